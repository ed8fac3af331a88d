"""N-gram Jaccard join, embedding join and connected components against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from cxlake.llm import ego_join, ngram_join
from cxlake.llm.shared import components

from .helpers import DOCS, awkward, by_id, documents, words


def groups(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    low = {}
    for n in nodes:
        low[find(n)] = min(low.get(find(n), n), n)
    return {n: low[find(n)] for n in nodes}


def shingle_set(text, k):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_join(rows, k, percent):
    sets = {i: shingle_set(t, k) for i, t in rows}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    low = groups(list(sets), links)
    return sorted(((i, len(s), low[i]) for i, s in sets.items()), key=repr)


def edited(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def family_rows(seed, families=6, members=12, length=120, singles=40):
    """Near copies at many distances, exact copies, and a passage that unrelated texts share."""
    rng = random.Random(seed)
    rows, passage = [], " ".join(f"shared{i}" for i in range(40))
    for f in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(length)]
        for _ in range(members):
            rows.append(edited(rng, base, rng.choice([0, 1, 2, 3, 5, 8])))
    for _ in range(singles):
        rows.append(" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 200))) + (" " + passage if rng.random() < 0.5 else ""))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "percent", "seed"), [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_join_matches_brute_force(spark, k, percent, seed):
    rows = family_rows(seed)
    got = by_id(ngram_join.jaccard_components(documents(spark, rows), k, percent), "n_shingles", "component_id")
    assert got == brute_join(rows, k, percent)


def test_join_with_small_blocks_and_runs(spark, monkeypatch):
    """Lists cut into many blocks, dealt to many runs, with every slot overfull."""
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "RUN", 4)
    monkeypatch.setattr(ngram_join, "NEAR", 1)
    rows = family_rows(5, families=3, members=25, length=60, singles=20)
    for levels in (None, lambda load: np.where(np.arange(len(load)) % 3 == 0, 2, 0).astype(np.uint8)):
        if levels:
            monkeypatch.setattr(ngram_join, "slot_levels", levels)
        got = by_id(ngram_join.jaccard_components(documents(spark, rows), 4, 80), "n_shingles", "component_id")
        assert got == brute_join(rows, 4, 80)


def test_join_sizes_at_the_boundary(spark):
    """Exactly the wanted similarity links; a little less does not."""
    base = [f"w{i}" for i in range(103)]  # 100 shingles of 4 words
    rows = [(1, " ".join(base)), (2, " ".join(base[:88])), (3, " ".join(base[:87])), (4, " ".join(base[:86]))]
    got = by_id(ngram_join.jaccard_components(documents(spark, rows), 4, 85), "n_shingles", "component_id")
    assert got == brute_join(rows, 4, 85)


def test_join_awkward_rows(spark):
    docs = awkward(spark)
    got = by_id(ngram_join.jaccard_components(docs, 4, 85), "n_shingles", "component_id")
    assert len(got) == docs.count()
    assert (1, 0, 1) in got and (2, 0, 2) in got and (3, 0, 3) in got and got.count((5, 3, 5)) == 2
    assert (6, 3, 5) in got and (9, 3, 5) in got and (7, 1, 7) in got and (None, 0, None) in got and (None, 3, None) in got
    assert ngram_join.jaccard_components(spark.createDataFrame([], DOCS), 4, 85).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(80)]
    frame = spark.createDataFrame([*links, (5, 5), (None, 3)], "a bigint, b bigint").repartition(7)
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    nodes = {n for l in links for n in l}
    want = groups(nodes, links)
    assert all(got.get(n, n) == want[n] for n in nodes)
    assert components(frame.limit(0)).count() == 0


def vectors(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")
    return df.selectExpr("*", "'x' AS entry", "'x' AS vector", "'x' AS h1", "'x' AS copies", "'x' AS links")


def brute_vectors(rows, cosine):
    good = {}
    for i, v, _ in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=np.float32).astype(float)
    linked = [(a, b) for a, b in itertools.combinations(good, 2) if len(good[a]) == len(good[b]) and good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= cosine]
    low = groups([r[0] for r in rows], linked)
    n = {i: 0 for i, _, _ in rows}
    for a, b in linked:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], low[i], low[i] == i) for i, _, _ in rows}


@pytest.mark.parametrize("cosine", [0.95, 0.8])
def test_embeddings_match_brute_force(spark, monkeypatch, cosine):
    monkeypatch.setattr(ego_join, "INTERVAL", 40)
    monkeypatch.setattr(ego_join, "LEAF", 7)
    monkeypatch.setattr(ego_join, "FANOUT", 2)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(25, 8))
    rows = []
    for i in range(300):
        v = centres[rng.integers(25)] * rng.uniform(0.1, 9) + rng.normal(scale=rng.choice([0.0, 0.05, 0.2, 0.6]), size=8)
        rows.append((i * 3 % 1000, [float(np.float32(x)) for x in v], 0))
    rows += [(5000 + i, rows[0][1], 1) for i in range(60)]
    rows += [(6000, None, 0), (6001, [0.0] * 8, 0), (6002, [1.0, None] + [0.0] * 6, 0), (6003, [float("nan")] * 8, 0), (6004, [float("inf")] + [1.0] * 7, 0), (6005, [], 0), (6006, [1.0] * 5, 0)]
    # other lengths are joined as well
    rows += [(7000 + i, [float(np.float32(x)) for x in centres[i % 4, :3] * (i + 1)], 0) for i in range(12)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in ego_join.near_duplicates(vectors(spark, rows), cosine).collect()}
    assert got == brute_vectors(rows, cosine)


@pytest.mark.parametrize(("spread", "share"), [(0.02, 0.02), (0.02, 1.0), (0.3, 0.5)])
def test_partial_distances_lose_no_link(spread, share):
    """Intervals in more dimensions than the partial distances have: few links, all pairs linked, and links at the edge."""
    rng = np.random.default_rng(11)
    v = rng.normal(size=(700, 40))
    copies = rng.random(700) < share
    v[copies] = v[0] + rng.normal(scale=spread, size=(int(copies.sum()), 40))
    u = ego_join._unit(v)
    rotation = np.linalg.eigh(np.cov(u.T, bias=True))[1][:, ::-1]
    eps, many = float(np.sqrt(0.1)), rng.integers(1, 4, 700)
    x, y = ((np.arange(700)[s], many[s], u[s]) for s in (slice(0, 300), slice(300, 700)))
    linked = u @ u.T >= 0.95
    np.fill_diagonal(linked, False)
    for p, q, part in ((x, x, linked[:300, :300]), (x, y, linked[:300, 300:])):
        ids, top, links = ego_join.join_intervals(p, q, rotation, 0.95, eps)
        want = {int(i): int(n) for i, n in zip(p[0], part @ q[1]) if n}
        if q is y:
            want |= {int(i): int(n) for i, n in zip(q[0], part.T @ p[1]) if n}
        assert dict(zip(ids.tolist(), links.tolist())) == want and want
        pairs = [(int(p[0][i]), int(q[0][j])) for i, j in zip(*np.nonzero(part))]
        low = groups(list(want), pairs)
        assert {frozenset(ids[top == t].tolist()) for t in top} == {frozenset(i for i in low if low[i] == r) for r in low.values()}


def test_embeddings_awkward(spark):
    rows = [(None, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], None), (3, [1e-38, 0.0], 0)]
    got = sorted((tuple(r) for r in ego_join.near_duplicates(vectors(spark, rows), 0.95).collect()), key=repr)
    assert got == sorted([(None, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (2, 0, 2, True), (3, 3, 1, False)], key=repr)
    empty = vectors(spark, [])
    assert ego_join.near_duplicates(empty).count() == 0
    assert [tuple(r) for r in ego_join.near_duplicates(vectors(spark, [(4, None, 0)])).collect()] == [(4, 0, 4, True)]
    double = vectors(spark, [(1, [1e200, 1e200], 0), (2, [1e-200, 1e-200], 0)], "double")
    assert sorted(tuple(r) for r in ego_join.near_duplicates(double).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_embeddings_of_several_lengths_and_a_cosine_of_one(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [0.0, 1.0], 0), (10, [1.0, 2.0, 3.0], 0), (11, [1.0, 2.0, 3.0], 0), (12, [0.0, 0.0, 9.0], 0)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ego_join.near_duplicates(vectors(spark, rows)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 10: (1, 10), 11: (1, 10), 12: (0, 12)}
    same = {r["vec_id"]: r["n_links"] for r in ego_join.near_duplicates(vectors(spark, rows), cosine=1.0).collect()}
    assert same[1] == same[2] == 1 and same[10] == same[11] == 1 and same[3] == same[12] == 0


def test_representatives_keep_unlike_texts_of_one_id(spark):
    texts = {c: " ".join(f"{c}{i}" for i in range(40)) for c in "abcde"}
    near = texts["a"] + " more"
    rows = [(1, texts["a"]), (5, near), (5, texts["b"]), (5, texts["b"]), (6, texts["c"]), (6, texts["d"]), (7, texts["d"]), (8, None), (8, ""), (8, texts["e"]), (None, texts["a"])]
    docs = documents(spark, rows, clashing=True)
    kept = sorted((r["doc_id"], r["text"]) for r in ngram_join.representatives(docs).where("doc_id is not null").collect() if r["text"])
    assert kept in (
        sorted([(1, texts["a"]), (5, texts["b"]), (6, texts["c"]), (6, texts["d"]), (8, texts["e"])]),
        sorted([(1, texts["a"]), (5, texts["b"]), (6, texts["c"]), (7, texts["d"]), (8, texts["e"])]),
    )
    out = ngram_join.representatives(docs)
    assert out.columns == docs.columns and out.where("doc_id is null").count() == 1
    assert out.where("doc_id = 8").count() == 2  # the empty text once, and the other one


def test_components_of_a_star_and_a_chain_with_a_million_links(spark):
    n = 1_000_000
    star = spark.range(1, n + 1).selectExpr("id AS a", "0L AS b")
    ring = spark.range(n // 10).selectExpr(f"id + {10 * n} AS a", f"id + {10 * n} + 1 AS b")
    found = components(star.unionByName(ring)).groupBy("component").count().collect()
    # the smallest node of a piece may stand for itself or be left out
    assert {r["component"] for r in found} == {0, 10 * n}
    assert {r["component"]: r["count"] for r in found if r["component"]} in ({10 * n: n // 10}, {10 * n: n // 10 + 1})
    assert next(r["count"] for r in found if r["component"] == 0) in (n, n + 1)


def test_candidate_pairs_go_out_in_small_batches(monkeypatch):
    n = 300
    rows = np.column_stack([np.arange(n), np.full(n, 100), np.zeros(n, dtype=np.int64), np.arange(n)])
    monkeypatch.setattr(ngram_join, "PAIRS", 1000)
    for inner, want in ((True, n * (n - 1) // 2), (False, n * (n - 1))):
        batches = list(ngram_join.pair_batches(ngram_join.block_pairs(rows, rows, 80, inner)))
        assert max(b.num_rows for b in batches) < 1000 + n
        pairs = [(x, y) for b in batches for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
        assert len(pairs) == want and set(pairs) == set(itertools.combinations(range(n), 2))
    assert list(ngram_join.pair_batches(ngram_join.block_pairs(rows[:1], rows[:1], 80, False))) == []


def test_texts_under_ids_of_their_own_need_no_python_worker(spark):
    docs = documents(spark, [(1, "a b c d e f"), (2, "a b c d e g"), (None, "x")])
    named = ngram_join._text_ids(docs)
    assert "MapInArrow" not in named._jdf.queryExecution().toString()
    assert sorted((r["doc_id"], r["_id"]) for r in named.where("doc_id is not null").collect()) == [(1, 1), (2, 2)]
    assert named.where("_id is null").count() == 1
