"""Best-fit packing, raking and sampled shards."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cxlake.llm import mixing, packing, sharding

from .helpers import DOCS, awkward, documents


def brute_best_fit(lengths, sources, clusters, capacity):
    bins, placed = [], []
    for n, s, c in zip(lengths, sources, clusters):
        fits = [
            (b["room"], i) for i, b in enumerate(bins)
            if b["room"] >= n and s not in b["sources"] and (c is None or c not in b["clusters"])
        ]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append({"room": capacity, "sources": set(), "clusters": set()})
        placed.append((i, capacity - bins[i]["room"]))
        bins[i]["room"] -= n
        bins[i]["sources"].add(s)
        bins[i]["clusters"].add(c)
    return placed


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_matches_brute_force(seed):
    rng = random.Random(seed)
    n = 300
    lengths = sorted((rng.choice([0, 1, 5, 40, rng.randrange(1, 100)]) for _ in range(n)), reverse=True)
    sources = [rng.choice(["hot", "hot", rng.randrange(9)]) for _ in range(n)]
    clusters = [rng.choice([None, rng.randrange(60)]) for _ in range(n)]
    assert packing.best_fit(lengths, sources, clusters, 100) == brute_best_fit(lengths, sources, clusters, 100)


def check_bins(docs, packed, capacity, clusters):
    rows = packed.collect()
    length = {}
    for r in docs.collect():
        length[r["doc_id"]] = length.get(r["doc_id"], 0) + len(r["text"] or "")
    got, bins = {}, {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        bins.setdefault(r["bin_id"], []).append(r)
    assert got == length
    for held in bins.values():
        assert sum(r["length"] for r in held) <= capacity
        assert len({r["source"] for r in held}) == len(held)
        twins = [clusters[r["doc_id"]] for r in held if clusters.get(r["doc_id"])]
        assert len(set(twins)) == len(twins)
        at = 0
        for r in sorted(held, key=lambda r: (r["offset"], r["length"])):
            assert r["offset"] == at
            at += r["length"]


def test_packing_keeps_everything_and_all_conflicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    check_bins(docs, packing.pack(docs, group_docs=300), packing.CAPACITY, text)


def test_packing_awkward(spark):
    docs = awkward(spark)
    packed = packing.pack(docs, capacity=1000)
    check_bins(docs, packed, 1000, {})
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0
    one = documents(spark, [(1, "abc" * 900, "en", "a"), (2, "xyz", "en", "b")], clashing=True)
    texts = {r["bin_id"]: r["text"] for r in packing.sequences(one, packing.pack(one, capacity=1000)).collect()}
    assert sorted("".join(texts.values())) == sorted("abc" * 900 + "xyz")


def test_raking_meets_the_marginals():
    rng = np.random.default_rng(0)
    cells = [(s, l, t) for s in "abcd" for l in "xy" for t in "uvw"]
    tokens = rng.uniform(1, 1000, len(cells))
    targets = [{"a": 0.1, "b": 0.2, "c": 0.3, "d": 0.4}, {"x": 0.7, "y": 0.3}, {"u": 0.5, "v": 0.25, "w": 0.25}]
    weight = mixing.rake(cells, tokens, targets)
    for d, target in enumerate(targets):
        for level, share in target.items():
            assert abs(sum(w for c, w in zip(cells, weight) if c[d] == level) - share) < 1e-7
    # raking changes no odds ratio
    w = {c: x for c, x in zip(cells, weight)}
    t = {c: x for c, x in zip(cells, tokens)}

    def odds(z):
        return z["a", "x", "u"] * z["b", "y", "u"] / (z["a", "y", "u"] * z["b", "x", "u"])

    assert abs(odds(w) / odds(t) - 1) < 1e-6


def test_keep_rates_hold_the_budget():
    rng = np.random.default_rng(2)
    tokens, weight = rng.uniform(1, 100, 50), rng.uniform(0, 1, 50)
    weight /= weight.sum()
    for keep in (0.1, 0.5, 0.9, 1.0):
        rates = mixing.keep_rates(weight, tokens, keep)
        assert rates.min() >= 0 and rates.max() <= 1 and abs((rates * tokens).sum() - keep * tokens.sum()) < 1e-6 * tokens.sum()


def test_sampling_follows_the_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    targets = {"source": {f"src{i}": (0.12 if i == 0 else 0.88 / 19) for i in range(20)}}
    rows = mixing.sample_report(docs, targets=targets, keep=0.3).collect()
    total = docs.select(mixing.token_count(docs["text"]).alias("n")).groupBy().sum("n").first()[0]
    kept = sum(r["tokens"] for r in rows)
    assert abs(kept / total - 0.3) < 0.05
    assert abs(sum(r["tokens"] for r in rows if r["source"] == "src0") / kept - 0.12) < 0.05


def test_registered_parameters_meet_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    levels = [f"_{d}" for d in mixing.DIMENSIONS]
    rows = mixing.with_cells(docs).groupBy(*levels).agg({"tokens": "sum"}).collect()
    tokens = {tuple(r)[:3]: r[3] for r in rows}
    total = sum(tokens.values())
    report = mixing.sample_report(docs).collect()
    kept = sum(r["tokens"] for r in report)
    assert abs(kept / total - mixing.KEEP) < 0.01
    rate = {(r["source"], r["lang"], r["topic"]): (r["weight"], r["probability"]) for r in report}
    # the weights are what the probabilities keep
    for c, (weight, probability) in rate.items():
        assert abs(weight - probability * tokens[c] / (mixing.KEEP * total)) < 1e-4
    for d, name in enumerate(mixing.DIMENSIONS):
        share = {}
        for c, n in tokens.items():
            share[c[d]] = share.get(c[d], 0) + n / total
        flat = mixing.flattened(share, mixing.TEMPERATURE)
        # what exceeds a level's own tokens goes to the others in proportion
        most = {x: s / mixing.KEEP for x, s in share.items()}
        low, high = 0.0, 100.0
        for _ in range(100):
            scale = (low + high) / 2
            low, high = (scale, high) if sum(min(most[x], scale * f) for x, f in flat.items()) < 1 else (low, scale)
        for x, f in flat.items():
            target = min(most[x], low * f)
            assert abs(sum(w for c, (w, _) in rate.items() if c[d] == x) - target) < 1e-4, (name, x)
            assert abs(sum(r["tokens"] for r in report if r[name] == x) / kept - target) < 0.02, (name, x)


def test_raking_within_bounds():
    rng = np.random.default_rng(3)
    cells = [(s, l, t) for s in "abcd" for l in "xy" for t in "uvw"]
    tokens = rng.uniform(1, 1000, len(cells))
    flat = [mixing.flattened({n: sum(t for c, t in zip(cells, tokens) if c[d] == n) for n in names}, 0.2) for d, names in enumerate(("abcd", "xy", "uvw"))]
    for keep in (0.1, 0.5, 0.8, 1.0):
        weight, met = mixing.rake_within(cells, tokens, flat, keep)
        assert (weight <= tokens / (keep * tokens.sum()) + 1e-4).all()
        for d, target in enumerate(met):
            for level, share in target.items():
                assert abs(sum(w for c, w in zip(cells, weight) if c[d] == level) - share) < 1e-4
    # level by level in reach, but together not: x and b share no cell
    weight, met = mixing.rake_within([("a", "x"), ("b", "y")], np.array([50.0, 50.0]), [{"a": 0.9, "b": 0.1}, {"x": 0.1, "y": 0.9}], 0.4)
    assert np.allclose(weight, 0.5) and met == [{"a": 0.5, "b": 0.5}, {"x": 0.5, "y": 0.5}]
    # a level without a target gets nothing
    weight, _ = mixing.rake_within([("a",), ("b",), ("c",)], np.array([10.0, 10.0, 10.0]), [{"a": 0.3, "b": 0.7}], 0.9)
    assert np.allclose(weight, [0.5, 0.5, 0])


def test_every_level_is_raked_on_the_driver_or_by_steps(spark):
    rows = [(i, f"text {i} of a host " * (1 + i % 300 // 30), ("en", "de", "fr")[i % 7 % 3], f"host{i % 300}") for i in range(1500)]
    docs = documents(spark, rows)
    for options in ({"keep": 0.3}, {"keep": 0.9, "targets": {"lang": {"en": 0.5, "de": 0.5}}}):
        got = [{r["doc_id"]: r for r in mixing.sample_report(docs, driver_cells=n, **options).collect()} for n in (mixing.DRIVER_CELLS, 0)]
        assert mixing.OTHER not in {r["source"] for r in got[0].values()}
        assert len(set(got[0]) ^ set(got[1])) <= 2
        for i in set(got[0]) & set(got[1]):
            assert abs(got[0][i]["probability"] - got[1][i]["probability"]) < 1e-3 and abs(got[0][i]["weight"] - got[1][i]["weight"]) < 1e-5


def test_mixing_awkward(spark):
    docs = awkward(spark)
    assert mixing.sampled_documents(docs, keep=1.0).count() == docs.count()
    assert mixing.sampled_documents(docs, keep=1.0).columns == docs.columns
    assert mixing.sampled_documents(docs, keep=1.0, max_levels=1).count() == docs.count()
    assert mixing.sampled_documents(spark.createDataFrame([], DOCS)).count() == 0


def check_shards(rows, docs, shards):
    assert len(rows) == len(docs)
    sizes = {}
    for r in rows:
        sizes.setdefault(r["shard"], []).append(r)
    assert set(sizes) <= set(range(shards))
    total = sum(r["size"] for r in rows)
    largest = max((r["size"] for r in rows), default=0)
    for held in sizes.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
        assert abs(sum(r["size"] for r in held) - total / shards) <= largest + 1


@pytest.mark.parametrize("sample", [20, 1])
def test_shards_are_near_equal(spark, sample):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard_by_bytes(docs, 40, sample=sample).collect()
    text = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    check_shards(rows, text, 40)
    assert all(r["size"] == len(text[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in rows)
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


def test_shards_split_a_large_group_of_copies(spark):
    rows = [(i, "the same text") for i in range(600)] + [(1000 + i, f"text {i} " * (i % 7)) for i in range(900)]
    got = sharding.shard_by_bytes(documents(spark, rows), 10, sample=2).collect()
    check_shards(got, rows, 10)
    shards = sorted({r["shard"] for r in got if r["doc_id"] < 1000})
    assert len(shards) > 1 and shards == list(range(shards[0], shards[-1] + 1))


@pytest.mark.parametrize("options", [{}, {"range_rows": 5}, {"ranges": 1, "sample": 1}])
def test_shards_are_those_of_a_sorted_prefix_sum(spark, options):
    """Shard and slot of every row, equal rows (a third of all) included, whatever the ranges."""
    rows = [(i, f"text {i % 200} " * (i % 11)) for i in range(600)] + [(7, "one row again and again")] * 300 + [(None, "no id"), (8, None)]
    docs = documents(spark, rows)
    got = sharding.shard_by_bytes(docs, 12, **options).collect()
    check_shards(got, rows, 12)
    hashed = docs.selectExpr("xxhash64(coalesce(text, '')) AS h", "doc_id", "octet_length(coalesce(text, '')) + 16 AS size").collect()
    ordered = sorted(hashed, key=lambda r: (r["h"], r["doc_id"] is not None, r["doc_id"] or 0))
    total, so_far, slots, want = sum(r["size"] for r in ordered), 0, {}, []
    for r in ordered:
        shard = so_far * 12 // total
        want.append((r["doc_id"], r["size"], shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        so_far += r["size"]
    assert sorted(((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in got), key=repr) == sorted(want, key=repr)
    assert len({r["shard"] for r in got if r["doc_id"] == 7 and r["size"] == 39}) > 1  # equal rows can part


@pytest.mark.parametrize("n", [1, 2, 5, 64])
def test_range_search(spark, n):
    rng = random.Random(n)
    keys = [(rng.randint(-3, 3), rng.choice([None, -1, 0, 2]), rng.randint(0, 4)) for _ in range(300)]
    splitters = sorted(set(keys), key=sharding._order)[:n]
    found = spark.createDataFrame(keys, "hash bigint, doc_id bigint, nth bigint").select("*", sharding._range_of(splitters).alias("range")).collect()
    assert all(r["range"] == sum(sharding._order(s) <= sharding._order(r[:3]) for s in splitters) for r in found)


def test_shards_awkward(spark):
    docs = awkward(spark)
    rows = sharding.shard_by_bytes(docs, 4).collect()
    check_shards(rows, docs.collect(), 4)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (1, 2)} == {(16, 0)}
    assert sharding.shard_by_bytes(spark.createDataFrame([], DOCS), 4).count() == 0
