"""Prefix trie, whitening and WARC against brute force, with awkward rows, small bounds and foreign archives."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
import tempfile
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cxlake.llm import prefix_trie, warc, whitening

CONV = "conv_id bigint, turn bigint, role string, text string"


# -- op11 --------------------------------------------------------------------------


def brute_trie(rows):
    conv = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            text = text or ""
            tie = hashlib.sha256(text.encode()).hexdigest()
            conv[c].append(((t is not None, t or 0, role or "", tie), role or "", text))
    conv = {c: [(r, x) for _, r, x in sorted(v, key=lambda q: q[0])] for c, v in conv.items()}
    members, ends, children, parent, depth = defaultdict(list), defaultdict(list), defaultdict(set), {}, {}
    for c, own in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = conv.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            key = tuple(turns[:d])
            members[key].append(c)
            depth[key] = d
            if d:
                parent[key] = key[:-1]
                children[key[:-1]].add(key)
        ends[tuple(turns)].append(c)
    leaves, saved, out = defaultdict(int), defaultdict(int), []
    for key in sorted(depth, key=lambda k: -len(k)):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        leaves[key] = leaves[key] or 1
        saved[key] += (len(members[key]) - 1) * words
        above = parent.get(key)
        if key:
            leaves[above] += leaves[key]
            saved[above] += saved[key]
        digest = hashlib.sha256(",".join(str(c) for c in sorted(ends[key])).encode()).hexdigest()
        out.append((min(members[key]), depth[key], min(members[above]) if key else None, len(members[key]), len(children[key]), leaves[key], saved[key], digest))
    return sorted(out, key=repr)


def trie_rows(df):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df).collect()), key=repr)


def conversations():
    """A hot opening and a hot conversation, chains, absent bases, negative ids, nulls, repeated rows, ties."""
    dice, rows = random.Random(5), []
    for c in range(-40, 400):
        if c % 20 == 0 and c % 3 == 0:
            continue  # absent base
        if c % 3 == 0:
            rows += [(c, i, "user", f"common {i}") for i in range(6)]
        else:
            n = dice.choice([0, 1, 2, 3, 5, 9])
            rows += [(c, 0, "system", "the hot opening")] * (c % 5 == 0)
            rows += [(c, i + 1, dice.choice(["user", "assistant"]), f"w{dice.randrange(3)} " * dice.randrange(4)) for i in range(n)]
    rows += [(1000, i, "user", f"step {i % 7}") for i in range(300)]
    rows += [(1001, None, None, None), (1001, None, None, None), (1001, 1, "user", "é 日本"), (1001, 1, "user", "a"), (1002, 5, "", ""), (None, 1, "user", "x")]
    return rows


def test_trie_matches_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "1 AS depth", "'x' AS k1", "2 AS c", "'y' AS block")
    assert trie_rows(df) == brute_trie(rows)


def test_trie_with_small_blocks_classes_and_queues(spark, monkeypatch):
    """Many blocks a conversation, many classes and spilled queues give the same rows."""
    rows = conversations()
    for name, value in (("BLOCK", 4), ("SPREAD", 3), ("SALTS", 3), ("RUN_STEP", 3), ("PACK_BYTES", 16)):
        monkeypatch.setattr(prefix_trie, name, value)
    monkeypatch.setattr(prefix_trie.MessageQueue.__init__, "__defaults__", (8, 3))
    assert prefix_trie.class_count(440) > 4
    assert trie_rows(spark.createDataFrame(rows, CONV)) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_rows(spark.createDataFrame([], CONV)) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "user", "x")], CONV)) == []


def test_turnless_conversations_belong_to_the_root(spark):
    c = next(i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 4 == 3)
    rows = [(c, 1, "user", "a"), (c, 2, "user", "b")]
    assert trie_rows(spark.createDataFrame(rows, CONV)) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_queue_spills_and_keeps_order():
    dice = random.Random(1)
    queue = prefix_trie.MessageQueue(held=10, most_runs=4)
    items = [(dice.randrange(50), i) for i in range(3000)]
    for item in items:
        queue.push(item)
    assert queue.spilled > 4 and len(queue.heap) <= 10
    got = [(k, *rest) for k in range(50) for rest in queue.take((k,))]
    assert got == sorted(items)
    queue.push((1, 0))
    with pytest.raises(RuntimeError):
        list(queue.take((2,)))


# -- op12 --------------------------------------------------------------------------


def check_whitened(vectors, found):
    x = np.floor(np.array([v for _, v in vectors], dtype=float) * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    values, basis = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True).reshape(x.shape[1], -1))
    values, basis = values[::-1], basis[:, ::-1]
    white = (x - s / n) @ basis[:, :4] / np.sqrt(values[:4])
    for c in range(min(4, x.shape[1])):
        rows = {r["vec_id"]: r for r in found if r["component"] == c + 1}
        got = np.array([rows[i]["whitened"] for i, _ in vectors])
        assert min(np.abs(got - white[:, c]).max(), np.abs(got + white[:, c]).max()) < 1e-8
        assert [rows[i]["deviation"] for i, _ in vectors] == [int(v) for v in ((n * x - s) ** 2).sum(axis=1)]
        for r in rows.values():
            assert r["n"] == n and r["identity_error"] < 1e-10
            assert abs(r["explained"] * values.sum() / values[c] - 1) < 1e-10


def test_whitening_matches_a_direct_eigendecomposition(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").repartition(13)
    vectors = [(r[0], r[1]) for r in table.select("vec_id", "embedding").collect()]
    check_whitened(vectors, whitening.whiten(table.selectExpr("*", "1 AS x", "2 AS n")).collect())


def test_whitening_with_equal_eigenvalues_and_constant_dimensions(spark):
    corners = [[float(a), float(b), float(c), 7.0, d / 2] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1) for d in range(9)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(corners + corners[:5])], "vec_id long, embedding array<double>")
    found = whitening.whiten(rows).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4} and {r["n"] for r in found} == {72}
    assert max(r["identity_error"] for r in found) < 1e-12
    white = np.array([[r["whitened"] for r in sorted(found, key=lambda r: r["vec_id"]) if r["component"] == c] for c in (1, 2, 3, 4)])
    assert np.abs(white[:, :72] @ white[:, :72].T / 72 - np.eye(4)).max() < 1e-12


def test_whitening_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, None), (5, [None, 1.0]), (6, [0.0, -0.0]), (7, [3.0, 1.0]), (None, [3.0, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (7, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = whitening.whiten(df).collect()
    assert sorted([(r["vec_id"] is None, r["vec_id"]) for r in found], key=repr) == sorted([(i is None, i) for i in (1, 6, 7, 7, None) for _ in range(2)], key=repr)
    check_whitened([(1, [1.0, 2.0]), (6, [0.0, 0.0]), (7, [3.0, 1.0])], [r for r in found if r["vec_id"] is not None])
    assert whitening.whiten(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [1.0])], "vec_id long, embedding array<double>")).collect()


@pytest.mark.parametrize("width,count", [(40, 300), (3, 60), (1, 9), (12, 4)])
def test_rank_one_updates_and_merges(width, count):
    dice = np.random.default_rng(width)
    x = np.floor(dice.normal(size=(count, width)) * 20)
    x[:, width // 2] = 3
    x[count // 2 :] = x[: count - count // 2]  # repeated vectors
    whole, left, right = (whitening.Spectrum(width) for _ in range(3))
    for i, y in enumerate(x):
        whole.add(y)
        (left if i % 3 else right).add(y)
    left.merge(right)
    centred = x - x.mean(axis=0)
    scatter = centred.T @ centred
    for s in (whole, left):
        assert s.n == count
        size = max(np.abs(scatter).max(), 1.0)
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() < 1e-12 * size * width
        assert np.abs(s.vectors.T @ s.vectors - np.eye(width)).max() < 1e-12


# -- op13 --------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string"


def report(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out, seen = [], set()
    for page_id, _, html in rows:
        data = (html or "").encode()
        low = first.get(html or "")
        is_first = page_id == low and (html or "") not in seen
        seen.add(html or "") if is_first else None
        revisit = len(data) >= 100 and not is_first
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", low if revisit else None))
    return sorted(out, key=repr)


def test_warc_round_trip(spark):
    hot = "<p>é 日本 the same page</p>" * 9
    rows = [(i, f"http://x.example/{i}", hot) for i in range(300, 0, -1)]
    rows += [(1000 + i, "http://a b\r\nWARC-Type: x", "q" * (97 + i % 6)) for i in range(12)]
    rows += [(5000, None, None), (5001, "u", ""), (5002, "u", "WARC/1.1\r\n\r\n\x1f\x8b"), (5003, "u", "long page " * 300_000), (None, "u", hot), (1, "u", hot), (5003, "u", "other")]
    df = spark.createDataFrame(rows, PAGES).repartition(7).selectExpr("*", "1 AS uid", "'x' AS payload_digest", "3 AS n")
    assert report(warc.round_trip(df)) == expected(rows)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_files_are_plain_gzip(spark):
    folder = tempfile.mkdtemp(prefix="cxlake-warc-") + "/a"
    warc.write_archives(spark.createDataFrame([(1, "http://x", "<p>hello</p>")], PAGES), folder)
    data = b"".join(r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content").collect())
    text = gzip.decompress(data).decode()
    assert text.count("WARC/1.1\r\n") == 2 and "WARC-Type: warcinfo" in text and "<p>hello</p>\r\n\r\n" in text


def foreign(dice, i):
    """A member as other tools make it: stored or compressed bytes, with file names, and magics inside the data."""
    noise = b"".join(dice.randbytes(dice.randrange(1, 400)) + warc.MAGIC * dice.randrange(3) for _ in range(dice.randrange(1, 12)))
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nX-Page-Id: %d\r\nContent-Length: %d\r\n\r\n" % (i, len(noise)) + noise + b"\r\n\r\n"
    pack = zlib.compressobj(dice.choice([0, 1, 9]), zlib.DEFLATED, -15)
    body = pack.compress(record) + pack.flush()
    head = warc.MAGIC + bytes([8]) + dice.randbytes(4) + b"\0\3name-%d.html\0" % i
    return noise, head + body + zlib.crc32(record).to_bytes(4, "little") + len(record).to_bytes(4, "little")


def test_reader_of_small_ranges_and_chance_magics(spark):
    """Ranges far smaller than a record, in several files: each record is owned once, and is whole."""
    dice = random.Random(3)
    folder, wanted = tempfile.mkdtemp(prefix="cxlake-warc-"), []
    for f in range(2):
        with open(f"{folder}/{f}.warc.bin", "wb") as out:
            for i in range(40):
                noise, member = foreign(dice, 1000 * f + i)
                wanted.append((1000 * f + i, noise))
                out.write(member)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (300, 1111, 60_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            records = warc.read_archives(spark, folder)
            found = [(int(r["fields"]["x-page-id"]), bytes(r["payload"])) for r in records.where("error is null").collect()]
            assert records.where("error is not null").count() == 0
            assert sorted(found) == sorted(wanted)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_damaged_members_are_reported(spark):
    folder = tempfile.mkdtemp(prefix="cxlake-warc-")
    good = [warc._member([("WARC-Type", "resource"), ("X-Page-Id", str(i))], random.Random(i).randbytes(500)) for i in range(4)]
    with open(f"{folder}/x.bin", "wb") as out:
        out.write(good[0] + good[1][:300] + good[2] + gzip.compress(b"no archive") + good[3])
    rows = warc.read_archives(spark, folder).collect()
    assert sorted(int(r["fields"]["x-page-id"]) for r in rows if r["error"] is None) == [0, 2, 3]
    assert sum(r["error"] is not None for r in rows) == 2
    with pytest.raises(Exception, match="no readable WARC member"):
        warc.page_report(warc.read_archives(spark, folder).select("*", F.lit(1).alias("other"))).collect()
