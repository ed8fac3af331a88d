"""Quality rules (isolation forest) and the pairwise quality classifier."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cxlake.llm import isolation, pairwise_quality, text_stats
from cxlake.llm.queries import op1_quality_rules, op4_quality_classifier

from .helpers import DOCS, awkward, words

SF = "/root/testdata/sf0.001"


def brute_counts(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
    lines, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


TEXTS = ["", None, " \n ", "a", "a b a b a b a", "x\r\nx\r\nx", "é é é é\n\nÉ\n日本 語 日本 語 日本 語", "#*$%&|<> ok", "l one\nl one\n l one\nl two", "a " * 5000]


def test_base_counts_match_brute_force():
    got = text_stats.count_texts(pa.array(TEXTS))
    assert [tuple(int(got[c][i]) for c in text_stats.BASE) for i in range(len(TEXTS))] == [brute_counts(t) for t in TEXTS]


def test_base_counts_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r["doc_id"]: brute_counts(r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: tuple(r[c] for c in text_stats.BASE) for r in op1_quality_rules(spark, SF).collect()}
    assert got == want


def test_long_texts_hash_alike_across_segments():
    from cxlake.llm import wordhash as W

    text = "ab cd ef " * (W.SEGMENT // 4)
    (t,) = list(W.slices(pa.array([text])))
    starts, ends, _ = t.words()
    assert len(set(W.span_hashes(t.buf, starts, ends, W.EXACT).tolist())) == 3


def test_rules_keep_clean_and_reject_junk(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in op1_quality_rules(spark, "/root/testdata/sf0.01").collect() if r["doc_id"] in labels]
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in rows)
    assert not any(r["kept"] and r["base_failed"] for r in rows)
    held = [r for r in rows if isolation_fold(r["doc_id"]) == 0]
    junk = [r["kept"] for r in held if labels[r["doc_id"]] == 0]
    clean = [r["kept"] for r in held if labels[r["doc_id"]] == 1 and not r["base_failed"]]
    assert sum(junk) <= 0.1 * len(junk) and sum(clean) >= 0.9 * len(clean)


def isolation_fold(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 5


def test_forest_scores_outliers_higher():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(500, 3)), [[9.0, 9.0, 9.0]]])
    scores = isolation.grow_forest(x).score(x)
    assert scores[-1] == scores.max() and scores[-1] > 0.6
    assert isolation.grow_forest(x[:0]).score(x).tolist() == [0.5] * len(x)


def test_awkward_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 0), (8, None, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    docs = awkward(spark)
    for operator in (isolation.quality_rules, pairwise_quality.classify):
        for l in (labels, none):
            assert operator(docs, l).count() == docs.count()
        assert operator(spark.createDataFrame([], DOCS), labels).count() == 0
    ruled = {r["doc_id"]: r for r in isolation.quality_rules(docs, labels).collect()}
    assert ruled[1]["n_words"] == 0 and ruled[1]["base_failed"] and not ruled[1]["kept"]


def test_classifier_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = op4_quality_classifier(spark, "/root/testdata/sf0.01").collect()
    assert all(r["held_out"] == (isolation_fold(r["doc_id"]) == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_pairwise_fit_orders_by_preference():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4))
    good = x @ np.array([2.0, -1.0, 0.0, 0.5]) + rng.normal(scale=0.1, size=400) > 0
    ranker = pairwise_quality.fit_pairs(x, good)
    score = ranker.score(x)
    assert np.mean((score >= pairwise_quality.THRESHOLD) == good) > 0.95
    assert score[good].mean() > score[~good].mean()


@pytest.mark.parametrize("label", [0, 1])
def test_classifier_with_one_kind_of_label(spark, label):
    docs = awkward(spark)
    labels = spark.createDataFrame([(i, label, 0) for i in range(1, 10)], "doc_id bigint, quality int, toxic int")
    assert {r["predicted"] for r in pairwise_quality.classify(docs, labels).collect()} == {label}


def count_rows(spark, n):
    """(n rows of counts, labels of all of them, 3 in 4 accepted); the ids are outside fold 0."""
    from pyspark.sql import functions as F

    ids = spark.range(2 * n).where("crc32(cast(cast(id as string) as binary)) % 5 != 0").limit(n).select(F.col("id").alias("doc_id"))
    rows = ids.select("doc_id", *[(F.xxhash64("doc_id", F.lit(c)) % 40 + 50).alias(c) for c in text_stats.COUNTS])
    return rows.localCheckpoint(), rows.select("doc_id", F.when(F.col("doc_id") % 4 > 0, 1).otherwise(0).alias("quality"))


def test_every_labelled_row_grows_the_forest(spark, monkeypatch):
    rows, labels = count_rows(spark, 45_000)
    known = isolation.labelled_rows(rows, labels, "quality")
    assert known.count() == 45_000
    seen = []

    def roots(measure, total, trees, tree_rows, seed):
        empty = isolation.Forest(np.full(trees, -1), np.zeros(trees), np.zeros(trees, int), np.zeros(trees, int), np.zeros(trees), trees, 1.0)
        seen.append((total * trees, *measure(empty, 0)))
        return empty

    monkeypatch.setattr(isolation, "grow", roots)
    isolation.grow_from_rows(known, 33_750, 11_250, 100, 256, 0.5)
    ((total, nodes, found),) = seen
    assert total == found[:, 0].sum() == 45_000 and nodes.tolist() == list(range(100))
    sample = rows.toPandas()
    x = text_stats.rates({c: sample[c] for c in text_stats.COUNTS})[:, : isolation.FOREST_RATES]
    assert np.array_equal(found[:, 1 : 1 + x.shape[1]].min(axis=0), x.min(axis=0))
    assert np.array_equal(found[:, 1 + x.shape[1] :].max(axis=0), x.max(axis=0))


def test_anomaly_cut_counts_every_row():
    level, accepted, rejected = np.array([3, 5, 9]), np.array([50_000, 10, 0]), np.array([1, 0, 30_000])
    cut = isolation.calibrate(level, accepted, rejected) * isolation.GRID
    assert 5 <= cut <= 8
    assert isolation.calibrate(level, accepted, rejected * 0) == float("inf")


def test_pairwise_fit_minimises_the_loss_of_all_pairs():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) * [1.0, 4.0, 0.5] + 2
    good = x @ np.array([1.0, -0.3, 0.5]) + rng.normal(scale=1.5, size=300) > 1.5
    ranker = pairwise_quality.fit_pairs(x, good)
    z = (x - ranker.mean) / ranker.spread
    diff = (z[good][:, None, :] - z[~good][None, :, :]).reshape(-1, 3)
    slope = pairwise_quality.RIDGE * ranker.weights - (diff / (1 + np.exp(diff @ ranker.weights))[:, None]).mean(axis=0)
    assert np.abs(slope).max() < 5e-4


def test_every_labelled_row_trains_the_classifier(spark):
    rows, labels = count_rows(spark, 45_000)
    ranker = pairwise_quality.train(rows, labels)
    sample = rows.join(labels, "doc_id").toPandas()
    x, good = pairwise_quality.features({c: sample[c] for c in text_stats.COUNTS}), sample["quality"].to_numpy() == 1
    assert np.allclose(ranker.mean, x.mean(axis=0), rtol=1e-12)
    local = pairwise_quality.fit_pairs(x, good)
    assert np.allclose(ranker.weights, local.weights, atol=1e-4) and abs(ranker.cut - local.cut) <= 2 * pairwise_quality.FINE
