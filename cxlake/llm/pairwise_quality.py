"""Quality classifier: Bradley-Terry pairwise ranking of documents.

Every pair of an accepted and a rejected document says that the accepted one
is preferred. The model gives each document a strength, linear in features of
its text, and the chance that one is preferred is the logistic function of the
difference in strengths; the weights minimise the mean logistic loss over all
pairs of labelled rows outside fold 0 (rows of fold 0 are held out). The cut is
a quantile of the strengths of those rows, and the published score is the
logistic function of the strength, shifted so that the cut falls on
``THRESHOLD``.

The pairs are never listed. A pair's loss depends on its two strengths alone,
so each Newton step takes two passes over the rows: counts and feature sums per
class and bin of the strength (``STEP`` wide), which give the slope of the loss
over all pairs of bins at the bins' mean strengths (error about ``STEP`` ** 2 /
250 of a pair's share), and second moments under the weights that follow. The
driver gets one row a bin; the rows stay in Spark.

Inputs of a score are text statistics only (never labels, language, source or
ids).

Defined results: null and empty texts have all-zero features and are scored
like any other; repeated rows each get a row; with labels of one kind only (or
none) every score is 1 (or 0 if all labels are 0).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cxlake.llm.shared import FOLDS, id_hash, keep_on_disk, labelled_rows, small_batches
from cxlake.llm.text_stats import COUNTS, count_texts, rates, text_counts

THRESHOLD, RIDGE = 0.3, 1e-3
# bins of the strength: width in the fit and for the cut; strengths beyond REACH count as REACH there
STEP, FINE, REACH = 1 / 8, 1 / 512, 64.0

# (features, accepted) of a batch -> (keys, rows of values), and the sums of the values by key over all batches
Run = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
Sums = Callable[[Run, int], tuple[np.ndarray, np.ndarray]]


def features(c) -> np.ndarray:
    """Rates and their saturating and squared-root forms, so that a linear strength can bend."""
    r = np.clip(rates(c), 0, 10)
    words = np.asarray(c["n_words"], dtype=np.float64)
    return np.column_stack([r, np.sqrt(r), np.minimum(r, 0.3), np.log1p(words), 1.0 / (1.0 + words)])


@dataclass
class Ranker:
    """Standardised linear strengths; ``cut`` is the strength that scores ``THRESHOLD``."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.strength(x) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys, ascending, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    if not len(keys):
        return keys, values
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def strength_keys(s: np.ndarray, good: np.ndarray, width: float) -> np.ndarray:
    """Bin of the strength and, in the lowest bit, the class."""
    return 2 * np.floor(np.clip(s, -REACH, REACH) / width).astype(np.int64) + good


def fit(sums: Sums, mean: np.ndarray, spread: np.ndarray, ridge: float = RIDGE) -> Ranker:
    """Bradley-Terry weights by Newton steps on the mean logistic loss of all pairs."""
    spread = np.where(spread > 1e-9, spread, 1.0)
    w = np.zeros(len(mean))

    def step_of(w: np.ndarray) -> np.ndarray:
        def binned(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            z = (x - mean) / spread
            return strength_keys(z @ w, good, STEP), np.column_stack([np.ones(len(z)), z])

        keys, total = sums(binned, 1 + len(w))
        good, n, z = (keys & 1) == 1, total[:, 0], total[:, 1:]
        level = z @ w / n
        # the chance that the rejected one is preferred, for each pair of an accepted and a rejected bin
        p = 1.0 / (1.0 + np.exp(np.clip(level[good][:, None] - level[~good], -50, 50)))
        q = p * (1 - p)
        many = n[good].sum() * n[~good].sum()
        slope = ridge * w - ((p @ n[~good]) @ z[good] - (n[good] @ p) @ z[~good]) / many
        heavy = np.empty(len(keys))
        heavy[good], heavy[~good] = q @ n[~good], n[good] @ q

        def curved(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            z = (x - mean) / spread
            at = np.searchsorted(keys, strength_keys(z @ w, good, STEP))
            return np.arange(len(w)), (z * heavy[np.minimum(at, len(keys) - 1)][:, None]).T @ z

        cross = z[good].T @ q @ z[~good]
        curve = ridge * np.eye(len(w)) + (sums(curved, len(w))[1] - cross - cross.T) / many
        return np.linalg.solve(curve, slope)

    for _ in range(25):
        step = step_of(w)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w = w - step
        if np.abs(step).max() < 1e-3:
            break

    def levels(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return strength_keys((x - mean) / spread @ w, good, FINE), np.ones((len(x), 1))

    keys, n = sums(levels, 1)
    return Ranker(mean, spread, w, quantile_cut(keys, n[:, 0]))


def quantile_cut(keys: np.ndarray, n: np.ndarray, spare: float = 2.0) -> float:
    """The quantile of the strengths, as counted in bins ``FINE`` wide, that parts the labels best: share
    of rejected rows below it, less ``spare`` times the share of accepted ones."""
    good, bins = (keys & 1) == 1, keys >> 1
    upto = np.searchsorted(np.cumsum(n), np.linspace(0.0, 1.0, 2001)[:-1] * n.sum(), side="right")
    cuts = np.unique(bins[upto])  # the lower edges of the bins that hold the quantiles
    good_below, bad_below = (np.concatenate([[0.0], np.cumsum(n[c])])[np.searchsorted(bins[c], cuts)] / max(n[c].sum(), 1) for c in (good, ~good))
    value = bad_below - spare * good_below
    best = np.flatnonzero(value >= value.max() - 1e-12)
    return float(cuts[best[len(best) // 2]] * FINE)


def fit_pairs(x: np.ndarray, good: np.ndarray, ridge: float = RIDGE) -> Ranker:
    """The fit to rows in memory."""
    return fit(lambda run, width: by_key(*run(x, good)), x.mean(axis=0), x.std(axis=0), ridge)


def train(counts: DataFrame, labels: DataFrame, ridge: float = RIDGE) -> Ranker:
    """The fit to all labelled rows of ``counts`` (doc_id and COUNTS), which stay in Spark."""
    known = labelled_rows(counts, labels, "quality")
    width = features({c: np.zeros(1) for c in COUNTS}).shape[1]
    names = [f"f{i}" for i in range(width)]

    def to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features({c: b.column(i + 1) for i, c in enumerate(COUNTS)})
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(f) for f in x.T]], ["label", *names])

    rows = keep_on_disk(known.select("label", *COUNTS).mapInArrow(to_features, "label int, " + ", ".join(f"{f} double" for f in names)))
    measures = [m(f) for m in (F.avg, F.stddev_pop) for f in names]
    kinds, *moments = rows.agg(F.count_distinct("label"), *measures).first()
    if kinds < 2:
        only = rows.agg(F.max("label")).first()[0]
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 100.0 if only == 0 else -100.0)

    def sums(run: Run, size: int) -> tuple[np.ndarray, np.ndarray]:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = np.column_stack([c.to_numpy() for c in b.columns[1:]])
                keys, values = by_key(*run(x, b.column(0).to_numpy() == 1))
                yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(v) for v in values.T]], ["key", *columns])

        columns = [f"v{i}" for i in range(size)]
        parts = rows.mapInArrow(part, "key bigint, " + ", ".join(f"{c} double" for c in columns))
        found = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in columns]).toPandas().sort_values("key")
        return found["key"].to_numpy(), found[columns].to_numpy()

    return fit(sums, np.array(moments[:width]), np.array(moments[width:]), ridge)


def score_documents(docs: DataFrame, ranker: Ranker, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``carry`` columns and ``score`` of every whole text, in one pass without a shuffle."""
    cols = ["doc_id", "text", *[c for c in carry if c not in ("doc_id", "text")]]
    chosen = docs.select(*[docs[c] for c in cols])
    keep = [i for i, c in enumerate(cols) if c != "text" or "text" in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = ranker.score(features(count_texts(b.column(1))))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(score)], [*[cols[i] for i in keep], "score"])

    schema = chosen.select(*[cols[i] for i in keep]).schema.add("score", "double")
    return chosen.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document. The text is read once, its counts are kept on disk."""
    small_batches(docs.sparkSession)
    counts = keep_on_disk(text_counts(docs))
    ranker = train(counts, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = ranker.score(features({c: b.column(i + 1) for i, c in enumerate(COUNTS)}))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["doc_id", "score"])

    id_type = counts.schema["doc_id"].dataType.simpleString()
    scored = counts.select("doc_id", *COUNTS).mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id",
        (id_hash(F.col("doc_id")) % FOLDS == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
