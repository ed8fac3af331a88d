"""Quality rules judged by an isolation forest.

Rule statistics of every whole text (``text_stats``) are scored by random
trees: a document that few random splits separate from the rest has a short
path and is an anomaly. Every labelled row outside fold 0 takes part in the
forest and in its threshold. Rows are dealt to the trees by a hash of the
document id, each to one tree or, where that would leave a tree fewer than
``tree_rows`` rows, to several. All trees grow at once, a level a pass: Spark
gives the count and the box (least and greatest value per feature) of the rows
in each newest node, and the driver draws the next splits, so the model has a
fixed size (``trees`` trees as deep as those of ``tree_rows`` rows) whatever the
rows. Rejected rows weigh less, so that they stay rare: ``rejected_share`` of all
at most. The threshold is the anomaly score that separates accepted from
rejected rows best, by the counts of all labelled rows at ``GRID`` levels.

Defined results: a null or empty text has no words, so it fails the base rules
(``base_failed`` true, ``kept`` false) and its anomaly score is that of all-zero
statistics; repeated rows each get their own row; without labelled rows of both
kinds nothing is an anomaly (threshold above every score).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.llm.shared import keep_on_disk, labelled_rows, small_batches
from cxlake.llm.text_stats import BASE, COUNTS, rates, text_counts

TREES, TREE_ROWS, GRID, SEED = 100, 256, 1 << 16, 7
# The forest sees the first rates of ``text_stats.RATES``. The others (duplicate
# lines, digits, marks, word length) vary widely among accepted documents, and
# random splits on them cost clean documents: measured on held-out labelled rows
# of sf0.1, 1.1 % of accepted documents of 50 words or more were lost with all
# ten rates, none with these six, and no rejected one was kept either way.
FOREST_RATES = 6


@dataclass
class Forest:
    """Nodes of all trees in one array each (feature, -1: leaf; split value; children; path length); the roots come first."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    trees: int
    unit: float

    def leaves(self, x: np.ndarray, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The leaf that each listed row of ``x`` reaches from its node."""
        while True:
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                return node
            below = x[rows, np.maximum(feature, 0)] < self.value[node]
            node = np.where(inner, np.where(below, self.left[node], self.right[node]), node)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score 2^(-mean path / expected path), in (0, 1)."""
        if self.unit <= 0 or not len(x):
            return np.full(len(x), 0.5)
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for t in range(self.trees):
            total += self.length[self.leaves(x, rows, np.full(len(x), t))]
        return np.exp2(-total / self.trees / self.unit)


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows (in between for weights below 3)."""
    if n < 3:
        return float(np.interp(n, [1, 2, 3], [0.0, 1.0, average_path(3)]))
    return 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def boxes(forest: Forest, x: np.ndarray, weight: np.ndarray, place: np.ndarray, turns: int, newest: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes from ``newest`` on, their rows' weight, least and greatest values).

    A row is in ``turns`` trees, from number ``place`` on."""
    rows = np.repeat(np.arange(len(x)), turns)
    node = forest.leaves(x, rows, (np.repeat(place, turns) + np.tile(np.arange(turns), len(x))) % forest.trees)
    found = np.flatnonzero(node >= newest)
    found = found[np.argsort(node[found], kind="stable")]
    node, rows = node[found], rows[found]
    if not len(node):
        return node, np.zeros((0, 1 + 2 * x.shape[1]))
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    part = x[rows]
    return node[first], np.column_stack([np.add.reduceat(weight[rows], first), np.minimum.reduceat(part, first), np.maximum.reduceat(part, first)])


def grow(measure: Callable[[Forest, int], tuple[np.ndarray, np.ndarray]], total: float, trees: int, tree_rows: int, seed: int) -> Forest:
    """Trees grown a level at a time; ``measure(forest, newest)`` gives the ``boxes`` of the newest nodes over all rows.

    ``total`` is the weight of the rows of a tree."""
    rng, limit = np.random.default_rng(seed), math.ceil(math.log2(tree_rows))
    forest = Forest(np.full(trees, -1), np.zeros(trees), np.zeros(trees, int), np.zeros(trees, int), np.zeros(trees), trees, average_path(total))
    newest = 0
    for depth in range(limit + 1):
        nodes, found = measure(forest, newest)
        more = len(forest.feature)
        newest, features = more, (found.shape[1] - 1) // 2
        for node, row in zip(nodes.tolist(), found, strict=True):
            forest.length[node] = depth + average_path(row[0])
            low, high = row[1 : 1 + features], row[1 + features :]
            varied = np.flatnonzero(high > low)
            if depth < limit and len(varied):
                f = int(rng.choice(varied))
                v = float(rng.uniform(low[f], high[f]))
                forest.feature[node], forest.value[node] = f, v if v > low[f] else high[f]
                forest.left[node], forest.right[node] = more, more + 1
                more += 2
        if more == newest:
            break
        new = np.zeros(more - newest, int)
        forest.feature, forest.value = np.concatenate([forest.feature, new - 1]), np.concatenate([forest.value, new * 0.0])
        forest.left, forest.right = np.concatenate([forest.left, new]), np.concatenate([forest.right, new])
        forest.length = np.concatenate([forest.length, new * 0.0])
    return forest


def tree_turns(rows: int, trees: int, tree_rows: int) -> int:
    """In how many trees a row is: in one, or in as many as give every tree ``tree_rows`` rows."""
    return min(trees, max(1, -(-trees * tree_rows // max(rows, 1))))


def grow_forest(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """The forest of rows in memory, equal in weight."""
    turns, place = tree_turns(len(x), trees, tree_rows), np.random.default_rng(seed).permutation(len(x)) % trees
    weight = np.ones(len(x))
    return grow(lambda forest, newest: boxes(forest, x, weight, place, turns, newest), len(x) * turns / trees, trees, tree_rows, seed)


def grow_from_rows(rows: DataFrame, accepted: int, rejected: int, trees: int, tree_rows: int, rejected_share: float, seed: int = SEED) -> Forest:
    """The forest of all ``rows`` (doc_id, COUNTS, label)."""
    weight = min(1.0, rejected_share * accepted / (1 - rejected_share) / rejected) if accepted and rejected else 1.0
    turns = tree_turns(accepted + rejected, trees, tree_rows)
    placed = rows.select("label", F.pmod(F.xxhash64("doc_id"), F.lit(trees)).alias("place"), *COUNTS)
    ends = [f"{end}{f}" for end in ("low", "high") for f in range(FOREST_RATES)]
    names = ["node", "weight", *ends]

    def measure(forest: Forest, newest: int) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = rates({c: b.column(i + 2) for i, c in enumerate(COUNTS)})[:, :FOREST_RATES]
                heavy = np.where(b.column(0).to_numpy() == 1, 1.0, weight)
                node, found = boxes(forest, x, heavy, b.column(1).to_numpy(), turns, newest)
                yield pa.RecordBatch.from_arrays([pa.array(node), *[pa.array(c) for c in found.T]], names)

        parts = placed.mapInArrow(run, "node bigint, " + ", ".join(f"{c} double" for c in names[1:]))
        level = parts.groupBy("node").agg(F.sum("weight").alias("weight"), *[(F.min if c.startswith("low") else F.max)(c).alias(c) for c in ends])
        found = level.toPandas().sort_values("node")  # the nodes of one level of all trees
        return found["node"].to_numpy(), found[names[1:]].to_numpy()

    return grow(measure, (accepted + weight * rejected) * turns / trees, trees, tree_rows, seed)


def calibrate(level: np.ndarray, accepted: np.ndarray, rejected: np.ndarray, spare: float = 3.0) -> float:
    """Score above which a row is an anomaly, from the labelled rows with a score in (level - 1, level] / ``GRID``,
    levels ascending: the cut with the greatest share of rejected rows above it less ``spare`` times the
    share of accepted ones."""
    if not accepted.sum() or not rejected.sum():
        return math.inf
    caught = 1 - np.cumsum(rejected) / rejected.sum()
    lost = 1 - np.cumsum(accepted) / accepted.sum()
    at = int(np.argmax(caught - spare * lost))
    after = level[at + 1] - 1 if at + 1 < len(level) else level[at]
    return float(level[at] + after) / 2 / GRID


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    trees: int = TREES,
    tree_rows: int = TREE_ROWS,
    rejected_share: float = 0.05,
) -> DataFrame:
    """doc_id, the base counts, ``base_failed``, ``anomaly`` and ``kept`` per document.

    The text is read once; its counts (some 15 longs a document) are written to
    the shared folder, then joined to the labels and scored."""
    small_batches(docs.sparkSession)
    counts = keep_on_disk(text_counts(docs))
    known = labelled_rows(counts, labels, "quality")
    accepted, rejected = known.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    forest = grow_from_rows(known, accepted, rejected, trees, tree_rows, rejected_share)

    def scored(rows: DataFrame) -> DataFrame:
        def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                part["anomaly"] = forest.score(rates({c: part[c] for c in COUNTS})[:, :FOREST_RATES])
                yield part

        return rows.mapInPandas(judge, T.StructType([*rows.schema, T.StructField("anomaly", T.DoubleType())]))

    by_level = scored(known).groupBy(F.ceil(F.col("anomaly") * GRID).alias("level")).agg(
        F.count_if(F.col("label") == 1).alias("accepted"), F.count_if(F.col("label") == 0).alias("rejected")
    )
    levels = by_level.toPandas().sort_values("level")  # at most GRID
    cut = calibrate(*(levels[c].to_numpy() for c in ("level", "accepted", "rejected")))
    n_words, n_repeat = F.col("n_words"), F.col("n_repeat_words")
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    return scored(counts).select(
        "doc_id", *BASE, failed.alias("base_failed"), "anomaly", (~failed & (F.col("anomaly") <= cut)).alias("kept")
    )
