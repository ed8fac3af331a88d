"""What several operators need: lineage cuts, labelled rows, connected components."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at ``spark.checkpoint.dir``; a fresh local folder only for a local master with none set."""
    if spark.sparkContext.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cxlake-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)


def keep_on_disk(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back: later
    uses neither recompute it nor depend on the executor that made it."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are on disk by now.

    They go when the driver's garbage is collected, which a driver with little
    to do may put off while the executors' disks fill."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


BATCH_BYTES, BATCH_ROWS = 2 << 20, 1000


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python in batches of about ``BATCH_BYTES`` (Spark's default of 64 MB would
    take much of a worker's memory). The setting stays with the session."""
    size, rows = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(size, None) is not None:
        spark.conf.set(size, str(BATCH_BYTES))
    elif not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:  # versions that count rows only
        spark.conf.set(rows, str(BATCH_ROWS))


def id_hash(col: Column) -> Column:
    """Unsigned crc32 of an id's text: the fold of a row, on every engine."""
    return F.crc32(col.cast("string").cast("binary"))


FOLDS = 5


def labelled_rows(rows: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Every row of ``rows`` whose doc_id has the value 0 or 1 in ``labels[label]``, outside fold 0, and
    that value as ``label``; ids whose labels contradict each other are left out. Kept on disk."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (id_hash(F.col("doc_id")) % FOLDS != 0))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("_most"))
        .where(F.col("label") == F.col("_most"))
    )
    return keep_on_disk(rows.join(known, rows["doc_id"] == known["_id"]).drop("_id", "_most"))


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links (node, smallest node of its piece) equivalent to the given links."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


PIECE = 1 << 20


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace a partition's links by star links, ``PIECE`` at a time (a star has at most one link a node)."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> pa.RecordBatch:
        a, b = spanning_links(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["u", "v"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= PIECE:
            yield out()
            held, size = [], 0
    if held:
        yield out()


SALTS = 64


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) rows with ``m``, the smallest v of each u.

    Reduced per (u, salt), then per u, and joined back per (u, salt): the rows of a hub, which
    may be most of all, are spread over ``SALTS`` keys and never meet in one task."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    parts = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    lows = parts.select("u", "salt", F.min("m").over(Window.partitionBy("u")).alias("m"))
    return salted.join(lows, ["u", "salt"]).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable over the links, for every linked node.

    ``links`` has two long columns. Alternating large-star and small-star steps
    (each a minimum per node, salted so that hubs are spread) until the
    links are stars; every round is written to the shared folder, so the plan
    stays short and a lost executor costs one round. Nothing goes to the driver
    but a count and a checksum per round.
    """
    a, b = links.columns
    pairs = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where(
        F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))
    )
    edges = keep_on_disk(pairs.mapInArrow(_local_stars, "u bigint, v bigint"))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("v", "u"))).first())

    seen = mark(edges)
    if seen[0] == 0:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        # small star: every node's links, itself the larger end, meet at its smallest neighbour
        near = _with_least(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        edges = keep_on_disk(near.select("u", F.col("m").alias("v")).unionByName(small).distinct())
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
