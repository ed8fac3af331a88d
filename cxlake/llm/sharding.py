"""Shards of near-equal bytes by sampled splitters (DataFrame functions only).

Records are ordered by a key, (hash of the text, doc_id, a number of the row): equal
texts are neighbours, and a group of any size can still be cut, even between equal rows.

1. A size-weighted sample of keys is drawn: a record is taken with a chance in
   proportion to its size, decided by a hash of its key (about ``SAMPLE`` keys a range).
2. Quantiles of the sample weights become splitters: ``RANGES`` ranges a shard, or
   as many as have ``RANGE_ROWS`` rows each on average, if that is more.
3. Bytes and rows of every range are counted exactly. Overfull ranges (twice
   the mean or more) are sampled again, more densely, and subdivided.
4. A record's shard follows from the bytes before it: those of earlier ranges
   (one small table) and of earlier records of its range (a window per range).
   Shard ``s`` holds the records that start in the ``s``-th equal part of the
   total, so sizes differ from the mean by less than one record; its slot is
   its place among them.

The driver holds the sample, splitters and range totals only: a few thousand keys,
or ``SAMPLE / RANGE_ROWS`` of the rows in large inputs (20 keys a million rows).

Defined results: a null text has no bytes, crc 0 and size 16; a null doc_id
sorts first among equal texts; rows with equal doc_id and text get neighbouring
places, in any order among them; an empty table gives an empty result.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cxlake.llm.shared import keep_on_disk

RECORD_BYTES = 16
RANGES, SAMPLE, RANGE_ROWS = 8, 20, 1_000_000
ROUNDS = 4

KEY = ("hash", "doc_id", "nth")
Key = tuple[int, int | None, int]


def _order(key: Key) -> tuple:
    """Python order of keys as Spark has it: nulls first."""
    return key[0], key[1] is not None, key[1] or 0, key[2]


def _draw(records: DataFrame, rate: Column, seed: int) -> list[tuple[Key, float]]:
    """Sampled keys with the bytes that each stands for."""
    chance = F.least(F.lit(1.0), F.col("size") * rate)
    uniform = F.pmod(F.xxhash64(*KEY, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    drawn = records.where(uniform < chance).select(*KEY, (F.col("size") / chance).alias("weight"))
    return [(tuple(r[c] for c in KEY), r["weight"]) for r in drawn.collect()]


def choose_splitters(sample: list[tuple[Key, float]], parts: int) -> list[Key]:
    """Keys at the weight quantiles of a sample; a range ends before its splitter."""
    ordered = sorted(sample, key=lambda s: _order(s[0]))
    total, so_far, cuts = sum(w for _, w in ordered), 0.0, []
    for key, weight in ordered:
        if so_far >= (len(cuts) + 1) * total / parts and len(cuts) < parts - 1:
            cuts.append(key)
        so_far += weight
    return cuts


def _range_of(splitters: list[Key]) -> Column:
    """Number of splitters at or below the record's key, by binary search.

    The splitters travel as one text, which the optimizer reads once into a literal."""
    if not splitters:
        return F.lit(0)
    keys = F.from_json(F.lit(json.dumps([dict(zip(KEY, s)) for s in splitters])), "array<struct<hash:bigint,doc_id:bigint,nth:bigint>>")
    key = F.struct(*KEY)
    widths = F.array(*[F.lit(1 << k) for k in reversed(range(len(splitters).bit_length()))])
    return F.aggregate(widths, F.lit(0), lambda low, width: F.when(F.get(keys, low + width - 1) <= key, low + width).otherwise(low))


def _totals(records: DataFrame, splitters: list[Key]) -> list[tuple[int, int, int]]:
    """(range, bytes, rows), in order; ranges without records are left out."""
    found = records.groupBy(_range_of(splitters).alias("range")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return sorted((r["range"], r["bytes"], r["rows"]) for r in found.collect())


def shard_by_bytes(docs: DataFrame, shards: int = 40, ranges: int = RANGES, sample: int = SAMPLE, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    At least ``ranges`` per shard, of ``range_rows`` rows at most on average, and about
    ``sample`` sampled keys per range."""
    text = F.coalesce(docs["text"], F.lit(""))
    records = keep_on_disk(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("hash"),
            F.monotonically_increasing_id().alias("nth"),
        )
    )
    total, rows = (n or 0 for n in records.agg(F.sum("size"), F.count(F.lit(1))).first())
    ranges = max(ranges, -(-rows // (shards * range_rows)))
    if not total:
        total, splitters = 1, []
    else:
        splitters = choose_splitters(_draw(records, F.lit(shards * ranges * sample / total), 0), shards * ranges)
    totals = _totals(records, splitters)
    for turn in range(ROUNDS):
        overfull = {r: b for r, b, n in totals if b > 2 * total / (shards * ranges) and n > 1}
        if not overfull:
            break
        # each overfull range gets a sample of its own, dense for its size
        inside = records.withColumn("range", _range_of(splitters)).where(F.col("range").isin(list(overfull)))
        more = []
        drawn = _draw(inside, F.lit(shards * ranges * 4 * sample / total), turn + 1)
        bounds = [_order(s) for s in splitters]
        by_range: dict[int, list[tuple[Key, float]]] = {}
        for key, weight in drawn:
            by_range.setdefault(sum(b <= _order(key) for b in bounds), []).append((key, weight))
        for r, part in by_range.items():
            more += choose_splitters(part, 2 * -(-overfull[r] * shards * ranges // total))
        grown = sorted(set(splitters) | set(more), key=_order)
        if len(grown) == len(splitters):
            break
        splitters = grown
        totals = _totals(records, splitters)

    spark, before, rows_before, starts = docs.sparkSession, 0, 0, []
    for r, size, rows in totals:
        starts.append((r, before, rows_before))
        before, rows_before = before + size, rows_before + rows
    offsets = F.broadcast(spark.createDataFrame(starts, "range int, bytes_before bigint, rows_before bigint"))

    in_range = Window.partitionBy("range").orderBy(*KEY)
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        records.withColumn("range", _range_of(splitters))
        .withColumn("end", F.sum("size").over(so_far))
        .withColumn("place", F.row_number().over(in_range))
        .join(offsets, "range")
        .select(
            "doc_id", "size", "text_crc32",
            F.floor((F.col("bytes_before") + F.col("end") - F.col("size")) * shards / F.lit(total)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("place") - 1).alias("at"),
        )
    )
    placed = keep_on_disk(placed)
    first = F.broadcast(placed.groupBy("shard").agg(F.min("at").alias("first")))  # one row a shard
    return placed.join(first, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("at") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
