"""Row numbers per group that stay parallel when one group is huge.

``row_number() OVER (PARTITION BY g ORDER BY k)`` puts every row of a group
in one task. ``ordered_numbers`` gives the same numbers on one path for groups
of any size, with no threshold:

1. rows are range-partitioned by (group, order columns), so a large group
   spans several ranges and small groups share one;
2. rows are numbered inside (range, group), in parallel;
3. a group that continues from an earlier range gets the number of its rows
   there added. At most one group continues into a range, so this table has
   fewer rows than there are ranges and is broadcast.

The ranges decide how evenly the work is split, never the result. The
range-partitioned rows are written to the shared checkpoint folder before they
are used twice (for numbers and for counts): both uses must see the same
ranges, also after an executor is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cxlake.session import use_checkpoint_dir


def in_ranges(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned by group and order, with ``_range`` (ascending), on disk."""
    use_checkpoint_dir(df.sparkSession)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *group_cols, *order_cols)
    return ranged.withColumn("_range", F.spark_partition_id()).checkpoint()


def ordered_numbers(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], out_col: str) -> DataFrame:
    """``df`` plus ``out_col`` = row_number() over (group_cols, order_cols); NULLs are a group and sort first."""
    group = list(group_cols)
    ranged = in_ranges(df, group, order_cols)
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order_cols)))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range at most: see above
    offsets = F.broadcast(
        counts.withColumn("_offset", F.sum("_rows").over(earlier))
        .where(F.col("_offset").isNotNull())
        .select(F.col("_range").alias("_r"), *[F.col(c).alias(f"_g_{c}") for c in group], "_offset")
    )
    same = local["_range"] == offsets["_r"]
    for c in group:
        same = same & local[c].eqNullSafe(offsets[f"_g_{c}"])
    number = (F.col("_local") + F.coalesce("_offset", F.lit(0))).cast("int")
    return local.join(offsets, same, "left").select(*df.columns, number.alias(out_col))
