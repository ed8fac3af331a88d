"""Keyed merge (upsert) as a DataFrame plan.

Semantics: rows match when every key column is equal (NULL never equals).
Matched target rows take the source row's values, unmatched source rows are
inserted, unmatched target rows are kept, nothing is deleted. A target row
matched by more than one source row is an error.

Plan: rows with a NULL in any key can never match, so they are split off
first and bypass the shuffle (otherwise every NULL key would hash to one
partition). The rest is ONE full outer join on the keys. The per-key source
row count used by the duplicate check is a window on the same keys, so it
rides on the join's hash partitioning instead of adding a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DUPLICATE_SOURCE_ERROR = "merge: several source rows match one target row"


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


DUPLICATE_IDENTITY_ERROR = "merge: several source rows have one identity"
ACTION_MOVED = "moved"
ACTION_INSERTED = "inserted"
ACTION_UPDATED = "updated"
ACTION_COPIED = "copied"


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    action_column: str | None = None,
) -> DataFrame:
    """Result of merging ``source`` into ``target`` on ``keys``.

    With ``action_column`` the result carries, per row, whether it was
    inserted, updated or copied unchanged from the target (used for the
    operation metrics; drop it before writing).
    """
    keys = list(keys)
    if not keys:
        raise ValueError("merge needs at least one key column")
    columns = target.columns
    missing = [c for c in columns if c not in source.columns]
    extra = [c for c in source.columns if c not in columns]
    if missing or extra:
        raise ValueError(f"merge: source columns differ from target (missing {missing}, extra {extra})")
    for k in keys:
        if k not in columns:
            raise ValueError(f"merge key {k!r} is not a column")
    source = source.select(*columns)
    values = [c for c in columns if c not in keys]

    null_key = _any_null(keys)
    t_null = target.where(null_key)
    s_null = source.where(null_key)

    t = target.where(~null_key).select(*keys, *[F.col(c).alias(f"_t_{c}") for c in values], F.lit(True).alias("_t"))
    s = source.where(~null_key).select(
        *keys,
        *[F.col(c).alias(f"_s_{c}") for c in values],
        F.lit(True).alias("_s"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("_source_count"),
    )
    joined = s.join(t, on=keys, how="full_outer")
    matched = F.col("_s").isNotNull() & F.col("_t").isNotNull()
    checked = joined.where(
        F.when(matched & (F.col("_source_count") > 1), F.raise_error(F.lit(DUPLICATE_SOURCE_ERROR))).otherwise(F.lit(True))
    )
    from_source = F.col("_s").isNotNull()
    out = [
        F.col(c) if c in keys else F.when(from_source, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)
        for c in columns
    ]
    if action_column:
        action = (
            F.when(matched, F.lit(ACTION_UPDATED))
            .when(from_source, F.lit(ACTION_INSERTED))
            .otherwise(F.lit(ACTION_COPIED))
        )
        out.append(action.alias(action_column))
        t_null = t_null.withColumn(action_column, F.lit(ACTION_COPIED))
        s_null = s_null.withColumn(action_column, F.lit(ACTION_INSERTED))
    return checked.select(*out).unionByName(t_null).unionByName(s_null)


def replace_frames(target: DataFrame, source: DataFrame, identity: Sequence[str], keys: Sequence[str], action_column: str) -> DataFrame:
    """``source`` and those rows of ``target`` whose identity it doesn't have.

    One full outer join on the identity. A source row that replaces a stored one is updated, or moved
    if the two differ in ``keys`` (NULLs equal each other there). Rows with a NULL in the identity have
    none: they replace nothing and are not replaced. Of several stored rows with the identity of a source
    row (a publish that broke off leaves such) all go."""
    identity, columns = list(identity), target.columns
    if sorted(source.columns) != sorted(columns):
        raise ValueError("merge: source columns differ from target")
    nameless = _any_null(identity)
    at = reduce(lambda a, b: a & b, [F.col(f"_old.{k}").eqNullSafe(F.col(f"_new.{k}")) for k in keys])
    nth = F.row_number().over(Window.partitionBy(*identity).orderBy(*identity))
    old = target.where(~nameless).select(*identity, F.struct(*columns).alias("_old"), nth.alias("_nth"))
    new = source.select(*columns).where(~nameless).select(
        *identity, F.struct(*columns).alias("_new"), F.count(F.lit(1)).over(Window.partitionBy(*identity)).alias("_source_count")
    )
    both = new.join(old, on=identity, how="full_outer").where(F.col("_new").isNull() | (F.coalesce("_nth", F.lit(1)) == 1))
    checked = both.where(F.when(F.col("_source_count") > 1, F.raise_error(F.lit(DUPLICATE_IDENTITY_ERROR))).otherwise(F.lit(True)))
    action = (
        F.when(F.col("_new").isNull(), F.lit(ACTION_COPIED))
        .when(F.col("_old").isNull(), F.lit(ACTION_INSERTED))
        .when(at, F.lit(ACTION_UPDATED))
        .otherwise(F.lit(ACTION_MOVED))
    )
    out = checked.select(F.coalesce("_new", "_old").alias("_row"), action.alias(action_column)).select("_row.*", action_column)
    alone = target.where(nameless).withColumn(action_column, F.lit(ACTION_COPIED))
    added = source.select(*columns).where(nameless).withColumn(action_column, F.lit(ACTION_INSERTED))
    return out.unionByName(alone).unionByName(added)


def append_frames(target: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of ``target`` followed by ``source`` (by column name)."""
    return target.unionByName(source.select(*target.columns))
