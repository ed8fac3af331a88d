"""Catalog tables: create, overwrite, append, merge, compact.

Spark owns the tables, their files and their partitions (managed parquet
tables, or the provider that ``provider`` names). A save has two steps:

1. the result is *staged*: written once, as Parquet, to the shared folder. This
   is the only action that runs the source plan; it counts the rows, checks an
   empty result, and cuts the lineage, so a table may be rewritten from itself;
2. the staged rows are *published* with ``insertInto``: all of the table
   (overwrite), some of its partitions (dynamic partition overwrite), or added
   to it (append).

A failed step 1 leaves the table as it was. Step 2 is Spark's own overwrite of a
file table: it copies staged files and is not atomic for readers of the same
partitions; a job that fails there is repaired by running it again. A table
that another job has published to between the two steps is not overwritten
(``ConcurrentSaveError``): every publish raises the table property
``cxlake.version``, which is read before staging and again before publishing.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.operators.merge import ACTION_COPIED, ACTION_INSERTED, ACTION_MOVED, ACTION_UPDATED, merge_frames, replace_frames
from cxlake.plans.tabledef import TableDef
from cxlake.session import remove_path, staging_path
from cxlake.sources.scans import read_sql_text

_ACTION = "_merge_action"
VERSION = "cxlake.version"
PLACES_OF = "cxlake.places_of"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# off: a join on (month, class, OT) may keep a table's buckets by (class, OT)
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


# Settings belong to the session, which jobs in several threads share: a write that needs some has them for itself.
_SETTINGS = threading.RLock()


class EmptyResultError(ValueError):
    """The DataFrame to save had no rows and the table forbids that."""


class ConcurrentSaveError(RuntimeError):
    """Another job published to the table after this one read it."""


@dataclass(frozen=True)
class SaveResult:
    table: str
    mode: str
    rows_written: int
    source_rows: int
    inserted: int | None = None
    updated: int | None = None
    copied: int | None = None
    moved: int | None = None


def _quote(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def bucket_columns(tdef: TableDef) -> list[str]:
    """The key columns that deal rows into buckets: a partition column is a folder, and no bucket column."""
    return [k for k in tdef.primary_key if k != tdef.partition_by]


def _inside(part: str, values: list) -> Column:
    """True for rows of these partitions, the one of NULLs included if it is named."""
    column = F.col(part)
    known = F.coalesce(column.isin([v for v in values if v is not None]), F.lit(False))
    return known | (column.isNull() if None in values else F.lit(False))


def _named(tdef: TableDef) -> Column:
    """True for rows with an identity (no NULL in it)."""
    return F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in tdef.identity))


def _places(tdef: TableDef) -> TableDef:
    """The table beside ``tdef`` that maps identities to partitions."""
    return TableDef(
        f"{tdef.name}_places", "python", primary_key=tdef.identity, mode="merge", catalog=tdef.catalog, database=tdef.database, python_source="places",
        buckets=tdef.buckets, fail_if_empty=False,
    )


class TableStore:
    """Saves DataFrames into catalog tables according to a ``TableDef``."""

    def __init__(self, spark: SparkSession, provider: str = "parquet"):
        self.spark = spark
        self.provider = provider

    # -- catalog --------------------------------------------------------------

    def exists(self, tdef: TableDef) -> bool:
        return self.spark.catalog.tableExists(tdef.full_name)

    def create(self, tdef: TableDef, schema: T.StructType | str | None = None) -> None:
        """Create the table (empty) if it does not exist yet.

        From the definition's DDL file if it has one, else from ``schema`` or
        the definition's schema text. A DDL file is SQL with the markers
        ``{full_name}``, ``{primary_key}`` and ``{partition_by}``."""
        if self.exists(tdef):
            return
        if tdef.ddl_path:
            text = read_sql_text(tdef.ddl_path)
            marks = {
                "full_name": _quote(tdef.full_name),
                "primary_key": ", ".join(f"`{k}`" for k in tdef.primary_key),
                "partition_by": f"PARTITIONED BY (`{tdef.partition_by}`)" if tdef.partition_by else "",
            }
            for mark, value in marks.items():
                text = text.replace("{" + mark + "}", value)
            self.spark.sql(text)
            return
        schema = schema or tdef.schema_ddl
        if schema is None:
            raise ValueError(f"table {tdef.name!r}: no schema to create it from")
        fields = self.spark.createDataFrame([], schema).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        partitioned = f" PARTITIONED BY (`{tdef.partition_by}`)" if tdef.partition_by else ""
        keys = ", ".join(f"`{k}`" for k in bucket_columns(tdef))
        bucketed = f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {tdef.buckets} BUCKETS" if tdef.buckets else ""
        self.spark.sql(f"CREATE TABLE {_quote(tdef.full_name)} ({columns}) USING {self.provider}{partitioned}{bucketed}")

    def drop(self, tdef: TableDef) -> None:
        """Drop the table with its files (and the map of its rows' places, if it has one)."""
        self.spark.sql(f"DROP TABLE IF EXISTS {_quote(tdef.full_name)}")
        if tdef.identity:
            self.spark.sql(f"DROP TABLE IF EXISTS {_quote(_places(tdef).full_name)}")

    def _version(self, tdef: TableDef, name: str = VERSION) -> int:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {_quote(tdef.full_name)}").where(F.col("key") == name).collect()
        return int(rows[0]["value"]) if rows else 0

    @contextmanager
    def _settings(self, values: dict[str, str]) -> Iterator[None]:
        """Session settings for one write, put back right after; one write at a time."""
        if not values:
            yield
            return
        with _SETTINGS:
            before = {k: self.spark.conf.get(k) for k in values}
            try:
                for k, v in values.items():
                    self.spark.conf.set(k, v)
                yield
            finally:
                for k, v in before.items():
                    self.spark.conf.set(k, v)

    # -- staging and publishing ---------------------------------------------------

    def _stage(self, df: DataFrame, tdef: TableDef, metrics: dict, counted: str) -> tuple[str, dict]:
        """Write ``df`` once to the shared folder; its metrics come from the same action."""
        path = staging_path(self.spark, "stage")
        seen = Observation(f"stage_{uuid.uuid4().hex[:8]}")
        observed = df.observe(seen, *[c.alias(n) for n, c in metrics.items()])
        observed.drop(_ACTION).write.parquet(path)
        found = seen.get
        if tdef.fail_if_empty and not found.get(counted):
            remove_path(self.spark, path)
            raise EmptyResultError(f"table {tdef.full_name}: the result has no rows; table left unchanged")
        return path, found

    def _publish(self, path: str, tdef: TableDef, version: int, how: str) -> None:
        """Move staged rows into the table; ``how``: all, partitions or append."""
        name = _quote(tdef.full_name)
        if self._version(tdef) != version:
            remove_path(self.spark, path)
            raise ConcurrentSaveError(f"table {tdef.full_name} has changed since it was read")
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{VERSION}' = '{version + 1}')")
        # positional insert: in the order of the table, which has the partition column last
        rows = self.spark.read.parquet(path).select(*self.spark.table(tdef.full_name).columns)
        if tdef.buckets:
            # a task holds one bucket, of all partitions, and makes one file of each
            rows = rows.repartition(tdef.buckets, *bucket_columns(tdef))
        elif tdef.partition_by:
            # rows of a partition meet in few tasks and make few files; AQE
            # splits a partition that holds much of the table
            rows = rows.hint("rebalance", tdef.partition_by)
        if tdef.cluster_by and not tdef.buckets:
            # sorted inside each file: tight row-group statistics
            rows = rows.sortWithinPartitions(*tdef.cluster_by)
        # insertInto heeds the session's mode only
        with self._settings({OVERWRITE_MODE: "dynamic" if how == "partitions" else "static"}):
            rows.write.insertInto(tdef.full_name, overwrite=how != "append")
        self.spark.catalog.refreshTable(tdef.full_name)
        remove_path(self.spark, path)

    # -- save -----------------------------------------------------------------

    def save(self, df: DataFrame, tdef: TableDef) -> SaveResult:
        mode = tdef.save_mode
        if mode == "merge":
            return self.merge(df, tdef)
        how = {"overwrite": "all", "overwrite_partitions": "partitions", "append": "append"}[mode]
        self.create(tdef, tdef.schema_ddl or df.schema)
        version = self._version(tdef)
        path, m = self._stage(df, tdef, {"rows": F.count(F.lit(1))}, "rows")
        self._publish(path, tdef, version, how)
        return SaveResult(tdef.full_name, mode, m["rows"], m["rows"])

    def overwrite(self, df: DataFrame, tdef: TableDef) -> SaveResult:
        return self.save(df, replace(tdef, mode="overwrite"))

    def append(self, df: DataFrame, tdef: TableDef) -> SaveResult:
        return self.save(df, replace(tdef, mode="append"))

    def merge(self, df: DataFrame, tdef: TableDef) -> SaveResult:
        """Upsert on the primary key.

        When the partition column is part of the key, rows can only match
        inside a partition that the source has: only those are read, merged and
        replaced. The source is written to the shared folder first, since its
        partition values (a list bounded by the table's partitions) prune the
        target's scan. A table with buckets is joined where its rows lie: only the
        source is shuffled."""
        if not tdef.primary_key:
            raise ValueError(f"table {tdef.full_name}: merge needs a primary key")
        if tdef.identity:
            return self._merge_moved(df, tdef)
        self.create(tdef, tdef.schema_ddl or df.schema)
        version = self._version(tdef)
        target, part, source_path = self.spark.table(tdef.full_name), tdef.partition_by, None
        some = bool(part) and part in tdef.primary_key
        if some:
            source_path = staging_path(self.spark, "merge-source")
            df.write.parquet(source_path)
            df = self.spark.read.parquet(source_path)
            # the partition of NULLs is replaced as well if the source adds to it
            target = target.where(_inside(part, [r[0] for r in df.select(part).distinct().collect()]))
        merged = merge_frames(target, df, tdef.primary_key, action_column=_ACTION)
        action = F.col(_ACTION)
        metrics = {
            "rows": F.count(F.lit(1)),
            "inserted": F.count_if(action == ACTION_INSERTED),
            "updated": F.count_if(action == ACTION_UPDATED),
            "copied": F.count_if(action == ACTION_COPIED),
            "source_rows": F.count_if(action != ACTION_COPIED),
        }
        with self._settings({CO_PARTITION: "false"} if tdef.buckets else {}):
            path, m = self._stage(merged, tdef, metrics, "source_rows")
        self._publish(path, tdef, version, "partitions" if some else "all")
        if source_path:
            remove_path(self.spark, source_path)
        return SaveResult(
            tdef.full_name, "merge", m["rows"], m["source_rows"], inserted=m["inserted"], updated=m["updated"], copied=m["copied"]
        )

    def _merge_moved(self, df: DataFrame, tdef: TableDef) -> SaveResult:
        """Upsert on the identity: the stored row goes, wherever it is, and the source's row comes.

        A map beside the table names the partition of every identity. So only the partitions that
        the source has, and those where its rows sat before, are read and replaced; a partition
        that has lost all its rows is dropped. The map carries the table's version; one that is
        behind (a save broke off, or another mode wrote) is made anew from the table."""
        self.create(tdef, tdef.schema_ddl or df.schema)
        version, part, places = self._version(tdef), tdef.partition_by, _places(tdef)
        target, source_path, touched = self.spark.table(tdef.full_name), staging_path(self.spark, "merge-source"), []
        df.write.parquet(source_path)
        df = self.spark.read.parquet(source_path)
        if part:
            if not self.exists(places) or self._version(places, PLACES_OF) != version:
                self.save(target.where(_named(tdef)).select(*tdef.identity, part), replace(places, mode="overwrite"))
            sat = self.spark.table(places.full_name).join(df.select(*tdef.identity), list(tdef.identity), "left_semi")
            touched = [r[0] for r in df.select(part).union(sat.select(part)).distinct().collect()]
            target = target.where(_inside(part, touched))
        merged = replace_frames(target, df, tdef.identity, tdef.primary_key, _ACTION)
        counts = {a: F.count_if(F.col(_ACTION) == a) for a in (ACTION_INSERTED, ACTION_UPDATED, ACTION_MOVED, ACTION_COPIED)}
        metrics = {"rows": F.count(F.lit(1)), "source_rows": F.count_if(F.col(_ACTION) != ACTION_COPIED), **counts}
        path, m = self._stage(merged, tdef, metrics, "source_rows")
        left = {r[0] for r in self.spark.read.parquet(path).select(part).distinct().collect()} if part else set()
        stored = {r[0] for r in self.spark.table(tdef.full_name).where(_inside(part, touched)).select(part).distinct().collect()} if part else set()
        if self._version(tdef) != version:
            remove_path(self.spark, path)
            raise ConcurrentSaveError(f"table {tdef.full_name} has changed since it was read")
        # before the rows come: if this breaks off, the same save run again brings them
        for value in stored - left:
            literal = "NULL" if value is None else self._literal(value)
            self.spark.sql(f"ALTER TABLE {_quote(tdef.full_name)} DROP IF EXISTS PARTITION (`{part}` = {literal})")
        self._publish(path, tdef, version, "partitions" if part else "all")
        if part:
            self.save(df.where(_named(tdef)).select(*tdef.identity, part), places)
            self.spark.sql(f"ALTER TABLE {_quote(places.full_name)} SET TBLPROPERTIES ('{PLACES_OF}' = '{version + 1}')")
        remove_path(self.spark, source_path)
        return SaveResult(
            tdef.full_name, "merge", m["rows"], m["source_rows"], inserted=m["inserted"], updated=m["updated"], copied=m["copied"], moved=m["moved"]
        )

    @staticmethod
    def _literal(value: object) -> str:
        if isinstance(value, (bool, int)):
            return str(value).lower()
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    def files(self, tdef: TableDef) -> DataFrame:
        """(part, file, bytes) of the table's files that hold rows; ``part`` is the partition's value as text."""
        part = F.col(tdef.partition_by).cast("string") if tdef.partition_by else F.lit(None).cast("string")
        found = self.spark.table(tdef.full_name).select(part.alias("part"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        return found.distinct()

    def compact(self, tdef: TableDef, num_files: int | None = None, small_bytes: int | None = None) -> SaveResult:
        """Rewrite the table into fewer, larger files (content unchanged).

        By default the files are sized by the scan, which packs small files into
        splits of ``spark.sql.files.maxPartitionBytes``. With ``small_bytes``, only
        partitions that have two files or more below that size are read and
        rewritten; all others keep their files (a table without partitions is
        one). A result without rows means that nothing was rewritten."""
        rows = self.spark.table(tdef.full_name)
        version, how = self._version(tdef), "all"
        if small_bytes is not None:
            sizes = self.files(tdef).where(F.col("bytes") < small_bytes).groupBy("part").count().where("count > 1")
            chosen = [r["part"] for r in sizes.select("part").collect()]  # bounded by the table's partitions
            if not chosen:
                return SaveResult(tdef.full_name, "compact", 0, 0)
            if tdef.partition_by:
                how = "partitions"
                named = F.col(tdef.partition_by).cast("string")
                rows = rows.where(F.coalesce(named.isin([c for c in chosen if c is not None]), F.lit(False)) | (named.isNull() if None in chosen else F.lit(False)))
        if num_files:
            rows = rows.repartition(num_files)
        path, m = self._stage(rows, replace(tdef, fail_if_empty=False), {"rows": F.count(F.lit(1))}, "rows")
        self._publish(path, tdef, version, how)
        return SaveResult(tdef.full_name, "compact", m["rows"], m["rows"])
