"""Table definitions: what to build, where to put it and how to save it."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from pathlib import Path

SAVE_MODES = ("overwrite", "overwrite_partitions", "append", "merge")
ORIGINS = ("python", "sql")


@dataclass(frozen=True)
class TableDef:
    """One output table.

    ``mode`` ``overwrite_partitions`` replaces the partitions that the result
    has and keeps the others. ``partition_by`` is a column name.
    ``cluster_by`` sorts rows inside each written file, so parquet row-group
    statistics are tight on those columns. ``ddl_path`` is a file with the
    table's CREATE statement (see ``TableStore.create``). ``buckets`` deals the rows
    by the primary key into so many buckets, sorted by it: a merge on that key then
    shuffles its source alone (choose a number that suits the grown table; it
    can't be changed later). ``identity`` are key columns that name a row for good:
    a merge then replaces the stored row of the same identity wherever it is, also
    in another partition or under another primary key. ``params`` are named
    parameters of a SQL-origin query; ``lookback_days`` adds ``:dias``. ``depends_on``
    are the tables that this one reads: in a run that has them it comes after them.
    """

    name: str
    origin: str
    primary_key: tuple[str, ...] = ()
    mode: str = "overwrite"
    catalog: str | None = None
    database: str | None = None
    python_source: str | None = None
    query_sql_path: str | None = None
    schema_ddl: str | None = None
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()
    ddl_path: str | None = None
    buckets: int | None = None
    identity: tuple[str, ...] = ()
    depends_on: tuple[str, ...] = ()
    params: dict = field(default_factory=dict)
    lookback_days: int | None = None
    description: str = ""
    fail_if_empty: bool = True
    extra: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.origin not in ORIGINS:
            raise ValueError(f"origin {self.origin!r} not supported (use one of {ORIGINS})")
        if self.mode.lower() not in SAVE_MODES:
            raise ValueError(f"mode {self.mode!r} not supported (use one of {SAVE_MODES})")
        if self.mode.lower() == "merge" and not self.primary_key:
            raise ValueError(f"table {self.name!r}: merge mode needs a primary key")
        if self.mode.lower() == "overwrite_partitions" and not self.partition_by:
            raise ValueError(f"table {self.name!r}: overwrite_partitions needs a partition column")
        if self.identity and self.mode.lower() != "merge":
            raise ValueError(f"table {self.name!r}: an identity is for merges")
        if self.buckets is not None and (self.buckets < 1 or not self.primary_key):
            raise ValueError(f"table {self.name!r}: buckets need a primary key and a number above 0")
        if self.origin == "python" and not self.python_source:
            raise ValueError(f"table {self.name!r}: python origin needs python_source")
        if self.origin == "sql" and not self.query_sql_path:
            raise ValueError(f"table {self.name!r}: sql origin needs query_sql_path")

    @property
    def full_name(self) -> str:
        return ".".join(p for p in (self.catalog, self.database, self.name) if p)

    @property
    def save_mode(self) -> str:
        return self.mode.lower()

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)


def load_table_defs(path: str | Path) -> dict[str, TableDef]:
    """Table definitions from a JSON file ``{"tables": [{...}, ...]}``."""
    raw = json.loads(Path(path).read_text(encoding="utf-8"))
    defs = {}
    for item in raw.get("tables", []):
        item = dict(item)
        item["primary_key"] = tuple(item.get("primary_key") or ())
        item["cluster_by"] = tuple(item.get("cluster_by") or ())
        item["identity"] = tuple(item.get("identity") or ())
        item["depends_on"] = tuple(item.get("depends_on") or ())
        d = TableDef(**item)
        defs[d.name] = d
    return defs


def get_table_def(defs: dict[str, TableDef], name: str) -> TableDef:
    try:
        return defs[name]
    except KeyError:
        raise ValueError(f"no table definition named {name!r}") from None
