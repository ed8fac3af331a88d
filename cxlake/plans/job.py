"""Per-table job: definition -> DataFrame -> load stamp -> save.

The source plan runs once per table: the row count comes from ``observe``
while the result is staged, not from a separate ``count()``.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cxlake.functions.text import MessagePatterns
from cxlake.operators import claims, dashboard, sessions
from cxlake.operators.messages import lookback, with_message_date
from cxlake.plans.tabledef import TableDef, get_table_def
from cxlake.session import ensure_session_defaults, use_checkpoint_dir
from cxlake.sinks.tables import SaveResult, TableStore
from cxlake.sources.normalize import normalize_result
from cxlake.sources.scans import sql_file_source

Builder = Callable[[SparkSession, TableDef], object]
Loader = Callable[[SparkSession], DataFrame]

LOAD_TS = "fecha_carga"


def with_load_ts(df: DataFrame, load_ts: dt.datetime | str | None = None) -> DataFrame:
    """Stamp the load time (``current_timestamp()`` unless a fixed one is given)."""
    value = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast(T.TimestampType())
    return df.withColumn(LOAD_TS, value)


@dataclass(frozen=True)
class Inputs:
    """Where the built-in builders read from, and their parameters."""

    usage_logs: Loader | None = None
    messages: Loader | None = None
    surveys: Loader | None = None
    excluded_users: tuple[str, ...] = ()
    # names in the first column of a table, any number of them; ``excluded_users`` are added
    excluded_user_list: Loader | None = None
    excluded_classes: tuple[str, ...] = claims.EXCLUDED_CLASSES
    log_tie_breaker: str | None = "_id"
    survey_tie_breaker: str | None = None
    as_of: str | None = None
    patterns: MessagePatterns = MessagePatterns()
    # Build the claim detail once per job run and checkpoint it (shared
    # checkpoint dir), so the detail table and its rollups read the logs once.
    share_detail: bool = True


def builtin_builders(inputs: Inputs) -> dict[str, Builder]:
    """The package's table builders, bound to ``inputs``.

    Create one set per job run: with ``share_detail`` the claim detail is
    computed and checkpointed on first use and reused by the rollups of the
    same run.
    """

    def need(loader: Loader | None, what: str) -> Loader:
        if loader is None:
            raise ValueError(f"no {what} input configured")
        return loader

    shared: dict[str, DataFrame] = {}
    # jobs that run at the same time wait for the one that builds the detail
    building = threading.Lock()

    def detail(spark: SparkSession, tdef: TableDef) -> DataFrame:
        with building:
            return shared["detail"] if "detail" in shared else built_detail(spark)

    def built_detail(spark: SparkSession) -> DataFrame:
        logs = need(inputs.usage_logs, "usage-log")(spark)
        excluded: tuple[str, ...] | DataFrame = inputs.excluded_users
        if inputs.excluded_user_list is not None:
            listed = inputs.excluded_user_list(spark)
            listed = listed.select(F.col(listed.columns[0]).cast(T.StringType()).alias("name"))
            excluded = listed.union(spark.createDataFrame([(u,) for u in inputs.excluded_users], "name STRING"))
        df = claims.claim_detail(
            logs,
            excluded_users=excluded,
            excluded_classes=inputs.excluded_classes,
            tie_breaker=inputs.log_tie_breaker,
        )
        if inputs.share_detail:
            use_checkpoint_dir(spark)
            df = df.checkpoint(eager=True)
            shared["detail"] = df
        return df

    def base(spark: SparkSession, tdef: TableDef) -> DataFrame:
        # per-table option: {"include_history": False} gives the metrics-only
        # dashboard (no per-session-day array)
        return dashboard.dashboard_base(
            need(inputs.messages, "message")(spark),
            need(inputs.surveys, "survey")(spark),
            inputs.as_of,
            tdef.lookback_days if tdef.lookback_days is not None else 3,
            patterns=inputs.patterns,
            include_history=tdef.extra.get("include_history", True),
            survey_tie_breaker=inputs.survey_tie_breaker,
        )

    def chunks(spark: SparkSession, tdef: TableDef) -> DataFrame:
        messages = need(inputs.messages, "message")(spark)
        recent = lookback(messages, "message_timestamp", inputs.as_of, tdef.lookback_days if tdef.lookback_days is not None else 3)
        return sessions.history_chunks(with_message_date(recent), tdef.extra.get("chunk_messages", sessions.CHUNK_MESSAGES))

    return {
        "claim_detail": detail,
        "claim_summary": lambda spark, tdef: claims.claim_summary(detail(spark, tdef)),
        "claim_evolution": lambda spark, tdef: claims.claim_evolution(detail(spark, tdef)),
        "claim_top": lambda spark, tdef: claims.claim_top(detail(spark, tdef)),
        "dashboard_base": base,
        "session_history": chunks,
    }


def build(
    spark: SparkSession,
    tdef: TableDef,
    builders: dict[str, Builder],
    sql_params: dict | None = None,
    load_ts: dt.datetime | str | None = None,
) -> DataFrame:
    """The table's DataFrame (lazy), with the load stamp."""
    ensure_session_defaults(spark)
    if tdef.origin == "python":
        try:
            builder = builders[tdef.python_source]
        except KeyError:
            raise ValueError(f"no builder named {tdef.python_source!r}") from None
        df = normalize_result(spark, builder(spark, tdef))
    else:
        params = {**tdef.params, **(sql_params or {})}
        if tdef.lookback_days is not None:
            params.setdefault("dias", tdef.lookback_days)
        df = sql_file_source(spark, tdef.query_sql_path, **params)
    return with_load_ts(df, load_ts)


def run_table_job(
    spark: SparkSession,
    tdef: TableDef,
    builders: dict[str, Builder],
    store: TableStore,
    sql_params: dict | None = None,
    load_ts: dt.datetime | str | None = None,
) -> SaveResult:
    """Build one table and save it by its mode (overwrite / append / merge)."""
    return store.save(build(spark, tdef, builders, sql_params, load_ts), tdef)


def run_tables(
    spark: SparkSession,
    names: Iterable[str],
    defs: dict[str, TableDef],
    builders: dict[str, Builder],
    store: TableStore,
    sql_params: dict | None = None,
    load_ts: dt.datetime | str | None = None,
) -> list[SaveResult]:
    """Run the jobs of several tables, in order."""
    return [
        run_table_job(spark, get_table_def(defs, n), builders, store, sql_params, load_ts) for n in names
    ]


@dataclass(frozen=True)
class TableRun:
    """What became of one table of a run: saved, failed (with the error) or skipped (``error`` names the table it waited for)."""

    name: str
    status: str
    result: SaveResult | None = None
    error: str | None = None


def run_table_graph(
    spark: SparkSession,
    names: Iterable[str],
    defs: dict[str, TableDef],
    builders: dict[str, Builder],
    store: TableStore,
    sql_params: dict | None = None,
    load_ts: dt.datetime | str | None = None,
    parallel: int = 4,
) -> list[TableRun]:
    """Run the jobs of several tables, each after the tables of this run that it depends on.

    Up to ``parallel`` tables without an open dependency run at the same time, as Spark
    jobs of their own; what the builders share is built once. A table that fails stops
    only those that depend on it. A circle of dependencies is an error before anything
    runs. Outcomes come in the order of ``names``."""
    names = list(dict.fromkeys(names))
    needs = {n: [d for d in get_table_def(defs, n).depends_on if d in names] for n in names}
    graph = TopologicalSorter(needs)
    graph.prepare()
    done: dict[str, TableRun] = {}
    running: dict[Future, str] = {}

    def job(name: str) -> SaveResult:
        return run_table_job(spark, get_table_def(defs, name), builders, store, sql_params, load_ts)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        while graph.is_active():
            for name in graph.get_ready():
                missing = next((d for d in needs[name] if done[d].status != "saved"), None)
                if missing is not None:
                    done[name] = TableRun(name, "skipped", error=missing)
                    graph.done(name)
                else:
                    running[pool.submit(inheritable_thread_target(spark)(job), name)] = name
            if not running:
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name, failure = running.pop(future), future.exception()
                if failure is None:
                    done[name] = TableRun(name, "saved", result=future.result())
                else:
                    done[name] = TableRun(name, "failed", error=f"{type(failure).__name__}: {failure}")
                graph.done(name)
    return [done[n] for n in names]
