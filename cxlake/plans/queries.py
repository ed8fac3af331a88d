"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver's tables (through the derivations in
``cxlake.sources.fixtures``) over their whole extent; parameters that the
product takes (exclusion lists, lookback end and length) are fixed here to
the fixture values. The sink and table queries write their result when called
(files under ``spark.checkpoint.dir``, tables in the catalog), read it back into
a checkpoint, and remove what they wrote.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cxlake.functions import documents
from cxlake.operators import claims, dashboard, messages, sessions, surveys
from cxlake.plans.catalog import default_table_defs
from cxlake.plans.fifo_ledger import FifoLedger
from cxlake.plans.job import Inputs, build, builtin_builders, run_table_graph, run_table_job, with_load_ts
from cxlake.plans.ledger import ClaimLedger, SessionLedger
from cxlake.plans.tabledef import TableDef
from cxlake.session import ensure_session_defaults, remove_path, staging_path, use_checkpoint_dir
from cxlake.sinks import files
from cxlake.sinks.tables import TableStore
from cxlake.sources import fixtures as fx
from cxlake.sources import scans
from cxlake.sources.normalize import normalize_result

Query = Callable[[SparkSession, str], DataFrame]


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session_defaults(spark)
    return fx.usage_logs(spark, sf_dir)


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.claim_detail(_logs(spark, sf_dir), excluded_users=fx.FIXTURE_EXCLUDED_USERS)


def q_claim_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detail(spark, sf_dir)


def q_claim_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.claim_summary(_detail(spark, sf_dir))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.claim_candidates(_logs(spark, sf_dir), excluded_users=fx.FIXTURE_EXCLUDED_USERS)


def q_usage_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logs(spark, sf_dir)


def q_claim_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _logs(spark, sf_dir)
    return logs.select("log_id", claims.event_date(logs).alias("event_ts"))


def q_claim_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _logs(spark, sf_dir)
    dated = logs.withColumn("event_ts", claims.event_date(logs))
    return dated.where(F.col("event_ts").isNotNull() & claims.valid_ot(logs)).select("log_id", "ot", "event_ts")


def q_claim_user_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _logs(spark, sf_dir)
    kept = logs.where(claims.not_excluded_user(logs, fx.FIXTURE_EXCLUDED_USERS))
    return kept.select("log_id", *claims.USER_FIELDS)


def q_claim_user_exclusion_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs without the users of a list that is a table."""
    logs = _logs(spark, sf_dir).select("log_id", *claims.USER_FIELDS)
    return claims.without_users(logs, fx.excluded_users(spark, sf_dir))


def q_claim_detail_exclusion_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claim detail, users excluded by a list that is a table."""
    return claims.claim_detail(_logs(spark, sf_dir), excluded_users=fx.excluded_users(spark, sf_dir))


def q_claim_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("event_ts")
    return _candidates(spark, sf_dir).select(
        "log_id",
        F.year(ts).alias("year_num"),
        F.month(ts).alias("month_num"),
        F.date_format(ts, "yyyy-MM").alias("Mes"),
    )


def q_claim_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select("log_id", "clasificacion")


def q_claim_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _logs(spark, sf_dir)
    return logs.select("log_id", claims.declared_value(logs).alias("valor"))


def q_claim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _logs(spark, sf_dir)
    return logs.select("log_id", claims.user_or_default(logs).alias("usuario"))


def q_claim_first_per_ot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.first_per_ot(_candidates(spark, sf_dir)).select("ot", "log_id", "event_ts")


def q_claim_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.sorted_detail(_detail(spark, sf_dir))


def q_claim_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.claim_evolution(_detail(spark, sf_dir))


def q_claim_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.claim_top(_detail(spark, sf_dir))


# --- documents whose fields change their type -----------------------------------


def _from_documents(spark: SparkSession, sf_dir: str, job: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``job`` over a JSON export: the documents are written as lines of text and read by the usage-log reader."""
    ensure_session_defaults(spark)
    path = staging_path(spark, "documents")
    fx.usage_log_documents(spark, sf_dir).write.text(path)
    return _read_and_remove(spark, path, lambda p: job(scans.read_usage_logs(spark, p, fmt="json")))


def q_usage_log_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind and text of every field of the documents (dates have no text of their own; amounts come as numbers)."""

    def told(docs: DataFrame) -> DataFrame:
        fields = [f for f in scans.USAGE_LOG_FIELDS if f != "_id"]
        out = [documents.text(F.col("_id")).alias("log_id")]
        for f in fields:
            kind = documents.kind(F.col(f))
            apart = (documents.DATE, documents.OTHER, *([documents.NUMBER] if f == "valor_declarado" else []))
            out += [kind.alias(f"{f}_kind"), F.when(~kind.isin(*apart), documents.text(F.col(f))).alias(f)]
        amount = F.col("valor_declarado")
        out.append(F.when(documents.kind(amount) == documents.NUMBER, documents.plain_number(amount)).alias("valor_numero"))
        return docs.select(*out)

    return _from_documents(spark, sf_dir, told)


def q_claim_event_date_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_documents(spark, sf_dir, lambda docs: docs.select(documents.text(F.col("_id")).alias("log_id"), claims.event_date(docs).alias("event_ts")))


def q_claim_value_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_documents(spark, sf_dir, lambda docs: docs.select(documents.text(F.col("_id")).alias("log_id"), claims.declared_value(docs).alias("valor")))


def q_claim_detail_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole claim detail from the JSON export."""
    return _from_documents(
        spark, sf_dir, lambda docs: claims.claim_detail(docs, excluded_users=fx.FIXTURE_EXCLUDED_USERS, tie_breaker="_id")
    )


# --- table operations, as the DataFrames that would be written ---------------

# The previous load saw only documents dated before the cutoff, and did not
# exclude users yet; the current load sees everything with the exclusions.
PREVIOUS_CUTOFF = "1998-01-01"
PREVIOUS_LOAD_TS = "2024-01-01 00:00:00"
CURRENT_LOAD_TS = "2024-02-01 00:00:00"


def previous_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    cand = claims.claim_candidates(_logs(spark, sf_dir), excluded_users=())
    cand = cand.where(F.col("event_ts") < F.lit(PREVIOUS_CUTOFF).cast("timestamp"))
    return claims.to_detail(claims.first_per_ot(cand))


def _loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    prev = with_load_ts(previous_detail(spark, sf_dir), PREVIOUS_LOAD_TS)
    cur = with_load_ts(_detail(spark, sf_dir), CURRENT_LOAD_TS)
    return prev, cur


def q_with_load_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loads(spark, sf_dir)[1]


def _own_def(what: str, **changes) -> TableDef:
    """A built-in definition (or the detail's) under a name of its own."""
    return replace(default_table_defs()[what], name=f"cx_{what}_{uuid.uuid4().hex[:12]}", **changes)


def _read_and_drop(spark: SparkSession, store: TableStore, *tdefs: TableDef, df: DataFrame | None = None) -> DataFrame:
    """What a query returns of the tables it made (the first one unless ``df`` is given); then they go."""
    use_checkpoint_dir(spark)
    out = (df if df is not None else spark.table(tdefs[0].full_name)).checkpoint()
    for t in tdefs:
        store.drop(t)
    return out


def q_table_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product's own upsert: the current load merged into the stored detail table (partitioned by month)."""
    store, tdef = TableStore(spark), _own_def("claim_detail")
    prev, cur = _loads(spark, sf_dir)
    store.save(prev, tdef)
    store.save(cur, tdef)
    return _read_and_drop(spark, store, tdef)


def q_table_merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same upsert into a table with buckets on its key: the stored side isn't shuffled."""
    store, tdef = TableStore(spark), _own_def("claim_detail", partition_by=None, buckets=8)
    prev, cur = _loads(spark, sf_dir)
    store.save(prev, tdef)
    store.save(cur, tdef)
    return _read_and_drop(spark, store, tdef)


def q_table_merge_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge by OT: an OT whose month or class has changed leaves its old place (one row per OT)."""
    store, tdef = TableStore(spark), _own_def("claim_detail", identity=("OT",))
    prev, cur = _loads(spark, sf_dir)
    store.save(prev, tdef)
    store.save(cur, tdef)
    return _read_and_drop(spark, store, tdef)


def q_table_compact_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads; only the months that hold several small files are rewritten."""
    store, tdef = TableStore(spark), _own_def("claim_detail", mode="append")
    for load in _loads(spark, sf_dir):
        store.save(load, tdef)
    store.compact(tdef, small_bytes=64 << 20)
    return _read_and_drop(spark, store, tdef)


def q_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, tdef = TableStore(spark), _own_def("claim_detail", mode="append")
    prev, cur = _loads(spark, sf_dir)
    store.save(prev, tdef)
    store.save(cur, tdef)
    return _read_and_drop(spark, store, tdef)


def q_table_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads, rewritten by the store's compaction (same rows, files of the scan's split size)."""
    store, tdef = TableStore(spark), _own_def("claim_detail", mode="append", partition_by=None)
    for load in _loads(spark, sf_dir):
        store.save(load, tdef)
    store.compact(tdef)
    return _read_and_drop(spark, store, tdef)


def q_table_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created from a DDL file, then appended to."""
    store = TableStore(spark)
    tdef = _own_def("claim_detail", mode="append", ddl_path="claim_detail.ddl.sql", schema_ddl=None)
    store.create(tdef)
    store.save(_loads(spark, sf_dir)[1], tdef)
    return _read_and_drop(spark, store, tdef)


def q_table_overwrite_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables partitioned by a boolean and by a date, both with NULLs, saved twice: no row is lost."""
    store, detail = TableStore(spark), _detail(spark, sf_dir)
    value, day = F.col("Valor_Declarado_CLP"), F.to_date("Fecha_Creacion")
    frames = {
        "alto": detail.select("OT", F.when(value > 0, value > 150000).alias("parte")),
        "dia": detail.select("OT", F.when(F.dayofmonth(day) > 15, F.trunc(day, "month")).alias("parte")),
    }
    tdefs, parts = [], []
    for name, frame in frames.items():
        tdef = TableDef(f"cx_{name}_{uuid.uuid4().hex[:12]}", "python", python_source=name, partition_by="parte")
        for _ in range(2):
            store.save(frame, tdef)
        tdefs.append(tdef)
        parts.append(spark.table(tdef.full_name).select(F.lit(name).alias("tabla"), "OT", F.col("parte").cast("string").alias("parte")))
    return _read_and_drop(spark, store, *tdefs, df=parts[0].unionByName(parts[1]))


# --- stored states, merged with every load ------------------------------------------

LOADS = 3


def _claim_ledger(spark: SparkSession, sf_dir: str, read: Callable[[ClaimLedger], DataFrame]) -> DataFrame:
    """Three loads of usage logs, in no order of time, the second one repeated; then ``read``."""
    logs = _logs(spark, sf_dir)
    ledger = ClaimLedger(TableStore(spark), f"cx_ledger_{uuid.uuid4().hex[:12]}", buckets=8, tie_breaker="log_id", excluded_users=fx.FIXTURE_EXCLUDED_USERS)
    for i in (0, 1, 1, 2):
        ledger.load(logs.where(F.pmod(F.hash("log_id"), F.lit(LOADS)) == i), f"load {i}")
    use_checkpoint_dir(spark)
    out = read(ledger).checkpoint()
    ledger.drop()
    return out


def q_claim_detail_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claim_ledger(spark, sf_dir, ClaimLedger.detail)


def q_claim_summary_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claim_ledger(spark, sf_dir, ClaimLedger.summary)


def q_claim_top_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _claim_ledger(spark, sf_dir, ClaimLedger.top)


def q_session_days_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of messages; turns of one session-day and copies of one message come in different loads."""
    ensure_session_defaults(spark)
    sent = messages.with_message_date(fx.messages(spark, sf_dir, copy_col="copy"))
    part = F.pmod(F.minute("message_timestamp") + F.col("copy"), F.lit(LOADS))
    ledger = SessionLedger(TableStore(spark), f"cx_ledger_{uuid.uuid4().hex[:12]}", buckets=8)
    for i in (0, 1, 1, 2):
        ledger.load(sent.where(part == i).drop("copy"), f"load {i}")
    use_checkpoint_dir(spark)
    out = ledger.session_days().checkpoint()
    ledger.drop()
    return out


def _job_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        usage_logs=lambda s: _logs(s, sf_dir),
        messages=lambda s: fx.messages(s, sf_dir),
        surveys=lambda s: fx.surveys(s, sf_dir),
        excluded_users=fx.FIXTURE_EXCLUDED_USERS,
        log_tie_breaker="log_id",
        survey_tie_breaker="event_id",
        as_of=AS_OF,
    )


def q_table_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table job: definition -> builder -> load stamp -> save."""
    store, tdef = TableStore(spark), _own_def("claim_summary")
    run_table_job(spark, tdef, builtin_builders(_job_inputs(spark, sf_dir)), store, load_ts=CURRENT_LOAD_TS)
    return _read_and_drop(spark, store, tdef)


# An exact measure of each table of the run.
GRAPH_MEASURES = {
    "claim_detail": "count(DISTINCT OT)",
    "claim_summary": "sum(Cantidad)",
    "claim_evolution": "sum(Cantidad)",
    "claim_top": "sum(Cantidad)",
    "dashboard_base": "sum(cantidad_mensajes)",
    "dashboard_recent": "count(DISTINCT session_id)",
}


def q_table_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tables in one run, several at a time, each after those it reads; rows and a measure of every stored table."""
    ensure_session_defaults(spark)
    store, defs = TableStore(spark), {n: _own_def(n) for n in GRAPH_MEASURES}
    defs["dashboard_base"] = replace(defs["dashboard_base"], lookback_days=DAYS)
    recent = {"source_table": defs["dashboard_base"].full_name, "as_of": AS_OF, "dias": RECENT_DAYS}
    defs["dashboard_recent"] = replace(defs["dashboard_recent"], params=recent)
    runs = run_table_graph(spark, reversed(defs), defs, builtin_builders(_job_inputs(spark, sf_dir)), store, load_ts=CURRENT_LOAD_TS)
    failed = [r for r in runs if r.status != "saved"]
    if failed:
        raise RuntimeError(f"tables not saved: {failed}")
    told = None
    for n, d in defs.items():
        one = spark.table(d.full_name).agg(F.count(F.lit(1)).alias("filas"), F.expr(GRAPH_MEASURES[n]).cast("long").alias("medida"))
        one = one.select(F.lit(n).alias("tabla"), "filas", "medida")
        told = one if told is None else told.unionByName(one)
    return _read_and_drop(spark, store, *defs.values(), df=told)


def q_python_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered builder that a definition names, with the load stamp (not saved)."""
    builders = builtin_builders(_job_inputs(spark, sf_dir))
    return build(spark, default_table_defs()["claim_top"], builders, load_ts=CURRENT_LOAD_TS)


def q_normalize_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A builder that returns pandas (the small class ranking), normalised to a Spark DataFrame."""
    return normalize_result(spark, claims.claim_top(_detail(spark, sf_dir)).toPandas())


# --- sources and sinks -----------------------------------------------------------

DETAIL_VIEW = "cx_claim_detail"
SQL_LIMIT_QUERY = f"%sql SELECT * FROM {DETAIL_VIEW} ORDER BY OT"
SQL_LIMIT_ROWS = 20
DISPLAY_NAMES = ("Mes", "Clasificación", "Cantidad", "Suma Total (CLP)", "Promedio (CLP)")


def q_parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.parquet_scan(spark, f"{sf_dir.rstrip('/')}/orders.parquet")


def q_sql_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _detail(spark, sf_dir).createOrReplaceTempView(DETAIL_VIEW)
    return scans.run_sql(spark, SQL_LIMIT_QUERY, limit=SQL_LIMIT_ROWS)


def q_sql_file_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    _detail(spark, sf_dir).createOrReplaceTempView(DETAIL_VIEW)
    return scans.sql_file_source(spark, "claim_summary.sql", source_table=DETAIL_VIEW)


def q_table_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any ten rows: how many there are, and how many of them the table has."""
    _detail(spark, sf_dir).createOrReplaceTempView(DETAIL_VIEW)
    sample = scans.table_sample(spark, DETAIL_VIEW)
    found = sample.intersect(spark.table(DETAIL_VIEW))
    both = sample.select(F.lit(1).alias("drawn"), F.lit(0).alias("there")).unionAll(found.select(F.lit(0), F.lit(1)))
    return both.agg(F.sum("drawn").alias("n_rows"), F.sum("there").alias("n_in_table"))


def q_clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    display = claims.claim_summary(_detail(spark, sf_dir)).toDF(*DISPLAY_NAMES)
    return files.clean_columns(display)


def q_json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.json_rows(_detail(spark, sf_dir))


# Sinks are checked by writing the whole result to a fresh folder under the
# session's shared checkpoint dir and reading it back.


def _read_and_remove(spark: SparkSession, path: str, reader) -> DataFrame:
    use_checkpoint_dir(spark)
    out = reader(path).checkpoint()
    remove_path(spark, path)
    return out


def q_csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = _detail(spark, sf_dir)
    path = staging_path(spark, "csv")
    files.write_csv(detail, path)
    reader = spark.read.schema(detail.schema).option("sep", files.CSV_SEPARATOR).option("header", True)
    return _read_and_remove(spark, path, reader.csv)


def q_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "parquet")
    files.write_parquet(_detail(spark, sf_dir), path)
    return _read_and_remove(spark, path, spark.read.parquet)


def q_parquet_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "export")
    files.export_parquet(claims.claim_summary(_detail(spark, sf_dir)), path, single_file=True)
    return _read_and_remove(spark, path, spark.read.parquet)


def q_table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, tdef = TableStore(spark), _own_def("claim_detail", mode="overwrite", partition_by=None)
    store.save(with_load_ts(_detail(spark, sf_dir), CURRENT_LOAD_TS), tdef)
    return _read_and_drop(spark, store, tdef)


# --- conversation pipeline ------------------------------------------------------

AS_OF = fx.FIXTURE_AS_OF
# Lookback for the dashboard queries: reaches back before the first message
# of the fixtures (no upper bound), so whole tables are processed.
DAYS = 31
# Lookback used by the queries whose feature *is* the lookback filter.
RECENT_DAYS = 10
JSON_OPTIONS = {"ignoreNullFields": "false"}


def _as_json(df: DataFrame, column: str) -> DataFrame:
    """Arrays are compared as JSON text (one text field per element)."""
    return df.withColumn(column, F.to_json(F.col(column), JSON_OPTIONS))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session_defaults(spark)
    return fx.messages(spark, sf_dir)


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = messages.lookback(_messages(spark, sf_dir), "message_timestamp", AS_OF, DAYS)
    return messages.with_message_date(recent)


def _days(spark: SparkSession, sf_dir: str, include_history: bool) -> DataFrame:
    return sessions.session_days(_dated(spark, sf_dir), include_history=include_history)


def _clean_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session_defaults(spark)
    return surveys.clean_surveys(fx.surveys(spark, sf_dir), AS_OF, DAYS)


def _dashboard(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    ensure_session_defaults(spark)
    return dashboard.dashboard_base(fx.messages(spark, sf_dir), fx.surveys(spark, sf_dir), AS_OF, DAYS, **options)


def q_message_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir)


def q_survey_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session_defaults(spark)
    return fx.surveys(spark, sf_dir)


def q_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.lookback(_messages(spark, sf_dir), "message_timestamp", AS_OF, RECENT_DAYS)


def q_msg_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.flag_messages(_messages(spark, sf_dir))


def q_case_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_msg_flags(spark, sf_dir).select("session_id", "message_timestamp", "role", "id_reclamo")


def q_msg_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.dedup_messages(_dated(spark, sf_dir))


def q_survey_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_surveys(spark, sf_dir)


def q_survey_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surveys.order_surveys(_clean_surveys(spark, sf_dir))


def q_satisfaction_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surveys.satisfaction_daily(_clean_surveys(spark, sf_dir))


def q_session_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days(spark, sf_dir, False).select("session_id", "message_date", "id", "expires_at", "updated_at")


def q_session_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_json(_days(spark, sf_dir, True).select("session_id", "message_date", "history"), "history")


def q_session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days(spark, sf_dir, False).select(
        "session_id",
        "message_date",
        "primer_timestamp",
        "ultimo_timestamp",
        "fecha_inicio",
        "fecha_fin",
        "cantidad_mensajes",
        "mensajes_usuario",
        "mensajes_bot",
        "turnos_conversacion",
        "duracion_minutos",
        "duracion_segundos",
    )


def q_session_user_msgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_json(sessions.user_messages(_days(spark, sf_dir, True)), "si")


# Small chunks, so that the fixtures' session-days have several.
FIXTURE_CHUNK = 3


def q_session_history_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_json(sessions.history_chunks(_dated(spark, sf_dir), FIXTURE_CHUNK), "history")


def q_session_user_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_json(sessions.history_chunks(_dated(spark, sf_dir), FIXTURE_CHUNK, user_only=True), "history")


def q_session_history_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk table as its job stores it, read back and put together."""
    ensure_session_defaults(spark)
    store, tdef = TableStore(spark), _own_def("session_history", lookback_days=DAYS, extra={"chunk_messages": FIXTURE_CHUNK})
    run_table_job(spark, tdef, builtin_builders(_job_inputs(spark, sf_dir)), store, load_ts=CURRENT_LOAD_TS)
    return _read_and_drop(spark, store, tdef, df=_as_json(sessions.whole_histories(spark.table(tdef.full_name)), "history"))


def q_session_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days(spark, sf_dir, False).select("session_id", "message_date", "mensajes_usuario", "tipo_sesion")


def q_session_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = sessions.order_sessions(_days(spark, sf_dir, False))
    return ordered.select("session_id", "message_date", "id", "fecha_fin", "orden_conv")


def q_claim_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days(spark, sf_dir, False).select("message_date", "session_id", *sessions.STATUS_COLUMNS)


def q_join_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _days(spark, sf_dir, False)
    index = surveys.satisfaction_daily(_clean_surveys(spark, sf_dir))
    return dashboard.join_index(days, index).select("session_id", "message_date", "isn")


def q_fifo_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = sessions.session_metrics(_dated(spark, sf_dir), keep_join_key=True)
    ends = metrics.select(*sessions.JOIN_KEY, "session_id", "id", "fecha_fin")
    pairs = dashboard.fifo_pairs(ends, _clean_surveys(spark, sf_dir))
    return ends.join(pairs, on=list(sessions.JOIN_KEY)).select(
        "session_id",
        "message_date",
        "id",
        "orden_conv",
        "orden_enc",
        "fecha_encuesta",
        "eval_ia",
        "eval_acceso",
        "resolucion",
    )


# Two overlapping runs: the first sees the days before FIRST_END, the second looks back to SECOND_START.
FIRST_END, SECOND_START = dt.date(2024, 1, 12), dt.date(2024, 1, 5)


def q_fifo_match_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIFO pairs of two overlapping lookbacks, stored by key; numbers go on across the edge."""
    metrics = sessions.session_metrics(_dated(spark, sf_dir), keep_join_key=True)
    ends = metrics.select(*sessions.JOIN_KEY, "session_id", "id", "fecha_fin").checkpoint()
    clean = _clean_surveys(spark, sf_dir)
    store, run = TableStore(spark), uuid.uuid4().hex[:12]
    ledger = FifoLedger(store, f"cx_fifo_{run}")
    stored = TableDef(f"cx_pairs_{run}", "python", primary_key=sessions.JOIN_KEY, mode="merge", python_source="pairs", fail_if_empty=False)
    store.save(ledger.pairs(ends.where(F.col("message_date") < F.lit(FIRST_END)), clean.where(F.col("Fecha") < F.lit(FIRST_END))), stored)
    ledger.advance(ends, clean, SECOND_START)
    recent = ends.where(F.col("message_date") >= F.lit(SECOND_START)), clean.where(F.col("Fecha") >= F.lit(SECOND_START))
    store.save(ledger.pairs(*recent), stored)
    pairs = ends.join(spark.table(stored.full_name), on=list(sessions.JOIN_KEY))
    out = pairs.select("session_id", "message_date", "id", "orden_conv", "orden_enc", "fecha_encuesta", "eval_ia", "eval_acceso", "resolucion")
    return _read_and_drop(spark, store, ledger.tdef(), stored, df=out)


def q_join_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dashboard(spark, sf_dir, include_history=False, include_fifo=False).select(
        "session_id", "message_date", *sessions.STATUS_COLUMNS
    )


def q_dashboard_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_json(_dashboard(spark, sf_dir), "history")


def stored_dashboard(spark: SparkSession, sf_dir: str, store: TableStore) -> TableDef:
    """The dashboard base as its table job stores it (every day of the messages)."""
    tdef = _own_def("dashboard_base", lookback_days=DAYS)
    run_table_job(spark, tdef, builtin_builders(_job_inputs(spark, sf_dir)), store, load_ts=CURRENT_LOAD_TS)
    return tdef


def recent_of(spark: SparkSession, tdef: TableDef) -> DataFrame:
    """The recent-dashboard definition over a stored base: its SQL file with its parameters."""
    recent = default_table_defs()["dashboard_recent"]
    params = {"source_table": tdef.full_name, "as_of": AS_OF, "dias": RECENT_DAYS}
    return _as_json(scans.sql_file_source(spark, recent.query_sql_path, **params), "history")


def q_dashboard_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session_defaults(spark)
    store = TableStore(spark)
    base = stored_dashboard(spark, sf_dir, store)
    return _read_and_drop(spark, store, base, df=recent_of(spark, base))


def registry() -> dict[str, Query]:
    return {
        "claim_detail": q_claim_detail,
        "claim_summary": q_claim_summary,
        "claim_evolution": q_claim_evolution,
        "claim_top": q_claim_top,
        "usage_log_scan": q_usage_log_scan,
        "claim_event_date": q_claim_event_date,
        "claim_valid": q_claim_valid,
        "claim_user_exclusion": q_claim_user_exclusion,
        "claim_user_exclusion_list": q_claim_user_exclusion_list,
        "claim_detail_exclusion_list": q_claim_detail_exclusion_list,
        "claim_month": q_claim_month,
        "claim_class": q_claim_class,
        "claim_value": q_claim_value,
        "claim_user": q_claim_user,
        "claim_first_per_ot": q_claim_first_per_ot,
        "claim_sorted": q_claim_sorted,
        "usage_log_documents": q_usage_log_documents,
        "claim_event_date_documents": q_claim_event_date_documents,
        "claim_value_documents": q_claim_value_documents,
        "claim_detail_documents": q_claim_detail_documents,
        "with_load_ts": q_with_load_ts,
        "table_merge": q_table_merge,
        "table_merge_bucketed": q_table_merge_bucketed,
        "table_merge_moved": q_table_merge_moved,
        "table_compact_partitions": q_table_compact_partitions,
        "table_append": q_table_append,
        "table_compact": q_table_compact,
        "claim_detail_ledger": q_claim_detail_ledger,
        "claim_summary_ledger": q_claim_summary_ledger,
        "claim_top_ledger": q_claim_top_ledger,
        "session_days_ledger": q_session_days_ledger,
        "parquet_scan": q_parquet_scan,
        "sql_limit": q_sql_limit,
        "sql_file_source": q_sql_file_source,
        "table_sample": q_table_sample,
        "clean_columns": q_clean_columns,
        "json_export": q_json_export,
        "csv_sink": q_csv_sink,
        "parquet_sink": q_parquet_sink,
        "parquet_export": q_parquet_export,
        "table_overwrite": q_table_overwrite,
        "table_overwrite_partitioned": q_table_overwrite_partitioned,
        "table_create": q_table_create,
        "table_job": q_table_job,
        "table_graph": q_table_graph,
        "python_source": q_python_source,
        "normalize_source": q_normalize_source,
        "message_scan": q_message_scan,
        "survey_scan": q_survey_scan,
        "lookback": q_lookback,
        "msg_flags": q_msg_flags,
        "case_id": q_case_id,
        "msg_dedup": q_msg_dedup,
        "survey_clean": q_survey_clean,
        "survey_order": q_survey_order,
        "satisfaction_daily": q_satisfaction_daily,
        "session_day": q_session_day,
        "session_history": q_session_history,
        "session_history_chunks": q_session_history_chunks,
        "session_user_chunks": q_session_user_chunks,
        "session_history_table": q_session_history_table,
        "session_metrics": q_session_metrics,
        "session_user_msgs": q_session_user_msgs,
        "session_type": q_session_type,
        "session_order": q_session_order,
        "claim_status": q_claim_status,
        "join_index": q_join_index,
        "fifo_match": q_fifo_match,
        "fifo_match_windows": q_fifo_match_windows,
        "join_status": q_join_status,
        "dashboard_base": q_dashboard_base,
        "dashboard_recent": q_dashboard_recent,
    }
