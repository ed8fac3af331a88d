"""Inputs derived from the driver's tables.

The product reads three inputs that the test data does not ship directly:
usage-log documents, the message history and the survey answers. They are
derived here, row for row, from ``orders``, ``conversations`` and ``events``
with plain column expressions (no shuffle, no join), so the derived inputs
scale with the tables they come from. The same derivations exist as DuckDB
SQL in ``cxlake.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values for the fixtures: the user exclusion list and the day the
# message and survey lookbacks end.
FIXTURE_EXCLUDED_USERS = ("u3", "u7")
FIXTURE_AS_OF = "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def usage_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One usage-log document per order, with every edge case of the source.

    Columns: log_id, ot, created_at, fecha_escaneo, clasificacion,
    valor_declarado, user, usuario, username, user_id (all text but log_id).
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")

    def user_like(modulus: int) -> F.Column:
        return F.concat(F.lit("u"), (cust % modulus).cast("string"))

    return o.select(
        k.alias("log_id"),
        F.when(k % 43 == 0, F.lit(None).cast("string"))
        .when(k % 41 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("OT-"), cust.cast("string")))
        .alias("ot"),
        F.when(k % 31 == 0, F.lit("sin fecha"))
        .when(k % 37 == 0, F.lit("10:15:00"))
        .when(k % 47 == 0, F.lit("2024-3"))
        .when(k % 53 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 07:30")))
        .when(k % 29 == 0, F.lit(None).cast("string"))
        .otherwise(iso)
        .alias("created_at"),
        F.when(k % 58 == 0, F.lit(None).cast("string")).otherwise(iso).alias("fecha_escaneo"),
        F.when(k % 13 == 0, F.lit("n/a"))
        .when(k % 26 == 1, F.lit("N/A"))
        .when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority"))
        .alias("clasificacion"),
        F.when(k % 17 == 0, F.lit("x"))
        .when(k % 19 == 0, F.lit(""))
        .when(k % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("valor_declarado"),
        F.when(k % 5 == 0, user_like(20)).alias("user"),
        F.when(k % 3 == 0, user_like(21)).alias("usuario"),
        F.when(k % 2 == 0, user_like(22)).alias("username"),
        F.when(k % 11 != 0, user_like(23)).alias("user_id"),
    )


def excluded_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of user names, one per customer in debt; few of them occur in the logs."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") < 0).select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("name"))


def usage_log_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per order, as a collection export writes them: one text column, ``value``.

    Every field changes its type from document to document (text, number, boolean,
    null, missing, extended-JSON dates and numbers, objects, arrays)."""
    o = table(spark, sf_dir, "orders")
    k, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    price = F.col("o_totalprice").cast("string")

    def quoted(value: F.Column) -> F.Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def wrapped(name: str, value: F.Column) -> F.Column:
        return F.concat(F.lit(f'{{"${name}":'), value, F.lit("}"))

    def raw(value: str) -> F.Column:
        return F.lit(value)

    def user_like(modulus: int) -> F.Column:
        return quoted(F.concat(F.lit("u"), (F.col("o_custkey") % modulus).cast("string")))

    nothing = F.lit(None).cast("string")
    fields = {
        "_id": wrapped("oid", quoted(F.lpad(F.lower(F.hex(k)), 24, "0"))),
        "ot": F.when(k % 79 == 0, nothing)
        .when(k % 83 == 0, raw('""'))
        .when(k % 89 == 0, raw("0"))
        .when(k % 97 == 0, raw("null"))
        .when(k % 101 == 0, raw("false"))
        .when(k % 2 == 0, cust)
        .when(k % 3 == 0, wrapped("numberLong", quoted(cust)))
        .otherwise(quoted(F.concat(F.lit("OT-"), cust))),
        "created_at": F.when(k % 29 == 0, nothing)
        .when(k % 31 == 0, raw('"sin fecha"'))
        .when(k % 37 == 0, k.cast("string"))
        .when(k % 41 == 0, raw("true"))
        .when(k % 43 == 0, raw("null"))
        .when(k % 47 == 0, raw('{"x":1}'))
        .when(k % 53 == 0, quoted(F.concat(iso, F.lit("+0000"))))
        .when(k % 59 == 0, wrapped("date", millis))
        .when(k % 5 == 0, wrapped("date", quoted(F.concat(iso, F.lit("Z")))))
        .when(k % 5 == 1, wrapped("date", wrapped("numberLong", quoted(millis))))
        .otherwise(quoted(iso)),
        "fecha_escaneo": F.when(k % 58 == 0, nothing)
        .when(k % 61 == 0, raw("false"))
        .when(k % 3 == 0, wrapped("date", quoted(F.concat(iso, F.lit("Z")))))
        .otherwise(quoted(iso)),
        "clasificacion": F.when(k % 13 == 0, raw('"n/a"'))
        .when(k % 26 == 1, raw('"N/A"'))
        .when(k % 7 == 0, nothing)
        .when(k % 67 == 0, raw("5"))
        .otherwise(quoted(F.col("o_orderpriority"))),
        "valor_declarado": F.when(k % 71 == 0, nothing)
        .when(k % 17 == 0, raw('"x"'))
        .when(k % 19 == 0, raw('""'))
        .when(k % 23 == 0, raw("null"))
        .when(k % 13 == 2, raw("true"))
        .when(k % 11 == 3, raw("false"))
        .when(k % 73 == 0, raw("[1,2]"))
        .when(k % 103 == 0, wrapped("date", wrapped("numberLong", quoted(F.concat(cust, F.lit("000"))))))
        .when(k % 7 == 0, price)
        .when(k % 7 == 1, wrapped("numberDecimal", quoted(price)))
        .when(k % 7 == 2, wrapped("numberInt", quoted(cust)))
        .otherwise(quoted(price)),
        "user": F.when(k % 5 == 0, user_like(20)),
        "usuario": F.when(k % 3 == 0, user_like(21)),
        "username": F.when(k % 4 == 0, raw("null")).when(k % 2 == 0, user_like(22)),
        "user_id": F.when(k % 11 != 0, (F.col("o_custkey") % 23).cast("string")),
    }
    members = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]
    return o.select(F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("value"))


def messages(spark: SparkSession, sf_dir: str, copy_col: str | None = None) -> DataFrame:
    """Message history: one row per conversation turn.

    Every eighth conversation carries its first message twice (an exact
    duplicate, generated by exploding a one- or two-element array in the same
    scan). Some turns get a phrase appended so that each message flag fires
    somewhere. ``copy_col``: also which copy a row is (1 or 2).
    """
    c = table(spark, sf_dir, "conversations")
    conv = F.col("conv_id")
    turn = F.col("turn")
    suffix = (
        F.when((conv % 5 == 0) & (turn == 2), F.lit(" ya existe un reclamo"))
        .when((conv % 4 == 0) & (turn == 3), F.concat(F.lit(" CAS-"), conv.cast("string"), F.lit("-X")))
        .when((conv % 6 == 0) & (turn == 1), F.lit(" indique su telefono"))
        .when((conv % 9 == 0) & (turn == 1), F.lit(" no fue posible crear el reclamo porque"))
        .otherwise(F.lit(""))
    )
    # one or two copies of each row, generated in the same scan
    copies = F.when((conv % 8 == 0) & (turn == 0), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return c.select(
        conv.cast("string").alias("session_id"),
        (conv % 60).cast("string").alias("balancer_mongo_id"),
        F.col("role"),
        F.concat(F.col("text"), suffix).alias("content"),
        F.expr(
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, conv_id * 397 + turn * 7, 0)"
        ).alias("message_timestamp"),
        F.expr("timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(0, 0, conv_id * 397, 0)").alias(
            "conversation_expires_at"
        ),
        F.expr("timestamp_ntz'2024-01-01 01:00:00' + make_dt_interval(0, 0, conv_id * 397, 0)").alias(
            "conversation_updated_at"
        ),
        F.explode(copies).alias(copy_col or "_copy"),
    ).drop(*([] if copy_col else ["_copy"]))


def surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey answers: one row per event, ratings stored as text."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid,
        (F.col("user_id") % 50).cast("string").alias("IdUsuario"),
        F.col("ts").cast("date").alias("Fecha"),
        F.when(eid % 10 == 9, F.lit(""))
        .when(eid % 97 == 0, F.lit(None).cast("string"))
        .when(eid % 89 == 0, F.lit("mal"))
        .otherwise((eid % 9).cast("string"))
        .alias("EvalIA"),
        (eid % 5 + 1).cast("string").alias("EvalAcceso"),
        F.when(eid % 2 == 0, F.lit("Si")).otherwise(F.lit("No")).alias("EvalResolvReq"),
        F.when(eid % 3 == 0, F.lit("No")).otherwise(F.lit("Si")).alias("AtencionIA"),
        F.when(eid % 7 == 0, F.lit("humano")).otherwise(F.lit("robot")).alias("OperadorAbre"),
        F.when(eid % 8 == 0, F.lit("humano")).otherwise(F.lit("robot")).alias("OperadorCierra"),
    )
