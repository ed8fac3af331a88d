"""Documents whose fields change their type: event dates, amounts and keys, per document."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cxlake.functions import documents
from cxlake.operators import claims
from cxlake.sources.scans import read_usage_logs


def read(spark, tmp_path, docs, name="docs.json"):
    path = tmp_path / name
    path.write_text("".join(d if isinstance(d, str) else json.dumps(d) + "\n" for d in docs))
    return read_usage_logs(spark, str(path))


def test_event_date_by_the_type_of_each_document(spark, tmp_path):
    scanned = {"$date": "2024-03-07T08:09:10Z"}
    cases = {
        # created_at -> (event time, or None)
        "date object": ({"$date": "2024-01-05T10:00:00Z"}, dt.datetime(2024, 1, 5, 10)),
        "millis": ({"$date": {"$numberLong": "1704448800000"}}, dt.datetime(2024, 1, 5, 10)),
        "plain millis": ({"$date": 1704448800000}, dt.datetime(2024, 1, 5, 10)),
        "text": ("2024-01-05T10:00:00", dt.datetime(2024, 1, 5, 10)),
        "offset without colon": ("2024-01-05T10:00:00+0200", dt.datetime(2024, 1, 5, 8)),
        "offset": ("2024-01-05T10:00:00-03:00", dt.datetime(2024, 1, 5, 13)),
        # present but unreadable: no fall through
        "bad text": ("soon", None),
        "bad date object": ({"$date": "soon"}, None),
        # neither a date nor text: the second field decides
        "number": (1704448800000, dt.datetime(2024, 3, 7, 8, 9, 10)),
        "wrapped number": ({"$numberLong": "7"}, dt.datetime(2024, 3, 7, 8, 9, 10)),
        "boolean": (True, dt.datetime(2024, 3, 7, 8, 9, 10)),
        "null": (None, dt.datetime(2024, 3, 7, 8, 9, 10)),
        "object": ({"x": 1}, dt.datetime(2024, 3, 7, 8, 9, 10)),
        "object with more than a date": ({"$date": "2024-01-05T10:00:00Z", "x": 1}, dt.datetime(2024, 3, 7, 8, 9, 10)),
        "array": (["2024-01-05"], dt.datetime(2024, 3, 7, 8, 9, 10)),
    }
    docs = [{"_id": name, "created_at": value, "fecha_escaneo": scanned} for name, (value, _) in cases.items()]
    docs.append({"_id": "missing", "fecha_escaneo": "2024-03-07 08:09"})
    docs.append({"_id": "nothing", "created_at": 5, "fecha_escaneo": False})
    df = read(spark, tmp_path, docs)
    got = {r["id"]: r["ts"] for r in df.select(documents.text(F.col("_id")).alias("id"), claims.event_date(df).alias("ts")).collect()}
    want = {name: ts for name, (_, ts) in cases.items()} | {"missing": dt.datetime(2024, 3, 7, 8, 9), "nothing": None}
    assert got == want


def test_declared_value_by_the_type_of_each_document(spark, tmp_path):
    cases = [
        (7, 7.0), (7.5, 7.5), ("7.5", 7.5), ("x", 0.0), ("", 0.0), (" 7 ", 0.0), (True, 1.0), (False, 0.0), (None, 0.0), ([7], 0.0), ({"x": 7}, 0.0),
        ({"$numberInt": "7"}, 7.0), ({"$numberDecimal": "12.50"}, 12.5), ({"$numberDouble": "1e3"}, 1000.0), ({"$date": {"$numberLong": "5000"}}, 5000.0),
        ({"$date": "1970-01-01T00:00:07Z"}, 7000.0), (10**25, 1e25), (1e300, 1e300),
    ]
    df = read(spark, tmp_path, [{"_id": i, "valor_declarado": v} for i, (v, _) in enumerate(cases)] + [{"_id": 99}])
    got = {int(r["id"]): r["v"] for r in df.select(documents.text(F.col("_id")).alias("id"), claims.declared_value(df).alias("v")).collect()}
    assert got == {i: v for i, (_, v) in enumerate(cases)} | {99: 0.0}


def test_keys_users_and_classes_of_any_type(spark, tmp_path):
    day = {"$date": "2024-01-05T10:00:00Z"}
    docs = [
        {"_id": {"$oid": "0b"}, "ot": 7, "created_at": day, "clasificacion": 5, "user": 3},
        {"_id": {"$oid": "0a"}, "ot": {"$numberInt": "7"}, "created_at": day, "clasificacion": "first by id", "usuario": "u"},
        {"_id": "c", "ot": 0, "created_at": day}, {"_id": "d", "ot": False, "created_at": day}, {"_id": "e", "ot": "", "created_at": day},
        {"_id": "f", "ot": None, "created_at": day}, {"_id": "g", "created_at": day}, {"_id": "h", "ot": [], "created_at": day}, {"_id": "i", "ot": {}, "created_at": day},
        {"_id": "j", "ot": "0", "created_at": day, "user": "bad"}, {"_id": "k", "ot": " ", "created_at": day, "user": None, "user_id": {"$numberLong": "42"}},
        {"_id": "l", "ot": "A", "created_at": day, "clasificacion": "n/a"}, {"_id": "m", "ot": "B", "created_at": day, "clasificacion": None},
    ]
    df = read(spark, tmp_path, docs)
    rows = claims.claim_detail(df, excluded_users=["bad"], tie_breaker="_id").collect()
    assert {(r["OT"], r["Clasificacion"], r["Usuario"]) for r in rows} == {("7", "first by id", "u"), (" ", claims.NO_CLASS, "42"), ("B", claims.NO_CLASS, claims.NO_USER)}


def test_a_line_that_is_no_document_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)malformed"):
        read(spark, tmp_path, ['{"_id": 1, "ot": "A"}\n', "no document\n"]).collect()
    path = str(tmp_path / "docs.json")
    assert read_usage_logs(spark, path, options={"mode": "PERMISSIVE"}).count() == 2


def test_typed_variant_dates(spark):
    df = spark.sql("SELECT to_variant_object(struct(timestamp'2024-01-05 10:00:00' AS t, date'2024-01-06' AS d)) AS v").selectExpr(
        "variant_get(v, '$.t', 'variant') AS created_at", "variant_get(v, '$.d', 'variant') AS fecha_escaneo"
    )
    assert df.select(claims.event_date(df)).first()[0] == dt.datetime(2024, 1, 5, 10)
    assert df.select(documents.kind(F.col("fecha_escaneo"))).first()[0] == "date"
