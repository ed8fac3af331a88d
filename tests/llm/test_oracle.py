"""Text-corpus queries against their DuckDB oracles, and what the driver expects of the registry."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cxlake.llm import secret_scan
from cxlake.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    res = compare(QUERIES[name](spark, SF), ORACLE_SQL[name], duck(SF))
    assert res["columns_match"] and res["values_match"] and res["rows_spark"] == res["rows_oracle"], res


def test_secret_oracle_links_by_the_gap(spark, tmp_path):
    """Long parts, parts at the edge of the scope, overlaps and repeated kinds: the oracle's law is the operator's."""
    rng = random.Random(7)
    url, blob, key = "https://db.example.com/" + "x/" * 110, "aB3" * 85, "AKIA" + "Q" * 16
    parts = [url, blob, "user: someone", "aB3" * 12, "password=" + "k" * 230, key, "0123456789abcdef" * 2, "s3://b/c", "login=ab"]
    texts = [(" " * rng.choice([1, 30, 199, 200, 201, 260])).join(rng.choices(parts, k=rng.randint(1, 6))) for _ in range(400)]
    docs = spark.createDataFrame([*enumerate([*texts, None, ""])], "doc_id bigint, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    res = compare(secret_scan.scan_documents(docs), ORACLE_SQL["op7_secret_scan"], con)
    assert res["columns_match"] and res["values_match"] and res["rows_spark"] == res["rows_oracle"] == 402, res


def test_registry():
    names = set(entry.queries())
    assert {*QUERIES, "pipeline"} <= names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
