"""Compare a Spark result with a DuckDB statement over the same parquet tables.

Mirrors the driver's gate: row count, column names (sorted) and an
order-insensitive comparison of the values. Used by the tests and from the
command line:  python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, dt.datetime):
        v = v.replace(tzinfo=None)
        # engines differ in how a DATE reaches pandas (date vs midnight timestamp)
        return v.date().isoformat() if v.time() == dt.time() else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v) if not isinstance(v, (int, str, bool)) else v


def rows_of(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    rows = [tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)]
    rows.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return cols, rows


def compare(spark_df, sql: str, con) -> dict:
    spdf = spark_df.toPandas()
    dpdf = con.execute(sql).df()
    scols, srows = rows_of(spdf)
    dcols, drows = rows_of(dpdf)
    out = {
        "rows_spark": len(srows),
        "rows_oracle": len(drows),
        "columns_match": scols == dcols,
        "values_match": srows == drows,
    }
    if not out["columns_match"]:
        out["spark_columns"] = scols
        out["oracle_columns"] = dcols
    elif not out["values_match"]:
        sset, dset = set(srows), set(drows)
        out["only_spark"] = [tuple(str(x)[:60] for x in r) for r in list(sset - dset)[:2]]
        out["only_oracle"] = [tuple(str(x)[:60] for x in r) for r in list(dset - sset)[:2]]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    from cxlake.session import get_or_create_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_or_create_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in oracle:
            n = qs[name](spark, sf_dir).count()
            print(f"{name:28s} rows-only {n}")
            continue
        res = compare(qs[name](spark, sf_dir), oracle[name], con)
        ok = res["columns_match"] and res["values_match"] and res["rows_spark"] == res["rows_oracle"]
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {res}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
