"""Run table jobs from the command line.

    spark-submit cxlake/__main__.py --tables claim_detail claim_summary \\
        --usage-logs /data/usage_logs/ --usage-logs-format json \\
        --exclude-user someone@example.com --defs tables.json

Inputs may be paths (parquet/json) or catalog table names (``table:name``).
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a file (spark-submit cxlake/__main__.py)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from cxlake.plans.catalog import default_table_defs  # noqa: E402
from cxlake.plans.job import Inputs, builtin_builders, run_table_graph, run_tables  # noqa: E402
from cxlake.plans.tabledef import load_table_defs  # noqa: E402
from cxlake.session import ensure_session_defaults  # noqa: E402
from cxlake.sinks.tables import TableStore  # noqa: E402
from cxlake.sources.scans import read_usage_logs, table_scan  # noqa: E402


def _loader(spec: str | None, fmt: str = "parquet"):
    if not spec:
        return None

    def load(spark: SparkSession) -> DataFrame:
        if spec.startswith("table:"):
            return table_scan(spark, spec[len("table:"):])
        if fmt == "parquet":
            return spark.read.parquet(spec)
        return spark.read.format(fmt).load(spec)

    return load


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cxlake", description=__doc__.splitlines()[0])
    ap.add_argument("--tables", nargs="+", required=True)
    ap.add_argument("--defs", help="JSON table catalog; default: the built-in definitions")
    ap.add_argument("--database")
    ap.add_argument("--usage-logs")
    ap.add_argument("--usage-logs-format", default="json", choices=["json", "parquet", "mongodb"])
    ap.add_argument("--messages")
    ap.add_argument("--surveys")
    ap.add_argument("--exclude-user", action="append", default=[])
    ap.add_argument("--exclude-user-list", help="path or table whose first column has names to exclude, any number of them")
    ap.add_argument("--as-of", help="last day of lookbacks (default: today)")
    ap.add_argument("--log-tie-breaker", default="_id")
    ap.add_argument("--survey-tie-breaker")
    ap.add_argument("--param", action="append", default=[], metavar="NAME=VALUE", help="parameter of SQL-origin tables")
    ap.add_argument("--parallel", type=int, help="so many tables at a time, after those they depend on (default: in the order given)")
    args = ap.parse_args(argv)

    spark = ensure_session_defaults(SparkSession.builder.appName("cxlake").getOrCreate())
    defs = load_table_defs(args.defs) if args.defs else default_table_defs(args.database)
    logs = None
    if args.usage_logs:
        if args.usage_logs.startswith("table:"):
            logs = _loader(args.usage_logs)
        else:
            logs = lambda s: read_usage_logs(s, args.usage_logs, fmt=args.usage_logs_format)
    inputs = Inputs(
        usage_logs=logs,
        messages=_loader(args.messages),
        surveys=_loader(args.surveys),
        excluded_users=tuple(args.exclude_user),
        excluded_user_list=_loader(args.exclude_user_list),
        log_tie_breaker=args.log_tie_breaker,
        survey_tie_breaker=args.survey_tie_breaker,
        as_of=args.as_of,
    )
    # parameters of SQL-origin tables: the day that lookbacks end, and name=value pairs
    sql_params = {**({"as_of": args.as_of} if args.as_of else {}), **dict(p.split("=", 1) for p in args.param)}
    if args.parallel:
        runs = run_table_graph(spark, args.tables, defs, builtin_builders(inputs), TableStore(spark), sql_params, parallel=args.parallel)
        for r in runs:
            print(json.dumps({"table": r.name, "status": r.status, "error": r.error, **(r.result.__dict__ if r.result else {})}))
        return int(any(r.status != "saved" for r in runs))
    results = run_tables(spark, args.tables, defs, builtin_builders(inputs), TableStore(spark), sql_params)
    for r in results:
        print(json.dumps(r.__dict__))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
