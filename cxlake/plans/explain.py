"""Print the physical plan of registered queries.

    python -m cxlake.plans.explain dashboard_base claim_detail --sf-dir /root/testdata/sf0.01 --static

``--static`` turns off adaptive execution and size-based broadcasts, which is
the plan a large input gets before run-time statistics exist.
"""

from __future__ import annotations

import argparse

from cxlake.plans.queries import registry
from cxlake.session import get_or_create_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cxlake.plans.explain")
    ap.add_argument("names", nargs="*", help="registered query names (default: all)")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--mode", default="formatted", choices=["simple", "extended", "codegen", "cost", "formatted"])
    ap.add_argument("--static", action="store_true")
    args = ap.parse_args(argv)
    spark = get_or_create_session()
    if args.static:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    queries = registry()
    for name in args.names or list(queries):
        print(f"===== {name}")
        queries[name](spark, args.sf_dir).explain(args.mode)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
