"""Headline queries at one scale factor; prints ONE JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all
cores) select the data and ``local[N]``. Each query is executed in full
through the ``noop`` sink (every row produced, nothing collected to the
driver); ``table_merge`` times the real versioned merge into a parquet
table in a fresh scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from cxlake.plans import queries as Q  # noqa: E402
from cxlake.plans.job import with_load_ts  # noqa: E402
from cxlake.session import get_or_create_session  # noqa: E402
from cxlake.sinks.tables import TableStore  # noqa: E402

HEADLINE = ("claim_detail", "claim_summary", "dashboard_base", "table_merge")
EXTRA = ("claim_top", "msg_dedup", "satisfaction_daily", "dashboard_recent", "fifo_match")


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


REPEAT = int(os.environ.get("BENCH_REPEAT", "5"))


def median(values: list[float]) -> float:
    v = sorted(values)
    return v[len(v) // 2]


def bench_merge(spark, sf_dir: str) -> float:
    """Previous load in the table, then time the merge of the current load
    (a fresh table per repetition, so every run does the same work)."""
    store, tdef = TableStore(spark), Q._own_def("claim_detail")
    store.save(with_load_ts(Q.previous_detail(spark, sf_dir), Q.PREVIOUS_LOAD_TS), tdef)
    current = with_load_ts(Q._detail(spark, sf_dir), Q.CURRENT_LOAD_TS)
    took = timed(lambda: store.save(current, tdef))
    store.drop(tdef)
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 8)
    scratch = tempfile.mkdtemp(prefix="cxlake-bench-")
    spark = get_or_create_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "6g"),
        },
    )
    reg = Q.registry()
    base = Q.stored_dashboard(spark, sf_dir, TableStore(spark))  # the stored table, as the product reads it
    runs = {name: (lambda name=name: timed(lambda: run_noop(reg[name](spark, sf_dir)))) for name in HEADLINE + EXTRA}
    runs["table_merge"] = lambda: bench_merge(spark, sf_dir)
    runs["dashboard_recent"] = lambda: timed(lambda: run_noop(Q.recent_of(spark, base)))
    # tells a slow machine from a slow query
    runs["control_scan"] = lambda: timed(lambda: run_noop(spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderpriority").count()))
    taken: dict[str, list[float]] = {name: [] for name in runs}
    for turn in range(REPEAT + 1):  # in turns; the first one warms up and isn't counted
        for name, run in runs.items():
            took = run()
            if turn:
                taken[name].append(took)
    times = {name: median(v) for name, v in taken.items()}
    headline = sum(times[n] for n in HEADLINE)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in times.items()},
                "fastest": {k: round(min(v), 3) for k, v in taken.items()},
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeat": REPEAT,
                "stat": "median",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
