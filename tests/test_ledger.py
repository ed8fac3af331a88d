"""Stored states against batch results: late records, moved classes, loads that break off."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from cxlake.operators import claims, sessions
from cxlake.plans import ledger as L
from cxlake.sinks.tables import TableStore
from cxlake.sources import fixtures as fx

LOGS = "log_id BIGINT, ot STRING, created_at STRING, clasificacion STRING, valor_declarado STRING, user STRING"


def claim_ledger(spark):
    return L.ClaimLedger(TableStore(spark), f"t_{uuid.uuid4().hex[:10]}", tie_breaker="log_id")


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def check(spark, ledger, logs):
    detail = claims.claim_detail(spark.createDataFrame(logs, LOGS))
    assert rows(ledger.detail()) == rows(detail)
    assert rows(ledger.summary()) == rows(claims.claim_summary(detail))
    assert rows(ledger.evolution()) == rows(claims.claim_evolution(detail))
    assert rows(ledger.top()) == rows(claims.claim_top(detail))


LOADS = [
    [(1, "A", "2024-03-05", "x", "10.125", "u"), (2, "B", "2024-03-06", "x", "0.1", None), (3, "C", "2024-03-07", "n/a", "5", "u")],
    # A's first record is a month earlier and of another class; C gets a class; B's tie is won by the smaller id
    [(0, "A", "2024-02-01", "y", "3", "v"), (4, "C", "2024-03-08", "z", "7", "u"), (5, "B", "2024-03-06", "w", "9", "u")],
    [(6, "D", "2024-01-01", "x", "1e3", "u"), (7, "A", "2024-05-01", "x", "99", "u"), (8, None, "2024-05-01", "x", "99", "u")],
    [],
]


def test_late_records_take_the_old_ones_out(spark):
    ledger, logs = claim_ledger(spark), []
    for i, load in enumerate(LOADS):
        ledger.load(spark.createDataFrame(load, LOGS), f"load {i}")
        logs += load
        check(spark, ledger, logs)
    # x of March held A and B; A has left it, and a month and class without records has no row
    assert {(r["Mes"], r["Clasificacion"]): r["n"] for r in ledger.monthly().collect()} == {("2024-02", "y"): 1, ("2024-03", "x"): 1, ("2024-03", "z"): 1, ("2024-01", "x"): 1}
    ledger.drop()


@pytest.mark.parametrize("broken", ["rollup", "ot"])
def test_a_load_that_breaks_off_counts_once(spark, monkeypatch, broken):
    ledger, logs = claim_ledger(spark), LOADS[0] + LOADS[1]
    ledger.load(spark.createDataFrame(LOADS[0], LOGS), "first")
    merge, struck = L.StateTable.merge, []

    def failing(self, *args):
        if self.name.endswith(broken) and not struck:
            struck.append(1)
            raise RuntimeError("lost")
        return merge(self, *args)

    monkeypatch.setattr(L.StateTable, "merge", failing)
    with pytest.raises(RuntimeError, match="lost"):
        ledger.load(spark.createDataFrame(LOADS[1], LOGS), "second")
    for _ in range(2):
        ledger.load(spark.createDataFrame(LOADS[1], LOGS), "second")
        check(spark, ledger, logs)
    assert {r["ot"]: r["records"] for r in ledger.states.rows(ledger.store).collect()} == {"A": 2, "B": 2, "C": 1}
    ledger.drop()


@pytest.mark.parametrize("broken", ["day", "message"])
def test_copies_of_messages_over_loads(spark, monkeypatch, broken):
    """A copy that comes later adds to the marks and not to the messages, also when the load before broke off."""
    from cxlake.operators.messages import MESSAGE_COLUMNS, with_message_date

    t, ids = dt.datetime(2024, 1, 1, 10), ("b1", "b2")
    message = lambda s, i, role, text, minute: (s, ids[i], role, text, t + dt.timedelta(minutes=minute), t, t)
    loads = [
        [message("s", 0, "user", "mi rut es", 0), message("s", 1, "assistant", "CAS-12", 5), message(None, 0, None, None, 3)],
        [message("s", 0, "user", "mi rut es", 0), message("s", 0, "user", "hola", -5), message(None, 0, None, None, 3), message("r", 0, "user", "x", 1)],
    ]
    schema = ", ".join(f"{c} {'TIMESTAMP_NTZ' if 'at' in c.split('_')[-1] or 'timestamp' in c else 'STRING'}" for c in MESSAGE_COLUMNS)
    frames = [with_message_date(spark.createDataFrame(x, schema)) for x in loads]
    ledger = L.SessionLedger(TableStore(spark), f"t_{uuid.uuid4().hex[:10]}")
    ledger.load(frames[0], "first")
    merge, struck = L.StateTable.merge, []

    def failing(self, *args):
        if self.name.endswith(broken) and not struck:
            struck.append(1)
            raise RuntimeError("lost")
        return merge(self, *args)

    monkeypatch.setattr(L.StateTable, "merge", failing)
    with pytest.raises(RuntimeError, match="lost"):
        ledger.load(frames[1], "second")
    for _ in range(2):
        ledger.load(frames[1], "second")
        assert rows(ledger.session_days()) == rows(sessions.session_metrics(frames[0].unionByName(frames[1])))
    ledger.drop()


def test_message_key_tells_null_from_empty(spark):
    from cxlake.operators.messages import DEDUP_KEY

    df = spark.createDataFrame([("", None), (None, ""), (None, None), ("1:a", "")], "session_id string, content string")
    for c in DEDUP_KEY:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    assert df.select(L.message_key()).distinct().count() == 4


def test_the_ledger_reads_touched_states_only(spark):
    """The logs of earlier loads are not read again: the plan of a load scans the new logs and the states."""
    ledger = claim_ledger(spark)
    logs = fx.usage_logs(spark, "/root/testdata/sf0.001")
    ledger.load(logs.where("log_id % 2 = 0"), "a")
    ledger.load(logs.where("log_id % 2 = 1"), "b")
    assert rows(ledger.detail()) == rows(claims.claim_detail(logs))
    plan = ledger.detail()._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan
    ledger.drop()
