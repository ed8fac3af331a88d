"""Numbers and pairs over overlapping lookbacks against one run over everything."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from cxlake.operators import dashboard, messages, sessions
from cxlake.plans.fifo_ledger import FifoLedger
from cxlake.plans.queries import AS_OF, DAYS
from cxlake.sinks.tables import TableStore
from cxlake.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


def inputs(spark, seed):
    """Twenty days; user a has most rows, surveys come before and after their conversations, some ids are null."""
    dice = random.Random(seed)
    users = ["a"] * 6 + ["b", "c", None]
    ends, clean = [], []
    for i in range(160):
        day, user = dice.randrange(20), dice.choice(users)
        at = dt.datetime.combine(days(day), dt.time(dice.randrange(24), dice.randrange(2)))
        ends.append((f"s{i}", False, days(day), f"s{i}", user, at))
    for i in range(150):
        clean.append((dice.choice(users), days(dice.randrange(20)), dice.randrange(8), 1, "Si", i))
    return (
        spark.createDataFrame(ends, "_sk string, _sn boolean, message_date date, session_id string, id string, fecha_fin timestamp"),
        spark.createDataFrame(clean, "id string, Fecha date, eval_ia int, eval_acceso int, resolucion string, event_id bigint"),
    )


def table(df):
    return {(r["_sk"], r["message_date"]): tuple(r[c] for c in ("orden_conv", "orden_enc", "fecha_encuesta", "eval_ia", "eval_acceso", "resolucion")) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_windows_give_the_pairs_of_one_run(spark, seed):
    ends, clean = inputs(spark, seed)
    whole = table(dashboard.fifo_pairs(ends, clean))
    ledger = FifoLedger(TableStore(spark), f"t_{uuid.uuid4().hex[:10]}")
    stored, restarted = {}, 0
    # (first day of the lookback, first day not seen yet)
    for start, end in ((0, 8), (4, 13), (4, 13), (9, 17), (16, 20)):
        ledger.advance(ends.where(F.col("message_date") < F.lit(days(end))), clean.where(F.col("Fecha") < F.lit(days(end))), days(start))
        window = [df.where((F.col(c) >= F.lit(days(start))) & (F.col(c) < F.lit(days(end)))) for df, c in ((ends, "message_date"), (clean, "Fecha"))]
        stored |= table(ledger.pairs(*window))
        if start:
            plain = table(dashboard.fifo_pairs(*window))
            restarted += sum(whole[k] != v for k, v in plain.items())
    assert stored == whole
    assert restarted > 0  # without the ledger, the numbers start anew at the edge
    ledger.drop()


def test_the_state_is_small_and_closed_days_are_counted_once(spark):
    ends, clean = inputs(spark, 3)
    ledger = FifoLedger(TableStore(spark), f"t_{uuid.uuid4().hex[:10]}")
    assert ledger.closed_before() is None
    for until in (5, 9, 9, 3):
        ledger.advance(ends, clean, days(until))
    assert ledger.closed_before() == days(9)
    state = spark.table(ledger.tdef().full_name)
    seen = {(r["id"], r["_side"]): r["_n"] for r in state.where("kind = 'seen'").collect()}
    closed = ends.where(F.col("message_date") < F.lit(days(9)))
    assert seen[("a", "c")] == closed.where("id = 'a'").count() and seen[(None, "c")] == closed.where("id is null").count()
    surveys = clean.where(F.col("Fecha") < F.lit(days(9)))
    for user in ("a", "b", "c"):
        waiting = state.where((F.col("kind") == "waiting") & (F.col("id") == user)).count()
        assert waiting == abs(closed.where(F.col("id") == user).count() - surveys.where(F.col("id") == user).count())
    assert state.where("kind = 'waiting' and id is null").count() == 0
    ledger.drop()


def test_dashboard_with_a_ledger(spark):
    """The dashboard of a later lookback, with the ledger, has the rows of the whole dashboard."""
    msgs, answers = fx.messages(spark, SF), fx.surveys(spark, SF)
    whole = dashboard.dashboard_base(msgs, answers, AS_OF, DAYS)
    first = whole.agg(F.min("message_date")).first()[0] + dt.timedelta(days=1)
    ledger = FifoLedger(TableStore(spark), f"t_{uuid.uuid4().hex[:10]}")
    dated = messages.with_message_date(msgs)
    from cxlake.operators.surveys import clean_surveys

    ends = sessions.session_metrics(dated, keep_join_key=True).select(*sessions.JOIN_KEY, "session_id", "id", "fecha_fin")
    ledger.advance(ends, clean_surveys(answers, AS_OF, DAYS), first)
    back = (dt.date.fromisoformat(AS_OF) - first).days
    recent = dashboard.dashboard_base(msgs, answers, AS_OF, back, fifo=ledger.pairs)
    columns = [c for c in recent.columns if c != "isn"]  # the index is a day's own
    want = whole.where(F.col("message_date") >= F.lit(first)).select(*columns)
    assert sorted(recent.select(*columns).collect(), key=str) == sorted(want.collect(), key=str) and want.count() > 0
    ledger.drop()
