"""Invariants on the driver's tables (sf0.01)."""

from pyspark.sql import functions as F

from cxlake.operators import merge
from cxlake.operators.messages import lookback, with_message_date
from cxlake.plans import queries as Q
from cxlake.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def test_one_detail_row_per_ot(spark):
    d = Q.q_claim_detail(spark, SF)
    assert d.count() == d.select("OT").distinct().count() > 0


def test_dashboard_has_one_row_per_session_day(spark):
    base = Q.q_dashboard_base(spark, SF)
    msgs = with_message_date(lookback(fx.messages(spark, SF), "message_timestamp", Q.AS_OF, Q.DAYS))
    assert base.count() == msgs.select("session_id", "message_date").distinct().count()
    assert base.select("session_id", "message_date").distinct().count() == base.count()


def test_each_survey_matched_at_most_once(spark):
    base = Q.q_dashboard_base(spark, SF).where(F.col("orden_enc").isNotNull())
    assert base.groupBy("id", "orden_enc").count().where("count > 1").count() == 0
    # and a match always pairs equal ordinals
    assert base.where(F.col("orden_enc") != F.col("orden_conv")).count() == 0


def test_merging_the_same_load_twice_changes_nothing(spark):
    prev, cur = Q._loads(spark, SF)
    once = merge.merge_frames(prev, cur, ("Mes", "Clasificacion", "OT"))
    twice = merge.merge_frames(once, cur, ("Mes", "Clasificacion", "OT"))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
