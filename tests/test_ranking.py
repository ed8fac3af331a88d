"""Ordered numbers equal the plain window, also for hot and NULL groups and hot days."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cxlake.operators.ranking import in_ranges, ordered_numbers


def test_matches_plain_window_with_hot_and_null_groups(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else rnd.choice(["a", "b", None, "c"])
        if i % 5 == 0:
            g = None  # a large NULL group
        rows.append((g, rnd.randint(0, 50) if i % 11 else None, f"t{rnd.randint(0, 9)}", i))
    df = spark.createDataFrame(rows, "g STRING, ts INT, t2 STRING, uid BIGINT")
    order = ["ts", "t2", "uid"]
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    got = ordered_numbers(df, ["g"], order, "n")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_small_and_empty_inputs(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "g STRING, ts INT")
    got = {(r["g"], r["ts"]): r["n"] for r in ordered_numbers(df, ["g"], ["ts"], "n").collect()}
    assert got == {("a", 1): 1, ("a", 2): 2, ("b", 5): 1}
    assert ordered_numbers(df.limit(0), ["g"], ["ts"], "n").count() == 0


def test_one_id_with_a_third_of_the_surveys_on_one_day(spark):
    """A hot id is spread over ranges even when all its rows have one date."""
    rows = [(f"u{i % 40}" if i % 3 else "hot", "2024-01-05" if i % 3 == 0 else f"2024-01-{i % 28 + 1:02d}", i) for i in range(4000)]
    df = spark.createDataFrame(rows, "id STRING, f STRING, event_id BIGINT").select("id", F.to_date("f").alias("Fecha"), "event_id")
    ranged = in_ranges(df, ["id"], ["Fecha", "event_id"])
    assert ranged.where("id = 'hot'").select("_range").distinct().count() > 1
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy("Fecha", "event_id")))
    got = ordered_numbers(df, ["id"], ["Fecha", "event_id"], "n")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
