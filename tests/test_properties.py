"""Property tests against brute-force Python versions of the operators."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from cxlake.operators.merge import merge_frames
from cxlake.operators.ranking import ordered_numbers

SCHEMA = "k STRING, m STRING, v BIGINT"
KEYS = ("k", "m")
rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(["1", "2", None]), st.integers(0, 9)),
    max_size=12,
)


class Duplicate(Exception):
    pass


def brute_merge(target, source):
    key = lambda r: (r[0], r[1])
    by_key = defaultdict(list)
    for s in source:
        if None not in key(s):
            by_key[key(s)].append(s)
    target_keys = {key(t) for t in target if None not in key(t)}
    out = []
    for t in target:
        k = key(t)
        if None in k or k not in by_key:
            out.append(t)
        elif len(by_key[k]) > 1:
            raise Duplicate
        else:
            out.append(by_key[k][0])
    out += [s for s in source if None in key(s) or key(s) not in target_keys]
    return sorted(out, key=str)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, source=rows)
def test_merge_matches_brute_force(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    try:
        want = brute_merge(target, source)
    except Duplicate:
        with pytest.raises(PySparkException):
            merge_frames(t, s, KEYS).collect()
        return
    got = sorted((tuple(r) for r in merge_frames(t, s, KEYS).collect()), key=str)
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(-3, 3)), min_size=1, max_size=40),
)
def test_ordered_numbers_match_window(spark, data):
    df = spark.createDataFrame([(g, x, i) for i, (g, x) in enumerate(data)], "g STRING, x INT, i INT")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("x", "i")))
    got = ordered_numbers(df, ["g"], ["x", "i"], "n")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
