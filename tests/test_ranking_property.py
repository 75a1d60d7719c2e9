"""Property test: any input, the distributed rank equals RANK()."""

from __future__ import annotations

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.operators.ranking import global_rank

# TIERLINE_RANK_EXAMPLES raises the number of generated cases for a longer run.
EXAMPLES = int(os.environ.get("TIERLINE_RANK_EXAMPLES", "12"))

scores = st.one_of(
    st.none(),
    st.sampled_from([0.0, -0.0, 1.5, -3.0, 1e300, float("nan"), float("inf")]),
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
    st.integers(min_value=-50, max_value=50).map(float),
)


@settings(
    max_examples=EXAMPLES,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(
    values=st.lists(scores, min_size=1, max_size=300),
    hot=st.one_of(st.none(), st.floats(min_value=-10, max_value=10, allow_nan=False)),
    ascending=st.booleans(),
)
def test_rank_matches_window(spark, values, hot, ascending):
    if hot is not None:
        values = values + [hot] * (len(values) // 2 + 1)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, s double")
    got = global_rank(df, "s", "r", ascending=ascending)
    order = F.col("s").asc_nulls_first() if ascending else F.col("s").desc_nulls_last()
    expected = df.withColumn("e", F.rank().over(Window.orderBy(order)))
    left = {r["id"]: r["r"] for r in got.collect()}
    right = {r["id"]: r["e"] for r in expected.collect()}
    assert left == right


@settings(
    max_examples=EXAMPLES,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
@given(
    values=st.lists(
        st.one_of(st.none(), st.integers(-30, 30), st.sampled_from([2**62, -(2**62), 2**53 + 1])),
        min_size=1,
        max_size=200,
    ),
    ascending=st.booleans(),
)
def test_rank_matches_window_on_bigint(spark, values, ascending):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, s bigint")
    got = global_rank(df, "s", "r", ascending=ascending)
    order = F.col("s").asc_nulls_first() if ascending else F.col("s").desc_nulls_last()
    expected = df.withColumn("e", F.rank().over(Window.orderBy(order)))
    assert {r["id"]: r["r"] for r in got.collect()} == {r["id"]: r["e"] for r in expected.collect()}
