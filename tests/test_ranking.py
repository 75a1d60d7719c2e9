"""Global rank: every execution path must equal Spark's single-partition RANK()."""

from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.operators import ranking
from tierline.operators.ranking import RankSpec, global_rank, global_ranks, top_k



def _check(df, column, *, ascending=False):
    df = df.withColumn("_id", F.monotonically_increasing_id()).persist()
    ranked = global_rank(df, column, "r", ascending=ascending)
    order = F.col(column).asc_nulls_first() if ascending else F.col(column).desc_nulls_last()
    expected = df.select("_id", F.rank().over(Window.orderBy(order)).alias("e"))
    assert {r["_id"]: r["r"] for r in ranked.collect()} == {r["_id"]: r["e"] for r in expected.collect()}
    assert dict(ranked.dtypes)["r"] == "bigint" and ranked.columns == [*df.columns, "r"]


def _scores(spark, values, dtype="double"):
    return spark.createDataFrame([(v,) for v in values], f"s {dtype}").repartition(3)


@pytest.mark.parametrize("ascending", [False, True])
@pytest.mark.parametrize("small, heavy", [(10_000, 4), (1, 4), (1, 0)])  # few scores; some heavy ones; none
def test_doubles_with_special_values(spark, monkeypatch, ascending, small, heavy):
    monkeypatch.setattr(ranking, "SMALL_TABLE", small)
    monkeypatch.setattr(ranking, "HEAVY_PER_TASK", heavy)
    rnd = random.Random(2)
    values = [rnd.uniform(-1000, 1000) for _ in range(1500)] + [42.0] * 800
    values += [None] * 11 + [float("nan")] * 5 + [math.inf, -math.inf, 0.0, -0.0, -0.0]
    _check(_scores(spark, values), "s", ascending=ascending)


def test_longs_beyond_double_precision(spark):
    base = 2**60
    _check(_scores(spark, [base + i for i in range(900)] + [base + 7] * 400 + [None], "bigint"), "s")


def test_wide_decimals(spark):
    values = [Decimal(10**17 + i) / 100 for i in range(300)] + [Decimal("3.14")] * 200
    _check(_scores(spark, values, "decimal(20,2)"), "s")


@pytest.mark.parametrize("ascending", [False, True])
def test_strings_and_timestamps(spark, ascending):
    df = spark.range(2000).select(F.concat(F.lit("k"), F.pmod(F.hash("id"), F.lit(900))).alias("s"), F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(700))).alias("t"))
    df = df.union(spark.sql("SELECT CAST(NULL AS STRING), CAST(NULL AS TIMESTAMP)"))
    _check(df.select("s"), "s", ascending=ascending)
    _check(df.select("t"), "t", ascending=ascending)


def test_two_ranks(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.randint(0, 3000), rnd.randint(0, 5), {"m": {"x": 1}}) for _ in range(2500)], "a int, b int, m map<string,map<string,int>>")
    for materialize in (False, True):
        out = global_ranks(df, [RankSpec("a", "ra"), RankSpec("b", "rb", ascending=True)], materialize=materialize)
        expected = df.withColumns({"ra": F.rank().over(Window.orderBy(F.col("a").desc())), "rb": F.rank().over(Window.orderBy("b"))})
        assert sorted((r.a, r.b, r.ra, r.rb) for r in out.collect()) == sorted((r.a, r.b, r.ra, r.rb) for r in expected.collect())


def test_ranks_of_several_types_share_one_table(spark, monkeypatch):
    """Each of the three ways to join, in one call, over text, timestamps and numbers with nulls."""
    monkeypatch.setattr(ranking, "SMALL_TABLE", 40)
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 9)).alias("few"),
        F.timestamp_seconds(F.col("id")).alias("none_heavy"),
        F.when(F.col("id") % 3 == 0, F.lit(1.5)).otherwise(F.pmod(F.hash("id"), F.lit(800)) / 4).alias("some_heavy"),
    )
    ranks = [RankSpec("few", "r0", ascending=True), RankSpec("none_heavy", "r1"), RankSpec("some_heavy", "r2")]
    want = df.withColumns(
        {
            "r0": F.rank().over(Window.orderBy(F.col("few").asc_nulls_first())),
            "r1": F.rank().over(Window.orderBy(F.col("none_heavy").desc())),
            "r2": F.rank().over(Window.orderBy(F.col("some_heavy").desc())),
        }
    )
    key = lambda r: str(tuple(r))
    assert sorted(map(key, global_ranks(df, ranks).collect())) == sorted(map(key, want.collect()))


def test_empty_input(spark):
    assert global_rank(spark.createDataFrame([], "s double"), "s", "r").count() == 0


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(50)], "k int, v double")
    assert [r["k"] for r in top_k(df, [F.col("v").desc(), F.col("k").asc()], 4).collect()] == [4, 9, 14, 19]


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(20,2)", "string"])
def test_rows_of_a_hot_score_stay_where_they_are(spark, kind):
    """A third of the rows are identical; none of them moves to meet the others."""
    n = 9_000
    df = spark.range(0, n, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 10).cast(kind).alias("s"))
    ranked = global_rank(df, "s", "r")
    hot = ranked.where("s = cast(7 as STRING)" if kind == "string" else "s = 7")
    assert hot.agg(F.count_distinct("r")).first()[0] == 1
    sizes = [r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == n // 3 and max(sizes) <= n // 3 // 3
