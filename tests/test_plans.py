"""Plan-shape checks: partial aggregation before shuffles, pruning, pushdown."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tierline.operators.conform import dedupe
from tierline.operators.measures import conditional_counts, headcount_and_breadth
from tierline.operators.quality import NotNull, Unique, audit


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lineitem(spark):
    return spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")


def test_dedupe_keeps_one_row_per_key_before_the_shuffle(spark):
    plan = _plan(dedupe(_lineitem(spark), ["l_orderkey", "l_linenumber"]))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_conditional_counts_combine_map_side(spark):
    df = conditional_counts(_lineitem(spark), ["l_suppkey"], {"r": F.col("l_returnflag") == "R"})
    plan = _plan(df)
    assert "partial_count_if" in plan or "partial_count" in plan


def test_distinct_count_is_two_level(spark):
    plan = _plan(headcount_and_breadth(_lineitem(spark), "l_suppkey", "l_partkey"))
    assert "hashpartitioning(l_suppkey#" in plan
    assert plan.count("Exchange") >= 2  # (key, value) then key


def test_scans_are_pruned_and_filters_pushed(spark):
    from tierline.plans.queries import _flag_medals_per_nation

    plan = _plan(_flag_medals_per_nation(spark, SF_SMALL))
    assert "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string>" in plan
    plan = _plan(entry.queries()["rate_per_100"](spark, SF_SMALL))
    assert "LessThan(s_acctbal,0.0)" in plan


def test_audit_reads_each_table_once(spark):
    plan = _plan(entry.queries()["dq_report"](spark, SF_SMALL)).split("== Initial Plan ==")[0]
    tables = ("lineitem", "customer", "events", "part")
    assert [plan.count(f"/{t}.parquet") for t in tables[:3]] == [1, 1, 1]  # one scan each


def test_several_unique_rules_expand_no_rows(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    frame = audit(part, "part", [Unique(["p_partkey"]), Unique(["p_brand", "p_type"]), Unique([]), NotNull(["p_name"]), Unique(["p_size"])])
    plan = frame._jdf.queryExecution().toString()
    assert "Expand" not in plan
    n = part.count()
    surplus = [n - part.select(*c).distinct().count() for c in (["p_partkey"], ["p_brand", "p_type"])]
    assert [r.observed for r in frame.collect()] == [*map(str, surplus), str(n - 1), "{}", str(n - part.select("p_size").distinct().count())]
    assert [r.observed for r in audit(part.limit(0), "part", [Unique(["p_partkey"]), Unique(["p_size"])]).collect()] == ["0", "0"]
