"""Mart building blocks: weighted standings, share of total, headcount and
breadth, rate per hundred, and conditional counts.

Each takes the column names it works on, so the same operator serves any
dataset shaped like the reference's marts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import percent, row_total, weighted_sum
from tierline.operators.ranking import RankSpec, global_ranks

# Fixed values that must equal the reference's: medal weights.
MEDAL_WEIGHTS = {"gold": 3, "silver": 2, "bronze": 1}


def conditional_counts(
    df: DataFrame, keys: Sequence[str], conditions: Mapping[str, Column]
) -> DataFrame:
    """One ``count_if`` column per condition, grouped by ``keys`` (partial
    aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(
        *[F.count_if(cond).alias(name) for name, cond in conditions.items()]
    )


def weighted_standings(
    df: DataFrame,
    key: str,
    weights: Mapping[str, int] = MEDAL_WEIGHTS,
    *,
    total_name: str = "total_medals",
    points_name: str = "medal_points",
    rank_points_name: str = "rank_by_points",
    rank_total_name: str = "rank_by_total_medals",
    materialize: bool = True,
) -> DataFrame:
    """Weighted score, row total and two independent global RANKs (both descending).

    Scores, totals and ranks are bigint (no ANSI overflow); a NULL
    part makes score and total NULL, which rank last. The scored table (one
    row per key, usually the result of an aggregation) is written once to the
    shared folder before ranking (``materialize``), so the upstream plan runs
    once, not once per rank pass.
    """
    parts = list(weights)
    scored = df.select(
        F.col(f"`{key}`"),
        *[F.col(p) for p in parts],
        row_total(parts).alias(total_name),
        weighted_sum(weights).alias(points_name),
    )
    return global_ranks(
        scored,
        [RankSpec(points_name, rank_points_name), RankSpec(total_name, rank_total_name)],
        materialize=materialize,
    )


def share_of_total(
    df: DataFrame,
    parts: Sequence[str],
    total: str,
    *,
    suffix: str = "_pct",
    digits: int = 2,
) -> DataFrame:
    """Add ``<part><suffix> = round(part / total * 100, digits)``; NULL when total is 0.

    The denominator is the supplied ``total`` column, not the sum of parts.
    """
    return df.withColumns({f"{p}{suffix}": percent(p, total, digits) for p in parts})


def headcount_and_breadth(
    df: DataFrame,
    key: str,
    distinct_col: str,
    *,
    count_name: str = "row_count",
    distinct_name: str = "distinct_count",
    approx_rsd: float | None = None,
) -> DataFrame:
    """Rows per key and distinct count of ``distinct_col`` (NULL not counted).

    Exact by default: Catalyst plans the distinct as a two-level aggregate,
    first on (key, value), then on key, so a key with many values is spread
    over tasks before the final count. ``approx_rsd`` (e.g. 0.02) switches to
    a HyperLogLog sketch per key, with no shuffle of the values; the count
    is then approximate (bigint, relative standard error ``approx_rsd``).
    """
    value = F.col(f"`{distinct_col}`")
    distinct = (
        F.count_distinct(value)
        if approx_rsd is None
        else F.approx_count_distinct(value, float(approx_rsd))
    )
    return df.groupBy(F.col(f"`{key}`")).agg(
        F.count(F.lit(1)).alias(count_name), distinct.alias(distinct_name)
    )


def rate_per_100(
    base: DataFrame,
    measure: DataFrame,
    key: str,
    measure_col: str,
    *,
    count_name: str,
    rate_name: str,
    base_weight: str | None = None,
    digits: int = 2,
) -> DataFrame:
    """Rows of ``base`` per key, left-joined to ``measure`` summed per key.

    Keys of ``base`` without a measure get 0; keys only in ``measure`` are
    dropped. The measure is aggregated per key first, so the join can never
    fan out. Both sides are aggregates on the same key, so the join reuses
    their hash partitioning (or is broadcast when adaptive execution
    measures one side small). When ``base`` is already reduced (one row per
    finer key with a row count in ``base_weight``), the counts are summed
    instead of counted.
    """
    base_count = F.count(F.lit(1)) if base_weight is None else F.sum(F.col(f"`{base_weight}`"))
    counts = base.groupBy(F.col(f"`{key}`")).agg(base_count.alias(count_name))
    totals = measure.groupBy(F.col(f"`{key}`")).agg(
        F.sum(F.col(f"`{measure_col}`")).alias(measure_col)
    )
    joined = counts.join(totals, on=key, how="left").fillna({measure_col: 0})
    return joined.withColumn(rate_name, percent(measure_col, count_name, digits)).select(
        key, count_name, measure_col, rate_name
    )
