"""Global ranking and top-k without funnelling every row through one task.

``rank() OVER (ORDER BY score)`` with no partition key moves all rows into one
task. :func:`global_ranks` takes one path for every size, every orderable type and
any number of ranks:

1. One aggregate counts the rows of every distinct score of every rank: the input is
   read once and partial aggregation collapses a score that most rows share. NULL and
   NaN are scores like any other.
2. This long table ``(rank, score, count)``, range-partitioned and sorted once for all
   ranks, is stored in the shared scratch folder with the range that each score fell
   into. One row per range is enough to know how many rows come before it; a running
   sum inside each range does the rest.
3. The rank is joined back by score. A score with at least a quarter of a task's even
   share of the rows is heavy; there can be at most four per shuffle partition. Heavy
   scores form a small table that goes to all tasks, and their rows are spread by a
   number of their own in the join with the other scores, which they don't match, so the
   rows are read once. If no more scores than that exist, all are in the small table and
   the rows are not shuffled at all; if none is heavy, there is only the second join.

Building the frame runs the jobs of steps 1 and 2; step 3 is lazy. Ordering follows
Spark/SQL: descending puts NaN first and NULL last, ascending NULL first and NaN last.
Ties share a rank and leave gaps, as ``RANK`` does. Ranks are ``bigint``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tierline.session import stored

HEAVY_PER_TASK = 4  # heavy scores for each shuffle partition, at most
SMALL_TABLE = 1_000  # so many scores are always few


@dataclass(frozen=True)
class RankSpec:
    """Rank ``column`` into a new column ``name``."""

    column: str
    name: str
    ascending: bool = False


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def global_rank(df: DataFrame, column: str, name: str, *, ascending: bool = False) -> DataFrame:
    """Add ``name`` = RANK() over the whole table ordered by ``column``."""
    return global_ranks(df, [RankSpec(column, name, ascending)])


def global_ranks(df: DataFrame, ranks: Sequence[RankSpec], *, materialize: bool = False) -> DataFrame:
    """Add one RANK column per spec.

    The input is read once for all scores and once for its rows. For an input that is
    expensive to recompute (an aggregate, a join), set ``materialize=True``: it is first
    written once to the shared scratch folder, and a lost executor costs a re-read, not a
    recomputation.
    """
    if not ranks:
        return df
    out = stored(df, "rank-input") if materialize else df
    scores, sizes = _score_table(out, ranks)
    share = HEAVY_PER_TASK * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for i, spec in enumerate(ranks):
        n_scores, n_rows, most = (sizes[f"{what}{i}"] or 0 for what in ("scores", "rows", "most"))
        if n_scores <= max(SMALL_TABLE, share):
            out = _joined(out, spec, small=_few_ranked(scores, i))
        elif most * share < n_rows:
            out = _joined(out, spec, large=_ranked(scores, i))
        else:
            table = stored(_ranked(scores, i), "rank-table")
            is_heavy = F.col("_n") * F.lit(share) >= F.lit(n_rows)
            out = _joined(out, spec, small=table.where(is_heavy), large=table.where(~is_heavy))
    return out.select(*[_c(c) for c in df.columns], *[_c(r.name) for r in ranks])


def _score_table(df: DataFrame, ranks: Sequence[RankSpec]) -> tuple[DataFrame, dict[str, int]]:
    """_rank_no, _s0, _s1, ... (only that of the rank is set), _n, _range, _place: one row per rank and distinct score.
    And of each rank the number of scores, of rows, and of rows of one score at most, observed while it is written."""
    kinds = [df.select(_c(r.column)).schema[0].dataType for r in ranks]
    entries = [
        F.struct(
            F.lit(i).alias("_rank_no"),
            *((_c(r.column) if i == j else F.lit(None).cast(kind)).alias(f"_s{j}") for j, kind in enumerate(kinds)),
        )
        for i, r in enumerate(ranks)
    ]
    names = ["_rank_no", *(f"_s{j}" for j in range(len(ranks)))]
    if len(ranks) == 1:
        long = df.select(F.lit(0).alias("_rank_no"), _c(ranks[0].column).alias("_s0"))
    else:
        long = df.select(F.inline(F.array(*entries)))
    counts = long.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.col("_rank_no")]
    order += [F.col(f"_s{j}").asc_nulls_first() if r.ascending else F.col(f"_s{j}").desc_nulls_last() for j, r in enumerate(ranks)]
    # The id holds the range (upper 31 bits) and the place in it (lower 33).
    ranged = counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    sizes = []
    for i in range(len(ranks)):
        n = F.when(F.col("_rank_no") == i, F.col("_n"))
        sizes += [F.count(n).alias(f"scores{i}"), F.sum(n).alias(f"rows{i}"), F.max(n).alias(f"most{i}")]
    seen = Observation()
    table = stored(ranged.observe(seen, *sizes), "rank-scores").withColumn("_range", F.shiftright("_place", 33))
    return table, seen.get


def _few_ranked(scores: DataFrame, i: int) -> DataFrame:
    """_score, _rank of one rank that has few scores: one small window."""
    before = Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    table = scores.where(F.col("_rank_no") == i)
    return table.select(F.col(f"_s{i}").alias("_score"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).alias("_rank"))


def _ranked(scores: DataFrame, i: int) -> DataFrame:
    """_score, _n (its rows), _rank of one rank."""
    table = scores.where(F.col("_rank_no") == i).select(F.col(f"_s{i}").alias("_score"), "_n", "_range", "_place")
    before_range = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = table.groupBy("_range").agg(F.sum("_n").alias("_rows"))
    starts = starts.select("_range", F.coalesce(F.sum("_rows").over(before_range), F.lit(0)).alias("_start"))
    before = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    within = table.withColumn("_within", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return within.join(starts, "_range").select("_score", "_n", (F.col("_start") + F.col("_within") + 1).alias("_rank"))


def _joined(df: DataFrame, spec: RankSpec, *, small: DataFrame | None = None, large: DataFrame | None = None) -> DataFrame:
    score = _c(spec.column)
    if small is not None:
        # At most max(SMALL_TABLE, HEAVY_PER_TASK x partitions) rows.
        small = F.broadcast(small.select(F.col("_score").alias("_heavy"), F.col("_rank").alias("_heavy_rank")))
        df = df.join(small, score.eqNullSafe(F.col("_heavy")), "left").drop("_heavy")
        if large is None:
            return df.withColumnRenamed("_heavy_rank", spec.name)
        spread = F.when(F.col("_heavy_rank").isNull(), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
        df = df.withColumn("_spread", spread)
        large = large.withColumn("_none", F.lit(0).cast("bigint"))
        met = score.eqNullSafe(F.col("_score")) & (F.col("_spread") == F.col("_none"))
        found = df.join(large.drop("_n"), met, "left")
        return found.withColumn(spec.name, F.coalesce("_heavy_rank", "_rank")).drop("_score", "_rank", "_heavy_rank", "_spread", "_none")
    return df.join(large.select("_score", F.col("_rank").alias(spec.name)), score.eqNullSafe(F.col("_score"))).drop("_score")


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order_by``; each task keeps its own top ``k``
    before one merge (``TakeOrderedAndProject``), so no full sort runs."""
    return df.orderBy(*order_by).limit(int(k))
