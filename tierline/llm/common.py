"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tierline.session import scratch_path

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of ``text`` in order; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words as a bigint, 0 for null."""
    return F.size(words(text)).cast("bigint")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage without keeping anything on executors, and gives Spark the
    true size of small tables, so that it broadcasts only what is small. The
    shuffle files of the write go at its end, so disk holds one step's at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``_n``: its rows counted from 1 in this order, without sorting them in one task.

    Range-partitioned and sorted rows are stored with their place in their
    partition; only one row per partition is needed to know where each begins.
    """
    place = F.monotonically_increasing_id()  # partition number in the upper 31 bits, place in the lower 33
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    table = stored(ranged, "numbered").withColumn("_part", F.shiftright("_place", 33))
    sizes = table.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = F.col("_place").bitwiseAND(F.lit(2**33 - 1))
    return table.join(starts, "_part").withColumn("_n", F.col("_start") + within + 1).drop("_place", "_part", "_start")


def attach(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row per ``key``; left join), however many rows share a key.

    ``weight`` is the number of rows of each key. A key with at least a quarter of a task's even share is heavy; there
    are at most four such keys per shuffle partition, so their table is small and goes to all tasks. Their rows are
    spread by a number of their own in the join with the rest of the table, which they don't match.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = stored(table, "attach")
    total = table.agg(F.sum(weight)).first()[0] or 0
    is_heavy = F.col(weight) * F.lit(4 * parts) >= F.lit(total)
    found = [c for c in table.columns if c not in (key, weight)]
    heavy = table.where(is_heavy).select(F.col(key).alias("_heavy"), *(F.col(c).alias(f"_heavy_{c}") for c in found))
    spread = F.when(F.col("_heavy").isNull(), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    dealt = rows.join(F.broadcast(heavy), F.col(key) == F.col("_heavy"), "left").withColumn("_spread", spread)
    light = table.where(~is_heavy).drop(weight).withColumn("_spread", F.lit(0).cast("bigint"))
    joined = dealt.join(light, [key, "_spread"], "left")
    either = [F.when(F.col("_heavy").isNull(), F.col(c)).otherwise(F.col(f"_heavy_{c}")).alias(c) for c in found]
    return joined.select(*rows.columns, *either)
