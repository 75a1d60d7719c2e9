"""

A third of the rows share one score / one key. Prints, per check, the
seconds taken and the largest post-shuffle task, for tierline's plan and the
plain single-task alternative. Generated data is for these checks only; no
registered query uses it.

Usage: python tools/stress_checks.py [rows=20000000]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    from tierline.operators.conform import dedupe
    from tierline.operators.quality import (
        ColumnsExist,
        MinRowCount,
        NonNegative,
        NotNull,
        Unique,
        ValidationSuite,
    )
    from tierline.operators.ranking import global_rank
    from tierline.session import scratch_path

    n = int(sys.argv[1]) if len(sys.argv) > 1 else 20_000_000
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "16")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    out: dict[str, object] = {"rows": n}

    def largest_task(df) -> int:
        sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("c"))
        return sizes.agg(F.max("c")).first()[0]

    # Rank: a third of the rows share one score.
    scores = spark.range(0, n, 1, 32).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(500.0))
        .otherwise((F.hash("id") % 1_000_000).cast("double"))
        .alias("s"),
    )
    start = time.perf_counter()
    ranked = global_rank(scores, "s", "r")
    out["rank_scale_safe_largest_task"] = largest_task(ranked)
    out["rank_scale_safe_sec"] = round(time.perf_counter() - start, 1)
    start = time.perf_counter()
    window = scores.withColumn("r", F.rank().over(Window.orderBy(F.col("s").desc())))
    window.write.format("noop").mode("overwrite").save()
    out["rank_single_window_sec"] = round(time.perf_counter() - start, 1)
    out["rank_mismatches"] = (
        ranked.join(window.withColumnRenamed("r", "e").select("id", "e"), "id").where("r <> e").count()
    )

    # De-duplication: a third of the rows share one key.
    rows = spark.range(0, n, 1, 32).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % (n // 10)).alias("k"),
        (F.hash("id") % 1000).alias("a"),
        F.concat(F.lit("v"), (F.col("id") % 97).cast("string")).alias("b"),
    )
    start = time.perf_counter()
    dedupe(rows, ["k"]).write.format("noop").mode("overwrite").save()
    out["dedupe_min_struct_sec"] = round(time.perf_counter() - start, 1)
    w = Window.partitionBy("k").orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first())
    start = time.perf_counter()
    rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").write.format("noop").mode(
        "overwrite"
    ).save()
    out["dedupe_row_number_sec"] = round(time.perf_counter() - start, 1)
    out["dedupe_largest_task_without_combine"] = largest_task(rows.repartition(16, "k"))

    # Audit: fused aggregate vs one action per rule, on a written table.
    path = scratch_path(spark, "audit-stress")
    spark.range(0, n, 1, 32).select(
        (F.col("id") % (n // 2)).alias("k1"),
        (F.col("id") % 7).cast("int").alias("k2"),
        (F.hash("id") % 1000).cast("double").alias("q"),
        (F.hash("id") % 5000).cast("double").alias("p"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.lit("x")).alias("s"),
    ).write.parquet(path)
    table = spark.read.parquet(path)
    rules = [
        ColumnsExist(["k1", "k2", "q"]),
        NotNull(["k1", "s"]),
        MinRowCount(1000),
        Unique(["k1", "k2"]),
        NonNegative(["q", "p"]),
    ]

    def per_rule() -> None:
        table.select([F.sum(F.col(c).isNull().cast("int")) for c in ("k1", "s")]).first()
        table.count()
        table.count()
        table.select("k1", "k2").distinct().count()
        table.filter((F.col("q") < 0) | (F.col("p") < 0)).count()

    for label, run in (
        ("audit_fused_sec", lambda: ValidationSuite("t", rules).run(table, fail_fast=False)),
        ("audit_per_rule_sec", per_rule),
    ):
        run()  # warm
        start = time.perf_counter()
        run()
        out[label] = round(time.perf_counter() - start, 2)

    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
