"""Time design alternatives side by side.

* fused audit (one aggregate per table) vs one action per rule;
* scale-safe global rank vs the single-partition window;
* min(struct) de-duplication vs dropDuplicates.

Usage: python tools/compare_strategies.py [/root/testdata/sf0.1]
Prints one JSON line of best-of-3 seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def best_of(fn, n=3):
    runs = []
    for _ in range(n):
        start = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - start)
    return round(min(runs), 3)


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

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "16")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    rules = [
        ColumnsExist(["l_orderkey", "l_linenumber", "l_quantity"]),
        NotNull(["l_orderkey", "l_linenumber"]),
        MinRowCount(1000),
        Unique(["l_orderkey", "l_linenumber"]),
        NonNegative(["l_quantity", "l_extendedprice"]),
    ]

    def fused():
        ValidationSuite("lineitem", rules).run(li, fail_fast=False)

    def per_rule():
        # One action per rule (and two for Unique), as a rule-by-rule gate runs.
        li.select([F.sum(F.col(c).isNull().cast("int")) for c in ("l_orderkey", "l_linenumber")]).first()
        li.count()
        li.count()
        li.select("l_orderkey", "l_linenumber").distinct().count()
        li.filter((F.col("l_quantity") < 0) | (F.col("l_extendedprice") < 0)).count()

    price = li.select("l_orderkey", "l_linenumber", "l_extendedprice")

    def ranged():
        global_rank(price, "l_extendedprice", "r").write.format("noop").mode(
            "overwrite"
        ).save()

    def single_window():
        price.withColumn("r", F.rank().over(Window.orderBy(F.col("l_extendedprice").desc()))).write.format(
            "noop"
        ).mode("overwrite").save()

    keys = ["l_orderkey", "l_linenumber"]

    def min_struct():
        dedupe(li, keys).write.format("noop").mode("overwrite").save()

    def drop_dups():
        li.dropDuplicates(keys).write.format("noop").mode("overwrite").save()

    for warm in (fused, per_rule, ranged, single_window, min_struct, drop_dups):
        warm()
    out = {
        "sf_dir": sf,
        "audit_fused": best_of(fused),
        "audit_one_action_per_rule": best_of(per_rule),
        "rank_scale_safe": best_of(ranged),
        "rank_single_partition_window": best_of(single_window),
        "dedupe_min_struct": best_of(min_struct),
        "dedupe_dropDuplicates": best_of(drop_dups),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
