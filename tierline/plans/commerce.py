"""A second dataset family for the layer jobs: the order/supplier tables.

Raw CSVs of nation, customer, supplier and lineitem go through the same
bronze -> silver -> gold jobs as the medal-table sources. Return flags play the
part of medals (R/A/N as gold/silver/bronze per supplier country), customers
the part of athletes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from tierline.operators.measures import conditional_counts, rate_per_100, weighted_standings
from tierline.operators.quality import ColumnsExist, MinRowCount, NonNegative, NotNull, Unique
from tierline.plans.specs import DatasetSpec


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


_S, _I, _L, _D, _T = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType()

RAW_SCHEMAS: dict[str, StructType] = {
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(
        ("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S)
    ),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "lineitem": _schema(
        ("l_orderkey", _L),
        ("l_partkey", _L),
        ("l_suppkey", _L),
        ("l_linenumber", _I),
        ("l_quantity", _D),
        ("l_extendedprice", _D),
        ("l_discount", _D),
        ("l_tax", _D),
        ("l_returnflag", _S),
        ("l_linestatus", _S),
        ("l_shipdate", _T),
    ),
}

COMMERCE_SPECS: dict[str, DatasetSpec] = {
    "nation": DatasetSpec(
        name="nation",
        file="nation.csv",
        encoding="ISO-8859-1",
        schema=RAW_SCHEMAS["nation"],
        renames={"n_nationkey": "nation_key", "n_name": "country", "n_regionkey": "region_key"},
        required=("nation_key", "country"),
        keys=("nation_key",),
        rules=lambda: [
            ColumnsExist(["nation_key", "country"]),
            NotNull(["nation_key", "country"]),
            Unique(["nation_key"]),
        ],
    ),
    "customer": DatasetSpec(
        name="customer",
        file="customer.csv",
        schema=RAW_SCHEMAS["customer"],
        renames={
            "c_custkey": "cust_key",
            "c_name": "name",
            "c_nationkey": "nation_key",
            "c_acctbal": "balance",
            "c_mktsegment": "segment",
        },
        required=("cust_key", "nation_key"),
        keys=("cust_key",),
        rules=lambda: [
            ColumnsExist(["cust_key", "nation_key"]),
            NotNull(["cust_key", "nation_key"]),
            MinRowCount(1),
            Unique(["cust_key"]),
            # Customers in debt are legitimate: reported, never blocking.
            NonNegative(["balance"], critical=False),
        ],
    ),
    "supplier": DatasetSpec(
        name="supplier",
        file="supplier.csv",
        schema=RAW_SCHEMAS["supplier"],
        renames={"s_suppkey": "supp_key", "s_name": "name", "s_nationkey": "nation_key", "s_acctbal": "balance"},
        required=("supp_key", "nation_key"),
        keys=("supp_key",),
        rules=lambda: [ColumnsExist(["supp_key", "nation_key"]), Unique(["supp_key"])],
    ),
    "lineitem": DatasetSpec(
        name="lineitem",
        file="lineitem.csv",
        schema=RAW_SCHEMAS["lineitem"],
        renames={
            "l_orderkey": "order_key",
            "l_partkey": "part_key",
            "l_suppkey": "supp_key",
            "l_linenumber": "line_number",
            "l_quantity": "quantity",
            "l_extendedprice": "price",
            "l_discount": "discount",
            "l_tax": "tax",
            "l_returnflag": "return_flag",
            "l_linestatus": "line_status",
            "l_shipdate": "ship_date",
        },
        required=("order_key", "line_number"),
        keys=("order_key", "line_number"),
        zero_fill=("quantity",),
        rules=lambda: [
            NotNull(["order_key", "line_number"]),
            NonNegative(["quantity", "price"]),
            Unique(["order_key", "line_number"]),
        ],
    ),
}

FLAG_MEDALS = {"gold": "R", "silver": "A", "bronze": "N"}


def flag_medals_by_country(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Per supplier country: line items with flag R, A, N as gold, silver, bronze.

    Line items are first reduced to one row per supplier (partial aggregation
    before any shuffle), so the joins see suppliers, not line items.
    """
    per_supplier = conditional_counts(
        silver["lineitem"],
        ["supp_key"],
        {medal: F.col("return_flag") == F.lit(flag) for medal, flag in FLAG_MEDALS.items()},
    )
    suppliers = silver["supplier"].select("supp_key", "nation_key")
    nations = silver["nation"].select("nation_key", "country")
    return (
        per_supplier.join(suppliers, "supp_key")
        .join(nations, "nation_key")
        .groupBy("country")
        .agg(*[F.sum(m).alias(m) for m in FLAG_MEDALS])
    )


def supplier_standings(silver: Mapping[str, DataFrame]) -> DataFrame:
    return weighted_standings(flag_medals_by_country(silver), "country")


def customer_reach(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Flag medals per 100 customers of the same country (0 when the country has none)."""
    # Customers are counted per nation key before the nation join (one row per nation).
    customers = (
        silver["customer"]
        .groupBy("nation_key")
        .agg(F.count(F.lit(1)).alias("_customers"))
        .join(silver["nation"].select("nation_key", "country"), "nation_key")
    )
    medals = flag_medals_by_country(silver).select(
        "country", (F.col("gold") + F.col("silver") + F.col("bronze")).alias("total_medals")
    )
    return rate_per_100(
        customers,
        medals,
        "country",
        "total_medals",
        count_name="customer_count",
        rate_name="medals_per_100_customers",
        base_weight="_customers",
    )


COMMERCE_MARTS: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "supplier_standings": supplier_standings,
    "customer_reach": customer_reach,
}
