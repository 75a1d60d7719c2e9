"""Registered queries over the driver tables, each with an equivalent SQL text.

Every query reads whole tables (no id subsets, no row caps; the only
``limit`` is the top-k feature itself). Output columns are aliased to the
same names on both sides. The SQL is plain ANSI as DuckDB runs it; where
Spark and DuckDB differ (regex classes, NULL ordering, integer widths) the
SQL spells out Spark's semantics.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tierline.functions.columns import ratio, to_int
from tierline.operators.conform import (
    clean_strings as clean_strings_op,
)
from tierline.operators.conform import (
    conform,
    dedupe,
    drop_null_keys,
    fill_zero,
    rename_columns,
    stamp_lineage,
)
from tierline.operators.measures import (
    conditional_counts,
    headcount_and_breadth,
    rate_per_100,
    share_of_total,
    weighted_standings,
)
from tierline.operators.quality import (
    ColumnsExist,
    MinRowCount,
    NonNegative,
    NotNull,
    Unique,
    audit,
)
from tierline.operators.ranking import RankSpec, global_rank, global_ranks, top_k
from tierline.plans import commerce
from tierline.plans.jobs import DEFAULT_CONCURRENT_JOBS, layer_path, run_all, run_concurrently
from tierline.session import scratch_path
from tierline.sources.tables import (
    export_csv,
    read_csv,
    read_csv_inferred,
    read_table,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Java's \s class, written out for DuckDB (whose \s lacks the vertical tab).
_WS = r"[ \t\n\x0B\f\r]+"


def _clean_sql(expr: str) -> str:
    return f"nullif(trim(regexp_replace({expr}, '{_WS}', ' ', 'g')), '')"


def register(name: str, sql: str | None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# Conform operators
# --------------------------------------------------------------------------


@register(
    "clean_strings",
    f"""
    SELECT doc_id, {_clean_sql('text')} AS text, {_clean_sql('lang')} AS lang,
           {_clean_sql('source')} AS source
    FROM documents
    """,
)
def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return clean_strings_op(docs)


_CUSTOMER_RENAMES = {
    "c_custkey": "customer_id",
    "c_name": "customer_name",
    "c_nationkey": "country_id",
    "c_acctbal": "balance",
    "c_mktsegment": "segment",
}


@register(
    "rename_columns",
    "SELECT "
    + ", ".join(f"{src} AS {dst}" for src, dst in _CUSTOMER_RENAMES.items())
    + " FROM customer",
)
def rename_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    # A name absent from the table is ignored, as a rename map may cover several layouts.
    return rename_columns(customer, {**_CUSTOMER_RENAMES, "c_comment": "comment"})


@register(
    "stamp_lineage",
    """
    SELECT *, 'orders.parquet' AS _source_file, true AS _ingested_at_set
    FROM orders
    """,
)
def stamp_lineage_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = stamp_lineage(table(spark, sf_dir, "orders"), "orders.parquet")
    return stamped.withColumn("_ingested_at_set", F.col("_ingested_at").isNotNull()).drop("_ingested_at")


@register(
    "fill_zero",
    """
    SELECT c_custkey,
           coalesce(nullif(c_nationkey, 0), 0) AS c_nationkey,
           coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS c_acctbal
    FROM customer
    """,
)
def fill_zero_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias("c_nationkey"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
    )
    return fill_zero(customer, ["c_nationkey", "c_acctbal"])


@register(
    "drop_null_keys",
    """
    SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, value
    FROM events
    WHERE nullif(event_type, 'error') IS NOT NULL
    """,
)
def drop_null_keys_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"), "value"
    )
    return drop_null_keys(events, ["event_type"])


_LINEITEM_COLS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]
_LINEITEM_NONKEY = [c for c in _LINEITEM_COLS if c not in ("l_orderkey", "l_linenumber")]


@register(
    "dedupe_by_key",
    f"""
    SELECT {', '.join(_LINEITEM_COLS)}
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _LINEITEM_NONKEY)}) = 1
    """,
)
def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select(*_LINEITEM_COLS)
    return dedupe(lineitem, ["l_orderkey", "l_linenumber"])


@register(
    "conform_entity",
    f"""
    WITH raw AS (
        SELECT c_custkey AS cust_key,
               {_clean_sql("'  ' || c_name || ' ' || chr(9) || ' '")} AS name,
               c_nationkey AS nation_key,
               coalesce(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS balance,
               {_clean_sql("nullif(c_mktsegment, 'BUILDING')")} AS segment
        FROM customer
    )
    SELECT cust_key, name, nation_key, balance, segment
    FROM raw
    WHERE segment IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY nation_key, segment
        ORDER BY cust_key ASC NULLS FIRST, name ASC NULLS FIRST, balance ASC NULLS FIRST) = 1
    """,
)
def conform_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustKey"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" \t ")).alias("Name"),
        F.col("c_nationkey").alias("NationKey"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("Balance"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("Segment"),
    )
    return conform(
        raw,
        renames={
            "CustKey": "cust_key",
            "Name": "name",
            "NationKey": "nation_key",
            "Balance": "balance",
            "Segment": "segment",
        },
        zero_fill=["balance"],
        required=["segment"],
        keys=["nation_key", "segment"],
    )


# --------------------------------------------------------------------------
# Marts and measures
# --------------------------------------------------------------------------


def _flag_medals_per_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R/A/N line items per supplier country, reduced per supplier before the joins."""
    per_supplier = conditional_counts(
        table(spark, sf_dir, "lineitem"),
        ["l_suppkey"],
        {m: F.col("l_returnflag") == F.lit(f) for m, f in commerce.FLAG_MEDALS.items()},
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return (
        per_supplier.join(supplier, per_supplier.l_suppkey == supplier.s_suppkey)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("country")
        .agg(*[F.sum(m).alias(m) for m in commerce.FLAG_MEDALS])
    )


_FLAG_MEDALS_SQL = """
    SELECT n_name AS country,
           CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS gold,
           CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS BIGINT) AS silver,
           CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS BIGINT) AS bronze
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_name
"""


@register(
    "weighted_standings",
    f"""
    WITH m AS ({_FLAG_MEDALS_SQL}),
    s AS (SELECT country, gold, silver, bronze,
                 gold + silver + bronze AS total_medals,
                 gold * 3 + silver * 2 + bronze AS medal_points
          FROM m)
    SELECT country, gold, silver, bronze, total_medals, medal_points,
           rank() OVER (ORDER BY medal_points DESC NULLS LAST) AS rank_by_points,
           rank() OVER (ORDER BY total_medals DESC NULLS LAST) AS rank_by_total_medals
    FROM s
    """,
)
def weighted_standings_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_standings(_flag_medals_per_nation(spark, sf_dir), "country")


@register(
    "global_rank_large",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice,
           rank() OVER (ORDER BY l_extendedprice DESC NULLS LAST) AS rank_by_price
    FROM lineitem
    """,
)
def global_rank_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return global_rank(lineitem, "l_extendedprice", "rank_by_price")


@register(
    "global_rank_text",
    """
    SELECT event_id, event_type, rank() OVER (ORDER BY event_type ASC NULLS FIRST) AS rank_by_type,
           rank() OVER (ORDER BY ts DESC NULLS LAST) AS rank_by_time
    FROM events
    """,
)
def global_rank_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of text (few, heavy values) and of timestamps."""
    events = table(spark, sf_dir, "events")
    ranks = [RankSpec("event_type", "rank_by_type", ascending=True), RankSpec("ts", "rank_by_time")]
    return global_ranks(events, ranks).select("event_id", "event_type", "rank_by_type", "rank_by_time")


def _status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditional_counts(
        table(spark, sf_dir, "orders"),
        ["o_custkey"],
        {
            "finished": F.col("o_orderstatus") == F.lit("F"),
            "open": F.col("o_orderstatus") == F.lit("O"),
        },
    )


_STATUS_SQL = """
    SELECT o_custkey,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS finished,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS BIGINT) AS open
    FROM orders GROUP BY o_custkey
"""


@register(
    "share_of_total",
    f"""
    WITH c AS ({_STATUS_SQL})
    SELECT o_custkey, finished, open, finished + open AS total,
           round(finished / nullif(finished + open, 0) * 100, 2) AS finished_pct,
           round(open / nullif(finished + open, 0) * 100, 2) AS open_pct
    FROM c
    """,
)
def share_of_total_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _status_counts(spark, sf_dir)
    with_total = counts.withColumn("total", F.col("finished") + F.col("open"))
    return share_of_total(with_total, ["finished", "open"], "total")


@register(
    "ratio_columns",
    f"""
    WITH c AS ({_STATUS_SQL}),
    t AS (SELECT o_custkey,
                 TRY_CAST(CAST(finished AS VARCHAR) AS INTEGER) AS finished,
                 TRY_CAST(CAST(open AS VARCHAR) AS INTEGER) AS open
          FROM c)
    SELECT o_custkey, finished, open, finished + open AS total,
           finished / nullif(finished + open, 0) AS finished_ratio,
           open / nullif(finished + open, 0) AS open_ratio
    FROM t
    """,
)
def ratio_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counts arrive as text (as from an untyped file) and are cast back leniently.
    as_text = _status_counts(spark, sf_dir).select(
        "o_custkey", F.col("finished").cast("string").alias("finished"), F.col("open").cast("string").alias("open")
    )
    typed = as_text.select("o_custkey", to_int("finished").alias("finished"), to_int("open").alias("open"))
    return typed.withColumn("total", F.col("finished") + F.col("open")).withColumns(
        {
            "finished_ratio": ratio("finished", "total"),
            "open_ratio": ratio("open", "total"),
        }
    )


@register(
    "headcount_and_breadth",
    """
    SELECT l_suppkey, count(*) AS line_count, count(DISTINCT l_partkey) AS distinct_parts
    FROM lineitem GROUP BY l_suppkey
    """,
)
def headcount_and_breadth_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headcount_and_breadth(
        table(spark, sf_dir, "lineitem"),
        "l_suppkey",
        "l_partkey",
        count_name="line_count",
        distinct_name="distinct_parts",
    )


@register(
    "rate_per_100",
    """
    WITH c AS (SELECT n_name AS country, count(*) AS customer_count
               FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
         s AS (SELECT n_name AS country, CAST(count(*) AS BIGINT) AS indebted_suppliers
               FROM supplier JOIN nation ON s_nationkey = n_nationkey
               WHERE s_acctbal < 0 GROUP BY n_name)
    SELECT c.country, c.customer_count,
           CAST(coalesce(s.indebted_suppliers, 0) AS BIGINT) AS indebted_suppliers,
           round(coalesce(s.indebted_suppliers, 0) / nullif(c.customer_count, 0) * 100, 2)
               AS indebted_suppliers_per_100_customers
    FROM c LEFT JOIN s ON c.country = s.country
    """,
)
def rate_per_100_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    # Both sides are reduced to one row per nation key before meeting the
    # nation table, so no join ever sees one row per customer or supplier.
    customers = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("_customers"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    indebted = (
        table(spark, sf_dir, "supplier")
        .where(F.col("s_acctbal") < 0)
        .groupBy("s_nationkey")
        .agg(F.count(F.lit(1)).alias("indebted_suppliers"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return rate_per_100(
        customers,
        indebted,
        "country",
        "indebted_suppliers",
        count_name="customer_count",
        rate_name="indebted_suppliers_per_100_customers",
        base_weight="_customers",
    )


@register(
    "top_k",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
    FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC LIMIT 20
    """,
)
def top_k_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return top_k(orders, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc()], 20)


# --------------------------------------------------------------------------
# Data quality
# --------------------------------------------------------------------------


def _dq_row(rule: str, dataset: str, passed: str, observed: str, detail: str, critical: bool = True) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{dataset}' AS dataset, {passed} AS passed, "
        f"{'true' if critical else 'false'} AS critical, {observed} AS observed, {detail} AS detail"
    )


def _num_rule(rule: str, dataset: str, value: str, test: str, suffix: str, source: str) -> str:
    return _dq_row(
        rule,
        dataset,
        f"(SELECT {value} {test} FROM {source})",
        f"(SELECT CAST({value} AS VARCHAR) FROM {source})",
        f"(SELECT CAST({value} AS VARCHAR) || '{suffix}' FROM {source})",
    )


def _columns_rule(dataset: str, columns: list[str], critical: bool = True) -> str:
    """ColumnsExist computed from the table's own column list."""
    wanted = ", ".join(f"'{c}'" for c in columns)
    lacking = (
        f"(SELECT coalesce(list(c ORDER BY i), []) FROM (SELECT unnest([{wanted}]) AS c, unnest(range({len(columns)})) AS i) "
        f"WHERE c NOT IN (SELECT column_name FROM information_schema.columns WHERE table_name = '{dataset}'))"
    )
    text = f"array_to_string({lacking}, ', ')"
    return _dq_row(
        "ColumnsExist",
        dataset,
        f"len({lacking}) = 0",
        f"CAST(to_json({lacking}) AS VARCHAR)",
        f"'columns not found: ' || CASE WHEN len({lacking}) = 0 THEN 'none' ELSE '[' || {text} || ']' END",
        critical,
    )


def _nulls_rule(dataset: str, columns: list[str]) -> str:
    """NotNull computed by counting."""
    pairs = [
        f"(SELECT CASE WHEN count(*) > count({c}) THEN '\"{c}\":' || (count(*) - count({c})) END FROM {dataset})" for c in columns
    ]
    found = f"concat_ws(',', {', '.join(pairs)})"
    observed = f"('{{' || {found} || '}}')"
    return _dq_row(
        "NotNull",
        dataset,
        f"{found} = ''",
        observed,
        f"'nulls by column: ' || CASE WHEN {found} = '' THEN 'none' ELSE {observed} END",
    )


_DQ_SQL = " UNION ALL ".join(
    [
        # lineitem
        _columns_rule("lineitem", ["l_orderkey", "l_linenumber", "l_quantity"]),
        _nulls_rule("lineitem", ["l_orderkey", "l_linenumber"]),
        _num_rule("MinRowCount", "lineitem", "count(*)", ">= 1000", " rows, wanted 1000", "lineitem"),
        _num_rule(
            "Unique",
            "lineitem",
            "count(*) - count(DISTINCT (l_orderkey, l_linenumber))",
            "= 0",
            " surplus rows for key [l_orderkey, l_linenumber]",
            "lineitem",
        ),
        _num_rule(
            "NonNegative",
            "lineitem",
            "count(*) FILTER (WHERE l_quantity < 0 OR l_extendedprice < 0)",
            "= 0",
            " rows below zero in [l_quantity, l_extendedprice]",
            "lineitem",
        ),
        # customer
        _columns_rule("customer", ["c_custkey", "c_name", "c_acctbal"]),
        _nulls_rule("customer", ["c_custkey", "c_name"]),
        _num_rule(
            "NonNegative",
            "customer",
            "count(*) FILTER (WHERE c_acctbal < 0)",
            "= 0",
            " rows below zero in [c_acctbal]",
            "customer",
        ),
        _num_rule(
            "Unique", "customer", "count(*) - count(DISTINCT c_custkey)", "= 0",
            " surplus rows for key [c_custkey]", "customer",
        ),
        # events, with error events turned into missing types
        _columns_rule("events", ["event_id", "session_id"], critical=False),
        _dq_row(
            "NotNull",
            "events",
            "(SELECT count(*) FILTER (WHERE event_type = 'error') = 0 FROM events)",
            """(SELECT CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN '{}'
                 ELSE '{"event_type":' || CAST(count(*) FILTER (WHERE event_type = 'error') AS VARCHAR)
                      || '}' END FROM events)""",
            """(SELECT 'nulls by column: ' || CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0
                 THEN 'none' ELSE '{"event_type":'
                      || CAST(count(*) FILTER (WHERE event_type = 'error') AS VARCHAR) || '}' END
                 FROM events)""",
        ),
        _num_rule(
            "NonNegative", "events", "count(*) FILTER (WHERE value < 0)", "= 0",
            " rows below zero in [value]", "events",
        ),
        _num_rule(
            "Unique", "events", "count(*) - count(DISTINCT event_id)", "= 0",
            " surplus rows for key [event_id]", "events",
        ),
        _num_rule("MinRowCount", "events", "count(*)", ">= 100", " rows, wanted 100", "events"),
        # part, with two keys
        _num_rule("Unique", "part", "count(*) - count(DISTINCT p_partkey)", "= 0", " surplus rows for key [p_partkey]", "part"),
        _num_rule(
            "Unique", "part", "count(*) - count(DISTINCT (p_brand, p_type, p_size))", "= 0",
            " surplus rows for key [p_brand, p_type, p_size]", "part",
        ),
        _nulls_rule("part", ["p_partkey", "p_name"]),
    ]
)


@register("dq_report", _DQ_SQL)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    customer = table(spark, sf_dir, "customer")
    events = table(spark, sf_dir, "events").withColumn(
        "event_type", F.nullif(F.col("event_type"), F.lit("error"))
    )
    reports = [
        audit(
            lineitem,
            "lineitem",
            [
                ColumnsExist(["l_orderkey", "l_linenumber", "l_quantity"]),
                NotNull(["l_orderkey", "l_linenumber"]),
                MinRowCount(1000),
                Unique(["l_orderkey", "l_linenumber"]),
                NonNegative(["l_quantity", "l_extendedprice"]),
            ],
        ),
        audit(
            customer,
            "customer",
            [
                ColumnsExist(["c_custkey", "c_name", "c_acctbal"]),
                NotNull(["c_custkey", "c_name"]),
                NonNegative(["c_acctbal"]),
                Unique(["c_custkey"]),
            ],
        ),
        audit(
            events,
            "events",
            [
                ColumnsExist(["event_id", "session_id"], critical=False),
                NotNull(["event_type"]),
                NonNegative(["value"]),
                Unique(["event_id"]),
                MinRowCount(100),
            ],
        ),
        audit(
            table(spark, sf_dir, "part"),
            "part",
            [Unique(["p_partkey"]), Unique(["p_brand", "p_type", "p_size"]), NotNull(["p_partkey", "p_name"])],
        ),
    ]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


# --------------------------------------------------------------------------
# Scans, sinks and the layer jobs
# --------------------------------------------------------------------------

_CUSTOMER_SCHEMA = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_nationkey", IntegerType()),
        StructField("c_acctbal", DoubleType()),
        StructField("c_mktsegment", StringType()),
    ]
)


@register("csv_roundtrip_schema", "SELECT * FROM customer")
def csv_roundtrip_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-roundtrip")
    export_csv(table(spark, sf_dir, "customer"), path, encoding="ISO-8859-1")
    return read_csv(spark, path, _CUSTOMER_SCHEMA, encoding="ISO-8859-1")


@register(
    "csv_infer_export",
    """
    SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey,
           CAST(s_acctbal AS DOUBLE) AS s_acctbal
    FROM supplier
    """,
)
def csv_infer_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-export")
    export_csv(table(spark, sf_dir, "supplier"), path)
    return read_csv_inferred(spark, path)


@register("partitioned_write", "SELECT * FROM lineitem")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items, written into one folder per flag and read back in their own column order."""
    path, lineitem = scratch_path(spark, "by-flag"), table(spark, sf_dir, "lineitem")
    write_table(lineitem, path, partition_by=["l_returnflag"])
    return read_table(spark, path, schema=lineitem.schema).select(*lineitem.columns)


def _clean_col(name: str, alias: str) -> str:
    return f"{_clean_sql(name)} AS {alias}"


_E2E_SQL = f"""
WITH nat AS (
    SELECT * FROM (
        SELECT n_nationkey AS nation_key, {_clean_col('n_name', 'country')}, n_regionkey AS region_key
        FROM nation)
    WHERE nation_key IS NOT NULL AND country IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY nation_key
        ORDER BY country ASC NULLS FIRST, region_key ASC NULLS FIRST) = 1
),
cust AS (
    SELECT * FROM (
        SELECT c_custkey AS cust_key, {_clean_col('c_name', 'name')}, c_nationkey AS nation_key,
               c_acctbal AS balance, {_clean_col('c_mktsegment', 'segment')}
        FROM customer)
    WHERE cust_key IS NOT NULL AND nation_key IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY cust_key
        ORDER BY name ASC NULLS FIRST, nation_key ASC NULLS FIRST, balance ASC NULLS FIRST,
                 segment ASC NULLS FIRST) = 1
),
supp AS (
    SELECT * FROM (
        SELECT s_suppkey AS supp_key, {_clean_col('s_name', 'name')}, s_nationkey AS nation_key,
               s_acctbal AS balance
        FROM supplier)
    WHERE supp_key IS NOT NULL AND nation_key IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY supp_key
        ORDER BY name ASC NULLS FIRST, nation_key ASC NULLS FIRST, balance ASC NULLS FIRST) = 1
),
li AS (
    SELECT * FROM (
        SELECT l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supp_key,
               l_linenumber AS line_number, coalesce(l_quantity, 0) AS quantity,
               l_extendedprice AS price, l_discount AS discount, l_tax AS tax, {_clean_col('l_returnflag', 'return_flag')},
               {_clean_col('l_linestatus', 'line_status')}, l_shipdate AS ship_date
        FROM lineitem)
    WHERE order_key IS NOT NULL AND line_number IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY order_key, line_number
        ORDER BY part_key ASC NULLS FIRST, supp_key ASC NULLS FIRST, quantity ASC NULLS FIRST,
                 price ASC NULLS FIRST, discount ASC NULLS FIRST, tax ASC NULLS FIRST,
                 return_flag ASC NULLS FIRST, line_status ASC NULLS FIRST, ship_date ASC NULLS FIRST) = 1
),
medals AS (
    SELECT nat.country,
           count(*) FILTER (WHERE li.return_flag = 'R')
         + count(*) FILTER (WHERE li.return_flag = 'A')
         + count(*) FILTER (WHERE li.return_flag = 'N') AS total_medals
    FROM li JOIN supp ON li.supp_key = supp.supp_key JOIN nat ON supp.nation_key = nat.nation_key
    GROUP BY nat.country
),
reach AS (
    SELECT nat.country, count(*) AS customer_count
    FROM cust JOIN nat ON cust.nation_key = nat.nation_key
    GROUP BY nat.country
)
SELECT reach.country, reach.customer_count,
       CAST(coalesce(medals.total_medals, 0) AS BIGINT) AS total_medals,
       round(coalesce(medals.total_medals, 0) / nullif(reach.customer_count, 0) * 100, 2)
           AS medals_per_100_customers
FROM reach LEFT JOIN medals ON reach.country = medals.country
"""


@register("layers_end_to_end", _E2E_SQL)
def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver tables -> raw CSV -> bronze -> silver (gated) -> gold; returns one mart."""
    root = scratch_path(spark, "layers")
    raw_root = f"{root}/raw"

    def land(name: str, spec) -> Callable[[], None]:
        source = table(spark, sf_dir, name).select(*spec.schema.fieldNames())
        # Each raw "file" is a folder of CSV part files written in parallel.
        return lambda: export_csv(source, f"{raw_root}/{spec.file}", encoding=spec.encoding)

    run_concurrently(
        [land(n, s) for n, s in commerce.COMMERCE_SPECS.items()], DEFAULT_CONCURRENT_JOBS
    )
    run_all(spark, commerce.COMMERCE_SPECS, commerce.COMMERCE_MARTS, raw_root, root)
    return read_table(spark, layer_path(root, "gold", "customer_reach"))


def entry_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: weighted standings of supplier countries by return flags."""
    return weighted_standings_q(spark, sf_dir)


# --------------------------------------------------------------------------
# Names in another case, as Spark resolves them
# --------------------------------------------------------------------------


@register(
    "names_in_any_case",
    " UNION ALL ".join(
        [
            _nulls_rule("part", ["p_partkey", "p_name"]).replace("p_partkey", "Part_Key").replace("p_name", "P_NAME"),
            _num_rule("Unique", "part", "count(*) - count(DISTINCT p_partkey)", "= 0", " surplus rows for key [PART_KEY]", "part"),
            _num_rule(
                "NonNegative", "part", "count(*) FILTER (WHERE p_retailprice < 0)", "= 0",
                " rows below zero in [P_RetailPrice]", "part",
            ),
        ]
    ).replace("count(Part_Key)", "count(p_partkey)"),
)
def names_in_any_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = rename_columns(table(spark, sf_dir, "part"), {"P_PARTKEY": "part_key", "absent": "x"})
    return audit(part, "part", [NotNull(["Part_Key", "P_NAME"]), Unique(["PART_KEY"]), NonNegative(["P_RetailPrice"])])


# --------------------------------------------------------------------------
# Malformed lines under PERMISSIVE reading, in Latin-1
# --------------------------------------------------------------------------

_KEYED_NAMES = StructType([StructField("key", LongType()), StructField("name", StringType()), StructField("nation", IntegerType())])


@register(
    "csv_malformed_lines",
    """
    SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS "key", 'Çé ' || c_name AS name,
           CAST(c_nationkey AS INTEGER) AS nation, c_custkey % 7 = 0 AS malformed
    FROM customer
    """,
)
def csv_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh key is no number: the row stays, its key is NULL and its raw line is kept."""
    key = F.col("c_custkey").cast("string")
    broken = F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("#"), key)).otherwise(key)
    rows = table(spark, sf_dir, "customer").select(
        broken.alias("key"), F.concat(F.lit("Çé "), "c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    raw, bronze = scratch_path(spark, "csv-malformed"), scratch_path(spark, "csv-malformed-bronze")
    export_csv(rows, raw, encoding="ISO-8859-1")
    write_table(read_csv(spark, raw, _KEYED_NAMES, encoding="ISO-8859-1", corrupt_record_column="_line"), bronze)
    return read_table(spark, bronze).select("key", "name", "nation", F.col("_line").isNotNull().alias("malformed"))
