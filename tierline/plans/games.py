"""The five source specs, their suites and their marts over the driver tables.

The driver tables are shaped into the five raw layouts (same columns, encodings and
kinds of flaws: stray white space, blank keys, repeated rows, a count that is no
number) and landed as CSV, so the real specs, rules and marts are what runs. Row counts
grow with the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.quality import read_audit
from tierline.plans.jobs import DEFAULT_CONCURRENT_JOBS, layer_path, read_mart, run_bronze, run_concurrently, run_gold, run_silver
from tierline.plans.marts import GOLD_BUILDERS
from tierline.plans.queries import _clean_sql, _dq_row, _num_rule, register, table
from tierline.plans.specs import SOURCE_SPECS
from tierline.session import scratch_path
from tierline.sources.tables import export_csv, read_csv

# -- raw layouts --------------------------------------------------------------------------


def _again(df: DataFrame, rows: str, **changes: str) -> DataFrame:
    """``df`` and once more its ``rows``, with ``changes``."""
    return df.unionByName(df.where(rows).withColumns({c: F.expr(x) for c, x in changes.items()}))


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def _athletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    people = _again(people, "c_custkey % 5 = 0", c_name="replace(c_name, '#', ' \t #')")
    return people.select(
        F.expr("replace(c_name, '#', '  #')").alias("PersonName"),
        F.expr("CASE WHEN c_custkey % 11 > 0 THEN n_name WHEN c_custkey % 2 = 0 THEN ' \t ' END").alias("Country"),
        F.col("c_mktsegment").alias("Discipline"),
    )


def _coaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "supplier").join(_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    return _again(people, "s_suppkey % 4 = 0").select(
        F.expr("concat('Ré ', s_name)").alias("Name"),
        F.col("n_name").alias("Country"),
        F.expr("concat('D', s_suppkey % 7)").alias("Discipline"),
        F.expr("CASE WHEN s_suppkey % 3 > 0 THEN concat('E', s_suppkey % 4) END").alias("Event"),
    )


def _entriesgender(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("discipline", F.concat_ws(" ", "p_brand", "p_type"))
    counts = parts.groupBy("discipline").agg(F.count_if(F.col("p_size") < 20).alias("f"), F.count_if(F.col("p_size") >= 30).alias("m"), F.count("*").alias("n"))
    female = F.when(F.startswith("discipline", F.lit("Brand#7 ")), F.lit("n/a")).otherwise(F.col("f").cast("string"))
    return counts.select(F.col("discipline").alias("Discipline"), female.alias("Female"), F.col("m").alias("Male"), F.col("n").alias("Total"))


def _medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).count()
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    won = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(*(F.sum(x).alias(x) for x in "FOP"))
    won = won.join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    won = _again(won, "n_nationkey % 4 = 0", F="F + 1")
    silver = F.expr("CASE WHEN n_nationkey % 6 > 0 THEN O END")  # a missing count
    return won.select(
        F.col("n_nationkey").alias("Rank"),
        F.col("n_name").alias("TeamCountry"),
        F.col("F").alias("Gold"),
        silver.alias("Silver"),
        F.col("P").alias("Bronze"),
        F.expr("F + P").alias("Total"),
        F.expr("n_nationkey % 3").alias("Rank by Total"),
    )


def _teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.expr("concat('Équipe ', o_orderkey % 40)").alias("TeamName"),
        F.col("o_orderpriority").alias("Discipline"),
        F.expr("CASE WHEN o_custkey % 9 > 0 THEN concat('C', o_custkey % 30) END").alias("Country"),
        F.col("o_orderstatus").alias("Event"),
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "athletes": _athletes,
    "coaches": _coaches,
    "entriesgender": _entriesgender,
    "medals": _medals,
    "teams": _teams,
}


def land(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> str:
    """Write the raw files of these datasets; returns their folder. Each raw "file" is a folder of CSV part files."""
    root = scratch_path(spark, "games-raw")

    def task(name: str) -> Callable[[], None]:
        spec = SOURCE_SPECS[name]
        return lambda: export_csv(RAW[name](spark, sf_dir), f"{root}/{spec.file}", encoding=spec.encoding)

    run_concurrently([task(n) for n in names], DEFAULT_CONCURRENT_JOBS)
    return root


def silver(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Silver frames of these datasets, from their raw files, without the layers between."""
    root = land(spark, sf_dir, names)
    specs = {n: SOURCE_SPECS[n] for n in names}
    return {n: s.to_silver(read_csv(spark, f"{root}/{s.file}", s.schema, encoding=s.encoding)) for n, s in specs.items()}


# -- SQL ----------------------------------------------------------------------------------

_RAW_SQL = {
    "athletes": """
        SELECT replace(name, '#', '  #') AS person_name, CASE WHEN c_custkey % 11 > 0 THEN n_name END AS country, c_mktsegment AS discipline
        FROM (SELECT *, c_name AS name FROM customer
              UNION ALL SELECT *, replace(c_name, '#', ' ' || chr(9) || ' #') FROM customer WHERE c_custkey % 5 = 0)
        JOIN nation ON c_nationkey = n_nationkey""",
    "coaches": """
        SELECT 'Ré ' || s_name AS coach_name, n_name AS country, 'D' || (s_suppkey % 7) AS discipline,
               CASE WHEN s_suppkey % 3 > 0 THEN 'E' || (s_suppkey % 4) END AS event
        FROM (SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_suppkey % 4 = 0)
        JOIN nation ON s_nationkey = n_nationkey""",
    "entriesgender": """
        SELECT discipline, CASE WHEN starts_with(discipline, 'Brand#7 ') THEN 0 ELSE count(*) FILTER (WHERE p_size < 20) END::INTEGER AS female,
               count(*) FILTER (WHERE p_size >= 30)::INTEGER AS male, count(*)::INTEGER AS total
        FROM (SELECT *, p_brand || ' ' || p_type AS discipline FROM part) GROUP BY discipline""",
    "medals": """
        SELECT n_nationkey::INTEGER AS rank, n_name AS country, coalesce(f + extra, 0)::INTEGER AS gold,
               coalesce(CASE WHEN n_nationkey % 6 > 0 THEN o END, 0)::INTEGER AS silver, coalesce(p, 0)::INTEGER AS bronze,
               coalesce(f + extra + p, 0)::INTEGER AS total, (n_nationkey % 3)::INTEGER AS rank_by_total
        FROM (SELECT c_nationkey, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS f,
                     nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS o, nullif(count(*) FILTER (WHERE o_orderstatus = 'P'), 0) AS p
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
        JOIN nation ON c_nationkey = n_nationkey JOIN (SELECT unnest([0, 1]) AS extra) ON extra = 0 OR n_nationkey % 4 = 0""",
    "teams": """
        SELECT 'Équipe ' || (o_orderkey % 40) AS team_name, o_orderpriority AS discipline,
               CASE WHEN o_custkey % 9 > 0 THEN 'C' || (o_custkey % 30) END AS country, o_orderstatus AS event
        FROM orders""",
}


def _silver_sql(name: str) -> str:
    """The dataset's silver rows: clean text, keyed rows, the smallest of each key."""
    spec = SOURCE_SPECS[name]
    columns = [spec.renames[c] for c in spec.schema.fieldNames()]
    text = {spec.renames[f.name] for f in spec.schema.fields if f.dataType.typeName() == "string"}
    clean = ", ".join(f"{_clean_sql(c)} AS {c}" if c in text else c for c in columns)
    keyed = " AND ".join(f"{c} IS NOT NULL" for c in spec.required)
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c not in spec.keys) or "1"
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT {clean} FROM ({_RAW_SQL[name]})) WHERE {keyed} "
        f"QUALIFY row_number() OVER (PARTITION BY {', '.join(spec.keys)} ORDER BY {order}) = 1"
    )


def _with_silver(sql: str, *names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({_silver_sql(n)})" for n in names) + sql


def _register_silver(name: str) -> None:
    register(f"games_{name}", _silver_sql(name))(lambda spark, sf_dir: silver(spark, sf_dir, name)[name])


for _name in RAW:
    _register_silver(_name)


# -- suites and counts --------------------------------------------------------------------


def _exist(dataset: str) -> str:
    return _dq_row("ColumnsExist", dataset, "true", "'[]'", "'columns not found: none'")


def _no_nulls(dataset: str) -> str:
    """Required columns have no NULL left: rows without them were dropped."""
    return _dq_row("NotNull", dataset, "true", "'{}'", "'nulls by column: none'")


def _rows(dataset: str, least: int) -> str:
    return _num_rule("MinRowCount", dataset, "count(*)", f">= {least}", f" rows, wanted {least}", dataset)


def _no_negatives(dataset: str, columns: list[str]) -> str:
    below = " OR ".join(f"{c} < 0" for c in columns)
    return _num_rule("NonNegative", dataset, f"count(*) FILTER (WHERE {below})", "= 0", f" rows below zero in [{', '.join(columns)}]", dataset)


def _unique(dataset: str, columns: list[str]) -> str:
    key = ", ".join(columns)
    return _num_rule("Unique", dataset, f"count(*) - count(DISTINCT ({key}))", "= 0", f" surplus rows for key [{key}]", dataset)


_SUITES_SQL = _with_silver(
    " "
    + " UNION ALL ".join(
        f"SELECT '2024-07' AS run_id, {i} AS place, * FROM ({row})"
        for i, row in enumerate(
            [
                *(_exist("athletes"), _no_nulls("athletes"), _rows("athletes", 1000), _unique("athletes", ["person_name", "country", "discipline"])),
                *(_exist("coaches"), _no_nulls("coaches"), _rows("coaches", 100)),
                *(_exist("entriesgender"), _no_nulls("entriesgender"), _no_negatives("entriesgender", ["female", "male", "total"])),
                _unique("entriesgender", ["discipline"]),
                *(_exist("medals"), _no_nulls("medals"), _no_negatives("medals", ["gold", "silver", "bronze", "total"]), _unique("medals", ["country"])),
                *(_exist("teams"), _no_nulls("teams"), _rows("teams", 100)),
            ]
        )
    ),
    *RAW,
)


@register("games_suites", _SUITES_SQL)
def games_suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five suites as the silver job stores them, without stopping at a failed rule."""
    lake = scratch_path(spark, "games")
    run_bronze(spark, SOURCE_SPECS, land(spark, sf_dir, list(SOURCE_SPECS)), lake)
    run_silver(spark, SOURCE_SPECS, lake, fail_fast=False, audit_path=f"{lake}/audit", run_id="2024-07")
    return read_audit(spark, f"{lake}/audit")


def _counts_sql(name: str) -> str:
    spec = SOURCE_SPECS[name]
    keyed = " AND ".join(f"{c} IS NOT NULL" for c in spec.required)
    malformed = "count(*) FILTER (WHERE starts_with(discipline, 'Brand#7 '))" if name == "entriesgender" else "count(*) FILTER (WHERE false)"
    return (
        f"SELECT '{name}' AS dataset, (SELECT count(*) FROM ({_RAW_SQL[name]})) AS rows_raw, "
        f"(SELECT {malformed} FROM ({_RAW_SQL[name]})) AS malformed, "
        f"(SELECT count(*) FROM ({_RAW_SQL[name]}) WHERE NOT ({keyed})) AS without_key, "
        f"(SELECT count(*) FROM ({_RAW_SQL[name]}) WHERE {keyed}) - (SELECT count(*) FROM {name}) AS duplicates, "
        f"(SELECT count(*) FROM {name}) AS rows_kept"
    )


@register("games_row_counts", _with_silver(" " + " UNION ALL ".join(_counts_sql(n) for n in RAW), *RAW))
def games_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bronze and silver jobs counted while they ran."""
    lake = scratch_path(spark, "games")
    raw = run_bronze(spark, SOURCE_SPECS, land(spark, sf_dir, list(SOURCE_SPECS)), lake)
    kept = run_silver(spark, SOURCE_SPECS, lake, fail_fast=False).counts
    rows = [(n, raw[n].rows, raw[n].malformed, kept[n].without_key, kept[n].duplicates, kept[n].rows_kept) for n in raw]
    schema = "dataset string, rows_raw bigint, malformed bigint, without_key bigint, duplicates bigint, rows_kept bigint"
    return spark.createDataFrame(rows, schema)


# -- marts --------------------------------------------------------------------------------

_MARTS_SQL = {
    "gender_participation": (
        """ SELECT discipline, female, male, total, round(female / nullif(total, 0) * 100, 2) AS female_pct,
                   round(male / nullif(total, 0) * 100, 2) AS male_pct FROM entriesgender""",
        ["entriesgender"],
    ),
    "athletes_by_country": (
        " SELECT country, count(*) AS athlete_count, count(DISTINCT discipline) AS discipline_count FROM athletes GROUP BY country",
        ["athletes"],
    ),
    "country_performance": (
        """ SELECT a.country, athlete_count, coalesce(total_medals, 0)::BIGINT AS total_medals,
                   round(coalesce(total_medals, 0) / athlete_count * 100, 2) AS medals_per_100_athletes
            FROM (SELECT country, count(*) AS athlete_count FROM athletes GROUP BY country) a
            LEFT JOIN (SELECT country, (gold + silver + bronze)::BIGINT AS total_medals FROM medals) m ON m.country = a.country""",
        ["athletes", "medals"],
    ),
}


def _register_mart(name: str, sql: str, sources: list[str]) -> None:
    register(f"games_{name}", _with_silver(sql, *sources))(lambda spark, sf_dir: GOLD_BUILDERS[name](silver(spark, sf_dir, *sources)))


for _name, (_sql, _sources) in _MARTS_SQL.items():
    _register_mart(_name, _sql, _sources)


@register(
    "games_standings_read",
    _with_silver(
        """ SELECT country, gold, silver, bronze, total_medals, medal_points,
                   rank() OVER (ORDER BY medal_points DESC)::INTEGER AS rank_by_points,
                   rank() OVER (ORDER BY total_medals DESC)::INTEGER AS rank_by_total_medals,
                   row_number() OVER (ORDER BY medal_points DESC, country) AS place
            FROM (SELECT *, (gold + silver + bronze)::BIGINT AS total_medals, (gold * 3 + silver * 2 + bronze)::BIGINT AS medal_points FROM medals)""",
        "medals",
    ),
)
def games_standings_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The medal table through all layers, gate included, read back in its order; ``place`` counts its rows as read."""
    lake, name = scratch_path(spark, "games"), "medal_standings"
    specs = {"medals": SOURCE_SPECS["medals"]}
    run_bronze(spark, specs, land(spark, sf_dir, ["medals"]), lake)
    run_silver(spark, specs, lake)
    run_gold(spark, {name: GOLD_BUILDERS[name]}, ["medals"], lake)
    read = read_mart(spark, lake, name)
    # One row per country: numbering them in one task is their order made visible.
    return read.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)
