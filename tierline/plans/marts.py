"""Gold marts over a mapping of silver tables.

Marts are returned unsorted: row order is not a property of a stored table,
and a global sort before a write costs a sampling job plus a range shuffle.
:func:`presentation_order` gives the order (with a tie-break) to apply
when a mart is read for display.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import ratio, row_total
from tierline.operators.measures import (
    headcount_and_breadth,
    rate_per_100,
    share_of_total,
    weighted_standings,
)
from tierline.operators.ranking import top_k

Catalog = Mapping[str, DataFrame]

# Fixed values that must equal the reference's: each mart's name and its
# output columns, in order.
MART_COLUMNS: dict[str, list[str]] = {
    "medal_standings": [
        "country",
        "gold",
        "silver",
        "bronze",
        "total_medals",
        "medal_points",
        "rank_by_points",
        "rank_by_total_medals",
    ],
    "gender_participation": ["discipline", "female", "male", "total", "female_pct", "male_pct"],
    "athletes_by_country": ["country", "athlete_count", "discipline_count"],
    "country_performance": ["country", "athlete_count", "total_medals", "medals_per_100_athletes"],
}


def medal_standings(silver: Catalog) -> DataFrame:
    """Medal table with weighted points, total and two global ranks."""
    medals = silver["medals"].select("country", "gold", "silver", "bronze")
    # One row per country: the mart's ranks fit an int.
    ranks = {c: F.col(c).cast("int") for c in ("rank_by_points", "rank_by_total_medals")}
    return weighted_standings(medals, "country").withColumns(ranks).select(*MART_COLUMNS["medal_standings"])


def gender_participation(silver: Catalog) -> DataFrame:
    """Per-discipline female/male share of the supplied total (NULL on a zero total)."""
    entries = silver["entriesgender"].select("discipline", "female", "male", "total")
    return share_of_total(entries, ["female", "male"], "total").select(
        *MART_COLUMNS["gender_participation"]
    )


def athletes_by_country(silver: Catalog) -> DataFrame:
    """Athlete rows and distinct disciplines per country."""
    return headcount_and_breadth(
        silver["athletes"],
        "country",
        "discipline",
        count_name="athlete_count",
        distinct_name="discipline_count",
    ).select(*MART_COLUMNS["athletes_by_country"])


def country_performance(silver: Catalog) -> DataFrame:
    """Medals per 100 athletes; countries without medals get 0, medal-only countries drop out."""
    medals = silver["medals"].select(
        "country", row_total(["gold", "silver", "bronze"]).alias("total_medals")
    )
    return rate_per_100(
        silver["athletes"],
        medals,
        "country",
        "total_medals",
        count_name="athlete_count",
        rate_name="medals_per_100_athletes",
    ).select(*MART_COLUMNS["country_performance"])


def top_gold_countries(silver: Catalog, k: int = 20) -> DataFrame:
    """Legacy view: the ``k`` countries with most golds (country as tie-break)."""
    medals = silver["medals"].select("country", "gold")
    return top_k(medals, [F.col("gold").desc_nulls_last(), F.col("country").asc()], k)


def entries_ratio(silver: Catalog) -> DataFrame:
    """Legacy view: unrounded female and male share of the supplied total
    (NULL instead of an error on a zero total)."""
    entries = silver["entriesgender"].select("discipline", "female", "male", "total")
    return entries.withColumns(
        {"avg_female": ratio("female", "total"), "avg_male": ratio("male", "total")}
    )


GOLD_BUILDERS: dict[str, Callable[[Catalog], DataFrame]] = {
    "medal_standings": medal_standings,
    "gender_participation": gender_participation,
    "athletes_by_country": athletes_by_country,
    "country_performance": country_performance,
}

# Presentation order of each mart: (column, descending) pairs, tie-break last.
MART_ORDER: dict[str, list[tuple[str, bool]]] = {
    "medal_standings": [("rank_by_points", False), ("country", False)],
    "gender_participation": [("total", True), ("discipline", False)],
    "athletes_by_country": [("athlete_count", True), ("country", False)],
    "country_performance": [("medals_per_100_athletes", True), ("country", False)],
}


def presentation_order(name: str) -> list[Column]:
    """Sort columns for reading mart ``name`` for display (NULL last when descending)."""
    return [
        F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_first()
        for c, desc in MART_ORDER[name]
    ]
