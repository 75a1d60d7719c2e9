"""Mixing sources to target weights.

Sources, in code-point order with null last, take the weights in turn and share
the words of the whole corpus by weight. A source's target stops at ``cap`` times
its own words; what it can't take goes to the others by weight until none is above.
Each document is then taken ``floor(rate)`` times, ``rate`` being its source's
target over its source's words, and once more if a number drawn from a hash of the
seed, its id, its size, its text's MD5 and its number among the source's rows of that id
and text lies below the rate's fraction. The draw depends on nothing else, so reruns and
recomputed tasks agree: equal rows may change places, but as many of them are taken.

One row per source is all that is ever gathered, by partial aggregates, so a source
that holds most rows is as cheap as any other; documents are not shuffled to reach it.
Rows are numbered only where an id and text repeat: such keys are found from narrow rows,
and their rows are stored and numbered part by part, so that a key of very many rows is
counted by many tasks.

Defined cases: a null text has no words; null is a source of its own; a source
without words has target 0 and its documents are taken 0 times; null and repeated ids, and
repeated rows, each have their own draw; an empty table gives an empty one; other columns,
of whatever name, are kept, but for those that carry a result's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tierline.llm.common import attach, numbered, read_table, stored, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
_RESULTS = ("size", "source_size", "target", "rate", "copies")


def source_targets(sized: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per ``_source`` of ``sized(_source, _size)``: source_size, weight, target."""
    totals = sized.groupBy("_source").agg(F.coalesce(F.sum("_size"), F.lit(0)).cast("bigint").alias("source_size"))
    turn = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_n") - 1) % len(weights) + 1).cast("int"))
    table = stored(
        numbered(totals, F.col("_source").asc_nulls_last())
        .withColumn("weight", turn)
        .withColumn("limit", F.col("source_size") * cap)
        .drop("_n"),
        "mix-sources",
    )
    all_words, all_weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level, full = (all_words or 0) / (all_weight or 1), -1
    while True:  # each turn fixes the sources that the level now overfills; the level only rises
        above = F.col("weight") * F.lit(level) > F.col("limit")
        n, taken, weight = table.where(above).agg(F.count("*"), F.sum("limit"), F.sum("weight")).first()
        if n == full or not n or weight == all_weight:
            break
        full, level = n, (all_words - taken) / (all_weight - weight)
    target = F.least(F.col("weight") * F.lit(float(level)), F.col("limit").cast("double"))
    return table.select("_source", "source_size", "weight", target.alias("target"))


def text_mark(text: Column) -> Column:
    """The text's MD5; null counts as empty."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on ``seed`` and ``key`` alone: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_k``: their number, from 1, among those of one ``_key``."""
    again = stored(rows.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1"), "mix-repeated")
    if not again.agg(F.count("*")).first()[0]:
        return rows.withColumn("_k", F.lit(1).cast("bigint"))
    marked = attach(rows, again.withColumn("_again", F.lit(True)), "_key", "_n")
    alone = marked.where("_again is null").drop("_again").withColumn("_k", F.lit(1).cast("bigint"))
    # What part a row lies in is written down, so that all that follows sees the same parts.
    several = stored(marked.where("_again").drop("_again").withColumn("_part", F.spark_partition_id()), "mix-several")
    earlier = W.partitionBy("_key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = several.groupBy("_key", "_part").agg(F.count("*").alias("_n"))
    before = before.select("_key", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy("_key", "_part").orderBy(F.lit(0)))
    numbered_rows = several.withColumn("_within", within).join(before, ["_key", "_part"])
    return alone.unionByName(numbered_rows.withColumn("_k", F.col("_before") + F.col("_within")).select(*alone.columns))


def mix(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size_col: str | None = None,
    mark_col: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """``df`` with size, source_size, target, rate and copies (how often the mix takes the row).

    ``size_col`` names a column that holds the words already, ``mark_col`` one that holds the text's MD5; otherwise both
    are taken from the text.
    """
    of = lambda c: F.col(f"`{c}`")
    size = F.coalesce(of(size_col).cast("bigint"), F.lit(0)) if size_col else word_count(of(text_col))
    mark = of(mark_col) if mark_col else text_mark(of(text_col))
    others = [c for c in df.columns if c.lower() not in _RESULTS]
    source = of(source_col).cast("string")
    # Null is an ordinary key here: a flag beside the value keeps the join an equality on both.
    key = F.concat_ws("|", F.coalesce(of(id_col).cast("string"), F.lit("null")), size.cast("string"), mark)
    rows = df.select(
        F.struct(*map(of, others)).alias("_row"),
        F.coalesce(source, F.lit("")).alias("_source"),
        source.isNull().alias("_null"),
        size.alias("_size"),
        F.struct(F.coalesce(source, F.lit("")).alias("s"), source.isNull().alias("n"), key.alias("k")).alias("_key"),
    )
    sized = rows.select(F.when(~F.col("_null"), F.col("_source")).alias("_source"), "_size")
    targets = stored(source_targets(sized, weights=weights, cap=cap), "mix-targets").withColumn("_null", F.col("_source").isNull())
    targets = targets.fillna({"_source": ""}).drop("weight")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    drawn = draw(F.concat_ws("|", F.col("_key.k"), F.col("_k").cast("string")), seed)
    return (
        _counted(rows)
        .join(targets, ["_source", "_null"])
        .withColumn("_rate", rate)
        .select(
            *(F.col("_row").getField(c).alias(c) for c in others),
            F.col("_size").alias("size"),
            "source_size",
            "target",
            F.col("_rate").alias("rate"),
            (F.floor("_rate").cast("int") + (drawn < F.col("_rate") - F.floor("_rate")).cast("int")).alias("copies"),
        )
    )


def emit(df: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``df`` as often as the mix takes it, with the columns of ``df``."""
    id_col, text_col, source_col = (options.pop(k, k0) for k, k0 in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    packed = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_src"),
        word_count(F.col(text_col)).alias("_words"),
        text_mark(F.col(text_col)).alias("_text"),
    )
    mixed = mix(packed, id_col="_id", source_col="_src", size_col="_words", mark_col="_text", **options)
    return mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", word_count(text).alias("words"), text_mark(text).alias("mark"))
    mixed = mix(stored(docs, "mix-sizes"), size_col="words", mark_col="mark")
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_sql(src: str, words: str) -> str:
    """DuckDB SQL (two CTEs and more, last ``mixed``) over ``src`` with columns doc_id, source, text; ``words`` is its size expression."""
    turns = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return f"""
sized AS (SELECT *, ({words})::BIGINT AS size FROM {src}),
per_source AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} {turns} END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum({CAP} * source_size) OVER before, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM per_source
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
         least(weight * (SELECT max(level) FROM levels), ({CAP} * source_size)::DOUBLE) AS target
  FROM levels),
rated AS (
  SELECT sized.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source),
mixed AS (
  SELECT * EXCLUDE (k), floor(rate)::BIGINT + (('0x' || substr(md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null') || '|' || size::VARCHAR
           || '|' || md5(coalesce(text, '')) || '|' || k), 1, 13))::BIGINT / {2**52}.0::DOUBLE < rate - floor(rate))::BIGINT AS copies
  FROM (SELECT *, row_number() OVER (PARTITION BY source, doc_id, md5(coalesce(text, ''))) AS k FROM rated))"""


WORDS_SQL = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
ORACLE = f"""
WITH {mix_sql("documents", WORDS_SQL)}
SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"""
