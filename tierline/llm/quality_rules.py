"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is a column expression over the whole text and every rule compares
two integers, so the verdict has no rounding. No user function, join or shuffle
takes part: a row is judged where it was read, whatever the size of the table.

Defined cases: a null text counts as empty; an empty text has no words and fails
``n_words``; repeated rows are judged alike; other columns, of whatever name, are
kept as they are unless they carry a result's name, when the result replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import WORD, read_table, words

SYMBOLS = "#*$%&|<>"

#: Function words by language; other languages need their own.
STOP_WORDS = {
    "en": "the of and to in is a that for was on with by at are be this from as it",
    "fr": "la le les de des du et un une est que qui dans pour sur avec par pas en au",
    "de": "der die das und ist von zu den mit nicht ein eine auf für sich dem es im",
    "es": "el los las y por con para se no su al del",
}
#: Letters in upper and lower case, and marks around a word, that its look-up among the stop words ignores.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÀÇÑ", "abcdefghijklmnopqrstuvwxyzäöüéèàçñ"
MARKS = ".,;:!?\"'()[]{}-_«»„“”‘’…¡¿"


@dataclass(frozen=True)
class Threshold:
    """Keep a document while ``100 * measure`` lies in ``[low, high]`` per cent of ``base``; None leaves a side open."""

    measure: str
    base: str
    low: int | None = None
    high: int | None = None


#: Production thresholds, in hundredths of the base.
THRESHOLDS = (
    Threshold("word_chars", "n_words", low=250, high=1200),  # mean word length 2.5 to 12
    Threshold("n_symbols", "n_words", high=10),
    Threshold("n_bangs", "n_words", high=40),
    Threshold("n_upper", "word_chars", high=40),
    Threshold("n_stop", "n_words", low=4),
    Threshold("n_dup_lines", "n_lines", high=40),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ALL = (*MEASURES, "n_bangs", "n_upper", "n_stop", "n_lines")


def _characters(text: Column, which: str) -> Column:
    return F.regexp_count(text, F.lit(which))


def _all_stop_words(stop_words: dict[str, str]) -> list[str]:
    return sorted({w for ws in stop_words.values() for w in ws.split()})


def _with_measures(df: DataFrame, text_col: str, stop_words: dict[str, str]) -> DataFrame:
    """One struct column ``_q`` of bigint measures."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    df = df.withColumn("_w", words(text)).withColumn("_lines", lines)
    # The 64-bit hashes of the three-word windows with their place, sorted: equal windows become
    # neighbours, so the cost stays n log n for a text of any length.
    n = F.size("_w")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(
                F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("g"),
                i.alias("i"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>"))
    df = df.withColumn("_s", F.sort_array(windows))
    twice = F.filter(
        F.col("_s"),
        lambda x, k: (F.get("_s", k - 1)["g"] == x["g"]) | (F.get("_s", k + 1)["g"] == x["g"]),
    )
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    known = _all_stop_words(stop_words)
    stop = F.size(F.filter("_w", lambda w: F.btrim(F.translate(w, UPPER, LOWER), F.lit(MARKS)).isin(*known)))
    values = {
        "n_words": n,
        "word_chars": F.char_length(F.array_join("_w", "")),
        "n_symbols": _characters(text, f"[{SYMBOLS}]"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": covered,
        "n_bangs": _characters(text, "!"),
        "n_upper": _characters(text, "[A-Z]"),
        "n_stop": stop,
        "n_lines": F.size("_lines"),
    }
    # A field that depends on the task keeps filters on the verdict above the measures; pushed below them,
    # a filter would work out each measure anew for every rule and word.
    fields = [*(values[k].cast("bigint").alias(k) for k in _ALL), F.spark_partition_id().alias("here")]
    return df.withColumn("_q", F.struct(*fields)).drop("_w", "_lines", "_s")


def _passes(rule: Threshold) -> Column:
    measure, base = F.col(f"_q.{rule.measure}") * 100, F.col(f"_q.{rule.base}")
    sides = [measure >= base * rule.low] if rule.low is not None else []
    sides += [measure <= base * rule.high] if rule.high is not None else []
    out = sides[0]
    for side in sides[1:]:
        out = out & side
    return out


def judge(
    df: DataFrame,
    text_col: str = "text",
    *,
    thresholds: tuple[Threshold, ...] = THRESHOLDS,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    stop_words: dict[str, str] = STOP_WORDS,
) -> DataFrame:
    """``df`` with the five measures, ``base_failed`` and ``kept``.

    ``stop_words`` has the function words of each language of the corpus, in lower case; those of all languages count in
    any text. Texts of a language without any fail ``n_stop``, so leave that threshold out for such a corpus.
    """
    q = F.col("_q")
    failed = (q["n_words"] < min_words) | (q["n_repeat_words"] * 100 > q["n_words"] * max_repeat_percent)
    kept = ~F.col("_failed")
    for rule in thresholds:
        kept = kept & _passes(rule)
    results = {**{k: q[k] for k in MEASURES}, "base_failed": F.col("_failed"), "kept": F.col("_kept")}
    others = [c for c in df.columns if c.lower() not in results]
    # The row travels as one column, so that no name in it can meet those used here.
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    out = _with_measures(packed, "_text", stop_words).withColumn("_failed", failed).withColumn("_kept", kept)
    return out.select(*(F.col("_row").getField(c).alias(c) for c in others), *(v.alias(k) for k, v in results.items()))


def keep(df: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows that the rules keep, with the columns of ``df``."""
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_row"), F.col(text_col).alias("_text"))
    return judge(packed, "_text", **options).where("kept").select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", *MEASURES, "base_failed", "kept")


def _sql_rule(rule: Threshold) -> str:
    sides = [f"100 * {rule.measure} >= {rule.low} * {rule.base}"] if rule.low is not None else []
    sides += [f"100 * {rule.measure} <= {rule.high} * {rule.base}"] if rule.high is not None else []
    return " AND ".join(sides)


_STOP_SQL = ", ".join(f"'{w}'" for w in _all_stop_words(STOP_WORDS))
_MARKS_SQL = MARKS.replace("'", "''")
_SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: DuckDB SQL of the measures and verdict for any relation named ``src`` with a unique key ``doc_id``.
MEASURES_SQL = rf"""
w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM src),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(translate(x, {_SPACE_SQL}, '')) > 0) AS l FROM w),
grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (
  SELECT doc_id, sum(least(3, coalesce(after - i, 3)))::BIGINT AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM twice) GROUP BY doc_id),
measures AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words,
         length(translate(text, {_SPACE_SQL}, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^{SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_bangs,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
         len(list_filter(w, lambda x: trim(translate(x, '{UPPER}', '{LOWER}'), '{_MARKS_SQL}') IN ({_STOP_SQL})))::BIGINT AS n_stop,
         len(l)::BIGINT AS n_lines
  FROM w JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measures)"""
KEPT_SQL = "NOT base_failed AND " + " AND ".join(_sql_rule(t) for t in THRESHOLDS)

ORACLE = f"""
WITH src AS (SELECT doc_id, text FROM documents), {MEASURES_SQL}
SELECT doc_id, {', '.join(MEASURES)}, base_failed, {KEPT_SQL} AS kept FROM judged"""
