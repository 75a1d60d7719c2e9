"""Bronze and silver operators: lineage stamp, rename, string cleaning, zero
fill, required-key filter, deterministic de-duplication, and the ``conform``
chain that strings them together from a :class:`~tierline.plans.specs.DatasetSpec`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from tierline.functions.columns import clean_string
from tierline.session import stored

LINEAGE_COLUMNS = ("_ingested_at", "_source_file")
FEW_KEYS = 200_000  # so many repeated keys are a small table beside the rows they are looked up for


def stamp_lineage(df: DataFrame, source_file: str) -> DataFrame:
    """Add ``_ingested_at`` (query start time, equal for every row) and ``_source_file``."""
    return df.withColumns(
        {"_ingested_at": F.current_timestamp(), "_source_file": F.lit(source_file)}
    )


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names are resolved as Spark does, absent ones are ignored."""
    return df.withColumnsRenamed(dict(mapping)) if mapping else df


def clean_strings(df: DataFrame, exclude: Iterable[str] = LINEAGE_COLUMNS) -> DataFrame:
    """Apply :func:`clean_string` to every top-level string column but ``exclude``.

    Built as one ``select`` from the schema (one projection to analyse).
    """
    skip = set(exclude)
    cols = [
        clean_string(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, StringType) and f.name not in skip
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULL by 0 in ``columns``; each column keeps its type."""
    if not columns:
        return df
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in columns})


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``columns`` is NULL (after cleaning, blanks are NULL)."""
    if not columns:
        return df
    return df.dropna(how="any", subset=list(columns))


def dedupe(df: DataFrame, keys: Sequence[str], *, rare: bool = False, seen: dict[str, int] | None = None) -> DataFrame:
    """Keep one row per key; NULL keys compare equal.

    The surviving row is the one whose non-key columns, compared left to right
    with NULL first, are smallest, so every run keeps the same row. It is the first
    of its key in a window, in one shuffle; before it each task keeps at most one row
    per key, so a key that holds a third of the rows does not meet in one task.

    With ``rare``, wide rows are neither sorted nor moved when few of them share a key.
    Building the frame then runs one job that counts the rows of every key: it reads,
    groups and shuffles the key columns alone, and stores the keys that have more than
    one row. Without any, ``df`` is returned as it is. With at most ``FEW_KEYS`` of them only
    rows with such keys are compared; all others pass, unshuffled where Spark finds the stored
    keys small enough to broadcast. With more, or when most rows turn out to share their key,
    all are compared in the one window: looking up many keys would shuffle and sort every row
    twice. If no key has more rows than a task's even share, tasks do not sort before the
    shuffle, since there is no hot key to collapse.

    ``seen`` receives the counts of that job, ``rows`` and distinct ``keys``, and asks for it.
    """
    wanted = {k.lower() for k in keys}
    keys = [c for c in df.columns if c.lower() in wanted]
    if len(keys) < len(wanted):
        raise ValueError(f"no such key column: {sorted(wanted - {k.lower() for k in keys})}")
    others = [f for f in df.schema.fields if f.name not in keys]
    # Maps have no order: such a column is compared by its JSON text.
    order = [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if _holds_map(f.dataType) else F.col(f"`{f.name}`").asc_nulls_first() for f in others
    ]

    def survivors(rows: DataFrame) -> DataFrame:
        if not others:
            return rows.distinct()
        first = F.row_number().over(Window.partitionBy(*(F.col(f"`{k}`") for k in keys)).orderBy(*order))
        return rows.withColumn("_row_number", first).where("_row_number = 1").drop("_row_number")

    if not rare and seen is None:
        return survivors(df)
    named = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    copies, n, count = df.groupBy(*named).agg(F.count(F.lit(1)).alias("_copies")), F.col("_copies"), Observation()
    more = F.when(n > 1, n)
    sizes = {"rows": F.sum(n), "keys": F.count(n), "compared": F.sum(more), "repeated": F.count(more), "most": F.max(n)}
    observed = copies.observe(count, *(size.alias(x) for x, size in sizes.items()))
    repeated = stored(observed.where("_copies > 1").drop("_copies"), "dedupe-keys")
    n_rows, n_keys, compared, n_repeated, most = (count.get[x] or 0 for x in sizes)
    if seen is not None:
        seen.update(rows=n_rows, keys=n_keys)
    if n_rows == n_keys:
        return df
    if 2 * compared > n_rows or n_repeated > FEW_KEYS:
        hot = most * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) > n_rows
        return survivors(df if hot or not others else df.repartition(*(F.col(f"`{k}`") for k in keys)))
    same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    return df.join(repeated, same, "left_anti").unionByName(survivors(df.join(repeated, same, "left_semi")))


def _holds_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, MapType) or (isinstance(kind, ArrayType) and _holds_map(kind.elementType))


def conform(
    df: DataFrame,
    *,
    renames: Mapping[str, str] | None = None,
    zero_fill: Sequence[str] = (),
    required: Sequence[str] = (),
    keys: Sequence[str] | None = None,
    seen: dict[str, int] | None = None,
) -> DataFrame:
    """Silver chain: rename -> clean strings -> zero fill -> drop null keys -> de-duplicate.

    With ``keys``, ``seen`` receives the number of ``rows`` that have all their required
    columns and of distinct ``keys``, counted by :func:`dedupe`.
    """
    out = rename_columns(df, renames or {})
    out = clean_strings(out)
    out = fill_zero(out, zero_fill)
    out = drop_null_keys(out, required)
    if keys:
        out = dedupe(out, keys, seen=seen)
    return out
