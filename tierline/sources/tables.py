"""Scans and sinks: CSV with declared schemas, table read/write, CSV export.

Curated layers are Parquet by default (columnar: column pruning and filter
pushdown reach the scan); the format is a parameter everywhere. Overwrites
are idempotent, and a Parquet overwrite replaces the schema by nature. Never
overwrite a path that the same plan reads: Spark deletes the target before
the read finishes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

DEFAULT_FORMAT = "parquet"
PUBLISHED = "_published"  # a table's log of versions
VERSIONS = "_versions"  # beside the tables of a layer: their data, version by version
_LOG_SCHEMA = "seq bigint, version string, published_at timestamp"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    encoding: str = "UTF-8",
    mode: str = "PERMISSIVE",
    multi_line: bool = False,
    corrupt_record_column: str | None = None,
    enforce_schema: bool = True,
) -> DataFrame:
    """CSV scan with a header line and an explicit schema (no inference pass).

    PERMISSIVE (the default) turns malformed or overflowing fields into NULL,
    pads short rows with NULL and drops extra fields; columns bind by position.
    Pass ``corrupt_record_column`` to keep the raw line of such rows so the loss
    can be counted, ``multi_line=True`` for quoted fields spanning lines
    (a file is then read by one task), and ``enforce_schema=False`` to make a
    header/schema name mismatch fail.

    Count corrupt rows on the written bronze table, not on the raw scan:
    Spark parses only the columns a query needs, so a scan that keeps just
    the corrupt-record column would not flag errors in the others (and
    Spark refuses such a scan).
    """
    read_schema = schema
    reader = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("mode", mode)
        .option("multiLine", multi_line)
        .option("enforceSchema", enforce_schema)
    )
    if corrupt_record_column:
        if corrupt_record_column not in schema.fieldNames():
            read_schema = StructType(
                [*schema.fields, StructField(corrupt_record_column, StringType(), True)]
            )
        reader = reader.option("columnNameOfCorruptRecord", corrupt_record_column)
    return reader.schema(read_schema).csv(path)


def read_csv_inferred(
    spark: SparkSession, path: str, *, encoding: str = "UTF-8"
) -> DataFrame:
    """CSV scan that infers column types. Opt-in only.

    Inference is an extra pass over all rows before the scan.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("encoding", encoding)
        .csv(path)
    )


def write_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str = DEFAULT_FORMAT,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
    rebalance: bool = True,
) -> None:
    """Write a table directory; ``overwrite`` makes re-runs idempotent.

    ``partition_by`` writes one sub-folder per value. Rows of one value first meet in as
    few tasks as their size needs (``rebalance``, one shuffle), so that not every task
    leaves a small file in every folder; adaptive execution splits a hot value into parts
    of ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and merges small ones, so no task
    gets all of it. ``max_records_per_file`` bounds files further.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *(F.col(f"`{c}`") for c in partition_by))
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    writer.save(path)


def new_version() -> str:
    """A name for one more version of a table; its data goes to :func:`version_path`."""
    return f"v-{uuid.uuid4().hex}"


def version_path(path: str, version: str) -> str:
    """Where the data of one version of the table ``path`` lies: beside the table, so that an
    unpublished version leaves no trace in it."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{VERSIONS}/{name}/{version}"


def publish_version(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` what :func:`read_table` reads at ``path``.

    Adds one row to the table's log of versions. A reader sees the log with that row or
    without it, never a part of a table; data is neither moved nor copied.
    """
    last = published_versions(spark, path).agg(F.max("seq")).first()[0] or 0
    row = spark.range(1, numPartitions=1).select(
        F.lit(last + 1).cast("bigint").alias("seq"), F.lit(version).alias("version"), F.current_timestamp().alias("published_at")
    )
    row.write.mode("append").parquet(f"{path.rstrip('/')}/{PUBLISHED}")


def published_versions(spark: SparkSession, path: str) -> DataFrame:
    """The log of versions of the table ``path``: seq (the largest is current), version, published_at. Empty for a
    table that was written without versions or not at all."""
    try:
        return spark.read.schema(_LOG_SCHEMA).parquet(f"{path.rstrip('/')}/{PUBLISHED}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG_SCHEMA)


def current_version(spark: SparkSession, path: str) -> str | None:
    # Two jobs that publish at once may take one number; the name decides, for all readers alike.
    row = published_versions(spark, path).orderBy(F.col("seq").desc(), F.col("version")).first()
    return row["version"] if row else None


def read_table(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = DEFAULT_FORMAT,
    schema: StructType | None = None,
    version: str | None = None,
) -> DataFrame:
    """Read a table directory, or the published (or the named) version of a versioned table.

    For partitioned tables pass ``schema``: otherwise partition values are
    re-typed from their folder names ("01" comes back as int 1).
    """
    version = version or current_version(spark, path)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(version_path(path, version) if version else path)


def export_csv(
    df: DataFrame,
    path: str,
    *,
    num_files: int | None = None,
    by_size: bool = False,
    encoding: str | None = None,
    header: bool = True,
) -> None:
    """Headered CSV export with overwrite.

    The write runs at the DataFrame's own parallelism unless told otherwise. ``by_size``
    deals the rows anew (one shuffle) into files of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, measured by adaptive execution at
    run time: small parts are merged and large ones split. ``num_files`` fixes the number
    of files. That is a ``repartition``, not a ``coalesce``: a coalesce would also
    squeeze the upstream computation into ``num_files`` tasks. ``num_files=1`` still
    writes every row from one task and is only sensible for small tables.
    """
    if num_files and by_size:
        raise ValueError("files are dealt by number or by size, not both")
    out = df.repartition(num_files) if num_files else df.hint("rebalance") if by_size else df
    writer = out.write.mode("overwrite").option("header", header)
    if encoding:
        writer = writer.option("encoding", encoding)
    writer.csv(path)


def show_table(
    spark: SparkSession, path: str, *, fmt: str = DEFAULT_FORMAT, n: int = 20, order_by: Sequence[Column] = ()
) -> DataFrame:
    """Read a published table, in ``order_by`` if given, print its first ``n`` rows and return it."""
    df = read_table(spark, path, fmt=fmt)
    if order_by:
        df = df.orderBy(*order_by)
    df.show(n, truncate=False)
    return df
