"""Layer jobs: raw CSV -> bronze -> silver (gated) -> gold.

Layers meet only through storage, so each job can be re-run alone. Bronze and gold
writes overwrite their own folder; no job overwrites a folder it reads, and a failed
overwrite can leave a partial folder. Silver tables are versioned: each is written
once, as a new version, audited there, and published by one row in the table's log, so
readers see the old version or the new one and a failed gate changes nothing.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierline.operators.conform import stamp_lineage
from tierline.operators.quality import ValidationResult, gate, store_audit
from tierline.plans.marts import presentation_order
from tierline.plans.specs import DatasetSpec
from tierline.sources.tables import (
    DEFAULT_FORMAT,
    new_version,
    publish_version,
    read_csv,
    read_table,
    version_path,
    write_table,
)

logger = logging.getLogger(__name__)

Builder = Callable[[Mapping[str, DataFrame]], DataFrame]

# Independent tables of one layer are submitted as concurrent Spark jobs so
# that small tables do not leave executors idle; every job is still a
# distributed plan of its own.
DEFAULT_CONCURRENT_JOBS = 4


def run_concurrently(tasks: Iterable[Callable[[], None]], max_concurrent: int) -> None:
    """Run independent driver-side job submissions; re-raise the first failure."""
    tasks = list(tasks)
    if max_concurrent <= 1 or len(tasks) <= 1:
        for task in tasks:
            task()
        return
    with ThreadPoolExecutor(max_workers=min(max_concurrent, len(tasks))) as pool:
        for future in [pool.submit(task) for task in tasks]:
            future.result()


def layer_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


@dataclass(frozen=True)
class BronzeCounts:
    """Rows of one raw file, and those that did not parse as its schema says (None where the read mode keeps no such rows)."""

    rows: int
    malformed: int | None


@dataclass(frozen=True)
class SilverCounts:
    """What became of a dataset's bronze rows."""

    rows_read: int
    without_key: int
    duplicates: int
    rows_kept: int


class SilverReport(dict[str, list[ValidationResult]]):
    """Audit results by dataset, in publication order, with the datasets' ``counts`` and the ``published`` versions."""

    def __init__(self) -> None:
        super().__init__()
        self.counts: dict[str, SilverCounts] = {}
        self.published: dict[str, str] = {}


_MALFORMED = "_malformed_line"


def run_bronze(
    spark: SparkSession,
    specs: Mapping[str, DatasetSpec],
    raw_root: str,
    lake_root: str,
    *,
    fmt: str = DEFAULT_FORMAT,
    max_concurrent: int = DEFAULT_CONCURRENT_JOBS,
) -> dict[str, BronzeCounts]:
    """Each raw CSV (declared schema and encoding) + lineage -> one bronze table.

    Rows and malformed rows are counted by the write itself, with no further scan: the
    reader marks a malformed line, the mark is observed and, unless the spec keeps it,
    dropped.
    """
    report: dict[str, BronzeCounts] = {}

    def load(spec: DatasetSpec) -> Callable[[], None]:
        marks = spec.mode.upper() == "PERMISSIVE"
        mark = spec.corrupt_record_column or (_MALFORMED if marks else None)

        def task() -> None:
            raw = read_csv(
                spark,
                f"{raw_root.rstrip('/')}/{spec.file}",
                spec.schema,
                encoding=spec.encoding,
                mode=spec.mode,
                multi_line=spec.multi_line,
                enforce_schema=spec.enforce_schema,
                corrupt_record_column=mark,
            )
            seen = Observation()
            malformed = F.count(F.col(f"`{mark}`")) if marks else F.max(F.lit(None).cast("bigint"))
            raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"), malformed.alias("malformed"))
            if not spec.corrupt_record_column and marks:
                raw = raw.drop(mark)
            write_table(stamp_lineage(raw, spec.file), layer_path(lake_root, "bronze", spec.name), fmt=fmt)
            report[spec.name] = BronzeCounts(seen.get["rows"], seen.get["malformed"])

        return task

    run_concurrently([load(spec) for spec in specs.values()], max_concurrent)
    return {name: report[spec.name] for name, spec in specs.items()}


def run_silver(
    spark: SparkSession,
    specs: Mapping[str, DatasetSpec],
    lake_root: str,
    *,
    fail_fast: bool = True,
    fmt: str = DEFAULT_FORMAT,
    max_concurrent: int = DEFAULT_CONCURRENT_JOBS,
    audit_path: str | None = None,
    run_id: str | None = None,
) -> SilverReport:
    """Conform, audit and publish each dataset.

    Up to ``max_concurrent`` datasets are conformed and audited at once. Each is written
    once, as a new version of its table, and the audit reads that copy, so a lost executor
    costs a re-read, never a re-run of the clean and de-duplicate shuffle.

    Publication follows the order of ``specs``, each dataset as soon as its own audit
    and all earlier publications are done. An error, or with ``fail_fast`` a failed critical
    rule, stops this dataset and every later one; earlier ones stay published, and the
    tables of the others stay as they were.

    ``audit_path`` names a table that keeps all results under ``run_id``
    (see :func:`~tierline.operators.quality.store_audit`), also those of a run that stops.
    """
    if (audit_path is None) != (run_id is None):
        raise ValueError("a stored audit needs both audit_path and run_id")
    report = SilverReport()

    def conformed(spec: DatasetSpec) -> tuple[str, list[ValidationResult], SilverCounts]:
        path, version, seen = layer_path(lake_root, "silver", spec.name), new_version(), {}
        bronze = read_table(spark, layer_path(lake_root, "bronze", spec.name), fmt=fmt)
        write_table(spec.to_silver(bronze, seen=seen), version_path(path, version), fmt=fmt)
        silver = read_table(spark, path, fmt=fmt, version=version)
        read, kept = bronze.count(), silver.count()  # from file footers where the format has them
        keyed = seen.get("rows", kept)
        return version, spec.suite().run(silver, fail_fast=False), SilverCounts(read, read - keyed, keyed - kept, kept)

    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        running = {name: pool.submit(conformed, spec) for name, spec in specs.items()}
        try:
            for name, done in running.items():
                version, report[name], report.counts[name] = done.result()
                if fail_fast:
                    gate(name, report[name])
                publish_version(spark, layer_path(lake_root, "silver", specs[name].name), version)
                report.published[name] = version
        finally:
            pool.shutdown(cancel_futures=True)
            if audit_path is not None:
                store_audit(spark, audit_path, run_id, [r for results in report.values() for r in results])
    return report


def run_gold(
    spark: SparkSession,
    builders: Mapping[str, Builder],
    silver_names: list[str],
    lake_root: str,
    *,
    fmt: str = DEFAULT_FORMAT,
    max_concurrent: int = DEFAULT_CONCURRENT_JOBS,
) -> None:
    """Read every silver table from storage, build and write each mart."""
    silver = {n: read_table(spark, layer_path(lake_root, "silver", n), fmt=fmt) for n in silver_names}

    def publish(name: str, build: Builder) -> Callable[[], None]:
        return lambda: write_table(build(silver), layer_path(lake_root, "gold", name), fmt=fmt)

    run_concurrently([publish(n, b) for n, b in builders.items()], max_concurrent)


def read_mart(spark: SparkSession, lake_root: str, name: str, *, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A published mart in its presentation order (ties broken, so every read agrees)."""
    return read_table(spark, layer_path(lake_root, "gold", name), fmt=fmt).orderBy(*presentation_order(name))


def run_all(
    spark: SparkSession,
    specs: Mapping[str, DatasetSpec],
    builders: Mapping[str, Builder],
    raw_root: str,
    lake_root: str,
    *,
    fail_fast: bool = True,
    fmt: str = DEFAULT_FORMAT,
    max_concurrent: int = DEFAULT_CONCURRENT_JOBS,
    audit_path: str | None = None,
    run_id: str | None = None,
) -> SilverReport:
    """bronze -> silver -> gold, strictly in that order; logs the elapsed time."""
    start = time.monotonic()
    run_bronze(spark, specs, raw_root, lake_root, fmt=fmt, max_concurrent=max_concurrent)
    report = run_silver(
        spark, specs, lake_root, fail_fast=fail_fast, fmt=fmt, max_concurrent=max_concurrent, audit_path=audit_path, run_id=run_id
    )
    run_gold(spark, builders, list(specs), lake_root, fmt=fmt, max_concurrent=max_concurrent)
    logger.info("layers built in %.1fs", time.monotonic() - start)
    return report
