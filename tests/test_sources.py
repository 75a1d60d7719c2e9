"""CSV scans with declared schemas, encodings, table I/O and export."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tierline.sources.tables import (
    export_csv,
    read_csv,
    read_csv_inferred,
    read_table,
    write_table,
)

SCHEMA = StructType(
    [
        StructField("Rank", IntegerType()),
        StructField("TeamCountry", StringType()),
        StructField("Gold", IntegerType()),
    ]
)


def _write(path, text: str, encoding: str = "utf-8") -> str:
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_permissive_corrupt_rows(spark, tmp_path):
    text = "Rank,TeamCountry,Gold\n1,USA,x9\n2,,3\n3,Japan\n4,Fiji,1,99\n6,\"\",2\n7,  Pad  ,2147483648\n"
    path = _write(tmp_path / "m.csv", text)
    rows = [tuple(r) for r in read_csv(spark, path, SCHEMA).collect()]
    assert rows == [
        (1, "USA", None),
        (2, None, 3),
        (3, "Japan", None),
        (4, "Fiji", 1),
        (6, None, 2),
        (7, "  Pad  ", None),
    ]
    with_bad = read_csv(spark, path, SCHEMA, corrupt_record_column="_bad").cache()
    flagged = sorted(r["Rank"] for r in with_bad.where("_bad IS NOT NULL").collect())
    assert flagged == [1, 3, 4, 7]


def test_quoted_comma(spark, tmp_path):
    path = _write(tmp_path / "m.csv", 'Rank,TeamCountry,Gold\n50,"Hong Kong, China",1\n')
    assert read_csv(spark, path, SCHEMA).first()["TeamCountry"] == "Hong Kong, China"


def test_latin1_decoding(spark, tmp_path):
    path = _write(tmp_path / "a.csv", "Rank,TeamCountry,Gold\n1,Côte d'Ivoire,0\n", "latin-1")
    assert read_csv(spark, path, SCHEMA, encoding="ISO-8859-1").first()["TeamCountry"] == "Côte d'Ivoire"
    assert read_csv(spark, path, SCHEMA).first()["TeamCountry"] != "Côte d'Ivoire"


def test_multiline_option(spark, tmp_path):
    path = _write(tmp_path / "m.csv", 'Rank,TeamCountry,Gold\n1,"two\nlines",3\n2,b,4\n')
    assert read_csv(spark, path, SCHEMA, multi_line=True).count() == 2


def test_export_and_inferred_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", -1.0)], "k int, s string, d double")
    out = str(tmp_path / "export")
    export_csv(df, out, num_files=1)
    back = read_csv_inferred(spark, out)
    assert dict(back.dtypes) == {"k": "int", "s": "string", "d": "double"}
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a", 2.5), (2, "b", -1.0)]


def test_latin1_roundtrip_via_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "Côte d'Ivoire", 0)], SCHEMA)
    out = str(tmp_path / "latin")
    export_csv(df, out, encoding="ISO-8859-1")
    assert read_csv(spark, out, SCHEMA, encoding="ISO-8859-1").first()["TeamCountry"] == "Côte d'Ivoire"


def test_partitioned_write_keeps_declared_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "01"), (2, "01"), (3, "2")], "v int, p string")
    out = str(tmp_path / "parts")
    write_table(df, out, partition_by=["p"])
    assert dict(read_table(spark, out).dtypes)["p"] == "int"  # re-typed from folder names
    typed = read_table(spark, out, schema=StructType([StructField("v", IntegerType()), StructField("p", StringType())]))
    assert sorted(tuple(r) for r in typed.collect()) == [(1, "01"), (2, "01"), (3, "2")]


def test_overwrite_is_idempotent_and_replaces_schema(spark, tmp_path):
    out = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1,)], "a int"), out)
    write_table(spark.createDataFrame([("x", 2)], "b string, c int"), out)
    back = read_table(spark, out)
    assert back.columns == ["b", "c"] and back.count() == 1


def test_lenient_int_cast(spark):
    from tierline.functions.columns import to_int

    df = spark.createDataFrame([("12",), ("x9",), ("2147483648",), (None,), (" 7 ",)], "s string")
    got = [r["i"] for r in df.select(to_int("s").alias("i")).collect()]
    assert got == [12, None, None, None, 7]


def test_show_table_reads_and_prints(spark, tmp_path, capsys):
    from tierline.sources.tables import show_table

    out = str(tmp_path / "mart")
    write_table(spark.createDataFrame([("A", 1)], "country string, n int"), out)
    df = show_table(spark, out, n=5)
    assert df.count() == 1
    assert "country" in capsys.readouterr().out


def test_max_records_per_file_bounds_file_sizes(spark, tmp_path):
    import glob

    out = str(tmp_path / "bounded")
    write_table(spark.range(100).coalesce(1), out, max_records_per_file=10)
    files = glob.glob(f"{out}/*.parquet")
    assert len(files) == 10
    assert read_table(spark, out).count() == 100


def test_export_file_count(spark, tmp_path):
    import glob

    out = str(tmp_path / "three")
    export_csv(spark.range(1000), out, num_files=3)
    assert len(glob.glob(f"{out}/*.csv")) == 3
    assert read_csv_inferred(spark, out).count() == 1000


def _sized(spark, target: str):
    """A session that differs in the target size of shuffled parts only."""
    session = spark.newSession()
    for key in ("advisoryPartitionSizeInBytes", "rebalancePartitionsSmallPartitionFactor"):
        session.conf.set(f"spark.sql.adaptive.{key}", target if key.startswith("adv") else "0.2")
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    session.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    return session


def test_partitioned_write_leaves_few_files_and_splits_a_hot_value(spark, tmp_path):
    import glob
    import os

    session = _sized(spark, "256k")
    rows = session.range(0, 120_000, 1, 24).select(
        F.when(F.col("id") % 4 > 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id") % 20)).alias("v"), F.xxhash64("id").alias("x")
    )
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    write_table(rows, few, partition_by=["v"])
    write_table(rows, many, partition_by=["v"], rebalance=False)
    count = lambda root, v: len(glob.glob(f"{root}/v={v}/*.parquet"))
    assert count(many, "hot") == 24 and count(many, "v4") == 24
    assert count(few, "v4") == 1
    assert 2 <= count(few, "hot") <= 8  # several tasks share the hot value
    sizes = [os.path.getsize(f) for f in glob.glob(f"{few}/v=hot/*.parquet")]
    assert max(sizes) <= 512 << 10
    assert read_table(session, few, schema=rows.schema).select("v", "x").exceptAll(rows).count() == 0
    assert read_table(session, few).count() == 120_000


def test_export_by_size(spark, tmp_path):
    import glob
    import os

    session = _sized(spark, "128k")
    rows = session.range(0, 60_000, 1, 40).select(F.xxhash64("id").alias("x"), F.xxhash64("x").alias("y"))
    by_size, as_is = str(tmp_path / "a"), str(tmp_path / "b")
    export_csv(rows, by_size, by_size=True)
    export_csv(rows, as_is)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{by_size}/*.csv")]
    assert len(glob.glob(f"{as_is}/*.csv")) == 40
    assert 4 <= len(sizes) <= 25 and max(sizes) < 1 << 20  # 128 KB of shuffled rows make at most some 400 KB of text
    assert read_csv(session, by_size, rows.schema).exceptAll(rows).count() == 0
    with pytest.raises(ValueError, match="not both"):
        export_csv(rows, by_size, num_files=2, by_size=True)


def test_versions_are_read_as_published(spark, tmp_path):
    from tierline.sources.tables import current_version, new_version, publish_version, version_path

    path = str(tmp_path / "layer" / "t")
    versions = [new_version() for _ in range(3)]
    for i, v in enumerate(versions):
        write_table(spark.range(i + 1), version_path(path, v))
    assert current_version(spark, path) is None
    for i in (0, 2, 0):
        publish_version(spark, path, versions[i])
        assert current_version(spark, path) == versions[i]
        assert read_table(spark, path).count() == i + 1
    assert read_table(spark, path, version=versions[1]).count() == 2
