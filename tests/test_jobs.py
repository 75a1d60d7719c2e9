"""Layer jobs end to end on medal-table CSVs, the gate and re-runs."""

from __future__ import annotations

import os

import pytest

from tierline.operators.quality import DataQualityError, NotNull, read_audit
from tierline.plans.jobs import BronzeCounts, SilverCounts, layer_path, run_all, run_bronze, run_silver
from tierline.plans.marts import GOLD_BUILDERS
from tierline.plans.specs import SOURCE_SPECS
from tierline.sources.tables import current_version, published_versions, read_table

MEDALS = (
    "Rank,TeamCountry,Gold,Silver,Bronze,Total,Rank by Total\n"
    "1,Norland,7,4,2,13,1\n"
    "2,O'Dale Isles,5,5,5,15,2\n"
    '3,"Westmark, North",1,0,6,7,3\n'
    "4,Çédille,0,0,1,1,4\n"
)
ENTRIES = "Discipline,Female,Male,Total\nCurling,30,50,80\nRelay,12,0,12\nFencing,,40,\n"
ATHLETES = (
    "PersonName,Country,Discipline\n"
    "Mara  Quill ,Norland,Relay\n"
    "Mara Quill,Norland,Relay\n"
    "Ivo Brandt,Çédille,Fencing\n"
    "Lio Tan,Farholm,Curling\n"
    "No Country, \t,Curling\n"
)
COACHES = "Name,Country,Discipline,Event\nRen Ode,Farholm,Curling,\n"
TEAMS = "TeamName,Discipline,Country,Event\nStones,Curling,Farholm,Mixed\nStones,Curling,Farholm,Mixed\n"


def _raw(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "Medals.csv").write_bytes(MEDALS.encode("utf-8"))
    (raw / "EntriesGender.csv").write_bytes(ENTRIES.encode("utf-8"))
    (raw / "Athletes.csv").write_bytes(ATHLETES.encode("latin-1"))
    (raw / "Coaches.csv").write_bytes(COACHES.encode("latin-1"))
    (raw / "Teams.csv").write_bytes(TEAMS.encode("latin-1"))
    return str(raw)


def test_gate_blocks_publication(spark, tmp_path):
    raw, lake = _raw(tmp_path), str(tmp_path / "lake")
    # athletes need >= 1000 rows: the gate raises before athletes' silver write.
    with pytest.raises(DataQualityError, match="MinRowCount"):
        run_all(spark, SOURCE_SPECS, GOLD_BUILDERS, raw, lake)
    assert not (tmp_path / "lake" / "silver" / "athletes").exists()
    assert not (tmp_path / "lake" / "gold").exists()


def test_full_run_in_warn_mode(spark, tmp_path):
    raw, lake = _raw(tmp_path), str(tmp_path / "lake")
    report = run_all(spark, SOURCE_SPECS, GOLD_BUILDERS, raw, lake, fail_fast=False)
    assert not [r for r in report["athletes"] if r.rule == "MinRowCount"][0].passed
    bronze = read_table(spark, layer_path(lake, "bronze", "medals"))
    assert "Rank by Total" in bronze.columns and "_ingested_at" in bronze.columns
    assert bronze.first()["_source_file"] == "Medals.csv"

    perf = {r["country"]: r for r in read_table(spark, layer_path(lake, "gold", "country_performance")).collect()}
    # Latin-1 athletes join UTF-8 medals on the same decoded name.
    assert perf["Çédille"]["total_medals"] == 1
    assert perf["Farholm"]["total_medals"] == 0
    assert perf["Norland"]["athlete_count"] == 1  # trimmed copy collapsed
    assert perf["Norland"]["medals_per_100_athletes"] == 1300.0

    entries = {r["discipline"]: r for r in read_table(spark, layer_path(lake, "gold", "gender_participation")).collect()}
    assert entries["Fencing"]["female"] == 0 and entries["Fencing"]["female_pct"] is None
    assert entries["Relay"]["female_pct"] == 100.0

    standings = read_table(spark, layer_path(lake, "gold", "medal_standings"))
    top = standings.orderBy("rank_by_points").first()
    assert (top["country"], top["medal_points"], top["rank_by_points"]) == ("Norland", 31, 1)
    teams = read_table(spark, layer_path(lake, "silver", "teams"))
    assert teams.count() == 1


def test_rerun_gives_same_tables(spark, tmp_path):
    raw, lake = _raw(tmp_path), str(tmp_path / "lake")
    specs = {k: SOURCE_SPECS[k] for k in ("medals", "entriesgender")}

    def snapshot():
        run_bronze(spark, specs, raw, lake)
        run_silver(spark, specs, lake)
        t = read_table(spark, layer_path(lake, "silver", "medals")).drop("_ingested_at")
        return sorted(tuple(r) for r in t.collect())

    assert snapshot() == snapshot()


def test_gate_publishes_in_order_up_to_first_failure(spark, tmp_path):
    raw, lake = _raw(tmp_path), str(tmp_path / "lake")
    order = ["medals", "entriesgender", "athletes", "coaches", "teams"]
    specs = {k: SOURCE_SPECS[k] for k in order}
    run_bronze(spark, specs, raw, lake)
    with pytest.raises(DataQualityError, match="athletes"):
        run_silver(spark, specs, lake)
    silver = tmp_path / "lake" / "silver"
    assert (silver / "medals").exists() and (silver / "entriesgender").exists()
    assert not any((silver / n).exists() for n in ("athletes", "coaches", "teams"))


def test_silver_report_counts_rows(spark, tmp_path):
    raw, lake = _raw(tmp_path), str(tmp_path / "lake")
    specs = {k: SOURCE_SPECS[k] for k in ("medals", "entriesgender", "teams", "athletes")}
    assert run_bronze(spark, specs, raw, lake) == {
        "medals": BronzeCounts(4, 0),
        "entriesgender": BronzeCounts(3, 0),
        "teams": BronzeCounts(2, 0),
        "athletes": BronzeCounts(5, 0),
    }
    report = run_silver(spark, specs, lake, fail_fast=False)
    assert [r.passed for r in report["teams"]] == [True, True, False]
    medals = read_table(spark, layer_path(lake, "silver", "medals"))
    assert medals.count() == 4 and "_ingested_at" in medals.columns
    assert list(report.published) == list(specs)
    assert report.counts["athletes"] == SilverCounts(rows_read=5, without_key=1, duplicates=1, rows_kept=3)
    assert report.counts["teams"] == SilverCounts(2, 0, 1, 1)
    unkeyed = {"athletes": dataclasses_replace(SOURCE_SPECS["athletes"], keys=None)}
    assert run_silver(spark, unkeyed, lake, fail_fast=False).counts["athletes"] == SilverCounts(5, 1, 0, 4)


def _silver_writes(spark, lake, specs):
    """Folders of table versions that hold data, by table."""
    root = os.path.join(lake, "silver", "_versions")
    return {n: len(os.listdir(os.path.join(root, n))) for n in sorted(os.listdir(root))}


def test_one_write_per_table_and_a_failed_gate_keeps_the_old_version(spark, tmp_path):
    raw, lake = _raw(tmp_path), str(tmp_path / "lake")
    small = {"medals": SOURCE_SPECS["medals"], "athletes": dataclasses_replace(SOURCE_SPECS["athletes"], rules=lambda: [NotNull(["country"])])}
    run_bronze(spark, small, raw, lake)
    first = run_silver(spark, small, lake)
    assert _silver_writes(spark, lake, small) == {"athletes": 1, "medals": 1}
    path = layer_path(lake, "silver", "athletes")
    before = sorted(map(str, read_table(spark, path).collect()))
    with pytest.raises(DataQualityError, match="MinRowCount"):
        run_silver(spark, {"medals": SOURCE_SPECS["medals"], "athletes": SOURCE_SPECS["athletes"]}, lake)
    assert sorted(map(str, read_table(spark, path).collect())) == before
    assert current_version(spark, path) == first.published["athletes"]
    assert current_version(spark, layer_path(lake, "silver", "medals")) != first.published["medals"]
    assert published_versions(spark, layer_path(lake, "silver", "medals")).count() == 2
    old = read_table(spark, layer_path(lake, "silver", "medals"), version=first.published["medals"])
    assert old.count() == 4


@pytest.mark.parametrize("max_concurrent", [1, 4])
def test_an_error_in_one_dataset_keeps_the_earlier_ones_published(spark, tmp_path, max_concurrent):
    raw, lake = _raw(tmp_path), str(tmp_path / "lake")
    order = ["medals", "entriesgender", "teams", "coaches", "athletes"]
    specs = {k: dataclasses_replace(SOURCE_SPECS[k], rules=list) for k in order}
    run_bronze(spark, specs, raw, lake)
    specs["teams"] = dataclasses_replace(specs["teams"], keys=("no_such_column",))
    with pytest.raises(ValueError, match="no_such_column"):
        run_silver(spark, specs, lake, max_concurrent=max_concurrent)
    assert [current_version(spark, layer_path(lake, "silver", n)) is not None for n in order] == [True, True, False, False, False]


def test_stored_audit_keeps_runs_and_replaces_a_repeat(spark, tmp_path):
    raw, lake, kept = _raw(tmp_path), str(tmp_path / "lake"), str(tmp_path / "audit")
    specs = {k: SOURCE_SPECS[k] for k in ("medals", "athletes", "teams")}
    run_bronze(spark, specs, raw, lake)
    for run in ("r1", "2024", "r1"):
        with pytest.raises(DataQualityError, match="athletes"):
            run_silver(spark, specs, lake, audit_path=kept, run_id=run)
    rows = read_audit(spark, kept).orderBy("run_id", "place").collect()
    assert [(r.run_id, r.dataset, r.rule) for r in rows[:4]] == [("2024", "medals", x) for x in ("ColumnsExist", "NotNull", "NonNegative", "Unique")]
    assert len(rows) == 2 * 8 and {r.run_id for r in rows} == {"2024", "r1"}
    assert [(r.rule, r.observed) for r in rows if r.run_id == "r1" and not r.passed] == [("MinRowCount", "3")]
    with pytest.raises(ValueError, match="run_id"):
        run_silver(spark, specs, lake, audit_path=kept)


def test_bronze_keeps_corrupt_lines_when_asked(spark, tmp_path):
    import dataclasses

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "Medals.csv").write_text(
        "Rank,TeamCountry,Gold,Silver,Bronze,Total,Rank by Total\n"
        "1,Norland,7,4,2,13,1\n"
        "2,Farholm,seven,4,2,13,2\n"
    )
    spec = dataclasses.replace(SOURCE_SPECS["medals"], corrupt_record_column="_corrupt_record")
    lake = str(tmp_path / "lake")
    assert run_bronze(spark, {"medals": spec}, str(raw), lake) == {"medals": BronzeCounts(2, 1)}
    plain = str(tmp_path / "plain")
    assert run_bronze(spark, {"medals": SOURCE_SPECS["medals"]}, str(raw), plain) == {"medals": BronzeCounts(2, 1)}
    assert "_malformed_line" not in read_table(spark, layer_path(plain, "bronze", "medals")).columns
    bronze = read_table(spark, layer_path(lake, "bronze", "medals"))
    assert bronze.where("_corrupt_record IS NOT NULL").count() == 1
    silver = spec.to_silver(bronze)
    assert "_corrupt_record" not in silver.columns
    assert {r["country"]: r["gold"] for r in silver.collect()} == {"Norland": 7, "Farholm": 0}


def test_concurrent_bronze_failure_propagates(spark, tmp_path):
    raw = _raw(tmp_path)
    specs = dict(SOURCE_SPECS)
    specs["ghost"] = dataclasses_replace(SOURCE_SPECS["teams"], name="ghost", file="Missing.csv")
    with pytest.raises(Exception, match="(?i)path does not exist|PATH_NOT_FOUND"):
        run_bronze(spark, specs, raw, str(tmp_path / "lake"))


def dataclasses_replace(spec, **changes):
    import dataclasses

    return dataclasses.replace(spec, **changes)


def test_a_spec_chooses_how_its_file_is_read(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "EntriesGender.csv").write_text("Discipline,Female,Male,Total\n\"Two\nlines\",1,2,3\nRelay,x,2,3\n")
    spec = dataclasses_replace(SOURCE_SPECS["entriesgender"], multi_line=True, mode="DROPMALFORMED")
    lake = str(tmp_path / "lake")
    assert run_bronze(spark, {"entriesgender": spec}, str(raw), lake) == {"entriesgender": BronzeCounts(1, None)}
    assert [r["Discipline"] for r in read_table(spark, layer_path(lake, "bronze", "entriesgender")).collect()] == ["Two\nlines"]
