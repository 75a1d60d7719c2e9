"""Dataset specifications: everything the layer jobs need to know about one
source, as a value. One parameterised ``conform`` replaces a hand-written
function per dataset.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tierline.operators.conform import conform
from tierline.operators.quality import (
    ColumnsExist,
    MinRowCount,
    NonNegative,
    NotNull,
    Rule,
    Unique,
    ValidationSuite,
)


@dataclass(frozen=True)
class DatasetSpec:
    """One raw dataset and how it becomes a silver table."""

    name: str
    file: str
    schema: StructType
    encoding: str = "UTF-8"
    renames: Mapping[str, str] = field(default_factory=dict)
    required: Sequence[str] = ()
    keys: Sequence[str] | None = None
    zero_fill: Sequence[str] = ()
    rules: Callable[[], list[Rule]] = list
    # When set, bronze keeps the raw line of malformed rows in this column, so
    # the rows PERMISSIVE parsing nulled out can be counted; silver drops it.
    corrupt_record_column: str | None = None
    # How the job reads the file; see sources.read_csv.
    mode: str = "PERMISSIVE"
    multi_line: bool = False
    enforce_schema: bool = True

    def to_silver(self, bronze: DataFrame, *, seen: dict[str, int] | None = None) -> DataFrame:
        if self.corrupt_record_column and self.corrupt_record_column in bronze.columns:
            bronze = bronze.drop(self.corrupt_record_column)
        return conform(
            bronze,
            renames=self.renames,
            zero_fill=self.zero_fill,
            required=self.required,
            keys=self.keys,
            seen=seen,
        )

    def suite(self) -> ValidationSuite:
        return ValidationSuite(self.name, self.rules())


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


_S, _I = StringType(), IntegerType()

# Fixed values that must equal the reference's: the five source datasets
# (file, encoding, declared schema), their silver renames, required columns,
# de-duplication keys, zero-filled counts and quality rules.
SOURCE_SPECS: dict[str, DatasetSpec] = {
    "athletes": DatasetSpec(
        name="athletes",
        file="Athletes.csv",
        encoding="ISO-8859-1",
        schema=_schema(("PersonName", _S), ("Country", _S), ("Discipline", _S)),
        renames={"PersonName": "person_name", "Country": "country", "Discipline": "discipline"},
        required=("person_name", "country"),
        keys=("person_name", "country", "discipline"),
        rules=lambda: [
            ColumnsExist(["person_name", "country", "discipline"]),
            NotNull(["person_name", "country"]),
            MinRowCount(1000),
            Unique(["person_name", "country", "discipline"]),
        ],
    ),
    "coaches": DatasetSpec(
        name="coaches",
        file="Coaches.csv",
        encoding="ISO-8859-1",
        schema=_schema(("Name", _S), ("Country", _S), ("Discipline", _S), ("Event", _S)),
        renames={"Name": "coach_name", "Country": "country", "Discipline": "discipline", "Event": "event"},
        required=("coach_name", "country"),
        keys=("coach_name", "country", "discipline", "event"),
        rules=lambda: [
            ColumnsExist(["coach_name", "country", "discipline", "event"]),
            NotNull(["coach_name", "country"]),
            MinRowCount(100),
        ],
    ),
    "entriesgender": DatasetSpec(
        name="entriesgender",
        file="EntriesGender.csv",
        encoding="UTF-8",
        schema=_schema(("Discipline", _S), ("Female", _I), ("Male", _I), ("Total", _I)),
        renames={"Discipline": "discipline", "Female": "female", "Male": "male", "Total": "total"},
        required=("discipline",),
        keys=("discipline",),
        zero_fill=("female", "male", "total"),
        rules=lambda: [
            ColumnsExist(["discipline", "female", "male", "total"]),
            NotNull(["discipline"]),
            NonNegative(["female", "male", "total"]),
            Unique(["discipline"]),
        ],
    ),
    "medals": DatasetSpec(
        name="medals",
        file="Medals.csv",
        encoding="UTF-8",
        schema=_schema(
            ("Rank", _I),
            ("TeamCountry", _S),
            ("Gold", _I),
            ("Silver", _I),
            ("Bronze", _I),
            ("Total", _I),
            ("Rank by Total", _I),
        ),
        renames={
            "Rank": "rank",
            "TeamCountry": "country",
            "Gold": "gold",
            "Silver": "silver",
            "Bronze": "bronze",
            "Total": "total",
            "Rank by Total": "rank_by_total",
        },
        required=("country",),
        keys=("country",),
        zero_fill=("gold", "silver", "bronze", "total"),
        rules=lambda: [
            ColumnsExist(["country", "gold", "silver", "bronze", "total"]),
            NotNull(["country"]),
            NonNegative(["gold", "silver", "bronze", "total"]),
            Unique(["country"]),
        ],
    ),
    "teams": DatasetSpec(
        name="teams",
        file="Teams.csv",
        encoding="ISO-8859-1",
        schema=_schema(("TeamName", _S), ("Discipline", _S), ("Country", _S), ("Event", _S)),
        renames={"TeamName": "team_name", "Discipline": "discipline", "Country": "country", "Event": "event"},
        required=("team_name", "country"),
        keys=("team_name", "discipline", "country", "event"),
        rules=lambda: [
            ColumnsExist(["team_name", "discipline", "country", "event"]),
            NotNull(["team_name", "country"]),
            MinRowCount(100),
        ],
    ),
}


def suite_for(dataset: str) -> ValidationSuite:
    """A fresh quality suite for one of the five source datasets (KeyError if unknown)."""
    return SOURCE_SPECS[dataset].suite()
