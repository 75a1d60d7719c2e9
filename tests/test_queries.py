"""Every registered query against its DuckDB SQL, and the driver entry points."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_check import compare
from tierline.plans import queries as _q

#: The library's own queries; those of the optional corpus package are tested with it.
NAMES = sorted(_q.QUERIES)


def test_every_query_has_sql():
    assert set(_q.ORACLE) == set(_q.QUERIES)
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == [
        "country",
        "gold",
        "silver",
        "bronze",
        "total_medals",
        "medal_points",
        "rank_by_points",
        "rank_by_total_medals",
    ]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    con = duck(SF_SMALL)
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert res["cols"] and res["rows"] and res["values"], res["detail"]


def test_entry_module_loads_by_path(spark):
    import importlib.util
    import os

    from tests.conftest import ROOT

    spec = importlib.util.spec_from_file_location("entry_by_path", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(NAMES) <= set(module.oracle_sql()) <= set(module.queries())
    assert module.entry(spark).count() > 0


def test_entry_module_loads_without_optional_packages(monkeypatch):
    """Without a package that only the corpus operators need, all other queries are there."""
    import importlib.util
    import os
    import sys

    from tests.conftest import ROOT

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)  # importing it now fails, as with a missing package
    spec = importlib.util.spec_from_file_location("entry_without", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(module.queries()) == set(module.oracle_sql()) == set(NAMES)
