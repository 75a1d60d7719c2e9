"""Property tests against brute-force Python models of the operators."""

from __future__ import annotations

import os
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierline.operators.conform import clean_strings, dedupe
from tierline.operators.quality import NonNegative, NotNull, Unique, ValidationSuite

EXAMPLES = int(os.environ.get("TIERLINE_PROPERTY_EXAMPLES", "10"))
SETTINGS = settings(
    max_examples=EXAMPLES,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

small_int = st.one_of(st.none(), st.integers(-3, 3))
small_str = st.one_of(st.none(), st.sampled_from(["", "a", "b", " a", "B"]))


def _nulls_first(value):
    return (value is not None, value)


@SETTINGS
@given(rows=st.lists(st.tuples(small_int, small_str, small_int, small_str), min_size=0, max_size=60))
def test_dedupe_keeps_smallest_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, k2 string, a int, b string")
    def order(row):
        return tuple(_nulls_first(x) for x in row)

    got = sorted((tuple(r) for r in dedupe(df, ["k", "k2"]).collect()), key=order)
    best = {}
    for k, k2, a, b in rows:
        rank = (_nulls_first(a), _nulls_first(b))
        if (k, k2) not in best or rank < best[(k, k2)][0]:
            best[(k, k2)] = (rank, (k, k2, a, b))
    expected = sorted((v[1] for v in best.values()), key=order)
    assert got == expected


@SETTINGS
@given(rows=st.lists(st.tuples(small_int, small_str, small_int), min_size=0, max_size=60))
def test_audit_rules_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a int, s string, b int")
    results = ValidationSuite(
        "t", [NotNull(["a", "s"]), Unique(["a", "s"]), NonNegative(["a", "b"])]
    ).run(df, fail_fast=False)
    nulls = {c: sum(1 for r in rows if r[i] is None) for c, i in (("a", 0), ("s", 1))}
    offenders = {c: n for c, n in nulls.items() if n > 0}
    surplus = len(rows) - len({(r[0], r[1]) for r in rows})
    negative = sum(1 for r in rows if (r[0] is not None and r[0] < 0) or (r[2] is not None and r[2] < 0))
    assert results[0].observed == offenders and results[0].passed == (not offenders)
    assert results[1].observed == surplus and results[1].passed == (surplus == 0)
    assert results[2].observed == negative and results[2].passed == (negative == 0)


_JAVA_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
text = st.text(
    alphabet=st.sampled_from(list("ab \t\n\x0b\f\r") + [" ", "　", "\x1c", "é"]), max_size=20
)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), text), min_size=1, max_size=40))
def test_clean_string_matches_java_whitespace_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string")
    got = {r["id"]: r["s"] for r in clean_strings(df).collect()}
    for i, v in enumerate(values):
        if v is None:
            assert got[i] is None
            continue
        cleaned = _JAVA_SPACE.sub(" ", v).strip(" ")
        assert got[i] == (cleaned or None)
