"""Scalar column expressions used by the layer operators.

Spark 4 runs with ANSI semantics: integer overflow and division by zero raise.
The expressions below therefore widen integer arithmetic to ``bigint`` and use
``nullif`` / ``try_divide`` wherever the result should be NULL instead of an
error.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_string(c: ColumnOrName) -> Column:
    """Collapse every whitespace run to one space, trim, and map '' to NULL.

    NULL stays NULL. ``\\s`` is Java's ASCII class (space, tab, newline,
    vertical tab, form feed, carriage return); NBSP and other Unicode spaces
    are left alone.
    """
    collapsed = F.trim(F.regexp_replace(_col(c), r"\s+", " "))
    return F.nullif(collapsed, F.lit(""))


def weighted_sum(weights: Mapping[str, int]) -> Column:
    """``sum(col * weight)`` over bigint-widened columns; NULL if any part is NULL."""
    terms = [F.col(name).cast("bigint") * F.lit(int(w)) for name, w in weights.items()]
    return reduce(add, terms)


def row_total(columns: Iterable[str]) -> Column:
    """Row-wise sum of the columns, widened to bigint; NULL if any part is NULL."""
    return reduce(add, [F.col(c).cast("bigint") for c in columns])


def safe_divisor(c: ColumnOrName) -> Column:
    """0 -> NULL so a following division yields NULL rather than an error."""
    return F.nullif(_col(c), F.lit(0))


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Unrounded ``numerator / denominator`` as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(_col(numerator), _col(denominator))


def percent(numerator: ColumnOrName, denominator: ColumnOrName, digits: int = 2) -> Column:
    """``round(numerator / denominator * 100, digits)`` (HALF_UP), NULL on a zero denominator.

    The operation order (divide in double, then multiply by 100, then round)
    is part of the contract: it decides the last bits of the double.
    """
    return F.round(ratio(numerator, safe_divisor(denominator)) * F.lit(100), digits)


def any_negative(columns: Iterable[str]) -> Column | None:
    """``c1 < 0 OR c2 < 0 ...``; a NULL operand does not match. None for no columns."""
    clauses = [F.col(c) < 0 for c in columns]
    if not clauses:
        return None
    return reduce(or_, clauses)


def to_int(c: ColumnOrName) -> Column:
    """Cast to int, NULL on malformed or overflowing input (instead of an ANSI error)."""
    return _col(c).try_cast("int")
