"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage code generation; none is a Python UDF."""

from tierline.functions.columns import (
    any_negative,
    clean_string,
    percent,
    ratio,
    row_total,
    safe_divisor,
    to_int,
    weighted_sum,
)

__all__ = [
    "any_negative",
    "clean_string",
    "percent",
    "ratio",
    "row_total",
    "safe_divisor",
    "to_int",
    "weighted_sum",
]
