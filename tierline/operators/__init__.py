"""DataFrame -> DataFrame operators."""

from tierline.operators.conform import (
    LINEAGE_COLUMNS,
    clean_strings,
    conform,
    dedupe,
    drop_null_keys,
    fill_zero,
    rename_columns,
    stamp_lineage,
)
from tierline.operators.measures import (
    MEDAL_WEIGHTS,
    conditional_counts,
    headcount_and_breadth,
    rate_per_100,
    share_of_total,
    weighted_standings,
)
from tierline.operators.quality import (
    ColumnsExist,
    DataQualityError,
    MinRowCount,
    NonNegative,
    NotNull,
    Rule,
    Unique,
    ValidationResult,
    ValidationSuite,
    audit,
)
from tierline.operators.ranking import RankSpec, global_rank, global_ranks, top_k

__all__ = [
    "LINEAGE_COLUMNS",
    "MEDAL_WEIGHTS",
    "ColumnsExist",
    "DataQualityError",
    "MinRowCount",
    "NonNegative",
    "NotNull",
    "RankSpec",
    "Rule",
    "Unique",
    "ValidationResult",
    "ValidationSuite",
    "audit",
    "clean_strings",
    "conditional_counts",
    "conform",
    "dedupe",
    "drop_null_keys",
    "fill_zero",
    "global_rank",
    "global_ranks",
    "headcount_and_breadth",
    "rate_per_100",
    "rename_columns",
    "share_of_total",
    "stamp_lineage",
    "top_k",
    "weighted_standings",
]
