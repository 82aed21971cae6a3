"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from cohortlens.functions.scalar import (
    WEEKDAY_NAMES,
    cut,
    full_days_between,
    is_missing,
    normalize_id,
    ordinal,
    parse_timestamp,
    starts_with_flag,
    weekday_name,
)
from cohortlens.functions.stats import adjusted_skewness, zscore

__all__ = [
    "WEEKDAY_NAMES",
    "adjusted_skewness",
    "cut",
    "full_days_between",
    "is_missing",
    "normalize_id",
    "ordinal",
    "parse_timestamp",
    "starts_with_flag",
    "weekday_name",
    "zscore",
]
