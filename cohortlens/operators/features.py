"""log1p transform and population z-score (SCL-8, FEA-1, FEA-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.stats import zscore

RAW_COLS = ("Recency", "Frequency", "Monetary")
LOG_COLS = ("R_log", "F_log", "M_log")
SCALED_COLS = ("R_scaled", "F_scaled", "M_scaled")


def log_transform(
    df: DataFrame, cols: Sequence[str] = RAW_COLS, out: Sequence[str] = LOG_COLS
) -> DataFrame:
    """FEA-1: natural log of 1 + x for each column (a projection)."""
    return df.withColumns({o: F.log1p(F.col(c).cast("double")) for c, o in zip(cols, out)})


def scale_features(
    df: DataFrame, cols: Sequence[str] = LOG_COLS, out: Sequence[str] = SCALED_COLS
) -> DataFrame:
    """FEA-2: (x - mean) / population std, std 0 -> divide by 1.

    The means and stds are uncorrelated scalar subqueries over the same
    plan; Catalyst merges them into one aggregate (partial per task) whose
    single row is inlined into the projection: no join, no driver round trip.
    """
    stats = {}
    for c in cols:
        stats[c] = (
            df.select(F.avg(c)).scalar(),
            df.select(F.stddev_pop(c)).scalar(),
        )
    return df.withColumns({o: zscore(F.col(c), *stats[c]) for c, o in zip(cols, out)})


def rfm_features(rfm: DataFrame) -> DataFrame:
    """log1p + z-score, keeping the raw R/F/M columns for later profiling."""
    return scale_features(log_transform(rfm))
