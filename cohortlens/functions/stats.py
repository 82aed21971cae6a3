"""Statistical column expressions matching pandas / scikit-learn."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_skewness(c: Column) -> Column:
    """Bias-adjusted sample skewness (pandas ``Series.skew``), an aggregate.

    Spark's ``skewness`` is the population form g1; pandas reports
    G1 = g1 * sqrt(n (n - 1)) / (n - 2). Fewer than 3 values give null and
    a constant column gives 0, as in pandas.
    """
    n = F.count(c).cast("double")
    g1 = F.skewness(c)
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(F.var_pop(c) == 0, F.lit(0.0))
        .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2))
    )


def zscore(c: Column, mean: Column, sd_pop: Column) -> Column:
    """Standard score with the population std; zero variance divides by 1."""
    return (c - mean) / F.when(sd_pop == 0, F.lit(1.0)).otherwise(sd_pop)
