"""Cluster profiles (AGG-7, AGG-8, SRT-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.stats import exact_quantiles

RFM_COLS = ("Recency", "Frequency", "Monetary")


def cluster_medians(
    df: DataFrame,
    cluster_col: str = "Cluster",
    cols: Sequence[str] = RFM_COLS,
    digits: int | None = 4,
) -> DataFrame:
    """AGG-8 / CHT-2: exact median of each column per cluster, one row per cluster.

    Uses ``exact_quantiles``, so no task holds a whole cluster.
    """
    q = exact_quantiles(df, cols, [0.5], [cluster_col])
    out = q.groupBy(cluster_col).agg(
        *[F.max(F.when(F.col("field") == c, F.col("value"))).alias(f"{c}_median") for c in cols]
    )
    if digits is not None:
        out = out.select(cluster_col, *[F.round(f"{c}_median", digits).alias(f"{c}_median") for c in cols])
    return out


def cluster_profile(
    df: DataFrame,
    cluster_col: str = "Cluster",
    id_col: str = "CustomerID",
    cols: Sequence[str] = RFM_COLS,
    digits: int | None = 4,
) -> DataFrame:
    """AGG-7: customers, mean and median of R, F, M per cluster, by Monetary_mean desc.

    Means and counts come with the medians (``exact_quantiles``).
    Customers counts non-null ids (R, F, M are non-null per customer).
    """
    base = df.filter(F.col(id_col).isNotNull()) if id_col in df.columns else df
    q = exact_quantiles(base, cols, [0.5], [cluster_col])
    joined = q.groupBy(cluster_col).agg(
        F.max("n").cast("long").alias("Customers"),
        *[F.max(F.when(F.col("field") == c, F.col("mean"))).alias(f"{c}_mean") for c in cols],
        *[F.max(F.when(F.col("field") == c, F.col("value"))).alias(f"{c}_median") for c in cols],
    )

    def r(c: str):
        return F.round(c, digits).alias(c) if digits is not None else F.col(c)

    ordered = [x for c in cols for x in (f"{c}_mean", f"{c}_median")]
    return joined.select(cluster_col, "Customers", *[r(c) for c in ordered]).orderBy(
        F.desc("Monetary_mean"), cluster_col
    )
