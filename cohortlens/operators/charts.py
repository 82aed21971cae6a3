"""Tables behind the reference's charts (AGG-14..17, PIV-1..4, CHT-3, SET-2).

Inputs are temporal profiles (one row per cluster x slot), so every
operation here runs on a table whose size is bounded by clusters x 504.
"unique_customers" is summed over finer cells, as in the reference: a
customer active in two cells counts twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.config import TemporalConfig
from cohortlens.functions.scalar import WEEKDAY_NAMES, ordinal

HOURS = tuple(range(24))


def share_matrix(
    profile: DataFrame,
    row_keys: Sequence[str],
    col_key: str,
    col_values: Sequence,
    col_names: Sequence[str] | None = None,
    value_col: str = "unique_customers",
) -> DataFrame:
    """Sum ``value_col`` per (row, column), normalise each row to sum 1 and
    pivot to one column per listed value (absent cells are 0).

    Listing the values keeps the pivot to a single aggregation job.
    """
    sums = profile.groupBy(*row_keys, col_key).agg(F.sum(value_col).alias("_v"))
    total = F.sum("_v").over(Window.partitionBy(*row_keys))
    long = sums.select(*row_keys, col_key, (F.col("_v") / total).alias("_share"))
    wide = long.groupBy(*row_keys).pivot(col_key, list(col_values)).agg(F.first("_share"))
    names = list(col_names) if col_names else [str(v) for v in col_values]
    wide = wide.select(*row_keys, *[F.col(str(v)).alias(n) for v, n in zip(col_values, names)])
    return wide.fillna(0.0, subset=names)


def hour_share(profile: DataFrame, cluster_col: str = "Cluster") -> DataFrame:
    """PIV-1: cluster x hour (h0..h23) share of unique customers."""
    return share_matrix(profile, [cluster_col], "hour", HOURS, [f"h{h}" for h in HOURS]).orderBy(cluster_col)


def dow_share(profile: DataFrame, cluster_col: str = "Cluster") -> DataFrame:
    """PIV-2: cluster x weekday (Monday first) share of unique customers."""
    return share_matrix(profile, [cluster_col], "day_of_week", WEEKDAY_NAMES).orderBy(cluster_col)


def dow_hour_share(profile: DataFrame) -> DataFrame:
    """PIV-3: weekday x hour share, normalised within each weekday; rows
    Monday first (``dow_num`` carries the order)."""
    wide = share_matrix(profile, ["day_of_week"], "hour", HOURS, [f"h{h}" for h in HOURS])
    dow = ordinal(F.col("day_of_week"), WEEKDAY_NAMES).alias("dow_num")
    return wide.select("day_of_week", dow, *[f"h{h}" for h in HOURS]).orderBy("dow_num")


def period_share(
    profile: DataFrame, cluster_col: str = "Cluster", tcfg: TemporalConfig = TemporalConfig()
) -> DataFrame:
    """PIV-4: cluster x month period (Early, Mid, Late) share."""
    return share_matrix(profile, [cluster_col], "month_period", tcfg.labels).orderBy(cluster_col)


def dow_ranking(profile: DataFrame, cluster_col: str = "Cluster") -> DataFrame:
    """CHT-3 (+ SRT-4, FLT-7 as one table): weekdays ranked by summed unique
    customers within each cluster; ties go to the earlier weekday."""
    sums = profile.groupBy(cluster_col, "day_of_week").agg(
        F.sum("unique_customers").cast("long").alias("unique_customers")
    )
    rank = F.row_number().over(
        Window.partitionBy(cluster_col).orderBy(
            F.desc("unique_customers"), ordinal(F.col("day_of_week"), WEEKDAY_NAMES)
        )
    )
    return sums.withColumn("rank", rank.cast("int")).orderBy(cluster_col, "rank")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """SET-2: sorted distinct values of a column."""
    return df.select(col).distinct().orderBy(col)
