"""When segments are active (SCL-9..15, AGG-9..13, WIN-1, WIN-2, TOP-3, TOP-4).

Scale notes
-----------
- ``activity_cube`` pre-aggregates transactions to one row per
  (customer, weekday, hour, month period) *before* the join with the
  cluster map. A customer holding a third of all transactions becomes at
  most 7 x 24 x 3 rows after map-side partial aggregation, so neither the
  join nor the summaries see the skew.
- Shares and top-N windows run over per-cluster slot counts (at most 24
  rows per cluster), never over transactions.
- Null slot keys are dropped before grouping, as pandas does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cohortlens.config import TemporalConfig, TxConfig
from cohortlens.functions.scalar import cut, ordinal, weekday_name

SLOT_KEYS = ("day_of_week", "hour", "month_period")


def enrich_time_features(
    df: DataFrame, date_col: str = "InvoiceDate", tcfg: TemporalConfig = TemporalConfig()
) -> DataFrame:
    """SCL-15: hour, weekday name / number (Monday = 0), weekend flag,
    day of month, month and the right-closed month period. One projection."""
    ts = F.col(date_col)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": weekday_name(ts),
            "dow_num": F.weekday(ts),
            "is_weekend": F.weekday(ts) >= 5,
            "day_of_month": F.dayofmonth(ts),
            "month": F.month(ts),
            "month_period": cut(F.dayofmonth(ts), tcfg.bins, tcfg.labels),
        }
    )


def activity_cube(
    tx: DataFrame,
    id_col: str = "Customer ID",
    date_col: str = "InvoiceDate",
    tcfg: TemporalConfig = TemporalConfig(),
) -> DataFrame:
    """Transactions per (customer, day_of_week, hour, month_period).

    Output id column is ``tcfg.id_col``; ``transactions`` is the weight.
    """
    e = enrich_time_features(tx.select(F.col(id_col).alias(tcfg.id_col), F.col(date_col)), date_col, tcfg)
    return e.groupBy(tcfg.id_col, *SLOT_KEYS).agg(F.count(F.lit(1)).cast("long").alias("transactions"))


def invoice_activity(clean: DataFrame, cfg: TxConfig = TxConfig(), tcfg: TemporalConfig = TemporalConfig()) -> DataFrame:
    """Clean transactions per (customer, invoice, day_of_week, hour, month_period):
    latest date, revenue and number of ``transactions``.

    Both ``build_rfm`` (same column names, sums of sums) and ``activity_cube``
    (weighted) can be derived from it, so the transactions are read once. The
    invoice in the key spreads a hot customer.
    """
    e = enrich_time_features(clean.select(cfg.customer, cfg.invoice, cfg.date, cfg.revenue), cfg.date, tcfg)
    return e.groupBy(cfg.customer, cfg.invoice, *SLOT_KEYS).agg(
        F.max(cfg.date).alias(cfg.date),
        F.sum(F.col(cfg.revenue).cast(DecimalType(38, cfg.money_scale))).alias(cfg.revenue),
        F.count(F.lit(1)).cast("long").alias("transactions"),
    )


def customer_activity(
    visits: DataFrame, id_col: str = "Customer ID", tcfg: TemporalConfig = TemporalConfig()
) -> DataFrame:
    """``activity_cube`` from ``invoice_activity``."""
    return visits.groupBy(F.col(id_col).alias(tcfg.id_col), *SLOT_KEYS).agg(
        F.sum("transactions").cast("long").alias("transactions")
    )


def _weight(weight_col: str | None) -> Column:
    return F.sum(weight_col) if weight_col else F.count(F.lit(1))


def slot_counts(
    df: DataFrame,
    cluster_col: str,
    slot_col: str,
    weight_col: str | None = None,
    name: str = "transactions",
) -> DataFrame:
    """AGG-9..11: rows (or summed weight) per (cluster, slot), observed only,
    ordered by cluster then count desc then slot."""
    out = (
        df.filter(F.col(slot_col).isNotNull() & F.col(cluster_col).isNotNull())
        .groupBy(cluster_col, slot_col)
        .agg(_weight(weight_col).cast("long").alias(name))
    )
    return out.orderBy(cluster_col, F.desc(name), slot_col)


def _densify(
    counts: DataFrame, cluster_col: str, slot_col: str, categories: Sequence[str], name: str
) -> DataFrame:
    """Every observed cluster x every category, 0 where absent (pandas
    ``observed=False`` on a categorical key).

    One pass over ``counts``, no join and no cross join: ``counts`` already
    holds one row per (cluster, slot), so each cluster's slot -> count map
    has at most len(categories) entries (plus any out-of-range slot, which
    is ignored); a generator then emits one row per category.
    """
    per_cluster = counts.groupBy(cluster_col).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(slot_col), F.col(name)))).alias("_m")
    )
    grid = per_cluster.select(
        cluster_col, "_m", F.explode(F.array(*[F.lit(c) for c in categories])).alias(slot_col)
    )
    return grid.select(
        cluster_col, slot_col, F.coalesce(F.col("_m")[F.col(slot_col)], F.lit(0)).cast("long").alias(name)
    )


def top_share(
    counts: DataFrame,
    cluster_col: str,
    slot_col: str,
    name: str,
    pct_name: str,
    top_n: int,
    categories: Sequence[str] | None,
) -> DataFrame:
    """WIN-1 + SCL-16 + WIN-2: share within cluster, first top_n by share.

    Ties keep the lower slot (category order for categorical slots,
    natural order otherwise), as the reference's sort of key-ordered
    groups does.
    """
    if categories:
        counts = _densify(counts, cluster_col, slot_col, categories, name)
        tie: Column = ordinal(F.col(slot_col), categories)
    else:
        tie = F.col(slot_col)
    total = F.sum(name).over(Window.partitionBy(cluster_col))
    with_pct = counts.withColumn(pct_name, F.col(name) / total)
    rank = F.row_number().over(Window.partitionBy(cluster_col).orderBy(F.desc(pct_name), tie.asc()))
    return (
        with_pct.withColumn("_rn", rank)
        .filter(F.col("_rn") <= top_n)
        .select(cluster_col, slot_col, F.col(name).cast("long").alias(name), pct_name, F.col("_rn").cast("int").alias("rank"))
    )


def top_preferences(
    df: DataFrame,
    cluster_col: str,
    slot_col: str,
    top_n: int = 3,
    weight_col: str | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """TOP-3: top slots per cluster by share of transactions.

    ``categories`` marks a categorical slot (e.g. month_period): unobserved
    categories appear with 0, as in the reference.
    """
    counts = (
        df.filter(F.col(slot_col).isNotNull() & F.col(cluster_col).isNotNull())
        .groupBy(cluster_col, slot_col)
        .agg(_weight(weight_col).cast("long").alias("transactions"))
    )
    return top_share(counts, cluster_col, slot_col, "transactions", "pct_within_cluster", top_n, categories)


def top_unique_customers(
    df: DataFrame,
    cluster_col: str,
    slot_col: str,
    id_col: str = "CustomerID",
    top_n: int = 3,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """TOP-4 (+ AGG-13): top slots per cluster by share of distinct customers.

    The denominator is the sum of the slots' distinct counts (a customer
    active on two days counts twice), as in the reference.
    """
    counts = (
        df.filter(F.col(slot_col).isNotNull() & F.col(cluster_col).isNotNull())
        .groupBy(cluster_col, slot_col)
        .agg(F.count_distinct(id_col).cast("long").alias("unique_customers"))
    )
    return top_share(
        counts, cluster_col, slot_col, "unique_customers", "pct_unique_within_cluster", top_n, categories
    )


def temporal_profile(
    df: DataFrame,
    cluster_col: str = "Cluster",
    id_col: str = "CustomerID",
    weight_col: str | None = None,
    one_row_per_customer_slot: bool = False,
) -> DataFrame:
    """AGG-12: transactions and distinct customers per (cluster, weekday,
    hour, month period), observed combinations only, in one aggregate.

    With ``activity_cube`` input (one row per customer and slot) the
    distinct count is a plain row count, which saves a shuffle.
    """
    keys = [cluster_col, *SLOT_KEYS]
    base = df
    for k in keys:
        base = base.filter(F.col(k).isNotNull())
    uniq = F.count(F.lit(1)) if one_row_per_customer_slot else F.count_distinct(id_col)
    return base.groupBy(*keys).agg(
        _weight(weight_col).cast("long").alias("transactions"),
        uniq.cast("long").alias("unique_customers"),
    )
