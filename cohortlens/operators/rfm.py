"""Recency / frequency / monetary per customer (SCL-6, SCL-7, AGG-1, AGG-2, TOP-1, CHK-3)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cohortlens.config import RFMConfig, TxConfig
from cohortlens.functions.scalar import full_days_between


def _snapshot_from_latest(latest: Column, rcfg: RFMConfig) -> Column:
    return F.to_date(latest).cast("timestamp_ntz") + F.make_dt_interval(F.lit(rcfg.snapshot_add_days))


def snapshot_date(clean: DataFrame, cfg: TxConfig = TxConfig(), rcfg: RFMConfig = RFMConfig()) -> Column:
    """SCL-6: midnight of the latest transaction + N days, as a scalar subquery.

    The subquery runs once (partial max per task, one row to the final
    aggregate) and its value is inlined; no join with the data.
    """
    return _snapshot_from_latest(clean.select(F.max(cfg.date)).scalar(), rcfg)


def per_customer(clean: DataFrame, cfg: TxConfig = TxConfig()) -> DataFrame:
    """AGG-1: (customer, _last, Frequency, _money, _bad), one row per customer.

    Written as two aggregations: (customer, invoice) first, then customer.
    The first shuffle spreads a very active customer over its invoices, and
    the second only moves one pre-aggregated row per (task, customer).
    ``_bad`` is the number of the customer's rows without a date (CHK-2).
    """
    money = DecimalType(38, cfg.money_scale)
    per_invoice = clean.groupBy(cfg.customer, cfg.invoice).agg(
        F.max(cfg.date).alias("_last"),
        F.sum(F.col(cfg.revenue).cast(money)).alias("_money"),
        F.count_if(F.col(cfg.date).isNull()).alias("_bad"),
    )
    return per_invoice.groupBy(cfg.customer).agg(
        F.max("_last").alias("_last"),
        F.count(cfg.invoice).alias("Frequency"),
        F.sum("_money").alias("_money"),
        F.sum("_bad").alias("_bad"),
    )


def rfm_of(customers: DataFrame, cfg: TxConfig = TxConfig(), rcfg: RFMConfig = RFMConfig(), guard: bool = True) -> DataFrame:
    """AGG-2 from ``per_customer``: (CustomerID, Recency, Frequency, Monetary).

    The snapshot is the max over the per-customer table, bound to a column once
    so the subquery is not inlined per use. With ``guard`` a negative recency
    fails the job (CHK-3); without it the caller counts them.
    """
    snap = _snapshot_from_latest(customers.select(F.max("_last")).scalar(), rcfg)
    with_snap = customers.withColumn("_snap", snap)
    recency = full_days_between(F.col("_last"), F.col("_snap"))
    if guard:
        recency = F.when(
            recency < 0,
            F.raise_error(F.concat(F.lit("negative recency for customer "), F.col(cfg.customer))),
        ).otherwise(recency)
    return with_snap.select(
        F.col(cfg.customer).alias(rcfg.id_out),
        recency.cast("int").alias("Recency"),
        F.col("Frequency").cast("long").alias("Frequency"),
        F.col("_money").cast("double").alias("Monetary"),
    )


def build_rfm(
    clean: DataFrame,
    cfg: TxConfig = TxConfig(),
    rcfg: RFMConfig = RFMConfig(),
    materialize: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """AGG-2: one row per customer -> (CustomerID, Recency, Frequency, Monetary).

    Recency   whole 24-hour days from the last purchase to the snapshot
    Frequency distinct non-null invoices
    Monetary  revenue summed exactly in decimal, returned as double

    Pass ``materialize`` (e.g. a reliable checkpoint) to write the per-customer
    table first: the snapshot subquery then scans that small table and the
    transactions are read exactly once. Without it the function stays lazy and
    the subquery re-evaluates the (column-pruned) aggregation.
    """
    customers = per_customer(clean, cfg).drop("_bad")
    return rfm_of(materialize(customers) if materialize is not None else customers, cfg, rcfg)


def top_customers(
    rfm: DataFrame, by: str, n: int = 10, id_col: str = "CustomerID"
) -> DataFrame:
    """TOP-1: the n customers with the largest ``by``; ties broken by id.

    Planned as TakeOrderedAndProject: each task keeps its own top n.
    """
    return rfm.orderBy(F.desc(by), F.asc(id_col)).limit(n)


def first_rows(df: DataFrame, n: int = 5, id_col: str = "CustomerID") -> DataFrame:
    """TOP-2: the first n rows by id (the reference's ``head()`` of a table
    grouped by customer). Planned as TakeOrderedAndProject."""
    return df.orderBy(F.asc(id_col)).limit(n)
