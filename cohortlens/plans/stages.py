"""The reference's stages composed as lazy DataFrame plans.

Entry A  raw transactions -> clean -> RFM
Entry B  RFM -> log1p + z-score -> clusters -> profile
Entry C  clean transactions + clusters -> activity summaries -> chart tables

Two inputs feed them: order lines (orders / lineitem / part / customer /
nation; midnight dates) and events (timestamps with hours). Functions that
``materialize`` a stage table run it when called; the rest only build a plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import RFMConfig, TemporalConfig, TxConfig
from cohortlens.operators.clean import clean_transactions
from cohortlens.operators.cluster import FIXED_CENTRES, assign_nearest, attach_clusters
from cohortlens.operators.features import rfm_features
from cohortlens.operators.rfm import build_rfm
from cohortlens.operators.temporal import customer_activity, invoice_activity, temporal_profile
from cohortlens.sources.adapters import dirty_orders_transactions, events_transactions, orders_transactions
from cohortlens.sources.stage_tables import materialize

Source = Callable[[SparkSession, str], DataFrame]

TX = TxConfig()
RFM = RFMConfig()
TEMPORAL = TemporalConfig()


# -- Entry A ----------------------------------------------------------------

def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_transactions(spark, sf_dir, TX)


def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(orders_raw(spark, sf_dir), TX)


def orders_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM over a checkpointed per-customer table (transactions read once)."""
    return build_rfm(orders_clean(spark, sf_dir), TX, RFM, materialize)


def dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_orders_transactions(spark, sf_dir, TX)


def dirty_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(dirty_raw(spark, sf_dir), TX)


def dirty_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_rfm(dirty_clean(spark, sf_dir), TX, RFM, materialize)


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_transactions(spark, sf_dir, TX)


def sparse_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events without a date after the 20th of a month (their month period never occurs)."""
    date = F.col(TX.date)
    return events_raw(spark, sf_dir).withColumn(TX.date, F.when(F.dayofmonth(date) <= 20, date))


def events_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(events_raw(spark, sf_dir), TX)


def events_visits(spark: SparkSession, sf_dir: str, raw: Source = events_raw) -> DataFrame:
    """The events per (customer, invoice, slot), written: the only read of the events
    for the RFM, the clusters and the activity of Entry C."""
    return materialize(invoice_activity(clean_transactions(raw(spark, sf_dir), TX), TX, TEMPORAL))


def events_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_rfm(events_clean(spark, sf_dir), TX, RFM, materialize)


# -- Entry B ----------------------------------------------------------------

def orders_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM + logs + z-scores, materialised (raw R/F/M carried along, so
    profiling needs no join back to the RFM table)."""
    return materialize(rfm_features(orders_rfm(spark, sf_dir)))


def orders_fixed_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_nearest(orders_features(spark, sf_dir), FIXED_CENTRES)


def visits_features(visits: DataFrame) -> DataFrame:
    return materialize(rfm_features(build_rfm(visits, TX, RFM, materialize)))


# -- Entry C ----------------------------------------------------------------

def events_activity(spark: SparkSession, sf_dir: str, raw: Source = events_raw) -> DataFrame:
    """Per-customer slot counts joined with the customer -> cluster map."""
    visits = events_visits(spark, sf_dir, raw)
    clusters = assign_nearest(visits_features(visits), FIXED_CENTRES)
    return attach_clusters(customer_activity(visits, TX.customer, TEMPORAL), clusters, TEMPORAL.id_col, TEMPORAL.cluster_col)


def events_temporal_profile(spark: SparkSession, sf_dir: str, raw: Source = events_raw) -> DataFrame:
    return activity_profile(events_activity(spark, sf_dir, raw))


def activity_profile(activity: DataFrame) -> DataFrame:
    return temporal_profile(
        activity,
        TEMPORAL.cluster_col,
        TEMPORAL.id_col,
        weight_col="transactions",
        one_row_per_customer_slot=True,
    )
