"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Names follow SURVEY §7.4; every query reads the driver's tables in full.
Derived doubles are rounded (4 places for statistics, 6 for features) so
that the DuckDB oracle can match them exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.config import ClusterConfig
from cohortlens.operators import charts, cluster, profile, stats, temporal, timing
from cohortlens.operators.clean import clean_audit
from cohortlens.operators.features import LOG_COLS, RAW_COLS, SCALED_COLS, log_transform
from cohortlens.operators.rfm import first_rows, top_customers
from cohortlens.plans import stages
from cohortlens.plans.stages import TEMPORAL, TX

Query = Callable[[SparkSession, str], DataFrame]

# KMeans fits registered as queries: the reference's k range, seed and 20
# restarts per k; all 140 fits of the sweep advance by the same passes.
QUERY_KMEANS = ClusterConfig()


def _round(df: DataFrame, cols, digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# -- Entry A: cleaning, RFM, statistics --------------------------------------

def clean_transactions(spark, sf):
    return stages.orders_clean(spark, sf)


def clean_audit_q(spark, sf):
    return clean_audit(stages.orders_raw(spark, sf), TX)


def missing_ratio(spark, sf):
    return stats.missing_ratio(stages.orders_clean(spark, sf))


def revenue_describe(spark, sf):
    return stats.describe(stages.orders_clean(spark, sf), [TX.revenue])


def date_range_uniques(spark, sf):
    return stats.date_range_uniques(stages.orders_clean(spark, sf), TX.date, TX.customer, TX.invoice)


def rfm(spark, sf):
    return stages.orders_rfm(spark, sf)


def rfm_events(spark, sf):
    return stages.events_rfm(spark, sf)


def rfm_describe(spark, sf):
    return stats.describe(stages.orders_rfm(spark, sf), RAW_COLS)


def rfm_skew(spark, sf):
    return stats.skewness(stages.orders_rfm(spark, sf), RAW_COLS)


def rfm_head(spark, sf):
    return first_rows(stages.orders_rfm(spark, sf), 5)


def _top(col: str) -> Query:
    return lambda spark, sf: top_customers(stages.orders_rfm(spark, sf), col, 10)


# -- Entry B: features, clusters, profiles ------------------------------------

def rfm_log(spark, sf):
    out = log_transform(stages.orders_rfm(spark, sf)).select("CustomerID", *LOG_COLS)
    return _round(out, LOG_COLS, 6)


def rfm_log_skew(spark, sf):
    return stats.skewness(log_transform(stages.orders_rfm(spark, sf)), LOG_COLS)


def rfm_scaled(spark, sf):
    out = stages.orders_features(spark, sf).select("CustomerID", *LOG_COLS, *SCALED_COLS)
    return _round(out, [*LOG_COLS, *SCALED_COLS], 6)


def scaled_describe(spark, sf):
    return stats.describe(stages.orders_features(spark, sf), SCALED_COLS, (0.25, 0.5, 0.75))


def assign_fixed_centres(spark, sf):
    return stages.orders_fixed_clusters(spark, sf).select("CustomerID", "Cluster")


def inertia_fixed_centres(spark, sf):
    out = cluster.inertia(stages.orders_features(spark, sf), cluster.FIXED_CENTRES)
    return _round(out, ["inertia"], 4)


def silhouette_fixed_centres(spark, sf):
    out = cluster.silhouette(stages.orders_fixed_clusters(spark, sf))
    return _round(out, ["silhouette_sq_euclidean"], 4)


def silhouette_euclidean(spark, sf):
    """ML-4 as the reference has it, and whether its proven error bound is small."""
    out = cluster.silhouette_euclidean(stages.orders_fixed_clusters(spark, sf))
    return _round(out, ["silhouette"], 4).withColumn("error_bound", F.col("error_bound") <= 1e-4).withColumnRenamed("error_bound", "within_bound")


def kmeans_counts(spark, sf):
    labelled = cluster.kmeans_clusters(stages.orders_features(spark, sf), QUERY_KMEANS)
    return cluster.cluster_sizes(labelled)


def kmeans_sweep(spark, sf):
    return cluster.kmeans_sweep(stages.orders_features(spark, sf), QUERY_KMEANS)


def cluster_profile_kmeans(spark, sf):
    """The reference's published profile: AGG-7 over fitted KMeans clusters
    (ML-1, best of 20, stable labels). Iterative fit: rows-only check."""
    labelled = cluster.kmeans_clusters(stages.orders_features(spark, sf), QUERY_KMEANS)
    return profile.cluster_profile(labelled)


def cluster_profile(spark, sf):
    return profile.cluster_profile(stages.orders_fixed_clusters(spark, sf))


def cluster_medians(spark, sf):
    return profile.cluster_medians(stages.orders_fixed_clusters(spark, sf))


def cluster_sizes(spark, sf):
    return cluster.cluster_sizes(stages.orders_fixed_clusters(spark, sf))


def segment_names(spark, sf):
    meds = profile.cluster_medians(stages.orders_fixed_clusters(spark, sf), digits=None)
    return cluster.segment_names(meds)


def segment_revenue_share(spark, sf):
    return cluster.segment_revenue_share(stages.orders_fixed_clusters(spark, sf))


# -- Entry C: activity timing --------------------------------------------------

def time_features(spark, sf):
    clean = stages.events_clean(spark, sf).select(
        TX.invoice, F.col(TX.customer).alias("CustomerID"), TX.date
    )
    return temporal.enrich_time_features(clean, TX.date, TEMPORAL)


def _counts(slot: str) -> Query:
    def q(spark, sf):
        return temporal.slot_counts(
            stages.events_activity(spark, sf), TEMPORAL.cluster_col, slot, weight_col="transactions"
        )

    return q


def _top_pref(slot: str, n: int, categories=None) -> Query:
    def q(spark, sf):
        return temporal.top_preferences(
            stages.events_activity(spark, sf),
            TEMPORAL.cluster_col,
            slot,
            n,
            weight_col="transactions",
            categories=categories,
        )

    return q


def _top_unique(slot: str, n: int, categories=None) -> Query:
    def q(spark, sf):
        return temporal.top_unique_customers(
            stages.events_activity(spark, sf), TEMPORAL.cluster_col, slot, TEMPORAL.id_col, n, categories
        )

    return q


def temporal_profile(spark, sf):
    return stages.events_temporal_profile(spark, sf)


def _bitmaps(spark, sf):
    """The events' activity as bitmaps of dense customer numbers."""
    visits = stages.events_visits(spark, sf)
    clusters = cluster.assign_nearest(stages.visits_features(visits), cluster.FIXED_CENTRES)
    numbered = timing.number_customers(clusters, TEMPORAL.id_col, TEMPORAL.cluster_col)
    return timing.activity_bitmaps(temporal.customer_activity(visits, TX.customer, TEMPORAL), numbered, TEMPORAL)


def slot_transactions(spark, sf):
    """AGG-9..11 of all slot kinds, by one GROUPING SETS."""
    return timing.transactions_by_slot(timing.profile_of(_bitmaps(spark, sf), TEMPORAL), TEMPORAL)


def slot_customers(spark, sf):
    """AGG-13, TOP-4's counts of all slot kinds, by OR of bitmaps."""
    return timing.customers_by_slot(_bitmaps(spark, sf), TEMPORAL)


def bitmap_profile(spark, sf):
    """AGG-12 by counting bitmaps."""
    return timing.profile_of(_bitmaps(spark, sf), TEMPORAL)


def _positions(query: Query, order_cols) -> Query:
    """SRT-2/3/5: the keys of an ordered result with the place that each row has in it."""

    def q(spark, sf):
        placed = query(spark, sf).withColumn("_id", F.monotonically_increasing_id())
        place = F.row_number().over(Window.orderBy("_id")).cast("int")  # a few rows per cluster
        return placed.select(*order_cols, place.alias("position"))

    return q


def _kmeans_activity(spark, sf):
    visits = stages.events_visits(spark, sf)
    labelled = cluster.kmeans_clusters(stages.visits_features(visits), QUERY_KMEANS)
    cube = temporal.customer_activity(visits, TX.customer, TEMPORAL)
    return cluster.attach_clusters(cube, labelled, TEMPORAL.id_col, TEMPORAL.cluster_col)


def temporal_profile_kmeans(spark, sf):
    """The reference's published timing table: AGG-12 over the activity of
    customers labelled by fitted KMeans clusters on their own RFM.
    Iterative fit: rows-only check."""
    return stages.activity_profile(_kmeans_activity(spark, sf))


def temporal_kmeans_facts(spark, sf):
    """Totals that the timing table must have whatever the fit: its transactions,
    and one cluster of the k for each."""
    prof = temporal_profile_kmeans(spark, sf)
    return prof.agg(
        F.sum("transactions").cast("long").alias("transactions"),
        F.count_distinct(TEMPORAL.cluster_col).cast("long").alias("clusters"),
    )


def kmeans_fit_facts(spark, sf):
    """ML-1, ML-6: what any valid fit must meet, computed from the fitted model."""
    features = stages.orders_features(spark, sf)
    centres, _ = cluster.fit_kmeans(features, QUERY_KMEANS.final_k, QUERY_KMEANS)
    return cluster.fit_facts(cluster.assign_nearest(features, centres), centres)


def kmeans_sweep_facts(spark, sf):
    """ML-2: what any valid sweep must meet, computed from the sweep's rows."""
    return cluster.sweep_facts(kmeans_sweep(spark, sf))


def _sparse(slot: str, unique: bool) -> Query:
    def q(spark, sf):
        activity = stages.events_activity(spark, sf, stages.sparse_events_raw)
        if unique:
            return temporal.top_unique_customers(
                activity, TEMPORAL.cluster_col, slot, TEMPORAL.id_col, 3, TEMPORAL.labels
            )
        return temporal.top_preferences(
            activity, TEMPORAL.cluster_col, slot, 3, weight_col="transactions", categories=TEMPORAL.labels
        )

    return q


def sparse_period_share(spark, sf):
    return charts.period_share(stages.events_temporal_profile(spark, sf, stages.sparse_events_raw))


def clustered_transactions(spark, sf):
    """JOIN-1, JOIN-4: every clean order line with its customer's cluster."""
    clean = stages.orders_clean(spark, sf).withColumnRenamed(TX.customer, "CustomerID")
    joined = cluster.attach_clusters(clean, stages.orders_fixed_clusters(spark, sf))
    return joined.select(TX.invoice, TX.stock, "CustomerID", "Cluster")


def active_weekdays(spark, sf):
    """SET-2: the weekdays on which anything was sold."""
    return charts.distinct_values(time_features(spark, sf), "day_of_week")


def _chart(fn) -> Query:
    return lambda spark, sf: fn(stages.events_temporal_profile(spark, sf))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "clean_transactions": clean_transactions,
        "clean_audit": clean_audit_q,
        "missing_ratio": missing_ratio,
        "revenue_describe": revenue_describe,
        "date_range_uniques": date_range_uniques,
        "rfm": rfm,
        "rfm_events": rfm_events,
        "rfm_describe": rfm_describe,
        "rfm_skew": rfm_skew,
        "rfm_top_monetary": _top("Monetary"),
        "rfm_top_frequency": _top("Frequency"),
        "rfm_top_recency": _top("Recency"),
        "rfm_head": rfm_head,
        "rfm_log": rfm_log,
        "rfm_log_skew": rfm_log_skew,
        "rfm_scaled": rfm_scaled,
        "scaled_describe": scaled_describe,
        "assign_fixed_centres": assign_fixed_centres,
        "inertia_fixed_centres": inertia_fixed_centres,
        "silhouette_fixed_centres": silhouette_fixed_centres,
        "silhouette_euclidean": silhouette_euclidean,
        "kmeans_counts": kmeans_counts,
        "kmeans_sweep": kmeans_sweep,
        "cluster_profile_kmeans": cluster_profile_kmeans,
        "cluster_profile": cluster_profile,
        "cluster_medians": cluster_medians,
        "cluster_sizes": cluster_sizes,
        "segment_names": segment_names,
        "segment_revenue_share": segment_revenue_share,
        "time_features": time_features,
        "dow_counts": _counts("day_of_week"),
        "hour_counts": _counts("hour"),
        "period_counts": _counts("month_period"),
        "top_dow": _top_pref("day_of_week", 3),
        "top_hour": _top_pref("hour", 5),
        "top_period": _top_pref("month_period", 3, TEMPORAL.labels),
        "top_dow_unique": _top_unique("day_of_week", 3),
        "top_hour_unique": _top_unique("hour", 5),
        "top_period_unique": _top_unique("month_period", 3, TEMPORAL.labels),
        "temporal_profile": temporal_profile,
        "slot_transactions": slot_transactions,
        "slot_customers": slot_customers,
        "bitmap_profile": bitmap_profile,
        "cluster_profile_order": _positions(cluster_profile, ["Cluster"]),
        "hour_counts_order": _positions(_counts("hour"), ["Cluster", "hour"]),
        "hour_share_order": _positions(_chart(charts.hour_share), ["Cluster"]),
        "temporal_profile_kmeans": temporal_profile_kmeans,
        "hour_share": _chart(charts.hour_share),
        "dow_share": _chart(charts.dow_share),
        "dow_hour_share": _chart(charts.dow_hour_share),
        "period_share": _chart(charts.period_share),
        "dow_ranking": _chart(charts.dow_ranking),
        "dirty_clean_transactions": stages.dirty_clean,
        "dirty_clean_audit": lambda spark, sf: clean_audit(stages.dirty_raw(spark, sf), TX),
        "dirty_missing_ratio": lambda spark, sf: stats.missing_ratio(stages.dirty_clean(spark, sf)),
        "dirty_rfm": stages.dirty_rfm,
        "sparse_top_period": _sparse("month_period", unique=False),
        "sparse_top_period_unique": _sparse("month_period", unique=True),
        "sparse_period_share": sparse_period_share,
        "clustered_transactions": clustered_transactions,
        "active_weekdays": active_weekdays,
        "kmeans_fit_facts": kmeans_fit_facts,
        "kmeans_sweep_facts": kmeans_sweep_facts,
        "temporal_kmeans_facts": temporal_kmeans_facts,
    }
    return q

