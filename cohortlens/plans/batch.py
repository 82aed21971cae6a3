"""Run the stages over files, as the reference's scripts do.

Each stage reads the previous stages' tables (SRC-3..8) from ``out_dir`` with
declared schemas and replaces its own (SNK-1..3) there, so a stage can run
alone, in its own process, and the written tables are the lineage cut points.
``out_dir`` must be a shared folder on a cluster. The reference's printed
reports are tables too.

  clean     raw -> clean_transactions (sorted), clean_audit, quality_range,
            quality_missing_ratio, quality_revenue
  rfm       clean_transactions -> rfm_raw, rfm_head, rfm_describe, rfm_skewness,
            rfm_top_monetary, rfm_top_frequency, rfm_top_recency
  features  rfm_raw -> rfm_scaled, log_skewness, scaled_summary
  clusters  rfm_scaled -> k_evaluation, rfm_clustered
  profile   rfm_raw + rfm_clustered -> cluster_profile, cluster_sizes, segments, segment_revenue
  temporal  clean_transactions + rfm_clustered -> temporal_profile (partitioned by cluster) and, for
            dow, hour and period, <slot>_counts, top_<slot>, top_<slot>_unique
  charts    temporal_profile -> hour_share, dow_share, dow_hour_share, period_share, dow_ranking

A stage's checks (CHK-2, CHK-3) count the bad rows while its table is written;
if there are any, the table is not replaced and the error states their number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import ClusterConfig, RFMConfig, TemporalConfig, TxConfig
from cohortlens.operators import charts
from cohortlens.operators.clean import AUDIT_STEPS, REASON, audit_metrics, counted_transactions
from cohortlens.operators.cluster import (
    assign_nearest,
    cluster_sizes,
    fit_sweep,
    score_sweep,
    segment_names,
    segment_revenue_share,
    sweep_ks,
)
from cohortlens.operators.features import LOG_COLS, SCALED_COLS, rfm_features
from cohortlens.operators.profile import cluster_medians, cluster_profile
from cohortlens.operators.rfm import per_customer, rfm_of
from cohortlens.operators.stats import date_range_uniques, describe, missing_ratio, rfm_diagnostics, skewness
from cohortlens.operators.temporal import activity_cube
from cohortlens.operators.timing import timing_tables
from cohortlens.sources.dates import find_date_format
from cohortlens.sources.files import (
    read_clean_transactions,
    read_profile_inputs,
    read_table,
    write_table,
)
from cohortlens.sources.schema import (
    RFM_SCHEMA,
    SCALED_COLUMNS,
    SCALED_SCHEMA,
    TEMPORAL_PROFILE_SCHEMA,
    clean_transactions_schema,
    clustered_schema,
)
from cohortlens.sources.stage_tables import materialize

STAGES = ("clean", "rfm", "features", "clusters", "profile", "temporal", "charts")


def _refuse(metric: str, message: str):
    """A check that fails if rows were counted under ``metric``; the message gets their number."""

    def check(found: dict) -> None:
        if found.get(metric):
            raise ValueError(message.format(n=found[metric]))

    return check


def run_stage(
    spark: SparkSession,
    stage: str,
    out_dir: str,
    raw: DataFrame | None = None,
    cfg: TxConfig = TxConfig(),
    rcfg: RFMConfig = RFMConfig(),
    kcfg: ClusterConfig = ClusterConfig(),
    tcfg: TemporalConfig = TemporalConfig(),
    fmt: str = "parquet",
) -> dict[str, str]:
    """Run one stage of ``STAGES``; ``raw`` is needed by ``clean`` only.

    Returns the path of every table the stage wrote.
    """
    out = out_dir.rstrip("/")
    paths: dict[str, str] = {}

    def path(name: str) -> str:
        return f"{out}/{name}"

    def save(name: str, df: DataFrame, **kw) -> dict:
        paths[name] = path(name)
        return write_table(df, paths[name], fmt=fmt, **kw)

    # customer tables share their buckets, so that joins by customer need no shuffle
    by_customer = {"buckets": (rcfg.id_out, rcfg.buckets)} if fmt == "parquet" else {}

    def typed(schema):
        # Parquet carries its own types; CSV text is typed by the declared schema
        return schema if fmt == "csv" else None

    def load(name: str, schema) -> DataFrame:
        return read_table(spark, path(name), stage, fmt, typed(schema))

    if cfg.date_format == "auto":
        pattern = None if raw is None or stage != "clean" else find_date_format(raw, cfg.date).pattern
        cfg = replace(cfg, date_format=pattern)  # tables of the stages have typed dates

    def clean() -> DataFrame:
        return read_clean_transactions(
            spark, path("clean_transactions"), cfg, fmt, typed(clean_transactions_schema(cfg)), guard=False
        )

    if stage == "clean":
        if raw is None:
            raise ValueError("stage 'clean' needs the raw transactions")
        # the raw rows are read and shuffled once, for the table and its audit
        counted = counted_transactions(raw, cfg)
        columns = counted.columns[:-2]
        audit = save(
            "clean_transactions", counted, sort_by=[cfg.customer, cfg.date],
            metrics=audit_metrics(), keep=F.col(REASON).isNull(), columns=columns,
        )
        steps = [(i, rule, audit.get(rule) or 0) for i, rule in enumerate(AUDIT_STEPS)]
        save("clean_audit", spark.createDataFrame(steps, "step int, rule string, rows long").coalesce(1))
        written = clean()
        save("quality_range", date_range_uniques(written, cfg.date, cfg.customer, cfg.invoice))
        save("quality_missing_ratio", missing_ratio(written))
        save("quality_revenue", describe(written, [cfg.revenue]))
    elif stage == "rfm":
        # per-customer table written once: the snapshot max scans it, not the
        # transactions again; it also carries the number of rows without a date
        dates = Observation()
        customers = materialize(per_customer(clean(), cfg).observe(dates, F.sum("_bad").alias("bad")))
        _refuse("bad", f"found {{n}} rows with an invalid {cfg.date} in the clean transactions")(dates.get)
        save(
            "rfm_raw", rfm_of(customers, cfg, rcfg, guard=False), metrics={"late": F.count_if(F.col("Recency") < 0)},
            check=_refuse("late", "found {n} customers with a negative recency; check the snapshot date"), **by_customer,
        )
        for name, table in rfm_diagnostics(load("rfm_raw", RFM_SCHEMA), top_n=rcfg.top_n).items():
            save(f"rfm_{name}", table)
    elif stage == "features":
        features = materialize(rfm_features(load("rfm_raw", RFM_SCHEMA)).select(*SCALED_COLUMNS))
        save("rfm_scaled", features)
        save("log_skewness", skewness(features, LOG_COLS))
        save("scaled_summary", describe(features, SCALED_COLS, (0.25, 0.5, 0.75)))
    elif stage == "clusters":
        # every k is fitted once, the final one among them
        feats = load("rfm_scaled", SCALED_SCHEMA)
        fits = fit_sweep(feats, sorted({*sweep_ks(kcfg), kcfg.final_k}), kcfg)
        save("k_evaluation", score_sweep(feats, fits, kcfg).coalesce(1))
        save("rfm_clustered", assign_nearest(feats, fits[kcfg.final_k][0], kcfg.features, kcfg.cluster_col), **by_customer)
    elif stage == "profile":
        joined = materialize(
            read_profile_inputs(
                spark, path("rfm_raw"), path("rfm_clustered"), fmt, rcfg.id_out, kcfg.cluster_col,
                typed(RFM_SCHEMA), typed(clustered_schema(kcfg.cluster_col)),
            )
        )
        save("cluster_profile", cluster_profile(joined, kcfg.cluster_col, rcfg.id_out))
        save("cluster_sizes", cluster_sizes(joined, kcfg.cluster_col))
        save("segments", segment_names(cluster_medians(joined, kcfg.cluster_col, digits=None), kcfg.cluster_col))
        save("segment_revenue", segment_revenue_share(joined, kcfg.cluster_col))
    elif stage == "temporal":
        # pre-aggregated per customer and slot before the join with the clusters
        clusters = load("rfm_clustered", clustered_schema(kcfg.cluster_col))
        cube = activity_cube(clean(), cfg.customer, cfg.date, tcfg)
        for name, table in timing_tables(cube, clusters, tcfg).items():
            save(name, table, partition_by=[tcfg.cluster_col] if name == "temporal_profile" else ())
    elif stage == "charts":
        profile = load("temporal_profile", TEMPORAL_PROFILE_SCHEMA)
        save("hour_share", charts.hour_share(profile, tcfg.cluster_col))
        save("dow_share", charts.dow_share(profile, tcfg.cluster_col))
        save("dow_hour_share", charts.dow_hour_share(profile))
        save("period_share", charts.period_share(profile, tcfg.cluster_col, tcfg))
        save("dow_ranking", charts.dow_ranking(profile, tcfg.cluster_col))
    else:
        raise ValueError(f"unknown stage {stage!r}; expected one of {STAGES}")
    return paths


def run_stages(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    cfg: TxConfig = TxConfig(),
    rcfg: RFMConfig = RFMConfig(),
    kcfg: ClusterConfig = ClusterConfig(),
    tcfg: TemporalConfig = TemporalConfig(),
    fmt: str = "parquet",
    stages: Sequence[str] = STAGES,
) -> dict[str, str]:
    """Clean -> RFM -> features -> clusters -> profiles -> timing -> charts
    (or the listed ``stages``, in that order). Returns every table written."""
    paths: dict[str, str] = {}
    for stage in stages:
        paths.update(run_stage(spark, stage, out_dir, raw, cfg, rcfg, kcfg, tcfg, fmt))
    return paths
