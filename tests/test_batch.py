import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortlens.config import ClusterConfig, TxConfig
from cohortlens.plans.batch import run_stages
from cohortlens.sources.adapters import events_transactions
from cohortlens.sources.files import current, read_raw_transactions, read_table, read_temporal_inputs, write_table

SF = "/root/testdata/sf0.001"


def check_reports(spark, read, paths):
    """Every table that stands for a printed report, against the operators on the written tables."""
    from cohortlens.operators import cluster, stats, temporal
    from cohortlens.operators.features import LOG_COLS, SCALED_COLS

    same = lambda name, df: assert_same(read(name), df)
    clean, rfm, scaled, clustered = (read(n) for n in ("clean_transactions", "rfm_raw", "rfm_scaled", "rfm_clustered"))
    same("quality_range", stats.date_range_uniques(clean, "InvoiceDate", "Customer ID", "Invoice"))
    same("quality_missing_ratio", stats.missing_ratio(clean))
    same("quality_revenue", stats.describe(clean, ["Revenue"]))
    diagnostics = stats.rfm_diagnostics(rfm)
    assert {f"rfm_{n}" for n in diagnostics} < set(paths)
    for name, table in diagnostics.items():
        same(f"rfm_{name}", table)
    same("log_skewness", stats.skewness(scaled, LOG_COLS))
    same("scaled_summary", stats.describe(scaled, SCALED_COLS, (0.25, 0.5, 0.75)))
    best = {r.k: r for r in read("k_evaluation").collect()}
    for k, r in best.items():
        assert -1 <= r.silhouette <= 1 and r.error_bound < 1e-3 and r.inertia > 0, k
    same("cluster_sizes", cluster.cluster_sizes(clustered))
    cube = temporal.activity_cube(clean)
    activity = cluster.attach_clusters(cube, clustered)
    same("temporal_profile", temporal.temporal_profile(activity, weight_col="transactions", one_row_per_customer_slot=True))
    for slot, short, n in (("day_of_week", "dow", 3), ("hour", "hour", 5), ("month_period", "period", 3)):
        dense = ("Early", "Mid", "Late") if short == "period" else None
        same(f"{short}_counts", temporal.slot_counts(activity, "Cluster", slot, "transactions"))
        same(f"top_{short}", temporal.top_preferences(activity, "Cluster", slot, n, "transactions", dense))
        same(f"top_{short}_unique", temporal.top_unique_customers(activity, "Cluster", slot, "CustomerID", n, dense))


def assert_same(got, want):
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    text = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())
    assert text(got) == text(want)


@pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables absent")
def test_run_stages_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="cohortlens-batch-")
    # raw CSV in the reference's layout: dates as text, ids as text
    ev = events_transactions(spark, SF).withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    write_table(ev.coalesce(2), f"{d}/raw", fmt="csv")
    raw = read_raw_transactions(spark, f"{d}/raw")
    paths = run_stages(
        spark, raw, f"{d}/out", kcfg=ClusterConfig(k_min=2, k_max=3, n_init=2, max_iter=50)
    )
    read = lambda name: read_table(spark, paths[name], name)
    clean_n = read("clean_transactions").count()
    audit = {r.rule: r.rows for r in read("clean_audit").collect()}
    assert audit["rows_out"] == clean_n
    assert audit["rows_in"] == raw.count()
    rfm_n = read("rfm_raw").count()
    assert read("rfm_scaled").count() == rfm_n == read("rfm_clustered").count()
    assert sorted(r.k for r in read("k_evaluation").collect()) == [2, 3]
    assert sum(r.Customers for r in read("cluster_profile").collect()) == rfm_n
    prof = read("temporal_profile")
    assert prof.agg(F.sum("transactions")).first()[0] == clean_n
    assert sorted(p for p in os.listdir(current(spark, paths["temporal_profile"])) if p.startswith("Cluster="))
    for r in read("period_share").collect():
        assert r.Early + r.Mid + r.Late == pytest.approx(1.0)

    check_reports(spark, read, paths)

    # SRC-7: the reference-style reader gives the same per-slot totals
    tx = read_temporal_inputs(spark, paths["clean_transactions"], paths["rfm_clustered"], TxConfig())
    assert tx.count() == clean_n


@pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables absent")
def test_command_line_runs_every_stage(spark, capsys):
    from cohortlens.__main__ import main

    d = tempfile.mkdtemp(prefix="cohortlens-cli-")
    ev = events_transactions(spark, SF).withColumn("InvoiceDate", F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"))
    write_table(ev.coalesce(1), f"{d}/raw", fmt="csv")
    paths = main(
        ["--input", f"{d}/raw", "--out", f"{d}/out", "--k-min", "2", "--k-max", "3", "--n-init", "2", "--format", "csv"]
    )
    printed = capsys.readouterr().out.splitlines()
    assert [line.split("\t")[0] for line in printed] == list(paths)
    prof = read_table(spark, paths["cluster_profile"], "profile", "csv")
    assert prof.count() == 3
    assert sorted(r.k for r in read_table(spark, paths["k_evaluation"], "k", "csv").collect()) == ["2", "3"]

    # one stage alone over the CSV tables left by the full run, as a separate script would
    again = main(["--out", f"{d}/out", "--stage", "clusters", "--k", "2", "--k-min", "2", "--k-max", "2",
                  "--n-init", "2", "--format", "csv"])
    assert set(again) == {"k_evaluation", "rfm_clustered"}
    clustered = read_table(spark, again["rfm_clustered"], "c", "csv")
    assert clustered.select("Cluster").distinct().count() == 2
    main(["--out", f"{d}/out", "--stage", "profile", "--format", "csv"])
    assert read_table(spark, paths["cluster_profile"], "profile", "csv").count() == 2

    # SRC-7 / SRC-8 over the CSV tables, typed by the declared schemas
    from cohortlens.sources.files import read_chart_inputs
    from cohortlens.sources.schema import (
        RFM_SCHEMA,
        TEMPORAL_PROFILE_SCHEMA,
        clean_transactions_schema,
        clustered_schema,
    )

    tx = read_temporal_inputs(
        spark, paths["clean_transactions"], paths["rfm_clustered"], TxConfig(), "csv",
        tx_schema=clean_transactions_schema(), clustered_schema=clustered_schema(),
    )
    assert dict(tx.dtypes)["InvoiceDate"] == "timestamp_ntz" and dict(tx.dtypes)["Cluster"] == "int"
    prof_in, timing = read_chart_inputs(
        spark, paths["rfm_raw"], paths["rfm_clustered"], paths["temporal_profile"], "csv",
        (RFM_SCHEMA, clustered_schema(), TEMPORAL_PROFILE_SCHEMA),
    )
    assert dict(prof_in.dtypes)["Monetary"] == "double"
    assert timing.agg(F.sum("transactions")).first()[0] == tx.count()
    with pytest.raises(SystemExit):
        main(["--out", f"{d}/out", "--stage", "clean"])  # clean needs --input
    with pytest.raises(SystemExit):
        main(["--out", f"{d}/out", "--stage", "charts", "--conf", "no-equals-sign"])
    main(["--out", f"{d}/out", "--stage", "charts", "--format", "csv", "--conf", "cohortlens.cli.flag=1"])
    assert spark.conf.get("cohortlens.cli.flag") == "1"


def test_declared_stage_schemas_match_written_tables(spark):
    # single-stage runs read CSV tables back with these declared schemas
    from cohortlens.config import RFMConfig
    from cohortlens.operators.clean import clean_transactions
    from cohortlens.operators.cluster import FIXED_CENTRES, assign_nearest
    from cohortlens.operators.features import rfm_features
    from cohortlens.operators.rfm import build_rfm
    from cohortlens.sources.schema import (
        RFM_SCHEMA,
        SCALED_COLUMNS,
        SCALED_SCHEMA,
        clean_transactions_schema,
        clustered_schema,
    )
    from tests.fixtures import cleaning_df

    def types(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    clean = clean_transactions(cleaning_df(spark))
    assert types(clean.schema) == types(clean_transactions_schema())
    rfm = build_rfm(clean, TxConfig(), RFMConfig())
    assert types(rfm.schema) == types(RFM_SCHEMA)
    scaled = rfm_features(rfm).select(*SCALED_COLUMNS)
    assert types(scaled.schema) == types(SCALED_SCHEMA)
    labelled = assign_nearest(scaled, FIXED_CENTRES)
    assert types(labelled.schema) == types(clustered_schema())


def test_run_stage_rejects_bad_calls(spark):
    from cohortlens.plans.batch import run_stage

    with pytest.raises(ValueError, match="unknown stage"):
        run_stage(spark, "plot", "/nonexistent")
    with pytest.raises(ValueError, match="raw transactions"):
        run_stage(spark, "clean", "/nonexistent")


@pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables absent")
def test_command_line_reads_typed_parquet(spark, capsys):
    from cohortlens.__main__ import main

    d = tempfile.mkdtemp(prefix="cohortlens-cli-pq-")
    # natural Parquet types: timestamp_ntz date, bigint quantity and customer id
    ev = events_transactions(spark, SF).withColumns(
        {"Quantity": F.col("Quantity").cast("bigint"), "Customer ID": F.col("Customer ID").cast("bigint")}
    )
    ev.write.parquet(f"{d}/raw")
    paths = main(["--input", f"{d}/raw", "--input-format", "parquet", "--out", f"{d}/out", "--stage", "clean"])
    audit = {r.rule: r.rows for r in read_table(spark, paths["clean_audit"], "audit").collect()}
    assert audit["rows_in"] == ev.count()
    assert audit["date_invalid"] == 0
    assert read_table(spark, paths["clean_transactions"], "clean").count() == audit["rows_out"]


def test_parquet_stages_keep_the_callers_types(spark):
    # a raw frame with a bigint quantity: Parquet stage tables are read back
    # with their own types, so the later stages still run
    from cohortlens.plans.batch import run_stages
    from tests.fixtures import cleaning_df

    d = tempfile.mkdtemp(prefix="cohortlens-pq-types-")
    raw = cleaning_df(spark).withColumn("Quantity", F.col("Quantity").cast("bigint"))
    paths = run_stages(spark, raw, d, stages=("clean", "rfm", "features"))
    rfm = read_table(spark, paths["rfm_raw"], "rfm")
    assert sorted((r.CustomerID, r.Frequency) for r in rfm.collect()) == [("13085", 2), ("13090", 0)]
    assert read_table(spark, paths["rfm_scaled"], "features").count() == 2
