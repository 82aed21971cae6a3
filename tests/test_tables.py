"""Atomic sinks, checks with counts, the audit of the cleaning write, and date formats."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortlens.config import TxConfig
from cohortlens.operators.clean import audit_metrics, clean_audit, clean_transactions, counted_transactions
from cohortlens.plans.batch import run_stage, run_stages
from cohortlens.sources.dates import DateFormatError, find_date_format
from cohortlens.sources.files import MissingInputError, current, read_table, versions, write_table
from tests.fixtures import cleaning_df


def folder():
    return tempfile.mkdtemp(prefix="cohortlens-tables-")


def ids(spark, path, fmt="parquet"):
    return sorted(int(r.id) for r in read_table(spark, path, "t", fmt).collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_failed_write_leaves_the_old_table(spark, fmt):
    path = folder() + "/t"
    with pytest.raises(MissingInputError):
        read_table(spark, path, "t")
    write_table(spark.range(3), path, fmt)
    broken = spark.range(0, 400, 1, 4).withColumn("x", F.when(F.col("id") == 399, F.raise_error(F.lit("half way"))).otherwise(F.lit("a")))
    with pytest.raises(Exception, match="half way"):
        write_table(broken, path, fmt)
    assert ids(spark, path, fmt) == [0, 1, 2] and len(versions(spark, path)) == 1

    def refuse(found):
        raise ValueError(f"{found['n']} rows")

    with pytest.raises(ValueError, match="5 rows"):
        write_table(spark.range(5), path, fmt, metrics={"n": F.count("*")}, check=refuse)
    assert ids(spark, path, fmt) == [0, 1, 2]
    assert write_table(spark.range(5), path, fmt, metrics={"n": F.count("*")}) == {"n": 5}
    assert ids(spark, path, fmt) == [0, 1, 2, 3, 4]


def test_a_reader_keeps_the_version_it_began_with(spark):
    path = folder() + "/t"
    write_table(spark.range(2), path)
    begun = read_table(spark, path, "t")
    write_table(spark.range(7), path)
    assert begun.count() == 2 and ids(spark, path) == list(range(7))
    write_table(spark.range(1), path)
    write_table(spark.range(4), path)
    assert [spark.read.parquet(v).count() for v in versions(spark, path)] == [0, 0, 1, 4]  # old ones are emptied
    assert current(spark, path) == versions(spark, path)[-1]
    plain = folder()
    spark.range(6).write.mode("overwrite").parquet(plain)
    assert ids(spark, plain) == list(range(6)) and versions(spark, plain) == []


def test_metrics_see_the_rows_that_are_not_kept(spark):
    path = folder() + "/t"
    df = spark.range(0, 1000, 1, 7).withColumn("odd", F.col("id") % 2 == 1)
    found = write_table(df, path, sort_by=["id"], metrics={"n": F.count("*"), "odd": F.count_if("odd")}, keep=~F.col("odd"), columns=["id"])
    assert found == {"n": 1000, "odd": 500}
    table = read_table(spark, path, "t")
    assert table.columns == ["id"] and ids(spark, path) == list(range(0, 1000, 2))


def test_the_audit_comes_from_the_cleaning_write(spark):
    raw = cleaning_df(spark)
    counted = counted_transactions(raw)
    assert sorted(map(str, counted.where("_drop_reason IS NULL").drop("_drop_reason", "_copies").collect())) == sorted(map(str, clean_transactions(raw).collect()))
    want = {r.rule: r.rows for r in clean_audit(raw).collect()}
    path = folder() + "/t"
    for df in (counted, counted.repartition(9)):
        found = write_table(df, path, sort_by=["Customer ID", "InvoiceDate"], metrics=audit_metrics(), keep=F.col("_drop_reason").isNull(), columns=df.columns[:-2])
        assert found == want
    assert read_table(spark, path, "t").count() == want["rows_out"]


def test_the_raw_rows_are_shuffled_once_in_full(spark, capsys):
    counted = counted_transactions(cleaning_df(spark))
    counted.repartitionByRange("Customer ID", "InvoiceDate").explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange rangepartitioning") == 1


def test_an_empty_raw_table_has_an_audit_of_zeros(spark):
    d = folder()
    paths = run_stage(spark, "clean", d, cleaning_df(spark).limit(0))
    audit = {r.rule: r.rows for r in read_table(spark, paths["clean_audit"], "a").collect()}
    assert set(audit.values()) == {0} and len(audit) == 11
    assert read_table(spark, paths["clean_transactions"], "c").count() == 0


def test_checks_state_the_number_of_bad_rows_and_keep_the_old_table(spark):
    d = folder()
    run_stages(spark, cleaning_df(spark), d, stages=("clean", "rfm"))
    before = sorted(map(str, read_table(spark, f"{d}/rfm_raw", "r").collect()))
    clean = read_table(spark, f"{d}/clean_transactions", "c")
    dates = F.when(F.monotonically_increasing_id() % 3 != 0, F.col("InvoiceDate"))
    bad = clean.unionAll(clean).unionAll(clean).withColumn("InvoiceDate", dates)
    write_table(bad, f"{d}/clean_transactions")
    n = read_table(spark, f"{d}/clean_transactions", "c").where("InvoiceDate IS NULL").count()
    assert n > 0
    with pytest.raises(ValueError, match=f"found {n} rows with an invalid InvoiceDate"):
        run_stage(spark, "rfm", d)
    assert sorted(map(str, read_table(spark, f"{d}/rfm_raw", "r").collect())) == before


def test_negative_recency_is_counted(spark):
    from cohortlens.config import RFMConfig

    d = folder()
    run_stages(spark, cleaning_df(spark), d, stages=("clean", "rfm"))
    n = read_table(spark, f"{d}/rfm_raw", "r").where("Recency < 30").count()
    with pytest.raises(ValueError, match=f"found {n} customers with a negative recency"):
        run_stage(spark, "rfm", d, rcfg=RFMConfig(snapshot_add_days=-29))


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "InvoiceDate string")


def test_date_formats_are_found(spark):
    iso = ["2009-12-01 07:45:00", "2010-01-31", None, "nonsense"]
    found = find_date_format(texts(spark, iso), "InvoiceDate")
    assert (found.pattern, found.read, found.unreadable) == (None, 2, 1)
    assert find_date_format(texts(spark, ["12/1/2009 7:45", "1/31/2010 17:05"]), "InvoiceDate").pattern.startswith("M/d/yyyy")
    assert find_date_format(texts(spark, ["12/1/2009", "31/1/2010 17:05:01"]), "InvoiceDate").pattern.startswith("d/M/yyyy")
    assert find_date_format(texts(spark, ["12/1/09 7:45", "1/31/10 17:05"]), "InvoiceDate").pattern.startswith("M/d/yy[")
    assert find_date_format(texts(spark, ["3/3/2010", "4/4/2010"]), "InvoiceDate").read == 2  # both ways the same
    assert find_date_format(texts(spark, [None, ""]), "InvoiceDate").pattern is None
    assert find_date_format(spark.sql("SELECT TIMESTAMP_NTZ'2010-01-01' AS InvoiceDate"), "InvoiceDate").pattern is None


def test_mixed_and_ambiguous_dates_are_reported(spark):
    with pytest.raises(DateFormatError, match=r"no format reads all 3 dates \(2 as ISO, 1 as M/d/yyyy"):
        find_date_format(texts(spark, ["2010-01-02", "2010-01-03 10:00:00", "1/31/2010"]), "InvoiceDate")
    with pytest.raises(DateFormatError, match="both read all 2 dates, 1 of them differently"):
        find_date_format(texts(spark, ["1/2/2010", "3/3/2010"]), "InvoiceDate")


def test_iso_and_month_first_files_give_the_same_rows(spark):
    raw = cleaning_df(spark)
    dated = raw.withColumn("_t", F.expr("try_cast(InvoiceDate AS timestamp_ntz)"))
    spread = dated.withColumn("_t", F.when(F.col("Invoice").isNotNull(), F.col("_t") + F.expr("INTERVAL 20 DAY")).otherwise(F.col("_t")))
    outs = []
    for pattern in ("yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm:ss"):
        text = F.coalesce(F.date_format("_t", pattern), F.col("InvoiceDate"))
        d = folder()
        run_stage(spark, "clean", d, spread.withColumn("InvoiceDate", text).drop("_t"), TxConfig(date_format="auto"))
        outs.append(sorted(map(str, read_table(spark, f"{d}/clean_transactions", "c").collect())))
    assert outs[0] == outs[1] and outs[0]


def test_customer_tables_are_joined_without_a_shuffle(spark, capsys):
    from cohortlens.sources.files import read_profile_inputs

    d = folder()
    names = lambda: {t.tableName for t in spark.sql("SHOW TABLES LIKE 'cohortlens_*'").collect()}
    before = names()
    people = spark.range(5000).selectExpr("CAST(id AS STRING) AS CustomerID", "CAST(id % 3 AS INT) AS Cluster")
    money = spark.range(5000).selectExpr("CAST(id AS STRING) AS CustomerID", "id * 1.5D AS Monetary")
    write_table(money, f"{d}/rfm", buckets=("CustomerID", 6))
    write_table(people.repartition(4), f"{d}/clusters", buckets=("CustomerID", 6))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = read_profile_inputs(spark, f"{d}/rfm", f"{d}/clusters")
        joined.explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert joined.count() == 5000 and joined.where("Monetary != CAST(CustomerID AS INT) * 1.5").count() == 0
        write_table(people.where("Cluster < 2"), f"{d}/clusters", buckets=("CustomerID", 4))  # replaced, another number
        assert read_profile_inputs(spark, f"{d}/rfm", f"{d}/clusters").count() == 3334
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert names() == before


def test_bucketed_tables_at_relative_and_quoted_paths(spark, monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)
    money = spark.range(50).selectExpr("CAST(id AS STRING) AS CustomerID", "id * 1.5D AS Monetary")
    write_table(money, f"{tmp_path}/it's/rfm", buckets=("CustomerID", 3))
    assert read_table(spark, f"{tmp_path}/it's/rfm", "r").count() == 50
    if os.path.abspath("out") == spark.range(1).sparkSession.sparkContext._jvm.java.io.File("out").getAbsolutePath():
        write_table(money, "out/rfm", buckets=("CustomerID", 3))
        assert read_table(spark, "out/rfm", "r").count() == 50
    empty = money.where("Monetary < 0")
    write_table(empty, f"{tmp_path}/none", buckets=("CustomerID", 3))
    assert read_table(spark, f"{tmp_path}/none", "r").count() == 0


def test_the_profile_stage_reads_buckets(spark, capsys):
    d = folder()
    run_stages(spark, cleaning_df(spark), d, stages=("clean", "rfm"))
    rfm = read_table(spark, f"{d}/rfm_raw", "r")
    rfm.groupBy("CustomerID").count().explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "SelectedBucketsCount: 16 out of 16" in plan
