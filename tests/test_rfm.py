import datetime as dt

import pytest

from cohortlens.operators.clean import clean_transactions
from cohortlens.operators.rfm import build_rfm, snapshot_date, top_customers
from cohortlens.plans.stages import materialize
from tests.conftest import rows
from tests.fixtures import cleaning_df


@pytest.mark.parametrize("mat", [None, materialize])
def test_rfm_fixture(spark, mat):
    rfm = build_rfm(clean_transactions(cleaning_df(spark)), materialize=mat)
    # 9 d 15 h floors to 9 (datediff would say 10); 11 h floors to 0; a
    # null invoice is not counted.
    assert rows(rfm) == [("13085", 9, 2, 17.0), ("13090", 0, 0, 3.75)]
    assert dict(rfm.dtypes) == {
        "CustomerID": "string",
        "Recency": "int",
        "Frequency": "bigint",
        "Monetary": "double",
    }


def test_snapshot(spark):
    clean = clean_transactions(cleaning_df(spark))
    snap = clean.select(snapshot_date(clean).alias("s")).first()["s"]
    assert snap == dt.datetime(2010, 1, 21, 0, 0)


def test_top_customers_tie_break(spark):
    df = spark.createDataFrame(
        [("b", 1, 1, 5.0), ("a", 1, 1, 5.0), ("c", 1, 1, 7.0)],
        "CustomerID string, Recency int, Frequency long, Monetary double",
    )
    assert [r.CustomerID for r in top_customers(df, "Monetary", 2).collect()] == ["c", "a"]


def test_negative_recency_fails(spark):
    from cohortlens.config import RFMConfig

    clean = clean_transactions(cleaning_df(spark))
    with pytest.raises(Exception, match="negative recency"):
        build_rfm(clean, rcfg=RFMConfig(snapshot_add_days=-1)).collect()


def test_rfm_diagnostics(spark):
    from cohortlens.operators.stats import rfm_diagnostics

    df = spark.createDataFrame(
        [(f"c{i:02d}", i % 7, 1 + i % 4, float(i * i)) for i in range(30)],
        "CustomerID string, Recency int, Frequency long, Monetary double",
    )
    d = rfm_diagnostics(df, top_n=3)
    assert list(d) == ["head", "describe", "skewness", "top_monetary", "top_frequency", "top_recency"]
    assert [r.CustomerID for r in d["head"].collect()] == ["c00", "c01", "c02", "c03", "c04"]
    assert [r.CustomerID for r in d["top_monetary"].collect()] == ["c29", "c28", "c27"]
    assert [r.CustomerID for r in d["top_frequency"].collect()] == ["c03", "c07", "c11"]
    desc = {r.field: r for r in d["describe"].collect()}
    assert desc["Monetary"]["count"] == 30 and desc["Monetary"]["p50"] == pytest.approx(210.5)
    assert [r.field for r in d["skewness"].collect()][0] == "Monetary"
