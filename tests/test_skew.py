"""A hot customer holding a third of all rows: results stay exact and every
shuffle of the aggregations moves partially aggregated rows only."""

import datetime as dt
import random
import re

import pandas as pd
import pytest

from cohortlens.operators.clean import clean_transactions
from cohortlens.operators.rfm import build_rfm
from cohortlens.operators.temporal import activity_cube, customer_activity, invoice_activity, temporal_profile
from cohortlens.sources.schema import raw_transactions_schema


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(9000):
        cust = "hot" if i % 3 == 0 else f"c{rnd.randint(0, 400)}"
        inv = f"{i // 4 if cust == 'hot' else i}"
        ts = dt.datetime(2011, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 60))
        rows.append((inv, "S", "D", float(rnd.randint(1, 5)), ts.strftime("%Y-%m-%d %H:%M:%S"), 1.25, cust, "UK"))
    return rows, spark.createDataFrame(rows, raw_transactions_schema())


def test_rfm_exact_with_hot_customer(spark, skewed):
    rows, df = skewed
    rfm = {r.CustomerID: r for r in build_rfm(clean_transactions(df)).collect()}
    pdf = pd.DataFrame(rows, columns=[f.name for f in raw_transactions_schema().fields])
    pdf["InvoiceDate"] = pd.to_datetime(pdf["InvoiceDate"])
    pdf["Revenue"] = pdf["Quantity"] * pdf["Price"]
    pdf = pdf.drop_duplicates()
    snap = pdf["InvoiceDate"].max().normalize() + pd.Timedelta(days=1)
    agg = pdf.groupby("Customer ID").agg(
        last=("InvoiceDate", "max"), F=("Invoice", pd.Series.nunique), M=("Revenue", "sum")
    )
    assert len(rfm) == len(agg)
    for cid, r in agg.iterrows():
        got = rfm[cid]
        assert got.Recency == (snap - r["last"]).days
        assert got.Frequency == r["F"]
        assert got.Monetary == pytest.approx(r["M"])
    assert rfm["hot"].Frequency == 2250  # invoices i // 4 for i = 0, 3, ..., 8997


def test_every_shuffle_is_preaggregated(spark, skewed):
    _, df = skewed
    plan = build_rfm(clean_transactions(df))._jdf.queryExecution().executedPlan().toString()
    # each hash exchange feeding an aggregate sits on a partial aggregate
    lines = plan.splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) >= 3  # dedup, (customer, invoice), customer
    for i in exchanges:
        line = lines[i]
        below = "\n".join(lines[i + 1 : i + 3])
        assert re.search(r"HashAggregate\(keys=.*functions=\[(partial_|\])", below), line


def test_activity_cube_bounds_hot_customer(spark, skewed):
    _, df = skewed
    clean = clean_transactions(df)
    cube = activity_cube(clean, "Customer ID", "InvoiceDate")
    hot_rows = cube.filter("CustomerID = 'hot'").count()
    assert hot_rows <= 7 * 24 * 3
    prof = temporal_profile(
        cube.withColumn("Cluster", cube.CustomerID.startswith("h").cast("int")),
        weight_col="transactions",
        one_row_per_customer_slot=True,
    )
    assert prof.groupBy().sum("transactions").first()[0] == clean.count()


def test_invoice_activity_feeds_rfm_and_cube(spark, skewed):
    _, df = skewed
    clean = clean_transactions(df)
    visits = invoice_activity(clean)
    assert sorted(map(tuple, build_rfm(visits).collect())) == sorted(map(tuple, build_rfm(clean).collect()))
    cube = activity_cube(clean, "Customer ID", "InvoiceDate")
    derived = customer_activity(visits).select(cube.columns)
    assert sorted(map(tuple, derived.collect())) == sorted(map(tuple, cube.collect()))
