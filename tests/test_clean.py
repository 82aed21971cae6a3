import datetime as dt

from pyspark.sql import functions as F

from cohortlens.operators.clean import AUDIT_STEPS, clean_audit, clean_transactions
from tests.conftest import rows
from tests.fixtures import cleaning_df


def test_clean_keeps_expected_rows(spark):
    out = clean_transactions(cleaning_df(spark))
    got = rows(out, "Invoice", "Customer ID", "Revenue")
    assert got == [(None, "13090", 3.75), ("489434", "13085", 7.0), ("c489441", "13085", 10.0)]
    # dates parsed to timestamp_ntz, id stays text
    assert dict(out.dtypes)["InvoiceDate"] == "timestamp_ntz"
    assert dict(out.dtypes)["Customer ID"] == "string"


def test_audit_parts_sum_to_dropped(spark):
    audit = {r["rule"]: r["rows"] for r in clean_audit(cleaning_df(spark)).collect()}
    assert set(audit) == set(AUDIT_STEPS)
    expected = {
        "rows_in": 12,
        "customer_null": 1,
        "date_invalid": 1,
        "cancelled": 1,
        "quantity_null": 1,
        "quantity_non_positive": 1,
        "price_null": 1,
        "price_non_positive": 1,
        "description_null": 1,
        "duplicate": 1,
        "rows_out": 3,
    }
    assert audit == expected
    dropped = sum(v for k, v in audit.items() if k not in ("rows_in", "rows_out"))
    assert dropped == audit["rows_in"] - audit["rows_out"]


def test_nan_price_shares_null_price_fate(spark):
    extra = [("489444", "A7", "PEN", 1, "2010-01-12 09:00:00", float("nan"), "13085", "UK")]
    audit = {r["rule"]: r["rows"] for r in clean_audit(cleaning_df(spark, extra)).collect()}
    assert audit["price_null"] == 2
    assert clean_transactions(cleaning_df(spark, extra)).count() == 3


def test_second_date_format_is_bad_date(spark):
    extra = [("489445", "A8", "INK", 1, "12/1/2009 7:45", 1.0, "13085", "UK")]
    audit = {r["rule"]: r["rows"] for r in clean_audit(cleaning_df(spark, extra)).collect()}
    assert audit["date_invalid"] == 2


def test_cleaning_is_idempotent(spark):
    once = clean_transactions(cleaning_df(spark))
    twice = clean_transactions(once.drop("Revenue"))
    assert rows(once) == rows(twice)


def test_partitioning_does_not_change_result(spark):
    base = cleaning_df(spark)
    a = clean_transactions(base.repartition(1))
    b = clean_transactions(base.repartition(8))
    assert rows(a) == rows(b)


def test_clean_output_dates(spark):
    out = clean_transactions(cleaning_df(spark)).agg(F.max("InvoiceDate")).first()[0]
    assert out == dt.datetime(2010, 1, 20, 12, 50)
