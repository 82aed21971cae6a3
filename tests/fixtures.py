"""Hand-built inputs from FIXTURES.md (our own rows)."""

from __future__ import annotations

import datetime as dt

from cohortlens.sources.schema import raw_transactions_schema

# FIXTURES §2: one row per cleaning rule (+ kept rows and a duplicate).
CLEANING_ROWS = [
    ("489434", "A1", "LAMP", 2, "2010-01-05 08:30:00", 3.50, "13085.0", "UK"),
    ("489434", "A1", "LAMP", 2, "2010-01-05 08:30:00", 3.50, "13085", "UK"),
    ("C489435", "A1", "LAMP", -1, "2010-01-06 09:00:00", 3.50, "13085", "UK"),
    ("489436", "A2", "MUG", 0, "2010-01-06 10:00:00", 2.00, "13085", "UK"),
    ("489437", "A3", "CUP", 1, "2010-01-06 11:00:00", 0.00, "13085", "UK"),
    ("489438", "A3", "CUP", 1, "2010-01-06 11:00:00", 1.00, None, "UK"),
    ("489439", "A3", "CUP", 1, "not a date", 1.00, "13085", "UK"),
    ("489440", "A4", None, 1, "2010-01-07 11:00:00", 1.00, "13085", "UK"),
    (None, "A5", "BAG", 3, "2010-01-20 12:50:00", 1.25, " 13090 ", "UK"),
    ("c489441", "A6", "TOY", 1, "2010-01-11 09:00:00", 10.00, "13085", "UK"),
    ("489442", "A6", "TOY", None, "2010-01-12 09:00:00", 10.00, "13085", "UK"),
    ("489443", "A6", "TOY", 1, "2010-01-12 09:00:00", None, "13085", "UK"),
]


def cleaning_df(spark, extra=()):
    rows = [(*r[:3], r[3] if r[3] is None else float(r[3]), *r[4:]) for r in CLEANING_ROWS + list(extra)]
    return spark.createDataFrame(rows, raw_transactions_schema())


# FIXTURES §3: (Cluster, CustomerID, InvoiceDate).
TEMPORAL_ROWS = [
    (0, "a", dt.datetime(2024, 1, 1, 9, 0)),
    (0, "a", dt.datetime(2024, 1, 1, 9, 30)),
    (0, "b", dt.datetime(2024, 1, 2, 10, 0)),
    (0, "c", dt.datetime(2024, 1, 6, 11, 0)),
    (0, "a", dt.datetime(2024, 1, 21, 10, 0)),
    (1, "e", dt.datetime(2024, 1, 10, 12, 0)),
    (1, "f", dt.datetime(2024, 1, 11, 12, 0)),
]


def temporal_df(spark):
    return spark.createDataFrame(TEMPORAL_ROWS, "Cluster int, CustomerID string, InvoiceDate timestamp_ntz")
