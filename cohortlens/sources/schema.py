"""Explicit schemas (no inference at read time)."""

from __future__ import annotations

from pyspark.sql import types as T

from cohortlens.config import TxConfig


def raw_transactions_schema(cfg: TxConfig = TxConfig()) -> T.StructType:
    """Raw retail transactions as found in CSV: dates and ids stay text.

    The id is read as text so it never round-trips through a double
    (``cast(12345678.0 as string)`` is ``1.2345678E7`` in Spark).
    """
    return T.StructType(
        [
            T.StructField(cfg.invoice, T.StringType()),
            T.StructField(cfg.stock, T.StringType()),
            T.StructField(cfg.description, T.StringType()),
            T.StructField(cfg.quantity, T.DoubleType()),
            T.StructField(cfg.date, T.StringType()),
            T.StructField(cfg.price, T.DoubleType()),
            T.StructField(cfg.customer, T.StringType()),
            T.StructField(cfg.country, T.StringType()),
        ]
    )


def clean_transactions_schema(cfg: TxConfig = TxConfig()) -> T.StructType:
    """Clean transactions as written by the cleaning stage: the raw columns
    with a parsed ``timestamp_ntz`` date, plus Revenue."""
    fields = [
        T.StructField(f.name, T.TimestampNTZType()) if f.name == cfg.date else f
        for f in raw_transactions_schema(cfg).fields
    ]
    return T.StructType([*fields, T.StructField(cfg.revenue, T.DoubleType())])


RFM_SCHEMA = T.StructType(
    [
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Recency", T.IntegerType()),
        T.StructField("Frequency", T.LongType()),
        T.StructField("Monetary", T.DoubleType()),
    ]
)

SCALED_COLUMNS = ("CustomerID", "R_log", "F_log", "M_log", "R_scaled", "F_scaled", "M_scaled")

SCALED_SCHEMA = T.StructType(
    [T.StructField("CustomerID", T.StringType())] + [T.StructField(c, T.DoubleType()) for c in SCALED_COLUMNS[1:]]
)


def clustered_schema(cluster_col: str = "Cluster") -> T.StructType:
    """Scaled features plus the cluster label, as written by the clustering stage."""
    return T.StructType([*SCALED_SCHEMA.fields, T.StructField(cluster_col, T.IntegerType())])

TEMPORAL_PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("Cluster", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("month_period", T.StringType()),
        T.StructField("transactions", T.LongType()),
        T.StructField("unique_customers", T.LongType()),
    ]
)


# Driver test tables as Spark reads them (identical at every scale factor).
# Declaring them skips the footer-reading job of schema inference per read.
TESTDATA_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
