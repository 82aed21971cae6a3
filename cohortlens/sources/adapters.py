"""Map the driver's test tables onto the raw transaction schema.

``orders_transactions``: one row per line item.
  Invoice      = 'C' || o_orderkey when l_returnflag = 'R' (a cancellation), else o_orderkey
  StockCode    = l_partkey          Description = p_name
  Quantity     = l_quantity         Price       = p_retailprice
  InvoiceDate  = o_orderdate        Customer ID = o_custkey
  Country      = n_name (via customer)

``events_transactions``: one row per event, with hours and minutes, so the
time-of-day summaries and the whole-day recency rule have real input.
  Invoice = event_id, Customer ID = user_id, InvoiceDate = ts,
  Quantity = 1, Price = value, StockCode = Description = event_type.

``dirty_orders_transactions``: every order line, damaged by its rule number
(part key + 5 x quantity, modulo 19), so that each cleaning rule has rows to drop:
  0 customer null, 1 date unreadable, 2 quantity null, 3 quantity 0, 4 quantity
  negative, 5 price null, 6 price NaN, 7 price 0, 8 price negative, 9 description
  null, 10 customer id ending in ".0", 11 customer id between blanks, 12 twice,
  13 country null, 14 stock code null, 15 a price of 0.001; 16 to 18 as they are.

Join sides other than the line items are broadcast only behind a size
check (``broadcast_if_small``); beyond the threshold the joins are
sort-merge, with AQE skew splitting. The line items are never the build side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import TxConfig
from cohortlens.sources.files import load_testdata
from cohortlens.sources.sizing import broadcast_if_small, size_estimate


def orders_transactions(spark: SparkSession, sf_dir: str, cfg: TxConfig = TxConfig()) -> DataFrame:
    li = load_testdata(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = load_testdata(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = load_testdata(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    customer = load_testdata(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load_testdata(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    cust_country = customer.join(
        broadcast_if_small(nation), customer.c_nationkey == nation.n_nationkey, "inner"
    ).select("c_custkey", "n_name")
    order_side = orders.join(
        broadcast_if_small(cust_country, size_estimate(customer) + size_estimate(nation)),
        orders.o_custkey == cust_country.c_custkey,
        "inner",
    )
    # N:1 joins keep the orders' rows; the sum of the inputs' estimates
    # bounds the joined side (Spark's own estimate is their product).
    order_bound = size_estimate(orders) + size_estimate(customer) + size_estimate(nation)
    joined = li.join(
        broadcast_if_small(order_side, order_bound), li.l_orderkey == order_side.o_orderkey, "inner"
    ).join(broadcast_if_small(part), li.l_partkey == part.p_partkey, "inner")
    invoice = F.concat(
        F.when(F.col("l_returnflag") == "R", F.lit(cfg.cancel_prefix)).otherwise(F.lit("")),
        F.col("o_orderkey").cast("string"),
    )
    return joined.select(
        invoice.alias(cfg.invoice),
        F.col("l_partkey").cast("string").alias(cfg.stock),
        F.col("p_name").alias(cfg.description),
        F.col("l_quantity").cast("int").alias(cfg.quantity),
        F.col("o_orderdate").alias(cfg.date),
        F.col("p_retailprice").alias(cfg.price),
        F.col("o_custkey").cast("string").alias(cfg.customer),
        F.col("n_name").alias(cfg.country),
    )


def dirty_orders_transactions(spark: SparkSession, sf_dir: str, cfg: TxConfig = TxConfig()) -> DataFrame:
    rows = orders_transactions(spark, sf_dir, cfg).withColumn(
        "_rule", (F.col(cfg.stock).cast("long") + 5 * F.col(cfg.quantity)) % 19
    )
    rule = F.col("_rule")

    def damaged(name: str, *cases: tuple[int, Column]) -> Column:
        out = F.col(name)
        for number, value in cases:
            out = F.when(rule == number, value).otherwise(out)
        return out.alias(name)

    nothing = F.lit(None)
    customer, quantity, price = F.col(cfg.customer), F.col(cfg.quantity), F.col(cfg.price)
    copies = F.explode(F.when(rule == 12, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    dated = rows.withColumn(cfg.date, F.col(cfg.date).cast("timestamp_ntz").cast("string"))
    return dated.select(
        cfg.invoice,
        damaged(cfg.stock, (14, nothing)),
        damaged(cfg.description, (9, nothing)),
        damaged(cfg.quantity, (2, nothing), (3, F.lit(0)), (4, -quantity)),
        damaged(cfg.date, (1, F.lit("not a date"))),
        damaged(cfg.price, (5, nothing), (6, F.lit(float("nan"))), (7, F.lit(0.0)), (8, -price), (15, F.lit(0.001))),
        damaged(cfg.customer, (0, nothing), (10, F.concat(customer, F.lit(".0"))), (11, F.concat(F.lit(" "), customer, F.lit(" ")))),
        damaged(cfg.country, (13, nothing)),
        copies.alias("_copy"),
    ).drop("_copy")


def events_transactions(spark: SparkSession, sf_dir: str, cfg: TxConfig = TxConfig()) -> DataFrame:
    ev = load_testdata(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value", "user_id")
    return ev.select(
        F.col("event_id").cast("string").alias(cfg.invoice),
        F.col("event_type").alias(cfg.stock),
        F.col("event_type").alias(cfg.description),
        F.lit(1).cast("int").alias(cfg.quantity),
        F.col("ts").alias(cfg.date),
        F.col("value").alias(cfg.price),
        F.col("user_id").cast("string").alias(cfg.customer),
        F.lit(None).cast("string").alias(cfg.country),
    )
