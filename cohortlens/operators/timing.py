"""Activity timing for all slots together (AGG-9..13, TOP-3, TOP-4).

Customers get dense numbers, so that a set of them is a bitmap. One aggregate
over the activity makes, for every (cluster, weekday, hour, month period) and
block of 32768 numbers, the number of transactions and the bitmap of the
customers. All else rolls up from that table: bitmaps of finer slots are OR'ed
into those of coarser ones, which keeps distinct counts exact, where plain
counts could not be added up; no fact row is expanded and no set of ids is
shuffled again. The transactions of all slot kinds come from one GROUPING SETS
over the profile, at most 504 rows per cluster.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.config import TemporalConfig
from cohortlens.operators.temporal import SLOT_KEYS, top_share
from cohortlens.sources.stage_tables import materialize

# Hash parts of each cluster whose customers are numbered by one window.
PARTS = 4096
# Slots that the reference lists per cluster.
TOP = {"day_of_week": 3, "hour": 5, "month_period": 3}


def number_customers(clusters: DataFrame, id_col: str = "CustomerID", cluster_col: str = "Cluster") -> DataFrame:
    """(id, cluster, number): customers numbered from 0 without gaps, cluster by cluster.

    A count per (cluster, hash part) and its running sum over at most
    clusters x ``PARTS`` rows give each part its first number; a window numbers the
    customers inside a part. Null ids and clusters are left out.
    """
    part = F.pmod(F.xxhash64(id_col), F.lit(PARTS)).cast("int")
    rows = clusters.select(id_col, cluster_col).dropna().withColumn("_part", part)
    counts = rows.groupBy(cluster_col, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy(cluster_col, "_part")) - F.col("_n")
    first = counts.select(F.col(cluster_col).alias("_c"), F.col("_part").alias("_p"), before.alias("_first"))
    inside = F.row_number().over(Window.partitionBy(cluster_col, "_part").orderBy(id_col)) - 1
    placed = rows.withColumn("_inside", inside)
    joined = placed.join(first, (F.col(cluster_col) == F.col("_c")) & (F.col("_part") == F.col("_p")))
    return joined.select(id_col, cluster_col, (F.col("_first") + F.col("_inside")).cast("long").alias("number"))


def activity_bitmaps(
    activity: DataFrame, numbered: DataFrame, tcfg: TemporalConfig = TemporalConfig(), weight_col: str = "transactions"
) -> DataFrame:
    """(cluster, weekday, hour, month period, block, customers bitmap, transactions), written.

    ``activity``: (id, slots, weight), any number of rows per customer and slot.
    Slots that are null are dropped, as are customers without a number.
    """
    rows = activity.select(tcfg.id_col, *SLOT_KEYS, weight_col).dropna(subset=list(SLOT_KEYS))
    joined = rows.join(numbered, tcfg.id_col)
    return materialize(
        joined.groupBy(tcfg.cluster_col, *SLOT_KEYS, F.bitmap_bucket_number("number").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers"),
            F.sum(weight_col).cast("long").alias("transactions"),
        )
    )


def profile_of(bitmaps: DataFrame, tcfg: TemporalConfig = TemporalConfig()) -> DataFrame:
    """AGG-12 from the bitmaps: transactions and distinct customers per (cluster, slots)."""
    return bitmaps.groupBy(tcfg.cluster_col, *SLOT_KEYS).agg(
        F.sum("transactions").cast("long").alias("transactions"),
        F.sum(F.bitmap_count("customers")).cast("long").alias("unique_customers"),
    )


def transactions_by_slot(profile: DataFrame, tcfg: TemporalConfig = TemporalConfig()) -> DataFrame:
    """AGG-9..11 in one aggregate: (cluster, kind, slot, transactions), slots as text."""
    sets = profile.groupingSets([[F.col(tcfg.cluster_col), F.col(s)] for s in SLOT_KEYS], tcfg.cluster_col, *SLOT_KEYS)
    sums = sets.agg(F.sum("transactions").cast("long").alias("transactions"), *[F.grouping(s).alias(f"_{s}") for s in SLOT_KEYS])
    kind = F.coalesce(*[F.when(F.col(f"_{s}") == 0, F.lit(s)) for s in SLOT_KEYS])
    slot = F.coalesce(*[F.when(F.col(f"_{s}") == 0, F.col(s).cast("string")) for s in SLOT_KEYS])
    return sums.select(tcfg.cluster_col, kind.alias("kind"), slot.alias("slot"), "transactions")


def customers_by_slot(bitmaps: DataFrame, tcfg: TemporalConfig = TemporalConfig()) -> DataFrame:
    """AGG-13 for all slot kinds: (cluster, kind, slot, unique_customers), slots as text.

    A slot's bitmaps of one block are OR'ed, then counted, and the blocks added.
    """

    def one(slot: str) -> DataFrame:
        merged = bitmaps.groupBy(tcfg.cluster_col, slot, "block").agg(F.bitmap_or_agg("customers").alias("customers"))
        counts = merged.groupBy(tcfg.cluster_col, slot).agg(F.sum(F.bitmap_count("customers")).cast("long").alias("unique_customers"))
        return counts.select(tcfg.cluster_col, F.lit(slot).alias("kind"), F.col(slot).cast("string").alias("slot"), "unique_customers")

    return reduce(DataFrame.unionAll, [one(s) for s in SLOT_KEYS])


def timing_tables(
    activity: DataFrame, clusters: DataFrame, tcfg: TemporalConfig = TemporalConfig(), weight_col: str = "transactions"
) -> dict[str, DataFrame]:
    """The timing summary as named tables: ``temporal_profile``, and for each of
    ``dow``, ``hour`` and ``period`` its counts, top slots by transactions and top
    slots by customers. ``activity`` has no cluster yet; ``clusters`` maps ids to it.
    """
    bitmaps = activity_bitmaps(activity, number_customers(clusters, tcfg.id_col, tcfg.cluster_col), tcfg, weight_col)
    profile = materialize(profile_of(bitmaps, tcfg))
    counts = materialize(transactions_by_slot(profile, tcfg))
    uniques = materialize(customers_by_slot(bitmaps, tcfg))
    out = {"temporal_profile": profile}
    for slot, short in zip(SLOT_KEYS, ("dow", "hour", "period"), strict=True):
        typed = F.col("slot").cast("int" if slot == "hour" else "string").alias(slot)
        dense = tcfg.labels if slot == "month_period" else None
        by_tx = counts.where(F.col("kind") == slot).select(tcfg.cluster_col, typed, "transactions")
        by_customer = uniques.where(F.col("kind") == slot).select(tcfg.cluster_col, typed, "unique_customers")
        out[f"{short}_counts"] = by_tx.orderBy(tcfg.cluster_col, F.desc("transactions"), slot)
        out[f"top_{short}"] = top_share(by_tx, tcfg.cluster_col, slot, "transactions", "pct_within_cluster", TOP[slot], dense)
        out[f"top_{short}_unique"] = top_share(
            by_customer, tcfg.cluster_col, slot, "unique_customers", "pct_unique_within_cluster", TOP[slot], dense
        )
    return out
