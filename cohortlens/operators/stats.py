"""Statistics and data-quality summaries (STA-1..6, AGG-3..6).

Exact quantiles in two reads of the values
------------------------------------------
``percentile``/``median`` merge a value->count map of the entire group in one
task. Instead, ``exact_quantiles``

1. sketches each group (KLL, merged in two levels so that the sketches of all
   scan tasks never meet in one), which brackets every wanted rank by two values,
   ``MARGIN`` of the ranks to either side: some four times the sketch's error at
   99 % confidence. Counts, means and deviations come with the same read;
2. counts the rows between the brackets and, value by value, those inside them.

Running counts over equal parts of the brackets, and then over the values of the
one part that holds the rank, give the exact values; only these counts, some
thousandths of the rows, are read for it. Should a rank lie outside its bracket
after all, which the counts show, ``counted_quantiles`` answers: three reads that
count values in ever finer ranges, without a sketch. Ranks interpolate linearly
(pandas / DuckDB ``quantile_cont``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.scalar import is_missing
from cohortlens.functions.stats import adjusted_skewness
from cohortlens.operators.rfm import first_rows, top_customers
from cohortlens.sources.sizing import broadcast_if_small
from cohortlens.sources.stage_tables import materialize, reusable


def melt(df: DataFrame, value_cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long form (keys..., field, value double); one generator, no shuffle."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in value_cols]
    )
    return df.select(*keys, F.inline(pairs))


# Ranges per power of two of the first pass, and parts of a range of the second.
_PER_OCTAVE = 1024
_PARTS = 1 << 21
# Bytes of a row of the table of ranges, generously, for its broadcast check.
_RANGE_BYTES = 256


def _octave_range(v: Column) -> Column:
    """Number of the value's range, ascending with the value; 0 for zero."""
    exponent = F.least(F.log2(F.abs(v)), F.lit(1100.0))  # infinities get a range of their own
    step = F.floor(exponent * _PER_OCTAVE) + F.lit(1100 * _PER_OCTAVE)
    return F.when(v == 0, F.lit(0)).when(v > 0, step).otherwise(-step).cast("long")


def _part(v: Column, lo: Column, hi: Column) -> Column:
    """Number of the equal part of [lo, hi] that holds the value."""
    part = F.least(F.floor((v - lo) / (hi - lo) * _PARTS), F.lit(_PARTS - 1))
    return F.when(hi > lo, part).otherwise(F.lit(0)).cast("long")


def _hits(counts: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The counted ranges that hold a target rank, with the rows before them
    (``_before``) and the targets inside (``_at``: number of p, upper rank or not)."""
    w = Window.partitionBy(*keys, "_from").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_end", F.col("_before") + F.sum("_c").over(w))
    ranked = ranked.withColumn("_before", F.col("_end") - F.col("_c"))
    targets = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_n") - 1)
        for upper, rank in ((False, F.floor(pos)), (True, F.ceil(pos))):
            inside = (rank >= F.col("_before")) & (rank < F.col("_end"))
            targets.append(F.when(inside, F.struct(F.lit(i).alias("i"), F.lit(upper).alias("upper"))))
    return ranked.withColumn("_at", F.array_compact(F.array(*targets))).filter(F.size("_at") > 0)


def _interpolated(picked: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, p, value) from (keys, _n, _i number of p, _v0 lower, _v1 upper value)."""
    p = F.array(*[F.lit(x) for x in probs])[F.col("_i")]
    pos = p * (F.col("_n") - 1)
    value = F.when(F.col("_v0") == F.col("_v1"), F.col("_v0")).otherwise(
        F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (pos - F.floor(pos))
    )
    return picked.select(*keys, p.alias("p"), value.cast("double").alias("value"))


def _both(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per wanted quantile from rows (keys, _n, _v, _t: number of p, upper rank or not)."""
    return found.groupBy(*keys, "_n", F.col("_t.i").alias("_i")).agg(
        F.max(F.when(~F.col("_t.upper"), F.col("_v"))).alias("_v0"),
        F.max(F.when(F.col("_t.upper"), F.col("_v"))).alias("_v1"),
    )


def counted_quantiles(long: DataFrame, keys: Sequence[str], probs: Sequence[float], bound: int) -> DataFrame:
    """(keys, p, value) without a sketch, in three reads of ``long`` (keys, value):

    1. ranges of 1/1024 of a power of two (about 2^22 over all doubles, some ten
       thousand over usual ones); running counts find the ranges that hold the
       ranks floor(p (n-1)) and ceil(p (n-1));
    2. each such range, cut into 2^21 equal parts;
    3. exact values of the parts found. A range of pass 1 spans about 2^42
       doubles, a part of pass 2 therefore about 2^22 at most.

    ``bound``: greatest size of the table of ranges, which is broadcast within
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joined by key.
    """
    v = F.col("value")
    span = [F.count(F.lit(1)).alias("_c"), F.min("value").alias("_lo"), F.max("value").alias("_hi")]
    counts = long.groupBy(*keys, _octave_range(v).alias("_b")).agg(*span)
    counts = counts.withColumns(
        {"_n": F.sum("_c").over(Window.partitionBy(*keys)), "_before": F.lit(0).cast("long"), "_from": F.lit(0.0)}
    )
    for last in (False, True):
        ranges = _hits(counts, keys, probs).select(*keys, "_n", "_before", F.col("_lo").alias("_from"), F.col("_hi").alias("_to"))
        near = long.join(broadcast_if_small(ranges, bound), keys).filter((v >= F.col("_from")) & (v <= F.col("_to")))
        bucket = v if last else _part(v, F.col("_from"), F.col("_to"))
        counts = near.groupBy(*keys, "_n", "_before", "_from", bucket.alias("_b")).agg(*span)
    found = _hits(counts, keys, probs).select(*keys, "_n", F.col("_lo").alias("_v"), F.explode("_at").alias("_t"))
    return _interpolated(_both(found, keys), keys, probs)


# Size of a sketch, and the share of the ranks by which a bracket reaches to either
# side of the rank it is for. Parts that a bracket is cut into.
SKETCH, MARGIN, CUTS = 8192, 0.002, 1 << 14
# Sketches of a group that are merged apart before they meet.
SALTS = 64


def _sketched(long: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys, n, mean, std, min, max, _lo: array, _hi: array of the brackets), written: the first read."""
    v = F.col("value")
    first = long.groupBy(*keys, F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")).agg(
        F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("_s"),
        F.count(v).alias("_n"), F.avg(v).alias("_mean"), F.var_pop(v).alias("_var"), F.min(v).alias("_min"), F.max(v).alias("_max"),
    )
    whole = Window.partitionBy(*keys)
    mean = F.sum(F.col("_n") * F.col("_mean")).over(whole) / F.sum("_n").over(whole)
    n = F.col("_n").cast("double")
    merged = first.withColumn("mean", mean).groupBy(*keys, "mean").agg(
        F.kll_merge_agg_double("_s", F.lit(SKETCH)).alias("_s"),
        F.sum("_n").alias("n"),
        F.sum(n * F.col("_var") + n * (F.col("_mean") - F.col("mean")) * (F.col("_mean") - F.col("mean"))).alias("_m2"),
        F.min("_min").alias("min"),
        F.max("_max").alias("max"),
    )
    size = F.col("n").cast("double")

    def edge(p: float, upper: bool):
        # a sketch answers for constant ranks only: few rows, whose ranks lie far apart, are all inside
        rank = p + MARGIN if upper else p - MARGIN
        end = F.col("max" if upper else "min")
        if not 0 < rank < 1:
            return end
        return F.when(size * MARGIN < 4, end).otherwise(F.kll_sketch_get_quantile_double("_s", F.lit(rank)))

    std = F.when(F.col("n") > 1, F.sqrt(F.col("_m2") / (size - 1)))
    return materialize(
        merged.select(
            *keys, "n", "mean", std.alias("std"), "min", "max",
            *[F.array(*[edge(p, upper) for p in probs]).alias(c) for c, upper in (("_lo", False), ("_hi", True))],
        )
    )


def exact_quantiles(
    df: DataFrame, value_cols: Sequence[str], probs: Sequence[float], group_cols: Sequence[str] = ()
) -> DataFrame:
    """Exact linear-interpolated quantiles per (group, field, p).

    Returns (group_cols..., field, p, value, n, mean, std [sample], min, max), the
    last five per (group, field). Null and NaN values and rows with a null group
    key are skipped.

    The values are read twice: an input with joins or shuffles is written as a
    stage table first, a plain scan is read again. The brackets, one row per
    (group, field), are broadcast if their number bounds them under
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that, values and brackets
    are joined by group, with AQE splitting hot ones.
    """
    probs = sorted({float(p) for p in probs})
    keys = [*group_cols, "field"]
    long = melt(df, value_cols, group_cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    for g in group_cols:
        long = long.filter(F.col(g).isNotNull())
    long = reusable(long)
    brackets = _sketched(long, keys, probs)
    groups = brackets.count()

    v = F.col("value")
    lo, hi = ([F.col(c)[i] for i in range(len(probs))] for c in ("_lo", "_hi"))
    near = long.join(broadcast_if_small(brackets.select(*keys, "_lo", "_hi"), groups * (64 + 32 * len(probs))), keys)
    # brackets ascend: values are ordered by how many lie below them, then by being inside, then by themselves
    below = reduce(lambda a, b: a + b, [(v > h).cast("int") for h in hi])
    inside = reduce(lambda a, b: a | b, [(v >= low) & (v <= high) for low, high in zip(lo, hi, strict=True)])
    part = F.coalesce(
        *[F.when((v >= low) & (v <= high), F.when(high > low, F.least(F.floor((v - low) / (high - low) * CUTS), F.lit(CUTS - 1))).otherwise(F.lit(0))) for low, high in zip(lo, hi, strict=True)],
        F.lit(-1),
    )
    counts = materialize(
        near.groupBy(*keys, below.alias("_below"), inside.alias("_inside"), part.cast("long").alias("_part"), F.when(inside, v).alias("_v")).agg(F.count("*").alias("_c"))
    )

    place = ["_below", "_inside", "_first", "_part"]
    running = lambda over, order: F.sum("_c").over(Window.partitionBy(*over).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    parts = counts.groupBy(*keys, "_below", "_inside", "_part").agg(F.sum("_c").alias("_c"), F.min("_v").alias("_first"))
    ranked = parts.withColumn("_to", running(keys, place)).withColumn("_from", F.col("_to") - F.col("_c"))
    ranked = ranked.withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    wanted = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_n") - 1)
        for upper, rank in ((False, F.floor(pos)), (True, F.ceil(pos))):
            wanted.append(F.struct(F.lit(i).alias("i"), F.lit(upper).alias("upper"), rank.alias("rank")))
    hit = ranked.withColumn("_t", F.explode(F.array(*wanted))).where("_inside AND _t.rank >= _from AND _t.rank < _to")
    hit = hit.select(*keys, "_below", "_part", "_n", "_from", "_t")
    values = counts.where("_inside").join(hit, [*keys, "_below", "_part"])
    order = Window.partitionBy(*keys, "_below", "_part", "_t").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = values.withColumn("_end", F.col("_from") + F.sum("_c").over(order))
    found = ends.where("_t.rank < _end AND _t.rank >= _end - _c").select(*keys, "_n", "_v", "_t")
    picked = materialize(_both(found, keys))
    if picked.where("_v0 IS NOT NULL AND _v1 IS NOT NULL").count() == groups * len(probs):
        quantiles = _interpolated(picked, keys, probs)
    else:  # a rank outside its bracket
        quantiles = counted_quantiles(long, keys, probs, groups * 2 * len(probs) * _RANGE_BYTES)
    moments = brackets.select(*keys, "n", "mean", "std", "min", "max")
    return quantiles.join(broadcast_if_small(moments, groups * 128), keys)


def describe(
    df: DataFrame,
    cols: Sequence[str],
    percentiles: Sequence[float] = (0.5, 0.9, 0.95, 0.99),
    digits: int | None = 4,
) -> DataFrame:
    """STA-1 / STA-3: pandas ``describe`` per column, one row per column.

    (field, count, mean, std [sample], min, p<NN>..., max); percentile
    columns are named p25, p50, p90 ... from the requested fractions.
    """
    q = exact_quantiles(df, cols, percentiles).withColumnRenamed("n", "count")
    names = [f"p{round(p * 100):d}" for p in percentiles]
    out = q.groupBy("field", "count", "mean", "std", "min", "max").agg(
        *[F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(n) for p, n in zip(percentiles, names)]
    )
    order = ["mean", "std", "min", *names, "max"]

    def r(c: str) -> Column:
        return F.round(F.col(c), digits).alias(c) if digits is not None else F.col(c)

    return out.select("field", F.col("count").cast("long").alias("count"), *[r(c) for c in order])


def skewness(df: DataFrame, cols: Sequence[str], digits: int | None = 4) -> DataFrame:
    """STA-2: bias-adjusted skewness per column, largest first."""
    long = melt(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    out = long.groupBy("field").agg(adjusted_skewness(F.col("value")).alias("skewness"))
    if digits is not None:
        out = out.select("field", F.round("skewness", digits).alias("skewness"))
    return out.orderBy(F.desc("skewness"), "field")


def missing_ratio(df: DataFrame, top_n: int = 10) -> DataFrame:
    """STA-4: share of missing (null or NaN) values per column, top n.

    One global aggregate (partial per task), then a tiny unpivot; ties are
    broken by column position.
    """
    fields = df.schema.fields
    wide = df.agg(
        *[
            F.avg(is_missing(F.col(f.name), f.dataType).cast("double")).alias(f"_m{i}")
            for i, f in enumerate(fields)
        ]
    )
    long = wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f.name).alias("field"),
                        F.lit(i).alias("position"),
                        F.col(f"_m{i}").alias("missing_ratio"),
                    )
                    for i, f in enumerate(fields)
                ]
            )
        )
    )
    return long.orderBy(F.desc("missing_ratio"), "position").limit(top_n)


def date_range_uniques(df: DataFrame, date_col: str, customer_col: str, invoice_col: str) -> DataFrame:
    """AGG-3 + AGG-4: first/last date, distinct customers and invoices.

    Rows first collapse to one per (customer, invoice), map-side; only these are
    doubled, one for each kind of id, and grouped by it. No row of ``df`` is
    expanded and no set of ids meets in one task.
    """
    pairs = df.groupBy(customer_col, invoice_col).agg(F.min(date_col).alias("_min"), F.max(date_col).alias("_max"))
    ids = F.array(
        *[F.struct(F.lit(i).alias("_kind"), F.col(c).cast("string").alias("_id")) for i, c in enumerate((customer_col, invoice_col))]
    )
    each = pairs.select("_min", "_max", F.inline(ids)).groupBy("_kind", "_id").agg(F.min("_min").alias("_min"), F.max("_max").alias("_max"))
    return each.agg(
        F.min("_min").alias("min_date"),
        F.max("_max").alias("max_date"),
        F.count_if((F.col("_kind") == 0) & F.col("_id").isNotNull()).cast("long").alias("customers"),
        F.count_if((F.col("_kind") == 1) & F.col("_id").isNotNull()).cast("long").alias("invoices"),
    )


def row_count(df: DataFrame) -> DataFrame:
    """AGG-5 as a DataFrame (rows bigint)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("rows"))


def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """AGG-6: rows per value, ordered by value (null group dropped, as pandas)."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).cast("long").alias(name))
        .orderBy(col)
    )


def quality_report(
    df: DataFrame, date_col: str, customer_col: str, invoice_col: str, revenue_col: str
) -> dict[str, DataFrame]:
    """STA-5: the post-cleaning report as named tidy DataFrames."""
    return {
        "date_range_uniques": date_range_uniques(df, date_col, customer_col, invoice_col),
        "revenue_describe": describe(df, [revenue_col]),
        "missing_ratio": missing_ratio(df),
    }


def rfm_diagnostics(
    rfm: DataFrame,
    cols: Sequence[str] = ("Recency", "Frequency", "Monetary"),
    id_col: str = "CustomerID",
    top_n: int = 10,
    head_n: int = 5,
) -> dict[str, DataFrame]:
    """STA-6: the RFM table's checks as named tidy DataFrames.

    ``head``       first ``head_n`` customers by id (TOP-2; per-group order of
                   the reference's grouped table)
    ``describe``   STA-1 with percentiles 50 / 90 / 95 / 99 (exact)
    ``skewness``   STA-2, bias-adjusted, largest first
    ``top_<col>``  TOP-1: ``top_n`` customers by each column, ties by id

    The top-n and head tables are per-task top-k (TakeOrderedAndProject),
    never a global sort of all customers. All entries are lazy, except
    that ``describe`` writes an input with joins or shuffles as a stage
    table first (see ``exact_quantiles``).
    """
    out = {
        "head": first_rows(rfm, head_n, id_col),
        "describe": describe(rfm, cols),
        "skewness": skewness(rfm, cols),
    }
    for c in reversed(cols):  # Monetary, Frequency, Recency: the reference's order
        out[f"top_{c.lower()}"] = top_customers(rfm, c, top_n, id_col)
    return out
