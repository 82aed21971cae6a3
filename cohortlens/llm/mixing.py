"""Mix sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets. Sources in code-point order (null last) weigh 5, 2, 1, repeating,
   and share 1.5 times all words; a target stops at ``cap`` times its source's
   words and the excess goes to the others by weight (water filling, solved by
   one sorted pass over the source table).
2. Blocks. A source's documents are dealt by hash into blocks of about
   ``block_docs``. The mix takes every block floor(target / words) times and,
   once more, the leading blocks of a seeded permutation up to the target; the
   last of these is cut inside, document by document, and one document in words,
   so each source gives exactly its rounded target.
3. Splitting tree. The block draws of all sources are split among output
   shards: a node halves its shards and draws how many draws of each source go
   left (multivariate hypergeometric), down to single shards. Draws in
   permuted order then fill these quotas, so shards are disjoint and hold the
   sources in proportion. Each shard is shuffled on its own.

The tree is first that of groups of ``GROUP`` sources and then, in a task for each
group, that of its sources, with the group's draws of each shard as totals; a task
holds a vector of sources for each level, and gives its shards one by one. Documents
only meet their block's row.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, lcm

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.sources.stage_tables import materialize

WEIGHTS = (5, 2, 1)
#: Sources whose draws one task splits.
GROUP = 4096
#: Words of a shard, if the number of shards isn't given.
SHARD_WORDS = 1 << 24


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def order_key(seed: int) -> Column:
    """A document's place in its source's permutation."""
    return F.md5(F.concat_ws(":", F.lit(f"d{seed}"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))


def number(md5: Column) -> Column:
    """60 bits of an md5 as a long."""
    return F.conv(F.substring(md5, 1, 15), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 2) -> DataFrame:
    """(source, si, n_docs, source_size, target, full, extra) of rows (source, size).

    One row per source; the windows run over this table only.
    """
    by = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("si") - 1) % len(weights)).cast("int") + 1).cast("long")
    many = lcm(*weights)
    whole = Window.partitionBy()
    rank = Window.orderBy((F.col("source_size") * F.expr(f"{many} div weight")).asc(), "si")
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    t = by.withColumn("si", place).withColumn("weight", weight)
    t = t.withColumn("words", F.sum("source_size").over(whole)).withColumn("heavy", F.sum("weight").over(whole))
    t = t.withColumn("capped_before", F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))).withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    is_capped = (F.col("words") * 3 - F.col("capped_before") * 2) * F.col("weight") > F.col("source_size") * (2 * cap) * (F.col("heavy") - F.col("weight_before"))
    t = t.withColumn("is_capped", is_capped)
    t = t.withColumn("cut", F.sum(F.when(F.col("is_capped"), F.col("source_size") * cap).otherwise(0)).over(whole))
    t = t.withColumn("left_weight", F.sum(F.when(F.col("is_capped"), 0).otherwise(F.col("weight"))).over(whole))
    share = (F.col("weight") * (F.col("words") * 3 - F.col("cut") * 2)).cast("double") / (F.col("left_weight") * 2).cast("double")
    t = t.withColumn("target", F.when(F.col("is_capped"), (F.col("source_size") * cap).cast("double")).otherwise(F.greatest(share, F.lit(0.0))))
    quota = F.floor(F.col("target") + 0.5)
    size = F.greatest(F.col("source_size"), F.lit(1))
    t = t.withColumn("full", F.floor(quota / size)).withColumn("extra", quota - F.col("full") * size)
    return t.select("source", F.col("si").cast("long").alias("si"), "n_docs", "source_size", "target", "full", "extra")


def _split(q: np.ndarray, totals: np.ndarray, lo: int, hi: int, seed: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, draws of each source) of the shards from lo on, one after the other; totals:
    running sums of the shards' draws. Holds one vector for each level of the tree."""
    if not q.any():
        return
    if hi - lo == 1:
        yield lo, q
        return
    mid = (lo + hi) // 2
    left = np.random.default_rng([*seed, lo, hi]).multivariate_hypergeometric(q, int(totals[mid] - totals[lo]), method="marginals")
    yield from _split(left, totals, lo, mid, seed)
    yield from _split(q - left, totals, mid, hi, seed)


def even(total: int, shards: int) -> np.ndarray:
    """Running sums of shards' draws that halve the total at every node of the tree."""
    sums = np.zeros(shards + 1, dtype=np.int64)
    todo = [(0, shards, total)]
    while todo:
        lo, hi, n = todo.pop()
        if hi - lo == 1:
            sums[hi] = n
            continue
        mid = (lo + hi) // 2
        part = n * (mid - lo) // (hi - lo)
        todo += [(lo, mid, part), (mid, hi, n - part)]
    return np.cumsum(sums)


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards x sources) draws of each source for each shard; columns sum to the quotas."""
    quotas = np.asarray(quotas, dtype=np.int64)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    for shard, q in _split(quotas, even(int(quotas.sum()), shards), 0, shards, [seed]):
        out[shard] = q
    return out


def _quota_rows(groups: pd.DataFrame, shards: int, seed: int):
    """Rows (si, shard, start, n) of one group of sources. groups: (grp, draws) of all groups,
    whose own tree gives each of them its draws of every shard."""
    totals = groups.sort_values("grp")["draws"].to_numpy(dtype=np.int64)
    sums = even(int(totals.sum()), shards)

    def run(sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("si")
        grp = int(sources["grp"].iloc[0])
        if len(totals) > 1:
            own = np.zeros(shards + 1, dtype=np.int64)
            for shard, q in _split(totals, sums, 0, shards, [seed]):
                own[shard + 1] = q[grp]
            mine, name = np.cumsum(own), [seed, grp]
        else:
            mine, name = sums, [seed]
        si, q = sources["si"].to_numpy(), sources["draws"].to_numpy(dtype=np.int64)
        start, parts = np.zeros_like(q), []
        for shard, n in _split(q, mine, 0, shards, name):
            at = np.flatnonzero(n)
            parts.append((si[at], np.full(len(at), shard), start[at].copy(), n[at]))
            start += n
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4
        return pd.DataFrame(dict(zip(["si", "shard", "start", "n"], columns, strict=True)))

    return run


def running(rows: DataFrame, keys: list[str], order: Column, ties: list[str], what: Column, name: str) -> DataFrame:
    """rows with the sum of ``what`` over the rows before them, by ``order``, an md5, and ties.

    The first two digits cut a source into 256 ranges: their sums, and a window inside
    each, so that a source with half of all rows is no single task's work.
    """
    cut = rows.withColumn("_key", order).withColumn("_range", F.substring("_key", 1, 2)).withColumn("_what", what)
    sums = cut.groupBy(*keys, "_range").agg(F.sum("_what").alias("_sum"))
    base = sums.withColumn("_base", F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_range")) - F.col("_sum")).drop("_sum")
    inside = Window.partitionBy(*keys, "_range").orderBy("_key", *ties).rowsBetween(Window.unboundedPreceding, 0)
    out = cut.withColumn("_in", F.sum("_what").over(inside) - F.col("_what")).join(base, [*keys, "_range"])
    return out.withColumn(name, (F.col("_base") + F.col("_in")).cast("long")).drop("_key", "_range", "_what", "_in", "_base")


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 2, shards: int | None = None, block_docs: int = 256, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(source table, block table) for rows (source, size, h), h from ``order_key``.

    A row of the block table holds the draws of a block, an array of
    (pass, shard), and ``room``: words the last draw takes of this block if it is
    the one that is cut, else null.
    """
    sources = materialize(source_targets(sized, weights, cap).withColumn("blocks", F.ceil(F.col("n_docs") / block_docs)))
    if shards is None:
        taken = sources.agg(F.sum("target")).first()[0] or 0
        shards = max(1, ceil(taken / SHARD_WORDS))
    blocks = place(sized, sources).groupBy("si", "block", "full", "extra").agg(F.sum("size").alias("words"))
    key = F.md5(F.concat_ws(":", F.lit(f"b{seed}"), F.col("block").cast("string")))
    blocks = running(materialize(blocks), ["si"], key, ["block"], F.col("words"), "before")
    room = F.when((F.col("before") < F.col("extra")) & (F.col("before") + F.col("words") > F.col("extra")), F.col("extra") - F.col("before"))
    blocks = blocks.withColumn("room", room).withColumn("passes", F.col("full") + F.when((F.col("before") < F.col("extra")) & (F.col("words") > 0), 1).otherwise(0))
    blocks = materialize(blocks.select("si", "block", "words", "room", "passes"))
    draws = blocks.where("passes > 0").select("si", "block", F.explode(F.sequence(F.lit(1).cast("long"), "passes")).alias("pass"))
    mixed = F.md5(F.concat_ws(":", F.lit(f"p{seed}"), F.col("pass").cast("string"), F.col("block").cast("string")))
    draws = running(draws, ["si"], mixed, ["pass", "block"], F.lit(1), "i")
    counts = blocks.groupBy("si").agg(F.sum("passes").cast("long").alias("draws")).withColumn("grp", F.floor((F.col("si") - 1) / GROUP).cast("long"))
    groups = counts.groupBy("grp").agg(F.sum("draws").alias("draws")).toPandas()  # a row for each GROUP sources
    whole = pd.DataFrame({"grp": np.arange(int(groups["grp"].max()) + 1 if len(groups) else 0)}).merge(groups, how="left").fillna(0)
    quotas = counts.groupBy("grp").applyInPandas(_quota_rows(whole, shards, seed), "si long, shard long, start long, n long")
    slots = quotas.select("si", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("i"))
    dealt = draws.join(slots, ["si", "i"]).groupBy("si", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
    return sources, materialize(blocks.join(dealt, ["si", "block"]).select("si", "block", "room", "draws"))


def place(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """The rows with their source's row (si, ...) and their block."""
    s = sources.withColumnRenamed("source", "its_source")
    return sized.join(s, sized.source.eqNullSafe(s.its_source)).drop("its_source").withColumn("block", number(F.col("h")) % F.col("blocks"))


def attach(rows: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows (source, size, h, ...) with target, source_size and ``takes``: an array
    of (pass, shard, words), empty if the mix leaves the row out.

    Only blocks that are cut, one per source, are put in order.
    """
    placed = place(rows, sources).join(blocks, ["si", "block"], "left")
    takes = F.coalesce(F.transform("draws", lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), F.col("size").alias("words"))), F.array())
    whole = placed.where("room is null").withColumn("takes", takes)
    order = Window.partitionBy("si", "block").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.where("room is not null").withColumn("got", F.sum("size").over(order))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.col("got") + F.col("size"))).cast("long")
    cut = cut.withColumn("got", part)
    last = F.expr("transform(draws, (d, i) -> struct(d.pass as pass, d.shard as shard, if(i = size(draws) - 1, got, size) as words))")
    cut = cut.withColumn("takes", F.filter(last, lambda d: (d["words"] > 0) | (d["pass"] < F.size("draws")))).drop("got")
    return whole.unionByName(cut)


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 2, shards: int | None = None, block_docs: int = 256, seed: int = 0) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, passes, shards.

    Needs doc_id, text and source. Null text has size 0; a null source is a
    source of its own, the last. Repeated rows count each by itself. No rows
    give no rows.
    """
    sized = materialize(docs.select("doc_id", "source", word_count().alias("size"), order_key(seed).alias("h")))
    out = attach(sized, *plan(sized, weights, cap, shards, block_docs, seed))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda a, t: a + t["words"])
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.size("takes").alias("passes"), F.transform("takes", lambda t: t["shard"]).alias("shards"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = 2, shards: int | None = None, block_docs: int = 256, seed: int = 0) -> DataFrame:
    """The mixed corpus: the columns of docs, a row for each time it is taken, in
    shards that are shuffled. A document whose last take is cut in words is
    given whole there, so a source may exceed its target by part of one text."""
    sized = materialize(docs.select("doc_id", "source", word_count().alias("size"), order_key(seed).alias("h")))
    sources, blocks = plan(sized, weights, cap, shards, block_docs, seed)
    row = F.struct(*[docs[c] for c in docs.columns])
    rows = docs.select(row.alias("row"), "source", word_count().alias("size"), order_key(seed).alias("h"))
    out = attach(rows, sources, blocks).select("row", "h", F.explode("takes").alias("take"))
    local = F.xxhash64(F.lit(seed), "h", "take.pass")
    return out.repartition("take.shard").sortWithinPartitions(F.col("take.shard"), local).select("row.*")
