"""Best-fit packing under conflicts.

Texts (cut into pieces if longer than a sequence) go into sequences of
``capacity`` words. No sequence holds two pieces of one duplicate cluster, nor
two of one source while ``spread_sources`` is set. Documents are dealt by hash
into blocks of about ``block_docs`` pieces; each block is packed on its own, largest
piece first. Open bins stand in order of their residual room, each with a bitmap
of the sources and one of the clusters it holds. A piece takes the first bin,
from its own size upwards, whose bitmaps have none of its bits: the tightest
compatible one. If the search ends, a new bin opens.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.mixing import word_count
from cohortlens.sources.stage_tables import materialize

CAPACITY = 2048
BLOCK_DOCS = 4096


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each piece, in the order given. Sizes are at most capacity;
    sources and clusters are numbers from 0, or -1 for no conflict."""
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    by_room: list[tuple[int, int]] = []  # (residual, bin), ascending
    out = []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        sbit, cbit = (1 << s if s >= 0 else 0), (1 << c if c >= 0 else 0)
        i = bisect_left(by_room, (size, -1))
        while i < len(by_room) and (source_bits[by_room[i][1]] & sbit or cluster_bits[by_room[i][1]] & cbit):
            i += 1
        if i < len(by_room):
            room, b = by_room.pop(i)
        else:
            room, b = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[b] |= sbit
        cluster_bits[b] |= cbit
        if room > size:
            insort(by_room, (room - size, b))
        out.append(b)
    return out


def _numbers(column: pd.Series) -> list[int]:
    return pd.factorize(column)[0].tolist()


def _pack_block(capacity: int, spread: bool):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["words", "h", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        sources = _numbers(block["source"]) if spread else [-1] * len(block)
        block["bin"] = best_fit(block["words"].tolist(), sources, _numbers(block["cluster"]), capacity)
        block["fill"] = block.groupby("bin")["words"].transform("sum")
        return block[["doc_id", "piece", "words", "block", "bin", "fill"]]

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, block_docs: int = BLOCK_DOCS, spread_sources: bool = True, cluster: str | None = None, groups: DataFrame | None = None) -> DataFrame:
    """(doc_id, piece, words, block, bin, fill): a row for each piece of each row of docs.

    Needs doc_id, text and source. ``cluster`` names a column with the duplicate
    cluster; by default equal texts are one. Pieces of one text are a cluster of
    their own by that. ``groups``, rows of ``near_duplicates`` of the same docs,
    gives near copies one cluster instead. Null and empty texts and those without words have no
    words to pack: one row with piece 0, words 0 and null bin. A null source or
    cluster is a source or cluster without conflicts. A bin is named by block and
    bin. Repeated rows are packed each, in different bins.
    """
    h = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")))))
    own = F.col(cluster).cast("string") if cluster else F.md5("text")
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), own.alias("cluster"), word_count().alias("size"), h.alias("h"), F.xxhash64("text").alias("th"))
    if groups is not None:
        one = groups.where("component is not null").groupBy(F.col("doc_id").alias("its_id"), F.col("th").alias("its_th")).agg(F.min("component").alias("component"))
        sized = sized.join(one, sized.doc_id.eqNullSafe(one.its_id) & (sized.th == one.its_th), "left").withColumn("cluster", F.col("component").cast("string"))
    sized = materialize(sized.select("doc_id", "source", "cluster", "size", "h"))
    some = sized.where("size > 0").withColumn("pieces", F.ceil(F.col("size") / capacity).cast("long"))
    blocks = max(1, ceil((some.agg(F.sum("pieces")).first()[0] or 0) / block_docs))
    piece = some.withColumn("piece", F.explode(F.expr("sequence(0L, pieces - 1)")))
    words = F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("piece") * capacity)
    block = F.pmod(F.xxhash64("h", "piece"), F.lit(blocks))
    rows = piece.select("doc_id", "piece", words.alias("words"), "source", "cluster", "h", block.alias("block"))
    packed = rows.groupBy("block").applyInPandas(_pack_block(capacity, spread_sources), "doc_id long, piece long, words long, block long, bin long, fill long")
    none = sized.where("size = 0").selectExpr("doc_id", "0L as piece", "0L as words", "cast(null as long) as block", "cast(null as long) as bin", "cast(null as long) as fill")
    return packed.unionByName(none)
