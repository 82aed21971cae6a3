"""Top-k search of a stated query set against all rows, block by block.

Rows and queries are dealt by hash into blocks and chunks of bounded size; a
task gets one block and one chunk, indexes the block, and returns each query's
best k of it. A ranked window merges the blocks' answers per query.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.sources.stage_tables import materialize

#: search(ids, vectors, query ids, queries, k) -> (row of the query, id, score) in flat arrays.
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.float64)


def _run(search: Search, k: int, score: str):
    kind = pa.int64() if score == "long" else pa.float64()
    names = ["query", "query_id", "row", "vec_id", "score"]

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table([pa.array([], kind if n == "score" else pa.int64()) for n in names], names=names)
        dim = len(rows.column("v")[0])
        keys, ids = (rows.column(c).to_numpy() for c in ("row", "vec_id"))
        order = np.lexsort((keys, ids))  # a row's place stands for it: smaller places have smaller ids
        keys, ids = keys[order], ids[order]
        by_key = np.argsort(keys)
        asked = queries.column("row").to_numpy()
        at = np.searchsorted(keys[by_key], asked)
        at[at == len(keys)] = 0
        own = np.where(keys[by_key][at] == asked, by_key[at], -1)  # a query's own row, if it is here
        if dim:
            q, place, scores = search(np.arange(len(ids)), _matrix(rows.column("v"), dim)[order], own, _matrix(queries.column("v"), dim), k)
        else:  # nothing to multiply: all alike
            every = np.arange(min(len(ids), k + 1))
            q, c = np.nonzero((own[:, None] != every) & (np.cumsum(own[:, None] != every, axis=1) <= k))
            place, scores = every[c], np.zeros(len(c))
        return pa.table([pa.array(asked[q]), pa.array(queries.column("vec_id").to_numpy()[q]), pa.array(keys[place]), pa.array(ids[place]), pa.array(scores).cast(kind)], names=names)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int, search: Search, block_rows: int, score: str = "double") -> DataFrame:
    """(query_id, rank, vec_id, score double or long) for rows (vec_id, v array<double>) without nulls.

    Every row is a candidate of every other query of its own dimension, also if it
    shares its vec_id with others; of rows that share one, each that is a query is
    answered on its own.
    """
    keyed = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.size("v").alias("dim"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = materialize(keyed)  # the keys stay with their rows
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    blocks, chunks = max(1, ceil(sizes["n"] / block_rows)), max(1, ceil((sizes["q"] or 0) / block_rows))
    hashed = F.xxhash64("row")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("dim", F.pmod(hashed, F.lit(blocks)).cast("int").alias("block"), every(chunks).alias("chunk"), "row", "vec_id", "v")
    right = rows.where("is_query").select("dim", F.pmod(hashed, F.lit(chunks)).cast("int").alias("chunk"), every(blocks).alias("block"), "row", "vec_id", "v")
    key = ["dim", "block", "chunk"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_run(search, k, score), f"query long, query_id long, row long, vec_id long, score {score}")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Best:
    """The best k (score, id) of many queries, larger scores and then smaller ids first."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)

    @property
    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Offer flat (query, id, score) entries."""
        ok = scores >= self.least[q]
        q, ids, scores = q[ok], ids[ok], scores[ok]
        if not len(q):
            return
        own, at = np.unique(q, return_inverse=True)
        every = np.concatenate([np.repeat(np.arange(len(own)), self.k), at])
        s = np.concatenate([self.score[own].reshape(-1), scores])
        i = np.concatenate([self.ids[own].reshape(-1), ids])
        order = np.lexsort((i, -s, every))
        every = every[order]
        place = np.arange(len(every)) - np.searchsorted(every, every)
        keep = order[place < self.k]
        self.score[own] = s[keep].reshape(-1, self.k)
        self.ids[own] = i[keep].reshape(-1, self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, c = np.nonzero(self.score > -np.inf)
        return q, self.ids[q, c], self.score[q, c]
