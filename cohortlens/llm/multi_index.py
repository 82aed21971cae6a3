"""Hard negatives by an inverted multi-index, exact.

A vector is cut into halves, and each half has a codebook; a pair of codes is a
cell, and a row lies in the cell of its nearest centres. An anchor's half
product with a row is at most that with the half's centre plus the half's
length times the code's radius, so a cell's rows score at most the sum of two
half bounds. The multi-sequence algorithm visits cells by falling sum: a heap
over the two sorted lists of half bounds gives one cell after another and never
lists them all. Each cell that comes up is tested once more with its own radii.

A search has windows of scores to fill with the best k rows each. It is
certified, and ends, when the next bound lies below all of them: below the
window itself, or below the k-th best that it holds. First the anchors' best
rows of their own label are found (one window without ends), which set the
windows of the second search, over rows of other labels.

Both searches go in two rounds. The first visits an anchor's leading cells, the
second all others that its k-th best do not rule out. Rows lie in blocks of
bounded size, a crowded cell in several; an anchor goes to the blocks of the
cells that it visits, together with a bounded number of others of near cells.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.ann import finite
from cohortlens.sources.sizing import broadcast_if_small
from cohortlens.sources.stage_tables import materialize

#: Codes of a half, and the bound of the sample of rows that they are fitted on.
CODES, SAMPLE, ROUNDS = 16, 8192, 12
#: Rows of a block, anchors that meet it at once, and rows that the first round visits.
BLOCK_ROWS, CHUNK, FIRST = 4096, 1024, 4096
LOWEST, HIGHEST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max
#: Share of the lengths' product by which rounded bounds give way.
SLACK = 1e-9


def codebook(x: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centres by Lloyd's algorithm; fewer than k if the rows differ less."""
    rng = np.random.default_rng(seed)
    centres = x[:1]
    near = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < min(k, len(x)) and near.max() > 0:
        centres = np.concatenate([centres, x[[rng.choice(len(x), p=near / near.sum())]]])
        near = np.minimum(near, ((x - centres[-1]) ** 2).sum(axis=1))
    for _ in range(ROUNDS):
        own = nearest(x, centres)[0]
        used = np.unique(own)
        centres = np.stack([x[own == c].mean(axis=0) for c in used])
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, distance to it) of each row."""
    square = (centres * centres).sum(axis=1)
    own = np.argmin(square - 2 * (x @ centres.T), axis=1) if len(x) else np.zeros(0, np.int64)
    return own, np.sqrt(((x - centres[own]) ** 2).sum(axis=1))


@dataclass
class Index:
    """Codebooks and cells of the vectors of one dimension."""

    first: np.ndarray
    second: np.ndarray
    #: (codes x codes): rows, block of the first, blocks, radii of both halves.
    count: np.ndarray = field(init=False)
    block: np.ndarray = field(init=False)
    parts: np.ndarray = field(init=False)
    radius: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        shape = (len(self.first), len(self.second))
        self.count, self.block, self.parts = (np.zeros(shape, np.int64) for _ in range(3))
        self.radius = np.zeros((2, *shape))

    @staticmethod
    def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[..., : x.shape[-1] // 2], x[..., x.shape[-1] // 2 :]

    def walk(self, q: np.ndarray, rows: int, least: float, low: float = -np.inf, high: float = np.inf) -> tuple[list, list]:
        """Cells (i, j) that may hold scores of a window [low, high], best bounds first:
        (those of the first round, of about ``rows`` rows; those of the second, which
        may also hold scores of ``least`` or more)."""
        a, b = self.halves(q)
        la, lb = float(np.sqrt(a @ a)), float(np.sqrt(b @ b))
        mid = self.first @ a, self.second @ b
        give = SLACK * (1 + abs(mid[0]).max() + abs(mid[1]).max() + la * self.radius[0].max() + lb * self.radius[1].max())
        half = mid[0] + la * self.radius[0].max(axis=1), mid[1] + lb * self.radius[1].max(axis=0)
        order = np.argsort(-half[0], kind="stable"), np.argsort(-half[1], kind="stable")
        u, v = half[0][order[0]].tolist(), half[1][order[1]].tolist()
        early, late, met = [], [], 0
        heap, pushed = [(-(u[0] + v[0]), 0, 0)], {(0, 0)}
        while heap:
            bound, s, t = heapq.heappop(heap)
            if -bound + give < low or (met >= rows and -bound + give < least):
                break
            for x, y in ((s + 1, t), (s, t + 1)):
                if x < len(u) and y < len(v) and (x, y) not in pushed:
                    pushed.add((x, y))
                    heapq.heappush(heap, (-(u[x] + v[y]), x, y))
            i, j = order[0][s], order[1][t]
            n = int(self.count[i, j])
            if not n:
                continue
            reach = la * self.radius[0, i, j] + lb * self.radius[1, i, j] + give
            best, worst = mid[0][i] + mid[1][j] + reach, mid[0][i] + mid[1][j] - reach
            if best < low or worst > high:
                continue
            if met < rows:
                early.append((i, j))
                met += n
            elif best >= least:
                late.append((i, j))
        return early, late


def _by_dim(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, matrix) of a batch of vectors without nulls."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    start = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        rows = np.flatnonzero(size == d)
        yield d, rows, flat[start[rows][:, None] + np.arange(d)]


def _assign(indexes: dict[int, Index], scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            out, code, far = [None] * n, np.zeros((2, n), np.int32), np.zeros((2, n))
            for d, rows, x in _by_dim(batch.column("v")):
                x = np.floor(scale * x)
                index = indexes.get(d) or Index(np.zeros((1, d // 2)), np.zeros((1, d - d // 2)))
                for h, (part, centres) in enumerate(zip(Index.halves(x), (index.first, index.second), strict=True)):
                    code[h][rows], far[h][rows] = nearest(part, centres)
                for r, v in zip(rows.tolist(), x, strict=True):
                    out[r] = v
            names = ["key", "vec_id", "label", "anchor"]
            dims = batch.column("v").value_lengths().cast(pa.int32())
            yield pa.record_batch([*[batch.column(c) for c in names], dims, *map(pa.array, (*code, *far)), pa.array(out, pa.list_(pa.float64()))], names=[*names, "dim", "i", "j", "far1", "far2", "v"])

    return run


def _walk(indexes: dict[int, Index], late: bool, first_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "chunk", "low", "high", "least")]
            keys, chunks, blocks = [], [], []
            for d, rows, x in _by_dim(batch.column("v")):
                for r, q in zip(rows.tolist(), x, strict=True):
                    key, chunk, low, high, least = (c[r] for c in columns)
                    found = indexes[d].walk(q, first_rows, -np.inf if least is None else least, low, high)[late]
                    for cell in found:
                        parts = int(indexes[d].parts[cell])
                        blocks += range(int(indexes[d].block[cell]), int(indexes[d].block[cell]) + parts)
                        keys += [key] * parts
                        chunks += [chunk] * parts
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(chunks, pa.int64()), pa.array(blocks, pa.int64())], names=["key", "chunk", "block"])

    return run


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered doubles, exact."""
    if q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) < 2.0**53:
        return (q @ x.T).astype(np.int64)
    whole = [np.array([[int(c) for c in row] for row in m], dtype=object).reshape(m.shape) for m in (q, x)]
    s = whole[0] @ whole[1].T if q.shape[1] else np.zeros((len(q), len(x)), object)
    if s.size and not (LOWEST <= s.min() and s.max() <= HIGHEST):
        raise OverflowError("a score does not fit a long")
    return s.astype(np.int64)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest scores above LOWEST - 1, ties to smaller ids."""
    none = LOWEST - 1
    if score.shape[1] > k:
        least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        row, column = np.nonzero((score >= least[:, None]) & (score > none))
    else:
        row, column = np.nonzero(score > none)
    order = np.lexsort((ids[column], -score[row, column], row))
    row, column = row[order], column[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], column[keep]


_FOUND = "key long, w int, other long, vec_id long, score long"


def _score(same: bool, k: int, at_once: int = 64):
    """Best k of a block's rows for each anchor and window that meet there."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64) for _ in range(5)]
        if rows.num_rows and anchors.num_rows:
            matrix = lambda t: next(_by_dim(t.column("v").combine_chunks()))[2]
            x, q = matrix(rows), matrix(anchors)
            ids, others, labels = (rows.column(c).to_numpy() for c in ("vec_id", "other", "label"))
            keys, own = anchors.column("key").to_numpy(), anchors.column("label").to_numpy()
            wins = anchors.column("wins").to_pylist()
            for lo in range(0, len(q), at_once):
                part = slice(lo, lo + at_once)
                s = products(q[part], x)
                fit = ((own[part, None] == labels) == same) & (keys[part, None] != others)
                for w in range(max(map(len, wins[part]))):
                    of = [ws[w] if w < len(ws) else {"w": -1, "lo": HIGHEST, "hi": LOWEST} for ws in wins[part]]
                    low, high, name = (np.array([o[c] for o in of], np.int64) for c in ("lo", "hi", "w"))
                    r, c = best(np.where(fit & (s >= low[:, None]) & (s <= high[:, None]), s, LOWEST - 1), ids, k)
                    got = keys[part][r], name[r], others[c], ids[c], s[r, c]
                    out = [np.concatenate(p) for p in zip(out, got, strict=True)]
        return pa.table([pa.array(o, pa.int32() if n == 1 else pa.int64()) for n, o in enumerate(out)], names=["key", "w", "other", "vec_id", "score"])

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Search:
    """An index over written rows, and its anchors."""

    def __init__(self, rows: DataFrame, is_anchor: Column, scale: float, codes: int, block_rows: int, chunk: int, first_rows: int) -> None:
        """rows: (vec_id, embedding, label). An anchor is no candidate of its own."""
        self.first_rows = first_rows
        v = F.transform("embedding", lambda c: c.cast("double"))
        sound = rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite())
        keyed = sound.select(F.monotonically_increasing_id().alias("key"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), v.alias("v"))
        keyed = materialize(keyed)  # the keys stay with their rows
        # by a hash, few more rows than wanted reach the sort, whatever the number of rows and tasks
        hashed, share = F.xxhash64("vec_id", "key"), min(1.0, 4 * SAMPLE / max(keyed.count(), 1))
        likely = keyed.where(F.pmod(hashed, F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
        sample = likely.orderBy(hashed, "key").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
        indexes = {d: Index(*[codebook(h, codes) for h in Index.halves(np.floor(scale * x))]) for d, _, x in _by_dim(sample)} if len(sample) else {}
        kinds = "key long, vec_id long, label long, anchor boolean, dim int, i int, j int, far1 double, far2 double, v array<double>"
        self.rows = materialize(keyed.mapInArrow(_assign(indexes, scale), kinds))
        cells = self.rows.groupBy("dim", "i", "j").agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max("far1").alias("r1"), F.max("far2").alias("r2"))
        placed, block, before = [], 0, 0
        for c in sorted(cells.collect(), key=lambda c: (c["dim"], c["i"], c["j"])):  # codes x codes at most
            index = indexes.setdefault(c["dim"], Index(np.zeros((1, c["dim"] // 2)), np.zeros((1, c["dim"] - c["dim"] // 2))))
            at, parts = (c["i"], c["j"]), ceil(c["n"] / block_rows)
            index.count[at], index.block[at], index.parts[at] = c["n"], block, parts
            index.radius[(0, *at)], index.radius[(1, *at)] = c["r1"] * (1 + SLACK), c["r2"] * (1 + SLACK)
            placed.append((c["dim"], *at, block, parts, before, max(c["anchors"], 1)))
            block, before = block + parts, before + c["anchors"]
        self.indexes = indexes
        layout = self.rows.sparkSession.createDataFrame(placed, "dim int, i int, j int, block long, parts int, before long, anchors long")
        here = self.rows.join(broadcast_if_small(layout, 64 * len(placed)), ["dim", "i", "j"])
        some = F.xxhash64("key")
        self.blocks = here.select((F.col("block") + F.pmod(some, "parts")).alias("block"), F.col("key").alias("other"), "vec_id", "label", "v")
        near = F.floor((F.col("before") + F.pmod(some, "anchors")) / chunk).cast("long")  # anchors of near cells together
        self.anchors = materialize(here.where("anchor").select("key", "vec_id", "label", "v", near.alias("chunk")))

    def _round(self, wanted: DataFrame, late: bool, same: bool, k: int) -> DataFrame:
        """Best k, of the blocks that the round visits, per anchor and window; wanted: (key, wins, low, high, least)."""
        asking = self.anchors.join(wanted, "key")
        visits = materialize(asking.select("key", "v", "chunk", "low", "high", "least").mapInArrow(_walk(self.indexes, late, self.first_rows), "key long, chunk long, block long"))
        met = visits.select("block", F.col("chunk").alias("to")).distinct()
        left = self.blocks.join(met, "block").withColumnRenamed("block", "at").groupBy("at", "to")
        right = visits.join(asking.select("key", "label", "v", "wins"), "key").groupBy("block", "chunk")
        return materialize(_top(left.cogroup(right).applyInArrow(_score(same, k), _FOUND), k).drop("rank"))

    def fill(self, wins: DataFrame, same: bool, k: int) -> DataFrame:
        """(key, w, other, vec_id, score, rank): the best k rows of the anchor's label, or of
        others, in each window; wins: (key, w, lo, hi)."""
        open_end = lambda c, end: F.when(F.col(c) == end, F.lit(float("inf" if end > 0 else "-inf"))).otherwise(F.col(c).cast("double"))
        asked = wins.groupBy("key").agg(F.collect_list(F.struct("w", "lo", "hi")).alias("wins"), F.min(open_end("lo", LOWEST)).alias("low"), F.max(open_end("hi", HIGHEST)).alias("high"))
        early = self._round(asked.withColumn("least", F.lit(None).cast("double")), False, same, k)
        full = early.groupBy("key", "w").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") == k)
        ruled = wins.join(full, ["key", "w"], "left").groupBy("key").agg(F.min(F.greatest("lo", "kth")).cast("double").alias("least"))
        late = self._round(asked.join(ruled, "key"), True, same, k)
        return _top(early.unionAll(late), k)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256,
    codes: int = CODES, block_rows: int = BLOCK_ROWS, chunk: int = CHUNK, first_rows: int = FIRST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are integer inner products of floor(scale * component). An anchor's
    positives are its best rows of its label, and to each belong the best rows of
    other labels that score from ``low`` to ``high`` per cent of it (none, if it is
    negative); ties go to smaller vec_ids.

    rows needs vec_id, embedding and label; other columns are left alone. Rows
    with a null vec_id or label, a null vector, or a null or non-finite component
    take no part; an anchor meets vectors of its own dimension only. Each row is
    a candidate and may be an anchor, also if others share its vec_id. Scores are
    exact for components of any size, and one beyond a long is an error. An empty
    table, or one without anchors, gives no rows.
    """
    search = Search(rows, is_anchor, scale, codes, block_rows, chunk, first_rows)
    anyone = search.anchors.select("key", F.lit(0).alias("w"), F.lit(LOWEST).cast("long").alias("lo"), F.lit(HIGHEST).cast("long").alias("hi"))
    found = materialize(search.fill(anyone, True, positives).select("key", F.col("rank").alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # low and high per cent of a score, rounded inwards without leaving the longs
    lo = F.expr(f"positive_score div 100 * {low} + (positive_score % 100 * {low} + 99) div 100")
    hi = F.expr(f"positive_score div 100 * {high} + positive_score % 100 * {high} div 100")
    wins = found.where("positive_score >= 0").select("key", "w", lo.alias("lo"), hi.alias("hi"))
    hard = search.fill(wins, False, negatives)
    named = hard.select("key", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = search.anchors.select("key", F.col("vec_id").alias("anchor_id"))
    return named.join(found, ["key", "w"]).join(ids, "key").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
