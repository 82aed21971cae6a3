"""Approximate nearest neighbours by inner product: few stable projections, a
kd-tree over them, and a chi-square stopping test.

Within a block, vectors get one more component that makes their lengths equal,
so the largest inner product is the least Euclidean distance. ``PROJECTIONS``
Gaussian (2-stable) projections index them: the square of a projected distance
over that of the true one follows a chi-square law. The kd-tree over the
projections yields leaves in order of their projected distance, and of a leaf
only the vectors whose own projected distance is still within reach are verified
on their original vectors. The reach is where the test holds: a vector as near as
the k-th best found would, with probability ``CERTAIN``, have been met before it.
The search ends when no leaf is within reach.

Measured on blocks of 8192 unit vectors of 64 dimensions, for 20 neighbours: 59 %
of all pairs verified with recall 0.96 on random ones, 1.6 % and 1.0 % with recall
0.99 on 200 clusters of spread 0.2 and 0.05. Random vectors of many dimensions are
nearly equally far from each other, so that few can be passed over.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.search_blocks import Best, top_k

PROJECTIONS = 16
CERTAIN = 0.9
LEAF = 64
BLOCK_ROWS = 8192
#: Leaves that a query takes between two stopping tests.
STRIDE = 4
#: Pairs that are verified at once.
PAIRS = 1 << 17


def chi_square(x: np.ndarray, m: int) -> np.ndarray:
    """The chi-square law's distribution function for an even number of degrees."""
    half = x / 2
    term, total = np.ones_like(half), np.zeros_like(half)
    for i in range(m // 2):
        total += term
        term = term * half / (i + 1)
    return 1 - np.exp(-half) * total


def quantile(p: float, m: int) -> float:
    """Where the chi-square law's distribution function for an even number of degrees reaches p."""
    low, high = 0.0, 10.0 * m + 100
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(np.array([mid]), m)[0] < p else (low, mid)
    return high


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """The leaves (row numbers) of a kd-tree: halves at the median of the widest side."""
    todo, out = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            out.append(rows)
            continue
        own = points[rows]
        side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        half = len(rows) // 2
        order = np.argpartition(own[:, side], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return out


def _search(projections: int, certain: float, seed: int, verified: list[int] | None = None):
    """verified: gets the numbers of pairs whose original vectors were multiplied."""
    sure = quantile(certain, projections)

    def search(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int):
        by_id = np.argsort(ids, kind="stable")  # then smaller rows are smaller ids
        ids, x = ids[by_id], x[by_id]
        square = (x * x).sum(axis=1)
        most = max(square.max(), 1e-300)
        length = np.sqrt((q * q).sum(axis=1))
        scaled = q * (np.sqrt(most) / length)[:, None]
        g = np.random.default_rng(seed).normal(size=(x.shape[1] + 1, projections))
        points = np.column_stack([x, np.sqrt(np.maximum(most - square, 0))]) @ g
        probe = scaled @ g[:-1]
        leaves = kd_leaves(points)
        low = np.stack([points[r].min(axis=0) for r in leaves])
        high = np.stack([points[r].max(axis=0) for r in leaves])
        near = np.zeros((len(q), len(leaves)))
        for j in range(projections):  # squared distance of each query to each leaf's box
            near += np.maximum(np.maximum(low[None, :, j] - probe[:, j, None], probe[:, j, None] - high[None, :, j]), 0) ** 2
        order = np.argsort(near, axis=1)
        place = (points * points).sum(axis=1)
        best = Best(len(q), k)
        # equal vectors are within reach of each other, however their projections are rounded
        give = 1e-9 * (place.max() + (probe * probe).sum(axis=1))
        reach = np.full(len(q), np.inf)
        going, at = np.arange(len(q)), 0
        while len(going):
            taken = order[going, at : at + (STRIDE if at else 1)]
            at += taken.shape[1]
            flat_q, flat_row = [], []
            pairs = np.stack([np.repeat(going, taken.shape[1]), taken.reshape(-1)])
            pairs = pairs[:, np.argsort(pairs[1], kind="stable")]
            for part in np.split(pairs, np.flatnonzero(np.diff(pairs[1])) + 1, axis=1):
                own, rows = part[0], leaves[part[1, 0]]
                far = place[rows][None, :] - 2 * (probe[own] @ points[rows].T) + (probe[own] * probe[own]).sum(axis=1)[:, None]
                a, b = np.nonzero((far <= reach[own][:, None]) & (qids[own][:, None] != ids[rows][None, :]))
                flat_q.append(own[a])
                flat_row.append(rows[b])
            own, rows = np.concatenate(flat_q), np.concatenate(flat_row)
            for lo in range(0, len(own), PAIRS):
                a, b = own[lo : lo + PAIRS], rows[lo : lo + PAIRS]
                # einsum sums every pair in the same order: equal vectors score alike
                best.add(a, b, np.einsum("ij,ij->i", q[a], x[b]))
            if verified is not None:
                verified.append(len(own))
            kth = np.maximum(2 * most - 2 * best.least[going] * (np.sqrt(most) / length[going]), 0)
            # no less far than the found ones, so that their copies are met; without a k-th best, infinite
            own = points[np.minimum(best.ids[going], len(x) - 1)] - probe[going][:, None, :]
            reach[going] = np.maximum(sure * kth, (own * own).sum(axis=2).max(axis=1)) + give[going]
            if at >= len(leaves):
                break
            going = going[near[going, order[going, at]] <= reach[going]]
        own, row, score = best.rows()
        return own, ids[row], score

    return search


def finite(vector: str = "embedding") -> Column:
    """True for vectors without null, NaN or infinite components."""
    # Not null, and no component that is null or unbounded.
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, projections: int = PROJECTIONS, certain: float = CERTAIN, seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products found.

    Needs vec_id and embedding. Vectors null, empty, zero, or holding null or
    non-finite components, and rows with a null vec_id, take no part. Each other
    row is a candidate, also if it shares its vec_id. Ties go to smaller vec_ids.
    """
    some = F.exists("embedding", lambda c: c != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & finite() & some)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return top_k(rows, is_query, k, _search(projections, certain, seed), BLOCK_ROWS)
