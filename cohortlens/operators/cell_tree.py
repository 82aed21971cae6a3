"""ML-4 as the reference has it: the silhouette with plain Euclidean distance, without pairs of rows.

The sum of the distances from a point to a cluster is taken cell by cell. The rows
that have the same labels in all labellings have an octree over the features, whose
sums count for a cluster of each labelling; a node knows its members' number, mean,
second moments and box. For the mean distance of a point to n members around
their mean, at distance D and with variance s2, two facts hold:

- it lies between D and sqrt(D^2 + s2) (Jensen, both ways);
- D + (s2 - q) / 2D, with q the variance along the line of sight, is off by at
  most 0.1925 r s2 / (D - r)^2, r the members' greatest distance from the mean
  (Taylor's third-order term, whose angular factor is at most 2 / (3 sqrt 3)).

A node whose second bound is within ``tolerance`` for every point of a group of
neighbouring points is taken whole; other nodes are opened. Leaves that are still
too near give the middle of the first interval. The bounds add up to an interval
for each point's silhouette, and their means to one for the score.

Groups of points are halved down to ``GROUP`` points, and nodes far from a group
are left to none of its points: by the Taylor series about the group's middle, up
to the third order in a point's offset from it, their distances add up to one cubic
for each cluster. With R the points' greatest offset, the series is off by at most
0.1925 r s2 / D^2 (the members' own third order) and 0.125 (R + r)^2 (R^2 + s2) /
(D - R - r)^3 (the fourth order, whose angular factor is at most 1 / 8), which has
to be within ``tolerance``. So a point costs less as the points get denser.

Passes over the rows: one for ranges and cluster sizes, one that aggregates rows
into the finest cells, one that scores. Cells are made in tasks, one for each
coarse cell and cluster (``SUB`` levels of cells at most), and merged there until
a leaf holds over 1 / ``cells`` of the rows at most, so that the tree that is sent
to the tasks is bounded, whatever the number of rows.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Levels of the tree, and those below a coarse cell, which one task builds.
LEVELS, SUB = 10, 5
# Points that share the nodes they take whole, and points that are grouped at once.
GROUP, AT_ONCE = 64, 1 << 16
# Points that one task scores.
TASK = 1 << 12
# Different rows of labels at most, for which all labellings share their trees.
JOINT = 512
THIRD_ORDER, FOURTH_ORDER = 0.1925, 0.125


@dataclass
class Tree:
    """Nodes of one cluster's octree, root last; children of node i are ``child[first[i]:first[i + 1]]``."""

    size: float
    n: np.ndarray
    mean: np.ndarray
    moment: np.ndarray  # mean outer product of the members' offsets from the mean, (nodes, d, d)
    reach: np.ndarray
    first: np.ndarray
    child: np.ndarray

    def opened(self, nodes: np.ndarray) -> np.ndarray:
        """The children of the nodes."""
        start, many = self.first[nodes], self.first[nodes + 1] - self.first[nodes]
        return self.child[np.repeat(start - np.cumsum(many) + many, many) + np.arange(many.sum())]

    def take(self, low: np.ndarray, high: np.ndarray, tolerance: float, todo: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(nodes taken whole, leaves too near for that) for the points of a box, from the root or the nodes ``todo`` down."""
        whole, near = [], []
        todo = np.array([len(self.n) - 1]) if todo is None else todo
        while len(todo):
            gap = np.maximum(np.maximum(low - self.mean[todo], self.mean[todo] - high), 0)
            distance = np.sqrt((gap * gap).sum(axis=1))
            room = distance - self.reach[todo]
            variance = np.einsum("nii->n", self.moment[todo])
            ok = THIRD_ORDER * self.reach[todo] * variance <= tolerance * np.where(room > 0, room * room, 0)
            whole.append(todo[ok])
            todo = todo[~ok]
            leaf = self.first[todo + 1] == self.first[todo]
            near.append(todo[leaf])
            todo = self.opened(todo[~leaf])
        return (np.concatenate(whole), np.concatenate(near)) if whole else (np.zeros(0, np.int64),) * 2

    def expand(self, low: np.ndarray, high: np.ndarray, tolerance: float, todo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes of the cubic of a box, its greatest error for each, nodes left to the box's parts)."""
        mid, radius = (low + high) / 2, float(np.sqrt(((high - low) ** 2).sum()) / 2)
        taken, errors, left = [todo[:0]], [np.zeros(0)], [todo[:0]]
        while len(todo):
            offset, reach = mid - self.mean[todo], self.reach[todo]
            distance = np.sqrt((offset * offset).sum(axis=1))
            room = distance - radius - reach
            far = np.flatnonzero(room > 0)
            r, variance, gap = reach[far], np.einsum("nii->n", self.moment[todo[far]]), room[far]
            error = THIRD_ORDER * r * variance / distance[far] ** 2 + FOURTH_ORDER * (radius + r) ** 2 * (radius * radius + variance) / gap**3
            ok = error <= tolerance
            taken.append(todo[far[ok]])
            errors.append(error[ok])
            rest = np.ones(len(todo), bool)
            rest[far[ok]] = False
            wide = (reach > radius) & (self.first[todo + 1] > self.first[todo])
            left.append(todo[rest & ~wide])
            todo = self.opened(todo[rest & wide])
        return np.concatenate(taken), np.concatenate(errors), np.concatenate(left)

    def cubic(self, nodes: np.ndarray, mid: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For each column of ``weight``, the coefficients of the cubic about ``mid`` (see ``_monomials``)
        that the distances to the nodes add up to."""
        offset, q, d = mid - self.mean[nodes], self.moment[nodes], len(mid)
        r = np.sqrt((offset * offset).sum(axis=1))[:, None]
        e = offset / r
        qe, variance = np.einsum("nij,nj->ni", q, e), np.einsum("nii->n", q)[:, None]
        along = (qe * e).sum(axis=1)[:, None]
        zero = r + (variance - along) / (2 * r)
        one = e + ((3 * along - variance) * e - 2 * qe) / (2 * r * r)
        two = (np.eye(d) - e[:, :, None] * e[:, None, :]).reshape(-1, d * d)
        three = -(two[:, :, None] * (e / r)[:, None, :]).reshape(-1, d**3)
        return np.concatenate([zero, one, two / (2 * r), three / (2 * r)], axis=1).T @ weight

    def sums(self, x: np.ndarray, tolerance: float, weight: np.ndarray, todo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum of the distances to the members below the nodes ``todo``, its greatest error) of each
        row of x, for each column of ``weight``, which counts the nodes' members."""
        low, high = x.min(axis=0), x.max(axis=0)
        whole, near = self.take(low, high, tolerance, todo)
        mid = (low + high) / 2
        x = x - mid
        total, error = np.zeros((2, len(x), weight.shape[1]))
        for nodes, far in ((whole, True), (near, False)):
            if not len(nodes):
                continue
            m, n, q = self.mean[nodes] - mid, weight[nodes], self.moment[nodes]
            variance = np.einsum("nii->n", q)
            square = np.maximum((x * x).sum(axis=1)[:, None] - 2 * (x @ m.T) + (m * m).sum(axis=1), 0)
            distance = np.sqrt(square)
            if far:
                # (x - m)' q (x - m), as one product of the monomials of x
                d = x.shape[1]
                qm = np.einsum("nij,nj->ni", q, m)
                along = (x[:, :, None] * x[:, None, :]).reshape(len(x), d * d) @ q.reshape(len(q), d * d).T - 2 * (x @ qm.T) + (qm * m).sum(axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    second = np.where(square > 0, (variance - along / square) / (2 * distance), 0)
                second = np.where(variance > 0, second, 0)
                total += (distance + second) @ n
                gap = np.maximum(np.maximum(low - self.mean[nodes], self.mean[nodes] - high), 0)
                room = np.sqrt((gap * gap).sum(axis=1)) - self.reach[nodes]
                with np.errstate(divide="ignore", invalid="ignore"):
                    bound = np.where(variance > 0, THIRD_ORDER * self.reach[nodes] * variance / (room * room), 0)
                error += bound @ n
            else:
                wide = np.sqrt(square + variance) - distance
                total += (distance + wide / 2) @ n
                error += (wide / 2) @ n
        return total, error


def _monomials(x: np.ndarray) -> np.ndarray:
    """1, the components of each row of x, and their products of two and of three."""
    two = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    return np.concatenate([np.ones((len(x), 1)), x, two, (two[:, :, None] * x[:, None, :]).reshape(len(x), -1)], axis=1)


def _together(trees: Sequence[Tree]) -> tuple[Tree, np.ndarray]:
    """All trees under one root that is never taken, and the number of each node's tree."""
    d = trees[0].mean.shape[1]
    nodes, links = np.cumsum([0, *[len(t.n) for t in trees]]), np.cumsum([0, *[len(t.child) for t in trees]])
    child = [t.child + lo for t, lo in zip(trees, nodes, strict=False)]
    first = [t.first[:-1] + lo for t, lo in zip(trees, links, strict=False)]
    size = sum(t.size for t in trees)
    one = Tree(
        size,
        np.concatenate([*[t.n for t in trees], [size]]),
        np.concatenate([*[t.mean for t in trees], np.zeros((1, d))]),
        np.concatenate([*[t.moment for t in trees], np.eye(d)[None]]),
        np.concatenate([*[t.reach for t in trees], [np.inf]]),
        np.concatenate([*first, [links[-1], links[-1] + len(trees)]]),
        np.concatenate([*child, nodes[1:] - 1]),
    )
    return one, np.repeat(np.arange(len(trees) + 1), [*np.diff(nodes), 1])


def plant(level: np.ndarray, cell: np.ndarray, n: np.ndarray, total: np.ndarray, square: np.ndarray, low: np.ndarray, high: np.ndarray) -> Tree:
    """The tree over leaves: levels, cell numbers on their level (rows of d integers), and what they add up to."""
    d = cell.shape[1]
    up = (n, total, square, low, high)
    cols: list[list[np.ndarray]] = [[] for _ in up]
    kids: list[np.ndarray] = []
    ids, cells, values, made = np.zeros(0, np.int64), np.zeros((0, d), np.int64), [u[:0] for u in up], 0
    for deep in range(int(level.max()), -1, -1):
        here = level == deep
        new = np.arange(made, made + int(here.sum()))
        made += len(new)
        for c, u in zip(cols, up, strict=True):
            c.append(u[here])
        kids += [np.zeros(0, np.int64)] * len(new)
        ids, cells = np.concatenate([ids, new]), np.concatenate([cells, cell[here]])
        values = [np.concatenate([v, u[here]]) for v, u in zip(values, up, strict=True)]
        if deep == 0 and len(ids) == 1:
            break
        _, group = np.unique(cells >> 1 if deep else np.zeros_like(cells), axis=0, return_inverse=True)
        order = np.argsort(group.reshape(-1), kind="stable")
        starts = np.flatnonzero(np.diff(group.reshape(-1)[order], prepend=-1))
        cells, ids = (cells >> 1)[order[starts]], ids[order]
        merged = [f.reduceat(v[order], starts, axis=0) for f, v in zip((np.add, np.add, np.add, np.minimum, np.maximum), values, strict=True)]
        kids += np.split(ids, starts[1:])
        for c, v in zip(cols, merged, strict=True):
            c.append(v)
        ids, values = np.arange(made, made + len(starts)), merged
        made += len(starts)
    n, total, square, low, high = (np.concatenate(c) for c in cols)
    mean = total / n[:, None]
    moment = square.reshape(-1, d, d) / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    single = ((low == high).all(axis=1))[:, None, None]
    moment = np.where(single, 0, moment)
    moment[:, range(d), range(d)] = np.maximum(moment[:, range(d), range(d)], 0)
    far = np.maximum(high - mean, mean - low)
    sizes = np.array([len(k) for k in kids])
    return Tree(float(n[-1]), n.astype(float), mean, moment, np.sqrt((far * far).sum(axis=1)), np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(kids) if sizes.any() else np.zeros(0, np.int64))


def _leaves(most: dict[tuple, int], d: int):
    """Leaves of one coarse cell of one cluster, from its finest cells."""

    def run(key: tuple, cells: pa.Table) -> pa.Table:
        cell = np.stack([cells.column(f"i{a}").to_numpy() for a in range(d)], axis=1)
        names = ["n", *[f"s{a}" for a in range(d)], *[f"q{a}{b}" for a in range(d) for b in range(d)]]
        added = np.stack([cells.column(c).to_numpy().astype(float) for c in names], axis=1)
        low, high = (np.stack([cells.column(f"{c}{a}").to_numpy() for a in range(d)], axis=1) for c in ("lo", "hi"))
        limit = most[key[0].as_py(), key[1].as_py()]
        out, left = [], np.arange(len(cell))
        for level in range(LEVELS - SUB, LEVELS + 1):
            if not len(left):
                break
            number, group = np.unique(cell[left] >> (LEVELS - level), axis=0, return_inverse=True)
            group = group.reshape(-1)
            count = np.bincount(group, weights=added[left, 0])
            done = (count <= limit) | (level == LEVELS)
            order = np.argsort(group, kind="stable")
            starts = np.flatnonzero(np.diff(group[order], prepend=-1))
            rows = left[order]
            sums = [f.reduceat(v[rows], starts, axis=0) for f, v in ((np.add, added), (np.minimum, low), (np.maximum, high))]
            out.append(np.concatenate([np.full((int(done.sum()), 1), level), number[done], *[s[done] for s in sums]], axis=1))
            left = left[~done[group]]
        rows = np.concatenate(out)
        columns = [f"c{i}" for i in range(rows.shape[1])]
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.string()), pa.array([key[1].as_py()] * len(rows), pa.int32()), *[pa.array(rows[:, i]) for i in range(rows.shape[1])]], names=["t", "c", *columns])

    return run


def _interleaved(x: np.ndarray, low: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Order of the points along the cells of the tree."""
    cell = np.clip(np.floor((x - low) / step), 0, (1 << LEVELS) - 1).astype(np.int64)
    code = np.zeros(len(x), np.int64)
    for bit in range(LEVELS):
        for a in range(x.shape[1]):
            code |= ((cell[:, a] >> bit) & 1) << (bit * x.shape[1] + a)
    return np.argsort(code, kind="stable")


def point_scores(x: np.ndarray, labels: Sequence[np.ndarray], trees: dict[tuple, Tree], tolerance: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(silhouette, least, greatest) of each point in each labelling, neighbours together.
    A tree holds the rows of one label in each labelling, or none."""
    clusters = [sorted({j[t] for j in trees} - {None}) for t in range(len(labels))]
    first = np.cumsum([0, *map(len, clusters)])
    at = {j: [first[t] + clusters[t].index(c) for t, c in enumerate(j) if c is not None] for j in trees}
    size, sums = np.zeros(first[-1]), np.zeros((2, first[-1], len(x)))
    counts = np.zeros((len(trees) + 1, first[-1]))
    for i, (j, tree) in enumerate(trees.items()):
        size[at[j]] += tree.size
        counts[i, at[j]] = 1
    every, number = _together(list(trees.values()))
    weight = counts[number] * every.n[:, None]
    todo = [(0, len(x), np.array([len(every.n) - 1]))]
    while todo:
        lo, hi, nodes = todo.pop()
        y = x[lo:hi]
        low, high = y.min(axis=0), y.max(axis=0)
        mid = (low + high) / 2
        taken, error, left = every.expand(low, high, tolerance, nodes)
        if len(taken):
            sums[0, :, lo:hi] += (_monomials(y - mid) @ every.cubic(taken, mid, weight[taken])).T
            sums[1, :, lo:hi] += (error @ weight[taken])[:, None]
        if hi - lo > GROUP:
            half = (lo + hi) // 2
            todo += [(lo, half, left), (half, hi, left)]
        else:
            for v, more in zip(sums, every.sums(y, tolerance, weight, left), strict=True):
                v[:, lo:hi] += more.T
    own = [np.searchsorted(c, v) for c, v in zip(clusters, labels, strict=True)]
    return [_silhouettes(sums[:, lo:hi], size[lo:hi], o) for lo, hi, o in zip(first, first[1:], own, strict=False)]


def _silhouettes(sums: np.ndarray, size: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(silhouette, least, greatest) of each point from the sums of its distances to each
    cluster, and their errors."""
    at = np.arange(len(own))
    rest = np.maximum(size[own] - 1, 1)
    a, ea = sums[0, own, at] / rest, sums[1, own, at] / rest
    mean, err = sums[0] / size[:, None], sums[1] / size[:, None]
    mean[own, at] = np.inf
    b = mean.min(axis=0)
    b_low, b_high = (mean - err).min(axis=0), (mean + err).min(axis=0)
    alone = (size[own] <= 1) | (len(size) < 2)

    def score(inner, outer):
        inner, outer = np.maximum(inner, 0), np.maximum(outer, 0)
        most = np.maximum(inner, outer)
        with np.errstate(divide="ignore", invalid="ignore"):
            s = np.where(most > 0, (outer - inner) / most, 0)
        return np.where(alone, 0, s)

    return score(a, b), score(a + ea, b_low), score(a - ea, b_high)


def _scored(forest, low: np.ndarray, step: np.ndarray, labellings: Sequence[str], d: int, tolerance: float):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= AT_ONCE:
                yield pa.Table.from_batches(held)
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = {part: {j: Tree(*parts) for j, parts in of.items()} for part, of in forest.value.items()}
        for rows in chunks(batches):
            x = np.stack([rows.column(f"x{a}").to_numpy() for a in range(d)], axis=1)
            order = _interleaved(x, low, step)
            x = x[order]
            for part, of in trees.items():
                nulls = [rows.column(f"l{t}").is_null().to_numpy()[order] for t in part]
                known = np.flatnonzero(~np.all(nulls, axis=0))
                if not len(known):
                    continue
                labels = [rows.column(f"l{t}").fill_null(-1).to_numpy()[order][known] for t in part]
                for t, null, (s, least, most) in zip(part, nulls, point_scores(x[known], labels, of, tolerance), strict=True):
                    has = ~null[known]
                    yield pa.record_batch([pa.array([labellings[t]]), pa.array([int(has.sum())], pa.int64()), *[pa.array([float(v[has].sum())]) for v in (s, least, most)]], names=["t", "n", "s", "least", "most"])

    return run


def euclidean_silhouettes(
    df: DataFrame, label_cols: Sequence[str], features: Sequence[str], cells: int = 16384, tolerance: float = 1e-4
) -> DataFrame:
    """(labelling, points, silhouette, error_bound): the mean silhouette with Euclidean
    distance of each column of cluster labels, and how far it can be from the exact one.

    Rows with a null feature take no part, nor do those with a null label in its
    labelling; a cluster of one row, or a single cluster, scores 0. Leaves hold at
    most about 1 / ``cells`` of the rows, unless they are of the finest level.
    """
    spark, d = df.sparkSession, len(features)
    x, lab = [f"x{a}" for a in range(d)], [f"l{t}" for t in range(len(label_cols))]
    rows = df.select(
        *[F.col(c).cast("double").alias(n) for c, n in zip(features, x, strict=True)],
        *[F.col(c).cast("int").alias(n) for c, n in zip(label_cols, lab, strict=True)],
    ).where(" AND ".join(f"{c} IS NOT NULL" for c in x))
    # a row counts once for all labellings, in the tree of its labels, unless these are too many
    parts = [tuple(range(len(lab)))]
    if rows.select(*lab).distinct().limit(JOINT + 1).count() > JOINT:
        parts = [(t,) for t in parts[0]]
    names = [F.concat_ws(",", F.lit(p), *[F.coalesce(F.col(lab[t]).cast("string"), F.lit("-")) for t in part]) for p, part in enumerate(parts)]
    some = [F.coalesce(*[F.col(lab[t]) for t in part]).isNotNull() for part in parts]
    labelled = F.array(*[F.struct(F.when(s, n).alias("t"), F.lit(0).alias("c")) for s, n in zip(some, names, strict=True)])
    long = rows.select(*x, F.inline(labelled)).where("t IS NOT NULL")
    sizes = long.groupBy("t", "c").agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in x]).collect()
    kinds = "labelling string, points long, silhouette double, error_bound double"
    if not sizes:
        return spark.createDataFrame([], kinds)
    total = [0] * len(lab)
    joint: dict[str, tuple[tuple, tuple]] = {}  # (labellings, the labels in them)
    for r in sizes:
        p, *own = r["t"].split(",")
        joint[r["t"]] = parts[int(p)], tuple(None if v == "-" else int(v) for v in own)
        for t, v in zip(*joint[r["t"]], strict=True):
            total[t] += r["n"] if v is not None else 0
    low = np.array([min(r[f"min_{c}"] for r in sizes) for c in x])
    width = np.array([max(r[f"max_{c}"] for r in sizes) for c in x]) - low
    step = np.full(d, max(float(width.max()), 1e-300) / (1 << LEVELS))  # cubes
    most = {(j, 0): max(1, min(total[t] for t, v in zip(*of, strict=True) if v is not None) // cells) for j, of in joint.items()}

    index_of = [F.least(F.floor((F.col(c) - F.lit(float(o))) / F.lit(float(s))), F.lit((1 << LEVELS) - 1)).cast("long") for c, o, s in zip(x, low, step, strict=True)]
    index = [i.alias(f"i{a}") for a, i in enumerate(index_of)]
    moved = [(F.col(c) - F.lit(float(o))).alias(c) for c, o in zip(x, low, strict=True)]  # moments about a corner of the data
    placed = long.select("t", "c", *index, *moved)
    finest = placed.groupBy("t", "c", *[f"i{a}" for a in range(d)]).agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(f"s{a}") for a, c in enumerate(x)],
        *[F.sum(F.col(p) * F.col(q)).alias(f"q{a}{b}") for a, p in enumerate(x) for b, q in enumerate(x)],
        *[F.min(c).alias(f"lo{a}") for a, c in enumerate(x)],
        *[F.max(c).alias(f"hi{a}") for a, c in enumerate(x)],
    )
    coarse = [F.shiftright(f"i{a}", SUB).alias(f"g{a}") for a in range(d)]
    width_of_row = 1 + d + 1 + d + d * d + 2 * d
    schema = "t string, c int, " + ", ".join(f"c{i} double" for i in range(width_of_row))
    leaves = finest.groupBy("t", "c", *coarse).applyInArrow(_leaves(most, d), schema).toArrow()

    forest: dict[tuple, dict[tuple, tuple]] = {part: {} for part in parts}
    t = np.array(leaves.column("t").to_pylist())
    values = np.stack([leaves.column(f"c{i}").to_numpy() for i in range(width_of_row)], axis=1)
    for j, (part, own) in joint.items():
        level, cell, n, s, q, lo, hi = np.split(values[t == j], np.cumsum([1, d, 1, d, d * d, d]), axis=1)
        tree = plant(level[:, 0].astype(np.int64), cell.astype(np.int64), n[:, 0], s, q, lo, hi)
        tree.mean += low
        forest[part][own] = tuple(vars(tree).values())  # plain arrays: a broadcast knows no classes of ours
    # neighbours meet in a task, and copies of one point are split by their order
    bits = min(LEVELS, 63 // d)
    code = [F.shiftleft(F.shiftright(f"i{a}", LEVELS - 1 - b).bitwiseAND(F.lit(1).cast("long")), (bits - 1 - b) * d + a) for b in range(bits) for a in range(d)]
    tasks = max(1, math.ceil(max(total) / TASK))
    near = rows.select("*", *index).withColumn("code", reduce(Column.bitwiseOR, code)).drop(*[f"i{a}" for a in range(d)])
    near = near.repartitionByRange(tasks, "code", F.monotonically_increasing_id()).drop("code")
    sent = spark.sparkContext.broadcast(forest)  # bounded by ``cells``, not by the rows
    parts = near.mapInArrow(_scored(sent, low, step, list(label_cols), d, tolerance), "t string, n long, s double, least double, most double")
    means = parts.groupBy(F.col("t").alias("labelling")).agg(F.sum("n").alias("points"), *[(F.sum(v) / F.sum("n")).alias(v) for v in ("s", "least", "most")])
    return means.select("labelling", "points", F.col("s").alias("silhouette"), F.greatest(F.col("most") - F.col("s"), F.col("s") - F.col("least")).alias("error_bound"))


# The tasks get this module's code along with their functions, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
