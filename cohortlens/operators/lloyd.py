"""Many KMeans fits over one table, all of them advanced by each pass (ML-1, ML-2).

Every restart of every k is a fit. A pass over the features assigns each row to
its nearest centre in all fits at once; a task returns one row of sums for each
centre, and the driver moves the centres. A fit ends by the reference's rule
(squared shifts of its centres in all at most tol x mean variance), so the
number of passes is that of the slowest fit, not the sum over all. Only centres
and their sums, bounded by the parameters, reach the driver.

Centres start by k-means++ and the same rule on a sample of at most ``SAMPLE``
rows, the first by a hash of the whole row, so that partitioning does not change
them; that saves most of the passes, which read every row.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 8192
# Distances of rows to centres that are held at once.
AT_ONCE = 1 << 16


@dataclass
class Fit:
    """Centres of one fit, their cost, and the passes that moved them."""

    centres: np.ndarray
    cost: float = float("inf")
    passes: int = 0


def plus_plus(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k starting centres among the rows of x, far ones more likely; the best of a few draws each."""
    centres = [x[rng.integers(len(x))]]
    near = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        p = near / near.sum() if near.sum() > 0 else None
        drawn = x[rng.choice(len(x), size=2 + int(np.log(k)), p=p)]
        after = np.minimum(near, ((x[None] - drawn[:, None]) ** 2).sum(axis=2))
        best = int(after.sum(axis=1).argmin())
        centres.append(drawn[best])
        near = after[best]
    return np.stack(centres)


def start(x: np.ndarray, k: int, seed: int, least: float, max_iter: int) -> np.ndarray:
    """Centres of the sample: from k-means++ until they shift by ``least`` at most."""
    c = plus_plus(x, k, np.random.default_rng((seed, k)))
    for _ in range(max_iter):
        own = ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)
        n = np.bincount(own, minlength=k)[:, None]
        added = np.stack([np.bincount(own, weights=w, minlength=k) for w in x.T], axis=1)
        c, before = np.where(n > 0, added / np.maximum(n, 1), c), c
        if ((c - before) ** 2).sum() <= least:
            break
    return c


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a centre is the nearest (fits, k, rows), the least squared distance less the row's
    square (fits, rows)) of the columns of x in each fit of ``centres`` (fits, k, d); ties go to the lower number."""
    fits, k, d = centres.shape
    c = centres.reshape(-1, d)
    far = ((c * c).sum(axis=1)[:, None] - 2 * (c @ x)).reshape(fits, k, -1)
    least = far.min(axis=1)
    hot = far == least[:, None]
    if np.count_nonzero(hot) > least.size:
        hot &= np.cumsum(hot, axis=1) == 1
    return hot, least


def _sums(centres: dict[int, np.ndarray], d: int, costs: bool):
    """Rows (fit, centre, n, sums, cost) of a task's rows."""
    by_k: dict[int, list[int]] = {}
    for f, c in centres.items():
        by_k.setdefault(len(c), []).append(f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {f: np.zeros((len(c), d + 2)) for f, c in centres.items()}
        for batch in batches:
            every = np.stack([np.ones(batch.num_rows), *[c.to_numpy(zero_copy_only=False) for c in batch.columns]])
            for k, fits in by_k.items():
                c = np.stack([centres[f] for f in fits])
                step = max(1, AT_ONCE // (len(fits) * k))
                for lo in range(0, batch.num_rows, step):
                    x = every[:, lo : lo + step]
                    hot, least = nearest(x[1:], c)
                    added = (hot.reshape(len(fits) * k, -1).astype(float) @ x.T).reshape(len(fits), k, -1)
                    for f, v in zip(fits, added, strict=True):
                        out[f][:, :-1] += v
                    if costs:
                        cost = np.maximum(least + (x[1:] * x[1:]).sum(axis=0), 0)
                        for f, h, v in zip(fits, hot, cost, strict=True):
                            out[f][:, -1] += h @ v
        rows = np.concatenate([np.column_stack([np.full(len(s), f), np.arange(len(s)), s]) for f, s in out.items()])
        yield pa.record_batch([pa.array(rows[:, i].astype(np.int32)) for i in (0, 1)] + [pa.array(rows[:, i]) for i in range(2, rows.shape[1])], names=names)

    names = ["fit", "centre", "n", *[f"s{a}" for a in range(d)], "cost"]
    return run, ", ".join(f"{n} {'int' if i < 2 else 'double'}" for i, n in enumerate(names))


def _pass(table: DataFrame, centres: dict[int, np.ndarray], costs: bool = False) -> dict[int, np.ndarray]:
    """(n, sums, cost) of each centre of each fit; the cost is 0 unless ``costs``."""
    d = len(table.columns)
    run, schema = _sums(centres, d, costs)
    part = table.mapInArrow(run, schema)
    merged = part.groupBy("fit", "centre").agg(*[F.sum(c).alias(c) for c in part.columns[2:]]).collect()
    out = {f: np.zeros((len(c), d + 2)) for f, c in centres.items()}
    for r in merged:
        out[r["fit"]][r["centre"]] = r[2:]
    return out


def fit_all(
    rows: DataFrame, table: DataFrame, wanted: Sequence[tuple[int, int]], mean_var: float, tol: float, max_iter: int
) -> list[Fit]:
    """One fit for each (k, seed) of ``wanted``. ``table`` holds the features only (doubles,
    no nulls), ``rows`` the same rows with the columns that tell them apart."""
    features = table.columns
    # by the hash, few more than wanted reach the sort, whatever the number of rows and tasks
    hashed, share = F.xxhash64(*rows.columns), min(1.0, 4 * SAMPLE / max(table.count(), 1))
    likely = rows.dropna(subset=features).where(F.pmod(hashed, F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    first = likely.orderBy(hashed, *features).limit(SAMPLE)
    x = first.select(*[F.col(c).cast("double") for c in features]).toPandas().to_numpy(dtype=float)
    if not len(x):
        raise ValueError("KMeans needs at least one row without null features")
    fits = [Fit(start(x, k, seed, tol * mean_var, max_iter)) for k, seed in wanted]
    going = set(range(len(fits)))
    while going:
        sums = _pass(table, {i: fits[i].centres for i in sorted(going)})
        for i, s in sums.items():
            fit, n = fits[i], s[:, :1]
            # a centre that no row is nearest to stays where it is
            moved = np.where(n > 0, s[:, 1:-1] / np.maximum(n, 1), fit.centres)
            shift = float(((moved - fit.centres) ** 2).sum())
            fit.centres, fit.passes = moved, fit.passes + 1
            if shift <= tol * mean_var or fit.passes >= max_iter:
                going.discard(i)
    for i, s in _pass(table, {i: f.centres for i, f in enumerate(fits)}, costs=True).items():
        fits[i].cost = float(s[:, -1].sum())
    return fits


# The tasks get this module's code along with their functions, so that it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
