"""Hard negatives against brute force, and what the index leaves out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import multi_index
from cohortlens.llm.multi_index import Index, codebook, mine, nearest

SCHEMA = "vec_id long, embedding array<double>, label int, score string, block int, key string"


def brute(rows, is_anchor, scale=256, positives=5, negatives=10):
    sound = [(i, [math.floor(scale * c) for c in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for n, (a, v, y) in enumerate(sound):
        if not is_anchor(a):
            continue
        met = [(-sum(c * d for c, d in zip(v, w, strict=True)), i, m, z) for m, (i, w, z) in enumerate(sound) if m != n and len(w) == len(v)]
        best = sorted(x for x in met if x[3] == y)[:positives]
        others = sorted(x for x in met if x[3] != y)
        for p, pid, _, _ in best:
            inside = [x for x in others if 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            out += [(a, pid, r, x[1], -p, -x[0]) for r, x in enumerate(inside, 1)]
    return sorted(out)


def frame(llm, rows):
    return llm.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


def odd_rows(rng, n=300, dim=7):
    x = rng.normal(size=(n, dim)) * rng.uniform(0.3, 2, (n, 1))
    x[60:140] = x[60]  # a common vector
    rows = [(i, v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(x)]
    rows += [(1000, None, 1), (1010, [math.nan] * dim, 1), (1020, [0.0] * dim, 1), (1030, [None, *[1.0] * (dim - 1)], 2), (None, x[0].tolist(), 0), (1040, [], 1), (1050, [], 2), (1060, [math.inf] * dim, 0), (1070, x[3].tolist(), None)]
    rows += [(10, (-x[10]).tolist(), 0), (10, x[10].tolist(), 0), (20, x[20].tolist(), rows[20][2])]  # shared ids
    rows += [(1080, x[5, :3].tolist(), 1), (1090, x[6, :3].tolist(), 1), (1091, (x[6, :3] * 0.8).tolist(), 2), (1100, [2.0], 1), (1101, [1.5], 2), (1102, [3.0], 1)]
    return rows


@pytest.mark.parametrize("codes,first", [(4, 40), (1, 10**9), (16, 1)])
def test_equals_brute_force(llm, codes, first):
    rows = odd_rows(np.random.default_rng(1))
    got = mine(frame(llm, rows), F.col("vec_id") % 10 == 0, codes=codes, block_rows=32, chunk=5, first_rows=first)
    want = brute(rows, lambda i: i % 10 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 300


def test_large_components_are_exact(llm):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(80, 4)) * 100) * 2.0**14
    x[30:50] = x[30] + rng.integers(0, 2, (20, 4))  # products that differ in few of many bits
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    got = sorted(map(tuple, mine(frame(llm, rows), F.col("vec_id") % 5 == 0, codes=4, block_rows=16, first_rows=20).collect()))
    assert got == brute(rows, lambda i: i % 5 == 0) and max(r[4] for r in got) > 2**53
    with pytest.raises(Exception, match="does not fit a long"):
        mine(frame(llm, [(i, [2.0**40, 1.0], i % 2) for i in range(4)]), F.col("vec_id") == 0).collect()


def test_no_rows_and_no_anchors(llm):
    assert mine(frame(llm, []), F.col("vec_id") % 10 == 0).collect() == []
    assert mine(frame(llm, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 1)]), F.col("vec_id") % 10 == 0).collect() == []
    assert mine(frame(llm, [(0, [1.0, 2.0], 0)]), F.col("vec_id") % 10 == 0).collect() == []


def numpy_index(x, codes):
    index = Index(*[codebook(h[:2048], codes) for h in Index.halves(x)])
    codes_, far = zip(*[nearest(h, c) for h, c in zip(Index.halves(x), (index.first, index.second), strict=True)], strict=True)
    np.add.at(index.count, codes_, 1)
    for h in (0, 1):
        np.maximum.at(index.radius[h], codes_, far[h])
    return index, codes_


def clustered(spread, n=6000, dim=32, clusters=60):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(clusters, dim))
    x = centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dim))
    return np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True))


def visited(x, codes=16, k=5, first=500):
    """The share of all rows that the search for an anchor's k best rows visits."""
    index, _ = numpy_index(x, codes)
    seen = 0
    for q in x[::100]:
        kth = np.sort(x @ q)[-k - 1]
        early, late = index.walk(q, first, float(kth))
        seen += sum(int(index.count[c]) for c in early + late)
    return seen / (len(x) * len(x[::100]))


def test_certified_windows_leave_out_cells():
    assert visited(clustered(0.05)) < 0.2
    assert visited(clustered(0.2)) < 0.45


def test_cells_come_by_falling_bounds_and_hold_every_row():
    x = clustered(0.3, n=1500)
    index, codes = numpy_index(x, 8)
    for q in x[::150]:
        early, late = index.walk(q, 0, -np.inf)
        assert not early and sorted(late) == sorted(set(zip(*codes, strict=True)))
        s = x @ q
        for low, high in ((np.sort(s)[-20], np.inf), (0, np.sort(s)[-300])):
            cells = set(sum(index.walk(q, 100, low, low, high), []))
            assert all((codes[0][r], codes[1][r]) in cells for r in np.flatnonzero((s >= low) & (s <= high)))
