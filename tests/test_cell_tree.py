"""The Euclidean silhouette from cells against all pairs, and its proven bound."""

import numpy as np
import pytest

from cohortlens.operators import cell_tree
from cohortlens.operators.cell_tree import euclidean_silhouettes
from cohortlens.operators.cluster import assign_nearest, silhouette_euclidean

FEATS = ["R", "F", "M"]
CENTRES = np.array([[1, -1, -1], [-1, 1, 1], [0, 0, 0.0]])


def all_pairs(x, label):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, own in enumerate(label):
        mine = label == own
        means = [d[i, label == c].mean() for c in set(label) - {own}]
        if mine.sum() == 1 or not means:
            out.append(0.0)
            continue
        a, b = d[i, mine].sum() / (mine.sum() - 1), min(means)
        out.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(out))


def frame(spark, x, *labels):
    names = ", ".join(f"l{i} int" for i in range(len(labels)))
    rows = [(*map(float, p), *(None if v is None else int(v) for v in ls)) for p, *ls in zip(x, *labels, strict=True)]
    return spark.createDataFrame(rows, f"R double, F double, M double, {names}").repartition(3)


def shop(rng, n):
    """Points as RFM has them: a lattice in two features, copies, and a long tail."""
    x = np.column_stack([np.round(rng.normal(size=n), 1), np.log1p(rng.geometric(0.4, n)), rng.lognormal(size=n)])
    x[: n // 3] = x[0]  # one point holds a third
    return x


@pytest.mark.parametrize("cells", [16384, 64, 1])
def test_within_the_bound_of_all_pairs(spark, cells):
    rng = np.random.default_rng(5)
    x = shop(rng, 1200)
    near = ((x[:, None] - CENTRES) ** 2).sum(axis=2).argmin(axis=1)
    near[0] = 9  # a cluster of one
    some = rng.integers(0, 4, len(x))
    got = {r.labelling: r for r in euclidean_silhouettes(frame(spark, x, near, some), ["l0", "l1"], FEATS, cells).collect()}
    for name, label in (("l0", near), ("l1", some)):
        error = abs(got[name].silhouette - all_pairs(x, label))
        assert got[name].points == len(x) and error <= got[name].error_bound + 1e-9
        assert error < (1e-6 if cells == 16384 else 2e-3) and got[name].error_bound < (1e-4 if cells == 16384 else 0.05)


def test_edge_cases(spark):
    one = frame(spark, np.zeros((5, 3)), [0] * 5)
    assert euclidean_silhouettes(one, ["l0"], FEATS).first().silhouette == 0
    same = frame(spark, np.ones((6, 3)), [0, 0, 0, 1, 1, 1])
    assert tuple(euclidean_silhouettes(same, ["l0"], FEATS).first())[1:] == (6, 0.0, 0.0)
    assert euclidean_silhouettes(one.limit(0), ["l0"], FEATS).collect() == []
    x = np.array([[0, 0, 0], [0, 0, 1.0], [5, 0, 0], [5, 0, 1.0], [9, 9, 9.0]])
    df = frame(spark, x, [0, 0, 1, 1, None])
    gap = spark.createDataFrame([(None, 1.0, 1.0, 0)], df.schema)
    got = euclidean_silhouettes(df.unionAll(gap), ["l0"], FEATS).first()
    assert got.points == 4 and got.silhouette == pytest.approx(all_pairs(x[:4], np.array([0, 0, 1, 1])))


def test_cost_per_point_hardly_grows(monkeypatch):
    """Nodes that a group of points meets: four times the points, about the same number."""
    rng = np.random.default_rng(6)
    met = []
    for n in (4000, 16000, 64000):
        x = rng.normal(size=(n, 3))
        low, step = x.min(axis=0), np.full(3, np.ptp(x, axis=0).max() / 1024)
        cell = np.minimum((x - low) // step, 1023).astype(np.int64)
        square = (x[:, :, None] * x[:, None, :]).reshape(n, 9)
        limit = max(1, n // 4096)
        names = ["n", *[f"s{a}" for a in range(3)], *[f"q{a}{b}" for a in range(3) for b in range(3)]]
        columns = {f"i{a}": cell[:, a] for a in range(3)} | dict(zip(names, np.column_stack([np.ones(n), x, square]).T, strict=True))
        columns |= {f"{c}{a}": x[:, a] for c in ("lo", "hi") for a in range(3)}
        key = [cell_tree.pa.scalar("t"), cell_tree.pa.scalar(0)]
        leaves = cell_tree._leaves({("t", 0): limit}, 3)(key, cell_tree.pa.table(columns))
        v = np.stack([leaves.column(f"c{i}").to_numpy() for i in range(23)], axis=1)
        level, c, k, s, q, lo, hi = np.split(v, np.cumsum([1, 3, 1, 3, 9, 3]), axis=1)
        tree = cell_tree.plant(level[:, 0].astype(int), c.astype(int), k[:, 0], s, q, lo, hi)
        assert tree.size == n and len(leaves) < 40000
        x = x[cell_tree._interleaved(x, low, step)]
        groups = [x[i : i + 64] for i in range(0, n, n // 20)]
        met.append(np.mean([len(np.concatenate(tree.take(g.min(axis=0), g.max(axis=0), 1e-4))) for g in groups]))
    assert met[2] < 2 * met[1] and met[2] < 64000 / 4


def test_labellings_share_the_distances(monkeypatch):
    """Seven labellings with the same borders meet as many nodes as one."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 3))
    label = (x[:, 0] > 0).astype(int)
    trees = []
    for c in (0, 1):
        y = x[label == c]
        square = (y[:, :, None] * y[:, None, :]).reshape(len(y), 9)
        trees.append(cell_tree.plant(np.full(len(y), cell_tree.LEVELS), np.floor((y + 8) * 64).astype(int), np.ones(len(y)), y, square, y, y))
    met, take = [], cell_tree.Tree.take

    def counted(self, *box):
        out = take(self, *box)
        met.append(len(out[0]) + len(out[1]))
        return out

    monkeypatch.setattr(cell_tree.Tree, "take", counted)
    seen = []
    for many in (1, 7):
        met.clear()
        scores = cell_tree.point_scores(x, [label] * many, {(c,) * many: t for c, t in enumerate(trees)}, 1e-4)
        seen.append(sum(met))
        assert len(scores) == many and all(abs(s.mean() - all_pairs(x, label)) < 1e-4 for s, _, _ in scores)
    assert seen[0] == seen[1]


def test_far_nodes_are_met_by_groups_not_by_points(monkeypatch):
    """Points score within their proven limits, and their small groups meet few of the nodes in reach."""
    rng = np.random.default_rng(9)
    y = rng.normal(size=(20000, 3))
    cluster = (y[:, 0] + y[:, 1] > 0).astype(int)
    low, step = y.min(axis=0), np.full(3, np.ptp(y, axis=0).max() / 64)
    trees = {}
    for c in (0, 1):
        z = y[cluster == c]
        cell, at = np.unique(((z - low) // step).astype(np.int64), axis=0, return_inverse=True)
        order = np.argsort(at.reshape(-1), kind="stable")
        starts = np.flatnonzero(np.diff(at.reshape(-1)[order], prepend=-1))
        z, square = z[order], (z[:, :, None] * z[:, None, :]).reshape(len(z), 9)[order]
        sums = [np.add.reduceat(v, starts, axis=0) for v in (np.ones(len(z)), z, square)]
        trees[(c,)] = cell_tree.plant(np.full(len(cell), 6), cell, *sums, np.minimum.reduceat(z, starts), np.maximum.reduceat(z, starts))
    x = rng.uniform(-0.1, 0.1, size=(512, 3))
    x = x[cell_tree._interleaved(x, low, step)]
    own = (x[:, 0] + x[:, 1] > 0).astype(int)
    met, take = [], cell_tree.Tree.take

    def counted(self, *box):
        out = take(self, *box)
        met.append(len(out[0]) + len(out[1]))
        return out

    monkeypatch.setattr(cell_tree.Tree, "take", counted)
    ((score, least, most),) = cell_tree.point_scores(x, [own], trees, 1e-4)
    seen = sum(met)
    met.clear()
    for lo in range(0, len(x), cell_tree.GROUP):
        part = x[lo : lo + cell_tree.GROUP]
        for tree in trees.values():
            tree.take(part.min(axis=0), part.max(axis=0), 1e-4)
    assert seen < sum(met) / 2
    d = np.sqrt(((x[:, None] - y) ** 2).sum(axis=2))
    sums = np.stack([d[:, cluster == c].sum(axis=1) for c in (0, 1)])
    n, at = np.bincount(cluster), np.arange(len(x))
    a, b = sums[own, at] / (n[own] - 1), sums[1 - own, at] / n[1 - own]
    exact = (b - a) / np.maximum(a, b)
    assert (least - 1e-12 <= exact).all() and (exact <= most + 1e-12).all() and abs((score - exact).mean()) < 1e-5


def test_wrapper_and_any_number_of_features(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 2))
    df = spark.createDataFrame([tuple(map(float, p)) for p in x], "a double, b double")
    labelled = assign_nearest(df, [(1, 1), (-1, -1)], ["a", "b"])
    label = ((x[:, None] - np.array([[1, 1], [-1, -1]])) ** 2).sum(axis=2).argmin(axis=1)
    got = silhouette_euclidean(labelled, ["a", "b"]).first()
    assert got.silhouette == pytest.approx(all_pairs(x, label), abs=1e-6) and got.error_bound < 1e-4
