import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler

from cohortlens.config import ClusterConfig
from cohortlens.operators.cluster import (
    assign_nearest,
    attach_clusters,
    cluster_sizes,
    fit_kmeans,
    inertia,
    kmeans_clusters,
    kmeans_sweep,
    segment_names,
    segment_revenue_share,
    silhouette,
    stable_order,
)

FEATS = ("R_scaled", "F_scaled", "M_scaled")


def _blobs(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    centres = np.array([[5.0, 0.0, 0.0], [0.0, 5.0, 0.0], [0.0, 0.0, 5.0]])
    rows = []
    for b, c in enumerate(centres):
        pts = rng.normal(c, 0.3, size=(n, 3))
        rows += [(f"{b}-{i}", b, *map(float, p)) for i, p in enumerate(pts)]
    return spark.createDataFrame(rows, "CustomerID string, blob int, R_scaled double, F_scaled double, M_scaled double")


def _np_silhouette_sq(x, labels):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    out = []
    for i, li in enumerate(labels):
        own = labels == li
        n_own = own.sum()
        if n_own == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (n_own - 1)
        b = min(d[i, labels == lj].mean() for lj in set(labels) if lj != li)
        out.append(0.0 if a == b else (1 - a / b if a < b else b / a - 1))
    return float(np.mean(out))


def test_assign_nearest_ties_go_to_lower_id(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0)], "R_scaled double, F_scaled double, M_scaled double")
    out = assign_nearest(df, [(1, 0, 0), (-1, 0, 0)], FEATS, "c", "d").first()
    assert (out.c, out.d) == (0, 1.0)


def test_inertia_fixed_centres(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0), (0.0, 2.0, 0.0)], "R_scaled double, F_scaled double, M_scaled double")
    assert inertia(df, [(0, 0, 0)]).first().inertia == 5.0


def test_silhouette_matches_numpy_and_spark(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(300, 3))
    labels = np.array([0] * 120 + [1] * 100 + [2] * 79 + [3])  # one singleton
    x[:120] += 3
    df = spark.createDataFrame(
        [(int(lab), *map(float, p)) for lab, p in zip(labels, x)],
        "Cluster int, R_scaled double, F_scaled double, M_scaled double",
    )
    ours = silhouette(df).first()[0]
    assert ours == pytest.approx(_np_silhouette_sq(x, labels), abs=1e-9)
    vec = VectorAssembler(inputCols=list(FEATS), outputCol="features").transform(df)
    ev = ClusteringEvaluator(predictionCol="Cluster", featuresCol="features")
    assert ours == pytest.approx(ev.evaluate(vec), abs=1e-9)


def test_kmeans_recovers_blobs_and_labels_are_stable(spark):
    df = _blobs(spark)
    cfg = ClusterConfig(n_init=2, max_iter=50)
    a = kmeans_clusters(df.repartition(1), cfg)
    b = kmeans_clusters(df.repartition(8), cfg)
    pa = {r.CustomerID: r.Cluster for r in a.select("CustomerID", "Cluster").collect()}
    pb = {r.CustomerID: r.Cluster for r in b.select("CustomerID", "Cluster").collect()}
    assert pa == pb
    # each blob maps to exactly one cluster
    mapping = a.groupBy("blob").agg({"Cluster": "collect_set"}).collect()
    assert all(len(r[1]) == 1 for r in mapping)
    assert sorted(r.Customers for r in cluster_sizes(a).collect()) == [400, 400, 400]


def test_sweep_inertia_falls_with_k(spark):
    df = _blobs(spark, n=60)
    cfg = ClusterConfig(k_min=2, k_max=4, n_init=2, max_iter=50)
    sweep = kmeans_sweep(df, cfg).orderBy("k").collect()
    assert [r.k for r in sweep] == [2, 3, 4]
    assert sweep[0].inertia > sweep[1].inertia >= sweep[2].inertia * 0.999
    assert max(sweep, key=lambda r: r.silhouette_sq_euclidean).k == 3


def test_fit_returns_stably_ordered_centres(spark):
    centres, cost = fit_kmeans(_blobs(spark, n=50), 3, ClusterConfig(n_init=1))
    assert centres == stable_order(centres)
    assert centres[0][2] > 4  # highest Monetary first
    assert cost > 0


def test_segments_and_revenue_share(spark):
    meds = spark.createDataFrame([(0, 10.0), (1, 500.0), (2, 90.0)], "Cluster int, Monetary_median double")
    names = {r.Cluster: r.segment for r in segment_names(meds).collect()}
    assert names == {1: "Champions", 2: "Potential Loyalists", 0: "Hibernating"}
    df = spark.createDataFrame([(0, 10.0), (1, 60.0), (1, 30.0)], "Cluster int, Monetary double")
    share = {r.Cluster: r.revenue_share for r in segment_revenue_share(df).collect()}
    assert share == {0: 0.1, 1: 0.9}


def test_attach_clusters_inner(spark):
    rfm = spark.createDataFrame([("a", 1), ("b", 2)], "CustomerID string, Recency int")
    cl = spark.createDataFrame([("a", 0)], "CustomerID string, Cluster int")
    assert [tuple(r) for r in attach_clusters(rfm, cl).collect()] == [("a", 1, 0)]


def test_fits_advance_together_and_stop_by_the_references_rule(spark, monkeypatch):
    """All fits of a sweep, in one place with numpy, from the same starting centres."""
    from cohortlens.operators import lloyd

    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(700, 3)) + rng.integers(0, 4, (700, 1)) * 2.0, 3)
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double, c double").repartition(5)
    table, wanted, var, tol = df.select("a", "b", "c"), [(k, s) for k in (2, 3, 5) for s in (1, 2)], float(x.var(axis=0).mean()), 1e-4
    monkeypatch.setattr(lloyd, "SAMPLE", 150)
    got = lloyd.fit_all(df, table, wanted, var, tol, 300)
    hashed = lloyd.F.xxhash64(*df.columns)
    likely = df.where(lloyd.F.pmod(hashed, lloyd.F.lit(1 << 40)) < lloyd.F.lit(int(600 / 700 * (1 << 40))))
    first = np.array(likely.orderBy(hashed, "a", "b", "c").select("a", "b", "c").limit(150).collect())
    assert max(f.passes for f in got) > 1
    for fit, (k, seed) in zip(got, wanted, strict=True):
        c, passes = lloyd.start(first, k, seed, tol * var, 300), 0
        while True:
            own = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
            moved = np.stack([x[own == i].mean(axis=0) for i in range(k)])
            shift, c, passes = ((moved - c) ** 2).sum(), moved, passes + 1
            if shift <= tol * var:
                break
        assert fit.passes == passes and np.allclose(fit.centres, c)
        assert fit.cost == pytest.approx(((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum())
    assert lloyd.fit_all(df, table, [(3, 1)], var, 0.0, 1)[0].passes == 1  # max_iter
    with pytest.raises(ValueError, match="at least one row"):
        lloyd.fit_all(df.limit(0), table.limit(0), [(2, 1)], var, tol, 5)


def test_nearest_centre_of_many_fits_and_ties():
    from cohortlens.operators import lloyd

    rng = np.random.default_rng(10)
    x = rng.integers(-2, 3, (50, 3)).astype(float)
    centres = rng.integers(-2, 3, (4, 5, 3)).astype(float)
    centres[1, 3] = centres[1, 0]
    hot, least = lloyd.nearest(x.T, centres)
    d = ((x[:, None, None] - centres) ** 2).sum(axis=3)
    assert (hot.sum(axis=1) == 1).all() and (hot.argmax(axis=1).T == d.argmin(axis=2)).all()
    assert np.allclose(least.T + (x * x).sum(axis=1)[:, None], d.min(axis=2))


def test_fit_reads_every_row_not_its_sample(spark, monkeypatch):
    from cohortlens.operators import lloyd

    monkeypatch.setattr(lloyd, "SAMPLE", 10)
    centres, cost = fit_kmeans(_blobs(spark), 3, ClusterConfig(n_init=4))
    assert all(max(c) == pytest.approx(5, abs=0.1) for c in centres) and cost == pytest.approx(1200 * 3 * 0.09, rel=0.1)


def test_facts_turn_red_on_a_broken_fit(spark):
    from cohortlens.operators.cluster import assign_nearest, fit_facts, sweep_facts

    pts = [(0.0, 0.0, 0.0), (0.2, 0.0, 0.0), (4.0, 4.0, 4.0), (4.0, 4.2, 4.0)]
    df = spark.createDataFrame(pts, "R_scaled double, F_scaled double, M_scaled double")
    good = [(0.1, 0.0, 0.0), (4.0, 4.1, 4.0)]
    got = fit_facts(assign_nearest(df, good), good).first()
    assert tuple(got) == (2, 4, True)
    moved = [(0.1, 0.0, 0.0), (4.0, 5.0, 4.0)]
    assert not fit_facts(assign_nearest(df, moved), moved).first().centres_are_means
    unused = [*good, (90.0, 90.0, 90.0)]
    assert fit_facts(assign_nearest(df, unused), unused).first().clusters == 2
    schema = "k int, inertia double, silhouette_sq_euclidean double, silhouette double"
    falling = spark.createDataFrame([(2, 9.0, 0.5, 0.4), (3, 4.0, 0.6, 0.5), (4, 4.0, -1.0, 1.0)], schema)
    assert tuple(sweep_facts(falling).first()) == (3, 2, 4, True, True)
    rising = spark.createDataFrame([(2, 9.0, 0.5, 0.4), (3, 9.5, 0.6, 0.5), (4, 4.0, 1.5, 0.1)], schema)
    assert tuple(sweep_facts(rising).first()) == (3, 2, 4, False, False)


def test_assignment_runs_in_codegen_and_null_features_have_no_cluster(spark, capsys):
    from cohortlens.operators.cluster import FIXED_CENTRES, assign_nearest

    rows = [(0.9, -1.0, -1.0), (None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "R_scaled double, F_scaled double, M_scaled double")
    assert [r.Cluster for r in assign_nearest(df, FIXED_CENTRES).collect()] == [0, None]
    scan = spark.range(3).selectExpr("id / 2 AS R_scaled", "id * 1.0D AS F_scaled", "1 - id * 1.0D AS M_scaled")
    assign_nearest(scan, FIXED_CENTRES).explain()
    plan = capsys.readouterr().out
    assert "transform(" not in plan and "aggregate(" not in plan and "*(1) Project" in plan
