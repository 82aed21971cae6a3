"""Clustering (ML-1..6, SEG-1, SEG-2).

- Assignment, inertia and the squared silhouette are plain arithmetic over
  literal centres and per-cluster statistics, inside whole-stage codegen. None
  pairs rows with rows.
- Fitting (``lloyd``) advances all restarts of all k by one pass over the
  features; the lowest cost of each k wins. Labels are then made stable by
  sorting centres (Monetary desc, Frequency desc, Recency asc), so ids do not
  depend on partitioning.
- Two silhouettes: with squared Euclidean distance (Spark's
  ``ClusteringEvaluator`` definition), which decomposes into per-cluster sums,
  and with plain Euclidean distance, the reference's, from a cell tree
  (``cell_tree``) with a proven error bound. Both score all labellings of a
  sweep together.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from cohortlens.config import ClusterConfig, TxConfig
from cohortlens.operators.cell_tree import euclidean_silhouettes
from cohortlens.operators.features import SCALED_COLS
from cohortlens.operators.lloyd import Fit, fit_all
from cohortlens.sources.stage_tables import is_plain_scan, materialize

# Literal centres in (R_scaled, F_scaled, M_scaled) space used
# by the deterministic, SQL-checkable assignment queries. Our own choice:
# 0 = lapsed / low value, 1 = recent / frequent / high value, 2 = middle.
FIXED_CENTRES = (
    (1.0, -1.0, -1.0),
    (-1.0, 1.0, 1.0),
    (0.0, 0.0, 0.0),
)

# Segment names by rank of median Monetary (highest first)
# for k = 3, as documented by the reference.
SEGMENT_NAMES = ("Champions", "Potential Loyalists", "Hibernating")


def _sq_dist(features: Sequence[str], centre: Sequence[float]) -> Column:
    """Squared distance to a centre, written out so that it runs in whole-stage codegen."""
    terms = [(F.col(c).cast("double") - F.lit(float(v))) for c, v in zip(features, centre)]
    return reduce(operator.add, [t * t for t in terms])


def assign_nearest(
    df: DataFrame,
    centres: Sequence[Sequence[float]],
    features: Sequence[str] = SCALED_COLS,
    cluster_col: str = "Cluster",
    distance_col: str | None = None,
) -> DataFrame:
    """ML-5: nearest centre (squared Euclidean); ties go to the lower id, and a
    null feature gives a null cluster."""
    names = [f"_d{i}" for i in range(len(centres))]
    out = df.withColumns({n: _sq_dist(features, c) for n, c in zip(names, centres)})
    least = F.least(*names) if len(names) > 1 else F.col(names[0])
    out = out.withColumn("_least", least)
    label = F.coalesce(*[F.when(F.col(n) == F.col("_least"), F.lit(i)) for i, n in enumerate(names)])
    out = out.withColumn(cluster_col, label.cast("int"))
    if distance_col:
        out = out.withColumn(distance_col, F.col("_least"))
    return out.drop("_least", *names)


def inertia(
    df: DataFrame, centres: Sequence[Sequence[float]], features: Sequence[str] = SCALED_COLS
) -> DataFrame:
    """ML-3: sum of squared distances to the nearest centre (one row)."""
    assigned = assign_nearest(df, centres, features, "_c", "_d")
    return assigned.agg(F.sum("_d").alias("inertia"))


def _squared_score(features: Sequence[str], label: str, stats: Sequence) -> Column:
    """A row's squared silhouette from literal (id, n, sums, psi) of its labelling's clusters.

    For point x and cluster C with n_C points, sum y_C and sum of squared norms
    psi_C, the mean squared distance is |x|^2 - 2 x.y_C/n_C + psi_C/n_C.
    a = own-cluster mean * n/(n-1) (excluding x itself), b = min over other
    clusters; singletons score 0; s = 1 - a/b if a < b, b/a - 1 if a > b.
    """
    x = [F.col(c).cast("double") for c in features]
    norm2 = reduce(operator.add, [v * v for v in x])
    own, others = [], []
    for id_, n, y, psi in stats:
        dot = reduce(operator.add, [v * F.lit(s) for v, s in zip(x, y, strict=True)])
        mean = norm2 - F.lit(2.0) * dot / F.lit(n) + F.lit(psi / n)
        mine = F.col(label) == F.lit(id_)
        own.append(F.when(mine, mean * F.lit(n / (n - 1)) if n > 1 else F.lit(None)))
        others.append(F.when(~mine, mean))
    a = F.coalesce(*own)
    b = F.least(*others) if len(others) > 1 else F.lit(None).cast("double")
    score = (
        F.when(a.isNull() | b.isNull(), F.lit(0.0))
        .when(a < b, F.lit(1.0) - a / b)
        .when(a > b, b / a - F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    return F.when(F.col(label).isNotNull(), score)


def squared_silhouettes(
    df: DataFrame, label_cols: Sequence[str], features: Sequence[str] = SCALED_COLS
) -> DataFrame:
    """ML-4 with squared Euclidean distance, of every column of cluster labels (one row,
    a column for each): two passes in all. The first gathers (n, sums, psi) of every
    labelling's clusters, whose number the caller bounds; they are literals of the second."""
    x = [F.col(c).cast("double") for c in features]
    labels = F.array(*[F.struct(F.lit(i).alias("t"), F.col(c).cast("long").alias("id")) for i, c in enumerate(label_cols)])
    long = df.select(*[v.alias(f"_x{a}") for a, v in enumerate(x)], F.inline(labels)).where("id IS NOT NULL")
    names = [f"_x{a}" for a in range(len(x))]
    per = long.groupBy("t", "id").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names], F.sum(reduce(operator.add, [F.col(c) * F.col(c) for c in names])).alias("psi")
    )
    stats: dict[int, list] = {i: [] for i in range(len(label_cols))}
    for r in sorted(per.collect(), key=lambda r: (r["t"], r["id"])):
        stats[r["t"]].append((r["id"], float(r["n"]), [r[c] for c in names], r["psi"]))
    return df.agg(*[F.avg(_squared_score(features, c, stats[i])).alias(c) for i, c in enumerate(label_cols)])


def silhouette(
    df: DataFrame, features: Sequence[str] = SCALED_COLS, cluster_col: str = "Cluster"
) -> DataFrame:
    """ML-4: mean silhouette with squared Euclidean distance (one row)."""
    return squared_silhouettes(df, [cluster_col], features).withColumnRenamed(cluster_col, "silhouette_sq_euclidean")


def silhouette_euclidean(
    df: DataFrame, features: Sequence[str] = SCALED_COLS, cluster_col: str = "Cluster", cells: int = 16384, tolerance: float = 1e-4
) -> DataFrame:
    """ML-4 as the reference scores it: (silhouette, error_bound), one row. See ``cell_tree``."""
    scored = euclidean_silhouettes(df, [cluster_col], features, cells, tolerance)
    return scored.select("silhouette", "error_bound")


def _fit_table(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame, float]:
    """(rows, persisted features, mean population variance of the features).

    The rows are written first unless they already are a plain scan of written
    files; the features without nulls stay in memory, or on the executors'
    disks, for the passes.
    """
    base = df if is_plain_scan(df) else materialize(df)
    table = base.select(*[F.col(c).cast("double").alias(c) for c in features]).dropna()
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    row = table.agg(*[F.var_pop(c) for c in features]).first()
    return base, table, sum(v or 0.0 for v in row) / len(features)


def stable_order(centres: list[list[float]]) -> list[list[float]]:
    """Relabel key: Monetary desc, Frequency desc, Recency asc (features R, F, M)."""
    return sorted(centres, key=lambda c: (-c[2], -c[1], c[0]))


def fit_sweep(df: DataFrame, ks: Sequence[int], cfg: ClusterConfig = ClusterConfig()) -> dict[int, tuple[list[list[float]], float]]:
    """ML-1 for every k: (stably ordered centres, inertia) of the best of n_init fits,
    all of which advance together (``lloyd``)."""
    base, table, mean_var = _fit_table(df, cfg.features)
    wanted = [(k, cfg.seed + i) for k in ks for i in range(cfg.n_init)]
    try:
        fits = fit_all(base, table, wanted, mean_var, cfg.tol, cfg.max_iter)
    finally:
        table.unpersist()
    best: dict[int, Fit] = {}
    for (k, _), fit in zip(wanted, fits, strict=True):
        if k not in best or fit.cost < best[k].cost:
            best[k] = fit
    return {k: (stable_order(f.centres.tolist()), f.cost) for k, f in best.items()}


def fit_kmeans(
    df: DataFrame, k: int | None = None, cfg: ClusterConfig = ClusterConfig()
) -> tuple[list[list[float]], float]:
    """ML-1: best-of-n_init KMeans; returns (stably ordered centres, inertia)."""
    k = k or cfg.final_k
    return fit_sweep(df, [k], cfg)[k]


def kmeans_clusters(df: DataFrame, cfg: ClusterConfig = ClusterConfig()) -> DataFrame:
    """ML-1 + ML-5: fit the final k and label every row with its cluster."""
    centres, _ = fit_kmeans(df, cfg.final_k, cfg)
    return assign_nearest(df, centres, cfg.features, cfg.cluster_col)


def sweep_ks(cfg: ClusterConfig) -> list[int]:
    return list(range(cfg.k_min, cfg.k_max + 1))


def score_sweep(df: DataFrame, fits: dict[int, tuple[list[list[float]], float]], cfg: ClusterConfig = ClusterConfig()) -> DataFrame:
    """ML-2: (k, inertia, silhouette, error_bound, silhouette_sq_euclidean) of the fits of
    ``sweep_ks(cfg)``. All k are scored together, from one table of their labels: two
    passes for the squared silhouette, three for the Euclidean one, whatever the number of k."""
    ks = sweep_ks(cfg)
    labelled = df
    for k in ks:
        labelled = assign_nearest(labelled, fits[k][0], cfg.features, f"_k{k}")
    # written once: each pass would take the distances to all centres anew
    labelled = materialize(labelled.select(*cfg.features, *[f"_k{k}" for k in ks]))
    names = [f"_k{k}" for k in ks]
    squared = squared_silhouettes(labelled, names, cfg.features).first()
    plain = {r["labelling"]: r for r in euclidean_silhouettes(labelled, names, cfg.features).collect()}
    number = lambda v: None if v is None else float(v)
    rows = [
        (k, float(fits[k][1]), number(plain[n]["silhouette"]), number(plain[n]["error_bound"]), number(squared[n]))
        for k, n in zip(ks, names, strict=True)
    ]
    kinds = "k int, inertia double, silhouette double, error_bound double, silhouette_sq_euclidean double"
    return df.sparkSession.createDataFrame(rows, kinds)


def kmeans_sweep(df: DataFrame, cfg: ClusterConfig = ClusterConfig()) -> DataFrame:
    """ML-2: fits of all k in [k_min, k_max] and their scores (``score_sweep``)."""
    df = df if is_plain_scan(df) else materialize(df)
    return score_sweep(df, fit_sweep(df, sweep_ks(cfg), cfg), cfg)


def fit_facts(
    labelled: DataFrame,
    centres: Sequence[Sequence[float]],
    features: Sequence[str] = SCALED_COLS,
    cluster_col: str = "Cluster",
    tolerance: float = 0.05,
) -> DataFrame:
    """What any valid fit must meet, from the labelled rows (one row): clusters
    used, rows labelled, and whether each centre is its members' mean."""
    per = labelled.groupBy(F.col(cluster_col).alias("_id")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(f"_m{j}") for j, c in enumerate(features)]
    )
    off = [
        F.abs(F.col(f"_m{j}") - F.element_at(F.array(*[F.lit(float(c[j])) for c in centres]), F.col("_id") + 1))
        for j in range(len(features))
    ]
    return per.agg(
        F.count("_id").cast("long").alias("clusters"),
        F.sum("_n").cast("long").alias("customers"),
        F.bool_and(reduce(operator.and_, [o <= tolerance for o in off])).alias("centres_are_means"),
    )


def sweep_facts(sweep: DataFrame) -> DataFrame:
    """What any valid sweep must meet (one row): the k tried, inertia never
    rising with k, both silhouettes within [-1, 1]. Reads k_max - k_min + 1 rows."""
    before = F.lag("inertia").over(Window.partitionBy().orderBy("k"))
    steps = sweep.withColumn("_falls", F.coalesce(F.col("inertia") <= before, F.lit(True)))
    return steps.agg(
        F.count("k").cast("long").alias("fits"),
        F.min("k").alias("k_min"),
        F.max("k").alias("k_max"),
        F.bool_and("_falls").alias("inertia_never_rises"),
        F.bool_and((F.abs("silhouette_sq_euclidean") <= 1) & (F.abs("silhouette") <= 1)).alias("silhouettes_valid"),
    )


def cluster_sizes(df: DataFrame, cluster_col: str = "Cluster", name: str = "Customers") -> DataFrame:
    """ML-6 / CHT-1: members per cluster, ordered by cluster."""
    return df.groupBy(cluster_col).agg(F.count(F.lit(1)).cast("long").alias(name)).orderBy(cluster_col)


def attach_clusters(
    df: DataFrame, clusters: DataFrame, id_col: str = "CustomerID", cluster_col: str = "Cluster"
) -> DataFrame:
    """JOIN-1/2/4: inner equi-join of rows with the customer -> cluster map.

    Left to AQE: broadcast when the map is measured small at run time,
    otherwise sort-merge with skew splitting of hot customers.
    """
    return df.join(clusters.select(id_col, cluster_col), id_col, "inner")


def segment_names(
    medians: DataFrame,
    cluster_col: str = "Cluster",
    by: str = "Monetary_median",
    names: Sequence[str] = SEGMENT_NAMES,
) -> DataFrame:
    """SEG-1: name clusters by rank of median Monetary (highest = first name).

    ``medians`` has one row per cluster (k rows), so the unpartitioned
    window sorts k rows.
    """
    rank = F.row_number().over(Window.orderBy(F.desc(by), F.asc(cluster_col)))
    name_arr = F.array(*[F.lit(n) for n in names])
    named = medians.select(cluster_col, rank.alias("segment_rank"))
    return named.select(
        cluster_col,
        F.col("segment_rank").cast("int").alias("segment_rank"),
        F.coalesce(
            F.element_at(name_arr, F.col("segment_rank")),
            F.concat(F.lit("Segment "), F.col("segment_rank").cast("string")),
        ).alias("segment"),
    )


def segment_revenue_share(
    df: DataFrame, cluster_col: str = "Cluster", money_col: str = "Monetary", digits: int = 6,
    money_scale: int = TxConfig.money_scale,
) -> DataFrame:
    """SEG-2: share of total revenue per cluster (per-cluster sums, k rows)."""
    per = df.groupBy(cluster_col).agg(
        F.sum(F.col(money_col).cast(DecimalType(38, money_scale))).alias("_rev"),
        F.count(F.lit(1)).cast("long").alias("Customers"),
    )
    total = F.sum("_rev").over(Window.partitionBy())
    return per.select(
        cluster_col,
        "Customers",
        F.col("_rev").cast("double").alias("revenue"),
        F.round(F.col("_rev").cast("double") / total.cast("double"), digits).alias("revenue_share"),
    )
