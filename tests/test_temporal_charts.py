import pytest

from cohortlens.operators import charts
from cohortlens.operators.temporal import (
    activity_cube,
    enrich_time_features,
    slot_counts,
    temporal_profile,
    top_preferences,
    top_unique_customers,
)
from tests.fixtures import temporal_df

PERIODS = ("Early", "Mid", "Late")


def _top(df):
    return [(r[0], r[1], r[2], round(r[3], 6)) for r in df.orderBy(df.columns[0], "rank").collect()]


@pytest.fixture
def enriched(spark):
    return enrich_time_features(temporal_df(spark))


@pytest.fixture
def cube(spark):
    tx = temporal_df(spark)
    c = activity_cube(tx, "CustomerID", "InvoiceDate")
    return c.join(tx.select("CustomerID", "Cluster").distinct(), "CustomerID")


def test_enrich(enriched):
    r = enriched.orderBy("InvoiceDate").first()
    assert (r.hour, r.day_of_week, r.dow_num, r.is_weekend, r.day_of_month, r.month, r.month_period) == (
        9, "Monday", 0, False, 1, 1, "Early",
    )


@pytest.mark.parametrize("source", ["enriched", "cube"])
def test_top_preferences(request, source):
    df = request.getfixturevalue(source)
    w = "transactions" if source == "cube" else None
    day = _top(top_preferences(df, "Cluster", "day_of_week", 3, weight_col=w))
    assert day == [
        (0, "Monday", 2, 0.4), (0, "Saturday", 1, 0.2), (0, "Sunday", 1, 0.2),
        (1, "Thursday", 1, 0.5), (1, "Wednesday", 1, 0.5),
    ]
    hour = _top(top_preferences(df, "Cluster", "hour", 2, weight_col=w))
    assert hour == [(0, 9, 2, 0.4), (0, 10, 2, 0.4), (1, 12, 2, 1.0)]
    period = _top(top_preferences(df, "Cluster", "month_period", 3, weight_col=w, categories=PERIODS))
    assert period == [
        (0, "Early", 4, 0.8), (0, "Late", 1, 0.2), (0, "Mid", 0, 0.0),
        (1, "Early", 1, 0.5), (1, "Mid", 1, 0.5), (1, "Late", 0, 0.0),
    ]


@pytest.mark.parametrize("source", ["enriched", "cube"])
def test_top_unique(request, source):
    df = request.getfixturevalue(source)
    day = _top(top_unique_customers(df, "Cluster", "day_of_week", "CustomerID", 3))
    assert day == [
        (0, "Monday", 1, 0.25), (0, "Saturday", 1, 0.25), (0, "Sunday", 1, 0.25),
        (1, "Thursday", 1, 0.5), (1, "Wednesday", 1, 0.5),
    ]
    hour = _top(top_unique_customers(df, "Cluster", "hour", "CustomerID", 2))
    assert hour == [(0, 10, 2, 0.5), (0, 9, 1, 0.25), (1, 12, 2, 1.0)]


def test_profile_from_rows_and_cube_agree(enriched, cube):
    a = temporal_profile(enriched)
    b = temporal_profile(cube, weight_col="transactions", one_row_per_customer_slot=True)
    ra = sorted(tuple(r) for r in a.collect())
    assert ra == sorted(tuple(r) for r in b.collect())
    assert len(ra) == 6
    assert (0, "Monday", 9, "Early", 2, 1) in ra
    assert sum(r[4] for r in ra) == 7  # every transaction counted once


def test_slot_counts_order(enriched):
    got = [tuple(r) for r in slot_counts(enriched, "Cluster", "month_period").collect()]
    assert got == [(0, "Early", 4), (0, "Late", 1), (1, "Early", 1), (1, "Mid", 1)]


def test_share_matrices_sum_to_one(enriched):
    prof = temporal_profile(enriched)
    for wide, cols in (
        (charts.hour_share(prof), [f"h{h}" for h in range(24)]),
        (charts.dow_share(prof), ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]),
        (charts.period_share(prof), list(PERIODS)),
        (charts.dow_hour_share(prof), [f"h{h}" for h in range(24)]),
    ):
        for r in wide.collect():
            assert sum(r[c] for c in cols) == pytest.approx(1.0)
    rank = [(r.Cluster, r.day_of_week, r.rank) for r in charts.dow_ranking(prof).collect()]
    assert rank[0] == (0, "Monday", 1)


def test_unobserved_category_appears_with_zero(spark):
    # cluster 0 has no Late rows, cluster 1 only Late rows: both get all three
    # periods, absent ones with 0 (pandas observed=False on a categorical).
    df = spark.createDataFrame(
        [(0, "c1", "Early"), (0, "c1", "Early"), (0, "c2", "Mid"), (1, "c3", "Late")],
        "Cluster int, CustomerID string, month_period string",
    )
    top = top_preferences(df, "Cluster", "month_period", 3, categories=PERIODS)
    got = [(r[0], r[1], r[2], r[4]) for r in top.orderBy("Cluster", "rank").collect()]
    assert got == [
        (0, "Early", 2, 1), (0, "Mid", 1, 2), (0, "Late", 0, 3),
        (1, "Late", 1, 1), (1, "Early", 0, 2), (1, "Mid", 0, 3),
    ]
    uniq = top_unique_customers(df, "Cluster", "month_period", "CustomerID", 3, PERIODS)
    got = [(r[0], r[1], r[2], r[4]) for r in uniq.orderBy("Cluster", "rank").collect()]
    assert got == [
        (0, "Early", 1, 1), (0, "Mid", 1, 2), (0, "Late", 0, 3),
        (1, "Late", 1, 1), (1, "Early", 0, 2), (1, "Mid", 0, 3),
    ]
