import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.functions.scalar import cut, full_days_between, normalize_id, ordinal, weekday_name
from cohortlens.operators.features import rfm_features, scale_features
from cohortlens.operators.stats import (
    date_range_uniques,
    describe,
    exact_quantiles,
    missing_ratio,
    skewness,
    value_counts,
)

X = [1.0, 2.0, 2.0, 5.0, 9.0, 40.0, 7.5]


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame([(d,) for d in (0, 1, 10, 11, 20, 21, 31, 32)], "d int")
    got = [r[0] for r in df.select(cut(F.col("d"), [0, 10, 20, 31], ["Early", "Mid", "Late"])).collect()]
    assert got == [None, "Early", "Early", "Mid", "Mid", "Late", "Late", None]


def test_normalize_id(spark):
    df = spark.createDataFrame([("13085.0",), (" 13090 ",), (" 12.0 ",), ("\t7\n",), ("10.05",)], "c string")
    got = [r[0] for r in df.select(normalize_id(F.col("c"))).collect()]
    assert got == ["13085", "13090", "12.0", "7", "10.05"]


def test_weekday_and_ordinal(spark):
    df = spark.createDataFrame([(dt.datetime(2011, 12, 10, 10, 0),)], "t timestamp_ntz")
    r = df.select(weekday_name(F.col("t")).alias("n"), F.weekday("t").alias("w")).first()
    assert (r.n, r.w) == ("Saturday", 5)
    o = df.select(ordinal(F.lit("Mid"), ["Early", "Mid", "Late"]).alias("o")).first().o
    assert o == 1


@pytest.mark.parametrize("tz", ["UTC", "Europe/London", "America/New_York"])
def test_full_days_is_zone_free(spark, tz):
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        df = spark.createDataFrame(
            [
                (dt.datetime(2010, 3, 27, 1, 30), dt.datetime(2010, 3, 29, 0, 0)),  # across DST
                (dt.datetime(2010, 1, 11, 9, 0), dt.datetime(2010, 1, 21, 0, 0)),
                (dt.datetime(2010, 1, 21, 5, 0), dt.datetime(2010, 1, 21, 0, 0)),  # negative
            ],
            "a timestamp_ntz, b timestamp_ntz",
        )
        got = [r[0] for r in df.select(full_days_between(F.col("a"), F.col("b"))).collect()]
        assert got == [1, 9, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_describe_matches_pandas_fixture(spark):
    df = spark.createDataFrame([(x,) for x in X], "x double")
    r = describe(df, ["x"], (0.5, 0.9)).first()
    assert r["count"] == 7
    assert r["p50"] == 5.0
    assert r["p90"] == pytest.approx(21.4)
    assert r["std"] == pytest.approx(13.7810, abs=1e-4)
    assert r["min"] == 1.0 and r["max"] == 40.0


def test_adjusted_skewness(spark):
    df = spark.createDataFrame([(x,) for x in X], "x double")
    assert skewness(df, ["x"], digits=None).first()["skewness"] == pytest.approx(2.390661, abs=1e-6)
    const = spark.createDataFrame([(3.0,)] * 5, "x double")
    assert skewness(const, ["x"]).first()["skewness"] == 0.0


def test_exact_quantiles_against_numpy(spark):
    rnd = random.Random(7)
    data = []
    for g in range(3):
        n = [1, 2, 997][g]
        for _ in range(n):
            # many ties plus a hot value, like Frequency = 1
            v = 1.0 if rnd.random() < 0.4 else float(rnd.randint(0, 50)) + rnd.choice([0.0, 0.5])
            data.append((g, v))
    df = spark.createDataFrame(data, "g int, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 0.95, 0.99, 1.0]
    got = {(r.g, r.p): r.value for r in exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    for g in range(3):
        vals = np.array([v for gg, v in data if gg == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.quantile(vals, p)), abs=1e-9)


def test_exact_quantiles_many_ties(spark):
    df = spark.createDataFrame([(float(i % 97),) for i in range(5000)], "v double")
    got = exact_quantiles(df, ["v"], [0.5, 0.75]).orderBy("p").collect()
    vals = np.array([float(i % 97) for i in range(5000)])
    assert [r.value for r in got] == [float(np.quantile(vals, 0.5)), float(np.quantile(vals, 0.75))]


def test_missing_ratio_and_uniques(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("b", float("nan"), "x"), ("a", 2.0, "y"), (None, 3.0, "z")],
        "c string, p double, d string",
    )
    got = [(r.field, r.missing_ratio) for r in missing_ratio(df).collect()]
    assert got == [("c", 0.25), ("p", 0.25), ("d", 0.25)]
    vc = [(r.c, r["count"]) for r in value_counts(df, "c").collect()]
    assert vc == [("a", 2), ("b", 1)]
    ts = spark.createDataFrame(
        [("1", "i1", dt.datetime(2020, 1, 1)), ("2", "i1", dt.datetime(2020, 1, 3))],
        "c string, i string, t timestamp_ntz",
    )
    r = date_range_uniques(ts, "t", "c", "i").first()
    assert (r.customers, r.invoices) == (2, 1)


def test_zscore_population_std(spark):
    df = spark.createDataFrame([(float(x),) for x in X], "a double")
    out = scale_features(df, ["a"], ["z"]).select("z").toPandas()["z"].to_numpy()
    assert abs(out.mean()) < 1e-12
    assert out.std(ddof=0) == pytest.approx(1.0)
    const = spark.createDataFrame([(2.0,)] * 4, "a double")
    assert [r.z for r in scale_features(const, ["a"], ["z"]).collect()] == [0.0] * 4


def test_rfm_features_columns(spark):
    rfm = spark.createDataFrame(
        [("a", 0, 1, 10.0), ("b", 5, 2, 20.0), ("c", 9, 7, 300.0)],
        "CustomerID string, Recency int, Frequency long, Monetary double",
    )
    out = rfm_features(rfm)
    for c in ("R_log", "F_log", "M_log", "R_scaled", "F_scaled", "M_scaled", "Monetary"):
        assert c in out.columns
    assert out.filter("CustomerID = 'a'").first().R_log == 0.0


def test_exact_quantiles_unsorted_probs_and_hot_value(spark):
    # a third of the rows share one value, as a hot key would
    rnd = random.Random(3)
    vals = [7.0] * 2000 + [float(rnd.randint(0, 3000)) / 4 for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.99, 0.5, 0.05, 0.3333, 0.75]
    got = {r.p: r.value for r in exact_quantiles(df, ["v"], probs).collect()}
    arr = np.array(vals)
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(arr, p)), abs=1e-9)


@pytest.mark.parametrize("threshold", ["10485760", "-1"], ids=["broadcast", "join"])
def test_exact_quantiles_both_joins(spark, threshold):
    rnd = random.Random(11)
    data = [(g, 7.0 if rnd.random() < 0.3 else rnd.uniform(-50, 50)) for g in range(3) for _ in range(3000)]
    df = spark.createDataFrame(data, "g int, v double")
    probs = [0.01, 0.5, 0.9, 0.999]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        res = {(r.g, r.p): r.value for r in exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for g in range(3):
        arr = np.array([v for gg, v in data if gg == g])
        for p in probs:
            assert res[(g, p)] == pytest.approx(float(np.quantile(arr, p)), abs=1e-9)


def test_exact_quantiles_extreme_values(spark):
    # neighbouring doubles, denormals, both signs, both zeros, infinities, nulls and NaN
    near = [1.0 + i * 2.0**-52 for i in range(40)] + [3e15 + i * 0.5 for i in range(40)]
    vals = [*near, 5e-324, 1e-323, -5e-324, 0.0, -0.0, 1.7e308, -1.7e308, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in [*vals, None, float("nan")]], "v double")
    ordered = sorted(vals)
    probs = [i / (len(vals) - 1) for i in range(len(vals))]
    got = {r.p: r.value for r in exact_quantiles(df, ["v"], probs).collect()}
    for i, p in enumerate(probs):
        if p * (len(vals) - 1) == i:  # an exact rank: the value itself
            assert got[p] == ordered[i]
    assert exact_quantiles(df.filter("v > 1 and v < 1"), ["v"], [0.5]).collect() == []


def test_custom_date_format_is_zone_free(spark):
    from pyspark.sql import types as T

    from cohortlens.functions.scalar import parse_timestamp

    df = spark.createDataFrame([("3/8/2020 2:30",), ("12/1/2009 7:45",), ("2009-12-01 07:45:00",)], "s string")
    parsed = parse_timestamp(F.col("s"), T.StringType(), "M/d/yyyy H:mm").alias("t")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 2:30 falls in its DST gap
        got = [r.t for r in df.select(parsed).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2020, 3, 8, 2, 30), dt.datetime(2009, 12, 1, 7, 45), None]


def test_a_rank_outside_its_bracket_is_counted(spark, monkeypatch):
    """Brackets made useless: the counting way answers, with the same values."""
    from cohortlens.operators import stats

    rng = np.random.default_rng(12)
    x = np.round(rng.lognormal(size=30000), 2)
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(x)], "g int, v double").repartition(6)
    probs = [0.0, 0.01, 0.5, 0.9, 0.999, 1.0]
    want = {(g, p): float(np.quantile(x[g::3], p)) for g in range(3) for p in probs}
    used = []
    counted = stats.counted_quantiles
    monkeypatch.setattr(stats, "counted_quantiles", lambda *a: used.append(1) or counted(*a))
    for margin, fell_back in ((0.002, 0), (1e-9, 1)):
        monkeypatch.setattr(stats, "MARGIN", margin)
        rows = exact_quantiles(df, ["v"], probs, ["g"]).collect()
        got = {(r.g, r.p): r.value for r in rows}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
        assert len(used) == fell_back or margin == 1e-9  # so narrow a bracket may still hold its ranks
        for r in rows:
            part = x[r.g :: 3]
            assert (r.n, r.min, r.max) == (len(part), part.min(), part.max())
            assert (r.mean, r.std) == (pytest.approx(part.mean()), pytest.approx(part.std(ddof=1)))


def test_values_are_read_twice(spark):
    """Reads of the written values, by the rows that scans put out."""
    import json
    import os
    import subprocess
    import sys
    import tempfile

    import pyarrow as pa
    import pyarrow.parquet as pq

    d = tempfile.mkdtemp(prefix="cohortlens-reads-")
    pq.write_table(pa.table({"v": np.arange(50000) * 1.5}), f"{d}/t.parquet")
    script = f"""
import sys; sys.path.insert(0, {os.getcwd()!r})
from cohortlens.session import build_session
from cohortlens.operators.stats import describe
spark = build_session("local[2]", shuffle_partitions=2, extra_conf={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{d}", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"}})
describe(spark.read.parquet("{d}/t.parquet"), ["v"]).collect()
spark.stop()
"""
    subprocess.run([sys.executable, "-c", script], check=True, capture_output=True, timeout=300)
    (log,) = [os.path.join(d, f) for f in os.listdir(d) if f.startswith(("local-", "app-"))]
    read = 0
    for line in open(log):
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd" and (m := e.get("Task Metrics")):
            read += m["Input Metrics"]["Records Read"]
    assert 100000 <= read < 110000  # the values twice, and small tables
