from pyspark.sql import functions as F

from cohortlens.sources.sizing import broadcast_if_small, broadcast_threshold, size_estimate


def _is_broadcast_hint(df):
    return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


def test_broadcast_only_under_threshold(spark):
    small = spark.range(10)
    assert size_estimate(small) > 0
    assert _is_broadcast_hint(broadcast_if_small(small))
    assert not _is_broadcast_hint(broadcast_if_small(small, bound=broadcast_threshold(small) + 1))


def test_threshold_parsing(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20m")
        assert broadcast_threshold(spark.range(1)) == 20 << 20
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not _is_broadcast_hint(broadcast_if_small(spark.range(1)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_plain_scan_detection(spark, tmp_path):
    from cohortlens.sources.stage_tables import is_plain_scan, materialize, reusable

    path = str(tmp_path / "t")
    spark.range(50).withColumn("g", F.col("id") % 3).write.parquet(path)
    scan = spark.read.parquet(path)
    assert is_plain_scan(scan.filter("id > 3").select((F.col("id") * 2).alias("x")))
    assert not is_plain_scan(scan.groupBy("g").count())
    assert not is_plain_scan(scan.join(scan.select("g"), "g"))
    assert not is_plain_scan(scan.dropDuplicates(["g"]))
    assert reusable(scan) is scan
    agg = scan.groupBy("g").agg(F.sum("id").alias("s"))
    written = materialize(agg)
    assert is_plain_scan(written)
    assert sorted(tuple(r) for r in written.collect()) == sorted(tuple(r) for r in agg.collect())
    assert is_plain_scan(reusable(agg))
    cached = agg.cache()
    try:
        assert is_plain_scan(cached.filter("s > 0"))  # cached result: re-read, not re-written
    finally:
        cached.unpersist()


def test_cluster_without_checkpoint_dir_fails():
    from types import SimpleNamespace

    import pytest

    from cohortlens.session import ensure_checkpoint_dir

    sc = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_cluster_sizing_only_off_local(spark):
    from types import SimpleNamespace

    from cohortlens.session import CLUSTER_CONF, apply_cluster_sizing

    assert apply_cluster_sizing(spark) == {}  # local master: untouched
    set_keys = {}
    preset = {"spark.sql.shuffle.partitions"}
    sc = SimpleNamespace(master="yarn", getConf=lambda: SimpleNamespace(contains=lambda k: k in preset))
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(set=lambda k, v: set_keys.__setitem__(k, v)))
    applied = apply_cluster_sizing(fake)
    assert "spark.sql.shuffle.partitions" not in applied  # a deployment's own value wins
    assert applied == set_keys == {k: v for k, v in CLUSTER_CONF.items() if k not in preset}
