"""Readers (SRC-1..8) and sinks (SNK-1..3).

Parquet is the default format at the edges; CSV is supported for the
reference's file layout. Readers never infer a schema.

A written table is a folder of versions and a log. A write fills a new version's
folder and then appends one line to the log, in one small file; readers follow
the newest line. So a table is replaced at once or not at all: a job that fails
half way, or whose check fails, leaves the old version in place, and a reader
that has begun keeps the version that it has. Folders without a log are read
as they are.

A table may be dealt out by a key into a fixed number of buckets, which its line in
the log records: tables of one key and number are joined by it without a shuffle.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.config import TxConfig
from cohortlens.functions.scalar import normalize_id, parse_timestamp
from cohortlens.sources.schema import TESTDATA_SCHEMAS, raw_transactions_schema


class MissingInputError(FileNotFoundError):
    """An input of a stage is absent; names the stage that needs it."""


LOG = "_versions"


def _missing(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)


def _log(spark: SparkSession, path: str) -> list[list[str]]:
    """A table's committed versions, the newest last: (time, folder, and key, number of buckets and schema, if bucketed)."""
    try:
        lines = spark.read.schema("line string").text(f"{path.rstrip('/')}/{LOG}").collect()  # a line for each write
    except AnalysisException as exc:
        if _missing(exc):
            return []
        raise
    return [line.split("\t") for line in sorted(r["line"] for r in lines)]


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of a table's committed versions, the newest last; none for a folder without a log."""
    return [f"{path.rstrip('/')}/{line[1]}" for line in _log(spark, path)]


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds a table's files now."""
    return (versions(spark, path) or [path])[-1]


def _absolute(spark: SparkSession, path: str) -> str:
    """The path as a table's location, which Spark would look for in the warehouse if it were relative."""
    if "://" in path or path.startswith(("/", "file:")):
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"a bucketed table needs an absolute path, not {path!r}")
    return os.path.abspath(path)


def _bucketed(spark: SparkSession, folder: str, key: str, number: str, schema: str) -> DataFrame:
    """A bucketed folder as Spark's planner knows it: declared as an external table, whose
    name is needed no longer once the plan holds its files."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(schema)).fields)
    name, folder = f"cohortlens_{uuid.uuid4().hex}", _absolute(spark, folder).replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {int(number)} BUCKETS LOCATION '{folder}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def read_table(
    spark: SparkSession,
    path: str,
    stage: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    logged: bool = True,
) -> DataFrame:
    """Read one table; a missing path raises ``MissingInputError`` (SRC-2).

    A table with a log of versions is read at its newest one, unless ``logged``
    is off: then the path is taken as it is.
    ``schema`` (a StructType or DDL string) skips schema inference. CSV quotes
    are doubled inside quoted text, as the sink writes them. ``multi_line``
    allows line breaks there, which makes a file one split.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, mode="PERMISSIVE", escape='"', multiLine=multi_line)
        if schema is not None:
            # check the header against the declared columns instead of
            # applying the schema by position (a reordered file fails loudly)
            reader = reader.option("enforceSchema", False)
    newest = (_log(spark, path) if logged else [])[-1:]
    folder = f"{path.rstrip('/')}/{newest[0][1]}" if newest else path
    if newest and len(newest[0]) > 2:
        return _bucketed(spark, folder, *newest[0][2:])
    try:
        return reader.format(fmt).load(folder)
    except AnalysisException as exc:
        if _missing(exc):
            raise MissingInputError(
                f"{stage}: input not found at {path}; run the producing stage first"
            ) from exc
        raise


def read_raw_transactions(
    spark: SparkSession, path: str, cfg: TxConfig = TxConfig(), multi_line: bool = False
) -> DataFrame:
    """SRC-1: raw transactions CSV; columns are found by their names in the header.

    Extra columns and any order are allowed and Description may be absent;
    other absent columns raise ``KeyError``. Numbers are read as doubles, and
    text that is no number as null. A record with more or fewer fields than
    the header fails the job, as does a quoted line break unless
    ``multi_line`` is set, so no purchase is lost as another rule's.
    """
    named = read_table(spark, path, "cleaning", fmt="csv").columns  # reads the header only
    text = T.StructType([T.StructField(c, T.StringType()) for c in named])
    reader = spark.read.schema(text).options(header=True, enforceSchema=False, mode="FAILFAST", escape='"', multiLine=multi_line)
    df = reader.csv(current(spark, path))
    wanted = raw_transactions_schema(cfg).fields
    require_columns(df, [f.name for f in wanted if f.name != cfg.description], "cleaning")
    return df.select(
        *[
            F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
            for f in wanted
            if f.name in named
        ]
    )


def require_columns(df: DataFrame, columns: Sequence[str], stage: str) -> DataFrame:
    """CHK-1: fail fast (no job) when required columns are absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{stage}: missing required columns {missing}")
    return df


def read_clean_transactions(
    spark: SparkSession,
    path: str,
    cfg: TxConfig = TxConfig(),
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    guard: bool = True,
) -> DataFrame:
    """SRC-3 + CHK-1 + CHK-2: clean transactions; any unparseable date fails
    the job that first reads it (guard fused into the scan's projection).
    Without ``guard`` such dates are null, for a caller that counts them.
    ``schema`` types a CSV table (Parquet carries its own)."""
    df = read_table(spark, path, "rfm", fmt=fmt, schema=schema)
    require_columns(df, [cfg.customer, cfg.invoice, cfg.date, cfg.revenue], "rfm")
    parsed = parse_timestamp(F.col(cfg.date), df.schema[cfg.date].dataType, cfg.date_format)
    if not guard:
        return df.withColumn(cfg.date, parsed)
    guarded = F.when(
        parsed.isNull(),
        F.raise_error(F.concat(F.lit("invalid InvoiceDate after cleaning: "), F.col(cfg.date).cast("string"))),
    ).otherwise(parsed)
    return df.withColumn(cfg.date, guarded.cast("timestamp_ntz"))


def read_profile_inputs(
    spark: SparkSession, rfm_path: str, clustered_path: str, fmt: str = "parquet",
    id_col: str = "CustomerID", cluster_col: str = "Cluster",
    rfm_schema: T.StructType | str | None = None, clustered_schema: T.StructType | str | None = None,
) -> DataFrame:
    """SRC-6 + JOIN-1: RFM table joined with the customer -> cluster map."""
    rfm = read_table(spark, rfm_path, "profile", fmt, rfm_schema)
    clusters = read_table(spark, clustered_path, "profile", fmt, clustered_schema)
    require_columns(clusters, [id_col, cluster_col], "profile")
    return rfm.join(clusters.select(id_col, cluster_col), id_col, "inner")


def read_temporal_inputs(
    spark: SparkSession, tx_path: str, clustered_path: str, cfg: TxConfig = TxConfig(),
    fmt: str = "parquet", id_col: str = "CustomerID", cluster_col: str = "Cluster",
    tx_schema: T.StructType | str | None = None, clustered_schema: T.StructType | str | None = None,
) -> DataFrame:
    """SRC-7 + JOIN-2: transactions with a parseable date, both sides' ids
    normalised (SCL-1..3), joined with the cluster map.

    Output: the transaction columns with ``cfg.customer`` renamed to
    ``id_col``, plus ``cluster_col``.
    """
    tx = read_table(spark, tx_path, "temporal", fmt, tx_schema)
    parsed = parse_timestamp(F.col(cfg.date), tx.schema[cfg.date].dataType, cfg.date_format)
    tx = (
        tx.withColumn(cfg.date, parsed)
        .filter(F.col(cfg.date).isNotNull())
        .withColumnRenamed(cfg.customer, id_col)
        .withColumn(id_col, normalize_id(F.col(id_col)))
    )
    clusters = read_table(spark, clustered_path, "temporal", fmt, clustered_schema)
    clusters = clusters.select(normalize_id(F.col(id_col)).alias(id_col), cluster_col)
    return tx.join(clusters, id_col, "inner")


def read_chart_inputs(
    spark: SparkSession, rfm_path: str, clustered_path: str, temporal_path: str, fmt: str = "parquet",
    schemas: tuple | None = None,
) -> tuple[DataFrame, DataFrame]:
    """SRC-8: (RFM joined with clusters, temporal profile). ``schemas`` =
    (rfm, clustered, temporal profile) types CSV tables."""
    rfm_s, clustered_s, temporal_s = schemas or (None, None, None)
    return (
        read_profile_inputs(
            spark, rfm_path, clustered_path, fmt, rfm_schema=rfm_s, clustered_schema=clustered_s
        ),
        read_table(spark, temporal_path, "charts", fmt, temporal_s),
    )


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    metrics: dict[str, Column] | None = None,
    keep: Column | None = None,
    columns: Sequence[str] | None = None,
    check: Callable[[dict], None] | None = None,
    buckets: tuple[str, int] | None = None,
) -> dict:
    """SNK-1/2/3: replace one table (CSV with a header row); returns the metrics.

    ``sort_by`` gives the reference's sorted layout without a single-task
    sort: range partitioning followed by a sort within each partition.
    ``metrics`` are aggregates of all rows of ``df``, observed while the table is
    written. They are taken after the last shuffle, in the stage that writes, whose
    tasks Spark counts once each, also if executors are lost. Only then do
    ``keep`` and ``columns`` choose the rows and columns to write. ``check`` gets
    the metrics; if it raises, the table is not replaced. ``buckets``: a key and a
    number of buckets, for Parquet tables with one row for each key.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if buckets:
        key, number = buckets
        df = df.repartition(number, key).sortWithinPartitions(key)
    out = df.repartitionByRange(*sort_by) if sort_by else df
    seen = Observation() if metrics else None
    if seen is not None:
        out = out.observe(seen, *[m.alias(name) for name, m in metrics.items()])
    if keep is not None:
        out = out.where(keep)
    if columns is not None:
        out = out.select(*[f"`{c}`" for c in columns])
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    version = f"v-{uuid.uuid4().hex}"
    writer = out.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(header=True, escape='"')
    if buckets:
        name = f"cohortlens_{uuid.uuid4().hex}"
        writer.format(fmt).option("path", _absolute(spark, f"{path}/{version}")).bucketBy(number, key).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
    else:
        writer.format(fmt).save(f"{path}/{version}")
    found = dict(seen.get) if seen is not None else {}
    if check is not None:
        check(found)
    before = versions(spark, path)
    line = "\t".join([f"{time.time_ns():020d}", version, *([key, str(number), out.schema.json()] if buckets else [])])
    spark.createDataFrame([(line,)], "line string").coalesce(1).write.mode("append").text(f"{path}/{LOG}")
    for old in before[-2:-1]:  # the version before the last: no reader starts on it any more
        spark.createDataFrame([], "emptied string").write.mode("overwrite").parquet(old)
    return found


def load_testdata(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver-generated table, e.g. ``lineitem`` (declared schema when known)."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", name, schema=TESTDATA_SCHEMAS.get(name), logged=False)
