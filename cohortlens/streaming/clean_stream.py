"""Row-local cleaning rules on a file stream (FLT-1..6, SCL-1..5; CLN-2 counts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import TxConfig
from cohortlens.operators.clean import REASON, tag_transactions
from cohortlens.sources.schema import raw_transactions_schema


def read_raw_stream(
    spark: SparkSession, path: str, cfg: TxConfig = TxConfig(), max_files_per_trigger: int | None = None
) -> DataFrame:
    """Raw transaction CSV files arriving in ``path`` (explicit schema)."""
    reader = (
        spark.readStream.schema(raw_transactions_schema(cfg))
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)  # header checked against the declared columns
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def stream_clean_rows(raw: DataFrame, cfg: TxConfig = TxConfig()) -> DataFrame:
    """Rows that pass every row-local rule, normalised and with Revenue.

    Stateless (append mode); duplicates are removed when the batch stage
    reads the written files (``clean_transactions`` is idempotent).
    """
    return tag_transactions(raw, cfg).filter(F.col(REASON).isNull()).drop(REASON)


def stream_audit_counts(raw: DataFrame, cfg: TxConfig = TxConfig()) -> DataFrame:
    """Running count of rows per first failing rule ('kept' for survivors).

    A streaming aggregation over at most ten keys, so its state is bounded;
    use ``update`` or ``complete`` output mode.
    """
    tagged = tag_transactions(raw, cfg)
    return tagged.groupBy(F.coalesce(F.col(REASON), F.lit("kept")).alias("rule")).agg(
        F.count(F.lit(1)).cast("long").alias("rows")
    )
