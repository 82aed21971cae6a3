"""Size-checked broadcast for dimension sides of a join.

Without table statistics Spark estimates an inner join's output as the
product of its inputs, so after a dimension join the *fact* side can look
smaller and get broadcast. ``broadcast_if_small`` makes the choice explicit:
a side is hinted for broadcast only when a size bound, taken from the
optimizer's estimate of the (column-pruned) inputs, is under the session's
``spark.sql.autoBroadcastJoinThreshold``; otherwise the join is left to
sort-merge (and AQE's runtime conversion when shuffle output is small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def size_estimate(df: DataFrame) -> int:
    """Optimizer size estimate in bytes (file size scaled to pruned columns)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size if isinstance(size, int) else size.toString())


def broadcast_threshold(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


def broadcast_if_small(df: DataFrame, bound: int | None = None) -> DataFrame:
    """``F.broadcast(df)`` when ``bound`` (default: its own estimate) fits the
    threshold; the unchanged ``df`` otherwise (threshold < 0 disables)."""
    limit = broadcast_threshold(df)
    size = size_estimate(df) if bound is None else bound
    return F.broadcast(df) if 0 <= size <= limit else df
