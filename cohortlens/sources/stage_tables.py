"""Stage tables: written Parquet under the reliable checkpoint directory.

``materialize`` is the stage boundary used by multi-pass operators and by
the customer-grain stages. ``is_plain_scan`` tells whether re-reading a
plan costs only a file scan (row-local operators over files), in which
case a multi-pass consumer may read it again instead of writing a copy.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from cohortlens.session import ensure_checkpoint_dir

# Logical operators that neither shuffle nor combine inputs, over leaves
# that are cheap to re-read (files, local rows, checkpointed RDDs, cached
# tables): a plan built only from these costs a scan per pass.
_ROW_LOCAL = frozenset(
    {
        "Project",
        "Filter",
        "Generate",
        "LogicalRelation",
        "Relation",
        "LocalRelation",
        "LogicalRDD",
        "InMemoryRelation",
    }
)


def is_plain_scan(df: DataFrame) -> bool:
    """True when the optimized plan is row-local operators over file / local
    relations only (no join, aggregate, dedup, window, sort or exchange)."""
    stack = [df._jdf.queryExecution().optimizedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() not in _ROW_LOCAL:
            return False
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return True


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table under the reliable checkpoint directory
    (``spark.checkpoint.dir``, a shared folder on a cluster) and continue
    from the written files.

    It cuts the lineage, so a lost executor re-reads the table instead of
    recomputing from the raw transactions; consumers that read the result
    several times (statistics subqueries, multi-pass quantiles) scan the
    table instead of re-running the upstream joins and shuffles; and the
    scan carries its real file size, so later broadcast decisions see the
    true table size.
    """
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/cohortlens-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    # The schema is known: reading it back needs no footer inference.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reusable(df: DataFrame) -> DataFrame:
    """``df`` itself when it is a plain scan, else a materialized copy: the
    input of an operator that reads its input more than once."""
    return df if is_plain_scan(df) else materialize(df)
