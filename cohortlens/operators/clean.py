"""Transaction cleaning (FLT-1..6, SCL-1..5, SET-1, CLN-1) and its audit (CLN-2).

Every rule is row-local, so the whole policy is one narrow projection +
filter fused into the scan's whole-stage-codegen span; only the duplicate
removal shuffles. The audit labels each row with the *first* rule it fails
(the order of the reference), so its parts always sum to the rows dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import TxConfig
from cohortlens.functions.scalar import (
    is_missing,
    normalize_id,
    parse_timestamp,
    starts_with_flag,
)

REASON = "_drop_reason"
COPIES = "_copies"

# Audit rows in policy order (step number = position).
AUDIT_STEPS = (
    "rows_in",
    "customer_null",
    "date_invalid",
    "cancelled",
    "quantity_null",
    "quantity_non_positive",
    "price_null",
    "price_non_positive",
    "description_null",
    "duplicate",
    "rows_out",
)


def _drop_reason(df: DataFrame, cfg: TxConfig, parsed_date: Column) -> Column:
    """Label of the first failing rule, or null when the row is kept."""
    dtype = {f.name: f.dataType for f in df.schema.fields}
    q, p = F.col(cfg.quantity), F.col(cfg.price)
    reason = (
        F.when(is_missing(F.col(cfg.customer), dtype[cfg.customer]), F.lit("customer_null"))
        .when(parsed_date.isNull(), F.lit("date_invalid"))
        .when(starts_with_flag(F.col(cfg.invoice), cfg.cancel_prefix), F.lit("cancelled"))
        .when(is_missing(q, dtype[cfg.quantity]), F.lit("quantity_null"))
        .when(~(q > 0), F.lit("quantity_non_positive"))
        .when(is_missing(p, dtype[cfg.price]), F.lit("price_null"))
        .when(~(p > 0), F.lit("price_non_positive"))
    )
    if cfg.description in df.columns:  # FLT-6 applies only when the column exists
        reason = reason.when(F.col(cfg.description).isNull(), F.lit("description_null"))
    return reason


def tag_transactions(df: DataFrame, cfg: TxConfig = TxConfig()) -> DataFrame:
    """Normalised columns + Revenue + the drop reason (null = kept). Narrow."""
    parsed = parse_timestamp(F.col(cfg.date), df.schema[cfg.date].dataType, cfg.date_format)
    return df.withColumns(
        {
            REASON: _drop_reason(df, cfg, parsed),
            cfg.date: parsed,
            cfg.customer: normalize_id(F.col(cfg.customer)),
            cfg.revenue: F.col(cfg.quantity) * F.col(cfg.price),
        }
    )


def clean_transactions(df: DataFrame, cfg: TxConfig = TxConfig()) -> DataFrame:
    """CLN-1: apply the cleaning policy and drop exact duplicate rows.

    The duplicate check runs over all columns after id normalisation, as in
    the reference. It is a hash aggregate with map-side partial
    aggregation, so even a group of copies holding a large share of the
    rows is collapsed before the shuffle.
    """
    tagged = tag_transactions(df, cfg)
    kept = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    return kept.dropDuplicates()


def counted_transactions(df: DataFrame, cfg: TxConfig = TxConfig()) -> DataFrame:
    """Distinct clean rows and, per drop reason, one row without content: (content..., reason, copies).

    Rows that fail a rule are keyed by their reason only, so they collapse into a
    handful of groups map-side; kept rows are keyed by their whole content. Both
    the clean table and its audit come from this one shuffle: see ``audit_metrics``.
    """
    tagged = tag_transactions(df, cfg)
    content = [c for c in tagged.columns if c != REASON]
    row = F.when(F.col(REASON).isNull(), F.struct(*[F.col(f"`{c}`") for c in content]))
    per_key = tagged.groupBy(F.col(REASON), row.alias("_row")).agg(F.count(F.lit(1)).alias(COPIES))
    return per_key.select(*[F.col("_row").getField(c).alias(c) for c in content], REASON, COPIES)


def audit_metrics() -> dict[str, Column]:
    """CLN-2 as aggregates over ``counted_transactions``, by rule."""
    reason, n = F.col(REASON), F.col(COPIES)
    metrics = {
        "rows_in": F.sum(n),
        **{r: F.sum(F.when(reason == r, n).otherwise(0)) for r in AUDIT_STEPS[1:-2]},
        "duplicate": F.sum(F.when(reason.isNull(), n - 1).otherwise(0)),
        "rows_out": F.count_if(reason.isNull()),
    }
    return {k: F.coalesce(m, F.lit(0)).cast("long") for k, m in metrics.items()}


def clean_audit(df: DataFrame, cfg: TxConfig = TxConfig()) -> DataFrame:
    """CLN-2: rows removed per rule plus totals, in one scan.

    The duplicates are the sum of (copies - 1) over ``counted_transactions``.
    Output: (step int, rule string, rows bigint), one row per AUDIT_STEPS.
    """
    wide = counted_transactions(df, cfg).agg(*[m.alias(k) for k, m in audit_metrics().items()])
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("step"), F.lit(k).alias("rule"), F.col(k).alias("rows"))
                    for i, k in enumerate(AUDIT_STEPS)
                ]
            )
        )
    )
