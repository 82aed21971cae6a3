"""Scalar column expressions with the reference's (pandas) semantics.

Each helper returns a ``Column``; nothing here triggers a job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

# English weekday names in calendar order, Monday = 0.
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Characters Python's ``str.strip()`` removes from ASCII text.
_WHITESPACE = " \t\n\r\x0b\x0c"


def normalize_id(c: Column) -> Column:
    """Identifier as text: drop one trailing ``.0``, then strip whitespace.

    The regex runs before the strip, so ``" 12.0 "`` becomes ``"12.0"``.
    """
    return F.btrim(F.regexp_replace(c.cast("string"), r"\.0$", ""), F.lit(_WHITESPACE))


def starts_with_flag(c: Column, prefix: str) -> Column:
    """``c`` starts with ``prefix``; a null value counts as False (not null)."""
    return F.coalesce(c.cast("string").startswith(prefix), F.lit(False))


def is_missing(c: Column, dtype: DataType | None = None) -> Column:
    """Null, or NaN for floating columns (pandas treats both as missing)."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def parse_timestamp(c: Column, dtype: DataType, fmt: str | None = None) -> Column:
    """Timestamp without zone; text that does not parse becomes null.

    Already-typed timestamps pass through; dates become midnight.
    """
    name = dtype.typeName()
    if name == "timestamp_ntz":
        return c
    if name in ("timestamp", "date"):
        return c.cast("timestamp_ntz")
    if fmt is None:
        return c.try_cast("timestamp_ntz")
    # Parsed straight to a zone-free value: going through a zoned timestamp
    # would move wall-clock times in a DST gap of the session zone. The
    # try_ guard makes unparseable text null instead of an (ANSI) error.
    text, pattern = c.cast("string"), F.lit(fmt)
    return F.when(F.try_to_timestamp(text, pattern).isNotNull(), F.to_timestamp_ntz(text, pattern))


def full_days_between(start: Column, end: Column) -> Column:
    """Whole 24-hour days from ``start`` to ``end`` (floored, zone-free).

    Subtracting two ``timestamp_ntz`` values yields a day-time interval;
    its DAY field truncates toward zero, so negative remainders are floored.
    """
    iv = end - start
    days = F.extract(F.lit("DAY"), iv).cast("int")
    return F.when(iv < F.make_dt_interval(days), days - 1).otherwise(days)


def weekday_name(ts: Column) -> Column:
    """Full English weekday name, independent of the JVM locale."""
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), F.weekday(ts) + 1)


def cut(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed binning like ``pandas.cut``: (e0,e1] -> labels[0], ...

    Values outside (edges[0], edges[-1]] and nulls give null.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("cut needs len(edges) == len(labels) + 1")
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def ordinal(c: Column, categories: Sequence[str]) -> Column:
    """0-based position of ``c`` in an ordered category list (null if absent)."""
    pos = F.array_position(F.array(*[F.lit(v) for v in categories]), c)
    return F.when(pos > 0, (pos - 1).cast("int"))
