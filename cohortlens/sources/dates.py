"""FLT-2: the format of date text, found from the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.scalar import parse_timestamp

# The formats tried; None is ISO text.
CANDIDATES = (
    None,
    "M/d/yyyy[ H:mm[:ss]]",
    "d/M/yyyy[ H:mm[:ss]]",
    "M/d/yy[ H:mm[:ss]]",
    "d/M/yy[ H:mm[:ss]]",
    "d.M.yyyy[ H:mm[:ss]]",
    "yyyy/M/d[ H:mm[:ss]]",
    "d MMM yyyy[ H:mm[:ss]]",
)


class DateFormatError(ValueError):
    """No single format reads all the dates, or several read them differently."""


@dataclass(frozen=True)
class DateFormat:
    """The format found, the values that it reads, and those that no format reads."""

    pattern: str | None
    read: int
    unreadable: int


def find_date_format(df: DataFrame, date_col: str, candidates: Sequence[str | None] = CANDIDATES) -> DateFormat:
    """The one candidate that reads every non-null date that any candidate reads.

    One narrow pass over the column counts, for each candidate, the values that it
    reads, and for each pair those that both read differently; one row reaches the
    driver. Values that none reads are no dates (the cleaning drops them). Dates in
    several formats, and formats that read all dates but differently, raise
    ``DateFormatError`` with the counts. A typed column, and one without dates, is
    read as it is.
    """
    dtype = df.schema[date_col].dataType
    if dtype.typeName() != "string":
        return DateFormat(None, 0, 0)
    text = df.select(F.col(date_col).alias("_text")).where("_text IS NOT NULL")
    read = {f"_p{i}": parse_timestamp(F.col("_text"), dtype, c) for i, c in enumerate(candidates)}
    pairs = list(combinations(range(len(candidates)), 2))
    row = text.withColumns(read).agg(
        F.count("*").alias("values"),
        F.count(F.coalesce(*read)).alias("dates"),
        *[F.count(p).alias(p) for p in read],
        *[F.count_if(F.col(f"_p{i}") != F.col(f"_p{j}")).alias(f"_d{i}_{j}") for i, j in pairs],
    ).first()
    counts = [row[p] for p in read]
    name = [c or "ISO" for c in candidates]
    whole = [i for i, n in enumerate(counts) if n == row["dates"]]
    if not whole:
        found = ", ".join(f"{n} as {name[i]}" for i, n in enumerate(counts) if n)
        raise DateFormatError(f"{date_col}: no format reads all {row['dates']} dates ({found}); name one, or split the file")
    differ = [(i, j) for i, j in pairs if i in whole and j in whole and row[f"_d{i}_{j}"]]
    if differ:
        i, j = differ[0]
        raise DateFormatError(
            f"{date_col}: {name[i]} and {name[j]} both read all {row['dates']} dates, {row[f'_d{i}_{j}']} of them differently; name one"
        )
    return DateFormat(candidates[whole[0]], row["dates"], row["values"] - row["dates"])
