"""Column expressions on delimited lines and event times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
NULL_TOKEN = "NULL"


def tab_fields(line: Column, drop_trailing: bool = False) -> Column:
    """The tab fields of a line; optionally without empty ones at the end."""
    return F.split(F.regexp_replace(line, "\t+$", "") if drop_trailing else line, "\t")


def pick(fields: Column, positions: Sequence[int], names: Sequence[str]) -> list[Column]:
    """Trimmed fields by 0-based position."""
    return [F.trim(F.get(fields, F.lit(p))).alias(n) for p, n in zip(positions, names, strict=True)]


def null_tokens(columns: Sequence[str], token: str = NULL_TOKEN) -> Column:
    """How many of the columns hold the null token."""
    return sum((F.when(F.col(c) == token, 1).otherwise(0) for c in columns), F.lit(0))


def tab_line(*columns: str | Column) -> Column:
    """One tab-separated line; nulls are written as ``null``."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])


def event_time(text: Column, fmt: str = TIME_FORMAT) -> Column:
    """A timestamp, or null where the text does not parse."""
    return F.try_to_timestamp(text, F.lit(fmt))


def event_seconds(text: Column, fmt: str = TIME_FORMAT) -> Column:
    return F.unix_seconds(event_time(text, fmt))


def time_text(seconds: Column, fmt: str = TIME_FORMAT) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), fmt)
