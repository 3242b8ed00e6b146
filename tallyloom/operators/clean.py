"""Cleaning of delimited lines: ragged rows, fields by position, bad rows, null tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.fields import NULL_TOKEN, null_tokens, pick, tab_fields
from tallyloom.functions.text import QUAKE_WORDS, contains_any, with_once
from tallyloom.session import broadcast_if_small, saved

# Field positions of the raw exports, and the null tokens that mark a row without a place.
TWEET_FIELDS = (1, 2, 3, 5, 9, 10, 11, 13)
PLACE_FIELDS = (1, 2, 3, 28, 29, 31, 32, 33)
USER_FIELDS = (1, 4, 5, 6, 8, 9, 10, 11, 12, 16, 17, 18, 19)
PLACELESS_NULLS = 5


def drop_ragged(lines: DataFrame, width: int | None = None, column: str = "value") -> DataFrame:
    """Lines with ``width`` tab fields, empty fields at the end not counted.

    Without ``width`` the first line of each file decides for that file; ``lines``
    then has the columns ``file`` and ``line`` of ``numbered_records``.
    """
    size = F.size(tab_fields(F.col(column), drop_trailing=True))
    if width is not None:
        return lines.where(size == width)
    if not {"file", "line"} <= set(lines.columns):
        raise ValueError("without a width, lines need the columns file and line")
    firsts = saved(lines.where("line = 0").select("file", size.alias("_width")), "widths")
    return lines.join(broadcast_if_small(firsts), "file").where(size == F.col("_width")).select(*lines.columns)


def project_fields(lines: DataFrame, positions: Sequence[int], names: Sequence[str] | None = None,
                   keep: Sequence[str] = (), column: str = "value") -> DataFrame:
    """Trimmed fields by position; names default to f<position>."""
    names = names or [f"f{p}" for p in positions]
    split = with_once(lines.select(*keep, column), "_fields", tab_fields(F.col(column)))
    return split.select(*keep, *pick(F.col("_fields"), positions, names))


def drop_null_rows(df: DataFrame, columns: Sequence[str], nulls: int = PLACELESS_NULLS,
                   token: str = NULL_TOKEN) -> DataFrame:
    """Leave out rows in which exactly ``nulls`` columns hold the null token."""
    return df.where(null_tokens(columns, token) != nulls)


def split_rejected(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that do not; an unknown outcome does not pass."""
    passes = F.coalesce(good, F.lit(False))
    return df.where(passes), df.where(~passes)


def keyword_filter(df: DataFrame, column: str, keywords: Sequence[str] = QUAKE_WORDS) -> DataFrame:
    """Rows whose text holds any keyword, each row once."""
    return df.where(contains_any(F.col(column), keywords))
