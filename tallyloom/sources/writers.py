"""Text, tab, CSV and Parquet sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.fields import tab_line
from tallyloom.session import saved


def write_lines(df: DataFrame, path: str, column: str = "value", gzip: bool = False) -> str:
    df.select(F.col(column).alias("value")).write.option("lineSep", "\n").option(
        "compression", "gzip" if gzip else "none").text(path)
    return path


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None, gzip: bool = False) -> str:
    """``key <tab> value`` lines without quoting; nulls are written as ``null``."""
    line = tab_line(*(columns or df.columns)).alias("value")
    return write_lines(df.select(line), path, gzip=gzip)


def write_tsv_with_header(df: DataFrame, path: str, null_token: str = "null") -> str:
    (df.write.option("sep", "\t").option("quote", "").option("header", True)
     .option("nullValue", null_token).csv(path))
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_many(shared: DataFrame, outputs: Mapping[str, object]) -> list[str]:
    """Several outputs of one frame: path -> function of the frame.

    The frame is computed once and written to the shared folder first, so no
    output repeats its work.
    """
    once = saved(shared, "shared")
    return [write_tsv(make(once), path) for path, make in outputs.items()]
