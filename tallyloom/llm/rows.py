"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import BROADCAST_ROWS


# Rows of an Arrow batch where a row is a whole text.
BATCH_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df`` as it is; the session sends tasks batches of few rows from now on, unless it has a size of its own.

    Ten thousand rows, Spark's default, may be hundreds of megabytes of text in
    the executor and once more in its Python worker.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH) == "10000":
        conf.set(_BATCH, str(BATCH_ROWS))
    return df


def own_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def field(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and quotes included."""
    return df["`" + name.replace("`", "``") + "`"]


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns under new names; all others, and any clash of names, are left behind."""
    return df.select(*[field(df, source).alias(name) for name, source in wanted.items()])


def lowered(text: Column) -> Column:
    """A text with A-Z lower-cased.

    The bytes are read as Latin-1, so that lower-casing works on single bytes.
    It also moves the first bytes of two-byte and some other characters, but the number of
    bytes that follow still tells them apart: different words stay different.
    """
    return F.lower(F.decode(text.cast("binary"), "ISO-8859-1"))


def text_key(df: DataFrame, ident: str, text: str) -> Column:
    """A key of a row by content: rows that agree in id and text share their result."""
    return F.xxhash64(F.coalesce(field(df, ident).cast("string"), F.lit("\u0000")), F.coalesce(field(df, text), F.lit("\u0000")))


def hinted(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """Broadcast a saved frame of short rows of fixed size when its count keeps it under 12 MB."""
    most = min(BROADCAST_ROWS, 12_000_000 // row_bytes)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
