"""Scans of line, tab, fixed-width, block and edge files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.credits import parse_credit
from tallyloom.functions.fields import tab_fields
from tallyloom.functions.text import with_once
from tallyloom.session import broadcast_if_small, saved, spread

# Columns of a raw rating line as name, first and end offset (0-based), type; the
# length of its shortest valid line; and the header lines of the two raw exports.
RATING_FIELDS = (
    ("distribution", 6, 16, "string"),
    ("votes", 17, 25, "int"),
    ("score", 26, 31, "double"),
    ("title", 32, None, "string"),
)
RATING_MIN_LENGTH = 33
RATING_HEADER_LINES = 296
CREDIT_HEADER_LINES = 239


def read_lines(spark: SparkSession, path: str, line_sep: str = "\n") -> DataFrame:
    """One row per line (``value``). Gzip is read by its suffix.

    A gzip file is one partition whatever its size, so a scan of few of them is
    spread before any work on the lines.
    """
    return spread(spark.read.option("lineSep", line_sep).text(path))


def _scan(spark: SparkSession, path: str, line_sep: str) -> DataFrame:
    """value, file, block, row: records with the split they came from and a number that rises along it."""
    return spark.read.option("lineSep", line_sep).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))


def _lines_taken(line_sep: str) -> Column:
    """How many lines of the file a record and its separator make up."""
    if line_sep == "\n":
        return F.lit(1).cast("bigint")
    breaks = F.length("value") - F.length(F.replace("value", F.lit("\n"), F.lit("")))
    return (breaks + line_sep.count("\n")).cast("bigint")


def split_starts(spark: SparkSession, path: str, line_sep: str = "\n") -> DataFrame:
    """file, block, start: the number of the first line of each split of each file.

    One scan counts lines per split, and a running sum over the splits of a file
    places them: a few rows for each file, written to the shared folder.
    """
    sizes = _scan(spark, path, line_sep).groupBy("file", "block").agg(F.sum(_lines_taken(line_sep)).alias("size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return saved(sizes.select("file", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start")), "splits")


def _numbered(scanned: DataFrame, starts: DataFrame, line_sep: str) -> DataFrame:
    """file, line, value of the records of the splits in ``starts``.

    The records are written once, so that nothing is numbered twice; no record
    is sorted across splits.
    """
    kept = saved(scanned.join(broadcast_if_small(starts), ["file", "block"]), "records")
    firsts = kept.groupBy("file", "block").agg(F.min("row").alias("first"))
    placed = kept.join(broadcast_if_small(saved(firsts, "first-rows")), ["file", "block"])
    if line_sep == "\n":
        inside = F.col("row") - F.col("first")
    else:
        before = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(_lines_taken(line_sep)).over(before), F.lit(0))
    return placed.select("file", (F.col("start") + inside).alias("line"), "value")


def numbered_records(spark: SparkSession, path: str, line_sep: str = "\n", before: int | None = None) -> DataFrame:
    """file, line (0-based), value: the records of each file with the number of their first line.

    With ``before`` only records that begin before that line. Splits that lie
    wholly behind it are neither written nor numbered, so what is written
    depends on ``before`` and the size of a split, not on the input. The result
    does not depend on the number of splits, tasks or slots.
    """
    starts = split_starts(spark, path, line_sep)
    if before is not None:
        starts = starts.where(F.col("start") < before)
    numbered = _numbered(_scan(spark, path, line_sep), starts, line_sep)
    return numbered if before is None else numbered.where(F.col("line") < before)


def records_after_header(spark: SparkSession, path: str, skip: int, line_sep: str = "\n") -> DataFrame:
    """value, line: the records of each file that reach beyond its first ``skip`` lines.

    ``line`` is the number of the record's first line where its split holds a
    part of the header, else null: those splits pass through as they are read.
    """
    starts, scanned = split_starts(spark, path, line_sep), _scan(spark, path, line_sep)
    headed = starts.where(F.col("start") < skip)
    behind = scanned.join(broadcast_if_small(headed.select("file", "block")), ["file", "block"], "left_anti")
    first = _numbered(scanned, headed, line_sep).where(F.col("line") + _lines_taken(line_sep) > skip)
    return behind.select("value", F.lit(None).cast("bigint").alias("line")).unionByName(first.select("value", "line"))


def read_lines_after_header(spark: SparkSession, path: str, skip: int) -> DataFrame:
    """Lines of each file without its first ``skip`` ones, however long the header is."""
    return records_after_header(spark, path, skip).select("value")


def head_lines(spark: SparkSession, path: str, k: int | None) -> DataFrame:
    """file, line, value: the first ``k`` lines of each file in file order; None means all, 0 none."""
    return numbered_records(spark, path, before=k)


def tsv_columns(lines: DataFrame, positions: Sequence[int], names: Sequence[str],
                column: str = "value") -> DataFrame:
    """Untyped fields by position; a missing field is null."""
    split = with_once(lines.select(column), "_fields", tab_fields(F.col(column)))
    return split.select(*[F.get("_fields", F.lit(p)).alias(n) for p, n in zip(positions, names, strict=True)])


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False,
             null_token: str | None = None) -> DataFrame:
    """Typed tab-separated files; a value that does not fit its type is null."""
    reader = (spark.read.schema(schema).option("sep", "\t").option("quote", "")
              .option("header", header).option("mode", "PERMISSIVE"))
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    return reader.csv(path)


def fixed_width(lines: DataFrame, fields=RATING_FIELDS, min_length: int = RATING_MIN_LENGTH,
                column: str = "value") -> DataFrame:
    """Columns cut at fixed offsets and trimmed; short lines and lines with a bad number leave."""

    def cut(start: int, end: int | None, kind: str) -> Column:
        width = F.length(column) if end is None else F.lit(end - start)
        text = F.substring(F.col(column), F.lit(start + 1), width)
        return text if kind == "raw" else F.trim(text).try_cast(kind)

    kept = lines.where(F.length(column) >= min_length)
    out = kept.select(*[cut(start, end, kind).alias(name) for name, start, end, kind in fields])
    for name, _, _, kind in fields:
        if kind not in ("string", "raw"):
            out = out.where(F.col(name).isNotNull())
    return out


def rating_entries(lines: DataFrame) -> DataFrame:
    """Raw rating lines with the title parsed to a credit struct."""
    return fixed_width(lines).withColumn("film", parse_credit(F.col("title")))


def read_blocks(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """actor, credit: distinct role lines of blocks that end with a blank line.

    The first line of a block holds the actor, a tab and the first role. The
    first ``skip`` lines of each file are a header, blank lines included.
    """
    # Reading by blank lines keeps a block together without sorting lines.
    if skip:
        headed = records_after_header(spark, path, skip, "\n\n")
        # A block that begins in the header loses the lines that belong to it.
        cut = F.greatest(F.lit(skip) - F.col("line"), F.lit(0)).cast("int")
        parts = F.split("value", "\n")
        left = F.slice(parts, cut + 1, F.greatest(F.size(parts) - cut, F.lit(0)))
        blocks = spread(headed.select(F.when(F.col("line") < skip, F.array_join(left, "\n")).otherwise(F.col("value")).alias("value")))
    else:
        blocks = spread(spark.read.option("lineSep", "\n\n").text(path))
    lines = F.filter(F.split(F.col("value"), "\n"), lambda x: F.trim(x) != "")
    split = with_once(blocks, "_l", lines).where(F.size("_l") > 0)
    actor = F.trim(F.substring_index(F.get("_l", F.lit(0)), "\t", 1))
    rows = split.select(actor.alias("actor"), F.posexplode("_l").alias("_pos", "_line"))
    bare = F.when(F.col("_pos") == 0, F.regexp_replace("_line", "^[^\t]*\t?", "")).otherwise(F.col("_line"))
    roles = rows.select("actor", F.regexp_replace(bare, r"^\s+|\s+$", "").alias("credit"))
    return roles.where((F.col("actor") != "") & (F.col("credit") != "")).distinct()


def edges(lines: DataFrame, fail: bool = True, column: str = "value") -> DataFrame:
    """src, dst from the first two tab fields; a shorter line fails the job or is dropped."""
    fields = tab_fields(F.col(column), drop_trailing=True)
    short = F.size(fields) < 2
    if not fail:
        return lines.where(~short).select(F.get(fields, F.lit(0)).alias("src"), F.get(fields, F.lit(1)).alias("dst"))
    message = F.concat(F.lit("edge line with fewer than two fields: "), F.col(column))
    checked = F.when(short, F.raise_error(message)).otherwise(F.get(fields, F.lit(0)))
    return lines.select(checked.alias("src"), F.get(fields, F.lit(1)).alias("dst"))
