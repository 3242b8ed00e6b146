"""Word, n-gram and key counts, their order and their totals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import NON_LETTERS, ngrams
from tallyloom.session import BROADCAST_ROWS, saved

# Buckets of a distinct-count sketch as a power of two: a relative error of about 0.8 %.
SKETCH_BITS = 14


def count_items(df: DataFrame, items: Column, name: str = "word") -> DataFrame:
    """Occurrences of each element of an array column: name, count.

    Counts are combined on the map side, so a word that makes up a third of
    all tokens costs one row per task in the shuffle.
    """
    return df.select(F.explode(items).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("count"))


def top_items(df: DataFrame, items: Column, k: int, name: str = "word") -> DataFrame:
    """The ``k`` most frequent elements of an array column, ties by element: name, count.

    Elements are counted by a hash of eight bytes first, so long ones do not go
    through the shuffle. None occurs more often than its hash: only the elements
    whose hash reaches the k-th count are counted by themselves. Should two of
    them share a hash, the k-th count may turn out lower, and it is done again
    from there. Too many ties to broadcast are counted as they are.
    """
    each = df.select(F.explode(items).alias(name))
    hashes = each.select(F.xxhash64(name).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    repeated = saved(hashes.where("_n > 1"), "repeated")
    found, least = repeated.orderBy(F.col("_n").desc()).limit(k).agg(F.count(F.lit(1)), F.min("_n")).first()
    least = least if found and found == k else 1
    while True:
        reached = repeated.where(F.col("_n") >= least).select("_h")
        if reached.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
            return top_k(count_items(df, items, name), [name], k)
        hit = F.xxhash64(name) == F.col("_h")
        known = each.join(F.broadcast(reached), hit, "left_semi").groupBy(name).agg(F.count(F.lit(1)).alias("count"))
        if least == 1:
            # All other elements occur once, and the first of them by name are enough.
            once = each.join(F.broadcast(reached), hit, "left_anti").orderBy(name).limit(k)
            known = known.unionByName(once.withColumn("count", F.lit(1).cast("bigint")))
        best = saved(top_k(known, [name], k), "top")
        found, lowest = best.agg(F.count(F.lit(1)), F.min("count")).first()
        if least == 1 or (found == k and lowest >= least):
            return top_k(best, [name], k)
        least = lowest if found == k else 1


def count_words(df: DataFrame, text: str, name: str = "word") -> DataFrame:
    """Occurrences of each lower-cased run of letters: name, count."""
    pieces = df.select(F.explode(F.split(text, NON_LETTERS)).alias("_w")).where(F.col("_w") != "")
    return pieces.groupBy(F.lower("_w").alias(name)).agg(F.count(F.lit(1)).alias("count"))


def extract_ngrams(df: DataFrame, keys: Sequence[str], tokens: Column, n: int) -> DataFrame:
    """keys, pos (1-based), ngram. Works inside each row; nothing is shuffled."""
    return df.select(*keys, F.posexplode(ngrams(tokens, n)).alias("pos", "ngram")).withColumn(
        "pos", F.col("pos").cast("bigint") + 1
    )


def totals(counts: DataFrame, count: str = "count") -> DataFrame:
    """One row: all occurrences and distinct items."""
    return counts.agg(
        F.coalesce(F.sum(count), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_items")
    )


def count_sketches(df: DataFrame, part: str, item: str, bits: int = SKETCH_BITS) -> DataFrame:
    """part, total, sketch: occurrences and a sketch of the distinct items of each part.

    A sketch takes a few kilobytes whatever it has seen. Sketches of several
    days or folders are kept and united later, so that distinct items over all
    of them need neither the items nor another scan.
    """
    return df.where(F.col(item).isNotNull()).groupBy(part).agg(
        F.count(F.lit(1)).alias("total"), F.hll_sketch_agg(item, F.lit(bits)).alias("sketch"))


def sketch_totals(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """keys, total, distinct_items of united sketches; the distinct count is an estimate."""
    return sketches.groupBy(*keys).agg(
        F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).cast("bigint").alias("distinct_items"))


def merge_counts(frames: Sequence[DataFrame], key: str, count: str = "count") -> DataFrame:
    """Add count tables up; rows with a null key or count are left out."""
    every = reduce(DataFrame.unionByName, [f.select(key, count) for f in frames])
    kept = every.where(F.col(key).isNotNull() & F.col(count).isNotNull())
    return kept.groupBy(key).agg(F.sum(count).alias(count))


def by_count(df: DataFrame, keys: Sequence[str], count: str = "count", descending: bool = True) -> DataFrame:
    """Total order by count, ties by key."""
    first = F.col(count).desc() if descending else F.col(count).asc()
    return df.orderBy(first, *keys)


def top_k(df: DataFrame, keys: Sequence[str], k: int | None, count: str = "count",
          descending: bool = True) -> DataFrame:
    """The ``k`` first rows of that order; ``None`` is all, 0 is none."""
    ordered = by_count(df, keys, count, descending)
    return ordered if k is None else ordered.limit(k)


def head(df: DataFrame, order: Sequence[str], k: int | None) -> DataFrame:
    """The ``k`` first rows in the given order; ``None`` is all, 0 is none."""
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)


def sort_lines(df: DataFrame, column: str = "value", descending: bool = False) -> DataFrame:
    """All lines in global order, repeats kept.

    A row number breaks ties, so that range partitioning can split a line
    that makes up much of the input over several tasks.
    """
    first = F.col(column).desc() if descending else F.col(column).asc()
    return df.withColumn("_row", F.monotonically_increasing_id()).orderBy(first, "_row").drop("_row")
