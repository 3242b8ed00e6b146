"""Pairs of items that occur in the same group, counted over all groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import broadcast_if_small, saved, small_tasks

# Distinct items of one group that one task may pair with each other.
HOT_CAST = 2_000


def _members(df: DataFrame, group: str, item: str, dedup: bool) -> DataFrame:
    """Distinct (group, item) with the number of listings as ``w``."""
    listed = df.where(F.col(group).isNotNull() & F.col(item).isNotNull())
    weight = F.lit(1).cast("bigint") if dedup else F.count(F.lit(1))
    return listed.groupBy(F.col(group).alias("g"), F.col(item).alias("x")).agg(weight.alias("w"))


def pair_counts(df: DataFrame, group: str, item: str, dedup: bool = True, min_count: int = 1,
                hot_cast: int = HOT_CAST) -> DataFrame:
    """Columns a, b, count with a < b, for pairs that share at least ``min_count``.

    With ``dedup`` an item listed twice in a group counts once; without, every
    combination of listings counts. Listings are collapsed to a weight before
    any pairing, so repeats never multiply rows.

    Groups of more than ``hot_cast`` distinct items are never paired inside one
    task: their items are spread over blocks, and two blocks meet in one cell.
    With ``min_count`` above 1, items in too few groups leave first, and while
    fewer groups are that large than ``min_count`` their pairs are not formed:
    a pair that reaches the floor must also meet in some smaller group, so the
    large groups only add to the pairs found there.
    """
    with small_tasks(df.sparkSession, df.count()):
        return saved(_pair_counts(df, group, item, dedup, min_count, hot_cast), "pair-counts")


def _pair_counts(df: DataFrame, group: str, item: str, dedup: bool, min_count: int, hot_cast: int) -> DataFrame:
    members = _members(df, group, item, dedup)
    if dedup and min_count > 1:
        # An item of fewer than min_count groups is in no pair that reaches the floor.
        members = saved(members, "members")
        frequent = members.groupBy("x").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_count)
        members = members.join(frequent.select("x"), "x", "left_semi")
    members = saved(members, "members")
    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > hot_cast)
    n_hot = sizes.count()
    if n_hot == 0:
        return _counted(_paired(members, ["g"]), min_count)
    hot = saved(sizes.select("g", F.ceil(F.col("_size") / hot_cast).alias("_blocks")), "hot-casts")
    marks = broadcast_if_small(hot)
    usual = members.join(marks, "g", "left_anti")
    large = members.join(marks, "g")
    if dedup and n_hot < min_count:
        return _counted(_with_large(usual, large), min_count)
    cells = large.withColumn("_at", F.pmod(F.xxhash64("x"), F.col("_blocks")))
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    left = cells.select("g", "x", "w", F.col("_at").alias("_row"), others.alias("_col"))
    right = cells.select("g", "x", "w", others.alias("_row"), F.col("_at").alias("_col"))
    spread = _paired(left, ["g", "_row", "_col"], right)
    return _counted(_paired(usual, ["g"]).unionByName(spread), min_count)


def top_pairs(df: DataFrame, group: str, item: str, k: int, hot_cast: int = HOT_CAST, step: int = 4) -> DataFrame:
    """a, b, count: the ``k`` pairs that share the most groups, ties by (a, b), without counting all pairs.

    No pair shares more groups than its rarer item is in. Items are taken by
    that support: first those within ``step`` of the largest, then down to a
    ``step``-th of that, and so on. As soon as the k-th best count found is not
    below the support taken so far, no other pair can reach it, and the pairs
    found are the answer. Once k pairs are known, the next round asks only for
    pairs of at least the k-th count among items of at least that support.
    """
    if k < 1:
        return pair_counts(df.limit(0), group, item)
    with small_tasks(df.sparkSession, df.count()):
        return _top_pairs(df, group, item, k, hot_cast, step)


def _top_pairs(df: DataFrame, group: str, item: str, k: int, hot_cast: int, step: int) -> DataFrame:
    members = saved(_members(df, group, item, True), "members")
    support = saved(members.groupBy("x").agg(F.count(F.lit(1)).alias("_n")), "supports")
    taken = support.agg(F.max("_n")).first()[0]
    floor = 1
    while True:
        taken = max((taken or 1) // step, floor)
        near = members.join(support.where(F.col("_n") >= taken).select("x"), "x", "left_semi")
        best = _pair_counts(near, "g", "x", True, floor, hot_cast).orderBy(F.col("count").desc(), "a", "b").limit(k)
        best = saved(best, "best-pairs")
        found, least = best.agg(F.count(F.lit(1)), F.min("count")).first()
        if found == k:
            floor = least
        if taken <= floor:
            return best.orderBy(F.col("count").desc(), "a", "b")


def _paired(left: DataFrame, on: list[str], right: DataFrame | None = None) -> DataFrame:
    right = left if right is None else right
    a = left.select(*on, F.col("x").alias("a"), F.col("w").alias("wa"))
    b = right.select(*on, F.col("x").alias("b"), F.col("w").alias("wb"))
    joined = a.join(b, on).where(F.col("a") < F.col("b"))
    return joined.select("a", "b", (F.col("wa") * F.col("wb")).alias("n"))


def _with_large(usual: DataFrame, large: DataFrame) -> DataFrame:
    """Pairs met in ordinary groups, plus what the large groups add to them."""
    found = saved(_counted(_paired(usual, ["g"]), 1), "pairs-found")
    in_a = large.select("g", F.col("x").alias("a"))
    in_b = large.select("g", F.col("x").alias("b"))
    # One row per large group that holds a; the number of large groups is below min_count.
    more = found.join(in_a, "a").join(in_b, ["g", "b"]).select("a", "b", F.lit(1).cast("bigint").alias("n"))
    return found.withColumnRenamed("count", "n").unionByName(more)


def _counted(pairs: DataFrame, min_count: int) -> DataFrame:
    counted = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counted if min_count <= 1 else counted.where(F.col("count") >= min_count)


def count_pairs(pairs: DataFrame, count: str | None = None) -> DataFrame:
    """Add up given pairs (a, b); a count column is used where it is not null."""
    n = F.lit(1) if count is None else F.coalesce(F.col(count), F.lit(1))
    return pairs.groupBy("a", "b").agg(F.sum(n.cast("bigint")).alias("count"))
