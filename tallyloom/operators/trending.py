"""Counts of tags over trailing and sliding time windows, and the top of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.ordered import HOT_ROWS, OrderedRows
from tallyloom.session import saved

# Window and step in seconds, entries shown.
WINDOW_SECONDS = 60
STEP_SECONDS = 1
TOP = 10
DAY_SECONDS = 86_400


def bucket_counts(df: DataFrame, tag: str, seconds: Column, step: int = STEP_SECONDS) -> DataFrame:
    """tag, bucket, n: records per tag and time bucket of ``step`` seconds.

    Everything below works on these counts; a tag that makes up much of the
    stream has one row per bucket here, however many records it has.
    """
    bucket = (F.floor(seconds / step) * step).cast("bigint")
    return df.groupBy(tag, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def trailing_counts(buckets: DataFrame, tag: str, width: int = WINDOW_SECONDS,
                    chunk: int = DAY_SECONDS) -> DataFrame:
    """tag, bucket, n_window: records of the tag in [bucket - width, bucket], both ends included.

    Time is cut into chunks and the last ``width`` seconds of a chunk are also
    handed to the next one, so the rows one task sorts are bounded by the chunk.
    """
    chunk = max(chunk, width + 1)
    home = F.floor(F.col("bucket") / chunk)
    reaches_next = F.pmod("bucket", F.lit(chunk)) >= chunk - width
    homes = F.when(reaches_next, F.array(home, home + 1)).otherwise(F.array(home))
    copies = buckets.withColumn("_home", home).withColumn("_chunk", F.explode(homes))
    frame = Window.partitionBy(tag, "_chunk").orderBy("bucket").rangeBetween(-width, 0)
    counted = copies.withColumn("n_window", F.sum("n").over(frame))
    return counted.where(F.col("_chunk") == F.col("_home")).select(tag, "bucket", "n_window")


def _levels(buckets: DataFrame, tag: str, changes: Sequence[tuple[int, Sequence[int]]],
            hot_rows: int = HOT_ROWS) -> DataFrame:
    """tag, start, stop, v0, v1, ..: the values of each tag from ``start`` up to (not including) ``stop``.

    ``changes`` lists what a bucket does some seconds after it: an offset and,
    for each value, how many times the bucket's count is added. A bucket is one
    row per change (one when it enters a window, one when it leaves), and an
    ordered running sum per tag gives the values in between. ``buckets`` is saved.
    """
    width = len(changes[0][1])
    rows = F.array(*[F.struct((F.col("bucket") + offset).alias("start"), F.lit(place).alias("change"),
                              *[(F.col("n") * times).cast("bigint").alias(f"d{k}") for k, times in enumerate(signs)])
                     for place, (offset, signs) in enumerate(changes)])
    moves = buckets.select(tag, F.explode(rows).alias("_m")).select(tag, "_m.*")
    # A tag has at most one bucket at a time, so time and kind of change name a row.
    ordered = OrderedRows.of(moves, [tag], ["start", "change"], hot_rows)
    for k in range(width):
        ordered = ordered.running_sum(F.col(f"d{k}"), f"v{k}")
    values = [f"v{k}" for k in range(width)]
    # After its last change a tag counts nothing.
    return ordered.lag("start", -1, "stop").rows().where("stop > start and v0 > 0").select(tag, "start", "stop", *values)


def _at_snapshots(levels: DataFrame, buckets: DataFrame, tag: str, step: int, span: int, only_at_messages: bool) -> DataFrame:
    """``levels`` at each snapshot: snapshot, tag and the values.

    A stretch in which a tag counts is no longer than ``span``. With
    ``only_at_messages`` the snapshots are the times at which any tag has a
    bucket; levels meet them by stretches of time as long as the window, at
    most two per level, and no count follows, so that adaptive execution may
    split a busy stretch.
    """
    values = [c for c in levels.columns if c not in (tag, "start", "stop")]
    if not only_at_messages:
        every = F.explode(F.sequence("start", F.col("stop") - step, F.lit(step).cast("bigint"))).alias("snapshot")
        return levels.select(every, tag, *values)
    moments = buckets.select(F.col("bucket").alias("snapshot")).distinct().withColumn("_stretch", F.floor(F.col("snapshot") / span))
    stretches = F.sequence(F.floor(F.col("start") / span), F.floor((F.col("stop") - 1) / span))
    spread = levels.withColumn("_stretch", F.explode(stretches))
    met = spread.join(moments, "_stretch").where((F.col("snapshot") >= F.col("start")) & (F.col("snapshot") < F.col("stop")))
    return met.select("snapshot", tag, *values)


def sliding_counts(buckets: DataFrame, tag: str, step: int = STEP_SECONDS, count: int = WINDOW_SECONDS + 1,
                   only_at_messages: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """snapshot, tag, n: records in the ``count`` buckets that end with the snapshot's.

    ``only_at_messages`` keeps the snapshots at which some record arrived; without
    it there is one per step. The default of 61 one-second buckets is a trailing
    minute with both ends included.
    """
    buckets, span = saved(buckets, "buckets"), step * count
    levels = _levels(buckets, tag, [(0, [1]), (span, [-1])], hot_rows)
    return _at_snapshots(levels, buckets, tag, step, span, only_at_messages).withColumnRenamed("v0", "n")


def top_per(counts: DataFrame, group: str, tag: str, k: int = TOP, n: str = "n") -> DataFrame:
    """The ``k`` largest per group, ties by tag, with their rank.

    The row-number limit is applied before the shuffle too, so a group costs
    at most ``k`` rows per task whatever the number of tags.
    """
    order = Window.partitionBy(group).orderBy(F.col(n).desc(), F.col(tag).asc())
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def trending(buckets: DataFrame, tag: str, step: int = STEP_SECONDS, count: int = WINDOW_SECONDS + 1,
             window_seconds: int = WINDOW_SECONDS, k: int = TOP, only_at_messages: bool = True) -> DataFrame:
    """snapshot, rank, tag, n, rate (records per second of the window)."""
    top = top_per(sliding_counts(buckets, tag, step, count, only_at_messages), "snapshot", tag, k)
    return top.withColumn("rate", F.col("n") / F.lit(window_seconds))


def growth(buckets: DataFrame, tag: str, step: int, count: int, only_at_messages: bool = True,
           hot_rows: int = HOT_ROWS) -> DataFrame:
    """snapshot, tag, recent, previous, ratio: this window against the one before it.

    Tags without a recent record are left out; from nothing the growth is infinite.
    """
    buckets, span = saved(buckets, "buckets"), step * count
    levels = _levels(buckets, tag, [(0, [1, 0]), (span, [-1, 1]), (2 * span, [0, -1])], hot_rows)
    both = _at_snapshots(levels, buckets, tag, step, span, only_at_messages).withColumnsRenamed({"v0": "recent", "v1": "previous"})
    ratio = F.when(F.col("previous") == 0, F.lit(float("inf"))).otherwise(F.col("recent") / F.col("previous"))
    return both.select("snapshot", tag, "recent", "previous", ratio.alias("ratio"))


def explode_tags(df: DataFrame, tags: Column, keep: Sequence[str], name: str = "tag") -> DataFrame:
    return df.select(*keep, F.explode(tags).alias(name))
