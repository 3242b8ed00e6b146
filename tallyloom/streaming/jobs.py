"""Stream forms of the keyword filter, the trending counts and the late-data count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallyloom.functions.text import QUAKE_WORDS, contains_any
from tallyloom.operators import trending as T


def keyword_records(records: DataFrame, keywords: Sequence[str] = QUAKE_WORDS) -> DataFrame:
    """Records (key, value, timestamp) whose value holds any keyword."""
    return records.where(contains_any(F.col("value"), keywords))


def route(records: DataFrame, path: str, checkpoint: str, keywords: Sequence[str] = QUAKE_WORDS,
          every: str = "1 second") -> DataStreamWriter:
    """Keep filtered records flowing to a file sink with key, value and time.

    The sink's log names the files of each finished batch. A stream that reads
    the folder reads that log, so it sees every record once, whatever failed
    and was repeated here.
    """
    kept = keyword_records(records, keywords).select("key", "value", "timestamp")
    return (kept.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(processingTime=every))


def step_counts(tagged: DataFrame, tag: str, time: str, step: str) -> DataFrame:
    """step, tag, n: records per tag and step. ``time`` has its watermark already."""
    return tagged.groupBy(F.window(time, step).alias("step"), tag).agg(F.count(F.lit(1)).alias("n"))


def sliding_counts(tagged: DataFrame, tag: str, time: str, width: str, step: str) -> DataFrame:
    """window, tag, n over sliding windows, each emitted once the watermark has passed it.

    Records are counted per tag and step first. Only those counts are copied to
    the windows they fall in, so a busy tag costs one row per step.
    """
    at = F.window_time("step").alias("at")
    return (step_counts(tagged, tag, time, step).select(at, tag, "n")
            .groupBy(F.window("at", width, step).alias("window"), tag)
            .agg(F.sum("n").alias("n")))


class TopTable:
    """The top ``k`` tags of each trailing window, kept in a folder while a stream goes on.

    A batch brings the counts of steps that the watermark has passed, every tag
    of a step in one batch. They are written under the number of the batch, and
    so is the top of each of their steps, taken together with the counts of the
    window before them. A batch that is repeated after a failure writes the same
    rows over its own, so nothing counts twice.
    """

    def __init__(self, folder: str, tag: str = "tag", step: int = T.STEP_SECONDS, count: int = T.WINDOW_SECONDS + 1,
                 window_seconds: int = T.WINDOW_SECONDS, k: int = T.TOP) -> None:
        self.folder, self.tag, self.step, self.count, self.window_seconds, self.k = folder, tag, step, count, window_seconds, k

    def merge(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = f"{self.folder}/counts/batch={number}"
        batch.select(self.tag, F.unix_seconds("step.start").alias("bucket"), "n").write.mode("overwrite").parquet(own)
        fresh = spark.read.parquet(own)
        low = fresh.agg(F.min("bucket")).first()[0]
        if low is None:
            return
        known = spark.read.schema(f"{fresh.schema.simpleString()[7:-1].replace(':', ' ')}, batch bigint").parquet(f"{self.folder}/counts")
        # Parquet statistics skip the files of all but the last window.
        near = known.where((F.col("batch") <= number) & (F.col("bucket") > low - self.step * self.count)).select(self.tag, "bucket", "n")
        counts = T.sliding_counts(near, self.tag, self.step, self.count, only_at_messages=True).where(F.col("snapshot") >= low)
        top = T.top_per(counts, "snapshot", self.tag, self.k).withColumn("rate", F.col("n") / F.lit(self.window_seconds))
        top.write.mode("overwrite").parquet(f"{self.folder}/top/batch={number}")

    def writer(self, counts: DataFrame, checkpoint: str, every: str = "1 second") -> DataStreamWriter:
        """``counts`` is a stream of ``step_counts``; a batch every ``every``."""
        return (counts.writeStream.outputMode("append").foreachBatch(self.merge)
                .option("checkpointLocation", checkpoint).trigger(processingTime=every))

    def rows(self, spark) -> DataFrame:
        """snapshot, tag, n, rank, rate of all batches so far."""
        return spark.read.parquet(f"{self.folder}/top").drop("batch")


def window_counts(records: DataFrame, time: str, width: str, delay: str) -> DataFrame:
    """window, n over tumbling windows; rows later than ``delay`` are left out.

    A record counts unless its window had ended before the watermark of the
    batch before it. Without a bound on lateness state could never be dropped.
    """
    return (records.withWatermark(time, delay).groupBy(F.window(time, width).alias("window"))
            .agg(F.count(F.lit(1)).alias("n")))
