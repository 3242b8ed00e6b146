"""Streams of files, arrivals one after the other, and running a stream to its end."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallyloom.session import new_path


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType) -> DataFrame:
    """A given table as a stream of its files, be it one file or a folder of part files.

    The path is given as a pattern that matches itself only: a stream takes a
    plain path for a folder, and the files of a pattern for what they are.
    """
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def closing_row(df: DataFrame, time: str, horizon: timedelta, **values: object) -> DataFrame:
    """One row of the shape of ``df``, ``horizon`` later than its newest: nothing but ``time`` and ``values`` is set.

    A stream waits for its watermark, so of a finite input the tail would never
    come out. A last record beyond all delays and windows moves the watermark
    behind everything that is real. No rows give a row without a time.
    """
    newest = df.agg(F.max(time).alias("newest"))
    later = F.col("newest") + F.lit(horizon)
    columns = [later.cast(f.dataType).alias(f.name) if f.name == time else F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
               for f in df.schema]
    return newest.select(*columns)


def run_all(writer: DataStreamWriter) -> None:
    """Process all that is there now, then stop; a later run with the same checkpoint goes on from here."""
    run = writer.trigger(availableNow=True).start()
    run.awaitTermination()


class FileSink:
    """An exactly-once Parquet sink with the checkpoint of the query that fills it."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.path, self.checkpoint = new_path(spark, label), new_path(spark, f"{label}-checkpoint")

    def take(self, stream: DataFrame) -> None:
        run_all(stream.writeStream.format("parquet").outputMode("append")
                .option("path", self.path).option("checkpointLocation", self.checkpoint))

    def rows(self, stream: DataFrame) -> DataFrame:
        return self.spark.read.schema(stream.schema).parquet(self.path)


def run_to_end(stream: DataFrame, label: str) -> DataFrame:
    """Process all that is there, exactly once, into Parquet; return the sink's rows."""
    sink = FileSink(stream.sparkSession, label)
    sink.take(stream)
    return sink.rows(stream)


def arrivals(frames: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame], label: str) -> tuple[FileSink, DataFrame]:
    """Let each frame arrive in a watched folder and be processed before the next one comes.

    A frame is one batch whatever the number of its files, because the query
    takes all new files at once; it then stops and goes on from its checkpoint
    when the next frame has come. Returns the sink and the stream.
    """
    sink, stream, folder = None, None, None
    for frame in frames:
        spark = frame.sparkSession
        folder = folder or new_path(spark, f"{label}-arrivals")
        frame.write.mode("append").parquet(folder)
        stream = stream or build(spark.readStream.schema(frame.schema).parquet(folder))
        sink = sink or FileSink(spark, label)
        sink.take(stream)
    if sink is None:
        raise ValueError("nothing arrives")
    return sink, stream


def time_slices(df: DataFrame, time: str, slices: int) -> list[DataFrame]:
    """``df`` in equal stretches of ``time``; the bounds are pushed down to the scan."""
    low, high = df.agg(F.min(time), F.max(time)).first()
    if low is None:
        return [df]
    width = (high - low) / slices
    bounds = [low + k * width for k in range(slices)]
    return [df.where((F.col(time) >= a) if b is None else (F.col(time) >= a) & (F.col(time) < b))
            for a, b in zip(bounds, [*bounds[1:], None])]


def kept_state(spark: SparkSession, checkpoint: str, **options: str) -> DataFrame:
    """What a stateful query holds at its last checkpoint; ``stateVarName`` names a state of several."""
    return spark.read.format("statestore").options(**options).load(checkpoint)
