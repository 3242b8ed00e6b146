"""Options of topic sources and sinks. They need Spark's Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter


def topic_reader(spark: SparkSession, servers: str, topics: str, from_start: bool = False,
                 max_offsets: int | None = None) -> DataStreamReader:
    """A stream reader on ``topics`` (comma-separated); ``max_offsets`` bounds a micro-batch."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topics)
              .option("startingOffsets", "earliest" if from_start else "latest"))
    return reader if max_offsets is None else reader.option("maxOffsetsPerTrigger", max_offsets)


def as_records(raw: DataFrame) -> DataFrame:
    """key, value, timestamp of a topic as the stream jobs expect them."""
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def topic_writer(records: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """A stream writer that keeps key and value.

    The sink has no column for the record time; it travels in a header.
    """
    time = F.struct(F.lit("event-time").alias("key"), F.col("timestamp").cast("string").cast("binary").alias("value"))
    out = records.select("key", "value", F.array(time).alias("headers"))
    return (out.writeStream.format("kafka").outputMode("append")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("includeHeaders", True).option("checkpointLocation", checkpoint))
