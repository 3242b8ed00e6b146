"""Streams over the events, run to their end and compared with what a batch job gives."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tallyloom.functions.text import hashtags
from tallyloom.operators import bursts as B
from tallyloom.operators import trending as T
from tallyloom.plans.moments import END, SIZE, START, sql_changes
from tallyloom.plans.registry import query
from tallyloom.session import new_path, read_table, state_by_record
from tallyloom.streaming import jobs as J
from tallyloom.streaming import sources as S
from tallyloom.streaming.bursts import burst_stream

DAY = 86_400
WORDS = ("#PURCHASE", "#k42")
SQL_TEXT = r"'Saw #' || event_type || ' #K' || regexp_extract(props, '\d+')"


def _records(events):
    """Topic-shaped records: key, value, timestamp. A null kind of event gives a null text."""
    text = F.concat(F.lit("Saw #"), "event_type", F.lit(" #K"), F.regexp_extract("props", r"(\d+)", 1))
    return events.select(F.col("event_id").cast("string").alias("key"), text.alias("value"),
                         F.col("ts").cast("timestamp").alias("timestamp"))


def _event_stream(spark, sf_dir):
    return S.table_stream(spark, sf_dir, "events", read_table(spark, sf_dir, "events").schema)


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _then_closing(spark, sf_dir, horizon, **values):
    """The events as a stream of their files, joined by a folder in which the closing row arrives; and how to let it arrive."""
    table = read_table(spark, sf_dir, "events")
    folder = new_path(spark, "closing")
    table.limit(0).write.parquet(folder)
    stream = _event_stream(spark, sf_dir).unionByName(spark.readStream.schema(table.schema).parquet(folder))
    row = S.closing_row(table, "ts", horizon, **values)
    return stream, lambda: row.write.mode("append").parquet(folder)


@query("stream_source_files", "SELECT event_id, event_type, user_id FROM events")
def stream_source_files(spark, sf_dir):
    """Six arrivals in time order; the query stops after each and goes on from its checkpoint."""
    slices = S.time_slices(_events(spark, sf_dir), "ts", 6)
    sink, stream = S.arrivals(slices, lambda s: s.select("event_id", "event_type", "user_id"), "replayed")
    return sink.rows(stream)


SQL_KEPT = f"""SELECT CAST(event_id AS VARCHAR) AS key, {SQL_TEXT} AS value, epoch_us(ts) AS us FROM events
    WHERE contains(lower({SQL_TEXT}), '#purchase') OR contains(lower({SQL_TEXT}), '#k42')"""


@query("stream_keyword_filter", f"SELECT key, value FROM ({SQL_KEPT})")
def stream_keyword_filter(spark, sf_dir):
    kept = J.keyword_records(_records(_event_stream(spark, sf_dir)), WORDS)
    return S.run_to_end(kept.select("key", "value"), "kept")


@query("stream_filter_route", SQL_KEPT)
def stream_filter_route(spark, sf_dir):
    path, checkpoint = new_path(spark, "routed"), new_path(spark, "routed-checkpoint")
    records = _records(_event_stream(spark, sf_dir))
    run = J.route(records, path, checkpoint, WORDS).trigger(availableNow=True).start()
    run.awaitTermination()
    routed = spark.read.parquet(path)
    return routed.select("key", "value", F.unix_micros("timestamp").alias("us"))


@query("stream_burst", f"SELECT event_type, event_no, kind, us, event_id, oldest, gap FROM ({sql_changes('event_type')})")
def stream_burst(spark, sf_dir):
    """All changes: a closing row lets the watermark pass the last event."""
    events = _events(spark, sf_dir).select("event_type", "ts", "event_id")
    frames = [*S.time_slices(events, "ts", 6), S.closing_row(events, "ts", timedelta(hours=8))]
    with state_by_record(spark):
        sink, stream = S.arrivals(frames, lambda s: burst_stream(
            s, "event_type", "ts", "event_id", "6 hours", SIZE, START, END, stretch_seconds=3600), "bursts")
    return sink.rows(stream)


# Fifty records in fifty seconds need a denser stream: time runs a thousand times faster.
SPEED = 1000
SQL_FAST = f"""(SELECT event_id, regexp_extract(lower({SQL_TEXT}), '#[a-z]+') AS event_type,
    make_timestamp(first + (epoch_us(ts) - first) // {SPEED}) AS ts FROM events, (SELECT min(epoch_us(ts)) AS first FROM events)
    WHERE contains(lower({SQL_TEXT}), '#purchase') OR contains(lower({SQL_TEXT}), '#k42'))"""


@query("stream_chain", f"""SELECT event_type AS tag, event_no, kind, us, event_id, oldest, gap FROM (
    {sql_changes('event_type', SQL_FAST, B.BURST_SIZE, B.START_GAP, B.END_GAP)})""")
def stream_chain(spark, sf_dir):
    """Filter, sink and detector: the detector reads what the filter's sink has committed.

    Fifty records, fifty seconds to start and a hundred to end, on a stream that
    runs a thousand times faster than the events.
    """
    stream, close = _then_closing(spark, sf_dir, timedelta(days=30), event_type="closing #PURCHASE", props="0")
    first = read_table(spark, sf_dir, "events").agg(F.unix_micros(F.min(F.col("ts").cast("timestamp")))).first()[0]
    records = _records(stream)
    if first is not None:
        fast = F.lit(first) + F.floor((F.unix_micros("timestamp") - first) / SPEED)
        records = records.withColumn("timestamp", F.timestamp_micros(fast))
    routed = S.FileSink(spark, "chain")
    kept = J.route(records, routed.path, routed.checkpoint, WORDS)
    S.run_all(kept)
    close()
    S.run_all(kept)
    # Reading a sink's folder as a stream reads its commit log, not its files.
    committed = spark.readStream.schema("key string, value string, timestamp timestamp").parquet(routed.path)
    tagged = committed.select(F.regexp_extract(F.lower("value"), "#([a-z]+)", 0).alias("tag"), "timestamp",
                              F.col("key").cast("bigint").alias("event_id"))
    with state_by_record(spark):
        return S.run_to_end(burst_stream(tagged, "tag", "timestamp", "event_id", "10 seconds"), "chain-bursts")


SQL_STEPS = f"""SELECT tag, CAST(floor(epoch(ts)) AS BIGINT) // 300 * 300 AS bucket, count(*) AS n
    FROM (SELECT ts, unnest(regexp_extract_all(lower({SQL_TEXT}), '#[\\p{{L}}\\p{{N}}_]+')) AS tag FROM events)
    GROUP BY ALL"""


@query("stream_trending", f"""SELECT window_start, tag, n, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, tag) AS rank FROM (
      SELECT bucket + age * 300 - 3300 AS window_start, tag, CAST(sum(n) AS BIGINT) AS n
      FROM ({SQL_STEPS}), range(12) AS r(age) GROUP BY ALL)) WHERE rank <= 10""")
def stream_trending(spark, sf_dir):
    """Top ten per hour-long window that moves by five minutes, the last windows too."""
    stream, close = _then_closing(spark, sf_dir, timedelta(hours=2))
    timed = _records(stream).withWatermark("timestamp", "10 minutes")
    tagged = timed.select("timestamp", F.explode(hashtags(F.col("value"))).alias("tag"))
    counts = J.sliding_counts(tagged, "tag", "timestamp", "1 hour", "5 minutes")
    flat = counts.select(F.unix_seconds("window.start").alias("window_start"), "tag", "n")
    sink = S.FileSink(spark, "trends")
    sink.take(flat)
    close()
    sink.take(flat)
    return T.top_per(sink.rows(flat), "window_start", "tag")


SQL_SECONDS = SQL_STEPS.replace("// 300 * 300", "")


@query("stream_trending_top", f"""WITH buckets AS ({SQL_SECONDS}),
    counted AS (SELECT bucket + age AS snapshot, tag, CAST(sum(n) AS BIGINT) AS n FROM buckets, range(61) AS r(age)
      WHERE bucket + age IN (SELECT bucket FROM buckets) GROUP BY ALL)
    SELECT snapshot, tag, n, CAST(rank AS INTEGER) AS rank, n / 60 AS rate FROM (
      SELECT *, row_number() OVER (PARTITION BY snapshot ORDER BY n DESC, tag) AS rank FROM counted) WHERE rank <= 10""")
def stream_trending_top(spark, sf_dir):
    """The top ten of the last minute, every second, kept up to date batch by batch while the stream runs."""
    events = _events(spark, sf_dir).select("event_id", "event_type", "ts", "props")
    table, checkpoint = J.TopTable(new_path(spark, "top")), new_path(spark, "top-checkpoint")
    folder, counts = new_path(spark, "top-arrivals"), None
    for frame in [*S.time_slices(events, "ts", 3), S.closing_row(events, "ts", timedelta(hours=1))]:
        frame.write.mode("append").parquet(folder)
        if counts is None:
            timed = _records(spark.readStream.schema(frame.schema).parquet(folder)).withWatermark("timestamp", "10 minutes")
            counts = J.step_counts(timed.select("timestamp", F.explode(hashtags(F.col("value"))).alias("tag")), "tag", "timestamp", "1 second")
        S.run_all(table.writer(counts, checkpoint))
    return table.rows(spark)


# One event in ten arrives six days late; arrivals come in files of five days.
SQL_ARRIVALS = f"""SELECT *, (CAST(floor(epoch(ts)) AS BIGINT) - (SELECT min(CAST(floor(epoch(ts)) AS BIGINT)) FROM events)
    + CASE WHEN event_id % 10 = 0 THEN {6 * DAY} ELSE 0 END) // {5 * DAY} AS file FROM events"""
SQL_WATERMARKS = f"""SELECT file, coalesce(max(top) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - {DAY * 1000}, 0) AS late_mark FROM (SELECT file, max(epoch_ms(ts)) AS top FROM ({SQL_ARRIVALS}) GROUP BY file)"""
SQL_IN_TIME = f"""SELECT CAST(floor(epoch(ts)) AS BIGINT) // 21600 * 21600 AS window_start, count(*) AS n
    FROM ({SQL_ARRIVALS}) JOIN ({SQL_WATERMARKS}) USING (file)
    WHERE (CAST(floor(epoch(ts)) AS BIGINT) // 21600 * 21600 + 21600) * 1000 > late_mark GROUP BY window_start"""


def _late_arrivals(spark, sf_dir):
    """The events in arrivals of five days, one event in ten six days late."""
    events = _events(spark, sf_dir)
    seconds = F.unix_seconds("ts")
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    if first is None:
        return [events]
    late = F.when(F.col("event_id") % 10 == 0, 6 * DAY).otherwise(0)
    number = F.floor((seconds - F.lit(first) + late) / (5 * DAY))
    # Of each arrival the scan reads only its own days and those six days before.
    reach = lambda k: seconds.between(first + (5 * k - 6) * DAY, first + 5 * (k + 1) * DAY)
    return [events.where(reach(k) & (number == k)) for k in range((last - first + 6 * DAY) // (5 * DAY) + 1)]


def _late_counts(stream):
    counts = J.window_counts(stream, "ts", "6 hours", "1 day")
    return counts.select(F.unix_seconds("window.start").alias("window_start"), "n")


@query("stream_late_data", SQL_IN_TIME)
def stream_late_data(spark, sf_dir):
    closing = S.closing_row(_events(spark, sf_dir), "ts", timedelta(days=2))
    sink, stream = S.arrivals([*_late_arrivals(spark, sf_dir), closing], _late_counts, "late-counts")
    return sink.rows(stream)


@query("stream_open_windows", f"""SELECT window_start, n FROM ({SQL_IN_TIME})
    WHERE (window_start + 21600) * 1000 > (SELECT max(epoch_ms(ts)) FROM events) - {DAY * 1000}""")
def stream_open_windows(spark, sf_dir):
    """Counts that the stopped stream still holds: windows that the watermark has not passed."""
    sink, _ = S.arrivals(_late_arrivals(spark, sf_dir), _late_counts, "open-counts")
    state = S.kept_state(spark, sink.checkpoint)
    return state.select(F.unix_seconds("key.window.start").alias("window_start"), F.col("value.count").alias("n"))
