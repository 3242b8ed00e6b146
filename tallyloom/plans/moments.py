"""Queries on event times: parsing, hashtags, trends, bursts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import fields as L
from tallyloom.functions import text as X
from tallyloom.operators import bursts as B
from tallyloom.operators import clean as K
from tallyloom.operators import trending as T
from tallyloom.plans.registry import query
from tallyloom.session import read_table, spread

# A record line of seven tab fields per event; some times do not parse.
SQL_RECORDS = r"""SELECT event_id, event_type, ts, CASE WHEN event_id % 97 = 0 THEN 'no time'
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time_text,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS seconds,
    'About #' || event_type || ' and #K' || regexp_extract(props, '\d+') AS text FROM events"""
SQL_LINES = f"""SELECT *, CAST(event_id AS VARCHAR) || chr(9) || time_text || chr(9) || 'a' || chr(9) || 'b'
    || chr(9) || 'c' || chr(9) || 'd' || chr(9) || text AS line FROM ({SQL_RECORDS})"""
SQL_TAGS = f"""SELECT event_id, event_type, seconds, tag, pos FROM (
    SELECT event_id, event_type, seconds, unnest(l) AS tag, unnest(range(1, len(l) + 1)) AS pos FROM (
      SELECT *, regexp_extract_all(lower(text), '#[\\p{{L}}\\p{{N}}_]+') AS l FROM ({SQL_RECORDS})))"""


def record_lines(spark, sf_dir):
    """The events as tab lines, the shape in which records arrive on a topic."""
    time = F.when(F.col("event_id") % 97 == 0, "no time").otherwise(
        F.date_format(F.col("ts").cast("timestamp"), L.TIME_FORMAT))
    text = F.concat(F.lit("About #"), "event_type", F.lit(" and #K"), F.regexp_extract("props", r"(\d+)", 1))
    line = L.tab_line("event_id", time, F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d"), text)
    events = spread(read_table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "props"))
    return events.select("event_id", "event_type", line.alias("line"))


def records(spark, sf_dir):
    """Lines of at least seven fields, with the time in seconds (null if bad) and the text."""
    parts = L.tab_fields(F.col("line"))
    split = X.with_once(record_lines(spark, sf_dir), "_f", parts).where(F.size("_f") >= 7)
    return split.select(
        "event_id", "event_type", "line",
        L.event_seconds(F.get("_f", F.lit(1))).alias("seconds"), F.get("_f", F.lit(6)).alias("text"),
    )


def tags(spark, sf_dir):
    good, _ = K.split_rejected(records(spark, sf_dir), F.col("seconds").isNotNull())
    return T.explode_tags(good, X.hashtags(F.col("text")), ["event_id", "event_type", "seconds"])


@query("parse_event_time", f"SELECT event_id, coalesce(seconds, -1) AS seconds FROM ({SQL_RECORDS})")
def parse_event_time(spark, sf_dir):
    known = F.coalesce("seconds", F.lit(-1).cast("bigint"))
    return records(spark, sf_dir).select("event_id", known.alias("seconds"))


@query("format_event_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text FROM events")
def format_event_time(spark, sf_dir):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return read_table(spark, sf_dir, "events").select("event_id", L.time_text(seconds).alias("time_text"))


@query("reject_bad_rows", f"SELECT event_id, line FROM ({SQL_LINES}) WHERE seconds IS NULL")
def reject_bad_rows(spark, sf_dir):
    _, bad = K.split_rejected(records(spark, sf_dir), F.col("seconds").isNotNull())
    return bad.select("event_id", "line")


@query("tail_fields", f"""SELECT event_id, array_to_string(list_filter(regexp_split_to_array(line, '\\s+'),
    lambda p: p <> '')[7:], ' ') AS tail FROM ({SQL_LINES})""")
def tail_fields(spark, sf_dir):
    return record_lines(spark, sf_dir).select("event_id", X.tail_text(F.col("line"), 6).alias("tail"))


@query("extract_hashtags", f"SELECT event_id, pos, tag FROM ({SQL_TAGS})")
def extract_hashtags(spark, sf_dir):
    found = F.posexplode(X.hashtags(F.col("text"))).alias("pos", "tag")
    return records(spark, sf_dir).select("event_id", found).withColumn("pos", F.col("pos").cast("bigint") + 1)


@query("trailing_range_count", """SELECT DISTINCT event_type, bucket, count(*) OVER (PARTITION BY event_type
      ORDER BY bucket RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS n_window
    FROM (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS bucket FROM events)""")
def trailing_range_count(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_type", "ts")
    buckets = T.bucket_counts(events, "event_type", F.unix_seconds(F.col("ts").cast("timestamp")))
    return T.trailing_counts(buckets, "event_type", 3600)


def sql_sliding(step: int, count: int, width: int, at_messages: bool, k: int = 10) -> str:
    semi = "WHERE snapshot IN (SELECT bucket FROM buckets)" if at_messages else ""
    return f"""WITH tags AS ({SQL_TAGS}), buckets AS (
        SELECT tag, seconds // {step} * {step} AS bucket, count(*) AS n FROM tags
        WHERE seconds IS NOT NULL GROUP BY ALL),
      slid AS (SELECT tag, bucket + age * {step} AS snapshot, n FROM buckets, range({count}) AS r(age)),
      counted AS (SELECT snapshot, tag, CAST(sum(n) AS BIGINT) AS n FROM slid {semi} GROUP BY ALL)
      SELECT snapshot, tag, n, n / {width} AS rate, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY snapshot ORDER BY n DESC, tag) AS rank FROM counted)
      WHERE rank <= {k}"""


@query("trending_topk", sql_sliding(1, 61, 60, True))
def trending_topk(spark, sf_dir):
    return T.trending(T.bucket_counts(tags(spark, sf_dir), "tag", F.col("seconds")), "tag")


@query("trending_windows", sql_sliding(60, 60, 3600, False))
def trending_windows(spark, sf_dir):
    buckets = T.bucket_counts(tags(spark, sf_dir), "tag", F.col("seconds"), 60)
    return T.trending(buckets, "tag", 60, 60, 3600, only_at_messages=False)


@query("trending_growth", f"""WITH tags AS ({SQL_TAGS}), buckets AS (
        SELECT tag, seconds // 60 * 60 AS bucket, count(*) AS n FROM tags WHERE seconds IS NOT NULL GROUP BY ALL),
      slid AS (SELECT tag, bucket + age * 60 AS snapshot, age, n FROM buckets, range(120) AS r(age)),
      both_windows AS (SELECT snapshot, tag, CAST(sum(CASE WHEN age < 60 THEN n ELSE 0 END) AS BIGINT) AS recent,
          CAST(sum(CASE WHEN age >= 60 THEN n ELSE 0 END) AS BIGINT) AS previous
        FROM slid WHERE snapshot IN (SELECT bucket FROM buckets) GROUP BY ALL)
      SELECT *, CASE WHEN previous = 0 THEN CAST('inf' AS DOUBLE) ELSE recent / previous END AS ratio
      FROM both_windows WHERE recent > 0""")
def trending_growth(spark, sf_dir):
    buckets = T.bucket_counts(tags(spark, sf_dir), "tag", F.col("seconds"), 60)
    return T.growth(buckets, "tag", 60, 60)


# Ten records; an event starts within two hours and ends beyond four.
SIZE, START, END = 10, 2 * 3600 * 1_000_000, 4 * 3600 * 1_000_000


def sql_changes(partition: str, events: str = "events", size: int = SIZE, start: int = START, end: int = END) -> str:
    part = f"PARTITION BY {partition}" if partition else ""
    return f"""SELECT * FROM (
      SELECT *, CAST(sum(CASE WHEN kind = 'START' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS event_no FROM (
        SELECT *, CASE WHEN was = 0 AND signal = 1 THEN 'START' WHEN was = 1 AND signal = 0 THEN 'END' END AS kind
        FROM (SELECT *, coalesce(last_value(signal IGNORE NULLS) OVER ({part} ORDER BY us, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS was
          FROM (SELECT *, us - oldest AS gap, CASE WHEN us - oldest <= {start}::BIGINT THEN 1
                  WHEN us - oldest >= {end}::BIGINT THEN 0 END AS signal
            FROM (SELECT event_type, event_id, us, lag(us, {size - 1}) OVER ({part} ORDER BY us, event_id) AS oldest
              FROM (SELECT *, epoch_us(ts) AS us FROM {events})))))
      WINDOW w AS ({part} ORDER BY us, event_id)) WHERE kind IS NOT NULL"""


def _changes(spark, sf_dir, keys):
    us = F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    events = read_table(spark, sf_dir, "events").select("event_type", "event_id", us)
    return B.burst_changes(events, keys, "us", "event_id", SIZE, START, END)


@query("burst_detect", "SELECT event_type, event_no, kind, us, event_id, oldest, gap FROM "
       f"({sql_changes('event_type')})")
def burst_detect(spark, sf_dir):
    return _changes(spark, sf_dir, ["event_type"])


# One stream without a key, with thresholds that the denser stream still crosses.
@query("burst_detect_global", "SELECT event_no, kind, us, event_id, oldest, gap FROM "
       f"({sql_changes('', start=START // 4, end=END // 4)})")
def burst_detect_global(spark, sf_dir):
    us = F.unix_micros(F.col("ts").cast("timestamp")).alias("us")
    events = read_table(spark, sf_dir, "events").select("event_id", us)
    return B.burst_changes(events, [], "us", "event_id", SIZE, START // 4, END // 4)


@query("burst_episodes", f"""SELECT event_type, event_no, max(CASE WHEN kind = 'START' THEN oldest END) AS first_record,
      max(CASE WHEN kind = 'START' THEN us END) AS noticed, coalesce(max(CASE WHEN kind = 'END' THEN us END), -1) AS ended
    FROM ({sql_changes('event_type')}) GROUP BY event_type, event_no""")
def burst_episodes(spark, sf_dir):
    episodes = B.burst_episodes(_changes(spark, sf_dir, ["event_type"]), ["event_type"], "us")
    return episodes.withColumn("ended", F.coalesce("ended", F.lit(-1).cast("bigint")))
