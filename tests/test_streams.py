"""Streams: folders of part files, restarts, state by record, repeated batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tallyloom.functions.text import hashtags
from tallyloom.operators import bursts as B
from tallyloom.plans import streams as P
from tallyloom.session import STATE_STORE, new_path
from tallyloom.streaming import jobs as J
from tallyloom.streaming import sources as S
from tallyloom.streaming.bursts import CHUNK, burst_stream
from tools.check import canonical

NAMES = [n for n in queries() if n.startswith("stream_")]
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The events as one file and as a folder of eight."""
    out = {}
    for files, sf in ((1, "0.01"), (8, "0.01")):
        folder = tmp_path_factory.mktemp(f"events{files}")
        table = spark.read.parquet(f"/root/testdata/sf{sf}/events.parquet")
        if files > 1:
            table.repartition(files).write.parquet(f"{folder}/events.parquet")
            assert len(list(Path(folder, "events.parquet").glob("*.parquet"))) == files
        else:
            Path(folder, "events.parquet").symlink_to(f"/root/testdata/sf{sf}/events.parquet")
        out[files] = str(folder)
    return out


# One file of the smallest size is in test_queries; bursts have rows only here.
@pytest.mark.parametrize("name, files", [*((n, 8) for n in NAMES), ("stream_burst", 1), ("stream_chain", 1)])
def test_stream_equals_sql(spark, folders, name, files):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.01/events.parquet'")
    frame, relation = queries()[name](spark, folders[files]), con.sql(oracle_sql()[name])
    got, want = canonical(frame.columns, frame.collect()), canonical(relation.columns, relation.fetchall())
    assert got == want and sum(got.values()) > 0


@pytest.mark.parametrize("name", ["stream_burst", "stream_chain"])
def test_bursts_run_where_the_session_has_sparks_own_state_store(spark, folders, name):
    own = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, own)
    try:
        assert queries()[name](spark, folders[1]).count() > 0
        assert spark.conf.get(STATE_STORE) == own
    finally:
        spark.conf.set(STATE_STORE, before)


def records(spark, rows):
    return spark.createDataFrame(rows, "tag string, ts timestamp, event_id long")


def made(spark, n=400, seed=4):
    rng, now, rows = random.Random(seed), START, []
    for k in range(n):
        # Dense and sparse stretches take turns.
        now += timedelta(seconds=rng.choice([1, 2, 3] if k // 25 % 2 else [10, 30, 60]))
        rows.append((rng.choice(["a", "b", None]), now, k))
    return records(spark, rows), rows


def detect(stream):
    return burst_stream(stream, "tag", "ts", "event_id", "1 hour", 5, 20 * 10**6, 60 * 10**6, stretch_seconds=45)


def test_bursts_are_the_same_whatever_the_arrivals(spark):
    frame, rows = made(spark)
    closing = S.closing_row(frame, "ts", timedelta(hours=2), tag="end")
    batch = frame.select("tag", "event_id", F.unix_micros("ts").alias("us"))
    want = sorted(map(str, B.burst_changes(batch, ["tag"], "us", "event_id", 5, 20 * 10**6, 60 * 10**6).select(
        "tag", "event_no", "kind", "us", "event_id", "oldest", "gap").collect()))
    assert len(want) > 20
    # All at once, in time order with a stop after each arrival, and out of order within the delay.
    mixed = [frame.where(F.pmod("event_id", F.lit(2)) == 0).where("event_id < 150"), frame.where("event_id < 150 and event_id % 2 = 1"),
             frame.where("event_id >= 150").repartition(6)]
    for frames in ([frame], S.time_slices(frame, "ts", 3), mixed):
        sink, stream = S.arrivals([*frames, closing], detect, "any")
        assert sorted(map(str, sink.rows(stream).collect())) == want


def test_a_million_waiting_records_grow_no_row_of_state(spark):
    """All records of one key wait; a row of state holds at most CHUNK of them, and a later batch rewrites none."""
    total = 1_000_000
    frames = [spark.range(k * total // 2, (k + 1) * total // 2).select(
        F.lit("one").alias("tag"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 500).alias("ts"), F.col("id").alias("event_id"))
        for k in range(2)]
    sink, stream = S.arrivals(frames, lambda s: burst_stream(s, "tag", "ts", "event_id", "1 hour", stretch_seconds=60), "million")
    state = S.kept_state(spark, sink.checkpoint, stateVarName="waiting")
    value = [c for c in state.columns if "value" in c][0]
    widths = state.select(F.octet_length(F.col(f"{value}.records")).alias("w")).agg(F.max("w"), F.sum("w"), F.count("*")).first()
    assert widths[0] <= 16 * CHUNK and widths[1] == 16 * total and widths[2] >= total // CHUNK
    assert sink.rows(stream).count() == 0


def test_a_stopped_stream_goes_on_where_it_was(spark):
    """Keyword filter and late-data windows: one run over all arrivals equals a stop after each of them."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    slices = S.time_slices(events, "ts", 4)
    closing = S.closing_row(events, "ts", timedelta(days=3))

    def kept(stream):
        return J.keyword_records(P._records(stream), P.WORDS).select("key", "value")

    for build in (kept, P._late_counts):
        sink, stream = S.arrivals([*slices, closing], build, "parts")
        whole, all_ = S.arrivals([events, closing], build, "whole")
        rows = sorted(map(str, sink.rows(stream).collect()))
        assert rows == sorted(map(str, whole.rows(all_).collect())) and rows


def test_a_repeated_batch_changes_nothing(spark):
    rng, rows = random.Random(1), []
    for k in range(600):
        rows.append((f"#t{rng.randrange(15)} x", START + timedelta(seconds=k // 3)))
    frame = spark.createDataFrame(rows, "value string, timestamp timestamp")
    table = J.TopTable(new_path(spark, "again"), count=11, window_seconds=10, k=3)
    batches = []

    def build(stream):
        timed = stream.withWatermark("timestamp", "5 seconds")
        return J.step_counts(timed.select("timestamp", F.explode(hashtags(F.col("value"))).alias("tag")), "tag", "timestamp", "1 second")

    folder, checkpoint = new_path(spark, "again-in"), new_path(spark, "again-checkpoint")
    counts = None
    for part in [*S.time_slices(frame, "timestamp", 3), S.closing_row(frame, "timestamp", timedelta(minutes=5))]:
        part.write.mode("append").parquet(folder)
        counts = build(spark.readStream.schema(frame.schema).parquet(folder)) if counts is None else counts
        writer = counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(
            # Every batch comes twice, as after a failure between the write and the commit.
            lambda batch, number: (table.merge(batch, number), table.merge(batch, number), batches.append(number)))
        S.run_all(writer)
    seconds = [(t, (w - START).seconds) for t, w in ((r[0].split()[0], r[1]) for r in rows)]
    base = int(START.timestamp()) if START.tzinfo else int((START - datetime(1970, 1, 1)).total_seconds())
    want = set()
    for s in sorted({s for _, s in seconds}):
        n = {}
        for tag, at in seconds:
            if s - 10 <= at <= s:
                n[tag] = n.get(tag, 0) + 1
        for rank, (count, tag) in enumerate(sorted((-c, t) for t, c in n.items())[:3], 1):
            want.add((base + s, tag, -count, rank, -count / 10))
    got = [tuple(r) for r in table.rows(spark).select("snapshot", "tag", "n", "rank", "rate").collect()]
    assert len(got) == len(set(got)) == len(want) and len(batches) > 3
    assert {(a - got[0][0], *b) for a, *b in got} == {(a - got[0][0] + shift, *b) for a, *b in want for shift in (min(x[0] for x in got) - base,)}


def test_a_closing_row_of_nothing(spark):
    empty, _ = made(spark, 1)
    row = S.closing_row(empty.limit(0), "ts", timedelta(hours=1), tag="x").first()
    assert row["ts"] is None and row["tag"] == "x"
    assert S.time_slices(empty.limit(0), "ts", 3)[0].count() == 0
