"""Sources, sinks, the shared folder, and streams in disorder."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom import session as Z
from tallyloom.operators.bursts import burst_changes
from tallyloom.sources import kafka, readers, writers
from tallyloom.streaming import sources as S
from tallyloom.streaming.bursts import burst_stream


@pytest.fixture
def lines(spark):
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def test_edges_fail_or_drop(spark, lines):
    df = lines("a\tb", "a\tb\tc", "alone")
    assert readers.edges(df, fail=False).count() == 2
    with pytest.raises(Exception, match="fewer than two fields"):
        readers.edges(df).collect()


def test_header_of_every_file_is_skipped(spark, lines, tmp_path):
    for name in ("one", "two"):
        (tmp_path / name).write_text("h1\nh2\n" + "\n".join(f"{name}{i}" for i in range(5)) + "\n")
    got = {r["value"] for r in readers.read_lines_after_header(spark, str(tmp_path), 2).collect()}
    assert got == {f"{n}{i}" for n in ("one", "two") for i in range(5)}


@pytest.mark.parametrize("split", ["64", "128m"])
def test_numbers_and_headers_do_not_depend_on_splits(spark, tmp_path, split):
    """A header far longer than a split, many splits per file, and the same answer with few."""
    for name, n in (("one", 300), ("two", 40)):
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {(r["value"], r["line"]) for r in readers.numbered_records(spark, str(tmp_path)).collect()}
        assert got == {(f"{n} line {i}", i) for n, k in (("one", 300), ("two", 40)) for i in range(k)}
        left = {r["value"] for r in readers.read_lines_after_header(spark, str(tmp_path), 296).collect()}
        assert left == {f"one line {i}" for i in range(296, 300)}
        assert readers.head_lines(spark, str(tmp_path), 3).count() == 6 and readers.head_lines(spark, str(tmp_path), 0).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("split", ["50", "128m"])
def test_blocks_under_a_header(spark, tmp_path, split):
    header = "CRC: 1\n\nName\t\tTitles (1900)\n\n----\tx (1)\n"
    (tmp_path / "b").write_text(header + "Ann\tA (1999)\n\t\t\tB (2000)\n\nBob\tC (2001)\n\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {tuple(r) for r in readers.read_blocks(spark, str(tmp_path), header.count("\n")).collect()}
        assert got == {("Ann", "A (1999)"), ("Ann", "B (2000)"), ("Bob", "C (2001)")}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_fixed_width_leaves_bad_lines_out(spark, lines):
    good = "      0000012345       77   8.4 Some Film (1999)"
    df = lines(good, "", "short", good.replace(" 8.4", " x.4"))
    rows = readers.rating_entries(df).collect()
    assert [(r["distribution"], r["votes"], r["score"], r["film"]["name"]) for r in rows] == [
        ("0000012345", 77, 8.4, "Some Film")]


def test_blocks(spark, tmp_path):
    (tmp_path / "b").write_text("Ann\tA (1999)\n\t\t\tB (2000)\n\t\t\tB (2000)\n\nBob B\t\tC (2001)\n\n")
    got = {tuple(r) for r in readers.read_blocks(spark, str(tmp_path)).collect()}
    assert got == {("Ann", "A (1999)"), ("Ann", "B (2000)"), ("Bob B", "C (2001)")}


def test_bad_values_become_null(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('1\t"x\n?\ty\n')
    rows = readers.read_tsv(spark, str(tmp_path), "n int, s string").orderBy("s").collect()
    assert [tuple(r) for r in rows] == [(1, '"x'), (None, "y")]


def test_sinks_keep_empty_lines(spark, lines):
    path = writers.write_lines(lines("a", "", "b"), Z.new_path(spark, "t"), gzip=True)
    assert sorted(r["value"] for r in readers.read_lines(spark, path).collect()) == ["", "a", "b"]


def test_folder_comes_from_the_session(spark, monkeypatch, tmp_path):
    class Conf:
        def get(self, key, default=None):
            return str(tmp_path) + "/" if key == "spark.checkpoint.dir" else default

    class Context:
        master, applicationId = "spark://cluster:7077", "app-1"

    class Fake:
        conf, sparkContext = Conf(), Context()

    assert Z.shared_folder(Fake()) == str(tmp_path)
    monkeypatch.setattr(Conf, "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError):
        Z.shared_folder(Fake())


def test_broadcast_only_when_small(spark):
    small, big = spark.range(5), spark.range(50)
    plan = lambda df: spark.range(9).join(df, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(Z.broadcast_if_small(small, 10))
    assert "broadcast" not in plan(Z.broadcast_if_small(big, 10))


def test_topic_options_are_accepted(spark):
    reader = kafka.topic_reader(spark, "host:9092", "quakes", from_start=True, max_offsets=10)
    with pytest.raises(Exception, match="(?i)kafka"):
        reader.load()


def test_burst_stream_does_not_depend_on_file_order(spark):
    base = 1_700_000_000
    rows, now = [], base
    for i in range(400):
        now += 5 if (i // 40) % 2 else 60
        rows.append(("a" if i % 3 else "b", now, i))
    df = spark.createDataFrame(rows, "k string, s bigint, id bigint").withColumn("ts", F.timestamp_seconds("s"))
    # Every other slice of a hundred comes before the one it follows in time.
    slices = [df.select("k", "ts", "id").where(F.floor(F.col("id") / 100) == n) for n in (1, 0, 3, 2)]
    size, start, end = 10, 200 * 1_000_000, 400 * 1_000_000
    closing = S.closing_row(slices[2], "ts", timedelta(hours=9), k="end")
    sink, stream = S.arrivals([*slices, closing], lambda s: burst_stream(s, "k", "ts", "id", "3 hours", size, start, end, 600), "b")
    got = {tuple(r) for r in sink.rows(stream).collect()}
    batch = burst_changes(df.withColumn("us", F.unix_micros("ts")), ["k"], "us", "id", size, start, end)
    want = {tuple(r) for r in batch.collect()}
    assert got == want and want


def test_what_a_header_writes_does_not_grow_with_the_input(spark, tmp_path, monkeypatch):
    written = []
    plain = readers.saved

    def counted(df, label):
        kept = plain(df, label)
        written.append((label, kept.count()))
        return kept

    monkeypatch.setattr(readers, "saved", counted)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        sizes = []
        for n in (2_000, 20_000):
            (tmp_path / "one").write_text("".join(f"line {i}\n" for i in range(n)))
            written.clear()
            assert readers.read_lines_after_header(spark, str(tmp_path), 296).count() == n - 296
            sizes.append(sum(k for label, k in written if label == "records"))
        assert 296 <= sizes[0] and sizes[1] <= 2 * sizes[0] < 2_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
