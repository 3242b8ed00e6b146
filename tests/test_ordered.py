"""Ordered work in groups: large groups spread over tasks give what one loop gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.bursts import burst_changes, burst_episodes
from tallyloom.operators.ordered import HOT_ROWS, OrderedRows, grouped_lists, row_numbers, run_lengths

LIMITS = [HOT_ROWS, 40]


def _rows(seed=1, n=400):
    """A third of the rows under one key, one null key, ties in time."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.35 else rng.choice(["a", "b", "c", None])
        out.append((key, rng.randrange(0, 200), i, rng.choice(["x", "y", None]), rng.choice([None, None, i])))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(_rows(), "k string, t bigint, id bigint, v string, s bigint").repartition(5)


def _groups():
    groups: dict = {}
    for row in sorted(_rows(), key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("hot", LIMITS)
def test_position_lag_last_known_running_sum(frame, hot):
    got = (OrderedRows.of(frame, ["k"], ["t", "id"], hot).position().lag("id", 3, "lag3")
           .last_known("s", "upto").last_known("s", "before", before=True)
           .running_sum(F.col("t"), "total").rows().collect())
    got = {r["id"]: (r["pos"], r["lag3"], r["upto"], r["before"], r["total"]) for r in got}
    want = {}
    for rows in _groups().values():
        known, total = None, 0
        for i, (_, t, rid, _, s) in enumerate(rows):
            before, known, total = known, s if s is not None else known, total + t
            want[rid] = (i + 1, rows[i - 3][2] if i >= 3 else None, known, before, total)
    assert got == want


@pytest.mark.parametrize("hot", LIMITS)
def test_position_without_keys(frame, hot):
    got = {r["id"]: r["pos"] for r in row_numbers(frame, [], ["t", "id"], hot_rows=hot).collect()}
    order = sorted(_rows(), key=lambda r: (r[1], r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(order)}


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("hot", LIMITS)
def test_run_lengths(frame, hot, keys):
    got = run_lengths(frame, "v", keys, ["t", "id"], hot).collect()
    got = {((r["k"] if keys else None), r["run"]): (r["v"], r["n"]) for r in got}
    want, groups = {}, _groups() if keys else {None: sorted(_rows(), key=lambda r: (r[1], r[2]))}
    for key, rows in groups.items():
        run, n, last = 0, 0, object()
        for row in rows:
            run, n, last = (run, n + 1, last) if row[3] == last else (run + 1, 1, row[3])
            want[(key, run)] = (last, n)
    assert got == want
    assert sum(n for _, n in got.values()) == len(_rows())


@pytest.mark.parametrize("hot", LIMITS)
def test_lists_continue_in_parts(frame, hot):
    got = grouped_lists(frame, ["k"], ["t", "id"], F.col("id"), 10, hot).collect()
    assert all(len(r["items"]) <= 10 for r in got)
    joined: dict = {}
    for r in sorted(got, key=lambda r: r["part"]):
        joined.setdefault(r["k"], []).extend(r["items"])
    assert joined == {k: [r[2] for r in rows] for k, rows in _groups().items()}


# Times of three short series, and the changes that are due with size 3 (the gap of a record reaches two
# records back), start 4 and end 9; record ids are 10 times the place.
SERIES = {
    "calm": [0, 10, 20, 30, 40],
    "twice": [0, 1, 2, 3, 20, 40, 41, 42, 43],
    "open": [5, 5, 5, 13, 14],
}
CHANGES = [
    ("open", 1, "START", 5, 20, 5, 0), ("open", 1, "END", 14, 40, 5, 9),
    ("twice", 1, "START", 2, 20, 0, 2), ("twice", 1, "END", 20, 40, 2, 18), ("twice", 2, "START", 42, 70, 40, 2),
]


@pytest.mark.parametrize("hot", [HOT_ROWS, 2])
def test_bursts_by_hand(spark, hot):
    rows = [(k, t, 10 * i) for k, times in SERIES.items() for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "k string, t bigint, id bigint").repartition(3)
    changes = burst_changes(df, ["k"], "t", "id", 3, 4, 9, hot)
    assert sorted(map(tuple, changes.collect())) == sorted(CHANGES)
    episodes = {(r["k"], r["noticed"], r["ended"]) for r in burst_episodes(changes, ["k"], "t").collect()}
    assert episodes == {("open", 5, 14), ("twice", 2, 20), ("twice", 42, None)}


@pytest.mark.parametrize("hot", LIMITS)
def test_bursts_follow_the_gaps(frame, hot):
    """Each change stands at a record whose gap calls for it, and no call between two changes is left out."""
    got = burst_changes(frame, ["k"], "t", "id", 5, 5, 9, hot).collect()
    assert len(got) > 10
    for key, rows in _groups().items():
        times = [(r[1], r[2]) for r in rows]
        calls = [(rid, "START" if t - times[i - 4][0] <= 5 else "END") for i, (t, rid) in enumerate(times)
                 if i >= 4 and not 5 < t - times[i - 4][0] < 9]
        due = [c for i, c in enumerate(calls) if c[1] != (calls[i - 1][1] if i else "END")]
        assert [(r["id"], r["kind"]) for r in sorted((r for r in got if r["k"] == key), key=lambda r: (r["t"], r["id"]))] == due
