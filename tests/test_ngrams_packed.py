"""N-grams of all lengths above a floor: cut, packed suffixes against plain counts."""

from __future__ import annotations

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.operators import ngrams as N
from tallyloom.session import drop_saved, saved, shared_folder

# So small that pieces, packed blocks, ranges, parts of the slots and slots that several n-grams share all occur.
SMALL = {"FEW_WORDS": 0, "PIECE": 200, "HELD_SLOTS": 300, "HELD": 2000, "COPIED": 50, "BLOCK": 7, "MARKS": 5, "MOST_MARKS": 60,
         "ROWS_PER_TASK": 40, "PART_BITS": 3}


def made(seed=1):
    rng = random.Random(seed)
    passage = [rng.choice("abcde") for _ in range(15)]
    some = ["a", "b", "c", "é", "aa", "ab", "abcdefgh", "abcdefghi", "日本", "x" * 30]
    texts = [[rng.choice(some) for _ in range(rng.randrange(0, 30))] for _ in range(50)]
    rare = [[f"rare{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 20))] for _ in range(10)]
    return texts + rare + [passage] * 40 + [None, [], ["a"], [""], ["", "a", ""]] + [["zz"] * 300]


def plain(texts, longest):
    out = Counter()
    for words in texts:
        for n in range(1, longest + 1):
            out.update((n, " ".join(words[k:k + n])) for k in range(len(words or ()) - n + 1))
    return out


def best(texts, longest, k, least=1):
    want = []
    for n in range(1, longest + 1):
        counts = [(-c, g) for (m, g), c in plain(texts, longest).items() if m == n and c >= least]
        want += [(n, rank, c, g) for rank, (c, g) in enumerate(sorted(counts, key=lambda x: (x[0], x[1].encode()))[:k], 1)]
    return want


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "tokens array<string>").repartition(3)


@pytest.fixture(params=[None, (4, 6), (10, 12)])
def small(monkeypatch, request):
    """Everything in small steps; with a number of slots, rare n-grams fall together with frequent ones or do not."""
    if request.param is None:
        monkeypatch.setattr(N, "FEW_WORDS", 0)
    else:
        for name, value in (SMALL | {"SLOT_BITS": request.param}).items():
            monkeypatch.setattr(N, name, value)


@pytest.mark.parametrize("longest, least", [(1, 2), (2, 3), (5, 2), (13, 10), (3, 10**10)])
def test_above_a_floor(spark, small, longest, least):
    texts = made()
    got = N.ngrams_of_all_lengths(frame(spark, texts), F.col("tokens"), longest, least).collect()
    assert len({(r["n"], r["ngram"]) for r in got}) == len(got)
    assert {(r["n"], r["ngram"]): r["count"] for r in got} == {key: n for key, n in plain(texts, longest).items() if n >= least}


@pytest.mark.parametrize("k, least", [(1, 1), (4, 1), (4, 30), (60, 1), (3000, 1)])
def test_most_frequent_above_their_own_floor(spark, small, k, least):
    """Also where a length has fewer than k that repeat, and fewer than k at all."""
    texts = made(2)
    got = N.ngrams_of_all_lengths(frame(spark, texts), F.col("tokens"), 6, least, k).collect()
    assert sorted((r["n"], r["rank"], -r["count"], r["ngram"]) for r in got) == best(texts, 6, k, least)


def test_lengths_that_no_text_has(spark, small):
    texts = [["a", "b", "c"]] * 30 + [["b", "c"]] * 5
    got = N.ngrams_of_all_lengths(frame(spark, texts), F.col("tokens"), 7, k=1).collect()
    assert sorted((r["n"], r["rank"], -r["count"], r["ngram"]) for r in got) == best(texts, 7, 1)


def test_a_floor_that_is_too_high_is_noticed(spark, monkeypatch):
    """Hashes that fall together may make a count that no n-gram has."""
    monkeypatch.setattr(N, "FEW_WORDS", 0)
    monkeypatch.setattr(N, "_lower_bound", lambda *args: 1000)
    texts = made(3)
    got = N.ngrams_of_all_lengths(frame(spark, texts), F.col("tokens"), 4, k=3).collect()
    assert sorted((r["n"], r["rank"], -r["count"], r["ngram"]) for r in got) == best(texts, 4, 3)


def test_the_floor_of_the_most_frequent_is_reached(spark, monkeypatch):
    monkeypatch.setattr(N, "PIECE", 200)
    texts = [t for t in made(4) if t]
    lines = spark.createDataFrame([(" ".join(t) + " ",) for t in texts], "text string").repartition(3)
    for k in (1, 5):
        kth = min(-c for _, rank, c, _ in best(texts, 5, k) if rank == k)
        assert 1 < N._lower_bound(lines, range(1, 6), k) <= kth


@pytest.mark.parametrize("options", [{"least": 10}, {"k": 5}])
def test_starts_that_cannot_count_are_not_sent(spark, monkeypatch, options):
    """Thirteen words for each start were many times the text in the shuffle."""
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(10**9)}" for _ in range(300)] for _ in range(400)] + [[f"x{k}" for k in range(20)]] * 50
    sent, cut = [], N._cut_suffixes
    monkeypatch.setattr(N, "_cut_suffixes", lambda *args: sent.append(cut(*args)) or sent[-1])
    monkeypatch.setattr(N, "drop_saved", lambda df: None)
    found = N.ngrams_of_all_lengths(frame(spark, texts), F.col("tokens"), **options)
    assert "rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    counts = {(r["n"], r["ngram"]): r["count"] for r in found.collect()}
    assert set(counts.values()) == {50} and len(counts) == (sum(21 - n for n in range(1, 14)) if "least" in options else 13 * 5)
    packed = sent[0].agg(F.sum("size"), F.sum(F.length("sizes") + F.length("bytes") + F.length("weights"))).first()
    # The twenty starts of the passage, from each task at most, and starts that fall together with them.
    assert len(sent) == 1 and packed[0] <= 20 * 3 + 10 and packed[1] < 20_000


def test_tables_on_the_way_are_removed(spark, monkeypatch):
    monkeypatch.setattr(N, "FEW_WORDS", 0)
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    N.ngrams_of_all_lengths(frame(spark, made()), F.col("tokens"), 5, k=2).collect()
    assert {name.split("-")[0] for name in set(os.listdir(folder)) - before} == {"ngrams"}
    N.ngrams_of_all_lengths(frame(spark, made()), F.col("tokens"), 5, 2).collect()
    assert {name.split("-")[0] for name in set(os.listdir(folder)) - before} == {"ngrams", "suffixes"}


def test_only_saved_tables_are_removed(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "other"))
    drop_saved(spark.read.parquet(str(tmp_path / "other")))
    assert spark.read.parquet(str(tmp_path / "other")).count() == 5
    kept, gone = saved(spark.range(3), "kept"), saved(spark.range(4), "gone")
    path = gone.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    assert os.path.isdir(path)
    drop_saved(gone)
    assert not os.path.exists(path) and kept.count() == 3


def test_blocks_and_numbers_by_hand():
    rng = random.Random(6)
    for size in (1, 2, 50, 300):
        numbers = np.array([rng.randrange(2 ** rng.randrange(1, 33)) for _ in range(size)])
        assert N._unpacked(N._packed(numbers), size).tolist() == numbers.tolist()
        texts = ["".join(rng.choice("ab é日") for _ in range(rng.randrange(0, 9))) for _ in range(size)]
        block = N._sealed(pa.array(["zz", *texts, "u"]).slice(1, size), numbers)
        opened, weights = N._opened(*block)
        assert opened.to_pylist() == texts and weights.tolist() == numbers.tolist()


def test_few_slots_are_merged_by_many_tasks(spark):
    """The slots of a high floor are few; one task would have read what all others send."""
    lines = spark.createDataFrame([(" ".join(f"w{k * n % 1009}" for k in range(500)) + " ",) for n in range(1, 40)], "text string")
    parts = lines.mapInArrow(N._hashed((1, 2, 3), N.SLOT_BITS[0], 500), "part int, size int, slots binary, counts binary")
    sizes = [r["s"] for r in parts.groupBy("part").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * sum(sizes) / 64


def test_words_and_hashes_by_hand():
    texts = [["a", "b"], ["", "b"], ["abcdefgh", "abcdefghi", "abcdefgh"], ["x" * 40, "x" * 41, "a", "b"]]
    words = N._Words(pa.array(["zz ", *(" ".join(t) + " " for t in texts)]).slice(1))
    every = [w for t in texts for w in t]
    assert [bytes(words.data[a:b]).decode() for a, b in zip(words.starts, words.ends)] == every
    assert words.left.tolist() == [2, 1, 2, 1, 3, 2, 1, 4, 3, 2, 1]
    for n, gram in words.grams(3):
        runs = [tuple(every[k:k + n]) for k in range(len(every) - n + 1)]
        assert len(gram) == len(runs) and len(set(zip(runs, gram.tolist()))) == len(set(runs)) == len(set(gram.tolist()))
