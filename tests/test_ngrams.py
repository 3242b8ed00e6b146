"""N-grams of all lengths against plain counts."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.operators import counts as C
from tallyloom.operators import ngrams as N


def made(seed=1):
    rng = random.Random(seed)
    passage = " ".join(rng.choice("abcde") for _ in range(15))
    texts = [" ".join(rng.choice(["a", "b", "c", "é", "aa", "ab"]) for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    return texts + [passage] * 40 + [None, "", "a", "12 -", "A a"] + ["zz " * 300]


def plain(texts, longest):
    out = Counter()
    for text in texts:
        words = [w.lower() for w in "".join(c if c.isalpha() else " " for c in text or "").split()]
        for n in range(1, longest + 1):
            out.update((n, " ".join(words[k:k + n])) for k in range(len(words) - n + 1))
    return out


@pytest.fixture(params=[1, 3, 7, 10_000])
def batches(spark, request):
    """Arrow batches of few rows, so that runs cross batches and partitions."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("longest, least", [(1, 1), (5, 1), (13, 3)])
def test_all_lengths(spark, batches, longest, least):
    texts = made()
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = {(r["n"], r["ngram"]): r["count"] for r in N.ngrams_of_all_lengths(docs, X.words(F.col("text")), longest, least).collect()}
    assert got == {key: n for key, n in plain(texts, longest).items() if n >= least}


def test_top_of_each_length(spark, batches):
    texts = made(2)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [(r["n"], r["rank"], -r["count"], r["ngram"]) for r in N.ngrams_of_all_lengths(docs, X.words(F.col("text")), 6, k=4).collect()]
    want = []
    for n in range(1, 7):
        best = sorted((-c, g) for (m, g), c in plain(texts, 6).items() if m == n)[:4]
        want += [(n, rank, c, g) for rank, (c, g) in enumerate(best, 1)]
    assert sorted(got) == want


def test_nothing_to_count(spark):
    docs = spark.createDataFrame([(None,), ("",), ("1 2",)], "text string")
    assert N.ngrams_of_all_lengths(docs, X.words(F.col("text"))).collect() == []
    assert N.ngrams_of_all_lengths(docs.limit(0), X.words(F.col("text")), k=3).collect() == []
    with pytest.raises(ValueError):
        N.ngrams_of_all_lengths(docs, X.words(F.col("text")), least=0)


def test_one_row_per_word_is_shuffled(spark):
    """A start is one row, whatever the number of lengths; the explode of each length would send thirteen."""
    docs = spark.createDataFrame([("a b c d e " * 20,)], "text string")
    assert N.suffixes(docs, X.words(F.col("text"))).count() == 100
    plan = N.ngrams_of_all_lengths(docs, X.words(F.col("text")), least=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and plan.count("Generate") == 1


def test_suffixes_are_joined_in_compiled_code(spark):
    """Joining words inside a lambda took several times as long, and the sort asks for all suffixes twice."""
    docs = spark.createDataFrame([("a b c",), (None,), ("",)], "text string").repartition(2)
    found = N.suffixes(docs, X.words(F.col("text")), 2)
    assert sorted(r["suffix"] for r in found.collect()) == ["a b", "b c", "c"]
    joined = [line for line in N.suffixes(docs, X.words(F.col("text")))._jdf.queryExecution().executedPlan().toString().splitlines() if "array_join" in line]
    assert joined and not any("lambda" in line for line in joined)


def test_shared_words_by_hand():
    """Words are compared as bytes; a word that only begins like another is not shared."""
    rng = random.Random(3)
    pieces = ["a", "b", "é", "aa", "abcdefgh", "abcdefghi", "x" * 29, "x" * 32, "日本", ""]
    for _ in range(300):
        texts = sorted(" ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(1, 9)))
        before = rng.choice([None, texts[0], "a aa", ""])
        # A slice of a longer column, as batches may be.
        sizes, shared = N.shared_words(pa.array(["zz", *texts, "u"]).slice(1, len(texts)), before)
        assert sizes.tolist() == [len(t.split(" ")) for t in texts]
        for text, last, n in zip(texts, [before, *texts], shared):
            one, two = text.split(" "), [] if last is None else last.split(" ")
            assert one[:n] == two[:n] and one[n:n + 1] != two[n:n + 1] or (one == two and n == len(one))


@pytest.mark.parametrize("k", [1, 4, 9, 50])
def test_top_items_move_by_hash(spark, monkeypatch, k):
    """The same as counting every item, with items that share a hash, ties and single ones; no item is in the shuffle of all."""
    rng = random.Random(8)
    lists = [[f"{'long ' * 20}{int(rng.paretovariate(0.7)) % 60}" for _ in range(40)] for _ in range(12)]
    docs = spark.createDataFrame([(x,) for x in lists] + [(None,)], "items array<string>").repartition(3)
    want = [tuple(r) for r in C.top_k(C.count_items(docs, F.col("items")), ["word"], k).collect()]
    hashed = F.xxhash64
    for bits in (64, 3):
        frames, plain = [], C.saved
        monkeypatch.setattr(C.F, "xxhash64", lambda c, b=bits: hashed(c) if b == 64 else F.pmod(hashed(c), F.lit(2 ** b)))
        monkeypatch.setattr(C, "saved", lambda df, label: frames.append(df) or plain(df, label))
        assert [tuple(r) for r in C.top_items(docs, F.col("items"), k).collect()] == want
        exchanges = [line for line in frames[0]._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in line]
        assert exchanges and not any("word" in line for line in exchanges)
        monkeypatch.undo()
    monkeypatch.setattr(C, "BROADCAST_ROWS", 2)
    assert [tuple(r) for r in C.top_items(docs, F.col("items"), k).collect()] == want


def test_the_most_frequent_ngrams_move_by_hash(spark, monkeypatch):
    """What ngram_topk shuffles of all n-grams is a hash of each."""
    from __spark_entry__ import queries

    seen = []
    monkeypatch.setattr(C, "top_items", lambda *args, plain=C.top_items: seen.append(args) or plain(*args))
    assert queries()["ngram_topk"](spark, "/root/testdata/sf0.001").count() == 5 and len(seen) == 1
