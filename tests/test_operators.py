"""Operators against brute force on small inputs."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import attempts as A
from tallyloom.operators import clean as K
from tallyloom.operators import counts as C
from tallyloom.operators import graph as G
from tallyloom.operators import pairs as P
from tallyloom.operators import ratings as R
from tallyloom.operators import search as S
from tallyloom.operators import trending as T
from tallyloom.session import new_path


# --- pairs ---------------------------------------------------------------------
def _casts():
    rng = random.Random(3)
    rows = [("huge", i) for i in range(40)] + [("huge", 3)] * 5 + [("large", i) for i in range(20, 45)]
    rows += [(f"f{rng.randrange(12)}", rng.randrange(45)) for _ in range(150)]
    return rows + [(None, 1), ("f1", None)]


def _brute_pairs(dedup, floor=1):
    films = defaultdict(list)
    for film, actor in _casts():
        if film is not None and actor is not None:
            films[film].append(actor)
    counts = Counter()
    for cast in films.values():
        cast = sorted(set(cast)) if dedup else sorted(cast)
        counts.update((a, b) for a, b in combinations(cast, 2) if a < b)
    return {k: n for k, n in counts.items() if n >= floor}


@pytest.mark.parametrize("hot", [2_000, 10, 30])
@pytest.mark.parametrize("dedup, floor", [(True, 1), (False, 1), (True, 2), (True, 3), (True, 4), (False, 3)])
def test_pair_counts(spark, dedup, floor, hot):
    df = spark.createDataFrame(_casts(), "film string, actor bigint")
    got = P.pair_counts(df, "film", "actor", dedup, floor, hot).collect()
    assert {(r["a"], r["b"]): r["count"] for r in got} == _brute_pairs(dedup, floor)


def test_given_pairs_use_their_count(spark):
    df = spark.createDataFrame([("a", "b", 2), ("a", "b", None), ("a", "c", 1)], "a string, b string, n int")
    assert {tuple(r) for r in P.count_pairs(df, "n").collect()} == {("a", "b", 3), ("a", "c", 1)}


# --- ratings ---------------------------------------------------------------------
def test_match_counts_keep_zeros_and_repeated_ratings(spark):
    roles = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", 9), ("z", None)], "star string, film int")
    rated = spark.createDataFrame([(1, 9.0), (1, 9.5), (2, 1.0), (None, 9.0)], "film int, score double")
    flags = {"good": F.col("score") >= 8, "bad": F.col("score") <= 3}
    got = {r["star"]: (r["good"], r["bad"]) for r in R.match_counts(roles, rated, "star", ["film"], flags).collect()}
    assert got == {"x": (4, 1), "y": (0, 0), "z": (0, 0)}


@pytest.mark.parametrize("hot", [5_000_000, 10])
def test_best_items_keep_all_ties(spark, hot):
    rows = [("hot", f"e{i:03d}", 9.0 if i % 3 else 8.0) for i in range(90)] + [("s", "b", 5.0), ("s", "a", 5.0), ("s", "c", None)]
    df = spark.createDataFrame(rows, "series string, episode string, rating double")
    got = R.best_items(df, ["series"], "episode", "rating", max_items=25, hot_rows=hot).orderBy("series", "part").collect()
    hot_items = [i for r in got if r["series"] == "hot" for i in r["items"]]
    assert hot_items == [f"e{i:03d}" for i in range(90) if i % 3]
    assert [r["items"] for r in got if r["series"] == "s"] == [["a", "b"]]
    assert {r["mean"] for r in got if r["series"] == "s"} == {5.0}


def test_attempts(spark):
    rows = []
    for user in range(12):
        rows += [("p", user, t, "WRONG_ANSWER") for t in range(user)] + [("p", user, 50, "OK"), ("p", user, 60, "RUNTIME_ERROR")]
    rows += [("q", 1, 1, "OK"), ("p", 99, 1, "WRONG_ANSWER"), ("p", 98, 1, "SKIPPED")]
    df = spark.createDataFrame(rows, "problem string, user int, t int, verdict string")
    got = A.attempts_before_success(df, ["problem"], "user", ["t"]).collect()
    assert [tuple(r) for r in got] == [("p", sum(range(12)) / 12, 12)]
    stages = {r["stage"]: r["rows"] for r in A.stage_row_counts(df, ["problem"], "user", ["t"]).collect()}
    assert stages == {"read": len(rows), "relevant": len(rows) - 1, "first_success": 13,
                      "before_success": sum(range(12)) + 1, "problems_solved": 2, "problems_kept": 1}


# --- counts -----------------------------------------------------------------------
def test_counts_and_limits(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 5)], "word string, count bigint")
    b = spark.createDataFrame([("x", 3), ("z", None)], "word string, count bigint")
    merged = C.merge_counts([a, b], "word")
    assert {tuple(r) for r in merged.collect()} == {("x", 4), ("y", 2)}
    assert tuple(C.totals(merged).first()) == (6, 2)
    assert C.top_k(merged, ["word"], 0).count() == 0
    assert [r["word"] for r in C.top_k(merged, ["word"], None).collect()] == ["x", "y"]
    assert [r["word"] for r in C.top_k(merged, ["word"], 1, descending=False).collect()] == ["y"]
    assert C.head(merged, ["word"], 0).count() == 0


def test_sort_lines_splits_one_repeated_line(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "m").otherwise(F.col("id").cast("string")).alias("value"))
    ordered = C.sort_lines(df.repartition(6))
    rows = [r["value"] for r in ordered.collect()]
    assert rows == sorted(rows) and len(rows) == 3000


# --- graph ------------------------------------------------------------------------
def _brute_ranks(edges, rounds):
    nodes = {n for e in edges for n in e}
    out = Counter(s for s, _ in edges)
    ranks = {n: 1 / len(nodes) for n in nodes}
    for _ in range(rounds):
        jump = sum(0.15 * r if out[n] else r for n, r in ranks.items())
        new = {n: jump / len(nodes) for n in nodes}
        for s, d in edges:
            new[d] += 0.85 * ranks[s] / out[s]
        ranks = new
    return ranks


@pytest.mark.parametrize("hot_targets", [1_000_000, 3])
def test_pagerank(spark, hot_targets):
    edges = [("hub", f"n{i}") for i in range(20)] + [(f"n{i}", "hub") for i in range(0, 20, 2)]
    edges += [("a", "a"), ("a", "b"), ("a", "b"), ("n1", "n3")]
    df = spark.createDataFrame(edges, "src string, dst string")
    got = {r["id"]: r["rank"] for r in G.pagerank(df, rounds=4, hot_targets=hot_targets).collect()}
    want = _brute_ranks(edges, 4)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[n], want[n], rel_tol=1e-12) for n in want)
    assert math.isclose(sum(got.values()), 1.0)
    degrees = {r["id"]: r["out_degree"] for r in G.out_degrees(df).collect()}
    assert degrees["a"] == 3 and degrees["b"] == 0
    assert {r["id"] for r in G.vertices(df).collect()} == set(want)


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_rounds_leave_out_what_never_changes_and_what_sends_nothing(spark, monkeypatch, rounds):
    """Buyers to shops to goods, a few goods to shops: rounds join the edges between shops and such goods only."""
    edges = [(f"c{i}", f"s{i * j % 7}") for i in range(60) for j in (1, 2, 5)] + [(f"s{i % 7}", f"p{i}") for i in range(90)]
    edges += [("p1", "s2"), ("p2", "s2"), ("p2", "s2"), ("lone", "only")]
    joined, plain = [], G.one_round
    monkeypatch.setattr(G, "one_round", lambda weighted, *args: joined.append(weighted.count()) or plain(weighted, *args))
    got = {r["id"]: r["rank"] for r in G.pagerank(spark.createDataFrame(edges, "src string, dst string"), rounds=rounds).collect()}
    want = _brute_ranks(edges, rounds)
    assert got.keys() == want.keys() and all(math.isclose(got[n], want[n], rel_tol=1e-12) for n in want)
    assert joined == [4] * rounds
    chain = spark.createDataFrame([("a", "b"), ("a", "c")], "src string, dst string")
    assert {r["id"]: round(r["rank"], 12) for r in G.pagerank(chain, rounds=rounds).collect()} == {
        n: round(r, 12) for n, r in _brute_ranks([("a", "b"), ("a", "c")], rounds).items()}


def test_pagerank_of_no_edges(spark):
    assert G.pagerank(spark.createDataFrame([], "src string, dst string")).collect() == []


# --- search -----------------------------------------------------------------------
def test_search_does_not_depend_on_what_else_is_asked(spark):
    docs = spark.createDataFrame([
        (1, "Gato negro", "el gato duerme"), (2, "Perro", "un gato y un perro"), (3, "Vacio", None),
        (4, "gato", "gato gato gato"), (4, "gato", "gato"), (None, "perro", "perro")], "id int, title string, abstract string")
    one = S.query_table(spark, {"q": "gato gato perro", "none": "zzz"})
    words = " ".join("".join(chr(97 + (k // 26**i) % 26) for i in range(4)) + "q" for k in range(20_000))
    many = S.query_table(spark, {"q": "gato gato perro", "none": "zzz", "large": words})
    alone = sorted(map(tuple, S.search(docs, "id", one).collect()), key=str)
    assert alone == sorted(map(tuple, S.search(docs, "id", many).collect()), key=str)
    assert sorted(str(r[1]) for r in alone) == ["1", "2", "4", "4", "None"]
    parts = S.explain(docs, "id", one).where("field = 'abstract' and term = 'gato'").collect()
    assert sorted((r["id"], r["tf"], r["df"]) for r in parts) == [(1, 1, 4), (2, 1, 4), (4, 1, 4), (4, 3, 4)]


def test_stop_words_leave_the_lengths(spark):
    stops = S.spanish_stop_words()
    docs = spark.createDataFrame([(1, "el gato de la casa")], "id int, title string")
    row = S.field_tokens(docs, "id", ["title"], stops).first()
    assert (row["tokens"], row["field_length"]) == (["gato", "casa"], 2)


def test_documents_need_two_fields(spark):
    lines = spark.createDataFrame([("u\tt\ta",), ("u\tt",), ("u",), ("",), ("u\tt\t",)], "value string")
    got = S.build_documents(lines, F.lit("now")).collect()
    assert sorted((r["title"], r["abstract"]) for r in got if r["abstract"]) == [("t", "a")]
    assert len(got) == 3


# --- cleaning ----------------------------------------------------------------------
def test_ragged_rows(spark):
    lines = spark.createDataFrame([
        ("f", 2, "x\ty\tz"), ("f", 1, "a\tb"), ("f", 0, "a\tb\tc\t\t"), ("g", 1, "a\tb\tc"), ("g", 0, "a"), ("g", 2, "b\t")],
        "file string, line bigint, value string").repartition(4)
    assert sorted(r["value"] for r in K.drop_ragged(lines).collect()) == ["a", "a\tb\tc\t\t", "b\t", "x\ty\tz"]
    assert K.drop_ragged(lines, 2).count() == 1
    with pytest.raises(ValueError):
        K.drop_ragged(lines.select("value"))


def test_hot_key_is_split_in_the_join_of_attempts(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500).alias("p"), F.lit("e").alias("e"),
        (F.xxhash64("id") % 1_000_000).alias("t"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("is_accepted")).repartition(8)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        import tallyloom.operators.attempts as A
        kept, A.broadcast_if_small = A.broadcast_if_small, lambda df: df
        got = A.failures_before_success(rows, ["p", "e"], ["t"])
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        A.broadcast_if_small = kept
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_null_rows(spark):
    df = spark.createDataFrame([("NULL", "NULL"), ("NULL", "x"), (None, "NULL")], "a string, b string")
    assert K.drop_null_rows(df, ["a", "b"], 2).count() == 2
    good, bad = K.split_rejected(df, F.col("a") == "NULL")
    assert (good.count(), bad.count()) == (2, 1)


# --- trends -------------------------------------------------------------------------
def _tagged():
    rng = random.Random(5)
    return [(rng.choice(["#a", "#a", "#b", "#c"]), rng.randrange(0, 400)) for _ in range(120)]


def test_trailing_counts_over_chunk_borders(spark):
    df = spark.createDataFrame(_tagged(), "tag string, s bigint")
    got = T.trailing_counts(T.bucket_counts(df, "tag", F.col("s")), "tag", 30, chunk=40).collect()
    want = {(t, s): sum(1 for u, v in _tagged() if u == t and s - 30 <= v <= s) for t, s in _tagged()}
    assert {(r["tag"], r["bucket"]): r["n_window"] for r in got} == want
    assert len(got) == len(want)


def test_trending_by_hand(spark):
    # Two minutes: at 0 "#a" twice and "#b"; at 60 "#b" (still sees 0); at 61 "#c" (0 is out of reach); at 130 nothing but itself.
    rows = [("#a", 0), ("#a", 0), ("#b", 0), ("#b", 60), ("#c", 61), ("#a", 130)]
    got = T.trending(T.bucket_counts(spark.createDataFrame(rows, "tag string, s bigint"), "tag", F.col("s")), "tag", k=2).collect()
    assert sorted((r["snapshot"], r["rank"], r["tag"], r["n"]) for r in got) == [
        (0, 1, "#a", 2), (0, 2, "#b", 1), (60, 1, "#a", 2), (60, 2, "#b", 2), (61, 1, "#b", 1), (61, 2, "#c", 1), (130, 1, "#a", 1)]
    assert all(r["rate"] == r["n"] / 60 for r in got)


def test_growth(spark):
    df = spark.createDataFrame(_tagged(), "tag string, s bigint")
    got = T.growth(T.bucket_counts(df, "tag", F.col("s")), "tag", 1, 60).collect()
    want = {}
    for now in {s for _, s in _tagged()}:
        for tag in ("#a", "#b", "#c"):
            recent = sum(1 for t, s in _tagged() if t == tag and 0 <= now - s < 60)
            previous = sum(1 for t, s in _tagged() if t == tag and 60 <= now - s < 120)
            if recent:
                want[(now, tag)] = recent / previous if previous else math.inf
    assert {(r["snapshot"], r["tag"]): r["ratio"] for r in got} == want


@pytest.mark.parametrize("hot_rows", [5_000_000, 40])
@pytest.mark.parametrize("at_messages", [True, False])
def test_windows_by_entries_and_exits(spark, hot_rows, at_messages):
    """Counts and growth from running sums, for ordinary tags and for tags that are cut into slices."""
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.5 else f"t{rng.randrange(5)}", rng.randrange(0, 400) * 2) for _ in range(600)]
    buckets = T.bucket_counts(spark.createDataFrame(rows, "tag string, s long"), "tag", F.col("s"), 2)
    moments = {b for _, b in rows} if at_messages else {b + 2 * k for _, b in rows for k in range(10)}

    def window(tag, low, high):
        return sum(1 for t, b in rows if t == tag and low < b <= high)

    want = {(s, t): (window(t, s - 20, s), window(t, s - 40, s - 20)) for s in moments for t in {t for t, _ in rows}}
    got = T.sliding_counts(buckets, "tag", 2, 10, at_messages, hot_rows).collect()
    assert {(r["snapshot"], r["tag"]): r["n"] for r in got} == {k: a for k, (a, _) in want.items() if a}
    grown = T.growth(buckets, "tag", 2, 10, at_messages, hot_rows).collect()
    assert {(r["snapshot"], r["tag"]): (r["recent"], r["previous"]) for r in grown if r["snapshot"] in moments} == {
        k: v for k, v in want.items() if v[0]}
    assert len(got) == len({(r["snapshot"], r["tag"]) for r in got})


def test_a_bucket_is_two_rows_before_the_sum(spark):
    buckets = spark.createDataFrame([("a", 60 * k, 3) for k in range(50)], "tag string, bucket long, n long")
    # Neighbours overlap, so each change but the last opens a level.
    assert T._levels(buckets, "tag", [(0, [1]), (3600, [-1])]).count() <= 2 * 50


@pytest.mark.parametrize("k", [1, 5, 40, 10_000])
def test_top_pairs_by_support(spark, monkeypatch, k):
    """Few frequent items, very many rare ones: the same as counting all pairs, with a fraction of them formed."""
    rng = random.Random(9)
    rows = []
    for g in range(300):
        rows += [(g, x) for x in rng.sample(range(12), 5)] + [(g, 1000 + rng.randrange(3000)) for _ in range(12)]
    df = spark.createDataFrame([*rows, *rows[:50], (None, 3), (4, None)], "g long, x long")
    counts = Counter()
    for g in range(300):
        counts.update(combinations(sorted({x for h, x in rows if h == g}), 2))
    want = [(a, b, n) for (a, b), n in sorted(counts.items(), key=lambda p: (-p[1], p[0]))[:k]]
    formed, plain = [], P._paired
    monkeypatch.setattr(P, "_paired", lambda *args: formed.append(plain(*args)) or formed[-1])
    got = [tuple(r) for r in P.top_pairs(df, "g", "x", k).collect()]
    assert got == want
    if k <= 40:
        assert sum(f.count() for f in formed) < sum(counts.values()) / 4
    assert P.top_pairs(df.limit(0), "g", "x", k).count() == 0 and P.top_pairs(df, "g", "x", 0).count() == 0


def test_distinct_counts_from_sketches(spark):
    """Within three per cent of the exact counts, whatever the parts, and a word in several parts counts once."""
    rng = random.Random(3)
    rows = [(rng.choice("abc"), f"w{int(rng.paretovariate(0.4)) % 40_000}") for _ in range(60_000)] + [("a", None)]
    sketches = C.count_sketches(spark.createDataFrame(rows, "part string, word string"), "part", "word")
    got = {r["part"]: r for r in C.sketch_totals(sketches, ["part"]).collect()}
    whole = C.sketch_totals(sketches).first()
    for part in "abc":
        exact = {w for p, w in rows if p == part and w}
        assert got[part]["total"] == sum(p == part and w is not None for p, w in rows)
        assert abs(got[part]["distinct_items"] - len(exact)) <= 0.03 * len(exact)
    exact = {w for _, w in rows if w}
    assert whole["total"] == 60_000 and abs(whole["distinct_items"] - len(exact)) <= 0.03 * len(exact)
    assert tuple(C.sketch_totals(sketches.limit(0)).first()) == (0, 0)


def test_search_in_stored_postings(spark, monkeypatch):
    """The same hits as a search over the texts, after the texts are gone, with most blocks left unread."""
    rng = random.Random(12)
    # Rare words gather in few stretches, so bounds differ from block to block.
    rows = [(i if i % 50 else None, " ".join(rng.choice(["sol", "mar", "casa"]) for _ in range(3)),
             " ".join(["w" + "abcdefghij"[i // 300]] * rng.randrange(3) + [rng.choice(["sol", "luz", "pan"]) for _ in range(rng.randrange(12))]) or None)
            for i in range(3000)]
    docs = spark.createDataFrame(rows, "id long, title string, abstract string").coalesce(1)
    asked = S.query_table(spark, {"a": "wd wd luz", "b": "wj", "c": "nada", "d": "sol mar"})
    want = sorted(map(str, S.search(docs, "id", asked).collect()))
    table = S.PostingsTable.write(docs, "id", new_path(spark, "stored"))
    read, plain = [], S.PostingsTable._scores
    monkeypatch.setattr(S.PostingsTable, "_scores", lambda self, blocks, *args: read.append(blocks) or plain(self, blocks, *args))
    got = S.PostingsTable(spark, table.path, "id").search(asked)
    assert sorted(map(str, got.collect())) == want
    blocks = {q: sum(b.where(F.col("query_id") == q).count() for b in read) for q in "ab"}
    assert all(n < 3000 / S.BLOCK / 2 for n in blocks.values()), blocks
    assert "PushedFilters: [In(term" in plain(table, read[0], S.query_terms(asked), F.col("term").isin(["wd", "luz"]), F.lit(1.0), 6)._jdf.queryExecution().executedPlan().toString()


def test_postings_are_written_with_one_shuffle_of_all_of_them(spark):
    """Terms are counted where a document is read, and no exchange brings a document's postings together."""
    rng = random.Random(5)
    rows = [(k // 2 or None, "Sol sol mar" if k % 3 else None, " ".join(rng.choice(["a", "b", "cc", "é"]) for _ in range(rng.randrange(30)))) for k in range(200)]
    docs = spark.createDataFrame(rows, "id long, title string, abstract string").repartition(3)
    tokens = S.field_tokens(docs.withColumn("_r", F.monotonically_increasing_id()), "_r", ["title", "abstract"])
    want = sorted(tuple(r) for r in S.postings(tokens, "_r").select("_r", "field", "term", "tf").collect())
    own = tokens.select("_r", "field", F.explode(S.counted_terms(F.col("tokens"))).alias("t")).select("_r", "field", "t.term", "t.tf")
    assert sorted(tuple(r) for r in own.collect()) == want
    assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString().replace("Exchange RoundRobin", "").replace("REPARTITION_BY_NUM", "")
    path = new_path(spark, "one-shuffle")
    S.PostingsTable.write(docs, "id", path)
    stored = spark.read.parquet(f"{path}/postings")
    assert stored.select(F.explode("held")).count() == len(want)
    assert stored.count() == stored.select("term", "field", "block").distinct().count()
    assert spark.createDataFrame([], "tokens array<string>").select(S.counted_terms(F.col("tokens"))).count() == 0


def test_a_round_of_ranks_has_one_exchange(spark, monkeypatch):
    """Edges and ranks are joined as they lie; only what flows in is shuffled."""
    plans, plain = [], G.one_round
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def watched(*args):
        out = plain(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(G, "one_round", watched)
    try:
        edges = spark.createDataFrame([(f"v{i % 40}", f"v{i * 7 % 90}") for i in range(400)], "src string, dst string")
        G.pagerank(edges, rounds=3).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(plans) == 3 and all(p.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in p for p in plans)


@pytest.mark.parametrize("job", ["pairs", "top pairs", "out degrees"])
def test_tasks_do_not_grow_with_the_input(spark, monkeypatch, job):
    """Shuffles get partitions by the number of rows and small bounds in bytes; the session's settings come back."""
    from __spark_entry__ import queries
    from tallyloom import session
    from tallyloom.plans import networks

    names = ["spark.sql.shuffle.partitions", *session.SMALL]
    before, seen = [spark.conf.get(n) for n in names], []
    module = {"pairs": P, "top pairs": P, "out degrees": networks}[job]

    def watched(df, label, plain=module.saved):
        seen.append([spark.conf.get(n) for n in names])
        return plain(df, label)

    monkeypatch.setattr(module, "saved", watched)
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    casts = spark.range(900).selectExpr("id div 3 AS g", "id % 7 AS x")
    if job == "pairs":
        P.pair_counts(casts, "g", "x", min_count=2).collect()
    elif job == "top pairs":
        P.top_pairs(casts, "g", "x", 3).collect()
    else:
        monkeypatch.setattr(networks, "trade_edges", lambda *_: casts.selectExpr("g AS src", "x AS dst"))
        queries()["graph_out_degree"](spark, "/root/testdata/sf0.001").collect()
    assert int(seen[-1][0]) > int(before[0]) and seen[-1][1:] == [small for _, small in session.SMALL.values()]
    assert [spark.conf.get(n) for n in names] == before
