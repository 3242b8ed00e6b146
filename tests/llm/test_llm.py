"""Operators of the llm subpackage on small tables, against brute force and round trips."""

from __future__ import annotations

import hashlib
import io
import json
import random
import re
import zipfile
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import archives, bpe, chats, components, decontaminate, grams, lines, minhash, pages, quality, substrings, toxicity
from tallyloom.llm.queries import ORACLES, QUERIES
from tools.check import canonical

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# A table with every awkward case: clashing names, nulls, repeats, one long text.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `key` string, `id` string, `n` int, `band` int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en", "s", 0, "k", "x", 1, 2) for i, t in rows], schema)


def words(n, seed=0, vocabulary=5000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    base = words(120)
    near = base[:60] + ["other"] + base[61:]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (9, " ".join(base)), (1, None), (2, ""),
            (4, " \n "), (None, " ".join(base)), (7, "one two"), (8, "one two"), (6, " ".join(words(30_000, 3)))]
    return table(spark, rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame, relation = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert canonical(frame.columns, frame.collect()) == canonical(relation.columns, relation.fetchall())


def test_grams_name_runs_of_words():
    a = grams.WordHasher()([b"%d" % (k % 7) for k in range(300)])
    for n in (1, 2, 8, 20, 50, 99):
        g = grams.grams(a, n)
        assert len(g) == 301 - n and len(set(g.tolist())) == 7
    assert len(grams.grams(a, 301)) == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 150), (7, 7), (300, 300)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 150: 100, 200: 100}


def test_near_duplicates_against_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    sets = {}
    for i, t in zip(docs.doc_id, docs.text):
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in QUERIES["op5_minhash"](spark, SF).collect()}
    assert got == want


def test_near_duplicates_odd_cases(spark, odd):
    got = sorted((r["id"] or 0, r["component_id"] or 0, r["kept"]) for r in minhash.near_duplicates(odd).collect())
    assert got == [(0, 0, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 3, False), (6, 6, True),
                   (7, 7, True), (8, 7, False), (9, 3, False), (9, 3, False)]
    assert minhash.drop_near_duplicates(odd).count() == 7
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_parity_never_exceeds_the_difference():
    a = np.arange(1, 900, dtype=np.uint64)
    differ = np.bitwise_count((minhash.parity(a) ^ minhash.parity(a[50:])).view(np.uint64)).sum()
    assert 0 < differ <= 50


def removed_by_hand(rows, window):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [6, 20])
def test_substrings_against_brute_force(spark, odd, bits):
    rng = random.Random(4)
    passage = words(90, 9)
    rows = [(i, t) for i, t in odd.select("doc_id", "text").collect()]
    for i in range(20, 50):
        at = rng.randrange(60)
        rows.append((i, " ".join(words(60, i)[:at] + passage[rng.randrange(30):60 + rng.randrange(30)] + words(60, i)[at:] + ["a"] * rng.randrange(130))))
    got = substrings.remove_repeated_passages(table(spark, rows), bits=bits)
    assert sorted(map(tuple, got.collect()), key=str) == removed_by_hand(rows, 50)
    assert substrings.remove_repeated_passages(odd.limit(0), bits=6).count() == 0


def test_bpe_equals_the_library(spark, odd):
    library = Tokenizer.from_file(VOCABULARY)
    library.no_truncation(), library.no_padding()
    rng = random.Random(5)
    pieces = ["a", "B", "the", "ing", "É", "Σ", " ", "\n", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<|startoftext|>", "<|", "'s", "'RE", "12", "½",
              "中文", "🎉", "!!!", "İ", "ß", "ﬁ", "é", "aaaaaaa", "zq", "\x00", "</w>", "cafe"]
    texts = [None, "", *("".join(rng.choice(pieces) for _ in range(rng.randrange(15))) for _ in range(800)), "word " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    coded = bpe.encode_and_decode(table(spark, rows), VOCABULARY, keep_ids=True)
    got = {r["id"]: r for r in coded.collect()}
    back = {r["id"]: r["text"] for r in bpe.decode(coded, VOCABULARY, ident="id").collect()}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == ids, t
        assert back[i] == library.decode(ids, skip_special_tokens=False)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_and_decode(odd.limit(0), VOCABULARY).count() == 0


def test_base_measures_against_brute_force():
    hasher, rng = grams.WordHasher(), random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice(["a ", "b ", "é ", "#\n", "\n", "x y z ", "<p> ", "\x1d", "\n\x0b\n"]) for _ in range(rng.randrange(120)))
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        covered = set()
        found = {}
        for k in range(len(w) - 7):
            found.setdefault(tuple(w[k:k + 8]), []).append(k)
        for starts in found.values():
            if len(starts) > 1:
                covered |= {k + j for k in starts for j in range(8)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        base, rates = quality.measure(text.encode(), hasher)
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)) if w else 0, dup, len(covered))
        assert base == want, text


def test_exact_bound():
    # With k wrong of n, the bound p solves P(X <= k) = level.
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** 0.01, abs=1e-6)
    p = quality.upper_bound(1, 50, 0.1)
    assert (1 - p) ** 50 + 50 * p * (1 - p) ** 49 == pytest.approx(0.1, abs=1e-6)
    assert quality.upper_bound(0, 0, 0.05) == 1 and quality.upper_bound(5, 5, 0.05) == 1


def test_quality_learns_and_limits_false_rejections(spark, odd):
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(3000):
        bad = i % 4 == 0
        rows.append((i, " ".join(w + ("###" if bad and rng.random() < 0.9 else "") for w in words(40, i))))
        marks.append((i, int(not bad), 0))
    labels = spark.createDataFrame(marks + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, id int")
    docs = table(spark, rows)
    got = {r["id"]: r["kept"] for r in quality.judge_quality(docs, labels).collect()}
    assert all(got[i] for i in range(3000) if i % 4) and not any(got[i] for i in range(0, 3000, 4))
    assert quality.keep_good(docs, labels).columns == docs.columns
    few = quality.judge_quality(odd, labels.limit(0)).collect()
    assert len(few) == 11 and sum(r["kept"] for r in few) == 6
    assert quality.keep_good(odd.limit(0), labels).count() == 0


def test_toxicity_on_held_out_rows(spark, odd):
    rows = [(i, " ".join(words(50, i, 400) + (["vile", "nasty"] if i % 3 == 0 else []))) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)] + [(None, 1)], "doc_id long, toxic int")
    docs = table(spark, rows)
    net = toxicity.fit(docs, labels)
    marked = [r for r in toxicity.score_toxicity(docs, net).collect() if r["held_out"]]
    assert len(marked) > 100 and sum(r["predicted"] == (r["id"] % 3 == 0) for r in marked) > 0.97 * len(marked)
    others = toxicity.score_toxicity(odd, net).collect()
    assert len(others) == 11 and all(0 <= r["score"] <= 1 for r in others)
    long = toxicity.Buckets()(b"a b " * 50_000 + b"vile nasty")
    assert toxicity.score(net, long) >= toxicity.score(net, long[:-4])
    # The threshold of a language by hand, from the rows that neither training nor the holdout takes.
    few = toxicity.fit(docs, labels, most=150)
    scored = toxicity.score_toxicity(docs, few, lang="lang")
    trained = {r["id"] for r in toxicity._chosen(labels, "doc_id", "toxic", 150)[0].collect()}
    mine = [(int(r["score"] * 100), r["id"] % 3 == 0) for r in scored.collect() if not r["held_out"] and r["id"] not in trained]
    assert len(trained) == 300 and len(mine) > 300
    good = [b for b in {s for s, _ in mine} if (a := [y for s, y in mine if s >= b]) and sum(a) >= 0.9 * len(a)]
    limits = toxicity.thresholds(scored, labels, most=150)
    assert [tuple(r) for r in limits.collect()] == [("en", min(good) / 100)]
    marks = toxicity.flagged(scored, limits).collect()
    assert all(r["flagged"] == (r["score"] >= min(good) / 100) for r in marks) and len(marks) == 900
    assert toxicity.thresholds(scored, labels).count() == 0
    # No labels, one class only, no documents: still a net and a score.
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        plain = toxicity.score_toxicity(docs, toxicity.fit(docs, some), lang="lang")
        assert plain.where("score between 0 and 1").count() == 900
        assert toxicity.flagged(plain, toxicity.thresholds(plain, some)).count() == 900
    assert toxicity.score_toxicity(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


@pytest.mark.parametrize("rows_to_broadcast", [24_000, 0])
def test_decontamination_by_hand(spark, rows_to_broadcast):
    item = [f"b{k}" for k in range(14)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "Short one"), (3, None), (None, "lonely words"), (4, "!!!")], "item_id long, text string")
    rows = [(1, "x " + " ".join(item[2:13]).upper() + " y"), (2, "a short, ONE here"), (3, None), (4, ""), (5, " ".join(item[:9])),
            (6, "lonely words"), (7, " ".join(item)), (7, " ".join(item))]
    got = sorted((r["id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in decontaminate.contamination(
        table(spark, rows), items, broadcast_rows=rows_to_broadcast).collect())
    assert got == [(1, 13, 11, ["1"], True), (2, 4, 2, ["2"], True), (3, 0, 0, [], False), (4, 0, 0, [], False), (5, 9, 0, [], False),
                   (6, 2, 2, [], True), (7, 14, 14, ["1"], True), (7, 14, 14, ["1"], True)]
    left = decontaminate.drop_contaminated(table(spark, rows), items)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]
    assert decontaminate.contamination(table(spark, rows), items.limit(0)).where("contaminated").count() == 0


def test_benchmark_words_are_cut_at_gaps_once(spark):
    """Words are those of the contract for any text; texts are cut at the gaps, once a scan, and not matched word by word."""
    texts = ["Ab, c-D  é É\u0085ß\u00a0x", "…‘quoted’ 語 語,語", "\x7fx{y}Z[0-9]_", " ", "", None, "\n\nÞþ ÀÃã\u00e3\u0301 𝒳", "one"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("*", decontaminate.item_words(F.col("text")).alias("words"))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    known = {}
    for r in rows.collect():
        want = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").translate(lower))
        assert len(want) == len(r["words"]) and all(known.setdefault(w, g) == g for w, g in zip(want, r["words"]))
    assert len(set(known.values())) == len(known) > 12
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and "translate" not in plan


def test_line_dedup_by_hand(spark):
    a = "one two three four five six seven eight nine ten"
    b = a.replace("ten", "eleven")
    rows = [(3, f"{a}\nshort line\n\nend"), (1, b), (2, f"short line\n{a}"), (4, None), (5, ""), (None, a), (6, f"{b.upper()}\n{b}"), (7, a + " p q r s t u v")]
    got = {(r["doc_id"], r["text"], r["lines"], r["gone"]) for r in lines.dedup_lines(table(spark, rows), counts=("lines", "gone")).collect()}
    assert got == {(3, "\nend", 4, 2), (1, b, 1, 0), (2, "short line", 2, 1), (4, None, 0, 0), (5, "", 1, 0), (None, a, 1, 0),
                   (6, "", 2, 2), (7, a + " p q r s t u v", 1, 0)}
    assert lines.dedup_lines(table(spark, rows).limit(0)).count() == 0


def test_long_lines_and_letters_beyond_ascii(spark):
    """Lines on both sides of the mask widths; only A-Z are lower-cased; white space of any kind separates."""
    rng = random.Random(4)
    pool = [f"{a}{n}" for n in range(150) for a in ("É", "é", "ß", "ж", "Ж", "語", "𝒳", "x", "X")]
    made = []
    for n in (8, 30, 46, 50, 54, 90, 160, 400):
        base = rng.sample(pool, n)
        for change in (0, 1, n // 10, n // 9, n // 8, n // 4):
            near = base[change:] + rng.sample(pool, change)
            rng.shuffle(near)
            made.append(rng.choice([" ", "\t", "\x0b", "\f ", "\r"]).join(near))
    rng.shuffle(made)
    rows = [(i, "\n".join(made[6 * i:6 * i + 6])) for i in range(8)]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = [set(re.split("[ \t\x0b\f\r]+", m.translate(lower))) for m in made]
    expected = {(j // 6, j % 6) for j, b in enumerate(sets) if any(100 * len(a & b) >= 80 * len(a | b) for a in sets[:j])}
    got = {(r["doc"], r["no"]) for r in lines.removed_lines(table(spark, rows)).collect()}
    assert got == expected and 8 < len(expected) < 40


def test_chats_by_hand(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 5, "user", "hi"), (3, 6, "assistant", "yo"),
            (3, 7, "user", None), (4, None, None, "x"), (None, 0, "user", "hi"), (6, 0, "user", "yo"), (5, 0, "user", "yo")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv"]: (r["n_turns"], r["text"]) for r in chats.format_chats(df).collect()}
    assert got == {3: (3, "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n<|im_start|>user\n<|im_end|>\n"),
                   4: (1, "<|im_start|>\nx<|im_end|>\n"), 5: (1, "<|im_start|>user\nyo<|im_end|>\n")}
    assert chats.format_chats(df.limit(0)).count() == 0


def test_main_text_of_awkward_pages():
    page = """<html><head><title>x</title><script>var a="</p><article>";</script></head><body><div id="cookieBanner">We use</div>
      <div class="site-header">H</div><main><h1>Title &amp; more</h1><!-- <p>no</p> --><p title="a>b">One<br>two <b>three</b><p>Four&nbsp;five &lt;x&gt;
      <ul><li>a<li>b</ul><section class="comments"><article>Nice!</article></section><form>in</form><aside>side</aside>
      <table><tr><td>c1<td>c2</table></main><footer>f</footer>"""
    assert pages.main_text(page) == "Title & more\nOne two three\nFour five <x>\na\nb\nc1\nc2"
    assert pages.main_text(None) == "" and pages.main_text("") == "" and pages.main_text("plain &am") == "plain &am"
    assert pages.main_text("<div>" * 3000 + "deep" + "</div>" * 2000) == "deep"


def test_style_tree_removes_what_a_host_repeats(spark):
    rows = [(i, f"http://h.example/{i}", f"<div class=box>same on all</div><div class=body><p>text {i}</p><p>more</p></div>") for i in range(12)]
    rows += [(50, None, "<p>alone</p>"), (51, "http://h.example/a", None), (52, "http://h.example/b", "<article><div class=box>same on all</div></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract_text(df).collect()}
    assert got == {**{i: f"text {i}\nmore" for i in range(12)}, 50: "alone", 51: "", 52: "same on all"}
    assert pages.extract_text(df.limit(0)).count() == 0


def test_style_tree_decides_inside_articles(spark):
    page = "<main><div class=box>same on all</div><article><div class=box>same too</div><h1>title {0}</h1><p>text {0}</p></article></main>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(12)]
    # Another host says the same on all pages: its articles stay whole.
    rows += [(20 + i, f"http://mirror.example/{i}", "<div>site</div><article><p>one text</p></article>") for i in range(12)]
    # A third one marks half of its pages.
    rows += [(40 + i, f"http://half.example/{i}", f"<{'article' if i % 2 else 'section'}><p class=by>staff</p><p>body {i}</p>") for i in range(24)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract_text(df).collect()}
    assert got == {**{i: f"title {i}\ntext {i}" for i in range(12)}, **{20 + i: "one text" for i in range(12)}, **{40 + i: f"body {i}" for i in range(24)}}


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_zip_files(zip64):
    package = archives.Package(zip64)
    package.add("a.txt", b"hello" * 100), package.add("ü/b", b"")
    data = package.close()
    with zipfile.ZipFile(io.BytesIO(data)) as file:
        assert file.testzip() is None and file.read("a.txt") == b"hello" * 100
    asked = []

    def fetch(start, length):
        asked.append(length)
        return data[start:start + length]

    members = archives.directory(fetch, len(data))
    assert set(members) == {"a.txt", "ü/b"} and fetch(archives.member_start(fetch, 0), 5) == b"hello"
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w") as file:
        file.comment = b"PK\x05\x06 note"
        with file.open(zipfile.ZipInfo("x"), "w", force_zip64=True) as member:
            member.write(b"data")
    raw = other.getvalue()
    assert list(archives.directory(lambda s, n: raw[s:s + n], len(raw)).values()) == [(0, 4)]
    with pytest.raises(ValueError):
        archives.directory(lambda s, n: raw[s:s + n][:-30], len(raw) - 30)


def test_packages_round_trip(spark):
    big = "é" * 600
    rows = [(1, "http://a", big), (3, "http://b\r\nX: 1", big), (2, None, big), (4, "u", None), (5, "u", "<p>"), (6, "u", "<p>"), (3, "u", big), (None, "u", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    packages = archives.write_packages(df, limit=300)
    got = sorted(((r["id"], r["record_type"], r["refers_to"], r["payload_bytes"], bytes(r["block"])) for r in archives.read_package_files(packages).collect()), key=str)
    text = big.encode()
    assert got == sorted([(1, "revisit", 3, 1200, b""), (3, "response", None, 1200, text), (2, "revisit", 3, 1200, b""), (4, "response", None, 0, b""),
                          (5, "response", None, 3, b"<p>"), (6, "response", None, 3, b"<p>"), (3, "response", None, 1200, text),
                          (None, "revisit", 3, 1200, b"")], key=str)
    assert archives.read_package_files(archives.write_packages(df.limit(0))).count() == 0
    # The same records from the bytes, as Spark's binary file source gives them.
    files = spark.read.format("binaryFile").load([r["path"] for r in packages.collect()])
    columns = ["id", "url", "record_id", "refers_to_record", "block"]
    by_bytes = sorted(map(str, archives.read_packages(files).select(*columns).collect()))
    records = archives.read_package_files(packages).select(*columns).collect()
    assert by_bytes == sorted(map(str, records)) and packages.count() > 1
    # Every revisit names a record that exists.
    ids = {r["record_id"] for r in records}
    assert {r["refers_to_record"] for r in records} - {None} <= ids and len(ids) == 7


def test_packages_without_a_usable_index_are_errors(spark):
    for members in ([("a.warc.gz", zipfile.ZIP_STORED)], [("a.warc.gz", zipfile.ZIP_STORED), ("a.cdxj", zipfile.ZIP_DEFLATED)],
                    [("a.warc", zipfile.ZIP_DEFLATED), ("a.idx", zipfile.ZIP_STORED)]):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as file:
            for name, kind in members:
                file.writestr(name, b"content", kind)
        with pytest.raises(ValueError, match="no stored index"):
            list(archives.read_records(lambda s, n: data.getvalue()[s:s + n], len(data.getvalue())))


def test_only_ranges_of_a_package_are_read():
    pages_ = [f"page {i} " * 400 for i in range(200)]
    package, index, body = archives.Package(), [], b""
    for i, page in enumerate(pages_):
        digest = hashlib.sha1(page.encode()).hexdigest()
        record = archives.gzip_member(archives.warc_record("response", f"u{i}", page.encode(), [
            ("WARC-Record-ID", archives.record_id(digest, str(i))), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(page)))]), 0)
        entry = {"filename": archives.WARC, "offset": len(body), "length": len(record)}
        index.append(f"u{i} x {json.dumps(entry)}\n")
        body += record
    package.add(archives.WARC, body), package.add(archives.INDEX, "".join(index).encode())
    data, asked = package.close(), []

    def fetch(start, length):
        asked.append(length)
        return data[start:start + length]

    assert [block.decode() for _, _, block in archives.read_records(fetch, len(data))] == pages_
    assert max(asked) < len(data) / 5 and sum(asked) < len(data) + 3 * 65_600


def test_pipeline_steps_take_effect(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    ids = [r["doc_id"] for r in out.collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r["id"] for r in quality.judge_quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["kept"]}
    assert 0 < len(ids) == len(set(ids)) and set(ids) < good
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "tokens"]
