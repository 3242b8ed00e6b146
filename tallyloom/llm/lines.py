"""Near-duplicate lines: an exact set-similarity join, all of it DataFrame operations.

A line is the set of its words. Words are ordered by rarity, taken from a table
of word counts of fixed size (hashed, so a count may be too high, never too
low; any order that is the same for all lines gives the exact result, rarity
only makes it fast). Two sets that are similar enough share a word among the
first few of both. Candidates must pass the length bound, the bound given by
the places of the first shared word, and a bound from parity masks of 64 bits,
or 128 for longer lines (the bits in which two masks differ never outnumber the
words in which the sets differ). Common words have a list for each class of
sizes, so that sets of very different sizes do not meet at all. What is left is
verified on the full sets.

Equal sets count once. Near copies are mostly settled before all lists of words
are made: sets that agree in the smallest or the largest hash of their rarer
words form a group, and each meets the earliest few of its groups. Those that
are near another then meet the earliest few in the lists of their words. Only
pairs whose later line is still unsettled are looked for in all lists.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyloom.functions.text import bind, with_once
from tallyloom.llm.rows import field, hinted, lowered, own_name, text_key
from tallyloom.session import saved_lean as saved

SLOTS = 1 << 16
HUBS = 4
# Larger groups are dealt out in cells of about this size.
CELL = 200_000
# Lines of more words have masks of two longs.
WIDE = 32
# Numbers of words and places are kept in 15 bits; this many words or more pass the bounds on them.
MANY = (1 << 15) - 1
# A word's number: its level of frequency in the top byte, 56 bits of its hash below.
LEVEL_BITS = 56
# Words of this level and above (256 times and more) have a list for each class of sizes; a class ends at twice as many words.
COMMON = 33
CLASS = 2


def _blanked(lower: Column) -> Column:
    """Blanks for white space other than line feeds. Few texts have any: the test is cheaper than the replacements."""
    blanks = lower
    for white in "\t\x0b\f\r":
        blanks = F.replace(blanks, F.lit(white), F.lit(" "))
    return F.when(lower.rlike("[\\t\\x0B\\f\\r]"), blanks).otherwise(lower)


def _slot(word: Column) -> Column:
    return word.bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def rarity(docs: DataFrame, text: str) -> Column:
    """An array with one level per slot of hashed words: a quarter-step logarithm of their count in all texts."""
    # A generator computes a costly value once.
    lower = docs.select(F.explode(F.array(lowered(field(docs, text)))).alias("text"))
    words = lower.select(F.explode(F.split(F.replace(_blanked(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("word")).where("word <> ''")
    counted = words.groupBy(_slot(F.xxhash64("word")).alias("slot")).agg(F.count("*").alias("n"))
    levels = [0] * SLOTS
    for row in counted.collect():
        levels[row["slot"]] = min(127, 1 + int(4 * math.log2(row["n"])))
    # A constant that the optimizer folds; an array of as many literals would be a huge expression.
    # The driver keeps plans as text with all of it, so the numbers stay short.
    return F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")


def with_line_words(df: DataFrame, name: str, line: Column, levels: Column) -> DataFrame:
    """``df`` with the sorted numbers of the distinct words of a (plain) line, the rarest first.

    Lambdas are not compiled, and neither is what is computed around them: words are sorted by a generator of their own.
    """
    hashes = F.transform(F.array_remove(F.split(line, " "), ""), lambda w: F.xxhash64(w))
    numbers = F.transform(hashes, lambda w: F.call_function("shiftleft", F.get(levels, _slot(w)), F.lit(LEVEL_BITS)).bitwiseOR(
        F.call_function("shiftrightunsigned", w, F.lit(64 - LEVEL_BITS))))
    return with_once(with_once(df, "numbers", numbers), name, F.sort_array(F.array_distinct("numbers"))).drop("numbers")


def _keyed(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """(doc, key, text): the key reads the whole text and is taken once per document."""
    return docs.where(field(docs, ident).isNotNull()).select(
        field(docs, ident).cast("long").alias("doc"), text_key(docs, ident, text).alias("key"), field(docs, text).alias("text"))


def _split_lines(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """(doc, key, no, line): every line of every text, in plain form."""
    lower = _keyed(docs, ident, text).select("doc", "key", F.explode(F.array(lowered(F.col("text")))).alias("text"))
    return lower.select("doc", "key", F.posexplode(F.split(_blanked(F.col("text")), "\n", -1)).alias("no", "line"))


def _masks(words: Column) -> list[Column]:
    """Two longs: the parity mask of 128 bits of a longer line; of a shorter one 64 bits and a zero.

    The exclusive or of both is the mask of 64 bits in either case.
    """
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    # Lambdas are not compiled: these take as few steps a word as they can.
    def flipped(bits: Column, w: Column) -> Column:
        return bits.bitwiseXOR(F.call_function("shiftleft", one, w.bitwiseAND(F.lit(63)).cast("int")))

    def flipped_upper(bits: Column, w: Column) -> Column:
        return F.when(w.bitwiseAND(F.lit(64)) == 0, bits).otherwise(flipped(bits, w))

    every = F.aggregate(words, none, flipped)
    upper = F.when(F.size(words) > WIDE, F.aggregate(words, none, flipped_upper)).otherwise(none)
    return [every.bitwiseXOR(upper), upper]


def _bare_half(words: Column) -> Column:
    """The rarer half of the words, levels aside."""
    half = F.slice(words, F.lit(1), F.floor((F.size(words) + 1) / 2).cast("int"))
    return F.transform(half, lambda w: w.bitwiseAND(F.lit((1 << LEVEL_BITS) - 1)))


def _needed(n: Column, m: Column, percent: int) -> Column:
    """Words that two sets of n and m words must share: ceil(t / (1 + t) * (n + m))."""
    total = (n + m) * percent
    return F.floor((total + (100 + percent - 1)) / (100 + percent)).cast("int")


def _prefix(n: Column, percent: int) -> Column:
    """How many of the rarest words must be looked at: n - ceil(t * n) + 1."""
    return n - F.floor((n * percent + 99) / 100).cast("int") + 1


def _close(a: str, b: str, percent: int) -> Column:
    """Length and mask bounds of two sets, given the prefixes of their columns."""
    n, m = F.col(f"{a}n"), F.col(f"{b}n")
    apart = [F.col(f"{a}m{k}").bitwiseXOR(F.col(f"{b}m{k}")) for k in range(2)]
    narrow = F.bit_count(apart[0].bitwiseXOR(apart[1]))
    wide = F.bit_count(apart[0]) + F.bit_count(apart[1])
    need = _needed(n, m, percent)
    return ((F.least(n, m) * 100 >= F.greatest(n, m) * percent) & ((n != m) | (need < n))
            & (F.when((n > WIDE) & (m > WIDE), wide).otherwise(narrow) <= n + m - 2 * need))


def _settled(pairs: DataFrame, firsts: DataFrame, docs: DataFrame, ident: str, text: str, percent: int, levels: Column) -> tuple[DataFrame, DataFrame]:
    """(name) of sets with an earlier similar set among the candidate ``pairs`` (a, b), and (name) of all sets in them."""
    pairs = saved(pairs.distinct(), "pairs")
    names = saved(pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct(), "names")
    known = saved(firsts.join(hinted(names), "name").select(F.col("name"), F.col("first"), F.col("first.doc").alias("doc"),
                                                            F.col("first.key").alias("key"), F.col("first.no").alias("no")), "first")
    # Only the first line of each set is taken up again, and only texts that hold one are cut.
    holding = _keyed(docs, ident, text).join(hinted(known.select("doc", "key").distinct()), ["doc", "key"], "left_semi")
    near = holding.select("doc", "key", F.posexplode(F.split("text", "\n", -1)).alias("no", "line")).join(hinted(known), ["doc", "key", "no"])
    lower = near.select("name", "first", F.explode(F.array(lowered(F.col("line")))).alias("line"))
    full = with_line_words(lower, "h", _blanked(F.col("line")), levels).select("name", "first", "h").dropDuplicates(["name"])
    full = saved(full, "full")
    one, two = (full.select(F.col("name").alias(s), F.col("h").alias(f"{s}_h"), F.col("first").alias(f"{s}_first")) for s in "ab")
    both = pairs.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("a_h", "b_h"))
    similar = shared * 100 >= (F.size("a_h") + F.size("b_h") - shared) * percent
    late = F.when(F.col("a_first") < F.col("b_first"), F.col("b")).otherwise(F.col("a"))
    return saved(both.where(similar).select(late.alias("name")).distinct(), "settled"), names


def _marked(sets: DataFrame, settled: DataFrame) -> DataFrame:
    """``sets`` with ``done``: 1 for the settled ones, else 0."""
    marks = settled.select(F.col("name").alias("settled"))
    return sets.join(hinted(marks), sets["name"] == marks["settled"], "left").withColumn("done", F.col("settled").isNotNull().cast("long")).drop("settled")


def _met(sets: DataFrame, groups: str, percent: int) -> DataFrame:
    """(a, b): each set that is not done with the earliest sets of its groups, where the bounds allow them to be similar."""
    own = ["doc", "name", "n", "m0", "m1"]
    done = F.col("done") if "done" in sets.columns else F.lit(0)
    members = sets.select(F.explode(groups).alias("group"), *own, done.alias("done"))
    large = saved(members.groupBy("group").count().where(F.col("count") > CELL), "groups")
    large = large.select(F.col("group").alias("dealt"), F.ceil(F.col("count") / CELL).alias("cells"))
    members = members.join(hinted(large), F.col("group") == F.col("dealt"), "left")
    members = members.withColumn("cell", F.coalesce(F.pmod("name", "cells"), F.lit(0))).drop("dealt", "cells")
    whole = Window.partitionBy("group", "cell").orderBy("doc", "name").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct(*own)
    hubs = F.array(*[F.nth_value(me, k).over(whole) for k in range(1, HUBS + 1)])
    asked = members.select(*own, "done", hubs.alias("hubs"), F.count("*").over(whole).alias("c")).where("c > 1 and done = 0")
    asked = asked.select(*own, F.explode("hubs").alias("hub"))
    earlier = (F.col("hub.doc") < F.col("doc")) | ((F.col("hub.doc") == F.col("doc")) & (F.col("hub.name") < F.col("name")))
    return asked.where(earlier & _close("", "hub.", percent)).select(F.col("name").alias("a"), F.col("hub.name").alias("b"))


def _size_class(n: Column, percent: int) -> Column:
    """The class of a number of words. Of two similar sets the smaller one is in the class of the larger or in the one below."""
    return F.floor(F.log(n) / math.log(max(CLASS, 101 / max(percent, 1)))).cast("int")


def _entries(sets: DataFrame, percent: int) -> DataFrame:
    """(spot, doc, name, m0, m1): sets in the lists of the words of their prefixes.

    The list of a common word is split by the size of the sets: each is in the
    list of its class, and a guest in that of the next class if it may be
    similar to a set there. ``spot`` holds list, guest or not, number of words,
    place and mark in one long: the shuffle of the entries is the largest of the job.
    """
    capped = F.least("n", F.lit(MANY))
    mine = _size_class(capped, percent)
    most = F.least(F.floor(F.col("n") * 100 / max(percent, 1)), F.lit(MANY))
    own = sets.select("doc", "name", "n", "m0", "m1", "done", "rare", mine.alias("class"), (_size_class(most, percent) > mine).alias("reaches"))
    entries = own.select("doc", "name", "n", "m0", "m1", "done", "class", "reaches", F.posexplode("rare").alias("at", "word"))

    def shifted(value: Column, bits: int) -> Column:
        return F.call_function("shiftleft", value.cast("long"), F.lit(bits))

    level = F.call_function("shiftrightunsigned", F.col("word"), F.lit(LEVEL_BITS - 32))
    none, one = F.lit(0), F.lit(1)
    entries = entries.withColumn("common", level >= COMMON).withColumn(
        "guest", F.explode(F.when(F.col("common") & F.col("reaches"), F.array(none, one)).otherwise(F.array(none))))
    # Lists whose hashes meet are one list, which only adds pairs to look at.
    named = F.when(F.col("common"), F.hash("word", F.col("class") + F.col("guest"))).otherwise(F.col("word"))
    spot = (shifted(named, 32) + shifted(F.col("guest"), 31) + shifted(F.least("n", F.lit(MANY)), 16)
            + shifted(F.least("at", F.lit(MANY)), 1) + F.col("done"))
    return entries.select(spot.alias("spot"), "doc", "name", "m0", "m1")


def _listed(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): sets that share a word of their prefixes, the later unsettled, where the bounds allow them to be similar; ``a`` is the larger."""
    entries = _entries(sets, percent)

    def word(side: str) -> Column:
        return F.call_function("shiftright", F.col(f"{side}.spot"), F.lit(32)).cast("int")

    def part(side: str, bits: int, mask: int = MANY) -> Column:
        return F.call_function("shiftright", F.col(f"{side}.spot"), F.lit(bits)).bitwiseAND(F.lit(mask))

    # Both sides of the join are the same rows, so they are shuffled once; a condition on one side alone would shuffle them twice.
    # The test of a pair is kept short, or it would not be compiled: no value is computed once for several uses here.
    n, i, m, j = part("a", 16), part("a", 1), part("b", 16), part("b", 1)
    larger = F.when((n > m) | ((n == m) & (F.col("a.name") < F.col("b.name"))), part("a", 31, 1) == 0).otherwise(F.lit(False))
    # The first word that two sets share has enough words left behind it in both: percent / (100 + percent) of n + m.
    placed = ((m - j) * (100 + percent) >= (n + m) * percent) & ((n - i) * (100 + percent) >= (n + m) * percent)
    # The later of both must be unsettled; of two lines in one document either.
    asked = (((F.col("a.doc") >= F.col("b.doc")) & (part("a", 0, 1) == 0)) | ((F.col("b.doc") >= F.col("a.doc")) & (part("b", 0, 1) == 0)))
    apart = [F.col(f"a.m{k}").bitwiseXOR(F.col(f"b.m{k}")) for k in range(2)]
    differ = F.when(m > WIDE, F.bit_count(apart[0]) + F.bit_count(apart[1])).otherwise(F.bit_count(apart[0].bitwiseXOR(apart[1])))
    bounds = (n == MANY) | (placed & (differ * (100 + percent) <= (n + m) * (100 - percent)))
    met = entries.alias("a").join(entries.alias("b"), (word("a") == word("b")) & bounds & larger & asked)
    return met.select(F.col("a.name").alias("a"), F.col("b.name").alias("b"))


def removed_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """(doc, key, no): lines that go, see ``dedup_lines``."""
    levels = rarity(docs, text)
    place = F.struct("doc", "key", "no")
    hashed = with_line_words(_split_lines(docs, ident, text), "h", F.col("line"), levels).select("doc", "key", "no", "h")
    hashed = with_once(hashed.where(F.size("h") > 0), "half", _bare_half(F.col("h")))
    size = F.size("h")
    # The level and 24 bits of a word's number name its list; words that share them share a list.
    short = F.transform(F.slice("h", F.lit(1), _prefix(size, percent)), lambda w: F.call_function("shiftrightunsigned", w, F.lit(32)).cast("int"))
    # Sets so small that one word more or less is too much are similar to no other.
    some = size * 100 >= (size + 1) * percent
    # Hashes of the smallest and of the largest word of the rarer half.
    groups = F.array(*[F.hash(m("half")) for m in (F.array_min, F.array_max)])
    lines = saved(hashed.select(
        "doc", "key", "no", F.xxhash64("h").alias("name"), size.alias("n"), *[m.alias(f"m{k}") for k, m in enumerate(_masks(F.col("h")))],
        F.when(some, short).alias("rare"), F.when(some, groups).alias("groups")), "lines")
    named = lines.select("doc", "key", "no", "name")
    own = ["n", "m0", "m1", "rare", "groups"]
    sets = lines.groupBy("name").agg(F.min(place).alias("first"), F.first(F.struct(*own)).alias("it"))
    sets = saved(sets.select("name", "first", F.col("first.doc").alias("doc"), *[F.col(f"it.{c}").alias(c) for c in own]), "sets")
    firsts = sets.select("name", "first")
    settled, near = _settled(_met(sets, "groups", percent), firsts, docs, ident, text, percent, levels)
    again, _ = _settled(_met(_marked(sets.join(hinted(near), "name"), settled), "rare", percent), firsts, docs, ident, text, percent, levels)
    settled = saved(settled.union(again), "settled")
    late, _ = _settled(_listed(_marked(sets, settled), percent), firsts, docs, ident, text, percent, levels)
    gone = saved(settled.union(late).distinct().withColumn("gone", F.lit(True)), "gone")
    judged = named.join(firsts, "name").join(hinted(gone), "name", "left")
    return judged.where(F.col("gone") | (place != F.col("first"))).select("doc", "key", "no")


def dedup_lines(docs: DataFrame, ident: str = "doc_id", text: str = "text", percent: int = 80,
                counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with its text less repeated lines, all other columns kept.

    Lines are split at line feeds; their words are runs of anything but ASCII
    white space, A-Z lower-cased, as sets. A line with words goes when an
    earlier line (smaller id, then place) is similar: 100 * shared >=
    ``percent`` * united words; of few words that means equal. Earlier lines
    count whether they stay or not. Lines without words stay. Remaining lines keep their order and their line
    feeds. ``counts`` names two more columns: lines, removed lines.

    Null texts stay null and have no lines; an empty text has one empty line.
    Rows with a null id neither lose lines nor make others lose any. Rows that
    agree in id and text are one document; a repeated id with other texts is
    ordered by a hash of the text. An empty table gives an empty table.
    """
    removed = removed_lines(docs, ident, text, percent).distinct().groupBy("doc", "key").agg(F.collect_list("no").alias("nos"))
    doc, key, nos = (own_name(docs, n) for n in ("line_doc", "line_key", "line_nos"))
    removed = removed.select(F.col("doc").alias(doc), F.col("key").alias(key), F.col("nos").alias(nos))
    joined = docs.join(removed, (field(docs, ident).cast("long") == removed[doc]) & (text_key(docs, ident, text) == removed[key]), "left")
    split = F.split(field(docs, text), "\n", -1)
    stay = bind(split, lambda all_: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), F.col(nos)), lambda i: F.get(all_, i)), "\n"))
    columns = [F.when(F.col(nos).isNull(), field(docs, c)).otherwise(stay).alias(c) if c == text else field(docs, c) for c in docs.columns]
    if counts:
        columns += [F.coalesce(F.when(field(docs, text).isNotNull(), F.size(split)), F.lit(0)).cast("long").alias(counts[0]),
                    F.coalesce(F.when(F.col(nos).isNotNull(), F.size(nos)), F.lit(0)).cast("long").alias(counts[1])]
    return joined.select(*columns)


SQL = r"""
WITH l AS (
  SELECT doc_id, no, line, list_distinct(list_filter(regexp_split_to_array(
           translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '')) AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents)),
s AS (SELECT array_to_string(list_sort(w), ' ') AS k, min((doc_id, no)) AS first, any_value(list_sort(w)) AS w FROM l WHERE len(w) > 0 GROUP BY 1),
n AS (SELECT row_number() OVER () AS id, k, first, w, len(w) AS n FROM s),
t AS (SELECT id, n, first, unnest(w) AS x FROM n),
p AS (SELECT b.id AS id FROM t a JOIN t b ON a.x = b.x AND a.first < b.first AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80
      GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
g AS (SELECT k, first, id IN (SELECT id FROM p) AS gone FROM n),
j AS (SELECT l.doc_id, l.no, l.line, coalesce(g.gone OR (l.doc_id, l.no) <> g.first, false) AS away
      FROM l LEFT JOIN g ON len(l.w) > 0 AND g.k = array_to_string(list_sort(l.w), ' '))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(away AS INT)) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT away), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
