"""Secrets in texts: fixed patterns, and strings that look random; all of it DataFrame operations.

Besides three fixed kinds of spans, every run of at least ``LEAST`` letters,
digits and the signs of base64 is tested. Its encoding is the smallest alphabet
that holds all its characters. Three statistics follow: chi-squared of the
character counts against an even alphabet, the number of runs of the lower and
upper half of the alphabet, and the serial correlation of neighbours. A string
that one of them rejects as random (beyond ``LIMIT`` standard deviations) is
none.

What is left must not be ordinary writing. From the character counts of all
texts follow the mean and the deviation of the chi-squared statistic of an
ordinary string of the same alphabet and length; they grow with the length, so
a short string can hardly be told apart and a long one easily. The share of
ordinary strings that look as even as this one is its p-value, rounded up to
steps of an eighth of a deviation. Benjamini and Hochberg's procedure over all
different strings, for each class of length by itself, flags as many as keep the
share of false discoveries at ``RATE``.

Only counts reach the driver: one per character, and one per class of length
and step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import bind
from tallyloom.llm.rows import field, text_key
from tallyloom.session import saved

# The three kinds, and how long a find must be.
# The look ahead at one letter only saves time.
ASSIGN = r"""(?=[PpSsTtAa])(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_ASSIGN = 12
KINDS = ("assign", "access", "hex", "random")

LEAST = 16
RANDOM = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}"
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
# The smallest that holds a string is its encoding; each has an even number of characters.
ALPHABETS = (DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", LOWER, UPPER, UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
             UPPER + LOWER, UPPER + LOWER + DIGITS, UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_",
             UPPER + LOWER + DIGITS + "+/-_")
# Common ones first: each is taken out of the text before the next is counted.
COUNTED = "etaoinsrhldcumfpgwybvkxjqz" + DIGITS + "ETAOINSRHLDCUMFPGWYBVKXJQZ" + "-/_+"
LIMIT, RATE = 3.0, 0.05
# Classes of length by their least length; steps of an eighth of a deviation.
CLASSES, STEPS, MOST = (16, 24, 32, 48), 8, 96


def character_counts(docs: DataFrame, text: str) -> dict[str, int]:
    """How often each of the tested characters occurs in all texts: one scan, a few dozen numbers."""
    value = F.coalesce(field(docs, text), F.lit(""))
    start = F.struct(value.alias("rest"), F.array().cast("array<bigint>").alias("sizes"))
    gone = F.aggregate(F.array(*[F.lit(c) for c in COUNTED]), start, lambda a, c: F.struct(
        F.replace(a["rest"], c, F.lit("")).alias("rest"), F.array_append(a["sizes"], F.octet_length(a["rest"]).cast("long")).alias("sizes")),
        lambda a: F.array_append(a["sizes"], F.octet_length(a["rest"]).cast("long")))
    sizes = docs.select(F.posexplode(gone).alias("at", "size")).groupBy("at").agg(F.sum("size").alias("size"))
    size = {r["at"]: r["size"] for r in sizes.collect()}
    return {c: size.get(k, 0) - size.get(k + 1, 0) for k, c in enumerate(COUNTED)}


def collisions(counts: dict[str, int], alphabet: str) -> tuple[float, float]:
    """Chance that two, and that three, ordinary characters of an alphabet are equal; each counts one more than seen."""
    total = sum(counts[c] + 1 for c in alphabet)
    return (sum((counts[c] + 1) ** 2 for c in alphabet) / total ** 2, sum((counts[c] + 1) ** 3 for c in alphabet) / total ** 3)


def _by_alphabet(number: Column, values) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), number)


def encoding(string: Column) -> Column:
    """Number of the smallest alphabet that holds the string."""
    order = sorted(range(len(ALPHABETS)), key=lambda k: len(ALPHABETS[k]))
    out = F.lit(order[-1])
    for k in reversed(order[:-1]):
        out = F.when(F.translate(string, ALPHABETS[k], "") == "", F.lit(k)).otherwise(out)
    return out


def step(string: Column, counts: dict[str, int]) -> Column:
    """How unlike ordinary writing a string is, in eighths of a deviation; -1 if it is not random."""
    two, three = zip(*(collisions(counts, a) for a in ALPHABETS))

    def judged(number: Column) -> Column:
        alphabet, k = _by_alphabet(number, ALPHABETS), _by_alphabet(number, [len(a) for a in ALPHABETS])
        n, size = F.length(string).cast("double"), k.cast("double")
        squares = F.aggregate(F.split(alphabet, ""), F.lit(0).cast("long"), lambda total, c: total + bind(
            (F.octet_length(string) - F.octet_length(F.replace(string, c, F.lit("")))).cast("long"), lambda m: m * m))
        chi = size * squares / n - n
        # Twice the place in the alphabet, counted from its middle: odd, so never in between.
        places = F.transform(F.split(string, ""), lambda c: (2 * F.call_function("locate", c, alphabet) - k - 1).cast("long"))

        def neighbours(x: Column) -> Column:
            pairs = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda a, b: a * b)
            zero = F.lit(0).cast("long")
            return F.aggregate(pairs, F.struct(zero.alias("product"), zero.alias("changes")), lambda t, p: F.struct(
                (t["product"] + p).alias("product"), (t["changes"] + (p < 0).cast("long")).alias("changes")))

        def tested(found: Column) -> Column:
            root = F.sqrt(n - 1)
            uneven = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
            runs = (2 * found["changes"] - (n - 1)) / root
            serial = found["product"] / ((size * size - 1) / 3 * root)
            random = (uneven <= LIMIT) & (F.abs(runs) <= LIMIT) & (F.abs(serial) <= LIMIT)
            s2, s3 = _by_alphabet(number, two), _by_alphabet(number, three)
            mean = size + size * (n - 1) * s2 - n
            spread = 2 * size / n * F.sqrt(n * (n - 1) / 2 * (s2 - s2 * s2) + n * (n - 1) * (n - 2) * (s3 - s2 * s2))
            far = F.floor(STEPS * ((mean - chi) / spread))
            # An even alphabet has no spread; nothing can be told then.
            return F.when(random & (spread > 0), F.greatest(F.lit(-1), F.least(F.lit(MOST), far))).otherwise(F.lit(-1)).cast("int")

        return bind(bind(places, neighbours), tested)

    return bind(encoding(string), judged)


def length_class(n: Column) -> Column:
    return sum(((n >= least).cast("int") for least in CLASSES[1:]), F.lit(0))


def cutoffs(counts, rate: float) -> list[int]:
    """For each class of length the least step that is flagged; ``counts`` has (class, step, n)."""
    out = []
    for number in range(len(CLASSES)):
        steps = {s: n for c, s, n in counts if c == number}
        total, above, cut = sum(steps.values()), 0, MOST + 1
        for s in range(MOST, -1, -1):
            above += steps.get(s, 0)
            if above and math.erfc(s / STEPS / math.sqrt(2)) / 2 * total <= rate * above:
                cut = s
        out.append(cut)
    return out


def _pieces(text: Column, kind: int, pattern: str, least: Column | None = None) -> Column:
    """For each find of a pattern: kind, place, what lies before it since the last one, its length, and the string."""
    gaps, finds = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    good = F.lit(True) if least is None else None

    def listed(gap: Column) -> Column:
        def one(found: Column, at: Column) -> Column:
            keep = good if good is not None else F.length(F.regexp_extract(found, pattern, 2)) >= least
            return F.struct(F.lit(kind).alias("kind"), at.alias("at"), F.length(F.get(gap, at)).cast("long").alias("gap"),
                            F.length(found).cast("long").alias("size"), keep.alias("keep"),
                            (found if kind == 3 else F.lit(None).cast("string")).alias("string"))
        return F.transform(finds, one)

    none = F.array().cast("array<struct<kind:int,at:int,gap:bigint,size:bigint,keep:boolean,string:string>>")
    # Most texts hold no find: they are not cut.
    return F.when(text.rlike(pattern), bind(gaps, listed)).otherwise(none)


def find_secrets(docs: DataFrame, ident: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """(id, spans): for each row its spans (start, kind, stop), ordered; code points, stop exclusive.

    ``kind`` is a place in ``KINDS``. The first three are leftmost finds of
    fixed patterns, each kind by itself; the last are strings that look random
    and lie in no span of the others. Null and empty texts have no spans, and a
    null id is treated like any other. Rows that agree in id and text are
    judged once and returned as often as they occur. Other columns are ignored
    whatever their names; an empty table gives none. Whether a string counts as
    random depends on all texts of ``docs``.
    """
    counts = character_counts(docs, text)
    rows = docs.select(field(docs, ident).cast("long").alias("id"), text_key(docs, ident, text).alias("key"),
                       F.coalesce(field(docs, text), F.lit("")).alias("text"))
    finds = F.concat(_pieces(F.col("text"), 0, ASSIGN, F.lit(LEAST_ASSIGN)), _pieces(F.col("text"), 1, ACCESS),
                     _pieces(F.col("text"), 2, HEX), _pieces(F.col("text"), 3, RANDOM))
    listed = rows.select("id", "key", F.explode_outer(finds).alias("find")).select("id", "key", "find.*")
    # One exchange: repeated rows, places and lists all go by document.
    listed = listed.repartition("id", "key")
    once = listed.groupBy("id", "key", "kind", "at").agg(
        *[F.first(c).alias(c) for c in ("gap", "size", "keep", "string")], F.count("*").alias("copies"))
    order = Window.partitionBy("id", "key", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = once.withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(order)).withColumn(
        "far", F.when(F.col("kind") == 3, step(F.col("string"), counts)))
    found = F.when(F.col("keep"), F.struct(
        (F.col("stop") - F.col("size")).alias("start"), "kind", "stop", "far", length_class(F.col("size")).alias("class"),
        F.xxhash64("string").alias("name")))
    # A list takes no nulls, so a document without finds has an empty one.
    return _judged(placed.groupBy("id", "key").agg(F.max("copies").alias("copies"), F.collect_list(found).alias("finds")), rate)


def _judged(per_doc: DataFrame, rate: float) -> DataFrame:
    kept = saved(per_doc, "finds")
    strings = kept.select(F.explode("finds").alias("f")).where("f.kind = 3").select("f.name", "f.class", "f.far").dropDuplicates(["name"])
    cut = cutoffs([tuple(r) for r in strings.groupBy("class", "far").count().collect()], rate)
    fixed = F.filter("finds", lambda f: f["kind"] < 3)

    def spans(base: Column) -> Column:
        random = F.filter("finds", lambda f: (f["kind"] == 3) & (f["far"] >= F.get(F.array(*map(F.lit, cut)), f["class"]))
                          & ~F.exists(base, lambda b: (b["start"] < f["stop"]) & (f["start"] < b["stop"])))
        return F.array_sort(F.transform(F.concat(base, random), lambda f: F.struct(f["start"], f["kind"], f["stop"])))

    return kept.select("id", bind(fixed, spans).alias("spans"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def named(spans: Column) -> Column:
    """Spans as kind:start:stop, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def either_case(pattern: str) -> str:
    """A pattern with each letter in both cases, for engines that fold more than ASCII."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ASSIGN_SQL = _quoted(either_case("(password|passwd|secret|token|api_?key)") + r"""["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")
_PATTERNS_SQL = (_ASSIGN_SQL, _quoted(ACCESS), _quoted(HEX), _quoted(f"[A-Za-z0-9+/_-]{{{LEAST},}}"))
_FINDS_SQL = " UNION ALL ".join(
    f"""SELECT doc_id, {kind} AS kind, unnest(range(len(m) + 1)) AS spot, unnest(list_append(m, NULL)) AS found, unnest(g) AS gap
        FROM (SELECT doc_id, regexp_extract_all(text, {pattern}) AS m, regexp_split_to_array(text, {pattern}) AS g FROM d)"""
    for kind, pattern in enumerate(_PATTERNS_SQL))
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS (SELECT doc_id, kind, found, length(found) AS size,
        sum(length(gap) + coalesce(length(found), 0)) OVER (PARTITION BY doc_id, kind ORDER BY spot) AS stop FROM ({_FINDS_SQL})),
base AS (SELECT doc_id, kind, stop - size AS start, stop FROM f
         WHERE kind < 3 AND found IS NOT NULL AND (kind > 0 OR length(regexp_extract(found, {_ASSIGN_SQL}, 2)) >= {LEAST_ASSIGN})),
a(no, alphabet) AS (VALUES {", ".join(f"({k}, {_quoted(x)})" for k, x in sorted(enumerate(ALPHABETS), key=lambda x: len(x[1])))}),
c AS (SELECT c, 1 + sum(length(text) - length(replace(text, c, ''))) AS m
      FROM d, (SELECT unnest(string_split({_quoted(COUNTED)}, '')) AS c) GROUP BY c),
s AS (SELECT no, any_value(alphabet) AS alphabet, CAST(count(*) AS DOUBLE) AS k,
        CAST(sum(m * m) AS DOUBLE) / pow(CAST(sum(m) AS DOUBLE), 2) AS s2, CAST(sum(m * m * m) AS DOUBLE) / pow(CAST(sum(m) AS DOUBLE), 3) AS s3
      FROM (SELECT no, alphabet, unnest(string_split(alphabet, '')) AS c FROM a) JOIN c USING (c) GROUP BY no),
t AS (SELECT found, CAST(length(found) AS DOUBLE) AS n, string_split(found, '') AS x,
        (SELECT arg_min(no, (length(alphabet), no)) FROM a WHERE translate(found, alphabet, '') = '') AS no
      FROM (SELECT DISTINCT found FROM f WHERE kind = 3 AND found IS NOT NULL)),
u AS (SELECT *, list_sum(list_transform(list_distinct(x), lambda c: pow(len(list_filter(x, lambda y: y = c)), 2))) AS squares,
        list_transform(x, lambda c: 2 * strpos(alphabet, c) - CAST(k AS INT) - 1) AS place FROM t JOIN s USING (no)),
v AS (SELECT *, list_sum(list_transform(range(1, len(place)), lambda i: place[i] * place[i + 1])) AS product,
        len(list_filter(range(1, len(place)), lambda i: place[i] * place[i + 1] < 0)) AS changes, k * squares / n - n AS chi FROM u),
w AS (SELECT *, k + k * (n - 1) * s2 - n AS mean,
        2 * k / n * sqrt(n * (n - 1) / 2 * (s2 - s2 * s2) + n * (n - 1) * (n - 2) * (s3 - s2 * s2)) AS spread,
        (chi - (k - 1)) / sqrt(2 * (k - 1) * (n - 1) / n) <= {LIMIT}
        AND abs((2 * changes - (n - 1)) / sqrt(n - 1)) <= {LIMIT} AND abs(product / ((k * k - 1) / 3 * sqrt(n - 1))) <= {LIMIT} AS random FROM v),
z AS (SELECT found, {" + ".join(f"CAST(n >= {least} AS INT)" for least in CLASSES[1:])} AS class,
        CASE WHEN random AND spread > 0 THEN greatest(-1, least({MOST}, floor({STEPS} * ((mean - chi) / spread)))) ELSE -1 END AS far FROM w),
p(far, p) AS (VALUES {", ".join(f"({k}, CAST({math.erfc(k / STEPS / math.sqrt(2)) / 2!r} AS DOUBLE))" for k in range(MOST + 1))}),
h AS (SELECT class, far, count(*) AS n FROM z GROUP BY class, far),
r AS (SELECT class, far, sum(n) OVER (PARTITION BY class) AS total, sum(n) OVER (PARTITION BY class ORDER BY far DESC) AS above FROM h),
cut AS (SELECT class, min(far) AS far FROM r JOIN p USING (far) WHERE p * total <= {RATE} * above GROUP BY class),
extra AS (SELECT f.doc_id, 3 AS kind, f.stop - f.size AS start, f.stop FROM f JOIN z USING (found) JOIN cut USING (class)
          WHERE f.kind = 3 AND z.far >= cut.far),
every AS (SELECT * FROM base UNION ALL SELECT * FROM extra e WHERE NOT EXISTS (
            SELECT 1 FROM base b WHERE b.doc_id = e.doc_id AND b.start < e.stop AND e.start < b.stop)),
named AS (SELECT *, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS name FROM every)
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce(string_agg(name, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
       coalesce(string_agg(name, ',' ORDER BY start, kind), '') AS spans
FROM d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id
"""
