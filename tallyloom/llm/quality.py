"""Quality rules whose cutoffs are certified on labelled holdouts.

Every document gets a few measures; a rule rejects a document whose measure
lies above its cutoff. Half of the labelled documents (by a hash of the id)
propose, for each stratum (language), one cutoff per rule and an order of the
rules by how much each adds. The other half certifies: with the first rules
switched on one after the other, the exact (Clopper-Pearson) upper bound for
the share of good documents rejected must stay within ``alpha``. Testing in a
fixed order and stopping at the first failure needs no correction inside a
stratum; the error level is divided by the number of strata with a proposal
(Bonferroni). With probability 1 - ``delta`` no stratum loses more than
``alpha`` of its good documents to the certified rules.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.grams import WordHasher, grams, split_words, text_bytes
from tallyloom.llm.rows import field, hinted, in_small_batches, own_name, pick
from tallyloom.session import saved

# Measures in thousandths, larger is worse.
RULES = ("symbol_rate", "shout_rate", "mark_rate", "dup_line_rate", "repeat_rate", "short")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
MARKS = b"!?"
SPACES = b" \t\n\v\f\r"
# Fixed values of the base rules.
LEAST_WORDS, REPEAT_SHARE, REPEAT_WINDOW = 20, 30, 8
CUTOFFS = (0, 5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900)


def measure(text: bytes | None, hasher: WordHasher) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Base counts and rule measures of one whole text."""
    words = split_words(text)
    n = len(words)
    if not n:
        return (0,) * len(BASE), (0,) * (len(RULES) - 1) + (1000,)
    # Bytes that start a code point and are no white space.
    data = np.frombuffer(text, dtype=np.uint8)
    kinds = np.bincount(data, minlength=256)
    points = int(kinds.sum() - kinds[0x80:0xC0].sum())
    chars = points - int(sum(kinds[c] for c in SPACES))
    symbols = int(sum(kinds[c] for c in SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    repeats = len(lines) - len(set(lines))
    gram = grams(hasher(words), REPEAT_WINDOW)
    covered = 0
    if len(gram):
        _, inverse, count = np.unique(gram, return_inverse=True, return_counts=True)
        again = count[inverse] > 1
        if again.any():
            change = np.zeros(n + 1, dtype=np.int64)
            change[:len(again)] += again
            change[REPEAT_WINDOW:] -= again[:n + 1 - REPEAT_WINDOW]
            covered = int((np.cumsum(change[:-1]) > 0).sum())
    upper, lower = int(kinds[65:91].sum()), int(kinds[97:123].sum())
    marks = int(sum(kinds[c] for c in MARKS))
    rates = (1000 * symbols // chars, 1000 * upper // max(1, upper + lower), 1000 * marks // chars,
             1000 * repeats // max(1, len(lines)), 1000 * covered // n, max(0, 1000 - 10 * n))
    return (n, chars, symbols, repeats, covered), rates


def _measures(column, hasher: WordHasher) -> list[pa.Array]:
    """The columns of ``BASE`` and ``RULES`` for a column of texts."""
    rows = [sum(measure(text, hasher), ()) for text in text_bytes(column)]
    fresh = np.array(rows, dtype=np.int64).reshape(len(rows), len(BASE) + len(RULES))
    return [pa.array(fresh[:, k]) for k in range(fresh.shape[1])]


def _measured(batches):
    hasher = WordHasher()
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *_measures(batch.column(batch.num_columns - 1), hasher)],
            names=[*batch.schema.names[:-1], *BASE, *RULES])


def _measured_beside(place: int):
    def run(batches):
        """Every column stays; the text is the one at ``place``."""
        hasher = WordHasher()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *_measures(batch.column(place), hasher)],
                                             names=[*batch.schema.names, *BASE, *RULES])

    return run


MEASURED = ", ".join(f"{name} long" for name in (*BASE, *RULES))


def measured(docs: DataFrame, ident: str, text: str, stratum: str) -> DataFrame:
    """(id, stratum, base counts, rule measures) for each row; the texts are left behind."""
    return in_small_batches(pick(docs, id=ident, stratum=stratum, text=text)).select(
        F.col("id").cast("long"), F.coalesce(F.col("stratum").cast("string"), F.lit("")).alias("stratum"), "text",
    ).mapInArrow(_measured, "id long, stratum string, " + MEASURED)


def base_failed() -> F.Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))


def upper_bound(wrong: int, total: int, level: float) -> float:
    """Exact upper confidence bound for a binomial share (Clopper-Pearson), by bisection."""
    if total == 0 or wrong >= total:
        return 1.0

    def tail(p: float) -> float:
        logs = [math.lgamma(total + 1) - math.lgamma(k + 1) - math.lgamma(total - k + 1)
                + k * math.log(p) + (total - k) * math.log1p(-p) for k in range(wrong + 1)]
        top = max(logs)
        return math.exp(top) * sum(math.exp(x - top) for x in logs)

    low, high = wrong / total, 1.0
    low = max(low, 1e-12)
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(middle) > level else (low, middle)
    return high


def _level(name: str):
    """How many cutoffs a measure exceeds."""
    return sum((F.col(name) > cut).cast("int") for cut in CUTOFFS)


RULE_LIST = "stratum string, rules array<int>, cuts array<int>"


def _proposed(cost: float):
    def run(key: tuple[pa.Scalar, ...], counts: pa.Table) -> pa.Table:
        """From one stratum's counts: rules that are worth it, the best first, each with the place of its cutoff."""
        count = np.zeros((2, len(RULES), len(CUTOFFS) + 1))
        for good, rule, level, n in zip(*(counts.column(c).to_pylist() for c in ("good", "rule", "level", "n"))):
            count[int(good > 0), rule, level] += n
        over = count[:, :, ::-1].cumsum(axis=2)[:, :, ::-1][:, :, 1:]
        gain = over[0] - cost * over[1]
        best = []
        for k, name in enumerate(RULES):
            # The most lenient of the best cutoffs.
            at = len(CUTOFFS) - 1 - int(np.argmax(gain[k][::-1]))
            if gain[k][at] > 0:
                best.append((-gain[k][at], name, k, at))
        best.sort()
        return pa.table({"stratum": pa.array([key[0].as_py()], pa.string()), "rules": pa.array([[k for _, _, k, _ in best]], pa.list_(pa.int32())),
                         "cuts": pa.array([[at for _, _, _, at in best]], pa.list_(pa.int32()))})

    return run


def _kept_rules(alpha: float, level: float):
    def run(batches):
        """The first rules of each stratum, as long as the bound holds with all of them switched on."""
        for batch in batches:
            rules, cuts = [], []
            for some, at, counts in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("rules", "cuts", "counts"))):
                by_first = {c["first"]: c["n"] for c in counts}
                total, wrong, kept = sum(by_first.values()), 0, 0
                for place in range(len(some)):
                    wrong += by_first.get(place + 1, 0)
                    if upper_bound(wrong, total, level) > alpha:
                        break
                    kept = place + 1
                rules.append(some[:kept]), cuts.append([CUTOFFS[c] for c in at[:kept]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("stratum")), pa.array(rules, pa.list_(pa.int32())), pa.array(cuts, pa.list_(pa.int32()))],
                names=["stratum", "rules", "cuts"])

    return run


def _hits(values) -> F.Column:
    """For each rule of the row's list whether its value lies above the cutoff."""
    return F.zip_with("rules", "cuts", lambda rule, cut: F.get(F.array(*values), rule) > cut)


def certified(stats: DataFrame, labels: DataFrame, label_id: str = "doc_id", label: str = "quality",
              alpha: float = 0.02, delta: float = 0.05, cost: float = 20.0) -> DataFrame:
    """(stratum, rules, cuts): the certified rules of each stratum, as places in ``RULES``, with their cutoffs.

    ``stats`` is the (saved) result of ``measured``; ``labels`` has 1 for good
    and 0 for bad documents. A proposed cutoff must reject bad documents worth
    more than ``cost`` times the good ones. Only documents that pass the base
    rules are judged. Null labels and ids are left out; a repeated id takes its
    largest label. Every stratum is decided by its own counts (a few hundred
    numbers), however many strata there are; one with too few labelled
    documents gets no rule. The error level is divided by the number of strata
    for which the first half of the labels proposes anything.
    """
    known = pick(labels, id=label_id, good=label).select(F.col("id").cast("long"), F.col("good").cast("int")).where(
        "id is not null and good is not null").groupBy("id").agg(F.max("good").alias("good"))
    judged = saved(stats.where(~base_failed()).join(known, "id").select(
        "stratum", "good", (F.pmod(F.xxhash64("id"), F.lit(2)) == 0).alias("proposes"),
        *[_level(name).cast("int").alias(name) for name in RULES]), "judged")
    # For each stratum and rule: good and bad documents by how many cutoffs they exceed.
    counts = judged.where("proposes").select("stratum", "good", F.posexplode(F.array(*RULES)).alias("rule", "level")).groupBy(
        "stratum", "good", "rule", "level").agg(F.count("*").alias("n"))
    proposed = saved(counts.groupBy("stratum").applyInArrow(_proposed(cost), RULE_LIST).where(F.size("rules") > 0), "proposed")
    level = delta / max(1, proposed.count())
    # The first rule that rejects each good holdout document; 0 if none does.
    held = judged.where("not proposes and good > 0").join(hinted(proposed, 128), "stratum")
    first = F.array_position(_hits(RULES), True).cast("int")
    by_first = held.select("stratum", first.alias("first")).groupBy("stratum", "first").agg(F.count("*").alias("n"))
    seen = by_first.groupBy("stratum").agg(F.collect_list(F.struct("first", "n")).alias("counts"))
    tested = proposed.join(seen, "stratum").mapInArrow(_kept_rules(alpha, level), RULE_LIST)
    return saved(tested.where(F.size("rules") > 0), "certified")


def _with_verdict(stats: DataFrame, rules: DataFrame, name: str) -> DataFrame:
    """``stats`` with the column ``name``: whether a certified rule of the row's stratum rejects it."""
    away = rules.withColumnRenamed("stratum", "ruled")
    joined = stats.join(hinted(away, 128), stats["stratum"] == away["ruled"], "left")
    return joined.withColumn(name, F.coalesce(F.exists(_hits(RULES), lambda hit: hit), F.lit(False)))


def judge_quality(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text",
                  stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """(id, base counts, base_failed, kept) for each row.

    ``kept`` is false when the base rules fail (fewer than 20 words, or more
    than 30 % of the words in repeated 8-word windows) or a certified rule
    rejects. Null and blank texts have no words and fail. A null stratum is the
    empty one; a null id is judged but never labelled. Without labels only the
    base rules decide. Other columns are ignored; an empty table gives none.
    """
    stats = saved(measured(docs, ident, text, stratum), "measures")
    rules = certified(stats, labels, alpha=alpha, delta=delta)
    failed = base_failed()
    return _with_verdict(stats, rules, "rejected").select(
        "id", *BASE, failed.alias("base_failed"), (~failed & ~F.col("rejected")).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text",
              stratum: str = "lang", alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """The rows that ``judge_quality`` keeps, all columns kept.

    The cutoffs come from a first scan; the second scan measures again instead
    of shuffling texts to their verdicts.
    """
    stats = saved(measured(docs, ident, text, stratum), "measures")
    rules = certified(stats, labels, alpha=alpha, delta=delta)
    # A text goes to its task once, among the columns of its row.
    names = [f"c{k}" for k in range(len(docs.columns))]
    carried = docs.select("*", F.coalesce(field(docs, stratum).cast("string"), F.lit("")).alias(own_name(docs, "_stratum"))).toDF(*names, "stratum")
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, (t for _, t in docs.dtypes)))
    # An exact name before one that differs in case.
    place = min(range(len(names)), key=lambda k: (docs.columns[k] != text, docs.columns[k].lower() != text.lower()))
    judged = carried.mapInArrow(_measured_beside(place), schema + ", stratum string, " + MEASURED)
    return _with_verdict(judged.where(~base_failed()), rules, "rejected").where("not rejected").select(*names).toDF(*docs.columns)
