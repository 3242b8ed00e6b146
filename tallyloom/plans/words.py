"""Queries on words, n-grams and sorted lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.operators import counts as C
from tallyloom.operators import ngrams as N
from tallyloom.operators.ordered import run_lengths
from tallyloom.plans.registry import query
from tallyloom.session import read_table, saved, spread

# Tokens as the SQL check states them.
SQL_TOKENS = r"""list_transform(list_filter(regexp_split_to_array({0}, '[^\p{{L}}]+'),
    lambda w: w <> ''), lambda w: lower(w))"""
SQL_WORDS = f"SELECT unnest({SQL_TOKENS.format('text')}) AS word FROM documents"
SQL_COUNTS = f"SELECT word, count(*) AS count FROM ({SQL_WORDS}) GROUP BY word"


def sql_ngrams(n: int) -> str:
    """N-grams by lead over the word positions of a document."""
    joined = " || ' ' || ".join(
        ["word"] + [f"lead(word, {i}) OVER w" for i in range(1, n)]
    )
    return f"""SELECT doc_id, pos, ngram FROM (
      SELECT doc_id, pos, {joined} AS ngram FROM (
        SELECT doc_id, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS pos
        FROM (SELECT doc_id, {SQL_TOKENS.format('text')} AS t FROM documents))
      WINDOW w AS (PARTITION BY doc_id ORDER BY pos)) WHERE ngram IS NOT NULL"""


def _documents(spark, sf_dir):
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def word_counts(spark, sf_dir):
    return C.count_words(_documents(spark, sf_dir), "text")


@query("word_count", SQL_COUNTS)
def word_count(spark, sf_dir):
    return word_counts(spark, sf_dir)


@query("word_count_raw", """SELECT word, count(*) AS count
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""")
def word_count_raw(spark, sf_dir):
    return C.count_items(_documents(spark, sf_dir), X.space_pieces(F.col("text")))


@query("word_count_raw_trimmed", """SELECT word, count(*) AS count FROM (
    SELECT unnest(CASE WHEN text <> '' AND rtrim(text, ' ') = '' THEN []
                       ELSE string_split(rtrim(text, ' '), ' ') END) AS word
    FROM documents) GROUP BY word""")
def word_count_raw_trimmed(spark, sf_dir):
    return C.count_items(_documents(spark, sf_dir), X.space_pieces(F.col("text"), drop_trailing=True))


@query("topk_words", f"SELECT * FROM ({SQL_COUNTS}) ORDER BY count DESC, word LIMIT 100")
def topk_words(spark, sf_dir):
    return C.top_k(word_counts(spark, sf_dir), ["word"], 100)


@query("sort_by_count", SQL_COUNTS)
def sort_by_count(spark, sf_dir):
    return C.by_count(word_counts(spark, sf_dir), ["word"])


@query("sort_by_count_ascending", SQL_COUNTS)
def sort_by_count_ascending(spark, sf_dir):
    return C.by_count(word_counts(spark, sf_dir), ["word"], descending=False)


@query("sort_by_key", SQL_COUNTS)
def sort_by_key(spark, sf_dir):
    return word_counts(spark, sf_dir).orderBy("word")


@query("corpus_totals", f"""SELECT CAST(sum(count) AS BIGINT) AS total, count(*) AS distinct_items
    FROM ({SQL_COUNTS})""")
def corpus_totals(spark, sf_dir):
    return C.totals(word_counts(spark, sf_dir))


@query("corpus_totals_sketch")
def corpus_totals_sketch(spark, sf_dir):
    """The totals by language and over all, distinct words estimated from sketches that are kept and united."""
    documents = read_table(spark, sf_dir, "documents").select("lang", F.explode(X.words(F.col("text"))).alias("word"))
    sketches = saved(C.count_sketches(documents, "lang", "word"), "sketches")
    whole = C.sketch_totals(sketches).withColumn("lang", F.lit("all"))
    return C.sketch_totals(sketches, ["lang"]).unionByName(whole)


@query("merge_counts", f"""SELECT word, count(*) AS count FROM ({SQL_WORDS}
    UNION ALL {SQL_WORDS.replace('FROM documents', 'FROM benchmark')}) GROUP BY word""")
def merge_counts(spark, sf_dir):
    benchmark = C.count_words(read_table(spark, sf_dir, "benchmark"), "text")
    return C.merge_counts([word_counts(spark, sf_dir), benchmark], "word")


def _ngrams(spark, sf_dir, n):
    return C.extract_ngrams(_documents(spark, sf_dir), ["doc_id"], X.words(F.col("text")), n)


def _ngram_counts(spark, sf_dir, n):
    return C.count_items(_documents(spark, sf_dir), X.ngrams(X.words(F.col("text")), n), "ngram")


@query("extract_ngrams", sql_ngrams(3))
def extract_ngrams(spark, sf_dir):
    return _ngrams(spark, sf_dir, 3)


@query("extract_ngrams_k", sql_ngrams(2) + " ORDER BY doc_id, pos LIMIT 1000")
def extract_ngrams_k(spark, sf_dir):
    return C.head(_ngrams(spark, sf_dir, 2), ["doc_id", "pos"], 1000)


@query("ngram_count", f"SELECT ngram, count(*) AS count FROM ({sql_ngrams(2)}) GROUP BY ngram")
def ngram_count(spark, sf_dir):
    return _ngram_counts(spark, sf_dir, 2)


@query("ngram_topk", f"""SELECT lpad(CAST(count AS VARCHAR), 10, '0') AS padded, ngram FROM (
    SELECT ngram, count(*) AS count FROM ({sql_ngrams(13)}) GROUP BY ngram)
    ORDER BY count DESC, ngram LIMIT 5""")
def ngram_topk(spark, sf_dir):
    top = C.top_items(_documents(spark, sf_dir), X.ngrams(X.words(F.col("text")), 13), 5, "ngram")
    return top.select(X.zero_padded(F.col("count")).alias("padded"), "ngram")


SQL_ALL_LENGTHS = " UNION ALL ".join(
    f"SELECT CAST({n} AS INTEGER) AS n, ngram, count(*) AS count FROM ({sql_ngrams(n) if n > 1 else SQL_WORDS.replace('AS word', 'AS ngram')}) GROUP BY ngram"
    for n in range(1, N.LONGEST + 1))


@query("ngram_all_lengths", f"SELECT * FROM ({SQL_ALL_LENGTHS}) WHERE count >= 10")
def ngram_all_lengths(spark, sf_dir):
    """Every n-gram of one to thirteen words that occurs ten times or more, from one sort."""
    return N.ngrams_of_all_lengths(_documents(spark, sf_dir), X.words(F.col("text")), least=10)


@query("ngram_topk_long", f"""SELECT n, rank, lpad(CAST(count AS VARCHAR), 10, '0') AS padded, ngram FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY count DESC, ngram) AS INTEGER) AS rank
    FROM ({SQL_ALL_LENGTHS})) WHERE rank <= 5""")
def ngram_topk_long(spark, sf_dir):
    """The five most frequent n-grams of each length up to thirteen."""
    top = N.ngrams_of_all_lengths(_documents(spark, sf_dir), X.words(F.col("text")), k=5)
    return top.select("n", "rank", X.zero_padded(F.col("count")).alias("padded"), "ngram")


SQL_LINES = r"""SELECT conv_id, turn, pos AS line_no, line AS value FROM (
    SELECT conv_id, turn, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
    FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l FROM conversations))"""


def conversation_lines(spark, sf_dir):
    pieces = F.posexplode(F.split("text", "\n")).alias("line_no", "value")
    lines = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", pieces)
    return lines.withColumn("line_no", F.col("line_no").cast("bigint") + 1)


@query("head_k", f"SELECT * FROM ({SQL_LINES}) ORDER BY conv_id, turn, line_no LIMIT 50")
def head_k(spark, sf_dir):
    return C.head(conversation_lines(spark, sf_dir), ["conv_id", "turn", "line_no"], 50)


@query("sort_lines", f"SELECT value FROM ({SQL_LINES})")
def sort_lines(spark, sf_dir):
    return C.sort_lines(conversation_lines(spark, sf_dir).select("value"))


@query("sort_lines_desc", f"SELECT value FROM ({SQL_LINES})")
def sort_lines_desc(spark, sf_dir):
    return C.sort_lines(conversation_lines(spark, sf_dir).select("value"), descending=True)


@query("sort_lines_with_source", f"SELECT value, conv_id AS id FROM ({SQL_LINES})")
def sort_lines_with_source(spark, sf_dir):
    """Lines with the id of their source, ordered by line and then by id."""
    lines = conversation_lines(spark, sf_dir).select("value", F.col("conv_id").alias("id"))
    return lines.withColumn("_row", F.monotonically_increasing_id()).orderBy("value", "id", "_row").drop("_row")


def _sql_runs(keys: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}run, event_type, count(*) AS n,
      lpad(CAST(count(*) AS VARCHAR), 10, '0') AS padded FROM (
      SELECT *, CAST(sum(s) OVER ({part} ORDER BY ts, event_id) AS BIGINT) AS run FROM (
        SELECT *, CASE WHEN lag(event_type) OVER ({part} ORDER BY ts, event_id) = event_type
                       THEN 0 ELSE 1 END AS s FROM events)) GROUP BY {lead}run, event_type"""


def _runs(spark, sf_dir, keys):
    runs = run_lengths(read_table(spark, sf_dir, "events"), "event_type", keys, ["ts", "event_id"])
    return runs.withColumn("padded", X.zero_padded(F.col("n")))


@query("run_length_count", _sql_runs("user_id"))
def run_length_count(spark, sf_dir):
    return _runs(spark, sf_dir, ["user_id"])


@query("run_length_count_global", _sql_runs(""))
def run_length_count_global(spark, sf_dir):
    return _runs(spark, sf_dir, [])
