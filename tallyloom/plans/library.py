"""Queries on the documents as a searchable collection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as X
from tallyloom.functions.fields import tab_line
from tallyloom.operators import search as R
from tallyloom.plans.registry import query
from tallyloom.plans.words import SQL_TOKENS
from tallyloom.session import new_path, read_table, spread

INDEX_TIME = "2024-06-01 00:00:00"
QUERIES = {
    "q1": "la ciudad de the",
    "q2": "Tion and the eaux",
    "q3": "schen und der und",
    "q4": "que en el",
}
STOP_WORDS = ("of", "by", "la")

# Title = first line, abstract = the other lines in one; a text of one line has no abstract.
SQL_DOCUMENTS = f"""SELECT doc_id, 'http://' || source || '/' || CAST(doc_id AS VARCHAR) AS url,
    split_part(text, chr(10), 1) AS title,
    CASE WHEN position(chr(10) IN text) > 0
         THEN replace(substr(text, position(chr(10) IN text) + 1), chr(10), ' ') END AS abstract FROM documents"""
SQL_INDEXED = f"""SELECT doc_id, url, title, nullif(abstract, '') AS abstract, TIMESTAMP '{INDEX_TIME}' AS modified
    FROM ({SQL_DOCUMENTS}) WHERE title <> '' OR coalesce(abstract, '') <> ''"""


def _documents(spark, sf_dir):
    """Documents built from tab lines, as an index job reads them."""
    first_break = F.instr("text", "\n")
    rest = F.replace(F.substring(F.col("text"), first_break + 1, F.length("text")), F.lit("\n"), F.lit(" "))
    url = F.concat(F.lit("http://"), "source", F.lit("/"), F.col("doc_id").cast("string"))
    title = F.substring_index("text", "\n", 1)
    line = F.when(first_break > 0, tab_line(url, title, rest)).otherwise(tab_line(url, title))
    source = spread(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    lines = source.select("doc_id", line.alias("value"))
    modified = F.to_timestamp_ntz(F.lit(INDEX_TIME))
    return R.build_documents(lines, modified, ["doc_id"])


SQL_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL_FIELDS = f"""SELECT doc_id, field, tokens, len(tokens) AS field_length FROM (
    SELECT doc_id, field, list_filter({SQL_TOKENS.format('body')}, lambda w: w NOT IN ({SQL_STOPS})) AS tokens FROM (
      SELECT doc_id, 'title' AS field, title AS body FROM ({SQL_INDEXED})
      UNION ALL SELECT doc_id, 'abstract', abstract FROM ({SQL_INDEXED}) WHERE abstract IS NOT NULL))
    WHERE len(tokens) > 0"""
SQL_POSTINGS = f"""SELECT doc_id, field, term, count(*) AS tf, max(field_length) AS field_length FROM (
    SELECT doc_id, field, field_length, unnest(tokens) AS term FROM ({SQL_FIELDS})) GROUP BY ALL"""
SQL_TERMS = "SELECT query_id, term, count(*) AS times FROM (" + " UNION ALL ".join(
    f"SELECT '{k}' AS query_id, unnest({SQL_TOKENS.format(repr(v))}) AS term" for k, v in QUERIES.items()
) + ") GROUP BY ALL"
SQL_EXPLAIN = f"""WITH fields AS MATERIALIZED ({SQL_FIELDS}), postings AS MATERIALIZED ({SQL_POSTINGS.replace(f'({SQL_FIELDS})', 'fields')}),
    terms AS ({SQL_TERMS}), stats AS (SELECT field, count(*) AS n_docs, avg(field_length) AS avg_length FROM fields GROUP BY field),
    freqs AS (SELECT field, term, count(*) AS df FROM postings GROUP BY ALL),
    parts AS (SELECT query_id, doc_id, field, term, tf, df, ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) AS idf,
      times * (CASE field WHEN 'title' THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END
        * ln(1 + (n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
        / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * field_length / avg_length))) AS score
      FROM postings JOIN freqs USING (field, term) JOIN stats USING (field) JOIN terms USING (term))"""


@query("index_documents", SQL_INDEXED)
def index_documents(spark, sf_dir):
    path = new_path(spark, "documents")
    _documents(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@query("term_postings", SQL_POSTINGS)
def term_postings(spark, sf_dir):
    tokens = R.field_tokens(_documents(spark, sf_dir), "doc_id", list(R.BOOSTS), STOP_WORDS)
    return R.postings(tokens, "doc_id")


# The stemming rules once more, on a lower-cased word.
SQL_STEM = """CASE WHEN length(w) < 5 THEN w
    WHEN right(p, 1) IN ('o', 'a', 'e') THEN left(p, length(p) - 1) WHEN right(p, 4) = 'eses' THEN left(p, length(p) - 2)
    WHEN right(p, 3) = 'ces' THEN left(p, length(p) - 3) || 'z' WHEN right(p, 2) IN ('os', 'as', 'es') THEN left(p, length(p) - 2)
    ELSE p END"""
SQL_STEMMED = f"""SELECT doc_id, field, term, count(*) AS tf, max(field_length) AS field_length FROM (
    SELECT doc_id, field, field_length, {SQL_STEM} AS term FROM (
      SELECT *, translate(w, 'àáâäòóôöèéêëùúûüìíîï', 'aaaaooooeeeeuuuuiiii') AS p FROM (
        SELECT doc_id, field, field_length, unnest(tokens) AS w FROM ({SQL_FIELDS})))) GROUP BY ALL"""


@query("term_postings_stemmed", SQL_STEMMED)
def term_postings_stemmed(spark, sf_dir):
    """Postings of light stems, stop words taken out first."""
    tokens = R.field_tokens(_documents(spark, sf_dir), "doc_id", list(R.BOOSTS), STOP_WORDS, X.spanish_stem)
    return R.postings(tokens, "doc_id")


@query("term_statistics", f"SELECT field, term, count(*) AS df FROM ({SQL_POSTINGS}) GROUP BY ALL")
def term_statistics(spark, sf_dir):
    return R.document_frequencies(term_postings(spark, sf_dir))


@query("field_statistics", f"""SELECT field, count(*) AS n_docs, round(avg(field_length), 6) AS avg_length
    FROM ({SQL_FIELDS}) GROUP BY field""")
def field_statistics(spark, sf_dir):
    tokens = R.field_tokens(_documents(spark, sf_dir), "doc_id", list(R.BOOSTS), STOP_WORDS)
    return R.field_statistics(tokens).withColumn("avg_length", F.round("avg_length", 6))


SQL_TOPK = SQL_EXPLAIN + """ SELECT query_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
      SELECT query_id, doc_id, round(max(s), 6) AS score FROM (
        SELECT query_id, doc_id, field, sum(score) AS s FROM parts GROUP BY ALL) GROUP BY ALL))
    WHERE rank <= 10"""


@query("search_topk", SQL_TOPK)
def search_topk(spark, sf_dir):
    return R.search(_documents(spark, sf_dir), "doc_id", R.query_table(spark, QUERIES), stop_words=STOP_WORDS)


@query("search_from_postings", SQL_TOPK)
def search_from_postings(spark, sf_dir):
    """The same hits from postings that were written before; blocks that cannot reach the top are not read."""
    table = R.PostingsTable.write(_documents(spark, sf_dir), "doc_id", new_path(spark, "postings-table"), stop_words=STOP_WORDS)
    return table.search(R.query_table(spark, QUERIES))


@query("search_explain", SQL_EXPLAIN + """ SELECT query_id, doc_id, field, term, tf, df, round(idf, 6) AS idf,
    round(score, 6) AS score FROM parts""")
def search_explain(spark, sf_dir):
    parts = R.explain(_documents(spark, sf_dir), "doc_id", R.query_table(spark, QUERIES), stop_words=STOP_WORDS)
    return parts.withColumn("idf", F.round("idf", 6)).withColumn("score", F.round("score", 6))
