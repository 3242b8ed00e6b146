"""Ranked keyword search over documents with several fields, as batch jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.fields import tab_fields
from tallyloom.functions.text import bind, with_once, words
from tallyloom.session import broadcast_if_small, saved

# Field boosts, hits per query, and the constants of the score.
BOOSTS = {"title": 5.0, "abstract": 1.0}
TOP = 10
K1, B = 1.2, 0.75
# Documents in a block of stored postings; asked terms that are pushed down to the scan one by one.
BLOCK = 128
PUSHED_TERMS = 1000


def spanish_stop_words() -> list[str]:
    """The stop-word list that comes with Spark."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords("spanish")


def build_documents(lines: DataFrame, modified: Column, keep: Sequence[str] = (),
                    column: str = "value") -> DataFrame:
    """url, title, abstract (null if absent), modified from tab lines of two fields or more."""
    written = lines.select(*keep, column).where(F.trim(column) != "")
    kept = with_once(written, "_f", tab_fields(F.col(column), True)).where(F.size("_f") >= 2)
    return kept.select(*keep, F.get("_f", F.lit(0)).alias("url"), F.get("_f", F.lit(1)).alias("title"),
                       F.get("_f", F.lit(2)).alias("abstract"), modified.alias("modified"))


def field_tokens(documents: DataFrame, key: str, fields: Sequence[str], stop_words: Sequence[str] = (),
                 stem: Callable[[Column], Column] | None = None) -> DataFrame:
    """key, field, tokens, field_length; fields without a token are left out.

    Stop words leave before ``stem`` is applied to what stays.
    """

    def entry(field: str) -> Column:
        tokens = words(F.col(field))
        if stop_words:
            tokens = F.filter(tokens, lambda w: ~w.isin(*stop_words))
        if stem is not None:
            tokens = F.transform(tokens, stem)
        return F.struct(F.lit(field).alias("field"), tokens.alias("tokens"))

    # Exploding the finished tokens computes them once, whatever reads them.
    one = documents.select(key, F.explode(F.array(*[entry(f) for f in fields])).alias("e"))
    sized = one.select(key, "e.field", "e.tokens", F.size("e.tokens").cast("bigint").alias("field_length"))
    return sized.where(F.col("field_length") > 0)


def postings(tokens: DataFrame, key: str) -> DataFrame:
    """key, field, term, tf, field_length."""
    words_of = tokens.select(key, "field", "field_length", F.explode("tokens").alias("term"))
    return words_of.groupBy(key, "field", "term").agg(
        F.count(F.lit(1)).alias("tf"), F.max("field_length").alias("field_length"))


def counted_terms(tokens: Column) -> Column:
    """The distinct tokens of an array in order, each a struct of term and tf: neighbours once the array is sorted."""

    def counted(t: Column) -> Column:
        places = F.when(F.size(t) > 0, F.sequence(F.lit(1), F.size(t)))
        starts = F.filter(places, lambda i: (i == 1) | (F.get(t, i - 1) != F.get(t, i - 2)))
        return bind(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(t, i - 1).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(t) + 1) - i).alias("tf"))))

    return bind(F.array_sort(tokens), counted)


def document_frequencies(posted: DataFrame) -> DataFrame:
    return posted.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def field_statistics(tokens: DataFrame) -> DataFrame:
    """field, n_docs, avg_length: one row per field."""
    return tokens.groupBy("field").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("field_length").alias("avg_length"))


def query_terms(queries: DataFrame, query_id: str = "query_id", text: str = "query") -> DataFrame:
    """query_id, term, times: a word asked for twice weighs twice."""
    terms = queries.select(F.col(query_id).alias("query_id"), F.explode(words(F.col(text))).alias("term"))
    return terms.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))


def _parts(documents: DataFrame, key: str, queries: DataFrame, boosts: Mapping[str, float],
           stop_words: Sequence[str]) -> DataFrame:
    """The rows of ``explain`` with a number of their own for each document (``_row``).

    The scan tokenizes each text once and leaves, per document and field, one
    row with the length and one per occurrence of an asked term.
    """
    asked = saved(query_terms(queries), "query-terms")
    numbered = documents.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key")).alias("_doc"), *boosts)
    tokens = field_tokens(numbered, "_doc", list(boosts), stop_words)
    words_of = tokens.select("_doc", "field", "field_length", F.posexplode("tokens").alias("_at", "_word"))
    terms = asked.select("term").distinct()
    met = words_of.join(broadcast_if_small(terms), F.col("_word") == F.col("term"), "left").where("term IS NOT NULL OR _at = 0")
    matches = saved(met.select("_doc.*", "field", "field_length", "_at", "term"), "matches")
    posted = saved(matches.where("term IS NOT NULL").groupBy("row", "key", "field", "term").agg(
        F.count(F.lit(1)).alias("tf"), F.max("field_length").alias("field_length")), "postings")
    # At most one row per asked term and field, and one per field.
    frequencies = broadcast_if_small(saved(document_frequencies(posted), "frequencies"))
    statistics = F.broadcast(saved(field_statistics(matches.where("_at = 0")), "field-statistics"))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    length = 1 - B + B * F.col("field_length") / F.col("avg_length")
    scored = posted.join(frequencies, ["field", "term"]).join(statistics, "field").withColumn("idf", idf).withColumn("length", length)
    scored = scored.withColumn("_part", _part(_boost(boosts)))
    return scored.join(broadcast_if_small(asked), "term").select(
        F.col("row").alias("_row"), "query_id", F.col("key").alias(key), "field", "term", "tf", "df", "idf",
        (F.col("times") * F.col("_part")).alias("score"))


def explain(documents: DataFrame, key: str, queries: DataFrame, boosts: Mapping[str, float] = BOOSTS,
            stop_words: Sequence[str] = ()) -> DataFrame:
    """query_id, key, field, term, tf, df, idf, score: each term's part of a field's score.

    All queries of the table run together, however many terms they ask for.
    Every row of ``documents`` is a document, with a repeated or null key too.
    """
    return _parts(documents, key, queries, boosts, stop_words).drop("_row")


def search(documents: DataFrame, key: str, queries: DataFrame, k: int | None = TOP,
           boosts: Mapping[str, float] = BOOSTS, stop_words: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """query_id, key, score, rank: any asked term matches and the best field gives the score.

    Scores are rounded before they are ranked, so that the order of additions
    cannot decide a tie; ties go by key.
    """
    parts = _parts(documents, key, queries, boosts, stop_words)
    by_field = parts.groupBy("query_id", "_row", key, "field").agg(F.sum("score").alias("_s"))
    best = by_field.groupBy("query_id", "_row", key).agg(F.round(F.max("_s"), digits).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(key).asc(), F.col("_row").asc())
    ranked = best.withColumn("rank", F.row_number().over(order)).drop("_row")
    return ranked if k is None else ranked.where(F.col("rank") <= k)


class PostingsTable:
    """Postings written once and searched many times; no text is read at search time.

    ``postings`` has a row per term, field and block of ``BLOCK`` documents, sorted
    by term and block: the largest part of a field's score, before idf and
    boosts, that the term has in the block, and the documents with their tf and
    relative length. ``terms`` holds the idf of each. Both are Parquet, so a
    search reads the row groups of the asked terms only, and of blocks that
    cannot reach the top only the bounds.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.key = spark, path, key

    @classmethod
    def write(cls, documents: DataFrame, key: str, path: str, fields: Sequence[str] = tuple(BOOSTS),
              stop_words: Sequence[str] = (), stem: Callable[[Column], Column] | None = None) -> PostingsTable:
        spark = documents.sparkSession
        # Numbers rise along the scan; once written they are fixed.
        numbered = documents.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key")).alias("_doc"), *fields)
        tokens = field_tokens(numbered, "_doc", list(fields), stop_words, stem)
        # A row is a field of one document, so its terms are counted where they are read.
        counted = saved(tokens.select("_doc", "field", "field_length", counted_terms(F.col("tokens")).alias("_terms")), "counted-terms")
        posted = counted.select("_doc", "field", "field_length", F.explode("_terms").alias("_t")).select(
            F.col("_t.term").alias("term"), "field", F.col("_doc.row").alias("row"), F.col("_doc.key").alias(key), "_t.tf",
            F.col("field_length").cast("int").alias("field_length"))
        statistics = F.broadcast(saved(field_statistics(counted), "field-statistics"))
        idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        document_frequencies(posted).join(statistics, "field").select("term", "field", idf.alias("idf")).repartitionByRange(
            "term").sortWithinPartitions("term").write.parquet(f"{path}/terms")
        # The one shuffle of all postings: its ranges hold whole blocks.
        block = F.floor(F.col("row") / BLOCK)
        length = 1 - B + B * F.col("field_length") / F.col("avg_length")
        ranged = posted.withColumn("block", block).repartitionByRange("term", "block").join(statistics, "field").withColumn("length", length)
        blocks = ranged.groupBy("term", "field", "block").agg(
            F.max(_part(F.lit(1.0), F.lit(1.0))).alias("most"), F.collect_list(F.struct("row", key, "tf", "length")).alias("held"))
        blocks.sortWithinPartitions("term", "block").write.parquet(f"{path}/postings")
        return cls(spark, path, key)

    def search(self, queries: DataFrame, k: int = TOP, boosts: Mapping[str, float] = BOOSTS, digits: int = 6,
               first: int = 4) -> DataFrame:
        """query_id, key, score, rank as ``search`` gives them.

        The bound of a block is what a document would score that had every
        term's largest part of the block. The ``first`` blocks with the highest
        bounds give a k-th best score; other blocks are read only where their
        bound reaches it.
        """
        asked = saved(query_terms(queries), "query-terms")
        # A short list of words goes to the scan as a filter, which skips row groups.
        words_asked = [r["term"] for r in asked.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
        pushed = F.col("term").isin(words_asked) if len(words_asked) <= PUSHED_TERMS else F.lit(True)
        terms = broadcast_if_small(asked)
        boost = _boost(boosts)
        bounds = self.spark.read.parquet(f"{self.path}/postings").select("term", "field", "block", "most").where(pushed).join(terms, "term").join(self._idf(terms, pushed), ["field", "term"])
        bounds = bounds.groupBy("query_id", "block", "field").agg(F.sum(F.col("times") * boost * F.col("idf") * F.col("most")).alias("_b"))
        bounds = saved(bounds.groupBy("query_id", "block").agg(F.max("_b").alias("bound")), "bounds")
        best_first = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "block")
        chosen = saved(bounds.withColumn("_at", F.row_number().over(best_first)).where(F.col("_at") <= first).select("query_id", "block"), "first-blocks")
        scores = saved(self._scores(chosen, terms, pushed, boost, digits), "first-scores")
        by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc())
        reached = scores.withColumn("_at", F.row_number().over(by_score)).where(F.col("_at") == k).select("query_id", F.col("score").alias("_k"))
        # A rounded score may lie half a digit above its bound.
        margin = 10.0 ** -digits
        others = bounds.join(chosen, ["query_id", "block"], "left_anti").join(reached, "query_id", "left").where(
            F.col("_k").isNull() | (F.col("bound") + margin >= F.col("_k")))
        others = saved(others.select("query_id", "block"), "other-blocks")
        every = scores.unionByName(self._scores(others, terms, pushed, boost, digits))
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(self.key).asc(), F.col("row").asc())
        ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.select("query_id", self.key, "score", "rank")

    def _idf(self, terms: DataFrame, pushed: Column) -> DataFrame:
        """term, field, idf of the asked terms."""
        known = self.spark.read.parquet(f"{self.path}/terms").where(pushed)
        return broadcast_if_small(known.join(terms.select("term").distinct(), "term", "left_semi"))

    def _scores(self, blocks: DataFrame, terms: DataFrame, pushed: Column, boost: Column, digits: int) -> DataFrame:
        """query_id, row, key, score of the documents in the given blocks that hold an asked term."""
        posted = self.spark.read.parquet(f"{self.path}/postings").where(pushed).join(terms, "term").join(
            broadcast_if_small(blocks), ["query_id", "block"]).join(self._idf(terms, pushed), ["field", "term"])
        each = posted.select("query_id", "times", "field", "idf", F.explode("held").alias("_p")).select("query_id", "times", "field", "idf", "_p.*")
        part = each.withColumn("_s", F.col("times") * _part(boost))
        by_field = part.groupBy("query_id", "row", self.key, "field").agg(F.sum("_s").alias("_s"))
        return by_field.groupBy("query_id", "row", self.key).agg(F.round(F.max("_s"), digits).alias("score"))


def _boost(boosts: Mapping[str, float]) -> Column:
    boost = F.lit(None).cast("double")
    for field, value in boosts.items():
        boost = F.when(F.col("field") == field, F.lit(float(value))).otherwise(boost)
    return boost


def _part(boost: Column, idf: Column | None = None) -> Column:
    """A term's part of a field's score from tf, idf and the relative length."""
    return boost * (F.col("idf") if idf is None else idf) * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * F.col("length"))


def query_table(spark: SparkSession, queries: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(list(queries.items()), "query_id string, query string")
