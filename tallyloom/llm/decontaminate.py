"""Benchmark decontamination as a prefix-filtered set join, all of it DataFrame operations.

An item's windows (runs of ``window`` words) are sets of positioned tokens that
a document must contain completely. For full containment one token is a
sufficient prefix, and the rarest one joins the fewest rows: the tokens of each
window are ordered by how often they occur in the documents, and only the first
is joined with the words of the documents. The place of that token in the window
bounds where the window can start (position) and whether it fits into the text
(length); what is left is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import with_once
from tallyloom.llm.rows import field, hinted, lowered, own_name
from tallyloom.session import saved

WINDOW = 10
# Windows of about 500 bytes that may be broadcast: 12 MB.
BROADCAST_WINDOWS = 24_000
# What stands between words.
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def item_words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of letters, digits and whatever is not ASCII.

    They come as ``lowered`` has them. Cutting at the gaps takes a tenth of the time of picking out the words.
    """
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), GAP), "")


def item_windows(items: DataFrame, ident: str, text: str, window: int) -> DataFrame:
    """(item, words): every window of every item; a shorter item is one window."""
    listed = with_once(items.select(field(items, ident).cast("string").alias("item"), field(items, text).alias("text")),
                       "all", item_words(F.col("text"))).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1)))
    return listed.select("item", "all", F.explode(starts).alias("start")).select(
        "item", F.slice("all", F.col("start"), window).alias("words"))


def _rows_with_words(docs: DataFrame, ident: str, text: str) -> DataFrame:
    return with_once(docs.select(F.monotonically_increasing_id().alias("row"), field(docs, ident).alias("id"),
                                 field(docs, text).alias("text")), "words", item_words(F.col("text"))).drop("text")


def contamination(docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  broadcast_rows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(id, n_words, n_hit, n_items, items, contaminated) for each row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of an item window,
    ``items`` lists the items with occurring windows, sorted as strings. Null
    and wordless texts have no words and no hits; items without words have no
    windows. Items with a null id count for hits but are not listed; items that
    share an id are one item. Repeated rows of ``docs`` are judged each on its
    own; other columns are ignored; empty tables give no rows, or no hits.

    Up to ``broadcast_rows`` windows, counted in the saved table, are broadcast
    and verified where a document is read. Beyond that the join shuffles single
    words, and the places it finds meet their document again; the result is the
    same.
    """
    windows = saved(item_windows(items, item_id, item_text, window).withColumn("key", F.sha2(F.to_json("words"), 256)), "windows")
    vocabulary = hinted(saved(windows.select(F.explode("words").alias("token")).distinct(), "vocabulary"))
    all_words = with_once(docs.select(field(docs, text).alias("text")), "words", item_words(F.col("text"))).select(F.explode("words").alias("token"))
    seen = saved(all_words.join(vocabulary, "token").groupBy("token").agg(F.count("*").alias("n")), "frequencies")
    tokens = windows.select("key", "words").distinct().select("key", "words", F.posexplode("words").alias("place", "token"))
    ordered = tokens.join(seen, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = ordered.groupBy("key").agg(F.min(F.struct("n", "token", "place")).alias("least"), F.first("words").alias("wanted"))
    # A window with a word that no document has cannot occur.
    prefix = saved(rarest.where("least.n > 0").select("key", "wanted", F.col("least.token").alias("token"), F.col("least.place").alias("place")), "prefixes")
    small = prefix.limit(broadcast_rows + 1).count() <= broadcast_rows
    words = _rows_with_words(docs, ident, text)
    words = words if small else saved(words, "words")
    # One more entry per row, so that every row comes through with its length.
    placed = words.select("row", "id", "words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("at", "token"))
    if small:
        met = placed.join(F.broadcast(prefix), "token", "left")
    else:
        places = placed.select("row", "at", "token").join(prefix, "token", "left").where("key is not null or token = ''")
        met = places.join(words, "row")
    start = F.col("at") - F.col("place")
    fits = (start >= 0) & (start + F.size("wanted") <= F.size("words"))
    hit = fits & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("wanted")) == F.col("wanted"))
    found = saved(met.where(hit | (F.col("token") == "")).select(
        "row", "id", F.when(F.col("token") == "", F.size("words")).alias("n_words"), start.alias("start"),
        F.size("wanted").alias("length"), "key"), "hits")
    cover = found.where("key is not null").select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
    n_hit = cover.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    touched = found.where("key is not null").select("row", "key").distinct().join(
        hinted(saved(windows.select("key", "item").distinct(), "owners"), 160), "key")
    by_item = touched.where("item is not null").select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    rows = found.where("n_words is not null").select("row", "id", F.col("n_words").cast("long").alias("n_words"))
    return rows.join(n_hit, "row", "left").join(by_item, "row", "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), F.lit(0)).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, ident: str = "doc_id", text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns kept.

    Verdicts go by the text: equal texts have equal verdicts.
    """
    key = own_name(docs, "row_key")
    keyed = docs.select(F.xxhash64(F.coalesce(field(docs, text), F.lit(""))).alias("key"), field(docs, text).alias("text"))
    judged = contamination(keyed, items, "key", "text", item_id, item_text, window)
    bad = hinted(saved(judged.where("contaminated").select(F.col("id").alias(key)).distinct(), "contaminated"))
    return docs.join(bad, F.xxhash64(F.coalesce(field(docs, text), F.lit(""))) == bad[key], "left_anti")


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT r, i, n, item FROM dw JOIN bw USING (n, s)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
