"""Queries that write the given tables to files, scan them back, clean and parse them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import credits as CR
from tallyloom.functions import text as X
from tallyloom.functions.fields import tab_line
from tallyloom.operators import clean as K
from tallyloom.plans.registry import query
from tallyloom.plans.tables import SQL_MATCHES, _matches
from tallyloom.plans.words import SQL_LINES
from tallyloom.sources import readers as S
from tallyloom.sources import writers as W
from tallyloom.session import new_path, read_table, saved


# --- lines -------------------------------------------------------------------
def _round_trip_lines(spark, sf_dir, gzip):
    texts = read_table(spark, sf_dir, "conversations")
    return S.read_lines(spark, W.write_lines(texts, new_path(spark, "lines"), "text", gzip))


@query("scan_text", f"SELECT value FROM ({SQL_LINES})")
def scan_text(spark, sf_dir):
    return _round_trip_lines(spark, sf_dir, gzip=False)


@query("scan_text_gz", f"SELECT value, count(*) AS n FROM ({SQL_LINES}) GROUP BY value")
def scan_text_gz(spark, sf_dir):
    return _round_trip_lines(spark, sf_dir, gzip=True).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("sink_text_gz", "SELECT text AS value FROM documents WHERE position(chr(10) IN text) = 0 UNION ALL "
       "SELECT unnest(string_split(text, chr(10))) FROM documents WHERE position(chr(10) IN text) > 0")
def sink_text_gz(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    return S.read_lines(spark, W.write_lines(documents, new_path(spark, "gz"), "text", gzip=True))


# --- tab-separated relations ---------------------------------------------------
ORDERS_AS_TEXT = """SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, o_orderpriority AS priority,
    o_orderstatus AS status FROM orders"""


@query("scan_tsv_positional", ORDERS_AS_TEXT)
def scan_tsv_positional(spark, sf_dir):
    path = W.write_tsv(read_table(spark, sf_dir, "orders"), new_path(spark, "orders"),
                       ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    return S.tsv_columns(S.read_lines(spark, path), [0, 4, 2], ["orderkey", "priority", "status"])


# A status of F makes the price unreadable, which a typed scan turns to null; it is counted by group.
@query("scan_tsv_typed", """SELECT status, count(*) AS n, count(price) AS n_price,
    CAST(sum(CAST(round(price * 100) AS BIGINT)) AS BIGINT) AS cents, max(custkey) AS top_custkey FROM (
      SELECT o_orderstatus AS status, o_custkey AS custkey,
        CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS price FROM orders) GROUP BY status""")
def scan_tsv_typed(spark, sf_dir):
    bad = F.when(F.col("o_orderstatus") == "F", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    orders = read_table(spark, sf_dir, "orders").withColumn("price", bad)
    path = W.write_tsv(orders, new_path(spark, "typed"), ["o_orderstatus", "o_custkey", "price"])
    typed = S.read_tsv(spark, path, "status string, custkey bigint, price double")
    return typed.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count("price").alias("n_price"),
        F.sum(F.round(F.col("price") * 100).cast("bigint")).alias("cents"),
        F.max("custkey").alias("top_custkey"),
    )


SQL_NULLED = """SELECT p_partkey, p_name, nullif(p_type, 'PROMO') AS p_type, nullif(p_size, 7) AS p_size,
    p_retailprice FROM part"""


def _nulled_part(spark, sf_dir):
    return read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.nullif("p_type", F.lit("PROMO")).alias("p_type"),
        F.nullif("p_size", F.lit(7)).alias("p_size"), "p_retailprice")


PART_SCHEMA = "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double"


@query("scan_tsv_header_null", SQL_NULLED)
def scan_tsv_header_null(spark, sf_dir):
    path = W.write_tsv_with_header(_nulled_part(spark, sf_dir), new_path(spark, "part"))
    return S.read_tsv(spark, path, PART_SCHEMA, header=True, null_token="null")


@query("sink_tsv", """SELECT CAST(p_partkey AS VARCHAR) || chr(9) || coalesce(p_type, 'null') || chr(9) ||
    coalesce(CAST(p_size AS VARCHAR), 'null') AS value FROM (""" + SQL_NULLED + ")")
def sink_tsv(spark, sf_dir):
    path = W.write_tsv(_nulled_part(spark, sf_dir), new_path(spark, "tsv"), ["p_partkey", "p_type", "p_size"])
    return S.read_lines(spark, path)


@query("sink_csv_header", SQL_NULLED)
def sink_csv_header(spark, sf_dir):
    path = W.write_csv(_nulled_part(spark, sf_dir), new_path(spark, "csv"))
    return spark.read.schema(PART_SCHEMA).option("header", True).csv(path)


@query("sink_parquet", SQL_NULLED)
def sink_parquet(spark, sf_dir):
    return spark.read.parquet(W.write_parquet(_nulled_part(spark, sf_dir), new_path(spark, "parquet")))


@query("sink_multi", f"""SELECT 'good' AS kind, CAST(l_suppkey AS VARCHAR) AS star, CAST(good_count AS VARCHAR) AS count
    FROM ({SQL_MATCHES}) UNION ALL SELECT 'bad', CAST(l_suppkey AS VARCHAR), CAST(bad_count AS VARCHAR)
    FROM ({SQL_MATCHES})""")
def sink_multi(spark, sf_dir):
    good, bad = new_path(spark, "good"), new_path(spark, "bad")
    W.write_many(_matches(spark, sf_dir), {
        good: lambda m: m.select("l_suppkey", "good_count"),
        bad: lambda m: m.select("l_suppkey", "bad_count"),
    })

    def read(path, kind):
        columns = S.tsv_columns(S.read_lines(spark, path), [0, 1], ["star", "count"])
        return columns.select(F.lit(kind).alias("kind"), "star", "count")

    return read(good, "good").unionByName(read(bad, "bad"))


# --- cleaning: 34 tab fields per customer --------------------------------------
# Nation 3 has no place fields at all, nation 4 all but one; nation 5 lacks the last
# field, nation 6 holds an empty last field (not counted as one).
def _sql_field(i: int) -> str:
    plain = f"' v{i}-' || CAST(c_custkey AS VARCHAR) || ' '"
    if i == 33:
        plain = f"CASE WHEN c_nationkey = 6 THEN '' ELSE {plain} END"
    if i == 28:
        return f"CASE WHEN c_nationkey = 3 THEN 'NULL' ELSE {plain} END"
    if i > 28:
        return f"CASE WHEN c_nationkey IN (3, 4) THEN ' NULL' ELSE {plain} END"
    return plain


def _customer_lines(spark, sf_dir):
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey")

    def field(i):
        plain = F.concat(F.lit(f" v{i}-"), key, F.lit(" "))
        if i == 33:
            plain = F.when(nation == 6, F.lit("")).otherwise(plain)
        if i == 28:
            return F.when(nation == 3, F.lit("NULL")).otherwise(plain)
        return F.when(nation.isin(3, 4), F.lit(" NULL")).otherwise(plain) if i > 28 else plain

    fields = [field(i) for i in range(34)]
    line = F.when(nation == 5, tab_line(*fields[:33])).otherwise(tab_line(*fields))
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", line.alias("value"))
    return saved(customers, "raw-export")


def _sql_projected(positions, names, extra="") -> str:
    cols = ", ".join(f"trim({_sql_field(p)}) AS {n}" for p, n in zip(positions, names))
    return f"SELECT c_custkey, {cols} FROM customer WHERE c_nationkey NOT IN (5, 6) {extra}"


@query("clean_drop_ragged", "SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (5, 6)")
def clean_drop_ragged(spark, sf_dir):
    return K.drop_ragged(_customer_lines(spark, sf_dir), 34).select("c_custkey")


# Several files, whose first lines decide: each nation's file is as wide as its first line.
@query("clean_first_width", """SELECT c_custkey FROM (SELECT *, first_value(c_custkey % 3) OVER (
    PARTITION BY c_nationkey ORDER BY c_custkey) AS w FROM customer) WHERE c_custkey % 3 = w""")
def clean_first_width(spark, sf_dir):
    path = _nation_files(spark, sf_dir)
    kept = K.drop_ragged(S.numbered_records(spark, path))
    return S.tsv_columns(kept, [0], ["c_custkey"]).select(F.col("c_custkey").cast("bigint").alias("c_custkey"))


@query("head_lines", """SELECT c_custkey, line FROM (SELECT c_custkey, row_number() OVER (
    PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS line FROM customer) WHERE line < 5""")
def head_lines(spark, sf_dir):
    """The first five lines of each of several files."""
    found = S.head_lines(spark, _nation_files(spark, sf_dir), 5)
    return found.select(F.substring_index("value", "\t", 1).cast("bigint").alias("c_custkey"), "line")


def _nation_files(spark, sf_dir):
    """A text file per nation, its customers in order; lines have one to three fields."""
    key = F.col("c_custkey").cast("string")
    fields = [F.when(F.col("c_custkey") % 3 >= i, F.lit(f"f{i}")) for i in (1, 2)]
    rows = read_table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.concat_ws("\t", key, *fields).alias("value"))
    path = new_path(spark, "nations")
    (rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", "value")
     .write.partitionBy("c_nationkey").text(path))
    return path


TWEET_NAMES = [f"t{p}" for p in K.TWEET_FIELDS]
USER_NAMES = [f"u{p}" for p in K.USER_FIELDS]
PLACE_NAMES = [f"g{p}" for p in K.PLACE_FIELDS]


@query("clean_project", _sql_projected(K.TWEET_FIELDS, TWEET_NAMES))
def clean_project(spark, sf_dir):
    even = K.drop_ragged(_customer_lines(spark, sf_dir), 34)
    return K.project_fields(even, K.TWEET_FIELDS, TWEET_NAMES, ["c_custkey"])


@query("clean_users", _sql_projected(K.USER_FIELDS, USER_NAMES))
def clean_users(spark, sf_dir):
    even = K.drop_ragged(_customer_lines(spark, sf_dir), 34)
    return K.project_fields(even, K.USER_FIELDS, USER_NAMES, ["c_custkey"])


@query("clean_geo", _sql_projected(K.PLACE_FIELDS, PLACE_NAMES, "AND c_nationkey <> 3"))
def clean_geo(spark, sf_dir):
    even = K.drop_ragged(_customer_lines(spark, sf_dir), 34)
    return K.drop_null_rows(K.project_fields(even, K.PLACE_FIELDS, PLACE_NAMES, ["c_custkey"]), PLACE_NAMES)


# --- keywords and literals -------------------------------------------------------
KEYWORDS = ("Thand", "eauxla", "schen", "ciónde")


@query("keyword_filter", "SELECT doc_id, lang FROM documents WHERE "
       + " OR ".join(f"contains(lower(text), '{k.lower()}')" for k in KEYWORDS))
def keyword_filter(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return K.keyword_filter(documents, "text", KEYWORDS).select("doc_id", "lang")


# The whole text as an RDF literal; texts not in Spanish have another language tag and give none.
@query("extract_literal", r"""SELECT doc_id, CASE WHEN lang = 'es'
    THEN replace(replace(text, chr(10), ' '), '\"', '"') END AS literal FROM documents WHERE lang = 'es'""")
def extract_literal(spark, sf_dir):
    flat = F.replace("text", F.lit("\n"), F.lit(" "))
    escaped = F.replace(flat, F.lit('"'), F.lit('\\"'))
    line = F.concat(F.lit("<d> <p> \""), escaped, F.lit('"@'), F.col("lang"), F.lit(" ."))
    lines = read_table(spark, sf_dir, "documents").select("doc_id", line.alias("line"))
    return lines.select("doc_id", X.quoted_literal(F.col("line")).alias("literal")).where("literal IS NOT NULL")


# --- fixed width -------------------------------------------------------------------
@query("scan_fixed_width", """SELECT '00012' || lpad(CAST(o_orderkey % 100000 AS VARCHAR), 5, '0') AS distribution,
    CAST(o_custkey AS INTEGER) AS votes, CAST(o_orderkey % 100 AS DOUBLE) / 10 AS score,
    o_orderpriority || ' (19' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || ')' AS title,
    o_orderpriority AS name
    FROM orders WHERE o_orderstatus <> 'P'""")
def scan_fixed_width(spark, sf_dir):
    """Rating lines under a header line; status P has an unreadable score."""
    key = F.col("o_orderkey")
    last = F.lpad((key % 100).cast("string"), 2, "0")
    score = F.when(F.col("o_orderstatus") == "P", F.lit("x")).otherwise(
        ((key % 100) / F.lit(10.0)).cast("string"))
    line = F.concat(
        F.lit("      "), F.lit("00012"), F.lpad((key % 100000).cast("string"), 5, "0"), F.lit(" "),
        F.lpad(F.col("o_custkey").cast("string"), 8, " "), F.lit(" "), F.lpad(score, 5, " "), F.lit(" "),
        F.col("o_orderpriority"), F.lit(" (19"), last, F.lit(")"))
    path = new_path(spark, "fixed")
    lines = read_table(spark, sf_dir, "orders").select(line.alias("header"))
    (lines.write.option("header", True).option("quote", "").option("sep", "\u0001")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    entries = S.rating_entries(S.read_lines_after_header(spark, path, 1))
    return entries.select("distribution", "votes", "score", "title", F.col("film.name").alias("name"))


# --- credits: one role text per part, of five kinds and one without a year -----------
SQL_YEAR = "CAST(1950 + p_size AS VARCHAR)"
SQL_CREDITS = f"""SELECT p_partkey, p_size % 6 AS k, p_name, p_brand, 1950 + p_size AS y, p_size, CASE p_size % 6
    WHEN 0 THEN p_name || ' (1901) (' || {SQL_YEAR} || '/II)  (V)  [' || p_brand || ']  <' || CAST(p_size AS VARCHAR) || '>'
    WHEN 1 THEN '"' || p_name || '" (' || {SQL_YEAR} || ') {{Part ' || CAST(p_size AS VARCHAR) || '}}  [' || p_brand || ']'
    WHEN 2 THEN '"' || p_name || '" (' || {SQL_YEAR} || ') (mini)  <' || CAST(p_size AS VARCHAR) || '>'
    WHEN 3 THEN p_name || ' (' || {SQL_YEAR} || ') (VG)  [' || p_brand || ']'
    WHEN 4 THEN p_name || ' (????/III) (TV)  [' || p_brand || ']'
    ELSE p_name || ' without a year' END AS credit FROM part"""


def _credits(spark, sf_dir):
    name, brand, size = F.col("p_name"), F.col("p_brand"), F.col("p_size").cast("string")
    year = (F.col("p_size") + 1950).cast("string")
    kind = F.col("p_size") % 6

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    credit = (
        F.when(kind == 0, text(name, " (1901) (", year, "/II)  (V)  [", brand, "]  <", size, ">"))
        .when(kind == 1, text('"', name, '" (', year, ") {Part ", size, "}  [", brand, "]"))
        .when(kind == 2, text('"', name, '" (', year, ") (mini)  <", size, ">"))
        .when(kind == 3, text(name, " (", year, ") (VG)  [", brand, "]"))
        .when(kind == 4, text(name, " (????/III) (TV)  [", brand, "]"))
        .otherwise(text(name, " without a year"))
    )
    return read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", X.bind(credit, lambda c: c).alias("credit"))


SQL_PARSED = f"""SELECT p_partkey, p_brand,
    CASE k WHEN 0 THEN p_name || ' (1901)' ELSE p_name END AS name, CASE WHEN k = 4 THEN NULL ELSE y END AS year,
    CASE k WHEN 0 THEN 'II' WHEN 4 THEN 'III' END AS number,
    CASE k WHEN 0 THEN 'VIDEO_MOVIE' WHEN 1 THEN 'TV_SERIES' WHEN 2 THEN 'TV_MINI_SERIES' WHEN 3 THEN 'VIDEO_GAME'
           ELSE 'TV_MOVIE' END AS kind,
    CASE k WHEN 1 THEN 'Part ' || CAST(p_size AS VARCHAR) END AS episode,
    CASE WHEN k IN (0, 2) THEN p_size END AS billing,
    CASE WHEN k IN (0, 1, 3, 4) THEN p_brand END AS role
    FROM ({SQL_CREDITS}) WHERE k <> 5"""


def _parsed(spark, sf_dir):
    parsed = _credits(spark, sf_dir).withColumn("c", CR.parse_credit(F.col("credit")))
    return parsed.where(F.col("c").isNotNull())


@query("parse_credit", f"""SELECT p_partkey, name, coalesce(year, -1) AS year, number, kind, episode,
    coalesce(billing, -1) AS billing, role FROM ({SQL_PARSED})""")
def parse_credit(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "p_partkey", "c.name", F.coalesce("c.year", F.lit(-1)).alias("year"), "c.number", "c.kind",
        "c.episode", F.coalesce("c.billing", F.lit(-1)).alias("billing"), "c.role")


@query("format_credit", f"""SELECT p_partkey, name || chr(9) || '(' || CAST(coalesce(year, -1) AS VARCHAR) || ')' ||
    chr(9) || ':' || kind || ':' || coalesce('#' || number || '#', '') || coalesce(chr(9) || '{{' || episode || '}}', '')
    || coalesce(chr(9) || '<' || CAST(billing AS VARCHAR) || '>', '') || coalesce(chr(9) || '[' || role || ']', '')
    AS line FROM ({SQL_PARSED})""")
def format_credit(spark, sf_dir):
    return _parsed(spark, sf_dir).select("p_partkey", CR.format_credit(F.col("c")).alias("line"))


# A block per part: its role twice (once to be left out) and a second, plain role.
@query("scan_blocks", f"""SELECT actor, name, kind, count(*) AS n FROM (
    SELECT 'Actor ' || CAST(p_partkey AS VARCHAR) AS actor, name, kind FROM ({SQL_PARSED})
    UNION ALL SELECT 'Actor ' || CAST(p_partkey AS VARCHAR), 'Common of ' || p_brand, 'THEATRICAL_MOVIE' FROM part)
    GROUP BY actor, name, kind""")
def scan_blocks(spark, sf_dir):
    block = F.concat(
        F.lit("Actor "), F.col("p_partkey").cast("string"), F.lit("\t"), F.col("credit"),
        F.lit("\n\t\t\t"), F.col("credit"), F.lit("\n\t\t\tCommon of "), F.col("p_brand"), F.lit(" (1999)\n"))
    # Every file starts with a header, with blank lines and text that looks like a block.
    header = "CRC: 0x1\n\nName\t\tTitles (1900)\n----\t\t------\n\nNobody\tNothing (1901)\n"
    blocks = _credits(spark, sf_dir).select("p_partkey", (F.col("p_partkey") % 3).alias("part"), block.alias("value"))
    first = blocks.groupBy("part").agg(F.min("p_partkey").alias("first"))
    headed = F.when(F.col("p_partkey") == F.col("first"), F.concat(F.lit(header), "value")).otherwise(F.col("value"))
    lines = blocks.join(first, "part").select("part", "p_partkey", headed.alias("value"))
    path = new_path(spark, "blocks")
    (lines.repartition("part").sortWithinPartitions("part", "p_partkey").select("part", "value")
     .write.partitionBy("part").text(path))
    roles = S.read_blocks(spark, path, header.count("\n")).withColumn("c", CR.parse_credit(F.col("credit")))
    named = roles.where(F.col("c").isNotNull()).select("actor", "c.name", "c.kind")
    return named.groupBy("actor", "name", "kind").agg(F.count(F.lit(1)).alias("n"))
