"""Queries on relations: pairs, matches, averages, attempts, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import attempts as A
from tallyloom.operators import counts as C
from tallyloom.operators import pairs as P
from tallyloom.operators import ratings as R
from tallyloom.operators.ordered import grouped_lists
from tallyloom.plans.registry import query
from tallyloom.session import read_table


# --- filters ---------------------------------------------------------------
@query("filter_eq", "SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'PROMO'")
def filter_eq(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return part.where(F.col("p_type") == "PROMO").select("p_partkey", "p_name", "p_type")


@query("filter_range", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_totalprice >= 400000 AND o_custkey <= 700""")
def filter_range(spark, sf_dir):
    kept = (F.col("o_totalprice") >= 400000) & (F.col("o_custkey") <= 700)
    return read_table(spark, sf_dir, "orders").where(kept).select("o_orderkey", "o_custkey", "o_totalprice")


@query("filter_in", """SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_in(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


# --- pairs: group = order, item = supplier ---------------------------------
SQL_PAIRS = """SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(*) AS count
    FROM {0} a JOIN {0} b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey
    GROUP BY a.l_suppkey, b.l_suppkey"""
SQL_DISTINCT_CAST = "(SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)"


def _pair_counts(spark, sf_dir, **options):
    return P.pair_counts(read_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", **options)


@query("costar_count", SQL_PAIRS.format("lineitem"))
def costar_count(spark, sf_dir):
    return C.by_count(_pair_counts(spark, sf_dir, dedup=False), ["a", "b"])


@query("costar_count_dedup", SQL_PAIRS.format(SQL_DISTINCT_CAST))
def costar_count_dedup(spark, sf_dir):
    return C.by_count(_pair_counts(spark, sf_dir, dedup=True), ["a", "b"])


@query("costar_frequent", SQL_PAIRS.format(SQL_DISTINCT_CAST) + " HAVING count(*) >= 20")
def costar_frequent(spark, sf_dir):
    return _pair_counts(spark, sf_dir, dedup=True, min_count=20)


@query("costar_topk", SQL_PAIRS.format(SQL_DISTINCT_CAST) + " ORDER BY count DESC, a, b LIMIT 20")
def costar_topk(spark, sf_dir):
    return P.top_pairs(read_table(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", 20)


# --- matches: role = line of a supplier in an order, rated film = order -----
SQL_MATCHES = """SELECT l_suppkey,
      CAST(sum(CASE WHEN o_orderstatus = 'F' AND o_totalprice >= 400000 THEN 1 ELSE 0 END) AS BIGINT) AS good_count,
      CAST(sum(CASE WHEN o_orderstatus = 'F' AND o_totalprice <= 20000 THEN 1 ELSE 0 END) AS BIGINT) AS bad_count
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY l_suppkey"""


def _matches(spark, sf_dir):
    roles = read_table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("film"))
    ratings = read_table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    flags = {"good_count": F.col("o_totalprice") >= 400000, "bad_count": F.col("o_totalprice") <= 20000}
    return R.match_counts(roles, ratings.withColumnRenamed("o_orderkey", "film"), "l_suppkey", ["film"], flags)


@query("zero_preserving_counts", SQL_MATCHES)
def zero_preserving_counts(spark, sf_dir):
    return _matches(spark, sf_dir)


def _sql_ranked(count: str, kind: str) -> str:
    return f"""(SELECT '{kind}' AS kind, l_suppkey, {count} AS count FROM ({SQL_MATCHES})
        ORDER BY {count} DESC, l_suppkey LIMIT 10)"""


@query("best_worst_counts", f"SELECT * FROM {_sql_ranked('good_count', 'best')} UNION ALL "
       f"SELECT * FROM {_sql_ranked('bad_count', 'worst')}")
def best_worst_counts(spark, sf_dir):
    matches = _matches(spark, sf_dir)

    def ranked(count, kind):
        one = matches.select(F.lit(kind).alias("kind"), "l_suppkey", F.col(count).alias("count"))
        return C.top_k(one, ["l_suppkey"], 10)

    return ranked("good_count", "best").unionByName(ranked("bad_count", "worst"))


@query("lookup_after_agg", f"SELECT * FROM ({SQL_MATCHES}) WHERE l_suppkey = 7")
def lookup_after_agg(spark, sf_dir):
    return _matches(spark, sf_dir).where(F.col("l_suppkey") == 7)


# --- averages: series = event type and user, episode = event ----------------
SQL_EPISODES = """SELECT event_type || '#' || CAST(user_id AS VARCHAR) AS series, event_id,
    CAST(event_id AS VARCHAR) AS episode, round(value / 10.0, 0) * 10.0 AS rating FROM events"""


def _episodes(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("#"), F.col("user_id").cast("string")).alias("series"),
        "event_id",
        F.col("event_id").cast("string").alias("episode"),
        (F.round(F.col("value") / 10.0, 0) * 10.0).alias("rating"),
    )


@query("avg_by_series", f"""SELECT series, round(avg(rating), 6) AS avg_rating
    FROM ({SQL_EPISODES}) GROUP BY series""")
def avg_by_series(spark, sf_dir):
    averages = R.group_average(_episodes(spark, sf_dir), ["series"], "rating", "avg_rating")
    return averages.withColumn("avg_rating", F.round("avg_rating", 6))


@query("best_and_avg", f"""SELECT series, part, string_agg(episode, '|' ORDER BY episode, event_id) AS episodes,
      any_value(best) AS best, round(any_value(mean), 6) AS mean FROM (
      SELECT *, (row_number() OVER (PARTITION BY series ORDER BY episode, event_id) - 1) // 10000 AS part
      FROM (SELECT *, max(rating) OVER (PARTITION BY series) AS best,
                   avg(rating) OVER (PARTITION BY series) AS mean FROM ({SQL_EPISODES}))
      WHERE rating = best) GROUP BY series, part""")
def best_and_avg(spark, sf_dir):
    best = R.best_items(_episodes(spark, sf_dir), ["series"], "episode", "rating", ["event_id"])
    return best.select("series", "part", F.array_join("items", "|").alias("episodes"), "best",
                       F.round("mean", 6).alias("mean"))


@query("collect_episodes", f"""SELECT series, part, string_agg(episode || ':' || CAST(CAST(rating AS BIGINT) AS VARCHAR),
      ',' ORDER BY event_id) AS episodes FROM (
      SELECT *, (row_number() OVER (PARTITION BY series ORDER BY event_id) - 1) // 10000 AS part
      FROM ({SQL_EPISODES})) GROUP BY series, part""")
def collect_episodes(spark, sf_dir):
    item = F.concat_ws(":", "episode", F.col("rating").cast("bigint").cast("string"))
    lists = grouped_lists(_episodes(spark, sf_dir), ["series"], ["event_id"], item)
    return lists.select("series", "part", F.array_join("items", ",").alias("episodes"))


# --- attempts: problem = last digit of k, entity = user ----------------------
SQL_SUBMISSIONS = r"""SELECT CAST(regexp_extract(props, '\d+') AS INTEGER) % 10 AS problem, user_id, ts, event_id,
    CASE event_type WHEN 'purchase' THEN 'OK' WHEN 'error' THEN 'RUNTIME_ERROR'
         WHEN 'click' THEN 'WRONG_ANSWER' ELSE 'SKIPPED' END AS verdict FROM events"""
SQL_COUNTED = f"""SELECT *, CASE WHEN verdict = 'OK' THEN 1 ELSE 0 END AS is_accepted
    FROM ({SQL_SUBMISSIONS}) WHERE verdict <> 'SKIPPED'"""
SQL_NUMBERED = f"""SELECT *, row_number() OVER (PARTITION BY problem, user_id ORDER BY ts, event_id) AS attempt
    FROM ({SQL_COUNTED})"""
SQL_SOLVED = f"""SELECT problem, user_id, sum(CASE WHEN attempt < first_ok THEN 1 ELSE 0 END) AS failed
    FROM (SELECT *, min(CASE WHEN is_accepted = 1 THEN attempt END) OVER (PARTITION BY problem, user_id) AS first_ok
          FROM ({SQL_NUMBERED})) WHERE first_ok IS NOT NULL GROUP BY problem, user_id"""


def _submissions(spark, sf_dir):
    kind = F.col("event_type")
    verdict = (F.when(kind == "purchase", "OK").when(kind == "error", "RUNTIME_ERROR")
               .when(kind == "click", "WRONG_ANSWER").otherwise("SKIPPED"))
    return read_table(spark, sf_dir, "events").select(
        (F.regexp_extract("props", r"(\d+)", 1).cast("int") % 10).alias("problem"),
        "user_id", "ts", "event_id", verdict.alias("verdict"),
    )


@query("attempt_number", f"SELECT problem, user_id, event_id, is_accepted, attempt FROM ({SQL_NUMBERED})")
def attempt_number(spark, sf_dir):
    rows = A.relevant(_submissions(spark, sf_dir))
    numbered = A.attempt_numbers(rows, ["problem", "user_id"], ["ts", "event_id"])
    return numbered.select("problem", "user_id", "event_id", "is_accepted", "attempt")


@query("attempts_before_success", f"""SELECT problem, round(avg(failed), 6) AS avg_failed_attempts,
    count(*) AS solved_by_count FROM ({SQL_SOLVED}) GROUP BY problem HAVING count(*) >= 10
    ORDER BY avg(failed) DESC, problem LIMIT 20""")
def attempts_before_success(spark, sf_dir):
    hardest = A.attempts_before_success(_submissions(spark, sf_dir), ["problem"], "user_id", ["ts", "event_id"])
    return hardest.withColumn("avg_failed_attempts", F.round("avg_failed_attempts", 6))


@query("stage_row_counts", f"""
    SELECT 'read' AS stage, count(*) AS rows FROM ({SQL_SUBMISSIONS})
    UNION ALL SELECT 'relevant', count(*) FROM ({SQL_COUNTED})
    UNION ALL SELECT 'first_success', count(*) FROM ({SQL_SOLVED})
    UNION ALL SELECT 'before_success', count(*) FROM (SELECT *, min(CASE WHEN is_accepted = 1 THEN attempt END)
        OVER (PARTITION BY problem, user_id) AS first_ok FROM ({SQL_NUMBERED}))
        WHERE first_ok IS NULL OR attempt < first_ok
    UNION ALL SELECT 'problems_solved', count(DISTINCT problem) FROM ({SQL_SOLVED})
    UNION ALL SELECT 'problems_kept', count(*) FROM
        (SELECT problem FROM ({SQL_SOLVED}) GROUP BY problem HAVING count(*) >= 10)""")
def stage_row_counts(spark, sf_dir):
    return A.stage_row_counts(_submissions(spark, sf_dir), ["problem"], "user_id", ["ts", "event_id"])
