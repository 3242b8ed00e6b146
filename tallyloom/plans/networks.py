"""Queries on the graph of customers, suppliers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import graph as G
from tallyloom.plans.registry import query
from tallyloom.session import new_path, read_table, saved, small_tasks
from tallyloom.sources import readers as S
from tallyloom.sources import writers as W

# Customer -> supplier and supplier -> part, once per order line; parts have no out-edge.
SQL_EDGES = """SELECT 'c' || CAST(o_custkey AS VARCHAR) AS src, 's' || CAST(l_suppkey AS VARCHAR) AS dst
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT 's' || CAST(l_suppkey AS VARCHAR), 'p' || CAST(l_partkey AS VARCHAR) FROM lineitem"""


def trade_edges(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")

    def named(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    bought = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return bought.select(named("c", "o_custkey").alias("src"), named("s", "l_suppkey").alias("dst")).unionByName(
        lines.select(named("s", "l_suppkey").alias("src"), named("p", "l_partkey").alias("dst")))


def sql_ranks(rounds: int = G.ROUNDS) -> str:
    """The recurrence, one common table expression per round."""
    steps = [f"""edges AS MATERIALIZED ({SQL_EDGES}),
      nodes AS MATERIALIZED (SELECT id, sum(n) AS out FROM (SELECT src AS id, 1 AS n FROM edges
        UNION ALL SELECT dst, 0 FROM edges) GROUP BY id),
      r0 AS MATERIALIZED (SELECT id, out, 1.0::DOUBLE / (SELECT count(*) FROM nodes) AS rank FROM nodes)"""]
    for t in range(1, rounds + 1):
        steps.append(f"""j{t} AS MATERIALIZED (SELECT sum(CASE WHEN out > 0 THEN 0.15::DOUBLE * rank ELSE rank END)
          / count(*) AS share FROM r{t - 1}),
        f{t} AS MATERIALIZED (SELECT dst AS id, sum(0.85::DOUBLE * rank / out) AS flow
          FROM edges JOIN r{t - 1} ON src = id GROUP BY dst),
        r{t} AS MATERIALIZED (SELECT n.id, n.out, coalesce(flow, 0) + (SELECT share FROM j{t}) AS rank
          FROM nodes n LEFT JOIN f{t} USING (id))""")
    return "WITH " + ", ".join(steps) + f" SELECT id, round(rank, 10) AS rank FROM r{rounds}"


def _ranks(spark, sf_dir):
    return G.pagerank(trade_edges(spark, sf_dir)).withColumn("rank", F.round("rank", 10))


@query("graph_edges_scan", f"SELECT src, dst FROM ({SQL_EDGES})")
def graph_edges_scan(spark, sf_dir):
    path = W.write_tsv(trade_edges(spark, sf_dir), new_path(spark, "edges"))
    return S.edges(S.read_lines(spark, path))


@query("graph_vertices", f"SELECT src AS id FROM ({SQL_EDGES}) UNION SELECT dst FROM ({SQL_EDGES})")
def graph_vertices(spark, sf_dir):
    return G.vertices(trade_edges(spark, sf_dir))


@query("graph_out_degree", f"""SELECT id, CAST(sum(n) AS BIGINT) AS out_degree FROM (
    SELECT src AS id, 1 AS n FROM ({SQL_EDGES}) UNION ALL SELECT dst, 0 FROM ({SQL_EDGES})) GROUP BY id""")
def graph_out_degree(spark, sf_dir):
    with small_tasks(spark, 2 * read_table(spark, sf_dir, "lineitem").count()):
        return saved(G.out_degrees(trade_edges(spark, sf_dir)), "out-degrees")


@query("pagerank", sql_ranks())
def pagerank(spark, sf_dir):
    return _ranks(spark, sf_dir)


@query("sort_by_rank", sql_ranks())
def sort_by_rank(spark, sf_dir):
    return G.by_rank(_ranks(spark, sf_dir))


@query("pagerank_top", f"SELECT * FROM ({sql_ranks()}) ORDER BY rank DESC, id LIMIT 20")
def pagerank_top(spark, sf_dir):
    return G.by_rank(_ranks(spark, sf_dir)).limit(20)
