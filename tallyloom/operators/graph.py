"""Vertices, degrees and PageRank of a directed graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.session import broadcast_if_small, saved, saved_in_buckets, shuffle_partitions

# Fixed values.
DAMPING = 0.85
ROUNDS = 10

# Distinct targets of one source that share a join key; larger sources are split.
HOT_TARGETS = 1_000_000


def vertices(edges: DataFrame) -> DataFrame:
    """All ids that occur as a source or a target."""
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    """id, out_degree of every vertex; parallel edges count as often as they occur."""
    ends = edges.select(F.col("src").alias("id"), F.lit(1).cast("bigint").alias("n")).unionByName(
        edges.select(F.col("dst").alias("id"), F.lit(0).cast("bigint").alias("n")))
    return ends.groupBy("id").agg(F.sum("n").alias("out_degree"))


def pagerank(edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS,
             hot_targets: int = HOT_TARGETS) -> DataFrame:
    """id, rank after exactly ``rounds`` updates from a start of 1 / vertices.

    The rank of vertices without out-edges, and what the damping keeps back
    from the others, is shared evenly by all. Parallel edges carry their share
    each and are collapsed to a weight once. Edges are laid out once by source
    and ranks by vertex, in as many buckets as a shuffle has partitions, so a
    round joins them as they lie and its one exchange adds up what flows in. It
    is written to the shared folder, which keeps the plan short and a lost
    executor cheap.

    A vertex without in-edges has the rank that all such vertices share, so what
    they send is a number times a sum taken once; one without out-edges sends
    nothing, so its in-edges are asked for in the last round only. Rounds go over
    the other vertices and the edges between them. Where a vertex has no name,
    what it sends and gets is lost, and rounds go over everything.
    """
    buckets = shuffle_partitions(edges.sparkSession)
    weighted = saved(edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w")), "edges")
    # A source with very many targets is split into parts, each joined by itself.
    sources = weighted.groupBy("src").agg(
        F.sum("w").alias("out"), F.ceil(F.count(F.lit(1)) / hot_targets).cast("int").alias("parts"))
    ends = sources.select(F.col("src").alias("id"), "out", "parts", F.lit(False).alias("fed")).unionByName(
        weighted.select(F.col("dst").alias("id"), F.lit(0).cast("bigint").alias("out"),
                        F.lit(0).alias("parts"), F.lit(True).alias("fed")))
    named = ends.groupBy("id").agg(F.max("out").alias("out"), F.max("parts").alias("parts"), F.max("fed").alias("fed"))
    # Rounds work on short numbers; the names come back at the end. Once written, numbers are fixed.
    nodes = saved(named.withColumn("node", F.monotonically_increasing_id()), "nodes")
    count, sinks, large, unfed, inner, nameless = nodes.agg(
        F.count(F.lit(1)), F.count_if(F.col("out") == 0), F.count_if(F.col("parts") > 1), F.count_if(~F.col("fed")),
        F.count_if(F.col("fed") & (F.col("out") > 0)), F.count_if(F.col("id").isNull())).first()
    if count == 0 or rounds == 0:
        return nodes.select("id", F.lit(1.0 / max(count, 1)).alias("rank"))
    inner_node, inner_edge = F.col("fed") & (F.col("out") > 0), F.col("fed") & F.col("passes")
    if nameless:
        inner_node, inner_edge, inner, unfed = F.lit(True), F.lit(True), count, 0
    numbers = broadcast_if_small(nodes.select("id", "node", "parts", "out", "fed"))
    sources_by_name = numbers.withColumnsRenamed({"id": "src", "node": "_src"})
    targets_by_name = numbers.select(F.col("id").alias("dst"), F.col("node").alias("_dst"), (F.col("out") > 0).alias("passes"))
    numbered = saved(weighted.join(sources_by_name, "src").join(targets_by_name, "dst").select(
        F.col("_src").alias("src"), F.col("_dst").alias("dst"), "w", "parts", "out", "fed", "passes"), "numbered-edges")
    on, between = ["src"], numbered.where(inner_edge).select("src", "dst", "w", "parts")
    if large:
        on = ["src", "part"]
        between = between.withColumn("part", F.pmod(F.xxhash64("dst"), "parts").cast("int"))
    # One file a bucket: without the exchange every task would write to all of them.
    between = saved_in_buckets(between.drop("parts").repartition(buckets, *on), "inner-edges", on, buckets)

    # What a vertex gets from those without in-edges, for a rank of one.
    steady = numbered.where(~F.col("fed") & F.col("passes") & ~F.lit(bool(nameless))).groupBy(F.col("dst").alias("node")).agg(
        F.sum(F.col("w") / F.col("out")).alias("steady"))
    start = nodes.where(inner_node).join(steady, "node", "left").select(
        "node", "out", "parts", F.coalesce("steady", F.lit(0.0)).alias("steady"), F.lit(1.0 / count).alias("rank"))
    ranks = saved_in_buckets(start.repartition(buckets, "node"), "ranks", ["node"], buckets)
    alone = 1.0 / count
    even_share = ((1 - damping) * (count - sinks) + sinks) / count / count
    for _ in range(rounds):
        earlier, alone_earlier, last_share = ranks, alone, even_share
        passing = resting = 0.0
        if inner:
            shares = ranks.where(F.col("out") > 0).select(
                F.col("node").alias("src"), "parts", (damping * F.col("rank") / F.col("out")).alias("share"))
            if large:
                shares = shares.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            summed = one_round(between, ranks, shares.drop("parts"), on, even_share, damping * alone)
            # What the next round shares evenly is observed while this one is written.
            seen = Observation()
            ranks = saved_in_buckets(summed.observe(
                seen, F.sum(F.when(F.col("out") > 0, F.col("rank"))).alias("passing"),
                F.sum(F.when(F.col("out") == 0, F.col("rank"))).alias("resting")), "ranks", ["node"], buckets)
            passing, resting = seen.get["passing"] or 0.0, seen.get["resting"] or 0.0
        alone = even_share
        passing += unfed * alone
        # Nothing is lost where all vertices have names: ranks add up to one.
        even_share = ((1 - damping) * passing + (resting if nameless else 1 - passing)) / count
    if nameless:
        return ranks.join(nodes.select("node", "id"), "node").select("id", "rank")
    sent = numbered.where(~F.col("passes"))
    flows = sent.where("NOT fed").select(F.col("dst").alias("node"), (F.lit(damping * alone_earlier) * F.col("w") / F.col("out")).alias("flow"))
    passed = earlier.select(F.col("node").alias("src"), (damping * F.col("rank") / F.col("out")).alias("share"))
    flows = flows.unionByName(sent.where("fed").join(passed, "src").select(
        F.col("dst").alias("node"), (F.col("share") * F.col("w")).alias("flow")))
    ends = flows.groupBy("node").agg((F.sum("flow") + F.lit(last_share)).alias("rank"))
    known = ranks.select("node", "rank").unionByName(ends)
    return nodes.select("node", "id").join(known, "node", "left").select("id", F.coalesce("rank", F.lit(alone)).alias("rank"))


def one_round(weighted: DataFrame, ranks: DataFrame, shares: DataFrame, on: list[str], even_share: float,
              steady_share: float = 0.0) -> DataFrame:
    """node, out, parts, steady, rank after one update; ``shares`` is what each source sends along an edge of weight one."""
    inflow = weighted.join(shares, on).select(
        F.col("dst").alias("node"), (F.col("share") * F.col("w")).alias("flow"),
        F.lit(0).cast("bigint").alias("out"), F.lit(0).alias("parts"), F.lit(0.0).alias("steady"))
    # Vertices go through the same aggregation as what flows in, so that
    # one shuffle both adds up and keeps those without in-edges.
    everyone = ranks.select("node", (F.col("steady") * F.lit(steady_share)).alias("flow"), "out", "parts", "steady")
    return inflow.unionByName(everyone).groupBy("node").agg(
        F.max("out").alias("out"), F.max("parts").alias("parts"), F.max("steady").alias("steady"),
        (F.sum("flow") + F.lit(even_share)).alias("rank"))


def by_rank(ranks: DataFrame) -> DataFrame:
    return ranks.orderBy(F.col("rank").desc(), "id")
