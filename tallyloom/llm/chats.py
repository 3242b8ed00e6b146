"""Logged conversations: collapse cumulative snapshots, then render what is left.

A client that logs the whole history at each turn leaves many conversations
that are prefixes of a longer one. A rolling hash over the turns names every
prefix of every conversation; an anti-join drops the conversations whose own
name occurs as a proper prefix of another, and equal conversations keep the
smallest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.rows import field
from tallyloom.session import saved

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
PARTS = ("p1", "p2", "p3", "p4")


def _turns(chats: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return chats.select(
        field(chats, conv).cast("long").alias("conv"), field(chats, turn).cast("long").alias("turn"),
        F.coalesce(field(chats, role), F.lit("")).alias("role"), F.coalesce(field(chats, text), F.lit("")).alias("text"),
    ).where("conv is not null")


def prefix_names(turns: DataFrame) -> DataFrame:
    """(conv, n, p1..p4): the name of the first n turns of each conversation, for each n.

    A name is four running sums of 31-bit hashes of (place, role, text): the place
    is part of each hash, so the order counts, and no sum can overflow.
    """
    hashed = turns.select("conv", "turn", "role", F.xxhash64("role", "text").alias("x"), F.xxhash64("text", "role", F.lit(1)).alias("y"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "x", "y")
    placed = hashed.withColumn("n", F.row_number().over(order))
    low = F.lit(2**31 - 1)
    one, two = F.xxhash64("n", "x", "y"), F.xxhash64("y", "n", "x")
    parts = (one.bitwiseAND(low), F.shiftrightunsigned(one, 33), two.bitwiseAND(low), F.shiftrightunsigned(two, 33))
    running = Window.partitionBy("conv").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    cut = placed.select("conv", "n", *[p.alias(name) for p, name in zip(parts, PARTS)])
    return cut.select("conv", "n", *[F.sum(p).over(running).alias(p) for p in PARTS])


def maximal(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n): conversations that are no proper prefix of another; of equal ones the smallest id."""
    names = saved(prefix_names(_turns(chats, conv, turn, role, text)), "prefixes")
    length = names.groupBy("conv").agg(F.max("n").alias("length"))
    sized = names.join(length, "conv")
    whole = sized.where("n = length").groupBy("n", *PARTS).agg(F.min("conv").alias("conv"))
    inner = sized.where("n < length").select("n", *PARTS).distinct()
    return whole.join(inner, ["n", *PARTS], "left_anti").select("conv", "n")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def format_chats(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n_turns, text): each maximal conversation as one text.

    Turns are taken in the order of turn, role, then a hash of the text; a null
    turn comes first. Null roles and texts count as empty. Rows without a
    conversation id are left out. A repeated row is a repeated turn. Other
    columns are ignored whatever their names; an empty table gives none. One
    conversation is one row of the result, so its turns meet in one task; names
    of prefixes are narrow rows.
    """
    kept = saved(maximal(chats, conv, turn, role, text), "maximal")
    turns = _turns(chats, conv, turn, role, text).join(kept.select("conv"), "conv", "left_semi")
    line = F.struct("turn", "role", F.xxhash64("role", "text").alias("x"), F.xxhash64("text", "role", F.lit(1)).alias("y"), "text")
    whole = turns.groupBy("conv").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    # array_sort puts null fields first, as the window does.
    return whole.select("conv", F.size("lines").cast("long").alias("n_turns"), F.array_join(
        F.transform("lines", lambda s: rendered(s["role"], s["text"])), "").alias("text"))


SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY n) AS turns, count(*) AS n FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT hash(turns[1:k]) AS h, turns[1:k] AS turns
      FROM (SELECT turns, unnest(generate_series(1, n - 1)) AS k FROM c)),
w AS (SELECT min(conv_id) AS conv_id, turns, any_value(n) AS n FROM c GROUP BY turns)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns,
       array_to_string(list_transform(turns, lambda s: '<|im_start|>' || s.role || chr(10) || s.text || '<|im_end|>' || chr(10)), '') AS text
FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.h = hash(w.turns) AND p.turns = w.turns)
"""
