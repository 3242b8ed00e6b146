"""Conversation structure repair: generalised LR parsing with weighted edits.

The role grammar says which sequences of roles a conversation may have. Its LR
tables are built from the rules. A conversation is read turn by turn; each turn
may be kept, reroled or deleted, and turns may be inserted in front of it. All
readings are followed at once on a graph-structured stack: a node is a state on
top of another node and is shared by all readings with that stack. Readings
whose stacks have the same top are merged by the minimum of (cost, audit); in
this grammar a top alone says what may follow, so nothing cheaper is lost. Two
readings of one cost and one top never have audits of which one is the start of
the other (that would take a further insertion), so the smaller audit stays the
smaller one whatever follows.

Rows go through a task as one sorted stream. What is kept of a conversation is
one (cost, audit) per stack top, the rows whose edits are not yet agreed on by
all readings, and a 16-byte digest of each different row.
"""

from __future__ import annotations

import hashlib
import os.path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.rows import field, pick

# Rules over role initials, roles that may be given, and the cost of each edit.
RULES = (("Talk", ()), ("Talk", ("Pairs",)), ("Talk", ("s", "Pairs")), ("Pairs", ("u", "a")), ("Pairs", ("Pairs", "u", "a")))
GIVEN = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
WHITE = " \t\n\v\f\r"
END = "$"
# Rows kept back before the edits that all readings share are settled.
PENDING = 512


class Tables:
    """SLR(1) actions of a grammar: what to do in a state at a symbol, every possibility listed."""

    def __init__(self, rules) -> None:
        self.rules = [("", (rules[0][0],)), *rules]
        self.names = {left for left, _ in rules}
        start = self._closure({(0, 0)})
        states, todo, moves = {start: 0}, [start], {}
        while todo:
            state = todo.pop()
            for symbol in {self.rules[r][1][dot] for r, dot in state if dot < len(self.rules[r][1])}:
                after = self._closure({(r, dot + 1) for r, dot in state if self.rules[r][1][dot:dot + 1] == (symbol,)})
                if after not in states:
                    states[after] = len(states)
                    todo.append(after)
                moves[states[state], symbol] = states[after]
        self.moves = moves
        follow = self._follow()
        self.reduces: dict[tuple[int, str], list[int]] = {}
        for state, number in states.items():
            for r, dot in sorted(state):
                left, right = self.rules[r]
                if dot == len(right) and r:
                    for symbol in follow[left]:
                        self.reduces.setdefault((number, symbol), []).append(r)
        self.accepts = {number for state, number in states.items() if (0, 1) in state}

    def _closure(self, items) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            r, dot = todo.pop()
            for symbol in self.rules[r][1][dot:dot + 1]:
                fresh = {(k, 0) for k, (left, _) in enumerate(self.rules) if left == symbol} - items
                items |= fresh
                todo += fresh
        return frozenset(items)

    def _follow(self) -> dict[str, set[str]]:
        empty: set[str] = set()
        first = {left: set() for left in self.names}
        follow = {left: set() for left in self.names} | {self.rules[1][0]: {END}}
        before = None
        while before != (before := (len(empty), sum(map(len, first.values())), sum(map(len, follow.values())))):
            for left, right in self.rules[1:]:
                if all(s in empty for s in right):
                    empty.add(left)
                for symbol in right:
                    first[left] |= first.get(symbol, {symbol})
                    if symbol not in empty:
                        break
                after = set(follow[left])
                for symbol in reversed(right):
                    if symbol in self.names:
                        follow[symbol] |= after
                    own = first.get(symbol, {symbol})
                    after = own | after if symbol in empty else set(own)
        return follow


class Node:
    """A state on top of another node; made once for each stack, so that readings share it."""

    __slots__ = ("state", "below", "above", "after")

    def __init__(self, state: int, below: Node | None) -> None:
        self.state, self.below = state, below
        self.above: dict[int, Node] = {}
        self.after: dict[str, list[Node]] = {}

    def push(self, state: int) -> Node:
        if state not in self.above:
            self.above[state] = Node(state, self)
        return self.above[state]


class Stack:
    """The graph-structured stack of one grammar."""

    def __init__(self, tables: Tables) -> None:
        self.tables, self.bottom = tables, Node(0, None)

    def _reduced(self, node: Node, symbol: str) -> list[Node]:
        """``node`` and every stack that reductions in front of ``symbol`` make of it."""
        out, todo = [], [node]
        while todo:
            top = todo.pop()
            out.append(top)
            for r in self.tables.reduces.get((top.state, symbol), ()):
                left, right = self.tables.rules[r]
                under = top
                for _ in right:
                    under = under.below
                todo.append(under.push(self.tables.moves[under.state, left]))
        return out

    def after(self, node: Node, symbol: str) -> list[Node]:
        """The stacks after ``symbol``; none if it cannot come here."""
        if symbol not in node.after:
            moves = self.tables.moves
            node.after[symbol] = [top.push(moves[top.state, symbol]) for top in self._reduced(node, symbol) if (top.state, symbol) in moves]
        return node.after[symbol]

    def complete(self, node: Node) -> bool:
        return any(top.state in self.tables.accepts for top in self._reduced(node, END))


class Repair:
    """The cheapest repair of one conversation, fed turn by turn."""

    def __init__(self, stack: Stack) -> None:
        self.stack = stack
        self.tops: dict[int, tuple[int, str, Node]] = {}
        self._merge(self.tops, 0, "", stack.bottom)
        self.settled: list[str] = []
        self.pending: list[tuple[str, str]] = []
        self.last, self.lines, self.digest = "", 0, hashlib.sha256()

    @staticmethod
    def _merge(tops, cost: int, audit: str, node: Node) -> bool:
        known = tops.get(node.state)
        if known is not None and known[:2] <= (cost, audit):
            return False
        tops[node.state] = (cost, audit, node)
        return True

    def _insert(self) -> None:
        """Adds the readings with turns inserted here."""
        todo = list(self.tops.values())
        while todo:
            cost, audit, node = todo.pop()
            for symbol in GIVEN:
                for after in self.stack.after(node, symbol):
                    if self._merge(self.tops, cost + INSERT, audit + "I", after):
                        todo.append(self.tops[after.state])

    def turn(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        self._insert()
        fresh: dict[int, tuple[int, str, Node]] = {}
        extra = TRUNCATED if truncated else 0
        for cost, audit, node in self.tops.values():
            self._merge(fresh, cost + DELETE, audit + "D", node)
            if must_go:
                continue
            for after in self.stack.after(node, role[:1]) if role else ():
                self._merge(fresh, cost + extra, audit + "K", after)
            for symbol in GIVEN:
                for after in self.stack.after(node, symbol):
                    self._merge(fresh, cost + REROLE + extra, audit + "R", after)
        self.tops = fresh
        self.pending.append((role, text))
        if len(self.pending) >= PENDING:
            self._settle(os.path.commonprefix([audit for _, audit, _ in self.tops.values()]))

    def _settle(self, audit: str) -> None:
        """Writes the turns whose edits all readings agree on."""
        taken = 0
        for edit in audit:
            if edit != "I":
                role, text = self.pending[taken]
                taken += 1
            if edit == "D":
                continue
            if edit != "K":
                # A given role is the only one that the grammar allows here.
                role = GIVEN["a" if self.last == "u" else "u"]
            self.digest.update(("\n" if self.lines else "").encode() + f"{role}:{'' if edit == 'I' else text}".encode())
            self.last, self.lines = role[:1], self.lines + 1
        self.settled.append(audit)
        del self.pending[:taken]
        self.tops = {state: (cost, left[len(audit):], node) for state, (cost, left, node) in self.tops.items()}

    def result(self) -> tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired turns)."""
        self._insert()
        cost, audit = min((cost, audit) for cost, audit, node in self.tops.values() if self.stack.complete(node))
        self._settle(audit)
        return cost, "".join(self.settled), self.digest.hexdigest()


class Talk:
    """Counts and repair of one conversation, from its rows in order."""

    def __init__(self, stack: Stack) -> None:
        self.repair, self.seen = Repair(stack), set()
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def row(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        name = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        bare = text.rstrip(WHITE)
        blank, again = not bare, name in self.seen
        self.seen.add(name)
        truncated = not blank and not again and bare[-1] not in ".!?"
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += truncated
        self.repair.turn(role, text, blank or again, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


COLUMNS = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _repaired(kind):
    def run(batches):
        stack = Stack(Tables(RULES))
        names = ["conv", *(c.split()[0] for c in COLUMNS.split(", "))]
        kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        out: list[tuple] = []
        now, talk = None, None

        def flushed():
            rows, out[:] = list(out), []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for conv, turn, copies, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if talk is None or conv != now:
                    if talk is not None:
                        out.append((now, *talk.result()))
                    now, talk = conv, Talk(stack)
                for _ in range(copies):
                    talk.row(turn, role, text)
            if out:
                yield flushed()
        if talk is not None:
            out.append((now, *talk.result()))
            yield flushed()

    return run


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv, counts, cost, audit, repaired_sha256) of each conversation in ``rows``.

    ``rows`` has conv, turn, copies, role, text; a row of no copies only names
    its conversation. Turns are taken in order of turn (nulls first), role and
    text. A null conversation id is a conversation of its own. An empty table
    gives none.
    """
    kind = rows.schema["conv"].dataType
    # Partitions by key are neither split nor read in another order by adaptive execution.
    ordered = rows.select("conv", "turn", "copies", "role", "text").repartition("conv").sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_first(), "role", "text")
    from pyspark.sql.pandas.types import to_arrow_type
    return ordered.mapInArrow(_repaired(to_arrow_type(kind)), f"conv {kind.simpleString()}, " + COLUMNS)


def damaged(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, copies, role, text): the conversations with faults put in by a checksum of id and turn.

    One in twenty turns each is dropped (no copies), emptied, stripped of its
    sentence ends, repeated, or made the user's. Nulls read as one space, in
    the checksum too; a null turn stays null for the order. Other columns are
    ignored whatever their names.
    """
    blank = F.lit(" ")
    rows = pick(chats, conv=conv, turn=turn, role=role, text=text).select(
        "conv", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("fault", F.crc32(key) % 20)

    def faulty(column: str, number: int, value: Column) -> Column:
        return F.when(F.col("fault") == number, value).otherwise(F.col(column))

    emptied = faulty("text", 1, F.lit(""))
    stripped = F.when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(emptied)
    copies = F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1)
    return rows.select("conv", "turn", copies.alias("copies"), faulty("role", 4, F.lit("user")).alias("role"), stripped.alias("text"))


# The damage, the counts and the cheapest edits once more, as a table of best (cost, audit, turns) after an empty
# start, a system turn, a user turn and an assistant turn, one row of a conversation after the other.
_CRC = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::UBIGINT)),
    lambda c, b: xor(c >> 8, (t[CAST(xor(c & 255, b) + 1 AS BIGINT)])))"""


def _edited(state: str, cost: str, letter: str, line: str | None = None, when: str | None = None) -> str:
    turns = f"{state}.turns" if line is None else f"list_append({state}.turns, {line})"
    made = f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{letter}', 'turns': {turns}}}"
    return f"CASE WHEN {state} IS NOT NULL{'' if when is None else ' AND ' + when} THEN {made} END"


def _best(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _inserted(role: str, *states: str) -> str:
    return ", ".join(_edited(s, str(INSERT), "I", f"'{role}:'") for s in states)


def _taken(role: str, *states: str) -> str:
    kept = ", ".join(_edited(s, "r.extra", "K", "r.role || ':' || r.text", f"NOT r.must AND r.role[1:1] = '{role[0]}'") for s in states)
    if role == "system":
        return kept
    return kept + ", " + ", ".join(_edited(s, f"r.extra + {REROLE}", "R", f"'{role}:' || r.text", "NOT r.must") for s in states)


SQL = f"""
WITH RECURSIVE crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n::UBIGINT, [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
f AS (SELECT *, xor({_CRC.format('key')}, 4294967295::UBIGINT) % 20 AS fault FROM k, crc_table),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d),
j AS (SELECT *, bare = '' AS blank, bare <> '' AND again AS duplicate,
        bare <> '' AND NOT again AND bare[-1:] NOT IN ('.', '!', '?') AS truncated,
        coalesce(lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY n) || role[1:1] NOT IN ('su', 'ua', 'au'), false) AS illegal FROM o),
r AS (SELECT conv_id, n, role, text, blank OR duplicate AS must, CAST(truncated AS INT) AS extra FROM j),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal,
        count(*) AS rows_left FROM j GROUP BY conv_id),
dp(conv_id, n, e, s, u, a) AS (
  SELECT conv_id, 0::BIGINT, {{'cost': 0, 'audit': '', 'turns': []::VARCHAR[]}}, NULL::STRUCT(cost INT, audit VARCHAR, turns VARCHAR[]),
         NULL::STRUCT(cost INT, audit VARCHAR, turns VARCHAR[]), NULL::STRUCT(cost INT, audit VARCHAR, turns VARCHAR[])
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT r.conv_id, r.n, {_edited('e', str(DELETE), 'D')}, {_best(_edited('s', str(DELETE), 'D'), _taken('system', 'e'))},
         {_best(_edited('u', str(DELETE), 'D'), _taken('user', 'e', 's', 'a'))}, {_best(_edited('a', str(DELETE), 'D'), _taken('assistant', 'u'))}
  FROM (SELECT conv_id, n, e, s, u, {_best('a', _inserted('assistant', 'u'))} AS a
        FROM (SELECT conv_id, n, e, s, {_best('u', _inserted('user', 'e', 's', 'a'))} AS u, a FROM dp)) AS p
  JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1),
z AS (SELECT conv_id, {_best('e', 'a', _inserted('assistant', 'u'))} AS best FROM dp LEFT JOIN c USING (conv_id)
      WHERE n = coalesce(rows_left, 0))
SELECT z.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.cost AS BIGINT) AS cost, best.audit AS audit,
       sha256(array_to_string(best.turns, chr(10))) AS repaired_sha256
FROM z LEFT JOIN c USING (conv_id)
"""
