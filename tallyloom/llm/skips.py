"""Fill-in-middle: texts are cut at two ranks of their units, found by an indexable skip list.

A unit is a run of ASCII letters or any other single code point. The bottom
lane of the list has a node for every ``FAN`` units; a node of an express lane
stands for ``FAN`` nodes of the lane below. Every node carries its widths: how
many units, code points and bytes it spans. A descent adds up widths while the
next node still fits in the rank that is looked for, and drops a lane where it
does not; the few units left are found in the bytes of one bottom node. So a
cut is exact in units, code points and bytes without a table of all units.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.grams import text_bytes
from tallyloom.llm.rows import field, in_small_batches

# The marks of prefix, suffix and middle, and the shares in per cent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
FAN = 64
# Bytes looked at in one step while the list is built.
BLOCK = 1 << 18
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True


def _marks(data: np.ndarray, after_letter: bool) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes start a unit, and which start a code point."""
    letter = LETTER[data]
    point = (data & 0xC0) != 0x80
    before = np.r_[after_letter, letter[:-1]]
    return point & ~(letter & before), point


class SkipList:
    """Lanes of nodes over one text; ``lanes[k]`` has the widths (units, points, bytes) of each node."""

    def __init__(self, text: bytes, fan: int = FAN, block: int = BLOCK) -> None:
        self.data, self.fan = np.frombuffer(text, dtype=np.uint8), fan
        units = points = 0
        heads: list[np.ndarray] = []
        after = False
        for start in range(0, len(self.data), block):
            part = self.data[start:start + block]
            unit, point = _marks(part, after)
            after = bool(LETTER[part[-1]])
            at = np.flatnonzero(unit)
            # The units whose rank is a multiple of the fan start a bottom node.
            at = at[-units % fan::fan] if len(at) > -units % fan else at[:0]
            before = np.cumsum(point, dtype=np.int64)
            heads.append(np.stack([points + before[at] - 1, start + at], axis=1))
            units += int(unit.sum())
            points += int(before[-1])
        self.units, self.points = units, points
        head = np.concatenate(heads) if heads else np.empty((0, 2), dtype=np.int64)
        ends = np.concatenate([head[1:], [[points, len(self.data)]]]) if len(head) else head
        width = np.full(len(head), fan, dtype=np.int64)
        if len(head):
            width[-1] = units - fan * (len(head) - 1)
        self.lanes = [np.column_stack([width, ends - head])]
        while len(self.lanes[-1]) > fan:
            low = self.lanes[-1]
            self.lanes.append(np.add.reduceat(low, np.arange(0, len(low), fan), axis=0))

    def find(self, rank: int) -> tuple[int, int]:
        """(code points, bytes) in front of the unit of this rank; the whole text for its number of units."""
        left, points, place, node = rank, 0, 0, 0
        for lane in reversed(self.lanes):
            while node < len(lane) and lane[node, 0] <= left:
                left -= int(lane[node, 0])
                points += int(lane[node, 1])
                place += int(lane[node, 2])
                node += 1
            node *= self.fan
        if left:
            # ``place`` is the head of a bottom node, so its first byte starts a unit.
            node //= self.fan
            part = self.data[place:place + int(self.lanes[0][node, 2])]
            unit, point = _marks(part, False)
            # A letter that follows one of another node would not be a head.
            unit[0] = True
            cut = int(np.flatnonzero(unit)[left])
            points += int(point[:cut].sum())
            place += cut
        return points, place


def _cut(batches):
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        draws = [columns[f"h{k}"].to_pylist() for k in range(1, 5)]
        out: list[list] = [[] for _ in range(5)]
        for text, h1, h2, h3, h4 in zip(text_bytes(columns["text"]), *draws):
            text = text or b""
            skips = SkipList(text)
            n, form, sizes = skips.units, "plain", (None, None)
            if text and h3 % 100 < PLAIN_FROM and not any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE)):
                first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
                (points, a), (more, b) = skips.find(first), skips.find(second)
                sizes = points, more - points
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                form = "spm" if h4 % 100 < SPM_BELOW else "psm"
                ordered = ((SUFFIX, suffix), (PREFIX, prefix)) if form == "spm" else ((PREFIX, prefix), (SUFFIX, suffix))
                text = b"".join(piece for mark, part in (*ordered, (MIDDLE, middle)) for piece in (mark.encode(), part))
            for column, value in zip(out, (n, form, *sizes, text)):
                column.append(value)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [columns["id"], *(pa.array(c, t) for c, t in zip(out, kinds)), pa.array(out[4], pa.binary()).cast(pa.string())],
            names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, ident: str = "doc_id", text: str = "text", seed: str = "1:") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): each text with its middle moved to the end.

    Cuts and forms are drawn from the SHA-256 of ``seed`` and the id. A text
    stays plain when it is empty, holds a mark, or by its draw; its sizes are
    null then. Null texts count as empty, a null id draws from the seed alone.
    Every row is independent: repeated rows and ids stay, other columns are
    ignored whatever their names, an empty table gives none. A text is cut into
    as many units as it has, of any number.
    """
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(field(docs, ident).cast("long").cast("string"), F.lit(""))), 256)
    rows = docs.select(field(docs, ident).cast("long").alias("id"), field(docs, text).alias("text"), digest.alias("digest"))
    draws = [F.conv(F.substring("digest", 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    return in_small_batches(rows).select("id", "text", *draws).mapInArrow(
        _cut, "id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form alone."""
    # A text with a mark stays plain, and no mark overlaps another, so the first three splits are the marks.
    part = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), 4)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
        CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
        CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4 FROM d),
n AS (SELECT *, len(u) AS n, h1 % (len(u) + 1) AS a, h2 % (len(u) + 1) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
        array_to_string(u[greatest(a, b) + 1:], '') AS suffix FROM n)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
