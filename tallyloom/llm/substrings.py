"""Repeated passages: a count-min prefilter over all documents, then exact grouping of windows.

A window is ``window`` consecutive words. Its anchor is the smallest hash among
the shorter runs of words inside it; equal windows have equal anchors, so a
window that starts in two documents has an anchor found in two documents.

1. Every task counts, in a count-min sketch of fixed size, in how many of its
   documents each anchor occurs; the sketches of all tasks are merged by blocks.
   An estimate is never below the truth.
2. A second scan keeps only windows whose anchor is estimated in two documents
   or more. Neighbouring windows with one anchor form a stretch; equal stretches
   are grouped first, so that only the first document's copy is looked at window
   by window, and those windows are then grouped exactly.
3. The covered words leave the texts.

No window is lost by the prefilter; when the sketch is full, more windows reach
the exact step and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.grams import U, WordHasher, as_long, grams, mix, split_words, text_bytes
from tallyloom.llm.rows import field, in_small_batches, text_key
from tallyloom.session import saved

WINDOW = 50
ANCHOR = 20
# Sketch: DEPTH rows of 2**WIDTH_BITS columns; one bit each is sent to the tasks (16 MB in all).
DEPTH, WIDTH_BITS = 2, 26
# Columns per block when sketches are merged.
BLOCK_BITS = 20


def anchors(gram: np.ndarray, windows: int, span: int) -> np.ndarray:
    """The smallest of ``span`` neighbouring hashes for each window start."""
    low, width = gram, 1
    while width * 2 <= span:
        low, width = np.minimum(low[:len(low) - width], low[width:]), width * 2
    return np.minimum(low[:windows], low[span - width:span - width + windows])


def columns_of(anchor: np.ndarray, depth: int, bits: int) -> list[np.ndarray]:
    """The sketch column of each anchor in each row of the sketch."""
    return [(mix(anchor + U(1000 + row)) >> U(64 - bits)).astype(np.int64) for row in range(depth)]


def stretches(anchor: np.ndarray) -> np.ndarray:
    """Where a new stretch of equal anchors starts."""
    return np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])


class _Text:
    """Hashes of one text; empty when it is shorter than a window."""

    def __init__(self, hasher: WordHasher, text: bytes | None, window: int, anchor: int) -> None:
        words = hasher(split_words(text))
        self.words = words
        self.windows = max(0, len(words) - window + 1)
        self.anchor = anchors(grams(words, anchor), self.windows, window - anchor + 1) if self.windows else np.empty(0, dtype=U)


def add_once(once: np.ndarray, often: np.ndarray, column: np.ndarray) -> None:
    """Counts one document in its (sorted, distinct) columns; two packed bits tell none, one, and more."""
    place, bit = column >> 3, np.uint8(128) >> (column & 7).astype(np.uint8)
    start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    place, bits = place[start], np.bitwise_or.reduceat(bit, start)
    often[place] |= once[place] & bits
    once[place] |= bits


def _sketch(window: int, anchor: int, depth: int, bits: int):
    def run(batches):
        hasher, total = WordHasher(), 0
        # Two bits per column; pages that no anchor touches are never taken from the system.
        once, often = (np.zeros((depth, 2**bits // 8), dtype=np.uint8) for _ in range(2))
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                found = _Text(hasher, text, window, anchor)
                if not found.windows:
                    continue
                total += 1
                for row, column in enumerate(columns_of(np.unique(found.anchor), depth, bits)):
                    add_once(once[row], often[row], np.unique(column))
        if not total:
            return
        size = 2**min(BLOCK_BITS, bits) // 8
        for row in range(depth):
            for block in range(once.shape[1] // size):
                part = slice(block * size, (block + 1) * size)
                seen, more = once[row, part], often[row, part]
                if seen.any():
                    lists = [np.flatnonzero(np.unpackbits(p)).astype(np.int32).tobytes() for p in (seen & ~more, more)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row], pa.int32()), pa.array([block], pa.int32()), *(pa.array([d], pa.binary()) for d in lists)],
                        names=["row", "block", "once", "often"])

    return run


def _merge(bits: int):
    size = 2**min(BLOCK_BITS, bits)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the blocks as they come; the state is one block, however many tasks sent one."""
        counts = np.zeros(size, dtype=np.uint8)
        for batch in batches:
            for name, add in (("once", 1), ("often", 2)):
                for data in batch.column(batch.schema.get_field_index(name)).to_pylist():
                    at = np.frombuffer(data, dtype=np.int32)
                    counts[at] = np.minimum(counts[at] + add, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
             pa.array([np.packbits(counts >= 2).tobytes()], pa.binary())], names=["row", "block", "bits"])

    return run


def _candidates(window: int, anchor: int, depth: int, bits: int, sent):
    def run(batches):
        hasher, repeated = WordHasher(), np.frombuffer(sent.value, dtype=np.uint8).reshape(depth, -1)
        for batch in batches:
            keys, out = batch.column(1).to_pylist(), [[] for _ in range(6)]
            for ident, key, text in zip(batch.column(0).to_pylist(), keys, text_bytes(batch.column(2))):
                found = _Text(hasher, text, window, anchor) if ident is not None else None
                if found is None or not found.windows:
                    continue
                start = stretches(found.anchor)
                value = found.anchor[start]
                hit = np.ones(len(start), dtype=bool)
                for row, column in enumerate(columns_of(value, depth, bits)):
                    hit &= (repeated[row, column >> 3] >> (7 - (column & 7)).astype(np.uint8)) & 1 == 1
                if not hit.any():
                    continue
                end = np.r_[start[1:], found.windows]
                whole = grams(found.words, window)
                place = np.arange(found.windows) - np.repeat(start, end - start)
                content = np.add.reduceat(mix(whole + mix(place.astype(U))), start)
                for k in np.flatnonzero(hit):
                    a, b = start[k], end[k]
                    for target, v in zip(out, (ident, key, int(value[k].view(np.int64)), int(content[k].view(np.int64)), int(a), as_long(whole[a:b]))):
                        target.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                names=["id", "key", "anchor", "content", "start", "windows"])

    return run


def _strip(batches):
    """Leaves out the covered words."""
    for batch in batches:
        columns = dict(zip(batch.schema.names, batch.columns))
        removed, kept, counts = [], [], []
        for text, spans in zip(text_bytes(columns["text"]), columns["spans"].to_pylist()):
            words = split_words(text)
            counts.append(len(words))
            if spans:
                change = np.zeros(len(words) + 1, dtype=np.int64)
                for span in spans:
                    change[span["start"]] += 1
                    change[span["stop"]] -= 1
                clear = np.cumsum(change[:-1]) == 0
                words = [words[i] for i in np.flatnonzero(clear)]
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [columns["id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "n_removed", "kept"])


def remove_repeated_passages(docs: DataFrame, ident: str = "doc_id", text: str = "text", window: int = WINDOW,
                             anchor: int = ANCHOR, depth: int = DEPTH, bits: int = WIDTH_BITS) -> DataFrame:
    """(id, n_words, n_removed, kept): the words that stay, joined by one space.

    Words are runs of bytes other than ASCII white space, unchanged. A word goes
    when a window over it has a word sequence that also starts in a document
    with a smaller id; windows are judged on the input. Null texts have no
    words and keep the empty text. A null id is neither smaller nor larger than
    any: nothing of it goes. Rows that share an id are one document. Other
    columns are ignored whatever their names; an empty table gives none.
    """
    spark = docs.sparkSession
    keyed = in_small_batches(docs).select(field(docs, ident).cast("long").alias("id"), text_key(docs, ident, text).alias("key"),
                        field(docs, text).alias("text"))
    blocks = keyed.select("text").mapInArrow(_sketch(window, anchor, depth, bits), "row int, block int, once binary, often binary")
    merged = blocks.groupBy("row", "block").applyInArrow(_merge(bits), "row int, block int, bits binary")
    size = 2**min(BLOCK_BITS, bits) // 8
    table = np.zeros((depth, 2**bits // 8), dtype=np.uint8)
    # At most depth * 2**bits bits, whatever the input.
    for part in merged.collect():
        table[part["row"], part["block"] * size:(part["block"] + 1) * size] = np.frombuffer(bytes(part["bits"]), dtype=np.uint8)
    sent = spark.sparkContext.broadcast(table.tobytes())
    found = saved(keyed.select("id", "key", "text").mapInArrow(
        _candidates(window, anchor, depth, bits, sent),
        "id long, key long, anchor long, content long, start long, windows array<long>"), "stretches")
    narrow = found.select("id", "key", "anchor", "content", "start", F.size("windows").alias("n"))
    first = saved(narrow.groupBy("anchor", "content").agg(F.min("id").alias("least")), "contents")
    judged = saved(narrow.join(first, ["anchor", "content"]), "judged")
    whole = judged.where("least < id").select("id", "key", "start", (F.col("start") + F.col("n") + (window - 1)).alias("stop"))
    # One document's copy of each stretch stands for all others, window by window; an anchor whose
    # stretches are all equal is settled.
    mixed = first.groupBy("anchor").agg(F.min("content").alias("a"), F.max("content").alias("b")).where("a < b").select("anchor")
    lead = found.join(judged.where("least = id").join(mixed, "anchor").select("id", "key", "anchor", "content", "start"),
                      ["id", "key", "anchor", "content", "start"], "left_semi")
    single = saved(lead.select("id", "key", "anchor", "start", F.posexplode("windows").alias("place", "hash")), "windows")
    shared = single.groupBy("anchor", "hash").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")
    alone = single.join(shared, ["anchor", "hash"]).where("least < id").select(
        "id", "key", (F.col("start") + F.col("place")).alias("start"), (F.col("start") + F.col("place") + window).alias("stop"))
    spans = whole.union(alone).groupBy("id", "key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    joined = keyed.join(spans.select(F.col("id").alias("span_id"), F.col("key").alias("span_key"), "spans"),
                        (F.col("id") == F.col("span_id")) & (F.col("key") == F.col("span_key")), "left")
    return joined.select("id", "text", "spans").mapInArrow(_strip, "id long, n_words long, n_removed long, kept string")

