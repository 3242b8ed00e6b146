"""N-grams of all lengths from one sort of truncated suffixes.

Counting each length by itself sends every start of a text through a shuffle
once per length. Here every start sends one row: the next ``longest`` words.
The rows are range-partitioned and sorted, so all occurrences of an n-gram, of
whatever length, are neighbours, and its count is the length of a run of rows
that share their first n words. One ordered pass over each partition finds the
runs of all lengths. A run that touches the first or last row of a partition
may go on in the next one; only those few are added up in a second shuffle.

Thirteen words per start are many times the text, so only what can count is sent
where a floor on the count is known:

1. Runs of one, two and three words are counted by a hash first, in slots whose
   number grows with the input. What falls together only raises a count, so no
   n-gram that reaches the floor has a run of words in a slot below it.
2. A second scan cuts the suffix of every start before the first run that is below
   the floor, and adds up equal suffixes; starts with nothing left send nothing.
   An n-gram that reaches the floor is cut nowhere, and all occurrences of another
   one are cut alike, so the sort counts exactly. What is left is sorted, packed and dealt out by
   ranges of suffixes that take as many rows each, as marks in the packed blocks tell.

For the k most frequent of each length the floor is a lower bound of the k-th count:
every task names its most frequent runs of all lengths, and what they add up to over
the tasks cannot be more than there is. Should a length have fewer than k that repeat,
whole suffixes are packed and dealt out.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import ROWS_PER_TASK, drop_saved, saved_lean

# The passes travel with their code: workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

U = np.uint64
# Fixed value: the longest n-grams of the batch job this serves.
LONGEST = 13
FOUND = "n int, ngram string, count bigint"
# Texts of fewer words are sorted whole; the scans before the sort would take longer.
FEW_WORDS = 100_000
# Lengths that are counted by a hash before the sort.
HASHED = (1, 2, 3)
# Bytes of text that a task works on at a time.
PIECE = 2**22
# Slots as powers of two: at least and at most, and how many are merged together at most (four bytes each); n-grams that a task adds up before it sends them.
SLOT_BITS, PART_BITS, HELD_SLOTS = (20, 29), 22, 2**23
# Bytes of suffixes that are copied at a time.
COPIED = 2**20
# Bytes of suffixes that a task adds up before it packs them, suffixes in a packed block, how many become marks, and how many marks the driver gets.
HELD, BLOCK, MARKS, MOST_MARKS = 2**25, 2**16, 256, 200_000
PACKED, BLOCK_NAMES = "size int, sizes binary, bytes binary, weights binary", ("size", "sizes", "bytes", "weights")
# Rows of an Arrow batch where a row is a whole text.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 512


def suffixes(df: DataFrame, tokens: Column, longest: int = LONGEST) -> DataFrame:
    """suffix: for every word of every row, it and the words after it, at most ``longest``, space-joined."""
    # Places are exploded and words joined behind that, where it is compiled; inside a lambda it takes several times as long.
    places = F.when(F.size("tokens") > 0, F.sequence(F.lit(1), F.size("tokens")))
    placed = df.select(tokens.alias("tokens")).select("tokens", F.explode(places).alias("place"))
    return placed.select(F.array_join(F.slice("tokens", F.col("place"), F.lit(longest)), " ").alias("suffix"))


def _laid_out(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, so that eight can be read at every place, and where each text starts and the last one ends."""
    _, places, values = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(places, dtype=wide)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    first, end = int(offsets[0]), int(offsets[-1])
    data = np.zeros(end - first + 8, dtype=np.uint8)
    if end > first:
        data[:end - first] = np.frombuffer(values, dtype=np.uint8)[first:end]
    return data, offsets - first


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on."""
    return np.ndarray(shape=len(data) - 7, dtype="<u8", buffer=data, strides=(1,))


def _same_bytes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many first bytes each text but the first shares with the one before it, eight at a time."""
    eights = _eights(data)
    most = np.minimum(np.diff(offsets[:-1]), np.diff(offsets[1:]))
    same = np.zeros(len(most), dtype=np.int64)
    left = np.flatnonzero(most > 0)
    while len(left):
        at = same[left]
        apart = eights[offsets[left] + at] ^ eights[offsets[left + 1] + at]
        # The lowest bit that differs lies in the first byte that differs.
        lowest = (apart & (~apart + np.uint64(1))).astype(np.float64)
        equal = np.where(apart == 0, 8, (np.frexp(lowest)[1] - 1) // 8)
        same[left] = np.minimum(at + equal, most[left])
        left = left[(equal == 8) & (same[left] < most[left])]
    return same


def shared_words(texts: pa.StringArray, before: str | None) -> tuple[np.ndarray, np.ndarray]:
    """For each text how many words it has, and how many first ones it shares with the text before it."""
    data, offsets = _laid_out(texts)
    blank = data == ord(" ")
    blanks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(blank, out=blanks[1:])
    sizes = blanks[offsets[1:]] - blanks[offsets[:-1]] + 1
    shared = np.zeros(len(sizes), dtype=np.int64)
    if len(sizes) > 1:
        same = _same_bytes(data, offsets)
        # The word at the first byte that differs is shared if it ends there in both.
        whole = [(same == np.diff(o)) | blank[o[:-1] + same] for o in (offsets[:-1], offsets[1:])]
        shared[1:] = blanks[offsets[1:-1] + same] - blanks[offsets[1:-1]] + (whole[0] & whole[1])
    if before is not None:
        one, two = texts[0].as_py().split(" "), before.split(" ")
        shared[0] = next((k for k, (a, b) in enumerate(zip(one, two)) if a != b), min(len(one), len(two)))
    return sizes, shared


def _first_words(text: str, n: int) -> str:
    return " ".join(text.split(" ", n)[:n])


def _runs(longest: int, least: int, k: int | None):
    """One pass over the sorted suffixes of a partition: complete runs that add up to ``least`` or more
    (with ``k`` only the k largest of each length, ties by text), and every run at an edge.

    A second column says how many suffixes a row stands for; without it a row is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = range(1, longest + 1)
        before: str | None = None
        # For each length the run that is still open: its weight, a row of it, if that is long enough, if it began at the edge.
        rows, text, valid, edge = [0] * (longest + 1), [""] * (longest + 1), [False] * (longest + 1), [True] * (longest + 1)
        best: list[list[tuple[int, str]]] = [[] for _ in range(longest + 1)]
        out: list[tuple[int, str, int]] = []

        def close(n: int, last: bool) -> None:
            if valid[n] and (edge[n] or last):
                out.append((n, _first_words(text[n], n), rows[n]))
            elif valid[n] and rows[n] >= least:
                found(n, [(-rows[n], _first_words(text[n], n))])

        def found(n: int, some: list[tuple[int, str]]) -> None:
            if k is None:
                out.extend((n, ngram, -count) for count, ngram in some)
            else:
                best[n] = sorted([*best[n], *some])[:k]

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64()))], names=["n", "ngram", "count"])

        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(0)
            sizes, shared = shared_words(texts, before)
            weights = np.arange(len(sizes) + 1)
            if batch.num_columns > 1:
                np.cumsum(batch.column(1).to_numpy(zero_copy_only=False), out=weights[1:])
            for n in levels:
                # The first row of a partition shares nothing, so it starts a run of every length.
                starts = np.flatnonzero(shared < n)
                if not len(starts):
                    rows[n] += int(weights[-1])
                    continue
                rows[n] += int(weights[starts[0]])
                if before is not None:
                    close(n, False)
                counts = np.diff(weights[starts])
                inner = starts[:-1]
                good = (sizes[inner] >= n) & (counts >= least)
                if before is None and len(inner):
                    # The first run of a partition is an edge, however short.
                    if sizes[inner[0]] >= n:
                        out.append((n, _first_words(texts[int(inner[0])].as_py(), n), int(counts[0])))
                    good[0] = False
                at, sure = inner[good], counts[good]
                if k is not None and len(at) > k:
                    top = np.argsort(-sure, kind="stable")[:k]
                    at, sure = at[top], sure[top]
                found(n, [(-int(c), _first_words(texts[int(a)].as_py(), n)) for a, c in zip(at, sure)])
                last = int(starts[-1])
                edge[n] = before is None and not len(inner)
                rows[n], text[n], valid[n] = int(weights[-1] - weights[last]), texts[last].as_py(), bool(sizes[last] >= n)
            before = texts[len(sizes) - 1].as_py()
            if out:
                yield flushed()
        if before is None:
            return
        for n in levels:
            close(n, True)
            out.extend((n, ngram, -count) for count, ngram in best[n])
        yield flushed()

    return run


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[_Words]:
    """All texts in order, some ``most`` bytes of them at a time."""
    held: list[pa.Array] = []
    size = 0
    for batch in batches:
        texts, at = batch.column(0), 0
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        while at < len(texts):
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + most - size)))
            held.append(texts.slice(at, stop - at))
            size, at = size + int(ends[stop - 1]) - done, stop
            if size >= most:
                yield _Words(pa.concat_arrays(held))
                held, size = [], 0
    if held:
        yield _Words(pa.concat_arrays(held))


class _Words:
    """The words of texts that have a space behind every word: where each starts and ends, and how many there are from it to the end of its text."""

    def __init__(self, texts: pa.StringArray) -> None:
        self.data, offsets = _laid_out(texts)
        self.ends = np.flatnonzero(self.data[:offsets[-1]] == ord(" "))
        self.starts = np.zeros_like(self.ends)
        self.starts[1:] = self.ends[:-1] + 1
        last = np.searchsorted(self.ends, offsets[1:])
        self.left = np.repeat(last, np.diff(last, prepend=0)) - np.arange(len(self.ends))

    def hashes(self) -> np.ndarray:
        """A hash of each word, eight bytes at a time."""
        eights, sizes = _eights(self.data), self.ends - self.starts
        masks = np.array([2**(8 * n) - 1 for n in range(9)], dtype=U)
        out = sizes.astype(U)
        left, at = np.arange(len(sizes)), 0
        while len(left):
            piece = eights[self.starts[left] + at] & masks[np.minimum(sizes[left] - at, 8)]
            out[left] = _mix(out[left] * U(3) + piece)
            at += 8
            left = left[sizes[left] > at]
        return out

    def grams(self, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """n and a hash of the n words from each place on, of texts as they stand: where ``left`` is less than n, it means nothing."""
        words = self.hashes()
        gram = words
        for n in range(1, min(longest, len(words)) + 1):
            gram = _mix(words + U(1)) if n == 1 else _mix(gram[:-1] * U(3) + words[n - 1:])
            yield n, gram


def _named(longest: int, k: int):
    """For each length the most frequent n-grams of some texts, by a hash: n, hash, count.

    Any choice is right. Starts whose n-gram is rare here are not looked at in greater lengths.
    """
    many = max(64, 4 * k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _pieces(batches, PIECE):
            at = np.arange(len(words.left))
            for n, gram in words.grams(longest):
                at = at[words.left[at] >= n]
                if not len(at):
                    break
                hashes, counts = np.unique(gram[at], return_counts=True)
                if len(counts) > many:
                    top = np.argpartition(-counts, many - 1)[:many]
                    hashes, counts = hashes[top], counts[top]
                    slots = (gram[at] >> U(44)).astype(np.int64)
                    at = at[np.bincount(slots)[slots] >= counts.min() // 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), n), pa.int32()), pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64())],
                    names=["n", "hash", "count"])

    return run


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32, byte by byte, so that what they have in common compresses."""
    return pa.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def _unpacked(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * size, codec="zstd"), dtype=np.uint8).reshape(4, size)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _part_bits(bits: int) -> int:
    """A part of the slots as a power of two: few slots are merged by many tasks, too."""
    return max(3, min(bits - 6, PART_BITS))


def _hashed(lengths: Sequence[int], bits: int, least: int):
    """How often each slot is met by n-grams of the given lengths: part, size, and the slots of the part and their counts, packed."""
    part_bits = _part_bits(bits)

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        slots = np.concatenate(held)
        held.clear()
        slots.sort()
        start = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]])
        # More than the floor says nothing more.
        counts = np.minimum(np.diff(start, append=len(slots)), least)
        slots = slots[start]
        cuts = np.searchsorted(slots, (np.arange(1, 2**(bits - part_bits)) << part_bits).astype(np.uint32))
        parts = [(k, s, c) for k, (s, c) in enumerate(zip(np.split(slots, cuts), np.split(counts, cuts))) if len(s)]
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in parts], pa.int32()), pa.array([len(s) for _, s, _ in parts], pa.int32()),
             pa.array([_packed(np.diff(s, prepend=np.uint32(k << part_bits))) for k, s, _ in parts], pa.binary()),
             pa.array([_packed(c) for _, _, c in parts], pa.binary())], names=["part", "size", "slots", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for words in _pieces(batches, PIECE):
            for n, gram in words.grams(max(lengths)):
                if n in lengths:
                    held.append((gram >> U(64 - bits)).astype(np.uint32)[words.left[:len(gram)] >= n])
            del words, gram
            if sum(map(len, held)) >= HELD_SLOTS:
                yield counted(held)
        if sum(map(len, held)):
            yield counted(held)

    return run


def _reached(bits: int, least: int):
    """One part of the slots: a bit for each, whether it is met ``least`` times or more."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(2**_part_bits(bits), dtype=np.int64 if least >= 2**31 else np.uint32)
        for batch in batches:
            for size, slots, counts in zip(*(batch.column(name).to_pylist() for name in ("size", "slots", "counts"))):
                at = np.cumsum(_unpacked(slots, size), dtype=np.int64)
                # Stops at the floor, so that it cannot run over.
                met[at] = np.minimum(met[at] + _unpacked(counts, size), least)
        data = pa.compress(np.packbits(met >= least), codec="zstd", asbytes=True)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([data], pa.binary())], names=["part", "bits"])

    return run


def _reach(words: _Words, lengths: Sequence[int], longest: int, bits: int, table: np.ndarray) -> np.ndarray:
    """How many words from each place on can be an n-gram that reaches the floor."""
    reach = np.zeros(len(words.left), dtype=np.int64)
    before = None
    for n, gram in words.grams(max(lengths)):
        slots = gram >> U(64 - bits)
        good = np.zeros(len(reach), dtype=bool)
        good[:len(gram)] = (table[slots >> U(3)] >> (U(7) - (slots & U(7))).astype(np.uint8)) & 1 == 1
        good &= words.left >= n
        if before is not None:
            good[:len(gram)] &= before[:len(gram)] & before[1:len(gram) + 1]
        reach[good] = n
        before = good
    if longest > max(lengths) and before is not None and len(words.left) >= max(lengths):
        places = np.arange(len(reach))
        ends = np.minimum.accumulate(np.where(before, len(reach), places)[::-1])[::-1]
        reach[before] = np.minimum(ends - places + max(lengths) - 1, longest)[before]
    return reach


def _cut(lengths: Sequence[int], longest: int, bits: int, sent: Broadcast | None):
    """The suffixes as far as they can count, and how often each occurs in some of the texts: sorted blocks, and marks evenly spread over them.

    Without slots they are whole."""

    def sealed(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.sort_by("suffix").combine_chunks()
        marks = rows["suffix"].take(np.linspace(0, len(rows) - 1, MARKS, dtype=np.int64)).to_pylist()
        blocks = [_sealed(b.column(0), b.column(1).to_numpy()) for b in rows.to_batches(max_chunksize=BLOCK)]
        lists = pa.array([marks] + [[]] * (len(blocks) - 1), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([*_columns(blocks), lists], names=[*BLOCK_NAMES, "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 2**_part_bits(bits) // 8
        table = np.zeros(2**bits // 8 if sent is not None else 0, dtype=np.uint8)
        for part, data in sent.value if sent is not None else []:
            table[part * size:(part + 1) * size] = np.frombuffer(pa.decompress(data, size, codec="zstd"), dtype=np.uint8)
        for words in _pieces(batches, PIECE):
            reach = _reach(words, lengths, longest, bits, table) if sent is not None else np.minimum(words.left, longest)
            at = np.flatnonzero(reach)
            if not len(at):
                continue
            starts, ends = words.starts[at], words.ends[at + reach[at] - 1]
            totals, texts, k = np.cumsum(ends - starts), [], 0
            while k < len(at):
                stop = max(k + 1, int(np.searchsorted(totals, (totals[k - 1] if k else 0) + COPIED)))
                first, places = starts[k:stop], np.zeros(stop - k + 1, dtype=np.int32)
                np.cumsum(ends[k:stop] - first, out=places[1:])
                taken = np.arange(places[-1]) + np.repeat(first - places[:-1], np.diff(places))
                texts.append(pa.StringArray.from_buffers(stop - k, pa.py_buffer(places), pa.py_buffer(words.data[taken])))
                k = stop
            counted = pc.value_counts(pa.chunked_array(texts))
            held.append(pa.table([counted.field(0), counted.field(1)], names=["suffix", "weight"]))
            del words, reach, at, starts, ends, totals, texts, counted
            if sum(rows.nbytes for rows in held) >= HELD:
                rows = _added(held)
                # What has come more than once is kept, as it may come again; if that is much, all goes.
                often = rows.filter(pc.greater(rows["weight"], 1))
                keep = 0 < often.nbytes < HELD // 2
                held = [often] if keep else []
                if not keep or len(often) < len(rows):
                    yield sealed(rows.filter(pc.equal(rows["weight"], 1)) if keep else rows)
                del rows, often
        if held:
            yield sealed(_added(held))

    return run


def _added(rows: list[pa.Table]) -> pa.Table:
    """Equal suffixes as one row."""
    return pa.concat_tables(rows).group_by("suffix").aggregate([("weight", "sum")]).select(["suffix", "weight_sum"]).rename_columns(["suffix", "weight"])


def _columns(blocks: list[tuple[int, bytes, bytes, bytes]]) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(zip(*blocks), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))]


def _sealed(texts: pa.StringArray, weights: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """A packed block: how many texts, their sizes, their bytes, and what each of them weighs."""
    data, offsets = _laid_out(texts)
    return len(texts), _packed(np.diff(offsets)), pa.Codec("zstd", 3).compress(data[:offsets[-1]], asbytes=True), _packed(weights)


def _opened(size: int, sizes: bytes, data: bytes, weights: bytes) -> tuple[pa.StringArray, np.ndarray]:
    places = np.zeros(size + 1, dtype=np.int32)
    np.cumsum(_unpacked(sizes, size), out=places[1:])
    letters = pa.decompress(data, int(places[-1]), codec="zstd")
    return pa.StringArray.from_buffers(size, pa.py_buffer(places), letters), _unpacked(weights, size).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.StringArray, np.ndarray]]:
    for batch in batches:
        for block in zip(*(batch.column(batch.schema.get_field_index(name)).to_pylist() for name in BLOCK_NAMES)):
            yield _opened(*block)


def _dealt(sent: Broadcast):
    """Blocks of sorted suffixes are cut at the bounds: range, and a packed block of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = sent.value
        for texts, weights in _blocks(batches):
            first, last = bisect_right(bounds, texts[0].as_py()), bisect_right(bounds, texts[len(texts) - 1].as_py())
            cuts = [bisect_left(range(len(texts)), bound, key=lambda k: texts[k].as_py()) for bound in bounds[first:last]]
            spans = [(k, a, b) for k, a, b in zip(range(first, last + 1), [0, *cuts], [*cuts, len(texts)]) if a < b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _, _ in spans], pa.int32()), *_columns([_sealed(texts.slice(a, b - a), weights[a:b]) for _, a, b in spans])],
                names=["range", *BLOCK_NAMES])

    return run


def _runs_of_range(longest: int, least: int, k: int | None):
    """The blocks of a range are put together, added up and sorted; then its runs are found."""
    runs = _runs(longest, least, k)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, weights = zip(*_blocks(batches))
        rows = _added([pa.table([pa.chunked_array(texts), np.concatenate(weights)], names=["suffix", "weight"])])
        yield from runs(iter(rows.sort_by("suffix").combine_chunks().to_batches(max_chunksize=BLOCK)))

    return run


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written inside reads whole texts in batches of few rows, unless the session has a size of its own."""
    own = spark.conf.get(BATCH) != "10000"
    if not own:
        spark.conf.set(BATCH, BATCH_ROWS)
    try:
        yield
    finally:
        if not own:
            spark.conf.unset(BATCH)


def _cut_suffixes(texts: DataFrame, n_words: int, longest: int, least: int) -> DataFrame:
    """Packed blocks of the suffixes of all starts, as far as an n-gram can occur ``least`` times."""
    spark = texts.sparkSession
    lengths = [n for n in HASHED if n <= longest]
    # A slot is met by a third of the floor on average, so hardly any rare n-gram falls together with enough others.
    bits = min(max((3 * len(lengths) * n_words // least).bit_length(), SLOT_BITS[0]), SLOT_BITS[1])
    sent = None
    with _small_batches(spark):
        if least > 1:
            met = texts.mapInArrow(_hashed(lengths, bits, least), "part int, size int, slots binary, counts binary")
            reached = saved_lean(met.groupBy("part").applyInArrow(_reached(bits, least), "part int, bits binary"), "reached")
            # At most a bit for each of 2**29 slots, whatever the input; rare slots compress well.
            sent = spark.sparkContext.broadcast([(r["part"], bytes(r["bits"])) for r in reached.collect()])
            drop_saved(reached)
        blocks = saved_lean(texts.mapInArrow(_cut(lengths, longest, bits, sent), f"{PACKED}, marks array<string>"), "suffixes")
    if sent is not None:
        sent.destroy()
    return blocks


def _runs_of_blocks(blocks: DataFrame, longest: int, least: int, k: int | None) -> DataFrame:
    """The runs of packed suffixes, range by range; a suffix is in a block once, so that none fills a range."""
    spark = blocks.sparkSession
    n_rows, n_marks = blocks.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum(F.size("marks")), F.lit(0))).first()
    every = n_marks // MOST_MARKS + 1
    marks = blocks.select(F.explode(F.filter("marks", lambda _, place: place % every == 0)).alias("mark")).toArrow()["mark"].to_pylist()
    ranges = n_rows // ROWS_PER_TASK + 1
    bounds = sorted(marks)[::max(1, -(-len(marks) // ranges))][1:]
    sent = spark.sparkContext.broadcast(sorted(set(bounds)))
    dealt = blocks.select(*BLOCK_NAMES).mapInArrow(_dealt(sent), f"range int, {PACKED}")
    return dealt.groupBy("range").applyInArrow(_runs_of_range(longest, least, k), FOUND)


def _runs_of_rows(rows: DataFrame, longest: int, least: int, k: int | None) -> DataFrame:
    """The runs of whole suffixes, one a row."""
    # The row number lets a suffix that fills much of the input be split over partitions.
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange("suffix", "_row").select("suffix")
    return ranged.sortWithinPartitions("suffix").mapInArrow(_runs(longest, least, k), FOUND)


def _counted(found: DataFrame, least: int, k: int | None) -> DataFrame:
    """n, ngram, count of runs; with ``k`` only the most frequent, with their rank."""
    # A complete run is a group of its own; only edges meet others.
    counted = found.groupBy("n", "ngram").agg(F.sum("count").alias("count")).where(F.col("count") >= least)
    return counted if k is None else _ranked(counted, ["ngram"], k)


def _ranked(counted: DataFrame, ties: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy("n").orderBy(F.col("count").desc(), *ties)
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _lower_bound(texts: DataFrame, lengths: Sequence[int], k: int) -> int:
    """A count that the k-th most frequent n-gram of every length reaches, as far as hashes tell; one if there are not that many."""
    longest = max(lengths)
    with _small_batches(texts.sparkSession):
        named = texts.mapInArrow(_named(longest, k), "n int, hash bigint, count bigint")
        sums = named.groupBy("n", "hash").agg(F.sum("count").alias("count"))
        lowest = _ranked(sums, ["hash"], k).groupBy("n").agg(F.min("count").alias("lowest"), F.count(F.lit(1)).alias("found")).where(F.col("found") == k)
        known = {r["n"]: r["lowest"] for r in lowest.collect()}
    return min(known.get(n, 1) for n in lengths)


def ngrams_of_all_lengths(df: DataFrame, tokens: Column, longest: int = LONGEST, least: int = 1, k: int | None = None) -> DataFrame:
    """n, ngram, count for n = 1 to ``longest``: n-grams that occur ``least`` times or more.

    With ``k`` only the k most frequent of each length, ties by text, with their
    ``rank``; a task then sends at most k rows per length besides its edges.
    Tokens hold no space. Rows without tokens add nothing.
    """
    if longest < 1 or least < 1:
        raise ValueError("longest and least must be at least 1")
    if least > 1 or k:
        # The generator's output is computed once per row, a plain projection by each of its uses.
        split = df.select(F.explode(F.array(tokens)).alias("tokens")).where(F.size("tokens") > 0)
        spaced = split.select(F.concat(F.array_join("tokens", " "), F.lit(" ")).alias("text"), F.size("tokens").alias("size"))
        texts = saved_lean(spaced, "words", compression="zstd")
        n_words, most = texts.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
        texts, there = texts.select("text"), range(1, min(longest, most) + 1)
        floors = [least] if n_words > FEW_WORDS else []
        if k and floors and (floor := max(2, _lower_bound(texts, there, k))) > least:
            floors = [floor, least]
        for floor in floors:
            blocks = _cut_suffixes(texts, n_words, longest, floor)
            counted = _counted(_runs_of_blocks(blocks, longest, floor, k), floor, k)
            if floor > least:
                counted = saved_lean(counted, "ngrams")
                drop_saved(blocks)
                # Some length may have fewer n-grams: hashes that fall together have raised the floor, or too few repeat.
                found = {r["n"]: r["count"] for r in counted.groupBy("n").count().collect()}
                if any(found.get(n) != k for n in there):
                    continue
            drop_saved(texts)
            return counted
        drop_saved(texts)
    return _counted(_runs_of_rows(suffixes(df, tokens, longest), longest, least, k), least, k)
