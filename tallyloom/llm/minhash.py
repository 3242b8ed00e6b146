"""Near-duplicate documents: one-permutation hashing, banded buckets, stars of candidates.

A document is the set of its word shingles. One hash of each shingle picks a
bin and a value (one permutation for all bins); an empty bin borrows from the
first full bin on its own random walk (optimal densification). Bands of bins
name buckets. Inside a bucket nobody is paired with everybody: members meet
hubs, links are confirmed on the full sets, and only members that still belong
to different components meet further hubs, whose number grows fourfold per
round until no bucket holds an open pair.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.grams import U, WordHasher, as_long, grams, mix, pair, split_words, text_bytes
from tallyloom.llm.rows import field, hinted, in_small_batches, own_name, pick
from tallyloom.session import saved

BINS, BAND = 128, 4
WALK = 4096
# Parity mask: 64-bit words. Hubs per bucket in the rounds; in the last one every member that is left is a hub.
MASK = 16
HUBS = (1, 16, None)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; a shorter text is one shingle as a whole."""
    if 0 < len(words) < size:
        return grams(words, len(words)) ^ U(len(words))
    return np.unique(grams(words, size))


def walks(bins: int = BINS) -> np.ndarray:
    """For each bin the bins it asks for a value, in order."""
    steps = np.arange(bins * WALK, dtype=U).reshape(bins, WALK)
    return (mix(mix(steps) + U(7)) % U(bins)).astype(np.int32)


def bands(shingles: np.ndarray, walk: np.ndarray, band: int = BAND) -> np.ndarray:
    """Bucket names of a non-empty set: one per band of ``band`` bins."""
    count = walk.shape[0]
    mixed = np.sort(mix(shingles))
    bins = (mixed // U(2**64 // count)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    value, full = np.zeros(count, dtype=U), np.zeros(count, dtype=bool)
    value[bins[first]], full[bins[first]] = mixed[first], True
    empty, step = np.flatnonzero(~full), 0
    while len(empty) and step < WALK:
        asked = walk[empty, step]
        found = full[asked]
        value[empty[found]] = value[asked[found]]
        empty, step = empty[~found], step + 1
    rows = value.reshape(-1, band)
    name = np.arange(len(rows), dtype=U)
    for column in rows.T:
        name = pair(name, column, 11)
    return name


def parity(shingles: np.ndarray) -> np.ndarray:
    """Bit k tells whether an odd number of shingles fall on it."""
    odd = np.bincount((mix(shingles + U(99)) % U(64 * MASK)).astype(np.int64), minlength=64 * MASK) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signatures(size: int):
    def run(batches):
        import pyarrow as pa
        import xxhash

        hasher, walk = WordHasher(), walks()
        for batch in batches:
            count, high, low, names, masks = [], [], [], [], []
            for text in text_bytes(batch.column(1)):
                found = shingle_set(hasher(split_words(text, lower=True)), size)
                count.append(len(found))
                if len(found):
                    digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype=np.int64)
                    high.append(digest[0]), low.append(digest[1])
                    names.append(as_long(bands(found, walk)))
                    masks.append(parity(found))
                else:
                    high.append(None), low.append(None), names.append(None), masks.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(low, pa.int64()), pa.array(names, pa.list_(pa.int64())), pa.array(masks, pa.list_(pa.int64()))],
                names=["id", "n", "high", "low", "bands", "mask"])

    return run


def _sets(size: int):
    def run(batches):
        import pyarrow as pa

        hasher = WordHasher()
        for batch in batches:
            found = [as_long(shingle_set(hasher(split_words(t, lower=True)), size)) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "shingles"])

    return run


def signatures(docs: DataFrame, ident: str, text: str, size: int) -> DataFrame:
    """(id, n, high, low, bands, mask): set size, 128-bit name of the set, bucket names and parity mask (null for an empty set)."""
    return in_small_batches(pick(docs, id=ident, text=text)).select(F.col("id").cast("long"), "text").mapInArrow(
        _signatures(size), "id long, n long, high long, low long, bands array<long>, mask array<long>")


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (u, v) whose full sets overlap enough; each set travels once per edge."""
    left = edges.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u")
    both = left.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")
    common = F.size(F.array_intersect("a", "b"))
    sized = both.select("u", "v", common.alias("common"), (F.size("a") + F.size("b")).alias("total"))
    return sized.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent).select("u", "v")


def _possible(percent: int):
    """Whether a member and a hub of its bucket may be similar and are not known to be connected."""
    n, m = F.col("m.n"), F.col("hub.n")
    differ = sum((F.bit_count(F.get("m.mask", F.lit(k)).bitwiseXOR(F.get("hub.mask", F.lit(k)))) for k in range(MASK)), F.lit(0))
    # |united| - |shared| <= (100 - percent) / (100 + percent) * (n + m), in whole numbers.
    return ((F.col("m.own") != F.col("hub.own")) & (F.col("m.id") != F.col("hub.id"))
            & (F.least(n, m) * 100 >= F.greatest(n, m) * percent)
            & (differ * (100 + percent) <= (n + m) * (100 - percent)))


def near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``docs``.

    Documents are linked when 100 * shared >= ``percent`` * united shingles
    (``size`` words, A-Z lower-cased); every link is confirmed on the full
    sets. ``component_id`` is the smallest id that a document reaches, and a
    document is kept when it is that one. Equal sets collapse to one
    representative first, so groups of copies cost nothing further.

    Null and blank texts have no shingles and stay alone. Rows that share an id
    count as linked. A null id is linked with nothing: null component, kept.
    Other columns are ignored whatever their names; an empty table gives none.
    """
    signed = saved(signatures(docs, ident, text, size), "signatures")
    named = signed.where("id is not null and high is not null")
    # One representative for each distinct set.
    least = named.groupBy("high", "low").agg(F.min("id").alias("rep"))
    member = saved(named.select("id", "high", "low", "n").join(least, ["high", "low"]).select("id", "rep", "n"), "members")
    reps = signed.join(member.where("id = rep").select("id").distinct(), "id", "left_semi").where("bands is not null")
    listed = reps.select("id", F.explode("bands").alias("band"))
    shared = listed.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("band")
    rows = saved(listed.join(shared, "band"), "buckets")
    asked = saved(rows.select("id").distinct(), "asked")
    facts = saved(reps.select("id", "n", "mask").join(hinted(asked), "id"), "facts")
    texts = pick(docs, id=ident, text=text).select(F.col("id").cast("long"), "text")
    # A repeated id gives several sets; each of its rows takes part.
    sets = saved(texts.join(hinted(asked), "id").mapInArrow(_sets(size), "id long, shingles array<long>"), "sets")
    # Rows that share an id, and sets that several ids share, are links already.
    links = saved(member.where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v")).join(
        named.groupBy("id").agg(F.count("*").alias("c")).where("c > 1").select(F.col("id").alias("u")), "u", "left_semi")
        .select("u", "v"), "links")
    label = None
    for hubs_per_bucket in HUBS:
        if label is None:
            now = rows.withColumn("own", F.col("id"))
        else:
            now = rows.join(label, rows["id"] == label["node"], "left").select("band", "id", F.coalesce("component", "id").alias("own"))
            mixed = now.groupBy("band").agg(F.min("own").alias("a"), F.max("own").alias("b")).where("a < b").select("band")
            now = now.join(mixed, "band")
        now = saved(now.join(facts, "id"), "open")
        if now.isEmpty():
            break
        hub = F.struct("id", "own", "n", "mask").alias("hub")
        if hubs_per_bucket is None:
            hubs = now.select("band", hub)
        else:
            cell = F.pmod(F.xxhash64("id"), F.lit(hubs_per_bucket))
            chosen = now.groupBy("band", cell.alias("cell")).agg(F.min("id").alias("id")).select("band", "id")
            hubs = now.join(chosen, ["band", "id"]).select("band", hub)
        hubs = saved(hubs.distinct(), "hubs")
        met = now.alias("m").join(hubs.alias("h"), (F.col("m.band") == F.col("h.band")) & _possible(percent))
        edges = met.select(F.greatest("m.id", "hub.id").alias("u"), F.least("m.id", "hub.id").alias("v")).distinct()
        found = saved(_confirmed(saved(edges, "candidates"), sets, percent), "found")
        if hubs_per_bucket is not None:
            # A hub has met all its bucket.
            rows = saved(now.select("band", "id").join(hubs.select("band", F.col("hub.id").alias("id")), ["band", "id"], "left_anti"), "rest")
        links = saved(links.union(found.distinct()), "links")
        label = components(links)
    result = label if label is not None else components(links)
    placed = member.join(result, member["rep"] == result["node"], "left").groupBy("id").agg(
        F.min(F.coalesce("component", "rep")).alias("component_id"))
    return signed.select("id", "n").join(placed, "id", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, ident: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest id of its component, all columns kept.

    Rows with a null id or no words stay. Of rows that share the smallest id all stay.
    """
    judged = near_duplicates(docs, ident, text, size, percent)
    away = own_name(docs, "gone")
    gone = saved(judged.where("not kept").select(F.col("id").alias(away)).distinct(), "gone")
    return docs.join(hinted(gone), field(docs, ident).cast("long") == gone[away], "left_anti")
