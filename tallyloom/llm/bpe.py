"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

Greedy longest matches are not what merging gives, but a sequence of tokens is
the merge result exactly when each token merges to itself and each pair of
neighbours would, merged from scratch, come out as that pair. The encoder walks
a word from left to right: it takes the longest token that matches (found by an
Aho-Corasick automaton), checks the pair with the token before it in a table of
compatible pairs, tries the next shorter match if the pair fails, and steps back
if none is left. A position that has failed is never entered again, so the work
is linear in the word.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.grams import once_per_worker
from tallyloom.llm.rows import field, in_small_batches

# Fixed value: the pieces that the vocabulary's own file splits a text into.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
WORD_END = "</w>"
# Words, pieces and pairs of tokens remembered within a task, about 160 bytes each; emptied beyond this.
WORDS, PARTS, PAIRS = 400_000, 100_000, 150_000


def byte_letters() -> list[str]:
    """The visible letter of each byte in byte-level vocabularies."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in visible}
    for place, b in enumerate(sorted(set(range(256)) - set(visible))):
        letters[b] = chr(256 + place)
    return [letters[b] for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Vocabulary:
    """Tokens, merges and tables built from a tokenizer file."""

    def __init__(self, text: str) -> None:
        import ahocorasick
        import regex

        data = json.loads(text)
        model = data["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for place, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            made = self.ids[left + right]
            a, b = self.ids[left], self.ids[right]
            self.rank[a, b] = place, made
            self.parts.setdefault(made, (place, a, b))
        self.letters = byte_letters()
        end = WORD_END
        # The end of a word is one extra symbol, so that "a" is a prefix of "a" at the end.
        self.shape = {i: (t[:-len(end)] + "\n" if t.endswith(end) and len(t) > len(end) else t) for t, i in self.ids.items()}
        # By the left token times the shift of ids plus the right one: one number takes half the room of a pair.
        self.shift = max(self.ids.values()).bit_length()
        self.pairs: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        self.span: dict[int, int] = {}
        for i, shape in self.shape.items():
            if len(shape.rstrip("\n")) == 1 or self._merges_to_itself(i):
                self.automaton.add_word(shape, (len(shape) - 1, i))
                self.span[i] = len(shape)
        self.automaton.make_automaton()
        # The longest token that is a proper prefix, -1 if there is none.
        by_shape = {self.shape[i]: i for i in self.span}
        self.shorter = {i: next((by_shape[shape[:k]] for k in range(len(shape) - 1, 0, -1) if shape[:k] in by_shape), -1)
                        for shape, i in by_shape.items()}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        names = [""] * size
        for name, i in [*self.ids.items(), *self.special.items()]:
            names[i] = name
        # Each token as it is decoded, followed by the blank that separates tokens.
        coded = [(name + " ").encode() for name in names]
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(c) for c in coded], out=self.offsets[1:])
        self.letters_of_tokens = np.frombuffer(b"".join(coded), dtype=np.uint8)
        # Ids as bytes: small, and joined without a look at each id.
        self.words: dict[str, bytes] = {}
        self.part_ids: dict[str, bytes] = {}
        self.pieces = regex.compile(PIECES).findall

    def _merges_to_itself(self, token: int) -> bool:
        """A token that merging cannot make of its own letters never occurs."""
        stack = [token]
        while stack:
            one = stack.pop()
            if one in self.parts:
                _, a, b = self.parts[one]
                if not self.compatible(a, b, within=self.parts[one][0]):
                    return False
                stack += (a, b)
            elif len(self.shape[one].rstrip("\n")) > 1:
                return False
        return True

    def compatible(self, left: int, right: int, within: int | None = None) -> bool:
        """Whether merging the letters of both tokens ends with exactly this pair.

        The merges that made the two are undone, latest first; at each state the
        two tokens at the border may not have a merge that comes before the one
        undone last. ``within``: the border itself is merged at that rank.
        """
        key = left << self.shift | right
        if within is None and key in self.pairs:
            return self.pairs[key]
        limit = len(self.rank) if within is None else within
        good, a, b = True, left, right
        while True:
            merge = self.rank.get((a, b))
            if merge is not None and merge[0] < limit:
                good = False
                break
            made_a, made_b = self.parts.get(a), self.parts.get(b)
            if made_a is None and made_b is None:
                break
            # Of equal ranks the left one is merged first, so the right one is undone first.
            if made_b is None or (made_a is not None and made_a[0] > made_b[0]):
                limit, a = made_a[0], made_a[2]
            else:
                limit, b = made_b[0] + 1, made_b[1]
        if within is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            self.pairs[key] = good
        return good

    def encode_word(self, word: str) -> list[int]:
        """Ids of one piece, given as letters of its bytes."""
        text = word + "\n"
        n = len(text)
        # The longest token that starts at each place; ends come in order, so a later match is longer.
        longest = [-1] * n
        for last, (before, token) in self.automaton.iter(text):
            longest[last - before] = token
        compatible, span, shorter, pairs, shift = self.compatible, self.span, self.shorter, self.pairs, self.shift
        dead = bytearray(n + 1)
        # A bare end mark is no token, so nothing may stop in front of it.
        dead[n - 1] = 1
        path: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            last = path[-1] if path else -1
            while token >= 0:
                if not dead[at + span[token]]:
                    if last < 0:
                        break
                    good = pairs.get(last << shift | token)
                    if compatible(last, token) if good is None else good:
                        break
                token = shorter[token]
            if token >= 0:
                path.append(token)
                at += span[token]
                token = longest[at] if at < n else -1
                continue
            dead[at] = 1
            if not path:
                raise ValueError(f"no token for {word!r}")
            path.pop()
            at -= span[last]
            token = shorter[last]
        return path

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        words, parts, letters = self.words, self.part_ids, self.letters
        for part, special in self.sections(text):
            if special is not None:
                out.append(_packed([special]))
                continue
            # One letter at a time, as the library does: no final form of sigma.
            plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            # No piece holds white space; four separators count as such for split() only.
            chunks = [plain] if any(c in plain for c in "\x1c\x1d\x1e\x1f") else plain.split()
            if len(words) > WORDS:
                words.clear()
            if len(parts) > PARTS:
                parts.clear()
            for chunk in set(chunks).difference(words):
                if chunk.isascii() and chunk.isalpha():
                    # A piece by itself, whose bytes are its letters.
                    words[chunk] = parts.get(chunk) or _packed(self.encode_word(chunk))
                    continue
                ids: list[bytes] = []
                for piece in self.pieces(chunk):
                    # A piece that stands alone is cut into nothing but itself.
                    known = words.get(piece) or parts.get(piece)
                    if known is None:
                        known = parts[piece] = _packed(self.encode_word("".join([letters[b] for b in piece.encode()])))
                    ids.append(known)
                words[chunk] = b"".join(ids)
            out.extend(map(words.__getitem__, chunks))
        return np.frombuffer(b"".join(out), dtype="<u4")

    def sections(self, text: str):
        """The text between special tokens, and the tokens themselves."""
        if "<|" not in text:
            yield text, None
            return
        at = 0
        while True:
            found = min(((text.find(s, at), -len(s), s) for s in self.special if text.find(s, at) >= 0), default=None)
            if found is None:
                yield text[at:], None
                return
            yield text[at:found[0]], None
            yield found[2], self.special[found[2]]
            at = found[0] - found[1]

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts joined by blanks, in UTF-8: one gather through the offset table."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        size = self.offsets[ids.astype(np.int64) + 1] - start
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        return self.letters_of_tokens[place][:-1].tobytes()

    def forget(self) -> None:
        """Leaves the tables alone and drops what was remembered."""
        for memory in (self.words, self.part_ids, self.pairs):
            memory.clear()


def _coded(sent, keep: bool):
    def run(batches):
        # The tables stay with the worker, what a task remembered does not.
        vocabulary = once_per_worker("bpe", sent.value, Vocabulary)
        for batch in batches:
            count, ids_hash, text_hash, lists = [], [], [], []
            for text in batch.column(1).to_pylist():
                ids = vocabulary.encode(text or "")
                count.append(len(ids))
                ids_hash.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_hash.append(hashlib.sha256(vocabulary.decode(ids)).hexdigest())
                if keep:
                    lists.append(ids.astype(np.int64))
            columns = [batch.column(0), pa.array(count, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                columns, names = [*columns, pa.array(lists, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        vocabulary.forget()

    return run


def _decoded(sent):
    def run(batches):
        vocabulary = once_per_worker("bpe", sent.value, Vocabulary)
        for batch in batches:
            texts = [None if ids is None else vocabulary.decode(np.array(ids, dtype=np.int64)).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return run


def _sent(df: DataFrame, path: str):
    """The tokenizer file, read once by the driver: a vocabulary of fixed size."""
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode_and_decode(docs: DataFrame, path: str, ident: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) for each row.

    Null is encoded as the empty text, which has no tokens. Special tokens that
    stand in a text are found, none are added. Rows are independent: repeated
    rows and ids stay, other columns are ignored, an empty table gives none.
    """
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>" if keep_ids else "")
    rows = docs.select(field(docs, ident).cast("long").alias("id"), field(docs, text).alias("text"))
    return in_small_batches(rows).mapInArrow(_coded(_sent(docs, path), keep_ids), schema)


def decode(rows: DataFrame, path: str, ident: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, text) of token id lists; null lists stay null."""
    picked = rows.select(field(rows, ident).cast("long").alias("id"), field(rows, ids).cast("array<long>").alias("ids"))
    return picked.mapInArrow(_decoded(_sent(rows, path)), "id long, text string")
