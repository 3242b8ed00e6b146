"""Words of a text and 64-bit hashes of word runs, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
# Words remembered per task; the memory is emptied, not grown, beyond this.
MEMORY = 100_000


def once_per_worker(name: str, source, make):
    """``make(source)``, kept between the tasks of a Python worker while the source stays the same."""
    import sys
    import types

    state = sys.modules.setdefault("tallyloom_worker_state", types.ModuleType("tallyloom_worker_state"))
    known = getattr(state, name, None)
    if known is None or known[0] != source:
        known = (source, make(source))
        setattr(state, name, known)
    return known[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def split_words(text: bytes | None, lower: bool = False) -> list[bytes]:
    """Runs of bytes other than space, tab, line feed, VT, FF and CR; ``lower`` lower-cases A-Z."""
    if not text:
        return []
    return (text.lower() if lower else text).split()


class WordHasher:
    """64-bit hashes of words, remembered within a task."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        new = set(words).difference(known)
        for word in new:
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), dtype=U, count=len(words))


def pair(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """Hash of two neighbours, order counts."""
    return mix(mix(left + U(salt)) * U(3) + right)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes, by its start; built from runs of doubled length."""
    if len(words) < n:
        return np.empty(0, dtype=U)
    done, length, run, width = None, 0, words, 1
    while True:
        if n & width:
            if done is None:
                done, length = run, width
            else:
                size = min(len(done), len(run) - length)
                done, length = pair(done[:size], run[length:length + size], 2 * width + 1), length + width
        if width * 2 > n:
            return done[:len(words) - n + 1]
        size = len(run) - width
        run, width = pair(run[:size], run[width:], 2 * width), width * 2


def text_bytes(column) -> list[bytes | None]:
    """The values of an Arrow string column as bytes."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
