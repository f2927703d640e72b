"""Words, shingles and hashes of an Arrow column of texts, with numpy.

Texts stay in the Arrow buffer as UTF-8; no Python string is made.  A column
is worked off in chunks of whole documents, so memory is bounded by the chunk
size or by the longest single document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

#: Bytes of a word: all but space and the controls 9 to 13.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
#: Bytes of a word without punctuation: ASCII letters and digits, and everything beyond ASCII.
ALNUM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = BASE if kind == "up" else BASE_INVERSE
        steps = np.full(max(n, CHUNK_BYTES + 1), base)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


@dataclass
class Chunk:
    """``data``: the bytes of documents first .. first + n - 1; ``offsets``: n + 1 places in it."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole documents, at most ``limit`` bytes or a single document at a time; NULL is empty."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    if not n:
        return
    _, places, values = texts.buffers()
    at = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        yield Chunk(i, data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


def pieces(chunk: Chunk, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes with ``inside``; no run crosses documents."""
    if not len(chunk.data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = chunk.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    start[edges] = inside[edges]
    end[:-1] &= ~inside[1:]
    end[edges - 1] = inside[edges - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], equal for equal bytes."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power("down", len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """``hash``, ``start``, ``end`` of each word; ``offsets``: the first word of each document, and the end."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray


def hashes_in_blocks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
    """``hashes``, taken over about ``block`` bytes of whole pieces at a time: the
    same values with less memory."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, side="right")))
        at = starts[i]
        out[i:j] = hashes(data[at : ends[j - 1]], starts[i:j] - at, ends[i:j] - at)
        i = j
    return out


def words(chunk: Chunk, inside: np.ndarray = NOT_SPACE, fold: np.ndarray = AS_IS, block: int = 0) -> Words:
    """The words of a chunk; with ``block`` their hashes are taken in blocks of that many bytes."""
    starts, ends = pieces(chunk, inside[chunk.data])
    data = fold[chunk.data]
    hash = hashes_in_blocks(data, starts, ends, block) if block else hashes(data, starts, ends)
    return Words(hash, starts, ends, np.searchsorted(starts, chunk.offsets))


def documents_of(offsets: np.ndarray) -> np.ndarray:
    """The document number of each word."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def windows(hash: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` consecutive words, whatever their documents."""
    n = len(hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * BASE + hash[j : j + n]
    return mix(out)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by document) of all runs of ``k`` words; a document of
    1 to k - 1 words has one shingle, of all its words; without words none."""
    count = np.diff(w.offsets)
    n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(offsets[-1], np.uint64)
    runs = windows(w.hash, k)
    doc = documents_of(w.offsets)
    if len(runs):
        whole = doc[: len(runs)] == doc[k - 1 :]
        place = np.flatnonzero(whole)
        out[offsets[doc[place]] + place - w.offsets[doc[place]]] = runs[place]
    for d in np.flatnonzero((count > 0) & (count < k)):
        own = w.hash[w.offsets[d] : w.offsets[d + 1]]
        out[offsets[d]] = windows(own, len(own))[0] ^ np.uint64(len(own))
    return out, offsets
