"""Rows in chunks of a few megabytes, and the packed pieces that chunks send to
partitions of a hash and get back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from . import textnum

FIELDS = "chunk long, part int, n int, check long, packed binary"
schema = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("n", pa.int32()), ("check", pa.int64()), ("packed", pa.binary())])


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(packed: pa.Scalar) -> bytes:
    raw = packed.as_buffer()
    return pa.decompress(raw.slice(8), int.from_bytes(raw.slice(0, 8), "little"), codec="zstd", asbytes=True)


def pack(columns: list[np.ndarray], kinds: tuple) -> bytes:
    """Columns of whole numbers, bytes of equal weight together: sorted and
    small numbers then compress well."""
    return squeeze(b"".join(np.ascontiguousarray(x, kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes() for x, kind in zip(columns, kinds)))


def unpack(packed: pa.Scalar, n: int, kinds: tuple) -> list[np.ndarray]:
    widths = [np.dtype(kind).itemsize for kind in kinds]
    planes = np.frombuffer(expand(packed), np.uint8)
    cuts = n * np.cumsum([0, *widths])
    return [np.ascontiguousarray(planes[i:j].reshape(w, n).T).view(kind)[:, 0] for i, j, w, kind in zip(cuts, cuts[1:], widths, kinds)]


def checksum(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys, initial=np.uint64(0)).view(np.int64))


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, textnum.Chunk, pa.Array | None]]:
    """(first row, its texts, its third column) of each chunk of a partition's
    (row, text) or (row, text, third): cut by the rows' lengths alone, whatever
    the batches."""
    data, lengths, third, size, first = [], [], [], 0, 0

    def whole() -> tuple[int, textnum.Chunk, pa.Array | None]:
        chunk = textnum.Chunk(0, np.concatenate(data), np.concatenate([[0], np.cumsum(np.concatenate(lengths))]))
        return first, chunk, pa.concat_arrays(third) if third else None

    for b in batches:
        for c in textnum.chunks(b.column(1), limit):
            at = 0
            while at < c.n:
                end = int(np.searchsorted(c.offsets, c.offsets[at] + limit - size, side="right")) - 1
                end = max(end, at + (not data))
                if end > at:
                    if not data:
                        first = b.column(0)[c.first + at].as_py()
                    data.append(c.data[c.offsets[at] : c.offsets[end]])
                    lengths.append(np.diff(c.offsets[at : end + 1]))
                    third += [b.column(2).slice(c.first + at, end - at)] if b.num_columns > 2 else []
                    size += len(data[-1])
                if end < c.n:
                    yield whole()
                    data, lengths, third, size = [], [], [], 0
                at = end
    if data:
        yield whole()


def parts_of(keys: np.ndarray, n_parts: int) -> np.ndarray:
    """Sorted keys fall into partitions one after the other: the cuts."""
    return np.searchsorted(((keys >> np.uint64(32)) * np.uint64(n_parts)) >> np.uint64(32), np.arange(n_parts + 1))
