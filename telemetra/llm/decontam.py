"""Benchmark decontamination by SimHash windows.

A window of a document as long as a benchmark item (in words) gets a 64-bit
SimHash of its word shingles, weighted by their letters.  Multi-index Hamming
search finds every item within RADIUS bits: with four blocks of 16 bits, two
fingerprints at most 15 bits apart differ by at most three bits in some block,
and each item stands in a block's table under all values within three bits of
its own.  Candidates are verified by the exact weighted Jaccard similarity of
window and item.

A similar window shares a shingle with its item, so windows are fingerprinted
only where they hold a shingle of some item; this loses no window that could
be verified.  Texts are worked off where they are: nothing is shuffled.  The
benchmark is the query set and is sent to the tasks in blocks of bounded size;
one pass over the texts goes through all blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum

K = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16
ITEMS_PER_BLOCK = 1000
#: Indexes of blocks that a task holds at a time (about 12 MB each).
INDEXES_HELD = 4
_SEED_BITS = 20
_BITS = np.arange(64, dtype=np.uint64)


@dataclass
class Text:
    """The words of one text: hashes and lengths."""

    hash: np.ndarray
    size: np.ndarray

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and weight (letters) of each run of ``k`` words."""
        if k < 1 or len(self.hash) < k:
            return np.zeros(0, np.uint64), np.zeros(0)
        total = np.concatenate([[0], np.cumsum(self.size)])
        return textnum.windows(self.hash, k) ^ np.uint64(k), (total[k:] - total[:-k]).astype(float)


def texts_of(chunk: textnum.Chunk) -> tuple[textnum.Words, Text]:
    w = textnum.words(chunk, textnum.ALNUM, textnum.LOWER)
    return w, Text(w.hash, w.end - w.start)


def fingerprints(shingle: np.ndarray, weight: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of the shingles first[i]:end[i], by sums of signed weights up to each place."""
    signed = np.where((shingle[:, None] >> _BITS) & np.uint64(1), weight[:, None], -weight[:, None])
    total = np.concatenate([np.zeros((1, 64)), np.cumsum(signed, axis=0)])
    return ((total[end] - total[first] > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


def weighted(shingle: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(shingle, return_inverse=True)
    return distinct, np.bincount(at, weights=weight, minlength=len(distinct))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: sum of minima by sum of maxima."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    whole = a[1].sum() + b[1].sum() - low
    return float(low / whole) if whole > 0 else 0.0


class Index:
    """One block of benchmark items."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        ids, texts = [], []
        for c in textnum.chunks(pa.array([t for _, t in items], pa.string())):
            w, all_words = texts_of(c)
            for d in range(c.n):
                own = slice(w.offsets[d], w.offsets[d + 1])
                if own.stop > own.start:  # an item without words is found nowhere
                    ids.append(items[c.first + d][0])
                    texts.append(Text(all_words.hash[own], all_words.size[own]))
        self.ids = ids
        self.length = np.array([len(t.hash) for t in texts], np.int64)
        self.k = np.minimum(K, self.length)
        shingles = [t.shingles(int(k)) for t, k in zip(texts, self.k)]
        self.sets = [weighted(*s) for s in shingles]
        self.print = np.array([fingerprints(*s, np.array([0]), np.array([len(s[0])]))[0] for s in shingles], np.uint64)
        self.seeds = {int(k): np.unique(np.concatenate([s[0] for s, x in zip(shingles, self.k) if x == k])) for k in np.unique(self.k)}
        self.may = {}
        for k, seeds in self.seeds.items():
            self.may[k] = np.zeros(1 << _SEED_BITS, bool)
            self.may[k][(seeds >> np.uint64(64 - _SEED_BITS)).astype(np.int64)] = True
        near = RADIUS // BLOCKS
        masks = np.array([sum(1 << b for b in bits) for n in range(near + 1) for bits in itertools.combinations(range(BLOCK_BITS), n)], np.int64)
        self.tables = []
        for block in range(BLOCKS):
            value = self.block(self.print, block)
            key = (value[:, None] ^ masks).ravel()
            item = np.repeat(np.arange(len(value), dtype=np.int32), len(masks))
            order = np.argsort(key, kind="stable")
            self.tables.append((np.searchsorted(key[order], np.arange((1 << BLOCK_BITS) + 1)), item[order]))

    @staticmethod
    def block(prints: np.ndarray, block: int) -> np.ndarray:
        return ((prints >> np.uint64(BLOCK_BITS * block)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)

    def within_radius(self, prints: np.ndarray, length: int) -> list[tuple[int, int, int]]:
        """(place in ``prints``, item, distance) of all items of that length within RADIUS."""
        found = set()
        for block, (at, item) in enumerate(self.tables):
            value = self.block(prints, block)
            n = at[value + 1] - at[value]
            who = np.repeat(np.arange(len(prints)), n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            what = item[np.repeat(at[value], n) + inside]
            fits = self.length[what] == length
            who, what = who[fits], what[fits]
            far = np.bitwise_count(prints[who] ^ self.print[what]).astype(np.int64)
            found.update(zip(who[far <= RADIUS].tolist(), what[far <= RADIUS].tolist(), far[far <= RADIUS].tolist()))
        return sorted(found)

    def seeded(self, hash: np.ndarray, k: int) -> np.ndarray:
        """Places in ``hash`` that hold a shingle of some item with shingles of ``k`` words."""
        hits = np.flatnonzero(self.may[k][(hash >> np.uint64(64 - _SEED_BITS)).astype(np.int64)])
        seeds = self.seeds[k]
        at = np.minimum(np.searchsorted(seeds, hash[hits]), len(seeds) - 1)
        return hits[seeds[at] == hash[hits]]

    def search(self, text: Text, places: dict[int, np.ndarray]) -> list[tuple[int, int, int, float, int]]:
        """(item, first word, words, similarity, distance): the best window of each item found."""
        best: dict[int, tuple[float, int, int, int]] = {}
        n = len(text.hash)
        for k, seeds in places.items():
            shingle, weight = text.shingles(k)
            for length in np.unique(self.length[self.k == k]).tolist():
                size = min(length, n)
                # all windows that hold one of the seeds
                reach = size - k
                edge = np.zeros(len(shingle) + 1, np.int64)
                np.add.at(edge, np.maximum(seeds - reach, 0), 1)
                np.add.at(edge, seeds + 1, -1)
                starts = np.flatnonzero(np.cumsum(edge) > 0)
                starts = starts[starts <= n - size]
                for i in range(0, len(starts), 4096):
                    part = starts[i : i + 4096]
                    lo, hi = part[0], part[-1] + reach + 1
                    prints = fingerprints(shingle[lo:hi], weight[lo:hi], part - lo, part - lo + reach + 1)
                    for at, item, far in self.within_radius(prints, length):
                        s = int(part[at])
                        sim = similarity(weighted(shingle[s : s + reach + 1], weight[s : s + reach + 1]), self.sets[item])
                        if sim >= SIMILARITY:
                            best[item] = max(best.get(item, (-1.0,)), (sim, -far, -s, size))
        return [(item, -s, size, sim, -far) for item, (sim, far, s, size) in sorted(best.items())]

    def hits(self, c: textnum.Chunk, w: textnum.Words, all_words: Text) -> Iterator[tuple[int, tuple[int, int, int, float, int]]]:
        """(row, hit) for the rows of a chunk with these words."""
        doc = textnum.documents_of(w.offsets)
        places: dict[int, dict[int, np.ndarray]] = {}
        for k in self.seeds:
            shingle, _ = all_words.shingles(k)
            at = self.seeded(shingle, k)
            at = at[doc[at] == doc[at + k - 1]]
            for d in np.unique(doc[at]).tolist():
                places.setdefault(d, {})[k] = at[doc[at] == d] - w.offsets[d]
        for d in sorted(places):
            own = slice(w.offsets[d], w.offsets[d + 1])
            for hit in self.search(Text(all_words.hash[own], all_words.size[own]), places[d]):
                yield c.first + d, hit


HIT = "item_id: bigint, start_word: bigint, n_words: bigint, similarity: double, distance: bigint"
_held: dict[int, tuple[Broadcast, Index]] = {}


def blocks(benchmark: DataFrame, items_per_block: int = ITEMS_PER_BLOCK) -> list[Broadcast]:
    """The benchmark (item_id, text), packed by the tasks of one job into
    blocks of about ``items_per_block`` items, each broadcast.

    The benchmark is the query set: all of its texts, and nothing of the
    documents, pass through the driver, a block at a time.
    """

    def packed(batches):
        own = [b for b in batches if b.num_rows]
        if own:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, own[0].schema) as out:
                for b in own:
                    out.write_batch(b)
            yield pa.RecordBatch.from_pydict({"block": [sink.getvalue().to_pybytes()]})

    n = max(1, -(-benchmark.count() // items_per_block))
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").repartition(n).mapInArrow(packed, "block binary")
    sc = benchmark.sparkSession.sparkContext
    return [sc.broadcast(bytes(r.block)) for r in rows.toLocalIterator()]


def index_of(block: Broadcast) -> Index:
    t = pa.ipc.open_stream(block.value).read_all()
    return Index(list(zip(t["item_id"].to_pylist(), t["text"].to_pylist())))


def indexes(found_in: list[Broadcast]) -> Iterator[list[Index]]:
    """The blocks' indexes, ``INDEXES_HELD`` at a time; as few as that are kept for the next batch."""
    for i in range(0, len(found_in), INDEXES_HELD):
        group = found_in[i : i + INDEXES_HELD]
        if len(found_in) > INDEXES_HELD:
            yield [index_of(b) for b in group]
            continue
        if not all(id(b) in _held for b in group):
            _held.clear()
            _held.update({id(b): (b, index_of(b)) for b in group})
        yield [_held[id(b)][1] for b in group]


def found(found_in: list[Broadcast]):
    """A Column function: the text's hits in all blocks as an array of structs, items in order."""

    @F.arrow_udf(f"array<struct<{HIT}>>")
    def searched(texts: pa.Array) -> pa.Array:
        names = [f.split(":")[0] for f in HIT.split(", ")]
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for group in indexes(found_in):
            for c in textnum.chunks(texts):
                read = texts_of(c)
                for index in group:
                    for d, (item, *rest) in index.hits(c, *read):
                        out[d].append(dict(zip(names, (index.ids[item], *rest))))
        kind = pa.list_(pa.struct([(n, pa.float64() if n == "similarity" else pa.int64()) for n in names]))
        return pa.array(out, kind)

    return searched


def contaminated(docs: DataFrame, benchmark: DataFrame, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity, distance): a row for
    each row of ``docs`` and benchmark item it holds, with the most similar
    window (ties: the least distance, then the first).

    Words are runs of ASCII letters and digits (lower-cased) and characters
    beyond ASCII.  Shingles have five words; those of an item of fewer words
    have all of its words.  A text shorter than an item is one window.  NULL
    and empty texts hold no item, items without words are held by none.
    Repeated rows and repeated items are reported one by one; an empty table
    on either side gives no rows.  ``docs`` are read once, however many items
    there are.
    """
    return docs.select("doc_id", F.explode(found(blocks(benchmark, items_per_block))(F.col("text"))).alias("h")).select("doc_id", "h.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    return docs.filter(F.size(found(blocks(benchmark, items_per_block))(F.col("text"))) == 0)
