"""Language-model scores: stupid backoff over bigrams, leave-one-out.

The counts of all rows are the model; a row is scored with its own words taken
out of them, so that it backs off where no other row has its pair:

    S(b | a) = count(a b) / count(a)  if another row has "a b",
               0.4 * count(b) / N     otherwise (a word no other row has counts once)

All counts are exact, and the n-gram tables are never gathered.  Rows are taken
in chunks of a few megabytes.  A chunk sends each of its distinct words and
pairs once, with its count, to the partition of the n-gram's hash; that adds
up the counts of all chunks and answers each chunk with the totals of the
n-grams it sent.  An n-gram has at most one entry per chunk, however frequent
it is, so none outgrows its partition.  The answers meet the chunk's texts
again, where whole rows are scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textnum
from .chunked import FIELDS, checksum, expand, gathered, pack, parts_of, schema, squeeze, unpack

BACKOFF = 0.4
#: Entries (n-grams of a chunk) per partition of the count tables, about.
PAIRS_PER_PARTITION = 1_500_000
#: Bytes of text in a chunk, or a single longer row.
CHUNK_BYTES = 4 << 20
_SENT = (np.uint64, np.uint32, np.uint32)
_TOTAL = (np.uint64, np.uint64)
_WORD = np.uint64(0xD6E8FEB86659FD93)


def _pairs(w: textnum.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, second) of neighbouring words, as places among the words."""
    doc = textnum.documents_of(w.offsets)
    same = np.flatnonzero(doc[:-1] == doc[1:]) if len(doc) > 1 else np.zeros(0, np.int64)
    return doc[same], same, same + 1


def _ngrams(chunk: textnum.Chunk) -> tuple[textnum.Words, tuple, np.ndarray, np.ndarray]:
    """Words, pairs, and the keys of all words, then of all pairs, of a chunk:
    the distinct ones, sorted, and the place of each among them."""
    w = textnum.words(chunk)
    doc, a, b = _pairs(w)
    keys = np.concatenate([textnum.mix(w.hash ^ _WORD), textnum.mix(w.hash[a] * textnum.BASE + w.hash[b])])
    return w, (doc, a, b), *np.unique(keys, return_inverse=True)


def count_words(docs: DataFrame) -> int:
    """The number of words of all rows."""

    def counted(batches):
        for b in batches:
            n = sum(len(textnum.pieces(c, textnum.NOT_SPACE[c.data])[0]) for c in textnum.chunks(b.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return docs.select("text").mapInArrow(counted, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def score(docs: DataFrame, pairs_per_partition: int = PAIRS_PER_PARTITION, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_pairs, n_seen, log_score) for every row of ``docs`` (doc_id, text).

    Words are what stands between white space.  ``n_pairs`` counts the row's
    neighbouring words, ``n_seen`` those that another row has too,
    ``log_score`` is the mean natural logarithm of S over them, rounded to six
    places; NULL for a NULL, empty or one-word text.  Repeated rows are rows
    like others: they find their pairs in each other.  Neither bound changes
    a result.  An empty table gives no rows.
    """
    total = count_words(docs)
    n_parts = max(1, -(-2 * total // pairs_per_partition))

    def sent(batches):
        for first, chunk, _ in gathered(batches, chunk_bytes):
            w, _, keys, place = _ngrams(chunk)
            n = np.bincount(place, minlength=len(keys))
            last = np.bincount(place[w.offsets[1:][np.diff(w.offsets) > 0] - 1], minlength=len(keys))
            cuts = parts_of(keys, n_parts)
            for p in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[p], cuts[p + 1])
                packed = pack([keys[own], n[own], last[own]], _SENT)
                yield pa.RecordBatch.from_pylist([{"chunk": first, "part": p, "n": len(keys[own]), "check": checksum(keys[own]), "packed": packed}], schema)

    def texts(batches):
        for first, chunk, _ in gathered(batches, chunk_bytes):
            packed = squeeze(chunk.offsets.astype(np.int64).tobytes() + chunk.data.tobytes())
            yield pa.RecordBatch.from_pylist([{"chunk": first, "part": -1, "n": chunk.n, "check": 0, "packed": packed}], schema)

    def added(group: pa.Table) -> pa.Table:
        sizes = group["n"].to_pylist()
        keys, n, last = (np.concatenate(x) for x in zip(*(unpack(raw, k, _SENT) for k, raw in zip(sizes, group["packed"]))))
        _, place = np.unique(keys, return_inverse=True)
        del keys
        n, last = (np.bincount(place, weights=x)[place] for x in (n, last))
        cuts = np.cumsum([0, *sizes])
        packed = [pack([n[i:j], last[i:j]], _TOTAL) for i, j in zip(cuts, cuts[1:])]
        return pa.table([group["chunk"], group["part"], group["n"], group["check"], pa.array(packed, pa.binary())], schema=schema)

    def scored(group: pa.Table) -> pa.Table:
        part = group["part"].to_numpy()
        text = int(np.flatnonzero(part < 0)[0])
        raw, n_docs = expand(group["packed"][text]), group["n"][text].as_py()
        chunk = textnum.Chunk(0, np.frombuffer(raw, np.uint8, offset=8 * (n_docs + 1)), np.frombuffer(raw, np.int64, n_docs + 1))
        w, (doc, a, b), keys, place = _ngrams(chunk)
        count, last = np.zeros(len(keys)), np.zeros(len(keys))
        cuts, answered = parts_of(keys, n_parts), 0
        for i in np.flatnonzero(part >= 0):
            own = slice(cuts[part[i]], cuts[part[i] + 1])
            n = group["n"][i].as_py()
            if n != len(keys[own]) or group["check"][i].as_py() != checksum(keys[own]):
                raise RuntimeError("the input gave other rows when it was read again")
            count[own], last[own] = unpack(group["packed"][i], n, _TOTAL)
            answered += n
        if answered != len(keys):
            raise RuntimeError("the input gave other rows when it was read again")
        word, pair = place[: len(w.hash)], place[len(w.hash) :]
        order = np.lexsort((pair, doc))
        doc, a, b, pair = doc[order], word[a[order]], word[b[order]], pair[order]
        head = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])])) if len(doc) else np.zeros(0, np.int64)
        times = np.diff(np.append(head, len(doc)))
        doc, a, b, pair = doc[head], a[head], b[head], pair[head]
        # the row's own pairs with this first word
        _, mine = np.unique(doc * len(keys) + a, return_inverse=True)
        own_a = np.bincount(mine, weights=times)[mine] if len(mine) else np.zeros(0)
        left_ab, left_a = count[pair] - times, count[a] - last[a] - own_a
        seen = left_ab > 0
        log = np.log(np.where(seen, left_ab / np.maximum(left_a, 1), BACKOFF * np.maximum(count[b] - times, 1) / max(total, 1)))
        n, n_seen, sums = (np.bincount(doc, weights=x, minlength=n_docs) for x in (times, times * seen, times * log))
        rows = group["chunk"][0].as_py() + np.arange(n_docs)  # rows of a chunk are numbered one after the other
        return pa.table({"row": rows, "n": n.astype(np.int64), "seen": n_seen.astype(np.int64), "log": sums})

    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    rows = numbered.select("row", "text")
    answers = rows.mapInArrow(sent, FIELDS).groupBy("part").applyInArrow(added, FIELDS)
    sums = answers.union(rows.mapInArrow(texts, FIELDS)).groupBy("chunk").applyInArrow(scored, "row long, n long, seen long, log double")
    out = numbered.select("doc_id", "row").join(sums, "row", "left")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_pairs"), F.coalesce("seen", F.lit(0)).alias("n_seen"), F.when(F.col("n") > 0, F.round(F.col("log") / F.col("n"), 6)).alias("log_score"))
