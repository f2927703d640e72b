"""Importance resampling towards a target distribution of hashed n-grams.

Features of a text are its words and its pairs of neighbouring words; the
bucket of a feature is the CRC-32 of its bytes modulo the number of buckets.
Frequent words and pairs form the head: the CRC state behind every frequent
word and the bucket of every frequent pair are computed once and broadcast.
Features outside the head, the tail, take their CRC directly: a pair goes on
from the state of its first word.  Both feed the same exact bucket totals, over
all rows and over all target texts, and a row's weight is the mean gain of its
features' buckets.  Rows are drawn without replacement by the Gumbel top-k rule.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.staging import stage
from . import textnum
from .heads import frequent

BUCKETS = 10_000
#: Words and pairs of the head, and bytes of them, at most.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 1 << 15, 1 << 16, 4 << 20
CHUNK_BYTES = 2 << 20


@dataclass
class Counted:
    """The n-grams of a chunk: distinct ``words``, the word ``code`` of each
    place and its ``doc``, and the distinct ``pairs`` as first * len(words) +
    second, with the pair ``pair`` of each place in ``left`` that has a right neighbour."""

    words: pa.Array
    code: np.ndarray
    doc: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray
    left: np.ndarray


def n_grams(chunk: textnum.Chunk) -> Counted:
    inside = textnum.ALNUM[chunk.data]
    starts, ends = textnum.pieces(chunk, inside)
    doc = np.searchsorted(chunk.offsets, starts, side="right") - 1
    data = textnum.LOWER[chunk.data[inside]]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary()).dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    left = np.flatnonzero(doc[:-1] == doc[1:]) if len(doc) > 1 else np.zeros(0, np.int64)
    pairs, pair = np.unique(code[left] * max(1, len(coded.dictionary)) + code[left + 1] if len(left) else left, return_inverse=True)
    return Counted(coded.dictionary, code, doc, pairs, pair, left)


def joined(c: Counted, pairs: np.ndarray) -> pa.Array:
    n = max(1, len(c.words))
    return pc.binary_join_element_wise(c.words.take(pa.array(pairs // n)), c.words.take(pa.array(pairs % n)), b" ")


@dataclass
class Head:
    """Frequent ``words`` with the CRC ``state`` behind each, and frequent
    pairs (``key``: first * len(words) + second, sorted) with the ``bucket`` of each."""

    words: pa.Array
    state: np.ndarray
    key: np.ndarray
    bucket: np.ndarray


def head_of(rows: DataFrame, buckets: int, n_words: int, n_pairs: int) -> Head:
    """The head of ``rows`` (text): bounded in number and in bytes, so fit to be broadcast."""

    def words(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
        for chunk in textnum.chunks(batch.column(0), CHUNK_BYTES):
            c = n_grams(chunk)
            yield c.words, np.bincount(c.code, minlength=len(c.words))

    def pairs(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
        for chunk in textnum.chunks(batch.column(0), CHUNK_BYTES):
            c = n_grams(chunk)
            n = np.bincount(c.pair, minlength=len(c.pairs))
            often = np.flatnonzero(n > 1)  # a pair that no chunk holds twice is not frequent
            yield joined(c, c.pairs[often]), n[often]

    keys = lambda df: [bytes(k) for k in df.select("key").toArrow()["key"].to_pylist()]
    found = sorted(keys(frequent(rows, words, n_words, HEAD_BYTES)))
    place = {w: k for k, w in enumerate(found)}
    both = [tuple(p.split(b" ")) for p in keys(frequent(rows, pairs, n_pairs, HEAD_BYTES))]
    both = sorted((place[a] * len(found) + place[b], a + b" " + b) for a, b in both if a in place and b in place)
    state = np.array([zlib.crc32(w) for w in found], np.int64)
    return Head(pa.array(found, pa.binary()), state, np.array([k for k, _ in both], np.int64), np.array([zlib.crc32(p) % buckets for _, p in both], np.int64))


def feature_buckets(c: Counted, head: Head, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each distinct word and of each distinct pair of a chunk."""
    place = pc.index_in(c.words, value_set=head.words)
    known = pc.is_valid(place).to_numpy(zero_copy_only=False)
    at = np.full(len(c.words), -1, np.int64)
    at[known] = place.drop_null().to_numpy()
    state = np.zeros(len(c.words), np.int64)
    state[known] = head.state[at[known]]
    words = c.words.to_pylist()
    for k in np.flatnonzero(~known).tolist():
        state[k] = zlib.crc32(words[k])

    first, second = np.divmod(c.pairs, max(1, len(words)))
    bucket = np.full(len(c.pairs), -1, np.int64)
    both = np.flatnonzero((at[first] >= 0) & (at[second] >= 0)) if len(head.key) else np.zeros(0, np.int64)
    key = at[first[both]] * len(head.words) + at[second[both]]
    where = np.minimum(np.searchsorted(head.key, key), len(head.key) - 1)
    hit = head.key[where] == key if len(both) else np.zeros(0, bool)
    bucket[both[hit]] = head.bucket[where[hit]]
    tail = np.flatnonzero(bucket < 0)
    spaced = [b" " + w for w in words]
    crc, go_on = zlib.crc32, state.tolist()
    bucket[tail] = np.array([crc(spaced[b], go_on[a]) for a, b in zip(first[tail].tolist(), second[tail].tolist())], np.int64) % buckets
    return state % buckets, bucket


def bucket_totals(rows: DataFrame, head, buckets: int) -> DataFrame:
    """(bucket, n): how many features of all ``rows`` (text) fall in each bucket that has any."""

    def counted(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for chunk in textnum.chunks(b.column(0), CHUNK_BYTES):
                c = n_grams(chunk)
                word, pair = feature_buckets(c, head.value, buckets)
                total += np.bincount(word[c.code], minlength=buckets) + np.bincount(pair[c.pair], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    return rows.mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of shares), target to raw, of each bucket."""
    every = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(raw.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    both = stage(both.select("bucket", F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("t", F.lit(0)).alias("t")), "buckets")  # one row per bucket
    sums = both.agg(F.sum("s"), F.sum("t")).first()
    d = lambda c: c.cast("double")
    ratio = d(F.col("t") + 1) * F.lit(float(sums[0] + buckets)) / (d(F.col("s") + 1) * F.lit(float(sums[1] + buckets)))
    out = np.zeros(buckets, np.int64)
    for r in both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain")).collect():
        out[r.bucket] = r.gain
    return out


def gumbel(doc_id: Column, seed: int) -> Column:
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight) for every row of ``docs`` (doc_id, text)."""
    sc = docs.sparkSession.sparkContext
    head = sc.broadcast(head_of(docs.select("text"), buckets, n_words, n_pairs))
    gain = gains(bucket_totals(docs.select("text"), head, buckets), bucket_totals(target.select("text"), head, buckets), buckets)
    fields = "row long, doc_id long, n_words long, n_features long, gain long"

    def weighed(batches):
        for b in batches:
            for chunk in textnum.chunks(b.column(2), CHUNK_BYTES):
                c = n_grams(chunk)
                word, pair = feature_buckets(c, head.value, buckets)
                n = np.bincount(c.doc, minlength=chunk.n)
                features = n + np.bincount(c.doc[c.left], minlength=chunk.n)
                # in doubles, which hold these whole numbers exactly
                total = np.bincount(c.doc, weights=gain[word[c.code]], minlength=chunk.n) + np.bincount(c.doc[c.left], weights=gain[pair[c.pair]], minlength=chunk.n)
                own = b.slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(n), pa.array(features), pa.array(total.astype(np.int64))], names=[f.split()[0] for f in fields.split(", ")])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(weighed, fields)
    n, total = F.col("n_features"), F.col("gain")
    return rows.select("row", "doc_id", "n_words", "n_features", F.when(n > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(F.lit(0)).cast("long").alias("weight"))


def ranked(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``rows`` (doc_id, score, eligible, row) with ``rank``: 1, 2, ... by falling
    score and rising doc_id of the first floor(share * n) of the n eligible ones.

    The order is cut into ranges, whose sizes give each its first place: no
    task sees more than its range.
    """
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    placed = stage(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("eligible").cast("long")).alias("_eligible"))  # one row per range
    sizes = sizes.select("_range", F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    n = placed.agg(F.coalesce(F.sum(F.col("eligible").cast("long")), F.lit(0)).alias("n")).scalar()
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    drawn = F.col("eligible") & (F.col("rank") <= F.expr(f"{share[0]}L") * n / F.lit(share[1]))
    out = placed.join(F.broadcast(sizes), "_range").withColumn("rank", rank.cast("long"))
    return out.withColumn("rank", F.when(drawn, F.col("rank"))).drop("_range", "_before")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (25, 100), least_words: int = 20, buckets: int = BUCKETS, seed: int = 7) -> DataFrame:
    """(row, doc_id, n_features, weight, score, rank) for every row of ``docs``
    (doc_id, text); ``rank`` is NULL for rows not drawn.

    Words are runs of ASCII letters and digits (A-Z lower-cased) and of
    characters beyond ASCII; NULL and empty texts have none, and so no
    feature, weight 0 and no part in the draw, like all texts of fewer than
    ``least_words`` words.  The draw takes the floor of ``share`` of the
    eligible rows; ties go to the smaller doc_id (NULL last), then to the
    first row.  A NULL doc_id is hashed as empty.  Repeated rows are rows like
    others.  An empty table gives no rows; an empty ``target`` is a uniform
    one.  Other columns are not read.
    """
    rows = stage(weights(docs, target, buckets), "weights")  # cutting ranges reads its rows twice
    scored = rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("eligible", F.col("n_words") >= least_words)
    out = ranked(scored, share)
    return out.select("row", "doc_id", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, all of their columns as they are."""
    out = resample(docs, target, **options).filter("rank is not null").select(F.col("row").alias("_drawn_row"))
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.monotonically_increasing_id().alias("_doc_row"))
    return numbered.join(out, F.col("_doc_row") == F.col("_drawn_row"), "left_semi").select("_doc.*")
