"""Near duplicates by improved consistent weighted sampling (ICWS).

A document is the weighted set of its five-word shingles, weight =
(1 + ln count) x idf.  ICWS draws from it 36 samples that two documents share
with the probability of their weighted Jaccard similarity, and 36 more, with
weight 1 for each distinct shingle, that they share with the probability of
their plain one; three of a kind make a band, and documents that share a band
are candidates.  Candidates are verified on their whole texts by both
similarities, and linked documents form classes.

No group of copies is expanded into pairs.  Equal texts are one node.  Each
band bucket links its members to its smallest one; where a bucket then still
holds several components, its members are compared across components through
their rarest shingles that the leader lacks, or by size where they can share
only what the leader has (see ``across``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from . import textnum
from .chunked import FIELDS, checksum, expand, gathered, pack, parts_of, schema, squeeze, unpack
from .components import components

K = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
#: Entries (shingles of a chunk) per partition of the document frequencies, about.
SHINGLES_PER_PARTITION = 1_500_000
#: Bytes of text in a chunk, or a single longer row, and bytes hashed at a time.
CHUNK_BYTES, HASH_BYTES = 2 << 20, 1 << 18
_TABLE_BITS = 16
_BLOCK = 1 << 14
_SEED = 20240607
_tables: list[np.ndarray] = []


def _sampling_tables() -> list[np.ndarray]:
    """r and c from Gamma(2, 1) and beta from U(0, 1), and the order of the plain
    samples from U(0, 1), by the low bits of a shingle's hash: shingles that
    share them draw alike, the samples are told apart by the whole hash."""
    if not _tables:
        rng, shape = np.random.Generator(np.random.Philox(_SEED)), (1 << _TABLE_BITS, BANDS * ROWS)
        r, c = (rng.standard_gamma(2.0, size=shape, dtype=np.float32) for _ in range(2))
        _tables.extend([r, np.log(c, out=c), rng.random(shape, np.float32), rng.random(shape, np.float32)])
    return _tables


def document_shingles(chunk: textnum.Chunk) -> tuple[list[tuple[np.ndarray, np.ndarray]], textnum.Words]:
    """For each document its distinct shingles, sorted, and their counts; and the words."""
    w = textnum.words(chunk, textnum.ALNUM, textnum.LOWER, HASH_BYTES)
    sh, at = textnum.shingles(w, K)
    return [np.unique(sh[at[d] : at[d + 1]], return_counts=True) for d in range(chunk.n)], w


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(rows with a shingle, words of all rows)."""

    def counted(batches):
        for b in batches:
            n, total = 0, 0
            for c in textnum.chunks(b.column(0)):
                words = np.diff(np.searchsorted(textnum.pieces(c, textnum.ALNUM[c.data])[0], c.offsets))
                n, total = n + int((words > 0).sum()), total + int(words.sum())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["n", "words"])

    sums = docs.select("text").mapInArrow(counted, "n long, words long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    return sums[0], sums[1]


def idf_weights(n: int, frequency: np.ndarray) -> np.ndarray:
    """1 for a shingle of every document up to 2 for that of a single one.

    The plain logarithm would let the few shingles that tell two copies of a
    large family apart outweigh all they share.
    """
    return (1 + np.log(max(n, 1) / np.clip(frequency, 1, max(n, 1))) / np.log(max(n, 2))).astype(np.float32)


def weigh(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(count)) * idf


def weighted_sets(texts: pa.Array, frequencies: pa.Array, n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each text its shingles, their counts and their idf of ``n`` documents."""
    sets = [x for c in textnum.chunks(texts) for x in document_shingles(c)[0]]
    return [(*x, idf_weights(n, unpack(df, len(x[0]), (np.uint64,))[0])) for x, df in zip(sets, frequencies)]


def signature(shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """One hash per band of the samples drawn, the weighted bands and then the
    plain ones; empty without shingles."""
    if not len(shingle):
        return np.zeros(0, np.int64)
    r, log_c, beta, plain = _sampling_tables()
    n = BANDS * ROWS
    best, who, level = np.full(2 * n, np.inf, np.float32), np.zeros(2 * n, np.uint64), np.zeros(2 * n, np.int64)
    for i in range(0, len(shingle), _BLOCK):
        part = shingle[i : i + _BLOCK]
        row = (part & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)
        ri, bi, order = r[row], beta[row], plain[row]
        t = np.floor(np.log(weight[i : i + _BLOCK]).astype(np.float32)[:, None] / ri + bi)
        log_a = log_c[row] - ri * (t - bi + 1)
        k, first, at = log_a.argmin(axis=0), order.argmin(axis=0), np.arange(n)
        found = np.concatenate([log_a[k, at], order[first, at]])
        better = found < best
        best[better], who[better] = found[better], part[np.concatenate([k, first])][better]
        level[better] = np.concatenate([t[k, at], np.zeros(n)])[better].astype(np.int64)
    samples = textnum.mix(who ^ (level.astype(np.uint64) * textnum.BASE)).reshape(2 * BANDS, ROWS)
    out = np.arange(1, 2 * BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        out = textnum.mix(out * textnum.BASE + samples[:, j])
    return out.view(np.int64)


def prefix_length(weight: np.ndarray) -> int:
    """How many shingles, first in some order common to all texts, are enough
    that every text of plain or weighted similarity >= SIMILARITY shares one
    of them among its own first; ``weight`` in that order."""
    n = len(weight)
    plain = n - int(np.ceil(SIMILARITY * n - 1e-9)) + 1
    gone = np.cumsum(weight)
    weighted = int(np.searchsorted(gone, (1 - SIMILARITY) * gone[-1] * (1 + 1e-5), side="right")) + 1
    return min(n, max(plain, weighted))


def similar(a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
    """The larger of weighted and plain Jaccard similarity of two shingle sets."""
    shared, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    wa, wb = weigh(*a[1:]), weigh(*b[1:])
    low = float(np.minimum(wa[ia], wb[ib]).sum())
    weighted = low / (float(wa.sum()) + float(wb.sum()) - low)
    return max(weighted, len(shared) / (len(a[0]) + len(b[0]) - len(shared)))


def _key() -> F.Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def signatures(docs: DataFrame, n: int, words: int, shingles_per_partition: int = SHINGLES_PER_PARTITION, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Staged: (doc_id, row, key, bands, n, weight, df) for every row of ``docs``.

    ``df`` packs the exact number of rows that hold each shingle of the row.
    A chunk of rows sends its distinct shingles once to the partition of their
    hash, which adds up all chunks and answers each, so that a shingle of all
    rows has no more than one entry per chunk; the answers meet the chunk's
    texts again.
    """
    fields = "doc_id long, row long, key binary, bands array<long>, n long, weight double, df binary"
    n_parts = max(1, -(-words // shingles_per_partition))

    def sent(batches):
        for first, chunk, _ in gathered(batches, chunk_bytes):
            keys, held = np.unique(np.concatenate([x for x, _ in document_shingles(chunk)[0]]), return_counts=True)
            cuts = parts_of(keys, n_parts)
            for p in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[p], cuts[p + 1])
                packed = pack([keys[own], held[own]], (np.uint64, np.uint32))
                yield pa.RecordBatch.from_pylist([{"chunk": first, "part": p, "n": len(keys[own]), "check": checksum(keys[own]), "packed": packed}], schema)

    def added(group: pa.Table) -> pa.Table:
        sizes = group["n"].to_pylist()
        keys, held = (np.concatenate(x) for x in zip(*(unpack(raw, k, (np.uint64, np.uint32)) for k, raw in zip(sizes, group["packed"]))))
        _, place = np.unique(keys, return_inverse=True)
        total = np.bincount(place, weights=held)[place]
        cuts = np.cumsum([0, *sizes])
        packed = [pack([total[i:j]], (np.uint64,)) for i, j in zip(cuts, cuts[1:])]
        return pa.table([group["chunk"], group["part"], group["n"], group["check"], pa.array(packed, pa.binary())], schema=schema)

    def texts(batches):
        for first, chunk, doc_id in gathered(batches, chunk_bytes):
            head = [chunk.offsets, doc_id.fill_null(0).to_numpy(zero_copy_only=False), doc_id.is_null().to_numpy(zero_copy_only=False)]
            packed = squeeze(b"".join(x.astype(np.int64).tobytes() for x in head) + chunk.data.tobytes())
            yield pa.RecordBatch.from_pylist([{"chunk": first, "part": -1, "n": chunk.n, "check": 0, "packed": packed}], schema)

    def signed(group: pa.Table) -> pa.Table:
        part = group["part"].to_numpy()
        text = int(np.flatnonzero(part < 0)[0])
        raw, m = expand(group["packed"][text]), group["n"][text].as_py()
        head = np.frombuffer(raw, np.int64, 3 * m + 1)
        at, doc_id, missing = head[: m + 1], head[m + 1 : 2 * m + 1], head[2 * m + 1 :] > 0
        chunk = textnum.Chunk(0, np.frombuffer(raw, np.uint8, offset=8 * (3 * m + 1)), at)
        sets, _ = document_shingles(chunk)
        keys = np.unique(np.concatenate([x for x, _ in sets]))
        held, cuts, answered = np.zeros(len(keys), np.uint64), parts_of(keys, n_parts), 0
        for i in np.flatnonzero(part >= 0):
            own = slice(cuts[part[i]], cuts[part[i] + 1])
            k = group["n"][i].as_py()
            if k != len(keys[own]) or group["check"][i].as_py() != checksum(keys[own]):
                raise RuntimeError("the input gave other rows when it was read again")
            held[own] = unpack(group["packed"][i], k, (np.uint64,))[0]
            answered += k
        if answered != len(keys):
            raise RuntimeError("the input gave other rows when it was read again")
        bands, total, df = [], [], []
        for shingle, count in sets:
            own = held[np.searchsorted(keys, shingle)]
            weight = weigh(count, idf_weights(n, own))
            bands.append(signature(shingle, weight))
            total.append(float(weight.sum()))
            df.append(pack([own], (np.uint64,)))
        digest = [hashlib.md5(chunk.data[i:j].tobytes()).digest() for i, j in zip(at, at[1:])]
        row = group["chunk"][0].as_py() + np.arange(m)  # rows of a chunk are numbered one after the other
        columns = [pa.array(doc_id, pa.int64(), mask=missing), pa.array(row, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
        columns += [pa.array([len(x) for x, _ in sets], pa.int64()), pa.array(total, pa.float64()), pa.array(df, pa.binary())]
        return pa.table(columns, names=[f.split()[0] for f in fields.split(", ")])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "text", F.col("doc_id").cast("long").alias("doc_id"))
    answers = rows.mapInArrow(sent, FIELDS).groupBy("part").applyInArrow(added, FIELDS)
    return stage(answers.union(rows.mapInArrow(texts, FIELDS)).groupBy("chunk").applyInArrow(signed, fields), "signatures")


def texts_of(docs: DataFrame, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Staged: (key, text, df) of the texts with these keys, each once."""
    keys = keys.select("key").distinct()
    texts = docs.select(_key().alias("key"), F.coalesce("text", F.lit("")).alias("text")).join(keys, "key", "left_semi").dropDuplicates(["key"])
    frequencies = rows.select("key", "df").join(keys, "key", "left_semi").dropDuplicates(["key"])
    return stage(texts.join(frequencies, "key"), "texts")


def verify(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Staged: the (a, b) of ``pairs`` (keys of texts) whose whole texts are similar."""

    def similar_pairs(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                sides = [weighted_sets(part.column(k), part.column(k + 1), n) for k in (2, 4)]
                keep = pa.array([similar(p, q) >= SIMILARITY for p, q in zip(*sides)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])

    side = lambda x: texts.select(F.col("key").alias(x), F.col("text").alias(f"text_{x}"), F.col("df").alias(f"df_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return stage(both.select("a", "b", "text_a", "df_a", "text_b", "df_b").mapInArrow(similar_pairs, "a binary, b binary"), "links")


def against_leader(unsettled: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Staged, for each member of an unsettled bucket: is it ``linked`` to the
    leader, the number and weight of all its shingles (n, weight) and of those
    the leader has too (s, sw), and ``tokens``: those of its prefix that the
    leader has not, where the prefix takes shingles the leader lacks first,
    rare before common, and is as long as ``rare_prefix`` says."""
    fields = "bucket long, key binary, root binary, linked boolean, n long, weight double, s long, sw double, tokens array<long>"

    def compared(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                leader, member = [weighted_sets(part.column(k), part.column(k + 1), n) for k in (3, 5)]
                out = []
                for l, m in zip(leader, member):
                    weight = weigh(*m[1:])
                    common = np.isin(m[0], l[0], assume_unique=True)
                    rank = np.lexsort((m[0], -m[2], common))
                    prefix = rank[: prefix_length(weight[rank])]
                    tokens = m[0][prefix[~common[prefix]]].view(np.int64)
                    out.append((similar(l, m) >= SIMILARITY, len(common), float(weight.sum()), int(common.sum()), float(weight[common].sum()), tokens))
                kinds = (pa.bool_(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.list_(pa.int64()))
                columns = [pa.array([row[j] for row in out], kind) for j, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns], names=[f.split()[0] for f in fields.split(", ")])

    both = unsettled.join(texts.withColumnsRenamed({"key": "first", "text": "text_l", "df": "df_l"}), "first").join(texts.withColumnsRenamed({"text": "text_m", "df": "df_m"}), "key")
    return stage(both.select("bucket", "key", "root", "text_l", "df_l", "text_m", "df_m").mapInArrow(compared, fields), "against-leader")


def across(members: DataFrame) -> DataFrame:
    """(a, b): pairs of one bucket but different components that can be similar.

    Two members share a shingle that the leader lacks, then one of their
    ``tokens``; or all they share is the leader's, then the similarity is at
    most what the smaller s allows: 4/9 of n + n.  Components differ, so one
    of the two is not linked to the leader, and only the few members short
    enough for one such outsider can meet it.
    """
    tokens = members.select("key", "root", "n", "weight", F.explode("tokens").alias("token"), "bucket").withColumn("token", F.xxhash64("bucket", "token")).drop("bucket")
    shared = tokens.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("token")
    tokens = tokens.join(shared, "token", "left_semi")
    x, y = tokens.alias("x"), tokens.alias("y")
    # no similarity exceeds the ratio of the sizes, plain or weighted
    near = lambda c: F.least(f"x.{c}", f"y.{c}") >= F.lit(SIMILARITY * 0.9999) * F.greatest(f"x.{c}", f"y.{c}")
    by_token = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.key") < F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & (near("n") | near("weight")))
    by_token = by_token.select(F.col("x.key").alias("a"), F.col("y.key").alias("b"))

    reach = (1 + SIMILARITY) / SIMILARITY * 1.0001
    sized = members.select("bucket", "key", "root", "linked", "n", "weight", (reach * F.col("s") - F.col("n")).alias("most_n"), (reach * F.col("sw") - F.col("weight")).alias("most_w"))
    least = sized.groupBy("bucket").agg(F.min("n").alias("least_n"), F.min("weight").alias("least_w"))
    outsiders = sized.filter("not linked").join(least, "bucket").filter("most_n >= least_n or most_w >= least_w").drop("least_n", "least_w")
    bound = outsiders.groupBy("bucket").agg(F.max("most_n").alias("bound_n"), F.max("most_w").alias("bound_w"))
    others = sized.join(bound, "bucket").filter("n <= bound_n or weight <= bound_w")
    x, y = outsiders.alias("x"), others.alias("y")
    fits = lambda n, most: (F.col(f"y.{n}") <= F.col(f"x.{most}")) & (F.col(f"x.{n}") <= F.col(f"y.{most}"))
    by_size = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.root") != F.col("y.root")) & (fits("n", "most_n") | fits("weight", "most_w")))
    by_size = by_size.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b"))
    return by_token.union(by_size).distinct()


def linked_texts(docs: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """(node, root): the component of every text that a verified link joins to another.

    The links of the stars settle most components; what is left to compare
    then links components, not texts, so the second search is over their
    roots alone.
    """
    entries = rows.select("key", (F.col("weight") / F.col("n")).alias("rarity"), F.explode("bands").alias("bucket")).distinct()
    buckets = entries.groupBy("bucket").agg(F.min(F.struct("rarity", "key")).alias("leader"), F.min("key").alias("k0"), F.max("key").alias("k1")).filter("k0 <> k1").select("bucket", F.col("leader.key").alias("first"))
    members = stage(entries.join(buckets, "bucket").select("bucket", "first", "key"), "members")
    texts = texts_of(docs, rows, members)
    star = stage(members.filter("first <> key").select(F.least("first", "key").alias("a"), F.greatest("first", "key").alias("b")).distinct(), "candidates")
    linked = verify(star, texts, n)

    roots = components(linked)
    labelled = members.filter("first <> key")  # the leader has met every member
    labelled = labelled.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    mixed = labelled.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("bucket")
    unsettled = labelled.select("bucket", "first", "key", "root").join(mixed, "bucket", "left_semi")
    cross = across(against_leader(unsettled, texts, n)).join(star, ["a", "b"], "left_anti")
    late = verify(stage(cross, "candidates"), texts, n)
    if late.isEmpty():
        return roots
    roots = stage(roots, "roots")
    ends = late.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    end = lambda x: ends.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    merged = components(late.join(end("a"), "a").join(end("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    merged = merged.select(F.col("node").alias("root"), F.col("root").alias("merged"))
    # texts that only a late link joins to another have no root yet
    return roots.union(ends.filter("node = root")).distinct().join(merged, "root", "left").select("node", F.coalesce("merged", "root").alias("root"))


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, row, key, class_id, class_size, kept) for every row of ``docs`` (doc_id, text).

    Words are runs of ASCII letters and digits (lower-cased) and characters
    beyond ASCII.  Texts of one to four words have one shingle, of all their
    words; texts without words are alike only if equal.  A NULL text counts
    as empty.  ``class_id`` is the smallest doc_id of the class, NULL ids
    last; ``kept`` marks exactly one row of each class, one with that doc_id.
    ``key`` is the digest of the text.  An empty table gives no rows.
    """
    n, words = corpus_size(docs)
    rows = signatures(docs, n, words)
    roots = linked_texts(docs, rows, n)
    rows = rows.select("doc_id", "row", "key").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("class_size"))
    out = rows.join(best, "root")
    return out.select("doc_id", "row", "key", F.col("best.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("best.row")).alias("kept"))


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, its columns unchanged."""
    kept = classes(docs.select("doc_id", "text")).filter("kept").select(F.col("doc_id").alias("_kept"), F.col("key").alias("_kept_key"))
    # the columns of ``docs`` travel as one, whatever their names
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col("doc_id").alias("_id"), _key().alias("_key"))
    rows = rows.join(kept, (rows["_key"] == kept["_kept_key"]) & rows["_id"].eqNullSafe(kept["_kept"])).select("_doc", "_id", "_key")
    # rows equal in id and text are one document; the join has brought them together
    return rows.dropDuplicates(["_key", "_id"]).select("_doc.*")
