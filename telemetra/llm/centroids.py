"""Clustering by centroids over zone maps of Hilbert-ordered vectors.

Vectors are put in the order of a Hilbert curve through all their components
and cut into blocks of neighbours.  A block is one row: its vectors packed as
whole numbers, their box (the least and largest value of each component) and
their sum.  In every round the bounds of the box on differences of distances give
each block its candidates: a centroid that is farther than another one wherever
in the box a vector may lie is nearest to no vector of the block.  A block with
one candidate is settled by its sum; the vectors of the others are compared
with the candidates exactly.  All arithmetic is on whole numbers, so a result
does not depend on the partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage

#: Bits of each component in the order of the curve.
BITS = 4
#: Vectors in a block, at most.
BLOCK = 512
#: Components lie below this in size: then no squared distance of 64 of them leaves a long.
LARGEST = 1 << 27


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Rows of ``x`` (n, d), whole numbers below 2 ** bits, to their place on
    the d-dimensional Hilbert curve, as (n, d * bits / 8) bytes in big-endian
    order (Skilling's transform: undo excess work, then Gray-encode)."""
    x = x.astype(np.uint32).T.copy()
    for b in range(bits - 1, 0, -1):
        low = np.uint32((1 << b) - 1)
        for axis in x:
            turned = (axis >> np.uint32(b)) & np.uint32(1) == 1
            swap = np.where(turned, 0, (x[0] ^ axis) & low).astype(np.uint32)
            x[0] ^= np.where(turned, low, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(b)) & np.uint32(1) == 1, np.uint32((1 << b) - 1), np.uint32(0))
    x ^= flip
    planes = (x[None] >> np.arange(bits - 1, -1, -1, dtype=np.uint32)[:, None, None]) & np.uint32(1)
    return np.packbits(planes.reshape(-1, x.shape[1]).T.astype(np.uint8), axis=1)


def whole_vectors(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """(vec_id, x): the vectors of exactly ``dim`` components, none NULL or
    non-finite, as floor(scale * component)."""
    e = F.col("embedding")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    kept = vectors.filter((F.size(e) == dim) & F.forall(e, finite))
    x = F.transform(e, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    wide = F.exists(F.col("x"), lambda v: F.abs(v) >= LARGEST)
    error = F.raise_error(F.concat(F.lit("a component of vector "), F.coalesce(F.col("vec_id").cast("string"), F.lit("NULL")), F.lit(" is too large")))
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    return kept.select("vec_id", F.transform(F.when(wide, error).otherwise(F.col("x")), lambda v: v.cast("int")).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def blocks_of(rows: DataFrame, dim: int, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Staged (n, ids, data, low, high, total): the vectors of ``rows`` (vec_id, x)
    in blocks of neighbours on the curve.

    Equal vectors have equal keys; their ids and then their places in the
    input tell them apart, so that a vector which a third of all rows share is
    split over many partitions.
    """
    ends = rows.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    low, width = ends[0] or 0, (ends[1] or 0) - (ends[0] or 0) + 1

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grid = (_matrix(b.column(1), dim).astype(np.int64) - low << bits) // width
            keys = hilbert_keys(grid, bits)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([k.tobytes() for k in keys], pa.binary())], names=["vec_id", "x", "row", "key"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dim).astype(np.int32)
            for i in range(0, len(x), block):
                part = x[i : i + block]
                row = {"n": len(part), "ids": b.column(0).slice(i, block).to_pylist(), "data": part.tobytes()}
                row |= {"low": part.min(axis=0).tobytes(), "high": part.max(axis=0).tobytes(), "total": part.sum(axis=0, dtype=np.int64).tobytes()}
                yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema([("n", pa.int64()), ("ids", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("data", "low", "high", "total")]])
    ordered = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(keyed, "vec_id long, x array<int>, row long, key binary")
    ordered = ordered.repartitionByRange("key", "vec_id", "row").sortWithinPartitions("key", "vec_id", "row").select("vec_id", "x")
    return stage(ordered.mapInArrow(packed, "n long, ids array<long>, data binary, low binary, high binary, total binary"), "zone-maps")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids that can be nearest to some vector of the box.

    The difference of the squared distances to two centroids is linear in the
    vector, so its largest value over the box is the sum of each component's.
    A centroid is out where another one is nearer even there.  (Comparing one's
    least with the other's largest distance would bound the same difference
    far more loosely, as these are taken at different corners.)
    """
    low, high = low.astype(np.int64), high.astype(np.int64)
    slope = 2 * (centroids[:, None] - centroids[None])
    square = (centroids * centroids).sum(axis=1)
    most = square[None] - square[:, None] + np.maximum(slope * low, slope * high).sum(axis=2)
    return np.flatnonzero(~(most < 0).any(axis=1))


def nearest(x: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector; ties go to the smaller number."""
    best, distance = np.zeros(len(x), np.int64), np.full(len(x), np.iinfo(np.int64).max)
    for c in among:
        d = x - centroids[c]
        d = (d * d).sum(axis=1)
        closer = d < distance
        best[closer], distance[closer] = c, d[closer]
    return best, distance


def _each(batches: Iterator[pa.RecordBatch], centroids: np.ndarray):
    """(ids, vectors, their number, their sum, candidates) of each block; the vectors unpacked on call."""
    dim = centroids.shape[1]
    for b in batches:
        for n, ids, data, low, high, total in zip(*b.columns):
            among = candidates(np.frombuffer(low.as_py(), np.int32), np.frombuffer(high.as_py(), np.int32), centroids)
            yield ids, lambda: np.frombuffer(data.as_py(), np.int32).reshape(-1, dim).astype(np.int64), n.as_py(), np.frombuffer(total.as_py(), np.int64), among  # noqa: B023


def next_centroids(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid moved to the floor of the mean of its vectors; one without any stays."""

    def summed(batches):
        k, dim = centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, vectors, n, whole, among in _each(batches, centroids):
            if len(among) == 1:
                count[among[0]] += n
                total[among[0]] += whole
                continue
            x = vectors()
            own, _ = nearest(x, centroids, among)
            count += np.bincount(own, minlength=k)
            for c in np.unique(own):
                total[c] += x[own == c].sum(axis=0)
        for c in np.flatnonzero(count):
            yield pa.RecordBatch.from_pydict({"cluster": np.full(dim, c), "dim": np.arange(dim), "n": np.full(dim, count[c]), "total": total[c]})

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = blocks.mapInArrow(summed, "cluster long, dim long, n long, total long").groupBy("cluster", "dim").agg(exact("n"), exact("total"))
    out = centroids.copy()
    for r in sums.collect():  # centroids x components
        out[r.cluster, r.dim] = int(r.total) // int(r.n)
    return out


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:vec_id`` (fewer if
    there are fewer; equal ids are told apart by their components)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = rows.select(digest.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r.x for r in first], np.int64)


def fit(rows: DataFrame, blocks: DataFrame, k: int, rounds: int, seed: int) -> np.ndarray:
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        moved = next_centroids(blocks, centroids)
        if np.array_equal(moved, centroids):
            break  # all further rounds would leave them there, too
        centroids = moved
    return centroids


def assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector in ``blocks``."""

    def found(batches):
        for ids, vectors, _, _, among in _each(batches, centroids):
            own, distance = nearest(vectors(), centroids, among)
            yield pa.RecordBatch.from_arrays([ids.values, pa.array(own, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(found, "vec_id long, cluster int, distance long")


def work_saved(blocks: DataFrame, centroids: np.ndarray) -> tuple[int, int]:
    """(pairs of vector and centroid left by the boxes, all such pairs)."""

    def counted(batches):
        left, every = 0, 0
        for _, _, n, _, among in _each(batches, centroids):
            left, every = left + n * len(among), every + n * len(centroids)
        yield pa.RecordBatch.from_pydict({"left": [left], "every": [every]})

    sums = blocks.mapInArrow(counted, "left long, every long").agg(F.sum("left"), F.sum("every")).first()
    return sums[0] or 0, sums[1] or 0


def _constant(centroids: np.ndarray, cluster: Column) -> Column:
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return F.element_at(F.array(*[F.lit(d) for d in digests]), cluster + 1)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)
    of every usable row of ``vectors`` (vec_id, embedding).

    Rows whose embedding is NULL, has not ``dim`` components or has one that
    is NULL, NaN or infinite are left out.  Components become
    floor(scale * x); one of 2 ** 27 or more in size fails the job, as its
    squared distances would not fit a long.  A NULL vec_id is kept and hashed as
    empty; rows with equal ids or vectors are rows like others.  Ties of
    distance go to the smaller cluster, and a cluster without vectors keeps
    its centroid.  With fewer than ``k`` vectors there are as many clusters as
    vectors; an empty table gives no rows.  Other columns are not read.
    """
    rows = whole_vectors(vectors.select("vec_id", "embedding"), dim, scale)
    blocks = blocks_of(rows, dim)
    centroids = fit(rows, blocks, k, rounds, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    out = assigned(blocks, centroids)
    sums = {r.cluster: int(r.s) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # one per cluster
    inertia = F.array(*[F.lit(sums.get(c, 0)).cast("long") for c in range(len(centroids))])
    return out.select(
        "vec_id",
        "cluster",
        "distance",
        F.element_at(inertia, F.col("cluster") + 1).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        _constant(centroids, F.col("cluster")).alias("centroid_sha256"),
    )
