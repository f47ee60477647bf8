"""Centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors become integer vectors (``floor(scale * x)``), are ordered along a
Hilbert curve through the plane of the first centroids' main directions, and cut
into blocks of ``block_rows`` rows, written once with the least and largest value
of every component (the block's box).  A round reads the blocks: bounds over the
box say which centroids can be nearest to any vector of the block -

* distance: a centroid whose least distance to the box exceeds another one's
  largest distance is out;
* difference: ``d(x, a) - d(x, b)`` is linear in ``x``, so its least value over
  the box is taken at a corner; where that is above 0 (or 0 and b has the smaller
  number), a is out;

- and the rest are compared exactly with every vector of the block, in array
steps.  Bounds and distances are exact integers: blocks change the work, never
the result.  A task adds its vectors up per centroid before anything is
shuffled; the driver sees ``k`` rows per component.

Vectors are ordered by (curve key, id, place in the input), so one very common
vector is dealt over many partitions and blocks like any others.

Defined results: a vector that is null, of another length, or with a component
that is null, not finite or of 2^20 and more (its squared distances would not fit
a long) is left out.  A null id is kept and never a first centroid.  Repeated rows are
vectors of their own (equal hashes: ordered by the vector).  With fewer than ``k``
vectors there are fewer centroids; an empty table gives no rows.  Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utxoflow.llm.common import arrow_schema, batch_of, staged
from utxoflow.session import pickle_by_value

#: Components are below 2^26 after scaling: 64 squares of differences stay below 2^60.
LIMIT = 1 << 26
#: Below this, products and distances of 64 components are exact in doubles.
SMALL = 1 << 22
#: Directions and bits per direction of the curve: 56 bits in a long.
AXES, BITS = 8, 7

BLOCKS = "ids array<bigint>, vectors binary, lo array<int>, hi array<int>"
ASSIGNED = "vec_id bigint, cluster int, distance bigint"
SUMS = "cluster int, n bigint, sums array<bigint>, compared bigint"


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """id and integer vector of every valid row."""
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT / scale)

    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).filter(F.size("v") == dims)
    return rows.filter(F.forall("v", fine)).select("id", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose hashed ids come first."""
    named = rows.filter(F.col("id").isNotNull())
    hashed = named.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("h"), "v")
    return np.array([list(r["v"]) for r in hashed.orderBy("h", "v").limit(k).collect()], np.int64)


# ---- order ----

def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of every row of ``cells`` (rows x axes,
    integers below 2^bits): axes are turned into the transposed index level by
    level, then its bits are interleaved."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(axes):
            inverted = (x[i] & q) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverted, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = top
    while q > 1:
        flip = np.where((x[-1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    out = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def directions(centroids: np.ndarray, axes: int = AXES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Main directions of the centroids, and the lower end and width of their
    range in each.  They shape the order only."""
    middle = centroids.mean(axis=0)
    basis = np.linalg.svd(centroids - middle, full_matrices=False)[2][:axes].T
    seen = centroids @ basis
    margin = 0.25 * (seen.max(axis=0) - seen.min(axis=0)) + 1e-9
    return basis, seen.min(axis=0) - margin, seen.max(axis=0) - seen.min(axis=0) + 2 * margin


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows x dims matrix of a list column whose lists are all ``dims`` long."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def build_blocks(rows: DataFrame, centroids: np.ndarray, block_rows: int, partitions: int) -> DataFrame:
    """The written blocks of ``rows`` in curve order."""
    dims = centroids.shape[1]
    basis, low, width = directions(centroids)
    keyed_schema, schema = arrow_schema("id bigint, v array<int>, key bigint"), arrow_schema(BLOCKS)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = (matrix(batch.column(1), dims) @ basis - low) / width
            cells = np.clip(share * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
            yield batch_of(keyed_schema, {"id": batch.column(0), "v": batch.column(1).cast(keyed_schema.field("v").type),
                                          "key": hilbert_keys(cells)})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= block_rows:
                whole = pa.Table.from_batches(held).combine_chunks()
                yield block(whole.slice(0, block_rows))
                held = whole.slice(block_rows).to_batches()
                n -= block_rows
        if n:
            yield block(pa.Table.from_batches(held))

    def block(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        v = matrix(part.column(1).chunk(0), dims).astype(np.int32)
        return batch_of(schema, {"ids": [part.column(0).to_pylist()], "vectors": [v.tobytes()],
                                 "lo": [v.min(axis=0).tolist()], "hi": [v.max(axis=0).tolist()]})

    keyed = rows.mapInArrow(keys, "id bigint, v array<int>, key bigint").withColumn("place", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(partitions, "key", "id", "place").sortWithinPartitions("key", "id", "place")
    return staged(ordered.select("id", "v").mapInArrow(cut, BLOCKS), "centroid-blocks")


# ---- a round ----

def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers, ascending, of the centroids that can be nearest to a vector of
    the box [lo, hi] (smaller number wins a tie)."""
    outside = np.maximum(np.maximum(lo - centroids, centroids - hi), 0)
    least = (outside * outside).sum(axis=1)
    far = np.maximum(np.abs(centroids - lo), np.abs(hi - centroids))
    left = np.flatnonzero(least <= (far * far).sum(axis=1).min())
    if len(left) == 1:
        return left
    c = centroids[left]
    size = (c * c).sum(axis=1)
    step = c[:, None, :] - c[None, :, :]
    top = np.maximum(step * lo, step * hi).sum(axis=2)  # largest x.(a - b) over the box
    gap = size[:, None] - size[None, :] - 2 * top  # least d(x, a) - d(x, b)
    beaten = (gap > 0) | ((gap == 0) & (left[None, :] < left[:, None]))
    return left[~beaten.any(axis=1)]


def distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows x centroids."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= SMALL:
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((v - x) ** 2).sum(axis=1) for x in c], axis=1)


def nearest(batch: pa.RecordBatch, row: int, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Vectors of a block, their centroids and distances, and how many
    distances were taken."""
    dims = centroids.shape[1]
    v = np.frombuffer(batch.column(1)[row].as_buffer(), np.int32).reshape(-1, dims).astype(np.int64)
    lo, hi = (batch.column(i)[row].values.to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
    left = candidates(lo, hi, centroids)
    if len(left) == 1:
        apart = v - centroids[left[0]]
        return v, np.full(len(v), left[0]), (apart * apart).sum(axis=1), len(v)
    d = distances(v, centroids[left])
    at = d.argmin(axis=1)
    return v, left[at], d[np.arange(len(v)), at], d.size


def summed(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per task and centroid: vectors, their sum, distances taken."""
    schema = arrow_schema(SUMS)
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, compared = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), 0
        for batch in batches:
            for row in range(batch.num_rows):
                v, cluster, _, taken = nearest(batch, row, centroids)
                compared += taken
                for c in np.unique(cluster):
                    own = v[cluster == c]
                    n[c] += len(own)
                    sums[c] += own.sum(axis=0)
        used = np.flatnonzero(n)
        yield batch_of(schema, {"cluster": used, "n": n[used], "sums": sums[used].tolist(),
                                "compared": [compared if i == 0 else 0 for i in range(len(used))]})

    return blocks.mapInArrow(run, SUMS)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of exact means; empty ones stay."""
    parts = summed(blocks, centroids).select("cluster", "n", F.posexplode("sums").alias("dim", "s"))
    exact = "decimal(38,0)"
    rows = parts.groupBy("cluster", "dim").agg(F.sum(F.col("s").cast(exact)).alias("s"), F.sum(F.col("n").cast(exact)).alias("n"))
    out = centroids.copy()
    for r in rows.collect():  # centroids x components
        out[r["cluster"], r["dim"]] = int(r["s"]) // int(r["n"])
    return out


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """id, centroid and squared distance of every vector."""
    schema = arrow_schema(ASSIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                _, cluster, d, _ = nearest(batch, row, centroids)
                yield batch_of(schema, {"vec_id": batch.column(0)[row].values, "cluster": cluster, "distance": d})

    return blocks.mapInArrow(run, ASSIGNED)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 16, rounds: int = 3,
            dims: int = 64, scale: int = 64, seed: int = 1, block_rows: int = 512, partitions: int | None = None) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia (summed
    distances) and centroid_sha256 (of the components joined by commas)."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vec_col, dims, scale)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], ASSIGNED + ", cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    blocks = build_blocks(rows, centroids, block_rows, partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    assigned = staged(assign(blocks, centroids), "centroid-assigned")
    own = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # at most k rows
    facts = [(c, s, sum(own.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, s in own.items()]
    ends = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(ends), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


pickle_by_value(__name__)
pickle_by_value("utxoflow.llm.common")
