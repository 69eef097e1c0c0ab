"""Centroid clustering with heap-ordered bounds.

Lloyd's rounds on integer vectors, exact. Of a vector's distances to its own centroid
(upper) and to the next other one (lower) only the gap is kept. A moving centroid
shrinks the gaps of cluster c by its own drift plus the largest drift of any other one
at most, so each cluster adds these up in one number, and a gap enters the cluster's
heap with the number of that moment added. Vectors whose entry has come down to the
cluster's number may have changed sides: they alone are popped, compared with all
centroids, and pushed again. Gaps carry a margin above the rounding of the roots; ties
have no gap, so they expire every round.

The vectors are stored once, in blocks of at most ``BLOCK`` rows, bucketed by block. A
round joins them to the heaps of the round before, which are bucketed alike: neither
side is shuffled, and only the heaps are written anew. A block reports what its moved
vectors change in the clusters' sums; the sums come to the driver, ``k`` times the
components at most. The rounds' tables are removed as soon as the next one is written,
all others when the result is stored.

Defined cases: kept are vectors of ``size`` components, none NULL, NaN or infinite;
other rows are not in the result. Components become ``floor(scale * x)``; one outside
+-2^26 is an error, for distances must fit into 64 bits. Equal vectors and equal ids
stay rows of their own; a NULL id hashes as an empty one; equal ids are ordered by their
components as starting centroids. With fewer vectors than ``k`` each starts a centroid; an
empty table gives an empty one. The carried columns are kept in a struct, so their names
cannot clash.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.llm.common import quoted, stored
from wardlight.session import Scratch

CENTROIDS = 8
ROUNDS = 10
COMPONENTS = 64
SCALE = 1024
LIMIT = 1 << 26
# Vectors of a block, and blocks of a bucket (about 64 MB of 64 components).
BLOCK = 4096
BUCKET_BLOCKS = 64
# Far above the rounding of square roots of 64-bit numbers, as a share of the distances.
MARGIN = 1e-12

STATE = "block long, keys binary, members binary, sizes array<int>, moved array<struct<slot:int,value:long>>"
FINAL = "block long, cluster array<int>, distance array<long>, inertia array<long>"


def usable(vector: Column, size: int) -> Column:
    """True for vectors of ``size`` components, all of them finite numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce((F.size(vector) == size) & whole, F.lit(False))


def integers(flat: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles."""
    found = np.floor(scale * flat.astype(np.float64))
    if len(found) and np.abs(found).max() > LIMIT:
        raise ValueError(f"a component is outside +-{LIMIT}")
    return found.astype(np.int32)


def _blocks(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """Rows packed into blocks: block, the carried rows, and the components as bytes."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                row = part.column("row")
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row),
                    pa.array([integers(flat, scale).tobytes()], pa.binary()),
                ], ["block", "rows", "vectors"])
                block += 1

    return rows.mapInArrow(pack, T.StructType([
        T.StructField("block", T.LongType()),
        T.StructField("rows", T.ArrayType(rows.schema["row"].dataType)),
        T.StructField("vectors", T.BinaryType()),
    ]))


class Heaps:
    """The gap heaps of one block of vectors."""

    def __init__(self, vectors: np.ndarray, heaps: list[list[tuple[float, int]]]) -> None:
        self.vectors, self.heaps = vectors, heaps

    @classmethod
    def unpack(cls, vectors: np.ndarray, k: int, keys: bytes | None, members: bytes | None,
               sizes: list[int] | None) -> Heaps:
        if keys is None:
            return cls(vectors, [[] for _ in range(k)])
        pairs = list(zip(np.frombuffer(keys, np.float64).tolist(),
                         np.frombuffer(members, np.int32).tolist()))
        ends = np.cumsum(sizes).tolist()
        return cls(vectors, [pairs[a:b] for a, b in zip([0, *ends], ends)])

    def pack(self) -> tuple[bytes, bytes, list[int]]:
        pairs = [pair for heap in self.heaps for pair in heap]
        return (np.array([x for x, _ in pairs], np.float64).tobytes(),
                np.array([x for _, x in pairs], np.int32).tobytes(),
                [len(heap) for heap in self.heaps])

    def expired(self, used: list[float]) -> tuple[list[int], list[int]]:
        """Pop the vectors whose gap may be used up, with the clusters they were in."""
        members, clusters = [], []
        for cluster, heap in enumerate(self.heaps):
            limit = used[cluster] * (1 + MARGIN) + MARGIN
            while heap and heap[0][0] <= limit:
                members.append(heapq.heappop(heap)[1])
                clusters.append(cluster)
        return members, clusters

    def rescan(self, members: np.ndarray, centroids: np.ndarray, used: list[float]) -> np.ndarray:
        """Compare vectors with all centroids, push them and return their clusters."""
        distances = squared(self.vectors[members], centroids)
        nearest = distances.argmin(axis=1)
        each = np.arange(len(members))
        upper = np.sqrt(distances[each, nearest].astype(np.float64))
        distances[each, nearest] = np.iinfo(np.int64).max
        lower = np.sqrt(distances.min(axis=1).astype(np.float64))
        gap = lower - upper - MARGIN * (lower + upper) if len(centroids) > 1 else upper + math.inf
        keys = gap + np.array(used)[nearest]
        for key, member, cluster in zip(keys.tolist(), members.tolist(), nearest.tolist()):
            heapq.heappush(self.heaps[cluster], (key, member))
        return nearest

    def clusters(self) -> np.ndarray:
        found = np.empty(len(self.vectors), np.int64)
        for cluster, heap in enumerate(self.heaps):
            found[[member for _, member in heap]] = cluster
        return found


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of each vector to each centroid, exact in 64 bits."""
    found = np.empty((len(vectors), len(centroids)), np.int64)
    wide = vectors.astype(np.int64)
    for c, centroid in enumerate(centroids):
        apart = wide - centroid
        found[:, c] = np.einsum("ij,ij->i", apart, apart)
    return found


def _changes(vectors: np.ndarray, old: np.ndarray, new: np.ndarray, k: int) -> list[dict]:
    """What moved vectors change in the clusters' sums and, behind them, counts."""
    size = vectors.shape[1]
    total = np.zeros((k, size + 1), np.int64)
    ones = np.ones((len(vectors), 1), np.int64)
    wide = np.hstack([vectors.astype(np.int64), ones])
    np.add.at(total, new, wide)
    was = old >= 0
    np.subtract.at(total, old[was], wide[was])
    flat = total.ravel()
    return [{"slot": s, "value": v} for s, v in
            zip(np.flatnonzero(flat).tolist(), flat[flat != 0].tolist())]


def _step(blocks: DataFrame, size: int, centroids: np.ndarray, used: list[float],
          last: bool) -> DataFrame:
    """One assignment: new heaps and changed sums, or at last clusters and distances."""
    k = len(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = np.frombuffer(row["vectors"], np.int32).reshape(-1, size)
                heaps = Heaps.unpack(vectors, k, row.get("keys"), row.get("members"),
                                     row.get("sizes"))
                if row.get("keys") is None:
                    members, old = np.arange(len(vectors)), np.full(len(vectors), -1)
                else:
                    members, old = (np.array(x, np.int64) for x in heaps.expired(used))
                new = heaps.rescan(members, centroids, used)
                if last:
                    cluster = heaps.clusters()
                    apart = vectors.astype(np.int64) - centroids[cluster]
                    distance = np.einsum("ij,ij->i", apart, apart)
                    inertia = np.zeros(k, np.int64)
                    np.add.at(inertia, cluster, distance)
                    values = [row["block"], cluster.tolist(), distance.tolist(), inertia.tolist()]
                else:
                    went = new != old
                    changes = _changes(vectors[members[went]], old[went], new[went], k)
                    values = [row["block"], *heaps.pack(), changes]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], kind) for v, kind in zip(values, kinds)], names)

    schema = T.StructType.fromDDL(FINAL if last else STATE)
    names = schema.names
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())] if last \
        else [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32()),
              pa.list_(pa.struct([("slot", pa.int32()), ("value", pa.int64())]))]
    return blocks.mapInArrow(work, schema)


class _Bucketed:
    """Tables bucketed by block, so that joining two of them moves neither.

    Their files are in the scratch folder; the catalog's entries go with ``drop``.
    """

    def __init__(self, scratch: Scratch, buckets: int) -> None:
        self.scratch, self.buckets = scratch, buckets
        self.held: dict[str, str] = {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        table, path = f"{name}_{uuid.uuid4().hex}", self.scratch.path(name)
        writer = df.write.format("parquet").bucketBy(self.buckets, "block")
        writer.option("path", path).saveAsTable(table)
        self.held[table] = path
        return df.sparkSession.table(table)

    def __enter__(self) -> _Bucketed:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()

    def drop(self, keep: int = 0) -> None:
        """Remove all tables but the first one and the last ``keep``."""
        names = list(self.held)
        for table in names[1:len(names) - keep] if keep else names:
            self.scratch.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.scratch.remove(self.held.pop(table))


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, size: int = COMPONENTS,
    scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding",
    carry: tuple[str, ...] = ("vec_id",), seed: int = 3,
) -> DataFrame:
    """Per kept vector: the carried columns as ``row``, cluster, distance, the
    inertia of its cluster and of all, and the hash of its final centroid.

    The result is a stored table; nothing else is left in the scratch folder.
    """
    spark = vectors.sparkSession
    kept = vectors.where(usable(quoted(vector), size)).select(
        F.struct(*map(quoted, carry)).alias("row"),
        quoted(vector).cast("array<double>").alias("vector"),
        quoted(vec_id).cast("string").alias("id"),
    )
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("id", F.lit(""))), 256)
    first = kept.orderBy(place, "vector").limit(k).select("vector").collect()
    centroids = [integers(np.array(r["vector"]), scale).tolist() for r in first]
    k = len(centroids)
    n_blocks = -(-kept.count() // BLOCK)
    buckets = max(1, min(n_blocks, max(spark.sparkContext.defaultParallelism,
                                       n_blocks // BUCKET_BLOCKS)))
    with Scratch(spark, "centroids") as scratch, _Bucketed(scratch, buckets) as tables:
        blocks = tables.store(
            _blocks(kept.select("row", "vector"), size, scale).repartition(buckets, "block"),
            "blocks")
        sums = [[0] * (size + 1) for _ in range(k)]
        used = [0.0] * k
        state = None
        for turn in range(rounds + 1 if k else 0):
            joined = blocks.select("block", "vectors")
            if state is not None:
                joined = joined.join(state.hint("shuffle_hash"), "block", "left")
            step = _step(joined, size, np.array(centroids, np.int64), used, turn == rounds)
            state = tables.store(step, "final" if turn == rounds else "heaps")
            tables.drop(keep=1)
            if turn == rounds:
                break
            _add_changes(sums, state)
            moved = [
                [total // count for total in row] if (count := sums[c][size]) else centroids[c]
                for c, row in enumerate(s[:size] for s in sums)
            ]
            drift = [math.dist(a, b) for a, b in zip(centroids, moved)]
            used = [u + drift[c] + max((d for e, d in enumerate(drift) if e != c), default=0.0)
                    for c, u in enumerate(used)]
            centroids = moved
        if not k:
            return stored(_described(kept.withColumns(
                {"cluster": F.lit(0), "distance": F.lit(0).cast("long")}), [0], [[0]]), "clusters")
        inertia = _sums(state, "inertia", k)
        each = F.explode(F.arrays_zip("rows", "cluster", "distance")).alias("one")
        found = blocks.select("block", "rows").join(state, "block").select(each).select(
            F.col("one.rows").alias("row"), "one.cluster", "one.distance")
        return stored(_described(found, inertia, centroids), "clusters")


def _add_changes(sums: list[list[int]], state: DataFrame) -> None:
    """Add what a round's blocks report to the clusters' sums, at most k times size numbers."""
    width = len(sums[0])
    changes = state.select(F.explode("moved").alias("m")).groupBy("m.slot").agg(
        F.sum(F.col("m.value").cast("decimal(38,0)")).alias("value"))
    for row in changes.collect():
        sums[row["slot"] // width][row["slot"] % width] += int(row["value"])


def _sums(state: DataFrame, column: str, k: int) -> list[int]:
    summed = state.agg(*[
        F.sum(F.get(column, F.lit(c)).cast("decimal(38,0)")).alias(f"c{c}") for c in range(k)
    ]).first()
    return [int(x or 0) for x in summed]


def _described(found: DataFrame, inertia: list[int], centroids: list[list[int]]) -> DataFrame:
    """Add what belongs to the whole cluster, k short values each."""
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of = lambda values: F.get(F.lit(values), F.col("cluster"))
    return found.select(
        "row", F.col("cluster").cast("int").alias("cluster"),
        F.col("distance").cast("long").alias("distance"),
        of(inertia).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"), of(hashes).alias("centroid_sha256"),
    )
