"""A count-min sketch of 64-bit hashes, made per partition and merged by shard.

Each of ``ROWS`` rows maps a hash to one of ``cells`` counters. The caller only asks
whether a hash was counted twice or more, so counters stop at two. A partition
sends, per row and shard, the sorted counter numbers as byte steps: about a byte
per hash, where the hash itself has eight. Shards are merged apart, partitions by
the 256 at a time. The merged sketch, two bits of which matter per counter, is at
most ``MAX_CELLS / 8`` bytes a row; that is the proven bound of what is broadcast.
Counts are only ever too high, so nothing that repeats is missed; a corpus far
larger than the sketch merely filters less.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 2
SHARD_BITS = 22
MIN_CELLS = 1 << SHARD_BITS
MAX_CELLS = 1 << 29
MERGE_AT_ONCE = 256
# Hashes a task holds before it sends their counters.
FLUSH = 4_000_000


def cells_for(hashes: int) -> int:
    """Counters per row: a power of two, twice the hashes at least, within the bounds."""
    return min(MAX_CELLS, max(MIN_CELLS, 1 << max(0, 2 * int(hashes) - 1).bit_length()))


def cell(hashes: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (hashes >> np.uint64(32 * row)) & np.uint64(cells - 1)


def to_steps(offsets: np.ndarray) -> bytes:
    """Sorted numbers as steps in bytes; 255 stands for "255 and go on"."""
    steps = np.diff(offsets, prepend=0)
    more, rest = np.divmod(steps, 255)
    ends = np.cumsum(more + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = rest
    return out.tobytes()


def from_steps(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def _blobs(hashes: np.ndarray, cells: int, part: int) -> pa.RecordBatch:
    size = 1 << SHARD_BITS
    parts, rows, shards, blobs = [], [], [], []
    for row in range(ROWS):
        found = np.sort(cell(hashes, row, cells).astype(np.uint32)).astype(np.int64)
        edges = np.searchsorted(found, np.arange(0, cells + 1, size))
        for shard in np.flatnonzero(np.diff(edges)):
            parts.append(part)
            rows.append(row)
            shards.append(int(shard))
            blobs.append(to_steps(found[edges[shard]:edges[shard + 1]] - shard * size))
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array(rows, pa.int32()), pa.array(shards, pa.int32()),
         pa.array(blobs, pa.binary())], ["part", "row", "shard", "cells"],
    )


def _merge(last: bool) -> Callable[[pa.Table], pa.Table]:
    def merge(table: pa.Table) -> pa.Table:
        size = 1 << SHARD_BITS
        counts = np.zeros(size, np.uint8)
        held, n = [], 0
        for k, blob in enumerate(table.column("cells"), 1):
            held.append(from_steps(blob.as_py()))
            n += len(held[-1])
            if n >= FLUSH or k == table.num_rows:
                found = np.bincount(np.concatenate(held), minlength=size)
                counts = np.minimum(found + counts, 2).astype(np.uint8)
                held, n = [], 0
        cells = (
            np.packbits(counts == 2, bitorder="little").tobytes() if last
            else to_steps(np.repeat(np.arange(size), counts))
        )
        head = table.slice(0, 1)
        return pa.table({
            "part": head.column("part"), "row": head.column("row"), "shard": head.column("shard"),
            "cells": pa.array([cells], pa.binary()),
        })

    return merge


SCHEMA = "part int, row int, shard int, cells binary"


def repeated_cells(
    df: DataFrame, extract: Callable[[pa.RecordBatch], Iterator[np.ndarray]], cells: int
) -> np.ndarray:
    """A row of bits per sketch row: counters that reached two.

    ``extract`` gives the hashes (uint64) of a batch in pieces. ``df`` should be a
    scan: a shuffle below it would run once more for the number of partitions.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, n = [], 0
        for batch in batches:
            for hashes in extract(batch):
                held.append(hashes)
                n += len(hashes)
                if n >= FLUSH:
                    yield _blobs(np.concatenate(held), cells, part)
                    held, n = [], 0
        if n:
            yield _blobs(np.concatenate(held), cells, part)

    blobs = df.mapInArrow(emit, SCHEMA)
    parts = df.rdd.getNumPartitions()
    while parts > MERGE_AT_ONCE:
        blobs = (
            blobs.withColumn("part", F.floor(F.col("part") / MERGE_AT_ONCE).cast("int"))
            .groupBy("part", "row", "shard").applyInArrow(_merge(False), SCHEMA)
        )
        parts = -(-parts // MERGE_AT_ONCE)
    merged = blobs.groupBy("row", "shard").applyInArrow(_merge(True), SCHEMA)
    bits = np.zeros((ROWS, cells // 8), np.uint8)
    size = (1 << SHARD_BITS) // 8
    for found in merged.toLocalIterator():
        at = found["shard"] * size
        bits[found["row"], at:at + size] = np.frombuffer(found["cells"], np.uint8)
    return bits


def send(df: DataFrame, bits: np.ndarray) -> Broadcast:
    """Broadcast the bits, compressed: most counters stay below two."""
    return df.sparkSession.sparkContext.broadcast((bits.shape, zlib.compress(bits.data, 1)))


def received(sent: Broadcast) -> np.ndarray:
    shape, data = sent.value
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(shape)


def maybe_repeated(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the sketch counts twice or more."""
    cells = bits.shape[1] * 8
    found = np.ones(len(hashes), bool)
    for row in range(ROWS):
        at = cell(hashes, row, cells)
        found &= ((bits[row, at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1) == 1
    return found
