"""Heap-ordered clustering against plain rounds in whole numbers."""

import hashlib
import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.llm import centroids
from wardlight.session import shared_dir

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=8, rounds=10, size=64):
    """vec_id, cluster, distance and centroid hash by full scans."""
    kept = [(i, [math.floor(1024 * x) for x in np.array(v, np.float32).astype(float).tolist()])
            for i, v in rows if v is not None and len(v) == size
            and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v)
                   for i, v in kept)
    middle = [v for _, v in first[:k]]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min(range(len(middle)), key=lambda c: (far(v, middle[c]), c)) for _, v in kept]

    for _ in range(rounds):
        of = assign()
        for c in range(len(middle)):
            held = [v for (_, v), x in zip(kept, of) if x == c]
            if held:
                middle[c] = [sum(column) // len(held) for column in zip(*held)]
    hashes = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middle]
    of = assign()
    found = [(i, c, far(v, middle[c]), hashes[c]) for (i, v), c in zip(kept, of)]
    inertia = [sum(f[2] for f in found if f[1] == c) for c in range(len(middle))]
    return sorted(((i, c, d, inertia[c], sum(inertia), h) for i, c, d, h in found), key=str)


def got(frame):
    return sorted(((r["row"]["vec_id"], *r[1:]) for r in frame.collect()), key=str)


def blobs(rng, n, spread=0.3):
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    return [(i, [x + rng.gauss(0, spread) for x in rng.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("block", [centroids.BLOCK, 7])
def test_clusters_equal_plain_rounds(spark, monkeypatch, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rng = random.Random(4)
    rows = blobs(rng, 250) + blobs(rng, 150, 2.0)[:150]
    rows = [(i, v) for i, (_, v) in enumerate(rows)]
    rows += [(i, rows[3][1]) for i in range(500, 620)]  # one vector, many times
    rows += [(900, rows[0][1]), (900, rows[1][1]), (900, rows[1][1]), (None, rows[2][1])]
    rows += [(901, None), (902, rows[0][1][:63]), (903, [None] * 64), (904, []),
             (905, [math.nan] * 64), (906, [math.inf] * 64)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    assert got(centroids.cluster(table)) == plain(rows)


def test_ties_and_few_vectors(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(40)]  # starting centroids that coincide
    assert got(centroids.cluster(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA))) == plain(rows)
    rows = [(1, [1.0] * 64), (2, [-2.5] * 64), (3, [0.25] * 64)]
    assert got(centroids.cluster(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA))) == plain(rows)
    table = spark.createDataFrame([(7, [0.5] * 64, 0)], SCHEMA)
    assert got(centroids.cluster(table, k=1, rounds=2)) == plain([(7, [0.5] * 64)], 1, 2)


def test_empty_tables_clashing_names_and_range(spark):
    table = spark.createDataFrame([(1, [0.5] * 64, 0)], SCHEMA)
    names = ("block", "rows", "vectors", "a.b", "cluster", "row", "id", "vector")
    wide = table.withColumns({c: F.lit(c) for c in names})
    row = centroids.cluster(wide, carry=tuple(wide.columns)).first()
    assert row["row"]["a.b"] == "a.b" and row["row"]["cluster"] == "cluster" and row["cluster"] == 0
    for nothing in (table.limit(0), table.where("false"), table.select(
            "vec_id", F.slice("embedding", 1, 3).alias("embedding"), "label")):
        empty = centroids.cluster(nothing)
        assert empty.count() == 0 and empty.columns == centroids.cluster(table).columns
    with pytest.raises(Exception, match="outside"):
        centroids.cluster(spark.createDataFrame([(1, [1e9] * 64, 0)], SCHEMA))


def test_only_expired_vectors_are_popped():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-50, 50, (500, 4)).astype(np.int32)
    middle = rng.integers(-50, 50, (3, 4)).astype(np.int64)
    heaps = centroids.Heaps(vectors, [[], [], []])
    of = heaps.rescan(np.arange(500), middle, [0.0] * 3)
    assert (heaps.clusters() == of).all()
    ties = np.sort(centroids.squared(vectors, middle), axis=1)
    members, _ = heaps.expired([0.0] * 3)
    assert sorted(members) == np.flatnonzero(ties[:, 0] == ties[:, 1]).tolist()
    heaps.rescan(np.array(members), middle, [0.0] * 3)
    moved = middle + np.array([[1, 0, 0, 0], [0, 2, 0, 0], [0, 0, 0, 0]])
    used = [3.0, 3.0, 2.0]
    members, _ = heaps.expired(used)
    assert 0 < len(members) < 250
    heaps.rescan(np.array(members), moved, used)
    assert (heaps.clusters() == centroids.squared(vectors, moved).argmin(axis=1)).all()
    again = centroids.Heaps.unpack(vectors, 3, *heaps.pack())
    assert again.heaps == heaps.heaps


def test_only_the_result_stays(spark):
    rng = random.Random(5)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.rglob("*.parquet"))
    result = centroids.cluster(spark.createDataFrame([(*r, 0) for r in blobs(rng, 60)], SCHEMA))
    left = {p.parent for p in set(folder.rglob("*.parquet")) - before}
    assert len(left) == 1 and result.count() == 60
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("blocks_", "heaps_"))]


def test_a_round_moves_no_vectors(spark):
    """The bucketed tables are joined where they are."""
    with centroids.Scratch(spark, "plan") as scratch, centroids._Bucketed(scratch, 4) as tables:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            left, right = (tables.store(spark.range(9).withColumnRenamed("id", "block"), name)
                           for name in ("blocks", "heaps"))
            joined = left.join(right.hint("shuffle_hash"), "block", "left")
            plan = joined._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan
