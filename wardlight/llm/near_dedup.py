"""Near-duplicate classes by BagMinHash signatures, bands and verified overlap.

A text is the multiset of its five-word shingles. BagMinHash signs it: each shingle
runs Poisson processes over its weight, cut at the integers. The range [0, 1) and
the doubling ranges [1, 2), [2, 4), [4, 8), ... are independent; the first point of
a range is the first of its two halves', so a range is only split while its first
point can still matter, and a large weight costs its logarithm. Every point falls
on one of the ``SLOTS`` slots, which keep their earliest time. Two texts agree in a
slot with the chance of their weighted Jaccard similarity, without bias.

Equal word sequences are one node. Nodes that agree in a band of slots share a
bucket. Buckets of ``SMALL`` nodes at most compare all their pairs. In a larger one a
hub is compared with the others, and classes of linked nodes are formed; then the
nodes outside the bucket's largest class are compared with all nodes of other
classes, in blocks. So no pair of different classes that shares a bucket stays
unchecked, yet copies of one text never meet in pairs. Every link is verified on the
exact multiset overlap.

Defined cases: NULL and word-less texts are alone in their class; texts below five
words are one shingle; rows of equal words are copies. A class is named by its
smallest doc_id (NULL if it has none); ``drop_near_copies`` keeps one row of each
class, the one of the smallest id, then of the smallest text hash.
Nodes are numbered by a 64-bit hash of their words.
Ids are whole numbers or text that spells them. Texts of any length are signed and
compared whole; other columns are kept in a struct, so their names cannot clash; an
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlight.llm.common import quoted, row_tag, stored, word_hashes
from wardlight.llm.substring_dedup import mix, pieces, window_hashes
from wardlight.session import Scratch

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
BAND_SLOTS = 6
SLOTS = BANDS * BAND_SLOTS
SMALL = 16
BLOCK = 256


def shingles(values: np.ndarray) -> np.ndarray:
    """The shingle hashes of one text's word hashes."""
    return window_hashes(values, min(SHINGLE, len(values))) if len(values) else values


def _bags(lists: pa.ListArray):
    """Distinct shingles and counts, by pieces: first row, number of rows, row, hash, count."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    for row, end, values, rows, places in pieces(lists, SHINGLE):
        found = window_hashes(values, SHINGLE)
        found = found[offsets[rows] - offsets[row] + places] if len(rows) else found[:0]
        short = [
            (r, shingles(values[offsets[r] - offsets[row]:offsets[r + 1] - offsets[row]])[0])
            for r in np.flatnonzero(np.diff(offsets[row:end + 1]) < SHINGLE) + row
            if offsets[r + 1] > offsets[r]
        ]
        if short:
            rows = np.concatenate([rows, [r for r, _ in short]])
            found = np.concatenate([found, np.array([h for _, h in short], np.uint64)])
        order = np.lexsort((found, rows))
        rows, found = rows[order], found[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
        first = np.flatnonzero(new)
        yield row, end - row, rows[first] - row, found[first], np.diff(np.append(first, len(rows)))


def _uniform(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _wait(keys: np.ndarray, rate) -> np.ndarray:
    return -np.log(_uniform(keys)) / rate


def _key(keys: np.ndarray, step) -> np.ndarray:
    return mix(keys ^ np.uint64(0xD6E8FEB86659FD93), np.asarray(step, np.uint64))


def bag_min_hash(n_rows: int, rows: np.ndarray, found: np.ndarray, counts: np.ndarray,
                 slots: int = SLOTS) -> np.ndarray:
    """Signatures (times) of weighted sets given as (row, element, whole weight)."""
    times = np.full(n_rows * slots, np.inf)
    # Roots: [0, 1) and the doubling ranges that begin below the weight.
    levels = np.where(counts > 1, np.ceil(np.log2(np.maximum(counts, 2))).astype(np.int64), 0) + 1
    each = np.repeat(np.arange(len(rows)), levels)
    level = np.arange(len(each)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.maximum(low, 1)
    row, weight, key = rows[each], counts[each], _key(found[each], level)
    time = _wait(_key(key, 1), width)
    taken = np.zeros(len(row), np.uint64)
    while len(row):
        latest = times.reshape(n_rows, slots).max(axis=1)
        live = time <= latest[row]
        row, weight, key, time, low, width, taken = (
            x[live] for x in (row, weight, key, time, low, width, taken))
        # Ranges wider than one level: the first point goes to one half, the other
        # half's first point comes later.
        wide = width > 1
        if wide.any():
            half = width[wide] // 2
            left_first = _uniform(_key(key[wide], 2)) < 0.5
            later = time[wide] + _wait(_key(key[wide], 3), half)
            split = []
            for side, inherits, start in ((4, left_first, low[wide]),
                                          (5, ~left_first, low[wide] + half)):
                inside = start < weight[wide]
                split.append((row[wide][inside], weight[wide][inside],
                              _key(key[wide], side)[inside],
                              np.where(inherits, time[wide], later)[inside],
                              start[inside], half[inside],
                              np.zeros(int(inside.sum()), np.uint64)))
            old = tuple(x[~wide] for x in (row, weight, key, time, low, width, taken))
            row, weight, key, time, low, width, taken = (
                np.concatenate(x) for x in zip(old, *split))
            continue
        if not len(row):
            break
        # Single levels: take the point, and some more of its process.
        many = int(np.clip(100_000 // len(row), 1, 32))
        steps = np.uint64(16) + 2 * (taken[:, None] + np.arange(many, dtype=np.uint64))
        slot = _key(key[:, None], steps) % np.uint64(slots)
        waits = _wait(_key(key[:, None], steps + np.uint64(1)), 1.0)
        points = np.cumsum(np.concatenate([time[:, None], waits], 1), axis=1)
        np.minimum.at(times, (row[:, None] * slots + slot.astype(np.int64)).ravel(),
                      points[:, :-1].ravel())
        time, taken = points[:, -1], taken + np.uint64(many)
    return times.reshape(n_rows, slots)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, tag, node (NULL without words), n (shingles) and the band hashes."""
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_tag().alias("tag"),
                         word_hashes(F.col("text")).alias("hashes"))
    hashed = hashed.select(
        "doc_id", "tag", "hashes", F.when(F.size("hashes") > 0, F.xxhash64("hashes")).alias("node")
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bands = [], []
            for _, n_rows, rows, found, counts in _bags(batch.column("hashes")):
                times = bag_min_hash(n_rows, rows, found, counts)
                bits = times.view(np.uint64).reshape(n_rows, BANDS, BAND_SLOTS)
                band = np.zeros((n_rows, BANDS), np.uint64)
                for k in range(BAND_SLOTS):
                    band = mix(band, bits[:, :, k])
                n.append(np.bincount(rows, counts, minlength=n_rows).astype(np.int64))
                bands.append(band.view(np.int64).ravel())
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(n) + 1) * BANDS, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tag"), batch.column("node"), pa.array(n),
                 lists], ["doc_id", "tag", "node", "n", "bands"])

    return hashed.mapInArrow(
        sign, "doc_id long, tag long, node long, n long, bands array<long>")


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of the shingle multisets of two word-hash arrays."""
    x, n_x = np.unique(shingles(a), return_counts=True)
    y, n_y = np.unique(shingles(b), return_counts=True)
    _, at_x, at_y = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(n_x[at_x], n_y[at_y]).sum())
    total = int(n_x.sum() + n_y.sum()) - common
    return common / total if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose overlap reaches the similarity."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select(
        "a", "b", word_hashes(F.col("text_a")).alias("of_a"),
        word_hashes(F.col("text_b")).alias("of_b"),
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_a, of_b = batch.column("of_a"), batch.column("of_b")
            keep = [
                overlap(a.values.to_numpy().view(np.uint64), b.values.to_numpy().view(np.uint64))
                >= similarity - 1e-12
                for a, b in zip(of_a, of_b)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(check, "a long, b long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node and its class (the smallest node it is linked with, over any steps).

    Every round takes the smallest class among the neighbours and then the class
    of that class; tables are stored between rounds, nothing but a count is
    collected.
    """
    both = scratch.store(
        links.select("a", "b").union(links.select("b", "a")).distinct().toDF("node", "near"),
        "class-links",
    )
    table = classes = scratch.store(
        both.groupBy("node").agg(F.least("node", F.min("near")).alias("class")), "classes")
    while True:
        near = classes.select(F.col("node").alias("near"), F.col("class").alias("near_class"))
        least = (
            both.join(near, "near").groupBy("node").agg(F.min("near_class").alias("least"))
            .join(classes, "node")
            .select("node", F.col("class").alias("old"), F.least("class", "least").alias("mid"))
        )
        jump = classes.select(F.col("node").alias("mid"), F.col("class").alias("far"))
        moved = scratch.store(
            least.join(jump, "mid", "left").select(
                "node", "old", F.least("mid", F.coalesce("far", "mid")).alias("class")),
            "classes",
        )
        scratch.drop(table)
        table, classes = moved, moved.select("node", "class")
        if moved.where("old != class").isEmpty():
            scratch.drop(both)
            return classes


def _distinct_pairs(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs a < b whose shingle counts allow the similarity."""
    return (
        pairs.where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (similarity - 1e-12))
        .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.lit(1).alias("one"))
        .select("a", "b")
    )


def linked(
    docs: DataFrame, signed: DataFrame, scratch: Scratch, similarity: float = SIMILARITY
) -> DataFrame:
    """Verified links between nodes that connect each class; see the module's text."""
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min("n").alias("n"), F.min("tag").alias("tag"), F.first("bands").alias("bands"))
    placed = nodes.select("node", "n", "tag", F.posexplode("bands").alias("band", "key"))
    buckets = (
        placed.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    )
    members = scratch.store(placed.join(buckets, ["band", "key"]), "band-members")
    # Texts of the nodes that meet any other, one row each, of one row of the node.
    wanted = members.groupBy("node").agg(F.first("tag").alias("tag"))
    texts = scratch.store(
        docs.select(row_tag().alias("tag"), "text").join(wanted, "tag")
        .groupBy("node").agg(F.first("text").alias("text")),
        "met-texts",
    )
    small = members.where(F.col("size") <= SMALL)
    a = small.select("band", "key", F.col("node").alias("a"), F.col("n").alias("n_a"))
    b = small.select("band", "key", F.col("node").alias("b"), F.col("n").alias("n_b"))
    pairs = _distinct_pairs(
        a.join(b, ["band", "key"]).where("a < b").select("a", "b", "n_a", "n_b"), similarity)
    links = [scratch.store(verified(pairs, texts, similarity), "links")]

    large = members.where(F.col("size") > SMALL)
    if large.isEmpty():
        return links[0]
    weights = large.groupBy("node").agg(F.sum("size").alias("weight"))
    large = scratch.store(
        large.join(weights, "node").select(
            "node", "n", F.xxhash64("band", "key").alias("bucket"), "weight"),
        "large-buckets",
    )
    # One hub per bucket, the node that large buckets hold most often.
    hub = large.groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
    met = large.join(hub, "bucket").where("node != hub.node").select(
        F.col("node").alias("a"), F.col("n").alias("n_a"),
        F.col("hub.node").alias("b"), F.col("hub.n").alias("n_b"))
    links.append(scratch.store(verified(_distinct_pairs(met, similarity), texts, similarity), "links"))
    known = links[0].union(links[1])
    return known.union(scratch.store(_rest_links(
        large, components(known, scratch), texts, similarity, scratch), "links"))


def _rest_links(
    large: DataFrame, classes: DataFrame, texts: DataFrame, similarity: float, scratch: Scratch
) -> DataFrame:
    """Links of nodes outside their bucket's largest class to all nodes of other classes.

    Both sides are dealt into blocks of ``BLOCK`` nodes; a task compares one block
    with one other through an index of shingles and sends links only.
    """
    state = large.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    state = scratch.store(state.select("bucket", "node", "class"), "bucket-state")
    main = (
        state.groupBy("bucket", "class").agg(F.count("*").alias("size"))
        .groupBy("bucket").agg(
            F.max(F.struct("size", "class")).alias("main"), F.sum("size").alias("size"))
        .select("bucket", F.col("main.class").alias("main"),
                F.ceil(F.col("size") / BLOCK).alias("blocks"),
                F.ceil((F.col("size") - F.col("main.size")) / BLOCK).alias("rest_blocks"))
        .where("rest_blocks > 0")
    )
    state = state.join(main, "bucket")
    every = lambda blocks: F.explode(F.sequence(
        F.lit(0).cast("long"), F.col(blocks) - 1))
    own = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks))
    all_side = state.select("bucket", own("blocks").alias("block"),
                            every("rest_blocks").alias("rest_block"), "node", "class",
                            F.lit(False).alias("rest"))
    rest_side = state.where("class != main").select(
        "bucket", every("blocks").alias("block"), own("rest_blocks").alias("rest_block"),
        "node", "class", F.lit(True).alias("rest"))
    cells = all_side.unionByName(rest_side).join(texts, "node")

    def compare(table: pa.Table) -> pa.Table:
        rest = table.column("rest").to_numpy()
        nodes, of_class = table.column("node").to_numpy(), table.column("class").to_numpy()
        bags = []
        for text in table.column("text"):
            # Hashes of this process serve, for both sides are here.
            words = [hash(w) for w in text.as_py().encode().split()]
            bags.append(np.unique(shingles(np.array(words, np.int64).view(np.uint64)),
                                  return_counts=True))
        totals = np.array([c.sum() for _, c in bags])
        mine, others = np.flatnonzero(rest), np.flatnonzero(~rest)
        a, b = [], []
        if len(mine) and len(others):
            found = np.concatenate([bags[k][0] for k in others])
            counts = np.concatenate([bags[k][1] for k in others])
            owner = np.repeat(others, [len(bags[k][0]) for k in others])
            order = np.argsort(found, kind="stable")
            found, counts, owner = found[order], counts[order], owner[order]
            for k in mine:
                first = np.searchsorted(found, bags[k][0], "left")
                length = np.searchsorted(found, bags[k][0], "right") - first
                at = np.repeat(first - np.cumsum(length) + length, length) + np.arange(length.sum())
                common = np.bincount(
                    owner[at], np.minimum(counts[at], np.repeat(bags[k][1], length)),
                    minlength=len(bags))
                near = common >= (similarity - 1e-12) * (totals + totals[k] - common)
                near &= ~rest & (of_class != of_class[k])
                a += [nodes[k]] * int(near.sum())
                b += nodes[near].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cells.groupBy("bucket", "block", "rest_block").applyInArrow(compare, "a long, b long")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, tag, n_shingles and class_id, one row per row of ``docs``."""
    docs = docs.select("doc_id", "text")
    with Scratch(docs.sparkSession, "near") as scratch:
        signed = scratch.store(signatures(docs), "signatures")
        classes = components(linked(docs, signed, scratch, similarity), scratch)
        rows = signed.select("doc_id", "tag", "n", "node").join(classes, "node", "left")
        # A node without links is a class of its own; a text without words has no node.
        rows = stored(
            rows.select("doc_id", "tag", "n", F.coalesce("class", "node").alias("class")),
            "classed")
    names = rows.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.min(_order()).alias("first"))
    return rows.join(names, "class", "left").select(
        "doc_id", "tag", F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
        .alias("class_id"),
        F.coalesce(_order() == F.col("first"), F.lit(True)).alias("is_first"),
    )


def _order():
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tag")


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each near-duplicate class, with the columns of ``docs``."""
    has_words = F.coalesce(F.col("n_shingles"), F.lit(0)) > 0
    first = near_classes(docs, similarity).where("is_first").groupBy("doc_id", "tag").agg(
        F.when(F.first(has_words), F.count("*")).otherwise(1).alias("equal_rows"),
    ).select(F.col("doc_id").alias("in_doc"), F.col("tag").alias("in_row"), "equal_rows")
    first = stored(first, "near-first")
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), row_tag().alias("tag"))
    kept = rows.join(first, F.col("doc_id").eqNullSafe(F.col("in_doc"))
                     & (F.col("tag") == F.col("in_row")))
    # Equal rows (same id and text) are copies too: one of them stays.
    once = (
        kept.where("equal_rows > 1").groupBy("doc_id", "tag").agg(F.first("row").alias("row"))
    )
    return kept.where("equal_rows = 1").select("row.*").unionByName(once.select("row.*"))
