"""Removing bytes of long repeated strings, by prefix-free parsing.

A rolling hash of ``GRAM`` bytes picks the triggers: each string of ``SIZE`` bytes is
led by the position of the least hash among its first ``REACH``. This depends on the
string alone, so equal strings have their trigger at the same place. The starts that
share a trigger form a phrase; its text runs to the end of its last string, so it
holds as much of the following phrases as its strings reach, and all that a
depth of ``SIZE`` asks of the parse's order. The corpus order of the suffixes comes in two
steps:

- Dictionary: equal phrase texts are one entry, known by its first occurrence in the
  corpus (smallest doc_id, then start). All strings of any later occurrence are
  repeats; this settles highly repetitive text without looking at its suffixes.
- Suffix array: entries that agree in the ``CORE`` bytes from their trigger on, but not as
  a whole, may share some of their strings. Each sends its text once, to the bucket
  of its core. There the suffixes that begin at one distance before the triggers are
  sorted to the depth of ``SIZE``, ties by the entries' order in the parse; of equal
  neighbours all but the first in the corpus are repeats.

A core with more than ``HOT`` entries would be too much for one bucket: the strings of its
entries are dealt out by 128-bit hash instead, one by one, behind a sketch.
Cores that occur once cannot hold a repeat. A count-min sketch of the cores leaves
them out before anything is shuffled; equal phrases of one batch are settled there.
Phrases are compared by 128 bits of hash, suffixes byte by byte.

Defined cases: NULL text is empty; texts below ``SIZE`` bytes keep everything; rows
with a NULL doc_id have no place in the order, so nothing is removed from them or
because of them; rows with equal doc_id count as one document's starts, and equal
starts are not earlier than each other.
Ids are whole numbers or text that spells them. A text of any length is one row's work;
only doc_id and text are read, so other columns cannot clash; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm import sketch
from wardlight.llm.common import row_tag, stored
from wardlight.llm.substring_dedup import mix, packed_range, unpacked
from wardlight.session import Scratch

SIZE = 100
GRAM = 8
REACH = 48
CORE = SIZE - REACH + 1
# Bytes a task works on at once.
PIECE = 1_000_000
# Entries of one core that a bucket takes, and entries of a bucket on the average.
HOT = 20_000
BUCKET = 30_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_OF_BYTE = mix(np.arange(256, dtype=np.uint64), np.full(256, 7, np.uint64))


@dataclass
class Piece:
    """Some rows' bytes in one array, their phrases and a hash of any substring."""

    sums: np.ndarray
    unbase: np.ndarray
    row: np.ndarray
    trigger: np.ndarray
    low: np.ndarray
    high: np.ndarray
    begin: np.ndarray

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.unbase[start]

    def core(self) -> np.ndarray:
        middle = self.trigger + CORE // 2
        return mix(self.hash(self.trigger, middle), self.hash(middle, self.trigger + CORE))

    def phrase(self) -> np.ndarray:
        shape = (self.trigger - self.low) * SIZE + self.high - self.low
        whole = mix(self.hash(self.low, self.trigger), self.hash(self.trigger, self.high + SIZE))
        return mix(whole, shape.astype(np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n + 1, base)
    steps[0] = 1
    return np.cumprod(steps)


def parse(data: np.ndarray, ends: np.ndarray, first_row: int = 0) -> Piece | None:
    """The phrases of the rows whose bytes lie in ``data`` up to ``ends``."""
    n = len(data)
    if n < SIZE:
        return None
    unbase = _powers(_UNBASE, n)
    sums = np.concatenate([np.zeros(1, np.uint64),
                           np.cumsum(_OF_BYTE[data] * _powers(_BASE, n)[:n])])
    rolling = (sums[GRAM:] - sums[:-GRAM]) * unbase[:n - GRAM + 1]
    rolling = (rolling ^ (rolling >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    low_bits = np.uint64(0xFFFFFFFF)
    placed = (rolling & ~low_bits) | np.arange(len(rolling), dtype=np.uint64)
    width, least = 1, placed
    while width * 2 <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < REACH:
        least = np.minimum(least[:len(least) - (REACH - width)], least[REACH - width:])
    begins = np.concatenate([[0], ends[:-1]])
    starts = np.maximum(0, ends - begins - SIZE + 1)
    rows = np.repeat(np.arange(len(ends)), starts)
    if not len(rows):
        return None
    at = begins[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(starts) - starts, starts)
    trigger = (least[at] & low_bits).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return Piece(sums, unbase, rows[first] + first_row, trigger[first], at[first], at[last],
                 begins[rows[first]])


def _pieces(texts: pa.BinaryArray) -> Iterator[Piece]:
    """Parse a column of bytes, some rows at a time."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1 + texts.offset)
    offsets = offsets[texts.offset:].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        found = parse(data[offsets[row]:offsets[end]], offsets[row + 1:end + 1] - offsets[row], row)
        if found is not None:
            yield found
        row = end


def _cores(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for piece in _pieces(batch.column("text")):
        yield piece.core()


def settle(h1, h2, rows, start, end, ids, tags) -> pa.RecordBatch:
    """Strings by hash; those a batch knows to be repeats leave as merged ranges.

    Of equal hashes all but the earliest (id, start) are certain repeats.
    """
    order = np.lexsort((start, ids[rows], h2, h1))
    h1, h2, rows, start, end = (x[order] for x in (h1, h2, rows, start, end))
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)
    docs = ids[rows]
    certain = (docs > docs[lead]) | ((docs == docs[lead]) & (start > start[lead]))
    sure = np.flatnonzero(certain)
    sure = sure[np.lexsort((start[sure], rows[sure]))]
    r, s, e = rows[sure], start[sure], end[sure]
    if len(r):
        # Ends never fall along a row, so ranges that touch can be merged.
        fresh = np.ones(len(r), bool)
        fresh[1:] = (r[1:] != r[:-1]) | (s[1:] > e[:-1])
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(r)) - 1
        r, s, e = r[head], s[head], e[tail]
    # In the rows' order, a row's id and tag repeat and shrink in the shuffle.
    left = np.flatnonzero(~certain)
    left = left[np.lexsort((start[left], rows[left]))]
    own = mix(r.astype(np.uint64), s.astype(np.uint64))
    in_row = np.concatenate([rows[left], r])
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([h1[left], own]).view(np.int64)),
        pa.array(np.concatenate([h2[left], mix(own, own)]).view(np.int64)),
        pa.array(ids[in_row]), pa.array(tags[in_row]),
        pa.array(np.concatenate([start[left], s]).astype(np.int32)),
        pa.array(np.concatenate([end[left] - start[left], e - s]).astype(np.int32)),
        pa.array(np.concatenate([np.zeros(len(left), bool), np.ones(len(r), bool)])),
    ], ["h1", "h2", "doc_id", "tag", "start", "length", "certain"])


CANDIDATES = "h1 long, h2 long, doc_id long, tag long, start int, length int, certain boolean"


def _repeated_phrases(batch: pa.RecordBatch, bits: np.ndarray):
    """Phrases whose core may repeat: core, phrase hash, row, start, end; NULL ids left out."""
    known = ~np.asarray(batch.column("doc_id").is_null())
    held = []
    for piece in _pieces(batch.column("text")):
        core = piece.core()
        pick = np.flatnonzero(sketch.maybe_repeated(bits, core) & known[piece.row])
        held.append((core[pick], piece.phrase()[pick], piece.row[pick],
                     (piece.low - piece.begin)[pick], (piece.high - piece.begin)[pick] + SIZE))
    return [np.concatenate(x) for x in zip(*held)] if held else None


def phrases(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Dictionary candidates: phrases by (core, phrase) hash."""
    sent = sketch.send(docs, bits)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.received(sent)
        for batch in batches:
            found = _repeated_phrases(batch, bits)
            if found:
                yield settle(*found, batch.column("doc_id").fill_null(0).to_numpy(),
                             batch.column("tag").to_numpy())

    return docs.mapInArrow(probe, CANDIDATES)


def _entries(
    batch: pa.RecordBatch, wanted: Callable[[np.ndarray], np.ndarray]
) -> Iterator[tuple[Piece, np.ndarray]]:
    """The batch's dictionary entries with a wanted core: pieces and phrase numbers.

    Later occurrences of an entry within the batch are settled: one stands for all.
    """
    known = ~np.asarray(batch.column("doc_id").is_null())
    ids = batch.column("doc_id").fill_null(0).to_numpy()
    held = []
    for k, piece in enumerate(_pieces(batch.column("text"))):
        core = piece.core()
        pick = np.flatnonzero(wanted(core) & known[piece.row])
        held.append((core[pick], piece.phrase()[pick], ids[piece.row[pick]],
                     (piece.low - piece.begin)[pick], np.full(len(pick), k), pick))
    if not held:
        return
    core, phrase, docs, low, of_piece, pick = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((low, docs, phrase, core))
    new = np.ones(len(order), bool)
    new[1:] = (core[order][1:] != core[order][:-1]) | (phrase[order][1:] != phrase[order][:-1])
    chosen = order[new]
    for k, piece in enumerate(_pieces(batch.column("text"))):
        mine = np.sort(pick[chosen[of_piece[chosen] == k]])
        if len(mine):
            yield piece, mine


def _string_hashes(batch: pa.RecordBatch, wanted: Callable[[np.ndarray], np.ndarray]):
    """The strings of the entries, per piece: two hashes, row and start."""
    for piece, mine in _entries(batch, wanted):
        count = piece.high[mine] - piece.low[mine] + 1
        each = np.repeat(mine, count)
        at = piece.low[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        a, b = piece.hash(at, at + SIZE // 2), piece.hash(at + SIZE // 2, at + SIZE)
        yield mix(a, b), mix(b, a), piece.row[each], at - piece.begin[each]


def strings(docs: DataFrame, shared: np.ndarray, cells: int) -> DataFrame:
    """Strings of the entries of hot cores, which may repeat."""
    sent_shared = sketch.send(docs, shared)
    held: list[np.ndarray] = []  # of one worker: the bits, unpacked once

    def bits_of_worker() -> np.ndarray:
        if not held:
            held.append(sketch.received(sent_shared))
        return held[0]

    def extract(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        wanted = lambda core: sketch.maybe_repeated(bits_of_worker(), core)
        for h1, _, _, _ in _string_hashes(batch, wanted):
            yield h1

    again = sketch.repeated_cells(docs, extract, cells)
    sent = sketch.send(docs, again)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, shared = sketch.received(sent), sketch.received(sent_shared)
        wanted = lambda core: sketch.maybe_repeated(shared, core)
        for batch in batches:
            found = []
            for h1, h2, rows, start in _string_hashes(batch, wanted):
                pick = sketch.maybe_repeated(bits, h1)
                found.append((h1[pick], h2[pick], rows[pick], start[pick], start[pick] + SIZE))
            if found:
                yield settle(*[np.concatenate(x) for x in zip(*found)],
                             batch.column("doc_id").fill_null(0).to_numpy(),
                             batch.column("tag").to_numpy())

    return docs.mapInArrow(probe, CANDIDATES)


ENTRIES = "bucket long, doc_id long, tag long, start int, before int, strings int, text binary"
RANGES = "doc_id long, tag long, start int, length int"


def dictionary(docs: DataFrame, shared: np.ndarray, hot: np.ndarray, buckets: int) -> DataFrame:
    """The entries whose core several entries share, with their text, by bucket of cores.

    ``before`` is the number of bytes in front of the trigger, ``strings`` that of starts.
    """
    sent = sketch.send(docs, shared), sketch.send(docs, hot)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, hot = (sketch.received(bits) for bits in sent)
        wanted = lambda core: (
            sketch.maybe_repeated(shared, core) & ~sketch.maybe_repeated(hot, core))
        for batch in batches:
            ids, tags = batch.column("doc_id").fill_null(0).to_numpy(), batch.column("tag").to_numpy()
            texts = batch.column("text")
            offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1 + texts.offset)
            offsets = offsets[texts.offset:].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for piece, mine in _entries(batch, wanted):
                row, low = piece.row[mine], (piece.low - piece.begin)[mine]
                length = piece.high[mine] + SIZE - piece.low[mine]
                ends = np.cumsum(length)
                at = np.repeat(offsets[row] + low - ends + length, length) + np.arange(ends[-1])
                body = pa.BinaryArray.from_buffers(pa.binary(), len(mine), [
                    None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)),
                    pa.py_buffer(data[at])])
                bucket = (piece.core()[mine] % np.uint64(buckets)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket), pa.array(ids[row]), pa.array(tags[row]),
                    pa.array(low.astype(np.int32)),
                    pa.array((piece.trigger - piece.low)[mine].astype(np.int32)),
                    pa.array((length - SIZE + 1).astype(np.int32)), body,
                ], ["bucket", "doc_id", "tag", "start", "before", "strings", "text"])

    return docs.mapInArrow(emit, ENTRIES)


def sorted_suffixes(table: pa.Table) -> pa.Table:
    """The repeated strings among a bucket's entries, as merged ranges.

    The entries are put in the order of the parse and aligned at their triggers. For each
    distance before the trigger the suffixes there are sorted, stably, to the depth of
    ``SIZE``; the first of equal neighbours is the earliest in the corpus.
    """
    table = table.combine_chunks()
    ids, start = table.column("doc_id").to_numpy(), table.column("start").to_numpy().astype(np.int64)
    before = table.column("before").to_numpy().astype(np.int64)
    count = table.column("strings").to_numpy().astype(np.int64)
    parse_order = np.lexsort((start + before, ids))
    front = REACH - 1
    aligned = np.zeros((len(ids), front + SIZE), np.uint8)
    for place, k in enumerate(parse_order.tolist()):
        body = table.column("text")[k].as_buffer()
        first = front - int(before[k])
        aligned[place, first:first + len(body)] = np.frombuffer(body, np.uint8)
    ids, start, before, count = (x[parse_order] for x in (ids, start, before, count))
    rows, places = [], []
    for ahead in range(REACH):
        has = np.flatnonzero((ahead <= before) & (ahead > before - count))
        if len(has) < 2:
            continue
        suffixes = np.ascontiguousarray(aligned[has, front - ahead:front - ahead + SIZE])
        suffixes = suffixes.view(f"V{SIZE}").ravel()
        order = np.argsort(suffixes, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = suffixes[order][1:] != suffixes[order][:-1]
        row = has[order]
        lead = row[np.flatnonzero(new)[np.cumsum(new) - 1]]
        at = start[row] + before[row] - ahead
        lead_at = start[lead] + before[lead] - ahead
        again = (ids[row] > ids[lead]) | ((ids[row] == ids[lead]) & (at > lead_at))
        rows.append(row[again])
        places.append(at[again])
    row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    at = np.concatenate(places) if places else np.zeros(0, np.int64)
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (at[1:] > at[:-1] + SIZE)
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(row)) - 1 if len(row) else head
    tags = table.column("tag").to_numpy()[parse_order]
    return pa.table({
        "doc_id": pa.array(ids[row[head]]), "tag": pa.array(tags[row[head]]),
        "start": pa.array(at[head].astype(np.int32)),
        "length": pa.array((at[tail] + SIZE - at[head]).astype(np.int32)),
    })


def repeated_ranges(docs: DataFrame, cells: int | None = None) -> DataFrame:
    """doc_id, tag and the packed byte ranges to remove; rows with such only.

    The result is a stored table; those made on the way are removed.
    """
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_tag().alias("tag"),
                         F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    if cells is None:
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        cells = sketch.cells_for(total // (REACH // 2))
    bits = sketch.repeated_cells(hashed, _cores, cells)

    def both(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        found = batch.column("h1").to_numpy().view(np.uint64)
        yield np.concatenate([found, found])

    with Scratch(docs.sparkSession, "suffixes") as scratch:
        entries = scratch.store(phrases(hashed, bits), "phrases")
        # Cores with more than one entry, as bit tables like the sketch's.
        shared = scratch.store(
            entries.where("NOT certain").groupBy("h1")
            .agg(F.min("h2").alias("least"), F.max("h2").alias("most"), F.count("*").alias("n"))
            .where("least != most").select("h1", "n"),
            "shared-cores",
        )
        hot = shared.where(F.col("n") > HOT).select("h1")
        n_hot, n_entries = shared.agg(
            F.count_if(F.col("n") > HOT), F.coalesce(F.sum("n"), F.lit(0))).first()
        shared_bits = sketch.repeated_cells(shared.select("h1"), both, cells)
        hot_bits = sketch.repeated_cells(hot, both, cells)
        buckets = max(1, -(-n_entries // BUCKET))
        suffixes = (
            dictionary(hashed, shared_bits, hot_bits, buckets)
            .groupBy("bucket").applyInArrow(sorted_suffixes, RANGES)
        )
        grouped = entries.where("NOT certain")
        if n_hot:
            of_hot = strings(hashed, hot_bits, cells)
            grouped = grouped.unionByName(of_hot.where("NOT certain"))
            suffixes = suffixes.unionByName(of_hot.where("certain").select(*suffixes.columns))
        least = F.min(F.struct("doc_id", "start")).over(W.partitionBy("h1", "h2"))
        repeats = (
            grouped.withColumn("least", least)
            .where(F.struct("doc_id", "start") > F.col("least")).select(*suffixes.columns)
            .unionByName(entries.where("certain").select(*suffixes.columns))
            .unionByName(suffixes)
        )
        return stored(
            repeats.groupBy("doc_id", "tag").agg(F.collect_list(packed_range()).alias("ranges")),
            "repeated-ranges")


def cut_ranges(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs removed, and what is left."""
    if not len(start):
        return 0, 0, text
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, end, -1)
    gone = np.cumsum(cover[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()


def remove_repeats(
    docs: DataFrame, cells: int | None = None, with_kept: bool = False
) -> DataFrame:
    """Per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, ``kept``."""
    found = repeated_ranges(docs, cells).select(
        F.col("doc_id").alias("in_doc"), F.col("tag").alias("in_row"), "ranges"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_tag().alias("tag"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    joined = rows.join(
        found, (F.col("doc_id") == F.col("in_doc")) & (F.col("tag") == F.col("in_row")), "left"
    ).select("doc_id", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column("text"), batch.column("ranges")):
                body = text.as_py()
                removed, spans, kept = cut_ranges(body, *unpacked(ranges))
                out.append((len(body), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            n, removed, spans, digest, kept = zip(*out) if out else ((),) * 5
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()),
                       pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                       pa.array(digest, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                columns.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(cut, schema + (", kept binary" if with_kept else ""))
