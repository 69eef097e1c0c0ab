"""Removing word windows that an earlier document has, behind a count-min prefilter.

First pass: the hashes of all windows of ``SIZE`` consecutive words of a document go
into a count-min sketch per partition, and the sketches are merged. Second pass:
only windows that the sketch counts twice or more travel; they are grouped exactly
by 96 bits of hash, and each group learns its smallest doc_id. A window whose group
has a smaller doc_id than its own is repeated, and its words go. Windows are judged
on the input, so what is removed elsewhere does not matter.

Before the shuffle a task settles what it can: of equal windows in one batch, those
behind the batch's smallest doc_id are repeated for certain and leave as word
ranges; only the others travel by hash. A passage that a third of all documents
share thus sends a row or two per batch and window.

Defined cases: NULL, empty and short texts have no window; rows with a NULL doc_id
have no place in the order, so nothing is removed from them or because of them;
rows with equal doc_id do not count as earlier than each other.
Ids are whole numbers or text that spells them. A text of any length is one row's work;
only doc_id and text are read, so other columns cannot clash; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm import sketch
from wardlight.llm.common import row_tag, word_hashes

SIZE = 13
# Words a task works on at once.
PIECE = 150_000

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Combine two hash arrays into one, in order."""
    z = a * _MULTIPLY + b
    z ^= z >> np.uint64(29)
    z *= _SPREAD
    z ^= z >> np.uint64(32)
    return z


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every ``size`` consecutive hashes, by doubling."""
    total, at, width, powers = None, 0, 1, hashes
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    while width <= size:
        if size & width:
            piece = powers[at:at + n]
            total = piece.copy() if total is None else mix(total, piece)
            at += width
        powers = mix(powers[:-width], powers[width:]) if len(powers) > width else powers[:0]
        width *= 2
    return mix(total, np.full(n, size, np.uint64))


def pieces(lists: pa.ListArray, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Cut a column of word hashes into runs of rows: first row, end row, values,
    and for each window start its row and its place in the row."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    row = 0
    while row < len(lists):
        end = int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1
        end = min(max(end, row + 1), len(lists))
        lengths = np.diff(offsets[row:end + 1])
        starts = np.maximum(0, lengths - size + 1)
        rows = np.repeat(np.arange(row, end), starts)
        places = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
        yield row, end, values[offsets[row]:offsets[end]], rows, places
        row = end


def _of_piece(offsets: np.ndarray, row: int, values, rows, places, size: int, salt: int):
    found = window_hashes(values ^ np.uint64(salt), size)
    return found[offsets[rows] - offsets[row] + places] if len(rows) else np.zeros(0, np.uint64)


def _extract(size: int):
    def extract(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        lists = batch.column("hashes")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        for row, _, values, rows, places in pieces(lists, size):
            found = _of_piece(offsets, row, values, rows, places, size, 0)
            # A window that one document repeats is no matter here: count it once.
            order = np.lexsort((rows, found))
            found, rows = found[order], rows[order]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
            yield found[new]

    return extract


def _runs(rows: np.ndarray, places: np.ndarray, size: int):
    """Window starts (sorted by row and place) as word ranges: row, start, end."""
    if not len(rows):
        return rows, places, places
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (places[1:] > places[:-1] + size)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    return rows[first], places[first], places[last] + size


def in_order(held: list[list[np.ndarray]], ids: np.ndarray) -> list[np.ndarray]:
    """The pieces' h1, h2, rows and places as one column each, by hash and then id.

    Empties ``held`` column by column: a batch is not in memory three times over.
    """
    def column(i: int) -> np.ndarray:
        found = np.concatenate([piece[i] for piece in held])
        for piece in held:
            piece[i] = None
        return found

    columns = [column(i) for i in range(4)]
    order = np.lexsort((ids[columns[2]], columns[1], columns[0]))
    for i in range(4):
        columns[i] = columns[i][order]
    return columns


CANDIDATES = "h1 long, h2 long, doc_id long, tag long, start int, length int, certain boolean"


def candidates(hashed: DataFrame, bits: np.ndarray, size: int) -> DataFrame:
    """Windows the sketch lets pass, and word ranges settled inside a batch."""
    sent = sketch.send(hashed, bits)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.received(sent)
        for batch in batches:
            lists = batch.column("hashes")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            known = ~np.asarray(batch.column("doc_id").is_null())
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            tags = batch.column("tag").to_numpy()
            held = []
            for row, _, values, rows, places in pieces(lists, size):
                h1 = _of_piece(offsets, row, values, rows, places, size, 0)
                passed = sketch.maybe_repeated(bits, h1) & known[rows]
                h2 = _of_piece(offsets, row, values, rows, places, size, 0x5851F42D4C957F2D)
                held.append([h1[passed], (h2[passed] >> np.uint64(32)).astype(np.uint32),
                             rows[passed].astype(np.int32), places[passed].astype(np.int32)])
            if not held:
                continue
            h1, h2, rows, places = in_order(held, ids)
            docs = ids[rows]
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            group = np.cumsum(new, dtype=np.int32) - 1
            certain = docs > docs[new][group] if len(docs) else new
            del docs, new, group
            sure = np.lexsort((places[certain], rows[certain]))
            in_row, start, end = _runs(rows[certain][sure], places[certain][sure], size)
            # In the rows' order, a row's id and tag repeat and shrink in the shuffle.
            left = np.flatnonzero(~certain)
            left = left[np.lexsort((places[left], rows[left]))]
            all_rows = np.concatenate([rows[left], in_row])
            # Settled ranges travel under keys of their own, spread like hashes.
            own = mix(in_row.astype(np.uint64), start.astype(np.uint64) + np.uint64(batch.num_rows))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([h1[left], own]).view(np.int64)),
                pa.array(np.concatenate([h2[left], np.full(len(own), -1)])),
                pa.array(ids[all_rows]), pa.array(tags[all_rows]),
                pa.array(np.concatenate([places[left], start]).astype(np.int32)),
                pa.array(np.concatenate([np.full(len(left), size), end - start]).astype(np.int32)),
                pa.array(np.concatenate([np.zeros(len(left), bool), np.ones(len(own), bool)])),
            ], ["h1", "h2", "doc_id", "tag", "start", "length", "certain"])

    return hashed.mapInArrow(probe, CANDIDATES)


def packed_range() -> Column:
    """Start and end of a range in one whole number, which shuffles smaller."""
    start = F.col("start").cast("long")
    return F.shiftleft(start, 32) + start + F.col("length")


def unpacked(ranges: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """The starts and ends of packed ranges; none for NULL."""
    found = ranges.values.to_numpy() if ranges.is_valid else np.zeros(0, np.int64)
    return found >> 32, found & 0xFFFFFFFF


def repeated_ranges(docs: DataFrame, size: int = SIZE, cells: int | None = None) -> DataFrame:
    """doc_id, tag and the packed word ranges to remove; rows with such only."""
    if cells is None:
        # A word takes six bytes or so, its blank included.
        total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        cells = sketch.cells_for(total // 6)
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_tag().alias("tag"),
        word_hashes(F.col("text")).alias("hashes"),
    )
    bits = sketch.repeated_cells(hashed.select("hashes"), _extract(size), cells)
    least = F.min("doc_id").over(W.partitionBy("h1", "h2"))
    found = candidates(hashed, bits, size).withColumn("least", least)
    return (
        found.where("certain OR doc_id > least").groupBy("doc_id", "tag")
        .agg(F.collect_list(packed_range()).alias("ranges"))
    )


def kept_words(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the kept words joined by blanks."""
    found = text.split()
    if not len(start):
        return len(found), 0, b" ".join(found)
    cover = np.zeros(len(found) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, end, -1)
    gone = np.cumsum(cover[:-1]) > 0
    kept = [w for w, g in zip(found, gone.tolist()) if not g]
    return len(found), len(found) - len(kept), b" ".join(kept)


def remove_repeats(
    docs: DataFrame, size: int = SIZE, cells: int | None = None, with_text: bool = False
) -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept_sha256 and, if asked, kept_text."""
    found = repeated_ranges(docs, size, cells).select(
        F.col("doc_id").alias("in_doc"), F.col("tag").alias("in_row"), "ranges"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       row_tag().alias("tag"), "text")
    joined = rows.join(
        found, (F.col("doc_id") == F.col("in_doc")) & (F.col("tag") == F.col("in_row")), "left"
    ).select("doc_id", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            out = []
            for text, ranges in zip(texts, batch.column("ranges")):
                n, removed, kept = kept_words(text.as_py() or b"", *unpacked(ranges))
                out.append((n, removed, hashlib.sha256(kept).hexdigest(),
                            kept.decode() if with_text else None))
            n, removed, digest, kept = zip(*out) if out else ((), (), (), ())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()),
                       pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array(kept, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return joined.mapInArrow(cut, schema + (", kept_text string" if with_text else ""))
