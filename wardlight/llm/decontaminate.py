"""Benchmark decontamination with an Aho-Corasick automaton over words.

Texts are normalised to words (A-Z lowered; runs of letters, digits and characters
above ASCII). A window is ``size`` consecutive words of an item; a shorter item is
one window. All windows go into one automaton whose symbols are word numbers, and
each document runs through it once. The hits are kept as word ranges and as
character ranges of the original text.

The automaton is sent to the tasks, so its items are bounded: a benchmark above
``MAX_BLOCK_BYTES`` is dealt into blocks by hash, and the documents run through the
automaton of each block in turn, adding to what was found.

Defined cases: NULL has no words; an item without words is in no document; items of
one id count once; a NULL item id is listed as an empty string; rows are scanned
one by one, so repeated rows and ids stay.
A text of any length is scanned whole in its row; the carried columns are kept in a struct,
so their names cannot clash; an empty table of documents gives an empty one, an empty
benchmark finds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.llm.common import quoted

WINDOW = 10
MAX_BLOCK_BYTES = 32_000_000

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# A-Z are lowered and bytes outside words become blanks.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if WORD.match(bytes([b])) else 32 for b in range(256)
)
RANGE = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("words", T.ArrayType(RANGE)),
    T.StructField("items", T.ArrayType(T.StringType())),
])


def text_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def item_windows(items: list[tuple[str, bytes]], size: int) -> dict[tuple[bytes, ...], list[str]]:
    """Each window with the ids of the items that hold it."""
    windows: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        words = text_words(text)
        for start in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[start:start + size]), set()).add(item)
    return {window: sorted(ids) for window, ids in windows.items()}


def build_automaton(windows: dict[tuple[bytes, ...], list[str]]):
    """The automaton and the numbers of its words; 0 stands for all others."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for window, ids in windows.items():
        key = tuple(numbers.setdefault(w, len(numbers) + 1) for w in window)
        automaton.add_word(key, (len(window), ids))
    if windows:
        automaton.make_automaton()
    return automaton, numbers


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def scan_text(text: bytes, automaton, numbers) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, merged word ranges inside windows, ids of the items found."""
    words = text_words(text)
    keys = tuple([numbers.get(w, 0) for w in words])
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    if numbers and any(keys):
        for last, (length, ids) in automaton.iter(keys):
            ranges.append((last + 1 - length, last + 1))
            items.update(ids)
    return len(words), merge_ranges(ranges), items


def character_ranges(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as character ranges of the original text."""
    if not ranges:
        return []
    places = [m.span() for m in WORD.finditer(text.translate(NORMAL))]
    found, at, chars = [], 0, 0
    for start, end in ranges:
        first, last = places[start][0], places[end - 1][1]
        chars += len(text[at:first].decode())
        length = len(text[first:last].decode())
        found.append((chars, chars + length))
        chars, at = chars + length, last
    return found


def _scan_block(docs: DataFrame, items: list[tuple[str, bytes]], size: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    schema = T.StructType([docs.schema["row"], docs.schema["text"], T.StructField("found", FOUND)])
    added = "found" in docs.columns

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, numbers = build_automaton(item_windows(sent.value, size))
        for batch in batches:
            texts = batch.column("text")
            earlier = batch.column("found").to_pylist() if added else [None] * batch.num_rows
            found = []
            for text, known in zip(texts.cast(pa.binary()), earlier):
                n_words, ranges, ids = scan_text(text.as_py() or b"", automaton, numbers)
                if known:
                    ranges = merge_ranges(ranges + [(r["start"], r["end"]) for r in known["words"]])
                    ids = ids | set(known["items"])
                found.append({
                    "n_words": n_words, "items": sorted(ids),
                    "words": [{"start": a, "end": b} for a, b in ranges],
                })
            kind = pa.struct([
                ("n_words", pa.int64()),
                ("words", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ("items", pa.list_(pa.string())),
            ])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), texts, pa.array(found, kind)], ["row", "text", "found"]
            )

    return docs.mapInArrow(scan, schema)


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
    carry: tuple[str, ...] = ("doc_id",), max_block_bytes: int = MAX_BLOCK_BYTES,
) -> DataFrame:
    """Per input row: the carried columns as ``row``, the text and ``found``.

    ``found`` has n_words, the merged word ranges inside windows and the items.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-total // max_block_bytes))
    scanned = docs.select(F.struct(*map(quoted, carry)).alias("row"), "text")
    for block in range(blocks):
        # One block, of about max_block_bytes, is on the driver at a time.
        held = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        scanned = _scan_block(scanned, [(r["item"], bytes(r["text"])) for r in held], size)
    return scanned


def with_spans(scanned: DataFrame) -> DataFrame:
    """Add ``spans``, the hits as character ranges of the original text."""
    schema = T.StructType([*scanned.schema, T.StructField("spans", T.ArrayType(RANGE))])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            spans = [
                [{"start": a, "end": b} for a, b in character_ranges(
                    text or b"", [(r["start"], r["end"]) for r in found["words"]])]
                for text, found in zip(texts, batch.column("found").to_pylist())
            ]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, kind)], [*batch.schema.names, "spans"]
            )

    return scanned.mapInArrow(locate, schema)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts per row: n_words, n_hit, n_items, items_sha256 and contaminated."""
    n_hit = F.aggregate(
        "found.words", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"]
    )
    items = F.sort_array("found.items")
    return scanned.select(
        "row.*", F.col("found.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, with their columns."""
    scanned = find_overlaps(docs, benchmark, size, carry=tuple(docs.columns))
    return scanned.where(F.size("found.items") == 0).select("row.*")
