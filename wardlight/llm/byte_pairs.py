"""Byte-level BPE: texts to token ids and back, with a two-tier lookup.

A pattern cuts a text into pre-tokens, which are encoded one by one. First tier: a
minimal perfect hash over the vocabulary resolves all pre-tokens of a piece of text
that are vocabulary entries themselves, by whole-array lookups; the entry's bytes are
compared, so a stranger that hashes to its place is a miss. Second tier: a miss is
merged from its bytes, held as a linked list, by a heap of neighbouring pairs: lowest
rank first, then leftmost. Decoding joins the entries' bytes.

The work is row by row: no shuffle, nothing stored. The vocabulary is sent to the
tasks; a rank file above ``MAX_VOCABULARY_BYTES`` is refused. A task holds the
pre-tokens of one piece at a time, so that one long text is worked off in parts.

Defined cases: NULL is the empty text, which has no ids; every other text, of any
length, decodes to its UTF-8 bytes; equal rows and ids are encoded each for itself; the
carried columns are kept in a struct, so their names cannot clash with ``ids`` and
``decoded``; an empty table gives an empty one. NULL ids decode to no bytes, an id
outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.llm.common import quoted

MAX_VOCABULARY_BYTES = 64_000_000
# Characters whose pre-tokens a task holds at once.
PIECE = 2_000_000
# Misses whose ids a task remembers; the memory starts anew when it is full.
MEMORY = 1 << 19

# Letters and digits younger than Unicode 16, the version that the public
# encoder of these vocabularies splits by. They count as neither letter nor digit.
LATE = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D
107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F
12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA
18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24
1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED
1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
FIRST_LATE = 0x558

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Vocabulary:
    """The rank file's content (one ``base64 rank`` a line) and the splitting pattern."""

    ranks: bytes
    pattern: str

    # A worker keeps what it builds as long as the broadcast vocabulary, for all its tasks.
    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self)

    @cached_property
    def decoder(self) -> Decoder:
        return Decoder(self)


def load(path: str, pattern: str) -> Vocabulary:
    """Read a rank file on the driver."""
    with open(path, "rb") as file:
        ranks = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(ranks) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return Vocabulary(ranks, pattern)


def parse_ranks(ranks: bytes) -> dict[bytes, int]:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    if any(bytes([b]) not in table for b in range(256)):
        raise ValueError("the rank file lacks a single byte")
    return table


def _mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    z = (a ^ b) * _MULTIPLY
    z ^= z >> np.uint64(29)
    z *= _SPREAD
    return z ^ (z >> np.uint64(32))


def byte_hashes(strings: pa.LargeBinaryArray, salt: int) -> np.ndarray:
    """A 64-bit hash of each byte string, one position of all strings at a time."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[
        strings.offset:strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = offsets[:-1][order], lengths[order]
    hashes = _mix(lengths.astype(np.uint64), np.uint64(salt))
    for at in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -at, side="left"))
        hashes[:live] = _mix(hashes[:live], data[starts[:live] + at].astype(np.uint64))
    out = np.empty_like(hashes)
    out[order] = hashes
    return out


class PerfectHash:
    """Gives each of n distinct keys its own place in 0..n-1.

    Each level has twice as many bits as keys are left; a key that meets no other one
    sets its bit and is done, the others go on to the next level. A key's place is
    the number of bits set before its own.
    """

    def __init__(self, keys: pa.LargeBinaryArray) -> None:
        self.salt = 0
        while len(np.unique(left := byte_hashes(keys, self.salt))) < len(keys):
            self.salt += 1
        levels = []
        while len(left):
            place = self._at(left, len(levels), 2 * len(left))
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            levels.append(alone)
            left = left[~alone[place]]
        self.sizes = [len(bits) for bits in levels]
        self.bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        self.before = np.cumsum(self.bits) - self.bits

    @staticmethod
    def _at(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mix(hashes, np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)

    def places(self, strings: pa.LargeBinaryArray) -> np.ndarray:
        """The place of each string, -1 where no level knows it; strangers may get one."""
        found = np.full(len(strings), -1, np.int64)
        hashes, left, base = byte_hashes(strings, self.salt), np.arange(len(strings)), 0
        for level, size in enumerate(self.sizes):
            place = base + self._at(hashes[left], level, size)
            hit = self.bits[place]
            found[left[hit]] = self.before[place[hit]]
            left, base = left[~hit], base + size
        return found


def pair_ranks(ranks: dict[bytes, int]) -> list[int]:
    """The rank of each pair of bytes, -1 for none."""
    return [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]


def merge(token: bytes, ranks: dict[bytes, int], pairs: list[int]) -> list[int]:
    """The ids of one pre-token, merged pair by pair from its bytes.

    Parts are known by their first byte and linked both ways. ``pair_at`` has the rank of
    a part and the next one together; a heap entry (rank and part in one number) that
    differs from it is out of date.
    """
    n = len(token)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pair_at = [pairs[a * 256 + b] for a, b in zip(token, token[1:])]
    pair_at.append(-1)
    heap = [rank * n + i for i, rank in enumerate(pair_at) if rank >= 0]
    heapq.heapify(heap)
    known = ranks.get
    while heap:
        rank, i = divmod(heapq.heappop(heap), n)
        if pair_at[i] != rank:
            continue
        joined = after[i]
        end = after[i] = after[joined]
        pair_at[i] = pair_at[joined] = -1
        if end < n:
            before[end] = i
            rank = pair_at[i] = known(token[i:after[end]], -1)
            if rank >= 0:
                heapq.heappush(heap, rank * n + i)
        h = before[i]
        if h >= 0:
            rank = pair_at[h] = known(token[h:end], -1)
            if rank >= 0:
                heapq.heappush(heap, rank * n + h)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[token[i:after[i]]])
        i = after[i]
    return ids


class Encoder:
    """What a task builds from the vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import regex

        self.ranks = parse_ranks(vocabulary.ranks)
        self.pairs = pair_ranks(self.ranks)
        keys = pa.array(list(self.ranks), pa.large_binary())
        self.longest = max(map(len, self.ranks))
        self.perfect = PerfectHash(keys)
        by_place = np.empty(len(keys), np.int64)
        by_place[self.perfect.places(keys)] = np.arange(len(keys))
        self.keys = keys.take(pa.array(by_place))
        self.ids = np.fromiter(self.ranks.values(), np.int32, len(keys))[by_place]
        self.split = regex.compile(vocabulary.pattern)
        late = "".join(
            "-".join(f"\\U{int(x, 16):08X}" for x in part.split("-")) for part in LATE.split())
        self.late = regex.compile(f"[{late}]")
        self.stand_in = "\ue000"  # of private use, so neither letter, digit nor blank
        self.known: dict[bytes, bytes] = {}

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, in lists of bounded length."""
        looked_at = text
        if not text.isascii():
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            if points.max() >= FIRST_LATE:
                looked_at = self.late.sub(self.stand_in, text)
        if len(text) <= PIECE and looked_at is text:
            yield self.split.findall(text)
            return
        found = self.split.finditer(looked_at)
        while part := [text[m.start():m.end()] for m in islice(found, PIECE // 4)]:
            yield part

    def _miss(self, token: bytes) -> bytes:
        """The ids of a pre-token outside the vocabulary, four bytes each."""
        ids = self.known.get(token)
        if ids is None:
            ids = array("i", merge(token, self.ranks, self.pairs)).tobytes()
            if len(token) <= 64:
                if len(self.known) >= MEMORY:
                    self.known.clear()
                self.known[token] = ids
        return ids

    def resolve(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each pre-token, and all ids in order."""
        coded = pa.array(tokens, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.cast(pa.large_binary())
        codes = coded.indices.to_numpy()
        short = np.flatnonzero(pc.binary_length(distinct).to_numpy() <= self.longest)
        asked = distinct.take(pa.array(short))
        place = self.perfect.places(asked)
        sure = pc.equal(self.keys.take(pa.array(np.maximum(place, 0))), asked)
        right = sure.to_numpy(zero_copy_only=False) & (place >= 0)
        counts = np.ones(len(distinct), np.int64)
        single = np.zeros(len(distinct), np.int32)
        single[short[right]] = self.ids[place[right]]
        whole = np.zeros(len(distinct), bool)
        whole[short[right]] = True
        missed = np.flatnonzero(~whole)
        merged = [self._miss(t) for t in distinct.take(pa.array(missed)).to_pylist()]
        counts[missed] = [len(ids) // 4 for ids in merged]
        starts = np.cumsum(counts) - counts
        pool = np.repeat(single, counts)
        if merged:
            places = np.repeat(starts[missed], counts[missed]) + _within(counts[missed])
            pool[places] = np.frombuffer(b"".join(merged), np.int32)
        of_token = counts[codes]
        return of_token, pool[np.repeat(starts[codes], of_token) + _within(of_token)]

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text."""
        sizes = np.zeros(len(texts), np.int64)
        found: list[np.ndarray] = []
        held: list[str] = []
        marks: list[tuple[int, int]] = []  # text and number of its pre-tokens in held

        def settle() -> None:
            counts, ids = self.resolve(held)
            found.append(ids)
            ends = np.cumsum([n for _, n in marks])
            total = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], ends])]
            np.add.at(sizes, [row for row, _ in marks], np.diff(total))
            held.clear()
            marks.clear()

        for row, text in enumerate(texts):
            for part in self.pre_tokens(text or ""):
                held += part
                marks.append((row, len(part)))
                if len(held) >= PIECE // 4:
                    settle()
        if marks:
            settle()
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        ids = np.concatenate(found) if found else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of these lengths."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


class Decoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        ranks = parse_ranks(vocabulary.ranks)
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        ordered = [b""] * size
        for token, rank in ranks.items():
            ordered[rank] = token
            self.lengths[rank] = len(token)
        self.data = np.frombuffer(b"".join(ordered), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)
                         or not self.lengths[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        counts = self.lengths[ids]
        return self.data[np.repeat(self.starts[ids], counts) + _within(counts)].tobytes()


def _rows_of(batch: pa.RecordBatch, lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about PIECE characters or ids, whole rows each."""
    part = np.cumsum(lengths) // PIECE
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encode(
    docs: DataFrame, vocabulary: Vocabulary, carry: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """Per input row: the carried columns as ``row``, and ``ids``."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.struct(*map(quoted, carry)).alias("row"),
                       quoted(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = sent.value.encoder
        for whole in batches:
            lengths = pc.fill_null(pc.binary_length(whole.column("text")), 0).to_numpy()
            for batch in _rows_of(whole, lengths):
                ids = encoder.encode(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("row"), ids], ["row", "ids"])

    return rows.mapInArrow(work, T.StructType([
        rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add ``decoded``, the bytes that the row's ``ids`` stand for."""
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = sent.value.decoder
        for whole in batches:
            lengths = pc.fill_null(pc.list_value_length(whole.column("ids")), 0).to_numpy()
            for batch in _rows_of(whole, lengths):
                texts = [
                    decoder.decode(ids.values.to_numpy()) if ids.is_valid else b""
                    for ids in batch.column("ids")
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.binary())],
                    [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(work, T.StructType([
        *encoded.schema, T.StructField("decoded", T.BinaryType())]))
