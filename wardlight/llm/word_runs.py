"""Runs: stretches of words that repeat with a period, caught online in squares.

``RunCatcher`` is fed a growing word sequence. Level p keeps a catcher for every
completed block of B = 2^p words that starts at a multiple of half a block. Each
appended word completes one suffix of B words, which is compared (by 64-bit hash) with
the blocks of the open catchers, those that start at most B words earlier. The first
suffix that equals a catcher's block, d words on, is its nearest next occurrence: with
B/2 < d <= B a square of period d is caught, compared word by word and extended both
ways into the maximal repetition; one that reaches the last word stays open and grows
with what is appended. A run of period q that holds at least four periods contains a
whole block of level p, B/2 < q <= B, with its next occurrence. As the block is as long as
a period, that occurrence is q words on, so every run is caught, with its smallest
period. All words of one ``append`` are compared in one array operation a level: time
O(n log n), memory O(n), also for a text of one repeated word.

Defined cases: NULL, empty and blank texts have no words and no runs, and collapse to
the empty text; texts of any length are one row's work in O(n) memory; rows are worked
on one by one, so equal rows and ids stay; the carried columns are kept in a struct, so
their names cannot clash; an empty table gives an empty one. Words are compared byte by
byte; only the choice of candidates rests on the hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.llm.common import quoted
from wardlight.llm.substring_dedup import mix

MIN_LENGTH = 6
MIN_POWERS = 4

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


class _Level:
    """Hashes of the blocks of one length, for the last starts only."""

    def __init__(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.base = 0  # start that the first kept hash belongs to
        self.spent: set[int] = set()  # catchers that have met their block again

    @property
    def filled(self) -> int:
        return self.base + len(self.hashes)

    def add(self, hashes: np.ndarray) -> None:
        self.hashes = np.concatenate([self.hashes, hashes]) if len(self.hashes) else hashes

    def keep(self, last: int) -> None:
        if len(self.hashes) > 2 * last:
            self.base += len(self.hashes) - last
            self.hashes = self.hashes[-last:].copy()


class RunCatcher:
    """The runs of a word sequence (as integers) that grows at its end."""

    def __init__(self, min_length: int = MIN_LENGTH, min_powers: int = MIN_POWERS) -> None:
        if min_powers < 4:
            raise ValueError("blocks catch every run only from four periods on")
        self.min_length, self.min_powers = min_length, min_powers
        self.words = np.zeros(0, np.int64)
        self.n = 0
        self.levels: list[_Level] = []
        # By period, start and end of the last repetition; open ones end at n.
        self.last: dict[int, list[int]] = {}
        self.open: set[int] = set()
        self.closed: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> list[tuple[int, int]]:
        """Take in the next words; the squares newly caught, as start and period."""
        if self.n + len(words) > len(self.words):
            room = max(2 * len(self.words), self.n + len(words))
            self.words = np.concatenate([self.words[:self.n], np.zeros(room - self.n, np.int64)])
        self.words[self.n:self.n + len(words)] = words
        self.n += len(words)
        for period in list(self.open):
            self._grow(period)
        caught = []
        level = 0
        # A run of the level's periods has more than two blocks.
        while self.n >= 2 << level:
            if level == len(self.levels):
                self.levels.append(_Level())
            for start, period in self._candidates(level):
                if self._catch(start, period, 1 << level):
                    caught.append((self.last[period][0], period))
            level += 1
        for p, kept in enumerate(self.levels):
            kept.keep(4 << p)
        return caught

    def _candidates(self, p: int) -> list[tuple[int, int]]:
        """Catchers of a level that the new suffixes meet for the first time."""
        level, size, grid = self.levels[p], 1 << p, max(1, 1 << p >> 1)
        first = level.filled
        end = self.n - size + 1
        if end <= first:
            return []
        if p == 0:
            level.add(self.words[first:end].view(np.uint64))
        else:
            under = self.levels[p - 1]
            part = under.hashes[first - under.base:end + size // 2 - under.base]
            level.add(mix(part[:end - first], part[size // 2:]))
        first = max(first, 1)
        if end <= first:
            return []
        hashes, base = level.hashes, level.base
        new = hashes[first - base:end - base]
        at = np.arange(first - 1, end - 1) // grid  # the catcher next before each suffix
        near = new == hashes[at * grid - base]
        if p == 0:
            catcher = at[near]
            distances = np.ones(len(catcher), np.int64)
        else:
            far = new == hashes[np.maximum(at - 1, 0) * grid - base]
            hits = np.flatnonzero(far & (at > 0))
            hit_near = np.unique(at[near])
            if len(hits):
                # The first suffix of each catcher; none where a nearer one was equal.
                catcher, place = np.unique(at[hits] - 1, return_index=True)
                distances = first + hits[place] - catcher * grid
                fresh = ~np.isin(catcher, hit_near)
                if level.spent:
                    fresh &= ~np.isin(catcher, list(level.spent))
                met, catcher, distances = catcher, catcher[fresh], distances[fresh]
            else:
                met = catcher = distances = hits
            # Only the last two catchers can still meet later suffixes.
            open_from = int(at[-1]) - 1
            level.spent = {c for c in level.spent if c >= open_from}
            level.spent.update(c for c in (*hit_near[-2:].tolist(), *met[-2:].tolist())
                               if c >= open_from)
        if len(catcher) > 1:
            # Neighbours with one distance lie in one repetition.
            new_run = np.ones(len(catcher), bool)
            new_run[1:] = (np.diff(catcher) != 1) | (np.diff(distances) != 0)
            catcher, distances = catcher[new_run], distances[new_run]
        return list(zip((catcher * grid).tolist(), distances.tolist()))

    def _equal(self, at: int, period: int, end: int) -> int:
        """How many words from ``at`` on, up to ``end``, equal those a period before."""
        done, step = at, 32
        while done < end:
            stop = min(end, done + step)
            other = self.words[done:stop] != self.words[done - period:stop - period]
            if other.any():
                return done + int(other.argmax()) - at
            done, step = stop, step * 4
        return end - at

    def _equal_back(self, at: int, period: int) -> int:
        """How many words before ``at`` equal those a period after."""
        done, step = at, 32
        while done > 0:
            stop = max(0, done - step)
            other = self.words[stop:done] != self.words[stop + period:done + period]
            if other.any():
                return at - done + int(other[::-1].argmax())
            done, step = stop, step * 4
        return at

    def _catch(self, start: int, period: int, size: int) -> bool:
        """Extend a candidate both ways; False if it is known or no repetition."""
        known = self.last.get(period)
        if known and known[0] <= start and start + period + size <= known[1]:
            return False
        right = self._equal(start + period, period, self.n)
        if right < size:
            return False  # equal hashes of different words
        left = self._equal_back(start, period)
        if period in self.open:
            self._close(period)
        self.last[period] = [start - left, start + period + right]
        if start + period + right == self.n:
            self.open.add(period)
        else:
            self._close(period)
        return True

    def _grow(self, period: int) -> None:
        run = self.last[period]
        run[1] += self._equal(run[1], period, self.n)
        if run[1] < self.n:
            self._close(period)

    def _close(self, period: int) -> None:
        self.open.discard(period)
        start, end = self.last[period]
        if self._long_enough(start, end, period):
            self.closed.append((start, end - start, period))

    def _long_enough(self, start: int, end: int, period: int) -> bool:
        return end - start >= max(self.min_length, self.min_powers * period)

    def runs(self) -> list[tuple[int, int, int]]:
        """Start, length and period of the runs so far, in order."""
        grown = [
            (start, end - start, period) for period in self.open
            for start, end in [self.last[period]] if self._long_enough(start, end, period)
        ]
        return sorted(self.closed + grown, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds beyond its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    gone = np.cumsum(cover[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def find_runs(
    docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), text: str = "text",
    min_length: int = MIN_LENGTH, min_powers: int = MIN_POWERS,
) -> DataFrame:
    """Per input row: the carried columns as ``row``, n_words, ``runs`` (start, length,
    period; by start and period) and ``collapsed``, the kept words joined by blanks."""
    rows = docs.select(F.struct(*map(quoted, carry)).alias("row"),
                       quoted(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found, kept = [], [], []
            for value in batch.column("text").cast(pa.binary()):
                words = (value.as_py() or b"").split()
                catcher = RunCatcher(min_length, min_powers)
                coded = pa.array(words, pa.large_binary()).dictionary_encode()
                catcher.append(coded.indices.to_numpy().astype(np.int64))
                runs = catcher.runs()
                sizes.append(len(words))
                found.append([dict(zip(RUN.names, run)) for run in runs])
                kept.append(b" ".join(collapse(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sizes, pa.int64()), pa.array(found, _RUNS),
                 pa.array(kept, pa.string())], ["row", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(work, T.StructType([
        rows.schema["row"], T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]))
