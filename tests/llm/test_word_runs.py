"""Runs of words against brute force, in whole, in parts and word by word."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardlight.llm import queries, word_runs


def plain_runs(words, least=6, powers=4):
    """By trying every period."""
    found, n = {}, len(words)
    for q in range(1, n // powers + 1):
        start = None
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                length = i - start + q
                if length >= max(least, powers * q):
                    found.setdefault((start, length), q)  # the smallest period comes first
                start = None
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def sequences():
    rng = random.Random(11)
    for _ in range(250):
        letters = rng.randrange(1, 4)
        yield [rng.randrange(letters) for _ in range(rng.randrange(0, 60))]
    for _ in range(150):  # repeated blocks, nested and side by side
        out = []
        for _ in range(rng.randrange(1, 5)):
            block = [rng.randrange(3) for _ in range(rng.randrange(1, 25))]
            if rng.random() < 0.4:
                block = block * rng.randrange(2, 6)
            out += block * rng.randrange(1, 7) + block[:rng.randrange(len(block))]
        yield out
    yield [0] * 1000
    yield ([0] * 100 + [1]) * 4
    yield list(range(300)) * 4


def test_runs_equal_brute_force():
    rng = random.Random(12)
    some = 0
    for words in sequences():
        want = plain_runs(words)
        some += len(want) > 1
        whole, parts = word_runs.RunCatcher(), word_runs.RunCatcher()
        codes = np.array(words, np.int64)
        whole.append(codes)
        at = 0
        while at < len(words):
            step = rng.choice([1, 1, 2, 7, 40])
            parts.append(codes[at:at + step])
            at += step
            if at < 100 or at % 3 == 0:
                assert parts.runs() == plain_runs(words[:at])
        assert whole.runs() == want
        assert parts.runs() == want
    assert some > 50


def test_a_square_is_reported_when_it_ends():
    catcher = word_runs.RunCatcher()
    reported = [catcher.append(np.array([w])) for w in [9, 1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 8]]
    when = [i for i, squares in enumerate(reported) if (1, 3) in squares]
    assert len(when) == 1 and 6 <= when[0] <= 8
    assert catcher.runs() == [(1, 12, 3)]


def test_long_texts_stay_cheap():
    for words in (np.zeros(300_000, np.int64), np.arange(300_000) % 70_000,
                  np.tile([0, 0, 1], 100_000)):
        catcher = word_runs.RunCatcher()
        catcher.append(words)
        assert len(catcher.runs()) == 1 and catcher.runs()[0][1] == 300_000
        assert sum(len(level.hashes) for level in catcher.levels) <= 64 * len(words)


def looped(doc_id, words):
    check = zlib.crc32(str(doc_id).encode())
    deal, n = check // 10, len(words)
    if check % 10 or not n:
        return words
    a = deal % n
    p = 1 + (n - a) // (3 + deal % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_loops_and_odd_rows(odd_docs, make_docs):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 90))) + "\t\n ")
            for i in range(120)]
    docs = make_docs(rows)
    made = docs.select("doc_id", queries.looped(F.col("text"), F.col("doc_id")).alias("text"))
    got = {r["row"]["doc_id"]: r for r in word_runs.find_runs(made).collect()}
    for doc_id, text in rows:
        words = looped(doc_id, text.split())
        runs = plain_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        row = got[doc_id]
        assert [tuple(r) for r in row["runs"]] == runs
        assert row["collapsed"] == " ".join(w for i, w in enumerate(words) if i not in gone)
        assert row["n_words"] == len(words)
    odd = odd_docs.withColumns({"a.b": F.lit(1), "runs": F.lit("x")})
    out = word_runs.find_runs(odd, tuple(odd.columns)).collect()
    assert len(out) == 11 and all(r["row"]["runs"] == "x" for r in out)
    assert word_runs.find_runs(odd.limit(0), tuple(odd.columns)).count() == 0
    with pytest.raises(ValueError):
        word_runs.RunCatcher(min_powers=3)
