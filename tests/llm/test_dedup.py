"""The copy-removing operators against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from wardlight.llm import line_dedup, near_dedup, sketch, substring_dedup, suffix_dedup


def word_text(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def copies(make_docs):
    """Texts with shared passages, near copies of one text, and loops."""
    rng = random.Random(5)
    passage, base = word_text(rng, 40), word_text(rng, 120).split()
    rows = [(i, word_text(rng, rng.randrange(5, 150))) for i in range(30)]
    for i in range(30, 60):
        cut = rng.randrange(0, 20)
        rows.append((i, f"{word_text(rng, cut)} {passage} {word_text(rng, 15)}"))
    for i in range(60, 110):
        edited = [w if rng.random() > 0.02 else "edited" for w in base]
        rows.append((i, " ".join(edited)))
    rows += [(200, "tick tock " * 80), (201, "é" * 300), (202, "ab" * 200 + passage), (203, passage)]
    rows += [(204, rows[3][1]), (205, rows[3][1])]
    return rows


def test_word_windows_equal_brute_force(make_docs, copies):
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(
        make_docs(copies), with_text=True).collect()}
    first = {}
    for doc_id, text in sorted(copies):
        words = text.split()
        gone = [False] * len(words)
        windows = [tuple(words[i:i + 13]) for i in range(len(words) - 12)]
        for i, window in enumerate(windows):
            if first.get(window, doc_id) < doc_id:
                gone[i:i + 13] = [True] * 13
        for window in windows:
            first.setdefault(window, doc_id)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        row = got[doc_id]
        assert (row["n_words"], row["n_removed"], row["kept_text"]) == (len(words), sum(gone), kept)
        assert row["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("hot, bucket", [(suffix_dedup.HOT, suffix_dedup.BUCKET), (2, 5), (10**9, 7)])
def test_bytes_equal_brute_force(make_docs, copies, monkeypatch, hot, bucket):
    """With HOT at 2 most shared cores are dealt out by string."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rng = random.Random(17)
    # one core between many different neighbours, and shared strings that begin before it
    middle = "".join(rng.choice("abcdefgh ") for _ in range(120))
    copies = copies + [
        (1000 + i, "".join(rng.choice("xyz") for _ in range(rng.randrange(60))) + middle[
            rng.randrange(0, 30):rng.randrange(95, 120)] + "".join(
                rng.choice("uvw") for _ in range(rng.randrange(60)))) for i in range(150)]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(
        make_docs(copies), with_kept=True).collect()}
    seen = set()
    for doc_id, text in sorted(copies):
        body = text.encode()
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - 99):
            if body[i:i + 100] in seen:
                gone[i:i + 100] = True
            seen.add(body[i:i + 100])
        kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
        row = got[doc_id]
        assert bytes(row["kept"]) == kept
        assert row["n_removed"] == gone.sum()
        assert row["n_spans"] == (np.diff(np.r_[0, gone.astype(int)]) == 1).sum()


def similarity(a, b):
    bag = lambda t: Counter(
        tuple(t[i:i + 5]) for i in range(max(1, len(t) - 4))) if t else Counter()
    x, y = bag(a.split()), bag(b.split())
    total = sum((x | y).values())
    return sum((x & y).values()) / total if total else 0.0


@pytest.mark.parametrize("small", [near_dedup.SMALL, 2])
def test_near_classes_equal_brute_force(make_docs, copies, monkeypatch, small):
    """With SMALL at 2 nearly every bucket goes through hubs and blocks."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    of = {i: i for i, _ in copies}

    def top(i):
        while of[i] != i:
            i = of[i]
        return i

    for i, a in copies:
        for j, b in copies:
            if i < j and similarity(a, b) >= 0.8:
                x, y = sorted((top(i), top(j)))
                of[y] = x
    want = {i: top(i) for i in of}
    assert len(set(want.values())) < len(want)
    got = {r["doc_id"]: r["class_id"]
           for r in near_dedup.near_classes(make_docs(copies)).collect()}
    assert got == want


def test_near_copies_keep_one(make_docs, copies):
    docs = make_docs(copies)
    classes = near_dedup.near_classes(docs).collect()
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["class_id"] for r in classes}


def test_bag_min_hash_is_unbiased():
    rng = np.random.default_rng(2)
    ids = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    a, b = rng.integers(1, 40, 60), rng.integers(0, 40, 60)
    has = b > 0
    signed = near_dedup.bag_min_hash(
        2, np.r_[np.zeros(60, int), np.ones(has.sum(), int)], np.r_[ids, ids[has]],
        np.r_[a, b[has]], slots=8192)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((signed[0] == signed[1]).mean() - want) < 0.02
    alone = near_dedup.bag_min_hash(1, np.zeros(60, int), ids, a, slots=8192)
    assert (alone[0] == signed[0]).all()


def test_sketch_never_undercounts(spark):
    hashes = np.random.default_rng(3).integers(0, 1 << 63, 5_000).astype(np.uint64)
    rows = [[int(h)] for h in np.r_[hashes, hashes[:700]].view(np.int64)]
    table = spark.createDataFrame(rows, "h long").repartition(5)

    def extract(batch):
        yield batch.column("h").to_numpy().view(np.uint64)

    bits = sketch.repeated_cells(table, extract, sketch.cells_for(5_000))
    found = sketch.maybe_repeated(bits, hashes)
    assert found[:700].all() and found[700:].mean() < 0.01


def test_steps_round_trip():
    for numbers in ([], [0], [0, 0, 1], [254, 255, 510, 511, 4_000_000, 4_000_000]):
        got = sketch.from_steps(sketch.to_steps(np.array(numbers, np.int64)))
        assert got.tolist() == numbers


def test_recurring_lines(make_docs):
    rng = random.Random(8)
    rows = []
    for i in range(40):
        own = " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(12))
        lines = [own, "All pages of this site"]
        if i % 2:
            lines.append(f"Page {i} of 90")
        lines.append(f"posted by the user name{chr(97 + i % 26)} on our board of news today")
        rows.append((i, "\n".join(lines)))
    rows.append((99, "quite alone\n\nhere"))
    got = {r["doc_id"]: r for r in line_dedup.find_recurring(
        make_docs([(i, t) for i, t in rows]).select("doc_id", "text"), min_docs=10, carry=("doc_id",)
    ).select("row.doc_id", "n_lines", "dropped", "kept_text").collect()}
    assert got[0]["dropped"] == [] and got[1]["dropped"] == [1, 3]
    assert got[2]["dropped"] == [1, 2] and got[3]["dropped"] == [1, 2, 3]
    assert got[3]["kept_text"] == rows[3][1].split("\n")[0]
    assert got[99]["kept_text"] == rows[40][1]


def test_copies_lose_lines_but_one_stays_whole(make_docs):
    text = "a first line of some words\nand a second line of other words"
    docs = make_docs([(i, text) for i in range(12)])
    assert [tuple(r) for r in line_dedup.drop_recurring(docs).select("doc_id", "text").collect()] == [
        (0, text)]


def dropped_lines(docs):
    return {r["doc_id"]: r["dropped"] for r in line_dedup.find_recurring(docs)
            .select("row.doc_id", "dropped").collect()}


def test_long_lines_recur_word_for_word(make_docs):
    """Long lines in 2, 3 and 9 documents go, with and without digits; short ones stay."""
    rows = []
    for copies in (2, 3, 9):
        long_line = " ".join(f"{w}{'abc'[copies % 3]}{'x' * copies}" for w in "abcdefghijkl")
        dated = " ".join(f"{w}y{'x' * copies}" for w in "abcdefghijk") + f" 20{copies}"
        for k in range(copies):
            rows.append((100 * copies + k, "\n".join([
                f"own{chr(97 + k)}{'z' * copies}", long_line, "short line " + "x" * copies, dated])))
    other = " ".join(f"{w}yxx" for w in "abcdefghijk") + " 77"
    got = dropped_lines(make_docs([*rows, (7, other)]))
    for copies in (2, 3, 9):
        assert got[100 * copies] == []
        assert all(got[100 * copies + k] == [1, 3] for k in range(1, copies))
    assert got[7] == []


FIELDS = {
    "four tokens": "posted by user {a}",
    "seven tokens": "posted by the user {a} on news",
    "eight tokens": "this comment was posted by {a} last night",
    "two fields": "the old board of news thanks {a} and all friends of {b} very much",
    "across a border": "one two three four five {a} {b} eight nine ten eleven twelve",
}


@pytest.mark.parametrize("name", FIELDS)
def test_variable_fields(make_docs, name):
    """The lines of 12 documents differ in their fields only; 9 such lines are too few."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=9))
    for n, want in ((12, [0]), (9, [])):
        got = dropped_lines(make_docs([
            (i, FIELDS[name].format(a=word(), b=word()) + "\n" + word()) for i in range(n)]))
        assert got[0] == [] and all(got[i] == want for i in range(1, n))


def test_a_common_field_value_shares_the_template(make_docs):
    """Lines with a rare value go, though one value alone makes up most of the lines."""
    rows = [(i, f"posted by the user {'john' if i < 30 else 'x' + chr(97 + i - 30)} on news")
            for i in range(34)]
    got = dropped_lines(make_docs([*rows, rows[33]]))  # equal rows are one document
    assert got[0] == [] and all(got[i] == [0] for i in range(1, 34))


def test_windows_put_in_order_in_little_memory():
    """A batch's windows take 60 bytes each at most while they are put in order."""
    draw, n = np.random.default_rng(3), 400_000
    ids = draw.permutation(1_000)
    tracemalloc.start()
    try:
        held = [[
            draw.integers(0, 5_000, n // 4).astype(np.uint64),
            draw.integers(0, 3, n // 4).astype(np.uint32),
            draw.integers(0, 1_000, n // 4).astype(np.int32), np.arange(n // 4, dtype=np.int32),
        ] for _ in range(4)]
        plain = [np.concatenate(x) for x in zip(*held)]
        order = np.lexsort((ids[plain[2]], plain[1], plain[0]))
        want = [hashlib.sha256(column[order]).hexdigest() for column in plain]
        del plain, order
        tracemalloc.reset_peak()
        found = substring_dedup.in_order(held, ids)
        assert tracemalloc.get_traced_memory()[1] < 60 * n
    finally:
        tracemalloc.stop()
    assert [hashlib.sha256(column).hexdigest() for column in found] == want
