"""Byte-level BPE against the public encoder."""

import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from wardlight.llm import byte_pairs, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return byte_pairs.load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def public():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(7)
    alphabet = "abcdeſéßÄ 字漢あ́​\x1c\x85\xa0　\n\t'’12٣!?-_\U0001f600՘࢏꟎"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    return made + [
        "", " ", "\n\n  \n", "it's we'LL I'd", "a" * 5_000, "ab" * 3_000, " " * 4_000 + "x",
        "".join(rng.choice("abcdefghij") for _ in range(3_000)), "<|endoftext|>", "\x00\x00",
        "Straße" * 500, "".join(chr(c) for c in range(0x20, 0x3000)),
    ]


def test_perfect_hash_is_minimal_and_perfect(vocabulary):
    keys = pa.array(list(byte_pairs.parse_ranks(vocabulary.ranks)), pa.large_binary())
    perfect = byte_pairs.PerfectHash(keys)
    assert sorted(perfect.places(keys).tolist()) == list(range(len(keys)))
    none = byte_pairs.PerfectHash(pa.array([], pa.large_binary()))
    assert none.places(pa.array([b"x"], pa.large_binary())).tolist() == [-1]


@pytest.mark.parametrize("piece", [byte_pairs.PIECE, 40])
def test_ids_equal_the_public_encoder(vocabulary, public, monkeypatch, piece):
    monkeypatch.setattr(byte_pairs, "PIECE", piece)
    encoder, decoder = byte_pairs.Encoder(vocabulary), byte_pairs.Decoder(vocabulary)
    all_texts = texts()
    got = encoder.encode([*all_texts, None])
    assert got.to_pylist() == [public.encode_ordinary(t) for t in all_texts] + [[]]
    for ids, text in zip(got, all_texts):
        assert decoder.decode(ids.values.to_numpy()) == text.encode()


def test_query_equals_the_public_encoder(spark, folder, public):
    got = {r["doc_id"]: r for r in queries.op11_byte_pairs(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        ids = public.encode_ordinary(text or "")
        row = got[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(public.decode_bytes(ids)).hexdigest()


def test_odd_rows(odd_docs, vocabulary):
    odd = odd_docs.withColumns({"a.b": F.lit(1), "ids": F.lit("x"), "decoded": F.lit("y")})
    carry = tuple(odd.columns)
    rows = byte_pairs.decode(byte_pairs.encode(odd, vocabulary, carry), vocabulary).collect()
    assert len(rows) == 11
    for row in rows:
        assert bytes(row["decoded"]) == (row["row"]["text"] or "").encode()
        assert row["row"]["a.b"] == 1 and row["row"]["ids"] == "x"
    assert byte_pairs.encode(odd.limit(0), vocabulary, carry).count() == 0


def test_what_is_refused(vocabulary, tmp_path, monkeypatch):
    with pytest.raises(ValueError):
        byte_pairs.parse_ranks(b"YQ== 0\n")
    with pytest.raises(ValueError):
        byte_pairs.Decoder(vocabulary).decode(byte_pairs.np.array([10**6]))
    monkeypatch.setattr(byte_pairs, "MAX_VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError):
        byte_pairs.load(PATH, "x")
