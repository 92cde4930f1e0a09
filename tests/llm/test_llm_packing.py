"""Packing against the tokenizer itself, exhaustive filling, and an exact round trip."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetstate.llm import packing
from fleetstate.llm.common import chunks
from fleetstate.llm.packing import Encoder, combinations, fullest, op12_best_fit_packing, pack, sequences

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "It's the dog's, we'll 12 go!!! <|endoftext|> a<|startoftext|>b", "é ́x Ångström wide space",
    "tab\tnew\nline\x0bvt\x0cff\rcr\x1cfs", "你好 مرحبا \U0001f600\U0001f600", "", " \n ", "ABC abc Abc", "\x00 nul", "x" * 5000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(tokenizer, text) -> list[int]:
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_fullest_equals_all_combinations():
    rng = random.Random(2)
    for _ in range(200):
        lengths = sorted(rng.sample(range(1, 25), rng.randint(1, 5)), reverse=True)
        counts, room = {k: rng.randint(0, 3) for k in lengths}, rng.randint(0, 40)
        best = max(s for many in itertools.product(*(range(counts[k] + 1) for k in lengths)) if (s := sum(k * n for k, n in zip(lengths, many))) <= room)
        found = fullest(counts, lengths, room)
        assert sum(k * n for k, n in found.items()) == best and all(0 < n <= counts[k] for k, n in found.items())


def test_combinations_use_all_pieces_and_each_is_the_fullest_left():
    rng = random.Random(4)
    for _ in range(30):
        counts = {k: rng.randint(1, 9) for k in rng.sample(range(1, 65), 12)}
        left = dict(counts)
        for times, chosen in combinations(counts, 64):
            longest = max(k for k in left if left[k])
            assert longest in chosen
            rest = {k: n - (k == longest) for k, n in left.items()}
            best = {0}
            for k, n in rest.items():
                best = {s + k * i for s in best for i in range(n + 1) if s + k * i <= 64 - longest}
            assert sum(k * n for k, n in chosen.items()) == longest + max(best)
            for k, n in chosen.items():
                left[k] -= times * n
        assert not any(left.values())


def encoded(encode, texts, most):
    import pyarrow as pa

    out = []
    for chunk in chunks(pa.array(texts), lower=False, most=most):
        ids, bounds = encode(chunk.data, chunk.bounds)
        out += [[*ids[a:b].tolist(), 0] for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def test_encoder_equals_the_tokenizer(tokenizer):
    rng = random.Random(8)
    signs = ["a", "B", "s", "t", "'", "'", "1", ".", "-", "<", "|", ">", " ", "\n", "é", "H̱", "H", "\u0331", "\u0338", "\u0301", "İ", "İ", "—", "你", "\xa0", "\u2003", "K", "ﬁ"]
    texts = [*ODD, *ODD[:3], "again it's the dog's", "<|ENDOFTEXT|> x", "DON'T we'Ll 'S''s x'1's"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(3000)]
    encode, want = Encoder(PATH), [expected(tokenizer, t) for t in texts]
    for most in (300, 1 << 20):
        assert encoded(encode, texts, most) == want


def test_words_of_one_hash_are_told_apart(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "span_hashes", lambda data, starts, ends: np.ones(len(starts), dtype=np.uint64))
    texts = ["alpha beta alpha gamma", "beta, beta"]
    assert encoded(Encoder(PATH), texts, 1000) == [expected(tokenizer, t) for t in texts]


def check(rows, texts: dict, tokenizer, size: int):
    """Pieces tile their documents and fill sequences without gaps; returns the number of sequences."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc, parts in by_doc.items():
        parts.sort(key=lambda r: r["piece"])
        ids = [i for r in parts for i in r["ids"]]
        assert ids == expected(tokenizer, texts[doc])
        assert [r["piece"] for r in parts] == list(range(-(-len(ids) // size)))
        assert [r["start"] for r in parts] == [size * i for i in range(len(parts))]
        assert all(r["length"] == len(r["ids"]) for r in parts) and all(r["length"] == size for r in parts[:-1])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= size
    return len(by_sequence)


@pytest.mark.parametrize("size", [16, 2048])
def test_pieces_tile_documents_and_sequences(spark, tokenizer, size):
    rng = random.Random(size)
    texts = {i: " ".join(rng.choice(["a", "It's", "zebra", "été", "12"]) for _ in range(rng.randint(0, 60))) for i in range(300)}
    texts |= {1000 + i: t for i, t in enumerate(ODD)} | {2000: None, 2001: "word " * 10_000}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = pack(frame, size).collect()
    many = check(rows, texts, tokenizer, size)
    tokens = sum(r["length"] for r in rows)
    assert many <= -(-tokens // size) + 1


def test_large_offsets_table_is_joined_by_shuffle(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SENT_ROWS", 0)
    texts = {i: "one two three"[: i % 13] for i in range(200)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    check(pack(frame, 32).collect(), texts, tokenizer, 32)


def test_null_and_repeated_ids_clashing_columns_and_empty_table(spark):
    rows = [(None, "a b", 1, 2), (7, "a b", 1, 2), (7, "a b", 1, 2), (7, None, 1, 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, part int, length int")
    found = sorted((str(r["doc_id"]), r["length"]) for r in pack(frame).collect())
    assert found == [("7", 1), ("7", 3), ("7", 3), ("None", 3)]
    assert pack(frame.limit(0)).collect() == []
    whole = sequences(pack(frame)).collect()
    assert len(whole) == 1 and len(whole[0]["ids"]) == 10


def test_query_over_the_given_table(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op12_best_fit_packing(spark, SF_DIR).collect()
    tokens = 0
    for r in rows:
        ids = expected(tokenizer, texts[r["doc_id"]])[r["start"] : r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(np.array(ids, dtype="<u4").tobytes()) == r["ids_crc32"]
        tokens += len(ids)
    assert tokens == sum(len(expected(tokenizer, t)) for t in texts.values())
    assert len({r["sequence_id"] for r in rows}) <= -(-tokens // 2048) + 1
