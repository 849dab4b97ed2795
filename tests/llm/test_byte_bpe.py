"""Merge replay against the tiktoken library, and the round trip."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.llm import byte_bpe as B
from marginflow.llm import queries as Q
from marginflow.llm.tokens import vocabulary_path
from tests.llm.helpers import SF, docs, texts_of

PATH = vocabulary_path(B.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(PATH),
                             special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return B.ByteBPE(PATH)


def split(bpe, texts):
    ids, n = bpe.encode_batch(texts)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


EDGE = ["", " ", "a", "\n\n  \n", "aaaaaaaaaaaaa", "ab" * 5000, "é" * 3000, "a" * 200_001, "<|endoftext|>",
        "it's they'LL 12345 \t x", "東京は日本の首都です。", "\x00\x1c\x85᠎​", "👩‍👩‍👧" * 50, "1" * 999]


def test_edge_texts_equal_the_library(bpe, library):
    assert split(bpe, EDGE) == [library.encode_ordinary(t) for t in EDGE]


def test_random_texts_equal_the_library(bpe, library):
    rnd = random.Random(5)
    pools = ["ab", "aeiou nt", [chr(c) for c in range(32, 127)],
             [chr(c) for c in (*range(0x20, 0x250), *range(0x400, 0x460), *range(0x4e00, 0x4e40), 0x1f600, 9, 10, 13)]]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randrange(80))) for pool in pools for _ in range(800)]
    assert split(bpe, texts) == [library.encode_ordinary(t) for t in texts]


def test_all_letters_cut_as_the_library_cuts(bpe, library):
    texts = ["a" + "".join(f"{chr(c)}b 1{chr(c)} " for c in range(lo, lo + 512)) for lo in range(0, 0x3000, 512)]
    assert split(bpe, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_hand_made_ranks_with_merges_out_of_order(seed):
    """Vocabularies no trainer would give: a merge may open one of a lower rank."""
    import tiktoken
    rnd = random.Random(seed)
    tokens = {bytes([b]) for b in range(256)}
    extra = {bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(2, 6))) for _ in range(40)}
    order = sorted(tokens) + rnd.sample(sorted(extra), len(extra))
    ranks = {t: i for i, t in enumerate(order)}
    replay = B.MergeReplay(ranks)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 30))) for _ in range(400)]
    lib = tiktoken.Encoding("odd", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    ids, n = replay.encode_words([w.encode() for w in words])
    for w, got in zip(words, np.split(ids, np.cumsum(n)[:-1])):
        if w.encode() not in ranks:
            assert got.tolist() == lib.encode_ordinary(w) == replay.merge_alone(w.encode())


def test_query_equals_the_library(spark, library):
    got = {r["doc_id"]: r for r in Q.op12_byte_bpe(spark, SF).collect()}
    texts = texts_of(spark)
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = library.encode_ordinary(t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_encode_then_decode_rows(spark, library):
    texts = [None, *EDGE, "again", "again"]
    rows = docs(spark, texts, ids=[None, *range(len(texts) - 2), 3]).withColumns(
        {"a.b": F.lit(1), "ids": F.lit("old"), "__text": F.lit("x")})
    coded = B.encode_texts(rows, keep=["doc_id", "a.b", "ids", "text", "__text"])
    assert coded.columns == ["doc_id", "a.b", "text", "__text", "n_tokens", "ids"]
    back = B.decode_ids(coded, keep=["text", "n_tokens"]).collect()
    assert sorted((r["text"] or "") for r in back) == sorted(bytes(r["decoded"]).decode() for r in back)
    assert {(r["text"] or "", r["n_tokens"]) for r in back} == {(t or "", len(library.encode_ordinary(t or ""))) for t in texts}


def test_empty_table(spark):
    assert B.round_trip(docs(spark, []), keep=["doc_id"]).collect() == []
