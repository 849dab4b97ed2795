"""Packing (op 1) and token files (op 6)."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from marginflow.llm import token_files as tf
from marginflow.llm.common import scratch_path
from marginflow.llm.packing import pack, plan_packing
from marginflow.llm.queries import QUERIES
from marginflow.llm.tokens import WordEncoder, vocabulary_path
from tests.llm.helpers import SF, docs, texts_of

ODD = ["", "a <|endoftext|>b", "x\x1cy", "  ", "́ é é x é", "İstanbul ΑΣ Σ", "a b　c d",
       "don't 12 we'LL", "\x85 a\x85b", "\ta\tb\r\nc", "汉字 текст ...,, '' $$$. x,", "Straße ÑANDÚ µm²"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(vocabulary_path())


def encode(tok, text, end):
    return np.asarray([*tok.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_word_encoder_equals_library(spark, tok):
    enc = WordEncoder(vocabulary_path())
    sample = ODD + list(texts_of(spark).values())
    got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode_batch(sample)]
    assert got == [tok.encode(t, add_special_tokens=False).ids for t in sample]


def check_places(rows, capacity):
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in seqs.values():
        at = 0
        for off, n in sorted(spans):
            assert off == at
            at += n
        assert at <= capacity
    return len(seqs)


def test_packing_query_against_library(spark, tok):
    rows = QUERIES["op1_best_fit_packing"](spark, SF).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    texts = texts_of(spark)
    assert set(by_doc) == set(texts)
    total = 0
    for d, t in texts.items():
        ids = encode(tok, t, 0)
        total += len(ids)
        got = sorted(by_doc[d], key=lambda r: r["piece"])
        want = [ids[i:i + 2048] for i in range(0, len(ids), 2048)]
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got] == \
               [(i, 2048 * i, len(w), zlib.crc32(w.tobytes())) for i, w in enumerate(want)]
    assert check_places(rows, 2048) <= -(-total // 2048) * 1.02 + 1


def simulate(runs):
    bins = {}
    for n, first_rank, first, per, offset, count in runs:
        for r in range(first_rank, first_rank + count):
            k = r - first_rank
            bins.setdefault(first + k // per, []).append((offset + (k % per) * n, n))
    return bins


def test_plan_is_gapless_and_near_first_fit_decreasing():
    rng = np.random.default_rng(3)
    for case in range(30):
        cap = int(rng.integers(5, 200))
        sizes = rng.integers(1, cap + 1, int(rng.integers(1, 400)))
        counts = dict(zip(*[a.tolist() for a in np.unique(sizes, return_counts=True)]))
        runs, used = plan_packing(counts, cap)
        runs.sort()
        sized = []
        for i, (n, rank, *_) in enumerate(runs):
            stop = runs[i + 1][1] if i + 1 < len(runs) and runs[i + 1][0] == n else counts[n]
            sized.append((*runs[i], stop - rank))
        bins = simulate(sized)
        assert len(bins) == used and sum(map(len, bins.values())) == len(sizes)
        for spans in bins.values():
            at = 0
            for off, n in sorted(spans):
                assert off == at
                at += n
            assert at <= cap and sum(3 * n > cap for _, n in spans) <= 2
        ffd = []
        for n in sorted(sizes.tolist(), reverse=True):
            i = next((i for i, b in enumerate(ffd) if b + n <= cap), None)
            ffd.append(n) if i is None else ffd.__setitem__(i, ffd[i] + n)
        assert used <= len(ffd) + max(1, len(ffd) // 50)


def test_packing_edges(spark):
    df = docs(spark, [None, "", "the cat", "the cat", "the cat"], [None, 1, 2, 2, 2]).selectExpr("*", "1 AS sequence_id")
    rows = pack(df, capacity=4).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["length"]) for r in rows) == \
        [(False, 1, 1), (False, 2, 3), (False, 2, 3), (False, 2, 3), (True, 0, 1)]
    assert check_places(rows, 4) == 3
    assert pack(df.limit(0)).count() == 0
    long = pack(docs(spark, ["the " * 50_000]), capacity=1000).collect()
    assert sum(r["length"] for r in long) == 50_001 and max(r["length"] for r in long) == 1000


def test_rank_offsets_by_shuffle_join(spark, monkeypatch):
    from marginflow.llm import packing
    monkeypatch.setattr(packing, "BROADCAST_OFFSETS", -1)
    df = docs(spark, ["the cat"] * 40).repartition(5)
    assert check_places(pack(df, capacity=6).collect(), 6) == 20


def test_token_files_query_against_library(spark, tok):
    rows = sorted(QUERIES["op6_token_files"](spark, SF).collect(), key=lambda r: r["doc_id"])
    start = 0
    for r, (d, t) in zip(rows, sorted(texts_of(spark).items()), strict=True):
        ids = encode(tok, t, 2)
        assert tuple(r) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_round_trip(spark, tok, monkeypatch):
    monkeypatch.setattr(tf, "SHARD_BYTES", 60)
    monkeypatch.setattr(tf, "ROWS_PER_BUCKET", 3)
    texts = [None, *ODD, "the cat sat on the mat " * 300, "same", "same"]
    ids = [None, *range(3, 3 + len(texts) - 3), 2, 2]
    df = docs(spark, texts, ids).selectExpr("*", "7 AS start", "'x' AS bucket")
    path = scratch_path(spark, "files")
    tf.write_token_files(df, path)
    rows = tf.read_token_files(spark, path).orderBy("start").collect()
    order = sorted(zip(ids, texts), key=lambda p: (p[0] is not None, p[0] or 0))
    assert [r["doc_id"] for r in rows] == [i for i, _ in order]
    at = 0
    for r, (_, t) in zip(rows, order):
        want = encode(tok, t, 2)
        assert r["ids"] == want.tobytes() and (r["start"], r["n_tokens"]) == (at, len(want))
        at += len(want)
    assert spark.read.parquet(f"{path}/manifest").count() > 5  # several shards


def test_one_document_of_a_shard(spark, tok):
    path = scratch_path(spark, "files")
    tf.write_token_files(docs(spark, ["the cat", "a dog", "no one"]), path)
    read = spark.read.format("binaryFile")
    dictionary = bytes(read.load(f"{path}/dictionary").first()["content"])
    shard = tf.Shard(bytes(read.load(f"{path}/shards").first()["content"]), dictionary)
    assert shard.ids(1).tolist() == encode(tok, "a dog", 2).tolist()
    with pytest.raises(ValueError):
        tf.Shard(shard.raw, b"another dictionary")


def test_no_documents_no_files(spark):
    path = scratch_path(spark, "files")
    tf.write_token_files(docs(spark, ["x"]).limit(0), path)
    assert tf.read_token_files(spark, path).count() == 0
