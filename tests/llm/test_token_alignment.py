"""Alignment of two tokenizers against plain loops over the libraries' ids."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.llm import queries as Q
from marginflow.llm import token_alignment as A
from marginflow.llm.tokens import vocabulary_path
from tests.llm.helpers import SF, docs, texts_of

PATHS = vocabulary_path(A.BYTE_VOCABULARY), vocabulary_path(A.PIECE_VOCABULARY)


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATHS[0])
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def token_bytes(libraries):
    t, m = libraries
    letters = A.byte_letters()
    def of_a(i):
        return bytes(letters[c] for c in t.id_to_token(i))
    def of_b(i):
        return bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
    return of_a, of_b


def brute(libraries, text):
    """(a ids, b ids, groups, links) with one set of ends a side."""
    t, m = libraries
    of_a, of_b = token_bytes(libraries)
    if not text:
        return [], [], "", []
    ids = t.encode(" " + text, add_special_tokens=False).ids, m.encode(text)
    want = (" " + text).encode()
    if b"".join(map(of_a, ids[0])) != want or b"".join(map(of_b, ids[1])) != want:
        return [], [], "", []
    ends = [np.cumsum([len(of(i)) for i in side]).tolist() for of, side in zip((of_a, of_b), ids)]
    common = sorted(set(ends[0]) & set(ends[1]))
    cut = []
    for side, end in zip(ids, ends):
        groups = {c: [] for c in common}
        for i, e in zip(side, end):
            groups[next(c for c in common if c >= e)].append(str(i))
        cut.append([",".join(groups[c]) for c in common])
    links = [(x, y) for x, e in zip(ids[0], ends[0]) for y, f in zip(ids[1], ends[1]) if e == f] \
        if len(ids[0]) < 300 else [(x, ids[1][ends[1].index(e)]) for x, e in zip(ids[0], ends[0]) if e in set(common)]
    return *ids, ";".join(f"{x}|{y}" for x, y in zip(*cut)), links


ODD = [None, "", " ", "  two  spaces ", "a▁b", "<0x41> <unk> </s>", "<|endoftext|> x", "naïve café 東京 👍🏽",
       "tab\tline\r\n\n  x", "\x00\x01", "é" * 400, "x", "end "]


def test_groups_and_links_of_odd_and_random_texts(libraries):
    rnd = random.Random(3)
    letters = [*"abcdefghij  etaoin", "é", "ß", "東", "京", "\n", "1", "23", "…", "the ", "tion"]
    texts = ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 60))) for _ in range(400)]
    got = A.Aligner(*PATHS)(texts, True)
    for text, (na, nb, ng, groups, links) in zip(texts, got):
        a, b, want, want_links = brute(libraries, text)
        assert (na, nb, groups) == (len(a), len(b), want), text
        pairs = np.frombuffer(links, "<u4")
        assert sorted(zip((pairs >> 16).tolist(), (pairs & 0xffff).tolist())) == sorted(want_links)
        assert ng == (len(want.split(";")) if want else 0)


@pytest.mark.parametrize("seed", range(4))
def test_common_ends(seed):
    rnd = np.random.default_rng(seed)
    for share in (0.02, 0.5, 0.98):
        n = int(rnd.integers(2, 3000))
        keep = [np.sort(rnd.choice(n, max(1, int(n * share)), replace=False)) for _ in range(2)]
        a, b = (np.unique(np.append(k, n)).astype(np.int32) for k in keep)
        x, y = A.common_ends(a, b)
        both = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[x].tolist() == b[y].tolist() == both


def test_query_against_brute_force(spark, libraries):
    texts = texts_of(spark)
    want = {i: brute(libraries, t) for i, t in texts.items()}
    counts = Counter(p for w in want.values() for p in w[3])
    top = {}
    for (a, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    got = {r["doc_id"]: r for r in Q.op13_token_alignment(spark, SF).collect()}
    assert got.keys() == want.keys()
    for i, (a, b, groups, links) in want.items():
        r = got[i]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (
            len(a), len(b), groups.count(";") + 1 if groups else 0, len(links))
        assert r["n_best"] == sum(counts[p] == top[p[1]] for p in links)
        assert r["count_sum"] == sum(counts[p] for p in links)
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if a else "")


def test_pairs_stay_within_the_bound(spark):
    aligner = A.Aligner(*PATHS)
    a, b = aligner.a.tokens.entries, aligner.b.tokens.entries
    assert A.pair_bound([b"ab", b"b", b"xab"], [b"b", b"ab", b"ab"]) == 3 + 3 + 3
    rows = A.align(spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id"])
    pairs = [r["pair"] for r in A.link_counts(rows).collect()]
    assert len(pairs) <= A.pair_bound(a, b)
    assert all(a[p >> 16].endswith(b[p & 0xffff]) or b[p & 0xffff].endswith(a[p >> 16]) for p in pairs)


def test_rows_with_nulls_repeats_and_clashing_names(spark, libraries):
    rows = docs(spark, ODD + ["x", "x"], ids=[None, *range(len(ODD)), 3]).withColumns(
        {"a.b": F.lit(1), "groups": F.lit("old"), "links": F.lit(2), "t": F.lit(None).cast("string")})
    out = A.align_corpus(rows.drop("groups", "links"), keep=["doc_id", "a.b", "t"], whole_groups=True)
    assert out.columns[:3] == ["doc_id", "a.b", "t"]
    got = sorted((r["n_a"], r["groups"]) for r in out.collect())
    assert got == sorted((len(w[0]), w[2]) for w in (brute(libraries, t) for t in ODD + ["x", "x"]))


def test_long_text_and_empty_table(spark):
    (na, nb, ng, groups, links), = A.Aligner(*PATHS)(["word " * 200_000 + "end"], False)
    assert ng == na == nb == len(links) // 4
    assert A.align_corpus(docs(spark, []), keep=["doc_id"]).collect() == []
