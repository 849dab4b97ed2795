"""Collocations against plain counting of all phrases."""

import pickle
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marginflow.llm import collocations as C
from marginflow.llm.bitmaps import Bitmap
from tests.llm.helpers import SF, docs, texts_of


def brute_counts(rows):
    """lang -> Counter of word tuples of one to three words."""
    out = {}
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            c = out.setdefault(lang or "und", Counter())
            for k in (1, 2, 3):
                c.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return out


def brute(rows, top=2000, threshold=10):
    out = []
    for lang, f in brute_counts(rows).items():
        total = sum(n for p, n in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < threshold:
                continue
            if len(p) == 2 and any(100 * n >= 50 * a for q, n in f.items()
                                   if len(q) == 3 and n >= threshold and p in (q[:2], q[1:])):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            found.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, r, p.decode(), -a, left, right, total, -s))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_given_table_with_more_shards(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r["lang"], r["text"]) for r in d.collect()])
    assert want
    assert rows_of(C.collocations(d, shards=3)) == want


def random_rows(seed, n=300):
    rnd = random.Random(seed)
    words = ["Alpha", "beta", "c", "dé", "日本", "e\x1cf", "I", "''"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "!? ", "\x0b"]
    return [(rnd.choice(["x", "x", "y", None]), None if rnd.random() < 0.03 else "".join(
        rnd.choice(words[:rnd.choice([3, 8])]) + rnd.choice(ends[:rnd.choice([1, 3, 8])]) for _ in range(rnd.randrange(0, 25))))
        for _ in range(n)]


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_random_texts_in_any_number_of_shards(spark, shards):
    rows = random_rows(shards)
    d = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    # a filter of 64 bits holds nearly everything: more is counted, the result is the same
    for bits in (6, 20):
        assert rows_of(C.collocations(d.repartition(4), shards=shards, filter_bits=bits, top=40)) == brute(rows, 40)


def test_phrases_that_become_frequent_late(spark):
    """Rows in the order of the shards: words of one shard alone, and words
    that reach the threshold only in the last scan of their cycle."""
    rows = [(i, "one two three" if i % 4 == 0 else "four five six" if i < 38 and i % 4 == 3 else "x", "a") for i in range(48)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    got = rows_of(C.collocations(d, shards=4, threshold=10))
    assert got == brute([("a", t) for _, t, _ in rows])
    assert "one two three" in {r[2] for r in got}


def every():
    full = np.full(1, 2 ** 64 - 1, np.uint64)
    return {k: Bitmap(6, full) for k in (1, 2, 3)}


def by_words(batches):
    got = Counter()
    for b in batches:
        for r in C.add_up(1)(pa.Table.from_batches([b])).to_pylist():
            got[r["size"], r["phrase"]] += r["n"]
    return got


def by_hash(batches):
    got = Counter()
    for b in batches:
        for r in b.to_pylist():
            for key, n in zip(*map(np.ndarray.tolist, C.unpacked(r["counts"]))):
                assert key // ((1 << C.HASH_BITS) // 8) == r["part"]
                got[r["size"], key] += n
    return got


def counts_of(text):
    out = Counter({(len(p), " ".join(p)): n for p, n in brute_counts([("x", text)])["x"].items()})
    out[0, None] = sum(n for (k, _), n in out.items() if k == 1)
    return out


def both(text):
    counters = C.FrequentCounter([1, 2, 3], every(), 4), C.ActiveCounter([1, 2, 3], every(), {1: None, 2: None}, 8)
    return [[*c.add("x", [text.encode()]), *c.take()] for c in counters]


def test_a_text_cut_into_parts_counts_once(monkeypatch):
    text = ("alpha beta gamma. " * 50 + "delta " * 40 + "\n") * 3
    words, hashes = both(text)
    assert by_words(words) == counts_of(text)
    hashed = by_hash(hashes)
    assert Counter((k, n) for (k, _), n in hashed.items()) == Counter(
        (k, n) for (k, _), n in counts_of(text).items() if k)
    for size in (1, 7, 50, 333):
        monkeypatch.setattr(C, "PART_BYTES", size)
        words, hashes = both(text)
        assert by_words(words) == counts_of(text) and by_hash(hashes) == hashed


def test_counts_are_passed_on_when_they_are_many(monkeypatch):
    monkeypatch.setattr(C, "TASK_COUNTS", 20)
    monkeypatch.setattr(C, "PART_BYTES", 40)
    rnd = random.Random(1)
    text = " ".join(rnd.choice("abcdefgh") * rnd.randrange(1, 4) for _ in range(500))
    words, hashes = both(text)
    assert len(words) > 10 and len(hashes) > 10
    assert by_words(words) == counts_of(text)
    assert sum(by_hash(hashes).values()) == sum(n for (k, _), n in counts_of(text).items() if k)


def test_phrases_of_all_tasks_add_up():
    texts = ["a b c a b", "b c. é é é", "z"]
    batches = []
    for t in texts:
        for lang in ("x", "y\tz"):
            counter = C.FrequentCounter([1, 2, 3], every(), 4)
            batches += [*counter.add(lang, [t.encode()]), *counter.take()]
    rows = C.add_up(2)(pa.Table.from_batches(batches)).to_pylist()
    want = sum((counts_of(t) for t in texts), Counter())
    for lang in ("x", "y\tz"):
        assert {(r["size"], r["phrase"]): r["n"] for r in rows if r["lang"] == lang} == {
            p: n for p, n in want.items() if n >= 2 or p[0] == 0}


def test_packed_counts_come_back():
    rng = np.random.default_rng(0)
    for n in (1, 2, 1000):
        key = np.unique(rng.integers(0, 1 << C.HASH_BITS, n))
        count = rng.integers(1, 2 ** 40, len(key))
        got = C.unpacked(C.packed(key, count))
        assert got[0].tolist() == key.tolist() and got[1].tolist() == count.tolist()


def test_reached_adds_up_tasks_and_ranges(spark):
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << C.HASH_BITS, 3000))
    rows, total = [], Counter()
    for task in range(4):
        some = np.sort(rng.choice(keys, 1500, replace=False))
        n = rng.integers(1, 6, len(some))
        total.update(dict(zip(some.tolist(), n.tolist())))
        part = some // ((1 << C.HASH_BITS) // 32)
        rows += [(2, int(p), bytearray(C.packed(some[part == p], n[part == p]))) for p in np.unique(part)]
    got = C.reached(spark.createDataFrame(rows, "size int, part int, counts binary"), 9, 20, 32)
    want = np.zeros(1 << 14, np.uint64)
    for key, n in total.items():
        if n >= 9:
            cell = key >> (C.HASH_BITS - 20)
            want[cell >> 6] |= np.uint64(1) << np.uint64(cell & 63)
    assert got.words.tolist() == want.tolist() and want.any()
    back = pickle.loads(pickle.dumps(got))
    assert back == got and back != Bitmap(20) and (back | Bitmap(20)) == got


def test_exact_scores_beyond_64_bits(spark):
    big = 3_000_000_019
    rows = [("x", 1, "a", 7 * big), ("x", 1, "b", 9 * big), ("x", 1, "c", big), ("x", 2, "a b", 5 * big), ("x", 2, "b c", big),
            ("x", 3, "a b c", big - 1), ("x", 0, None, 20 * big)]
    phrases = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    got = {r["phrase"]: (r["a"], r["l"], r["r"], r["score"]) for r in C.score_phrases(phrases).collect()}
    f = {p: n for _, _, p, n in rows}
    for p, parts in (("a b", [("a", "b")]), ("b c", [("b", "c")]), ("a b c", [("a", "b c"), ("a b", "c")])):
        s, _, left, right = min((1_000_000 * f[p] ** 2 // (f[x] * f[y]), k, x, y) for k, (x, y) in enumerate(parts))
        assert got[p] == (f[p], f[left], f[right], s)
    kept = {r["phrase"] for r in C.drop_contained(C.score_phrases(phrases), phrases).collect()}
    assert kept == {"a b", "a b c"}


def test_ties_go_by_bytes_and_empty_tables(spark):
    texts = ["p q"] * 10 + ["é q"] * 10 + ["Z q"] * 10
    got = rows_of(C.collocations(docs(spark, texts).withColumns({"shard": F.lit(1), "a.b": F.lit(2), "size": F.lit(3)})))
    assert [r[2] for r in got] == ["p q", "z q", "é q"] and [r[1] for r in got] == [1, 2, 3]
    assert C.collocations(docs(spark, [])).collect() == []
    assert C.collocations(docs(spark, [None, "", "..."])).collect() == []
    assert len(texts_of(spark)) == 200
