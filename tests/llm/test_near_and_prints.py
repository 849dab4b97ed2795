"""SimHash near-duplicates (op 4), components, Order MinHash (op 10)."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from marginflow.llm import order_minhash as omh
from marginflow.llm import simhash
from marginflow.llm.graph import connected_components
from marginflow.llm.queries import QUERIES
from tests.llm.helpers import SF, docs, sha, texts_of


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    f = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= 3).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [ids[find(i)] for i in range(len(ids))]


def test_simhash_query_against_brute_force(spark):
    texts = texts_of(spark)
    ids = sorted(texts)
    prints = [brute_print(texts[i]) for i in ids]
    got = {r["doc_id"]: r for r in QUERIES["op4_simhash_near_dedup"](spark, SF).collect()}
    assert [got[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in ids] == brute_components(ids, prints)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("hot", [2, 10_000])
def test_links_of_clustered_fingerprints(spark, monkeypatch, hot):
    """Both ways, pairs and points, give the components of all links."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 6]))))
    fps = sorted(signed(p) for p in prints)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.close_pairs(df)
    assert links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 3).count() == 0
    roots = {r["node"]: r["root"] for r in connected_components(links).collect()}
    want = brute_components(fps, [f & (1 << 64) - 1 for f in fps])
    assert [roots.get(f, f) for f in fps] == want


def test_simhash_edges(spark):
    df = docs(spark, [None, "", " \t", "One two", "one TWO", "x", "x"], [5, 6, None, 8, 9, 4, 4])
    rows = simhash.near_duplicates(df.selectExpr("*", "1 AS fp", "2 AS component_id")).collect()
    got = sorted(((r["doc_id"], r["fingerprint"] == "0" * 16, r["component_id"]) for r in rows), key=str)
    assert got == sorted([(5, True, 5), (6, True, 5), (None, True, 5), (8, False, 8), (9, False, 8),
                          (4, False, 4), (4, False, 4)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chain_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 200)] + \
        [(500, 501), (501, 502), (502, 500), (7, 7)]
    df = spark.createDataFrame(random.Random(1).sample(edges, len(edges)), "a long, b long")
    roots = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert roots == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys(range(100, 300), 100),
                     **dict.fromkeys(range(500, 503), 500)}
    assert connected_components(df.limit(0)).count() == 0


def brute_picked(hashes):
    """Ranks of each bucket's least numbered k-mers in text order."""
    buckets, seen = {}, {}
    for place, h in enumerate(hashes):
        g, number = h & (1 << 64) - 1, seen.get(h, 0)
        seen[h] = number + 1
        buckets.setdefault(g & omh.SKETCH - 1, []).append((g >> 6, number, place))
    out = [None] * omh.SKETCH
    for b, members in buckets.items():
        out[b] = [r for _, r in sorted((place, rank) for rank, _, place in sorted(members)[:omh.PICK])]
    return out


def brute_signatures(spark, text):
    windows = [text[i:i + omh.K] for i in range(len(text) - omh.K + 1) if re.match(omh.ANCHOR, text[i])] or [text]
    d = spark.createDataFrame(list(enumerate(windows)), "i int, w string")
    want = brute_picked([r["h"] for r in d.select("i", F.xxhash64("w").alias("h")).orderBy("i").collect()])
    d = spark.createDataFrame([(b, m) for b, m in enumerate(want) if m], "b int, m array<long>")
    tuples = {r["b"]: r["v"] for r in d.select("b", F.xxhash64("m").bitwiseAND(0xFFFFFFFF).alias("v")).collect()}
    return [tuples.get(b) for b in range(omh.SKETCH)]


def test_signatures_against_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(40)]
    cases = ["the cat sat on the mat. " * 100, " ".join(rng.choice(vocab) for _ in range(900)),
             " ".join(f"u{i}" for i in range(700)), "short text", "aaaaaaaaaa" * 3, "", "seven77", "eight888",
             "汉字👍🏽\n" * 40 + "ab", "bcd fgh " * 30, "-" * 50]
    want = [brute_signatures(spark, t) for t in cases]
    for part in (omh.PART, 1000, 64):
        monkeypatch.setattr(omh, "PART", part)
        rows = docs(spark, cases).select("doc_id", omh.signatures(F.col("text")).alias("s")).collect()
        assert [r["s"] for r in sorted(rows)] == want


def near(spark, pairs):
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    sigs = omh.likeness(omh.signatures(F.col("a")), omh.signatures(F.col("b")))
    return [r["s"] for r in rows.select("i", sigs.alias("s")).orderBy("i").collect()]


def test_one_rule_for_texts_of_any_length(spark):
    """A text and its beginning, on either side of any length (under 16
    characters there are one to three windows, of which the last one goes)."""
    rng = random.Random(6)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(500))
    pairs = [(word[:a], word[:b]) for a, b in ((420, 390), (401, 399), (400, 398), (21, 19), (20, 19), (17, 16))]
    assert all(s > 0.8 for s in near(spark, pairs)), near(spark, pairs)


def test_one_character_more_in_unspaced_texts(spark):
    rng = random.Random(7)
    alphabets = {"chinese": [chr(rng.randrange(0x4e00, 0x9fa5)) for _ in range(800)],
                 "thai": [chr(c) for c in range(0xe01, 0xe2f)],
                 "base64": list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")}
    texts = {name: "".join(rng.choice(a) for _ in range(3000)) for name, a in alphabets.items()}
    pairs = [(t, t[:at] + "x" + t[at:]) for t in texts.values() for at in (0, 1, 1500, 3000)]
    assert all(s > 0.8 for s in near(spark, pairs)), near(spark, pairs)
    others = ["".join(rng.choice(a) for _ in range(3000)) for a in alphabets.values()]
    assert all(s < 0.2 for s in near(spark, list(zip(texts.values(), others))))


def test_order_counts_and_not_only_members(spark):
    rng = random.Random(8)
    words = [f"{rng.randrange(10 ** 6)}" for _ in range(400)]
    halves = " ".join(words[200:] + words[:200])
    moved, same = near(spark, [(" ".join(words), halves), (" ".join(words), " ".join(words))])
    assert moved < 0.85 and same == 1.0


def test_edited_hashes_are_those_of_the_edited_text(spark):
    rng = random.Random(9)
    text = "".join(rng.choice("abcé汉 ") for _ in range(90))
    rows = [(i, text[:n], text[i:i + m], k) for i, (n, m, k) in enumerate(
        [(90, 20, 68), (8, 2, 6), (3, 1, 3), (0, 0, 0), (1, 0, 1), (12, 0, 9), (9, 3, 7), (40, 5, 40), (10, 10, 0), (7, 9, 2)])]
    df = spark.createDataFrame(rows, "i int, t string, more string, kept int")
    t, kept = F.col("t"), F.col("kept")
    got = df.select(omh.edited_windows(omh.window_hashes(t), t, kept, F.col("more")).alias("a"),
                    omh.window_hashes(F.concat(F.substring(t, F.lit(1), kept), F.col("more"))).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got) and any(len(r["a"]) > 5 for r in got)


def test_fingerprint_query(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op10_order_minhash"](spark, SF).collect()}
    texts = texts_of(spark)
    ids = sorted(texts)
    assert sorted(rows) == ids
    by_text = {}
    for i, d in enumerate(ids):
        t, nxt, r = texts[d], texts[ids[(i + 1) % len(ids)]], rows[d]
        q = len(t) // 4
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), sha(t[:len(t) - q] + nxt[:q]))
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_next"] <= r["near_edited"] <= 1
        after = rows[ids[(i + 1) % len(ids)]]["fingerprint"]
        pairs = [(r["fingerprint"][j:j + 8], after[j:j + 8]) for j in range(0, len(after), 8)]
        either = [p for p in pairs if p != ("-" * 8, "-" * 8)]
        assert r["near_next"] == pytest.approx((sum(a == b for a, b in either) / len(either)) ** 0.5)
    assert np.mean([r["near_edited"] for r in rows.values()]) > 0.5


def test_next_rows_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(omh, "ROWS_PER_BUCKET", 3)
    ids = [None, None, 5, 5, *range(10, 60), 7]
    df = spark.createDataFrame([(d, f"t{i}", i) for i, d in enumerate(ids)], "id long, text string, tie long")
    rows = omh.with_next(df, "id", ["text"], "tie").collect()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, i))
    want = {f"t{a}": f"t{b}" for a, b in zip(order, order[1:] + order[:1])}
    assert {r["text"]: r["next_text"] for r in rows} == want and len(rows) == len(ids)


def test_fingerprint_edges(spark):
    s = omh.sketch(docs(spark, [None, "", "  ", "x", "x"], [1, 2, 3, None, 4]))
    got = {r["id"]: r["sigs"] for r in s.collect()}
    assert got[1] == got[2] and got[4] == got[None]
    assert omh.with_next(s.limit(0), "id", ["text"], "tie").count() == 0
    one = omh.with_next(s.filter("id = 4"), "id", ["text"], "tie").collect()
    assert [r["next_text"] for r in one] == ["x"]


def test_every_position_begins_a_window(spark):
    """Texts without vowels and digits have as many windows as any other, and a
    change of such characters shows in the signatures."""
    rng = random.Random(11)
    text = "".join(rng.choice("bcdfg \n") for _ in range(3000))
    df = spark.createDataFrame([(text,), (text[:8],), (text[:7],)], "t string")
    assert [r["n"] for r in df.select(F.size(omh.window_hashes(F.col("t"))).alias("n")).collect()] == [2993, 1, 0]
    cut, other = near(spark, [(text, text[:2900]), (text, text[::-1])])
    assert cut > 0.8 and other < 0.2
