"""URL filter rules by Bloom filter cascades, DataFrame functions only.

A rule is (host, path, verdict): it fits its host and all subdomains if the
path starts with the rule's; the longest fitting rule wins.  Every url gives
the keys that could be rules: its host suffixes of the label counts that
rules have, each with the path prefixes of the lengths that rules have.  All
distinct keys of the corpus are the key universe.  For each verdict a cascade
is built over it: level 1 is a Bloom filter of the listed keys, level 2 one
of the universe's keys that level 1 takes wrongly, level 3 one of the listed
keys that level 2 takes, and so on until no false positive is left.  On the
universe the cascade then answers exactly, and urls are judged row by row
with the filters' bits as constants of the plan: no join.

A level's bits are sized by its key count and may take at most ``MAX_BITS``;
a larger list is split by key hash into shards, each with a cascade of its
own over its share of the universe.

Edge cases: a null url or one without ``://`` has empty host and path and no
keys, so it gets the default verdict; rules with a null host or path are
dropped, repeated rules count once; a key listed under both verdicts is a
block; of equally long fitting rules the one with the longer host wins;
empty tables are fine; kept columns named like a result give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import write_table

#: Bits per key and hash functions of a level (false positives about 1 %).
BITS_PER_KEY, HASHES = 10, 7
#: Bits of one level at most (8 MB of constants).
MAX_BITS = 1 << 26
MAX_LEVELS = 40

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.length(host).cast("string"), F.lit(":"), host, path)


def candidate_keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Array of (host, path, key) for all rules that could fit, longest first."""
    n_labels = F.size(F.split(host, r"\."))
    suffixes = F.filter(F.array(*[F.when(n_labels >= n, F.substring_index(host, ".", -n)) for n in labels]),
                        lambda h: h.isNotNull() & (h != ""))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
                        lambda p: p.isNotNull())
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(
        (-F.length(h) - F.length(p)).alias("size"), (-F.length(h)).alias("host_size"),
        rule_key(h, p).alias("key"), F.concat(h, p).alias("rule")))))
    return F.array_sort(pairs)


def _positions(key: Column, level: int, n_bits: int) -> Column:
    """The key's bit positions: double hashing over one 64-bit hash pair."""
    a, b = (F.pmod(F.xxhash64(key, F.lit(2 * level + i)), F.lit(n_bits)) for i in range(2))
    return F.array(*[F.pmod(a + F.lit(i) * b, F.lit(n_bits)) for i in range(HASHES)])


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))


def _filter_bits(keys: DataFrame, level: int) -> list[int]:
    """A level's Bloom filter as 64-bit words, aggregated on the executors."""
    n = keys.count()
    n_words = max(1, -(-n * BITS_PER_KEY // 64))
    words = dict.fromkeys(range(n_words), 0)
    bit = keys.select(F.explode(_positions(F.col("key"), level, 64 * n_words)).alias("at"))
    set_bits = bit.groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.bit_or(_bit(F.col("at"))).alias("bits"))
    for r in set_bits.collect():  # at most MAX_BITS / 64 words
        words[r["word"]] = r["bits"]
    return [words[i] for i in range(n_words)]


def _passes(key: Column, level: int, words: list[int]) -> Column:
    table = F.array(*[F.lit(w).cast("long") for w in words]) if len(words) <= 64 else F.from_json(
        F.lit("[" + ",".join(map(str, words)) + "]"), "array<bigint>")
    at = _positions(key, level, 64 * len(words))
    return F.forall(at, lambda p: F.get(table, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0)


class Cascade:
    """Alternating Bloom filters: exact membership on the key universe."""

    def __init__(self, shards: list[list[list[int]]]):
        self.shards = shards

    def contains(self, key: Column) -> Column:
        def verdict(levels: list[list[int]], level: int) -> Column:
            if level == len(levels):  # past the last level: decided by its parity
                return F.lit(level % 2 == 1)
            return F.when(_passes(key, level, levels[level]), verdict(levels, level + 1)) \
                    .otherwise(F.lit(level % 2 == 1))
        shard = F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(len(self.shards)))
        out = F.lit(False)
        for i, levels in enumerate(self.shards):
            own = verdict(levels, 0) if levels else F.lit(False)
            out = own if len(self.shards) == 1 else F.when(shard == i, own).otherwise(out)
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS) -> Cascade:
    """Cascade for ``listed(key)`` that is exact on ``universe(key)``.

    Both are distinct keys.  Levels shrink by the false-positive rate, so the
    work is a few passes over the universe.
    """
    listed = write_table(listed, "listed")
    n_shards = max(1, -(-listed.count() * BITS_PER_KEY // max_bits))
    shards = []
    for i in range(n_shards):
        def own(df: DataFrame) -> DataFrame:
            return df.filter(F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(n_shards)) == i) if n_shards > 1 else df
        inside, outside, levels = own(listed), own(universe).join(own(listed), "key", "left_anti"), []
        for level in range(MAX_LEVELS):
            if not inside.head(1):
                break
            levels.append(_filter_bits(inside, level))
            wrong = write_table(outside.filter(_passes(F.col("key"), level, levels[-1])), "false-positives")
            inside, outside = wrong, inside
        else:
            raise RuntimeError(f"the cascade has not ended after {MAX_LEVELS} levels")
        shards.append(levels)
    return Cascade(shards)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url",
               keep: list[str] | None = None, max_bits: int = MAX_BITS) -> DataFrame:
    """Kept columns (default: all) and host, path, rule (host and path of the
    winning rule, else null) and verdict (``block`` or ``allow``).

    ``rules``: (host, path, verdict).  The distinct label counts of hosts and
    lengths of paths in ``rules`` are taken to the driver.
    """
    rules = rules.filter("host is not null and path is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").distinct()
    shape = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
                      F.collect_set(F.length("path")).alias("lengths")).first()
    labels, lengths = sorted(shape["labels"]), sorted(shape["lengths"])

    keep = pages.columns if keep is None else keep
    new = ("host", "path", "rule", "verdict")
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    cols = [c for c in keep if c.lower() not in new]
    if not labels:
        return pages.select(*[F.col(f"`{c}`") for c in cols], host.alias("host"), path.alias("path"),
                            F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    universe = write_table(pages.select(candidate_keys(host, path, labels, lengths).alias("c"))
                           .select(F.explode("c.key").alias("key")).distinct(), "key-universe")
    keyed = rules.select(rule_key(F.col("host"), F.col("path")).alias("key"), "verdict")
    blocked = keyed.filter("verdict = 'block'").select("key")
    allowed = keyed.filter("verdict = 'allow'").select("key").join(blocked, "key", "left_anti")
    block, allow = build_cascade(blocked, universe, max_bits), build_cascade(allowed, universe, max_bits)

    judged = F.transform("__keys", lambda k: F.struct(
        k["rule"].alias("rule"), F.when(block.contains(k["key"]), "block")
        .when(allow.contains(k["key"]), "allow").alias("verdict")))
    taken = {c.lower() for c in cols}
    assert not taken & {"__keys", "__best"}, "columns __keys and __best are used by judge_urls"
    return (pages.select(*[F.col(f"`{c}`") for c in cols], host.alias("host"), path.alias("path"))
            .withColumn("__keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
            .withColumn("__best", F.get(F.filter(judged, lambda v: v["verdict"].isNotNull()), F.lit(0)))
            .select(*[F.col(f"`{c}`") for c in cols], "host", "path", F.col("__best.rule").alias("rule"),
                    F.coalesce("__best.verdict", F.lit(default)).alias("verdict")))
