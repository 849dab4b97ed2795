"""Phrase collocation mining by dynamic itemset counting.

Method: the texts are dealt into shards, which are scanned one after the
other, round and round.  Words are counted from the first scan on.  As soon
as both subphrases of a longer phrase (all words but the last, all but the
first) have reached the threshold in the shards seen so far, the phrase
becomes active and is counted from the next scan on, next to the shorter
ones, until it has been through every shard once; scanning ends when no
phrase of any length is under way.

A scan is an Arrow map over one shard that counts active phrases by 40-bit
hashes and writes them per task and hash range as packed blobs of about three
bytes a phrase.  Which phrases have reached the threshold is one merge of the
running cycle's blobs, range by range (``reached``); it is kept as a bitmap of
``2^filter_bits`` bits per length (``FILTER_BITS``: 8 MB, whatever the corpus),
which is what the next scans' tasks get.  Bits only ever appear, and a phrase
is active from the first scan after both its subphrases' bits are there, so
every phrase goes through each shard exactly once; phrases sharing a hash or
a bit cost counting and are never missed.  A last pass counts the phrases
whose own bit is set by their words, in packed blobs per hash range again, and
those below the threshold go.

Scores use decimals of 38 digits: exact for counts up to 10^15.

Edge cases: a null text is an empty one; a null lang is ``und``; words can be
of any length; repeated rows count as often as they occur; equal scores are
ranked by count, then by the phrase's bytes; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.bitmaps import Bitmap
from marginflow.llm.common import column, share, text_slices, write_table

# fixed values of the contract: what ends a piece, and what parts words
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
THRESHOLD = 10
MAX_WORDS = 3
TOP = 2000
#: Shards that the texts are dealt into.
SHARDS = 2
#: Bits of an activity filter (a power of two).
FILTER_BITS = 26
#: Counts that a task holds before it passes them on.
TASK_COUNTS = 3_000_000
#: Bits of the hashes by which phrases are counted.
HASH_BITS = 40
#: Parts in which each lang's best phrases are first sought.
PARTS = 16


#: Bytes of text that a task cuts into words at a time.
PART_BYTES = 4_000_000
#: Number of the mark that ends a piece.
BREAK = 0


class PhraseCounter:
    """Numbers the words of a task's texts and counts phrases of them."""

    BITS = 21     # of a word's number; three fit into 63

    def __init__(self, sizes: list[int]):
        upper = bytes(range(65, 91))
        self.sizes = sizes
        self.table = bytes.maketrans(upper + PIECE_ENDS + BLANKS,
                                     upper.lower() + b"\n" * len(PIECE_ENDS) + b" " * len(BLANKS))
        self._reset()

    def _reset(self):
        import numpy as np
        self.number: dict[str, dict[bytes, int]] = {}
        self.words: list[bytes] = [b"\n"]
        self.langs: list[str] = [""]
        self.hash = np.zeros(1, np.uint64)
        self.held = {k: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for k in self.sizes}

    @property
    def full(self) -> bool:
        return len(self.words) > 1_500_000 or sum(len(h[0]) for h in self.held.values()) > TASK_COUNTS

    def add(self, lang: str, texts: list[bytes]):
        """Count the texts of one lang; gives what is counted when that is much."""
        # a text ends where a piece ends; the marks are words of their own
        data = b"\n".join(texts).translate(self.table).replace(b"\n", b" \n ")
        at, before = 0, []
        while at < len(data):
            stop = data.find(b" ", at + PART_BYTES)
            stop = len(data) if stop < 0 else stop
            words = [*before, *filter(None, data[at:stop].split(b" "))]
            self._count(self._numbers(lang, words), len(before))
            # a phrase may go on in the next part
            at, before = stop, words[len(words) - max(self.sizes) + 1:]
            if self.full:
                yield from self.take()

    def _numbers(self, lang: str, words: list[bytes]):
        import numpy as np
        import xxhash
        known = self.number.setdefault(lang, {b"\n": BREAK})
        new = list(set(words).difference(known))
        if new:
            base, seed = len(self.words), xxhash.xxh32_intdigest(lang)
            known.update(zip(new, range(base, base + len(new))))
            self.words += new
            self.langs += [lang] * len(new)
            self.hash = np.concatenate([self.hash, np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in new),
                                                               np.uint64, len(new))])
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _count(self, ids, counted: int) -> None:
        """Phrases that end after the first ``counted`` of these words."""
        import numpy as np
        h, ok = self.hash[ids], ids != BREAK
        one_h, one_ok = h, ok
        for k in range(1, max(self.sizes) + 1):
            shorter = h
            if k > 1:
                # the phrase of k words from that of k - 1 and its next word
                ok = ok[:-1] & one_ok[k - 1:]
                h = mix(h[:-1], one_h[k - 1:])
            if k in self.sizes:
                take = ok & self.active(k, shorter, h)
                take[:max(0, counted - k + 1)] = False
                at = np.flatnonzero(take)
                self._add(k, *np.unique(self.key(k, ids, h, at), return_counts=True))

    def _add(self, k, key, n) -> None:
        import numpy as np
        old_key, old_n = self.held[k]
        if len(old_key):
            key, where = np.unique(np.concatenate([old_key, key]), return_inverse=True)
            n = np.bincount(where, np.concatenate([old_n, n]), len(key)).astype(np.int64)
        self.held[k] = (key, n)


class ActiveCounter(PhraseCounter):
    """Counts by hash the phrases whose subphrases have both reached the
    threshold, but not a whole cycle ago."""

    def __init__(self, sizes, now, before, parts: int):
        super().__init__(sizes)
        self.now, self.before, self.parts = now, before, parts

    def active(self, k, shorter, h):
        if k == 1:
            return True
        both = inside(self.now[k - 1], shorter)
        return both if self.before[k - 1] is None else both & ~inside(self.before[k - 1], shorter)

    def key(self, k, ids, h, at):
        return short(h[at])

    def take(self):
        """(size, part, counts): the counts of a range of hashes; then forgets them."""
        import numpy as np
        import pyarrow as pa
        for k, (key, n) in self.held.items():
            edges = np.searchsorted(key, np.arange(self.parts + 1) * ((1 << HASH_BITS) // self.parts))
            some = [p for p in range(self.parts) if edges[p] < edges[p + 1]]
            if some:
                blobs = [packed(key[edges[p]:edges[p + 1]], n[edges[p]:edges[p + 1]]) for p in some]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k] * len(some), pa.int32()), pa.array(some, pa.int32()), pa.array(blobs, pa.binary())],
                    names=["size", "part", "counts"])
        self._reset()


class FrequentCounter(PhraseCounter):
    """Counts by their words the phrases whose bit is set, and all words."""

    def __init__(self, sizes, filters, parts: int):
        super().__init__(sizes)
        self.filters, self.parts = filters, parts
        self.total: dict[str, int] = {}

    def active(self, k, shorter, h):
        return set_for(self.filters[k], h)

    def key(self, k, ids, h, at):
        code = ids[at]
        for i in range(1, k):
            code = code << self.BITS | ids[at + i]
        return code

    def _count(self, ids, counted):
        import numpy as np
        super()._count(ids, counted)
        words = ids[counted:]
        words = words[words != BREAK]
        if len(words):
            lang = self.langs[int(words[0])]
            self.total[lang] = self.total.get(lang, 0) + len(np.atleast_1d(words))

    def take(self):
        """(part, lang, size, phrases, counts); then forgets them.  Phrases of
        one part, in order, parted by line ends; size 0: a lang's words."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import zstandard
        press = zstandard.ZstdCompressor(level=3).compress
        words = pa.array(self.words, pa.binary())
        langs = pa.array(self.langs).dictionary_encode()
        lang_of, names = langs.indices.to_numpy(), langs.dictionary.to_pylist()
        mask = (1 << self.BITS) - 1
        out = []
        for k, (code, n) in self.held.items():
            if not len(code):
                continue
            each = [(code >> (self.BITS * i)) & mask for i in reversed(range(k))]
            h = self.hash[each[0]]
            for e in each[1:]:
                h = mix(h, self.hash[e])
            phrase = words.take(pa.array(each[0]))
            if k > 1:
                phrase = pc.binary_join_element_wise(*[words.take(pa.array(e)) for e in each], pa.scalar(b" "))
            group = (short(h) // ((1 << HASH_BITS) // self.parts)) * len(names) + lang_of[each[0]]
            order = pc.sort_indices(pa.table({"g": group, "p": phrase}), [("g", "ascending"), ("p", "ascending")]).to_numpy()
            group, n = group[order], n[order]
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])).tolist()
            for lo, hi in zip(edges, edges[1:]):
                part = phrase.take(pa.array(order[lo:hi])).to_pylist()
                out.append((int(group[lo]) // len(names), names[int(group[lo]) % len(names)], k,
                            press(b"\n".join(part)), press(n[lo:hi].astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())))
        out += [(0, lang, 0, b"", press(np.array([n], "<u8").tobytes())) for lang, n in self.total.items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()))],
                names=["part", "lang", "size", "phrases", "counts"])
        self.total = {}
        self._reset()


def add_up(threshold: int):
    """Merges one part's phrases and counts of all tasks."""
    def run(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import zstandard
        plain = zstandard.ZstdDecompressor().decompress
        found: dict[tuple, list] = {}
        for r in table.select(["lang", "size", "phrases", "counts"]).to_pylist():
            n = np.frombuffer(plain(r["counts"]), np.uint8).reshape(8, -1)
            n = np.ascontiguousarray(n.T).view("<i8")[:, 0]
            phrases = plain(r["phrases"]).decode().split("\n") if r["size"] else [None]
            found.setdefault((r["lang"], r["size"]), []).append(pa.table(
                {"phrase": pa.array(phrases, pa.string()), "n": pa.array(n)}))
        out = []
        for (lang, size), tables in found.items():
            one = pa.concat_tables(tables).group_by("phrase").aggregate([("n", "sum")])
            if size:
                one = one.filter(pc.greater_equal(one.column("n_sum"), threshold))
            out.append(pa.table({"lang": pa.array([lang] * len(one), pa.string()), "size": pa.array([size] * len(one), pa.int32()),
                                 "phrase": one.column("phrase").combine_chunks(), "n": one.column("n_sum").combine_chunks()}))
        return pa.concat_tables(out)
    return run


def packed(key, n) -> bytes:
    """Rising keys and their counts in little room."""
    import numpy as np
    import zstandard
    steps = np.diff(key, prepend=0).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    # byte by byte of all steps, the rare high ones together
    raw = np.ascontiguousarray(steps.T).tobytes() + n.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpacked(blob: bytes):
    import numpy as np
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(13, -1)
    wide = np.zeros((raw.shape[1], 8), np.uint8)
    wide[:, :5] = raw[:5].T
    return np.cumsum(wide.view("<u8")[:, 0].astype(np.int64)), \
        np.ascontiguousarray(raw[5:].T).view("<u8")[:, 0].astype(np.int64)


def set_for(bitmap: Bitmap, h):
    """Whether the phrases of these hashes have reached the threshold, by the hashes' first bits."""
    import numpy as np
    return bitmap.has((h >> np.uint64(64 - bitmap.bits)).astype(np.int64))


def inside(bitmap: Bitmap, h):
    """Whether both of two neighbouring phrases have reached the threshold."""
    has = set_for(bitmap, h)
    return has[:-1] & has[1:]


def mix(left, right):
    """Hash of a phrase from that of its first words and that of its last."""
    import numpy as np
    h = (left ^ (right + np.uint64(0x9E3779B97F4A7C15) + (left << np.uint64(6)) + (left >> np.uint64(2))))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def short(h):
    """The bits of a hash that are compared between tasks."""
    import numpy as np
    return (h >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _map_texts(table: DataFrame, make, schema) -> DataFrame:
    """``make()``'s counter over the (lang, text) rows of every task."""
    def run(batches):
        counter = make()
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lo, hi, texts in text_slices(batch.column(1)):
                by_lang: dict[str, list[bytes]] = {}
                for lang, t in zip(langs[lo:hi], texts):
                    if t:
                        by_lang.setdefault(lang, []).append(t.encode())
                for lang, part in by_lang.items():
                    yield from counter.add(lang, part)
        yield from counter.take()

    return table.select("lang", "text").mapInArrow(run, schema)


def scan(shard: DataFrame, sizes: list[int], now: dict, before: dict, parts: int) -> DataFrame:
    """(size, part, counts) per task of one shard (lang, text)."""
    given = share(shard.sparkSession, (now, before))
    return _map_texts(shard, lambda: ActiveCounter(sizes, *given(), parts), "size int, part int, counts binary")


def reached(rows: DataFrame, threshold: int, bits: int, parts: int) -> Bitmap:
    """The bitmap of the hashes that come to the threshold in blobs of counts.
    Ranges of hashes are ranges of the bitmap: 2^bits bits reach the driver."""
    import numpy as np

    def merge(table):
        import pyarrow as pa
        keys, sums = zip(*map(unpacked, table.column("counts").to_pylist()))
        keys, sums = np.concatenate(keys), np.concatenate(sums)
        order = np.argsort(keys, kind="stable")
        keys, sums = keys[order], sums[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        cell = np.unique(keys[first][np.add.reduceat(sums, first) >= threshold] >> (HASH_BITS - bits))
        word, at = np.unique(cell >> 6, return_index=True)
        held = np.bitwise_or.reduceat(np.uint64(1) << (cell & 63).astype(np.uint64), at) if len(at) else at.astype(np.uint64)
        return pa.table({"word": pa.array([word.astype("<i8").tobytes()], pa.binary()),
                         "held": pa.array([held.astype("<u8").tobytes()], pa.binary())})

    out = np.zeros(1 << (bits - 6), np.uint64)
    for r in rows.groupBy("part").applyInArrow(merge, "word binary, held binary").collect():
        # two ranges may share a word where there are more ranges than words
        np.bitwise_or.at(out, np.frombuffer(r["word"], "<i8"), np.frombuffer(r["held"], "<u8"))
    return Bitmap(bits, out)


def count_phrases(docs: DataFrame, max_words: int = MAX_WORDS, threshold: int = THRESHOLD, shards: int = SHARDS,
                  filter_bits: int = FILTER_BITS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, size, phrase, n): all phrases of up to ``max_words`` words that
    occur at least ``threshold`` times in their lang, and, of size 0, every
    lang's number of words (phrase: null)."""
    if not 1 <= max_words <= 3:
        raise ValueError("phrases of one to three words are counted")
    dealt = docs.select(F.coalesce(column(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        column(text_col).alias("text"))
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")
    dealt = write_table(dealt.withColumn("shard", shard), "shards", "shard")
    # ranges of hashes: as many as a scan has tasks, so that each merges about what a task has counted
    parts = 1 << max(5, (dealt.rdd.getNumPartitions() // shards).bit_length())

    empty = Bitmap(filter_bits)
    history = {k: [] for k in range(1, max_words + 1)}      # the filter after each scan
    scans: list[tuple[list[int], DataFrame]] = []

    def after(k, step):
        return history[k][step] if step >= 0 else empty

    step = 0
    while True:
        # a length is under way if a filter of its subphrases grew during the last cycle
        sizes = [1] if step < shards else []
        sizes += [k for k in range(2, max_words + 1)
                  if after(k - 1, step - 1) != after(k - 1, step - 1 - shards)]
        if not sizes:
            break
        now = {k - 1: after(k - 1, step - 1) for k in sizes if k > 1}
        before = {k: after(k, step - 1 - shards) if step > shards else None for k in now}
        counted = scan(dealt.filter(F.col("shard") == step % shards), sizes, now, before, parts)
        scans.append((sizes, write_table(counted, "scan")))
        for k in history:
            bitmap = after(k, step - 1)
            if k in sizes:
                cycle = [t.filter(F.col("size") == k) for some, t in scans[max(0, step - shards + 1):] if k in some]
                bitmap = bitmap | reached(union(cycle), threshold, filter_bits, parts)
            history[k].append(bitmap)
        step += 1

    filters = share(docs.sparkSession, {k: after(k, step - 1) for k in history})
    counted = _map_texts(dealt, lambda: FrequentCounter(list(history), filters(), parts),
                         "part int, lang string, size int, phrases binary, counts binary")
    return write_table(counted.groupBy("part").applyInArrow(
        add_up(threshold), "lang string, size int, phrase string, n long"), "phrases")


def union(tables: list[DataFrame]) -> DataFrame | None:
    out = None
    for t in tables:
        out = t if out is None else out.unionByName(t)
    return out


def score_phrases(phrases: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, size, phrase, a, l, r, score) of every phrase of two or more
    words of ``count_phrases``: the lowest score floor(10^6 a^2 / (l r)) over
    its cuts into two parts, the first such cut at ties."""
    def part(lo, hi):
        return F.array_join(F.slice("words", lo, hi), " ")

    known = phrases.filter("size > 0")
    cut = known.filter("size > 1").withColumn("words", F.split("phrase", " ")).withColumn("k", F.explode(
        F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select("lang", "size", part(F.lit(1), F.col("k")).alias("first"),
                     part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"), F.col("n").alias("a"))
    for name, n in (("first", "l"), ("rest", "r")):
        of = known.filter(F.col("size") < max_words).select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
        cut = cut.join(of, ["lang", name])
    big = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    top = (big["a"] * big["a"]).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    cut = cut.select("lang", "size", F.concat_ws(" ", "first", "rest").alias("phrase"), "a", "l", "r",
                     F.size(F.split("first", " ")).alias("k"), top.alias("top"), (big["l"] * big["r"]).alias("bottom"))
    cut = cut.withColumn("score", F.expr("cast(top div bottom as bigint)")).drop("top", "bottom")
    # two words have one cut
    long = cut.filter("size > 2").groupBy("lang", "size", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    result = ["lang", "size", "phrase", "a"]
    return cut.filter("size = 2").select(*result, "l", "r", "score").unionByName(
        long.select(*result, "best.l", "best.r", "best.score"))


def drop_contained(scored: DataFrame, phrases: DataFrame, percent: int = 50, max_words: int = MAX_WORDS) -> DataFrame:
    """Without the phrases that lie inside a longer one of which there are at
    least ``percent`` % as many."""
    longer = phrases.filter("size > 2").withColumn("words", F.split("phrase", " "))
    inside = longer.select("lang", "size", "n", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("k")) \
        .select("lang", "n", "words", "k", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)).alias("i")) \
        .select("lang", F.array_join(F.slice("words", F.col("i"), F.col("k")), " ").alias("phrase"), "n") \
        .groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    # nothing is longer than the longest
    out = scored.filter(F.col("size") < max_words).join(inside, ["lang", "phrase"], "left")
    out = out.filter(~(F.coalesce(F.col("most"), F.lit(0)) * 100 >= F.col("a") * percent)).drop("most")
    return out.unionByName(scored.filter(F.col("size") >= max_words))


def best_of_each(scored: DataFrame, top: int = TOP, parts: int = PARTS) -> DataFrame:
    """The first ``top`` phrases of each lang, ranked.  Each lang is first
    ranked in parts, so no task gets more than ``parts`` x ``top`` rows."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    some = scored.withColumn("part", part) \
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "score")


def collocations(docs: DataFrame, top: int = TOP, percent: int = 50, max_words: int = MAX_WORDS,
                 **settings) -> DataFrame:
    """Each lang's best phrases of two and more words: (lang, rank, phrase, a,
    l, r, n, score).  ``settings`` go to ``count_phrases``."""
    phrases = count_phrases(docs, max_words, **settings)
    best = best_of_each(drop_contained(score_phrases(phrases, max_words), phrases, percent, max_words), top)
    total = phrases.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
