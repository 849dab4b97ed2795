"""Benchmark decontamination by a prefix-filtered set join.

Every window of consecutive item words (an item of fewer words is one
window) is a set of five-word shingles, or one shorter shingle if the window
is shorter.  Containment must be complete, so one shingle of each window is a
sufficient prefix: the rarest over all documents.  A document shingle that
equals it fixes where the window would start; windows that would not lie
inside the document are dropped (length and positional bounds), and the rest
is verified word by word.

The benchmark is taken in blocks of bounded text; each block's index is
broadcast and the documents pass by it in a narrow Arrow map.  The work per
block is one pass to count the block's shingles and one to match.

Edge cases: a null text has no words and is clean; a null or wordless item
matches nothing; items with one id count once, a null id reads as an empty
string; ties in rarity go to the earlier shingle; repeated document rows each get a row; empty tables are fine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.llm.common import fresh, map_texts, share, write_table

WINDOW = 10
SHINGLE = 5
#: Characters of benchmark text indexed and broadcast at once (some 300,000
#: windows, 150 MB as Python objects).
BLOCK_CHARS = 2_000_000

#: Word bytes: ASCII letters and digits and everything outside ASCII.
_TABLE = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words (A-Z only), as UTF-8 bytes."""
    return text.encode().translate(_TABLE).split() if text else []


class WindowIndex:
    """Vocabulary, windows and shingles of one benchmark block."""

    def __init__(self, items: list[tuple], window: int, shingle: int):
        import numpy as np
        self.shingle = shingle
        self.vocab: dict[bytes, int] = {}
        self.windows: dict[tuple[int, ...], list[str]] = {}
        for item_id, text in items:
            ids = tuple(self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(text))
            seen = set(ids[i:i + window] for i in range(max(1, len(ids) - window + 1))) if ids else ()
            for w in seen:
                self.windows.setdefault(w, []).append(item_id)
        self.sizes = sorted({min(shingle, len(w)) for w in self.windows})
        keys = {n: set() for n in self.sizes}
        for w in self.windows:
            n = min(shingle, len(w))
            keys[n].update(w[i:i + n] for i in range(len(w) - n + 1))
        #: per shingle length: the sorted hashes of all shingles
        self.hashes = {n: np.unique(self.hash_rows(np.asarray(list(k), np.uint64))) for n, k in keys.items()}

    @staticmethod
    def hash_rows(rows):
        """64-bit hash of each row of word ids."""
        import numpy as np
        h = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            h = (h + rows[:, j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def ids(self, text: str | None):
        """Word ids of a text, 0 for words that no item has; and their number."""
        import numpy as np
        from itertools import repeat
        ws = words(text)
        return np.fromiter(map(self.vocab.get, ws, repeat(0)), np.int64, len(ws))

    def at(self, ids, n: int):
        """Positions and hashes of the n-word shingles made of item words."""
        import numpy as np
        if len(ids) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        ok = ids > 0
        full = ok[:len(ids) - n + 1].copy()
        for j in range(1, n):
            full &= ok[j:len(ids) - n + 1 + j]
        pos = np.flatnonzero(full)
        rows = ids[pos[:, None] + np.arange(n)].astype(np.uint64)
        return pos, self.hash_rows(rows)

    def found(self, ids, n: int, hashes):
        """Positions of shingles in ``hashes`` (sorted), and their places there."""
        import numpy as np
        pos, h = self.at(ids, n)
        if not len(pos) or not len(hashes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        hit = hashes[k] == h
        return pos[hit], k[hit]

    def choose_prefixes(self, frequency: dict[tuple[int, int], int]) -> None:
        """Keep of each window its rarest shingle: hash -> (window, offset)."""
        import numpy as np
        self.prefix: dict[int, dict[int, list[tuple]]] = {n: {} for n in self.sizes}
        for w, items in self.windows.items():
            n = min(self.shingle, len(w))
            rows = np.asarray([w[i:i + n] for i in range(len(w) - n + 1)], np.uint64)
            hs = self.hash_rows(rows).tolist()
            off = min(range(len(hs)), key=lambda i: (frequency.get((n, hs[i]), 0), i))
            self.prefix[n].setdefault(hs[off], []).append((np.asarray(w, np.int64), off, items))
        del self.windows, self.hashes  # what matching does not need is not sent
        self.prefix_hashes = {n: np.asarray(sorted(p), np.uint64) for n, p in self.prefix.items()}

    def match(self, ids):
        """(start, length) of every window that occurs, and its items."""
        import numpy as np
        spans, items = [], set()
        for n in self.sizes:
            keys = self.prefix_hashes[n]
            pos, k = self.found(ids, n, keys)
            for key in np.unique(k):
                where = pos[k == key]
                for w, off, owners in self.prefix[n][int(keys[key])]:
                    start = where - off
                    start = start[(start >= 0) & (start + len(w) <= len(ids))]
                    if len(start):
                        start = start[(ids[start[:, None] + np.arange(len(w))] == w).all(axis=1)]
                    if len(start):
                        spans.append((start, len(w)))
                        items.update(owners)
        return spans, items


def _count_shingles(docs: DataFrame, index, text_col: str) -> dict[tuple[int, int], int]:
    """Documents that have each of the block's shingles, over all documents."""
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("h", T.LongType()),
                           T.StructField("docs", T.LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa
        ix = index()
        total = {n: np.zeros(len(ix.hashes[n]), np.int64) for n in ix.sizes}
        for batch in batches:
            for text in batch.column(0):
                ids = ix.ids(text.as_py())
                for n in ix.sizes:
                    total[n][np.unique(ix.found(ids, n, ix.hashes[n])[1])] += 1
        for n, t in total.items():
            k = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(k), n, np.int32)), pa.array(ix.hashes[n][k].view(np.int64)),
                pa.array(t[k])], names=["n", "h", "docs"])

    rows = docs.select(F.col(f"`{text_col}`")).mapInArrow(run, schema).groupBy("n", "h").agg(F.sum("docs").alias("docs"))
    return {(r["n"], r["h"] & 0xFFFFFFFFFFFFFFFF): r["docs"] for r in rows.collect()}


def _match(docs: DataFrame, index, keep: list[str], text_col: str, found: str) -> DataFrame:
    """Adds the block's findings: a struct of words, hit words (as merged
    spans of word positions) and item ids."""
    kind = T.StructType([
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                         T.StructField("stop", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType()))])

    def make():
        import numpy as np
        import pyarrow as pa
        ix = index()
        span_t = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        out_t = pa.struct([("n_words", pa.int64()), ("spans", span_t), ("items", pa.list_(pa.string()))])

        def run(texts):
            rows = []
            for t in texts:
                ids = ix.ids(t)
                found, items = ix.match(ids)
                spans = []
                if found:
                    edge = np.zeros(len(ids) + 1, np.int64)
                    for start, n in found:
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + n, -1)
                    hit = np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]]).astype(np.int8)
                    step = np.diff(hit)
                    spans = [{"start": a, "stop": b} for a, b in
                             zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())]
                rows.append({"n_words": len(ids), "spans": spans, "items": sorted(items)})
            return [pa.array(rows, out_t)]
        return run

    return map_texts(docs, text_col, keep, [T.StructField(found, kind)], make)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  keep: list[str] | None = None, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The kept columns (default: all) and n_words, n_hit, n_items, item_ids
    (as strings, sorted), hit_spans (merged word positions, stop exclusive)
    and contaminated.  A kept column of one of these names gives way."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    size = benchmark.agg(F.sum(F.length(item_text))).first()[0] or 0
    blocks = -(-size // block_chars) or 1
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")) \
        .filter("text is not null")
    if blocks > 1:
        items = write_table(items.withColumn("block", (F.rand(7) * blocks).cast("int")), "benchmark")
    out, parts = docs, []
    for b in range(blocks):
        own = items.filter(F.col("block") == b) if blocks > 1 else items
        index = WindowIndex([(r["id"], r["text"]) for r in own.select("id", "text").collect()], window, shingle)
        counts = _count_shingles(docs, share(spark, index), text_col)
        index.choose_prefixes(counts)
        last = b == blocks - 1
        name, = fresh(out, f"found{b}")
        carry = list(dict.fromkeys([*keep, *parts, *([] if last else [text_col])]))
        out = _match(out, share(spark, index), carry, text_col, name)
        parts.append(name)

    if blocks > 1:  # the same word may be hit by windows of several blocks
        positions = F.array_distinct(F.flatten(F.array(*[
            F.flatten(F.transform(F.col(f"{p}.spans"), lambda s: F.sequence(s.start, s.stop - 1))) for p in parts])))
        out = out.withColumn(parts[0], F.col(parts[0]).withField("hits", F.sort_array(positions)))
        merged = F.col(f"{parts[0]}.hits")
        n_hit = F.size(merged).cast("long")
        starts = F.filter(merged, lambda x, i: F.coalesce(F.get(merged, i - 1) != x - 1, F.lit(True)))
        stops = F.filter(merged, lambda x, i: F.coalesce(F.get(merged, i + 1) != x + 1, F.lit(True)))
        spans = F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("stop")))
        ids = F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(f"{p}.items") for p in parts]))))
    else:
        spans, ids = F.col(f"{parts[0]}.spans"), F.col(f"{parts[0]}.items")
        n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + s.stop - s.start)
    new = {"n_words": F.col(f"{parts[0]}.n_words"), "n_hit": n_hit, "n_items": F.size(ids).cast("long"),
           "item_ids": ids, "hit_spans": spans, "contaminated": n_hit > 0}
    return out.select(*[F.col(f"`{c}`") for c in keep if c.lower() not in new], *[v.alias(k) for k, v in new.items()])
