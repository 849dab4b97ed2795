"""SimHash near-duplicates by multi-index hashing.

Fingerprint: words between ASCII white space, A-Z lowered, 3-word shingles
with repeats, XXH64 of each; a bit is set if it is set in over half of them.

Links at ``max_bits`` = 3 or fewer differing bits: of two 32-bit halves one
differs in at most one bit.  Distinct fingerprints are filed under both
halves; each probes, for either half, its own value and the values with one
zero bit set (the partner with that bit set is then found by the other), and
complete distances are verified.  A half shared by more than ``HOT``
fingerprints would give too many pairs; there each member files all 64-bit
points within two bits (its neighbours by one bit of that half: within two
bits, that bit included), and all at a point are linked to one that lies
within a single bit of it.  Two fingerprints at three bits or fewer always
meet at such a point, and none is linked beyond three bits, so components
are exact and rows grow in proportion to the group.

Edge cases: no words (null, empty, blank): fingerprint zero, linked like any
other; fewer words than a shingle: the whole sequence is one; repeated rows
each get a row; null ids are ignored when the least id of a component is
taken (null if it has no other); an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.llm.common import map_texts, write_table
from marginflow.llm.graph import connected_components

SHINGLE = 3
MAX_BITS = 3
#: Fingerprints that share a half before points replace pairs.
HOT = 256
#: Hot halves that are broadcast (16 bytes each); more are joined by shuffles.
BROADCAST_HALVES = 1_000_000

_LOW = (1 << 32) - 1


def _simhash(shingle: int):
    """Task-side function: texts -> signed 64-bit fingerprints."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh64_digest

    def one(text: str | None) -> bytes:
        words = text.encode().lower().split() if text else []
        if not words:
            return bytes(8)
        line = b" ".join(words)
        if len(words) <= shingle:
            return xxh64_digest(line, 42)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *stops[:len(words) - shingle].tolist()]
        ends = (stops[shingle - 1:] - 1).tolist()
        raw = b"".join([xxh64_digest(line[s:e], 42) for s, e in zip(starts, ends)])
        n = len(ends)
        rows = np.frombuffer(raw, np.uint8).reshape(n, 8)
        votes = np.zeros(64, np.int64)
        for at in range(0, n, 8192):
            votes += np.unpackbits(rows[at:at + 8192], axis=1).sum(axis=0, dtype=np.int32)
        return np.packbits(2 * votes > n).tobytes()

    def run(texts):
        return [pa.array(np.frombuffer(b"".join(map(one, texts)), ">i8").astype(np.int64))]
    return run


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE, text_col: str = "text",
                 name: str = "fp") -> DataFrame:
    """``keep`` columns and the fingerprint as a signed 64-bit integer."""
    return map_texts(docs, text_col, keep, [T.StructField(name, T.LongType())], lambda: _simhash(shingle))


def close_pairs(fps: DataFrame) -> DataFrame:
    """(a, b) links among distinct 64-bit ``fps(fp)``: each within three bits,
    and together connecting all that are linked by such distances."""
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(_LOW))
    halves = fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), high.alias("key"), low.alias("rest")),
        F.struct(F.lit(1).alias("seg"), low.alias("key"), high.alias("rest")))).alias("h")) \
        .select("fp", "h.seg", "h.key", "h.rest")
    hot = write_table(halves.groupBy("seg", "key").count().filter(F.col("count") > HOT).select("seg", "key"), "hot")
    if hot.count() <= BROADCAST_HALVES:
        hot = F.broadcast(hot)

    bits = F.array(*[F.lit(1 << i) for i in range(32)])
    free = F.filter(bits, lambda m: F.col("key").bitwiseAND(m) == 0)
    flipped = halves.select("fp", "seg", "rest", F.explode(
        F.transform(free, lambda m: F.col("key").bitwiseOR(m))).alias("key"))

    table = halves.join(hot, ["seg", "key"], "left_anti").select("seg", "key", F.col("fp").alias("b"))
    probes = halves.select("seg", "key", F.col("fp").alias("a")).unionByName(
        flipped.select("seg", "key", F.col("fp").alias("a"))).join(hot, ["seg", "key"], "left_anti")
    pairs = probes.join(table, ["seg", "key"]).filter(
        (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS) & (F.col("a") != F.col("b"))).select("a", "b")

    near = [0] + [1 << i for i in range(32)]
    ball = near + [(1 << i) | (1 << j) for i, j in combinations(range(32), 2)]
    point = F.when(F.col("seg") == 0, F.shiftleft("key", 32).bitwiseOR(F.col("z"))) \
             .otherwise(F.shiftleft("z", 32).bitwiseOR(F.col("key")))

    def points(rows: DataFrame, masks: list[int]) -> DataFrame:
        around = F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: F.col("rest").bitwiseXOR(m))
        return rows.join(hot, ["seg", "key"], "left_semi") \
                   .withColumn("z", F.explode(around)).select(point.alias("p"), "fp")

    at = points(halves, ball).unionByName(points(flipped, near)) \
        .withColumn("r", F.bit_count(F.col("fp").bitwiseXOR(F.col("p"))))
    # at most 2081 fingerprints lie within two bits of a point
    met = at.groupBy("p").agg(F.min(F.struct("r", "fp")).alias("c"), F.collect_set("fp").alias("fps")) \
            .filter((F.col("c.r") <= 1) & (F.size("fps") > 1))
    stars = met.select(F.col("c.fp").alias("a"), F.explode("fps").alias("b")).filter(
        (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS) & (F.col("a") != F.col("b")))
    return pairs.unionByName(stars)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id_col, fp, fingerprint, component_id) for every row of ``docs``."""
    prints = write_table(fingerprints(docs, [id_col], shingle, text_col), "fingerprints")
    of_print = _least_of_component(prints, F.min(id_col)).withColumnRenamed("least", "component_id")
    return prints.join(of_print, "fp").select(
        id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _least_of_component(prints: DataFrame, least: Column) -> DataFrame:
    """(fp, least) for every fingerprint of ``prints``: the least value, by the
    aggregate ``least``, of all rows in its component."""
    distinct = write_table(prints.groupBy("fp").agg(least.alias("least")), "distinct-fingerprints")
    roots = connected_components(close_pairs(distinct.select("fp")))
    rooted = write_table(distinct.join(roots, distinct.fp == roots.node, "left")
                         .select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    smallest = write_table(rooted.groupBy("root").agg(F.min("least").alias("least")), "components")
    return write_table(rooted.select("fp", "root").join(smallest, "root").select("fp", "least"), "component-of")


def surplus_rows(docs: DataFrame, row_col: str, order: list[str], shingle: int = SHINGLE,
                 text_col: str = "text") -> DataFrame:
    """(row_col) of all rows but one of each component: the first by the
    ``order`` columns (nulls last), then by ``row_col``, which is unique and
    not null."""
    prints = write_table(fingerprints(docs, [row_col, *order], shingle, text_col), "fingerprints")
    place = [x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]
    kept = _least_of_component(prints, F.min(F.struct(*place, F.col(row_col).alias("kept")))) \
        .select("fp", "least.kept")
    return prints.join(kept, "fp").filter(F.col(row_col) != F.col("kept")).select(row_col)
