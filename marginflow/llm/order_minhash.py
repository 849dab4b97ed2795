"""Document fingerprints by Order MinHash, DataFrame functions only.

The k-mers of a text are all its windows of ``K`` characters, one from every
character on, whatever the text's length or script (a text shorter than that
is one k-mer itself).  Equal k-mers are told apart by the number of their
occurrence.  A k-mer's 64-bit hash deals it to one of ``SKETCH`` buckets by
its last bits and ranks it there by the rest, equal ones by their occurrence
number (one-permutation hashing).  The ``PICK`` least of each bucket are put
back into text order and hashed as a tuple: one signature.  A moved or
inserted passage changes the order or the members, so equal signatures follow
edit distance and not only shared words; a character put in or taken out
changes the windows over it, ``K`` at most, and no other.

Likeness: the share of equal signatures among buckets filled in either text,
to the power 1/PICK (a tuple is equal if all its members are).

Everything is array arithmetic within a row.  Long texts are cut into
``PART`` characters, so that only hashes of the whole text are held.  Hashes
are sorted as plain numbers, the bucket in the first bits.  Of long texts,
those of low rank are sorted first: the rank under which ``EXPECT`` members of
each bucket are expected.  If these fill all buckets with ``PICK`` they hold
the least of all; if not, all are sorted, so every k-mer counts.

Edge cases: a null text is an empty one; empty texts are alike; equal texts
have equal fingerprints; texts of little more than ``K`` characters have but a
few windows, so one character may halve their likeness; repeated rows each
get a row; an empty table gives an empty result.  Null document ids sort first.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.llm.common import column, range_buckets

#: Characters of a k-mer, and those that one may begin with: all.
K = 8
ANCHOR = r"(?s:.)"
PICK = 2
SKETCH = 64
#: Members expected in a bucket after the cut by rank.
EXPECT = 10
#: Characters from which windows are taken at a time.
PART = 65536
ROWS_PER_BUCKET = 1024
_BITS = SKETCH.bit_length() - 1


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _turned(hashes: Column) -> Column:
    """Hashes with the bucket moved to the first bits: in their order as
    numbers a bucket's members stand together, by rank."""
    return F.transform(hashes, lambda g: F.shiftleft(g, 64 - _BITS).bitwiseOR(F.shiftrightunsigned(g, _BITS)))


def _bucket(turned: Column) -> Column:
    return F.shiftrightunsigned(turned, 64 - _BITS)


def _least(turned: Column) -> Column:
    """The ``PICK`` least of each filled bucket, bucket by bucket; equal k-mers
    as often as they occur."""
    return let(F.sort_array(turned), lambda s: F.filter(
        s, lambda t, j: (j < PICK) | (_bucket(t) != _bucket(F.get(s, j - PICK)))))


def window_hashes(text: Column) -> Column:
    """Hashes of all the text's windows of ``K`` characters, in order."""
    each = F.lit(rf"(?s)(?=({'.' * K})).")

    def of_part(part: Column) -> Column:
        return F.transform(F.regexp_extract_all(part, each, F.lit(1)), lambda w: F.xxhash64(w))

    last = F.floor(F.greatest(F.length(text) - K, F.lit(0)) / PART).cast("int")
    return F.when(F.length(text) < K + PART, of_part(text)).otherwise(F.flatten(F.transform(
        F.sequence(F.lit(0), last), lambda j: of_part(F.substring(text, j * PART + 1, F.lit(PART + K - 1))))))


def or_whole(windows: Column, text: Column) -> Column:
    """K-mer hashes: those of the windows, or that of the text if it has none."""
    return F.when(F.size(windows) == 0, F.array(F.xxhash64(text))).otherwise(windows)


def edited_windows(own: Column, text: Column, kept: Column, added: Column) -> Column:
    """``window_hashes`` of the first ``kept`` characters of ``text`` and then
    ``added``, given those of ``text``: the windows within the first part are
    the text's own, only those that reach into the second are new."""
    over = F.least(kept, F.lit(K - 1))
    inside = F.greatest(kept - (K - 1), F.lit(0))
    end = F.concat(F.substring(text, kept - over + 1, over), added)
    return F.concat(F.slice(own, F.lit(1), inside), window_hashes(end))


def signatures_of(hashes: Column) -> Column:
    """Array of ``SKETCH`` 32-bit signatures of k-mer hashes; null for an empty bucket."""
    def tuples(turned: Column, least: Column) -> Column:
        """Bucket -> hash of its picked ranks, by their first place in the text."""
        return let(F.array_intersect(turned, least), lambda order: let(
            F.filter(F.sequence(F.lit(0), F.size(least) - 1),
                     lambda j: (j == 0) | (_bucket(F.get(least, j)) != _bucket(F.get(least, j - 1)))),
            lambda firsts: F.map_from_entries(F.transform(firsts, lambda f, q: let(
                F.slice(least, f + 1, F.coalesce(F.get(firsts, q + 1), F.size(least)) - f), lambda b: F.struct(
                    _bucket(F.get(b, F.lit(0))).alias("k"), F.xxhash64(F.transform(
                        F.array_sort(F.transform(b, lambda t: F.struct(
                            F.array_position(order, t).alias("p"), t.bitwiseAND((1 << (64 - _BITS)) - 1).alias("r")))),
                        lambda m: m["r"])).bitwiseAND(0xFFFFFFFF).alias("v")))))))

    def spread(found: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(SKETCH - 1)), lambda i: F.element_at(found, i.cast("long")))

    def of(h: Column) -> Column:
        n = F.size(h)
        limit = (F.lit(float(1 << (64 - _BITS))) * EXPECT * SKETCH / n).cast("long")
        every = let(_turned(h), lambda t: let(_least(t), lambda few: tuples(t, few)))
        low = let(limit, lambda most: _turned(F.filter(h, lambda g: F.shiftrightunsigned(g, _BITS) < most)))
        return F.when(n <= EXPECT * SKETCH, every).otherwise(let(low, lambda t: let(_least(t), lambda few: F.when(
            F.size(few) == PICK * SKETCH, tuples(t, few)).otherwise(every))))

    return let(hashes, lambda h: let(of(h), spread))


def signatures(text: Column) -> Column:
    return signatures_of(let(window_hashes(text), lambda h: or_whole(h, text)))


def fingerprint(sigs: Column) -> Column:
    """Signatures as text: eight hex digits each, dashes for an empty bucket."""
    return F.concat_ws("", F.transform(sigs, lambda s: F.coalesce(F.lower(F.lpad(F.hex(s), 8, "0")),
                                                                  F.lit("--------"))))


def likeness(a: Column, b: Column) -> Column:
    """0 (no signature in common) to 1 (all)."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: F.coalesce(e, F.lit(False))))
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.isNotNull() | y.isNotNull()), lambda e: e))
    return F.pow(same / either, F.lit(1.0 / PICK))


def with_next(docs: DataFrame, id_col: str, columns: list[str], tie: str) -> DataFrame:
    """Adds ``next_<column>`` of the next row by ascending integer id (ties by
    ``tie``; after the last row: the first).

    Rows are dealt by ranges of the id, and the first rows of each range are
    dealt to the range before it too: one shuffle, no global sort.
    """
    bucket, n = range_buckets(docs, id_col, ROWS_PER_BUCKET)
    rows = docs.withColumn("__bucket", bucket)
    firsts = {r["__bucket"]: r["first"]["id"] for r in rows.groupBy("__bucket").agg(
        F.min(F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("id"))).alias("first")).collect()}
    filled = sorted(firsts)
    before = {b: filled[i - 1] for i, b in enumerate(filled)}

    def table(values) -> Column:
        return F.from_json(F.lit(json.dumps(values)), "array<bigint>")

    every = range(max(filled, default=0) + 1)
    first = F.get(table([firsts.get(b) for b in every]), F.col("__bucket"))
    target = F.get(table([before.get(b) for b in every]), F.col("__bucket")).cast("int")
    at = F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("extra")),
                 F.when(F.col(id_col).eqNullSafe(first), F.struct(target.alias("b"), F.lit(True).alias("extra"))))
    dealt = rows.withColumn("__at", F.explode(F.filter(at, lambda a: a.isNotNull())))
    order = Window.partitionBy("__at.b").orderBy("__at.extra", F.col(id_col).asc_nulls_first(), tie)
    return dealt.select(*docs.columns, "__at", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]) \
                .filter("not __at.extra").drop("__at")


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, tie, sigs) for every row; a null text becomes an empty one."""
    rows = texts_of(docs, id_col, text_col)
    return rows.select("*", signatures(F.col("text")).alias("sigs"))


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, tie) for every row; a null text becomes an empty one."""
    text = F.coalesce(column(text_col), F.lit(""))
    return docs.select(column(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("tie"))


def sketch_with_edit(rows: DataFrame) -> DataFrame:
    """(id, tie, n, edited_sha256, sigs, edited_sigs) of rows (id, text, tie,
    next_text): the text's signatures, and those of the text whose last
    quarter gives way to as much of the next text's beginning.  The k-mers
    that both have are hashed once."""
    n = F.length("text")
    kept = n - F.floor(n / 4).cast("int")
    added = F.substring("next_text", F.lit(1), n - kept)
    edited = F.concat(F.substring("text", F.lit(1), kept), added)
    both = let(window_hashes(F.col("text")), lambda h: F.struct(
        signatures_of(or_whole(h, F.col("text"))).alias("own"),
        signatures_of(let(edited_windows(h, F.col("text"), kept, added), lambda e: or_whole(e, edited))).alias("edited")))
    return rows.select("id", "tie", n.cast("long").alias("n"),
                       F.sha2(edited, 256).alias("edited_sha256"),
                       both.alias("s")).select("id", "tie", "n", "edited_sha256", F.col("s.own").alias("sigs"),
                                               F.col("s.edited").alias("edited_sigs"))
