"""Best-fit packing of documents into token sequences of a fixed capacity.

Method: pieces above one third of the capacity go at most two to a sequence,
paired by greedy matching (largest with the largest that still fits, which
gives the most pairs); smaller pieces then go by decreasing length into the
smallest gap that holds them, a new sequence only if none does.

A piece is an integer length no larger than the capacity, so the corpus is
described exactly by one count per length.  Spark counts, the driver plans
over at most ``capacity`` counts, and every piece finds its place from its
length and its rank among the pieces of that length.  Ranks come from counts
per write task, so no group of equal lengths ever meets in one task.

Edge cases: a null text is an empty one (one end token); a null id is carried
along; repeated rows are packed as often as they occur; an empty table gives
an empty result; other columns of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.llm.common import text_slices, write_table
from marginflow.llm.tokens import WordEncoder, vocabulary_path

CAPACITY = 2048
#: Rows of the per-task rank offsets that are broadcast (24 bytes each);
#: a larger table is joined by a shuffle instead.
BROADCAST_OFFSETS = 1_000_000


def token_pieces(docs: DataFrame, capacity: int, end_id: int, vocabulary: str,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: (id, piece, start, length, ids,
    chunk, rank).  ``ids`` are little-endian uint32 bytes; ``rank`` numbers
    the pieces of one length within one task (``chunk``)."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("chunk", T.IntegerType()),
        T.StructField("rank", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext
        chunk, seen, enc = TaskContext.get().partitionId(), {}, WordEncoder(vocabulary)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for lo, _, texts in text_slices(batch.column(1)):
                src, piece, length, ids, rank = [], [], [], [], []
                part = enc.encode_batch([t or "" for t in texts])
                for row, raw in enumerate(part, lo):
                    wide = np.frombuffer(raw, enc.dtype).astype("<u4").tobytes() + end
                    for k in range(0, len(wide) // 4, capacity):
                        one = wide[4 * k:4 * (k + capacity)]
                        n = len(one) // 4
                        src.append(row)
                        piece.append(k // capacity)
                        length.append(n)
                        ids.append(one)
                        rank.append(seen.get(n, 0))
                        seen[n] = rank[-1] + 1
                piece_a = pa.array(piece, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(src, pa.int64())), piece_a,
                    pa.array([p * capacity for p in piece], pa.int64()), pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()), pa.array([chunk] * len(src), pa.int32()),
                    pa.array(rank, pa.int64())], names=[f.name for f in schema])

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def plan_packing(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Places for ``counts[length]`` pieces of every length.

    Returns runs (length, first rank, first sequence, pieces per sequence,
    offset) in which rank r goes to sequence first + (r - first rank) // per,
    and the number of sequences.  Work and output depend on the capacity, not
    on the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    placed: dict[int, int] = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    open_gaps, sequences = 0, 0  # bit g: there is a sequence with gap g

    def place(n: int, first: int, bins: int, per: int, offset: int) -> None:
        runs.append((n, placed[n], first, per, offset))
        placed[n] += bins * per
        left[n] -= bins * per

    def free(gap: int, first: int, bins: int) -> None:
        nonlocal open_gaps
        if gap and bins:
            gaps[gap].append((first, bins))
            open_gaps |= 1 << gap

    for a in sorted((n for n in left if 3 * n > capacity), reverse=True):
        while left[a]:
            b = next((b for b in range(min(a, capacity - a), capacity // 3, -1)
                      if left.get(b, 0) > (b == a)), 0)
            pairs = (left[a] // 2 if a == b else min(left[a], left[b])) if b else left[a]
            place(a, sequences, pairs, 1, 0)
            if b:
                place(b, sequences, pairs, 1, a)
            free(capacity - a - b, sequences, pairs)
            sequences += pairs

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            fits = open_gaps >> n
            if not fits:
                bins = -(-left[n] // (capacity // n))
                free(capacity, sequences, bins)
                sequences += bins
                continue
            gap = (fits & -fits).bit_length() - 1 + n
            first, bins = gaps[gap].pop()
            per = min(gap // n, left[n])
            take = min(bins, left[n] // per)
            place(n, first, take, per, capacity - gap)
            if take < bins:
                gaps[gap].append((first + take, bins - take))
            if not gaps[gap]:
                open_gaps &= ~(1 << gap)
            free(gap - per * n, first, take)
    return runs, sequences


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, vocabulary: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document; one row per piece with its ids and its place.

    Result: (id_col, piece, start, length, ids, sequence_id, offset).
    """
    spark = docs.sparkSession
    pieces = write_table(token_pieces(docs, capacity, end_id, vocabulary or vocabulary_path(),
                                      id_col, text_col), "pieces")
    per_chunk = write_table(pieces.groupBy("chunk", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in per_chunk.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan_packing(counts, capacity)

    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select("chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    if per_chunk.count() <= BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)

    import numpy as np
    runs.sort()
    table = spark.sparkContext.broadcast(np.asarray(runs, np.int64).reshape(-1, 5))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd
        t = table.value
        n, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        # runs are sorted by (length, first rank); search both as one key
        span = np.int64(1 << 50)
        at = np.searchsorted(t[:, 0] * span + t[:, 1], n * span + r, side="right") - 1
        k = r - t[at, 1]
        return pd.DataFrame({"sequence_id": t[at, 2] + k // t[at, 3],
                             "offset": t[at, 4] + (k % t[at, 3]) * n})

    return (pieces.join(offsets, ["chunk", "length"])
            .withColumn("at", place("length", F.col("rank") + F.col("before")))
            .select(F.col("id").alias(id_col), "piece", "start", "length", "ids", "at.sequence_id", "at.offset"))
