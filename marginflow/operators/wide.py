"""Linear weights and scores for vectors of any width.

Columns are cut into blocks of ``width``.  A row becomes one slice per block
in which it has a value other than 0: (row, block, at, v), offsets within the
block and values.  W is a table of blocks, never one row: tasks add up the
blocks they meet, at most ``HELD_VALUES`` numbers at a time, and a grouped
sum per block ends it.  A score joins a row's slices with the blocks of W
and adds up the partial products.  As every row may have a slice in a block,
blocks are dealt in ``salts`` copies, so no block's rows meet in one task.

Vectors are dense (one array column) or sparse (an array of distinct
0-based positions and one of values).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.operators.dual import broadcast_if_small

#: Columns of a block.
WIDTH = 4096
#: Numbers of W that a task holds before it passes them on (64 MB).
HELD_VALUES = 8 << 20
#: Rows whose slices of one block a task joins, about.
ROWS_A_TASK = 1_000_000

_SLICE = [T.StructField("block", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType(), False)),
          T.StructField("v", T.ArrayType(T.DoubleType(), False))]


def _entries(batch, first: int, sparse: bool):
    """(row, position, value) arrays of the values other than 0 of a batch."""
    lists = batch.column(first)
    if lists.null_count or (sparse and batch.column(first + 1).null_count):
        raise ValueError("feature vectors must not be NULL")
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    starts = np.cumsum(size) - size
    if sparse:
        other = batch.column(first + 1).value_lengths().to_numpy(zero_copy_only=False)
        if (other != size).any():
            raise ValueError("positions and values differ in length")
        pos, val = lists.flatten(), batch.column(first + 1).flatten()
        if pos.null_count:
            raise ValueError("positions must not be NULL")
        pos = pos.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(pos) and pos.min() < 0:
            raise ValueError("positions must be 0 or more")
    else:
        pos, val = np.arange(len(row)) - np.repeat(starts, size), lists.flatten()
    if val.null_count:
        raise ValueError("feature values must not be NULL")
    val = val.to_numpy(zero_copy_only=False).astype(np.float64)
    if np.isnan(val).any():
        raise ValueError("feature values must not be NaN")
    kept = val != 0
    row, pos, val = row[kept], pos[kept], val[kept]
    order = np.lexsort((pos, row))
    row, pos, val = row[order], pos[order], val[order]
    if sparse and len(row) > 1 and ((row[1:] == row[:-1]) & (pos[1:] == pos[:-1])).any():
        raise ValueError("positions must not repeat")
    return row, pos, val


def _vector_columns(x_col: str | tuple[str, str]) -> tuple[list[str], bool]:
    return ([x_col], False) if isinstance(x_col, str) else (list(x_col), True)


def slice_rows(df: DataFrame, id_col: str, x_col: str | tuple[str, str], width: int = WIDTH) -> DataFrame:
    """(id, block, at, v): a row per vector and block with a value other than 0."""
    cols, sparse = _vector_columns(x_col)
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), *_SLICE])

    def run(batches):
        for batch in batches:
            row, pos, val = _entries(batch, 1, sparse)
            block = pos // width
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (block[1:] != block[:-1])])) \
                if len(row) else np.zeros(0, np.int64)
            ends = pa.array(np.append(new, len(row)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row[new])), pa.array(block[new]),
                pa.ListArray.from_arrays(ends, pa.array((pos % width).astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(val))], names=schema.names)

    return df.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(cols)]) \
        .mapInArrow(run, schema)


def blocked_weights(support: DataFrame, coef: str = "coef", x_col: str | tuple[str, str] = "x",
                    width: int = WIDTH) -> DataFrame:
    """W = sum_i coef_i x_i as (block, w): arrays of ``width`` numbers; blocks
    in which no support row has a value are not there."""
    cols, sparse = _vector_columns(x_col)

    def run(batches):
        held: dict[int, np.ndarray] = {}

        def passed():
            return pa.RecordBatch.from_arrays([
                pa.array(list(held), pa.int64()), pa.array([w.tobytes() for w in held.values()], pa.binary())],
                names=["block", "w"])
        for batch in batches:
            row, pos, val = _entries(batch, 1, sparse)
            share = batch.column(0).to_numpy(zero_copy_only=False)[row] * val
            order = np.argsort(pos // width, kind="stable")
            block, at, share = (pos // width)[order], (pos % width)[order], share[order]
            edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(block) else []
            for lo, hi in zip(edges[:-1], edges[1:]):
                w = held.setdefault(int(block[lo]), np.zeros(width))
                w += np.bincount(at[lo:hi], share[lo:hi], width)
                if len(held) * width >= HELD_VALUES:
                    yield passed()
                    held.clear()
        yield passed()

    def add(table):
        total = sum(np.frombuffer(w, np.float64) for w in table.column("w").to_pylist())
        return pa.table({"block": table.column("block")[:1], "w": pa.array([total], pa.list_(pa.float64()))})

    rows = support.select(F.col(coef).cast("double").alias("c"), *[F.col(f"`{c}`").alias(f"x{i}") for i, c in enumerate(cols)])
    return rows.mapInArrow(run, "block long, w binary").groupBy("block").applyInArrow(add, "block long, w array<double>")


def blocked_score(df: DataFrame, weights: DataFrame, b: float, id_col: str = "id",
                  x_col: str | tuple[str, str] = "x", width: int = WIDTH, out_col: str = "score") -> DataFrame:
    """(id, score = W.x - b) of every row (M1); ``id_col`` must be unique.
    Rows without a value in a block of W score -b."""
    ids = df.select(F.col(f"`{id_col}`").alias("id"))
    salts = max(1, math.ceil(ids.count() / ROWS_A_TASK))
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    copies = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    slices = slice_rows(df, id_col, x_col, width).withColumn("salt", salt)
    product = F.aggregate(F.zip_with("at", "v", lambda a, v: v * F.get("w", a)), F.lit(0.0), lambda s, p: s + p)
    parts = slices.join(broadcast_if_small(copies), ["block", "salt"]).select("id", product.alias("p"))
    # a row without any slice has a zero of its own, so no join back is needed
    total = parts.unionByName(ids.select("id", F.lit(0.0).alias("p"))).groupBy("id").agg(F.sum("p").alias("s"))
    return total.select(F.col("id").alias(id_col), (F.col("s") - F.lit(float(b))).alias(out_col))
