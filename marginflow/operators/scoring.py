"""Kernel sums and decision values (K4, K5, M1-M7).

The reference's decision value is an all-pairs product: every scored row
against every support row.  Here it is a narrow Arrow map: the support block
is collected once (after a size check) and broadcast; each task scores its
own batches with one GEMM per slice.  No join, no shuffle, no pair rows.

If the support table exceeds the broadcast budget, identical rows are merged
and the sum becomes a grid of tiles (``tiled_kernel_sum``): rows are dealt
into blocks of the budget's size, every block gets a copy of the support
rows, one shuffle brings them together sorted by (block, rows first), and a
task holds one block while the support streams past it in Arrow batches,
each batch a tile whose partial sums are added in place.  Every row is
written once and shuffled once; nothing of the support reaches the driver.
For the linear kernel the support collapses to one weight vector computed by
a distributed aggregate (T13), and scoring is a per-row dot product.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.functions.kernels import block_kernel_sum, check_kernel, dot
from marginflow.session import shared_table

DEFAULT_BROADCAST_BYTES = 64 << 20


def arrow_matrix(column: pa.Array, d: int | None = None) -> np.ndarray:
    """LIST<DOUBLE> Arrow column -> dense (rows x d) float64 matrix.

    Every row must have the same length, and no value may be NULL or NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("feature vectors must not be NULL")
    n = len(column)
    if n == 0:
        return np.zeros((0, d or 0))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    width = int(lengths[0]) if d is None else d
    if (lengths != width).any():
        raise ValueError(f"feature vectors differ in length: {sorted(set(lengths.tolist()))[:5]}")
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("feature values must not be NULL")
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if np.isnan(values).any():
        raise ValueError("feature values must not be NaN")
    return values.reshape(n, width)


@dataclass
class BasisStats:
    rows: int
    dim: int

    @property
    def bytes(self) -> int:
        return self.rows * (self.dim + 2) * 8


def basis_stats(basis: DataFrame, x_col: str = "x") -> BasisStats:
    """Row count and (checked) vector width of a basis table, one job."""
    r = basis.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(x_col)).alias("lo"),
                  F.max(F.size(x_col)).alias("hi")).first()
    if r["n"] and r["lo"] != r["hi"]:
        raise ValueError(f"basis vectors differ in length ({r['lo']} .. {r['hi']})")
    return BasisStats(int(r["n"]), int(r["hi"] or 0))


def _collect_block(block: DataFrame, x_col: str, coef_col: str):
    tbl = block.select(F.col(x_col).alias("x"), F.col(coef_col).cast("double").alias("c")).toArrow()
    S = arrow_matrix(tbl.column("x"))
    coef = tbl.column("c").to_numpy().astype(np.float64)
    return S, coef


def _add_kernel_sum(df: DataFrame, bc, out_col: str, x_col: str, kernel: str,
                    gamma: float, scale_col: str | None) -> DataFrame:
    """One Arrow map that adds the kernel sum over a broadcast block."""
    fields = df.schema.fields
    at = {f.name: i for i, f in enumerate(fields)}
    own = [f"c{i}" for i in range(len(fields))]      # by position: names may hold dots
    schema = T.StructType([T.StructField(c, f.dataType, f.nullable) for f, c in zip(fields, own)]
                          + [T.StructField("out", T.DoubleType(), False)])

    def run(batches):
        S, coef, center = bc.value
        for batch in batches:
            X = arrow_matrix(batch.column(at[x_col]), S.shape[1])
            part = block_kernel_sum(X, S, coef, kernel, gamma, center)
            if scale_col is not None:
                part = part * batch.column(at[scale_col]).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.float64())], names=schema.names)

    return df.toDF(*own).mapInArrow(run, schema).toDF(*[f.name for f in fields], out_col)


def tiled_kernel_sum(df: DataFrame, basis: DataFrame, out_col: str, kernel: str, gamma: float, x_col: str,
                     scale_col: str | None, dim: int, block_bytes: int) -> DataFrame:
    """``out_col`` = [scale *] sum_j c_j K(x_j, x) for a basis (x, c) of any size.

    Tiles of row blocks (about ``block_bytes`` of vectors, held in memory)
    and Arrow batches of the basis; the shuffle carries the rows once and the
    basis once a block.  Block numbers come from the written table's row
    numbers, so identical rows spread evenly and a repeated task deals alike."""
    fields = df.schema.fields
    own = [f"c{i}" for i in range(len(fields))]
    at = {f.name: i for i, f in enumerate(fields)}
    numbered = shared_table(df.select(*[F.col(f"`{f.name}`").alias(c) for f, c in zip(fields, own)],
                                      F.monotonically_increasing_id().alias("row")), "tile-rows")
    blocks = max(1, math.ceil(numbered.count() * (dim + 2) * 8 / block_bytes))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    rows = numbered.select(block.alias("block"), F.lit(0).alias("kind"), *own,
                           F.lit(None).cast("array<double>").alias("bx"), F.lit(None).cast("double").alias("bc"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    copies = basis.select(every.alias("block"), F.lit(1).alias("kind"),
                          *[F.lit(None).cast(f.dataType).alias(c) for f, c in zip(fields, own)],
                          F.col("x").cast("array<double>").alias("bx"), F.col("c").cast("double").alias("bc"))
    grid = rows.unionByName(copies).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "kind")
    schema = T.StructType([T.StructField(c, f.dataType, True) for f, c in zip(fields, own)]
                          + [T.StructField("out", T.DoubleType(), False)])
    first, x_at = 2, 2 + at[x_col]

    def run(batches):
        held, X, sums, center, current = [], None, None, None, None

        def scored():
            done = 0
            for part in held:
                share = sums[done:done + len(part)] if X is not None else np.zeros(len(part))
                done += len(part)
                if scale_col is not None:
                    share = share * part.column(first + at[scale_col]).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [part.column(first + i) for i in range(len(own))] + [pa.array(share, pa.float64())],
                    names=schema.names)

        for batch in batches:
            number, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            edges = [0, *cuts.tolist(), len(number)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if number[lo] != current:
                    yield from scored()
                    held, X, sums, current = [], None, None, number[lo]
                part = batch.slice(lo, hi - lo)
                if kind[lo] == 0:
                    held.append(part)
                elif held:
                    if X is None:
                        X = np.concatenate([arrow_matrix(p.column(x_at), dim) for p in held])
                        sums, center = np.zeros(len(X)), X.mean(axis=0)
                    S = arrow_matrix(part.column(first + len(own)), dim)
                    coef = part.column(first + len(own) + 1).to_numpy(zero_copy_only=False)
                    sums += block_kernel_sum(X, S, coef, kernel, gamma, center)
        yield from scored()

    return grid.mapInArrow(run, schema).toDF(*[f.name for f in fields], out_col)


def _shared_block(df: DataFrame, S: np.ndarray, coef: np.ndarray, kernel: str):
    center = S.mean(axis=0) if (kernel != "linear" and len(S)) else None
    return df.sparkSession.sparkContext.broadcast((S, coef, center))


def kernel_sum(df: DataFrame, basis: DataFrame, coef_col: str, out_col: str,
               kernel: str = "rbf", gamma: float = 0.5, x_col: str = "x",
               basis_x_col: str = "x", scale_col: str | None = None,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Add ``out_col = [scale *] sum_j coef_j K(basis_x_j, x)`` to every row of df.

    The basis is counted first.  One that fits ``max_broadcast_bytes`` is
    broadcast; a larger one meets the rows in tiles, with the same result.
    """
    check_kernel(kernel)
    if out_col in df.columns:
        raise ValueError(f"column {out_col!r} is already there")
    stats = basis_stats(basis, basis_x_col)
    if stats.rows == 0:
        return df.withColumn(out_col, F.lit(0.0))
    if stats.bytes <= max_broadcast_bytes:
        bc = _shared_block(df, *_collect_block(basis, basis_x_col, coef_col), kernel)
        return _add_kernel_sum(df, bc, out_col, x_col, kernel, gamma, scale_col)
    # identical basis vectors first become one: their coefficients add
    merged = shared_table(basis.groupBy(F.col(basis_x_col).alias("x")).agg(
        F.sum(coef_col).alias("c")), "basis")
    return tiled_kernel_sum(df, merged, out_col, kernel, gamma, x_col, scale_col, stats.dim, max_broadcast_bytes)


# --------------------------------------------------------------------------
# linear kernel: weight vector by a distributed aggregate
# --------------------------------------------------------------------------

def linear_weights(support: DataFrame, coef: str = "coef", x_col: str = "x") -> DataFrame:
    """W_k = sum_i coef_i x_ik as (pos, w) rows.

    posexplode + groupBy(pos): map-side partial sums, so each task ships at
    most d rows to the shuffle whatever the row count.
    """
    return (support.select(F.col(coef).alias("_c"), F.posexplode(x_col).alias("pos", "v"))
            .groupBy("pos").agg(F.sum(F.col("_c") * F.col("v")).alias("w")))


def weights_array(weights: DataFrame) -> F.Column:
    """(pos, w) rows -> one ARRAY<DOUBLE> as a scalar subquery (d values)."""
    arr = weights.agg(F.array_sort(F.collect_list(F.struct("pos", "w"))).alias("s")) \
        .select(F.transform("s", lambda e: e["w"]).alias("w"))
    return arr.scalar()


def linear_score(df: DataFrame, weights: DataFrame, b: float, x_col: str = "x",
                 out_col: str = "score") -> DataFrame:
    """score = W.x - b (M1, with the inner product the reference intended)."""
    bound = df.withColumn("_w", weights_array(weights))
    return bound.withColumn(out_col, dot(x_col, "_w") - F.lit(float(b))).drop("_w")


def literal_linear_score(df: DataFrame, w: list, b: float, x_col: str = "x",
                         out_col: str = "score") -> DataFrame:
    """score = sum_i x[i] * w_i - b with W held as d literals: a plain sum of
    products that stays in generated code (no lambda, no subquery).  A vector
    of another length raises."""
    terms = [F.col(x_col)[i] * F.lit(float(v)) for i, v in enumerate(w)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return df.withColumn(out_col, F.when(F.size(x_col) == len(w), total - F.lit(float(b))).otherwise(
        F.raise_error(F.lit(f"feature vectors must have {len(w)} values"))))


# --------------------------------------------------------------------------
# fitted kernel model
# --------------------------------------------------------------------------

@dataclass
class KernelModel:
    """Support table (x, y, alpha[, mult]) + header; f(x) = sum a y K - b."""

    support: DataFrame
    b: float
    kernel: str = "rbf"
    gamma: float = 0.5
    c: float = 1.0
    tol: float = 1e-3
    info: dict = field(default_factory=dict)
    weights: list | None = None     # linear models whose W is already on the driver
    block: tuple | None = None      # (support vectors, coefficients) already on the driver

    def coef_table(self) -> DataFrame:
        mult = F.col("mult") if "mult" in self.support.columns else F.lit(1.0)
        return self.support.select("x", (F.col("alpha") * F.col("y") * mult).alias("coef"))

    def decision(self, df: DataFrame, x_col: str = "x", out_col: str = "score",
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
        """Add the decision value f(x) (K4)."""
        if self.kernel == "linear" and self.weights is not None:
            return literal_linear_score(df, self.weights, self.b, x_col, out_col)
        if self.kernel == "linear":
            w = linear_weights(self.coef_table(), "coef")
            return linear_score(df, w, self.b, x_col, out_col)
        if self.block is not None:
            scored = _add_kernel_sum(df, _shared_block(df, *self.block, self.kernel), "_ksum", x_col,
                                     self.kernel, self.gamma, None)
        else:
            scored = kernel_sum(df, self.coef_table(), "coef", "_ksum", self.kernel, self.gamma,
                                x_col=x_col, max_broadcast_bytes=max_broadcast_bytes)
        return scored.withColumn(out_col, F.col("_ksum") - F.lit(float(self.b))).drop("_ksum")

    def transform(self, df: DataFrame, x_col: str = "x", y: F.Column | None = None) -> DataFrame:
        """Score and 0/1 prediction (M2, M4); with the true ``y`` (-1, 1) also
        the decision error f(x) - y (K5)."""
        out = predict_label(self.decision(df, x_col))
        return out if y is None else prediction_error(out, y=y)

    def header(self) -> DataFrame:
        spark = self.support.sparkSession
        return spark.createDataFrame(
            [(self.kernel, float(self.gamma), float(self.c), float(self.b), float(self.tol))],
            "kernel string, gamma double, c double, b double, tol double")

    def save(self, path: str) -> None:
        self.support.write.mode("overwrite").parquet(f"{path}/support")
        self.header().write.mode("overwrite").parquet(f"{path}/header")

    @classmethod
    def load(cls, spark, path: str) -> "KernelModel":
        h = spark.read.parquet(f"{path}/header").first()
        return cls(spark.read.parquet(f"{path}/support"), h["b"], h["kernel"],
                   h["gamma"], h["c"], h["tol"])


def predict_label(df: DataFrame, score: str = "score", out: str = "prediction") -> DataFrame:
    """score > 0 -> 1.0, otherwise 0.0 (M2); NULL for a NULL or NaN score."""
    v = F.nanvl(F.col(score), F.lit(None).cast("double"))
    return df.withColumn(out, F.when(v > 0, F.lit(1.0)).when(v <= 0, F.lit(0.0)))


def prediction_error(df: DataFrame, score: str = "score", y: str | F.Column = "y",
                     out: str = "error") -> DataFrame:
    """E = f(x) - y (K5)."""
    return df.withColumn(out, F.col(score) - (F.col(y) if isinstance(y, str) else y))
