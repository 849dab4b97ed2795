"""Row preparation: target split, min-max scaling, class index, one-hot.

Statistics (min, max, class list) are one-row or K-row aggregates used as
scalar subqueries, so every operator stays a single lazy plan: one
partial+final aggregate, then a narrow projection.  Nothing grows with the
row count on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed value: a decoded one-hot slot counts as set at this score
ONE_HOT_THRESHOLD = 0.5


def target_split(df: DataFrame, values_col: str, target_index: int,
                 label_col: str = "label", features_col: str = "x") -> DataFrame:
    """values -> (label = values[t], features = values without slot t).

    The reference keeps the target and drops its left neighbour; this drops
    exactly the target (SURVEY Q1).
    """
    t = int(target_index)
    if t < 0:
        raise ValueError("target index must be >= 0")
    arr = F.col(values_col)
    return df.withColumn(label_col, F.element_at(arr, t + 1)) \
             .withColumn(features_col, F.filter(arr, lambda v, i: i != F.lit(t)))


def global_minmax(df: DataFrame, x_col: str = "x") -> DataFrame:
    """One (mn, mx) row over every cell of the array column."""
    return df.agg(F.min(F.array_min(x_col)).alias("mn"), F.max(F.array_max(x_col)).alias("mx"))


def _safe_scale(v: Column, lo: Column, hi: Column) -> Column:
    # constant data: range 0 -> 0.0 instead of 0/0
    return F.coalesce((v - lo) / F.nullif(hi - lo, F.lit(0.0)), F.lit(0.0))


def scale_global(df: DataFrame, x_col: str = "x", stats: DataFrame | None = None,
                 out_col: str | None = None) -> DataFrame:
    """(x - min) / (max - min) with ONE range for the whole table.

    ``stats`` lets a test table reuse the training range.
    """
    stats = stats if stats is not None else global_minmax(df, x_col)
    # one scalar subquery for the statistics row (one aggregate pass), bound
    # to columns first because lambdas cannot hold subqueries
    st = stats.select(F.struct("mn", "mx")).scalar()
    bound = df.withColumn("_lo", st["mn"]).withColumn("_hi", st["mx"])
    return bound.withColumn(out_col or x_col, F.transform(
        x_col, lambda v: _safe_scale(v, F.col("_lo"), F.col("_hi")))).drop("_lo", "_hi")


def column_minmax(df: DataFrame, x_col: str) -> DataFrame:
    """Per-position (mins, maxs) arrays: one vector aggregate with map-side
    partial results, no row for an empty table."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    vectors = df.select(array_to_vector(F.col(x_col).cast("array<double>")).alias("v"))
    return vectors.groupBy().agg(Summarizer.metrics("min", "max").summary(F.col("v")).alias("s")) \
                  .select(vector_to_array("s.min").alias("mins"), vector_to_array("s.max").alias("maxs"))


def scale_per_column(df: DataFrame, x_col: str, stats: DataFrame | None = None,
                     out_col: str | None = None) -> DataFrame:
    """Standard per-column min-max scaling of an array column."""
    stats = stats if stats is not None else column_minmax(df, x_col)
    st = stats.select(F.struct("mins", "maxs")).scalar()
    return scale_with(df.withColumn("_lo", st["mins"]).withColumn("_hi", st["maxs"]),
                      x_col, F.col("_lo"), F.col("_hi"), out_col).drop("_lo", "_hi")


def scale_with(df: DataFrame, x_col: str, lo: Column, hi: Column, out_col: str | None = None) -> DataFrame:
    """Per-column scaling with given arrays of minima and maxima."""
    return df.withColumn(out_col or x_col, F.transform(
        x_col, lambda v, i: _safe_scale(v, F.element_at(lo, i + 1), F.element_at(hi, i + 1))))


def class_count(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Number of distinct labels."""
    return df.agg(F.count_distinct(label_col).alias("n_classes"))


def class_list(df: DataFrame, label_col: str = "label") -> DataFrame:
    """One row ``classes``: the distinct labels in order.  A NULL label raises.

    K values in one row; a one-hot row has as many."""
    seen = df.groupBy(label_col).agg(F.lit(1).alias("_one"))
    return seen.agg(F.when(F.max(F.col(label_col).isNull()), F.raise_error(F.lit(f"NULL label in {label_col!r}")))
                    .otherwise(F.array_sort(F.collect_list(label_col))).alias("classes"))


def one_hot(df: DataFrame, label_col: str = "label", classes: DataFrame | None = None,
            out_col: str = "onehot") -> DataFrame:
    """label -> K-slot 0/1 array, slot i = class i (P5, SURVEY Q5); all 0 for
    a label that is not among ``classes`` (a ``class_list``)."""
    known = (classes if classes is not None else class_list(df, label_col)).select("classes").scalar()
    return df.withColumn("_classes", known).withColumn(out_col, F.transform(
        "_classes", lambda c: F.when(c == F.col(label_col), F.lit(1.0)).otherwise(F.lit(0.0)))).drop("_classes")


def one_hot_decode(col: Column | str, threshold: float = ONE_HOT_THRESHOLD) -> Column:
    """Index of the LAST slot >= threshold, else 0 (P6, as the reference)."""
    c = F.col(col) if isinstance(col, str) else col
    hits = F.filter(F.transform(c, lambda v, i: F.when(v >= F.lit(threshold), i)),
                    lambda e: e.isNotNull())
    return F.coalesce(F.array_max(hits), F.lit(0))
