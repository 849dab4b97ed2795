"""Evaluation as aggregates.

Every metric is a partial+final aggregate over the scored rows (or over the
K x K confusion table derived from them); no row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label (M3).

    The reference names this rate ``err`` though it counts matches; both
    readings are returned (SURVEY Q22).
    """
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy")) \
             .withColumn("error_rate", F.lit(1.0) - F.col("accuracy"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n): labels and predictions paired on one row."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")) \
             .agg(F.count(F.lit(1)).alias("n"))


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class precision, recall, F1 and the overall precision (= accuracy).

    One pass over the scored rows: each row adds (tp, 1 true) to its label's
    class and (1 predicted) to its prediction's class, then one grouped
    aggregate with map-side partial sums.  Totals come from the K
    aggregated class rows, not from a second pass over the input.
    """
    ltype = df.schema[label].dataType
    lab = F.col(label)
    pred = F.col(prediction).cast(ltype)
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    contrib = df.select(F.inline(F.array(
        F.struct(lab.alias("cls"), (lab == pred).cast("long").alias("tp"),
                 one.alias("n_true"), zero.alias("n_pred")),
        F.struct(pred.alias("cls"), zero.alias("tp"), zero.alias("n_true"), one.alias("n_pred")))))
    per = contrib.groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("n_true").alias("n_true"),
                                     F.sum("n_pred").alias("n_pred"))
    # the K class rows meet in one row for the totals
    k = per.agg(F.collect_list(F.struct("cls", "tp", "n_true", "n_pred")).alias("rows"),
                (F.sum("tp") / F.sum("n_true")).alias("overall_precision"))
    return k.select(F.explode("rows").alias("r"), "overall_precision") \
        .select("r.*", precision_of("r").alias("precision"), recall_of("r").alias("recall"), "overall_precision") \
        .withColumn("f1", F.lit(2.0) * F.col("precision") * F.col("recall")
                    / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)))


def precision_of(row: str) -> Column:
    return F.col(f"{row}.tp") / F.nullif(F.col(f"{row}.n_pred"), F.lit(0))


def recall_of(row: str) -> Column:
    return F.col(f"{row}.tp") / F.nullif(F.col(f"{row}.n_true"), F.lit(0))


def class_priors(df: DataFrame, label: str = "label") -> DataFrame:
    """(cls, n, prior) by class (E3): one pass, the K class rows meet in one
    row for the total."""
    counts = df.groupBy(F.col(label).alias("cls")).agg(F.count(F.lit(1)).alias("n"))
    k = counts.agg(F.array_sort(F.collect_list(F.struct("cls", "n"))).alias("rows"), F.sum("n").alias("total"))
    return k.select(F.explode("rows").alias("r"), "total") \
            .select("r.cls", "r.n", (F.col("r.n") / F.col("total")).alias("prior"))


def _split_counts(df: DataFrame, is_test: Column, label: str, hit: Column) -> DataFrame:
    """Per class: rows and hits of the training and the test part (one pass)."""
    def part(test: bool, v: Column) -> Column:
        return F.sum(F.when(is_test if test else ~is_test, v).otherwise(0))
    one, hits = F.lit(1), hit.cast("int")
    return df.groupBy(F.col(label).alias("cls")).agg(
        part(False, one).alias("n_train"), part(True, one).alias("n_test"),
        part(False, hits).alias("hit_train"), part(True, hits).alias("hit_test"))


def random_precision(df: DataFrame, is_test: Column, label: str = "label") -> DataFrame:
    """Agreement rate of a random classifier drawing from the training
    priors: sum over classes of p_train * p_test (E4).

    Training and test priors come from one pass and share the class's row (a
    class missing from one side contributes 0, SURVEY Q24); 0 if a side is
    empty.
    """
    per = _split_counts(df, is_test, label, F.lit(False))
    return per.agg(_agreement().alias("random_precision"))


def _agreement() -> Column:
    both = F.sum(F.col("n_train").cast("double") * F.col("n_test"))
    return F.coalesce(both / F.nullif(F.sum("n_train").cast("double") * F.sum("n_test"), F.lit(0.0)), F.lit(0.0))


def eval_classification(scored: DataFrame, is_test: Column, label: str = "label",
                        prediction: str = "prediction") -> DataFrame:
    """(metric, value) rows: training and test precision and the random
    baseline, from one pass over the scored rows (E5).

    Test precision is computed on the test rows (SURVEY Q23); NULL for an
    empty part."""
    per = _split_counts(scored, is_test, label, F.coalesce(F.col(label) == F.col(prediction), F.lit(False)))
    total = per.agg((F.sum("hit_train") / F.nullif(F.sum("n_train"), F.lit(0))).alias("train_precision"),
                    (F.sum("hit_test") / F.nullif(F.sum("n_test"), F.lit(0))).alias("test_precision"),
                    _agreement().alias("random_precision"))
    return total.unpivot([], ["train_precision", "test_precision", "random_precision"], "metric", "value")


def eval_regression(df: DataFrame, is_test: Column, label: str, prediction: str, rng: DataFrame) -> DataFrame:
    """(metric, value) rows ``train_rmse`` and ``test_rmse`` of normalised
    labels and predictions, taken back to the training range first (E5-E7)."""
    rows = denormalise(df.withColumn("_test", is_test), [label, prediction], rng)
    err = F.col(label) - F.col(prediction)
    both = rows.agg(*[F.sqrt(F.avg(F.when(F.col("_test") == t, err * err))).alias(n)
                      for t, n in ((False, "train_rmse"), (True, "test_rmse"))])
    return both.unpivot([], ["train_rmse", "test_rmse"], "metric", "value")


def value_range(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row (mn, mx) over the given columns: the true minimum."""
    return df.agg(F.array_min(F.array(*[F.min(c) for c in cols])).alias("mn"),
                  F.array_max(F.array(*[F.max(c) for c in cols])).alias("mx"))


def denormalise(df: DataFrame, cols: list[str], rng: DataFrame) -> DataFrame:
    """v * (max - min) + min with the range of the training table."""
    st = rng.select(F.struct("mn", "mx")).scalar()
    lo, hi = st["mn"], st["mx"]
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c) * (hi - lo) + lo)
    return out


def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """sqrt(mean((label - prediction)^2)) with the count and MSE."""
    err = F.col(label) - F.col(prediction)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse")) \
             .withColumn("rmse", F.sqrt("mse"))


def half_mse(df: DataFrame, error: str = "err") -> DataFrame:
    """0.5 * mean(err^2), the reference's ``Loss``."""
    e = F.col(error)
    return df.agg(F.count(F.lit(1)).alias("n"), (F.lit(0.5) * F.avg(e * e)).alias("half_mse"))


def holdout_agreement(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """Share of held-out rows where sign(score) agrees with sign(y) (M7)."""
    agree = ((F.col(score) > 0) == (F.col(y) > 0)).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(agree).alias("agreement"))
