"""The reference's whole run (E9): text -> typed rows -> target split ->
scaling -> training -> report, as one chain of DataFrame operators.

The type file decides between the classification report (precision of a
support vector classifier) and the regression report (RMSE of a support
vector regression, in the target's own units).  The caller chooses the
classifier's trainer (``rff``, which suits any size, or the exact
working-set trainer); nothing switches with the size of the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.operators import metrics as M
from marginflow.operators import prep as P
from marginflow.operators.trainers import SVMParams, fit_kernel_svm, fit_linear_svr, fit_rff_svc
from marginflow.session import ensure_checkpoint_dir, one_row, shared_table
from marginflow.sources import fixtures as fx
from marginflow.sources import text as TX

#: Share of rows a run's model must get right to be reported as accurate.
ACCURATE = 0.97


def _typed_rows(spark: SparkSession, sf_dir: str, target: str) -> tuple[str, DataFrame, tuple[float, float]]:
    """(task, rows, range): the text lines parsed, split at the target, and
    scaled per column by the training range.

    The task comes from the type file.  ``rows`` are (is_test, label, x); the
    label is as it was, ``range`` is its (min, max) over the training rows."""
    files = f"{ensure_checkpoint_dir(spark).rstrip('/')}/f8-{uuid.uuid4().hex}"
    names, types = _name_and_type_files(spark, files)
    found = TX.task_type(names, types, target).first()
    parsed = shared_table(TX.parse_lines(fx.text_lines(spark, sf_dir), fx.F8_NAMES, keep=["l_shipdate"]), "parsed")
    late = F.col("l_shipdate") >= F.lit(fx.SPLIT_DATE).cast("timestamp_ntz")
    values = parsed.select(late.alias("is_test"), F.array(*fx.F8_NAMES).alias("values"))
    # the training range, 2 numbers a column; test rows reuse it
    st = P.column_minmax(values.filter("not is_test"), "values").first()
    if st is None:
        raise ValueError("training needs rows before the split date")
    at = found["pos"]
    lo, hi = (F.array(*[F.lit(v) for i, v in enumerate(st[k]) if i != at]) for k in ("mins", "maxs"))
    rows = P.target_split(values, "values", at).drop("values")
    return found["task"], P.scale_with(rows, "x", lo, hi), (st["mins"][at], st["maxs"][at])


def svm_run(spark: SparkSession, sf_dir: str, target: str, **settings) -> DataFrame:
    """The whole run for one target column: (metric, value) rows of the
    classification or the regression report, as the type file says."""
    task, rows, span = _typed_rows(spark, sf_dir, target)
    if task == TX.CLASSIFICATION:
        return classification_report(rows, **settings)
    return regression_report(rows, span, **settings)


def classification_run(spark: SparkSession, sf_dir: str, params: SVMParams | None = None,
                       trainer: str = "rff", rff_features: int = 128) -> DataFrame:
    """The run on the ring label, a class."""
    return svm_run(spark, sf_dir, "in_ring", params=params, trainer=trainer, rff_features=rff_features)


def classification_report(rows: DataFrame, params: SVMParams | None = None,
                          trainer: str = "rff", rff_features: int = 128) -> DataFrame:
    """Train on the training rows, report on all.

    Returns (metric, value) rows: training and test rows, distinct training
    rows, the random-agreement baseline, whether training and test precision
    reach ``ACCURATE``, and whether the trainer converged (it raises if not,
    unless ``params.allow_unconverged``).
    """
    if trainer not in ("rff", "exact"):
        raise ValueError(f"unknown trainer {trainer!r}; expected 'rff' or 'exact'")
    params = params or SVMParams(c=1.0, gamma=5.0, tol=0.01)
    train = rows.filter("not is_test")
    if trainer == "exact":
        model = fit_kernel_svm(train, params)
    else:
        model = fit_rff_svc(train, gamma=params.gamma, n_features=rff_features,
                            allow_unconverged=params.allow_unconverged)
    report = {r["metric"]: r["value"] for r in M.eval_classification(model.transform(rows), F.col("is_test")).collect()}
    test_rows = rows.filter("is_test").count()
    return metric_rows(rows.sparkSession, [
        ("train_rows", model.info["rows"]), ("test_rows", test_rows),
        ("distinct_train_rows", model.info["distinct_rows"]),
        ("random_precision", round(report["random_precision"], 9)),
        ("train_accurate", report["train_precision"] >= ACCURATE),
        ("test_accurate", report["test_precision"] >= ACCURATE),
        ("converged", model.info["converged"])])


def regression_report(rows: DataFrame, span: tuple[float, float], c: float = 1.0) -> DataFrame:
    """Train a support vector regression on the training rows' normalised
    label and report on all rows.

    Labels are normalised by the training range ``span``; the model's outputs
    and the labels are taken back to it, and training and test RMSE come from
    the scored rows in one pass.  A constant label has range 0 and normalises
    to 0.  Returns (metric, value) rows: train_rows, test_rows, train_rmse,
    test_rmse (NULL for an empty part)."""
    lo, hi = span
    rng = one_row(rows.sparkSession).select(F.lit(float(lo)).alias("mn"), F.lit(float(hi)).alias("mx"))
    unit = rows.withColumn("label", F.coalesce((F.col("label") - F.lit(lo)) / F.nullif(F.lit(hi - lo), F.lit(0.0)),
                                               F.lit(0.0)))
    model = fit_linear_svr(unit.filter("not is_test"), c=c)
    scored = model.decision(unit, out_col="prediction")
    report = M.eval_regression(scored, F.col("is_test"), "label", "prediction", rng)
    counts = rows.groupBy().agg(F.count_if(~F.col("is_test")).cast("double").alias("train_rows"),
                                F.count_if(F.col("is_test")).cast("double").alias("test_rows"))
    return report.unionByName(counts.unpivot([], ["train_rows", "test_rows"], "metric", "value"))


def _name_and_type_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    fx.name_and_type_files(spark, path)
    return TX.read_names(spark, f"{path}/names"), TX.read_types(spark, f"{path}/types")


def metric_rows(spark: SparkSession, pairs: list[tuple[str, float]]) -> DataFrame:
    """A handful of (metric, value) rows."""
    structs = [F.struct(F.lit(m).alias("metric"), F.lit(float(v)).alias("value")) for m, v in pairs]
    return one_row(spark).select(F.inline(F.array(*structs)))
