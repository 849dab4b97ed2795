"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (or tables Spark derives from them);
none caps rows or picks an id subset.  Float outputs whose value depends on
summation order are rounded to a fixed number of places (and +0.0 removes
negative zeros) so results compare exactly with the DuckDB oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import numpy as np

from marginflow.functions.kernels import curvature_expr, kernel_expr, sq_distance
from marginflow.operators import dual as D
from marginflow.operators import metrics as M
from marginflow.operators import prep as P
from marginflow.operators.scoring import (KernelModel, linear_score, linear_weights,
                                          predict_label, prediction_error)
from marginflow.session import ensure_checkpoint_dir
from marginflow.sources import fixtures as fx
from marginflow.sources import text as TX

GAMMA = fx.PLANTED_GAMMA
C = fx.PLANTED_C
B = fx.PLANTED_B
TOL = 0.01
SEED = 7
EPS = 1e-3
RING_TARGET = "in_ring"
REGRESSION_TARGET = "l_extendedprice"


def r(col: Column | str, places: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, places) + F.lit(0.0)


# ---------------------------------------------------------------- fixtures

def _parsed_lines(spark, sf):
    lines = fx.text_lines(spark, sf)
    return TX.parse_lines(lines, fx.F8_NAMES, keep=fx.LINEITEM_KEY + ["l_shipdate"])


def _planted_model(rows: DataFrame, kernel: str = "rbf") -> tuple[KernelModel, list[int]]:
    """Planted model of ``rows`` (id, x, label): K support rows, one of each
    class, and a threshold that centres the rows' scores; and the support ids.

    The support is collected once (K rows) and broadcast with the tasks."""
    support = fx.planted_support(rows)
    got = support.orderBy("label").collect()
    block = (np.array([g["x"] for g in got]), np.array([g["alpha"] * g["y"] for g in got]))
    model = KernelModel(support.select("x", "y", "alpha"), 0.0, kernel, GAMMA, C, block=block)
    model.b = model.decision(rows).agg(F.avg("score")).first()[0]
    return model, [g["id"] for g in got]


def _planted_scored(spark, sf, kernel: str = "rbf") -> DataFrame:
    """Every embeddings row scored by the planted model: id, label, y, score."""
    pm = fx.planted_model(spark, sf)
    model, _ = _planted_model(pm, kernel)
    return model.decision(pm).drop("x")


def _planted_state(spark, sf, keep_x: bool = True) -> tuple[DataFrame, float]:
    """(id, [x,] y, cap, alpha, g, e) and b: the planted dual state.

    The support rows hold the planted multipliers, all others 0, and g and e
    follow from them, as in a solver's state."""
    pm = fx.planted_model(spark, sf)
    model, ids = _planted_model(pm)
    alpha = F.when(F.col("id").isin(ids), fx.planted_alpha()).otherwise(F.lit(0.0))
    # score = sum - b  ->  g = y * (score + b) - 1
    state = model.decision(pm).select(
        "id", *(["x"] if keep_x else []), "y", F.lit(C).alias("cap"), alpha.alias("alpha"),
        (F.col("y") * (F.col("score") + F.lit(model.b)) - F.lit(1.0)).alias("g"))
    return D.with_error(state, model.b), model.b


PAIR_COLS = ["x", "y", "cap", "alpha", "e"]


def _chosen_step(st: DataFrame, b: float) -> DataFrame:
    """One SMO step: first choice i, second choice j, their pair stepped, as
    delta rows (id, x, y, alpha_old, alpha_new, b_new) (T4, T5, T10, T11)."""
    choice = D.second_choice(st, D.first_choice(st, TOL))
    pair = D.pair_of(st, choice, PAIR_COLS)
    deltas = D.step_deltas(D.with_pair_step(D.with_kernels(pair, "rbf", GAMMA), b, eps=EPS))
    return D.local_rows(deltas, 2)   # one pair moves two rows


def _label01() -> Column:
    return F.when(F.col("label") < 5, F.lit(1.0)).otherwise(F.lit(0.0))


def _split_planted(spark, sf, holdout_only: bool = False) -> DataFrame:
    """Rows scored, with a ``holdout`` flag, by the planted model of the
    training part (only the held-out rows when ``holdout_only``)."""
    pm, hold = fx.planted_model(spark, sf), fx.holdout_flag()
    model, _ = _planted_model(pm.filter(~hold))
    rows = pm.filter(hold) if holdout_only else pm
    return model.decision(rows.withColumn("holdout", hold)).drop("x")


# ---------------------------------------------------------------- S: sources

def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_csv_lines(spark, sf):
    path = _scratch(spark, "f8")
    fx.f8_files(spark, sf, path)
    p = TX.read_delimited(spark, f"{path}/data", fx.LINEITEM_KEY + fx.F8_NAMES)
    keys = fx.table(spark, sf, "lineitem").schema
    return p.select(*[F.col(k).cast(keys[k].dataType).alias(k) for k in fx.LINEITEM_KEY], *fx.F8_NAMES)


def q_task_type(spark, sf):
    """Name and type files looked up for the target; parsed values per column."""
    path = _scratch(spark, "f8")
    fx.f8_files(spark, sf, path)
    names, types = TX.read_names(spark, f"{path}/names"), TX.read_types(spark, f"{path}/types")
    target = TX.task_type(names, types, RING_TARGET).select(F.col("pos").alias("_tpos"))
    counts = TX.read_delimited(spark, f"{path}/data", fx.LINEITEM_KEY + fx.F8_NAMES) \
        .agg(*[F.count(c).alias(c) for c in fx.F8_NAMES]).unpivot([], fx.F8_NAMES, "name", "n_values")
    return names.join(types, "pos").join(target, F.col("pos") == F.col("_tpos"), "left").join(counts, "name").select(
        "pos", "name", "code",
        F.when(F.col("code") == TX.CLASSIFICATION_CODE, F.lit(TX.CLASSIFICATION))
        .otherwise(F.lit(TX.REGRESSION)).alias("task"),
        F.col("_tpos").isNotNull().alias("is_target"), "n_values")


def q_target_split(spark, sf):
    p = _parsed_lines(spark, sf)
    arr = p.select(*fx.LINEITEM_KEY, F.array(*fx.F8_NAMES).alias("values"))
    sp = P.target_split(arr, "values", 2)  # l_discount as the target
    return sp.select(*fx.LINEITEM_KEY, "label", *[F.col("x")[i].alias(f"f{i}") for i in range(4)])


# ---------------------------------------------------------------- P: preparation

def q_global_minmax(spark, sf):
    return P.global_minmax(fx.embeddings(spark, sf))


def q_scale_global(spark, sf):
    s = P.scale_global(fx.embeddings(spark, sf))
    return s.select("id", F.posexplode("x").alias("pos", "v"))


def q_scale_per_column(spark, sf):
    s = P.scale_per_column(fx.embeddings(spark, sf), "x")
    return s.select("id", F.posexplode("x").alias("pos", "v"))


def q_class_count(spark, sf):
    return P.class_count(fx.order_status(spark, sf), "cls")


def q_one_hot(spark, sf):
    oh = P.one_hot(fx.order_status(spark, sf), "cls")
    return oh.select("o_orderkey", "cls", F.posexplode("onehot").alias("slot", "v"))


def q_one_hot_decode(spark, sf):
    s = P.scale_global(fx.embeddings(spark, sf))
    return s.select("id", P.one_hot_decode("x").alias("cls"))


# ---------------------------------------------------------------- K: kernel arithmetic

def _pairs(spark, sf):
    return D.pair_rows(fx.embeddings(spark, sf), ["x"])


def q_sq_distance(spark, sf):
    return _pairs(spark, sf).select("i", "j", r(sq_distance("x_i", "x_j"), 9).alias("d2"))


def q_rbf_pairs(spark, sf):
    return _pairs(spark, sf).select("i", "j", r(kernel_expr("x_i", "x_j", "rbf", GAMMA), 9).alias("k"))


def q_pair_curvature(spark, sf):
    return _pairs(spark, sf).select("i", "j", r(curvature_expr("x_i", "x_j", "rbf", GAMMA), 9).alias("eta"))


def q_decision_rbf(spark, sf):
    return _planted_scored(spark, sf).select("id", r("score", 6).alias("score"))


def q_decision_sqdist(spark, sf):
    return _planted_scored(spark, sf, "sqdist").select("id", r("score", 6).alias("score"))


def q_prediction_error(spark, sf):
    s = prediction_error(_planted_scored(spark, sf), out="e")
    return s.select("id", "y", r("e", 6).alias("e"))


# ---------------------------------------------------------------- M: scoring

def q_predict_label(spark, sf):
    s = predict_label(_planted_scored(spark, sf))
    return s.select("id", r("score", 6).alias("score"), "prediction")


def q_accuracy(spark, sf):
    s = predict_label(_planted_scored(spark, sf)).withColumn("label01", _label01())
    return M.accuracy(s, "label01", "prediction")


def q_predict_rows(spark, sf):
    pm = fx.planted_model(spark, sf)
    model, _ = _planted_model(pm)
    out = model.transform(pm, y=F.col("y"))
    x_sum = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v)
    return out.select("id", "label", r(x_sum, 6).alias("x_sum"), r("score", 6).alias("score"), "prediction",
                      r("error", 6).alias("error"))


def _planted_weights(spark, sf):
    pm = fx.planted_model(spark, sf)
    return linear_weights(pm.select("x", (F.col("alpha") * F.col("y")).alias("coef")), "coef")


def q_linear_weights(spark, sf):
    return _planted_weights(spark, sf).select("pos", r("w", 9).alias("w"))


def q_linear_score(spark, sf):
    s = linear_score(fx.embeddings(spark, sf), _planted_weights(spark, sf), B)
    return s.select("id", r("score", 6).alias("score"))


def q_classify_test(spark, sf):
    return _split_planted(spark, sf, holdout_only=True).select("id", r("score", 6).alias("score"))


def q_holdout_agreement(spark, sf):
    return M.holdout_agreement(_split_planted(spark, sf, holdout_only=True), "score", "y")


# ---------------------------------------------------------------- T: training steps

def q_warm_start(spark, sf):
    """Start from the multipliers one SMO step produced (two rows), every
    other row at 0; g for all rows from that start (T3)."""
    emb = fx.embeddings(spark, sf).select("id", "x", fx.embeddings_y().alias("y"))
    warm = _chosen_step(*_planted_state(spark, sf)).select("id", F.col("alpha_new").alias("alpha"))
    st = D.warm_state(emb, warm, C, "rbf", GAMMA)
    return st.select("id", "y", "alpha", r("g", 6).alias("g"))


def q_kkt_violators(spark, sf):
    st, _ = _planted_state(spark, sf, keep_x=False)
    return D.kkt_violators(st, TOL).select("id", "y", "alpha", r("e", 6).alias("e"))


def q_second_choice(spark, sf):
    st, _ = _planted_state(spark, sf, keep_x=False)
    sc = D.second_choice(st, D.first_choice(st, TOL))
    return sc.select("i", "j", r("e_i", 6).alias("e_i"), r("e_j", 6).alias("e_j"),
                     r("gap", 6).alias("gap"))


def q_fallback_nonbound(spark, sf):
    st, _ = _planted_state(spark, sf, keep_x=False)
    return D.fallback_choice(st, D.first_choice(st, TOL), SEED, free_only=True)


def q_fallback_any(spark, sf):
    st, _ = _planted_state(spark, sf, keep_x=False)
    return D.fallback_choice(st, D.first_choice(st, TOL), SEED, free_only=False)


def q_pair_bounds(spark, sf):
    st = fx.planted_model(spark, sf).withColumn("cap", F.lit(C))
    pairs = D.with_pair_bounds(D.pair_rows(st, ["y", "cap", "alpha"]))
    return pairs.select("i", "j", "lo", "hi")


def q_pair_step(spark, sf):
    """Every (2k, 2k+1) pair stepped at once (T10), with the multipliers
    id % 11 that cover all bound cases."""
    pm = fx.planted_model(spark, sf)
    model, _ = _planted_model(pm)
    st = prediction_error(model.decision(pm), out="e").withColumn("cap", F.lit(C))
    s = D.with_pair_step(D.with_kernels(D.pair_rows(st, PAIR_COLS), "rbf", GAMMA), model.b, eps=EPS)
    return s.select("i", "j", r("a1_new", 9).alias("a1_new"), r("a2_new", 9).alias("a2_new"),
                    r("b_new", 6).alias("b_new"))


def q_apply_step(spark, sf):
    st, b = _planted_state(spark, sf)
    out = D.apply_step(st.drop("x"), _chosen_step(st, b), b)
    return out.select("id", r("alpha", 9).alias("alpha"), r("b", 6).alias("b"))


def q_gradient_update(spark, sf):
    st, b = _planted_state(spark, sf)
    out = D.gradient_update(st, _chosen_step(st, b), "rbf", GAMMA, b)
    return out.select("id", r("g", 6).alias("g"), r("e", 6).alias("e"))


def q_weights_delta(spark, sf):
    w = D.weights_delta(_planted_weights(spark, sf), _chosen_step(*_planted_state(spark, sf)))
    return w.select("pos", r("w", 9).alias("w"))


# ---------------------------------------------------------------- E: metrics

def _planted_predictions(spark, sf):
    return predict_label(_planted_scored(spark, sf)).withColumn("label01", _label01())


def q_confusion(spark, sf):
    return M.confusion(_planted_predictions(spark, sf), "label01", "prediction")


def q_class_metrics(spark, sf):
    m = M.class_metrics(_planted_predictions(spark, sf), "label01", "prediction")
    return m.select("cls", "tp", "n_true", "n_pred",
                    *[r(c, 9).alias(c) for c in ("precision", "recall", "f1", "overall_precision")])


def q_class_priors(spark, sf):
    return M.class_priors(fx.order_status(spark, sf), "cls")


def _late() -> Column:
    return F.col("o_orderdate") >= F.lit(fx.ORDERS_SPLIT_DATE).cast("timestamp_ntz")


def q_random_precision(spark, sf):
    rp = M.random_precision(fx.order_status(spark, sf), _late(), "cls")
    return rp.select(r("random_precision", 9).alias("random_precision"))


def q_eval_classification(spark, sf):
    scored = predict_label(_split_planted(spark, sf)).withColumn("label01", _label01())
    ev = M.eval_classification(scored, F.col("holdout"), "label01", "prediction")
    return ev.select("metric", r("value", 9).alias("value"))


def _price_range(pairs: DataFrame) -> DataFrame:
    return M.value_range(pairs.filter(~_late()), ["price"])


def q_denormalise(spark, sf):
    """Training and test rows taken back to the training range of the price."""
    pairs = fx.unit_pairs(spark, sf)
    back = M.denormalise(pairs, ["label", "prediction"], _price_range(pairs))
    return back.select("o_orderkey", _late().alias("is_test"), r("label", 4).alias("label"),
                       r("prediction", 4).alias("prediction"))


def q_eval_regression(spark, sf):
    pairs = fx.unit_pairs(spark, sf)
    ev = M.eval_regression(pairs, _late(), "label", "prediction", _price_range(pairs))
    return ev.select("metric", r("value", 4).alias("value"))


def q_rmse(spark, sf):
    m = M.rmse(fx.regression_pairs(spark, sf))
    return m.select("n", r("mse", 0).alias("mse"), r("rmse", 6).alias("rmse"))


def q_half_mse(spark, sf):
    f6 = fx.regression_pairs(spark, sf).withColumn("err", F.col("label") - F.col("prediction"))
    return M.half_mse(f6, "err").select("n", r("half_mse", 0).alias("half_mse"))


# ---------------------------------------------------------------- trainers

def _on_the_line(model, *extra: Column) -> DataFrame:
    """W, b, the rows trained on and the certificate of a model of one column."""
    w = linear_weights(model.coef_table(), "coef").filter("pos = 0")
    info = model.info
    return w.select(r("w", 6).alias("w"), F.lit(round(model.b, 6) + 0.0).alias("b"),
                    F.lit(info["rows"]).cast("long").alias("n_rows"),
                    *[F.lit(round(info[k], 4) + 0.0).alias(k) for k in ("primal", "dual", "duality_gap")], *extra)


def q_train_kernel(spark, sf):
    """Linear-kernel SVM on separable prices: W, b, the rows trained on, and
    the primal and dual objective."""
    from marginflow.operators.trainers import SVMParams, fit_kernel_svm
    return _on_the_line(fit_kernel_svm(fx.price_samples(spark, sf), SVMParams(c=10.0, kernel="linear", tol=1e-6)))


def q_train_shrinking(spark, sf):
    """The same fit with settled rows put apart at every step: the same model,
    over fewer rows, and their gradients computed again before it stops."""
    from marginflow.operators.trainers import SVMParams, fit_kernel_svm
    model = fit_kernel_svm(fx.price_samples(spark, sf), SVMParams(
        c=10.0, kernel="linear", tol=1e-6, working_set=2, shrink_every=1))
    active = model.info["active_rows"]
    return _on_the_line(model, F.lit(2 * min(active) < active[0]).alias("fell"),
                        F.lit(active[-1] == active[0]).alias("whole_at_the_end"))


def q_train_rbf(spark, sf):
    """RBF SVM on three points a class stands for, by value: each status's
    rows, multiplier and decision value, and b."""
    from marginflow.operators.trainers import SVMParams, fit_kernel_svm
    data = fx.status_points(spark, sf)
    model = fit_kernel_svm(data, SVMParams(c=1000.0, gamma=GAMMA, tol=1e-9, eps=0.0))
    alpha = model.support.select("x", (F.col("alpha") * F.col("mult")).alias("alpha"))
    each = data.groupBy("cls", "label", "x").agg(F.count(F.lit(1)).alias("n_rows"))
    scored = model.decision(each).join(D.broadcast_if_small(alpha), "x")
    return scored.select("cls", "n_rows", r("alpha", 4).alias("alpha"), r("score", 6).alias("score"),
                         F.lit(round(model.b, 4) + 0.0).alias("b"))


def q_train_linear(spark, sf):
    from marginflow.operators.trainers import fit_linear_svc
    data = fx.price_samples(spark, sf)
    return fit_linear_svc(data, reg=1e-2, tol=1e-4).transform(data).select("o_orderkey", "label", "prediction")


def q_train_rff(spark, sf):
    """Ring over nearly distinct points: rows and classes, and whether the
    predictions take both values and agree with at least 97 % of the labels."""
    from marginflow.operators.trainers import fit_rff_svc
    data = fx.price_ring(spark, sf)
    scored = fit_rff_svc(data, gamma=5.0, n_features=64, seed=SEED).transform(data.select("x", "label"))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("label") == 1).alias("n_positive"),
        (F.avg((F.col("label") == F.col("prediction")).cast("double")) >= 0.97).alias("accurate"),
        (F.count_distinct("prediction") == 2).alias("two_sided"))


def q_svm_report(spark, sf):
    from marginflow.plans.run import classification_run
    return classification_run(spark, sf)


def q_svm_regression_report(spark, sf):
    """The whole run on a target the type file calls a number."""
    from marginflow.plans.run import svm_run
    rep = svm_run(spark, sf, REGRESSION_TARGET)
    return rep.select("metric", r("value", 4).alias("value"))


def q_decision_tiled(spark, sf):
    """Decision values over every row as support (no broadcast: the budget is
    a tenth of it, or the usual one if that is less), rows and support meeting
    in tiles."""
    pm = fx.planted_model(spark, sf)
    model = KernelModel(pm.filter("alpha > 0").select("x", "y", "alpha"), B, "rbf", GAMMA, C)
    out = model.decision(pm.select("id", "x"), max_broadcast_bytes=_tenth(pm))
    return out.select("id", r("score", 6).alias("score"))


def _tenth(pm: DataFrame) -> int:
    from marginflow.operators.scoring import DEFAULT_BROADCAST_BYTES, basis_stats
    return max(1, min(DEFAULT_BROADCAST_BYTES, basis_stats(pm.filter("alpha > 0")).bytes // 10))


def q_project_start(spark, sf):
    """A start below 0 and above C, projected onto what the trainer accepts."""
    a = F.lit(C) * (F.col("id") % fx.PLANTED_ALPHA_MOD - F.lit(2)) / F.lit(6.0)
    rows = fx.embeddings(spark, sf).select("id", fx.embeddings_y().alias("y"), F.lit(C).alias("cap"), a.alias("alpha"))
    return D.project_start(rows).select("id", "y", r("alpha", 6).alias("alpha"))


#: Columns of a block in the wide queries (the vectors have 64).
BLOCK = 24


def _blocked(spark, sf) -> DataFrame:
    from marginflow.operators.wide import blocked_weights
    pm = fx.planted_model(spark, sf)
    return blocked_weights(pm.select("x", (F.col("alpha") * F.col("y")).alias("coef")), width=BLOCK)


def q_blocked_weights(spark, sf):
    """W of the planted model as a table of column blocks."""
    w = _blocked(spark, sf).select("block", F.posexplode("w").alias("at", "w"))
    w = w.withColumn("pos", (F.col("block") * BLOCK + F.col("at")).cast("int"))
    return w.filter(F.col("pos") < 64).select("pos", r("w", 9).alias("w"))


def q_blocked_score(spark, sf):
    """Scores from slices of the rows and blocks of W."""
    from marginflow.operators.wide import blocked_score
    s = blocked_score(fx.embeddings(spark, sf), _blocked(spark, sf), B, width=BLOCK)
    return s.select("id", r("score", 6).alias("score"))


ROUND_PAIRS = 8


def q_pair_round(spark, sf):
    """One round of disjoint pairs on the planted state, with its line search."""
    from marginflow.operators.rounds import pair_round
    st, _ = _planted_state(spark, sf)
    new, _ = pair_round(st.drop("e"), "rbf", GAMMA, ROUND_PAIRS)
    return new.select("id", r("alpha", 6).alias("alpha"), r("g", 6).alias("g"))


def q_zoned_choice(spark, sf):
    """The most violating rows of both sets, read from the files that can
    hold them, and whether files were left out."""
    from marginflow.operators.rounds import write_zoned, zoned_top
    from marginflow.session import one_row
    st, _ = _planted_state(spark, sf)
    zoned = write_zoned(st.drop("e", "x"), 16)
    rows = []
    for up in (True, False):
        top, files = zoned_top(spark, zoned, ROUND_PAIRS, up)
        rows += [F.struct(F.lit("up" if up else "low").alias("side"), F.lit(i).alias("rank"), F.lit(t["id"]).cast("long").alias("id"),
                          F.lit(round(t["v"], 6) + 0.0).alias("v"), F.lit(2 * len(files) < len(zoned.zones)).alias("pruned"))
                 for i, t in enumerate(top, 1)]
    return one_row(spark).select(F.inline(F.array(*rows)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_lines": q_csv_lines,
    "task_type": q_task_type,
    "target_split": q_target_split,
    "global_minmax": q_global_minmax,
    "scale_global": q_scale_global,
    "scale_per_column": q_scale_per_column,
    "class_count": q_class_count,
    "one_hot": q_one_hot,
    "one_hot_decode": q_one_hot_decode,
    "sq_distance": q_sq_distance,
    "rbf_pairs": q_rbf_pairs,
    "pair_curvature": q_pair_curvature,
    "decision_rbf": q_decision_rbf,
    "decision_sqdist": q_decision_sqdist,
    "prediction_error": q_prediction_error,
    "predict_label": q_predict_label,
    "accuracy": q_accuracy,
    "predict_rows": q_predict_rows,
    "linear_weights": q_linear_weights,
    "linear_score": q_linear_score,
    "classify_test": q_classify_test,
    "holdout_agreement": q_holdout_agreement,
    "warm_start": q_warm_start,
    "kkt_violators": q_kkt_violators,
    "second_choice": q_second_choice,
    "fallback_nonbound": q_fallback_nonbound,
    "fallback_any": q_fallback_any,
    "pair_bounds": q_pair_bounds,
    "pair_step": q_pair_step,
    "apply_step": q_apply_step,
    "gradient_update": q_gradient_update,
    "weights_delta": q_weights_delta,
    "confusion": q_confusion,
    "class_metrics": q_class_metrics,
    "class_priors": q_class_priors,
    "random_precision": q_random_precision,
    "eval_classification": q_eval_classification,
    "denormalise": q_denormalise,
    "eval_regression": q_eval_regression,
    "rmse": q_rmse,
    "half_mse": q_half_mse,
    "train_kernel": q_train_kernel,
    "train_linear": q_train_linear,
    "train_rff": q_train_rff,
    "svm_report": q_svm_report,
    "svm_regression_report": q_svm_regression_report,
    "train_shrinking": q_train_shrinking,
    "train_rbf": q_train_rbf,
    "decision_tiled": q_decision_tiled,
    "project_start": q_project_start,
    "blocked_weights": q_blocked_weights,
    "blocked_score": q_blocked_score,
    "pair_round": q_pair_round,
    "zoned_choice": q_zoned_choice,
}
