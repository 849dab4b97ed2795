"""Input rules, optimality of the trainers, two-sided fixtures, whole steps."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.functions.kernels import block_kernel
from marginflow.operators import dual as D
from marginflow.operators import metrics as M
from marginflow.operators.scoring import KernelModel, kernel_sum, linear_weights, predict_label
from marginflow.operators.trainers import (NotConverged, SVMParams, dual_objective, fit_kernel_svm,
                                           fit_linear_svc, fit_rff_svc, solve_subproblem)
from marginflow.plans import catalog
from marginflow.sources import fixtures as fx
from tests.conftest import SF_SMALL

XY = "id long, x array<double>, label double"


def xy(spark, rows):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], XY)


def linear_model(spark, d=1):
    sup = spark.createDataFrame([([1.0] * d, 1.0, 0.5)], "x array<double>, y double, alpha double")
    return KernelModel(sup, 0.0, "rbf", 0.5, 1.0)


@pytest.mark.parametrize("bad", [[1.0], [1.0, 2.0, 3.0], None, [None, 1.0], [float("nan"), 1.0]])
def test_scoring_rejects_bad_vectors(spark, bad):
    df = xy(spark, [([1.0, 2.0], 1.0), (bad, 0.0)]).coalesce(1)
    with pytest.raises(Exception, match="feature v"):
        linear_model(spark, 2).decision(df).collect()


def test_ragged_rows_of_the_right_total_are_rejected(spark):
    df = xy(spark, [([1.0], 1.0), ([2.0, 3.0, 4.0], 0.0)]).coalesce(1)
    with pytest.raises(Exception, match="differ in length"):
        linear_model(spark, 2).decision(df).collect()


def test_no_prediction_without_a_score(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,), (0.0,), (-1.0,)], "score double")
    assert [r.prediction for r in predict_label(df).collect()] == [None, None, 1.0, 0.0, 0.0]


FITS = [lambda df: fit_kernel_svm(df, SVMParams(c=1.0)), fit_linear_svc, lambda df: fit_rff_svc(df, 1.0)]


@pytest.mark.parametrize("fit", FITS)
@pytest.mark.parametrize("rows,message", [
    ([], "no rows"), ([([0.0], 1.0), ([1.0], 1.0)], "both classes"), ([([0.0], 0.0), ([1.0], 2.0)], "both classes"),
    ([([0.0], 1.0), ([1.0], 0.0), ([2.0], 2.0)], "both classes"), ([([0.0], 1.0), ([1.0], None)], "NULL"),
    ([([0.0], 1.0), ([1.0, 2.0], 0.0)], "one length"), ([([0.0], 1.0), ([None], 0.0)], "NULL or NaN"),
    ([([0.0], 1.0), ([float("nan")], 0.0)], "NULL or NaN"), ([([0.0], 1.0), (None, 0.0)], "NULL or NaN")])
def test_trainers_reject_unusable_tables(spark, fit, rows, message):
    with pytest.raises(ValueError, match=message):
        fit(xy(spark, rows))


def test_unconverged_trainers_raise(spark):
    df = fx.ring_samples(spark, SF_SMALL)
    slow = dict(c=1.0, gamma=5.0, tol=1e-4, working_set=8, max_iter=2)
    with pytest.raises(NotConverged):
        fit_kernel_svm(df, SVMParams(**slow))
    model = fit_kernel_svm(df, SVMParams(**slow, allow_unconverged=True))
    assert not model.info["converged"] and model.info["gap"] > 1e-4
    with pytest.raises(NotConverged):
        fit_rff_svc(df, 5.0, max_iter=2)
    assert not fit_rff_svc(df, 5.0, max_iter=2, allow_unconverged=True).info["converged"]


def test_closed_form_on_prices(spark):
    df = fx.price_samples(spark, SF_SMALL)
    m = fit_kernel_svm(df, SVMParams(c=10.0, kernel="linear", tol=1e-6))
    p, n = (df.filter(f"label = {v}").agg(f(F.col("x")[0])).first()[0] for v, f in ((1, F.min), (0, F.max)))
    w = linear_weights(m.coef_table(), "coef").first().w
    assert w == pytest.approx(2 / (p - n), abs=1e-9) and m.b == pytest.approx(w * (p + n) / 2, abs=1e-9)


def test_optimality_on_many_distinct_rows(spark):
    """RBF, nearly all rows distinct, a working set much smaller than the table."""
    df = fx.price_ring(spark, SF_SMALL).filter(F.pmod(F.xxhash64("x"), F.lit(4)) == 0)
    m = fit_kernel_svm(df, SVMParams(c=1.0, gamma=5.0, tol=0.02, working_set=256, checkpoint_every=4))
    info, st = m.info, m.info["state"]
    assert info["converged"] and info["gap"] <= 0.02 and info["distinct_rows"] > 4 * 256
    r = st.agg(F.min("alpha").alias("lo"), F.max(F.col("alpha") - F.col("cap")).alias("over"),
               F.sum(F.col("alpha") * F.col("y")).alias("ay")).first()
    assert r.lo >= 0 and r.over <= 1e-12 and abs(r.ay) <= 1e-8
    steps = np.diff(info["objective"])
    assert (steps <= 1e-9).all() and info["objective"][-1] == pytest.approx(dual_objective(st), rel=1e-6)
    rows = st.collect()
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
    g = y * (block_kernel(x, x, "rbf", 5.0) @ (y * np.array([r.alpha for r in rows]))) - 1
    assert np.allclose(g, [r.g for r in rows], atol=1e-6)
    assert M.accuracy(m.transform(df)).first().accuracy >= 0.97


def test_eps_keeps_flat_pairs_of_little_gain():
    """Two equal points of opposite label and one apart: the flat pair waits."""
    x = np.array([[0.0], [0.0], [1.0], [1.2]])
    y = np.array([1.0, -1.0, -1.0, 1.0])
    k = block_kernel(x, x, "rbf", 1.0)
    start, g = np.zeros(4), -np.ones(4)
    cap = np.array([1e-5, 1e-5, 1.0, 1.0])
    one, _ = solve_subproblem(k, y, start, g, cap, 1e-9, 1, eps=0.0)
    held, _ = solve_subproblem(k, y, start, g, cap, 1e-9, 1, eps=1e-3)
    assert one[0] == one[1] == 1e-5 and not np.array_equal(one, held)
    full, _ = solve_subproblem(k, y, start, g, cap, 1e-9, 10000, eps=1e-3)
    gf = (y[:, None] * y[None] * k) @ full - 1
    v = -y * gf
    up, low = ((y > 0) & (full < cap)) | ((y < 0) & (full > 0)), ((y > 0) & (full > 0)) | ((y < 0) & (full < cap))
    assert v[up].max() - v[low].min() <= 1e-9


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_planted_predictions_are_two_sided(spark, sf):
    d = f"/root/testdata/{sf}"
    got = [r.prediction for r in catalog.QUERIES["predict_label"](spark, d).collect()]
    assert 0.1 <= np.mean(got) <= 0.9
    assert catalog.QUERIES["confusion"](spark, d).count() == 4
    held = catalog.QUERIES["classify_test"](spark, d).agg(F.avg((F.col("score") > 0).cast("double"))).first()[0]
    assert 0.1 <= held <= 0.9
    st, _ = catalog._planted_state(spark, d, keep_x=False)
    r = st.selectExpr("count_if(y * e > 0.01 and alpha > 0)", "count_if(y * e < -0.01 and alpha < cap)",
                      "count_if(alpha > 0 and alpha < cap)", "count_if(alpha = cap)").first()
    assert all(n > 0 for n in r)


def test_a_constant_predictor_fails_the_oracle(spark, monkeypatch):
    from marginflow.plans.oracle import ORACLE
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    for value in (0.0, 1.0):
        monkeypatch.setattr(catalog, "predict_label", lambda df, v=value: df.withColumn("prediction", F.lit(v)))
        for name in ("predict_label", "accuracy", "confusion", "class_metrics", "eval_classification"):
            got = sorted(map(repr, (tuple(r.asDict()[c] for c in sorted(r.asDict()))
                                    for r in catalog.QUERIES[name](spark, SF_SMALL).collect())))
            cur = con.execute(ORACLE[name])
            cols = [d[0] for d in cur.description]
            order = [cols.index(c) for c in sorted(cols)]
            assert got != sorted(repr(tuple(row[i] for i in order)) for row in cur.fetchall()), name


def test_step_leaves_a_consistent_state(spark):
    """g and e after T11/T12 equal those computed anew from the new multipliers."""
    st, b = catalog._planted_state(spark, SF_SMALL)
    deltas = catalog._chosen_step(st, b)
    assert deltas.filter("alpha_new <> alpha_old").count() == 2
    stepped = D.apply_step(D.gradient_update(st, deltas, "rbf", fx.PLANTED_GAMMA, b), deltas, b)
    basis = stepped.filter("alpha > 0").select("x", (F.col("alpha") * F.col("y")).alias("coef"))
    again = kernel_sum(stepped, basis, "coef", "k", "rbf", fx.PLANTED_GAMMA)
    off = again.select(F.abs(F.col("y") * F.col("k") - 1 - F.col("g")).alias("g"),
                       F.abs(F.col("k") - F.col("b") - F.col("y") - F.col("e")).alias("e"))
    worst = off.agg(F.max("g"), F.max("e")).first()
    assert max(worst) < 1e-9


def test_pairs_keep_odd_rows_and_reject_repeats(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (5, 3.0), (2**60, 4.0), (2**60 + 1, 5.0)], "id long, v double")
    got = sorted((r.i, r.v_i, r.j, r.v_j) for r in D.pair_rows(df, ["v"]).collect())
    assert got == [(0, 1.0, 1, 2.0), (5, 3.0, None, None), (2**60, 4.0, 2**60 + 1, 5.0)]
    with pytest.raises(Exception, match="unique"):
        D.pair_rows(df.unionByName(df.filter("id = 5")), ["v"]).collect()


def test_regression_report_depends_on_the_range(spark):
    pairs = fx.unit_pairs(spark, SF_SMALL)
    rng = catalog._price_range(pairs)
    got = {r.metric: r.value for r in M.eval_regression(pairs, catalog._late(), "label", "prediction", rng).collect()}
    wrong = rng.select("mn", (F.col("mx") * 2).alias("mx"))
    other = {r.metric: r.value
             for r in M.eval_regression(pairs, catalog._late(), "label", "prediction", wrong).collect()}
    assert set(got) == {"train_rmse", "test_rmse"} and all(other[k] > 1.5 * got[k] for k in got)
    back = M.denormalise(pairs, ["label"], rng.select((F.col("mn") + 1).alias("mn"), "mx")).first().label
    assert back != M.denormalise(pairs, ["label"], rng).first().label


def test_kernel_sum_refuses_to_overwrite(spark):
    df = spark.createDataFrame([([1.0], 1.0)], "x array<double>, coef double")
    with pytest.raises(ValueError, match="already"):
        kernel_sum(df, df, "coef", "coef")


def test_fourier_fit_over_packed_rows_against_numpy(spark, monkeypatch):
    """A pass over packed rows gives the loss and gradient of the features in
    full, and a fit begun on a share ends where one over all rows does."""
    from marginflow.operators import trainers as tr
    rng = np.random.default_rng(4)
    X = np.vstack([p := rng.random((900, 2)), p[:100]])
    label = (((X - 0.5) ** 2).sum(axis=1) < 0.12).astype(float)
    df = spark.createDataFrame([(x.tolist(), float(v)) for x, v in zip(X, label)], "x array<double>, label double")
    fmap = tr.FourierMap.draw(2, 16, 5.0, 1)
    merged = tr._merged_rows(df, "x", "label", 1.0, True)
    packed = tr._packed(merged, F.pmod(F.xxhash64("x"), F.lit(4)) == 0)
    assert sorted(packed.columns) == ["first", "n", "s", "x"]
    assert packed.agg(F.sum("n"), F.sum(F.octet_length("x")), F.sum(F.octet_length("s"))).first() == (900, 14400, 7200)
    v = rng.normal(size=17)
    Z, y = np.cos(X @ fmap.W.T + fmap.p), 2 * label - 1
    hinge = 1 - y * (Z @ v[:-1] + v[-1])
    pull = np.where(hinge > 0, -y, 0.0)
    n, loss, g = tr._hinge_sums(packed, fmap, v)
    assert n == 1000 and loss == pytest.approx(np.maximum(hinge, 0).sum(), rel=1e-5)
    assert g == pytest.approx(np.append(pull @ Z, pull.sum()), rel=1e-4, abs=1e-2)

    def loss_of(model):
        z = np.sqrt(2 / 64) * np.cos(X @ model.fmap.W.T + model.fmap.p)
        return np.maximum(1 - y * (z @ model.w - model.b), 0).mean() + 0.5e-5 * model.w @ model.w

    whole = fit_rff_svc(df, 5.0)
    monkeypatch.setattr(tr, "START_ROWS", 200)
    shared = fit_rff_svc(df, 5.0)
    assert whole.info["start_rows"] == 0 < shared.info["start_rows"] < 400
    assert whole.info["distinct_rows"] == shared.info["distinct_rows"] == 900
    assert loss_of(shared) < loss_of(whole) + 0.01 < 0.3
