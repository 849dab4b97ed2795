"""Tiled scoring, repaired starts, shrinking, the certificate, the regression run."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.functions.kernels import block_kernel
from marginflow.operators import dual as D
from marginflow.operators import metrics as M
from marginflow.operators import rounds as RO
from marginflow.operators import wide as W
from marginflow.operators.scoring import KernelModel, basis_stats, kernel_sum
from marginflow.operators.trainers import (NotConverged, SVMParams, certificate, fit_kernel_svm, fit_linear_svr,
                                           gram_matrix, prepare_state, settled)
from marginflow.plans import run as R
from marginflow.session import one_row
from marginflow.sources import fixtures as fx
from tests.conftest import SF_SMALL


# ------------------------------------------------------------------ tiles

@pytest.mark.parametrize("kernel", ["rbf", "linear", "sqdist"])
def test_tiles_equal_the_broadcast_path(spark, kernel):
    """A basis of ten budgets; a third of the rows are one point."""
    rng = np.random.default_rng(1)
    pts = rng.normal(size=(600, 3))
    rows = [(i, pts[i].tolist(), float(i % 7 - 3), 1.0 if i % 3 else -1.0) for i in range(600)]
    rows += [(600 + i, [0.5, 0.5, 0.5], 0.0, 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, x array<double>, coef double, y double").repartition(5) \
        .withColumns({"a.b": F.lit("q"), "block": F.lit(1), "kind": F.lit(None).cast("string")})
    basis = df.filter("coef <> 0").select("x", "coef")
    whole = basis_stats(basis).bytes
    one = {r.id: r.s for r in kernel_sum(df, basis, "coef", "s", kernel, 0.6, scale_col="y").collect()}
    out = kernel_sum(df, basis, "coef", "s", kernel, 0.6, scale_col="y", max_broadcast_bytes=whole // 10)
    assert out.columns == [*df.columns, "s"]
    got = {r.id: (r.s, r["a.b"], r.block, r.kind) for r in out.collect()}
    assert got.keys() == one.keys()
    assert all(abs(got[i][0] - one[i]) < 1e-9 and got[i][1:] == ("q", 1, None) for i in one)


def test_tiles_write_every_row_once(spark):
    """One exchange, whatever the number of tiles, and no rows on the driver."""
    df = spark.range(400).select("id", F.array(F.rand(3), F.rand(4)).alias("x"), F.lit(1.0).alias("coef"))
    out = kernel_sum(df, df, "coef", "s", "rbf", 1.0, max_broadcast_bytes=800)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Broadcast" not in plan
    assert out.count() == 400


def test_tiles_without_rows(spark):
    df = spark.range(50).select("id", F.array(F.rand(3)).alias("x"), F.lit(1.0).alias("coef"))
    assert kernel_sum(df.limit(0), df, "coef", "s", "rbf", 1.0, max_broadcast_bytes=100).collect() == []


# ------------------------------------------------------------------ starts

def project(a, y, cap):
    """Projection by trying all breakpoints."""
    def total(t):
        return (y * np.clip(a - t * y, 0, cap)).sum()
    ts = np.unique(np.concatenate([y * a, y * (a - cap)]))
    h = np.array([total(t) for t in ts])
    k = np.flatnonzero(h >= 0)[-1] if (h >= 0).any() else 0
    if k == len(ts) - 1 or h[k] == h[k + 1]:
        t = ts[k]
    else:
        t = ts[k] + h[k] * (ts[k + 1] - ts[k]) / (h[k] - h[k + 1])
    return np.clip(a - t * y, 0, cap)


@pytest.mark.parametrize("seed", range(4))
def test_projection_against_all_breakpoints(spark, seed):
    rng = np.random.default_rng(seed)
    n = 200
    a, y = rng.normal(size=n) * 10.0 ** rng.integers(-2, 3), np.where(rng.random(n) < [0.5, 0.05, 0.9, 0.5][seed], 1.0, -1.0)
    cap = rng.integers(1, 5, n) * [1.0, 10.0, 0.1, 3.0][seed]
    rows = spark.createDataFrame([(i, float(a[i]), float(y[i]), float(cap[i])) for i in range(n)],
                                 "id long, alpha double, y double, cap double")
    got = np.array([r.alpha for r in D.project_start(rows).orderBy("id").collect()])
    assert np.allclose(got, project(a, y, cap), atol=1e-9 * max(1.0, np.abs(a).max()))
    assert abs((got * y).sum()) < 1e-8 and (got >= 0).all() and (got <= cap).all()


def test_projection_of_odd_starts(spark):
    s = "id long, alpha double, y double, cap double"
    feasible = [(0, 0.5, 1.0, 1.0), (1, 0.5, -1.0, 1.0), (2, None, 1.0, 1.0)]
    got = {r.id: r.alpha for r in D.project_start(spark.createDataFrame(feasible, s)).collect()}
    assert got == pytest.approx({0: 0.5, 1: 0.5, 2: 0.0}, abs=1e-9)
    one_class = spark.createDataFrame([(0, 3.0, 1.0, 1.0), (1, 0.2, 1.0, 1.0)], s)
    assert all(abs(r.alpha) < 1e-9 for r in D.project_start(one_class).collect())
    assert D.project_start(spark.createDataFrame([], s)).collect() == []
    for bad in (float("nan"), float("inf")):
        with pytest.raises(ValueError, match="finite"):
            D.project_start(spark.createDataFrame([(0, bad, 1.0, 1.0)], s))


def test_trainer_takes_a_repaired_start(spark):
    data = fx.ring_samples(spark, SF_SMALL).withColumn("id", F.xxhash64(*fx.LINEITEM_KEY))
    params = SVMParams(c=0.5, gamma=5.0, tol=0.01)
    bad = data.select("id", (F.rand(5) * 3 - 1).alias("alpha")).dropDuplicates(["id"])
    with pytest.raises(Exception, match="outside"):
        fit_kernel_svm(data, params, warm_start=bad)
    cold = fit_kernel_svm(data, params)
    warm = fit_kernel_svm(data, params, warm_start=bad, repair_start=True)
    assert warm.info["dual"] == pytest.approx(cold.info["dual"], rel=1e-3)
    assert warm.info["duality_gap"] >= -1e-6


def test_warm_state_with_repair(spark):
    rows = fx.embeddings(spark, SF_SMALL).select("id", "x", fx.embeddings_y().alias("y"))
    start = rows.select("id", (F.col("id") - 100.0).alias("alpha"))
    st = D.warm_state(rows, start, 2.0, "linear", 0.0, repair=True).collect()
    a, y = np.array([r.alpha for r in st]), np.array([r.y for r in st])
    X = np.array([r.x for r in st])
    assert abs(a @ y) < 1e-8 and a.min() >= 0 and a.max() <= 2.0
    assert np.allclose([r.g for r in st], y * (X @ (X.T @ (a * y))) - 1.0, atol=1e-6)


# ------------------------------------------------------------------ shrinking and certificate

def test_shrinking_gives_the_same_model_over_fewer_rows(spark):
    data = fx.price_ring(spark, SF_SMALL)
    base = dict(c=1.0, gamma=5.0, tol=1e-3, working_set=128, eps=0.0)
    whole = fit_kernel_svm(data, SVMParams(**base, shrink_every=0))
    shrunk = fit_kernel_svm(data, SVMParams(**base, shrink_every=3))
    rows = shrunk.info["active_rows"]
    assert set(whole.info["active_rows"]) == {whole.info["distinct_rows"]}
    assert min(rows) < 0.7 * rows[0] and rows[-1] == rows[0] and shrunk.info["reconstructions"] >= 1
    assert sum(rows) < len(rows) * rows[0]
    assert shrunk.b == pytest.approx(whole.b, abs=2e-3)
    assert shrunk.info["dual"] == pytest.approx(whole.info["dual"], rel=1e-5)
    assert shrunk.info["gap"] <= 1e-3
    f = {(tuple(r.x)): r.score for r in whole.decision(data).collect()}
    g = {(tuple(r.x)): r.score for r in shrunk.decision(data).collect()}
    assert max(abs(f[k] - g[k]) for k in f) < 5e-3
    # every row is there again, with the right gradient
    state = shrunk.info["state"]
    assert state.count() == shrunk.info["distinct_rows"] == state.select("sid").distinct().count()
    basis = state.filter("alpha > 0").select("x", (F.col("alpha") * F.col("y")).alias("c"))
    worst = kernel_sum(state, basis, "c", "k", "rbf", 5.0, scale_col="y") \
        .agg(F.max(F.abs(F.col("k") - 1 - F.col("g")))).first()[0]
    assert worst < 1e-7


def test_shrinking_stops_whole_when_iterations_run_out(spark):
    data = fx.price_ring(spark, SF_SMALL)
    params = SVMParams(c=1.0, gamma=5.0, tol=1e-9, working_set=64, shrink_every=1, max_iter=4, allow_unconverged=True)
    model = fit_kernel_svm(data, params)
    state = model.info["state"]
    assert not model.info["converged"] and state.count() == model.info["distinct_rows"]
    assert model.info["duality_gap"] > 0
    with pytest.raises(NotConverged):
        fit_kernel_svm(data, params.set_tol(1e-12).__class__(**{**params.__dict__, "allow_unconverged": False}))


def test_settled_rows_cannot_violate(spark):
    s = "y double, alpha double, cap double, g double"
    rows = [(1.0, 0.0, 1.0, 5.0), (1.0, 0.0, 1.0, -5.0), (1.0, 0.5, 1.0, 5.0), (1.0, 1.0, 1.0, -9.0), (1.0, 1.0, 1.0, 9.0),
            (-1.0, 0.0, 1.0, 9.0), (-1.0, 0.0, 1.0, -9.0), (-1.0, 1.0, 1.0, -9.0), (-1.0, 1.0, 1.0, 9.0)]
    df = spark.createDataFrame(rows, s)
    got = [r.out for r in df.select("*", settled(1.0, -1.0).alias("out")).collect()]
    # at 0 with v = -y g below every low row, or at the cap above every up row
    assert got == [True, False, False, True, False, True, False, True, False]


def test_certificate_against_numpy(spark):
    data = fx.ring_samples(spark, SF_SMALL)
    model = fit_kernel_svm(data, SVMParams(c=0.3, gamma=5.0, tol=0.01))
    rows = model.info["state"].collect()
    X, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
    a, cap = np.array([r.alpha for r in rows]), np.array([r.cap for r in rows])
    K = block_kernel(X, X, "rbf", 5.0)
    w2 = (a * y) @ K @ (a * y)
    f = K @ (a * y) - model.b
    assert model.info["primal"] == pytest.approx(0.5 * w2 + (cap * np.maximum(0, 1 - y * f)).sum(), rel=1e-9)
    assert model.info["dual"] == pytest.approx(a.sum() - 0.5 * w2, rel=1e-9)
    # the gap bounds what is left, and is not negative
    assert 0 <= model.info["duality_gap"] < 0.01 * model.info["primal"]
    assert certificate(model.info["state"], model.b) == (model.info["primal"], model.info["dual"])


def test_a_start_is_prepared_once(spark):
    data = spark.createDataFrame([(0, [0.0], 1.0), (1, [1.0], 0.0)], "id long, x array<double>, label double")
    start = spark.createDataFrame([(0, 7.0)], "id long, alpha double")
    got = prepare_state(data, SVMParams(c=1.0), warm_start=start, repair=True).collect()
    assert sum(r.alpha * r.y for r in got) == pytest.approx(0.0, abs=1e-9)
    assert all(0 <= r.alpha <= 1 for r in got)


# ------------------------------------------------------------------ regression

def test_linear_svr_against_numpy(spark):
    rng = np.random.default_rng(2)
    X = rng.random((300, 3))
    y = X @ [2.0, -1.0, 0.5] + 3 + 0.1 * rng.normal(size=300)
    df = spark.createDataFrame([(X[i].tolist(), float(y[i])) for i in range(300)], "x array<double>, label double").repartition(4)
    Z = np.column_stack([X, y, np.ones(300)])
    assert np.allclose(gram_matrix(df), Z.T @ Z)
    for c in (0.01, 1.0, 100.0):
        m = fit_linear_svr(df, c=c)
        Xc, yc = X - X.mean(0), y - y.mean()
        w = np.linalg.solve(Xc.T @ Xc + np.eye(3) / c, Xc.T @ yc)
        assert np.allclose(m.weights, w)
        got = np.array([r.score for r in m.decision(df).orderBy("label").collect()])
        assert np.allclose(got, ((X @ w) + y.mean() - X.mean(0) @ w)[np.argsort(y)])


@pytest.mark.parametrize("rows", [[([1.0], None), ([2.0], 1.0)], [([1.0], float("nan"))], [([None], 1.0)], [(None, 1.0)], []])
def test_linear_svr_rejects_unusable_tables(spark, rows):
    with pytest.raises(Exception):
        fit_linear_svr(spark.createDataFrame(rows, "x array<double>, label double"))


def test_regression_report_follows_the_training_range(spark):
    rows = spark.createDataFrame([(i % 4 == 3, 100.0 + 7 * i + (i * i) % 11, [i / 40.0]) for i in range(40)],
                                 "is_test boolean, label double, x array<double>")
    train = rows.filter("not is_test").agg(F.min("label"), F.max("label")).first()
    got = {r.metric: r.value for r in R.regression_report(rows, tuple(train)).collect()}
    assert (got["train_rows"], got["test_rows"]) == (30.0, 10.0)
    data = rows.collect()
    X, y, t = np.array([r.x[0] for r in data]), np.array([r.label for r in data]), np.array([r.is_test for r in data])
    lo, hi = train
    u = (y - lo) / (hi - lo)
    xc = X[~t] - X[~t].mean()
    w = xc @ (u[~t] - u[~t].mean()) / (xc @ xc + 1.0)
    err = (u - (w * (X - X[~t].mean()) + u[~t].mean())) * (hi - lo)
    assert got["train_rmse"] == pytest.approx(np.sqrt((err[~t] ** 2).mean()))
    assert got["test_rmse"] == pytest.approx(np.sqrt((err[t] ** 2).mean()))
    # taken back to the range of all rows, the figures would be others
    unit = rows.withColumn("label", (F.col("label") - lo) / (hi - lo)).withColumn("prediction", F.col("label") + 0.1)
    def back(a, b):
        rng = one_row(spark).select(F.lit(float(a)).alias("mn"), F.lit(float(b)).alias("mx"))
        return {r.metric: r.value for r in M.eval_regression(unit, F.col("is_test"), "label", "prediction", rng).collect()}
    assert back(lo, hi)["test_rmse"] != pytest.approx(back(y.min(), y.max() + 50)["test_rmse"])


def test_regression_report_of_a_constant_target_and_an_empty_part(spark):
    rows = spark.createDataFrame([(False, 5.0, [float(i)]) for i in range(4)], "is_test boolean, label double, x array<double>")
    got = {r.metric: r.value for r in R.regression_report(rows, (5.0, 5.0)).collect()}
    assert got == {"train_rmse": 0.0, "test_rmse": None, "train_rows": 4.0, "test_rows": 0.0}


def test_the_type_file_picks_the_report(spark):
    got = {r.metric for r in R.svm_run(spark, SF_SMALL, "l_tax").collect()}
    assert got == {"train_rmse", "test_rmse", "train_rows", "test_rows"}
    with pytest.raises(Exception):
        R.svm_run(spark, SF_SMALL, "no_such_column")


def test_model_of_a_large_basis_scores_alike(spark):
    pm = fx.planted_model(spark, SF_SMALL)
    model = KernelModel(pm.filter("alpha > 0").select("x", "y", "alpha"), 0.1, "rbf", 0.5)
    one = {r.id: r.score for r in model.decision(pm).collect()}
    many = {r.id: r.score for r in model.decision(pm, max_broadcast_bytes=20_000).collect()}
    assert all(abs(one[i] - many[i]) < 1e-9 for i in one)


# ------------------------------------------------------------------ wide vectors

def wide_rows(spark, n, d, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        pos = rng.choice(d, rng.integers(0, 12), replace=False)
        rows.append((i, [int(p) for p in pos], rng.normal(size=len(pos)).tolist(), float(rng.normal())))
    df = spark.createDataFrame(rows, "id long, pos array<int>, val array<double>, coef double").repartition(4)
    X = np.zeros((n, d))
    for i, pos, val, _ in rows:
        X[i, pos] = val
    return df, X, np.array([r[3] for r in rows])


@pytest.mark.parametrize("width", [1, 7, 50, 64])
def test_blocked_weights_and_scores(spark, width):
    df, X, c = wide_rows(spark, 120, 50)
    dense = spark.createDataFrame([(i, X[i].tolist(), float(c[i])) for i in range(len(X))],
                                  "id long, x array<double>, coef double")
    for cols, table in ((("pos", "val"), df), ("x", dense)):
        w = W.blocked_weights(table, "coef", cols, width)
        got = np.zeros((-(-50 // width)) * width)
        for r in w.collect():
            got[r.block * width:(r.block + 1) * width] = r.w
        assert np.allclose(got[:50], X.T @ c) and not got[50:].any()
        scores = {r.id: r.score for r in W.blocked_score(table, w, 0.25, "id", cols, width).collect()}
        assert np.allclose([scores[i] for i in range(len(X))], X @ (X.T @ c) - 0.25)


def test_a_million_columns_without_a_row_of_them(spark, monkeypatch):
    monkeypatch.setattr(W, "HELD_VALUES", 20 * 4096)
    d = 1_000_000
    rng = np.random.default_rng(3)
    rows = [(i, sorted(int(p) for p in rng.choice(d, 30, replace=False)), rng.normal(size=30).tolist(), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, pos array<int>, val array<double>, coef double").repartition(3)
    w = W.blocked_weights(df, "coef", ("pos", "val"))
    assert w.agg(F.max(F.size("w"))).first()[0] == W.WIDTH
    got = {r.id: r.score for r in W.blocked_score(df, w, 0.0, "id", ("pos", "val")).collect()}
    total = {}
    for _, pos, val, _ in rows:
        for p, v in zip(pos, val):
            total[p] = total.get(p, 0.0) + v
    for i, pos, val, _ in rows:
        assert got[i] == pytest.approx(sum(total[p] * v for p, v in zip(pos, val)))


def test_wide_rows_in_salted_copies_and_rows_without_values(spark, monkeypatch):
    monkeypatch.setattr(W, "ROWS_A_TASK", 10)
    df, X, c = wide_rows(spark, 60, 30, 4)
    w = W.blocked_weights(df, "coef", ("pos", "val"), 8)
    scores = {r.id: r.score for r in W.blocked_score(df, w, 1.0, "id", ("pos", "val"), 8).collect()}
    assert np.allclose([scores[i] for i in range(60)], X @ (X.T @ c) - 1.0)
    none = spark.createDataFrame([(1, [], []), (2, [5000], [2.0])], "id long, pos array<int>, val array<double>")
    assert {r.id: r.score for r in W.blocked_score(none, w, 1.0, "id", ("pos", "val"), 8).collect()} == {1: -1.0, 2: -1.0}
    assert W.blocked_score(none.limit(0), w, 1.0, "id", ("pos", "val"), 8).collect() == []


@pytest.mark.parametrize("pos,val", [([0, 0], [1.0, 2.0]), ([0], [1.0, 2.0]), ([-1], [1.0]), ([0], [None]), ([None], [1.0]),
                                     (None, None), ([0], [float("nan")])])
def test_wide_rows_reject_bad_vectors(spark, pos, val):
    df = spark.createDataFrame([(1, pos, val)], "id long, pos array<int>, val array<double>")
    with pytest.raises(Exception, match="feature v|positions"):
        W.slice_rows(df, "id", ("pos", "val")).collect()


# ------------------------------------------------------------------ rounds and zones

def dual_rows(spark, n=60, seed=1, c=1.0):
    """A feasible state with its gradient, and its arrays."""
    rng = np.random.default_rng(seed)
    X, y = rng.normal(size=(n, 2)), np.where(np.arange(n) % 2, 1.0, -1.0)
    a = np.repeat(rng.choice([0.0, 0.3, c], n // 2), 2)
    K = block_kernel(X, X, "rbf", 0.5)
    g = y * (K @ (a * y)) - 1
    rows = [(i, X[i].tolist(), float(y[i]), c, float(a[i]), float(g[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, x array<double>, y double, cap double, alpha double, g double"), y, a, g, K


def round_twin(y, a, g, K, c, pairs):
    """The same round with plain loops."""
    v = -y * g
    up = [i for i in range(len(y)) if (y[i] > 0 and a[i] < c) or (y[i] < 0 and a[i] > 0)]
    low = [i for i in range(len(y)) if (y[i] > 0 and a[i] > 0) or (y[i] < 0 and a[i] < c)]
    up, low = sorted(up, key=lambda i: (-v[i], i))[:pairs], sorted(low, key=lambda i: (v[i], i))[:pairs]
    keep_up = [i for i in up if i not in low or up.index(i) <= low.index(i)]
    keep_low = [i for i in low if i not in up or low.index(i) < up.index(i)]
    d = np.zeros(len(y))
    for i, j in zip(keep_up, keep_low):
        if v[i] > v[j]:
            t = min((v[i] - v[j]) / (K[i, i] + K[j, j] - 2 * K[i, j]), c - a[i] if y[i] > 0 else a[i], a[j] if y[j] > 0 else c - a[j])
            d[i], d[j] = y[i] * t, -y[j] * t
    Qd = y * (K @ (d * y))
    s = min(1.0, -(g @ d) / (d @ Qd)) if d @ Qd > 0 else 1.0
    return a + s * d, g + s * Qd, s * (g @ d) + 0.5 * s * s * (d @ Qd)


@pytest.mark.parametrize("pairs", [1, 5, 40])
def test_rounds_against_a_plain_twin(spark, pairs):
    state, y, a, g, K = dual_rows(spark)
    for _ in range(3):
        state, one = RO.pair_round(state, "rbf", 0.5, pairs)
        want_a, want_g, change = round_twin(y, a, g, K, 1.0, pairs)
        rows = state.orderBy("id").collect()
        got_a, got_g = np.array([r.alpha for r in rows]), np.array([r.g for r in rows])
        assert np.allclose(got_a, want_a, atol=1e-9) and np.allclose(got_g, want_g, atol=1e-9)
        assert one.change == pytest.approx(change) and one.change < 0 < one.step <= 1
        assert abs((got_a * y).sum()) < 1e-9 and got_a.min() >= 0 and got_a.max() <= 1
        a, g = got_a, got_g


def test_rounds_reach_the_optimum(spark):
    state, y, a, g, K = dual_rows(spark, 40, 3)
    state, done = RO.solve_by_rounds(state, "rbf", 0.5, 60, tol=0.05, pairs=8)
    assert done and all(r.change <= 1e-12 for r in done) and len(done) < 60
    assert done[-1].gap < done[0].gap
    rows = state.orderBy("id").collect()
    a, g = np.array([r.alpha for r in rows]), np.array([r.g for r in rows])
    assert np.allclose(g, y * (K @ (a * y)) - 1, atol=1e-8)
    v = -y * g
    up, low = ((y > 0) & (a < 1)) | ((y < 0) & (a > 0)), ((y > 0) & (a > 0)) | ((y < 0) & (a < 1))
    assert v[up].max() - v[low].min() <= 0.05 + 1e-9


def test_a_round_without_violating_pairs_changes_nothing(spark):
    state, *_ = dual_rows(spark, 20, 5)
    same, one = RO.pair_round(state, "rbf", 0.5, 5, tol=1e9)
    assert one.moved == 0 and same.collect() == state.collect()


@pytest.mark.parametrize("k", [1, 10, 300])
def test_zone_maps_choose_as_a_full_scan(spark, k):
    rng = np.random.default_rng(k)
    rows = [(i, 1.0 if rng.random() < 0.5 else -1.0, 1.0, float(rng.choice([0.0, 0.5, 1.0])), float(np.round(rng.normal(), 1)))
            for i in range(2000)]
    state = spark.createDataFrame(rows, "id long, y double, cap double, alpha double, g double").repartition(5)
    zoned = RO.write_zoned(state, 20)
    for up in (True, False):
        got, files = RO.zoned_top(spark, zoned, k, up)
        v = RO.violation()
        want = state.filter(D.up_set() if up else D.low_set()).withColumn("v", v) \
            .orderBy(v.desc() if up else v.asc(), "id").limit(k).collect()
        assert [(r.id, r.v) for r in got] == [(r.id, r.v) for r in want]
        assert len(files) < len(zoned.zones) / 2 and len(set(files)) == len(files)


def test_zone_maps_of_an_empty_or_one_sided_state(spark):
    s = "id long, y double, cap double, alpha double, g double"
    assert RO.zoned_top(spark, RO.write_zoned(spark.createDataFrame([], s), 3), 2, True) == ([], [])
    zoned = RO.write_zoned(spark.createDataFrame([(1, 1.0, 1.0, 0.0, 2.0)], s), 3)
    assert RO.zoned_top(spark, zoned, 2, False) == ([], [])
    assert [r.id for r in RO.zoned_top(spark, zoned, 2, True)[0]] == [1]
