"""Hand-made unit cases (FIXTURES.md sec. 4) and the defect decisions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.functions.kernels import block_kernel, block_kernel_sum
from marginflow.functions.smo import pair_step
from marginflow.operators import dual as D
from marginflow.operators import metrics as M
from marginflow.operators import prep as P
from marginflow.operators.scoring import KernelModel, kernel_sum, linear_weights
from marginflow.operators.trainers import SVMParams, fit_kernel_svm, solve_subproblem
from marginflow.sources import text as TX


def arr_df(spark, rows, schema="id long, x array<double>, label double"):
    return spark.createDataFrame(rows, schema)


# ------------------------------------------------------------------ sources

def test_csv_failfast_bad_field(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("a,b\n1.0,2.0\n3.0,oops\n")
    df = TX.read_delimited(spark, str(p), ["a", "b"])
    with pytest.raises(Exception):
        df.collect()


def test_csv_reads_typed(spark, tmp_path):
    p = tmp_path / "ok.csv"
    p.write_text("a,b\n1.0,2.0\n3.5,-4\n")
    rows = TX.read_delimited(spark, str(p), ["a", "b"]).orderBy("a").collect()
    assert [(r.a, r.b) for r in rows] == [(1.0, 2.0), (3.5, -4.0)]


def test_split_fields_short_row_and_bad_number(spark):
    lines = spark.createDataFrame([("1,2,3",), ("4,5",)], "value string")
    with pytest.raises(Exception):
        TX.parse_lines(lines, ["a", "b", "c"]).collect()
    bad = spark.createDataFrame([("1,x,3",)], "value string")
    with pytest.raises(Exception):
        TX.parse_lines(bad, ["a", "b", "c"]).collect()
    ok = TX.parse_lines(spark.createDataFrame([("1, 2,3",)], "value string"), ["a", "b", "c"]).first()
    assert (ok.a, ok.b, ok.c) == (1.0, 2.0, 3.0)


def test_name_and_type_files(spark, tmp_path):
    (tmp_path / "names.txt").write_text("f1\nf2\ntarget\n")
    (tmp_path / "types.txt").write_text("2,0\n2\n1,5\n")
    names = TX.read_names(spark, str(tmp_path / "names.txt"))
    types = TX.read_types(spark, str(tmp_path / "types.txt"))
    t = TX.task_type(names, types, "target").first()
    assert (t.target, t.pos, t.code, t.task) == ("target", 2, 1, "Classification")
    t2 = TX.task_type(names, types, "f1").first()
    assert t2.task == "Regression"
    with pytest.raises(Exception):
        TX.task_type(names, types, "missing").collect()


# ------------------------------------------------------------------ preparation

@pytest.mark.parametrize("t,label,feats", [(0, 1.0, [2.0, 3.0]), (1, 2.0, [1.0, 3.0]),
                                           (2, 3.0, [1.0, 2.0])])
def test_target_split_positions(spark, t, label, feats):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
    r = P.target_split(df, "v", t).first()
    assert r.label == label and list(r.x) == feats


def test_target_split_one_column(spark):
    df = spark.createDataFrame([([7.0],)], "v array<double>")
    r = P.target_split(df, "v", 0).first()
    assert r.label == 7.0 and list(r.x) == []


def test_constant_table_scales_to_zero(spark):
    df = arr_df(spark, [(1, [5.0, 5.0], 1.0), (2, [5.0, 5.0], 0.0)])
    assert all(v == 0.0 for r in P.scale_global(df).collect() for v in r.x)
    assert all(v == 0.0 for r in P.scale_per_column(df, "x").collect() for v in r.x)


def test_scale_per_column_matches_minmaxscaler(spark):
    from pyspark.ml.feature import MinMaxScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    rnd = random.Random(3)
    rows = [(i, [rnd.uniform(-5, 5), rnd.uniform(100, 200), rnd.uniform(0, 1)], 0.0) for i in range(50)]
    df = arr_df(spark, rows)
    ours = {r.id: r.x for r in P.scale_per_column(df, "x").collect()}
    vec = df.withColumn("v", array_to_vector("x"))
    model = MinMaxScaler(inputCol="v", outputCol="s").fit(vec)
    theirs = {r.id: r.s for r in model.transform(vec).select("id", vector_to_array("s").alias("s")).collect()}
    for k in ours:
        assert np.allclose(ours[k], theirs[k], atol=1e-12)


def test_scale_global_uses_one_range(spark):
    df = arr_df(spark, [(1, [0.0, 10.0], 0.0), (2, [5.0, 20.0], 0.0)])
    got = {r.id: list(r.x) for r in P.scale_global(df).collect()}
    assert got == {1: [0.0, 0.5], 2: [0.25, 1.0]}


def test_one_hot_slots_and_decode(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "b")], "id int, cls string")
    oh = {r.id: list(r.onehot) for r in P.one_hot(df, "cls").collect()}
    assert oh == {1: [0.0, 1.0, 0.0], 2: [1.0, 0.0, 0.0], 3: [0.0, 0.0, 1.0], 4: [0.0, 1.0, 0.0]}
    back = P.one_hot(df, "cls").select("id", P.one_hot_decode("onehot").alias("k")).collect()
    assert {r.id: r.k for r in back} == {1: 1, 2: 0, 3: 2, 4: 1}


def test_one_hot_decode_edge_rows(spark):
    df = spark.createDataFrame([([0.1, 0.2, 0.3],), ([0.9, 0.1, 0.7],)], "s array<double>")
    got = [r.k for r in df.select(P.one_hot_decode("s").alias("k")).collect()]
    assert got == [0, 2]   # none set -> 0; two set -> the last one


def test_class_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (1.0,)], "label double")
    assert P.class_count(df).first().n_classes == 2


# ------------------------------------------------------------------ kernels / steps

def test_block_kernel_matches_direct():
    rng = np.random.default_rng(0)
    X, S = rng.normal(size=(30, 5)) * 1e4, rng.normal(size=(7, 5)) * 1e4
    d2 = ((X[:, None, :] - S[None, :, :]) ** 2).sum(-1)
    assert np.allclose(block_kernel(X, S, "sqdist", 0.0), d2, rtol=1e-9)
    assert np.allclose(block_kernel(X, S, "linear", 0.0), X @ S.T)
    X, S = rng.normal(size=(30, 5)), rng.normal(size=(7, 5))
    d2 = ((X[:, None, :] - S[None, :, :]) ** 2).sum(-1)
    assert np.allclose(block_kernel(X, S, "rbf", 0.3), np.exp(-0.3 * d2))
    c = rng.normal(size=7)
    assert np.allclose(block_kernel_sum(X, S, c, "rbf", 0.3, max_cells=20), np.exp(-0.3 * d2) @ c)


def test_staged_pair_step_equals_scalar(spark):
    from marginflow.functions.smo import with_pair_step_columns
    rnd = random.Random(12)
    rows = []
    for k in range(200):
        a1, a2 = rnd.choice([0.0, 0.5, rnd.uniform(0, 0.5)]), rnd.choice([0.0, 0.5, rnd.uniform(0, 0.5)])
        k12 = 1.0 if k % 9 == 0 else rnd.uniform(0, 1)
        rows.append((k, rnd.choice([-1.0, 1.0]), rnd.choice([-1.0, 1.0]), a1, a2, rnd.uniform(-2, 2),
                     rnd.uniform(-2, 2), 1.0, k12, 1.0, 0.5, 0.5))
    df = spark.createDataFrame(rows, "k int, y1 double, y2 double, a1 double, a2 double, e1 double, "
                                     "e2 double, k11 double, k12 double, k22 double, c1 double, c2 double")
    out = with_pair_step_columns(df, "y1", "y2", "a1", "a2", "e1", "e2", "k11", "k12", "k22",
                                 "c1", "c2", -0.2, 1e-3)
    assert set(out.columns) == set(df.columns) | {"a1_new", "a2_new", "b_new"}
    got = {r.k: (r.a1_new, r.a2_new, r.b_new) for r in out.collect()}
    for row in rows:
        assert np.allclose(got[row[0]], pair_step(*row[1:], b=-0.2, eps=1e-3), atol=1e-12)


def test_pair_step_identical_points_opposite_labels():
    # curvature 0: end-point rule; same point with opposite labels
    a1, a2, _ = pair_step(1.0, -1.0, 0.0, 0.0, -1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 1e-3)
    assert 0.0 <= a2 <= 1.0 and a1 == a2


def test_pair_step_same_labels_no_room():
    # same labels at alpha 0: L = H = 0, nothing moves
    assert pair_step(1.0, 1.0, 0.0, 0.0, -1.0, -1.0, 1.0, 0.2, 1.0, 1.0, 1.0)[:2] == (0.0, 0.0)


def test_pair_bounds(spark):
    df = spark.createDataFrame([(2, 1.0, 0.2, 0.0, 0.5), (3, 3.0, 0.7, 0.0, 0.5),
                                (4, 5.0, 0.3, 0.0, 0.5), (5, -6.0, 0.4, 0.0, 0.5)],
                               "id long, y double, alpha double, x double, cap double")
    df = df.withColumn("y", F.when(F.col("y") > 0, 1.0).otherwise(-1.0))
    got = {(r.i, r.j): (r.lo, r.hi) for r in D.with_pair_bounds(D.pair_rows(df, ["y", "cap", "alpha"])).collect()}
    # (2,3): same labels, a=(0.2,0.7), C=.5 -> L=max(0,.9-.5)=.4, H=min(.5,.9)=.5
    assert got[(2, 3)] == pytest.approx((0.4, 0.5))
    # (4,5): labels differ, a=(0.3,0.4) -> L=max(0,.1)=.1, H=min(.5,.5+.1)=.5
    assert got[(4, 5)] == pytest.approx((0.1, 0.5))


def test_kernel_sum_chunked_equals_single(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist(), float(rng.normal())) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x array<double>, coef double")
    one = {r.id: r.s for r in kernel_sum(df, df, "coef", "s", "rbf", 0.7).collect()}
    many = {r.id: r.s for r in kernel_sum(df, df, "coef", "s", "rbf", 0.7,
                                          max_broadcast_bytes=2000).collect()}
    X = np.array([r[1] for r in rows]); c = np.array([r[2] for r in rows])
    want = np.exp(-0.7 * ((X[:, None] - X[None]) ** 2).sum(-1)) @ c
    for i in range(200):
        assert one[i] == pytest.approx(want[i], abs=1e-9)
        assert many[i] == pytest.approx(want[i], abs=1e-9)


def test_linear_weights(spark):
    df = spark.createDataFrame([([1.0, 2.0], 0.5), ([3.0, -1.0], -1.0)], "x array<double>, coef double")
    got = {r.pos: r.w for r in linear_weights(df).collect()}
    assert got == {0: pytest.approx(-2.5), 1: pytest.approx(2.0)}


def test_warm_state_rejects_out_of_bounds(spark):
    s = spark.createDataFrame([(0, [0.0], 1.0), (1, [1.0], -1.0)], "id long, x array<double>, y double")
    w = spark.createDataFrame([(0, 2.0)], "id long, alpha double")
    with pytest.raises(Exception):
        D.warm_state(s, w, 1.0, "rbf", 1.0).collect()


# ------------------------------------------------------------------ metrics

def test_random_precision_class_missing_in_test(spark):
    tr = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (2.0,)], "label double")
    te = spark.createDataFrame([(0.0,), (2.0,)], "label double")
    both = tr.withColumn("test", F.lit(False)).unionByName(te.withColumn("test", F.lit(True)))
    got = M.random_precision(both, F.col("test")).first().random_precision
    assert got == pytest.approx(0.25 * 0.5 + 0.5 * 0.5)


def test_class_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 2)), float(rnd.randint(0, 2))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = M.class_metrics(df).collect()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    acc = ev.setMetricName("accuracy").evaluate(df)
    assert ours[0].overall_precision == pytest.approx(acc)
    for r in ours:
        p = ev.setMetricName("precisionByLabel").setMetricLabel(r.cls).evaluate(df)
        rc = ev.setMetricName("recallByLabel").setMetricLabel(r.cls).evaluate(df)
        assert r.precision == pytest.approx(p) and r.recall == pytest.approx(rc)
    assert M.accuracy(df).first().accuracy == pytest.approx(acc)


def test_rmse_matches_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.5), (0.0, -1.0)], "label double, prediction double")
    want = RegressionEvaluator(metricName="rmse").evaluate(df)
    got = M.rmse(df).first()
    assert got.rmse == pytest.approx(want)
    e = df.withColumn("err", F.col("label") - F.col("prediction"))
    assert M.half_mse(e).first().half_mse == pytest.approx(0.5 * want ** 2)


def test_denormalise_round_trip(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 6.0)], "label double, prediction double")
    rng = M.value_range(df, ["label", "prediction"])
    r = rng.first()
    assert (r.mn, r.mx) == (1.0, 6.0)
    scaled = df.select(*[((F.col(c) - 1.0) / 5.0).alias(c) for c in ("label", "prediction")])
    back = M.denormalise(scaled, ["label", "prediction"], rng).orderBy("label").collect()
    assert [(b.label, b.prediction) for b in back] == [(1.0, 4.0), (2.0, 6.0)]


# ------------------------------------------------------------------ training

def test_two_points_closed_form(spark):
    df = arr_df(spark, [(0, [0.0], 1.0), (1, [1.0], 0.0)])
    m = fit_kernel_svm(df, SVMParams(c=10.0, kernel="linear", tol=1e-9))
    sup = {r.y: r.alpha for r in m.support.collect()}
    assert sup == {1.0: pytest.approx(2.0), -1.0: pytest.approx(2.0)}
    assert m.b == pytest.approx(-1.0)
    scored = {r.id: r.score for r in m.decision(df).collect()}
    assert scored[0] == pytest.approx(1.0) and scored[1] == pytest.approx(-1.0)


def test_single_class_raises(spark):
    df = arr_df(spark, [(0, [0.0], 1.0), (1, [1.0], 1.0)])
    with pytest.raises(ValueError, match="both classes"):
        fit_kernel_svm(df, SVMParams(c=1.0))


def test_empty_table_raises(spark):
    df = arr_df(spark, [])
    with pytest.raises(ValueError):
        fit_kernel_svm(df, SVMParams(c=1.0))


def test_c_zero_rejected():
    with pytest.raises(ValueError):
        SVMParams(c=0.0)


def test_subproblem_reaches_tolerance():
    rng = np.random.default_rng(2)
    X = rng.normal(size=(40, 2)); y = np.where(X[:, 0] * X[:, 1] > 0, 1.0, -1.0)
    K = block_kernel(X, X, "rbf", 1.0)
    a, _ = solve_subproblem(K, y, np.zeros(40), -np.ones(40), np.full(40, 1.0), 1e-6, 100000)
    g = (y[:, None] * y[None] * K) @ a - 1
    v = -y * g
    up = ((y > 0) & (a < 1)) | ((y < 0) & (a > 0))
    low = ((y > 0) & (a > 0)) | ((y < 0) & (a < 1))
    assert v[up].max() - v[low].min() <= 1e-6
    assert abs((a * y).sum()) < 1e-12 and a.min() >= 0 and a.max() <= 1


@pytest.fixture(scope="module")
def ring(spark):
    from marginflow.sources import fixtures as fx
    return fx.ring_samples(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def ring_model(ring):
    return fit_kernel_svm(ring, SVMParams(c=1.0, gamma=5.0, tol=0.01, working_set=32,
                                          checkpoint_every=3))


def test_training_properties(ring_model):
    st = ring_model.info["state"]
    r = st.agg(F.min("alpha").alias("lo"), F.max(F.col("alpha") - F.col("cap")).alias("over"),
               F.sum(F.col("alpha") * F.col("y")).alias("ay")).first()
    assert r.lo >= 0 and r.over <= 1e-12
    assert abs(r.ay) <= 1e-8
    assert ring_model.info["converged"] and ring_model.info["gap"] <= 0.01
    assert ring_model.info["iterations"] > 3   # crosses a checkpoint boundary
    sup = ring_model.support.agg(F.max("alpha")).first()[0]
    assert sup <= 1.0 + 1e-12   # per-row alpha stays within C after the merge


def test_ring_accuracy(ring, ring_model):
    acc = M.accuracy(ring_model.transform(ring)).first().accuracy
    majority = ring.agg(F.avg("label")).first()[0]
    assert acc >= 0.97 and acc > max(majority, 1 - majority) + 0.2


def test_dedup_matches_plain(spark):
    rnd = random.Random(9)
    pts = [[rnd.randint(0, 4) / 4, rnd.randint(0, 4) / 4] for _ in range(120)]
    rows = [(i, p, 1.0 if (p[0] - .5) ** 2 + (p[1] - .5) ** 2 < .12 else 0.0) for i, p in enumerate(pts)]
    df = arr_df(spark, rows)
    prm = SVMParams(c=1.0, gamma=4.0, tol=1e-4)
    a = fit_kernel_svm(df, prm)
    b = fit_kernel_svm(df, SVMParams(c=1.0, gamma=4.0, tol=1e-4, dedup=False))
    sa = {r.id: r.score for r in a.decision(df).collect()}
    sb = {r.id: r.score for r in b.decision(df).collect()}
    assert max(abs(sa[k] - sb[k]) for k in sa) < 5e-3


def test_repartition_invariance(spark, ring):
    prm = SVMParams(c=1.0, gamma=5.0, tol=1e-3)
    a = fit_kernel_svm(ring, prm)
    b = fit_kernel_svm(ring.repartition(5), prm)
    grid = spark.createDataFrame([(i * 11 + j, [i / 10, j / 10]) for i in range(11) for j in range(11)],
                                 "id long, x array<double>")
    sa = {r.id: r.score for r in a.decision(grid).collect()}
    sb = {r.id: r.score for r in b.decision(grid).collect()}
    assert max(abs(sa[k] - sb[k]) for k in sa) < 1e-6
    assert a.b == pytest.approx(b.b, abs=1e-6)


def test_warm_start_from_solution(spark):
    df = arr_df(spark, [(0, [0.0], 1.0), (1, [1.0], 0.0), (2, [3.0], 0.0)])
    m = fit_kernel_svm(df, SVMParams(c=10.0, kernel="linear", tol=1e-9, dedup=False))
    st = m.info["state"]
    # reuse the solution as a warm start keyed by row id (rows are distinct points)
    warm = df.join(st.select(F.col("x"), "alpha"), "x").select("id", "alpha")
    m2 = fit_kernel_svm(df, SVMParams(c=10.0, kernel="linear", tol=1e-9, dedup=False),
                        warm_start=warm)
    assert m2.info["iterations"] <= 1
    assert m2.b == pytest.approx(m.b)


def test_model_save_load(spark, tmp_path, ring_model, ring):
    path = str(tmp_path / "model")
    ring_model.save(path)
    back = KernelModel.load(spark, path)
    a = M.accuracy(ring_model.transform(ring)).first().accuracy
    b = M.accuracy(back.transform(ring)).first().accuracy
    assert a == b
