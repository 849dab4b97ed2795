"""
where the other test files do not already pin them down."""

import math

import pytest
from pyspark.sql import functions as F

from marginflow.functions.smo import pair_step
from marginflow.operators import dual as D
from marginflow.operators import metrics as M
from marginflow.operators.scoring import KernelModel


def test_q7_kernel_everywhere_sqdist_selectable(spark):
    sup = spark.createDataFrame([([0.0, 0.0], 1.0, 0.5), ([1.0, 1.0], -1.0, 0.25)],
                                "x array<double>, y double, alpha double")
    pts = spark.createDataFrame([(1, [0.5, 0.0])], "id long, x array<double>")
    d2 = [0.25, 1.25]
    coef = [0.5, -0.25]
    rbf = KernelModel(sup, 0.1, "rbf", 2.0).decision(pts).first().score
    sq = KernelModel(sup, 0.1, "sqdist", 2.0).decision(pts).first().score
    assert rbf == pytest.approx(sum(c * math.exp(-2.0 * d) for c, d in zip(coef, d2)) - 0.1)
    assert sq == pytest.approx(sum(c * d for c, d in zip(coef, d2)) - 0.1)


def test_q9_step_uses_y_of_the_second_row():
    # labels differ; the Newton step moves a2 by -y2 (E1 - E2) / eta
    k11 = k22 = 1.0
    k12 = 0.2
    eta = 2 * k12 - k11 - k22
    a1, a2, _ = pair_step(1.0, -1.0, 0.3, 0.3, 0.4, -0.2, k11, k12, k22, 1.0, 1.0)
    want = 0.3 - (-1.0) * (0.4 - (-0.2)) / eta
    assert a2 == pytest.approx(min(max(want, 0.0), 1.0))
    assert a1 == pytest.approx(0.3 + (-1.0) * (0.3 - a2))


def test_q11_q12_flat_curvature_takes_the_smaller_end():
    # identical points (eta = 0), same labels: the end with the lower
    # objective is chosen; with E1 < E2 moving weight to row 1 helps
    y1 = y2 = 1.0
    a1, a2, _ = pair_step(y1, y2, 0.2, 0.2, -1.0, 0.5, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 1e-9)
    lo, hi = 0.0, 0.4
    def obj(a2n):
        a1n = 0.4 - a2n
        f1 = y1 * (-1.0) - 0.2 - 0.2
        f2 = y2 * 0.5 - 0.2 - 0.2
        return a1n * f1 + a2n * f2 + 0.5 * a1n ** 2 + 0.5 * a2n ** 2 + a1n * a2n
    best = lo if obj(lo) < obj(hi) else hi
    assert a2 == pytest.approx(best)
    assert a1 + a2 == pytest.approx(0.4)


def test_q13_b_from_the_free_multiplier():
    # a1 ends strictly inside (0, C): b = b1
    args = (1.0, -1.0, 0.3, 0.3, 0.1, 0.0, 1.0, 0.2, 1.0, 1.0, 1.0)
    a1, a2, b = pair_step(*args, b=0.05)
    assert 0 < a1 < 1
    b1 = 0.1 + 1.0 * (a1 - 0.3) * 1.0 + (-1.0) * (a2 - 0.3) * 0.2 + 0.05
    assert b == pytest.approx(b1)


def _state(spark, rows):
    return spark.createDataFrame(rows, "id long, y double, alpha double, cap double, e double")


def test_q16_no_free_row_means_no_second_choice(spark):
    st = _state(spark, [(0, 1.0, 0.0, 1.0, -2.0), (1, -1.0, 1.0, 1.0, 0.5), (2, 1.0, 0.0, 1.0, 0.1)])
    first = D.first_choice(st, 0.01)
    assert first.first().id == 0
    assert D.second_choice(st, first).count() == 0       # NULL, not row 0


def test_q18_true_argmax_ties_by_lowest_id(spark):
    st = _state(spark, [(0, 1.0, 0.0, 1.0, -2.0), (1, 1.0, 0.5, 1.0, 1.0),
                        (2, 1.0, 0.5, 1.0, -5.0), (3, 1.0, 0.5, 1.0, 1.0)])
    first = D.first_choice(st, 0.01)
    assert first.first().id == 2          # largest |E| among violators
    r = D.second_choice(st, first).first()
    assert (r.i, r.j) == (2, 1)           # |E_2 - E_j| = 6 for j = 1 and 3: lowest id


def test_q19_seeded_offset_wraps_round(spark):
    st = _state(spark, [(i, 1.0, 0.5 if i % 3 == 0 else 0.0, 1.0, 0.0) for i in range(10)])
    st = st.withColumn("e", F.when(F.col("id") == 4, F.lit(-3.0)).otherwise(F.col("e")))
    first = D.first_choice(st, 0.01)
    seed = 7
    k0 = (seed * D.OFFSET_MULTIPLIER) % 10
    free = [i for i in range(10) if i % 3 == 0 and i != 4]
    want = min([i for i in free if i >= k0] or free)
    got = D.fallback_choice(st, first, seed, free_only=True).first()
    assert (got.i, got.k0, got.j) == (4, k0, want)
    any_row = D.fallback_choice(st, first, seed, free_only=False).first()
    rest = [i for i in range(10) if i != 4]
    assert any_row.j == min([i for i in rest if i >= k0] or rest)


def test_q23_test_precision_is_computed_on_test_rows(spark):
    train = spark.createDataFrame([(1.0, 1.0), (0.0, 0.0)], "label double, prediction double")
    test = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    both = train.withColumn("test", F.lit(False)).unionByName(test.withColumn("test", F.lit(True)))
    got = {r.metric: r.value for r in M.eval_classification(both, F.col("test")).collect()}
    assert got["train_precision"] == 1.0 and got["test_precision"] == 0.5
    assert got["random_precision"] == pytest.approx(0.5 * 0.5 + 0.5 * 0.5)
