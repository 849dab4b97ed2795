"""Scoring on a stream, Fourier features, linear kernel, checked broadcast, the run."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.operators import metrics as M
from marginflow.operators.dual import broadcast_if_small
from marginflow.operators.scoring import KernelModel
from marginflow.operators.trainers import fit_linear_svc, fit_rff_svc
from marginflow.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_scoring_a_stream(spark, tmp_path):
    """The Arrow scoring map is stateless, so it runs unchanged on readStream."""
    emb = fx.embeddings(spark, SF_SMALL)
    sup = emb.limit(20).select("x", fx.embeddings_y().alias("y"), F.lit(0.05).alias("alpha"))
    model = KernelModel(sup, 0.05, "rbf", 0.5, 0.1)
    batch = {r.id: r.score for r in model.decision(emb).collect()}
    folder = str(tmp_path / "emb")
    spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").write.parquet(folder)
    src = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    rows = src.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"))
    q = (model.decision(rows).select("id", "score").writeStream.format("memory")
         .queryName("scored_stream").option("checkpointLocation", str(tmp_path / "ck")).start())
    try:
        q.processAllAvailable()
        streamed = {r.id: r.score for r in spark.sql("SELECT * FROM scored_stream").collect()}
    finally:
        q.stop()
    assert streamed.keys() == batch.keys()
    assert all(abs(streamed[k] - batch[k]) < 1e-9 for k in batch)


def test_rff_learns_the_ring(spark):
    data = fx.ring_samples(spark, SF_SMALL)
    model = fit_rff_svc(data, gamma=5.0, n_features=64, seed=3)
    acc = M.accuracy(model.transform(data)).first().accuracy
    assert acc >= 0.95


def test_linear_svc_is_a_linear_kernel_model(spark):
    rows = [([float(i), float(i % 3)], 1.0 if i > 10 else 0.0) for i in range(22)]
    df = spark.createDataFrame(rows, "x array<double>, label double")
    model = fit_linear_svc(df)
    acc = M.accuracy(model.transform(df)).first().accuracy
    assert acc == 1.0
    w = np.array(model.support.first().x)
    got = {tuple(r.x): r.score for r in model.decision(df).collect()}
    for x, s in got.items():
        assert s == pytest.approx(float(np.dot(w, x)) - model.b, abs=1e-9)


def test_broadcast_if_small_marks_only_small_tables(spark):
    small = spark.range(5)
    big = spark.range(50)
    joined = spark.range(100).join(broadcast_if_small(small, max_bytes=200), "id")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert broadcast_if_small(big, max_bytes=200) is big


def test_chunked_basis_merges_duplicates(spark):
    """Over-budget bases merge identical vectors (coefficients add) before
    chunking; the sum is unchanged."""
    from marginflow.operators.scoring import kernel_sum
    rng = np.random.default_rng(4)
    pts = rng.normal(size=(40, 3))
    rows = [(i, pts[i % 40].tolist(), float(i % 5 - 2)) for i in range(400)]   # each point 10 times
    df = spark.createDataFrame(rows, "id long, x array<double>, coef double")
    small = {r.id: r.s for r in kernel_sum(df, df, "coef", "s", "rbf", 0.3,
                                           max_broadcast_bytes=1500).collect()}
    X = np.array([r[1] for r in rows]); c = np.array([r[2] for r in rows])
    want = np.exp(-0.3 * ((X[:, None] - X[None]) ** 2).sum(-1)) @ c
    assert all(abs(small[i] - want[i]) < 1e-9 for i in range(400))


def test_local_rows_checks_its_bound(spark):
    from marginflow.operators.dual import local_rows
    df = spark.range(3).select("id", (F.col("id") * 0.5).alias("v"))
    back = local_rows(df, 3)
    assert sorted((r.id, r.v) for r in back.collect()) == [(0, 0.0), (1, 0.5), (2, 1.0)]
    assert back.schema == df.schema
    with pytest.raises(ValueError):
        local_rows(df, 2)
    assert local_rows(df.filter("id > 5"), 2).count() == 0


def test_task_count_follows_bytes(spark):
    from marginflow.operators.trainers import TASK_BYTES, sized, task_count
    assert [task_count(b) for b in (0, 1, 16 << 10, 64 << 10, 1 << 20)] == [1, 1, 1, 2, 8]
    assert task_count(100 << 40) == (100 << 40) // TASK_BYTES
    assert sized(spark.range(0, 15000, numPartitions=1), 15000, 1).rdd.getNumPartitions() > 1


def test_report_with_the_exact_trainer(spark):
    """E9 end to end on sf0.001 with the trainer the caller asks for."""
    from marginflow.operators.trainers import SVMParams
    from marginflow.plans.run import classification_run
    params = SVMParams(c=1.0, gamma=5.0, tol=0.05)
    got = {r.metric: r.value for r in classification_run(spark, SF_SMALL, params, trainer="exact").collect()}
    assert got["converged"] == got["train_accurate"] == 1.0
    assert got["distinct_train_rows"] <= got["train_rows"] and 0.0 < got["random_precision"] < 1.0
    with pytest.raises(ValueError, match="trainer"):
        classification_run(spark, SF_SMALL, trainer="auto")
