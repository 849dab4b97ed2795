"""Trainers: exact kernel SVM (T1-T3), linear SVM (T15), Fourier-feature SVM.

Exact kernel trainer (re-aim of the reference's one-pass SMO loop)
-----------------------------------------------------------------
Working-set decomposition over a dual-state table (sid, x, y, mult, cap,
alpha, g).  Per outer iteration:

1. two top-k jobs pick q/2 rows of the "up" set by -y*g descending and q/2
   of the "low" set ascending (per-partition top-k merged on the driver,
   never a sort of the table); their difference is the optimality gap;
2. the q x q sub-problem is solved on the driver with corrected pair steps
   (its size is fixed by q, not by the data);
3. one Arrow map over all rows adds y * sum_j dalpha_j y_j K(x_j, x) to g
   and writes the q new alphas (the q rows travel with the task closure).

The state is persisted each iteration and written to the shared checkpoint
folder every ``checkpoint_every`` iterations, so lineage (and the
recomputation after a lost executor) stays bounded.  Its partition count
follows its bytes.

Shrinking: every ``shrink_every`` iterations the rows that sit at a bound and
lie beyond the most violating rows of the other set are written apart, and
the following iterations pass over the active rows alone.  When those meet
the tolerance, the gradients of the rows put apart are computed again from
the support rows (one kernel sum), all rows join in again, and training goes
on until the gap of the whole table is within the tolerance, so the result
is that of the trainer without shrinking.

Certificate: at the end one aggregate gives the primal objective
0.5 |w|^2 + C sum(hinge) beside the dual one; their difference bounds how far
the model is from the optimum, whatever stopped the trainer.

Duplicate rows are merged first: identical (x, y) rows share one
multiplier with box bound C * multiplicity.  This is exact (any optimum can
be averaged over identical rows) and turns a heavily repeated point, however
many rows it has, into one row before anything iterates.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.functions.kernels import block_kernel, block_kernel_sum, check_kernel
from marginflow.functions.smo import pair_step
from marginflow.operators.dual import broadcast_if_small, low_set, project_start, up_set
from marginflow.operators.scoring import (DEFAULT_BROADCAST_BYTES, KernelModel,
                                          arrow_matrix, kernel_sum)
from marginflow.session import ensure_checkpoint_dir, one_row, shared_table

# fixed values: the reference trainer's defaults (C, eps, gamma, tolerance)
DEFAULT_C = 0.1
DEFAULT_EPS = 0.001
DEFAULT_GAMMA = 0.01
DEFAULT_TOL = 0.01

STATE_SCHEMA = T.StructType([
    T.StructField("sid", T.LongType(), False),
    T.StructField("x", T.ArrayType(T.DoubleType(), False), False),
    T.StructField("y", T.DoubleType(), False),
    T.StructField("mult", T.LongType(), False),
    T.StructField("cap", T.DoubleType(), False),
    T.StructField("alpha", T.DoubleType(), False),
    T.StructField("g", T.DoubleType(), False),
])


@dataclass(frozen=True)
class SVMParams:
    """Trainer settings (T1).  ``set_*`` return a changed copy, like the
    reference's fluent setters; every value is validated."""

    c: float = DEFAULT_C
    gamma: float = DEFAULT_GAMMA
    eps: float = DEFAULT_EPS
    tol: float = DEFAULT_TOL
    kernel: str = "rbf"
    working_set: int = 512
    max_iter: int = 1000
    max_inner: int = 20000
    checkpoint_every: int = 10
    shrink_every: int = 10      # 0: never
    dedup: bool = True
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES
    allow_unconverged: bool = False

    def __post_init__(self):
        if not self.c > 0:
            raise ValueError("C must be > 0 (C = 0 leaves no feasible non-zero alpha)")
        if self.gamma < 0:
            raise ValueError("gamma must be >= 0")
        if self.tol <= 0 or self.eps < 0:
            raise ValueError("tol must be > 0 and eps >= 0")
        if self.working_set < 2:
            raise ValueError("working_set must be >= 2")
        if self.max_iter < 1 or self.checkpoint_every < 1 or self.shrink_every < 0:
            raise ValueError("max_iter and checkpoint_every must be >= 1, shrink_every >= 0")
        check_kernel(self.kernel)

    def set_c(self, c: float) -> "SVMParams":
        return replace(self, c=c)

    def set_gamma(self, gamma: float) -> "SVMParams":
        return replace(self, gamma=gamma)

    def set_eps(self, eps: float) -> "SVMParams":
        return replace(self, eps=eps)

    def set_tol(self, tol: float) -> "SVMParams":
        return replace(self, tol=tol)


# --------------------------------------------------------------------------
# driver-side sub-problem (bounded by the working-set size)
# --------------------------------------------------------------------------

def solve_subproblem(K: np.ndarray, y: np.ndarray, alpha: np.ndarray, g: np.ndarray,
                     cap: np.ndarray, tol: float, max_steps: int, eps: float = 0.0):
    """Pair steps on the working set until its own gap <= tol.

    g is the full gradient restricted to the set; it is kept current with
    the set's own Q columns.  The pair is chosen by second-order selection:
    i = the most violating row of the up set, j = the low-set row with the
    largest guaranteed decrease b^2 / a (a = K_ii + K_jj - 2 K_ij), which
    needs far fewer steps than the maximal violating pair when bounds are
    large (merged duplicates).  A flat pair whose ends differ by less than
    ``eps`` stays where it is, and another partner is tried; the most
    violating row of all is moved even so.  Returns (new alpha, steps).
    """
    a = alpha.astype(np.float64).copy()
    G = g.astype(np.float64).copy()
    Q = (y[:, None] * y[None, :]) * K
    diag = np.diag(K).copy()
    steps = 0
    for steps in range(1, max_steps + 1):
        v = -y * G
        up = ((y > 0) & (a < cap)) | ((y < 0) & (a > 0))
        low = ((y > 0) & (a > 0)) | ((y < 0) & (a < cap))
        if not up.any() or not low.any():
            break
        i = int(np.flatnonzero(up)[np.argmax(v[up])])
        if v[i] - v[low].min() <= tol:
            break
        cand = low & (v < v[i])
        gain_b = v[i] - v
        curv = np.maximum(diag[i] + diag - 2.0 * K[i], 1e-12)
        score = np.where(cand, gain_b * gain_b / curv, -np.inf)
        for j, e in ((int(np.argmax(score)), eps), (int(np.argmax(np.where(curv > 1e-12, score, -np.inf))), eps),
                     (int(np.argmax(score)), 0.0)):
            a1, a2, _ = pair_step(y[i], y[j], a[i], a[j], y[i] * G[i], y[j] * G[j],
                                  K[i, i], K[i, j], K[j, j], cap[i], cap[j], 0.0, e)
            a1, a2 = _snap(a1, cap[i]), _snap(a2, cap[j])
            d1, d2 = a1 - a[i], a2 - a[j]
            if d1 != 0.0 or d2 != 0.0:
                break
        else:
            break
        a[i], a[j] = a1, a2
        G += Q[:, i] * d1 + Q[:, j] * d2
    return a, steps


def _snap(v: float, cap: float) -> float:
    if v <= cap * 1e-12:
        return 0.0
    if v >= cap * (1.0 - 1e-12):
        return float(cap)
    return float(v)


# --------------------------------------------------------------------------
# distributed state update
# --------------------------------------------------------------------------

def _update_state(state: DataFrame, sids: np.ndarray, S: np.ndarray, dcoef: np.ndarray,
                  new_alpha: np.ndarray, kernel: str, gamma: float) -> DataFrame:
    """g += y * K(x, S) @ dcoef on every row; alpha[sid] = new for the set."""
    order = np.argsort(sids)
    sids, new_alpha = sids[order], new_alpha[order]
    moved = dcoef != 0
    S_m, c_m = S[moved], dcoef[moved]
    center = S_m.mean(axis=0) if len(S_m) and kernel != "linear" else None
    names = STATE_SCHEMA.names

    def run(batches):
        for batch in batches:
            cols = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
            y = cols["y"].to_numpy(zero_copy_only=False)
            g = cols["g"].to_numpy(zero_copy_only=False).copy()
            alpha = cols["alpha"].to_numpy(zero_copy_only=False).copy()
            if len(S_m):
                X = arrow_matrix(cols["x"], S.shape[1])
                g += y * block_kernel_sum(X, S_m, c_m, kernel, gamma, center)
            sid = cols["sid"].to_numpy(zero_copy_only=False)
            pos = np.searchsorted(sids, sid)
            pos[pos >= len(sids)] = 0
            hit = sids[pos] == sid if len(sids) else np.zeros(len(sid), bool)
            alpha[hit] = new_alpha[pos[hit]]
            arrays = [cols["sid"], cols["x"], cols["y"], cols["mult"], cols["cap"],
                      pa.array(alpha, pa.float64()), pa.array(g, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return state.mapInArrow(run, STATE_SCHEMA)


def _select(state: DataFrame, half: int):
    """Top q/2 of the up set (-y*g descending) and of the low set (ascending);
    ties go by (y, x), which tells merged rows apart on any partitioning.

    Each is a per-partition top-k merged on the driver.  The two jobs read
    the same cached state and are submitted together from two threads, so
    an outer iteration waits for one round of tasks, not two.
    """
    key = F.round(-F.col("y") * F.col("g"), NOISE_PLACES)
    cols = ["sid", "x", "y", "cap", "alpha", "g"]
    up = state.filter(up_set()).select(*cols, key.alias("v")) \
        .orderBy(F.col("v").desc(), "y", "x", "sid").limit(half)
    low = state.filter(low_set()).select(*cols, key.alias("v")) \
        .orderBy(F.col("v").asc(), "y", "x", "sid").limit(half)
    with ThreadPoolExecutor(max_workers=2) as pool:
        f_up, f_low = pool.submit(up.collect), pool.submit(low.collect)
        return f_up.result(), f_low.result()


@dataclass
class TrainInfo:
    iterations: int = 0
    inner_steps: int = 0
    gap: float = math.inf
    converged: bool = False
    rows: int = 0
    distinct_rows: int = 0
    history: list = field(default_factory=list)
    objective: list = field(default_factory=list)
    active_rows: list = field(default_factory=list)     # rows passed over, iteration by iteration
    reconstructions: int = 0
    primal: float = math.inf
    dual: float = -math.inf
    duality_gap: float = math.inf


class NotConverged(RuntimeError):
    """The trainer stopped before its tolerance."""


#: Decimal places of a gradient that count; the rest is summation noise.
NOISE_PLACES = 10
#: Bytes from which an iterated table has two tasks, and of a task at most.
SMALL_TASK_BYTES, TASK_BYTES = 16 << 10, 64 << 20


def settled(m_up: float, m_low: float):
    """Rows at a bound that cannot belong to a violating pair as things stand:
    in the up set alone and below every low row, or in the low set alone and
    above every up row (``m_up``, ``m_low``: the extremes of -y*g)."""
    v = -F.col("y") * F.col("g")
    return (~low_set() & (v < F.lit(m_low))) | (~up_set() & (v > F.lit(m_up)))


def put_apart(state: DataFrame, m_up: float, m_low: float) -> tuple[DataFrame, DataFrame]:
    """(active rows, settled rows) of one written table."""
    spark = state.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/state-{uuid.uuid4().hex}"
    state.withColumn("settled", settled(m_up, m_low)).write.partitionBy("settled").parquet(path)
    schema = T.StructType([*STATE_SCHEMA.fields, T.StructField("settled", T.BooleanType())])
    written = spark.read.schema(schema).parquet(path)
    return tuple(written.filter(F.col("settled") == side).drop("settled") for side in (False, True))


def reconstruct(active: DataFrame, apart: list[DataFrame], params: "SVMParams") -> DataFrame:
    """The whole state again: the gradients of the rows put apart are computed
    anew, g = y * sum_j alpha_j y_j K(x_j, x) - 1 over all support rows."""
    idle = apart[0]
    for t in apart[1:]:
        idle = idle.unionByName(t)
    basis = active.unionByName(idle).filter(F.col("alpha") > 0).select(
        "x", (F.col("alpha") * F.col("y")).alias("coef"))
    anew = kernel_sum(idle.drop("g"), basis, "coef", "_ks", params.kernel, params.gamma, scale_col="y",
                      max_broadcast_bytes=params.max_broadcast_bytes)
    anew = anew.withColumn("g", F.col("_ks") - F.lit(1.0)).select(*STATE_SCHEMA.names)
    return shared_table(active.select(*STATE_SCHEMA.names).unionByName(anew), "state")


def certificate(state: DataFrame, b: float) -> tuple[float, float]:
    """(primal, dual) objective of a whole state, one aggregate:
    0.5 a'Qa + sum(cap * hinge(1 - y f)) and sum(a) - 0.5 a'Qa, where
    a'Qa = sum(a * (g + 1)) and 1 - y f = y b - g."""
    quad = F.sum(F.col("alpha") * (F.col("g") + F.lit(1.0)))
    hinge = F.sum(F.col("cap") * F.greatest(F.col("y") * F.lit(float(b)) - F.col("g"), F.lit(0.0)))
    r = state.agg((0.5 * quad + hinge).alias("primal"), (F.sum("alpha") - 0.5 * quad).alias("dual")).first()
    return r["primal"], r["dual"]


def task_count(n_bytes: int) -> int:
    """Partitions of a table that is passed over many times, from its bytes
    alone: as many tasks as each has units of 16 KB, until tasks of 64 MB."""
    return max(1, math.ceil(math.sqrt(n_bytes / SMALL_TASK_BYTES)), math.ceil(n_bytes / TASK_BYTES))


def sized(df: DataFrame, rows: int, width: int) -> DataFrame:
    """Spread an iterated table of ``width`` doubles a row by its bytes."""
    n = task_count(8 * rows * (width + 6))
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


def check_training(df: DataFrame, x_col: str, label_col: str, positive: float) -> tuple[int, int]:
    """(rows, width) of a usable training table: one pass.

    Raises on NULL labels, NULL vectors, NULL or NaN values, vectors of
    different lengths, no rows, and labels other than ``positive`` and one
    more value."""
    x, label = F.col(x_col), F.col(label_col)
    odd = x.isNull() | F.exists(F.transform(x, lambda v: v.cast("double")), lambda v: v.isNull() | F.isnan(v))
    other = F.when(label != F.lit(positive), label)
    r = df.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(x)).alias("lo"), F.max(F.size(x)).alias("hi"),
               F.max(F.coalesce(odd, F.lit(True))).alias("odd"), F.max(label.isNull()).alias("unlabelled"),
               F.count_if(label == F.lit(positive)).alias("positives"),
               F.min(other).alias("least"), F.max(other).alias("most")).first()
    if not r["n"]:
        raise ValueError("training needs both classes; found no rows")
    if r["unlabelled"]:
        raise ValueError("training labels must not be NULL")
    if r["odd"] or r["lo"] != r["hi"]:
        raise ValueError("feature vectors must have one length and no NULL or NaN values")
    if not r["positives"] or r["least"] is None or r["least"] != r["most"]:
        found = sorted({r["least"], r["most"], positive if r["positives"] else None} - {None})
        raise ValueError(f"training needs both classes, {positive} and one other label; found among others {found}")
    return r["n"], r["hi"]


def prepare_state(df: DataFrame, params: SVMParams, x_col: str = "x",
                  label_col: str = "label", positive: float = 1.0,
                  warm_start: DataFrame | None = None, id_col: str = "id", repair: bool = False) -> DataFrame:
    """Input rows -> initial dual state (merged duplicates, alpha start, g).

    With ``repair`` an infeasible start is projected (``project_start``)."""
    y = F.when(F.col(label_col) == F.lit(positive), F.lit(1.0)).otherwise(F.lit(-1.0))
    rows = df.select(*([id_col] if warm_start is not None else []),
                     F.col(x_col).cast("array<double>").alias("x"), y.alias("y"))
    if warm_start is not None:
        w = broadcast_if_small(warm_start.select(F.col(id_col), F.col("alpha").cast("double").alias("_a")))
        rows = rows.join(w, id_col, "left").withColumn("_a", F.coalesce("_a", F.lit(0.0)))
        if not repair:
            bad = (F.col("_a") < 0) | (F.col("_a") > F.lit(params.c))
            rows = rows.withColumn("_a", F.when(bad, F.raise_error(
                F.lit("warm-start alpha outside [0, C]"))).otherwise(F.col("_a")))
    else:
        rows = rows.withColumn("_a", F.lit(0.0))
    if params.dedup:
        merged = rows.groupBy("x", "y").agg(F.count(F.lit(1)).alias("mult"),
                                            F.sum("_a").alias("alpha"))
    else:
        merged = rows.select("x", "y", F.lit(1).cast("long").alias("mult"),
                             F.col("_a").alias("alpha"))
    state = merged.select(F.monotonically_increasing_id().alias("sid"), "x", "y", "mult",
                          (F.col("mult") * F.lit(params.c)).alias("cap"), "alpha", F.lit(-1.0).alias("g"))
    return project_start(shared_table(state, "start")) if repair and warm_start is not None else state


def fit_kernel_svm(df: DataFrame, params: SVMParams = SVMParams(), x_col: str = "x",
                   label_col: str = "label", positive: float = 1.0,
                   warm_start: DataFrame | None = None, id_col: str = "id",
                   verbose: bool = False, repair_start: bool = False) -> KernelModel:
    """Train an exact kernel SVM (T2); returns a KernelModel with support table
    (x, y, alpha, mult) and b in the f = sum alpha y K - b convention.

    Raises NotConverged when the optimality gap is above ``tol`` at the end,
    unless ``allow_unconverged``; ``info`` holds the gaps, the objective and
    the rows passed over, iteration by iteration, and the final primal and
    dual objectives.  A start that breaks the bounds or sum(alpha*y) = 0
    raises, or is projected with ``repair_start``."""
    ensure_checkpoint_dir(df.sparkSession)
    info = TrainInfo()
    _, width = check_training(df, x_col, label_col, positive)
    # sid is assigned once and frozen by the written table
    state = shared_table(prepare_state(df, params, x_col, label_col, positive, warm_start, id_col, repair_start),
                         "state")
    counts = {r["y"]: (r["rows"], r["n"], r["ay"]) for r in state.groupBy("y").agg(
        F.sum("mult").alias("rows"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("alpha") * F.col("y")).alias("ay")).collect()}
    info.rows = int(sum(v[0] for v in counts.values()))
    info.distinct_rows = int(sum(v[1] for v in counts.values()))
    state = sized(state, info.distinct_rows, width)
    if warm_start is not None:
        resid = sum(v[2] for v in counts.values())
        if abs(resid) > 1e-8 * max(1.0, params.c * info.rows):
            raise ValueError(f"warm start breaks sum(alpha*y) = 0 (residual {resid:.3g})")
        basis = state.filter(F.col("alpha") > 0).select(
            "x", (F.col("alpha") * F.col("y")).alias("coef"))
        started = kernel_sum(state, basis, "coef", "_ks", params.kernel, params.gamma,
                             scale_col="y", max_broadcast_bytes=params.max_broadcast_bytes) \
            .withColumn("g", F.col("_ks") - F.lit(1.0)).select(*STATE_SCHEMA.names)
        state = sized(shared_table(started, "state"), info.distinct_rows, width)
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    info.objective.append(dual_objective(state))

    half = max(1, params.working_set // 2)
    pending: list[DataFrame] = []
    apart: list[DataFrame] = []       # written tables of settled rows
    n_active = info.distinct_rows
    m_up = m_low = 0.0

    def whole_again(active):
        """All rows in play, cached; the old state waits to be released."""
        nonlocal apart, n_active
        full = sized(reconstruct(active, apart, params), info.distinct_rows, width)
        apart, n_active = [], info.distinct_rows
        info.reconstructions += 1
        return full.persist(StorageLevel.MEMORY_AND_DISK)

    for it in range(1, params.max_iter + 1):
        up, low = _select(state, half)
        info.active_rows.append(n_active)
        for old in pending:           # the new state is cached now
            old.unpersist()
        pending = []
        if up and low:
            m_up, m_low = up[0]["v"], low[0]["v"]
        info.gap = m_up - m_low if up and low else 0.0
        info.history.append(info.gap)
        if verbose:
            print(f"iter {it}: gap {info.gap:.6g}, {n_active} rows")
        if info.gap <= params.tol:
            if apart:
                pending, state = [state], whole_again(state)
                continue
            info.converged = True
            break
        # an order, and gradients, that do not depend on the partitioning
        chosen = sorted({r["sid"]: r for r in up + low}.values(), key=lambda r: (r["y"], r["x"], r["sid"]))
        sids = np.array([r["sid"] for r in chosen], dtype=np.int64)
        S = np.array([r["x"] for r in chosen], dtype=np.float64)
        yv, av, cv = (np.array([r[k] for r in chosen]) for k in ("y", "alpha", "cap"))
        gv = np.round([r["g"] for r in chosen], NOISE_PLACES)
        K = block_kernel(S, S, params.kernel, params.gamma)
        new_a, steps = solve_subproblem(K, yv, av, gv, cv, params.tol * 0.1, params.max_inner, params.eps)
        info.inner_steps += steps
        info.iterations = it
        dcoef = (new_a - av) * yv
        if not np.any(dcoef):
            if apart:
                pending, state = [state], whole_again(state)
                continue
            break
        # the step changes the objective by d'g + 0.5 d'Qd, d = change of alpha
        info.objective.append(info.objective[-1] + float((new_a - av) @ gv + 0.5 * dcoef @ (K @ dcoef)))
        nxt = _update_state(state, sids, S, dcoef, new_a, params.kernel, params.gamma)
        if params.shrink_every and it % params.shrink_every == 0:
            nxt, idle = put_apart(nxt, m_up, m_low)
            rows = nxt.count()
            if rows < n_active:
                apart.append(idle)
            n_active = rows
            nxt = sized(nxt, n_active, width)
        elif it % params.checkpoint_every == 0:
            nxt = sized(shared_table(nxt, "state"), n_active, width)
        nxt = nxt.persist(StorageLevel.MEMORY_AND_DISK)
        pending = [state]
        state = nxt
    else:
        if apart:
            pending, state = [*pending, state], whole_again(state)
        up, low = _select(state, 1)
        if up and low:
            m_up, m_low = up[0]["v"], low[0]["v"]
            info.gap = m_up - m_low
            info.converged = info.gap <= params.tol
    if not info.converged and not params.allow_unconverged:
        for old in pending + [state]:
            old.unpersist()
        raise NotConverged(f"gap {info.gap:.3g} > tol {params.tol:.3g} after {info.iterations} iterations; "
                           "raise max_iter or max_inner, or set allow_unconverged")
    b = -(m_up + m_low) / 2.0
    final = shared_table(state, "state")
    for old in pending + [state]:
        old.unpersist()
    info.primal, info.dual = certificate(final, b)
    info.duality_gap = info.primal - info.dual
    support = final.filter(F.col("alpha") > 0).select(
        "sid", "x", "y", (F.col("alpha") / F.col("mult")).alias("alpha"), "mult")
    return KernelModel(support, b, params.kernel, params.gamma, params.c, params.tol,
                       info=info.__dict__ | {"state": final})


def dual_objective(state: DataFrame) -> float:
    """0.5 a'Qa - sum(a) = 0.5 * sum(alpha * (g - 1)), one aggregate."""
    return state.agg(F.sum(F.lit(0.5) * F.col("alpha") * (F.col("g") - F.lit(1.0)))).first()[0]


# --------------------------------------------------------------------------
# linear (built-in LinearSVC) and Fourier-feature trainers
# --------------------------------------------------------------------------

def _merged_rows(df: DataFrame, x_col: str, label_col: str, positive: float, dedup: bool) -> DataFrame:
    """(x, label 0/1, weight).  With ``dedup`` identical rows become one row
    weighted by its count."""
    lab = F.when(F.col(label_col) == F.lit(positive), F.lit(1.0)).otherwise(F.lit(0.0))
    rows = df.select(F.col(x_col).cast("array<double>").alias("x"), lab.alias("label"))
    if dedup:
        return rows.groupBy("x", "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return rows.withColumn("weight", F.lit(1.0))


def _weighted_rows(df: DataFrame, x_col: str, label_col: str, positive: float,
                   dedup: bool) -> tuple[DataFrame, dict]:
    """``_merged_rows``, and the row counts.  Written once and spread by its
    bytes, as every optimizer step passes over it."""
    n, width = check_training(df, x_col, label_col, positive)
    rows = shared_table(_merged_rows(df, x_col, label_col, positive, dedup), "weighted-rows")
    distinct = rows.count()
    return sized(rows, distinct, width), {"rows": n, "distinct_rows": distinct, "width": width}


def _fit_svc(rows: DataFrame, info: dict, reg: float, max_iter: int, tol: float, allow_unconverged: bool,
             standardize: bool):
    """Built-in LinearSVC on (features, label, weight); fills ``info``."""
    from pyspark.ml.classification import LinearSVC

    model = LinearSVC(featuresCol="features", labelCol="label", weightCol="weight", regParam=reg,
                      maxIter=max_iter, tol=tol, standardization=standardize).fit(rows)
    info["iterations"] = model.summary().totalIterations
    info["converged"] = info["iterations"] < max_iter
    if not info["converged"] and not allow_unconverged:
        raise NotConverged(f"LinearSVC has not reached tol {tol:.3g} in {max_iter} iterations; "
                           "raise max_iter or tol, or set allow_unconverged")
    return model


def fit_linear_svc(df: DataFrame, x_col: str = "x", label_col: str = "label",
                   positive: float = 1.0, reg: float = 1e-3, max_iter: int = 200,
                   tol: float = 1e-6, dedup: bool = True, allow_unconverged: bool = False) -> KernelModel:
    """Linear SVM with the built-in LinearSVC.

    Identical rows are merged into one weighted row first (LinearSVC's
    weighted hinge loss is then the same objective); columns are scaled to
    unit variance inside the fit.  Returned as a linear KernelModel whose
    single support row is W, so scoring is W.x - b.
    """
    from pyspark.ml.functions import array_to_vector

    rows, info = _weighted_rows(df, x_col, label_col, positive, dedup)
    model = _fit_svc(rows.withColumn("features", array_to_vector("x")), info, reg, max_iter, tol,
                     allow_unconverged, True)
    w = [float(v) for v in model.coefficients.toArray()]
    support = one_row(df.sparkSession).select(
        F.array(*[F.lit(v) for v in w]).alias("x"), F.lit(1.0).alias("y"),
        F.lit(1.0).alias("alpha"), F.lit(1).cast("long").alias("mult"))
    return KernelModel(support, -float(model.intercept), "linear", 0.0, 0.0, tol, info=info, weights=w)


def gram_matrix(df: DataFrame, x_col: str = "x", label_col: str = "label") -> np.ndarray:
    """Sums of products of every two of (x, label, 1): one pass, (d + 2)^2
    numbers a task, added up by Spark."""
    def run(batches):
        total = None
        for batch in batches:
            X = arrow_matrix(batch.column(0))
            if not len(X):
                continue
            Z = np.column_stack([X, batch.column(1).to_numpy(zero_copy_only=False), np.ones(len(X))])
            total = Z.T @ Z if total is None else total + Z.T @ Z
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(v.ravel()) for v in (i, j, total)], names=["i", "j", "s"])

    rows = df.select(F.col(x_col).cast("array<double>").alias("x"), F.col(label_col).cast("double").alias("y"))
    cells = rows.mapInArrow(run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    if not cells:
        raise ValueError("training needs rows")
    out = np.zeros((max(r["i"] for r in cells) + 1,) * 2)
    for r in cells:
        out[r["i"], r["j"]] = r["s"]
    return out


def fit_linear_svr(df: DataFrame, x_col: str = "x", label_col: str = "label", c: float = 1.0) -> KernelModel:
    """Least-squares support vector regression with the linear kernel: the W
    and b of min 0.5 |W|^2 + C/2 sum (label - (W.x - b))^2.

    Its optimality conditions are d linear equations over one pass's sums
    (``gram_matrix``), so it suits any number of rows and up to some thousand
    columns.  Returned as a linear KernelModel; decision values are the
    predictions.  NULL or NaN values and NULL labels raise."""
    if not c > 0:
        raise ValueError("C must be > 0")
    s = gram_matrix(df, x_col, label_col)
    d, n = len(s) - 2, s[-1, -1]
    if np.isnan(s).any():
        raise ValueError("training labels must not be NULL or NaN")
    mean = s[-1, :] / n
    cov = s[:d + 1, :d + 1] - n * np.outer(mean[:d + 1], mean[:d + 1])
    w = np.linalg.solve(cov[:d, :d] + np.eye(d) / c, cov[:d, d])
    b = float(w @ mean[:d] - mean[d])
    support = one_row(df.sparkSession).select(
        F.array(*[F.lit(float(v)) for v in w]).alias("x"), F.lit(1.0).alias("y"),
        F.lit(1.0).alias("alpha"), F.lit(1).cast("long").alias("mult"))
    return KernelModel(support, b, "linear", 0.0, c, 0.0, info={"rows": int(n), "converged": True},
                       weights=[float(v) for v in w])


@dataclass
class FourierMap:
    """z(x) = sqrt(2/D) cos(W x + p), W ~ N(0, 2 gamma), p ~ U(0, 2 pi), seeded.

    W is D x d doubles (bounded by the chosen D, not by the data) and is
    captured in the Arrow task closure."""

    W: np.ndarray
    p: np.ndarray

    @classmethod
    def draw(cls, dim: int, n_features: int, gamma: float, seed: int = 0) -> "FourierMap":
        rng = np.random.default_rng(seed)
        W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_features, dim))
        p = rng.uniform(0.0, 2.0 * math.pi, size=n_features)
        return cls(W, p)

    def transform(self, df: DataFrame, x_col: str = "x", out_col: str = "z") -> DataFrame:
        W, p = self.W, self.p
        scale = math.sqrt(2.0 / len(p))
        fields = [f for f in df.schema.fields if f.name != out_col]
        schema = T.StructType(fields + [T.StructField(out_col, T.ArrayType(T.DoubleType(), False), False)])

        def run(batches):
            for batch in batches:
                X = arrow_matrix(batch.column(batch.schema.get_field_index(x_col)), W.shape[1])
                Z = scale * np.cos(X @ W.T + p)
                flat = pa.array(Z.ravel(), pa.float64())
                offsets = pa.array(np.arange(0, Z.size + 1, Z.shape[1], dtype=np.int32))
                z = pa.ListArray.from_arrays(offsets, flat)
                cols = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
                yield pa.RecordBatch.from_arrays(cols + [z], names=[f.name for f in fields] + [out_col])

        return df.mapInArrow(run, schema)


@dataclass
class FourierModel:
    """Fourier map + linear model.  Scoring evaluates w . z(x) - b inside one
    Arrow map, so the D-wide feature arrays are never materialised."""

    fmap: FourierMap
    w: np.ndarray
    b: float
    info: dict = field(default_factory=dict)

    def decision(self, df: DataFrame, x_col: str = "x", out_col: str = "score") -> DataFrame:
        W, p = self.fmap.W, self.fmap.p
        coef = self.w * math.sqrt(2.0 / len(p))
        b = float(self.b)
        fields = [f for f in df.schema.fields if f.name != out_col]
        schema = T.StructType(fields + [T.StructField(out_col, T.DoubleType(), False)])

        def run(batches):
            for batch in batches:
                X = arrow_matrix(batch.column(batch.schema.get_field_index(x_col)), W.shape[1])
                score = np.zeros(len(X))
                for lo in range(0, len(X), 4096):
                    score[lo:lo + 4096] = np.cos(X[lo:lo + 4096] @ W.T + p) @ coef - b
                cols = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(score, pa.float64())],
                                                 names=[f.name for f in fields] + [out_col])

        return df.mapInArrow(run, schema)

    def transform(self, df: DataFrame, x_col: str = "x") -> DataFrame:
        from marginflow.operators.scoring import predict_label
        return predict_label(self.decision(df, x_col))


#: Rows of the share that a Fourier fit starts on, before it passes over all.
START_ROWS = 1 << 20
#: Packed rows are large: a reader holds a row group of them at a time.
SMALL_GROUPS = {"parquet.block.size": str(16 << 20)}


def _packed(rows: DataFrame, start: Column) -> DataFrame:
    """(first, n, x, s): the (x, label, weight) rows of an Arrow batch as one
    row of packed doubles, ``s`` the weight with the label's sign; those that
    ``start`` picks and the others apart.  A pass over packed rows costs no
    conversion row by row.  Written once to the shared folder."""
    def run(batches):
        for batch in batches:
            X = arrow_matrix(batch.column(0))
            if not len(X):
                continue
            label, weight, first = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            s = np.where(label > 0, weight, -weight)
            parts = [(side, first == side) for side in (True, False) if (first == side).any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([side for side, _ in parts]), pa.array([int(at.sum()) for _, at in parts], pa.int64()),
                 pa.array([X[at].tobytes() for _, at in parts], pa.binary()),
                 pa.array([s[at].tobytes() for _, at in parts], pa.binary())], names=["first", "n", "x", "s"])

    packed = rows.select("x", "label", "weight", start.alias("first")) \
        .mapInArrow(run, "first boolean, n long, x binary, s binary")
    return shared_table(packed, "packed-rows", SMALL_GROUPS)


def _hinge_sums(packed: DataFrame, fmap: FourierMap, v: np.ndarray) -> tuple[float, float, np.ndarray]:
    """(sum of weights, sum of weighted hinge losses, its gradient) of packed
    rows under v[:-1] . cos(W x + p) + v[-1]: one pass.

    The features are computed 1024 rows at a time and never leave the task,
    in 4-byte numbers once the angle is within half a turn; the sums are
    8-byte.  A task returns ``len(v) + 2`` numbers, added up by Spark."""
    W, p = fmap.W.T / (2.0 * math.pi), fmap.p / (2.0 * math.pi)
    w, b = v[:-1].astype(np.float32), float(v[-1])

    def run(batches):
        total = np.zeros(len(v) + 2)
        for batch in batches:
            for x, s in zip(batch.column(0), batch.column(1)):
                S = np.frombuffer(s.as_buffer())
                X = np.frombuffer(x.as_buffer()).reshape(len(S), len(W))
                for lo in range(0, len(S), 1024):
                    turns = X[lo:lo + 1024] @ W + p
                    turns -= np.rint(turns)
                    Z = np.cos(turns.astype(np.float32) * np.float32(2.0 * math.pi))
                    sc = S[lo:lo + 1024]
                    hinge = 1.0 - np.sign(sc) * (Z @ w + b)
                    pull = np.where(hinge > 0, -sc, 0.0)
                    total[:-3] += pull.astype(np.float32) @ Z
                    total[-3] += pull.sum()
                    total[-2] += np.abs(sc) @ np.maximum(hinge, 0.0)
                    total[-1] += np.abs(sc).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "s"])

    cells = packed.select("x", "s").mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(len(v) + 2)
    for r in cells:
        out[r["i"]] = r["s"]
    return out[-1], out[-2], out[:-2]


def _minimise(f, v: np.ndarray, max_iter: int, tol: float, memory: int = 10) -> tuple[np.ndarray, int, bool]:
    """L-BFGS for a convex function with kinks: (v, iterations, converged).

    ``f`` gives (value, gradient).  Steps are bisected until they fall enough
    and the slope has risen (weak Wolfe conditions, which the kinks of the
    hinge loss allow).  Converged: ten iterations have let the value fall by no
    more than ``tol`` of that at zero, or no step lets it fall."""
    value, g = f(v)
    start = f(np.zeros_like(v))[0] if v.any() else value
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    values = [value]
    for it in range(1, max_iter + 1):
        d = -g
        kept = []
        for s, y in reversed(pairs):
            a = (s @ d) / (s @ y)
            d = d - a * y
            kept.append(a)
        if pairs:
            s, y = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, reversed(kept)):
            d = d + s * (a - (y @ d) / (s @ y))
        slope = g @ d
        lo, hi = 0.0, math.inf
        t = 1.0 if pairs else 1.0 / max(float(np.linalg.norm(g)), 1e-12)
        for _ in range(20):
            new, new_g = f(v + t * d)
            if new > value + 1e-4 * t * slope:
                hi = t
            elif new_g @ d < 0.9 * slope:
                lo = t
            else:
                break
            t = (lo + hi) / 2.0 if hi < math.inf else 2.0 * t
        if not new < value:
            if not pairs:
                return v, it, True
            pairs = []            # once more, along the gradient
            continue
        step, change = t * d, new_g - g
        if step @ change > 0:
            pairs = [*pairs[1 - memory:], (step, change)]
        v, value, g = v + step, new, new_g
        values.append(value)
        if len(values) > 10 and values[-11] - value <= tol * start:
            return v, it, True
    return v, max_iter, False


def fit_rff_svc(df: DataFrame, gamma: float, n_features: int = 64, seed: int = 0,
                x_col: str = "x", label_col: str = "label", positive: float = 1.0,
                reg: float = 1e-5, max_iter: int = 200, tol: float = 1e-3,
                dedup: bool = True, allow_unconverged: bool = False) -> FourierModel:
    """Large-table RBF SVM: random Fourier features, and the linear SVM of
    mean hinge loss + reg/2 |w|^2 over them (T16).

    Duplicates are merged before the feature map (weights carry the counts).
    Every step is one pass over the merged rows, packed once, which computes
    the features anew (``_hinge_sums``): nothing ``n_features`` wide is kept in memory or
    on disk, so a pass costs the rows' own bytes and their arithmetic.

    The first steps run over a share of about ``START_ROWS`` rows, picked by
    the hash of x; the steps from there on run over all rows, until they meet
    ``tol``.  The share only says where those begin: the objective, its
    tolerance and ``max_iter`` are those of the whole table.
    """
    n, width = check_training(df, x_col, label_col, positive)
    merged = _merged_rows(df, x_col, label_col, positive, dedup)
    rows = _packed(merged, F.pmod(F.xxhash64("x"), F.lit(n)) < F.lit(START_ROWS))
    sizes = {r["first"]: r["n"] for r in rows.groupBy("first").agg(F.sum("n").alias("n")).collect()}
    info = {"rows": n, "distinct_rows": sum(sizes.values()), "width": width,
            "start_rows": sizes.get(True, 0) if sizes.get(False) else 0, "start_iterations": 0}
    fmap = FourierMap.draw(width, n_features, gamma, seed)
    scale = math.sqrt(2.0 / n_features)
    ridge = np.append(np.full(n_features, reg / scale ** 2), 0.0)   # v[:-1] = scale * w

    def objective(table: DataFrame):
        def f(v):
            total, loss, g = _hinge_sums(table, fmap, v)
            return loss / total + 0.5 * float(ridge @ (v * v)), g / total + ridge * v
        return f

    v = np.zeros(n_features + 1)
    if info["start_rows"]:
        first = shared_table(rows.filter("first"), "start-rows", SMALL_GROUPS)
        v, info["start_iterations"], _ = _minimise(objective(first), v, max_iter, tol)
    v, info["iterations"], info["converged"] = _minimise(objective(rows), v, max_iter, tol)
    if not info["converged"] and not allow_unconverged:
        raise NotConverged(f"the fit has not reached tol {tol:.3g} in {max_iter} iterations; "
                           "raise max_iter or tol, or set allow_unconverged")
    return FourierModel(fmap, v[:-1] / scale, -float(v[-1]), info)
