"""The dual state as a table, and SMO's building blocks as table operators.

State schema: (id, x, y, cap, alpha, g [, e]) with y in {-1, +1},
0 <= alpha <= cap, g = y * sum_j alpha_j y_j K(x_j, x) - 1 (the gradient of
the minimised dual) and e = f(x) - y = y*g - b (see ``functions.smo``).

Operators (T3-T14):
  warm_state           optional (id, alpha) start, left join + bound check (T3)
  project_start        nearest feasible start: box and sum(alpha*y) = 0 (T3)
  kkt_violators        first-choice test (T4)
  second_choice        argmax |E_i - E_j| over free rows (T5)
  fallback_choice      first free / any row from a seeded offset (T6, T7)
  pair_rows            rows (2k, 2k+1) paired by an equi-join on k
  with_pair_bounds     L, H (T8, T9)
  with_pair_step       corrected pair update (T10)
  step_deltas/apply_step  new alphas written back by id (T11)
  gradient_update      g += y * sum_j dalpha_j y_j K(x_j, x) (T12)
  weights_delta        W + sum dalpha y x (T14)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.functions.kernels import kernel_expr
from marginflow.functions.smo import lower_bound, upper_bound, with_pair_step_columns
from marginflow.operators.scoring import DEFAULT_BROADCAST_BYTES, kernel_sum, linear_weights
from marginflow.session import one_row, shared_table

# fixed value: multiplier used to turn a seed into a start offset (Knuth's
# multiplicative hashing constant)
OFFSET_MULTIPLIER = 2654435761


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if its values take at most ``max_bytes``
    (8 bytes a value, arrays and strings by their lengths; one aggregate).

    Catalyst cannot size the output of a Python map, so without the check a
    two-row table joined to a large one would shuffle the large side."""
    def values(f) -> Column:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        return F.coalesce(F.size(c) if kind == "array" else F.length(c) if kind == "string" else F.lit(1), F.lit(1))
    total = df.agg(F.sum(sum((values(f) for f in df.schema.fields), F.lit(0)) * 8).alias("b")).first()["b"] or 0
    return F.broadcast(df) if total <= max_bytes else df


def up_set() -> Column:
    """Rows whose multiplier may move so that -y*g can decrease."""
    return ((F.col("y") > 0) & (F.col("alpha") < F.col("cap"))) | \
           ((F.col("y") < 0) & (F.col("alpha") > 0))


def low_set() -> Column:
    return ((F.col("y") > 0) & (F.col("alpha") > 0)) | \
           ((F.col("y") < 0) & (F.col("alpha") < F.col("cap")))


def free_set() -> Column:
    """0 < alpha < cap: the reference's non-bound rows."""
    return (F.col("alpha") > 0) & (F.col("alpha") < F.col("cap"))


def warm_state(samples: DataFrame, warm: DataFrame | None, c: float, kernel: str,
               gamma: float, x_col: str = "x",
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, repair: bool = False) -> DataFrame:
    """(id, x, y, cap, alpha, g) from samples (id, x, y) and an optional
    (id, alpha) start table (T3).

    Missing ids start at 0; an alpha outside [0, C] raises, or with
    ``repair`` the whole start is projected (``project_start``).  g is computed
    from the start alphas with one kernel sum over the rows with alpha > 0.
    """
    base = samples.select("id", F.col(x_col).alias("x"), "y", F.lit(float(c)).alias("cap"))
    if warm is None:
        return base.withColumn("alpha", F.lit(0.0)).withColumn("g", F.lit(-1.0))
    w = broadcast_if_small(warm.select("id", F.col("alpha").cast("double").alias("_a")))
    a = F.coalesce(F.col("_a"), F.lit(0.0))
    checked = F.when((a < 0) | (a > F.col("cap")),
                     F.raise_error(F.concat(F.lit("warm-start alpha outside [0, C] for id "),
                                            F.col("id").cast("string")))).otherwise(a)
    if repair:
        state = project_start(shared_table(base.join(w, "id", "left").withColumn("alpha", a).drop("_a"), "start"))
    else:
        state = base.join(w, "id", "left").withColumn("alpha", checked).drop("_a")
    basis = state.filter(F.col("alpha") > 0).select("x", (F.col("alpha") * F.col("y")).alias("coef"))
    out = kernel_sum(state, basis, "coef", "g", kernel, gamma, scale_col="y",
                     max_broadcast_bytes=max_broadcast_bytes)
    return out.withColumn("g", F.col("g") - F.lit(1.0))


#: Trial values of the multiplier that one pass of ``project_start`` sums for.
PROBES = 16


def project_start(rows: DataFrame, alpha: str = "alpha", y: str = "y", cap: str = "cap") -> DataFrame:
    """The feasible multipliers nearest to any start (T3): ``alpha`` becomes
    its projection onto 0 <= alpha <= cap and sum(alpha * y) = 0.

    The projection is clip(alpha - t * y, 0, cap) for the t at which the sum
    is 0.  The sum falls with t, so t is bracketed by bisection, ``PROBES``
    trial values an aggregate; between two neighbouring breakpoints the sum is
    a straight line, whose zero is then exact.  A NULL start is 0; NaN and
    infinite ones raise."""
    a = F.coalesce(F.col(alpha).cast("double"), F.lit(0.0))
    odd = F.isnan(a) | (F.abs(a) == F.lit(float("inf")))

    def clipped(t: float) -> Column:
        return F.least(F.greatest(a - F.lit(t) * F.col(y), F.lit(0.0)), F.col(cap))

    def sums(ts: list[float]) -> list[float]:
        got = rows.agg(*[F.sum(F.col(y) * clipped(t)).alias(f"s{i}") for i, t in enumerate(ts)]).first()
        return [v or 0.0 for v in got]

    st = rows.agg(F.max(F.abs(a) + F.col(cap)).alias("reach"), F.max(odd).alias("odd")).first()
    if st["reach"] is None:
        return rows.withColumn(alpha, a)
    if st["odd"]:
        raise ValueError("a start must be a finite number")
    lo, hi = -st["reach"], st["reach"]
    s_lo, s_hi = sums([lo, hi])
    for _ in range(64):
        width = (hi - lo) / (PROBES + 1)
        ts = [t for t in (lo + width * (i + 1) for i in range(PROBES)) if lo < t < hi]
        if not ts or hi - lo <= 1e-13 * max(1.0, abs(lo), abs(hi)):
            break
        found = [(lo, s_lo), *zip(ts, sums(ts)), (hi, s_hi)]
        (lo, s_lo), (hi, s_hi) = next((p, q) for p, q in zip(found, found[1:]) if q[1] <= 0.0 or q is found[-1])
        if s_lo == 0.0:
            break
    t = lo if s_lo == s_hi else lo + s_lo * (hi - lo) / (s_lo - s_hi)
    return rows.withColumn(alpha, clipped(t))


def with_error(state: DataFrame, b: float) -> DataFrame:
    """e = f(x) - y with f = sum alpha y K - b, from the gradient:
    y*g = f + b - y  ->  e = y*g - b."""
    return state.withColumn("e", F.col("y") * F.col("g") - F.lit(float(b)))


def kkt_violators(state: DataFrame, tol: float, e: str = "e") -> DataFrame:
    """Rows breaking the KKT conditions by more than tol (T4, with E = f - y):
    y*E > tol with alpha > 0, or y*E < -tol with alpha < C."""
    r = F.col("y") * F.col(e)
    return state.filter(((r > tol) & (F.col("alpha") > 0)) |
                        ((r < -tol) & (F.col("alpha") < F.col("cap"))))


def first_choice(state: DataFrame, tol: float) -> DataFrame:
    """The violator with the largest |E| (ties: lowest id), one row."""
    return kkt_violators(state, tol).orderBy(F.abs("e").desc(), "id").limit(1)


def second_choice(state: DataFrame, first: DataFrame) -> DataFrame:
    """For the chosen row i: the free row j != i maximising |E_i - E_j|,
    ties by lowest id; no row when none qualifies (T5, SURVEY Q16, Q18).

    Per-partition top-1 merged on the driver; never a full sort.
    """
    chosen = first.select(F.struct("id", "e")).scalar()
    i, ei = chosen["id"], chosen["e"]
    cand = state.filter(free_set() & (F.col("id") != i))
    return cand.select(i.alias("i"), F.col("id").alias("j"), ei.alias("e_i"),
                       F.col("e").alias("e_j"), F.abs(ei - F.col("e")).alias("gap")) \
               .orderBy(F.col("gap").desc(), "j").limit(1)


def seeded_offset(state: DataFrame, seed: int) -> Column:
    """k0 in [0, max id]: a seeded start offset."""
    top = state.agg(F.max("id")).scalar()
    return F.pmod(F.lit(int(seed) * OFFSET_MULTIPLIER), top + F.lit(1))


def fallback_choice(state: DataFrame, first: DataFrame, seed: int,
                    free_only: bool = True) -> DataFrame:
    """First row (free rows only, or any row) at or after the seeded offset,
    wrapping round, excluding i (T6 / T7)."""
    i = first.select("id").scalar()
    k0 = seeded_offset(state, seed)
    cand = state.filter(F.col("id") != i)
    if free_only:
        cand = cand.filter(free_set())
    return cand.select(i.alias("i"), F.col("id").alias("j"), k0.alias("k0")) \
               .orderBy(F.col("j") < F.col("k0"), "j").limit(1)


def pair_rows(state: DataFrame, cols: list[str]) -> DataFrame:
    """Rows 2k and 2k+1 side by side, columns suffixed _i / _j.

    One exchange on k = id >> 1 and a look at the next row of the same key:
    every row takes part in exactly one pair, and a row whose neighbour is
    absent stays with NULLs for it.  Ids must be unique; a repeated id raises.
    """
    pair = Window.partitionBy(F.shiftright("id", 1)).orderBy("id")
    rows = state.select(F.struct("id", *cols).alias("a"), F.lead(F.struct("id", *cols)).over(pair).alias("b"),
                        F.row_number().over(pair).alias("at"))
    first = F.when((F.col("at") > 2) | (F.col("a.id") == F.col("b.id")), F.raise_error(
        F.lit("ids must be unique"))).otherwise(F.col("at") == 1)
    return rows.filter(first).select(
        F.col("a.id").alias("i"), *[F.col(f"a.{c}").alias(f"{c}_i") for c in cols],
        F.col("b.id").alias("j"), *[F.col(f"b.{c}").alias(f"{c}_j") for c in cols])


def pair_of(state: DataFrame, choice: DataFrame, cols: list[str]) -> DataFrame:
    """The chosen (i, j) of a one-row choice table as one pair row.

    Equi-joins of the choice (one row) with the state on id, so the state
    is scanned once per side and the choice side is broadcast."""
    a = state.select(F.col("id").alias("i"), *[F.col(c).alias(f"{c}_i") for c in cols])
    b = state.select(F.col("id").alias("j"), *[F.col(c).alias(f"{c}_j") for c in cols])
    return choice.select("i", "j").join(a, "i").join(b, "j")


def local_rows(df: DataFrame, max_rows: int) -> DataFrame:
    """Collect a table bounded by construction (checked: at most max_rows)
    and return it as literal rows of a one-partition relation.

    Used for the two rows one SMO step moves: later plans read two literal
    rows instead of re-running the choice and the step for every use."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows")
    if not rows:
        return df.sparkSession.createDataFrame([], df.schema)
    structs = [F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields])
               for r in rows]
    return one_row(df.sparkSession).select(F.inline(F.array(*structs)))


def with_kernels(pairs: DataFrame, kernel: str, gamma: float) -> DataFrame:
    return pairs.withColumn("k11", kernel_expr("x_i", "x_i", kernel, gamma)) \
                .withColumn("k12", kernel_expr("x_i", "x_j", kernel, gamma)) \
                .withColumn("k22", kernel_expr("x_j", "x_j", kernel, gamma))


def with_pair_bounds(pairs: DataFrame) -> DataFrame:
    args = [F.col("y_i"), F.col("y_j"), F.col("alpha_i"), F.col("alpha_j"),
            F.col("cap_i"), F.col("cap_j")]
    return pairs.withColumn("lo", lower_bound(*args)).withColumn("hi", upper_bound(*args))


def with_pair_step(pairs: DataFrame, b: float, eps: float = 1e-3) -> DataFrame:
    """Adds a1_new, a2_new, b_new (T10); needs y, alpha, e, cap and k11/k12/k22."""
    return with_pair_step_columns(pairs, "y_i", "y_j", "alpha_i", "alpha_j", "e_i", "e_j",
                                  "k11", "k12", "k22", "cap_i", "cap_j", b, eps)


def step_deltas(stepped: DataFrame) -> DataFrame:
    """Pair rows -> one row per moved multiplier: (id, x, y, alpha_old,
    alpha_new, b_new)."""
    return stepped.select(F.inline(F.array(
        F.struct(F.col("i").alias("id"), F.col("x_i").alias("x"), F.col("y_i").alias("y"),
                 F.col("alpha_i").alias("alpha_old"), F.col("a1_new").alias("alpha_new"), "b_new"),
        F.struct(F.col("j").alias("id"), F.col("x_j").alias("x"), F.col("y_j").alias("y"),
                 F.col("alpha_j").alias("alpha_old"), F.col("a2_new").alias("alpha_new"), "b_new"))))


def new_threshold(deltas: DataFrame, b: float) -> Column:
    """The step's b, or the old one if no pair was chosen."""
    return F.coalesce(deltas.agg(F.max("b_new")).scalar(), F.lit(float(b)))


def apply_step(state: DataFrame, deltas: DataFrame, b: float) -> DataFrame:
    """Write new alphas back by id; untouched rows keep theirs.  Adds the new
    threshold as ``b`` (T11)."""
    d = broadcast_if_small(deltas.select("id", F.col("alpha_new").alias("_new")))
    return state.join(d, "id", "left") \
        .withColumn("alpha", F.coalesce(F.col("_new"), F.col("alpha"))).drop("_new") \
        .withColumn("b", new_threshold(deltas, b))


def gradient_update(state: DataFrame, deltas: DataFrame, kernel: str, gamma: float, b: float,
                    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """g += y * sum_j (alpha_new - alpha_old)_j y_j K(x_j, x) on every row, and
    the errors e = y*g - b with the step's new b (T12).

    The moved rows are the broadcast basis (chunked if large); rows with no
    change are filtered out before anything is collected.
    """
    moved = deltas.select("x", ((F.col("alpha_new") - F.col("alpha_old")) * F.col("y")).alias("coef")) \
                  .filter(F.col("coef") != 0)
    upd = kernel_sum(state, moved, "coef", "_dg", kernel, gamma, scale_col="y",
                     max_broadcast_bytes=max_broadcast_bytes)
    return upd.withColumn("g", F.col("g") + F.col("_dg")).drop("_dg") \
              .withColumn("e", F.col("y") * F.col("g") - new_threshold(deltas, b))


def weights_delta(weights: DataFrame, deltas: DataFrame) -> DataFrame:
    """W + sum_j (alpha_new - alpha_old)_j y_j x_j as (pos, w)."""
    moved = deltas.select("x", ((F.col("alpha_new") - F.col("alpha_old")) * F.col("y")).alias("coef"))
    dw = linear_weights(moved, "coef").withColumnRenamed("w", "dw")
    return weights.join(dw, "pos", "full").select(
        "pos", (F.coalesce("w", F.lit(0.0)) + F.coalesce("dw", F.lit(0.0))).alias("w"))
