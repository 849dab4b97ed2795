"""Rounds of disjoint pairs, and their selection by zone maps.

A round moves many pairs at once.  The ``pairs`` most violating rows of the
up set and of the low set are matched rank by rank, no row twice; each pair
takes its own best step within its bounds; the steps together are a
direction that keeps every bound and sum(alpha*y), and the exact minimum of
the objective along it is found from two sums, so the objective never rises.

Zone maps: a state written in files sorted by -y*g, with the extremes of the
up and the low set of every file in a small table.  The best k rows are read
from the files that can hold one of them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.functions.kernels import kernel_expr
from marginflow.operators.dual import broadcast_if_small, low_set, up_set
from marginflow.operators.scoring import DEFAULT_BROADCAST_BYTES, kernel_sum
from marginflow.session import ensure_checkpoint_dir, shared_table

#: Rows of each set that one round pairs.
PAIRS = 256


def violation() -> Column:
    """-y*g: the up set's largest against the low set's least is the gap."""
    return -F.col("y") * F.col("g")


def _top(state: DataFrame, largest: bool, k: int) -> DataFrame:
    order = [F.col("v").desc() if largest else F.col("v").asc(), F.col("id")]
    rows = state.withColumn("v", violation()).orderBy(*order).limit(k)
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))


def disjoint_pairs(state: DataFrame, pairs: int = PAIRS, tol: float = 0.0) -> DataFrame:
    """Up and low rows matched rank by rank, no row twice: (rank, columns of
    the up row _i, of the low row _j).

    ``pairs`` rows of each set are taken (a top-k each, never a sort of the
    table).  A free row may be among both; it stays where its rank is better
    (at ties among the up rows), and the ranks close up.  Pairs whose
    violation is at most ``tol`` are left out."""
    cols = ["id", "x", "y", "cap", "alpha", "g", "v"]
    up, low = _top(state.filter(up_set()), True, pairs), _top(state.filter(low_set()), False, pairs)
    both = shared_table(up.withColumn("side", F.lit(0)).unionByName(low.withColumn("side", F.lit(1))), "candidates")
    once = both.withColumn("best", F.row_number().over(Window.partitionBy("id").orderBy("rank", "side"))) \
        .filter("best = 1")
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("side").orderBy("rank")))
    sides = [ranked.filter(F.col("side") == s).select("rank", *[F.col(c).alias(f"{c}_{t}") for c in cols])
             for s, t in ((0, "i"), (1, "j"))]
    return sides[0].join(sides[1], "rank").filter(F.col("v_i") - F.col("v_j") > F.lit(float(tol)))


def pair_directions(pairs: DataFrame, kernel: str, gamma: float) -> DataFrame:
    """Each pair's own best step within its bounds, as a row per moved
    multiplier: (id, x, y, d)."""
    room_i = F.when(F.col("y_i") > 0, F.col("cap_i") - F.col("alpha_i")).otherwise(F.col("alpha_i"))
    room_j = F.when(F.col("y_j") > 0, F.col("alpha_j")).otherwise(F.col("cap_j") - F.col("alpha_j"))
    curve = kernel_expr("x_i", "x_i", kernel, gamma) + kernel_expr("x_j", "x_j", kernel, gamma) \
        - 2.0 * kernel_expr("x_i", "x_j", kernel, gamma)
    free = F.when(curve > 1e-12, (F.col("v_i") - F.col("v_j")) / curve).otherwise(F.lit(float("inf")))
    t = F.least(free, room_i, room_j)
    moved = pairs.withColumn("t", t)
    return moved.select(F.inline(F.array(
        F.struct(F.col("id_i").alias("id"), F.col("x_i").alias("x"), F.col("y_i").alias("y"), (F.col("y_i") * F.col("t")).alias("d")),
        F.struct(F.col("id_j").alias("id"), F.col("x_j").alias("x"), F.col("y_j").alias("y"), (-F.col("y_j") * F.col("t")).alias("d")))))


@dataclass
class Round:
    """What a round did: rows moved, the violation it started from, the share
    of the joint step taken, and the change of the objective."""

    moved: int
    gap: float
    step: float
    change: float


def pair_round(state: DataFrame, kernel: str, gamma: float, pairs: int = PAIRS, tol: float = 0.0,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, Round]:
    """One round on a state (id, x, y, cap, alpha, g): the new state, and what
    was done.  The change along the joint direction d is s*g'd + s^2/2 d'Qd,
    least at s = -g'd / d'Qd (at most 1, which keeps the bounds); both sums
    run over the moved rows, whose Qd is their change of gradient."""
    chosen = shared_table(disjoint_pairs(state, pairs, tol), "pairs")
    d = shared_table(pair_directions(chosen, kernel, gamma).filter("d <> 0"), "directions")
    gap = chosen.agg(F.max(F.col("v_i") - F.col("v_j"))).first()[0]
    if gap is None or not d.take(1):
        return state, Round(0, gap or 0.0, 0.0, 0.0)
    changed = kernel_sum(state, d.select("x", (F.col("d") * F.col("y")).alias("coef")), "coef", "_dg", kernel, gamma,
                         scale_col="y", max_broadcast_bytes=max_broadcast_bytes)
    changed = shared_table(changed.join(broadcast_if_small(d.select("id", "d")), "id", "left")
                           .withColumn("d", F.coalesce("d", F.lit(0.0))), "round")
    m = changed.agg(F.sum(F.col("g") * F.col("d")).alias("gd"), F.sum(F.col("_dg") * F.col("d")).alias("q"),
                    F.count_if(F.col("d") != 0).alias("n")).first()
    s = min(1.0, -m["gd"] / m["q"]) if m["q"] > 0 else 1.0
    # d'Qd can be 0 only to rounding; never step uphill
    s = max(0.0, s)
    new = changed.withColumn("alpha", F.least(F.greatest(F.col("alpha") + F.lit(s) * F.col("d"), F.lit(0.0)), F.col("cap"))) \
        .withColumn("g", F.col("g") + F.lit(s) * F.col("_dg")).select(*state.columns)
    return new, Round(m["n"], gap, s, s * m["gd"] + 0.5 * s * s * m["q"])


def solve_by_rounds(state: DataFrame, kernel: str, gamma: float, rounds: int, tol: float = 1e-3,
                    pairs: int = PAIRS) -> tuple[DataFrame, list[Round]]:
    """Rounds until no pair violates by more than ``tol``, or ``rounds`` of them."""
    done: list[Round] = []
    for _ in range(rounds):
        state, one = pair_round(state, kernel, gamma, pairs, tol)
        if not one.moved:
            break
        done.append(one)
        state = shared_table(state, "state")
    return state, done


# --------------------------------------------------------------------------
# zone maps
# --------------------------------------------------------------------------

@dataclass
class ZonedState:
    """A written state and the extremes of each of its files."""

    path: str
    schema: object
    zones: list      # (file, best of the up set, best of the low set), one a file

    def read(self, spark, files: list[str]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*files)


def write_zoned(state: DataFrame, files: int) -> ZonedState:
    """Write a state in about ``files`` files by ranges of -y*g, and their zone
    map: one aggregate over three columns, a row per file to the driver."""
    spark = state.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/zoned-{uuid.uuid4().hex}"
    state.withColumn("v", violation()).repartitionByRange(files, "v", "id").drop("v").write.parquet(path)
    written = spark.read.schema(state.schema).parquet(path).withColumn("file", F.input_file_name())
    zones = written.groupBy("file").agg(F.max(F.when(up_set(), violation())).alias("up"),
                                        F.min(F.when(low_set(), violation())).alias("low")).collect()
    return ZonedState(path, state.schema, [(z["file"], z["up"], z["low"]) for z in zones])


def zoned_top(spark, state: ZonedState, k: int, up: bool) -> tuple[list, list[str]]:
    """The k most violating rows of the up or the low set, and the files read.

    Files are taken from the best extreme on until they hold k rows of the
    set; the k-th of these bounds the answer, and any further file whose
    extreme is not worse is read too."""
    sign = 1.0 if up else -1.0
    order = [F.col("v").desc() if up else F.col("v").asc(), F.col("id")]
    zones = sorted(((sign * z[1 if up else 2], z[0]) for z in state.zones if z[1 if up else 2] is not None), reverse=True)
    taken, rows, n = [], [], 1
    while len(taken) < len(zones):
        worst = sign * rows[k - 1]["v"] if len(rows) >= k else None
        more = [f for best, f in zones[len(taken):] if worst is None or best >= worst]
        if not more:
            break
        # without k rows yet: twice as many files as before
        fresh = more if worst is not None else more[:n]
        taken += fresh
        n *= 2
        got = state.read(spark, fresh).filter(up_set() if up else low_set()).withColumn("v", violation()) \
            .orderBy(*order).limit(k).collect()
        rows = sorted([*rows, *got], key=lambda r: (-sign * r["v"], r["id"]))[:k]
    return rows, taken
