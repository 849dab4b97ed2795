"""Sequential-minimal-optimisation arithmetic for one pair of multipliers.

Convention used everywhere in the package:

* labels y in {-1, +1};
* decision value f(x) = sum_j alpha_j y_j K(x_j, x) - b;
* prediction error E_i = f(x_i) - y_i;
* gradient of the minimised dual 0.5 a'Qa - sum(a) is g_i = y_i (E_i + b),
  so E_i - E_j = y_i g_i - y_j g_j does not depend on b.

Each multiplier has its own upper bound ``c`` (C times the multiplicity of a
de-duplicated row), so the same formulas serve weighted and plain problems.
The step is the corrected reading of the reference's pair update: Newton step
along the constraint line when the curvature is negative, clipped to [L, H];
otherwise the smaller of the two end-point objectives; three-way b update.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Curvature at or above -ETA_FLOOR is treated as flat (identical points).
ETA_FLOOR = 1e-12


# --------------------------------------------------------------------------
# column expressions (pair tables)
# --------------------------------------------------------------------------

def lower_bound(y1, y2, a1, a2, c1, c2) -> Column:
    """L: y differ -> max(0, a2 - a1); same -> max(0, a1 + a2 - c1)."""
    return F.when(y1 != y2, F.greatest(F.lit(0.0), a2 - a1)) \
        .otherwise(F.greatest(F.lit(0.0), a1 + a2 - c1))


def upper_bound(y1, y2, a1, a2, c1, c2) -> Column:
    """H: y differ -> min(c2, c1 + a2 - a1); same -> min(c2, a1 + a2)."""
    return F.when(y1 != y2, F.least(c2, c1 + a2 - a1)) \
        .otherwise(F.least(c2, a1 + a2))


# --------------------------------------------------------------------------
# the same step on scalars (driver-side working-set solver)
# --------------------------------------------------------------------------

def pair_step(y1, y2, a1, a2, e1, e2, k11, k12, k22, c1, c2, b=0.0,
              eps: float = 1e-3):
    s = y1 * y2
    if y1 != y2:
        lo, hi = max(0.0, a2 - a1), min(c2, c1 + a2 - a1)
    else:
        lo, hi = max(0.0, a1 + a2 - c1), min(c2, a1 + a2)
    eta = 2.0 * k12 - k11 - k22
    if lo >= hi:
        a2n = a2
    elif eta < -ETA_FLOOR:
        a2n = min(max(a2 - y2 * (e1 - e2) / eta, lo), hi)
    else:
        f1 = y1 * (e1 + b) - a1 * k11 - s * a2 * k12
        f2 = y2 * (e2 + b) - s * a1 * k12 - a2 * k22
        l1 = a1 + s * (a2 - lo)
        h1 = a1 + s * (a2 - hi)
        lobj = l1 * f1 + lo * f2 + 0.5 * l1 * l1 * k11 + 0.5 * lo * lo * k22 + s * lo * l1 * k12
        hobj = h1 * f1 + hi * f2 + 0.5 * h1 * h1 * k11 + 0.5 * hi * hi * k22 + s * hi * h1 * k12
        a2n = lo if lobj < hobj - eps else hi if lobj > hobj + eps else a2
    a1n = a1 + s * (a2 - a2n)
    b1 = e1 + y1 * (a1n - a1) * k11 + y2 * (a2n - a2) * k12 + b
    b2 = e2 + y1 * (a1n - a1) * k12 + y2 * (a2n - a2) * k22 + b
    if 0.0 < a1n < c1:
        bn = b1
    elif 0.0 < a2n < c2:
        bn = b2
    else:
        bn = (b1 + b2) / 2.0
    return a1n, a2n, bn


def with_pair_step_columns(df, y1: str, y2: str, a1: str, a2: str, e1: str, e2: str,
                           k11: str, k12: str, k22: str, c1: str, c2: str, b: float,
                           eps: float = 1e-3):
    """The same step added as columns a1_new, a2_new, b_new through named
    intermediate columns.

    As one expression it would repeat L, H and the new alphas inside every
    later term, and take seconds to analyse; staged columns keep the plan linear (Catalyst does not inline a
    non-trivial column that is used more than once)."""
    col = F.col
    t = "_ps_"
    out = df.withColumns({
        t + "s": col(y1) * col(y2),
        t + "lo": lower_bound(col(y1), col(y2), col(a1), col(a2), col(c1), col(c2)),
        t + "hi": upper_bound(col(y1), col(y2), col(a1), col(a2), col(c1), col(c2)),
        t + "eta": F.lit(2.0) * col(k12) - col(k11) - col(k22),
        t + "b": F.lit(float(b)),
    })
    s, lo, hi, eta, bb = (col(t + n) for n in ("s", "lo", "hi", "eta", "b"))
    out = out.withColumns({
        t + "newton": F.least(F.greatest(col(a2) - col(y2) * (col(e1) - col(e2)) / eta, lo), hi),
        t + "f1": col(y1) * (col(e1) + bb) - col(a1) * col(k11) - s * col(a2) * col(k12),
        t + "f2": col(y2) * (col(e2) + bb) - s * col(a1) * col(k12) - col(a2) * col(k22),
        t + "l1": col(a1) + s * (col(a2) - lo),
        t + "h1": col(a1) + s * (col(a2) - hi),
    })
    f1, f2, l1, h1 = (col(t + n) for n in ("f1", "f2", "l1", "h1"))
    out = out.withColumns({
        t + "lobj": (l1 * f1 + lo * f2 + F.lit(0.5) * l1 * l1 * col(k11)
                     + F.lit(0.5) * lo * lo * col(k22) + s * lo * l1 * col(k12)),
        t + "hobj": (h1 * f1 + hi * f2 + F.lit(0.5) * h1 * h1 * col(k11)
                     + F.lit(0.5) * hi * hi * col(k22) + s * hi * h1 * col(k12)),
    })
    lobj, hobj = col(t + "lobj"), col(t + "hobj")
    flat = (F.when(lobj < hobj - F.lit(eps), lo)
            .when(lobj > hobj + F.lit(eps), hi).otherwise(col(a2)))
    out = out.withColumn("a2_new", F.when(lo >= hi, col(a2))
                         .when(eta < F.lit(-ETA_FLOOR), col(t + "newton")).otherwise(flat))
    out = out.withColumn("a1_new", col(a1) + s * (col(a2) - col("a2_new")))
    a1n, a2n = col("a1_new"), col("a2_new")
    out = out.withColumns({
        t + "b1": col(e1) + col(y1) * (a1n - col(a1)) * col(k11) + col(y2) * (a2n - col(a2)) * col(k12) + bb,
        t + "b2": col(e2) + col(y1) * (a1n - col(a1)) * col(k12) + col(y2) * (a2n - col(a2)) * col(k22) + bb,
    })
    b1, b2 = col(t + "b1"), col(t + "b2")
    out = out.withColumn("b_new", F.when((a1n > 0) & (a1n < col(c1)), b1)
                         .when((a2n > 0) & (a2n < col(c2)), b2)
                         .otherwise((b1 + b2) / F.lit(2.0)))
    return out.drop(*[c for c in out.columns if c.startswith(t)])
