"""Kernel arithmetic in two forms.

* Column expressions over ``ARRAY<DOUBLE>`` columns, for row-pair tables
  (a pair of vectors in one row).  They stay JVM-side.
* NumPy block kernels used inside Arrow tasks, where one batch of rows is
  scored against a broadcast block of basis vectors with one GEMM.

Kernel names: ``rbf`` = exp(-gamma * |a-b|^2), ``linear`` = a.b,
``sqdist`` = |a-b|^2 (the squared distance the reference's decision value
uses in place of the kernel; selectable for scoring only).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

KERNELS = ("rbf", "linear", "sqdist")


def check_kernel(kernel: str) -> str:
    if kernel not in KERNELS:
        raise ValueError(f"unknown kernel {kernel!r}; expected one of {KERNELS}")
    return kernel


# --------------------------------------------------------------------------
# column expressions
# --------------------------------------------------------------------------

def sq_distance(a: Column | str, b: Column | str) -> Column:
    """|a - b|^2 of two equal-length double arrays (K1)."""
    diffs = F.zip_with(_col(a), _col(b), lambda p, q: (p - q) * (p - q))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column | str, b: Column | str) -> Column:
    prods = F.zip_with(_col(a), _col(b), lambda p, q: p * q)
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


def kernel_expr(a: Column | str, b: Column | str, kernel: str = "rbf",
                gamma: float = 0.5) -> Column:
    """K(a, b) as a column (K2 for ``rbf``)."""
    check_kernel(kernel)
    if kernel == "linear":
        return dot(a, b)
    d2 = sq_distance(a, b)
    if kernel == "sqdist":
        return d2
    return F.exp(F.lit(-float(gamma)) * d2)


def curvature_expr(a: Column | str, b: Column | str, kernel: str = "rbf",
                   gamma: float = 0.5) -> Column:
    """eta = 2 K(a,b) - K(a,a) - K(b,b), never positive for a valid kernel (K3)."""
    return (F.lit(2.0) * kernel_expr(a, b, kernel, gamma)
            - kernel_expr(a, a, kernel, gamma) - kernel_expr(b, b, kernel, gamma))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# NumPy block kernels (run inside tasks or on a bounded driver block)
# --------------------------------------------------------------------------

def block_kernel(X: np.ndarray, S: np.ndarray, kernel: str, gamma: float,
                 center: np.ndarray | None = None) -> np.ndarray:
    """K(X_i, S_j) for a row block X (n x d) against a basis block S (m x d).

    Squared distances use |x|^2 + |s|^2 - 2 x.s after subtracting a common
    centre (the basis mean) so large raw magnitudes do not cancel.
    """
    if kernel == "linear":
        return X @ S.T
    if center is None:
        center = S.mean(axis=0) if len(S) else np.zeros(X.shape[1])
    Xc = X - center
    Sc = S - center
    x2 = np.einsum("ij,ij->i", Xc, Xc)
    s2 = np.einsum("ij,ij->i", Sc, Sc)
    d2 = x2[:, None] + s2[None, :] - 2.0 * (Xc @ Sc.T)
    np.maximum(d2, 0.0, out=d2)
    if kernel == "sqdist":
        return d2
    np.multiply(d2, -float(gamma), out=d2)
    return np.exp(d2, out=d2)


def block_kernel_sum(X: np.ndarray, S: np.ndarray, coef: np.ndarray,
                     kernel: str, gamma: float, center: np.ndarray | None = None,
                     max_cells: int = 4_000_000) -> np.ndarray:
    """sum_j coef_j K(X_i, S_j) for every row of X, in row slices that keep
    the n x m kernel block under ``max_cells`` doubles."""
    out = np.zeros(len(X), dtype=np.float64)
    if len(S) == 0 or len(X) == 0:
        return out
    if kernel == "linear":
        # sum_j c_j (x . s_j) = x . (sum_j c_j s_j): one d-vector per basis
        return X @ (S.T @ coef)
    if center is None:
        center = S.mean(axis=0)
    step = max(1, max_cells // max(1, len(S)))
    for lo in range(0, len(X), step):
        blk = block_kernel(X[lo:lo + step], S, kernel, gamma, center)
        out[lo:lo + step] = blk @ coef
    return out
