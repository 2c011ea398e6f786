"""Small-matrix statistics on coefficient-sized results (driver side).

Inputs here are K x K moment matrices (K <= ~10) per group, never rows.
"""

from __future__ import annotations

import math

import numpy as np

Z_CRIT_95 = 1.959963984540054


def two_sided_p(z: float) -> float:
    """Normal reference: p = erfc(|z| / sqrt(2))."""
    if z is None or not math.isfinite(z):
        return float("nan") if z is None or math.isnan(z) else 0.0
    return math.erfc(abs(z) / math.sqrt(2.0))


def select_identified(gram: np.ndarray, raw_ss: np.ndarray, rel_tol: float = 1e-9) -> list[int]:
    """Indices of regressors that stay identified after absorption.

    A column is dropped when its demeaned sum of squares is a negligible
    fraction of its raw centred one (absorbed by an effect, trap T4) or when
    it is (numerically) a combination of the columns kept before it.
    """
    kept: list[int] = []
    for j in range(gram.shape[0]):
        scale = max(raw_ss[j], 0.0)
        if scale <= 0 or gram[j, j] <= rel_tol * scale:
            continue
        if kept:
            a = gram[np.ix_(kept, kept)]
            c = gram[np.ix_(kept, [j])]
            resid = gram[j, j] - float(c.T @ np.linalg.solve(a, c))
            if resid <= rel_tol * gram[j, j]:
                continue
        kept.append(j)
    return kept


def sym_from_upper(values: dict, k: int, prefix: str) -> np.ndarray:
    m = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            m[i, j] = m[j, i] = values[f"{prefix}_{i}_{j}"]
    return m
