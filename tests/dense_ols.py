"""Dense dummy-variable OLS in numpy: the test oracle for the estimators.

Builds the full design (intercept, regressors, one dummy per non-base
level of each effect) and applies the textbook covariance formulas.
"""

import numpy as np
import pandas as pd


def design(df: pd.DataFrame, xs, fes):
    cols = [np.ones(len(df))] + [df[x].to_numpy(float) for x in xs]
    for fe in fes:
        levels = sorted(df[fe].unique())
        for lv in levels[1:]:
            cols.append((df[fe].to_numpy() == lv).astype(float))
    return np.column_stack(cols)


def fit(df: pd.DataFrame, y, xs, fes=(), cluster=None, cov="cluster"):
    x = design(df, xs, fes)
    yv = df[y].to_numpy(float)
    xtx_inv = np.linalg.pinv(x.T @ x)
    b = xtx_inv @ x.T @ yv
    u = yv - x @ b
    n, k = x.shape
    if cov == "cluster":
        g = df[cluster].to_numpy()
        n_g = len(np.unique(g))
        s = pd.DataFrame(x * u[:, None]).groupby(g).sum().to_numpy()
        v = xtx_inv @ (s.T @ s) @ xtx_inv * (n_g / (n_g - 1)) * ((n - 1) / (n - k))
    else:
        rank = np.linalg.matrix_rank(x)
        meat = (x * (u ** 2)[:, None]).T @ x
        v = xtx_inv @ meat @ xtx_inv * (n / (n - rank))
    idx = slice(1, 1 + len(xs))
    r2 = 1 - (u @ u) / ((yv - yv.mean()) @ (yv - yv.mean()))
    return b[idx], np.sqrt(np.diag(v))[idx], k, r2
