"""Small dense solvers used inside ``applyInPandas`` groups (one portfolio problem each).

No SciPy here: a primal active-set method for the long-only quadratic programs
(min w'Sw subject to equality rows and w >= 0) and cyclical coordinate descent for
risk parity.  N is the number of assets of one portfolio (at most 50 by the
portfolio rules), so each solve is a few small linear systems.
"""

from __future__ import annotations

import numpy as np


def active_set_qp(G: np.ndarray, E: np.ndarray, f: np.ndarray, w0: np.ndarray, max_iter: int = 500,
                  tol: float = 1e-12):
    """min 1/2 w'Gw  s.t.  E w = f,  w >= 0, from a feasible start ``w0``.

    Returns (w, converged).  Standard primal active set: solve the equality-constrained
    step on the free variables, walk to the first blocking bound, drop the bound with
    the most negative multiplier when the step is zero.
    """
    n = len(w0)
    w = w0.astype(float).copy()
    active = set(np.where(w <= tol)[0].tolist())
    for _ in range(max_iter):
        free = [i for i in range(n) if i not in active]
        g = G @ w
        Gf = G[np.ix_(free, free)]
        Ef = E[:, free]
        m = E.shape[0]
        K = np.zeros((len(free) + m, len(free) + m))
        K[:len(free), :len(free)] = Gf
        K[:len(free), len(free):] = Ef.T
        K[len(free):, :len(free)] = Ef
        rhs = np.concatenate([-g[free], np.zeros(m)])
        sol = np.linalg.lstsq(K, rhs, rcond=None)[0]
        p = np.zeros(n)
        p[free] = sol[:len(free)]
        lam = sol[len(free):]
        if np.linalg.norm(p) <= 1e-12 * max(1.0, np.linalg.norm(w)):
            nu = g + E.T @ lam
            cand = [(nu[i], i) for i in active]
            if not cand or min(cand)[0] >= -1e-12:
                return w, True
            active.remove(min(cand)[1])
            continue
        alpha, block = 1.0, None
        for i in free:
            if p[i] < -1e-15:
                a = -w[i] / p[i]
                if a < alpha:
                    alpha, block = a, i
        w = w + alpha * p
        w[w < 0] = 0.0
        if block is not None:
            active.add(block)
    return w, False


def min_variance(S: np.ndarray, mu: np.ndarray, target: float | None = None):
    """O-02: minimum variance, long only, weights sum to 1, optionally mean return = target."""
    n = len(mu)
    if target is None:
        E, f = np.ones((1, n)), np.array([1.0])
        w0 = np.full(n, 1.0 / n)
    else:
        lo, hi = int(np.argmin(mu)), int(np.argmax(mu))
        if not (mu[lo] - 1e-15 <= target <= mu[hi] + 1e-15):
            return np.full(n, 1.0 / n), False
        E, f = np.vstack([np.ones(n), mu]), np.array([1.0, target])
        w0 = np.zeros(n)
        if mu[hi] - mu[lo] > 0:
            a = (target - mu[lo]) / (mu[hi] - mu[lo])
            w0[hi], w0[lo] = a, 1 - a
        else:
            w0[:] = 1.0 / n
    return active_set_qp(2 * S, E, f, w0)


def max_sharpe(S: np.ndarray, mu: np.ndarray, rf: float):
    """O-01: maximise (mu'w - rf) / sqrt(w'Sw), long only, sum 1.

    With some excess return positive this is min y'Sy s.t. (mu - rf)'y = 1, y >= 0,
    then w = y / sum(y).  Otherwise the reference falls back to equal weights.
    """
    n = len(mu)
    ex = mu - rf
    k = int(np.argmax(ex))
    if ex[k] <= 0:
        return np.full(n, 1.0 / n), False
    y0 = np.zeros(n)
    y0[k] = 1.0 / ex[k]
    y, ok = active_set_qp(2 * S, ex.reshape(1, -1), np.array([1.0]), y0)
    s = y.sum()
    if s <= 0:
        return np.full(n, 1.0 / n), False
    return y / s, ok


def risk_parity(S: np.ndarray, budget: np.ndarray | None = None, max_iter: int = 1000, tol: float = 1e-12):
    """O-05: weights whose risk contributions w_i (S w)_i match the budget shares
    (cyclical coordinate descent on the risk-budgeting fixed point), normalised to 1."""
    n = S.shape[0]
    b = np.full(n, 1.0 / n) if budget is None else np.asarray(budget, float)
    w = np.full(n, 1.0 / n)
    for _ in range(max_iter):
        prev = w.copy()
        for i in range(n):
            sigma = np.sqrt(max(w @ S @ w, 1e-300))
            c = S[i] @ w - S[i, i] * w[i]
            a = S[i, i]
            if a <= 0:
                continue
            w[i] = (-c + np.sqrt(c * c + 4 * a * b[i] * sigma)) / (2 * a)
        if np.max(np.abs(w - prev)) < tol:
            return w / w.sum(), True
    return w / w.sum(), False
