"""Cumulative-link (proportional odds) regression on sparse rows.

P(grade <= k) = sigmoid(cut_k - w.x): one weight vector for all thresholds, ordered by
construction (each cut is the one before it plus an exponential).  Fitted by full-batch
gradient steps with Adam scaling on rows held as (row, column) index pairs."""

from __future__ import annotations

import numpy as np


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def grade_probabilities(margin: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """(rows, grades) probabilities from margins and ordered cuts."""
    below = _sigmoid(cuts[None, :] - margin[:, None])
    edge = np.ones((len(margin), 1))
    return np.diff(np.concatenate([0 * edge, below, edge], axis=1), axis=1)


def expected_grade(margin: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum over k of P(grade > k)."""
    return (1.0 - _sigmoid(cuts[None, :] - margin[:, None])).sum(1)


def fit(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_cols: int, n_grades: int, *,
        steps: int = 600, rate: float = 0.1, l2: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """(weights, cuts) for ``grades`` in 0..n_grades-1; entry i puts a 1 at (rows[i], cols[i]).
    Grades that never occur keep an ordered cut.  Without rows: zero weights, everything grade 0."""
    n = len(grades)
    w, first, gaps = np.zeros(n_cols), 0.0, np.zeros(max(0, n_grades - 2))
    if n == 0:
        return w, np.full(n_grades - 1, 5.0) + np.arange(n_grades - 1)
    share = np.clip((np.bincount(grades, minlength=n_grades).cumsum()[:-1] + 0.5) / (n + 1.0), 1e-4, 1 - 1e-4)
    start = np.log(share / (1 - share))
    first, gaps = start[0], np.log(np.maximum(np.diff(start), 0.05))
    theta = np.concatenate([w, [first], gaps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    pick = np.arange(n)
    for step in range(1, steps + 1):
        w, cuts = theta[:n_cols], theta[n_cols] + np.concatenate([[0.0], np.exp(theta[n_cols + 1:]).cumsum()])
        margin = np.bincount(rows, w[cols], n)
        upper, lower = np.append(cuts, np.inf)[grades], np.append(-np.inf, cuts)[grades]
        fu = np.where(np.isinf(upper), 1.0, _sigmoid(np.where(np.isinf(upper), 0, upper) - margin))
        fl = np.where(np.isinf(lower), 0.0, _sigmoid(np.where(np.isinf(lower), 0, lower) - margin))
        p = np.maximum(fu - fl, 1e-12)
        du, dl = fu * (1 - fu), fl * (1 - fl)
        d_margin = (du - dl) / p / n  # of the negative log-likelihood
        d_cuts = np.zeros(n_grades - 1)
        has_u, has_l = grades < n_grades - 1, grades > 0
        np.add.at(d_cuts, grades[has_u], -(du / p)[has_u] / n)
        np.add.at(d_cuts, grades[has_l] - 1, (dl / p)[has_l] / n)
        g = np.empty_like(theta)
        g[:n_cols] = np.bincount(cols, d_margin[rows], n_cols) + l2 * w
        g[n_cols] = d_cuts.sum()
        for k in range(n_grades - 2):
            g[n_cols + 1 + k] = d_cuts[k + 1:].sum() * np.exp(theta[n_cols + 1 + k])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    cuts = theta[n_cols] + np.concatenate([[0.0], np.exp(theta[n_cols + 1:]).cumsum()])
    return theta[:n_cols], cuts
