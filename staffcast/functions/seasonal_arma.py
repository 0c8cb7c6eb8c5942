"""Weekly seasonal ARMA fit of one series by conditional least squares.

Model on the log scale, no constant:
``(1 - a B)(1 - A B^7) z = (1 + m B)(1 + M B^7) e``. Starting values come from a
long autoregression (Hannan and Rissanen 1982); Gauss-Newton steps then minimise
the conditional sum of squares. This is not a likelihood fit, so values differ
slightly from one.
"""

from __future__ import annotations

import numpy as np

SEASON = 7
AR_BOUND, MA_BOUND = 1.0, 0.98


def _lagged(x: np.ndarray, lag: int) -> np.ndarray:
    return np.concatenate((np.zeros(lag), x[:-lag]))


def _undo_ma(x: np.ndarray, coefficient: float, lag: int) -> np.ndarray:
    """Apply ``1 / (1 + c B^lag)`` by its power series, independently per phase."""
    n = len(x)
    rows = -(-n // lag)
    grid = np.concatenate((x, np.zeros(rows * lag - n))).reshape(rows, lag)
    size = abs(coefficient)
    terms = rows if size > 0.999 else min(rows, 2 + int(np.log(1e-14) / np.log(max(size, 1e-9))))
    kernel = (-coefficient) ** np.arange(terms)
    return np.column_stack([np.convolve(grid[:, j], kernel)[:rows] for j in range(lag)]).ravel()[:n]


def residuals(z: np.ndarray, p: np.ndarray) -> np.ndarray:
    a, big_a, m, big_m = p
    w = z - a * _lagged(z, 1)
    w = w - big_a * _lagged(w, SEASON)
    return _undo_ma(_undo_ma(w, m, 1), big_m, SEASON)


def _bounded(p: np.ndarray) -> np.ndarray:
    bound = np.array([AR_BOUND, AR_BOUND, MA_BOUND, MA_BOUND])
    return np.clip(p, -bound, bound)


def _starting_point(z: np.ndarray) -> np.ndarray:
    order = min(4 * SEASON, len(z) // 4)
    design = np.column_stack([_lagged(z, k) for k in range(1, order + 1)])[order:]
    long_fit, *_ = np.linalg.lstsq(design, z[order:], rcond=None)
    noise = np.concatenate((np.zeros(order), z[order:] - design @ long_fit))
    skip = order + SEASON + 1
    columns = [_lagged(s, k) for s in (z, noise) for k in (1, SEASON, SEASON + 1)]
    coefficient, *_ = np.linalg.lstsq(np.column_stack(columns)[skip:], z[skip:], rcond=None)
    return _bounded(coefficient[[0, 1, 3, 4]] * np.array([1.0, 1.0, 0.9, 0.9]))


def fit(z: np.ndarray, steps: int = 30) -> np.ndarray | None:
    """Coefficients (a, A, m, M), or None when the series cannot be fitted."""
    if len(z) < 5 * SEASON or not np.any(z):
        return None
    burn = SEASON + 1
    p = _starting_point(z)
    e = residuals(z, p)
    cost = float(e[burn:] @ e[burn:])
    for _ in range(steps):
        nudge = 1e-6
        slope = np.column_stack(
            [(residuals(z, p + nudge * unit) - e)[burn:] / nudge for unit in np.eye(4)]
        )
        move, *_ = np.linalg.lstsq(slope, -e[burn:], rcond=1e-10)
        for scale in 0.5 ** np.arange(10):
            trial = _bounded(p + scale * move)
            e_trial = residuals(z, trial)
            trial_cost = float(e_trial[burn:] @ e_trial[burn:])
            if np.isfinite(trial_cost) and trial_cost < cost:
                break
        else:
            break
        gain = (cost - trial_cost) / max(cost, 1e-300)
        p, e, cost = trial, e_trial, trial_cost
        if gain < 1e-9:
            break
    return p if np.all(np.isfinite(p)) and np.isfinite(cost) else None


def forecast(z: np.ndarray, p: np.ndarray, horizon: int) -> np.ndarray:
    """Mean of ``z`` for the next ``horizon`` steps; future noise is 0."""
    a, big_a, m, big_m = p
    keep = SEASON + 1
    past = list(z[-keep:])
    noise = np.concatenate((residuals(z, p)[-keep:], np.zeros(horizon)))
    for h in range(horizon):
        t = keep + h
        past.append(
            a * past[t - 1] + big_a * past[t - SEASON] - a * big_a * past[t - keep]
            + m * noise[t - 1] + big_m * noise[t - SEASON] + m * big_m * noise[t - keep]
        )
    return np.array(past[keep:])
