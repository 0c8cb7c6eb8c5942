"""Robust seasonal-trend decomposition of one series by local regression.

Follows the published procedure of Cleveland, Cleveland, McRae and Terpenning
(1990). One call handles one department inside a Spark task. Neighbourhoods and
distance weights depend only on the length, so they are built once per series
and every smoothing pass is a handful of array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


# Median gaps below this part of the largest value are rounding noise: the fit is exact and
# all points keep their full weight.
EXACT_FIT = 1e-9


def odd_at_least(value: float) -> int:
    """Smallest odd whole number not below ``value``."""
    whole = int(np.ceil(value))
    return whole if whole % 2 else whole + 1


class LocalLine:
    """Degree-1 local regression on positions 1..n, evaluated at ``points``."""

    def __init__(self, n: int, span: int, points: np.ndarray):
        width = min(span, n)
        first = np.clip(points - (span + 1) // 2 + 1, 1, n - width + 1)
        self.position = first[:, None] + np.arange(width)[None, :]
        self.index = self.position - 1
        reach = np.maximum(points - first, first + width - 1 - points).astype(float)
        if span > n:
            reach += (span - n) // 2
        far = np.abs(self.position - points[:, None])
        scaled = far / np.where(reach > 0, reach, 1.0)[:, None]
        weight = np.where(scaled <= 0.001, 1.0, (1.0 - np.minimum(scaled, 1.0) ** 3) ** 3)
        self.distance_weight = np.where(scaled <= 0.999, weight, 0.0)
        self.points = points
        self.spread_floor = 0.001 * (n - 1)

    def __call__(self, y: np.ndarray, robustness: np.ndarray | None = None) -> np.ndarray:
        """Fitted values for a batch of series ``y`` of shape (series, n); NaN where no weight is left."""
        weight = self.distance_weight[None]
        if robustness is not None:
            weight = weight * robustness[:, self.index]
        total = weight.sum(axis=2, keepdims=True)
        weight = np.divide(weight, total, out=np.full_like(weight, np.nan), where=total > 0)
        centre = (weight * self.position).sum(axis=2, keepdims=True)
        offset = self.position - centre
        spread = (weight * offset**2).sum(axis=2, keepdims=True)
        sloped = np.sqrt(spread) > self.spread_floor
        lean = np.divide(
            self.points[None, :, None] - centre, spread, out=np.zeros_like(spread), where=sloped
        )
        return (weight * (1.0 + lean * offset) * y[:, self.index]).sum(axis=2)


class _SeasonalSmoother:
    """Smooths every phase of the season and extends it by one cycle on both sides."""

    def __init__(self, n: int, period: int, span: int):
        self.n, self.period = n, period
        self.batches = []
        whole, spare = divmod(n, period)
        for phases, length in ((range(spare), whole + 1), (range(spare, period), whole)):
            if len(phases) and length:
                rows = np.array([[p + period * i for i in range(length)] for p in phases])
                self.batches.append((rows, LocalLine(length, span, np.arange(0, length + 2))))

    def __call__(self, y: np.ndarray, robustness: np.ndarray | None) -> np.ndarray:
        out = np.empty(self.n + 2 * self.period)
        for rows, line in self.batches:
            values = y[rows]
            fit = line(values, None if robustness is None else robustness[rows])
            inner = np.where(np.isnan(fit[:, 1:-1]), values, fit[:, 1:-1])
            before = np.where(np.isnan(fit[:, 0]), inner[:, 0], fit[:, 0])
            after = np.where(np.isnan(fit[:, -1]), inner[:, -1], fit[:, -1])
            out[rows] = np.c_[before, inner[:, :-1]]
            out[rows[:, -1] + self.period] = inner[:, -1]
            out[rows[:, -1] + 2 * self.period] = after
        return out


def _running_mean(y: np.ndarray, width: int) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(y)))
    return (total[width:] - total[:-width]) / width


@dataclass(frozen=True)
class Decomposition:
    trend: np.ndarray
    seasonal: np.ndarray
    remainder: np.ndarray


def decompose(y: np.ndarray, period: int, inner: int = 2, outer: int = 15, seasonal_span: int = 7) -> Decomposition:
    """Split ``y`` into trend, seasonal and remainder with robustness weights."""
    y = np.asarray(y, dtype=float)
    n = len(y)
    positions = np.arange(1, n + 1)
    smooth_season = _SeasonalSmoother(n, period, seasonal_span)
    smooth_trend = LocalLine(n, odd_at_least(1.5 * period / (1 - 1.5 / seasonal_span)), positions)
    smooth_low = LocalLine(n, odd_at_least(period + 1), positions)

    def keep_if_blank(fit: np.ndarray, source: np.ndarray) -> np.ndarray:
        return np.where(np.isnan(fit), source, fit)

    trend, seasonal, weights = np.zeros(n), np.zeros(n), None
    for round_no in range(outer + 1):
        for _ in range(inner):
            cycles = smooth_season(y - trend, weights)
            low = _running_mean(_running_mean(_running_mean(cycles, period), period), 3)
            seasonal = cycles[period : period + n] - keep_if_blank(smooth_low(low[None])[0], low)
            level = y - seasonal
            fit = smooth_trend(level[None], None if weights is None else weights[None])[0]
            trend = keep_if_blank(fit, level)
        if round_no < outer:
            gap = np.abs(y - trend - seasonal)
            cut = 6.0 * np.median(gap)
            if cut <= 6.0 * EXACT_FIT * np.max(np.abs(y), initial=0.0):
                weights = None
                continue
            share = gap / cut
            weights = np.where(share <= 0.001, 1.0, (1.0 - np.minimum(share, 1.0) ** 2) ** 2)
            weights[share > 0.999] = 0.0
    return Decomposition(trend, seasonal, y - trend - seasonal)
