"""The array form of the decomposition against a plain loop over every point."""

import numpy as np
import pytest

from staffcast.functions import loess
from staffcast.operators import fitting


def fit_at(y, x, span, left, right, weights):
    n = len(y)
    reach = max(x - left, right - x)
    if span > n:
        reach += (span - n) // 2
    w = np.zeros(n)
    for j in range(left, right + 1):
        far = abs(j - x)
        if far <= 0.999 * reach:
            w[j - 1] = 1.0 if far <= 0.001 * reach else (1 - (far / reach) ** 3) ** 3
            w[j - 1] *= weights[j - 1]
    if w.sum() <= 0:
        return None
    w /= w.sum()
    position = np.arange(1, n + 1)
    mean = (w * position).sum()
    spread = (w * (position - mean) ** 2).sum()
    if np.sqrt(spread) > 0.001 * (n - 1):
        w = w * (1 + (x - mean) / spread * (position - mean))
    return (w * y).sum()


def smooth(y, span, weights):
    n = len(y)
    if n < 2:
        return y.copy()
    out = np.empty(n)
    left, right, half = 1, min(span, n), (span + 1) // 2
    for x in range(1, n + 1):
        if span < n and x > half and right != n:
            left, right = left + 1, right + 1
        value = fit_at(y, x, span, left, right, weights)
        out[x - 1] = y[x - 1] if value is None else value
    return out


def slow_decompose(y, period, inner=2, outer=15, span=7):
    n = len(y)
    trend_span = loess.odd_at_least(1.5 * period / (1 - 1.5 / span))
    low_span = loess.odd_at_least(period + 1)
    trend, season, weights, ones = np.zeros(n), np.zeros(n), np.ones(n), np.ones(n)
    for k in range(outer + 1):
        for _ in range(inner):
            detrended, cycles = y - trend, np.zeros(n + 2 * period)
            for phase in range(period):
                part, w = detrended[phase::period], weights[phase::period]
                m = len(part)
                middle = smooth(part, span, w)
                first = fit_at(part, 0, span, 1, min(span, m), w)
                last = fit_at(part, m + 1, span, max(1, m - span + 1), m, w)
                values = [middle[0] if first is None else first, *middle, middle[-1] if last is None else last]
                cycles[phase::period][: m + 2] = values
            low = cycles
            for width in (period, period, 3):
                low = np.convolve(low, np.ones(width) / width, "valid")
            season = cycles[period : period + n] - smooth(low, low_span, ones)
            trend = smooth(y - season, trend_span, weights)
        if k < outer:
            gap = np.abs(y - trend - season)
            cut = 6 * np.median(gap)
            if np.median(gap) <= 1e-9 * np.abs(y).max():
                weights = np.ones(n)
                continue
            weights = np.array([
                1.0 if g <= 0.001 * cut else (1 - (g / cut) ** 2) ** 2 if g <= 0.999 * cut else 0.0 for g in gap
            ])
    return trend, season


@pytest.mark.parametrize("n, period", [(56, 7), (60, 7), (91, 7), (18, 12), (31, 12), (40, 12)])
def test_same_as_plain_loops(n, period):
    rng = np.random.default_rng(n)
    y = 3 + 0.02 * np.arange(n) + np.sin(2 * np.pi * np.arange(n) / period) + 0.1 * rng.standard_normal(n)
    y[n // 2] += 4
    got = loess.decompose(y, period)
    trend, season = slow_decompose(y, period)
    np.testing.assert_allclose(got.trend, trend, atol=1e-8)
    np.testing.assert_allclose(got.seasonal, season, atol=1e-8)


@pytest.mark.parametrize("y", [np.zeros(60), np.full(60, 2.5), np.r_[np.zeros(59), 9.0], np.arange(60.0)])
def test_parts_add_up_and_are_finite(y):
    parts = loess.decompose(y, 7)
    np.testing.assert_allclose(parts.trend + parts.seasonal + parts.remainder, y, atol=1e-12)
    assert np.all(np.isfinite(parts.trend)) and np.all(np.isfinite(parts.seasonal))


def test_finds_season_and_trend_in_spite_of_outliers():
    t = np.arange(140)
    season = np.tile([0.0, 0.5, 1.0, 0.5, 0.0, -1.0, -1.0], 20)
    y = 2 + 0.01 * t + season + np.random.default_rng(0).normal(0, 0.05, 140)
    y[[30, 80]] += 10
    parts = loess.decompose(y, 7)
    # the two odd days stay in the remainder instead of bending trend or season
    assert np.abs(parts.remainder[[30, 80]] - 10).max() < 0.5
    assert np.abs(parts.trend - (2 + 0.01 * t + season.mean())).max() < 0.3
    assert np.corrcoef(parts.seasonal, season)[0, 1] > 0.97


def test_spans():
    assert loess.odd_at_least(1.5 * 7 / (1 - 1.5 / 7)) == 15
    assert loess.odd_at_least(1.5 * 12 / (1 - 1.5 / 7)) == 23
    assert loess.odd_at_least(8) == 9 and loess.odd_at_least(13) == 13


@pytest.mark.parametrize("n", range(18, 37))
def test_rounding_noise_does_not_move_a_monthly_fit(n):
    rng = np.random.default_rng(n)
    y = 3 + 0.02 * np.arange(n) + np.sin(2 * np.pi * np.arange(n) / 12) + 0.1 * rng.standard_normal(n)
    first, second = loess.decompose(y, 12), loess.decompose(y * (1 + 1e-15), 12)
    assert abs((first.trend + first.seasonal - second.trend - second.seasonal)).max() < 1e-9
    assert abs(first.trend - second.trend).max() < 1e-9


@pytest.mark.parametrize("n", range(18, 25))
def test_an_exact_monthly_fit_keeps_a_band(n):
    y = 40 + 10 * np.sin(np.arange(n)) + np.random.default_rng(n).random(n)
    assert fitting.decomposition_row(y, 12)["log_sd"] > 1e-6
