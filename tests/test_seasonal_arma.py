import numpy as np
import pytest

from staffcast.functions import seasonal_arma as arma


def simulate(p, n, seed=1):
    a, big_a, m, big_m = p
    e = np.random.default_rng(seed).standard_normal(n + 200)
    z = np.zeros(n + 200)
    for t in range(8, n + 200):
        z[t] = (
            a * z[t - 1] + big_a * z[t - 7] - a * big_a * z[t - 8]
            + e[t] + m * e[t - 1] + big_m * e[t - 7] + m * big_m * e[t - 8]
        )
    return z[200:]


def test_residuals_match_the_recursion():
    z, p = simulate((0.5, 0.4, 0.3, 0.2), 120), np.array([0.5, 0.4, 0.3, 0.2])
    a, big_a, m, big_m = p
    e = np.zeros(128)
    past = np.r_[np.zeros(8), z]
    for t in range(8, 128):
        e[t] = (
            past[t] - a * past[t - 1] - big_a * past[t - 7] + a * big_a * past[t - 8]
            - m * e[t - 1] - big_m * e[t - 7] - m * big_m * e[t - 8]
        )
    np.testing.assert_allclose(arma.residuals(z, p), e[8:], atol=1e-9)


@pytest.mark.parametrize("p", [(0.6, 0.5, 0.3, 0.4), (-0.3, 0.8, 0.7, 0.2), (0.9, -0.4, 0.2, -0.3)])
def test_coefficients_are_recovered(p):
    got = arma.fit(simulate(p, 4000))
    np.testing.assert_allclose(got, p, atol=0.08)


def test_forecast_follows_the_recursion():
    z, p = simulate((0.5, 0.4, 0.3, 0.2), 200), np.array([0.5, 0.4, 0.3, 0.2])
    ahead = arma.forecast(z, p, 400)
    e = arma.residuals(z, p)
    first = 0.5 * z[-1] + 0.4 * z[-7] - 0.2 * z[-8] + 0.3 * e[-1] + 0.2 * e[-7] + 0.06 * e[-8]
    assert ahead[0] == pytest.approx(first)
    assert abs(ahead[-1]) < 1e-6


@pytest.mark.parametrize("z", [np.zeros(100), np.ones(20)])
def test_unusable_series_are_refused(z):
    assert arma.fit(z) is None


def test_strong_weekly_pattern_is_repeated():
    z = np.log1p(np.tile([10, 12, 11, 9, 8, 2, 1], 30) + np.random.default_rng(3).normal(0, 0.3, 210))
    ahead = arma.forecast(z, arma.fit(z), 14)
    assert np.all(np.isfinite(ahead))
    assert ahead[0] > ahead[5] + 1 and ahead[7] > ahead[12] + 1
