"""Recursions, distributions, tests on series, pricing: closed forms, published values and properties."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fathom.functions import distributions as di
from fathom.functions import recursion as rec
from fathom.functions import timeseries as ts
from fathom.operators import performance as pf
from fathom.operators import pricing as pr

numbers = st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=0, max_size=60)


@given(numbers, st.integers(1, 10))
@settings(max_examples=60, deadline=None)
def test_ema_is_the_recursion(xs, n):
    x = np.array(xs, float)
    got = rec.ema(x, n)
    if len(x) < n:
        assert np.isnan(got).all()
        return
    seeded = np.concatenate(([x[:n].mean()], x[n:]))
    want = pd.Series(seeded).ewm(alpha=2 / (n + 1), adjust=False).mean().to_numpy()
    assert np.allclose(got[n - 1 :], want) and np.isnan(got[: n - 1]).all()


@given(numbers, st.integers(1, 8))
@settings(max_examples=40, deadline=None)
def test_smoother_knows_no_future(xs, n):
    x = np.array(xs, float)
    whole = rec.rma(x, n)
    for cut in range(0, len(x), 7):
        assert np.array_equal(rec.rma(x[:cut], n), whole[:cut], equal_nan=True)


@pytest.mark.parametrize("got, want", [
    (di.t_two_sided(2.0, 10), 0.0733880), (di.f_upper(3.0, 2, 20), 0.0725446), (di.chi2_upper(5.991465, 2), 0.05), (di.normal_quantile(0.975), 1.959964), (di.normal_cdf(-1.0), 0.1586553),
    (di.mackinnon_p(-2.86, "c"), 0.0502), (di.mackinnon_p(-3.41, "ct"), 0.0502),
])
def test_published_tails(got, want):
    assert got == pytest.approx(want, abs=5e-4)


def test_unit_root_tells_walk_from_noise():
    rng = np.random.default_rng(1)
    noise = rng.normal(size=400)
    assert ts.adf(noise)[1] < 0.01 < 0.2 < ts.adf(np.cumsum(noise))[1]
    assert ts.kpss(noise)[1] == pytest.approx(0.1) and ts.kpss(np.cumsum(noise))[1] <= 0.05
    x = np.cumsum(rng.normal(size=400))
    assert ts.engle_granger(2 * x + 1 + rng.normal(size=400), x)[4] < 0.01


def test_granger_finds_the_cause():
    rng = np.random.default_rng(2)
    x = rng.normal(size=500)
    y = np.concatenate(([0.0], 0.8 * x[:-1])) + 0.1 * rng.normal(size=500)
    assert ts.granger(y, x, 2)["f_p"] < 1e-6 < 0.001 < ts.granger(x, y, 2)["f_p"]


def test_normality_statistics():
    rng = np.random.default_rng(3)
    w, p = ts.shapiro(rng.normal(size=300))
    assert w > 0.99 and p > 0.05
    assert ts.shapiro(rng.exponential(size=300))[1] < 1e-6
    assert ts.ks_normal(rng.normal(size=1000))[1] > 0.01 > ts.ks_normal(rng.normal(1, 1, 1000))[1]


def test_implied_volatility_gives_the_price_back():
    v = np.linspace(0.05, 1.5, 40)
    price, _ = pr.bs_price(100.0, 110.0, 0.7, 0.03, 0.01, v, 1.0)
    assert np.allclose(pr.implied_vol(price, 100.0 + 0 * v, 110.0 + 0 * v, 0.7 + 0 * v, 0.03 + 0 * v, 0.01 + 0 * v, 1.0 + 0 * v), v, atol=1e-6)
    assert np.isnan(pr.implied_vol([200.0], [100.0], [100.0], [1.0], [0.0], [0.0], [1.0]))[0]


def test_american_options_bounds():
    european, _ = pr.bs_price(100.0, 110.0, 1.0, 0.05, 0.0, np.array([0.2]), -1.0)
    american = pr.american_price([100.0], [110.0], [1.0], [0.05], [0.0], [0.2], [-1.0], 400)
    assert american[0] > european[0] and american[0] == pytest.approx(11.97, abs=0.05)
    call = pr.american_price([100.0], [110.0], [1.0], [0.05], [0.0], [0.2], [1.0], 400)
    assert call[0] == pytest.approx(pr.bs_price(100.0, 110.0, 1.0, 0.05, 0.0, np.array([0.2]), 1.0)[0][0], abs=0.02)


def test_curves():
    nodes = pr.bootstrap([(1, 0.03), (2, 0.03), (3, 0.03)])
    assert [d for _, d in nodes] == pytest.approx([1.03**-t for t in (1, 2, 3)])
    assert pr.hazard_curve([(1.0, 0.012), (2.0, 0.012)])[1][1] == pytest.approx(0.02)
    assert pr.bond_yield([100.0], [0.05], [10.0])[0] == pytest.approx(0.05, abs=1e-9)


def test_greatest_sharpe_without_bounds_that_bind():
    mean, cov = np.array([0.1, 0.05]), np.diag([0.04, 0.01])
    w = pf.max_sharpe(mean, cov)
    want = np.linalg.solve(cov, mean)
    assert w == pytest.approx(want / want.sum(), abs=0.01) and w.sum() == pytest.approx(1)
    assert math.isclose(pf.max_sharpe(mean, cov, 0.4, 0.6).sum(), 1, abs_tol=1e-6)
