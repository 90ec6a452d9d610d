"""Tests on one series as a numpy array; grouped operators run them a series at a time."""

from __future__ import annotations

import math

import numpy as np

from .distributions import mackinnon_p, normal_cdf, normal_quantile


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(coefficients, standard errors, residual sum of squares) of least squares."""
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    rss = float(np.sum((y - x @ b) ** 2))
    se = np.sqrt(np.maximum(np.diag(np.linalg.pinv(x.T @ x)) * rss / max(1, len(y) - x.shape[1]), 0))
    return b, se, rss


def trend(n: int, regression: str) -> np.ndarray:
    t = np.arange(1, n + 1, dtype=float)
    return np.column_stack([t**k for k in range({"n": 0, "c": 1, "ct": 2, "ctt": 3}[regression])]) if regression != "n" else np.zeros((n, 0))


def adf(x: np.ndarray, regression: str = "c", max_lag: int | None = None, autolag: str | None = "AIC") -> tuple[float, float, int, int]:
    """Augmented Dickey-Fuller: (statistic, p, lags, observations). Lags by AIC or BIC over a common sample, or fixed."""
    n = len(x)
    if max_lag is None:
        max_lag = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - len(regression) - 1))
    d = np.diff(x)

    def design(k: int, start: int) -> tuple[np.ndarray, np.ndarray]:
        y = d[start:]
        cols = [x[start:-1], *(d[start - i : len(d) - i] for i in range(1, k + 1))]
        return np.column_stack([*cols, trend(len(y), regression)]), y

    lags = max_lag
    if autolag:

        def score(k: int) -> float:
            m, y = design(k, max_lag)
            *_, rss = fit(m, y)
            return len(y) * math.log(max(rss, 1e-300) / len(y)) + (2 if autolag == "AIC" else math.log(len(y))) * m.shape[1]

        lags = min(range(max_lag + 1), key=score)
    m, y = design(lags, lags)
    b, se, _ = fit(m, y)
    stat = float(b[0] / se[0]) if se[0] else -math.inf
    return stat, mackinnon_p(stat, regression), lags, len(y)


# Critical values of the KPSS statistic at 10, 5, 2.5 and 1 percent (Kwiatkowski et al., 1992).
KPSS = {"c": (0.347, 0.463, 0.574, 0.739), "ct": (0.119, 0.146, 0.176, 0.216)}


def kpss(x: np.ndarray, regression: str = "c") -> tuple[float, float, int]:
    """(statistic, p between 0.01 and 0.1, lags); lags by Hobijn, Franses and Ooms' automatic rule."""
    n = len(x)
    z = trend(n, regression)
    e = x - z @ np.linalg.lstsq(z, x, rcond=None)[0]
    cov = int(n ** (2 / 9))
    gammas = [float(e[i:] @ e[: n - i]) * 2 / n for i in range(1, cov + 1)]
    s0 = float(e @ e) / n + sum(gammas)
    s1 = sum(i * g for i, g in enumerate(gammas, 1))
    lags = min(n - 1, int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3))) if s0 else 0
    long_run = float(e @ e) / n + 2 / n * sum((1 - i / (lags + 1)) * float(e[i:] @ e[: n - i]) for i in range(1, lags + 1))
    stat = float(np.sum(np.cumsum(e) ** 2)) / n**2 / long_run if long_run else 0.0
    return stat, float(np.interp(stat, KPSS[regression], (0.1, 0.05, 0.025, 0.01))), lags


def engle_granger(y: np.ndarray, x: np.ndarray) -> tuple[float, float, float, float, float]:
    """(constant, gamma, alpha, statistic, p): long-run fit, error correction, unit-root test of the residuals with one lag."""
    m = np.column_stack([np.ones(len(x)), x])
    (c, g), *_ = np.linalg.lstsq(m, y, rcond=None)
    z = y - c - g * x
    step, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(y) - 1), np.diff(x), z[:-1]]), np.diff(y), rcond=None)
    stat, p, *_ = adf(z, "c", 1, None)
    return float(c), float(g), float(step[2]), stat, p


def granger(y: np.ndarray, x: np.ndarray, lag: int) -> dict[str, float]:
    """F, chi-square and likelihood-ratio statistics that x's past helps to tell y, at one lag length."""
    from .distributions import chi2_upper, f_upper

    past = lambda v: [v[lag - i : len(v) - i] for i in range(1, lag + 1)]
    target, one = y[lag:], np.ones(len(y) - lag)
    *_, r = fit(np.column_stack([*past(y), one]), target)
    m = np.column_stack([*past(y), *past(x), one])
    *_, u = fit(m, target)
    n, df = len(target), len(target) - m.shape[1]
    f, chi, lr = (r - u) / lag / (u / df), n * (r - u) / u, n * math.log(r / u)
    return {"f": f, "f_p": f_upper(f, lag, df), "chi2": chi, "chi2_p": chi2_upper(chi, lag), "lr": lr, "lr_p": chi2_upper(lr, lag)}


def shapiro(x: np.ndarray) -> tuple[float, float]:
    """Shapiro-Wilk W and p by Royston's (1995) approximation, for 12 values or more; fitted up to 5000, so that p is rough beyond."""
    x = np.sort(x)
    n = len(x)
    m = np.array([normal_quantile((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    u, ss = 1 / math.sqrt(n), float(m @ m)
    c = m / math.sqrt(ss)
    # Royston's polynomials of the two outer weights and of the transformed statistic.
    last = np.polyval([-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, c[-1]], u)
    inner = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, c[-2]], u)
    phi = (ss - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * inner**2)
    a = m / math.sqrt(phi)
    a[-1], a[-2], a[0], a[1] = last, inner, -last, -inner
    w = float((a @ x) ** 2 / np.sum((x - x.mean()) ** 2))
    ln = math.log(n)
    mu, sigma = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], ln), math.exp(np.polyval([0.0030302, -0.082676, -0.4803], ln))
    return w, 1 - normal_cdf((math.log(max(1 - w, 1e-300)) - mu) / sigma)


def ks_normal(x: np.ndarray) -> tuple[float, float]:
    """Kolmogorov-Smirnov distance to N(0, 1) and its asymptotic p."""
    x = np.sort(x)
    n = len(x)
    cdf = np.array([normal_cdf(v) for v in x])
    d = float(max((np.arange(1, n + 1) / n - cdf).max(), (cdf - np.arange(n) / n).max()))
    t = d * (math.sqrt(n) + 0.12 + 0.11 / math.sqrt(n))
    return d, max(0.0, min(1.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 101))))
