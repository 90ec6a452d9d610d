"""Tail probabilities from published series and continued fractions, for plain numbers."""

from __future__ import annotations

import math


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def normal_quantile(p: float) -> float:
    """Inverse normal by Newton steps on the tail function, from a rough start."""
    if not 0 < p < 1:
        return math.copysign(math.inf, p - 0.5)
    t = math.sqrt(-2 * math.log(min(p, 1 - p)))
    x = math.copysign(t - (2.30753 + 0.27061 * t) / (1 + 0.99229 * t + 0.04481 * t * t), p - 0.5)
    for _ in range(6):
        x -= (normal_cdf(x) - p) / max(math.exp(-x * x / 2) / math.sqrt(2 * math.pi), 1e-300)
    return x


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_inc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), 1e-300)
    total = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + num * d) or 1e-300)
            c = (1 + num / c) or 1e-300
            total *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * total


def gamma_inc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1 - front * total
    b, c = x + 1 - a, 1e300
    d = h = 1 / b
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or 1e-300)
        c = (b + an / c) or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2, 0.5, df / (df + t * t)) if math.isfinite(t) else 0.0


def f_upper(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if math.isfinite(f) else 0.0


def chi2_upper(x: float, df: float) -> float:
    return gamma_inc_upper(df / 2, x / 2)


# MacKinnon's (1994) response surfaces of the unit-root statistic for one series, by
# regression: where the surface changes, its lower and upper end, and the polynomials of either part.
MACKINNON = {
    "n": (-1.04, -19.04, math.inf, (0.6344, 1.2378, 0.032496), (0.4797, 0.93557, -0.06999, 0.033066)),
    "c": (-1.61, -18.83, 2.74, (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)),
    "ct": (-2.89, -16.18, 0.70, (3.2512, 1.6047, 0.049588), (2.5261, 0.61654, -0.37956, -0.060285)),
    "ctt": (-3.21, -17.17, 0.54, (4.0003, 1.658, 0.048288), (3.0778, 0.49529, -0.41477, -0.059359)),
}


def mackinnon_p(stat: float, regression: str = "c") -> float:
    star, low, high, small, large = MACKINNON[regression]
    if stat > high:
        return 1.0
    if stat < low:
        return 0.0
    return normal_cdf(sum(k * stat**i for i, k in enumerate(small if stat <= star else large)))
