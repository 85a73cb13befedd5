"""Tail probabilities and quantiles of the normal, t, F and chi-square laws (public series and continued fractions)."""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            out *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return out


def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def gamma_tail(a: float, x: float) -> float:
    """Upper regularised incomplete gamma."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1 - total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    out = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        out *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return out * scale


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / (df + t * t), df / 2, 0.5)


def f_tail(f: float, d1: float, d2: float) -> float:
    return 1.0 if f <= 0 else beta_cdf(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)


def chi2_tail(x: float, df: float) -> float:
    return gamma_tail(df / 2, x / 2)


def t_quantile(p: float, df: float) -> float:
    """t with P(T <= t) = p, by bisection."""
    if p < 0.5:
        return -t_quantile(1 - p, df)
    low, high = 0.0, 1.0
    while 1 - t_two_sided(high, df) / 2 < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        if 1 - t_two_sided(mid, df) / 2 < p:
            low = mid
        else:
            high = mid
    return (low + high) / 2
