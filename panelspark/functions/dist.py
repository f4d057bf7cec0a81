"""Distribution functions for p-values and intervals."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

_STD = NormalDist()


def normal_ppf(p: float) -> float:
    return _STD.inv_cdf(p)


def normal_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2))


def normal_cdf(z: np.ndarray) -> np.ndarray:
    """Normal distribution function of an array."""
    tails = map(math.erfc, (np.asarray(z, float) / -math.sqrt(2)).tolist())
    return 0.5 * np.fromiter(tails, dtype=float, count=len(z))


def log_normal_sf(x: float) -> float:
    """log P(Z > x), also far in the tail where the probability underflows."""
    if x < 30:
        return math.log(normal_sf(x))
    inv = 1 / (x * x)
    series = 1 - inv * (1 - 3 * inv * (1 - 5 * inv * (1 - 7 * inv)))
    return -0.5 * x * x - math.log(x) - 0.5 * math.log(2 * math.pi) + math.log(series)


def log_normal_between(a: float, b: float) -> float:
    """log P(a < Z < b) for a < b, computed on the side of the smaller tail."""
    if a >= b:
        return -math.inf
    if a < 0 < b:
        inside = 1 - normal_sf(-a) - normal_sf(b)
        if inside > 0:
            return math.log(inside)
    if b <= 0:
        a, b = -b, -a
    top = log_normal_sf(a)
    if b == math.inf:
        return top
    gap = log_normal_sf(b) - top
    return top + (math.log(-math.expm1(gap)) if gap < 0 else -math.inf)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    value = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + step * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + step / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return value


def beta_cdf(x: float, a: float, b: float) -> float:
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_sf(t: float, df: float) -> float:
    """P(T > t) of Student's t."""
    tail = 0.5 * beta_cdf(df / (df + t * t), df / 2, 0.5)
    return tail if t >= 0 else 1 - tail


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student's t, by bisection on the upper tail."""
    if p == 0.5:
        return 0.0
    if p < 0.5:
        return -t_ppf(1 - p, df)
    tail, lo, hi = 1 - p, 0.0, 1.0
    while t_sf(hi, df) > tail:
        lo, hi = hi, hi * 2
    for _ in range(200):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (mid, hi) if t_sf(mid, df) > tail else (lo, mid)
    return (lo + hi) / 2


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    if f <= 0:
        return 1.0
    return beta_cdf(d2 / (d2 + d1 * f), d2 / 2, d1 / 2)


def chi2_sf(x: float, df: float) -> float:
    """P(X > x) of chi-square: series below the mean, continued fraction above."""
    if x <= 0:
        return 1.0
    a, z = df / 2, x / 2
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > 1e-17 * total:
            k += 1
            term *= z / k
            total += term
        return 1 - front * total
    b, c = z + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h


def log_choose(n: int, k: int) -> float:
    if k < 0 or k > n:
        return -math.inf
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
