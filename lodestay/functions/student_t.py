"""Student-t tail and quantile for model summaries (a handful of numbers per fitted model)."""

from __future__ import annotations

import math


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-16:
            break
    return value


def _regularised_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                 + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


def two_sided_p(t: float, dof: float) -> float:
    """P(|T| >= |t|)."""
    if math.isinf(t):
        return 0.0
    return _regularised_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def t_quantile(probability: float, dof: float) -> float:
    """The t with P(T <= t) = probability, by bisection."""
    if not 0.0 < probability < 1.0:
        raise ValueError("probability must be between 0 and 1")
    if probability == 0.5:
        return 0.0
    tail = 2.0 * min(probability, 1.0 - probability)
    low, high = 0.0, 1.0
    while two_sided_p(high, dof) > tail:
        high *= 2.0
    for _ in range(200):
        middle = (low + high) / 2.0
        if middle in (low, high):
            break
        low, high = (middle, high) if two_sided_p(middle, dof) > tail else (low, middle)
    return math.copysign((low + high) / 2.0, probability - 0.5)
