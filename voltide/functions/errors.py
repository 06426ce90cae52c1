"""Error columns and the few distribution functions a report needs."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def error(actual: str = "amount", predicted: str = "predicted_amount") -> Column:
    return F.col(actual) - F.col(predicted)


def error_columns(actual: str = "amount", predicted: str = "predicted_amount") -> dict:
    e = error(actual, predicted)
    return {
        "error": e,
        "abs_error": F.abs(e),
        "error_pct": F.try_divide(e, F.col(actual)) * 100,
    }


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


# Hart's rational approximation of the normal distribution function.
NORMAL_ABOVE = (3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383,
                112.079291497871, 221.213596169931, 220.206867912376)
NORMAL_BELOW = (8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461,
                296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
NORMAL_FAR = 7.07106781186547


def normal_cdf_sql(x: str) -> str:
    """The normal distribution function of an expression, in any SQL, good to 1e-14."""
    a = f"abs({x})"

    def poly(coefficients) -> str:
        out = repr(coefficients[0])
        for c in coefficients[1:]:
            out = f"({out} * {a} + {c!r})"
        return out

    far = f"({a} + 0.65)"
    for k in (4, 3, 2, 1):
        far = f"({a} + {k} / {far})"
    tail = (
        f"CASE WHEN {a} < {NORMAL_FAR} THEN exp(-{a} * {a} / 2) * {poly(NORMAL_ABOVE)} / {poly(NORMAL_BELOW)}"
        f" WHEN {a} < 37 THEN exp(-{a} * {a} / 2) / {far} / 2.506628274631 ELSE 0.0 END"
    )
    return f"(CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END)"


def _gamma_ratio_log(z: float) -> float:
    """log(gamma(z + 1/2) / gamma(z)), by its series 20 steps further up."""
    far = z + 20
    series = 0.5 * math.log(far) - 1 / (8 * far) + 1 / (192 * far**3) - 1 / (640 * far**5)
    return series + sum(math.log1p(-0.5 / (z + k + 0.5)) for k in range(20))


def t_quantile(p: float, dof: float) -> float:
    """Student t quantile, one formula for every number of degrees of freedom."""
    scale = math.exp(_gamma_ratio_log(dof / 2)) / math.sqrt(dof * math.pi)

    def density(x: float) -> float:
        return scale * math.exp(-(dof + 1) / 2 * math.log1p(x * x / dof))

    def mass(x: float, steps: int = 2_000) -> float:
        # Simpson's rule from 0 to x
        h = x / steps
        inner = sum((4 if i % 2 else 2) * density(i * h) for i in range(1, steps))
        return 0.5 + h / 3 * (density(0) + inner + density(x))

    if p < 0.5:
        return -t_quantile(1 - p, dof)
    lo, hi = 0.0, 1.0
    while mass(hi) < p:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mass(mid) < p else (lo, mid)
    return (lo + hi) / 2


def lilliefors_p(d: float, n: int) -> float:
    """Published Dallal-Wilkinson approximation of the Lilliefors p-value.

    The rescaling above 100 values belongs to it; it holds for p up to 0.1.
    """
    if n > 100:
        d, n = d * (n / 100) ** 0.49, 100
    # Coefficients of the published approximation.
    p = math.exp(
        -7.01256 * d * d * (n + 2.78019)
        + 2.99587 * d * math.sqrt(n + 2.78019)
        - 0.122119 + 0.974598 / math.sqrt(n) + 1.67997 / n
    )
    return min(1.0, p)
