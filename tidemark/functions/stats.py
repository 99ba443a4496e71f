"""Distribution functions without a statistics package, as column expressions."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def student_p(t: Column, df: Column) -> Column:
    """Two-sided p-value for a whole number of degrees of freedom, by the finite series in the squared cosine.

    NULL where ``t`` is missing or there are no degrees of freedom.
    """
    whole = F.floor(df).cast("bigint")
    odd = whole % 2 == 1
    cosine = df / (df + t * t)
    sine = F.abs(t) / F.sqrt(df + t * t)
    terms = F.when(odd, F.floor((whole - 1) / 2)).otherwise(F.floor(whole / 2)).cast("bigint")
    steps = F.when(terms > 1, F.sequence(F.lit(2).cast("bigint"), F.greatest(terms, F.lit(2).cast("bigint")))).otherwise(F.array().cast("array<bigint>"))
    first = F.when(terms >= 1, F.lit(1.0)).otherwise(0.0)

    def add(state: Column, j: Column) -> Column:
        factor = F.when(odd, (2.0 * j - 2) / (2.0 * j - 1)).otherwise((2.0 * j - 3) / (2.0 * j - 2))
        term = state["term"] * factor * cosine
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    total = F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), add)["total"]
    inside = F.when(odd, 2 / math.pi * (F.atan2(sine, F.sqrt(cosine)) + sine * F.sqrt(cosine) * total)).otherwise(sine * total)
    known = t.isNotNull() & ~F.isnan(t) & (df >= 1)
    return F.when(known, F.when(F.abs(t) == float("inf"), 0.0).otherwise(F.greatest(1 - inside, F.lit(0.0))))


def normal_cdf(x: Column) -> Column:
    """Standard normal distribution function by its series of odd powers; beyond 8 deviations it is 0 or 1."""
    near = F.greatest(F.least(x, F.lit(8.0)), F.lit(-8.0))

    def add(state: Column, n: Column) -> Column:
        term = state["term"] * near * near / (2.0 * n + 1)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(150)), F.struct(near.alias("term"), near.alias("total")), add)["total"]
    inside = 0.5 + total * F.exp(-near * near / 2) / math.sqrt(2 * math.pi)
    return F.when(x < -8, 0.0).when(x > 8, 1.0).otherwise(F.greatest(F.least(inside, F.lit(1.0)), F.lit(0.0)))


# The published response surface of the unit-root test with a
# constant and one variable (p-value polynomials, their range, critical values).
TAU_MIN, TAU_STAR, TAU_MAX = -18.83, -1.61, 2.74
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}


def _polynomial(terms: tuple[float, ...], x: Column) -> Column:
    """c0 + c1 x + c2 x^2 + ..."""
    value = F.lit(0.0)
    for c in reversed(terms):
        value = value * x + c
    return value


def unit_root_p(tau: Column) -> Column:
    """Approximate p-value of an augmented Dickey-Fuller statistic."""
    inner = F.when(tau <= TAU_STAR, _polynomial(P_SMALL, tau)).otherwise(_polynomial(P_LARGE, tau))
    return F.when(tau > TAU_MAX, 1.0).when(tau < TAU_MIN, 0.0).when(tau.isNotNull(), normal_cdf(inner))


def unit_root_critical(n_obs: Column) -> dict[str, Column]:
    """Finite-sample critical values at 1, 5 and 10 percent."""
    return {k: _polynomial(cs, 1.0 / n_obs) for k, cs in CRITICAL.items()}


def levinson_partial(acf: np.ndarray, n: int, lags: int) -> np.ndarray:
    """Partial autocorrelations by Durbin-Levinson on sample-size adjusted moments.

    ``acf`` holds the biased autocorrelations; dividing the k-th moment by
    ``n - k`` instead of ``n`` is the adjustment.
    """
    lags = min(lags, len(acf) - 1)
    rho = acf[: lags + 1] * n / (n - np.arange(lags + 1))
    out = np.full(lags + 1, np.nan)
    out[0] = 1.0
    if lags == 0:
        return out
    phi = np.array([rho[1]])
    out[1] = rho[1]
    for k in range(2, lags + 1):
        spread = 1.0 - phi @ rho[1:k]
        last = (rho[k] - phi @ rho[k - 1 : 0 : -1]) / spread if spread != 0 else np.nan
        phi = np.append(phi - last * phi[::-1], last)
        out[k] = last
    return out
