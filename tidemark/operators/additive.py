"""Additive regression: piecewise-linear trend, yearly waves, holiday effects.

Bends of the trend carry a double-exponential prior, so most stay near zero;
it is handled by reweighted ridge regression.  The design is column
expressions; its products are summed once per series (``gram``), and every
prior scale is a change of the diagonal of that one matrix.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import gram
from tidemark.operators.calendar import holiday_windows
from tidemark.runtime import cut_lineage

# The usual settings of this model family.
CHANGEPOINTS, CHANGEPOINT_RANGE, YEARLY_ORDER = 25, 0.8, 10
EFFECT_SCALE, TREND_SCALE, YEAR_DAYS = 10.0, 5.0, 365.25
#: Rounds of reweighting, and what keeps a bend of size zero from an infinite penalty.
ROUNDS, FLOOR = 12, 1e-6


def with_effects(rows: DataFrame, holidays: DataFrame | None, on: Sequence[str] = ("ds",)) -> DataFrame:
    """Attach the holiday effects that reach each date as an array column.

    ``on`` may add a column naming the calendar, to compare several at once.
    The joined side has at most one row per calendar and day.
    """
    if holidays is None:
        return rows.withColumn("effects", F.array().cast("array<string>"))
    hits = holiday_windows(holidays).groupBy(*on).agg(F.collect_set("effect").alias("effects"))
    return rows.join(hits, list(on), "left").withColumn(
        "effects", F.coalesce("effects", F.array().cast("array<string>"))
    )


def extend_rows(history: DataFrame, keys: Sequence[str], horizon: int) -> DataFrame:
    """Append ``horizon`` future dates without a value to every series."""
    from tidemark.operators.baselines import future_dates

    future = future_dates(history, keys, horizon).select(
        *keys, "ds", F.lit(None).cast("double").alias("y"), F.lit(True).alias("is_test")
    )
    return history.select(*keys, "ds", "y", F.lit(False).alias("is_test")).unionByName(future)


def _designed(rows: DataFrame, keys: list[str], yearly_order: int) -> DataFrame:
    """Rows with their regressors ``x``: constant, time, bends, waves, one column per holiday effect.

    Time runs from 0 to 1 over the training rows.  Bends sit at evenly spread
    training rows of the first part of the history.  Effects that no training
    row has get no column.
    """
    day = F.unix_date("ds").cast("double")
    train = ~F.col("is_test") & F.col("y").isNotNull() & ~F.isnan("y")
    own = W.partitionBy(*keys)
    known = rows.select(*keys, "ds", F.col("y").cast("double").alias("y"), "is_test", "effects").withColumns({"_day": day, "_train": F.coalesce(train, F.lit(False))})
    known = known.withColumns({
        "_n": F.count_if("_train").over(own),
        "_at": F.row_number().over(W.partitionBy(*keys, "_train").orderBy("ds")) - 1,
    })
    last = F.floor(F.col("_n") * CHANGEPOINT_RANGE).cast("bigint") - 1
    bends = F.least(F.lit(CHANGEPOINTS).cast("bigint"), F.greatest(last, F.lit(0).cast("bigint")))
    known = known.withColumns({"_last": last, "_bends": bends})
    some = F.greatest(F.col("_bends"), F.lit(1).cast("bigint"))
    spot = F.exists(F.sequence(F.lit(1).cast("bigint"), some), lambda i: F.floor((2 * i * F.col("_last") + some) / (2 * some)) == F.col("_at"))
    of = lambda c: F.when(F.col("_train"), c)
    groups = known.groupBy(*keys).agg(
        F.max("_n").alias("_size"), F.min(of(F.col("_day"))).alias("_first"), F.max(of(F.col("_day"))).alias("_end"),
        F.max(of(F.abs("y"))).alias("_most"),
        F.array_sort(F.collect_list(F.when(F.col("_train") & (F.col("_bends") > 0) & spot, F.col("_day")))).alias("knots"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(of(F.col("effects")))))).alias("names"),
    )
    span = F.when(F.col("_end") > F.col("_first"), F.col("_end") - F.col("_first")).otherwise(1.0)
    scale = F.when(F.col("_most") > 0, F.col("_most")).otherwise(1.0)
    groups = groups.withColumns({"_span": span, "scale": scale})
    joined = known.select(*keys, "ds", "y", "is_test", "effects", "_day", "_train").join(groups, keys)
    time = lambda d: (d - F.col("_first")) / F.col("_span")
    waves = [f(F.lit(2 * math.pi * k / YEAR_DAYS) * F.col("_day")) for f in (F.sin, F.cos) for k in range(1, yearly_order + 1)]
    x = F.concat(
        F.array(F.lit(1.0), F.col("t")),
        F.transform("knots", lambda k: F.greatest(F.col("t") - time(k), F.lit(0.0))),
        F.array(*waves) if waves else F.array().cast("array<double>"),
        F.transform("names", lambda n: F.array_contains("effects", n).cast("double")),
    )
    return joined.withColumn("t", time(F.col("_day"))).withColumn("x", x)


def _solutions(prior_scales: Sequence[float], yearly_order: int):
    """The solve of one matrix for all prior scales: reweighted ridge with a re-estimated noise."""

    def run(rows: int, matrix: np.ndarray, bends: int) -> list[dict]:
        products, moment, square = matrix[:-1, :-1], matrix[:-1, -1], matrix[-1, -1]
        bent = slice(2, 2 + bends)
        out = []
        for scale in prior_scales:
            penalty = np.full(len(moment), 1.0 / EFFECT_SCALE**2)
            penalty[:2] = 1.0 / TREND_SCALE**2
            shrink = np.full(bends, scale)
            noise = max(square / rows - (moment[0] / rows) ** 2, 0.0) or 1e-6
            for _ in range(ROUNDS):
                penalty[bent] = 1.0 / (scale * (shrink + FLOOR))
                beta = np.linalg.solve(products + noise * np.diag(penalty), moment)
                noise_used, noise = noise, max((square - 2 * beta @ moment + beta @ products @ beta) / rows, 1e-10)
                shrink = np.abs(beta[bent])
            rest = moment - (products + noise_used * np.diag(penalty)) @ beta
            out.append({
                "prior_scale": float(scale), "beta": beta.tolist(), "noise": float(noise), "typical": float(shrink.mean()) if bends else 0.0,
                "unsolved": float(np.abs(rest).max() / rows),
            })
        return out

    return run


def fit_series(rows: DataFrame, keys: Sequence[str], prior_scales: Sequence[float], yearly_order: int = YEARLY_ORDER) -> tuple[DataFrame, DataFrame]:
    """Designed rows, and per series and prior scale: coefficients, noise, mean size of a bend, what the equations leave.

    Series with fewer than three training rows get no coefficients.
    """
    keys = list(keys)
    designed = cut_lineage(_designed(rows, keys, yearly_order))
    vector = F.when(F.col("_train") & (F.col("_size") >= 3), F.concat("x", F.array(F.col("y") / F.col("scale"))))
    seen = designed.withColumn("bends", F.size("knots")).withColumn("v", vector)
    sums = gram.products(seen, [*keys, "bends"])
    fields = "prior_scale double, beta array<double>, noise double, typical double, unsolved double"
    return designed, cut_lineage(gram.solve(sums, keys, _solutions(prior_scales, yearly_order), fields, ["bends"]))


def additive_forecast(
    rows: DataFrame,
    keys: Sequence[str] = (),
    prior_scale: float | Sequence[float] = 0.05,
    yearly_order: int = YEARLY_ORDER,
    width: float = 0.95,
) -> DataFrame:
    """Fit every series and return all rows with forecast, interval and components.

    ``rows`` holds ``ds, y, is_test, effects``; rows flagged as test, or without
    a value, are predicted but not fitted.  Several prior scales give the rows
    once for each, with a column ``prior_scale``; the sums are made once.
    """
    many = not isinstance(prior_scale, (int, float))
    scales = list(prior_scale) if many else [float(prior_scale)]
    source, group = (rows, list(keys)) if keys else (rows.withColumn("_all", F.lit(0)), ["_all"])
    designed, fits = fit_series(source, group, scales, yearly_order)
    candidates = designed.withColumn("prior_scale", F.explode(F.array(*[F.lit(float(s)) for s in scales])))
    both = candidates.join(fits, [*group, "prior_scale"], "left")
    bends = F.size("knots")
    part = lambda start, size: gram.dot(F.slice("x", start, size), F.slice("beta", start, size)) * F.col("scale")
    rest = F.lit(3) + bends + 2 * yearly_order
    parts = both.withColumns({
        "trend": part(F.lit(1), F.lit(2) + bends), "yearly": part(F.lit(3) + bends, F.lit(2 * yearly_order)), "holidays": part(rest, F.size("names")),
    })
    # beyond the history, bends keep arriving at the past rate with the past size
    ahead = F.greatest(F.col("t") - 1, F.lit(0.0))
    drift = bends * 2 * F.pow("typical", F.lit(2)) * F.pow(ahead, F.lit(3)) / 3
    wide = F.lit(NormalDist().inv_cdf(0.5 + width / 2)) * F.col("scale")
    parts = parts.withColumns({"yhat": F.col("trend") + F.col("yearly") + F.col("holidays"), "_half": wide * F.sqrt(F.col("noise") + drift), "_trend_half": wide * F.sqrt(drift)})
    return parts.select(
        *keys, *(["prior_scale"] if many else []), "ds", "is_test", "y", "yhat",
        (F.col("yhat") - F.col("_half")).alias("yhat_lo"), (F.col("yhat") + F.col("_half")).alias("yhat_hi"),
        "trend", (F.col("trend") - F.col("_trend_half")).alias("trend_lo"), (F.col("trend") + F.col("_trend_half")).alias("trend_hi"),
        "yearly", "holidays", F.when(F.col("beta").isNull(), "short_history").otherwise("ok").alias("status"),
    )


def additive_changepoints(rows: DataFrame, keys: Sequence[str] = (), prior_scale: float | Sequence[float] = 0.05) -> DataFrame:
    """Where the trend may bend, and by how much it did (slope change, scaled units)."""
    many = not isinstance(prior_scale, (int, float))
    scales = list(prior_scale) if many else [float(prior_scale)]
    source, group = (rows, list(keys)) if keys else (rows.withColumn("_all", F.lit(0)), ["_all"])
    designed, fits = fit_series(source, group, scales)
    knots = designed.groupBy(*group).agg(F.first("knots").alias("knots"))
    pairs = F.arrays_zip("knots", F.slice("beta", F.lit(3), F.size("knots")).alias("delta"))
    bends = fits.join(knots, group).select(*group, "prior_scale", F.explode(pairs).alias("bend"))
    ds = F.date_from_unix_date(F.col("bend.knots").cast("int")).alias("ds")
    return bends.select(*keys, *(["prior_scale"] if many else []), ds, F.col("bend.delta").alias("delta"))


def components_long(fitted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The additive parts as rows: keys, ds, component, value."""
    parts = F.array(
        *[F.struct(F.lit(c).alias("component"), F.col(c).alias("value")) for c in ("trend", "yearly", "holidays")]
    )
    return fitted.select(*keys, "ds", F.inline(parts))


def largest_effects(fitted: DataFrame, n: int = 5) -> DataFrame:
    """The dates on which holidays moved the forecast most."""
    return fitted.select("ds", "holidays").orderBy(F.abs("holidays").desc(), "ds").limit(n)


def forecast_for_dates(fitted: DataFrame, dates: DataFrame) -> DataFrame:
    """The forecast with both bounds, for wanted dates only."""
    keep = [c for c in fitted.columns if c not in ("is_test", "y", "trend", "trend_lo", "trend_hi", "yearly", "holidays", "status")]
    return fitted.join(dates.select("ds").distinct(), ["ds"], "left_semi").select(*keep)
