"""Is this series forecastable?  Trend, seasonality, autocorrelation, stationarity.

All operators take ``(keys..., ds, y)`` with one row per key and date, so every
window group is as long as the calendar and no longer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.functions.stats import (
    levinson_partial, student_p, unit_root_critical, unit_root_p,
)
from tidemark.operators import gram
from tidemark.runtime import cut_lineage

SEASON = 52


def positions(df: DataFrame, keys: Sequence[str] = (), ds: str = "ds") -> DataFrame:
    """Number the rows of every series from 0 in date order."""
    return df.withColumn("t", F.row_number().over(W.partitionBy(*keys).orderBy(ds)) - 1)


def describe(df: DataFrame, keys: Sequence[str] = (), y: str = "y") -> DataFrame:
    """Count, mean, minimum, maximum and sample standard deviation per series."""
    return df.groupBy(*keys).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.min(y).alias("min"),
        F.max(y).alias("max"), F.stddev_samp(y).alias("std"),
    )


def growth(df: DataFrame, keys: Sequence[str] = (), y: str = "y", ds: str = "ds") -> DataFrame:
    """First and last value of every series and the change between them in percent."""
    first, last = F.min_by(y, ds), F.max_by(y, ds)
    return df.groupBy(*keys).agg(
        first.alias("first"), last.alias("last"), ((ratio(last, first) - 1) * 100).alias("growth_pct")
    )


def trend_test(
    df: DataFrame, keys: Sequence[str] = (), y: str = "y", period: int = SEASON, ds: str = "ds"
) -> DataFrame:
    """Straight line through every series: slope, percent a year, p-value, r squared."""
    line = positions(df, keys, ds).groupBy(*keys).agg(
        F.regr_slope(F.col(y), F.col("t").cast("double")).alias("slope"),
        F.regr_r2(F.col(y), F.col("t").cast("double")).alias("r_squared"),
        F.avg(y).alias("_mean"),
        F.count(y).alias("_n"),
    )
    freedom = F.col("_n") - 2
    t = F.sqrt(F.col("r_squared")) * F.sqrt(ratio(freedom, 1 - F.col("r_squared")))
    p = F.when(F.col("r_squared") >= 1, 0.0).otherwise(
        student_p(F.coalesce(t, F.lit(float("nan"))), freedom.cast("double"))
    )
    return line.withColumn("p_value", p).select(
        *keys,
        "slope",
        (ratio(F.col("slope") * period, F.col("_mean")) * 100).alias("pct_per_year"),
        "p_value",
        "r_squared",
        (F.col("p_value") < 0.05).alias("significant"),
    )


def moving_trend(
    df: DataFrame, keys: Sequence[str] = (), period: int = SEASON, y: str = "y", ds: str = "ds"
) -> DataFrame:
    """Centred moving average over one season; NULL where the window is not full.

    An even season has no middle row, so the two outermost weeks count half.
    """
    half = period // 2
    ordered = W.partitionBy(*keys).orderBy(ds)
    span = ordered.rowsBetween(-half, half)
    total = F.sum(y).over(span)
    if period % 2 == 0:
        total = total - (F.lag(y, half).over(ordered) + F.lead(y, half).over(ordered)) * 0.5
    full = F.count(y).over(span) == 2 * half + 1
    return df.withColumn("trend", F.when(full, total / period))


def decompose(
    df: DataFrame,
    keys: Sequence[str] = (),
    period: int = SEASON,
    model: str = "additive",
    y: str = "y",
    ds: str = "ds",
) -> DataFrame:
    """Observed, trend, seasonal and residual per row.

    Seasonal is the mean of the detrended rows at the same position of the
    cycle, centred over one cycle.  Series shorter than two cycles get NULL
    components.  All windows share the partitioning by series: one shuffle.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError("model is 'additive' or 'multiplicative'")
    additive = model == "additive"
    ordered = W.partitionBy(*keys).orderBy(ds)
    series = W.partitionBy(*keys)
    rows = moving_trend(df, keys, period, y, ds).withColumns(
        {"_t": F.row_number().over(ordered) - 1, "_n": F.count(F.lit(1)).over(series)}
    )
    long_enough = F.col("_n") >= 2 * period
    rows = rows.withColumn("trend", F.when(long_enough, F.col("trend"))).withColumn(
        "_phase", F.col("_t") % period
    )
    detrended = F.col(y) - F.col("trend") if additive else ratio(F.col(y), F.col("trend"))
    rows = rows.withColumn("_detrended", detrended)
    rows = rows.withColumn("_figure", F.avg("_detrended").over(W.partitionBy(*keys, "_phase")))
    centre = F.avg(F.when(F.col("_t") < period, F.col("_figure"))).over(series)
    seasonal = F.col("_figure") - centre if additive else ratio(F.col("_figure"), centre)
    rows = rows.withColumn("seasonal", seasonal)
    residual = (
        F.col("_detrended") - F.col("seasonal")
        if additive
        else ratio(F.col("_detrended"), F.col("seasonal"))
    )
    return rows.select(
        *keys, ds, F.col(y).alias("observed"), "trend", "seasonal", residual.alias("residual")
    )


def strength(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of variance each component explains, 0 to 1, from a decomposition."""
    known = parts.filter(F.col("residual").isNotNull())

    def share(component: str):
        explained = 1 - ratio(
            F.var_samp("residual"), F.var_samp(F.col(component) + F.col("residual"))
        )
        return F.greatest(F.lit(0.0), explained)

    return known.groupBy(*keys).agg(
        share("seasonal").alias("seasonal_strength"), share("trend").alias("trend_strength")
    )


def component_swing(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Peak-to-trough of season and trend, their ratio, and the residual spread."""
    season = F.max("seasonal") - F.min("seasonal")
    trend = F.max("trend") - F.min("trend")
    return parts.groupBy(*keys).agg(
        season.alias("seasonal_swing"), trend.alias("trend_swing"),
        ratio(season, trend).alias("swing_ratio"), F.stddev_samp("residual").alias("residual_std"),
    )


def autocorrelation(
    df: DataFrame, keys: Sequence[str] = (), nlags: int = 60, y: str = "y", ds: str = "ds"
) -> DataFrame:
    """ACF and PACF per lag, with the 95% significance band.

    All lagged products come from one ordered window per series and are summed
    in one aggregation; nothing is exploded or joined.  Lags a series is too
    short for are NULL; PACF stops below half the sample.
    """
    keys = list(keys)
    ordered = W.partitionBy(*keys).orderBy(ds)
    centred = df.select(*keys, ds, (F.col(y) - F.avg(y).over(W.partitionBy(*keys))).alias("_d"))
    products = centred.select(
        *keys,
        *[(F.col("_d") * F.lag("_d", k).over(ordered)).alias(f"_p{k}") for k in range(nlags + 1)],
    )
    sums = products.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"_p{k}").alias(f"_p{k}") for k in range(nlags + 1)]
    )

    @F.pandas_udf("array<double>")
    def partial(acf: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for values, size in zip(acf, n):
            known = np.array([v for v in values if v is not None and not math.isnan(v)], dtype=float)
            lags = min(nlags, int(size) // 2 - 1, len(known) - 1)
            row = [None] * (nlags + 1)
            if lags >= 0:
                row[: lags + 1] = [float(v) for v in levinson_partial(known, int(size), lags)]
            out.append(row)
        return pd.Series(out)

    arrays = sums.select(
        *keys, "n",
        F.array(*[ratio(F.col(f"_p{k}"), F.col("_p0")) for k in range(nlags + 1)]).alias("_acf"),
    ).withColumn("_pacf", partial("_acf", "n"))
    zipped = F.arrays_zip("_acf", "_pacf")
    return arrays.select(*keys, "n", F.posexplode(zipped).alias("lag", "_pair")).select(
        *keys,
        "lag",
        F.col("_pair._acf").alias("acf"),
        F.col("_pair._pacf").alias("pacf"),
        (F.lit(1.96) / F.sqrt("n")).alias("band"),
    )


#: How many lags a unit-root test may look at: LAG_RATE * (n / 100) ** 0.25, and at most half the rows.
LAG_RATE = 12


def _lagged(df: DataFrame, keys: list[str], y: str, ds: str) -> DataFrame:
    """Standardised previous level and difference per row, with all earlier differences the series may need.

    ``limit`` is the series' own largest lag; the window is as wide as the
    longest series asks for, one number for the whole table.
    """
    known = df.filter(F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double"))).select(*keys, ds, F.col(y).cast("double").alias("_y"))
    longest = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    widest = max(1, math.ceil(LAG_RATE * (longest / 100) ** 0.25))
    own, ordered = W.partitionBy(*keys), W.partitionBy(*keys).orderBy(ds)
    n = F.col("_n")
    limit = F.least(F.floor(n / 2) - 2, F.ceil(LAG_RATE * F.pow(n / 100, F.lit(0.25)))).cast("int")
    rows = known.withColumns({
        "_n": F.count(F.lit(1)).over(own), "_mean": F.avg("_y").over(own), "_std": F.stddev_pop("_y").over(own),
        "_t": F.row_number().over(ordered) - 1, "_flat": F.min("_y").over(own) == F.max("_y").over(own),
    })
    rows = rows.withColumns({"_z": ratio(F.col("_y") - F.col("_mean"), F.col("_std")), "limit": limit})
    rows = rows.withColumns({"_level": F.lag("_z").over(ordered), "_step": F.col("_z") - F.lag("_z").over(ordered)})
    return rows.withColumn("_past", F.reverse(F.collect_list("_step").over(ordered.rowsBetween(-widest, -1))))


def _lag_vector(lags: Column) -> Column:
    """Level, constant, ``lags`` earlier differences and the current one; NULL where there are fewer."""
    there = (F.col("_t") - 1 >= lags) & (lags >= 0) & ~F.col("_flat")
    return F.when(there, F.concat(F.array("_level", F.lit(1.0)), F.slice("_past", F.lit(1), F.greatest(lags, F.lit(0))), F.array("_step")))


def _orders(rows: int, matrix: np.ndarray) -> list[dict]:
    sse = gram.nested_sse(matrix)[1:]
    return [
        {"lags": lags, "aic": rows * math.log(max(value, 1e-300) / rows) + 2 * (lags + 2), "sse": float(value)} for lags, value in enumerate(sse)
    ]


def _unit_root(rows: int, matrix: np.ndarray) -> list[dict]:
    found, freedom = gram.least_squares(rows, matrix), rows - len(matrix) + 1
    if found is None or found["sse"] <= 0:
        return []
    spread = math.sqrt(found["inverse"][0, 0] * found["sse"] / freedom)
    return [{"statistic": float(found["beta"][0] / spread), "n_obs": rows}]


def unit_root_orders(df: DataFrame, keys: Sequence[str] = (), y: str = "y", ds: str = "ds") -> DataFrame:
    """Information criterion of every lag order of every series, on the sample of the largest one.

    The lagged design is summed once per series at its largest lag; the smaller
    orders are leading blocks of that one matrix.
    """
    source, group = (df, list(keys)) if keys else (df.withColumn("_all", F.lit(0)), ["_all"])
    orders = _all_orders(_lagged(source, group, y, ds), group)
    return orders if keys else orders.drop("_all")


def _all_orders(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = gram.products(rows.withColumn("v", _lag_vector(F.col("limit"))), keys)
    return gram.solve(sums, keys, _orders, "lags int, aic double, sse double")


def adf_report(df: DataFrame, keys: Sequence[str] = (), y: str = "y", ds: str = "ds") -> DataFrame:
    """Augmented Dickey-Fuller test with a constant per series; the lag order by information criterion.

    Of equally good orders the smallest counts.  The chosen order is fitted on
    all rows it has lags for.  A constant series, or one too short for a test,
    says so in ``status``.
    """
    source, group = (df, list(keys)) if keys else (df.withColumn("_all", F.lit(0)), ["_all"])
    rows = cut_lineage(_lagged(source, group, y, ds))
    best = cut_lineage(_all_orders(rows, group).groupBy(*group).agg(F.min_by("lags", F.struct("aic", "lags")).alias("lags_used")))
    series = rows.groupBy(*group).agg(F.first("limit").alias("_limit"), F.first("_flat").alias("_flat")).join(best, group, "left")
    chosen = rows.join(best, group).withColumn("v", _lag_vector(F.col("lags_used")))
    tests = gram.solve(gram.products(chosen, group), group, _unit_root, "statistic double, n_obs bigint")
    table = series.join(tests, group, "left")
    tested = F.col("statistic").isNotNull()
    status = F.when(tested, "ok").when(F.col("_flat") & (F.col("_limit") >= 0), "constant").otherwise("short_history")
    levels = unit_root_critical(F.col("n_obs").cast("double"))
    report = table.withColumn("p_value", unit_root_p(F.col("statistic"))).select(
        *group, "statistic", "p_value", F.when(tested, F.col("lags_used")).alias("lags_used"), "n_obs",
        *[value.alias(name) for name, value in levels.items()], (F.col("p_value") < 0.05).alias("stationary"), status.alias("status"),
    )
    return report if keys else report.drop("_all")


def grid_check(df: DataFrame, keys: Sequence[str] = (), ds: str = "ds") -> DataFrame:
    """Length, span, whether all gaps are equal, and the most common gap in days.

    Of several equally common gaps the smallest counts.
    """
    ordered = W.partitionBy(*keys).orderBy(ds)
    gaps = df.select(*keys, ds, F.datediff(F.col(ds), F.lag(ds).over(ordered)).alias("_gap"))
    counted = gaps.groupBy(*keys, "_gap").agg(
        F.count(F.lit(1)).alias("_n"), F.min(ds).alias("_from"), F.max(ds).alias("_to")
    )
    weight = F.when(F.col("_gap").isNotNull(), F.struct(F.col("_n"), -F.col("_gap")))
    return counted.groupBy(*keys).agg(
        F.sum("_n").alias("n"),
        F.min("_from").alias("start"),
        F.max("_to").alias("end"),
        (F.count("_gap") == 1).alias("regular_grid"),
        F.coalesce(F.max_by("_gap", weight), F.lit(0)).alias("step_days"),
    )


def suitability_report(
    df: DataFrame, keys: Sequence[str] = (), period: int = SEASON, with_adf: bool = True
) -> DataFrame:
    """Everything worth knowing before choosing a model, one row per series.

    Five reports read the series, so its table is written once; the parts are
    joined on the series keys, one row a side.
    """
    keys = list(keys)
    base = df.select(*keys, "ds", "y")
    if not keys:
        base = base.withColumn("_all", F.lit(0))
    on = keys or ["_all"]
    base = cut_lineage(base)
    lags = autocorrelation(base, on, nlags=period + 8)
    seasonal_lag = lags.groupBy(*on).agg(
        F.max(F.when(F.col("lag") == period, F.col("acf"))).alias("acf_at_period"),
        F.max_by(
            "lag", F.when((F.col("lag") > 2) & F.col("acf").isNotNull(), F.struct("acf", -F.col("lag")))
        ).alias("strongest_lag"),
    )
    trend = trend_test(base, on, period=period).select(
        *on,
        F.col("pct_per_year").alias("trend_pct_per_year"),
        F.col("p_value").alias("trend_p_value"),
        F.col("r_squared").alias("trend_r_squared"),
        F.col("significant").alias("trend_significant"),
    )
    report = (
        grid_check(base, on)
        .withColumn("cycles", F.col("n") / period)
        .join(trend, on, "left")
        .join(strength(decompose(base, on, period), on), on, "left")
        .join(seasonal_lag, on, "left")
    )
    if with_adf:
        adf = adf_report(base, on).select(
            *on, F.col("p_value").alias("adf_p_value"), "stationary"
        )
        report = report.join(adf, on, "left")
    return report if keys else report.drop("_all")


def earliest_testable(df: DataFrame, keys: Sequence[str] = (), period: int = SEASON) -> DataFrame:
    """First date a seasonal model can be tested on: after two full cycles."""
    return positions(df, keys).groupBy(*keys).agg(
        F.max(F.when(F.col("t") == 2 * period, F.col("ds"))).alias("earliest_testable")
    )


def christmas_weeks(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows in ISO weeks 51 and 52."""
    return df.filter(F.weekofyear("ds").isin(51, 52))


def christmas_window(
    df: DataFrame, keys: Sequence[str] = (), period: int = SEASON, lead: int = 6, length: int = 13
) -> DataFrame:
    """Flag the latest testable window around Christmas of every series.

    It starts ``lead`` rows before a Christmas week that leaves more than one
    season of history, and lasts ``length`` rows.  Rows after it are dropped;
    series without such a week vanish.
    """
    rows = positions(df, keys)
    start = F.col("t") - lead
    candidate = F.when(F.weekofyear("ds").isin(51, 52) & (start > period), start)
    rows = rows.withColumn("_start", F.max(candidate).over(W.partitionBy(*keys)))
    return (
        rows.filter(F.col("_start").isNotNull() & (F.col("t") < F.col("_start") + length))
        .withColumn("is_test", F.col("t") >= F.col("_start"))
        .drop("_start", "t")
    )


def interpolate_gaps(
    df: DataFrame, keys: Sequence[str] = (), y: str = "y", ds: str = "ds", start: str | None = None
) -> DataFrame:
    """Fill missing values linearly by row position, drop leading ones, slice.

    Values after the last known one repeat it.
    """
    rows = positions(df, keys, ds)
    ordered = W.partitionBy(*keys).orderBy("t")
    past, ahead = ordered.rowsBetween(W.unboundedPreceding, 0), ordered.rowsBetween(0, W.unboundedFollowing)
    at = F.when(F.col(y).isNotNull(), F.col("t"))
    rows = rows.withColumns(
        {
            "_y0": F.last(y, ignorenulls=True).over(past),
            "_t0": F.last(at, ignorenulls=True).over(past),
            "_y1": F.first(y, ignorenulls=True).over(ahead),
            "_t1": F.first(at, ignorenulls=True).over(ahead),
        }
    )
    share = ratio(F.col("t") - F.col("_t0"), F.col("_t1") - F.col("_t0"))
    filled = F.coalesce(F.col(y), F.col("_y0") + (F.col("_y1") - F.col("_y0")) * share, F.col("_y0"))
    out = rows.withColumn(y, filled).drop("t", "_y0", "_t0", "_y1", "_t1").filter(F.col(y).isNotNull())
    return out.filter(F.col(ds) >= F.lit(start).cast("date")) if start else out


def difference(df: DataFrame, keys: Sequence[str] = (), y: str = "y", ds: str = "ds", out: str = "y") -> DataFrame:
    """First difference of every series; the first row drops out."""
    step = F.col(y) - F.lag(y).over(W.partitionBy(*keys).orderBy(ds))
    return df.withColumn(out, step).filter(F.col(out).isNotNull())
