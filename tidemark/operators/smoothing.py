"""Exponential smoothing in the JVM: simple smoothing as a scan, Holt-Winters as a fold over candidates.

Simple smoothing is a chain of maps y -> a y + b, which compose, so ``scan.affine``
splits a series of any length over bins.  Holt-Winters carries level, slope and
one seasonal figure per week through the values of a series; every set of
weights is a row, so all of them are tried side by side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.panelfit import forecast_table, numbered_test
from tidemark.operators.scan import affine

#: Weeks of a series that one bin of the scan holds.
BIN_WEEKS = 256
SEASON = 52
# Weights that are tried for level, slope and season.
ALPHAS, BETAS, GAMMAS = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7), (0.0001, 0.01, 0.05, 0.2), (0.0001, 0.05, 0.1, 0.2, 0.4)


def simple_smoothing(
    df: DataFrame, keys: Sequence[str] = (), alphas: Sequence[float] = (0.4,)
) -> DataFrame:
    """One-step-ahead forecasts by simple exponential smoothing, per alpha.

    Output: keys, ds, t, y, alpha, yhat.  The first forecast is the first value;
    score from ``t >= 1`` on.  A missing value leaves the forecast as it is.
    """
    levels = F.array(*[F.lit(float(a)) for a in alphas])
    rows = df.select(*keys, "ds", F.col("y").cast("double").alias("y")).withColumn("alpha", F.explode(levels))
    known, alpha = F.col("y").isNotNull(), F.col("alpha")
    bins = F.floor(F.unix_date("ds") / (7 * BIN_WEEKS))
    out = affine(
        rows, [*keys, "alpha"], "ds", bins, slope=F.when(known, 1 - alpha).otherwise(1.0),
        shift=F.when(known, alpha * F.col("y")).otherwise(0.0), start=F.col("y"), carry=["y"],
    )
    return out.select(*keys, "ds", F.col("position").cast("int").alias("t"), "y", "alpha", F.col("state").alias("yhat"))


# --------------------------------------------------------------------------
# Holt-Winters
# --------------------------------------------------------------------------


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values)


def _start(series: DataFrame, period: int, trend: bool, seasonal: str | None) -> DataFrame:
    """Level, slope and seasonal figure before the first value, from the first two cycles."""
    v = F.col("_values")
    if seasonal is None:
        span = F.least(F.size(v), F.lit(10))
        slope = (F.element_at(v, span) - v[0]) / F.greatest(span - 1, F.lit(1)) if trend else F.lit(0.0)
        return series.withColumn("_slope", slope).withColumns({"_level": v[0] - F.col("_slope"), "_season": F.array().cast("array<double>")})
    first, second = _mean(F.slice(v, 1, period)), _mean(F.slice(v, period + 1, period))
    line = series.withColumns({"_first": first, "_slope": (second - first) / period if trend else F.lit(0.0)})
    line = line.withColumn("_level", F.col("_first") - F.col("_slope") * (period + 1) / 2)

    def off(i: Column) -> Column:
        """How far value ``i`` (from 0) is off the line through the first two cycles."""
        base = F.col("_level") + F.col("_slope") * (i + 1)
        return F.try_divide(F.get(v, i), base) if seasonal == "mul" else F.get(v, i) - base

    line = line.withColumn("_figure", F.transform(F.sequence(F.lit(0), F.lit(period - 1)), lambda i: (off(i) + off(i + period)) / 2))
    line = line.withColumn("_middle", _mean(F.col("_figure")))
    centred = F.transform("_figure", lambda f: F.try_divide(f, F.col("_middle")) if seasonal == "mul" else f - F.col("_middle"))
    return line.withColumn("_season", centred).drop("_first", "_figure", "_middle")


def _advance(state: Column, y: Column, period: int, seasonal: str | None) -> tuple[dict[str, Column], Column]:
    """The state after one more value, and what was fitted to it.

    ``season`` holds the figures of the last full cycle and ``fresh`` those of
    the running one, which takes its place when it is full.
    """
    base = state["level"] + state["slope"]
    if seasonal is None:
        fitted, level, season, fresh = base, base + F.col("alpha") * (y - base), state["season"], state["fresh"]
    else:
        head = F.get(state["season"], F.size(state["fresh"]))
        fitted = base * head if seasonal == "mul" else base + head
        seen = F.try_divide(y, head) if seasonal == "mul" else y - head
        level = base + F.col("alpha") * (seen - base)
        own = F.try_divide(y, base) if seasonal == "mul" else y - base
        grown = F.concat(state["fresh"], F.array(head + F.col("gamma") * (own - head)))
        full = F.size(state["fresh"]) == period - 1
        season, fresh = F.when(full, grown).otherwise(state["season"]), F.when(full, F.array().cast("array<double>")).otherwise(grown)
    slope = state["slope"] + F.col("beta") * (level - state["level"] - state["slope"])
    return {"level": level, "slope": slope, "season": season, "fresh": fresh}, fitted


def _struct(**columns: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in columns.items()])


def _state(**more: Column) -> Column:
    return _struct(level=F.col("_level"), slope=F.col("_slope"), season=F.col("_season"), fresh=F.array().cast("array<double>"), **more)


def _upcoming(state: Column, period: int) -> Column:
    """The seasonal figures in the order of the next values."""
    done = F.size(state["fresh"])
    return F.concat(F.slice(state["season"], done + 1, F.greatest(F.lit(period) - done, F.lit(0))), state["fresh"])


def fit_holt_winters(
    series: DataFrame, keys: Sequence[str], period: int = SEASON, trend: str | None = "add", seasonal: str | None = "add",
    alphas: Sequence[float] = ALPHAS, betas: Sequence[float] = BETAS, gammas: Sequence[float] = GAMMAS,
) -> DataFrame:
    """keys, the best weights, their squared error, and the state after the last value.

    Every combination of weights is a row that goes through the series once;
    the least squared one-step error wins, ties go to the smaller weights.
    Series with less than two cycles are left out, and with factors as season
    those with a value that is not positive.
    """
    if seasonal not in (None, "add", "mul") or trend not in (None, "add"):
        raise ValueError("trend is None or 'add'; seasonal is None, 'add' or 'mul'")
    least = 2 * period if seasonal else 3
    known = series.where(F.col("y").isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("_rows"))
    held = known.select(*keys, F.col("_rows.y").alias("_values")).where(F.size("_values") >= least)
    if seasonal == "mul":
        held = held.where(F.forall("_values", lambda v: v > 0))
    started = _start(held, period, trend is not None, seasonal)
    spread = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # folds are long work for few rows: the series are dealt out by their first weight, however small they are
    dealt = started.withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas]))).repartition(spread, *keys, "alpha")
    others = [(b, g) for b in (betas if trend else (0.0,)) for g in (gammas if seasonal else (0.0,))]
    tried = dealt.withColumn("_w", F.explode(F.array(*[_struct(beta=F.lit(float(b)), gamma=F.lit(float(g))) for b, g in others]))).select("*", "_w.*")

    def step(state: Column, y: Column) -> Column:
        new, fitted = _advance(state, y, period, seasonal)
        return _struct(**new, sse=state["sse"] + (y - fitted) * (y - fitted))

    done = tried.withColumn("_end", F.aggregate("_values", _state(sse=F.lit(0.0)), step))
    done = done.where(F.col("_end.sse").isNotNull() & ~F.isnan("_end.sse"))
    fields = ["alpha", "beta", "gamma", "_end.sse", "_end.level", "_end.slope", "_end.season", "_end.fresh"]
    best = done.groupBy(*keys).agg(F.min_by(F.struct(*fields), F.struct("_end.sse", "alpha", "beta", "gamma")).alias("_best"))
    state = F.col("_best")
    season = _upcoming(state, period) if seasonal else F.array().cast("array<double>")
    return best.select(*keys, *[state[c].alias(c) for c in ("alpha", "beta", "gamma", "sse", "level", "slope")], season.alias("season"))


def extend_holt_winters(fits: DataFrame, keys: Sequence[str], horizon: int, period: int = SEASON, seasonal: str | None = "add") -> DataFrame:
    """keys, step and yhat of the next ``horizon`` rows from the fitted states."""
    rows = fits.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    line = F.col("level") + F.col("slope") * F.col("step")
    if seasonal is None:
        return rows.select(*keys, "step", line.alias("yhat"))
    figure = F.get("season", (F.col("step") - 1) % period)
    return rows.select(*keys, "step", (line * figure if seasonal == "mul" else line + figure).alias("yhat"))


def holt_winters_forecast(
    split: DataFrame, keys: Sequence[str] = (), period: int = SEASON, trend: str | None = "add", seasonal: str | None = "add",
    model: str = "holt_winters",
) -> DataFrame:
    """Forecasts of the test rows of ``split`` (ds, y, is_test) as the long forecast table."""
    source, group = (split, list(keys)) if keys else (split.withColumn("_all", F.lit(0)), ["_all"])
    fits = fit_holt_winters(source.where(~F.col("is_test")), group, period, trend, seasonal)
    test, longest = numbered_test(source, group)
    return forecast_table(test, extend_holt_winters(fits, group, longest, period, seasonal), group, keys, model)


def holt_winters_parts(
    df: DataFrame, keys: Sequence[str] = (), period: int = SEASON, trend: str | None = "add", seasonal: str | None = "add"
) -> DataFrame:
    """What Holt-Winters learned: weights, and level, trend and season per row."""
    source, group = (df, list(keys)) if keys else (df.withColumn("_all", F.lit(0)), ["_all"])
    fits = fit_holt_winters(source, group, period, trend, seasonal)
    rows = source.where(F.col("y").isNotNull()).groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("_rows"))
    held = _start(rows.withColumn("_values", F.col("_rows.y")).join(fits, group), period, trend is not None, seasonal)
    empty = F.array().cast("array<struct<level:double,trend:double,season:double,fitted:double>>")

    def step(state: Column, y: Column) -> Column:
        new, fitted = _advance(state, y, period, seasonal)
        figure = F.lit(None).cast("double")
        if seasonal:  # the figure just made is the last of the running cycle, or of the full one
            figure = F.coalesce(F.get(new["fresh"], F.size(new["fresh"]) - 1), F.element_at(new["season"], -1))
        row = _struct(level=new["level"], trend=new["slope"], season=figure, fitted=fitted)
        return _struct(**new, path=F.concat(state["path"], F.array(row)))

    path = F.aggregate("_values", _state(path=empty), step)["path"]
    each = held.withColumn("_each", F.explode(F.arrays_zip(F.col("_rows.ds").alias("ds"), path.alias("at"))))
    return each.select(
        *keys, "_each.ds", "_each.at.level", "_each.at.trend", "_each.at.season", "_each.at.fitted", "alpha", "beta", "gamma",
        F.col("level").alias("last_level"), F.col("slope").alias("trend_per_week"),
        (F.try_divide(F.col("slope") * period, F.col("level")) * 100).alias("trend_pct_per_year"),
    )
