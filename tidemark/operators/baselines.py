"""Forecasts without parameters: the bar every fitted model has to clear."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio

SEASON = 52


def future_dates(train: DataFrame, keys: Sequence[str] = (), horizon: int = 13, ds: str = "ds") -> DataFrame:
    """The next ``horizon`` dates of every series, on the step between its last two."""
    last_two = F.slice(F.sort_array(F.collect_list(ds), asc=False), 1, 2)
    newest = W.partitionBy(*keys).orderBy(F.col(ds).desc())
    tail = train.withColumn("_rev", F.row_number().over(newest)).filter(F.col("_rev") <= 2)
    ends = tail.groupBy(*keys).agg(last_two.alias("_last"))
    step = F.datediff(F.col("_last")[0], F.get("_last", F.lit(1)))
    return (
        ends.withColumn("_gap", step)
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .select(*keys, "step", F.date_add(F.col("_last")[0], F.col("_gap") * F.col("step")).alias(ds))
    )


def _entries(last: Column, mean: Column, seasonal: Column, growth: Column) -> Column:
    """The four models as an array of (model, yhat, status)."""

    def entry(name: str, value: Column) -> Column:
        return F.struct(
            F.lit(name).alias("model"),
            value.alias("yhat"),
            F.when(value.isNull(), "short_history").otherwise("ok").alias("status"),
        )

    return F.array(
        entry("naive", last), entry("mean", mean), entry("seasonal_naive", seasonal),
        entry("seasonal_naive_growth", growth),
    )


def baseline_forecasts(
    train: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 13,
    period: int = SEASON,
    window: int = 13,
    ds: str = "ds",
    y: str = "y",
) -> DataFrame:
    """Four baselines for every series in one pass over its training rows.

    ``naive`` repeats the last value, ``mean`` the mean of history,
    ``seasonal_naive`` the value one season before each step, and
    ``seasonal_naive_growth`` scales that by the last ``window`` rows against
    the same rows a season earlier.  Output: keys, model, step, yhat, status;
    a series too short for a model gets NULL and ``short_history``.

    One shuffle on the keys serves the ranking and the aggregation; what is
    collected per series is at most one horizon long.
    """
    if horizon > period:
        raise ValueError(
            f"a horizon of {horizon} steps reaches past one season of {period}: "
            "values that are not known yet would be needed"
        )
    keys = list(keys)
    newest = W.partitionBy(*keys).orderBy(F.col(ds).desc())
    ranked = train.withColumn("_rev", F.row_number().over(newest))
    rev = F.col("_rev")
    step_of = F.lit(period + 1) - rev
    per_series = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(y).alias("_mean"),
        F.max(F.when(rev == 1, F.col(y))).alias("_last"),
        F.sum(F.when(rev <= window, F.col(y))).alias("_recent"),
        F.sum(F.when((rev > period) & (rev <= period + window), F.col(y))).alias("_before"),
        F.map_from_entries(
            F.collect_list(
                F.when((step_of >= 1) & (step_of <= horizon), F.struct(step_of, F.col(y)))
            )
        ).alias("_season"),
    )
    steps = per_series.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    seasonal = F.when(F.col("_n") >= period, F.try_element_at("_season", F.col("step")))
    growth = F.when(F.col("_n") >= period + window, seasonal * ratio(F.col("_recent"), F.col("_before")))

    models = _entries(F.col("_last"), F.col("_mean"), seasonal, growth)
    return steps.select(*keys, "step", F.inline(models)).select(*keys, "model", "step", "yhat", "status")


def score_baselines(
    split: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 13,
    period: int = SEASON,
    window: int = 13,
    ds: str = "ds",
    y: str = "y",
) -> DataFrame:
    """Forecast table of the four baselines for a frame with an ``is_test`` flag.

    The same forecasts as ``baseline_forecasts``, already beside the actuals:
    test rows follow their training rows in one ordered window per series, so
    one shuffle does and nothing is joined.  Add ``fold`` to the keys to score
    rolling-origin folds in the same job.
    """
    if horizon > period:
        raise ValueError(
            f"a horizon of {horizon} steps reaches past one season of {period}: "
            "values that are not known yet would be needed"
        )
    keys = list(keys)
    ordered, series = W.partitionBy(*keys).orderBy(ds), W.partitionBy(*keys)
    train = ~F.col("is_test")
    rows = split.withColumns(
        {
            "_n": F.count(F.when(train, 1)).over(series),
            "_pos": F.row_number().over(ordered),
            "_mean": F.avg(F.when(train, F.col(y))).over(series),
            "_copy": F.lag(y, period).over(ordered),
        }
    ).withColumn("_back", F.col("_n") - F.col("_pos") + 1)
    back = F.col("_back")
    rows = rows.withColumns(
        {
            "_last": F.max(F.when(back == 1, F.col(y))).over(series),
            "_recent": F.sum(F.when((back >= 1) & (back <= window), F.col(y))).over(series),
            "_before": F.sum(F.when((back > period) & (back <= period + window), F.col(y))).over(series),
        }
    )
    seasonal = F.when(F.col("_n") >= period, F.col("_copy"))
    growth = F.when(F.col("_n") >= period + window, seasonal * ratio(F.col("_recent"), F.col("_before")))
    step = (F.col("_pos") - F.col("_n")).cast("int")
    return (
        rows.withColumn("step", step)
        .filter(F.col("is_test") & (F.col("step") <= horizon))
        .select(*keys, ds, "step", y, F.inline(_entries(F.col("_last"), F.col("_mean"), seasonal, growth)))
        .select(*keys, "model", F.col(ds).alias("ds"), "step", F.col(y).alias("y"), "yhat", "status")
    )
