"""Seasonal autoregression with lagged errors, by two regressions instead of a search.

The series is differenced over a season.  A long autoregression gives the
errors, and a second regression on lagged values and lagged errors gives the
coefficients.  Both are sums of products over window columns (``gram``), so all
series, folds and models are fitted by two aggregations.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import gram
from tidemark.operators.panelfit import forecast_table, numbered_test
from tidemark.runtime import cut_lineage

# One lag of each kind beside one seasonal error, in a season of 52 weeks.
SEASON, VALUE_LAGS, ERROR_LAGS = 52, (1,), (1, 52, 53)
#: Lags of the first regression.
LONG = 13


def _coefficients(rows: int, matrix: np.ndarray) -> list[dict]:
    found = gram.least_squares(rows, matrix)
    return [] if found is None else [{"beta": found["beta"].tolist()}]


def _regressed(rows: DataFrame, keys: list[str], regressors: list[Column], target: str) -> DataFrame:
    """keys, beta of ``target`` on the regressors, over the rows where all of them are known."""
    there = F.lit(True)
    for column in [*regressors, F.col(target)]:
        there = there & column.isNotNull()
    vector = F.when(there, F.array(*regressors, F.col(target)))
    return gram.solve(gram.products(rows.withColumn("v", vector), keys), keys, _coefficients, "beta array<double>")


def fit_arma(
    series: DataFrame, keys: Sequence[str], season: int = SEASON, value_lags: Sequence[int] = VALUE_LAGS,
    error_lags: Sequence[int] = ERROR_LAGS, long: int = LONG,
) -> tuple[DataFrame, DataFrame]:
    """Rows (keys, ds, y, w, e) and coefficients (keys, beta) of every series (ds, y).

    ``w`` is the change over a season, ``e`` the error of the long regression.
    ``beta`` holds the value lags, then the error lags.  A series too short for
    its regressions, or one they can't tell apart, has no coefficients.
    """
    keys = list(keys)
    ordered = W.partitionBy(*keys).orderBy("ds")
    back = lambda c, k: F.lag(c, k).over(ordered)
    rows = series.select(*keys, "ds", F.col("y").cast("double").alias("y")).where(F.col("y").isNotNull())
    rows = rows.withColumn("w", F.col("y") - back("y", season))
    rows = cut_lineage(rows.withColumn("_lags", F.array(*[back("w", k) for k in range(1, long + 1)])))
    first = _regressed(rows, keys, [F.col("_lags")[i] for i in range(long)], "w")
    known = ~F.exists("_lags", lambda v: v.isNull()) & F.col("w").isNotNull()
    rows = rows.join(first, keys, "left").withColumn("e", F.when(known, F.col("w") - gram.dot("_lags", "beta"))).drop("_lags", "beta")
    regressors = {f"_w{k}": back("w", k) for k in value_lags} | {f"_e{k}": back("e", k) for k in error_lags}
    rows = cut_lineage(rows.withColumns(regressors))
    return rows.select(*keys, "ds", "y", "w", "e"), cut_lineage(_regressed(rows, keys, [F.col(c) for c in regressors], "w"))


def extend_arma(
    rows: DataFrame, fits: DataFrame, keys: Sequence[str], horizon: int, season: int = SEASON,
    value_lags: Sequence[int] = VALUE_LAGS, error_lags: Sequence[int] = ERROR_LAGS,
) -> DataFrame:
    """keys, step, yhat of the next ``horizon`` rows of every series that has coefficients; future errors are 0."""
    keys = list(keys)
    need = max(season, *value_lags, *error_lags)
    tail = rows.withColumn("_rev", F.row_number().over(W.partitionBy(*keys).orderBy(F.col("ds").desc()))).where(F.col("_rev") <= need)
    held = tail.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(-F.col("_rev"), "y", "w", "e"))).alias("_tail")).join(fits, keys)
    errors, past = F.col("_tail.e"), F.size("_tail")
    # the arrays grow by one per step; position -k from the end is k rows back
    count = len(list(value_lags))

    def step(state: Column, h: Column) -> Column:
        values = [F.col("beta")[i] * F.get(state["w"], F.size(state["w"]) - k) for i, k in enumerate(value_lags)]
        noise = [F.col("beta")[count + i] * F.when(h <= k, F.coalesce(F.get(errors, past + h - 1 - k), F.lit(0.0))).otherwise(0.0) for i, k in enumerate(error_lags)]
        change = sum(values + noise, F.lit(0.0))
        level = F.get(state["y"], F.size(state["y"]) - season) + change
        return F.struct(F.concat(state["w"], F.array(change)).alias("w"), F.concat(state["y"], F.array(level)).alias("y"))

    start = F.struct(F.col("_tail.w").alias("w"), F.col("_tail.y").alias("y"))
    whole = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step)
    future = F.slice(whole["y"], past + 1, F.lit(horizon))
    return held.select(*keys, F.posexplode(future).alias("_at", "yhat")).select(*keys, (F.col("_at") + 1).alias("step"), "yhat")


def arma_forecast(split: DataFrame, keys: Sequence[str] = (), model: str = "seasonal_arma") -> DataFrame:
    """Forecasts of the test rows of ``split`` (ds, y, is_test) as the long forecast table.

    A series without coefficients keeps its rows, with NULL and a status.
    """
    source, group = (split, list(keys)) if keys else (split.withColumn("_all", F.lit(0)), ["_all"])
    rows, fits = fit_arma(source.where(~F.col("is_test")), group)
    test, longest = numbered_test(source, group)
    return forecast_table(test, extend_arma(rows, fits, group, longest), group, keys, model)
