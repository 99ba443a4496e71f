"""Forecast errors, fold summaries and error bands over one long forecast table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.operators.scan import exact_quantiles


def error_columns(y: str = "y", yhat: str = "yhat") -> list[Column]:
    """MAE, MSE, RMSE, MAPE and R2 as aggregate expressions.

    Rows without a forecast do not count.  MAPE uses rows with a positive
    actual only; R2 is NULL when the actuals do not vary.
    """
    known = F.col(y).isNotNull() & F.col(yhat).isNotNull()
    actual = F.when(known, F.col(y))
    error = F.col(y) - F.col(yhat)
    positive = F.when(known & (F.col(y) > 0), F.abs(error / F.when(F.col(y) > 0, F.col(y))))
    total = F.var_pop(actual) * F.count(actual)
    return [
        F.count(actual).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(positive) * 100).alias("mape"),
        F.when(total > 0, 1 - ratio(F.sum(error * error), total)).alias("r2"),
    ]


def forecast_metrics(
    df: DataFrame, by: Sequence[str] = ("model",), y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """All five error measures per group, in one aggregation."""
    return df.groupBy(*by).agg(*error_columns(y, yhat))


def metrics_table(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """The same, best MAPE first."""
    return forecast_metrics(df, by).orderBy(F.col("mape").asc_nulls_last(), *by)


def weighted_error(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Sum of absolute errors over sum of actuals: large series count for more.

    Both sums are over the rows that have a forecast.
    """
    actual = F.when(F.col("yhat").isNotNull(), F.col("y"))
    return df.groupBy(*by).agg(
        (ratio(F.sum(F.abs(F.col("y") - F.col("yhat"))), F.sum(actual)) * 100).alias("wape")
    )


def fold_summary(scores: DataFrame, metric: str = "mape", model: str = "model") -> DataFrame:
    """Mean, range and folds won per model; ``scores`` has one row per (model, fold).

    A model without a value in a fold cannot win it.
    """
    ranked = scores.withColumn("_rank", F.rank().over(W.partitionBy("fold").orderBy(F.col(metric).asc_nulls_last())))
    return ranked.groupBy(model).agg(
        F.avg(metric).alias("mean"),
        F.min(metric).alias("min"),
        F.max(metric).alias("max"),
        (F.max(metric) - F.min(metric)).alias("spread"),
        F.count_if((F.col("_rank") == 1) & F.col(metric).isNotNull()).alias("folds_won"),
        F.count(F.lit(1)).alias("folds"),
    )


def tournament_winner(scores: DataFrame, metric: str = "mape", model: str = "model") -> DataFrame:
    """The model with the lowest mean over folds; ties go to the first name, a model without values loses to any other."""
    return fold_summary(scores, metric, model).orderBy(F.col("mean").asc_nulls_last(), model).limit(1)


def compare_on_folds(
    scores: DataFrame, base: str, other: str, metric: str = "mape", model: str = "model"
) -> DataFrame:
    """Effect of ``other`` against ``base``, measured against the spread of the folds.

    One row: mean difference, spread of the base over folds, how many times
    smaller the effect is than that spread, and whether its sign is the same in
    every fold.
    """
    wide = scores.groupBy("fold").agg(
        F.max(F.when(F.col(model) == base, F.col(metric))).alias("_base"),
        F.max(F.when(F.col(model) == other, F.col(metric))).alias("_other"),
    )
    change = F.col("_other") - F.col("_base")
    return wide.agg(
        F.avg(change).alias("effect"),
        (F.max("_base") - F.min("_base")).alias("fold_spread"),
        ratio(
            F.max("_base") - F.min("_base"), F.greatest(F.abs(F.avg(change)), F.lit(1e-9))
        ).alias("spread_over_effect"),
        F.count_if(change < 0).alias("folds_better"),
        F.count_if(change > 0).alias("folds_worse"),
        (F.abs(F.sum(F.signum(change))) == F.count(change)).alias("same_sign"),
    )


def residuals(df: DataFrame) -> DataFrame:
    """Actual minus forecast, and the same in percent of the actual."""
    error = F.col("y") - F.col("yhat")
    return df.withColumns({"residual": error, "error_pct": ratio(error, F.col("y")) * 100})


def cv_interval(
    df: DataFrame, by: Sequence[str] = ("model",), coverage: float = 0.8, error: str = "error_pct"
) -> DataFrame:
    """Half-width of the band that held ``coverage`` of the past percentage errors."""
    sizes = df.select(*by, F.abs(F.col(error)).alias("_size"))
    found = exact_quantiles(sizes, list(by), "_size", [coverage])
    return found.select(*by, F.col("quantiles")[0].alias("band"))


def apply_band(df: DataFrame, bands: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Put a percentage band around every forecast."""
    width = F.col("band") / 100
    return df.join(bands, list(by), "left").withColumns(
        {"yhat_lo": F.col("yhat") * (1 - width), "yhat_hi": F.col("yhat") * (1 + width)}
    )


def interval_coverage(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Share of actuals inside their interval, bounds included."""
    inside = (F.col("y") >= F.col("yhat_lo")) & (F.col("y") <= F.col("yhat_hi"))
    return df.groupBy(*by).agg(F.avg(inside.cast("double")).alias("coverage"))


def near_zero_rows(df: DataFrame, limit: float = 100.0, by: Sequence[str] = ()) -> DataFrame:
    """How many rows have an actual below ``limit``, where percentages break down."""
    return df.groupBy(*by).agg(
        F.count_if(F.col("y") < limit).alias("near_zero"), F.count(F.lit(1)).alias("rows")
    )
