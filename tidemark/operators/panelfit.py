"""Forecast tables over many series, folds and models.

``forecast_panel`` runs a user's own forecaster: a function ``(train values,
horizon) -> forecast`` or ``None`` when the history is too short, with every
(series, fold, model) as one group of a grouped map.  The library's own models
(``baselines``, ``smoothing``, ``arma``, ``additive``) are Spark expressions and
need no such function; their forecasts come through ``forecast_table``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


Forecaster = Callable[[np.ndarray, int], "np.ndarray | None"]


def numbered_test(split: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """The test rows with their step, and the largest step of any series."""
    test = split.where("is_test").withColumn("step", F.row_number().over(W.partitionBy(*keys).orderBy("ds")))
    return test, test.agg(F.max("step")).first()[0] or 1


def forecast_table(test: DataFrame, future: DataFrame, group: Sequence[str], keys: Sequence[str], model: str) -> DataFrame:
    """The long forecast table of the test rows from (group, step, yhat); a row without a forecast stays, with a status."""
    out = test.join(future, [*group, "step"], "left")
    return out.select(
        *keys, F.lit(model).alias("model"), "ds", "step", F.col("y").cast("double").alias("y"), "yhat", F.lit("multi_step").alias("horizon_kind"),
        F.when(F.col("yhat").isNull(), "short_history").otherwise("ok").alias("status"),
    )


def naive(train: np.ndarray, horizon: int):
    return np.repeat(train[-1], horizon) if len(train) else None


def seasonal_naive(period: int = 52) -> Forecaster:
    def forecast(train: np.ndarray, horizon: int):
        if horizon > period or len(train) < period:
            return None
        return train[len(train) - period :][:horizon]

    return forecast


def seasonal_naive_growth(period: int = 52, window: int = 13) -> Forecaster:
    def forecast(train: np.ndarray, horizon: int):
        copied = seasonal_naive(period)(train, horizon)
        if copied is None or len(train) < period + window:
            return None
        before = train[-window - period : -period].sum()
        return None if before == 0 else copied * (train[-window:].sum() / before)

    return forecast


FORECAST_FIELDS = (
    "model STRING, ds DATE, step INT, y DOUBLE, yhat DOUBLE, horizon_kind STRING, status STRING"
)


def forecast_panel(
    split: DataFrame, models: dict[str, Forecaster], keys: Sequence[str] = ()
) -> DataFrame:
    """Fit every model to every series (and fold, if among the keys).

    ``split`` has ``ds, y, is_test``.  Output: the long forecast table for the
    test rows, with ``status`` instead of a silent gap where a fit failed.
    """
    keys = list(keys)
    names = F.array(*[F.lit(n) for n in models])
    source = split.select(*keys, "ds", "y", "is_test").withColumn("model", F.explode(names))
    key_schema = "".join(
        f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema if f.name in keys
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("ds")
        flag = ordered["is_test"].to_numpy(dtype=bool)
        test = ordered[flag].reset_index(drop=True)
        train = ordered.loc[~flag, "y"].to_numpy(dtype=float)
        name = ordered["model"].iloc[0]
        status, values = "ok", None
        try:
            values = models[name](train, len(test))
            if values is None:
                status = "short_history"
        except (np.linalg.LinAlgError, FloatingPointError, ZeroDivisionError) as error:
            status = f"failed: {type(error).__name__}"
        out = test[[*keys, "model", "ds"]].copy()
        out["step"] = np.arange(1, len(test) + 1, dtype=np.int32)
        out["y"] = test["y"]
        out["yhat"] = np.nan if values is None else np.asarray(values, dtype=float)
        out["horizon_kind"] = "multi_step"
        out["status"] = status
        return out[[*keys, "model", "ds", "step", "y", "yhat", "horizon_kind", "status"]]

    return source.groupBy(*keys, "model").applyInPandas(run, key_schema + FORECAST_FIELDS).withColumn(
        "yhat", F.when(~F.isnan("yhat"), F.col("yhat"))
    )


def per_series_score(forecasts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pooled MAPE over all series, and how many series were fitted or opted out."""
    per = forecasts.groupBy("model", *keys).agg(
        F.sum(F.when(F.col("y") > 0, F.abs((F.col("y") - F.col("yhat")) / F.when(F.col("y") > 0, F.col("y"))))).alias("_e"),
        F.count(F.when((F.col("y") > 0) & F.col("yhat").isNotNull(), 1)).alias("_n"),
        F.max((F.col("status") == "ok").cast("int")).alias("_ok"),
    )
    return per.groupBy("model").agg(
        (F.try_divide(F.sum("_e"), F.sum("_n")) * 100).alias("mape"),
        F.sum("_ok").alias("fitted"),
        (F.count(F.lit(1)) - F.sum("_ok")).alias("opted_out"),
    )
