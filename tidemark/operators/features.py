"""Calendar, lag and rolling features that never read the current or a later row.

Series frames hold one row per (keys, ds); a window group is therefore bounded
by the number of weeks in the calendar, not by the size of the raw table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.dates import calendar_columns
from tidemark.functions.numbers import code_for

CALENDAR = ["week", "month", "quarter", "week_sin", "week_cos", "t"]
LAGS = ["lag_1", "lag_52", "roll_4"]
STORE_TYPES = {"A": 0, "B": 1, "C": 2}


def calendar_features(df: DataFrame, ds: str = "ds") -> DataFrame:
    """Append year, month, week, quarter and the week angle."""
    return df.withColumns(calendar_columns(F.col(ds)))


def lag_features(
    df: DataFrame,
    keys: Sequence[str] = (),
    value: str = "y",
    ds: str = "ds",
    lags: Sequence[int] = (1, 2, 52),
    windows: Sequence[int] = (4, 13),
    by_calendar: bool = False,
    step_days: int = 7,
) -> DataFrame:
    """Append ``lag_k`` and ``roll_w``, all computed from earlier rows only.

    Lags count rows by default.  With ``by_calendar`` they count steps of the
    date grid instead, so a missing week gives NULL rather than an older one.
    ``roll_w`` is NULL until ``w`` earlier rows exist.
    """
    ordered = W.partitionBy(*keys).orderBy(ds)
    new = {}
    for k in lags:
        if by_calendar:
            at = W.partitionBy(*keys).orderBy(F.unix_date(ds)).rangeBetween(
                -k * step_days, -k * step_days
            )
            new[f"lag_{k}"] = F.first(value).over(at)
        else:
            new[f"lag_{k}"] = F.lag(value, k).over(ordered)
    for w in windows:
        before = ordered.rowsBetween(-w, -1)
        full = F.count(value).over(before) == w
        new[f"roll_{w}"] = F.when(full, F.avg(value).over(before))
    return df.withColumns(new)


def build_features(
    df: DataFrame,
    keys: Sequence[str] = (),
    value: str = "y",
    ds: str = "ds",
    type_column: str | None = "Type",
    by_calendar: bool = False,
) -> DataFrame:
    """The table a tree model needs: calendar, counter, lags; incomplete rows dropped."""
    out = df
    if type_column and type_column in df.columns:
        out = out.withColumn(type_column, code_for(F.col(type_column), STORE_TYPES))
    parts = calendar_columns(F.col(ds))
    out = out.withColumns({c: parts[c] for c in ("week", "month", "quarter", "week_sin", "week_cos")})
    counter = F.row_number().over(W.partitionBy(*keys).orderBy(ds)) - 1
    out = out.withColumn("t", counter)
    out = lag_features(out, keys, value, ds, lags=(1, 52), windows=(4,), by_calendar=by_calendar)
    return out.na.drop("any", subset=LAGS)


