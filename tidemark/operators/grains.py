"""The sales log at three grains, and its way into and out of series form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.runtime import cut_lineage
from tidemark.sources.sales_files import EXTERNALS, clean_sales


def _mean(column: str) -> Column:
    return F.avg(F.col(column).cast("double")).alias(column)


def chain_total(df: DataFrame, by_store: bool = False) -> DataFrame:
    """One row per week.  Externals are means over rows of the log.

    With ``by_store`` each store counts once per week in those means, whatever
    its number of departments.
    """
    if by_store:
        df = store_panel(df)
    return df.groupBy("Date").agg(
        F.sum("Weekly_Sales").alias("Weekly_Sales"),
        F.max("IsHoliday").alias("IsHoliday"),
        *[_mean(c) for c in EXTERNALS],
    )


def store_panel(df: DataFrame) -> DataFrame:
    """One row per store and week; Type and Size are attributes of the store."""
    return df.groupBy("Store", "Date").agg(
        F.sum("Weekly_Sales").alias("Weekly_Sales"),
        F.max("IsHoliday").alias("IsHoliday"),
        F.any_value("Type", True).alias("Type"),
        F.any_value("Size", True).alias("Size"),
        *[_mean(c) for c in EXTERNALS],
    )


def dept_panel(df: DataFrame) -> DataFrame:
    """The finest grain: one row per store, department and week, as loaded."""
    return df


def prepare(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Clean the log once and cut the three grains from it.

    Returns chain, stores, departments, and the clean log they share, which is
    written once to the checkpoint folder.
    """
    clean = cut_lineage(clean_sales(log))
    return chain_total(clean), store_panel(clean), dept_panel(clean), clean


def as_series(
    df: DataFrame, value: str = "Weekly_Sales", keys: Sequence[str] = (), date: str = "Date"
) -> DataFrame:
    """Reduce a grain to ``(keys..., ds, y)``, the shape all series operators take."""
    return df.select(*keys, F.col(date).cast("date").alias("ds"), F.col(value).cast("double").alias("y"))


def deflate(
    df: DataFrame, keys: Sequence[str] = (), nominal: str = "y", index: str = "cpi",
    ds: str = "ds", out: str = "real",
) -> DataFrame:
    """Express ``nominal`` in the prices of the first period of each series."""
    base = F.first(index).over(
        W.partitionBy(*keys).orderBy(ds).rowsBetween(W.unboundedPreceding, 0)
    )
    return df.withColumn(out, F.try_divide(F.col(nominal), F.try_divide(F.col(index), base)))


def roll_up(df: DataFrame, levels: Sequence[str], ds: str = "ds") -> DataFrame:
    """Sum actuals and forecasts over every prefix of ``levels``, the whole included.

    ``roll_up(f, ["store", "dept"])`` yields rows per dept, per store and for
    the chain in one aggregation; ``depth`` counts the levels kept, and levels
    summed away are NULL.  ``y`` and ``yhat`` are summed over the same rows.
    """
    levels = list(levels)
    sets = [levels[:i] + [ds] for i in range(len(levels), -1, -1)]
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *levels, ds).agg(
        F.sum("y").alias("y"),
        F.sum("yhat").alias("yhat"),
        sum(((1 - F.grouping(c)) for c in levels), F.lit(0)).cast("int").alias("depth"),
    )
    return grouped
