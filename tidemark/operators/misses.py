"""Reading the misses: the calendar of this week and of the week it was copied from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio

# Texts of the report, around the name of an event.
NEW_EVENT = "%s fell in this week this year, but not in the same week last year"
OLD_EVENT = "last year's %s peak sits in this week; this year it did not"


def explain_misses(
    scored: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = (),
    period: int = 52,
    top: int | None = None,
) -> DataFrame:
    """Every forecast row with its signed miss and the events on both sides.

    A miss is ``(actual - forecast) / actual`` in percent: positive means the
    forecast was too low.  ``top`` keeps the largest misses of every series.
    ``events`` is the per-date label frame, at most one row per calendar day.
    """
    keys = list(keys)
    labels = events.select("ds", "event").filter(F.col("event") != "")
    now = labels.withColumnRenamed("event", "_now")
    before = labels.select(F.col("ds").alias("last_year"), F.col("event").alias("_before"))
    rows = (
        scored.withColumn("last_year", F.date_sub("ds", 7 * period))
        .join(now, ["ds"], "left")
        .join(before, ["last_year"], "left")
        .withColumns({"_now": F.coalesce("_now", F.lit("")), "_before": F.coalesce("_before", F.lit(""))})
    )
    differ = F.col("_now") != F.col("_before")
    why = (
        F.when(
            (F.col("_now") != "") & differ,
            F.format_string(NEW_EVENT, "_now"),
        )
        .when(
            (F.col("_before") != "") & differ,
            F.format_string(OLD_EVENT, "_before"),
        )
        .otherwise("")
    )
    source = F.concat(
        F.date_format("last_year", "yyyy-MM-dd"),
        F.when(F.col("_before") != "", F.format_string(" (%s)", "_before")).otherwise(""),
    )
    table = rows.select(
        *keys,
        F.col("ds").alias("week"),
        F.col("y").alias("actual"),
        F.col("yhat").alias("forecast"),
        (ratio(F.col("y") - F.col("yhat"), F.col("y")) * 100).alias("miss_pct"),
        F.col("_now").alias("event_this_year"),
        source.alias("same_week_last_year"),
        why.alias("why"),
    )
    if top is None:
        return table
    largest = W.partitionBy(*keys).orderBy(F.abs("miss_pct").desc_nulls_last(), "week")
    return table.withColumn("_rank", F.row_number().over(largest)).filter(F.col("_rank") <= top).drop("_rank")
