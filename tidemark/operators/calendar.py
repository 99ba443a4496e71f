"""Holiday calendars, Easter on a weekly grid, and event labels per week.

Everything here is a small dimension: bounded by years or by calendar days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import easter_sunday, last_weekday, nth_weekday, week_ending

HOLIDAY_SCHEMA = "holiday STRING, ds DATE, lower_window INT, upper_window INT"


def _rows(spark: SparkSession, first_year: int, last_year: int, rules: dict[str, Column],
          lower: int, upper: int) -> DataFrame:
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    entries = F.array(
        *[F.struct(F.lit(name).alias("holiday"), day.alias("ds")) for name, day in rules.items()]
    )
    return years.select(F.inline(entries)).select(
        "holiday", "ds", F.lit(lower).alias("lower_window"), F.lit(upper).alias("upper_window")
    )


def _trading_rules(year: Column) -> dict[str, Column]:
    return {
        "Superbowl": nth_weekday(year, 2, 2, "Fri"),
        "Labor Day": week_ending(nth_weekday(year, 9, 1, "Mon")),
        "Thanksgiving": week_ending(nth_weekday(year, 11, 4, "Thu")),
        "Christmas": last_weekday(year, 12, "Fri"),
    }


def trading_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """The four trading events of the sales log as the Friday that ends their week.

    Each reaches three days back and two days ahead.
    """
    return _rows(spark, first_year, last_year, _trading_rules(F.col("year")), -3, 2)


def is_trading_holiday(day: Column) -> Column:
    """True on the Friday that ends the week of a trading event, in any year."""
    return F.coalesce(day.isin(*_trading_rules(F.year(day)).values()), F.lit(False))


def national_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Public holidays of the United States by their dating rules, window 0 days."""
    year = F.col("year")

    def fixed(month: int, day: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day))

    rules = {
        "New Year's Day": fixed(1, 1),
        "Martin Luther King Jr. Day": nth_weekday(year, 1, 3, "Mon"),
        "Washington's Birthday": nth_weekday(year, 2, 3, "Mon"),
        "Memorial Day": last_weekday(year, 5, "Mon"),
        "Independence Day": fixed(7, 4),
        "Labor Day (public)": nth_weekday(year, 9, 1, "Mon"),
        "Columbus Day": nth_weekday(year, 10, 2, "Mon"),
        "Veterans Day": fixed(11, 11),
        "Thanksgiving (public)": nth_weekday(year, 11, 4, "Thu"),
        "Christmas Day": fixed(12, 25),
    }
    return _rows(spark, first_year, last_year, rules, 0, 0)


def easter_weeks(dates: DataFrame, ds: str = "ds") -> DataFrame:
    """The grid date of the pre-Easter shopping week, for every year covered.

    That is the last grid date more than two and at most nine days before
    Easter Sunday, so the week ending on Good Friday on a Friday grid.
    """
    easter = easter_sunday(F.year(ds))
    ahead = F.datediff(easter, F.col(ds))
    return (
        dates.select(ds).distinct()
        .filter((ahead >= 2) & (ahead < 9))
        .groupBy(F.year(ds).alias("year"))
        .agg(F.max(ds).alias("ds"))
        .select("ds", F.lit("Easter").alias("holiday"))
    )


def calendar_events(dates: DataFrame, holidays: DataFrame | None = None, ds: str = "ds") -> DataFrame:
    """Label every distinct date with the event in it; '' for an ordinary week."""
    grid = dates.select(F.col(ds).alias("ds")).distinct()
    easter = easter_weeks(grid).withColumnRenamed("holiday", "_easter")
    labelled = grid
    if holidays is not None:
        named = holidays.groupBy("ds").agg(F.max("holiday").alias("_named"))
        labelled = labelled.join(named, ["ds"], "left")
    else:
        labelled = labelled.withColumn("_named", F.lit(None).cast("string"))
    # concat_ws skips NULL, so the label is '', one name, or 'name + Easter'.
    return labelled.join(easter, ["ds"], "left").select(
        "ds", F.concat_ws(" + ", "_named", "_easter").alias("event")
    )


def weekly_grid(dates: DataFrame, ahead_weeks: int = 0, ds: str = "ds", weekday: str = "Fri") -> DataFrame:
    """The complete weekly grid over the span of ``dates``, reaching ``ahead_weeks`` past it."""
    span = dates.agg(F.min(ds).alias("_from"), F.max(ds).alias("_to"))
    first = week_ending(F.col("_from"), weekday)
    last = F.date_add("_to", 7 * ahead_weeks)
    return span.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 7 DAYS"))).alias("ds"))


def with_easter(holidays: DataFrame | None, grid: DataFrame) -> DataFrame:
    """A holiday frame with one Easter row per year of the weekly grid appended.

    The grid should reach past the forecast horizon, so the model also knows
    where the next Easter falls.
    """
    easter = easter_weeks(grid).select(
        "holiday", "ds", F.lit(0).alias("lower_window"), F.lit(0).alias("upper_window")
    )
    return easter if holidays is None else holidays.unionByName(easter)


def one_per_date(holidays: DataFrame, order: Sequence[str] = ("holiday",), ds: str = "ds") -> DataFrame:
    """One whole row per date: the smallest by ``order``, NULLs last, ties by the other columns from left to right.

    Rows without a date are one group.  Nothing is sorted: the winner is a
    minimum, so a date with most of the rows is reduced before the shuffle.
    """
    rest = [c for c in holidays.columns if c != ds]
    if not rest:
        return holidays.distinct()
    by = [*order, *(c for c in rest if c not in order)]
    ranks = [part for c in by for part in (F.col(c).isNull(), F.col(c))]
    winner = F.min_by(F.struct(*rest), F.struct(*[p.alias(f"_{k}") for k, p in enumerate(ranks)]))
    return holidays.groupBy(ds).agg(winner.alias("_row")).select(ds, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def holiday_windows(holidays: DataFrame) -> DataFrame:
    """Spread each holiday over the days of its window: one row per affected day.

    ``effect`` names the holiday and the offset, the unit that gets its own
    coefficient in an additive model.
    """
    offsets = holidays.withColumn("offset", F.explode(F.sequence("lower_window", "upper_window")))
    extra = [c for c in holidays.columns if c not in ("holiday", "ds", "lower_window", "upper_window")]
    return offsets.select(
        *extra,
        F.date_add("ds", F.col("offset")).alias("ds"),
        F.col("holiday"),
        F.col("offset"),
        F.when(F.col("offset") == 0, F.col("holiday"))
        .otherwise(F.format_string("%s_%+d", "holiday", "offset"))
        .alias("effect"),
    )


def holiday_summary(holidays: DataFrame) -> DataFrame:
    """How many dates each holiday has, and the first and last of them."""
    return holidays.groupBy("holiday").agg(
        F.count("ds").alias("dates"), F.min("ds").alias("first"), F.max("ds").alias("last")
    )
