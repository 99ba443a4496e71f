import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.dates import easter_sunday, week_ending
from tidemark.operators import calendar, features

EASTERS = {2010: "2010-04-04", 2011: "2011-04-24", 2012: "2012-04-08", 2013: "2013-03-31", 2000: "2000-04-23"}
# The published event weeks of the sales log.
EVENTS = {
    "Superbowl": ["2010-02-12", "2011-02-11", "2012-02-10", "2013-02-08"],
    "Labor Day": ["2010-09-10", "2011-09-09", "2012-09-07", "2013-09-06"],
    "Thanksgiving": ["2010-11-26", "2011-11-25", "2012-11-23", "2013-11-29"],
    "Christmas": ["2010-12-31", "2011-12-30", "2012-12-28", "2013-12-27"],
}


def test_easter_dates(spark):
    years = spark.createDataFrame([(y,) for y in EASTERS], "y INT")
    got = {r.y: str(r.e) for r in years.select("y", easter_sunday(F.col("y")).alias("e")).collect()}
    assert got == EASTERS


def test_trading_holidays_follow_the_published_weeks(spark):
    rows = calendar.trading_holidays(spark, 2010, 2013).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.ds):
        got.setdefault(r.holiday, []).append(str(r.ds))
        assert (r.lower_window, r.upper_window) == (-3, 2)
    assert got == EVENTS


def test_week_label_is_the_friday_on_or_after(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2012-01-06', DATE'2012-01-13', INTERVAL 1 DAY)) AS d")
    got = [str(r[0]) for r in days.select(week_ending(F.col("d"))).collect()]
    assert got == ["2012-01-06"] + ["2012-01-13"] * 7


def test_easter_week_and_joined_labels(spark, weekly):
    grid = weekly({"a": [1.0] * 143})
    weeks = {str(r.ds) for r in calendar.easter_weeks(grid).collect()}
    assert weeks == {"2010-04-02", "2011-04-22", "2012-04-06"}
    clash = spark.createDataFrame([("Sale", dt.date(2011, 4, 22))], "holiday STRING, ds DATE")
    labels = {str(r.ds): r.event for r in calendar.calendar_events(grid, clash).collect()}
    assert labels["2011-04-22"] == "Sale + Easter" and labels["2010-04-02"] == "Easter"
    assert labels["2010-02-05"] == ""
    only_easter = calendar.calendar_events(grid).filter("event <> ''").count()
    assert only_easter == 3


def test_holiday_windows_name_their_offsets(spark):
    rows = calendar.holiday_windows(calendar.trading_holidays(spark, 2010, 2010)).filter("holiday = 'Christmas'").collect()
    assert {r.effect for r in rows} == {"Christmas", "Christmas_-3", "Christmas_-2", "Christmas_-1", "Christmas_+1", "Christmas_+2"}
    assert {str(r.ds) for r in rows if r.effect == "Christmas_+2"} == {"2011-01-02"}


def test_iso_week_53_shares_the_angle_of_week_1(spark):
    days = spark.sql("SELECT DATE'2010-01-01' AS ds UNION ALL SELECT DATE'2010-01-08'")
    rows = features.calendar_features(days).orderBy("ds").collect()
    assert [r.week for r in rows] == [53, 1]
    assert abs(rows[0].week_sin - rows[1].week_sin) < 1e-12
