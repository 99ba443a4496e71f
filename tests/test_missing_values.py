"""Short series, new groups and missing features: no forecast row is lost and NULL never wins."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar, encode, metrics, trees
from tidemark.operators.scan import shuffled_rank


def test_a_model_without_values_wins_nothing(spark):
    rows = [("ghost", 1, None), ("ghost", 2, None), ("real", 1, 5.0), ("real", 2, 7.0), ("other", 1, 6.5), ("other", 2, None)]
    scores = spark.createDataFrame(rows, "model string, fold int, mape double")
    won = {r.model: r.folds_won for r in metrics.fold_summary(scores).collect()}
    assert won == {"ghost": 0, "real": 2, "other": 0}
    assert [r.model for r in metrics.tournament_winner(scores).collect()] == ["real"]


def test_weighted_error_is_over_rows_with_a_forecast(spark):
    rows = [("m", 100.0, 90.0), ("m", 100.0, None), ("none", 5.0, None)]
    found = {r.model: r.wape for r in metrics.weighted_error(spark.createDataFrame(rows, "model string, y double, yhat double")).collect()}
    assert found["m"] == pytest.approx(10.0) and found["none"] is None


def test_tree_forecasts_keep_rows_without_a_feature(spark):
    train = spark.createDataFrame([(float(k % 7), float(k), 3.0 * (k % 7)) for k in range(60)], "a double, b double, y double")
    model = trees.fit_boosted(train.unionByName(train.limit(1).withColumn("y", F.lit(None).cast("double"))), ["a", "b"], rounds=4)
    test = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, 1.0, None)], "id int, a double, b double")
    found = {r.id: r.yhat for r in model.predict(test).collect()}
    assert set(found) == {1, 2, 3} and found[1] is not None and found[2] is found[3] is None


def test_a_new_group_gets_the_mean_line(spark):
    train = spark.createDataFrame([(g, float(t), 10.0 * g + g * t) for g in (1, 3) for t in range(5)] + [(7, 0.0, 1.0)], "g int, t double, y double")
    lines = trees.group_trends(train, ["g"])
    got = {r.g: r.trend for r in trees.add_trend(spark.createDataFrame([(1, 4.0), (7, 4.0), (9, 4.0)], "g int, t double"), lines, ["g"]).collect()}
    assert got == {1: pytest.approx(14.0), 7: pytest.approx(28.0), 9: pytest.approx(28.0)}


def test_random_ranks_do_not_depend_on_the_bins(spark):
    df = spark.range(300).withColumn("s", F.col("id") % 3)
    ranks = [{r.id: r["rank"] for r in shuffled_rank(df, ["s"], "id", 42, digits=d).collect()} for d in (1, 2, 4)]
    assert ranks[0] == ranks[1] == ranks[2]


def test_the_holiday_rule_is_the_calendar(spark):
    days = spark.range(0, 60 * 365).select(F.date_add(F.lit("1980-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    by_rule = {r.d for r in days.where(calendar.is_trading_holiday(F.col("d"))).collect()}
    listed = {r.ds for r in calendar.trading_holidays(spark, 1980, 2039).collect()}
    last = max(by_rule)
    assert by_rule == {d for d in listed if d <= last} and last.year == 2039 and min(by_rule) > datetime.date(1980, 1, 31)


def test_too_many_categories_are_an_error(spark):
    with pytest.raises(ValueError):
        encode.one_hot(spark.range(1500).selectExpr("cast(id as string) AS c"), ["c"])
