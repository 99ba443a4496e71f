import pytest
from pyspark.sql import functions as F

from tidemark.operators import baselines, features, splits


def test_features_never_read_the_present_or_the_future(weekly):
    base = features.lag_features(weekly({"a": range(60)}), ["series"]).orderBy("ds").collect()
    bumped = list(range(60))
    bumped[40] = 1000
    other = features.lag_features(weekly({"a": bumped}), ["series"]).orderBy("ds").collect()
    columns = ["lag_1", "lag_2", "lag_52", "roll_4", "roll_13"]
    for i in range(41):
        assert [base[i][c] for c in columns] == [other[i][c] for c in columns]
    assert base[4].roll_4 == 1.5 and base[3].roll_4 is None
    assert base[52].lag_52 == 0 and base[51].lag_52 is None


def test_calendar_lags_do_not_slide_over_a_gap(weekly):
    frame = weekly({"a": range(6)}).filter("y <> 2")
    by_row = features.lag_features(frame, ["series"], lags=(1,), windows=()).filter("y = 3").first()
    by_date = features.lag_features(frame, ["series"], lags=(1,), windows=(), by_calendar=True).filter("y = 3").first()
    assert by_row.lag_1 == 1 and by_date.lag_1 is None


def test_build_features_drops_the_first_year_and_codes_types(weekly):
    frame = weekly({"a": range(60)}).withColumn("Type", F.lit("B"))
    rows = features.build_features(frame, ["series"]).collect()
    assert len(rows) == 8 and {r.Type for r in rows} == {1.0} and min(r.t for r in rows) == 52


def test_folds_grow_and_never_overlap(weekly):
    rows = splits.rolling_origin(weekly({"a": range(100), "b": range(70)}), ["series"], 3, 13).collect()
    for series in "ab":
        tested = []
        for fold in (1, 2, 3):
            train = [r.ds for r in rows if r.series == series and r.fold == fold and not r.is_test]
            test = [r.ds for r in rows if r.series == series and r.fold == fold and r.is_test]
            assert max(train) < min(test) and len(test) == 13
            tested += test
        assert len(set(tested)) == 39


def test_panel_folds_cut_all_series_on_the_same_dates(weekly):
    rows = splits.panel_folds(weekly({"a": range(60), "b": range(45)})).filter("fold = 3 AND is_test")
    assert rows.select("ds").distinct().count() == 13
    assert rows.filter("series = 'b'").count() == 0
    windows = {r.fold: r for r in splits.fold_windows(weekly({"a": range(60)})).collect()}
    assert [windows[f].train_dates for f in (1, 2, 3)] == [21, 34, 47]


def test_validation_is_cut_on_a_date(weekly):
    rows = splits.validation_by_date(weekly({"a": range(50), "b": range(50)}), 0.2).collect()
    assert min(r.ds for r in rows if r.is_val) > max(r.ds for r in rows if not r.is_val)
    assert sum(r.is_val for r in rows) == 20


def test_stratified_splits_keep_shares_and_are_repeatable(spark):
    people = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    held = splits.stratified_hold_out(people, ["label"], "id", 0.2)
    counts = {(r.label, r.is_test): r["count"] for r in held.groupBy("label", "is_test").count().collect()}
    assert counts == {(0, True): 150, (0, False): 600, (1, True): 50, (1, False): 200}
    again = splits.stratified_hold_out(people.repartition(7), ["label"], "id", 0.2)
    assert held.filter("is_test").exceptAll(again.filter("is_test")).count() == 0
    folded = splits.stratified_folds(people, ["label"], "id", 5)
    assert {r["count"] for r in folded.filter("label = 1").groupBy("fold").count().collect()} == {50}
    assert splits.stratified_sample(people, ["label"], "id", 100).count() == 100
    nested = splits.growing_subsets(people, "id", (0.1, 0.5, 1.0))
    small = nested.filter("subset = 1").select("id")
    assert small.count() == 100 and small.exceptAll(nested.filter("subset = 2").select("id")).count() == 0


def test_baselines_match_their_definitions(weekly):
    values = [float(i % 52 + i // 52 * 10 + 1) for i in range(130)]
    split = splits.hold_out_rows(weekly({"a": values, "b": values[:50]}), ["series"])
    rows = baselines.score_baselines(split, ["series"]).collect()
    train = values[:117]
    of = {(r.series, r.model, r.step): r for r in rows}
    growth = sum(train[-13:]) / sum(train[-65:-52])
    for step in range(1, 14):
        assert of["a", "naive", step].yhat == train[-1]
        assert of["a", "mean", step].yhat == pytest.approx(sum(train) / 117)
        assert of["a", "seasonal_naive", step].yhat == train[117 - 52 + step - 1]
        assert of["a", "seasonal_naive_growth", step].yhat == pytest.approx(train[117 - 52 + step - 1] * growth)
        assert of["b", "seasonal_naive", step].yhat is None
        assert of["b", "seasonal_naive", step].status == "short_history"
    with pytest.raises(ValueError):
        baselines.baseline_forecasts(split, ["series"], horizon=60)


def test_future_dates_continue_the_grid(weekly):
    rows = baselines.future_dates(weekly({"a": range(5)}), ["series"], 2).orderBy("step").collect()
    assert [str(r.ds) for r in rows] == ["2010-03-12", "2010-03-19"]


def test_both_ways_to_baselines_agree(weekly):
    values = [float((i * 37) % 52 + i) for i in range(130)]
    split = splits.hold_out_rows(weekly({"a": values, "b": values[:75]}), ["series"])
    apart = baselines.baseline_forecasts(split.filter("NOT is_test"), ["series"]).collect()
    beside = baselines.score_baselines(split, ["series"]).collect()
    want = {(r.series, r.model, r.step): (r.yhat, r.status) for r in apart}
    got = {(r.series, r.model, r.step): (r.yhat, r.status) for r in beside}
    assert want.keys() == got.keys()
    for key, (yhat, status) in want.items():
        assert got[key] == (None if yhat is None else pytest.approx(yhat), status)
