import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import additive, arma, calendar, features, metrics, panelfit, smoothing, splits, trees


def planted(n, seed=0, slope=0.5, swing=40.0, noise=2.0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 300 + slope * t + swing * np.sin(2 * np.pi * t / 52) + rng.normal(0, noise, n)


def test_models_beat_the_copy_of_last_year(weekly):
    y = planted(208)
    split = splits.hold_out_rows(weekly({"a": y, "short": y[:60]}), ["series"])
    copied = panelfit.forecast_panel(split, {"copy": panelfit.seasonal_naive()}, ["series"])
    forecasts = copied.unionByName(smoothing.holt_winters_forecast(split, ["series"])).unionByName(arma.arma_forecast(split, ["series"])).persist()
    score = {r.model: r.mape for r in metrics.forecast_metrics(forecasts.filter("series = 'a'")).collect()}
    assert score["holt_winters"] < score["copy"] / 2 and score["seasonal_arma"] < score["copy"]
    status = {(r.series, r.model): r.status for r in forecasts.collect()}
    assert status["short", "holt_winters"] == "short_history" and status["a", "holt_winters"] == "ok"
    assert status["short", "seasonal_arma"] == "short_history" and status["a", "seasonal_arma"] == "ok"
    pooled = {r.model: r for r in panelfit.per_series_score(forecasts, ["series"]).collect()}
    assert pooled["holt_winters"].fitted == 1 and pooled["holt_winters"].opted_out == 1
    parts = smoothing.holt_winters_parts(weekly({"a": y}), ["series"]).collect()
    assert len(parts) == 208 and parts[0].trend_per_week == pytest.approx(0.5, abs=0.3)
    alone = smoothing.holt_winters_forecast(split.filter("series = 'a'").drop("series")).collect()
    mine = {r.ds: r.yhat for r in forecasts.collect() if (r.series, r.model) == ("a", "holt_winters")}
    assert {r.ds: pytest.approx(r.yhat) for r in alone} == mine


def recursion(y, period, a, b, g, seasonal):
    """Holt-Winters step by step for one set of weights."""
    first, second = y[:period], y[period : 2 * period]
    slope = (second.mean() - first.mean()) / period
    level = first.mean() - slope * (period + 1) / 2
    line = level + slope * np.arange(1, 2 * period + 1)
    off = y[: 2 * period] / line if seasonal == "mul" else y[: 2 * period] - line
    season = (off[:period] + off[period:]) / 2
    season = season / season.mean() if seasonal == "mul" else season - season.mean()
    sse = 0.0
    for i, v in enumerate(y):
        base, s = level + slope, season[i % period]
        fitted = base * s if seasonal == "mul" else base + s
        new = base + a * ((v / s if seasonal == "mul" else v - s) - base)
        season[i % period] = s + g * ((v / base if seasonal == "mul" else v - base) - s)
        slope, level = slope + b * (new - level - slope), new
        sse += (v - fitted) ** 2
    return sse, level, slope, season[(len(y) + np.arange(period)) % period]


@pytest.mark.parametrize("seasonal", ["add", "mul"])
def test_best_weights_of_the_fold_match_the_recursion(weekly, seasonal):
    y = planted(75, seed=6, swing=30.0, noise=8.0)
    grid = [(a, b, g) for a in (0.1, 0.5) for b in (0.01, 0.2) for g in (0.05, 0.4)]
    fits = smoothing.fit_holt_winters(weekly({"a": y}), ["series"], 12, "add", seasonal, (0.1, 0.5), (0.01, 0.2), (0.05, 0.4)).first()
    best = min((recursion(y, 12, *w, seasonal)[0], w) for w in grid)
    sse, level, slope, season = recursion(y, 12, *best[1], seasonal)
    assert (fits.alpha, fits.beta, fits.gamma) == best[1] and fits.sse == pytest.approx(sse)
    assert fits.level == pytest.approx(level) and fits.slope == pytest.approx(slope) and fits.season == pytest.approx(list(season))


def test_smoothing_without_season_or_trend(weekly):
    line = weekly({"a": np.arange(30.0)})
    fits = smoothing.fit_holt_winters(line, ["series"], seasonal=None)
    ahead = [r.yhat for r in smoothing.extend_holt_winters(fits, ["series"], 3, seasonal=None).orderBy("step").collect()]
    assert ahead == pytest.approx([30, 31, 32], abs=0.2)
    level = smoothing.fit_holt_winters(weekly({"a": [4.0] * 8}), ["series"], trend=None, seasonal=None).first()
    assert level.level == 4 and level.slope == 0 and level.beta == 0
    assert smoothing.fit_holt_winters(weekly({"a": [1.0, -1.0] * 60}), ["series"], seasonal="mul").count() == 0
    with pytest.raises(ValueError):
        smoothing.fit_holt_winters(line, ["series"], seasonal="other")


def two_regressions(y, season=52, long=13):
    """The same two least-squares problems over the rows themselves."""
    w = y[season:] - y[:-season]
    x = np.column_stack([w[long - k : len(w) - k] for k in range(1, long + 1)])
    e = np.full(len(w), np.nan)
    e[long:] = w[long:] - x @ np.linalg.lstsq(x, w[long:], rcond=None)[0]
    rows = range(long + 53, len(w))
    x = np.array([[w[i - 1], e[i - 1], e[i - 52], e[i - 53]] for i in rows])
    beta = np.linalg.lstsq(x, w[list(rows)], rcond=None)[0]
    w, e, level = list(w), list(e), list(y)
    for _ in range(60):
        w.append(beta @ [w[-1], e[-1], e[-52], e[-53]])
        e.append(0.0)
        level.append(level[-season] + w[-1])
    return beta, level[len(y) :]


def test_seasonal_arma_matches_regressions_over_the_rows(weekly):
    y = planted(260, seed=9, noise=15.0)
    beta, ahead = two_regressions(y)
    rows, fits = arma.fit_arma(weekly({"a": y, "b": y[:118]}), ["series"])
    got = {r.series: r.beta for r in fits.collect()}
    assert got.keys() == {"a"} and got["a"] == pytest.approx(list(beta), rel=1e-6)
    future = arma.extend_arma(rows, fits, ["series"], 60).orderBy("step").collect()
    assert [r.yhat for r in future] == pytest.approx(ahead, rel=1e-7)


def test_sums_of_products_and_their_regressions(spark):
    from tidemark.operators import gram

    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4)) * [1, 100, 1e-3, 1]
    rows = [("a" if i % 3 else None, [float(v) for v in r]) for i, r in enumerate(x)] + [("b", None)]
    frame = spark.createDataFrame(rows, "k STRING, v ARRAY<DOUBLE>").repartition(7)
    sums = {r.k: r for r in gram.products(frame, ["k"]).collect()}
    assert sums.keys() == {"a", None}
    for key, own in ((None, x[::3]), ("a", np.delete(x, np.s_[::3], 0))):
        matrix = gram.unpacked(np.array(sums[key].products))
        assert sums[key].rows == len(own) and matrix == pytest.approx(own.T @ own)
        beta, sse, *_ = np.linalg.lstsq(own[:, :3], own[:, 3], rcond=None)
        found = gram.least_squares(len(own), matrix)
        assert found["beta"] == pytest.approx(beta) and found["sse"] == pytest.approx(sse[0])
        direct = [np.linalg.lstsq(own[:, :k], own[:, 3], rcond=None)[1][0] for k in (1, 2, 3)]
        assert gram.nested_sse(matrix) == pytest.approx(direct)
    assert gram.least_squares(10, np.ones((3, 3))) is None and gram.least_squares(2, np.eye(4)) is None


def test_additive_model_learns_a_moving_holiday(spark, weekly):
    n = 180
    y = planted(n, slope=0.2, noise=1.0)
    grid = weekly({"a": y})
    easter = {r.ds for r in calendar.easter_weeks(grid).collect()}
    bumped = grid.withColumn("y", F.col("y") + F.when(F.col("ds").isin(list(easter)), 80.0).otherwise(0.0))
    split = splits.hold_out_rows(bumped, ["series"], 13)
    holidays = calendar.with_easter(None, calendar.weekly_grid(grid, 60))
    plain = additive.additive_forecast(additive.with_effects(split, None), ["series"])
    taught = additive.additive_forecast(additive.with_effects(split, holidays), ["series"]).persist()
    history = lambda f: metrics.forecast_metrics(f.filter("NOT is_test"), ["series"]).first().rmse
    assert history(taught) < history(plain) / 2
    row = taught.filter(F.col("holidays") != 0).first()
    assert row.holidays == pytest.approx(80, abs=15)
    for r in taught.collect():
        assert r.yhat == pytest.approx(r.trend + r.yearly + r.holidays)
        assert r.yhat_lo <= r.yhat <= r.yhat_hi
    assert metrics.forecast_metrics(taught.filter("is_test"), ["series"]).first().mape < 2.5
    bends = additive.additive_changepoints(additive.with_effects(split, holidays), ["series"])
    assert bends.count() == 25 and bends.agg(F.max("ds")).first()[0] < split.filter("is_test").agg(F.min("ds")).first()[0]
    future = additive.extend_rows(grid, ["series"], 4)
    assert future.filter("is_test").count() == 4


def test_looser_prior_lets_the_trend_bend_more(weekly):
    rng = np.random.default_rng(2)
    y = 100 + np.cumsum(rng.normal(0, 2, 130))
    split = splits.hold_out_rows(weekly({"a": y}), ["series"], 13)
    rows = additive.with_effects(split, None)
    bends = additive.additive_changepoints(rows, ["series"], [0.001, 0.5])
    size = {r.prior_scale: r.s for r in bends.groupBy("prior_scale").agg(F.sum(F.abs("delta")).alias("s")).collect()}
    assert size[0.5] > size[0.001]
    both = additive.additive_forecast(rows, ["series"], [0.001, 0.5])
    one = additive.additive_forecast(rows, ["series"], 0.5)
    assert both.count() == 2 * one.count()
    apart = both.where("prior_scale = 0.5").join(one.select("series", "ds", F.col("yhat").alias("other")), ["series", "ds"])
    assert apart.agg(F.max(F.abs(F.col("yhat") - F.col("other")))).first()[0] < 1e-9


def test_additive_fit_solves_its_normal_equations(weekly):
    y = planted(150, seed=12)
    split = splits.hold_out_rows(weekly({"a": y, "tiny": y[:15], "one": y[:3]}), ["series"], 13)
    rows = additive.with_effects(split, calendar.easter_weeks(split).withColumns({"lower_window": F.lit(0), "upper_window": F.lit(0)}))
    designed, fits = additive.fit_series(rows, ["series"], [0.05])
    solved = {r.series: r for r in fits.collect()}
    assert solved.keys() == {"a"} and solved["a"].unsolved < 1e-12
    own = [r for r in designed.collect() if r.series == "a" and not r.is_test]
    x, target = np.array([r.x for r in own]), np.array([r.y / r.scale for r in own])
    beta, bends = np.zeros(x.shape[1]), len(own[0].knots)
    assert bends == 25 and x.shape[1] == 2 + 25 + 20 + 1
    penalty, shrink, noise = np.full(x.shape[1], 0.01), np.full(bends, 0.05), target.var()
    penalty[:2] = 0.04
    for _ in range(additive.ROUNDS):
        penalty[2 : 2 + bends] = 1 / (0.05 * (shrink + 1e-6))
        beta = np.linalg.solve(x.T @ x + noise * np.diag(penalty), x.T @ target)
        noise, shrink = np.mean((target - x @ beta) ** 2), np.abs(beta[2 : 2 + bends])
    assert solved["a"].beta == pytest.approx(list(beta), abs=1e-8) and solved["a"].noise == pytest.approx(noise, rel=1e-6)
    status = {r.series: r.status for r in additive.additive_forecast(rows, ["series"]).collect()}
    assert status == {"a": "ok", "tiny": "short_history", "one": "short_history"}


def test_detrending_helps_trees_without_lags(weekly):
    series = {f"s{i}": planted(156, seed=i, slope=2.0 + i, swing=10.0) for i in range(3)}
    panel = features.build_features(weekly(series), ["series"]).withColumn(
        "id", F.substring("series", 2, 1).cast("double")
    ).persist()
    columns = ["id", "week_sin", "week_cos", "t"]
    plain = trees.score_panel(panel, columns, False, ["series"], rounds=10, patience=10, depth=3, rate=0.3)
    hybrid = trees.score_panel(panel, columns, True, ["series"], rounds=10, patience=10, depth=3, rate=0.3)
    mean = lambda f: f.agg(F.avg("mape")).first()[0]
    assert mean(hybrid) < mean(plain) / 2
    assert {r.horizon_kind for r in plain.collect()} == {"one_step"}


def test_stopping_waits_for_patience():
    assert trees.best_round([5, 4, 3, 3.5, 3.6], 2) == (3, True)
    assert trees.best_round([5, 4, 3, 3.5], 2) == (3, False)


def test_first_rounds_of_an_ensemble_are_the_shorter_fit(spark):
    rows = spark.range(200).select((F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.sin(F.col("id") % 17) * 3 + F.col("id") % 5).alias("y"))
    ready = trees.assemble(rows, ["a", "b"]).select("features", "label").cache()
    long, short = (trees._booster(n, 2, 0.3, 1.0, 1.0, 1).fit(ready) for n in (5, 2))
    cut = trees.first_rounds(long, 2)
    assert cut.getNumTrees == 2 and trees.first_rounds(long, 9) is long
    assert [r.prediction for r in cut.transform(ready).collect()] == pytest.approx([r.prediction for r in short.transform(ready).collect()])
    assert cut.featureImportances.toArray() == pytest.approx(short.featureImportances.toArray())
