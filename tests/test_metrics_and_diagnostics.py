import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import stats
from tidemark.operators import calendar, diagnostics, grains, metrics, misses, smoothing


def test_error_measures_and_their_guards(spark):
    rows = [("m", 10.0, 8.0), ("m", 0.0, 1.0), ("m", 20.0, 25.0), ("flat", 5.0, 4.0), ("flat", 5.0, 6.0)]
    table = {r.model: r for r in metrics.forecast_metrics(spark.createDataFrame(rows, "model STRING, y DOUBLE, yhat DOUBLE")).collect()}
    m = table["m"]
    assert m.mae == pytest.approx(8 / 3) and m.mse == pytest.approx(10) and m.mape == pytest.approx(22.5)
    assert m.r2 == pytest.approx(1 - 30 / 200)
    assert table["flat"].r2 is None
    assert metrics.metrics_table(spark.createDataFrame(rows, "model STRING, y DOUBLE, yhat DOUBLE")).first().model == "flat"


def test_band_and_coverage(spark):
    rows = [("m", float(i), 100.0, 100.0 - i) for i in range(1, 11)]
    frame = metrics.residuals(spark.createDataFrame(rows, "model STRING, k DOUBLE, y DOUBLE, yhat DOUBLE"))
    band = metrics.cv_interval(frame, coverage=0.8)
    assert band.first().band == pytest.approx(np.quantile(np.arange(1, 11), 0.8))
    covered = metrics.interval_coverage(metrics.apply_band(frame, band)).first().coverage
    assert 0 <= covered <= 1


def test_fold_comparison_reads_effect_against_spread(spark):
    rows = [("a", 1, 10.0), ("a", 2, 12.0), ("a", 3, 14.0), ("b", 1, 9.0), ("b", 2, 13.0), ("b", 3, 13.5)]
    scores = spark.createDataFrame(rows, "model STRING, fold INT, mape DOUBLE")
    row = metrics.compare_on_folds(scores, "a", "b").first()
    assert row.effect == pytest.approx(-0.5 / 3) and row.fold_spread == 4 and not row.same_sign
    assert row.folds_better == 2 and row.folds_worse == 1
    assert metrics.tournament_winner(scores).first().model == "b"


def test_roll_up_keeps_the_chain_total(spark):
    rows = [(s, d, f"2020-01-{w:02d}", float(s * d + w), 1.0) for s in (1, 2) for d in (1, 2) for w in (3, 10)]
    frame = spark.createDataFrame(rows, "store INT, dept INT, ds STRING, y DOUBLE, yhat DOUBLE")
    rolled = grains.roll_up(frame, ["store", "dept"])
    sums = {r.depth: r.s for r in rolled.groupBy("depth").agg(F.sum("y").alias("s")).collect()}
    assert len(set(sums.values())) == 1 and set(sums) == {0, 1, 2}


def test_misses_name_the_moved_event(spark, weekly):
    grid = weekly({"a": [100.0] * 143})
    events = calendar.calendar_events(grid)
    scored = grid.filter("ds >= DATE'2011-04-01' AND ds < DATE'2011-05-01'").withColumn("yhat", F.lit(80.0))
    rows = {str(r.week): r for r in misses.explain_misses(scored, events).collect()}
    assert rows["2011-04-22"].why.startswith("Easter fell in this week") and rows["2011-04-22"].miss_pct == pytest.approx(20)
    assert rows["2011-04-01"].why.startswith("last year's Easter")
    assert rows["2011-04-01"].same_week_last_year == "2010-04-02 (Easter)"
    zero = misses.explain_misses(scored.withColumn("y", F.lit(0.0)), events).first()
    assert zero.miss_pct is None


def planted(n, seed=0, slope=0.5, swing=30.0, noise=1.0, level=200.0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return level + slope * t + swing * np.sin(2 * np.pi * t / 52) + rng.normal(0, noise, n)


def test_trend_test_against_least_squares(weekly):
    y = planted(100)
    row = diagnostics.trend_test(weekly({"a": y}), ["series"]).first()
    slope = np.polyfit(np.arange(100), y, 1)[0]
    r = np.corrcoef(np.arange(100), y)[0, 1]
    assert row.slope == pytest.approx(slope) and row.r_squared == pytest.approx(r * r)
    assert row.pct_per_year == pytest.approx(100 * slope * 52 / y.mean())


def test_distribution_functions_at_known_points(spark):
    value = lambda column: spark.range(1).select(column).first()[0]
    student = lambda t, df: value(stats.student_p(F.lit(t), F.lit(float(df))))
    assert student(2.0, 10) == pytest.approx(0.0733880, abs=1e-7) and student(-2.0, 10) == student(2.0, 10)
    assert student(1.0, 1) == pytest.approx(0.5) and student(1.0, 2) == pytest.approx(1 - 1 / math.sqrt(3))
    assert student(1.96, 20_001) == pytest.approx(0.05, abs=1e-4)
    assert student(1.0, 0) is None and student(float("nan"), 5) is None and student(float("inf"), 5) == 0
    assert value(stats.normal_cdf(F.lit(1.6448536269514722))) == pytest.approx(0.95, abs=1e-12)
    assert value(stats.normal_cdf(F.lit(-6.0))) == pytest.approx(9.865876e-10, rel=1e-4)
    assert value(stats.normal_cdf(F.lit(-40.0))) == 0 and value(stats.normal_cdf(F.lit(9.0))) == 1
    assert value(stats.unit_root_p(F.lit(-2.86))) == pytest.approx(0.05, abs=0.001)
    assert value(stats.unit_root_p(F.lit(5.0))) == 1 and value(stats.unit_root_p(F.lit(-30.0))) == 0


def direct_unit_root(y):
    """The test by one least-squares problem per order, over the rows themselves."""
    y = y - y.mean()  # the constant takes it up; without this the inverse below loses half its digits
    n, steps = len(y), np.diff(y)
    limit = min(n // 2 - 2, math.ceil(12 * (n / 100) ** 0.25))

    def regression(start, lags):
        design = np.column_stack([y[start:-1], np.ones(n - 1 - start), *[steps[start - k : n - 1 - k] for k in range(1, lags + 1)]])
        beta = np.linalg.lstsq(design, steps[start:], rcond=None)[0]
        rest = steps[start:] - design @ beta
        return beta, rest @ rest, design

    size = n - 1 - limit
    aic = [size * math.log(regression(limit, p)[1] / size) + 2 * (p + 2) for p in range(limit + 1)]
    lags = int(np.argmin(aic))
    beta, sse, design = regression(lags, lags)
    spread = math.sqrt(np.linalg.inv(design.T @ design)[0, 0] * sse / (len(design) - design.shape[1]))
    return beta[0] / spread, lags, len(design), aic


def test_unit_root_matches_one_regression_per_order(weekly):
    rng = np.random.default_rng(8)
    walk = 1e6 + np.cumsum(rng.normal(0, 10, 220))
    wave = 50 * np.sin(np.arange(140)) + np.convolve(rng.normal(0, 5, 143), [1, 0.6, -0.3, 0.2])[:140]
    frame = weekly({"walk": walk, "wave": wave})
    rows = {r.series: r for r in diagnostics.adf_report(frame, ["series"]).collect()}
    orders = diagnostics.unit_root_orders(frame, ["series"]).collect()
    for name, y in (("walk", walk), ("wave", wave)):
        statistic, lags, size, aic = direct_unit_root(y)
        row = rows[name]
        assert (row.lags_used, row.n_obs) == (lags, size) and row.statistic == pytest.approx(statistic, rel=1e-7)
        mine = [r.aic for r in sorted((r for r in orders if r.series == name), key=lambda r: r.lags)]
        assert np.diff(mine) == pytest.approx(np.diff(aic), abs=1e-6)
    whole = diagnostics.adf_report(frame.where("series = 'walk'").drop("series")).collect()
    assert len(whole) == 1 and whole[0].statistic == pytest.approx(rows["walk"].statistic)


def test_decomposition_parts_add_up(weekly):
    y = planted(160)
    for model, combine in (("additive", lambda a, b, c: a + b + c), ("multiplicative", lambda a, b, c: a * b * c)):
        rows = diagnostics.decompose(weekly({"a": y}), ["series"], model=model).orderBy("ds").collect()
        assert sum(r.trend is None for r in rows) == 52
        for r in rows[26:-26]:
            assert combine(r.trend, r.seasonal, r.residual) == pytest.approx(r.observed)
        centre = np.mean([r.seasonal for r in rows[:52]])
        assert centre == pytest.approx(0 if model == "additive" else 1, abs=1e-9)
    short = diagnostics.decompose(weekly({"a": y[:90]}), ["series"]).collect()
    assert all(r.trend is None and r.seasonal is None for r in short)
    strong = diagnostics.strength(diagnostics.decompose(weekly({"a": y}), ["series"]), ["series"]).first()
    assert strong.seasonal_strength > 0.98 and strong.trend_strength > 0.9


def test_autocorrelation_against_direct_sums_and_toeplitz(weekly):
    y = planted(120, seed=3, noise=20)
    rows = diagnostics.autocorrelation(weekly({"a": y}), ["series"], nlags=70).orderBy("lag").collect()
    d = y - y.mean()
    acf = [d[: 120 - k] @ d[k:] / (d @ d) for k in range(71)]
    assert [r.acf for r in rows] == pytest.approx(acf)
    for k in (1, 2, 5):
        rho = [acf[i] * 120 / (120 - i) for i in range(k + 1)]
        matrix = [[rho[abs(i - j)] for j in range(k)] for i in range(k)]
        assert rows[k].pacf == pytest.approx(np.linalg.solve(matrix, rho[1:])[-1])
    assert rows[59].pacf is not None and rows[60].pacf is None


def test_unit_root_separates_noise_from_a_walk(weekly):
    rng = np.random.default_rng(5)
    noise, walk = rng.normal(0, 1, 300), np.cumsum(rng.normal(0, 1, 300))
    rows = {r.series: r for r in diagnostics.adf_report(weekly({"noise": noise, "walk": walk, "flat": [1.0] * 40, "tiny": [1, 2]}), ["series"]).collect()}
    assert rows["noise"].stationary and rows["noise"].p_value < 0.001
    assert not rows["walk"].stationary
    assert rows["flat"].status == "constant" and rows["tiny"].status == "short_history"


def test_suitability_report_has_one_row_per_series(weekly):
    y = planted(160)
    report = diagnostics.suitability_report(weekly({"a": y, "b": y[:60]}), ["series"])
    rows = {r.series: r for r in report.collect()}
    assert rows["a"].regular_grid and rows["a"].step_days == 7 and rows["a"].cycles == pytest.approx(160 / 52)
    assert rows["b"].seasonal_strength is None
    whole = diagnostics.suitability_report(weekly({"a": y}).drop("series"))
    assert whole.count() == 1 and "_all" not in whole.columns


def test_smoothing_known_answer(weekly):
    rows = smoothing.simple_smoothing(weekly({"a": [10, 12, 11, 15]}), ["series"], (0.4,)).orderBy("t").collect()
    assert [r.yhat for r in rows] == pytest.approx([10, 10, 10.8, 10.88])


def test_smoothing_does_not_depend_on_bins(weekly, monkeypatch):
    y = list(planted(90, seed=4, noise=30)) + [None, 5.0]
    want, state = [], y[0]
    for i, v in enumerate(y):
        want.append(state)
        state = state if v is None else state + 0.3 * (v - state)
    for width in (256, 7, 1):
        monkeypatch.setattr(smoothing, "BIN_WEEKS", width)
        rows = smoothing.simple_smoothing(weekly({"a": y, None: [1, 2]}), ["series"], (0.3, 1.0)).orderBy("t").collect()
        assert [r.yhat for r in rows if r.series == "a" and r.alpha == 0.3] == pytest.approx(want)
        assert [r.t for r in rows if r.series == "a" and r.alpha == 0.3] == list(range(92))
        assert [r.yhat for r in rows if r.series is None] == [1, 1, 1, 1]


def test_interpolation_fills_inner_gaps_only_from_known_points(weekly):
    rows = diagnostics.interpolate_gaps(weekly({"a": [None, 1, None, None, 4, None]}), ["series"]).orderBy("ds").collect()
    assert [r.y for r in rows] == pytest.approx([1, 2, 3, 4, 4])


def test_deflate_and_growth(weekly):
    frame = weekly({"a": [100, 110, 120]}).withColumn("cpi", F.col("y") / 50)
    assert [r.real for r in grains.deflate(frame, ["series"]).orderBy("ds").collect()] == pytest.approx([100] * 3)
    assert diagnostics.growth(frame, ["series"]).first().growth_pct == pytest.approx(20)
    assert math.isclose(diagnostics.component_swing(
        diagnostics.decompose(weekly({"a": planted(160)}), ["series"]), ["series"]).first().seasonal_swing, 60, rel_tol=0.1)
