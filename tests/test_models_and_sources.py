import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar, encode, grains, propensity, splits
from tidemark.sources import sales_files


@pytest.fixture(scope="module")
def churners(spark):
    rng = np.random.default_rng(0)
    x, z = rng.normal(0, 1, 400), rng.normal(0, 1, 400)
    label = (rng.random(400) < 1 / (1 + np.exp(-2 * x))).astype(int)
    rows = [(i, float(a), float(b), int(c)) for i, (a, b, c) in enumerate(zip(x, z, label))]
    frame = spark.createDataFrame(rows, "id LONG, x DOUBLE, z DOUBLE, churn INT")
    return propensity.prepare(frame, ["x", "z"], "churn", "id").persist()


def test_models_are_compared_on_the_same_rows(spark, churners):
    names = ["x", "z"]
    train, test = churners.filter("id < 300"), churners.filter("id >= 300")
    models = {"logistic": propensity.logistic(names, 300), "boosted": propensity.boosted(names, rounds=5),
              "network": propensity.network(names, hidden=(4,), max_iter=30)}
    scores, fitted = propensity.score_models(models, train, test, "id")
    table = propensity.compare_models(scores).collect()
    assert len(table) == 3 and all(r.roc_auc > 0.7 for r in table)
    top = propensity.importances(fitted["logistic"], names, spark).first()
    assert top.feature == "x" and fitted["boosted"].stages[-1].getNumTrees == 5


def test_cross_validation_and_searches(churners):
    names = ["x", "z"]
    auc = propensity.cross_validate(lambda rows: propensity.logistic(names, rows), churners, "id", folds=3)
    rows = auc.collect()
    assert {r.fold for r in rows} == {0, 1, 2}
    spread = propensity.mean_and_spread(auc).first()
    assert spread["mean"] == pytest.approx(np.mean([r.roc_auc for r in rows]))
    assert spread["std"] == pytest.approx(np.std([r.roc_auc for r in rows]))
    table = propensity.search(propensity.logistic, names, [{"c": 1e-4, "l1_ratio": 1.0}, {"c": 1.0}], churners, "id")
    assert table.first().candidate == "c=1.0"
    assert len(propensity.all_combinations(propensity.BOOSTED_GRID)) == 72
    assert propensity.some_combinations(propensity.BOOSTED_GRID, 10) == propensity.some_combinations(propensity.BOOSTED_GRID, 10)


def test_learning_and_validation_curves(churners):
    names = ["x", "z"]
    curve = propensity.learning_curve(lambda rows: propensity.logistic(names, rows), churners, "id", (0.3, 1.0), folds=2).collect()
    assert {r.subset for r in curve} == {1, 2} and all(r.validation_mean > 0.7 for r in curve)
    sweep = propensity.validation_curve(propensity.logistic, names, "c", (0.1, 1.0), churners, "id", folds=2)
    reading = propensity.read_curve(sweep, "c").first()
    assert reading.flat and reading.best in ("0.1", "1.0")
    low, high = sweep.sparkSession.sql("SELECT 0.8D AS mean"), sweep.sparkSession.sql("SELECT 0.9D AS mean")
    assert propensity.high_bias(low, high).first().high_bias


def test_sales_files_are_joined_cleaned_and_reported(spark, tmp_path):
    (tmp_path / "train.csv").write_text(
        "Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,100.5,FALSE\n1,2,2010-02-05,-3,FALSE\n1,1,2011-11-11,50,TRUE\n")
    (tmp_path / "stores.csv").write_text("Store,Type,Size\n1,A,1000\n")
    (tmp_path / "features.csv").write_text(
        "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday\n"
        "1,2010-02-05,42,2.5,NA,NA,NA,NA,NA,211,8,FALSE\n1,2011-11-11,50,3.1,7,NA,NA,NA,NA,215,8,TRUE\n")
    log = sales_files.load_sales(spark, str(tmp_path))
    assert log.columns.count("IsHoliday") == 1 and log.count() == 3
    report = sales_files.cleaning_report(log).first()
    assert (report.rows_in, report.dropped, report.rows_out, report.weeks, report.series, report.no_promotion) == (3, 1, 2, 2, 1, 1)
    clean = sales_files.clean_sales(log)
    first = sales_files.promotion_coverage(clean, clean).first()
    assert str(first.first_recorded) == "2011-11-11" and first.weeks_without == 1 and first.weeks == 2
    log.write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).filter(F.col("MarkDown1").isNull()).count() == 2


def test_all_lines_and_only_used_columns_are_scanned(spark):
    from tidemark.plans import tables

    folder = "/root/testdata/sf0.001"
    plan = tables.store_series(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not any(f"{kind}(l_shipdate" in plan for kind in ("GreaterThan", "GreaterThanOrEqual", "LessThan", "LessThanOrEqual"))
    assert plan.count("FileScan parquet [l_") == 1
    weekly = tables.weekly_cells(spark, folder)
    assert weekly.agg(F.sum("lines")).first()[0] == tables.table(spark, folder, "lineitem").count()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "l_shipdate" in line)
    assert "l_linenumber" not in scan and "l_tax" not in scan


def test_every_check_belongs_to_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


def test_tuned_models_take_the_parameters_of_the_best_row(spark):
    rows = [("a", 0.7, 0.1, 3, [32]), ("b", 0.9, 0.2, 5, [64, 32]), ("c", 0.9, 0.0, 7, None)]
    table = spark.createDataFrame(rows, "candidate string, mean double, std double, depth int, hidden array<int>")
    seen = []
    made = propensity.tuned({"x": (lambda names, n, **p: seen.append((names, n, p)) or "fit", table)}, ["f"], 9)
    assert made == {"x_tuned": "fit"} and seen == [(["f"], 9, {"depth": 5, "hidden": (64, 32)})]


def test_excluded_columns_are_not_features():
    assert encode.without_leaks(["a", "tenure", "b", "tenures"], ["tenure"]) == ["a", "b", "tenures"]
    with pytest.raises(ValueError, match="tenure_bucket"):
        encode.without_leaks(["a", "tenure_bucket"], ["tenure"])


def test_one_row_per_date_has_a_defined_winner(spark):
    rows = [("2020-01-01", "b", 1), ("2020-01-01", "a", 9), ("2020-01-01", "a", 2), ("2020-01-02", None, 1), ("2020-01-02", "z", None), (None, "q", 1), (None, "q", 1)]
    table = spark.createDataFrame(rows, "ds string, holiday string, n int")
    want = {("2020-01-01", "a", 2), ("2020-01-02", "z", None), (None, "q", 1)}
    assert {tuple(r) for r in calendar.one_per_date(table).collect()} == want
    assert {tuple(r) for r in calendar.one_per_date(table.repartition(5)).collect()} == want
    by_n = {tuple(r) for r in calendar.one_per_date(table, ["n"]).collect()}
    assert by_n == {("2020-01-01", "b", 1), ("2020-01-02", None, 1), (None, "q", 1)}
    assert calendar.one_per_date(table.limit(0)).count() == 0 and calendar.one_per_date(table.select("ds")).count() == 3


def test_prepare_cuts_three_grains_from_one_clean_log(spark):
    fields = "Store int, Dept int, Date date, Weekly_Sales double, IsHoliday boolean, Type string, Size int, Temperature double, Fuel_Price double, CPI double, Unemployment double, MarkDown1 double"
    day = datetime.date(2020, 1, 3)
    rows = [(s, d, day, y, False, "A", 10, 1.0, 2.0, 3.0, 4.0, None) for s, d, y in [(1, 1, 5.0), (1, 2, 7.0), (2, 1, 11.0), (2, 2, -1.0)]]
    chain, stores, depts, clean = grains.prepare(spark.createDataFrame(rows, fields))
    assert [r.Weekly_Sales for r in chain.collect()] == [23.0]
    assert {(r.Store, r.Weekly_Sales) for r in stores.collect()} == {(1, 12.0), (2, 11.0)}
    assert depts.count() == clean.count() == 3


def test_sample_sizes_come_from_the_whole(spark):
    table = spark.range(100).selectExpr("id", "id % 4 = 0 as rare")
    taken = splits.stratified_sample(table, ["rare"], "id", 20).groupBy("rare").count().collect()
    assert {(r.rare, r["count"]) for r in taken} == {(True, 5), (False, 15)}
