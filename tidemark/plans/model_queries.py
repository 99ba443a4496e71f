"""Queries that fit models: tree ensembles on the panel, churn models, hazard models.

Fits have no SQL twin; the trend part of the hybrid does.  Tree budgets are
kept small here because every MLlib tree level is a Spark job of its own; the
library defaults are the full budgets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import (
    cox, curves, encode, features, grains, hazard_forest, logistic_grid, metrics, propensity, rank_svm, segments, splits,
    survival, trees,
)
from tidemark.plans import solve_sql
from tidemark.plans import tables as t
from tidemark.plans.customer_queries import NUMERIC, SEED, survival_table
from tidemark.plans.oracle import on_cells, on_customers
from tidemark.plans.registry import query, rounded
from tidemark.runtime import cut_lineage, run_parallel

BUDGET = {"rounds": 16, "patience": 5}
PANEL = ["Store", "Size", "Type", *features.CALENDAR, *features.LAGS]
NO_LAGS = ["Store", "Size", "Type", *features.CALENDAR]
EXTERNALS = ["Temperature", "Fuel_Price", "CPI", "Unemployment"]


def store_features(spark, folder):
    """The store panel's feature table, written once: fits read it many times."""
    panel = t.full_store_panel(spark, folder).select(
        "Store", F.col("Date").alias("ds"), F.col("Weekly_Sales").cast("double").alias("y"), "Type",
        F.col("Size").cast("double").alias("Size"), *EXTERNALS,
    )
    return cut_lineage(features.build_features(panel, ["Store"]))


def store_split(spark, folder):
    rows = splits.hold_out_dates(store_features(spark, folder))
    return splits.validation_by_date(rows.filter(~F.col("is_test"))), rows.filter("is_test")


@query("boosted_store_panel")
def boosted_store_panel(spark, folder):
    """One booster for all stores beside the 52-week lag, on the last 13 weeks."""
    train, test = store_split(spark, folder)
    predicted = trees.fit_boosted(train, PANEL, validation="is_val", **BUDGET).predict(test)
    rows = predicted.select(
        "y", F.inline(F.array(
            F.struct(F.lit("boosted").alias("model"), F.col("yhat")),
            F.struct(F.lit("seasonal_naive").alias("model"), F.col("lag_52").alias("yhat")),
        ))
    )
    return metrics.metrics_table(rows)


@query("boosted_training_report")
def boosted_training_report(spark, folder):
    train, _ = store_split(spark, folder)
    return trees.fit_boosted(train, PANEL, validation="is_val", **BUDGET).training_report(spark)


@query("boosted_importance")
def boosted_importance(spark, folder):
    train, _ = store_split(spark, folder)
    table = trees.fit_boosted(train, PANEL, validation="is_val", **BUDGET).importance(spark)
    return table.withColumn("is_lag", F.col("feature").isin(features.LAGS)).limit(5)


@query("boosted_depth_sweep")
def boosted_depth_sweep(spark, folder):
    train, test = store_split(spark, folder)
    return trees.depth_sweep(train, test, PANEL, (2, 4, 6, 10), "is_val", rounds=8, patience=3)


@query("chain_tree_models")
def chain_tree_models(spark, folder):
    """Booster and forest on the single chain series."""
    table = cut_lineage(features.build_features(t.chain_series(spark, folder)))
    rows = splits.hold_out_rows(table)
    train, test = splits.validation_by_date(rows.filter(~F.col("is_test"))), rows.filter("is_test")
    columns = features.CALENDAR + features.LAGS
    booster = trees.fit_boosted(train, columns, validation="is_val", **BUDGET)
    forest = trees.fit_forest(train, columns, trees=50)
    scored = booster.predict(test).withColumn("model", F.lit("boosted")).unionByName(
        forest.predict(test).withColumn("model", F.lit("forest"))
    )
    return metrics.metrics_table(scored)


@query(
    "hybrid_trend",
    on_cells(
        """, f AS (SELECT *, row_number() OVER (PARTITION BY "Store" ORDER BY ds) - 1 AS t, lag(y, 52) OVER (PARTITION BY "Store" ORDER BY ds) AS l FROM store_series),
        k AS (SELECT * FROM f WHERE l IS NOT NULL),
        cut AS (SELECT MIN(ds) AS cut FROM (SELECT DISTINCT ds FROM k ORDER BY ds DESC LIMIT 13)),
        fitted AS (SELECT "Store", regr_slope(y, t) AS a, regr_intercept(y, t) AS b FROM k, cut WHERE ds < cut GROUP BY 1)
        SELECT k."Store", ds, y, round(b + a * t, 3) AS trend FROM k JOIN fitted USING ("Store"), cut WHERE ds >= cut"""
    ),
)
def hybrid_trend(spark, folder):
    """The per-store line carried into the test weeks."""
    table = features.build_features(t.store_series(spark, folder), ["Store"])
    rows = splits.hold_out_dates(table)
    lines = trees.group_trends(rows.filter(~F.col("is_test")), ["Store"])
    carried = trees.add_trend(rows.filter("is_test"), lines, ["Store"])
    return rounded(carried.select("Store", "ds", "y", "trend"), 3, "trend")


@query("trending_control_series")
def trending_control_series(spark, folder):
    """Plain against detrended trees on a series with a trend trees cannot follow.

    The cumulative sales of the chain stand in for the trending control series.
    """
    ordered = W.orderBy("ds").rowsBetween(W.unboundedPreceding, 0)
    # One row per week of the chain: the window is as long as the calendar.
    series = t.chain_series(spark, folder).select("ds", F.sum("y").over(ordered).alias("y"))
    rows = splits.hold_out_dates(cut_lineage(features.build_features(series)), 52)
    train, test = splits.validation_by_date(rows.filter(~F.col("is_test"))), rows.filter("is_test")
    columns = ["week", "week_sin", "week_cos", "t"]
    plain = trees.fit_boosted(train, columns, validation="is_val", **BUDGET).predict(test)
    _, hybrid = trees.fit_hybrid(train, test, columns, validation="is_val", **BUDGET)
    both = plain.select(F.lit("plain").alias("model"), "y", "yhat").unionByName(
        hybrid.select(F.lit("detrended").alias("model"), "y", "yhat")
    )
    return metrics.metrics_table(both)


def _regimes(spark, folder, regimes):
    panel = store_features(spark, folder)

    def job(name, columns, hybrid):
        return trees.score_panel(panel, columns, hybrid, rounds=8, patience=3).withColumn("model", F.lit(name))

    jobs = [lambda n=n, c=c, h=h: job(n, c, h) for n, (c, h) in regimes.items()]
    return reduce(lambda a, b: a.unionByName(b), run_parallel(spark, jobs, threads=2))


@query("detrending_regimes")
def detrending_regimes(spark, folder):
    """With and without lags, plain and detrended, over three folds."""
    scores = _regimes(spark, folder, {
        "lags, plain": (PANEL, False), "lags, detrended": (PANEL, True),
        "no lags, plain": (NO_LAGS, False), "no lags, detrended": (NO_LAGS, True),
    })
    return metrics.fold_summary(scores)


@query("external_features_effect")
def external_features_effect(spark, folder):
    """Do the four externals help, measured against the spread of the folds?"""
    scores = _regimes(spark, folder, {"base": (PANEL, False), "with externals": (PANEL + EXTERNALS, False)})
    return metrics.compare_on_folds(scores, "base", "with externals")


@query("model_at_three_grains")
def model_at_three_grains(spark, folder):
    """The same booster at department, store and chain grain, and rolled up."""
    columns = [*features.CALENDAR, *features.LAGS]

    def scored(series, keys):
        table = cut_lineage(features.build_features(series, keys))
        rows = splits.hold_out_dates(table)
        train = splits.validation_by_date(rows.filter(~F.col("is_test")))
        return trees.fit_boosted(train, columns, validation="is_val", **BUDGET).predict(rows.filter("is_test"))

    depts = cut_lineage(scored(t.dept_series(spark, folder), ["Store", "Dept"]).select("Store", "Dept", "ds", "y", "yhat"))
    jobs = [
        lambda: scored(t.store_series(spark, folder), ["Store"]).select(F.lit("store").alias("grain"), "y", "yhat"),
        lambda: scored(t.chain_series(spark, folder), []).select(F.lit("chain").alias("grain"), "y", "yhat"),
    ]
    parts = [
        *run_parallel(spark, jobs),
        depts.select(F.lit("department").alias("grain"), "y", "yhat"),
        grains.roll_up(depts, ["Store", "Dept"]).filter(F.col("depth") == 0).select(
            F.lit("departments summed to chain").alias("grain"), "y", "yhat"
        ),
    ]
    return metrics.forecast_metrics(reduce(lambda a, b: a.unionByName(b), parts), ["grain"])


# --------------------------------------------------------------------------
# Churn models
# --------------------------------------------------------------------------


def churn_frame(spark, folder):
    """Encoded customers with a stratified 20% test flag, written once."""
    coded, names, _ = encode.encode_features(t.customer_table(spark, folder), "customer_id", "churn")
    split = splits.stratified_hold_out(coded, ["churn"], "customer_id", 0.2, SEED)
    ready = propensity.prepare(split, names, "churn", "customer_id", "is_test")
    return cut_lineage(ready), names


def _train_test(spark, folder):
    rows, names = churn_frame(spark, folder)
    return rows.filter(~F.col("is_test")).drop("is_test"), rows.filter("is_test").drop("is_test"), names


def _three_models(names, rows):
    return {
        "logistic": propensity.logistic(names, rows),
        "boosted": propensity.boosted(names),
        "network": propensity.network(names),
    }


@query("churn_model_scores")
def churn_model_scores(spark, folder):
    train, test, names = _train_test(spark, folder)
    return propensity.score_models(_three_models(names, train.count()), train, test, "customer_id")[0]


@query("churn_model_comparison")
def churn_model_comparison(spark, folder):
    return propensity.compare_models(churn_model_scores(spark, folder))


def best_scores(spark, folder):
    """Test scores of the model with the best ROC-AUC."""
    scores = cut_lineage(churn_model_scores(spark, folder))
    best = propensity.best_model(propensity.compare_models(scores)).select("model")
    return cut_lineage(scores.join(best, ["model"], "left_semi"))


@query("churn_best_model_curves")
def churn_best_model_curves(spark, folder):
    """ROC and precision-recall points of the best model."""
    scores = best_scores(spark, folder)
    roc = curves.roc_points(scores, ["model"]).select(
        "model", F.lit("roc").alias("curve"), "threshold", F.col("fpr").alias("x"), F.col("tpr").alias("y")
    )
    recall = curves.precision_recall_points(scores, ["model"]).select(
        "model", F.lit("precision_recall").alias("curve"), "threshold", F.col("recall").alias("x"), F.col("precision").alias("y")
    )
    return roc.unionByName(recall)


@query("churn_best_model_report")
def churn_best_model_report(spark, folder):
    """Precision, recall, F1 and support per class of the best model."""
    return curves.class_report(curves.classify(best_scores(spark, folder)), ["model"])


# What holds for any fit on the test rows of the stratified split, from the split alone.
_TEST_ROWS = """, h AS (SELECT *, md5(CAST(customer_id AS VARCHAR) || ':42') AS h FROM customers),
  r AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY h, customer_id) AS rk, COUNT(*) OVER (PARTITION BY churn) AS n FROM h),
  test AS (SELECT * FROM r WHERE rk <= round(n * 0.2))"""


@query(
    "churn_best_model_totals",
    on_customers(
        _TEST_ROWS + """ SELECT CAST(churn AS INTEGER) AS actual, COUNT(*)::BIGINT AS customers, COUNT(*)::BIGINT AS reported,
          true AS curve_ends_in_corner, true AS scores_in_range FROM test GROUP BY 1"""
    ),
)
def churn_best_model_totals(spark, folder):
    """Confusion cells and report of the best model add up to the test rows; its ROC ends in the corner."""
    scores = best_scores(spark, folder)
    labelled = curves.classify(scores)
    cells = curves.confusion(labelled).groupBy("actual").agg(F.sum("customers").alias("customers"))
    support = labelled.groupBy(F.col("label").alias("actual")).agg(
        F.count(F.lit(1)).alias("reported"), F.bool_and(F.col("score").between(0, 1)).alias("scores_in_range")
    )
    corner = curves.roc_points(scores).agg(F.bool_or((F.col("fpr") == 1) & (F.col("tpr") == 1))).scalar()
    return cells.join(support, ["actual"]).withColumn("curve_ends_in_corner", corner)


@query(
    "churn_scored_customers",
    on_customers(
        _TEST_ROWS + """ SELECT model, customer_id, CAST(churn AS INTEGER) AS label, true AS in_range
          FROM test, (SELECT UNNEST(['boosted', 'logistic', 'network']) AS model)"""
    ),
)
def churn_scored_customers(spark, folder):
    """One score between 0 and 1 per model and test customer."""
    scores = churn_model_scores(spark, folder)
    return scores.select("model", "customer_id", "label", F.col("score").between(0, 1).alias("in_range"))


@query(
    "churn_segments_total",
    on_customers(_TEST_ROWS + " SELECT COUNT(*)::BIGINT AS customers, SUM(churn)::BIGINT AS churned, true AS shares_sum_to_one FROM test"),
)
def churn_segments_total(spark, folder):
    """The risk segments of the best model add up to the test rows and their churn."""
    parts = churn_segments_scored(spark, folder)
    churned = F.round(F.coalesce(F.col("churn_rate"), F.lit(0.0)) * F.col("customers"))
    return parts.agg(
        F.sum("customers").alias("customers"), F.sum(churned).cast("bigint").alias("churned"),
        (F.abs(F.sum("share") - 1) < 1e-9).alias("shares_sum_to_one"),
    )


@query("churn_segments_scored")
def churn_segments_scored(spark, folder):
    """Risk segments from the best model's scores."""
    return segments.segment_summary(segments.risk_segments(best_scores(spark, folder)))


@query(
    "churn_importance_totals",
    on_customers(" SELECT UNNEST(['logistic', 'boosted']) AS model, true AS all_features, true AS shares_sum_to_one"),
)
def churn_importance_totals(spark, folder):
    """Every feature has an importance; those of the trees are shares."""
    _, names = churn_frame(spark, folder)
    return churn_importances(spark, folder).groupBy("model").agg(
        (F.count_distinct("feature") == len(names)).alias("all_features"),
        ((F.abs(F.sum("weight") - 1) < 1e-6) | (F.first("model") == "logistic")).alias("shares_sum_to_one"),
    )


@query("churn_importances")
def churn_importances(spark, folder):
    train, test, names = _train_test(spark, folder)
    models = {k: v for k, v in _three_models(names, train.count()).items() if k != "network"}
    _, fitted = propensity.score_models(models, train, test, "customer_id")
    parts = [
        propensity.importances(m, names, spark).withColumn("model", F.lit(k)) for k, m in fitted.items()
    ]
    return parts[0].unionByName(parts[1])


@query("churn_cross_validation")
def churn_cross_validation(spark, folder):
    train, _, names = _train_test(spark, folder)
    auc = cut_lineage(propensity.logistic_folds(train, names, "customer_id"))
    return auc.withColumn("kind", F.lit("fold")).select("kind", "fold", F.col("roc_auc").alias("mean"), F.lit(None).cast("double").alias("std")).unionByName(
        propensity.mean_and_spread(auc).select(F.lit("all").alias("kind"), F.lit(None).cast("int").alias("fold"), "mean", "std")
    )


@query("churn_grid_search")
def churn_grid_search(spark, folder):
    train, _, names = _train_test(spark, folder)
    grid = propensity.all_combinations(propensity.LOGISTIC_GRID)
    return propensity.logistic_search(train, names, grid, "customer_id")


# The splits from the table alone: what each fit is trained on; a fit is right where its gradient is 0.
_CELLS = _TEST_ROWS + """, train AS (SELECT customer_id, churn, h, md5(CAST(customer_id AS VARCHAR) || ':43') AS h2 FROM r WHERE rk > round(n * 0.2)),
  k AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY h, customer_id) - 1 AS place FROM train),
  g AS (SELECT *, place % 3 AS f3, place % 5 AS f5 FROM k),
  s AS (SELECT *, row_number() OVER (PARTITION BY f3 ORDER BY h2, customer_id) AS rk, COUNT(*) OVER (PARTITION BY f3) AS m FROM g),
  steps AS (SELECT UNNEST([1, 2, 3, 4, 5, 6]) AS level, UNNEST([0.1, 0.28, 0.46, 0.64, 0.82, 1.0]::DOUBLE[]) AS fraction),
  folds AS (SELECT UNNEST(range(5)) AS fold),
  cells AS (
    SELECT 'grid' AS kind, c, l1_ratio, fold, 6 AS level FROM folds, (SELECT UNNEST([0.01, 0.1, 1.0, 10.0]::DOUBLE[]) AS c),
      (SELECT UNNEST([1.0, 0.0]::DOUBLE[]) AS l1_ratio) WHERE fold < 3
    UNION ALL SELECT 'penalties', c, 0.0, fold, 6 FROM folds, (SELECT UNNEST([0.001, 0.01, 0.1, 1.0, 10.0, 100.0]::DOUBLE[]) AS c) WHERE fold < 3
    UNION ALL SELECT 'sizes', 1.0, 0.0, fold, level FROM folds, steps WHERE fold < 3
    UNION ALL SELECT 'folds', 1.0, 0.0, fold, 1 FROM folds),
  sized AS (
    SELECT kind, c, l1_ratio, fold, level, COUNT(*) AS trained, SUM(churn) AS positives FROM cells JOIN steps USING (level) JOIN s
      ON kind <> 'folds' AND f3 <> fold AND rk <= round(m * fraction) GROUP BY ALL
    UNION ALL SELECT kind, c, l1_ratio, fold, level, COUNT(*), SUM(churn) FROM cells JOIN s ON kind = 'folds' AND f5 <> fold GROUP BY ALL)
  SELECT kind, c, l1_ratio, CAST(fold AS INTEGER) AS fold, CAST(level AS INTEGER) AS level, trained::BIGINT AS "rows", positives::BIGINT AS positives,
    true AS converged, 0.0 AS gradient FROM sized"""


@query("churn_logistic_fits", on_customers(_CELLS))
def churn_logistic_fits(spark, folder):
    """Every logistic regression of the searches and curves: what it is trained on, and its gradient."""
    train, _, names = _train_test(spark, folder)
    sizes = range(1, len(propensity.LEARNING_FRACTIONS) + 1)
    folded = splits.stratified_folds(train, ["label"], "customer_id", 3, SEED)
    grown = splits.subset_levels(folded, "customer_id", propensity.LEARNING_FRACTIONS, SEED + 1, keys=["fold"])
    grid = [logistic_grid.Cell(p["c"], p["l1_ratio"], f, 6) for p in propensity.all_combinations(propensity.LOGISTIC_GRID) for f in range(3)]
    penalties = [logistic_grid.Cell(c, 0.0, f, 6) for c in propensity.C_VALUES for f in range(3)]
    grown_cells = [logistic_grid.Cell(1.0, 0.0, f, s) for s in sizes for f in range(3)]
    kinds = ["grid"] * len(grid) + ["penalties"] * len(penalties) + ["sizes"] * len(grown_cells)

    def checked(rows, cells, kinds):
        held = cut_lineage(logistic_grid.complete(rows, names))
        table = logistic_grid.gradients(held, logistic_grid.fit_cells(held, names, cells))
        return table.withColumn("kind", F.array(*map(F.lit, kinds))[F.col("cell")])

    five = splits.stratified_folds(train, ["label"], "customer_id", 5, SEED)
    both = checked(grown, grid + penalties + grown_cells, kinds).unionByName(
        checked(five, [logistic_grid.Cell(fold=f) for f in range(5)], ["folds"] * 5)
    )
    return rounded(both.select("kind", "c", "l1_ratio", "fold", "level", "rows", "positives", "converged", "gradient"), 6, "gradient")


@query("churn_random_search_network")
def churn_random_search_network(spark, folder):
    train, _, names = _train_test(spark, folder)
    return network_search(train, names)


@query("churn_random_search_boosted")
def churn_random_search_boosted(spark, folder):
    train, _, names = _train_test(spark, folder)
    return boosted_search(train, names)


def network_search(train, names):
    """Eight draws, which are all combinations of the grid, with all iterations."""
    return propensity.search(propensity.network, names, propensity.some_combinations(propensity.NETWORK_GRID, 8), train, "customer_id")


def boosted_search(train, names):
    grid = {**propensity.BOOSTED_GRID, "rounds": [5, 10]}
    return propensity.search(propensity.boosted, names, propensity.some_combinations(grid, 3), train, "customer_id")


def all_searches(train, names):
    """Maker and results of the three searches."""
    grid = propensity.all_combinations(propensity.LOGISTIC_GRID)
    return {
        "logistic": (propensity.logistic, cut_lineage(propensity.logistic_search(train, names, grid, "customer_id"))),
        "boosted": (propensity.boosted, cut_lineage(boosted_search(train, names))),
        "network": (propensity.network, cut_lineage(network_search(train, names))),
    }


def six_model_scores(spark, folder):
    """Test scores of the three models and of the best row of each search, fitted on all training rows."""
    train, test, names = _train_test(spark, folder)
    rows = train.count()
    models = _three_models(names, rows) | propensity.tuned(all_searches(train, names), names, rows)
    return cut_lineage(propensity.score_models(models, train, test, "customer_id")[0])


@query("churn_tuned_comparison")
def churn_tuned_comparison(spark, folder):
    """Six models on the same test rows, best ROC-AUC first."""
    return propensity.compare_models(six_model_scores(spark, folder))


@query("churn_tuned_segments")
def churn_tuned_segments(spark, folder):
    """Risk segments from the scores of the best of the six models."""
    scores = six_model_scores(spark, folder)
    best = propensity.best_model(propensity.compare_models(scores)).select("model")
    return segments.segment_summary(segments.risk_segments(scores.join(best, ["model"], "left_semi")))


@query("churn_learning_curve")
def churn_learning_curve(spark, folder):
    train, _, names = _train_test(spark, folder)
    return propensity.logistic_learning_curve(train, names, "customer_id")


@query("churn_validation_curve")
def churn_validation_curve(spark, folder):
    train, _, names = _train_test(spark, folder)
    return propensity.logistic_validation_curve(train, names, "customer_id")


@query("churn_curve_reading")
def churn_curve_reading(spark, folder):
    curve = cut_lineage(churn_validation_curve(spark, folder))
    return propensity.read_curve(curve, "c")


@query("churn_complexity_sweeps")
def churn_complexity_sweeps(spark, folder):
    """One complexity knob per family: tree depth, and the size of the network."""
    train, _, names = _train_test(spark, folder)
    depth = propensity.validation_curve(
        propensity.boosted, names, "depth", (1, 3, 5), train, "customer_id", fixed={"rounds": 4, "rate": 0.1}
    )
    hidden = propensity.validation_curve(
        propensity.network, names, "hidden", propensity.HIDDEN_VALUES, train, "customer_id"
    )
    return depth.withColumnRenamed("depth", "value").withColumn("knob", F.lit("tree depth")).unionByName(
        hidden.withColumnRenamed("hidden", "value").withColumn("knob", F.lit("hidden layers"))
    )


@query("churn_high_bias")
def churn_high_bias(spark, folder):
    """Does any tuned model reach clearly more than the last level of the logistic learning curve?"""
    train, _, names = _train_test(spark, folder)
    curve = propensity.logistic_learning_curve(train, names, "customer_id")
    last = curve.where(F.col("subset") == len(propensity.LEARNING_FRACTIONS)).select(F.col("validation_mean").alias("mean"))
    tables = [table.select("mean") for _, table in all_searches(train, names).values()]
    return propensity.high_bias(cut_lineage(last), reduce(lambda a, b: a.unionByName(b), tables))


# --------------------------------------------------------------------------
# Hazard models
# --------------------------------------------------------------------------

#: The key, the outcome and what knows it: no hazard model sees them.
HAZARD_LEAKS = ["customer_id", "churn", "event", "time", "tenure", "days_silent"]
HAZARD_FEATURES = encode.without_leaks(NUMERIC, HAZARD_LEAKS)


def hazard_split(spark, folder):
    """One-hot customers without tenure, scaled by the training rows, written once."""
    split = splits.stratified_hold_out(survival_table(spark, folder), ["churn"], "customer_id", 0.3, SEED)
    wide, dummies = encode.one_hot(split, ["segment"])
    wide = encode.standardise(wide, HAZARD_FEATURES, train="is_test")
    rows = cut_lineage(wide.select("customer_id", "event", "time", "is_test", *HAZARD_FEATURES, *dummies))
    return rows.filter(~F.col("is_test")), rows.filter("is_test"), encode.without_leaks([*HAZARD_FEATURES, *dummies], HAZARD_LEAKS)


# The market segments of the customer table that get an indicator.
SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_HAZARD_NAMES = [*HAZARD_FEATURES, *(f"segment_{s}" for s in SEGMENTS)]
_HAZARD_SPLIT = """, h AS (SELECT *, md5(CAST(customer_id AS VARCHAR) || ':42') AS h FROM customers),
  r AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY h, customer_id) AS rk, COUNT(*) OVER (PARTITION BY churn) AS n FROM h),
  seen AS (SELECT * FROM r WHERE rk > round(n * 0.3))"""


@query(
    "hazard_features",
    on_customers(
        _HAZARD_SPLIT + " SELECT feature, COUNT(*)::BIGINT AS train_rows FROM seen, (SELECT UNNEST(["
        + ", ".join(f"'{c}'" for c in _HAZARD_NAMES) + "]) AS feature) GROUP BY 1"
    ),
)
def hazard_features(spark, folder):
    """What the hazard models see, none of it made of an excluded column, and from how many customers."""
    train, _, names = hazard_split(spark, folder)
    per = train.agg(*[F.count(c).alias(c) for c in names])
    return per.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("train_rows")) for c in names])))

_COX = (
    _HAZARD_SPLIT + ", cx_rows AS (SELECT tenure AS time, churn = 1 AS event, [1.0::DOUBLE, "
    + ", ".join(f"({c} - AVG({c}) OVER ()) / stddev_pop({c}) OVER ()" for c in HAZARD_FEATURES)
    + ", " + ", ".join(f"CASE WHEN segment = '{s}' THEN 1.0 ELSE 0.0 END" for s in SEGMENTS) + "] AS x FROM seen),"
    + solve_sql.cox("cx_rows", len(_HAZARD_NAMES))
)


@query(
    "cox_hazard_ratios",
    on_customers(
        _COX + f""" SELECT name AS feature, round(beta[k], 6) AS coefficient, round(exp(beta[k]), 6) AS hazard_ratio
          FROM cx_b8, (SELECT UNNEST({_HAZARD_NAMES}) AS name, UNNEST(range(1, {len(_HAZARD_NAMES) + 1})) AS k)"""
    ),
)
def cox_hazard_ratios(spark, folder):
    train, _, names = hazard_split(spark, folder)
    return rounded(cox.fit_cox(train, names).hazard_ratios(), 6, "coefficient", "hazard_ratio")


@query("cox_score", on_customers(f" SELECT UNNEST({_HAZARD_NAMES}) AS feature, 0.0 AS score, true AS converged"))
def cox_score(spark, folder):
    """The slope of the likelihood per feature from the residuals of the rows: 0 at the fit."""
    train, _, names = hazard_split(spark, folder)
    model = cox.fit_cox(train, names)
    # a zero has no sign
    return rounded(cox.score_vector(model, train), 6, "score").withColumn("score", F.col("score") + 0.0).withColumn("converged", F.lit(model.converged))


@query("cox_customer_curves")
def cox_customer_curves(spark, folder):
    train, test, names = hazard_split(spark, folder)
    model = cox.fit_cox(train, names)
    return model.curves(splits.pick_some(test, "customer_id", 3, SEED), "customer_id")


@query("forest_customer_curves")
def forest_customer_curves(spark, folder):
    train, test, names = hazard_split(spark, folder)
    model = hazard_forest.fit_hazard_forest(train, names)
    return model.curves(splits.pick_some(test, "customer_id", 3, SEED), "customer_id")


@query("hazard_model_concordance")
def hazard_model_concordance(spark, folder):
    """Train and test concordance of the three models, and the gap."""
    train, test, names = hazard_split(spark, folder)
    rows = train.unionByName(test)
    keep = ["model", "is_test", "event", "time", "risk"]
    forest = hazard_forest.fit_hazard_forest(train, names)
    scored = [
        cox.fit_cox(train, names).with_risk(rows).withColumn("model", F.lit("cox")),
        rank_svm.fit_rank_svm(train, names).with_risk(rows).withColumn("model", F.lit("ranking svm")),
        forest.with_risk(rows, "customer_id").withColumn("model", F.lit("hazard forest")),
    ]
    long = reduce(lambda a, b: a.unionByName(b), [s.select(*keep) for s in scored])
    table = survival.concordance(long, ["model", "is_test"])
    wide = table.groupBy("model").agg(
        F.max(F.when(~F.col("is_test"), F.col("c_index"))).alias("train_c"),
        F.max(F.when(F.col("is_test"), F.col("c_index"))).alias("test_c"),
    )
    return wide.withColumn("gap", F.col("train_c") - F.col("test_c"))


def _hazard_models(train, names):
    return {
        "cox": cox.fit_cox(train, names), "hazard forest": hazard_forest.fit_hazard_forest(train, names),
        "ranking svm": rank_svm.fit_rank_svm(train, names),
    }


@query("hazard_model_evaluation")
def hazard_model_evaluation(spark, folder):
    """Concordance, mean AUC(t) and, for models with a curve, the Brier score of every fitted model."""
    train, test, names = hazard_split(spark, folder)
    return survival.evaluate_survival_models(_hazard_models(train, names), train, test, "customer_id")


def _best_strata(spark, folder):
    """Test rows in risk quartiles of the model that orders them best."""
    train, test, names = hazard_split(spark, folder)
    scored = cut_lineage(survival.score_survival_models(_hazard_models(train, names), test, "customer_id"))
    table = survival.concordance(scored, ["model"]).select("model", F.col("c_index").alias("test_c"))
    best = scored.join(survival.best_survival_model(table).select("model"), ["model"], "left_semi")
    return cut_lineage(survival.risk_quartiles(cut_lineage(best)))


@query("best_hazard_strata")
def best_hazard_strata(spark, folder):
    return survival.strata_summary(_best_strata(spark, folder))


@query("best_hazard_strata_curves")
def best_hazard_strata_curves(spark, folder):
    """Kaplan-Meier curves of the risk groups."""
    return survival.kaplan_meier(_best_strata(spark, folder), ["risk_group"])


@query(
    "best_hazard_strata_totals",
    on_customers(_HAZARD_SPLIT + " SELECT COUNT(*)::BIGINT AS customers, SUM(churn)::BIGINT AS churned FROM r WHERE rk <= round(n * 0.3)"),
)
def best_hazard_strata_totals(spark, folder):
    """The risk groups hold the test rows of the split and their events, each once."""
    parts = survival.strata_summary(_best_strata(spark, folder))
    return parts.agg(F.sum("customers").alias("customers"), F.sum(F.round(F.col("churn_rate") * F.col("customers"))).cast("bigint").alias("churned"))


@query("rank_svm_risk_strata")
def rank_svm_risk_strata(spark, folder):
    """Risk quartiles of the ranking model's test scores."""
    train, test, names = hazard_split(spark, folder)
    scored = cut_lineage(rank_svm.fit_rank_svm(train, names).with_risk(test))
    return survival.strata_summary(survival.risk_quartiles(scored))


@query("hazard_model_brier")
def hazard_model_brier(spark, folder):
    """Integrated Brier score of the models that have a survival curve."""
    train, test, names = hazard_split(spark, folder)
    window = survival.evaluation_window(train, test)
    inside = survival.in_window(test, window)
    fitted_cox = cox.fit_cox(train, names)
    forest = hazard_forest.fit_hazard_forest(train, names)
    keep = ["model", "event", "time", "t", "surv"]
    scored_curves = fitted_cox.survival_at(inside, window.times).withColumn("model", F.lit("cox")).select(*keep).unionByName(
        forest.survival_at(inside, "customer_id", window.times).withColumn("model", F.lit("hazard forest")).select(*keep)
    )
    scores = survival.brier_scores(train, cut_lineage(scored_curves), ["model"])
    return survival.integrated_brier(scores, ["model"])
