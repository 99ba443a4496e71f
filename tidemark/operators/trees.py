"""Tree ensembles on the feature table: boosting, forests, and the detrended hybrid.

Trees are grown by MLlib; what is added is a stopping rule with patience, the
per-series trend that trees cannot extrapolate, and scoring over dated folds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import forecast_metrics
from tidemark.operators.splits import panel_folds, validation_by_date
from tidemark.runtime import ensure_checkpoint_dir, right_sized, run_parallel

# The shared booster settings.
ROUNDS, DEPTH, RATE, ROW_SHARE, COLUMN_SHARE, PATIENCE, SEED = 400, 6, 0.05, 0.8, 0.8, 50, 42


def assemble(df: DataFrame, features: Sequence[str], label: str = "y") -> DataFrame:
    """Add ``features`` and ``label`` columns for MLlib; rows without a feature or label are not fitted."""
    ready = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return ready.transform(df).withColumn("label", F.col(label).cast("double")).where(F.col("label").isNotNull())


@dataclass
class TreeModel:
    """A fitted ensemble with what its training showed."""

    model: object
    features: list[str]
    rounds: int
    requested: int
    losses: list[float] = field(default_factory=list)

    def predict(self, df: DataFrame, out: str = "yhat") -> DataFrame:
        """All rows of ``df`` with their forecast, NULL where a feature is missing."""
        whole = F.lit(True)
        for name in self.features:
            whole = whole & F.col(name).isNotNull()
        filled = {f"_in_{k}": F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for k, name in enumerate(self.features)}
        ready = VectorAssembler(inputCols=list(filled), outputCol="features", handleInvalid="keep").transform(df.withColumns(filled))
        scored = self.model.transform(ready)
        return scored.withColumn(out, F.when(whole, F.col("prediction"))).drop("features", "prediction", *filled)

    def importance(self, session) -> DataFrame:
        """Share of each feature, largest first."""
        rows = [(f, float(v)) for f, v in zip(self.features, self.model.featureImportances.toArray())]
        return session.createDataFrame(rows, "feature STRING, importance DOUBLE").orderBy(
            F.col("importance").desc(), "feature"
        )

    def training_report(self, session) -> DataFrame:
        """Trees asked for, trees used, and the share of the budget."""
        row = [(self.requested, self.rounds, self.rounds / self.requested)]
        return session.createDataFrame(row, "requested INT, used INT, share DOUBLE")


def _booster(rounds: int, depth: int, rate: float, rows: float, columns: float, seed: int) -> GBTRegressor:
    return GBTRegressor(
        maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
        featureSubsetStrategy=str(columns), seed=seed, checkpointInterval=10,
    )


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Best round so far (1-based), and whether patience has run out after it."""
    best = min(range(len(losses)), key=losses.__getitem__)
    return best + 1, len(losses) - 1 - best >= patience


def first_rounds(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The ensemble after ``rounds`` rounds: its first trees with their weights, nothing is fitted again."""
    if rounds >= model.getNumTrees:
        return model
    inner, spark = model._java_obj, SparkSession.active()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = inner.trees()[i], float(model.treeWeights[i])
    cut = jvm.org.apache.spark.ml.regression.GBTRegressionModel(model.uid, trees, weights, inner.numFeatures())
    return model._copyValues(GBTRegressionModel(inner.copyValues(cut, jvm.org.apache.spark.ml.param.ParamMap.empty())))


def fit_boosted(
    train: DataFrame,
    features: Sequence[str],
    label: str = "y",
    validation: str | None = None,
    patience: int = PATIENCE,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    row_share: float = ROW_SHARE,
    column_share: float = COLUMN_SHARE,
    seed: int = SEED,
) -> TreeModel:
    """Boosted trees, stopped ``patience`` rounds after the validation error turns.

    ``validation`` names a flag column; flagged rows are watched, not fitted.
    The budget is grown in doubling stages and the error of every round read
    from the fitted ensemble, so training ends shortly after the turn; the model
    returned is the ensemble's first trees up to the best round.
    """
    ensure_checkpoint_dir(train.sparkSession)
    features = list(features)
    columns = [*features, label] + ([validation] if validation else [])
    ready = right_sized(assemble(train.select(*dict.fromkeys(columns)), features, label))
    settings = (depth, rate, row_share, column_share, seed)
    try:
        if validation is None:
            return TreeModel(_booster(rounds, *settings).fit(ready.select("features", "label")), features, rounds, rounds)
        fit_on = ready.filter(~F.col(validation)).select("features", "label")
        watch = ready.filter(F.col(validation)).select("features", "label")
        stage = min(rounds, max(2 * patience, 16))
        while True:
            model = _booster(stage, *settings).fit(fit_on)
            losses = list(model.evaluateEachIteration(watch, "squared"))
            best, done = best_round(losses, patience)
            if done or stage >= rounds:
                break
            stage = min(rounds, stage * 2)
        return TreeModel(first_rounds(model, best), features, best, rounds, losses)
    finally:
        ready.unpersist()


def fit_forest(
    train: DataFrame, features: Sequence[str], label: str = "y", trees: int = 300, depth: int = 12,
    seed: int = SEED,
) -> TreeModel:
    """Independent trees on bootstrap samples with all features, averaged."""
    ready = right_sized(assemble(train.select(*features, label), features, label).select("features", "label"))
    try:
        model = RandomForestRegressor(
            numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=seed
        ).fit(ready)
    finally:
        ready.unpersist()
    return TreeModel(model, list(features), trees, trees)


def group_trends(train: DataFrame, group: Sequence[str] = (), y: str = "y", t: str = "t") -> DataFrame:
    """Straight line per group: slope and intercept against the counter."""
    x = F.col(t).cast("double")
    return train.groupBy(*group).agg(
        F.regr_slope(F.col(y), x).alias("trend_slope"), F.regr_intercept(F.col(y), x).alias("trend_intercept")
    )


def add_trend(df: DataFrame, trends: DataFrame, group: Sequence[str] = (), t: str = "t") -> DataFrame:
    """The line of each row's group at the row's counter, as column ``trend``.

    A group without a line, as it is new or has one point only, gets the mean
    of the lines of the others.
    """
    if group:
        mean = trends.select(F.struct(F.avg("trend_slope").alias("slope"), F.avg("trend_intercept").alias("intercept"))).scalar()
        joined = df.join(trends, list(group), "left").withColumn("_mean", mean)
        known = F.col("trend_slope").isNotNull()
        joined = joined.withColumns({
            "trend_intercept": F.when(known, F.col("trend_intercept")).otherwise(F.col("_mean.intercept")),
            "trend_slope": F.coalesce("trend_slope", F.col("_mean.slope")),
        }).drop("_mean")
    else:
        line = trends.select(F.struct("trend_slope", "trend_intercept")).scalar()
        joined = df.withColumn("_line", line).select("*", "_line.trend_slope", "_line.trend_intercept").drop("_line")
    return joined.withColumn(
        "trend", F.col("trend_intercept") + F.col("trend_slope") * F.col(t)
    ).drop("trend_slope", "trend_intercept")


def fit_hybrid(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    group: Sequence[str] = (),
    label: str = "y",
    validation: str | None = None,
    **settings,
) -> tuple[DataFrame, DataFrame]:
    """A line per group for the level, boosted trees for the rest.

    Returns the trends and the test rows with ``yhat``.  The trees stop by the
    same rule as a plain booster when ``validation`` is given.
    """
    trends = group_trends(train, group, label)
    detrended = add_trend(train, trends, group).withColumn("_rest", F.col(label) - F.col("trend"))
    model = fit_boosted(detrended, features, "_rest", validation, **settings)
    scored = model.predict(add_trend(test, trends, group), "_rest")
    return trends, scored.withColumn("yhat", F.col("trend") + F.col("_rest")).drop("_rest", "trend")


def depth_sweep(
    train: DataFrame, test: DataFrame, features: Sequence[str], depths: Sequence[int] = (2, 4, 6, 10),
    validation: str | None = None, label: str = "y", **settings,
) -> DataFrame:
    """Error on fitted and on unseen rows for each tree depth, and the gap."""
    seen = train.filter(~F.col(validation)) if validation else train

    def job(depth: int):
        model = fit_boosted(train, features, label, validation, depth=depth, **settings)
        inside, outside = (
            forecast_metrics(model.predict(part).withColumn("depth", F.lit(depth)), ["depth"], y=label).first()["mape"]
            for part in (seen, test)
        )
        return depth, inside, outside, outside - inside

    rows = run_parallel(train.sparkSession, [lambda d=d: job(d) for d in depths])
    return train.sparkSession.createDataFrame(rows, "depth INT, train_mape DOUBLE, test_mape DOUBLE, gap DOUBLE")


def score_panel(
    panel: DataFrame,
    features: Sequence[str],
    hybrid: bool = False,
    group: Sequence[str] = ("Store",),
    folds: int = 3,
    **settings,
) -> DataFrame:
    """Errors per fold for one feature set, plain or detrended.

    The features of a test row use the actual weeks before it, so these are
    one-step forecasts, and are labelled so.
    """
    marked = right_sized(panel_folds(panel, folds))

    def job(fold: int) -> DataFrame:
        rows = marked.filter(F.col("fold") == fold)
        train = validation_by_date(rows.filter(~F.col("is_test")))
        test = rows.filter("is_test")
        if hybrid:
            _, predicted = fit_hybrid(train, test, features, group, validation="is_val", **settings)
        else:
            predicted = fit_boosted(train, features, validation="is_val", **settings).predict(test)
        return forecast_metrics(predicted, ["fold"])

    try:
        tables = run_parallel(
            panel.sparkSession, [lambda f=f: job(f).collect()[0] for f in range(1, folds + 1)]
        )
    finally:
        marked.unpersist()
    # One measured row per fold.
    fields = "fold INT, n BIGINT, mae DOUBLE, mse DOUBLE, rmse DOUBLE, mape DOUBLE, r2 DOUBLE"
    return panel.sparkSession.createDataFrame([tuple(r) for r in tables], fields).withColumn(
        "horizon_kind", F.lit("one_step")
    )
