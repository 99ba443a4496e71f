"""Churn propensity: model families, cross-validation, tuning, curves.

Estimators are MLlib pipelines; folds are a column, so every fit of a search
reads one cached frame, and fits run side by side from a small thread pool.
Logistic regressions of a search are fitted together (``logistic_grid``), and so
are networks (``network_grid``).  A search keeps counts of scores, which add up;
final models are measured exactly.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import logistic_grid, network_grid
from tidemark.operators.curves import evaluate_scores, ranking_of_counts
from tidemark.operators.logistic_grid import SCORE_DIGITS, Cell
from tidemark.operators.splits import growing_subsets, stratified_folds, subset_levels
from tidemark.runtime import cut_lineage, right_sized, run_parallel

SEED = 42
# The parameter grids that are searched.
LOGISTIC_GRID = {"c": [0.01, 0.1, 1.0, 10.0], "l1_ratio": [1.0, 0.0]}
BOOSTED_GRID = {
    "depth": [3, 5, 7], "rate": [0.05, 0.1, 0.3], "rounds": [100, 200],
    "row_share": [0.8, 1.0], "column_share": [0.8, 1.0],
}
NETWORK_GRID = {"hidden": [(32,), (32, 16), (64, 32)], "rate": [0.001, 0.01]}
C_VALUES = (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)
DEPTH_VALUES = (1, 2, 3, 5, 7, 10)
HIDDEN_VALUES = ((4,), (8,), (16,), (32, 16), (64, 32))
LEARNING_FRACTIONS = tuple(0.1 + 0.18 * i for i in range(6))

Maker = Callable[..., Pipeline]


def scaled(model, features: Sequence[str]) -> Pipeline:
    """Standardisation as part of the model: refitted with it on every fold."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw", handleInvalid="keep"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            model,
        ]
    )


def unscaled(model, features: Sequence[str]) -> Pipeline:
    """Trees split on thresholds and need no scaling."""
    return Pipeline(
        stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), model]
    )


def logistic(features: Sequence[str], rows: int, c: float = 1.0, l1_ratio: float = 0.0, max_iter: int = 1000) -> Pipeline:
    """Logistic regression; ``c`` is the inverse penalty on the summed loss."""
    return scaled(
        LogisticRegression(
            featuresCol="features", labelCol="label", regParam=1.0 / (c * rows), elasticNetParam=l1_ratio,
            standardization=False, maxIter=max_iter,
        ),
        features,
    )


def boosted(
    features: Sequence[str], rows: int = 0, depth: int = 2, rate: float = 0.01, rounds: int = 100,
    row_share: float = 1.0, column_share: float = 1.0,
) -> Pipeline:
    return unscaled(
        GBTClassifier(
            featuresCol="features", labelCol="label", maxDepth=depth, stepSize=rate, maxIter=rounds,
            subsamplingRate=row_share, featureSubsetStrategy="all" if column_share >= 1 else str(column_share),
            seed=SEED,
        ),
        features,
    )


def network(
    features: Sequence[str], rows: int = 0, hidden: Sequence[int] = (32, 16), max_iter: int = 200,
    rate: float = 0.03,
) -> network_grid.Network:
    """A small multilayer perceptron (sigmoid units, no penalty term).

    The quasi-Newton steps find their own length: ``rate`` is a parameter of
    the search and has no effect on the fit, as with MLlib's l-bfgs.
    """
    return network_grid.Network(features, hidden, max_iter, SEED)


def prepare(df: DataFrame, features: Sequence[str], label: str, key: str, *extra: str) -> DataFrame:
    """Key, numeric features and ``label`` as the estimators expect them."""
    return df.select(
        F.col(key), *[F.col(c).cast("double").alias(c) for c in features],
        F.col(label).cast("double").alias("label"), *extra,
    )


def _scores(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(
        *keep, F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("score")
    )


def score_models(
    models: dict[str, Pipeline], train: DataFrame, test: DataFrame, key: str, threads: int = 8
) -> tuple[DataFrame, dict]:
    """Fit every model on the same rows, networks in the same passes; return one long score frame and the models."""
    train = right_sized(train)
    networks = {name: e for name, e in models.items() if isinstance(e, network_grid.Network)}
    jobs = [lambda name=name, e=e: {name: e.fit(train)} for name, e in models.items() if name not in networks]
    jobs += [lambda: network_grid.fit_together(networks, train)] if networks else []
    try:
        parts = run_parallel(train.sparkSession, jobs, threads)
    finally:
        train.unpersist()
    fitted = {name: model for part in parts for name, model in part.items()}
    fitted = {name: fitted[name] for name in models}
    long = None
    for name, model in fitted.items():
        part = _scores(model, test, [key]).withColumn("model", F.lit(name))
        long = part if long is None else long.unionByName(part)
    return long.select("model", key, "label", "score"), fitted


def compare_models(scores: DataFrame) -> DataFrame:
    """Six measures per model, best ROC-AUC first."""
    return evaluate_scores(cut_lineage(scores), ["model"]).orderBy(F.col("roc_auc").desc(), "model")


def best_model(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy(F.col("roc_auc").desc(), "model").limit(1)


def _counts(model, df: DataFrame, **constants) -> DataFrame:
    """Positives and negatives per score at ``SCORE_DIGITS`` digits: what a fit of a search leaves behind."""
    scored = _scores(model, df, []).groupBy(F.round("score", SCORE_DIGITS).alias("score"))
    counts = scored.agg(F.sum("label").alias("pos"), (F.count(F.lit(1)) - F.sum("label")).alias("neg"))
    return counts.select(*[F.lit(v).alias(k) for k, v in constants.items()], "score", "pos", "neg")


def _fold_counts(
    candidates: Sequence[tuple[str, Callable[[int], Pipeline]]], df: DataFrame, folds: int, threads: int,
    with_train: bool = False,
) -> DataFrame:
    """Score counts of every candidate on every fold's unseen (and optionally seen) rows."""
    sizes = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    total = sum(sizes.values())

    def job(name, make, fold):
        def run():
            seen = df.filter(F.col("fold") != fold)
            model = make(total - sizes.get(fold, 0)).fit(seen)
            parts = [("validation", df.filter(F.col("fold") == fold))] + ([("train", seen)] if with_train else [])
            return reduce(DataFrame.unionByName, [_counts(model, rows, candidate=name, fold=fold, role=role) for role, rows in parts])

        return run

    jobs = [job(name, make, fold) for name, make in candidates for fold in range(folds)]
    return reduce(DataFrame.unionByName, run_parallel(df.sparkSession, jobs, threads))


def _network_counts(
    names: Sequence[str], combinations: Sequence[dict], df: DataFrame, features: Sequence[str], folds: int, with_train: bool = False
) -> DataFrame:
    """Score counts as ``_fold_counts`` gives them; the networks are fitted in the same passes, equal ones once."""
    wanted: dict[tuple, list[str]] = {}
    for name, p in zip(names, combinations):
        fitted = network(features, **p)
        wanted.setdefault((fitted.max_iter, fitted.hidden), []).append(name)
    parts = []
    for budget in dict.fromkeys(max_iter for max_iter, _ in wanted):
        sizes = [hidden for max_iter, hidden in wanted if max_iter == budget]
        cells = [network_grid.Cell(hidden, f) for hidden in sizes for f in range(folds)]
        fits, blocks = network_grid.fit_cells(df, features, cells, budget, seed=SEED)
        counts = cut_lineage(network_grid.score_counts(blocks, fits, with_train))
        of = F.array(*[F.array(*[F.lit(name) for name in wanted[budget, cell.hidden]]) for cell in cells])
        parts.append(counts.withColumn("candidate", F.explode(F.get(of, F.col("cell")))).select("candidate", "fold", "role", "score", "pos", "neg"))
    return reduce(DataFrame.unionByName, parts)


def _auc_by_fold(counts: DataFrame) -> DataFrame:
    return ranking_of_counts(counts, ["candidate", "role", "fold"])


def _logistic_auc(folded: DataFrame, features: Sequence[str], cells: Sequence[Cell]) -> tuple[DataFrame, logistic_grid.Fits]:
    """ROC-AUC of every cell and role with what the cell is; all cells are fitted in the same passes."""
    rows = cut_lineage(logistic_grid.complete(folded, features))
    fits = logistic_grid.fit_cells(rows, features, cells)
    auc = ranking_of_counts(logistic_grid.score_counts(rows, fits), ["cell", "role"]).select("cell", "role", "roc_auc")
    return auc.join(fits.table(rows.sparkSession).drop("weights", "centre", "width"), "cell"), fits


def logistic_folds(df: DataFrame, features: Sequence[str], key: str, folds: int = 5, seed: int = SEED, c: float = 1.0) -> DataFrame:
    """ROC-AUC of one logistic regression on every stratified fold."""
    folded = stratified_folds(df, ["label"], key, folds, seed)
    auc, _ = _logistic_auc(folded, features, [Cell(c=c, fold=f) for f in range(folds)])
    return auc.where(F.col("role") == "validation").select("fold", "roc_auc")


def logistic_search(
    df: DataFrame, features: Sequence[str], combinations: Sequence[dict], key: str, folds: int = 3, seed: int = SEED
) -> DataFrame:
    """Cross-validated ROC-AUC of every (c, l1_ratio), best first; all of them are fitted in the same passes."""
    cells = [Cell(c=p.get("c", 1.0), l1_ratio=p.get("l1_ratio", 0.0), fold=f) for p in combinations for f in range(folds)]
    auc, _ = _logistic_auc(stratified_folds(df, ["label"], key, folds, seed), features, cells)
    table = mean_and_spread(auc.where(F.col("role") == "validation"), ["c", "l1_ratio"])
    return table.orderBy(F.col("mean").desc(), "c", "l1_ratio")


def logistic_validation_curve(
    df: DataFrame, features: Sequence[str], key: str, values: Sequence[float] = C_VALUES, folds: int = 3, seed: int = SEED
) -> DataFrame:
    """Train and validation ROC-AUC for every inverse penalty."""
    cells = [Cell(c=float(c), fold=f) for c in values for f in range(folds)]
    auc, _ = _logistic_auc(stratified_folds(df, ["label"], key, folds, seed), features, cells)
    return _role_table(auc, "c")


def logistic_learning_curve(
    df: DataFrame, features: Sequence[str], key: str, fractions: Sequence[float] = LEARNING_FRACTIONS,
    folds: int = 3, seed: int = SEED, c: float = 1.0,
) -> DataFrame:
    """Train and validation ROC-AUC for growing training sets; rows know their first subset and are not copied."""
    folded = subset_levels(stratified_folds(df, ["label"], key, folds, seed), key, fractions, seed + 1, keys=["fold"])
    # a row beyond the largest subset trains nothing, but still counts for validation
    held = folded.withColumn("level", F.coalesce("level", F.lit(len(fractions) + 1)))
    cells = [Cell(c=c, fold=f, level=s) for s in range(1, len(fractions) + 1) for f in range(folds)]
    auc, _ = _logistic_auc(held, features, cells)
    return _role_table(auc, "level").withColumnRenamed("level", "subset")


def cross_validate(
    make: Callable[[int], Pipeline], df: DataFrame, key: str, folds: int = 5, threads: int = 8, seed: int = SEED
) -> DataFrame:
    """ROC-AUC of one model on every stratified fold."""
    folded = right_sized(stratified_folds(df, ["label"], key, folds, seed))
    try:
        scores = cut_lineage(_fold_counts([("model", make)], folded, folds, threads))
    finally:
        folded.unpersist()
    return _auc_by_fold(scores).select("fold", "roc_auc")


def mean_and_spread(auc: DataFrame, by: Sequence[str] = (), value: str = "roc_auc") -> DataFrame:
    """Mean and population deviation over folds."""
    return auc.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def all_combinations(grid: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def some_combinations(grid: dict[str, Sequence], n: int, seed: int = SEED) -> list[dict]:
    """``n`` different combinations, the same ones for the same seed."""
    everything = all_combinations(grid)
    return random.Random(seed).sample(everything, min(n, len(everything)))


def describe(params: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in params.items())


def search(
    make: Maker, features: Sequence[str], combinations: Sequence[dict], df: DataFrame, key: str,
    folds: int = 3, threads: int = 8, seed: int = SEED,
) -> DataFrame:
    """Cross-validated ROC-AUC of every combination, best first, with the parameters as typed columns."""
    candidates = [
        (describe(p), lambda rows, p=p: make(features, rows, **p)) for p in combinations
    ]
    if make is network:
        folded = cut_lineage(stratified_folds(df, ["label"], key, folds, seed))
        scores = _network_counts([name for name, _ in candidates], combinations, folded, features, folds)
    else:
        folded = right_sized(stratified_folds(df, ["label"], key, folds, seed))
        try:
            scores = cut_lineage(_fold_counts(candidates, folded, folds, threads))
        finally:
            folded.unpersist()
    table = mean_and_spread(_auc_by_fold(scores), ["candidate"])
    names = sorted({name for p in combinations for name in p})
    value = lambda v: list(v) if isinstance(v, tuple) else v
    typed = df.sparkSession.createDataFrame([(describe(p), *[value(p.get(n)) for n in names]) for p in combinations], ["candidate", *names])
    return table.join(typed, "candidate").orderBy(F.col("mean").desc(), "candidate")


def best_parameters(table: DataFrame) -> dict:
    """The parameters of the best row of a search."""
    names = [c for c in table.columns if c not in ("candidate", "mean", "std")]
    row = table.orderBy(F.col("mean").desc(), *table.drop("mean", "std").columns).select(*names).first().asDict()
    return {k: tuple(v) if isinstance(v, list) else v for k, v in row.items() if v is not None}


def tuned(searches: dict[str, tuple[Maker, DataFrame]], features: Sequence[str], rows: int) -> dict[str, Pipeline]:
    """Per search (maker, table of results) a pipeline with the parameters of its best row, named ``<search>_tuned``."""
    return {f"{name}_tuned": make(features, rows, **best_parameters(table)) for name, (make, table) in searches.items()}


def learning_curve(
    make: Callable[[int], Pipeline], df: DataFrame, key: str, fractions: Sequence[float] = LEARNING_FRACTIONS,
    folds: int = 3, threads: int = 8, seed: int = SEED,
) -> DataFrame:
    """Train and validation ROC-AUC for growing training sets, per size over folds."""
    folded = right_sized(stratified_folds(df, ["label"], key, folds, seed))
    jobs = []
    grown = right_sized(growing_subsets(folded, key, fractions, seed + 1, keys=["fold"]))
    sizes = {(r["subset"], r["fold"]): r["count"] for r in grown.groupBy("subset", "fold").count().collect()}

    def job(subset, fold):
        def run():
            seen = grown.filter((F.col("subset") == subset) & (F.col("fold") != fold))
            rows = sum(n for (s, f), n in sizes.items() if s == subset and f != fold)
            model = make(rows).fit(seen)
            parts = (("train", seen), ("validation", folded.filter(F.col("fold") == fold)))
            return reduce(DataFrame.unionByName, [_counts(model, part, candidate=str(subset), fold=fold, role=role) for role, part in parts])

        return run

    jobs = [job(s, f) for s in range(1, len(fractions) + 1) for f in range(folds)]
    try:
        scores = cut_lineage(reduce(DataFrame.unionByName, run_parallel(df.sparkSession, jobs, threads)))
    finally:
        grown.unpersist()
        folded.unpersist()
    return _role_table(_auc_by_fold(scores)).withColumn("subset", F.col("candidate").cast("int")).drop("candidate")


def _role_table(auc: DataFrame, by: str = "candidate") -> DataFrame:
    """One row per candidate: mean and deviation for train and validation, and the gap."""
    def of(role, value):
        return F.when(F.col("role") == role, F.col(value))

    return auc.groupBy(by).agg(
        F.avg(of("train", "roc_auc")).alias("train_mean"), F.stddev_pop(of("train", "roc_auc")).alias("train_std"),
        F.avg(of("validation", "roc_auc")).alias("validation_mean"),
        F.stddev_pop(of("validation", "roc_auc")).alias("validation_std"),
        (F.avg(of("train", "roc_auc")) - F.avg(of("validation", "roc_auc"))).alias("gap"),
    )


def validation_curve(
    make: Maker, features: Sequence[str], parameter: str, values: Sequence, df: DataFrame, key: str,
    folds: int = 3, threads: int = 8, seed: int = SEED, fixed: dict | None = None,
) -> DataFrame:
    """Train and validation ROC-AUC for every value of one parameter."""
    combinations = [{**(fixed or {}), parameter: v} for v in values]
    candidates = [
        (str(v), lambda rows, p=p: make(features, rows, **p)) for v, p in zip(values, combinations)
    ]
    if make is network:
        folded = cut_lineage(stratified_folds(df, ["label"], key, folds, seed))
        scores = _network_counts([name for name, _ in candidates], combinations, folded, features, folds, with_train=True)
    else:
        folded = right_sized(stratified_folds(df, ["label"], key, folds, seed))
        try:
            scores = cut_lineage(_fold_counts(candidates, folded, folds, threads, with_train=True))
        finally:
            folded.unpersist()
    return _role_table(_auc_by_fold(scores)).withColumnRenamed("candidate", parameter)


def read_curve(curve: DataFrame, parameter: str, flat: float = 0.005) -> DataFrame:
    """Best value, spread of the means, and whether the curve is too flat to matter."""
    spread = F.max("validation_mean") - F.min("validation_mean")
    return curve.agg(
        F.max_by(parameter, "validation_mean").alias("best"), spread.alias("spread"), (spread < flat).alias("flat")
    )


def high_bias(simple: DataFrame, best: DataFrame, margin: float = 0.02) -> DataFrame:
    """Does a more flexible model beat the simple one's level by more than ``margin``?

    Both frames hold a ``mean``; the highest of each counts.
    """
    level, top = simple.agg(F.max("mean")).scalar(), best.agg(F.max("mean")).scalar()
    row = simple.sparkSession.range(1).select(level.alias("simple_level"), top.alias("best_level"))
    return row.withColumn("high_bias", F.col("best_level") - F.col("simple_level") > margin)


def importances(model, features: Sequence[str], session, top: int = 10) -> DataFrame:
    """Weight of every feature: absolute coefficients or split gains, largest first."""
    last = model.stages[-1]
    weights = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    rows = [(f, abs(float(w))) for f, w in zip(features, weights.toArray())]
    return session.createDataFrame(rows, "feature STRING, weight DOUBLE").orderBy(
        F.col("weight").desc(), "feature"
    ).limit(top)
