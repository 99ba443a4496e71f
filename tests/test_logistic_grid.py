import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import curves, logistic_grid, propensity, splits
from tidemark.operators.logistic_grid import Cell


def planted(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 50.0, 1e-3] + [0.0, 1e5, 3.0]
    chance = 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.02 * (x[:, 1] - 1e5) - 0.3)))
    y = (rng.random(n) < chance).astype(float)
    rows = [(i, *map(float, v), float(t), int(i % 3), int(1 + i % 2)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id LONG, a DOUBLE, b DOUBLE, c DOUBLE, label DOUBLE, fold INT, level INT"), x, y


def dense_fit(x, y, c, l1_ratio, rounds=20000):
    """Proximal gradient on all rows at once, small steps until nothing moves."""
    z = (x - x.mean(0)) / x.std(0)
    z = np.column_stack([z, np.ones(len(z))])
    step = 1 / (0.25 * np.linalg.eigvalsh(z.T @ z)[-1] + (1 - l1_ratio) / c)
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        slope = z.T @ (1 / (1 + np.exp(-z @ w)) - y)
        slope[:-1] += (1 - l1_ratio) / c * w[:-1]
        new = w - step * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * l1_ratio / c, 0)
        if np.abs(new - w).max() < 1e-14:
            break
        w = new
    return w


def test_all_cells_match_a_dense_fit_of_their_own_rows(spark):
    frame, x, y = planted(spark)
    cells = [Cell(0.01, 1.0, 0, 2), Cell(0.1, 0.5, 1, 2), Cell(10.0, 0.0, 2, 2), Cell(1.0, 0.0, 0, 1), Cell(0.02, 1.0, None, 2)]
    rows = logistic_grid.complete(frame.repartition(5), ["a", "b", "c"]).cache()
    fits = logistic_grid.fit_cells(rows, ["a", "b", "c"], cells)
    assert fits.converged.all() and fits.steps.max() < 25
    at = np.arange(len(y))
    for i, cell in enumerate(cells):
        own = (at % 3 != (-1 if cell.fold is None else cell.fold)) & (1 + at % 2 <= cell.level)
        assert fits.rows[i] == own.sum() and fits.positives[i] == y[own].sum()
        assert fits.weights[i] == pytest.approx(dense_fit(x[own], y[own], cell.c, cell.l1_ratio), abs=1e-6)
    assert (fits.weights[0, :-1] == 0).any()
    assert logistic_grid.gradients(rows, fits).agg(F.max("gradient")).first()[0] < 1e-9


def test_counts_of_scores_give_the_auc_of_the_rows(spark):
    frame, x, y = planted(spark)
    rows = logistic_grid.complete(frame, ["a", "b", "c"]).cache()
    cells = [Cell(fold=0, level=1), Cell(fold=1, level=2)]
    fits = logistic_grid.fit_cells(rows, ["a", "b", "c"], cells)
    auc = {(r.cell, r.role): r.roc_auc for r in curves.ranking_of_counts(logistic_grid.score_counts(rows, fits), ["cell", "role"]).collect()}
    plain, at = fits.plain(), np.arange(len(y))
    for i, cell in enumerate(cells):
        score = np.round(1 / (1 + np.exp(-(x @ plain[i, :-1] + plain[i, -1]))), 6)
        for role, own in (("train", (at % 3 != cell.fold) & (1 + at % 2 <= cell.level)), ("validation", at % 3 == cell.fold)):
            pos, neg = score[own & (y == 1)], score[own & (y == 0)]
            wins = (pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2
            assert auc[i, role] == pytest.approx(wins / (len(pos) * len(neg)))


def test_missing_values_constant_columns_and_odd_cells(spark):
    rows = [(1.0, 5.0, 0.0, 0), (2.0, 5.0, 1.0, 0), (3.0, 5.0, 1.0, 1), (0.5, 5.0, 0.0, 1), (None, 5.0, 1.0, 0), (float("nan"), 5.0, 1.0, 1), (1.0, 5.0, None, 0)]
    frame = spark.createDataFrame(rows, "a DOUBLE, k DOUBLE, label DOUBLE, fold INT")
    held = logistic_grid.complete(frame, ["a", "k"])
    assert held.count() == 4
    fits = logistic_grid.fit_cells(held, ["a", "k"], [Cell(), Cell(fold=0), Cell(level=0), Cell(1e-6, 1.0)])
    assert list(fits.rows) == [4, 2, 0, 4] and fits.converged.all()
    assert fits.weights[0, 1] == 0 and (fits.weights[2] == 0).all() and (fits.weights[3, :-1] == 0).all()


def test_a_feature_that_is_constant_on_a_cells_rows_has_no_coefficient(spark):
    # k is constant in fold 0, and near 1e6 in the other; m is constant everywhere, with a mean that is rounded
    rows = [(float(i % 7), 0.3 if i % 2 else 1e6 + i, 0.1, float(i % 3 == 0), i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "a DOUBLE, k DOUBLE, m DOUBLE, label DOUBLE, fold INT")
    cells = [Cell(), Cell(fold=0), Cell(fold=1), Cell(0.1, 0.5, 0), Cell(float("inf"), 0.0, 0)]
    held = logistic_grid.complete(frame.repartition(5), ["a", "k", "m"])
    fits = logistic_grid.fit_cells(held, ["a", "k", "m"], cells)
    assert fits.converged.all() and (fits.weights[:, 2] == 0).all()
    assert (fits.weights[[1, 3, 4], 1] == 0).all() and (fits.weights[[0, 2], 1] != 0).all()
    x, y = np.array([r[0] for r in rows if r[4]]), np.array([r[3] for r in rows if r[4]])
    assert fits.weights[1, [0, 3]] == pytest.approx(dense_fit(x[:, None], y, 1.0, 0.0), abs=1e-6)


def test_searches_and_curves_in_shared_passes(spark):
    frame, _, _ = planted(spark)
    names = ["a", "b", "c"]
    frame = frame.drop("fold", "level")
    table = propensity.logistic_search(frame, names, [{"c": 1e-4, "l1_ratio": 1.0}, {"c": 1.0}], "id").collect()
    assert [r.c for r in table] == [1.0, 1e-4] and table[1]["mean"] == pytest.approx(0.5)
    assert propensity.logistic_folds(frame, names, "id", folds=4).count() == 4
    curve = propensity.logistic_learning_curve(frame, names, "id", (0.3, 1.0)).collect()
    assert {r.subset for r in curve} == {1, 2} and all(r.validation_mean > 0.7 for r in curve)
    sweep = propensity.logistic_validation_curve(frame, names, "id", (0.1, 1.0))
    assert propensity.read_curve(sweep, "c").first().flat


def test_levels_are_the_subsets_without_copies(spark):
    frame = spark.range(200).withColumn("fold", (F.col("id") % 3).cast("int"))
    grown = splits.growing_subsets(frame, "id", (0.1, 0.5, 0.9), 5, ["fold"]).groupBy("id").agg(F.min("subset").alias("first"))
    levels = splits.subset_levels(frame, "id", (0.1, 0.5, 0.9), 5, ["fold"])
    assert levels.count() == 200
    assert levels.join(grown, "id", "left").where(~F.col("level").eqNullSafe(F.col("first"))).count() == 0


def test_parameters_of_a_search_stay_typed(spark):
    table = spark.createDataFrame([("x", 0.7, 0.0, [32, 16], 0.1), ("y", 0.9, 0.0, [4], 0.3)], "candidate STRING, mean DOUBLE, std DOUBLE, hidden ARRAY<INT>, rate DOUBLE")
    assert propensity.best_parameters(table) == {"hidden": (4,), "rate": 0.3}
