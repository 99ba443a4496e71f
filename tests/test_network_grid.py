import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import network_grid, propensity
from tidemark.operators.network_grid import Cell


@pytest.fixture(scope="module")
def churners(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 2)) * [1.0, 400.0] + [0.0, 1e4]
    label = (rng.random(900) < 1 / (1 + np.exp(-2 * x[:, 0] * np.sign(x[:, 1] - 1e4)))).astype(float)
    rows = [(i, *map(float, v), float(t), i % 3) for i, (v, t) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "id LONG, x DOUBLE, z DOUBLE, label DOUBLE, fold INT").repartition(4).persist()


def test_slopes_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    sizes = network_grid.layer_sizes(3, (4, 5))
    flat, z, label = network_grid.first_weights(sizes, 7), rng.normal(size=(20, 3)), (rng.random(20) < 0.4).astype(float)
    _, slope = network_grid.loss_and_gradient(z, label, flat, sizes)
    for j in range(len(flat)):
        step = np.zeros(len(flat))
        step[j] = 1e-5
        up, down = (network_grid.loss_and_gradient(z, label, flat + s, sizes)[0] for s in (step, -step))
        assert slope[j] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_networks_fitted_together_are_those_of_mllib(spark, churners):
    cells = [Cell((4,), 0), Cell((5, 3), 2), Cell((4,))]
    start = [network_grid.first_weights(network_grid.layer_sizes(2, c.hidden), 3) for c in cells]
    fits, blocks = network_grid.fit_cells(churners, ["x", "z"], cells, max_iter=20, start=start)
    pdf = churners.toPandas()
    x, label, fold = pdf[["x", "z"]].to_numpy(), pdf["label"].to_numpy(), pdf["fold"].to_numpy()
    for i, cell in enumerate(cells):
        seen = fold != (-1 if cell.fold is None else cell.fold)
        z = (x - x[seen].mean(0)) / x[seen].std(0, ddof=1)
        own = spark.createDataFrame([(float(t), Vectors.dense(v)) for t, v in zip(label[seen], z[seen])], ["label", "features"]).coalesce(1)
        sizes = network_grid.layer_sizes(2, cell.hidden)
        theirs = MultilayerPerceptronClassifier(layers=sizes, maxIter=20, blockSize=int(seen.sum()), initialWeights=Vectors.dense(start[i])).fit(own)
        loss, _ = network_grid.loss_and_gradient(z[seen], label[seen], theirs.weights.toArray(), sizes)
        assert theirs.summary().objectiveHistory[-1] == pytest.approx(loss / seen.sum())
        assert fits.losses[i] == pytest.approx(network_grid.loss_and_gradient(z[seen], label[seen], fits.weights[i], sizes)[0] / seen.sum(), rel=1e-5)
        assert fits.losses[i] <= loss / seen.sum() + 0.03
        assert np.abs(network_grid.chances(x, fits, i) - network_grid.chances(x, _with(fits, i, theirs.weights.toArray()), i)).mean() < 0.1
    counts = network_grid.score_counts(blocks, fits, with_train=True).groupBy("cell", "role").agg(F.sum(F.col("pos") + F.col("neg")).alias("n"))
    assert {(r.cell, r.role): r.n for r in counts.collect()} == {(0, "validation"): 300, (0, "train"): 600, (1, "validation"): 300, (1, "train"): 600, (2, "train"): 900}


def _with(fits, i, weights):
    from dataclasses import replace

    return replace(fits, weights=[weights if k == i else w for k, w in enumerate(fits.weights)])


def test_a_search_fits_equal_networks_once_and_all_in_the_same_passes(spark, churners, monkeypatch):
    passes = []
    sums = network_grid._sums
    monkeypatch.setattr(network_grid, "_sums", lambda blocks, q, cells, *rest: passes.append(len(cells)) or sums(blocks, q, cells, *rest))
    table = propensity.search(
        propensity.network, ["x", "z"], propensity.all_combinations({"hidden": [(4,), (5, 3)], "rate": [0.001, 0.01], "max_iter": [12]}), churners.drop("fold"), "id"
    ).collect()
    assert passes[0] == 2 * 3 and len(passes) < 40
    by = {(tuple(r.hidden), r.rate): r["mean"] for r in table}
    assert len(by) == 4 and all(by[h, 0.001] == by[h, 0.01] > 0.55 for h in [(4,), (5, 3)])
    one = propensity.cross_validate(lambda rows: propensity.network(["x", "z"], rows, hidden=(4,), max_iter=12), churners.drop("fold"), "id", folds=3)
    assert one.agg(F.avg("roc_auc")).first()[0] == pytest.approx(by[(4,), 0.001], abs=1e-3)


def test_rows_with_a_missing_feature_train_nothing(spark, churners):
    holed = churners.unionByName(churners.limit(5).withColumn("x", F.lit(None).cast("double")))
    kept, _ = network_grid.fit_cells(churners, ["x", "z"], [Cell((3,), 1)], max_iter=2)
    odd, _ = network_grid.fit_cells(holed, ["x", "z"], [Cell((3,), 1)], max_iter=2)
    assert odd.losses == pytest.approx(kept.losses)


def test_networks_of_a_comparison_are_fitted_in_the_same_passes(spark, churners, monkeypatch):
    passes, sums = [], network_grid._sums
    monkeypatch.setattr(network_grid, "_sums", lambda blocks, q, cells, *rest: passes.append([c.hidden for c in cells]) or sums(blocks, q, cells, *rest))
    names = ["x", "z"]
    models = {
        "network": propensity.network(names, hidden=(4,), max_iter=6), "logistic": propensity.logistic(names, 900),
        "network_tuned": propensity.network(names, hidden=(5, 3), max_iter=6, rate=0.01), "same": propensity.network(names, hidden=(4,), max_iter=6, rate=0.001),
    }
    scores, fitted = propensity.score_models(models, churners, churners, "id")
    assert passes[0] == [(4,), (5, 3)] and list(fitted) == list(models)
    table = {r.model: r.roc_auc for r in propensity.compare_models(scores).collect()}
    assert set(table) == set(models) and table["network"] == table["same"]
    alone = models["network_tuned"].fit(churners)
    assert fitted["network_tuned"].fits.losses == pytest.approx(alone.fits.losses, rel=1e-5)
