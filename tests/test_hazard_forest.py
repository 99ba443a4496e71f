import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import hazard_forest
from tidemark.operators.hazard_forest import Tree


def customers(spark, n=120, seed=2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 3, n)])
    time = rng.integers(1, 8, n).astype(float)
    event = rng.random(n) < 0.3 + 0.4 * (x[:, 0] > 0)
    rows = [(i, bool(e), float(t), *map(float, v)) for i, (e, t, v) in enumerate(zip(event, time, x))]
    return x, time, event, spark.createDataFrame(rows, "id LONG, event BOOLEAN, time DOUBLE, x DOUBLE, z DOUBLE")


def reached(tree, bins, step):
    node = 1
    while node in tree.split:
        feature, cut = tree.split[node]
        node = 2 * node + ((step if feature == len(bins) else bins[feature]) > cut)
    return node


def test_sums_of_a_block_are_those_of_customers_times_steps():
    """Every row of a customer and a step, written out and drawn one by one."""
    rng = np.random.default_rng(5)
    n, steps = 50, 6
    own = np.sort(rng.integers(1, steps + 1, n))[::-1]
    data = np.column_stack([own, rng.integers(0, 2, n), rng.integers(0, 4, n), rng.integers(0, 3, n)]).astype(np.uint8)
    trees = [Tree({1: (2, 2), 2: (0, 1), 3: (2, 4)}, {}), Tree({1: (1, 0)}, {})]
    active = [{4: [0, 2], 5: [1], 6: [0, 1, 2], 7: [2]}, {2: [0, 2], 3: [1, 2]}]
    totals = [hazard_forest._empty(wanted, [4, 3, steps]) for wanted in active]
    hazard_forest._add_block(totals, data, trees, active, steps, (1, 2, 3))
    seen = 0
    for k, tree in enumerate(trees):
        longs = np.random.Generator(np.random.SFC64([1, 2, 3, k])).integers(0, 2**64, own.sum() // 4 + 1, np.uint64).view(np.uint16)
        at, want = 0, hazard_forest._empty(active[k], [4, 3, steps])
        for s in range(steps):
            for i in range((own > s).sum()):
                drawn, at = int((longs[at] >= hazard_forest._DRAWS).sum()), at + 1
                node = reached(tree, data[i, 2:], s)
                for j, part in zip(active[k].get(node, ()), want.get(node, ())):
                    b = s if j == 2 else data[i, 2 + j]
                    part[0, b] += drawn
                    part[1, b] += drawn * (data[i, 1] and own[i] == s + 1)
                    seen += drawn
        for node in want:
            assert all((a == b).all() for a, b in zip(totals[k][node], want[node]))
    assert seen > 100


def test_a_bootstrap_draws_rows_as_poisson():
    u = np.arange(65536).astype(np.uint16)
    drawn = (u[:, None] >= hazard_forest._DRAWS).sum(1)
    assert drawn.mean() == pytest.approx(1, abs=1e-3) and drawn.var() == pytest.approx(1, abs=2e-3)


def test_scores_are_those_of_walking_every_step(spark):
    x, _, _, frame = customers(spark)
    model = hazard_forest.fit_hazard_forest(frame.repartition(3), ["x", "z"], trees=6, depth=4, leaf=3)
    assert any(f == 2 for t in model.trees for f, _ in t.split.values()) and any(f < 2 for t in model.trees for f, _ in t.split.values())
    bins = np.column_stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(model.cuts)])
    hazards = np.array([[np.mean([t.chance[reached(t, b, s)] for t in model.trees]) for s in range(model.steps)] for b in bins])
    # equal and missing ids are rows like others; an id joined and grouped by made more or fewer of them
    odd = frame.withColumn("row", F.col("id")).withColumn("id", F.when(F.col("id") % 3 > 0, F.lit(7)))
    risk = {r.row: r.risk for r in model.with_risk(odd, "id").collect()}
    assert len(risk) == len(x) and [risk[i] for i in range(len(x))] == pytest.approx(hazards.sum(1).tolist())
    surv = {(r.row, r.t): r.surv for r in model.survival_at(odd, "id", [0.5, 3.0, 99.0]).collect()}
    assert len(surv) == 3 * len(x)
    ended = sum(e <= 3 for e in model.edges)
    for i in range(len(x)):
        assert [surv[i, t] for t in (0.5, 3.0, 99.0)] == pytest.approx([1, np.prod(1 - hazards[i, :ended]), np.prod(1 - hazards[i])])


def test_a_deep_tree_on_all_rows_finds_what_splits_them(spark):
    x, time, event, frame = customers(spark, 400, 4)
    planted = frame.withColumn("event", F.col("x") > 0.5)
    model = hazard_forest.fit_hazard_forest(planted, ["x"], trees=10, depth=3, leaf=1)
    risk = {r.id: r.risk for r in model.with_risk(planted, "id").collect()}
    low, high = [risk[i] for i in range(400) if x[i, 0] < 0.3], [risk[i] for i in range(400) if x[i, 0] > 0.7]
    assert max(low) < min(high)
