import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cox, encode, hazard_forest, scan, survival


def people(spark, n=200, seed=0, months=True):
    rng = np.random.default_rng(seed)
    x, z = rng.normal(0, 1, n), rng.normal(0, 1, n)
    life = rng.exponential(12 * np.exp(-0.8 * x + 0.3 * z))
    stop = rng.exponential(18, n)
    time = np.minimum(life, stop)
    time = np.ceil(time) if months else time
    event = life <= stop
    rows = [(i, bool(e), float(t), float(a), float(b)) for i, (e, t, a, b) in enumerate(zip(event, time, x, z))]
    frame = spark.createDataFrame(rows, "id LONG, event BOOLEAN, time DOUBLE, x DOUBLE, z DOUBLE")
    return event, time, np.column_stack([x, z]), frame


def brute_km(event, time, reverse=False):
    s, out = 1.0, {}
    for t in np.unique(time):
        d, n = (event & (time == t)).sum(), (time >= t).sum()
        if reverse:
            d, n = (~event & (time == t)).sum(), n - d
        s *= 1 - (d / n if n else 0)
        out[t] = s
    return out


def brute_c(event, time, risk):
    good = pairs = 0.0
    for i in np.flatnonzero(event):
        other = (time > time[i]) | ((time == time[i]) & ~event)
        pairs += other.sum()
        good += (risk[i] > risk[other]).sum() + (risk[i] == risk[other]).sum() / 2
    return good / pairs


def test_hand_computed_curve(spark):
    rows = [(1.0, True), (2.0, True), (2.0, False), (3.0, False), (4.0, True), (5.0, False)]
    curve = survival.kaplan_meier(spark.createDataFrame(rows, "time DOUBLE, event BOOLEAN"), confidence=0.95)
    got = {r.time: r for r in curve.collect()}
    assert [got[t].surv for t in (1, 2, 3, 4, 5)] == pytest.approx([5 / 6, 4 / 6, 4 / 6, 2 / 6, 2 / 6])
    assert [got[t].at_risk for t in (1, 2, 3, 4, 5)] == [6, 5, 3, 2, 1]
    assert got[1].conf_lo < 5 / 6 < got[1].conf_hi <= 1
    read = {r.time: r.surv for r in survival.survival_at(curve, (0.5, 2.5, 9)).collect()}
    assert read == {0.5: 1.0, 2.5: pytest.approx(4 / 6), 9.0: None}


@pytest.mark.parametrize("months", [True, False])
@pytest.mark.parametrize("few", [10**6, 0])
def test_curve_and_concordance_equal_brute_force(spark, monkeypatch, months, few):
    monkeypatch.setattr(scan, "FEW_ROWS", few)
    monkeypatch.setattr(scan, "ROWS_PER_BIN", 9)
    monkeypatch.setattr(survival, "FEW_ROWS", few)
    event, time, x, frame = people(spark, 150, months=months)
    for reverse in (False, True):
        got = {r.time: r.surv for r in survival.kaplan_meier(frame, reverse=reverse).collect()}
        assert got == pytest.approx(brute_km(event, time, reverse))
    risk = np.round(x[:, 0], 1)
    row = survival.concordance(frame.withColumn("risk", F.round("x", 1))).first()
    assert row.c_index == pytest.approx(brute_c(event, time, risk))


@pytest.mark.parametrize("few", [10**6, 0])
def test_concordance_makes_one_row_per_digit_of_256_and_counts_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(scan, "FEW_ROWS", few)
    monkeypatch.setattr(scan, "ROWS_PER_BIN", 60)
    monkeypatch.setattr(survival, "FEW_ROWS", few)
    written, materialise = [], survival.materialise
    monkeypatch.setattr(survival, "materialise", lambda table: written.append(materialise(table)) or written[-1])
    for months, digits in ((True, 1), (False, 2)):  # 400 different times have two digits, months one
        written.clear()
        event, time, x, frame = people(spark, 400, seed=8, months=months)
        parts = frame.withColumn("risk", F.round("x", 2)).withColumn("g", F.when(F.col("id") % 2 == 0, "even"))
        rows = {r.g: r for r in survival.concordance(parts, ["g"]).collect()}
        assert written[2][1] <= digits * written[0][1]
        for g, own in (("even", np.arange(400) % 2 == 0), (None, np.arange(400) % 2 == 1)):
            assert rows[g].c_index == pytest.approx(brute_c(event[own], time[own], np.round(x[own, 0], 2)))


def test_curves_by_group_fall_and_stay_in_range(spark):
    _, _, _, frame = people(spark)
    grouped = frame.withColumn("g", (F.col("x") > 0).cast("string"))
    for g in ("true", "false"):
        values = [r.surv for r in survival.kaplan_meier(grouped, ["g"]).filter(F.col("g") == g).orderBy("time").collect()]
        assert all(0 <= b <= a <= 1 for a, b in zip(values, values[1:]))
    nobody = survival.kaplan_meier(frame.withColumn("event", F.lit(False)))
    assert {r.surv for r in nobody.collect()} == {1.0}


def test_dynamic_auc_and_brier_equal_brute_force(spark):
    event, time, x, frame = people(spark, 240, seed=4)
    train, test = frame.filter("id < 140"), frame.filter("id >= 140").withColumn("risk", F.col("x") - 0.4 * F.col("z"))
    window = survival.evaluation_window(train, test)
    horizon = min(time[:140].max(), time[140:].max())
    assert window.horizon == horizon
    keep = np.flatnonzero((np.arange(240) >= 140) & (time < horizon))
    e, t, risk = event[keep], time[keep], x[keep, 0] - 0.4 * x[keep, 1]
    assert window.times == pytest.approx(np.unique(np.percentile(t[e], np.linspace(10, 90, 9))).tolist())
    steps = brute_km(event[:140], time[:140], reverse=True)

    def at(curve, when):
        before = [k for k in curve if k <= when]
        return curve[max(before)] if before else 1.0

    g = np.array([at(steps, v) for v in t])
    inside = survival.in_window(test, window)
    auc = {r.t: r.auc for r in survival.dynamic_auc(train, inside).collect()}
    want = {}
    for s in window.times:
        case, control = e & (t <= s), t > s
        w = 1 / g[case]
        won = [(risk[control] < r).sum() + (risk[control] == r).sum() / 2 for r in risk[case]]
        want[s] = (w * won).sum() / (w.sum() * control.sum())
    assert auc == pytest.approx(want)
    alive = brute_km(e, t)
    s_at = [at(alive, s) for s in window.times]
    drops = -np.diff([1.0, *s_at])
    mean = survival.mean_dynamic_auc(survival.dynamic_auc(train, inside), inside).first().mean_auc
    assert mean == pytest.approx((np.array(list(want[s] for s in window.times)) * drops).sum() / (1 - s_at[-1]))

    guess = inside.withColumn("t", F.explode("eval_times")).withColumn("surv", F.exp(-F.col("t") / 20))
    brier = {r.t: r.brier for r in survival.brier_scores(train, guess).collect()}
    for s in window.times:
        p = np.exp(-s / 20)
        loss = np.where(e & (t <= s), p * p / g, np.where(t > s, (1 - p) ** 2 / at(steps, s), 0.0))
        assert brier[s] == pytest.approx(loss.mean())
    total = survival.integrated_brier(survival.brier_scores(train, guess)).first()[0]
    b = np.array([brier[s] for s in window.times])
    area = ((b[1:] + b[:-1]) / 2 * np.diff(window.times)).sum()
    assert total == pytest.approx(area / (window.times[-1] - window.times[0]))


@pytest.mark.parametrize("few", [10**6, 0])
def test_cox_gradient_vanishes_and_effects_have_their_sign(spark, monkeypatch, few):
    monkeypatch.setattr(scan, "FEW_ROWS", few)
    monkeypatch.setattr(cox, "FEW_ROWS", few)
    monkeypatch.setattr(scan, "ROWS_PER_BIN", 9)
    event, time, x, frame = people(spark, 200, seed=2)
    model = cox.fit_cox(frame, ["x", "z"], alpha=0.1)
    beta = model.coefficients
    w = np.exp(x @ beta)
    gradient = -0.1 * beta
    for i in np.flatnonzero(event):
        at_risk = time >= time[i]
        gradient = gradient + x[i] - (w[at_risk, None] * x[at_risk]).sum(axis=0) / w[at_risk].sum()
    assert np.abs(gradient).max() < 1e-6
    assert beta[0] == pytest.approx(0.8, abs=0.25) and beta[1] < 0
    hazard, total = {}, 0.0
    for t in np.unique(time):
        total += (event & (time == t)).sum() / w[time >= t].sum()
        hazard[t] = total
    assert {r.time: r.cumulative_hazard for r in model.baseline.collect()} == pytest.approx(hazard)
    probe = model.survival_at(frame.filter("id = 0"), [0.0, 5.0, 1e9]).orderBy("t").collect()
    assert probe[0].surv == 1 and probe[1].surv == pytest.approx(np.exp(-hazard[5.0] * np.exp(x[0] @ beta)))
    ratios = {r.feature: r.hazard_ratio for r in model.hazard_ratios().collect()}
    assert ratios["x"] == pytest.approx(np.exp(beta[0]))
    assert model.curves(frame.filter("id < 2"), "id").count() == 2 * len(hazard)


def test_hazard_forest_ranks_and_gives_falling_curves(spark):
    event, time, x, frame = people(spark, 200, seed=3)
    model = hazard_forest.fit_hazard_forest(frame, ["x", "z"], trees=10, depth=4, leaf=5)
    scored = model.with_risk(frame, "id")
    assert survival.concordance(scored).first().c_index > 0.65
    curve = [r.surv for r in model.curves(frame.filter("id = 1"), "id").orderBy("time").collect()]
    assert all(0 <= b <= a <= 1 for a, b in zip(curve, curve[1:])) and len(curve) == model.steps


def test_steps_of_the_hazard_forest_follow_the_events(spark):
    rows = [(k % 2 == 0, float(1 + k % 5), float(k % 3)) for k in range(40)] + [(False, 300.0, 1.0)]
    frame = spark.createDataFrame(rows, "event BOOLEAN, time DOUBLE, x DOUBLE")
    model = hazard_forest.fit_hazard_forest(frame, ["x"], trees=2, depth=2, leaf=1)
    assert model.edges == [1, 2, 3, 4, 5] and model.steps == 5  # one long time adds no step and widens none
    many = spark.createDataFrame([(True, i / 7, 1.0) for i in range(1, 201)], "event BOOLEAN, time DOUBLE, x DOUBLE")
    edges = hazard_forest.step_edges(many, 10)
    assert len(edges) == 10 and edges[-1] == 200 / 7 and edges[4] == pytest.approx(np.quantile(np.arange(1, 201) / 7, 0.5))
    assert hazard_forest.step_edges(frame.withColumn("event", F.lit(False))) == [300.0]


def test_models_are_graded_on_what_they_offer(spark):
    from tidemark.operators import rank_svm

    event, time, x, frame = people(spark, 200, seed=5)
    train, test = frame.filter("id < 120").cache(), frame.filter("id >= 120").cache()
    models = {
        "cox": cox.fit_cox(train, ["x", "z"]), "forest": hazard_forest.fit_hazard_forest(train, ["x", "z"], trees=5, depth=3, leaf=5),
        "svm": rank_svm.fit_rank_svm(train, ["x", "z"]),
    }
    table = {r.model: r for r in survival.evaluate_survival_models(models, train, test, "id").collect()}
    assert table["svm"].integrated_brier is None and 0 < table["cox"].integrated_brier < 0.3 and table["forest"].integrated_brier is not None
    alone = survival.concordance(models["cox"].with_risk(test)).first().c_index
    assert table["cox"].test_c == pytest.approx(alone) and table["cox"].gap == pytest.approx(table["cox"].train_c - alone)
    assert all(0.5 < r.mean_auc <= 1 for r in table.values())
    only = survival.evaluate_survival_models({"svm": models["svm"]}, train, test, "id").collect()
    assert len(only) == 1 and only[0].integrated_brier is None
    assert cox.score_vector(models["cox"], train).agg(F.max(F.abs("score"))).first()[0] < 1e-6
    assert models["cox"].converged and models["svm"].converged


def test_risk_quartiles_collapse_equal_edges(spark):
    frame = spark.createDataFrame([(float(r), True, 1.0) for r in [1, 1, 1, 1, 2, 3, 4, 5]], "risk DOUBLE, event BOOLEAN, time DOUBLE")
    grouped = survival.risk_quartiles(frame)
    sizes = {r.risk_group: r.customers for r in survival.strata_summary(grouped).collect()}
    assert sum(sizes.values()) == 8 and sizes["Low"] == 4
    shares = encode.class_balance(frame, "event").first()
    assert shares.share == 1


@pytest.mark.parametrize("few", [10**6, 0])
def test_ranking_svm_minimises_the_hinge_over_all_pairs(spark, monkeypatch, few):
    from tidemark.operators import rank_svm

    monkeypatch.setattr(scan, "FEW_ROWS", few)
    monkeypatch.setattr(scan, "ROWS_PER_BIN", 40)
    event, time, x, frame = people(spark, 120, seed=6)
    model = rank_svm.fit_rank_svm(frame, ["x", "z"], alpha=0.01)

    def objective(w):
        s = x @ w
        total, slope = 0.5 * w @ w, w.copy()
        for i in np.flatnonzero(event):
            later = time > time[i]
            v = np.maximum(0.0, 1 - s[later] + s[i])
            total += 0.005 * (v**2).sum()
            slope = slope + 0.01 * (v[:, None] * (x[i] - x[later])).sum(axis=0)
        return total, slope

    total, slope = objective(model.weights)
    assert model.losses[-1] == pytest.approx(total)
    assert np.abs(slope).max() < 1e-3 * max(1.0, np.abs(objective(np.zeros(2))[1]).max())
    assert not model.has_survival
    assert survival.concordance(model.with_risk(frame)).first().c_index > 0.65
