import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import curves, encode, lookalike, scan, segments
from tidemark.sources import churn_files


def scored(spark, n=300, seed=0, digits=1):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, n)
    score = np.clip(np.round(rng.normal(0.4 + 0.2 * label, 0.2), digits), 0, 1)
    rows = [(i, int(a), float(b)) for i, (a, b) in enumerate(zip(label, score))]
    return label, score, spark.createDataFrame(rows, "id INT, label INT, score DOUBLE")


def brute_auc(label, score):
    pos, neg = score[label == 1], score[label == 0]
    return np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])


def brute_ap(label, score):
    total, out, before = label.sum(), 0.0, 0.0
    for s in sorted(set(score), reverse=True):
        hit = label[score >= s].sum()
        out += (hit - before) / total * hit / (score >= s).sum()
        before = hit
    return out


@pytest.mark.parametrize("few", [scan.FEW_ROWS, 0])
def test_ranking_measures_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(scan, "FEW_ROWS", few)
    monkeypatch.setattr(scan, "ROWS_PER_BIN", 3)
    label, score, frame = scored(spark, digits=2)
    row = curves.ranking_metrics(frame).first()
    assert row.roc_auc == pytest.approx(brute_auc(label, score))
    assert row.pr_auc == pytest.approx(brute_ap(label, score))
    flipped = curves.ranking_metrics(frame.withColumn("score", -F.col("score"))).first()
    assert flipped.roc_auc == pytest.approx(1 - row.roc_auc)


@pytest.mark.parametrize("few", [10**6, 0])
def test_running_sums_products_and_lasts_in_bins(spark, monkeypatch, few):
    monkeypatch.setattr(scan, "ROWS_PER_BIN", 7)
    rng = np.random.default_rng(1)
    rows = [(k, float(t), float(v), 1 - float(v) / 50, float(v) if t % 3 else None)
            for k in ("a", None) for t, v in enumerate(rng.integers(1, 9, 90))]
    frame = spark.createDataFrame(rows, "k STRING, t DOUBLE, v DOUBLE, f DOUBLE, l DOUBLE")
    for down in (False, True):
        got = scan.running(frame, ["k"], "t", ["v"], ["f"], ["l"], descending=down, few=few).collect()
        for key in ("a", None):
            mine = sorted((r for r in rows if r[0] == key), key=lambda r: r[1], reverse=down)
            want, total, product, last = {}, 0.0, 1.0, None
            for r in mine:
                total, product, last = total + r[2], product * r[3], r[4] if r[4] is not None else last
                want[r[1]] = (total, product, last)
            for r in (g for g in got if g.k == key):
                assert (r.v_run, r.f_run) == pytest.approx(want[r.t][:2]) and r.l_run == want[r.t][2]


@pytest.mark.parametrize("few", [10**6, 0])
def test_quantiles_interpolate_like_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(scan, "ROWS_PER_BIN", 5)
    rng = np.random.default_rng(2)
    data = {k: np.round(rng.normal(0, 5, 80), 1) for k in "ab"}
    frame = spark.createDataFrame([(k, float(v)) for k in data for v in data[k]], "k STRING, v DOUBLE")
    for r in scan.exact_quantiles(frame, ["k"], "v", [0.1, 0.5, 0.83], few=few).collect():
        assert r.quantiles == pytest.approx(np.quantile(data[r.k], [0.1, 0.5, 0.83]).tolist())


def test_threshold_measures_and_report(spark):
    label, score, frame = scored(spark)
    guess = (score >= 0.5).astype(int)
    tp = ((guess == 1) & (label == 1)).sum()
    row = curves.threshold_metrics(frame).first()
    assert row.accuracy == pytest.approx((guess == label).mean())
    assert row.precision == pytest.approx(tp / guess.sum()) and row.recall == pytest.approx(tp / label.sum())
    cells = curves.confusion(curves.classify(frame)).collect()
    assert len(cells) == 4 and sum(c.customers for c in cells) == 300
    report = {r["class"]: r for r in curves.class_report(curves.classify(frame)).collect()}
    assert report["macro avg"].support == 300 and report["Churn"].support == label.sum()
    nobody = curves.threshold_metrics(frame.withColumn("score", F.lit(0.0))).first()
    assert nobody.precision == 0 and nobody.recall == 0 and nobody.f1 == 0


def test_curve_points_reach_the_corners(spark):
    _, _, frame = scored(spark)
    points = curves.roc_points(frame).orderBy("threshold").collect()
    assert (points[0].fpr, points[0].tpr) == (1, 1)
    pr = curves.precision_recall_points(frame).orderBy("threshold").collect()
    assert pr[0].recall == 1 and pr[0].precision == pytest.approx(pr[0].chance)


def test_segment_edges_and_empty_segments(spark):
    rows = [(i, s, 1) for i, s in enumerate([0.0, 0.4, 0.5, 0.7, 1.0])]
    frame = segments.risk_segments(spark.createDataFrame(rows, "id INT, score DOUBLE, label INT"))
    assert [r.segment for r in frame.orderBy("id").collect()] == [
        "Low risk", "Low risk", "Medium risk", "Medium risk", "High risk"]
    summary = {r.segment: r for r in segments.segment_summary(frame.filter("score < 0.6")).collect()}
    assert summary["High risk"].customers == 0 and sum(r.share for r in summary.values()) == pytest.approx(1)
    assert segments.with_actions(frame).filter("action IS NULL").count() == 0


def test_lookalike_windows_do_not_leak(spark):
    day = lambda d: dt.datetime(2024, 1, d, 12)
    rows = [
        (1, day(1), "view", 2.0), (1, day(9), "click", 3.0), (1, day(10), "purchase", 9.0),
        (1, day(12), "purchase", 1.0), (2, day(5), "view", 1.0), (2, day(11), "purchase", 1.0), (3, day(13), "purchase", 1.0),
    ]
    events = spark.createDataFrame(rows, "user_id LONG, ts TIMESTAMP, event_type STRING, value DOUBLE")
    out = {r.user_id: r for r in lookalike.lookalike_profiles(
        events, ["2024-01-10"], "purchase", ["view", "click", "purchase"], 9, 2, 4).collect()}
    assert set(out) == {1, 2}
    assert out[1].events == 2 and out[1].n_purchase == 0 and out[1].total_value == 5 and out[1].label == 1
    assert out[2].label == 0 and out[2].days_since_last == 5  # bought inside the buffer only


def test_encoding_and_scaling(spark):
    rows = [("x", 1, "b", 1.0, 5.0, 0), ("y", 2, "a", 3.0, 5.0, 1), ("z", 3, "c", 5.0, 5.0, 1)]
    frame = spark.createDataFrame(rows, "id STRING, n INT, g STRING, v DOUBLE, k DOUBLE, churn INT")
    coded, names, model = encode.encode_features(frame, "id", "churn")
    assert names == ["n", "g", "v", "k"] and [r.g for r in coded.orderBy("id").collect()] == [1, 0, 2]
    later = spark.createDataFrame([("w", 9, "b", 0.0, 0.0, 0)], frame.schema)
    assert encode.apply_codes(later, model).first().g == 1
    wide, dummies = encode.one_hot(frame, ["g"])
    assert dummies == ["g_b", "g_c"] and wide.filter("id = 'y'").select(*dummies).first() == (0.0, 0.0)
    flagged = frame.withColumn("is_test", F.col("id") == "z")
    scaled = {r.id: r for r in encode.standardise(flagged, ["v", "k"], "is_test").collect()}
    assert [scaled[i].v for i in "xyz"] == [-1, 1, 3] and scaled["x"].k == 0


def test_customer_files_are_combined(spark, tmp_path):
    header = "CustomerID,Age,Gender,Tenure,Usage Frequency,Support Calls,Payment Delay,Subscription Type,Contract Length,Total Spend,Last Interaction,Churn\n"
    (tmp_path / "a.csv").write_text(header + "1,30,F,5,1,1,1,Basic,Annual,10,3,1\n" + ",,,,,,,,,,,\n")
    (tmp_path / "b.csv").write_text(header + "1,40,M,6,1,1,1,Basic,Monthly,10,3,0\n")
    rows = churn_files.load_churn(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv")).collect()
    assert {r.CustomerID for r in rows} == {"a:1", "b:1"} and {r.Churn for r in rows} == {0, 1}
