"""Queries over the customer table: preparation, scoring curves, segments, survival."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import curves, encode, lookalike, segments, splits, survival
from tidemark.plans import tables as t
from tidemark.plans.oracle import on_customers
from tidemark.plans.registry import query, rounded
from tidemark.runtime import cut_lineage
from tidemark.sources.churn_files import combine_customers

NUMERIC = ["balance", "orders", "spend", "largest", "urgent", "pending", "days_silent", "tenure"]
SEED = 42

# A plain deterministic score, so that every measure has an exact check.
SCORED_SQL = "scored AS (SELECT *, churn AS label, round(days_silent / (days_silent + 180), 3) AS score FROM customers)"


def scored_customers(spark, folder):
    score = F.round(F.col("days_silent") / (F.col("days_silent") + 180), 3)
    return t.customer_table(spark, folder).withColumns({"label": F.col("churn"), "score": score})


@query("customer_table", on_customers("SELECT * FROM customers"))
def customer_table(spark, folder):
    return t.customer_table(spark, folder)


@query(
    "customers_combined",
    on_customers(
        """SELECT CASE customer_id % 2 WHEN 0 THEN 'a:' ELSE 'b:' END || CAST(customer_id // 2 AS VARCHAR) AS customer_id,
        segment, balance, churn FROM customers WHERE balance > 0"""
    ),
)
def customers_combined(spark, folder):
    """Two parts, numbered alike, that hold all customers; rows with a missing value drop out."""
    customers = t.customer_table(spark, folder).select(
        "customer_id", "segment", F.when(F.col("balance") > 0, F.col("balance")).alias("balance"), "churn"
    )
    half = F.floor(F.col("customer_id") / 2)
    parts = {
        name: customers.filter(F.col("customer_id") % 2 == odd).withColumn("customer_id", half)
        for name, odd in (("a", 0), ("b", 1))
    }
    return combine_customers(parts, "customer_id", "churn")


_RANKED = """, h AS (SELECT *, md5(CAST(customer_id AS VARCHAR) || ':42') AS h FROM customers),
  r AS (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY h, customer_id) AS rk, COUNT(*) OVER (PARTITION BY churn) AS n FROM h)"""


@query(
    "stratified_sample",
    on_customers(
        _RANKED + """ SELECT customer_id, churn FROM r WHERE rk <= round(n * least(1.0, 500.0 / (SELECT COUNT(*) FROM customers)))"""
    ),
)
def stratified_sample(spark, folder):
    return splits.stratified_sample(t.customer_table(spark, folder), ["churn"], "customer_id", 500, SEED).select(
        "customer_id", "churn"
    )


@query("stratified_hold_out", on_customers(_RANKED + " SELECT customer_id, churn, rk <= round(n * 0.2) AS is_test FROM r"))
def stratified_hold_out(spark, folder):
    return splits.stratified_hold_out(t.customer_table(spark, folder), ["churn"], "customer_id", 0.2, SEED).select(
        "customer_id", "churn", "is_test"
    )


@query("stratified_folds", on_customers(_RANKED + " SELECT customer_id, churn, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM r"))
def stratified_folds(spark, folder):
    return splits.stratified_folds(t.customer_table(spark, folder), ["churn"], "customer_id", 5, SEED).select(
        "customer_id", "churn", "fold"
    )


@query(
    "growing_subsets",
    on_customers(
        """, h AS (SELECT *, md5(CAST(customer_id AS VARCHAR) || ':42') AS h FROM customers),
        r AS (SELECT *, row_number() OVER (ORDER BY h, customer_id) AS rk, COUNT(*) OVER () AS n FROM h),
        steps AS (SELECT UNNEST([1, 2, 3, 4, 5, 6]) AS subset, UNNEST([0.1, 0.28, 0.46, 0.64, 0.82, 1.0]::DOUBLE[]) AS fraction)
        SELECT subset, fraction, COUNT(*) AS customers, CAST(SUM(churn) AS BIGINT) AS churned FROM r, steps WHERE rk <= round(n * fraction) GROUP BY 1, 2"""
    ),
)
def growing_subsets(spark, folder):
    rows = splits.growing_subsets(
        t.customer_table(spark, folder), "customer_id", (0.1, 0.28, 0.46, 0.64, 0.82, 1.0), SEED
    )
    return rows.groupBy("subset", "fraction").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("churn").alias("churned")
    )


@query(
    "picked_customers",
    on_customers("SELECT customer_id, tenure, churn FROM customers ORDER BY md5(CAST(customer_id AS VARCHAR) || ':42'), customer_id LIMIT 3"),
)
def picked_customers(spark, folder):
    return splits.pick_some(t.customer_table(spark, folder), "customer_id", 3, SEED).select(
        "customer_id", "tenure", "churn"
    )


@query(
    "label_encoding",
    on_customers("SELECT customer_id, CAST(dense_rank() OVER (ORDER BY segment) - 1 AS INTEGER) AS segment, balance, churn FROM customers"),
)
def label_encoding(spark, folder):
    frame, _, _ = encode.encode_features(t.customer_table(spark, folder), "customer_id", "churn")
    return frame.select("customer_id", "segment", "balance", "churn")


@query(
    "one_hot_encoding",
    on_customers(
        """, ranked_seg AS (SELECT DISTINCT segment, dense_rank() OVER (ORDER BY segment) AS k FROM customers)
        SELECT customer_id,
          CAST(segment = (SELECT segment FROM ranked_seg WHERE k = 2) AS DOUBLE) AS "segment_BUILDING",
          CAST(segment = (SELECT segment FROM ranked_seg WHERE k = 3) AS DOUBLE) AS "segment_FURNITURE",
          CAST(segment = (SELECT segment FROM ranked_seg WHERE k = 4) AS DOUBLE) AS "segment_HOUSEHOLD",
          CAST(segment = (SELECT segment FROM ranked_seg WHERE k = 5) AS DOUBLE) AS "segment_MACHINERY" FROM customers"""
    ),
)
def one_hot_encoding(spark, folder):
    frame, names = encode.one_hot(t.customer_table(spark, folder), ["segment"])
    return frame.select("customer_id", *names)


@query(
    "standardised_features",
    on_customers(
        _RANKED + """, s AS (SELECT *, rk <= round(n * 0.3) AS is_test FROM r),
        m AS (SELECT AVG(spend) AS ms, stddev_pop(spend) AS ss, AVG(days_silent) AS md, stddev_pop(days_silent) AS sd FROM s WHERE NOT is_test)
        SELECT customer_id, is_test, round((spend - ms) / ss, 8) AS spend, round((days_silent - md) / sd, 8) AS days_silent FROM s, m"""
    ),
)
def standardised_features(spark, folder):
    split = splits.stratified_hold_out(t.customer_table(spark, folder), ["churn"], "customer_id", 0.3, SEED)
    scaled = encode.standardise(split, ["spend", "days_silent"], train="is_test")
    return rounded(scaled.select("customer_id", "is_test", "spend", "days_silent"), 8, "spend", "days_silent")


@query(
    "class_balance",
    on_customers("SELECT churn, COUNT(*) AS customers, round(COUNT(*) / (SELECT COUNT(*) FROM customers), 6) AS share FROM customers GROUP BY 1"),
)
def class_balance(spark, folder):
    return rounded(encode.class_balance(t.customer_table(spark, folder), "churn"), 6, "share")


_HIST = ["balance", "orders", "spend", "days_silent"]


@query(
    "feature_histograms",
    on_customers(
        ", long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, churn, {c} AS v FROM customers" for c in _HIST) + """),
        b AS (SELECT feature, MIN(v) AS lo, MAX(v) AS hi FROM long GROUP BY 1)
        SELECT feature, churn, CAST(least(greatest(floor((v - lo) / ((hi - lo) / 20)) + 1, 1), 20) AS INTEGER) AS bin, COUNT(*) AS customers
        FROM long JOIN b USING (feature) GROUP BY 1, 2, 3"""
    ),
)
def feature_histograms(spark, folder):
    return encode.histograms(t.customer_table(spark, folder), _HIST, "churn")


@query(
    "score_histogram",
    on_customers(
        """SELECT 'score' AS feature, label, CAST(least(greatest(floor((score - 0.0) / ((1.0::DOUBLE - 0.0) / 40)) + 1, 1), 40) AS INTEGER) AS bin, COUNT(*) AS customers
        FROM scored GROUP BY 1, 2, 3""",
        SCORED_SQL,
    ),
)
def score_histogram(spark, folder):
    return encode.histograms(scored_customers(spark, folder), ["score"], "label", bins=40, bounds=(0.0, 1.0))


@query(
    "label_correlations",
    on_customers(
        ", c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, churn) AS correlation FROM customers" for c in NUMERIC) + """)
        SELECT feature, round(correlation, 9) AS correlation FROM c"""
    ),
)
def label_correlations(spark, folder):
    return rounded(
        encode.label_correlations(t.customer_table(spark, folder), NUMERIC, "churn", ends=4), 9, "correlation"
    )


@query(
    "threshold_metrics",
    on_customers(
        """, c AS (SELECT COUNT(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, COUNT(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
          COUNT(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, COUNT(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn, segment FROM scored GROUP BY segment)
        SELECT segment, round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(COALESCE(tp / NULLIF(tp + fp, 0), 0), 9) AS precision,
          round(COALESCE(tp / NULLIF(tp + fn, 0), 0), 9) AS recall, round(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 9) AS f1 FROM c""",
        SCORED_SQL,
    ),
)
def threshold_metrics(spark, folder):
    table = curves.threshold_metrics(scored_customers(spark, folder), ["segment"])
    return rounded(table, 9, "accuracy", "precision", "recall", "f1")


@query(
    "confusion_matrix",
    on_customers(
        """SELECT a.actual, p.predicted, COUNT(s.customer_id) AS customers FROM (SELECT UNNEST([0, 1]) AS actual) a CROSS JOIN (SELECT UNNEST([0, 1]) AS predicted) p
        LEFT JOIN scored s ON s.label = a.actual AND CAST(s.score >= 0.5 AS INTEGER) = p.predicted GROUP BY 1, 2""",
        SCORED_SQL,
    ),
)
def confusion_matrix(spark, folder):
    return curves.confusion(curves.classify(scored_customers(spark, folder)))


@query(
    "class_report",
    on_customers(
        """, c AS (SELECT COUNT(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, COUNT(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
          COUNT(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, COUNT(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn FROM scored),
        m AS (SELECT tn / NULLIF(tn + fn, 0) AS p0, tn / NULLIF(tn + fp, 0) AS r0, 2 * tn / NULLIF(2 * tn + fn + fp, 0) AS f0,
          tp / NULLIF(tp + fp, 0) AS p1, tp / NULLIF(tp + fn, 0) AS r1, 2 * tp / NULLIF(2 * tp + fp + fn, 0) AS f1, tn + fp AS n0, tp + fn AS n1, (tp + tn) / (tp + tn + fp + fn) AS acc FROM c)
        SELECT 'Stay' AS class, round(p0, 9) AS precision, round(r0, 9) AS recall, round(f0, 9) AS f1, n0 AS support FROM m
        UNION ALL SELECT 'Churn', round(p1, 9), round(r1, 9), round(m.f1, 9), n1 FROM m
        UNION ALL SELECT 'accuracy', round(acc, 9), round(acc, 9), round(acc, 9), n0 + n1 FROM m
        UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 9), round((r0 + r1) / 2, 9), round((f0 + m.f1) / 2, 9), n0 + n1 FROM m
        UNION ALL SELECT 'weighted avg', round((p0 * n0 + p1 * n1) / (n0 + n1), 9), round((r0 * n0 + r1 * n1) / (n0 + n1), 9), round((f0 * n0 + m.f1 * n1) / (n0 + n1), 9), n0 + n1 FROM m""",
        SCORED_SQL,
    ),
)
def class_report(spark, folder):
    report = curves.class_report(curves.classify(scored_customers(spark, folder)))
    return rounded(report, 9, "precision", "recall", "f1")


_COUNTS = """, k AS (SELECT score, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM scored GROUP BY 1),
  u AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC) AS tp, SUM(neg) OVER (ORDER BY score DESC) AS fp, SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM k)"""


@query(
    "ranking_metrics",
    on_customers(
        """, k AS (SELECT segment, score, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM scored GROUP BY 1, 2),
        u AS (SELECT *, SUM(pos) OVER (PARTITION BY segment ORDER BY score DESC) AS tp, SUM(neg) OVER (PARTITION BY segment ORDER BY score DESC) AS fp,
          SUM(neg) OVER (PARTITION BY segment ORDER BY score) AS below FROM k)
        SELECT segment, round(SUM(CAST(pos AS DOUBLE) * (below - neg + neg / 2)) / (SUM(pos) * SUM(neg)), 9) AS roc_auc,
          round(SUM(pos * CAST(tp AS DOUBLE) / (tp + fp)) / SUM(pos), 9) AS pr_auc FROM u GROUP BY 1""",
        SCORED_SQL,
    ),
)
def ranking_metrics(spark, folder):
    return rounded(curves.ranking_metrics(scored_customers(spark, folder), ["segment"]), 9, "roc_auc", "pr_auc")


@query(
    "roc_points",
    on_customers(_COUNTS + " SELECT score AS threshold, round(CAST(fp AS DOUBLE) / n, 9) AS fpr, round(CAST(tp AS DOUBLE) / p, 9) AS tpr FROM u", SCORED_SQL),
)
def roc_points(spark, folder):
    return rounded(curves.roc_points(scored_customers(spark, folder)), 9, "fpr", "tpr")


@query(
    "precision_recall_points",
    on_customers(
        _COUNTS + """ SELECT score AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 9) AS precision, round(CAST(tp AS DOUBLE) / p, 9) AS recall,
        round(CAST(p AS DOUBLE) / (p + n), 9) AS chance FROM u""",
        SCORED_SQL,
    ),
)
def precision_recall_points(spark, folder):
    return rounded(
        curves.precision_recall_points(scored_customers(spark, folder)), 9, "precision", "recall", "chance"
    )


_SEGMENT = """CASE WHEN score IS NULL THEN NULL WHEN score <= 0.4 THEN 'Low risk' WHEN score <= 0.7 THEN 'Medium risk' ELSE 'High risk' END"""


@query("customer_segments", on_customers(f"SELECT customer_id, score, label, {_SEGMENT} AS segment FROM scored", SCORED_SQL))
def customer_segments(spark, folder):
    return segments.risk_segments(scored_customers(spark, folder)).select("customer_id", "score", "label", "segment")


@query(
    "segment_summary",
    on_customers(
        f""", names AS (SELECT UNNEST({list(segments.SEGMENTS)}) AS segment), s AS (SELECT label, {_SEGMENT} AS segment FROM scored)
        SELECT names.segment, COUNT(s.segment) AS customers, round(AVG(label), 9) AS churn_rate, round(COUNT(s.segment) / (SELECT COUNT(*) FROM scored), 9) AS share,
        CASE names.segment {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in segments.ACTIONS.items())} END AS action
        FROM names LEFT JOIN s ON s.segment = names.segment GROUP BY 1""",
        SCORED_SQL,
    ),
)
def segment_summary(spark, folder):
    labelled = segments.risk_segments(scored_customers(spark, folder))
    return rounded(segments.with_actions(segments.segment_summary(labelled)), 9, "churn_rate", "share")


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
CUTOFFS = ("2024-01-13", "2024-01-19", "2024-01-24")


@query(
    "lookalike_profiles",
    """WITH cuts AS (SELECT CAST(UNNEST(['2024-01-13', '2024-01-19', '2024-01-24']) AS DATE) AS cutoff),
    e AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type, CAST(value AS DECIMAL(18,4)) AS v, cutoff FROM events, cuts
      WHERE (CAST(ts AS DATE) >= cutoff - 12 AND CAST(ts AS DATE) < cutoff) OR (CAST(ts AS DATE) >= cutoff + 2 AND CAST(ts AS DATE) < cutoff + 6))
    SELECT user_id, cutoff, """
    + ", ".join(f"COUNT(*) FILTER (WHERE d < cutoff AND event_type = '{e}') AS n_{e}" for e in EVENT_TYPES)
    + """, COUNT(*) FILTER (WHERE d < cutoff) AS events, COUNT(DISTINCT CASE WHEN d < cutoff THEN d END) AS active_days,
      CAST(SUM(v) FILTER (WHERE d < cutoff) AS DOUBLE) AS total_value, CAST(cutoff - MAX(d) FILTER (WHERE d < cutoff) AS INTEGER) AS days_since_last,
      CAST(COUNT(*) FILTER (WHERE d >= cutoff AND event_type = 'purchase') > 0 AS INTEGER) AS label
    FROM e GROUP BY 1, 2 HAVING COUNT(*) FILTER (WHERE d < cutoff) > 0""",
)
def lookalike_profiles(spark, folder):
    """Windows of 12, 2 and 4 days before and after three cut-off days."""
    return lookalike.lookalike_profiles(
        t.table(spark, folder, "events"), CUTOFFS, "purchase", EVENT_TYPES,
        observation_days=12, buffer_days=2, outcome_days=4,
    )


# --------------------------------------------------------------------------
# Survival
# --------------------------------------------------------------------------

SURV_SQL = "surv AS (SELECT *, churn = 1 AS event, tenure AS time FROM customers)"


def survival_table(spark, folder):
    return survival.event_time(t.customer_table(spark, folder), "churn", "tenure")


def _km(name: str, source: str, key: str = "", reverse: bool = False) -> str:
    """Kaplan-Meier of ``source`` as CTE ``name``; ``key`` is a grouping column."""
    pick, part = (f"{key}, ", f"PARTITION BY {key}") if key else ("", "")
    hit, exposed = ("c", "(n - d)") if reverse else ("d", "n")
    return f"""{name}_lt AS (SELECT {pick}time, COUNT(*) FILTER (WHERE event) AS d, COUNT(*) FILTER (WHERE NOT event) AS c, COUNT(*) AS k FROM {source} GROUP BY ALL),
  {name}_nr AS (SELECT *, CAST(SUM(k) OVER ({part} ORDER BY time DESC) AS BIGINT) AS n FROM {name}_lt),
  {name} AS (SELECT {pick}time, d, c, n, PRODUCT(1 - COALESCE({hit} / NULLIF({exposed}, 0), 0)) OVER ({part} ORDER BY time) AS s,
    SUM(COALESCE({hit} / NULLIF(CAST({exposed} AS DOUBLE) * ({exposed} - {hit}), 0), 0)) OVER ({part} ORDER BY time) AS v FROM {name}_nr)"""


@query(
    "event_summary",
    on_customers(
        """SELECT segment, COUNT(*) FILTER (WHERE event) AS events, COUNT(*) FILTER (WHERE NOT event) AS censored, round(AVG(churn), 9) AS event_share,
        round(1 - AVG(churn), 9) AS censored_share, MIN(time) AS min_time, MAX(time) AS max_time, median(time) AS median_time FROM surv GROUP BY 1""",
        SURV_SQL,
    ),
)
def event_summary(spark, folder):
    return rounded(
        survival.event_summary(survival_table(spark, folder), ["segment"]), 9, "event_share", "censored_share"
    )


@query(
    "kaplan_meier",
    on_customers(
        """SELECT time, d AS events, c AS censored, n AS at_risk, round(s, 9) AS surv,
        round(CASE WHEN s >= 1 THEN 1 WHEN s <= 0 THEN 0 ELSE exp(exp(-1.959963984540054 * sqrt(v) / ln(s)) * ln(s)) END, 9) AS conf_lo,
        round(CASE WHEN s >= 1 THEN 1 WHEN s <= 0 THEN 0 ELSE exp(exp(1.959963984540054 * sqrt(v) / ln(s)) * ln(s)) END, 9) AS conf_hi FROM km""",
        SURV_SQL, _km("km", "surv"),
    ),
)
def kaplan_meier(spark, folder):
    curve = survival.kaplan_meier(survival_table(spark, folder), confidence=0.95)
    return rounded(curve, 9, "surv", "conf_lo", "conf_hi")


@query(
    "kaplan_meier_by_segment",
    on_customers("SELECT segment, time, d AS events, c AS censored, n AS at_risk, round(s, 9) AS surv FROM km", SURV_SQL, _km("km", "surv", "segment")),
)
def kaplan_meier_by_segment(spark, folder):
    return rounded(survival.kaplan_meier(survival_table(spark, folder), ["segment"]), 9, "surv")


@query(
    "censoring_curve",
    on_customers("SELECT time, d AS events, c AS censored, n AS at_risk, round(s, 9) AS surv FROM km", SURV_SQL, _km("km", "surv", reverse=True)),
)
def censoring_curve(spark, folder):
    return rounded(survival.kaplan_meier(survival_table(spark, folder), reverse=True), 9, "surv")


@query(
    "survival_at_months",
    on_customers(
        """SELECT segment, m AS time, round(CASE WHEN MAX(time) >= m THEN COALESCE(arg_max(s, time) FILTER (WHERE time <= m), 1) END, 9) AS surv
        FROM km, (SELECT UNNEST([6, 12, 24, 36]::DOUBLE[]) AS m) GROUP BY segment, m""",
        SURV_SQL, _km("km", "surv", "segment"),
    ),
)
def survival_at_months(spark, folder):
    curve = survival.kaplan_meier(survival_table(spark, folder), ["segment"])
    return rounded(survival.survival_at(curve, (6, 12, 24, 36), ["segment"]), 9, "surv")


RISK_SQL = "risky AS (SELECT *, round((orders * 2 + urgent) / 3, 1) AS risk, rk <= round(n * 0.3) AS is_test FROM (SELECT *, row_number() OVER (PARTITION BY churn ORDER BY md5(CAST(customer_id AS VARCHAR) || ':42'), customer_id) AS rk, COUNT(*) OVER (PARTITION BY churn) AS n FROM surv))"


def risk_table(spark, folder):
    """Customers with a plain deterministic risk and a stratified 30% test flag."""
    base = survival_table(spark, folder).withColumn(
        "risk", F.round((F.col("orders") * 2 + F.col("urgent")) / 3, 1)
    )
    return splits.stratified_hold_out(base, ["churn"], "customer_id", 0.3, SEED)


@query(
    "concordance_index",
    on_customers(
        """, p AS (SELECT a.segment, a.risk AS ra, b.risk AS rb FROM risky a JOIN risky b ON a.segment = b.segment
            AND a.event AND (a.time < b.time OR (a.time = b.time AND NOT b.event)))
        SELECT segment, round((COUNT(*) FILTER (WHERE ra > rb) + COUNT(*) FILTER (WHERE ra = rb) / 2) / COUNT(*), 9) AS c_index,
          CAST(COUNT(*) FILTER (WHERE ra > rb) AS DOUBLE) AS concordant, CAST(COUNT(*) FILTER (WHERE ra = rb) AS DOUBLE) AS tied, CAST(COUNT(*) AS DOUBLE) AS comparable FROM p GROUP BY 1""",
        SURV_SQL, RISK_SQL,
    ),
)
def concordance_index(spark, folder):
    return rounded(survival.concordance(risk_table(spark, folder), ["segment"]), 9, "c_index")


_WINDOW = """hz AS (SELECT least((SELECT MAX(time) FROM risky WHERE NOT is_test), (SELECT MAX(time) FROM risky WHERE is_test)) AS horizon),
  win AS (SELECT risky.* FROM risky, hz WHERE is_test AND time < horizon),
  ts AS (SELECT DISTINCT UNNEST(quantile_cont(time, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS t FROM win WHERE event),
  tr AS (SELECT * FROM risky WHERE NOT is_test)"""
_G = """gw AS (SELECT win.*, COALESCE((SELECT arg_max(s, g.time) FROM g WHERE g.time <= win.time), 1) AS gt FROM win)"""


def _split(spark, folder):
    rows = cut_lineage(risk_table(spark, folder))  # read many times below
    train, test = rows.filter(~F.col("is_test")), rows.filter("is_test")
    window = survival.evaluation_window(train, test)
    return train, survival.in_window(test, window), window


@query(
    "evaluation_window",
    on_customers("SELECT horizon, round(t, 6) AS t FROM hz, ts", SURV_SQL, RISK_SQL, _WINDOW),
)
def evaluation_window(spark, folder):
    _, _, window = _split(spark, folder)
    rows = [(window.horizon, t) for t in window.times]
    return rounded(spark.createDataFrame(rows, "horizon DOUBLE, t DOUBLE"), 6, "t")


_AUC = """ca AS (SELECT t, risk, SUM(CASE WHEN event AND time <= t THEN 1 / gt ELSE 0 END) AS w, COUNT(*) FILTER (WHERE time > t) AS c FROM gw, ts GROUP BY 1, 2),
  cb AS (SELECT *, SUM(c) OVER (PARTITION BY t ORDER BY risk) AS below FROM ca),
  auc AS (SELECT t, SUM(w * (below - c + c / 2)) / NULLIF(SUM(w) * SUM(c), 0) AS auc FROM cb GROUP BY 1)"""


@query(
    "dynamic_auc",
    on_customers("SELECT round(t, 6) AS t, round(auc, 9) AS auc FROM auc", SURV_SQL, RISK_SQL, _WINDOW, _km("g", "tr", reverse=True), _G, _AUC),
)
def dynamic_auc(spark, folder):
    train, test, _ = _split(spark, folder)
    return rounded(rounded(survival.dynamic_auc(train, test), 9, "auc"), 6, "t")


@query(
    "mean_dynamic_auc",
    on_customers(
        """, st AS (SELECT auc.*, COALESCE((SELECT arg_max(s, k.time) FROM k WHERE k.time <= auc.t), 1) AS s FROM auc),
        dr AS (SELECT *, COALESCE(lag(s) OVER (ORDER BY t), 1) - s AS dropped FROM st)
        SELECT round(CASE WHEN COUNT(*) = 1 THEN MAX(auc) ELSE SUM(auc * dropped) / (1 - MIN(s)) END, 9) AS mean_auc FROM dr""",
        SURV_SQL, RISK_SQL, _WINDOW, _km("g", "tr", reverse=True), _G, _AUC, _km("k", "win"),
    ),
)
def mean_dynamic_auc(spark, folder):
    train, test, _ = _split(spark, folder)
    return rounded(survival.mean_dynamic_auc(survival.dynamic_auc(train, test), test), 9, "mean_auc")


_BRIER = """pr AS (SELECT gw.*, t, exp(-t / (risk * 4 + 1)) AS sp, COALESCE((SELECT arg_max(s, g.time) FROM g WHERE g.time <= t), 1) AS g_t FROM gw, ts),
  br AS (SELECT t, AVG(CASE WHEN event AND time <= t THEN sp * sp / gt WHEN time > t THEN (1 - sp) * (1 - sp) / g_t ELSE 0 END) AS brier FROM pr GROUP BY 1)"""


def _scored_curves(test):
    return test.withColumn("t", F.explode("eval_times")).withColumn(
        "surv", F.exp(-F.col("t") / (F.col("risk") * 4 + 1))
    )


@query(
    "brier_scores",
    on_customers("SELECT round(t, 6) AS t, round(brier, 9) AS brier FROM br", SURV_SQL, RISK_SQL, _WINDOW, _km("g", "tr", reverse=True), _G, _BRIER),
)
def brier_scores(spark, folder):
    train, test, _ = _split(spark, folder)
    return rounded(rounded(survival.brier_scores(train, _scored_curves(test)), 9, "brier"), 6, "t")


@query(
    "integrated_brier",
    on_customers(
        """, a AS (SELECT t, (brier + lag(brier) OVER (ORDER BY t)) / 2 * (t - lag(t) OVER (ORDER BY t)) AS area FROM br)
        SELECT round(SUM(area) / NULLIF(MAX(t) - MIN(t), 0), 9) AS integrated_brier FROM a""",
        SURV_SQL, RISK_SQL, _WINDOW, _km("g", "tr", reverse=True), _G, _BRIER,
    ),
)
def integrated_brier(spark, folder):
    train, test, _ = _split(spark, folder)
    scores = survival.brier_scores(train, _scored_curves(test))
    return rounded(survival.integrated_brier(scores), 9, "integrated_brier")


_QUART = """q AS (SELECT quantile_cont(risk, [0.25, 0.5, 0.75]) AS e FROM risky WHERE is_test),
  strata AS (SELECT risky.*, CASE WHEN risk <= e[1] THEN 'Low' WHEN risk <= e[2] THEN 'Medium' WHEN risk <= e[3] THEN 'High' ELSE 'Very high' END AS risk_group FROM risky, q WHERE is_test)"""


@query(
    "risk_strata",
    on_customers(
        "SELECT risk_group, COUNT(*) AS customers, round(AVG(churn), 9) AS churn_rate, round(AVG(time), 9) AS mean_tenure FROM strata GROUP BY 1",
        SURV_SQL, RISK_SQL, _QUART,
    ),
)
def risk_strata(spark, folder):
    grouped = survival.risk_quartiles(risk_table(spark, folder).filter("is_test"))
    return rounded(survival.strata_summary(grouped), 9, "churn_rate", "mean_tenure")


@query(
    "kaplan_meier_by_risk",
    on_customers(
        "SELECT risk_group, time, d AS events, c AS censored, n AS at_risk, round(s, 9) AS surv FROM km",
        SURV_SQL, RISK_SQL, _QUART, _km("km", "strata", "risk_group"),
    ),
)
def kaplan_meier_by_risk(spark, folder):
    grouped = survival.risk_quartiles(risk_table(spark, folder).filter("is_test"))
    return rounded(survival.kaplan_meier(grouped, ["risk_group"]), 9, "surv")
