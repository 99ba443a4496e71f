"""Time-to-event estimation and evaluation on a table of (event, time).

Everything starts from counts per distinct time, and ordered sums go through
``scan.running``; time may be months with sixty values or a continuous clock.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from inspect import signature
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.functions.numbers import ratio, right_closed_bucket
from tidemark.operators.scan import FEW_ROWS, _with_bin, exact_quantiles, materialise, running
from tidemark.runtime import cut_lineage

RISK_LEVELS = ("Low", "Medium", "High", "Very high")


def event_time(df: DataFrame, event: str = "Churn", time: str = "Tenure") -> DataFrame:
    """Add ``event`` (did it happen) and ``time`` (how long we watched)."""
    return df.withColumn("event", F.col(event).cast("boolean")).withColumn("time", F.col(time).cast("double"))


def event_summary(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Events, censored, their shares, and range and median of the time."""
    keys = list(keys)
    counts = df.groupBy(*keys).agg(
        F.count_if("event").alias("events"),
        F.count_if(~F.col("event")).alias("censored"),
        F.avg(F.col("event").cast("double")).alias("event_share"),
        F.avg((~F.col("event")).cast("double")).alias("censored_share"),
        F.min("time").alias("min_time"),
        F.max("time").alias("max_time"),
    )
    medians = exact_quantiles(df, keys, "time", [0.5]).select(
        *keys, F.col("quantiles")[0].alias("median_time")
    )
    if keys:
        return counts.join(medians, keys)
    return counts.withColumn("median_time", F.lit(medians.first()[0]))


def _leavers(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, "time").agg(
        F.count_if("event").alias("events"),
        F.count_if(~F.col("event")).alias("censored"),
        F.count(F.lit(1)).alias("leaving"),
    )


def life_table(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per distinct time: events, censored, leavers, and the number still at risk."""
    counts, rows = materialise(_leavers(df, keys))
    return _at_risk(counts, keys, rows)


def _at_risk(counts: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    return running(counts, keys, "time", sums=["leaving"], descending=True, rows=rows).withColumnRenamed(
        "leaving_run", "at_risk"
    )


def kaplan_meier(
    df: DataFrame, keys: Sequence[str] = (), confidence: float | None = None, reverse: bool = False
) -> DataFrame:
    """Product-limit estimate per group.

    ``confidence`` adds a log-log band from the Greenwood variance.  ``reverse``
    estimates the censoring distribution instead: at tied times events leave the
    risk set before the censored do.
    """
    counts, rows = materialise(_leavers(df, keys))
    table = _at_risk(counts, keys, rows)
    if reverse:
        hits, exposed = F.col("censored"), F.col("at_risk") - F.col("events")
    else:
        hits, exposed = F.col("events"), F.col("at_risk")
    table = table.withColumn("surv", 1 - F.coalesce(ratio(hits, exposed), F.lit(0.0)))
    variance = ratio(hits, exposed.cast("double") * (exposed - hits))
    table = table.withColumn("var", F.coalesce(variance, F.lit(0.0)))
    if rows > FEW_ROWS:
        table = cut_lineage(table)
    curve = running(table, keys, "time", sums=["var"], products=["surv"], rows=rows).drop("surv", "var")
    curve = curve.withColumnsRenamed({"surv_run": "surv", "var_run": "var"})
    if confidence is not None:
        z = NormalDist().inv_cdf(0.5 + confidence / 2)
        log_s = F.ln(F.when((F.col("surv") > 0) & (F.col("surv") < 1), F.col("surv")))
        theta = F.sqrt("var") / log_s * z
        inner = F.when(F.col("surv") > 0, F.lit(1.0)).otherwise(0.0)
        curve = curve.withColumns(
            {
                "conf_lo": F.coalesce(F.exp(F.exp(-theta) * log_s), inner),
                "conf_hi": F.coalesce(F.exp(F.exp(theta) * log_s), inner),
            }
        )
    return curve.drop("var", "leaving")


def survival_at(curve: DataFrame, times: Sequence[float], keys: Sequence[str] = (), surv: str = "surv") -> DataFrame:
    """Read S(t) off a curve at fixed times: the value at the last time up to t.

    Times beyond the observed range give NULL, times before it 1.
    """
    picks = [
        F.when(F.max("time") >= t, F.coalesce(F.max_by(surv, F.when(F.col("time") <= t, F.col("time"))), F.lit(1.0)))
        .alias(f"_{i}")
        for i, t in enumerate(times)
    ]
    wide = curve.groupBy(*keys).agg(*picks)
    entries = F.array(
        *[F.struct(F.lit(float(t)).alias("time"), F.col(f"_{i}").alias("surv")) for i, t in enumerate(times)]
    )
    return wide.select(*keys, F.inline(entries))


def step_values(points: DataFrame, curve: DataFrame, value: str = "surv", start: float = 1.0) -> DataFrame:
    """Value of a step function at every distinct time of ``points``.

    An as-of lookup: both sets of distinct times share one ordered axis and the
    last known value is carried forward.
    """
    asked = points.select("time").distinct().select("time", F.lit(None).cast("double").alias("_v"), F.lit(1).alias("_asked"))
    known = curve.select("time", F.col(value).cast("double").alias("_v"), F.lit(0).alias("_asked"))
    merged = asked.unionByName(known).groupBy("time").agg(F.max("_v").alias("_v"), F.max("_asked").alias("_asked"))
    carried = running(merged, [], "time", lasts=["_v"])
    return carried.filter(F.col("_asked") == 1).select(
        "time", F.coalesce("_v_run", F.lit(start)).alias(value)
    )


def concordance(
    df: DataFrame, keys: Sequence[str] = (), risk: str = "risk", event: str = "event", time: str = "time"
) -> DataFrame:
    """Concordance index over all comparable pairs, without forming a pair.

    A pair is comparable when the earlier one had the event, or both share the
    time and only one had it: in the order of times, and at a time of events
    before the censored, the event comes first.  Two places in that order first
    differ in one digit of base 256, so rows grouped by (digit, leading digits)
    hold every pair in one group, and there are as many rows as digits.  Within
    a group, pairs from different bins of the risk follow from one sum per bin
    and digit value, pairs inside a bin are counted by the task that holds it.
    """
    keys = list(keys)
    cells, _ = materialise(
        df.groupBy(*keys, F.col(time).alias("_t"), F.col(event).alias("_e"), F.col(risk).cast("double").alias("_r")).agg(
            F.count(F.lit(1)).alias("_n")
        )
    )
    times, n_times = materialise(cells.select("_t").distinct().withColumn("_one", F.lit(1)))
    ranks = running(times, [], "_t", sums=["_one"], rows=n_times).select("_t", (F.col("_one_run") * 2).cast("bigint").alias("_rank"))
    placed = cells.join(ranks, ["_t"]).withColumn("_place", F.col("_rank") + F.when(F.col("_e"), 0).otherwise(1))
    digits = F.sequence(F.lit(0), F.lit((2 * n_times + 1).bit_length() - 1 >> 3))
    group = [*keys, "_digit", "_head"]
    sums, n_sums = materialise(
        placed.withColumn("_digit", F.explode(digits))
        .groupBy(*group[:-1], F.expr("shiftright(_place, 8 * (_digit + 1))").alias("_head"), F.expr("int(shiftright(_place, 8 * _digit) & 255)").alias("_d"), "_r")
        .agg(F.sum(F.when(F.col("_e"), F.col("_n")).otherwise(0)).cast("double").alias("early"), F.sum("_n").cast("double").alias("late"))
    )
    binned = _with_bin(sums, "_r", n_sums) if n_sums > FEW_ROWS else sums.withColumn("_bin", F.lit(0))
    totals = binned.groupBy(*group, "_bin", "_d").agg(F.sum("early").alias("early"), F.sum("late").alias("late"))
    found = StructType([*[f for f in sums.schema.fields if f.name in keys], *[StructField(c, DoubleType()) for c in ("concordant", "tied", "comparable")]])
    counted = binned.groupBy(*group, "_bin").applyInArrow(_pairs_by_group(keys, _pairs_inside), found).unionByName(
        totals.groupBy(*group).applyInArrow(_pairs_by_group(keys, _pairs_across), found)
    )
    both = counted.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("concordant", "tied", "comparable")])
    return both.select(
        *keys,
        ratio(F.col("concordant") + F.col("tied") / 2, F.col("comparable")).alias("c_index"),
        "concordant", "tied", "comparable",
    )


def _pairs_by_group(keys: Sequence[str], count):
    """A grouped map that gives the keys of a group and what ``count`` makes of its rows."""

    def run(key, table):
        columns = {k: pa.array([v.as_py()], v.type) for k, v in zip(keys, key)}
        return pa.table(columns | {c: [float(v)] for c, v in zip(("concordant", "tied", "comparable"), count(table))})

    return run


def _pairs_inside(table: pa.Table) -> tuple[float, float, float]:
    """Concordant and tied pairs of one bin: the earlier has the lower digit value, concordant pairs its higher risk."""
    d, early, late = (table[c].to_numpy() for c in ("_d", "early", "late"))
    # a missing risk is lower than any, NaN is higher
    r = np.unique(table["_r"].fill_null(-np.inf).to_numpy(), return_inverse=True)[1]
    concordant = tied = 0.0
    for bit in range(8):
        head, after = d >> (bit + 1), (d >> bit) & 1
        if not after.any() or after.all():
            continue
        order = np.lexsort((r, head))
        h, q = head[order], r[order]
        weight = np.concatenate([[0.0], np.cumsum(np.where(after, late, 0.0)[order])])
        new_head = np.concatenate([[True], h[1:] != h[:-1]])
        new_run = new_head | np.concatenate([[True], q[1:] != q[:-1]])
        run_at, head_at = np.flatnonzero(new_run), np.flatnonzero(new_head)
        run, of_head = np.cumsum(new_run) - 1, np.cumsum(new_head) - 1
        run_end = np.append(run_at[1:], len(h))
        first = np.where(after, 0.0, early)[order]
        concordant += (first * (weight[run_at][run] - weight[head_at][of_head])).sum()
        tied += (first * (weight[run_end] - weight[run_at])[run]).sum()
    return concordant, tied, 0.0


def _pairs_across(table: pa.Table) -> tuple[float, float, float]:
    """Concordant pairs of different bins, and all comparable pairs, of one group."""
    bins, at = np.unique(table["_bin"].to_numpy(), return_inverse=True)
    early, late = np.zeros((len(bins), 257)), np.zeros((len(bins), 257))
    early[at, table["_d"].to_numpy()], late[at, table["_d"].to_numpy()] = table["early"].to_numpy(), table["late"].to_numpy()
    above = np.cumsum(late[:, ::-1], axis=1)[:, ::-1][:, 1:]  # rows with a higher digit value
    below = np.cumsum(above, axis=0) - above
    return (early[:, :-1] * below).sum(), 0.0, (early[:, :-1].sum(0) * above.sum(0)).sum()


# --------------------------------------------------------------------------
# Evaluation inside the observed window
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class EvaluationWindow:
    """Where models are graded: strictly before ``horizon``, at ``times``."""

    horizon: float
    times: list[float]


def evaluation_window(train: DataFrame, test: DataFrame, points: int = 9) -> EvaluationWindow:
    """The smaller of the two largest times, and at most ``points`` grading times.

    Those are the distinct 10..90% percentiles of the test events strictly
    before the horizon.
    """
    horizon = min(frame.agg(F.max("time")).first()[0] for frame in (train, test))
    inside = test.filter((F.col("time") < horizon) & F.col("event"))
    probabilities = [0.1 + 0.8 * i / (points - 1) for i in range(points)]
    row = exact_quantiles(inside, [], "time", probabilities).first()
    return EvaluationWindow(horizon, sorted({v for v in row["quantiles"] if v is not None}))


def in_window(test: DataFrame, window: EvaluationWindow) -> DataFrame:
    """Test rows strictly inside the horizon, with the grading times attached."""
    times = F.array(*[F.lit(float(t)) for t in window.times]).cast("array<double>")
    return test.filter(F.col("time") < window.horizon).withColumn("eval_times", times)


def _censoring_weights(train: DataFrame, rows: DataFrame) -> DataFrame:
    """``g``: probability of still being observed at the row's own time."""
    censoring = kaplan_meier(train, reverse=True)
    lookup = step_values(rows, censoring).withColumnRenamed("surv", "g")
    return rows.join(lookup, ["time"], "left")


def dynamic_auc(
    train: DataFrame, test: DataFrame, keys: Sequence[str] = (), risk: str = "risk"
) -> DataFrame:
    """AUC(t): cases had the event up to t, controls are still there after it.

    Cases weigh 1/G(their time), with G from the training rows.  ``test`` comes
    from ``in_window``.  Rows meet each grading time at most once; ranks are
    running sums per (group, t).
    """
    keys = list(keys)
    weighted = _censoring_weights(train, test)
    at = (
        weighted.select(*keys, "time", "event", "g", F.col(risk).alias("_r"), F.explode("eval_times").alias("t"))
        .withColumn("_case", F.col("event") & (F.col("time") <= F.col("t")))
        .withColumn("_control", F.col("time") > F.col("t"))
    )
    sums = at.groupBy(*keys, "t", "_r").agg(
        F.sum(F.when(F.col("_case"), ratio(F.lit(1.0), F.col("g")))).alias("_w"),
        F.count_if("_control").alias("_c"),
    ).withColumn("_w", F.coalesce("_w", F.lit(0.0)))
    ordered = running(sums, [*keys, "t"], "_r", sums=["_c"])
    won = F.col("_w") * (F.col("_c_run") - F.col("_c") + F.col("_c") / 2)
    return ordered.groupBy(*keys, "t").agg(
        ratio(F.sum(won), F.sum("_w") * F.sum("_c")).alias("auc")
    )


def mean_dynamic_auc(auc: DataFrame, test: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Average of AUC(t), each t weighted by the drop of the survival curve up to it.

    There are at most nine grading times per group.
    """
    curve = kaplan_meier(test.select("time", "event"))
    drops = step_values(auc.select(F.col("t").alias("time")), curve)
    joined = auc.join(drops.withColumnRenamed("time", "t"), ["t"])
    before = F.coalesce(F.lag("surv").over(W.partitionBy(*keys).orderBy("t")), F.lit(1.0))
    joined = joined.withColumn("_drop", before - F.col("surv"))
    return joined.groupBy(*keys).agg(
        F.when(F.count(F.lit(1)) == 1, F.max("auc"))
        .otherwise(ratio(F.sum(F.col("auc") * F.col("_drop")), 1 - F.min("surv")))
        .alias("mean_auc")
    )


def brier_scores(
    train: DataFrame, scored_curves: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Censoring-corrected squared error of S(t) at every grading time.

    ``scored_curves`` holds ``time, event, t, surv``: one row per customer and t.
    A customer whose censoring weight is 0 has no loss and is not averaged.
    """
    keys = list(keys)
    weighted = _censoring_weights(train, scored_curves)
    grading = scored_curves.select(F.col("t").alias("time")).distinct()
    at_t = step_values(grading, kaplan_meier(train, reverse=True)).select(
        F.col("time").alias("t"), F.col("surv").alias("g_t")
    )
    rows = weighted.join(at_t, ["t"])
    case = F.col("event") & (F.col("time") <= F.col("t"))
    control = F.col("time") > F.col("t")
    loss = (
        F.when(case, ratio(F.col("surv") * F.col("surv"), F.col("g")))
        .when(control, ratio((1 - F.col("surv")) * (1 - F.col("surv")), F.col("g_t")))
        .otherwise(0.0)
    )
    return rows.groupBy(*keys, "t").agg(F.avg(loss).alias("brier"))


def integrated_brier(brier: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Trapezoid over the grading times divided by their range."""
    ordered = W.partitionBy(*keys).orderBy("t")
    area = (F.col("brier") + F.lag("brier").over(ordered)) / 2 * (F.col("t") - F.lag("t").over(ordered))
    return brier.withColumn("_area", area).groupBy(*keys).agg(
        ratio(F.sum("_area"), F.max("t") - F.min("t")).alias("integrated_brier")
    )


def risk_quartiles(df: DataFrame, risk: str = "risk", levels: Sequence[str] = RISK_LEVELS) -> DataFrame:
    """Label rows by the quartile of their predicted risk; equal edges collapse."""
    cuts = [(i + 1) / len(levels) for i in range(len(levels) - 1)]
    edges = exact_quantiles(df, [], risk, cuts).first()["quantiles"]
    return df.withColumn("risk_group", right_closed_bucket(F.col(risk), edges, list(levels)))


def strata_summary(df: DataFrame, group: str = "risk_group") -> DataFrame:
    """Size, event rate and mean time per risk group."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(F.col("event").cast("double")).alias("churn_rate"),
        F.avg("time").alias("mean_tenure"),
    )


def _with_risk(model, df: DataFrame, id_column: str) -> DataFrame:
    """Risk column of any model; some need the customer's key to attach it."""
    wants = "id_column" in signature(model.with_risk).parameters
    return model.with_risk(df, id_column) if wants else model.with_risk(df)


def _survival_at(model, df: DataFrame, id_column: str, times: Sequence[float]) -> DataFrame:
    wants = "id_column" in signature(model.survival_at).parameters
    return model.survival_at(df, id_column, times) if wants else model.survival_at(df, times)


def score_survival_models(models: dict, rows: DataFrame, id_column: str, keep: Sequence[str] = ()) -> DataFrame:
    """model, key, event, time, ``keep`` and risk of every row under every model."""
    parts = [
        _with_risk(m, rows, id_column).select(F.lit(name).alias("model"), id_column, "event", "time", *keep, F.col("risk").cast("double").alias("risk"))
        for name, m in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def evaluate_survival_models(models: dict, train: DataFrame, test: DataFrame, id_column: str) -> DataFrame:
    """One row per model: concordance on both sides, mean AUC(t), and the Brier score of models that have a curve.

    What a model offers decides what it is graded on: ``has_survival`` says
    whether it has S(t), and without it the Brier score is NULL.
    """
    window = evaluation_window(train, test)
    sides = train.withColumn("_side", F.lit("train_c")).unionByName(test.withColumn("_side", F.lit("test_c")))
    scored = cut_lineage(score_survival_models(models, sides, id_column, ["_side"]))
    c_index = concordance(scored, ["model", "_side"]).groupBy("model").pivot("_side", ["train_c", "test_c"]).agg(F.max("c_index"))
    tested = cut_lineage(in_window(scored.where(F.col("_side") == "test_c"), window))
    auc = mean_dynamic_auc(dynamic_auc(train, tested, ["model"]), in_window(test, window), ["model"])
    table = c_index.withColumn("gap", F.col("train_c") - F.col("test_c")).join(auc, "model", "left")
    able = {name: m for name, m in models.items() if m.has_survival}
    if not able:
        return table.withColumn("integrated_brier", F.lit(None).cast("double"))
    inside = in_window(test, window)
    curves = [_survival_at(m, inside, id_column, window.times).select(F.lit(name).alias("model"), "event", "time", "t", "surv") for name, m in able.items()]
    brier = brier_scores(train, cut_lineage(reduce(DataFrame.unionByName, curves)), ["model"])
    return table.join(integrated_brier(brier, ["model"]), "model", "left")


def best_survival_model(evaluation: DataFrame) -> DataFrame:
    """The model that orders the test rows best; ties go to the first name."""
    return evaluation.orderBy(F.col("test_c").desc_nulls_last(), "model").limit(1)
