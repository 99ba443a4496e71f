"""Cox proportional hazards by distributed Newton steps.

Each step reads the rows once: the weight, the weighted features and their
products are summed per distinct time by built-in sums, carried backwards over
the times by the scan, and added up to p + p*p numbers, for which the driver
solves a p-by-p system.  Rows are never joined.  Tied events follow Breslow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scan import FEW_ROWS, running
from tidemark.runtime import cut_lineage, right_sized


def linear(features: Sequence[str], weights: Sequence[float]) -> Column:
    """Weighted sum of feature columns.

    The weights are one array literal, so the generated code of a Newton step
    is the same text every time and is compiled once.
    """
    values = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    factors = F.array(*[F.lit(float(w)) for w in weights])
    return F.aggregate(F.zip_with(values, factors, lambda v, w: v * w), F.lit(0.0), lambda a, v: a + v)


def cross_gram(df: DataFrame, left: Sequence[str], right: Sequence[str], weight: str | None = None) -> np.ndarray:
    """Sum over rows of weight * left * right', as a small matrix on the driver.

    Every partition multiplies its Arrow batches into one small block; only the
    cells of those blocks are shuffled and added up.
    """
    rows, columns = list(left), list(right)
    shape = (len(rows), len(columns))

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = np.zeros(shape)
        for batch in batches:
            values = batch[rows].to_numpy(dtype=float)
            if weight is not None:
                values = values * batch[weight].to_numpy(dtype=float)[:, None]
            block += values.T @ batch[columns].to_numpy(dtype=float)
        yield pd.DataFrame({"cell": np.arange(block.size, dtype=np.int32), "value": block.ravel()})

    needed = dict.fromkeys([*rows, *columns, *([weight] if weight else [])])
    cells = df.select(*[F.col(f"`{c}`") for c in needed]).mapInPandas(multiply, "cell INT, value DOUBLE")
    out = np.zeros(shape[0] * shape[1])
    for row in cells.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[row["cell"]] = row["value"]
    return out.reshape(shape)


def weighted_gram(df: DataFrame, weight: str, columns: Sequence[str]) -> np.ndarray:
    """Sum over rows of weight * x * x'."""
    return cross_gram(df, columns, columns, weight)


@dataclass
class CoxModel:
    """Coefficients and baseline hazard of a fitted model; it has S(t)."""

    features: list[str]
    coefficients: np.ndarray
    gradient: np.ndarray
    iterations: int
    baseline: DataFrame
    converged: bool = True
    has_survival = True

    def with_risk(self, df: DataFrame, out: str = "risk") -> DataFrame:
        """Higher risk means the event comes sooner."""
        return df.withColumn(out, linear(self.features, self.coefficients))

    def hazard_ratios(self) -> DataFrame:
        """Effect per feature, smallest first."""
        rows = [(f, float(b), float(np.exp(b))) for f, b in zip(self.features, self.coefficients)]
        spark = self.baseline.sparkSession
        return spark.createDataFrame(rows, "feature STRING, coefficient DOUBLE, hazard_ratio DOUBLE").orderBy(
            "coefficient"
        )

    def survival_at(self, df: DataFrame, times: Sequence[float]) -> DataFrame:
        """S(t) per row at a few times: columns ``t`` and ``surv``.

        The cumulative hazard is read off once per time and carried as literals,
        so customers and times are not joined.
        """
        known = [
            F.coalesce(F.max_by("cumulative_hazard", F.when(F.col("time") <= t, F.col("time"))), F.lit(0.0)).alias(f"h{i}")
            for i, t in enumerate(times)
        ]
        hazards = self.baseline.agg(*known).first()
        grid = F.array(
            *[F.struct(F.lit(float(t)).alias("t"), F.lit(float(h)).alias("_h")) for t, h in zip(times, hazards)]
        )
        return (
            self.with_risk(df)
            .select("*", F.inline(grid))
            .withColumn("surv", F.exp(-F.col("_h") * F.exp("risk")))
            .drop("_h")
        )

    def curves(self, df: DataFrame, id_column: str, most: int = 1_000) -> DataFrame:
        """Full curves of picked customers, one row per customer and time step.

        Meant for a handful of customers (see ``splits.pick_some``), ``most`` of
        them: they are copied to the baseline's rows, so nothing is shuffled.
        """
        if df.limit(most + 1).count() > most:
            raise ValueError(f"full curves are for up to {most} customers")
        picked = self.with_risk(df).agg(
            F.collect_list(F.struct(F.col(id_column), F.col("risk")))
        ).scalar()
        return (
            self.baseline.withColumn("_picked", picked)
            .select("time", "cumulative_hazard", F.inline("_picked"))
            .select(id_column, "time", F.exp(-F.col("cumulative_hazard") * F.exp("risk")).alias("surv"))
        )


def _baseline(data: DataFrame, beta: np.ndarray, features: Sequence[str], rows: int | None) -> DataFrame:
    """Cumulative baseline hazard at every distinct time."""
    per_time = data.groupBy("time").agg(F.count_if("event").alias("_d"), F.sum(F.exp(linear(features, beta))).alias("_s"))
    at_risk = running(per_time, [], "time", sums=["_s"], descending=True, rows=rows).withColumn("_jump", F.col("_d") / F.col("_s_run"))
    hazard = running(at_risk, [], "time", sums=["_jump"], rows=rows)
    return cut_lineage(hazard.select("time", F.col("_jump_run").alias("cumulative_hazard")))


def _newton_terms(data: DataFrame, beta: np.ndarray, features: Sequence[str], rows: int | None):
    """Log-likelihood part, first moments and information at ``beta``, from one reading of the rows."""
    p = len(features)
    x = [f"`{f}`" for f in features]
    upper = [(j, k) for j in range(p) for k in range(j, p)]
    # as text: one expression each, however many sums it holds
    moments = ["_w", *[f"_w * {c}" for c in x], *[f"_w * {x[j]} * {x[k]}" for j, k in upper]]
    per_time = data.withColumn("_w", F.exp(linear(features, beta))).groupBy("time").agg(
        F.count_if("event").alias("_d"), F.expr(f"array({', '.join(f'sum({m})' for m in moments)})").alias("_m")
    )
    long = per_time.select("time", "_d", F.posexplode("_m").alias("_at", "_v"))
    run = running(long, ["_at"], "time", sums=["_v"], descending=True, rows=rows).where(F.col("_d") > 0)
    at_risk = run.groupBy("time", "_d").agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v_run"))), lambda r: r["_v_run"]).alias("_r"))
    mean = [f"_r[{j + 1}] / _r[0]" for j in range(p)]
    spread = [f"_r[{p + 1 + i}] / _r[0] - {mean[j]} * {mean[k]}" for i, (j, k) in enumerate(upper)]
    row = at_risk.agg(F.expr(f"array({', '.join(f'sum(_d * ({c}))' for c in ['ln(_r[0])', *mean, *spread])})").alias("sums")).first()
    sums = np.array([v or 0.0 for v in row["sums"]])
    information = np.zeros((p, p))
    for (j, k), value in zip(upper, sums[p + 1 :]):
        information[j, k] = information[k, j] = value
    return sums[0], sums[1 : p + 1], information


def score_vector(model: CoxModel, df: DataFrame, alpha: float = 0.1) -> DataFrame:
    """Per feature the slope of the penalised likelihood at the fit, from residuals of the rows; 0 for a fit.

    A row's residual is whether it had the event, less the hazard it lived
    through: another reading of the gradient than the one the fit uses.
    """
    rows = model.with_risk(df, "_risk").join(model.baseline.withColumnRenamed("time", "_time"), F.col("time") == F.col("_time"))
    rest = F.col("event").cast("double") - F.col("cumulative_hazard") * F.exp("_risk")
    sums = rows.agg(F.array(*[
        F.struct(F.lit(f).alias("feature"), (F.sum(rest * F.col(f"`{f}`")) - F.lit(float(alpha * b))).alias("score"))
        for f, b in zip(model.features, model.coefficients)
    ]).alias("all"))
    return sums.select(F.inline("all"))


def fit_cox(
    df: DataFrame, features: Sequence[str], alpha: float = 0.1, max_iter: int = 50, tol: float = 1e-9
) -> CoxModel:
    """Fit ``event, time`` on numeric feature columns with a ridge of ``alpha``.

    ``converged`` says whether the gradient vanished within ``max_iter`` steps.
    """
    features = list(features)
    p = len(features)
    data = right_sized(df.select("event", "time", *[F.col(f"`{f}`").cast("double").alias(f) for f in features]))
    try:
        # Few distinct times are scanned as they are; many are materialised per step.
        n_times = data.select("time").distinct().count()
        few = n_times if n_times <= FEW_ROWS else None
        observed = data.agg(
            *[F.sum(F.when(F.col("event"), F.col(f"`{f}`"))).alias(f"e{j}") for j, f in enumerate(features)],
        ).first()
        event_sum = np.array([observed[f"e{j}"] or 0.0 for j in range(p)], dtype=float)
        beta, best = np.zeros(p), -np.inf
        previous, gradient, step = beta, np.zeros(p), np.zeros(p)
        steps, converged = 0, False
        for steps in range(1, max_iter + 1):
            log_part, first, information = _newton_terms(data, beta, features, few)
            likelihood = float(event_sum @ beta) - log_part - alpha / 2 * float(beta @ beta)
            if not np.isfinite(likelihood) or likelihood < best - 1e-9 * abs(best):
                step = step / 2  # overshot: halve the way from the last good point
                if np.abs(step).max() < tol:
                    converged = True
                    break
                beta = previous + step
                continue
            best, previous = likelihood, beta
            gradient = event_sum - first - alpha * beta
            if np.abs(gradient).max() < tol * max(1.0, np.abs(event_sum).max()):
                converged = True
                break
            step = np.linalg.solve(information + alpha * np.eye(p), gradient)
            beta = beta + step
        beta = previous
        baseline = _baseline(data, beta, features, few)
    finally:
        data.unpersist()
    return CoxModel(features, beta, gradient, steps, baseline, converged)
