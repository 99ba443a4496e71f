"""Survival ranking SVM: a linear score that puts later events later.

The squared hinge runs over all comparable pairs, yet no pair is formed or
sampled.  Pairs are grouped by ``pairs.digit_groups``; inside a group the
violated pairs of an earlier row are those with a lower shifted score, so their
number and sums come from running sums along the score.  The driver holds only
p-sized vectors and takes quasi-Newton steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cox import cross_gram, linear, weighted_gram
from tidemark.operators.pairs import digit_groups
from tidemark.operators.scan import materialise, running
from tidemark.runtime import cut_lineage, right_sized


@dataclass
class RankModel:
    """A ranking only: it orders customers but has no survival curve."""

    features: list[str]
    weights: np.ndarray
    losses: list[float]
    converged: bool = True
    has_survival = False

    def with_risk(self, df: DataFrame, out: str = "risk") -> DataFrame:
        """Higher risk means the event comes sooner."""
        return df.withColumn(out, -linear(self.features, self.weights))


def _prepare(data: DataFrame, names: list[str]):
    """Rows with time ranks, and the curvature when every pair is violated."""
    p = len(names)
    per_time, n_times = materialise(
        data.groupBy("time").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("event").alias("e"), F.lit(1).alias("_one"),
            *[F.sum(F.when(F.col("event"), F.col(f"`{c}`")).otherwise(0.0)).alias(f"ex{j}") for j, c in enumerate(names)],
            *[F.sum(f"`{c}`").alias(f"ax{j}") for j, c in enumerate(names)],
        )
    )
    forward = running(per_time, [], "time", sums=["_one", "e"], rows=n_times).select(
        "time", F.col("_one_run").alias("_rank"), (F.col("e_run") - F.col("e")).alias("earlier")
    )
    backward = running(per_time, [], "time", sums=["n", *[f"ax{j}" for j in range(p)]], descending=True, rows=n_times)
    table = cut_lineage(
        backward.join(forward, ["time"]).select(
            "time", "_rank", "earlier", (F.col("n_run") - F.col("n")).alias("later"),
            *[f"ex{j}" for j in range(p)],
            *[(F.col(f"ax{j}_run") - F.col(f"ax{j}")).alias(f"lx{j}") for j in range(p)],
        )
    )
    part = F.when(F.col("event"), F.col("later")).otherwise(0) + F.col("earlier")
    rows = right_sized(
        data.join(table.select("time", "_rank", "earlier", "later"), ["time"]).select(
            "event", "_rank", part.cast("double").alias("_weight"), *[F.col(f"`{c}`") for c in names]
        )
    )
    cross = cross_gram(table, [f"ex{j}" for j in range(p)], [f"lx{j}" for j in range(p)])
    return rows, n_times, weighted_gram(rows, "_weight", names) - cross - cross.T


def _loss_and_gradient(rows: DataFrame, n_times: int, names: list[str], w: np.ndarray, alpha: float):
    """Objective and gradient over all pairs at ``w``."""
    p = len(names)
    grouped = digit_groups(rows.withColumn("_s", linear(names, w)), n_times)
    early = (F.col("_bit") == 0) & F.col("event")
    late = F.col("_bit") == 1
    keyed = grouped.filter(early | late).withColumn("_key", F.when(late, F.col("_s")).otherwise(F.col("_s") + 1.0))
    sums, n_sums = materialise(
        keyed.groupBy("_digit", "_head", "_key").agg(
            F.count_if(early).cast("double").alias("en"), F.count_if(late).cast("double").alias("ln"),
            *[F.sum(F.when(early, F.col(f"`{c}`")).otherwise(0.0)).alias(f"ex{j}") for j, c in enumerate(names)],
            *[F.sum(F.when(late, F.col(f"`{c}`")).otherwise(0.0)).alias(f"lx{j}") for j, c in enumerate(names)],
        )
    )
    key = F.col("_key")
    wide = sums.select(
        "*", (key * F.col("ln")).alias("ls"), (key * key * F.col("ln")).alias("lq"),
        *[(key * F.col(f"lx{j}")).alias(f"lsx{j}") for j in range(p)],
    )
    carried = ["ln", "ls", "lq", *[f"lx{j}" for j in range(p)], *[f"lsx{j}" for j in range(p)]]
    if n_sums > 0:
        wide = running(wide, ["_digit", "_head"], "_key", sums=carried, rows=n_sums)
    pull = key * F.col("ln_run") - F.col("ls_run")
    row = wide.filter(F.col("en") > 0).agg(
        F.sum(F.col("en") * (key * key * F.col("ln_run") - 2 * key * F.col("ls_run") + F.col("lq_run"))).alias("l"),
        *[
            F.sum(pull * F.col(f"ex{j}") - F.col("en") * (key * F.col(f"lx{j}_run") - F.col(f"lsx{j}_run"))).alias(f"g{j}")
            for j in range(p)
        ],
    ).first()
    loss = 0.5 * float(w @ w) + 0.5 * alpha * (row["l"] or 0.0)
    return loss, w + alpha * np.array([row[f"g{j}"] or 0.0 for j in range(p)])


def fit_rank_svm(
    df: DataFrame, features: Sequence[str], alpha: float = 0.01, max_iter: int = 50, tol: float = 1e-5
) -> RankModel:
    """Minimise half the squared norm plus ``alpha``/2 times the squared hinge over pairs."""
    names = list(features)
    data = df.select("event", "time", *[F.col(f"`{c}`").cast("double").alias(c) for c in names]).persist()
    rows = None
    try:
        rows, n_times, curvature = _prepare(data, names)
        inverse = np.linalg.inv(np.eye(len(names)) + alpha * curvature)
        w = np.zeros(len(names))
        loss, gradient = _loss_and_gradient(rows, n_times, names, w, alpha)
        losses, start, converged = [loss], max(1.0, float(np.abs(gradient).max())), False
        for _ in range(max_iter):
            converged = bool(np.abs(gradient).max() < tol * start)
            if converged:
                break
            step, size = -inverse @ gradient, 1.0
            while True:
                trial = w + size * step
                new_loss, new_gradient = _loss_and_gradient(rows, n_times, names, trial, alpha)
                if new_loss <= loss + 1e-4 * size * float(gradient @ step) or size < 1e-3:
                    break
                size /= 2
            if new_loss > loss:
                break
            s, y = trial - w, new_gradient - gradient
            w, loss, gradient = trial, new_loss, new_gradient
            losses.append(loss)
            if float(s @ y) > 1e-12:
                rho, eye = 1.0 / float(s @ y), np.eye(len(names))
                left = eye - rho * np.outer(s, y)
                inverse = left @ inverse @ left.T + rho * np.outer(s, s)
        return RankModel(names, w, losses, converged or bool(np.abs(gradient).max() < tol * start))
    finally:
        data.unpersist()
        if rows is not None:
            rows.unpersist()
