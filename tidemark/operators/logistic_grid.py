"""Logistic regressions side by side: all penalties, folds and training sizes in one pass a step.

A cell is one fit: a penalty, the fold it leaves out, and how far it reaches
into a growing training set.  The coefficients of all cells are the columns of
one matrix.  A step of Newton's method reads the rows once: every task makes
the loss, gradient and curvature of all cells for its rows, which add up to
``cells * (features + 2)^2 / 2`` numbers whatever the rows, and the driver
solves one small problem per cell.  Scaling by mean and deviation of a cell's
own training rows is part of the fit.  A fit leaves counts of scores, which
add up as well, not a row per customer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest gradient per training row that counts as zero, and steps after which a fit is given up.
GRADIENT, MOST_STEPS = 1e-10, 60
#: Scores are counted at so many digits: at most 10 ** SCORE_DIGITS counts per cell and role.
SCORE_DIGITS = 6


class Cell(NamedTuple):
    """One fit; it trains on rows of other folds whose ``level`` is at most its own."""

    c: float = 1.0
    l1_ratio: float = 0.0
    fold: int | None = None
    level: int = 1


@dataclass
class Fits:
    """Fitted cells: coefficients on the scale of each cell's training rows, intercept last."""

    features: list[str]
    cells: list[Cell]
    centre: np.ndarray
    width: np.ndarray
    weights: np.ndarray
    rows: np.ndarray
    positives: np.ndarray
    steps: np.ndarray
    converged: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def plain(self) -> np.ndarray:
        """Coefficients for features as they are, intercept last."""
        slope = self.weights[:, :-1] / self.width
        return np.column_stack([slope, self.weights[:, -1] - (slope * self.centre).sum(1)])

    def table(self, spark) -> DataFrame:
        """One row per cell: what it is, its training rows, steps, coefficients and their scale."""
        rows = [
            (i, *map(float, cell[:2]), cell.fold, cell.level, int(self.rows[i]), int(self.positives[i]), int(self.steps[i]), bool(self.converged[i]),
             self.weights[i].tolist(), self.centre[i].tolist(), self.width[i].tolist())
            for i, cell in enumerate(self.cells)
        ]
        return spark.createDataFrame(
            rows, "cell INT, c DOUBLE, l1_ratio DOUBLE, fold INT, level INT, rows BIGINT, positives BIGINT, steps INT, converged BOOLEAN, "
            "weights ARRAY<DOUBLE>, centre ARRAY<DOUBLE>, width ARRAY<DOUBLE>",
        )


def complete(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Features as doubles, label, fold and level of the rows where none of them is missing."""
    wanted = df.select(
        *[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("label"),
        F.col("fold").cast("int").alias("fold"), (F.col("level") if "level" in df.columns else F.lit(1)).cast("int").alias("level"),
    )
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in features])
    return wanted.where(there & F.col("label").isin(0.0, 1.0) & F.col("level").isNotNull())


def _trains(cells: Sequence[Cell], fold: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Which rows train which cells; a row without a fold trains all."""
    left_out = np.array([-1 if cell.fold is None else cell.fold for cell in cells])
    reach = np.array([cell.level for cell in cells])
    return (fold[:, None] != left_out) & (level[:, None] <= reach)


def _batch(batch: pa.RecordBatch, q: int):
    column = lambda i: batch.column(i).fill_null(-2).to_numpy(zero_copy_only=False)
    x = np.column_stack([column(i) for i in range(q)]) if q else np.zeros((len(batch), 0))
    return x, column(q), column(q + 1), column(q + 2)


def _scales(rows: DataFrame, features: list[str], cells: Sequence[Cell]):
    """Rows, positives, means and deviations of the training rows of each cell, and which features vary there, from sums per fold and level."""
    middle = rows.agg(*[F.avg(c).alias(c) for c in features]).first()
    base = np.array([v if v is not None else 0.0 for v in middle])
    centred = [F.col(c) - F.lit(float(m)) for c, m in zip(features, base)]
    groups = rows.groupBy("fold", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"), F.array(*[F.sum(x) for x in centred]).alias("s"),
        F.array(*[F.sum(x * x) for x in centred]).alias("ss"), F.array(*[F.min(c) for c in features]).alias("least"), F.array(*[F.max(c) for c in features]).alias("most"),
    ).collect()  # one row per fold and level
    fold = np.array([-2 if g.fold is None else g.fold for g in groups])
    trains = _trains(cells, fold, np.array([g.level for g in groups])).T.astype(float)
    n, pos = trains @ np.array([g.n for g in groups]), trains @ np.array([g.pos for g in groups])
    total = np.maximum(n, 1)[:, None]
    mean = trains @ np.array([g.s for g in groups]) / total
    spread = np.sqrt(np.maximum(trains @ np.array([g.ss for g in groups]) / total - mean**2, 0))
    there = trains[:, :, None] > 0
    bound = lambda name: np.array([g[name] for g in groups], float).reshape(1, len(groups), len(features))
    least = np.where(there, bound("least"), np.inf).min(1, initial=np.inf)
    most = np.where(there, bound("most"), -np.inf).max(1, initial=-np.inf)
    return n, pos, mean + base, np.where(spread > 1e-12 * (1 + np.abs(base)), spread, 1.0), least < most


def _sums(rows: DataFrame, q: int, cells: Sequence[Cell], weights: np.ndarray, centre: np.ndarray, width: np.ndarray):
    """Loss, gradient and curvature of every cell at its weights, from one pass over the rows."""
    upper = np.triu_indices(q + 1)
    base, spread = centre.mean(0), width.mean(0)  # a common scale for the products, so that none is lost to rounding
    slope = weights[:, :-1] / width
    turned, level0 = (slope * spread).T, weights[:, -1] + (slope * (base - centre)).sum(1)

    def run(stream):
        loss, first, second = np.zeros(len(cells)), np.zeros((len(cells), q + 1)), np.zeros((len(cells), len(upper[0])))
        for batch in stream:
            x, label, fold, level = _batch(batch, q)
            z = np.column_stack([(x - base) / spread, np.ones(len(x))])
            margin = z[:, :-1] @ turned + level0
            mask = _trains(cells, fold, level)
            chance = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            loss += np.where(mask, np.logaddexp(0, margin) - label[:, None] * margin, 0).sum(0)
            first += ((chance - label[:, None]) * mask).T @ z
            second += (chance * (1 - chance) * mask).T @ (z[:, upper[0]] * z[:, upper[1]])
        values = np.column_stack([loss, first, second])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(cells) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), lists], names=["cell", "values"])

    parts = rows.mapInArrow(run, "cell long, values array<double>").select("cell", F.posexplode("values").alias("at", "v"))
    table = parts.groupBy("cell", "at").agg(F.sum("v").alias("v")).toArrow()
    values = np.zeros((len(cells), 1 + (q + 1) + len(upper[0])))
    values[table["cell"].to_numpy(), table["at"].to_numpy()] = table["v"].to_numpy()
    loss, first, packed = values[:, 0], values[:, 1 : q + 2], values[:, q + 2 :]
    second = np.zeros((len(cells), q + 1, q + 1))
    second[:, upper[0], upper[1]] = second[:, upper[1], upper[0]] = packed
    # from the common scale to the scale of each cell
    turn = np.zeros((len(cells), q + 1, q + 1))
    turn[:, np.arange(q), np.arange(q)] = spread / width
    turn[:, :-1, -1] = (base - centre) / width
    turn[:, -1, -1] = 1
    return loss, np.einsum("cij,cj->ci", turn, first), turn @ second @ turn.transpose(0, 2, 1)


def _residual(gradient: np.ndarray, weight: np.ndarray, lasso: float) -> np.ndarray:
    """How far a point is from being stationary; the last coefficient has no penalty."""
    rest = gradient.copy()
    at_zero = weight[:-1] == 0
    rest[:-1] = np.where(at_zero, np.sign(gradient[:-1]) * np.maximum(np.abs(gradient[:-1]) - lasso, 0), gradient[:-1] + lasso * np.sign(weight[:-1]))
    return rest


def _move(gradient: np.ndarray, curvature: np.ndarray, weight: np.ndarray, lasso: float) -> np.ndarray:
    """The step to the least point of the quadratic model plus the absolute values, by coordinate descent."""
    if lasso == 0:
        return np.linalg.lstsq(curvature, -gradient, rcond=None)[0]
    step, slope = np.zeros(len(weight)), gradient.copy()
    for _ in range(2000):
        most = 0.0
        for j, bend in enumerate(np.diag(curvature)):
            if bend <= 0:
                continue
            target = weight[j] + step[j] - slope[j] / bend
            new = (np.sign(target) * max(abs(target) - lasso / bend, 0.0) if j < len(weight) - 1 else target) - weight[j]
            if new != step[j]:
                slope += curvature[:, j] * (new - step[j])
                most = max(most, abs(new - step[j]) * bend)
                step[j] = new
        if most < 1e-13 * (1 + np.abs(gradient).max()):
            break
    return step


def fit_cells(rows: DataFrame, features: Sequence[str], cells: Sequence[Cell]) -> Fits:
    """Fit every cell on ``rows`` (features, label, fold, level), as ``complete`` makes them.

    ``c`` is the inverse penalty on the summed loss, ``l1_ratio`` the share of
    absolute values in it; the intercept has none.  A feature that is one value
    on all training rows of a cell has coefficient 0 there.  A cell stops at a gradient
    of 0; ``converged`` is false where ``MOST_STEPS`` passes did not get there.
    Steps that make the objective worse are halved.  Keep ``rows`` where
    several passes are cheap, for example in a checkpoint.
    """
    features, cells = list(features), list(cells)
    q, k = len(features), len(cells)
    n, positives, centre, width, varies = _scales(rows, features, cells)
    ridge = np.array([(1 - cell.l1_ratio) / cell.c for cell in cells])
    lasso = np.array([cell.l1_ratio / cell.c for cell in cells])
    at, step, trial = np.zeros((k, q + 1)), np.zeros((k, q + 1)), np.zeros((k, q + 1))
    best, steps, converged = np.full(k, np.inf), np.zeros(k, int), n == 0
    for _ in range(MOST_STEPS):
        live = np.flatnonzero(~converged)
        if not len(live):
            break
        loss, first, second = _sums(rows, q, [cells[i] for i in live], trial[live], centre[live], width[live])
        for i, value, gradient, curvature in zip(live, loss, first, second):
            inner = trial[i, :-1]
            value += ridge[i] / 2 * inner @ inner + lasso[i] * np.abs(inner).sum()
            steps[i] += 1
            if value > best[i] + 1e-12 * abs(best[i]):
                step[i] /= 2
            else:
                best[i], at[i] = value, trial[i]
                gradient[:-1] += ridge[i] * inner
                curvature[np.arange(q), np.arange(q)] += ridge[i]
                own = np.flatnonzero(np.append(varies[i], True))
                converged[i] = np.abs(_residual(gradient[own], trial[i, own], lasso[i])).max() <= GRADIENT * n[i]
                step[i] = 0
                step[i, own] = _move(gradient[own], curvature[np.ix_(own, own)], trial[i, own], lasso[i])
            trial[i] = at[i] + step[i]
    return Fits(features, cells, centre, width, at, n, positives, steps, converged)


def score_counts(rows: DataFrame, fits: Fits, digits: int = SCORE_DIGITS) -> DataFrame:
    """cell, role, score, pos, neg: how often each score occurs on the rows a cell has seen and on its left-out fold."""
    q, cells, plain = len(fits.features), fits.cells, fits.plain()
    left_out = np.array([-1 if cell.fold is None else cell.fold for cell in cells])

    def run(stream):
        for batch in stream:
            x, label, fold, level = _batch(batch, q)
            chance = np.round(1 / (1 + np.exp(-np.clip(x @ plain[:, :-1].T + plain[:, -1], -700, 700))), digits)
            seen = _trains(cells, fold, level)
            for role, mask in (("train", seen), ("validation", fold[:, None] == left_out)):
                row, cell = np.nonzero(mask)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), pa.array([role] * len(row), pa.string()), pa.array(chance[row, cell]), pa.array(label[row].astype(np.int64))],
                    names=["cell", "role", "score", "pos"],
                )

    each = rows.mapInArrow(run, "cell int, role string, score double, pos long")
    return each.groupBy("cell", "role", "score").agg(F.sum("pos").alias("pos"), (F.count(F.lit(1)) - F.sum("pos")).alias("neg"))


def gradients(rows: DataFrame, fits: Fits) -> DataFrame:
    """Per cell the largest entry of the gradient per training row, by column expressions alone.

    An independent reading of the fit: 0 for a stationary point, with the
    subgradient that is nearest to 0 where a lasso coefficient is 0.
    """
    table = fits.table(rows.sparkSession)
    x = F.array(*[F.col(c) for c in fits.features])
    held = F.broadcast(table.withColumnRenamed("fold", "left_out").withColumnRenamed("level", "reach").select("cell", "left_out", "reach", "weights", "centre", "width"))  # one row per cell
    seen = rows.select(x.alias("x"), "label", "fold", "level").join(held, (F.col("level") <= F.col("reach")) & F.coalesce(F.col("fold") != F.col("left_out"), F.lit(True)))
    z = F.concat(F.transform(F.arrays_zip("x", "centre", "width"), lambda r: (r["x"] - r["centre"]) / r["width"]), F.array(F.lit(1.0)))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    margin = total(F.zip_with("z", "weights", lambda a, b: a * b))
    rest = seen.withColumn("z", z).select("cell", "z", (1 / (1 + F.exp(-margin)) - F.col("label")).alias("r"))
    sums = rest.groupBy("cell").agg(F.array(*[F.sum(F.col("r") * F.col("z")[j]) for j in range(len(fits.features) + 1)]).alias("g"))
    lasso, ridge = F.col("l1_ratio") / F.col("c"), (1 - F.col("l1_ratio")) / F.col("c")

    def distance(g: Column, w: Column, free: Column) -> Column:
        pull = g + F.when(free, 0.0).otherwise(ridge * w)
        bound = F.when(free, 0.0).otherwise(lasso)
        return F.when(w == 0, F.greatest(F.abs(pull) - bound, F.lit(0.0))).otherwise(F.abs(pull + bound * F.signum(w)))

    q = len(fits.features)
    parts = [distance(F.col("g")[j], F.col("weights")[j], F.lit(j == q)) for j in range(q + 1)]
    return table.join(sums, "cell").select("cell", "c", "l1_ratio", "fold", "level", "rows", "positives", "steps", "converged", (F.greatest(*parts) / F.col("rows")).alias("gradient"))
