"""Small networks side by side: all sizes and folds in one pass a step.

A cell is one fit: its hidden layers and the fold it leaves out.  Rows are
packed once into blocks of one fold, so a step of every fit is one pass over the
blocks, and a task holds one block and one gradient per cell whatever the rows.
The gradients add up; the driver only takes the quasi-Newton steps, with the
line search and the stopping rules of MLlib's l-bfgs.  The model is MLlib's
perceptron: sigmoid layers, two outputs with softmax, mean cross-entropy, no
penalty.  Scaling by the training rows of a cell is part of the fit.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Sequence
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import logistic_grid
from tidemark.runtime import ROWS_PER_TASK, cut_lineage

BLOCK_ROWS = 1024
#: Scores are counted at so many digits, as those of the other searches.
SCORE_DIGITS = logistic_grid.SCORE_DIGITS


class Cell(NamedTuple):
    """One fit; it trains on rows of other folds."""

    hidden: tuple[int, ...]
    fold: int | None = None
    level: int = 1  # as the logistic cells: all rows are at level 1


@dataclass
class Networks:
    """Fitted cells: flat weights on the scale of each cell's training rows; blocks are on the scale (base, spread)."""

    features: list[str]
    cells: list[Cell]
    base: np.ndarray
    spread: np.ndarray
    centre: np.ndarray
    width: np.ndarray
    weights: list[np.ndarray]
    losses: list[float]
    steps: list[int]


def layer_sizes(features: int, hidden: Sequence[int]) -> list[int]:
    return [features, *hidden, 2]


def first_weights(sizes: Sequence[int], seed: int) -> np.ndarray:
    """Uniform weights of MLlib's range; per layer the matrix (in, out), then the intercepts."""
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.uniform(-2.4, 2.4, (a + 1) * b) / np.sqrt(a) for a, b in zip(sizes, sizes[1:])])


def _layers(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    parts, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        parts.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + (a + 1) * b]))
        at += (a + 1) * b
    return parts


def _forward(z: np.ndarray, layers) -> list[np.ndarray]:
    """Values after every layer; the last are the two outputs before softmax."""
    values, most = [z], 80 if z.dtype == np.float32 else 700
    for k, (matrix, intercept) in enumerate(layers):
        if k == len(layers) - 1:
            return [*values, values[-1] @ matrix + intercept]
        out = values[-1] @ -matrix
        out -= intercept
        np.minimum(out, most, out=out)
        np.exp(out, out=out)
        out += 1
        values.append(np.reciprocal(out, out=out))
    return values


def loss_and_gradient(z: np.ndarray, label: np.ndarray, flat: np.ndarray, sizes: Sequence[int]) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of scaled rows and its slope; the layers are worked on in the kind of ``z``, loss and sums in 64 bits."""
    layers = [(m.astype(z.dtype), b.astype(z.dtype)) for m, b in _layers(flat, sizes)]
    values = _forward(z, layers)
    gap = np.subtract(values[-1][:, 1], values[-1][:, 0], dtype=float)
    loss = float((np.logaddexp(0, gap) - label * gap).sum())
    rest = (1 / (1 + np.exp(-np.clip(gap, -700, 700))) - label)[:, None].astype(z.dtype)
    delta = np.hstack([-rest, rest])
    parts: list[np.ndarray] = []
    for k in range(len(layers) - 1, -1, -1):
        parts[:0] = [(values[k].T @ delta).ravel().astype(float), delta.sum(0, dtype=float)]
        if k:
            delta = delta @ layers[k][0].T
            bend = values[k] * values[k]
            np.subtract(values[k], bend, out=bend)
            delta *= bend
    return loss, np.concatenate(parts)


def _descent(x: np.ndarray, max_iter: int, tol: float, memory: int = 10) -> Generator[np.ndarray, tuple[float, np.ndarray], tuple[np.ndarray, float, int]]:
    """L-BFGS as a generator: yields points, is sent loss and slope, returns the best point, its loss and the steps.

    It ends as MLlib's does: ``max_iter`` steps, ten values within ``tol`` of
    the first loss, a slope within ``tol`` of the loss, or no better point.
    """
    f, g = yield x
    first, history, pairs = f, deque([f], maxlen=10), deque(maxlen=memory)
    for step in range(max_iter):
        if np.linalg.norm(g) <= max(tol * abs(f), 1e-8):
            return x, f, step
        d, turns = g.copy(), []
        for s, y, rho in reversed(pairs):
            turns.append(rho * (s @ d))
            d -= turns[-1] * y
        if pairs:
            s, y, rho = pairs[-1]
            d *= 1 / (rho * (y @ y))
        for (s, y, rho), a in zip(pairs, reversed(turns)):
            d += (a - rho * (y @ d)) * s
        d = -d
        slope = float(g @ d)
        if not slope < 0:
            d, slope = -g, -float(g @ g)
            pairs.clear()
        # strong Wolfe: the least step seen that is low enough, and a bracket around a flat enough one
        low, high, t, best = 0.0, None, 1.0 if pairs else 1 / np.linalg.norm(d), None
        f_low, g_low = f, slope
        for _ in range(20):
            f_t, g_t = yield x + t * d
            s_t = float(g_t @ d)
            if np.isfinite(f_t) and f_t <= f + 1e-4 * t * slope and (best is None or f_t < best[1]):
                best = (t, f_t, g_t)
            if not np.isfinite(f_t) or f_t > f + 1e-4 * t * slope or f_t >= f_low and low > 0:
                high = t
            elif abs(s_t) <= -0.9 * slope:
                break
            elif s_t >= 0:
                high = t
            else:
                low, f_low, g_low = t, f_t, s_t
            if high is None:
                t *= 2
            elif np.isfinite(f_t) and t == high and (bend := f_t - f_low - g_low * (t - low)) > 0:
                # least point of the parabola through the low end, kept off the ends
                inner = low - g_low * (high - low) ** 2 / (2 * bend)
                t = min(max(inner, low + 0.1 * (high - low)), high - 0.1 * (high - low))
            else:
                t = (low + high) / 2
        if best is None:
            return x, f, step
        t, f_new, g_new = best
        s, y = t * d, g_new - g
        if float(s @ y) > 1e-14 * float(y @ y):
            pairs.append((s, y, 1 / float(s @ y)))
        x, f, g = x + s, f_new, g_new
        history.append(f)
        if len(history) == 10 and max(history) - f <= tol * abs(first):
            return x, f, step + 1
    return x, f, max_iter


def _packed(rows: DataFrame, features: Sequence[str], base: np.ndarray, spread: np.ndarray, n: int) -> DataFrame:
    """fold and a block of scaled rows with their label, written once in as many partitions as the rows deserve."""
    q = len(features)

    def run(stream):
        waiting: dict[int, list[np.ndarray]] = {}
        emit = lambda f, block: pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([block.tobytes()], pa.binary())], names=["fold", "block"])
        for batch in stream:
            x, label, fold, _ = logistic_grid._batch(batch, q)
            ready = np.column_stack([(x - base) / spread, label])
            for f in np.unique(fold):
                parts = waiting.setdefault(int(f), [])
                parts.append(ready[fold == f])
                if sum(map(len, parts)) >= BLOCK_ROWS:
                    whole = np.concatenate(parts)
                    full = len(whole) // BLOCK_ROWS * BLOCK_ROWS
                    for at in range(0, full, BLOCK_ROWS):
                        yield emit(f, whole[at : at + BLOCK_ROWS])
                    waiting[int(f)] = [whole[full:]]
        for f, parts in waiting.items():
            if sum(map(len, parts)):
                yield emit(f, np.concatenate(parts))

    wanted = -(-n // ROWS_PER_TASK) or 1
    return cut_lineage(rows.coalesce(wanted).mapInArrow(run, "fold int, block binary"))


def _blocks(stream, q: int):
    for batch in stream:
        for fold, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = np.frombuffer(block.as_buffer(), float).reshape(-1, q + 1)
            yield fold, np.ascontiguousarray(data[:, :q]), data[:, q]


def _sums(blocks: DataFrame, q: int, cells: Sequence[Cell], points: Sequence[np.ndarray], shift: np.ndarray, scale: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """Summed loss and slope of every cell at its point, from one pass over the blocks."""
    sizes = [layer_sizes(q, cell.hidden) for cell in cells]
    group = lambda i: pa.array(i, pa.int32())

    def run(stream):
        totals = [np.zeros(len(p) + 1) for p in points]
        for fold, x, label in _blocks(stream, q):
            for i, cell in enumerate(cells):
                if cell.fold != fold:
                    loss, slope = loss_and_gradient(((x - shift[i]) / scale[i]).astype(np.float32), label, points[i], sizes[i])
                    totals[i][0] += loss
                    totals[i][1:] += slope
        for i, total in enumerate(totals):
            yield pa.RecordBatch.from_arrays([group([i]), pa.array([total.tobytes()], pa.binary())], names=["cell", "total"])

    def add(stream):
        totals: dict[int, np.ndarray] = {}
        for batch in stream:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = np.frombuffer(part.as_buffer(), float)
                totals[i] = totals[i] + value if i in totals else value
        if totals:
            yield pa.RecordBatch.from_arrays([group(list(totals)), pa.array([v.tobytes() for v in totals.values()], pa.binary())], names=["cell", "total"])

    kind = "cell int, total binary"
    parts = blocks.mapInArrow(run, kind).repartition(min(len(cells), 8), "cell").mapInArrow(add, kind).collect()  # one row per cell
    found = {r["cell"]: np.frombuffer(r["total"], float) for r in parts}
    return [(found[i][0], found[i][1:]) if i in found else (0.0, np.zeros(len(p))) for i, p in enumerate(points)]


def fit_cells(
    df: DataFrame, features: Sequence[str], cells: Sequence[Cell], max_iter: int = 200, tol: float = 1e-6, seed: int = 42,
    start: Sequence[np.ndarray] | None = None,
) -> tuple[Networks, DataFrame]:
    """Fit every cell on ``df`` (features, label, fold); returns the fits and the packed rows.

    Rows with a missing feature or label are left out.  ``start`` has the
    weights to begin with, drawn by ``seed`` if absent.
    """
    features, cells = list(features), list(cells)
    q = len(features)
    rows = logistic_grid.complete(df if "fold" in df.columns else df.withColumn("fold", F.lit(-2)), features)
    rows = rows.withColumn("fold", F.coalesce("fold", F.lit(-2)))
    n, _, centre, width, _ = logistic_grid._scales(rows, features, cells)
    width = width * np.sqrt(n / np.maximum(n - 1, 1))[:, None]
    base, spread = centre.mean(0), width.mean(0)
    blocks = _packed(rows, features, base, spread, int(n.max(initial=0)))
    shift, scale = (centre - base) / spread, width / spread
    points = [first_weights(layer_sizes(q, c.hidden), seed) for c in cells] if start is None else list(start)
    runs = [_descent(p, max_iter, tol) for p in points]
    asked = {i: next(run) for i, run in enumerate(runs) if n[i] > 0}
    done = {i: (points[i], 0.0, 0) for i in range(len(cells)) if i not in asked}
    while asked:
        live = sorted(asked)
        sums = _sums(blocks, q, [cells[i] for i in live], [asked[i] for i in live], shift[live], scale[live])
        for i, (loss, slope) in zip(live, sums):
            try:
                asked[i] = runs[i].send((loss / n[i], slope / n[i]))
            except StopIteration as stop:
                done[i] = stop.value
                del asked[i]
    ends = [done[i] for i in range(len(cells))]
    fits = Networks(features, cells, base, spread, centre, width, [e[0] for e in ends], [e[1] for e in ends], [e[2] for e in ends])
    return fits, blocks


def chances(x: np.ndarray, fits: Networks, i: int) -> np.ndarray:
    """Probability of class 1 of plain rows under one cell."""
    out = _forward((x - fits.centre[i]) / fits.width[i], _layers(fits.weights[i], layer_sizes(len(fits.features), fits.cells[i].hidden)))[-1]
    return 1 / (1 + np.exp(-np.clip(out[:, 1] - out[:, 0], -700, 700)))


def score_counts(blocks: DataFrame, fits: Networks, with_train: bool = False, digits: int = SCORE_DIGITS) -> DataFrame:
    """cell, fold, role, score, pos, neg: how often each score occurs on the left-out fold, and on the seen rows if wanted."""
    q = len(fits.features)

    def run(stream):
        for fold, x, label in _blocks(stream, q):
            x = x * fits.spread + fits.base
            for i, cell in enumerate(fits.cells):
                if cell.fold == fold or with_train:
                    score, at = np.unique(np.round(chances(x, fits, i), digits), return_inverse=True)
                    pos, each = np.bincount(at, weights=label, minlength=len(score)).astype(np.int64), np.bincount(at, minlength=len(score))
                    role = "validation" if cell.fold == fold else "train"
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(score), pa.int32()), pa.array([role] * len(score)), pa.array(score), pa.array(pos), pa.array(each - pos)],
                        names=["cell", "role", "score", "pos", "neg"],
                    )

    each = blocks.mapInArrow(run, "cell int, role string, score double, pos long, neg long")
    folds = F.array(*[F.lit(cell.fold).cast("int") for cell in fits.cells])
    sums = each.groupBy("cell", "role", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return sums.withColumn("fold", F.get(folds, F.col("cell")))


class Network(Estimator):
    """One network as an estimator, for lists of models beside MLlib's."""

    def __init__(self, features: Sequence[str], hidden: Sequence[int], max_iter: int, seed: int):
        super().__init__()
        self.features, self.hidden, self.max_iter, self.seed = list(features), tuple(hidden), max_iter, seed

    def _fit(self, dataset: DataFrame) -> NetworkModel:
        rows = dataset.select(*self.features, "label")
        return NetworkModel(fit_cells(rows, self.features, [Cell(self.hidden)], self.max_iter, seed=self.seed)[0])


def fit_together(networks: dict[str, Network], df: DataFrame) -> dict[str, NetworkModel]:
    """Fit networks on the same rows in the same passes; equal ones are one fit."""
    models, alike = {}, {}
    for name, e in networks.items():
        alike.setdefault((tuple(e.features), e.max_iter, e.seed), {}).setdefault(e.hidden, []).append(name)
    for (features, max_iter, seed), by_size in alike.items():
        fits, _ = fit_cells(df.select(*features, "label"), features, [Cell(hidden) for hidden in by_size], max_iter, seed=seed)
        for i, names in enumerate(by_size.values()):
            one = replace(
                fits, cells=fits.cells[i : i + 1], centre=fits.centre[i : i + 1], width=fits.width[i : i + 1],
                weights=fits.weights[i : i + 1], losses=fits.losses[i : i + 1], steps=fits.steps[i : i + 1],
            )
            models |= {name: NetworkModel(one) for name in names}
    return models


class NetworkModel(Model):
    """Adds ``probability`` as MLlib's models do."""

    def __init__(self, fits: Networks):
        super().__init__()
        self.fits = fits

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fits = self.fits

        @F.pandas_udf("array<double>")
        def both(*columns):
            import pandas as pd

            chance = chances(np.column_stack([c.to_numpy(dtype=float) for c in columns]), fits, 0)
            return pd.Series([[1 - p, p] for p in chance])

        values = both(*[F.col(f"`{c}`").cast("double") for c in fits.features])
        return dataset.withColumn("probability", array_to_vector(values))
