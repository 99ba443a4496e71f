"""Tree-ensemble survival as a discrete-time hazard model.

A random forest over (customer, time step lived through) learns the chance of
the event in that step, and S(t) is the running product of surviving.  A
different estimator from a log-rank survival forest, with the same inputs and
the same kind of curve.

The rows of customers and steps are never made.  A node of a tree is a region of
the features and a run of steps, so a customer adds the number of their steps in
the run, and an event if it falls into it; the sums per bin of every feature add
up over blocks of customers, and one pass over the blocks grows all trees by one
level.  A fitted forest is a list of leaves: the hazards of a batch of customers
are one product of region flags and leaf values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scan import exact_quantiles
from tidemark.runtime import cut_lineage

#: Steps of time at most: every distinct event time is one, or as many quantiles of the event times.
MOST_STEPS = 100
#: Bins per feature, as many as MLlib's trees have.
BINS = 32
BLOCK_ROWS, SCORED_ROWS = 8192, 1024
#: Chances of fewer than 1, 2, ... draws of a row in a bootstrap sample (Poisson with mean 1), in 16 bits.
_DRAWS = np.round(np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 8)])) * 65536).clip(0, 65535).astype(np.uint16)


@dataclass
class Tree:
    """Nodes by heap number (root 1): what they split on and where, and the chance of the event in a leaf.

    The feature after the last one is the step; ``cut`` is the number of the
    last bin, or step, that goes left.
    """

    split: dict[int, tuple[int, int]]
    chance: dict[int, float]


@dataclass
class HazardForest:
    """Trees over features and steps; ``edges`` are the ends of the steps, ``cuts`` the ends of the bins per feature."""

    features: list[str]
    trees: list[Tree]
    cuts: list[np.ndarray]
    edges: list[float]
    has_survival = True

    @property
    def steps(self) -> int:
        return len(self.edges)

    def leaf_values(self) -> np.ndarray:
        """Per leaf of the forest its part of the hazard of every step, in the order of ``regions``."""
        rows = []
        for tree in self.trees:
            for leaf, first, last in _leaves(tree, self.steps, len(self.features)):
                row = np.zeros(self.steps)
                row[first:last] = tree.chance[leaf] / len(self.trees)
                rows.append(row)
        return np.array(rows)

    def regions(self, x: np.ndarray) -> np.ndarray:
        """Per row and leaf 1 if the row's features reach the leaf in some step, else 0."""
        flags, step = [], len(self.features)

        def walk(tree: Tree, node: int, here: np.ndarray) -> None:
            if node not in tree.split:
                flags.append(here)
                return
            feature, cut = tree.split[node]
            if feature == step:
                walk(tree, 2 * node, here)
                walk(tree, 2 * node + 1, here)
            else:
                left = x[:, feature] <= self.cuts[feature][cut]
                walk(tree, 2 * node, here & left)
                walk(tree, 2 * node + 1, here & ~left)

        for tree in self.trees:
            walk(tree, 1, np.ones(len(x), bool))
        return np.array(flags).T.astype(float)

    def _scored(self, values: np.ndarray, finish, kind: str) -> Column:
        """A column made of the products of region flags and ``values``, batch by batch."""
        regions = self.regions

        @F.pandas_udf(kind)
        def score(*columns):
            import pandas as pd

            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            parts = [finish(regions(x[at : at + SCORED_ROWS]) @ values) for at in range(0, len(x), SCORED_ROWS)]
            return pd.Series([v for part in parts for v in part])

        return score(*[F.col(f"`{f}`").cast("double") for f in self.features])

    def with_hazards(self, df: DataFrame, id_column: str | None = None, out: str = "_h") -> DataFrame:
        """Attach the hazards of all steps as an array."""
        return df.withColumn(out, self._scored(self.leaf_values(), lambda h: h, "array<double>"))

    def with_risk(self, df: DataFrame, id_column: str | None = None, out: str = "risk") -> DataFrame:
        """Cumulative hazard over all steps: higher means sooner."""
        return df.withColumn(out, self._scored(self.leaf_values().sum(1), lambda h: h, "double"))

    def survival_at(self, df: DataFrame, id_column: str | None, times: Sequence[float]) -> DataFrame:
        """S(t) per row at a few times: columns ``t`` and ``surv``; a step counts once its end is reached."""
        times = [float(t) for t in times]
        reached = [sum(e <= t for e in self.edges) for t in times]

        def lived(hazards: np.ndarray) -> np.ndarray:
            alive = np.column_stack([np.ones(len(hazards)), np.cumprod(1 - hazards, axis=1)])
            return alive[:, reached]

        at = df.withColumn("_s", self._scored(self.leaf_values(), lived, "array<double>"))
        grid = F.arrays_zip(F.array(*map(F.lit, times)).cast("array<double>").alias("t"), F.col("_s").alias("surv"))
        return at.select(*df.columns, F.inline(grid))

    def curves(self, df: DataFrame, id_column: str) -> DataFrame:
        """S at the end of every step, for picked customers."""
        return self.survival_at(df, id_column, self.edges).select(
            id_column, F.col("t").alias("time"), "surv"
        )


def _leaves(tree: Tree, steps: int, step: int, node: int = 1, first: int = 0, last: int | None = None) -> list[tuple[int, int, int]]:
    """Leaves from left to right with the run of steps (first, last] they are about."""
    last = steps if last is None else last
    if node not in tree.split:
        return [(node, first, last)]
    feature, cut = tree.split[node]
    middle = (cut + 1, cut + 1) if feature == step else (last, first)
    return _leaves(tree, steps, step, 2 * node, first, middle[0]) + _leaves(tree, steps, step, 2 * node + 1, middle[1], last)


def step_edges(df: DataFrame, most: int = MOST_STEPS) -> list[float]:
    """Ends of the steps: the distinct event times, or ``most`` quantiles of them where there are more.

    They follow the events, so one very long time neither adds steps nor
    widens them.
    """
    events = df.where(F.col("event") & F.col("time").isNotNull())
    few = [r["time"] for r in events.select("time").distinct().limit(most + 1).collect()]
    if len(few) <= most:
        return sorted(few) or [df.agg(F.max("time")).first()[0] or 1.0]
    probabilities = [(i + 1) / most for i in range(most)]
    return sorted(set(exact_quantiles(events, [], "time", probabilities).first()["quantiles"]))


def bin_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Ends of all bins but the last, per feature: between its values if they are few, else at its quantiles."""
    features = list(features)

    def few(stream):
        found = [np.zeros(0)] * len(features)
        for batch in stream:
            for j in range(len(features)):
                if len(found[j]) <= bins:
                    values = batch.column(j).drop_null().to_numpy(zero_copy_only=False)
                    found[j] = np.union1d(found[j], values[~np.isnan(values)])[: bins + 1]
        where = np.repeat(np.arange(len(features)), [len(v) for v in found])
        yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(np.concatenate(found))], names=["j", "value"])

    columns = df.select(*[F.col(f"`{f}`").cast("double").alias(f"_{j}") for j, f in enumerate(features)])
    distinct = columns.mapInArrow(few, "j int, value double").distinct().groupBy("j").agg(F.slice(F.sort_array(F.collect_set("value")), 1, bins + 1).alias("v"))
    values = {r["j"]: np.array(r["v"]) for r in distinct.collect()}  # at most bins + 1 values per feature
    many = [j for j in range(len(features)) if len(values.get(j, ())) > bins]
    wanted = [i / bins for i in range(1, bins)]
    # quantiles are within a quarter of a bin; NaN has no place among them
    ends = dict(zip(many, columns.approxQuantile([f"_{j}" for j in many], wanted, 0.25 / bins))) if many else {}
    between = lambda v: (v[1:] + v[:-1]) / 2
    return [np.unique(ends[j]) if j in ends else between(values.get(j, np.zeros(0))) for j in range(len(features))]


def _packed(df: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], edges: Sequence[float]) -> DataFrame:
    """Blocks of customers, written once: their last step (longest first), whether it was the event, and their bins."""
    own = F.least(F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e < F.col("time"))) + 1, F.lit(len(edges)))
    known = df.where(F.col("event").isNotNull() & F.col("time").isNotNull())
    rows = known.select(own.cast("int").alias("own"), F.col("event").cast("int").alias("event"), *[F.col(f"`{f}`").cast("double").alias(f"_{j}") for j, f in enumerate(features)])
    p = len(features)

    def run(stream):
        part, count = TaskContext.get().partitionId(), 0
        waiting: list[np.ndarray] = []

        def emit(data: np.ndarray) -> pa.RecordBatch:
            ordered = data[np.argsort(-data[:, 0].astype(int), kind="stable")]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([count], pa.int32()), pa.array([np.asfortranarray(ordered).tobytes("F")], pa.binary())], names=["part", "number", "block"]
            )

        for batch in stream:
            data = np.empty((len(batch), p + 2), np.uint8)
            data[:, 0], data[:, 1] = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for j in range(p):  # a missing value is in the last bin
                data[:, 2 + j] = np.searchsorted(cuts[j], batch.column(2 + j).fill_null(float("nan")).to_numpy(zero_copy_only=False))
            waiting.append(data)
            if sum(map(len, waiting)) >= BLOCK_ROWS:
                whole = np.concatenate(waiting)
                full = len(whole) // BLOCK_ROWS * BLOCK_ROWS
                for at in range(0, full, BLOCK_ROWS):
                    yield emit(whole[at : at + BLOCK_ROWS])
                    count += 1
                waiting = [whole[full:]]
        if sum(map(len, waiting)):
            yield emit(np.concatenate(waiting))

    return cut_lineage(rows.mapInArrow(run, "part int, number int, block binary"))


def _add_block(totals: list[dict], data: np.ndarray, trees: Sequence[Tree], active: Sequence[dict], steps: int, seed: Sequence[int]) -> None:
    """Add a block's sums to ``totals``: per tree and active node, for its features, rows and events per bin."""
    own, event = data[:, 0].astype(int), data[:, 1].astype(bool)
    bins = data[:, 2:].T.astype(np.intp)
    n, p = len(own), len(bins)
    alive = np.searchsorted(-own, -np.arange(steps), side="left")  # rows that live through step s come first
    starts = np.concatenate([[0], np.cumsum(alive)])
    drawn, run = np.zeros((steps, n), np.uint16), np.zeros((steps + 1, n), np.uint16)
    everyone, at_event = np.arange(n), np.flatnonzero(event)
    for k, (tree, wanted) in enumerate(zip(trees, active)):
        if not wanted:
            continue
        # every row of a customer and a step is drawn for every tree on its own, the same in every pass
        chance = np.random.Generator(np.random.SFC64([*seed, k])).integers(0, 2**64, starts[-1] // 4 + 1, np.uint64).view(np.uint16)
        count = np.zeros(len(chance), np.uint8)
        for bound in _DRAWS:
            count += chance >= bound
        for s in range(steps):
            drawn[s, : alive[s]] = count[starts[s] : starts[s + 1]]
            np.add(run[s], drawn[s], out=run[s + 1])
        hits = np.zeros(n)
        hits[at_event] = drawn[own[at_event] - 1, at_event]

        def walk(node: int, rows: np.ndarray, events: np.ndarray, first: int, last: int) -> None:
            if node in wanted:
                weight = (run[last][rows] - run[first][rows]).astype(float)
                for j, total in zip(wanted[node], totals[k][node]):
                    if j == p:
                        total[0, first:last] += drawn[first:last][:, rows].sum(1, dtype=float)
                        total[1] += np.bincount(own[events] - 1, weights=hits[events], minlength=steps)
                    else:
                        total[0] += np.bincount(bins[j][rows], weights=weight, minlength=total.shape[1])
                        total[1] += np.bincount(bins[j][events], weights=hits[events], minlength=total.shape[1])
            elif node in tree.split:
                feature, cut = tree.split[node]
                if feature == p:
                    late = events[own[events] > cut + 1]
                    walk(2 * node, rows, events[own[events] <= cut + 1], first, cut + 1)
                    walk(2 * node + 1, rows[own[rows] > cut + 1], late, cut + 1, last)
                else:
                    left, early = bins[feature][rows] <= cut, bins[feature][events] <= cut
                    walk(2 * node, rows[left], events[early], first, last)
                    walk(2 * node + 1, rows[~left], events[~early], first, last)

        walk(1, everyone, at_event[hits[at_event] > 0], 0, steps)


def _empty(wanted: dict, sizes: Sequence[int]) -> dict:
    return {node: [np.zeros((2, sizes[j])) for j in chosen] for node, chosen in wanted.items()}


def _sums(blocks: DataFrame, trees: Sequence[Tree], active: Sequence[dict], sizes: Sequence[int], seed: int) -> list[dict]:
    """The sums of all blocks for all active nodes of all trees, from one pass."""
    p = len(sizes) - 1

    def flat(total: dict) -> np.ndarray:
        return np.concatenate([part.ravel() for parts in total.values() for part in parts])

    def rows(totals: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([v.tobytes() for v in totals.values()], pa.binary())], names=["tree", "total"])

    def run(stream):
        totals = [_empty(wanted, sizes) for wanted in active]
        for batch in stream:
            for part, number, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = np.frombuffer(block.as_buffer(), np.uint8).reshape(p + 2, -1).T
                _add_block(totals, data, trees, active, sizes[p], (seed, part, number))
        yield rows({k: flat(total) for k, total in enumerate(totals) if total})

    def add(stream):
        totals: dict[int, np.ndarray] = {}
        for batch in stream:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = np.frombuffer(part.as_buffer(), float)
                totals[k] = totals[k] + value if k in totals else value
        yield rows(totals)

    kind = "tree int, total binary"
    # one row per tree: as long as its active nodes, whatever the customers
    found = {r["tree"]: np.frombuffer(r["total"], float) for r in blocks.mapInArrow(run, kind).repartition(min(len(trees), 16), "tree").mapInArrow(add, kind).collect()}
    out = []
    for k, wanted in enumerate(active):
        total, at = _empty(wanted, sizes), 0
        for parts in total.values() if k in found else ():
            for part in parts:
                part += found[k][at : at + part.size].reshape(part.shape)
                at += part.size
        out.append(total)
    return out


def _best_split(chosen: Sequence[int], parts: Sequence[np.ndarray], leaf: int):
    """Largest gain of the Gini impurity: (feature, cut, chance left, chance right), or None."""
    best, gain = None, 0.0
    for j, (rows, events) in zip(chosen, parts):
        left, hit = np.cumsum(rows)[:-1], np.cumsum(events)[:-1]
        n, e = rows.sum(), events.sum()
        right, missed = n - left, e - hit
        allowed = (left >= leaf) & (right >= leaf)
        if not allowed.any():
            continue
        safe = lambda a, b: a / np.maximum(b, 1)
        after = safe(hit * (left - hit), left) + safe(missed * (right - missed), right)
        better = np.where(allowed, e * (n - e) / n - after, -np.inf)
        at = int(np.argmax(better))
        if better[at] / n > max(gain, 1e-15):
            best, gain = (j, at, hit[at] / left[at], missed[at] / right[at]), better[at] / n
    return best


def fit_hazard_forest(
    df: DataFrame,
    features: Sequence[str],
    trees: int = 50,
    depth: int = 5,
    leaf: int = 15,
    most_steps: int = MOST_STEPS,
    seed: int = 42,
) -> HazardForest:
    """Fit on ``event, time`` and numeric features, with at most ``most_steps`` steps.

    A customer lives through every step that ends before their time, and the
    one their time falls into.  Every node tries the square root of the number
    of features, the step being one of them; ``leaf`` is the least number of
    drawn steps of customers in a node.
    """
    features = list(features)
    edges = step_edges(df, most_steps)
    if len(edges) > 255:
        raise ValueError("a forest has at most 255 steps")
    cuts = bin_cuts(df, features)
    sizes = [*[len(c) + 1 for c in cuts], len(edges)]
    blocks = _packed(df, features, cuts, edges)
    picked = int(np.ceil(np.sqrt(len(sizes))))
    forest = [Tree({}, {}) for _ in range(trees)]
    nodes: list[list[int]] = [[1]] * trees
    for level in range(max(depth, 1)):
        active = [
            {node: sorted(np.random.default_rng([seed, k, node]).choice(len(sizes), picked, replace=False).tolist()) for node in nodes[k]} for k in range(trees)
        ]
        totals = _sums(blocks, forest, active, sizes, seed)
        for k, tree in enumerate(forest):
            grown = []
            for node, chosen in active[k].items():
                parts = totals[k][node]
                if level == 0:
                    rows, events = parts[0].sum(1)
                    tree.chance[1] = events / rows if rows else 0.0
                found = _best_split(chosen, parts, leaf) if depth else None
                if found:
                    tree.split[node] = found[:2]
                    tree.chance |= {2 * node: float(found[2]), 2 * node + 1: float(found[3])}
                    grown += [2 * node, 2 * node + 1]
            nodes[k] = grown
        if not any(nodes):
            break
    return HazardForest(features, forest, cuts, edges)
