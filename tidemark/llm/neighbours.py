"""Nearest neighbours by cosine: cross-polytope tables, multiprobe candidates, exact reranking.

1. Index: a hash rotates a unit vector by three rounds of random signs and a
   fast Hadamard transform and takes the nearest signed axis.  ``TABLES``
   tables join a hash over all axes and one over ``SECOND`` axes, and every
   row is filed under its bucket in every table.
2. Probes: what a bucket costs a query is how far its own nearest axes are
   ahead of the bucket's, squared.  A query goes through buckets of all tables
   in the order of that cost until they hold ``PROBED * rows ** POWER`` rows.
3. Search: rows are dealt to cells by a hash of their row number, so no key is
   hot, and every query visits every cell.  A cell files its rows by bucket,
   looks up the probed buckets, and reranks the rows found exactly.

No bucket is cut: a crowded one is only counted as ``HEAVY`` times a mean
bucket when the stop is decided, so that it can't end the probes early.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.vectors import finite, longest, matrix
from tidemark.runtime import cut_lineage

TABLES, SECOND, TURNS = 8, 16, 3
#: Rows to look through per query: PROBED * rows ** POWER, where a row counts once in each table.
PROBED, POWER = 4.0, 0.75
HEAVY = 16
#: Steps of the cost of a bucket in one unit; costs of unit vectors are at most 8.
STEPS = 512
#: Rows of a cell and queries that visit it at a time, as upper bounds.
CELL_ROWS, CELL_QUERIES = 1 << 15, 1 << 13
#: Queries whose probes are worked out together, and the least difference of two rough scores.
AT_ONCE, ROUGH = 64, 1e-11


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two, scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        pair = x.reshape(len(x), -1, 2, h)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


class Tables:
    """The hashes of all tables for vectors of up to ``width`` components."""

    def __init__(self, width: int, seed: int = 20240301):
        self.width, self.axes = width, 1 << max(width - 1, 0).bit_length()
        self.second = min(SECOND, self.axes)
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (TABLES, 2, TURNS, self.axes))
        self.buckets = 2 * self.axes * 2 * self.second

    def unit(self, x: np.ndarray) -> np.ndarray:
        """Rows scaled to length one, with room for the transform."""
        x = scaled(x)
        out = np.zeros((len(x), self.axes))
        out[:, : x.shape[1]] = x / np.sqrt((x * x).sum(1))[:, None]
        return out

    def signed_axes(self, unit: np.ndarray, table: int, part: int) -> np.ndarray:
        """Components along the signed axes after the pseudo-rotation."""
        for sign in self.signs[table, part]:
            unit = hadamard(unit * sign)
        unit = unit[:, : (self.axes, self.second)[part]]
        return np.concatenate([unit, -unit], 1)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table."""
        out = np.empty((len(unit), TABLES), np.int32)
        for t in range(TABLES):
            first, second = (self.signed_axes(unit, t, part).argmax(1) for part in (0, 1))
            out[:, t] = first * 2 * self.second + second
        return out

    def costs(self, unit: np.ndarray) -> np.ndarray:
        """Cost in steps of each bucket of each table: (rows, TABLES, buckets)."""
        out = np.empty((len(unit), TABLES, self.buckets), np.int16)
        for t in range(TABLES):
            sides = [self.signed_axes(unit, t, part) for part in (0, 1)]
            first, second = ((y.max(1, keepdims=True) - y) ** 2 for y in sides)
            out[:, t] = ((first[:, :, None] + second[:, None, :]) * STEPS).reshape(len(unit), -1)
        return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by powers of two, so that squares of any finite components can be summed; cosines stay the same."""
    most = np.abs(x).max(1, initial=0)
    return np.ldexp(x, -np.frexp(most)[1][:, None])


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows with rows, always summed in the same order, so equal rows give equal scores."""
    return (a * b).sum(-1) / (np.sqrt((a * a).sum(-1)) * np.sqrt((b * b).sum(-1)))


def reach(costs: np.ndarray, weight: np.ndarray, wanted: float) -> np.ndarray:
    """Per query the smallest cost up to which buckets hold the wanted rows."""
    steps = 8 * STEPS + 1
    out = np.empty(len(costs), np.int32)
    for i, cost in enumerate(costs):
        held = np.cumsum(np.bincount(cost.ravel(), weight.ravel(), steps))
        out[i] = min(np.searchsorted(held, wanted), steps - 1)
    return out


class Cell:
    """Rows of one cell, filed by bucket in every table."""

    def __init__(self, tables: Tables, row: np.ndarray, ids: pa.Array, vectors: np.ndarray, codes: np.ndarray):
        self.tables, self.row, self.vectors = tables, row, scaled(vectors)
        self.unit = tables.unit(vectors)
        self.null = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy().astype(np.int64)
        self.order = np.argsort(codes, axis=0, kind="stable")
        edges = np.arange(tables.buckets + 1)
        self.first = np.stack([np.searchsorted(codes[self.order[:, t], t], edges) for t in range(TABLES)])

    def candidates(self, cost: np.ndarray, most: int) -> np.ndarray:
        """Rows in the buckets that cost at most ``most``, each once."""
        found = np.zeros(len(self.row), bool)
        for t in range(TABLES):
            probed = np.flatnonzero(cost[t] <= most)
            lo = self.first[t, probed]
            size = self.first[t, probed + 1] - lo
            start = np.cumsum(size) - size
            found[self.order[np.repeat(lo - start, size) + np.arange(size.sum()), t]] = True
        return np.flatnonzero(found)

    def nearest(self, query: np.ndarray, unit: np.ndarray, own: int, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` nearest of the rows ``at`` and their exact scores; ties go to the smaller id, nulls last."""
        at = at[self.row[at] != own]
        rough = self.unit[at] @ unit
        if len(at) > k:
            least = np.partition(rough, len(at) - k)[len(at) - k]
            at = at[rough >= least - ROUGH]
        score = cosine(self.vectors[at], query)
        best = np.lexsort((self.row[at], self.ids[at], self.null[at], -score))[:k]
        return at[best], score[best]


def index(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, Tables, np.ndarray]:
    """Rows (vec_id, row, vector, codes) that take part, the hashes, and the rows of each bucket.

    Vectors that are null, have no components, only zeros, or components that
    are null or not finite take no part.  Shorter vectors count as if filled
    up with zeros.  The counts are a table of fixed size, whatever the rows.
    """
    there = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    there = there.where(finite("vector")).where(F.exists("vector", lambda x: x != 0))
    tables = Tables(longest(there, "vector"))

    def coded(stream):
        for batch in stream:
            if len(batch):
                codes = tables.codes(tables.unit(matrix(batch.column(2), tables.width)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1) * TABLES, pa.int32()), pa.array(codes.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "row", "vector", "codes"])

    kind = dict(there.dtypes)["vector"]
    numbered = there.select("vec_id", F.monotonically_increasing_id().alias("row"), "vector")
    rows = cut_lineage(numbered.mapInArrow(coded, f"vec_id long, row long, vector {kind}, codes array<int>"))
    sums = rows.select(F.posexplode("codes").alias("t", "code")).groupBy("t", "code").count().toArrow()
    counts = np.zeros((TABLES, tables.buckets))
    counts[sums["t"].to_numpy(), sums["code"].to_numpy()] = sums["count"].to_numpy()
    return rows, tables, counts


def search(vectors: DataFrame, every: int = 50, k: int = 5, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows found of each row whose id ``every`` divides.

    A query is compared with every row but itself; another row with the same
    id is a candidate, and a repeated id is a query each time.  A null id is
    never a query and comes last among ties.  If there are at most ``k`` other
    rows, all are returned.  See ``index`` for the rows that take part.
    """
    rows, tables, counts = index(vectors, vector, key)
    spark, n = rows.sparkSession, int(counts[0].sum())
    wanted = max(PROBED * n**POWER, TABLES * (k + 1))
    weight = np.minimum(counts, HEAVY * max(1.0, n / tables.buckets))
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "row", "vector")
    parts = -(-asked.count() // CELL_QUERIES) or 1
    cells = max(-(-n // CELL_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def planned(stream):
        for batch in stream:
            unit = tables.unit(matrix(batch.column(2), tables.width))
            for lo in range(0, len(batch), AT_ONCE):
                most = reach(tables.costs(unit[lo : lo + AT_ONCE]), weight, wanted)
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, AT_ONCE).columns, pa.array(most)], names=["vec_id", "row", "vector", "reach"])

    def visit(held: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        held, queries = held.combine_chunks(), queries.combine_chunks()
        if len(held) and len(queries):
            codes = held["codes"].combine_chunks().flatten().to_numpy().reshape(-1, TABLES)
            ids = held["vec_id"].combine_chunks()
            cell = Cell(tables, held["row"].to_numpy(), ids, matrix(held["vector"], tables.width), codes)
            raw = matrix(queries["vector"], tables.width)
            own, name, most = (queries[c].to_numpy() for c in ("row", "vec_id", "reach"))
            unit, raw = tables.unit(raw), scaled(raw)
            for lo in range(0, len(raw), AT_ONCE):
                costs = tables.costs(unit[lo : lo + AT_ONCE])
                for i in range(lo, min(lo + AT_ONCE, len(raw))):
                    at, score = cell.nearest(raw[i], unit[i], own[i], cell.candidates(costs[i - lo], most[i]), k)
                    for column, values in zip(out, (np.full(len(at), own[i]), np.full(len(at), name[i]), at, score)):
                        column.append(values)
        joined = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
        found = ids.take(pa.array(joined[2])) if out[2] else pa.array([], pa.int64())
        return pa.table([pa.array(joined[0], pa.int64()), pa.array(joined[1], pa.int64()), found, pa.array(joined[3], pa.float64())], names=["asked", "query_id", "vec_id", "score"])

    kind = dict(rows.dtypes)["vector"]
    plans = cut_lineage(asked.mapInArrow(planned, f"vec_id long, row long, vector {kind}, reach int"))
    deal = lambda c, m: F.pmod(F.xxhash64("row", F.lit(c)), F.lit(m)).cast("int")
    held = rows.withColumn("cell", deal("cell", cells)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    queries = plans.withColumn("part", deal("part", parts)).withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    met = held.groupBy("cell", "part").cogroup(queries.groupBy("cell", "part"))
    near = met.applyInArrow(visit, "asked long, query_id long, vec_id long, score double")
    best = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
