"""Least squares for many groups at once, from sums of products.

Every row brings a vector: its regressors and, last, its target.  Tasks add up
the products of their rows per group, whatever groups they hold, and the sums
of a group are added up afterwards; so no task needs the rows of a group
together.  What is solved is one small matrix per group.  Several solutions of
a group (prior scales, orders) come from the same sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A pivot this small against its column's own size means that the column adds nothing.
NO_PIVOT = 1e-11


def products(rows: DataFrame, keys: Sequence[str], vector: str = "v") -> DataFrame:
    """keys, rows and the packed upper triangle of the summed outer products of ``vector``.

    Vectors of a group have the same length; rows whose vector is null are left out.
    """
    keys = list(keys)
    kinds = dict(rows.dtypes)
    held = rows.where(F.col(vector).isNotNull()).select(*keys, F.to_json(F.struct(F.lit(0), *keys)).alias("_group"), F.col(vector).alias("_vector"))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not len(batch):
                continue
            code = batch.column(len(keys)).dictionary_encode().indices.to_numpy()
            order = np.argsort(code, kind="stable")
            firsts, counts, sums = [], [], []
            for own in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
                held = batch.column(len(keys) + 1).take(pa.array(own)).flatten().to_numpy().reshape(len(own), -1)
                gram = held.T @ held
                firsts.append(own[0])
                counts.append(len(own))
                sums.append(gram[np.triu_indices(len(gram))])
            edges = np.cumsum([0, *map(len, sums)]).astype(np.int32)
            packed = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(sums)))
            columns = [batch.column(i).take(pa.array(firsts)) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), packed], names=[*keys, "rows", "products"])

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keys], "rows bigint", "products array<double>"])
    parts = held.mapInArrow(run, schema)
    # a group has one part for each task that held some of its rows
    lists = parts.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.collect_list("products").alias("_parts"))
    total = F.aggregate(F.slice("_parts", 2, F.greatest(F.size("_parts") - 1, F.lit(0))), F.element_at("_parts", 1), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    return lists.select(*keys, "rows", total.alias("products"))


def unpacked(packed: np.ndarray) -> np.ndarray:
    """The symmetric matrix of a packed upper triangle."""
    size = int((np.sqrt(8 * len(packed) + 1) - 1) / 2)
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = packed
    return out + np.triu(out, 1).T


def solve(sums: DataFrame, keys: Sequence[str], function: Callable[..., list[dict]], fields: str, extra: Sequence[str] = ()) -> DataFrame:
    """keys and the rows that ``function(rows, matrix, **extra)`` makes of each group's matrix.

    Numbers may be None.  The last row and column of the matrix belong to the target.
    """
    keys, extra = list(keys), list(extra)
    kinds = dict(sums.dtypes)
    names = [part.strip().split()[0] for part in fields.split(",")]

    def run(stream: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in stream:
            out = []
            for row in frame.itertuples(index=False):
                own = dict(zip(frame.columns, row))
                for found in function(int(own["rows"]), unpacked(np.asarray(own["products"], float)), **{c: own[c] for c in extra}):
                    out.append([*[own[c] for c in keys], *[found.get(c) for c in names]])
            yield pd.DataFrame(out, columns=[*keys, *names], dtype=object)

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keys], fields])
    return sums.select(*dict.fromkeys([*keys, *extra]), "rows", "products").mapInPandas(run, schema)


def least_squares(rows: int, matrix: np.ndarray) -> dict | None:
    """Coefficients, residual sum of squares and the inverse of the regressors' matrix; None without a solution."""
    gram, moment, square = matrix[:-1, :-1], matrix[:-1, -1], matrix[-1, -1]
    size = np.sqrt(np.maximum(np.diag(gram), 0))
    if rows <= len(gram) or (size == 0).any():
        return None
    scaled = gram / size / size[:, None]
    if np.linalg.matrix_rank(scaled, tol=NO_PIVOT, hermitian=True) < len(gram):
        return None
    inverse = np.linalg.inv(scaled) / size / size[:, None]
    beta = np.linalg.solve(scaled, moment / size) / size
    return {"beta": beta, "sse": max(float(square - 2 * beta @ moment + beta @ gram @ beta), 0.0), "inverse": inverse}


def nested_sse(matrix: np.ndarray) -> np.ndarray:
    """Residual sums of squares of the regressions on the first 1, 2, ... regressors.

    One elimination gives all of them: what is left of the target's square
    after each pivot is the sum for the leading block so far.
    """
    work, out = matrix.copy(), np.empty(len(matrix) - 1)
    for i in range(len(out)):
        if work[i, i] > NO_PIVOT * max(matrix[i, i], 0.0):
            work[i + 1 :, i + 1 :] -= np.outer(work[i + 1 :, i], work[i, i + 1 :]) / work[i, i]
        out[i] = max(work[-1, -1], 0.0)
    return out


def dot(a: str | Column, b: str | Column) -> Column:
    """Sum of products of two arrays of doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
