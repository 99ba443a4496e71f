"""Neighbours found against all pairs: recall, exact scores, order of ties, odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm import neighbours


def brute(rows, every, k):
    """All pairs in double precision, one by one."""
    ok = [(i, [float(x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for at, (i, v) in enumerate(ok):
        if i is not None and i % every == 0:
            a = np.array(v)
            near = []
            for other, (j, w) in enumerate(ok):
                if other != at:
                    b = np.array(w)
                    near.append((-(a @ b) / (math.sqrt(a @ a) * math.sqrt(b @ b)), j is None, j or 0))
            out.setdefault(i, []).append([(-s, None if null else j) for s, null, j in sorted(near)[:k]])
    return out


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def frame(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {kind}")


def test_recall_and_scores_on_random_and_crowded_vectors(spark):
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(3000, 48))
    rows[:1000] = rows[0] + 0.05 * rng.normal(size=(1000, 48))  # a third of the rows in one place
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in zip(rng.permutation(3000), rows)]
    got, want = found(neighbours.search(frame(spark, rows))), brute(rows, 50, 5)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q][0]}) for q in want)
    assert hits >= 0.93 * 5 * len(want)
    by_id = {i: np.array(v) for i, v in rows}
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[0], x[1])) and q not in [j for _, j in near]
        for score, j in near:
            a, b = by_id[q], by_id[j]
            assert score == pytest.approx((a @ b) / math.sqrt((a @ a) * (b @ b)), abs=1e-14)


def test_ties_few_rows_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (9, [1.0, 0.0]), (4, [1.0, 0.0]), (7, [2.0, 0.0]), (3, [0.0, 1.0]), (50, [-1.0, 0.0]),
            (1, None), (2, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (8, [None, 1.0]), (10, []), (None, [1.0, 0.0])]
    got = found(neighbours.search(frame(spark, rows)))
    assert [j for _, j in got[0]] == [4, 7, 9, None, 3]
    assert [j for _, j in got[50]] == [3, 0, 4, 7, 9] and got[50][1][0] == -1.0
    few = found(neighbours.search(frame(spark, rows[:3])))
    assert [j for _, j in few[0]] == [4, 9]
    alone = neighbours.search(frame(spark, rows[:1]))
    assert alone.collect() == [] and alone.columns == ["query_id", "rank", "vec_id", "score"]
    assert neighbours.search(frame(spark, [])).collect() == []


def test_repeated_ids_clashing_columns_huge_and_short_vectors(spark):
    rows = [(0, [1e300, 1e300, 0.0], 1, 2), (0, [1e-300, 0.0, 0.0], 1, 2), (2, [1.0], 1, 2), (3, [0.0, 3.0, 4.0], 1, 2)]
    near = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, row int, cell int"))
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in near.collect())
    half, other = round(math.sqrt(0.5), 12), round(3 / 5 * math.sqrt(0.5), 12)
    assert got == sorted([(0, 1, 0, half), (0, 2, 2, half), (0, 3, 3, other), (0, 1, 2, 1.0), (0, 2, 0, half), (0, 3, 3, 0.0)])


def test_every_row_is_filed_once_in_every_table(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=10)]) for i in range(500)]
    _, tables, counts = neighbours.index(frame(spark, rows, "array<double>"))
    assert (counts.sum(1) == 500).all() and tables.axes == 16
    x = rng.normal(size=(20, 16))
    assert np.allclose(np.linalg.norm(neighbours.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
