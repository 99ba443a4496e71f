"""Vector codes against plain rounds over all rows and entries; trees against all distances."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import anchors, codebooks


def brute(rows, rounds=4):
    """Everything by the definition, with Python's integers."""
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, label, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, _, v in kept) // 4) * 4
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    part = lambda v, p: v[p * width // 4 : (p + 1) * width // 4]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:256]
    books = [[part(v, p) for _, _, v in order] for p in range(4)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((far(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(4):
            own = {}
            for _, _, v in kept:
                own.setdefault(near(part(v, p), books[p])[1], []).append(part(v, p))
            for k, parts in own.items():
                books[p][k] = [sum(c) // len(parts) for c in zip(*parts)]
    out, total = [], {}
    for i, label, v in kept:
        best = [near(part(v, p), books[p]) for p in range(4)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
        total[label] = total.get(label, 0) + out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, code, error, total[label], sha) for i, label, code, error in out), key=str)


def coded(spark, rows, kind="array<double>", more=""):
    frame = spark.createDataFrame(rows, f"vec_id long, label int, embedding {kind}{more}")
    return sorted((tuple(r) for r in codebooks.compress(frame).collect()), key=str)


def clustered(seed=5, n=700, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, width))
    x = centres[rng.integers(30, size=n)] + 0.01 * rng.normal(size=(n, width))
    x[: n // 3] = x[0]  # a third of the rows is one vector
    return [(int(i), [None, 1, 2][i % 3], [float(c) for c in v]) for i, v in zip(rng.permutation(n), x)]


def test_same_codes_as_plain_rounds(spark):
    rows = clustered()
    assert coded(spark, rows) == brute(rows)


def test_short_long_null_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, 1, [0.5, -0.25, 1.0]), (3, 1, [0.5, -0.25, 1.0]), (None, None, [0.0] * 6), (1, 2, None), (2, 2, [nan, 1.0]), (4, 2, [inf]),
            (5, 2, [None]), (6, None, []), (7, 1, [-0.0004, 2.0, 0.0, 0.0, 3.0])]
    assert coded(spark, rows) == brute(rows)
    clash = [(*r, "x", 1) for r in rows]
    assert coded(spark, clash, more=", code string, error int") == brute(rows)
    assert coded(spark, []) == [] and coded(spark, [(1, 1, None)]) == []
    assert coded(spark, [(1, 1, [0.25])]) == brute([(1, 1, [0.25])])


def test_large_components_stay_exact(spark):
    rows = [(i, 0, [60000.0 + i / 7, -65000.0, 1.0, i / 1000]) for i in range(300)]
    assert coded(spark, rows) == brute(rows)


@pytest.mark.parametrize("kind", ["random", "clustered", "equal", "ties"])
def test_trees_give_exact_nearest_entries(kind):
    rng = np.random.default_rng(1)
    points = {
        "random": rng.integers(-500, 500, (900, 6)),
        "clustered": (rng.integers(-5000, 5000, (12, 6))[rng.integers(12, size=900)] + rng.integers(-3, 4, (900, 6))),
        "equal": np.full((900, 6), 7),
        "ties": rng.integers(0, 2, (900, 6)),
    }[kind].astype(np.int64)
    entries = points[:200].copy()
    tree = anchors.build(points)
    far = ((points[:, None] - entries) ** 2).sum(2)
    code, error = anchors.assign(tree, entries)
    assert (code == far.argmin(1)).all() and (error == far.min(1)).all()
    count, sums = anchors.totals(tree, entries)
    assert (count == np.bincount(code, minlength=200)).all()
    assert all((sums[e] == points[code == e].sum(0)).all() for e in range(200))
    owned, _, leaves, _ = anchors._owners(tree, entries)
    covered = (tree["last"] - tree["first"])[np.concatenate([owned, leaves])].sum()
    assert covered == len(points)
    if kind == "equal":
        assert len(owned) == 1
    if kind == "clustered":
        assert len(anchors._owners(tree, entries[:12])[2]) < 0.7 * tree["leaf"].sum()


def test_trees_do_not_depend_on_blocks(spark, monkeypatch):
    rows = clustered(9, 300, 4)
    want = coded(spark, rows)
    monkeypatch.setattr(codebooks, "BLOCK_ROWS", 37)
    assert coded(spark, rows) == want
