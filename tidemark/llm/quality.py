"""Quality of a text: boosted histogram trees over statistics of the whole document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import boosting, labelled
from tidemark.llm import textbytes as tb

# The byte classes that are counted.
CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:?", b"!", b"#*$%&|<>^~=+@", b"'\"()[]{}-_/\\`")
THRESHOLD = 0.3
MODULUS, REMAINDER = 5, 0


def _tables():
    kind = np.full(256, len(CLASSES), np.uint8)
    for k, members in enumerate(CLASSES):
        kind[list(members)] = k
    return kind


class Statistics:
    """Statistics of each text of a run of rows: shares of byte classes, words, repeats, lines."""

    def __init__(self):
        self.kind, self.hasher = _tables(), tb.Hasher()
        self.word = ~tb.byte_table(tb.WHITE)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n, length = len(offsets) - 1, np.diff(offsets)
        kinds = len(CLASSES) + 1
        counts = np.bincount(np.repeat(np.arange(n), length) * kinds + self.kind[data], minlength=n * kinds).reshape(n, kinds)
        shares = counts / np.maximum(length, 1)[:, None]

        starts, ends = tb.spans(self.word[data], offsets)
        row, edges = tb.owner(starts, offsets), np.searchsorted(starts, offsets)
        words, size = np.diff(edges), ends - starts
        many = np.maximum(words, 1)
        hashed = self.hasher.spans(data, starts, ends)
        distinct, top = tb.repeats_and_distinct(hashed, row, n)
        same = np.zeros(len(starts), bool)
        if len(starts) > 1:
            same[1:] = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
        three = max(len(starts) - 2, 0)
        window = tb.mix(hashed[:three] + np.uint64(3) * tb.mix(hashed[1 : 1 + three]) + np.uint64(7) * hashed[2 : 2 + three] * np.uint64(tb.BASE))
        inside = row[:three] == row[2 : 2 + three]
        threes = np.bincount(row[:three][inside], minlength=n)
        distinct3, top3 = tb.repeats_and_distinct(window[inside], row[:three][inside], n)
        first, last = self.kind[data[starts]] if len(starts) else np.empty(0, np.uint8), self.kind[data[ends - 1]] if len(starts) else np.empty(0, np.uint8)
        by_row = lambda flag: np.bincount(row[flag], minlength=n) / many
        mean = np.bincount(row, size, n) / many
        spread = np.sqrt(np.maximum(np.bincount(row, size.astype(float) ** 2, n) / many - mean**2, 0))

        from_line, to_line = tb.spans(data != 10, offsets)
        line_row = tb.owner(from_line, offsets)
        lines = np.bincount(line_row, minlength=n)
        distinct_lines, _ = tb.repeats_and_distinct(self.hasher.spans(data, from_line, to_line), line_row, n)
        return np.column_stack([
            np.log1p(length), np.log1p(words), shares, mean, spread, distinct / many, top / many,
            by_row(same), by_row(first == 1), by_row(last == 6), by_row(last == 7), by_row(size == 1),
            np.where(threes > 0, distinct3 / np.maximum(threes, 1), 1), top3 / np.maximum(threes, 1),
            np.log1p(lines), distinct_lines / np.maximum(lines, 1), words / np.maximum(lines, 1),
        ]).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = labelled.MOST_ROWS) -> boosting.Forest:
    """Fit on a bounded sample of labelled rows; classes weigh as they do among all labelled rows."""
    stats = None

    def describe(data, offsets):
        nonlocal stats
        stats = stats or Statistics()
        return [pa.array(list(stats(data, offsets)), pa.list_(pa.float64()))]

    rows = labelled.sample(docs, labels, "quality", MODULUS, REMAINDER, most_rows)
    got = tb.score_rows(rows, ["doc_id", "place", "label"], "text", describe, "x array<double>").toArrow().sort_by([("place", "ascending"), ("doc_id", "ascending")])
    shares = {r["label"]: r["n"] for r in labels.where(~labelled.held_out(MODULUS, REMAINDER)).groupBy(F.col("quality").alias("label")).agg(F.count("*").alias("n")).collect()}
    y = got["label"].to_numpy().astype(float)
    x = np.array(got["x"].to_pylist(), float) if len(got) else np.zeros((0, 1))
    weight = np.ones(len(y))
    for value in (0, 1):
        mine = y == value
        if mine.any():
            weight[mine] = shares.get(value, 0) / mine.sum()
    weight *= len(y) / max(weight.sum(), 1e-9)
    return boosting.fit(x, y, weight)


def score(docs: DataFrame, forest: boosting.Forest, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and score, 0 to 1, of every row over its whole text.

    A null text is an empty one, and an empty one has a score like any other.
    Repeated rows are each scored; other columns are not read.
    """
    stats = None

    def rate(data, offsets):
        nonlocal stats
        stats = stats or Statistics()
        return [forest.probability(stats(data, offsets))]

    return tb.score_rows(docs, [key], text, rate, "score double")
