import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import textbytes as tb

TEXTS = st.lists(st.none() | st.text(alphabet="ab \n\té", max_size=12), max_size=8)
WORD = ~tb.byte_table(tb.WHITE)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 20))
def test_words_and_hashes_are_those_of_each_text(texts, segment):
    hasher, whole = tb.Hasher(segment), tb.Hasher()
    data, offsets = tb.column_bytes(pa.array(texts, pa.string()))
    starts, ends = tb.spans(WORD[data], offsets)
    rows = tb.owner(starts, offsets)
    got = [(int(r), data[a:b].tobytes()) for r, a, b in zip(rows, starts, ends)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().split()]
    assert [int(h) for h in hasher.spans(data, starts, ends)] == [whole.one(w) for _, w in got]


def test_slices_and_runs_cover_every_row_once():
    column = pa.array(["x" * n for n in (0, 5, 3, 0, 100, 1)]).slice(1)
    data, offsets = tb.column_bytes(column)
    assert offsets.tolist() == [0, 5, 8, 8, 108, 109] and len(data) == 109
    assert [r for lo, hi in tb.runs(offsets, 8) for r in range(lo, hi)] == list(range(5))


def test_distinct_and_largest_groups():
    keys, rows = np.array([1, 1, 2, 1, 3, 3, 3], np.uint64), np.array([0, 0, 0, 2, 2, 2, 2])
    distinct, most = tb.repeats_and_distinct(keys, rows, 4)
    assert distinct.tolist() == [2, 0, 2, 0] and most.tolist() == [2, 0, 3, 0]


def test_fields_pass_what_was_put_in(spark):
    rows = spark.range(500).selectExpr("xxhash64(id) AS h")
    held = np.array([r.h for r in rows.collect()])
    field = tb.bit_field(rows, "h", 14)
    other = np.random.default_rng(1).integers(-(2**63), 2**63, 20_000)
    assert tb.in_field(held, field, 14).all() and tb.in_field(other, field, 14).mean() < 0.05
    assert not tb.in_field(other, tb.bit_field(rows.limit(0), "h", 14), 14).any()
