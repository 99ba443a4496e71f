"""Text columns as numpy byte arrays: words, rolling hashes and rows by weight.

Arrow hands a batch of strings to a task as one byte buffer with offsets, so
everything here works on that buffer at once.  Batches are cut into runs of
rows of at most ``RUN_BYTES`` (one row at least), which bounds the memory of a
task by that size or by its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_BYTES = 1 << 20
HASH_BYTES = 1 << 18
BASE = 0x9E3779B97F4A7C15 | 1
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def byte_table(values, dtype=bool, fill=0) -> np.ndarray:
    """A table of 256 entries from a mapping or from the bytes that are true."""
    table = np.full(256, fill, dtype=dtype)
    for key in values:
        table[key] = values[key] if isinstance(values, dict) else True
    return table


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; a null is an empty row."""
    if pa.types.is_null(column.type):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def runs(offsets: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def text_runs(column: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of each run of a column."""
    data, offsets = column_bytes(column)
    for lo, hi in runs(offsets, most):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes, cut at row borders."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, stop = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(inside))]
    start[border] = inside[border]
    stop[border - 1] = inside[border - 1]
    return np.flatnonzero(start), np.flatnonzero(stop) + 1


def owner(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that each position lies in."""
    return np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of spans of bytes by differences of a weighted prefix sum."""

    def __init__(self, segment: int = HASH_BYTES):
        self.segment = segment
        self._powers(segment)

    def _powers(self, n: int) -> None:
        base = np.full(n + 1, BASE, np.uint64)
        back = np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64)
        base[0] = back[0] = 1
        self.power, self.inverse = np.cumprod(base), np.cumprod(back)

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each span; spans must be in order of their starts and ends."""
        out, i, n = np.empty(len(starts), np.uint64), 0, len(starts)
        while i < n:
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + self.segment, "right")))
            first, size = int(starts[i]), int(ends[j - 1] - starts[i])
            if size >= len(self.power):
                self._powers(size)
            total = np.zeros(size + 1, np.uint64)
            np.cumsum((data[first : first + size] + np.uint64(1)) * self.power[:size], out=total[1:])
            a, b = starts[i:j] - first, ends[i:j] - first
            out[i:j] = (total[b] - total[a]) * self.inverse[a] + (b - a).astype(np.uint64)
            i = j
        return mix(out)

    def one(self, text: str | bytes) -> int:
        raw = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
        return int(self.spans(raw, np.array([0]), np.array([len(raw)]))[0])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, everything else as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def lower_latin(data: np.ndarray) -> np.ndarray:
    """A-Z and the accented capitals U+00C0 to U+00DE in lower case."""
    out = lower_ascii(data)
    if len(data) > 1:
        second = data[1:]
        out[1:] += ((data[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)).astype(np.uint8) * np.uint8(32)
    return out


def first_of_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For ordered spans: index of the first span of each row, and the number of spans at the end."""
    return np.searchsorted(starts, offsets)


def row_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of values[edges[i]:edges[i + 1]]; an empty range gives 0."""
    total = np.zeros((len(values) + 1,) + values.shape[1:], np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def repeats_and_distinct(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: number of distinct keys, and size of the largest group of equal keys."""
    if not len(keys):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    own = mix(keys ^ (rows.astype(np.uint64) * np.uint64(BASE)))
    order = np.argsort(own, kind="stable")
    own = own[order]
    head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    sizes = np.diff(np.concatenate([head, [len(own)]]))
    where = rows[order[head]]
    most = np.zeros(n, np.int64)
    np.maximum.at(most, where, sizes)
    return np.bincount(where, minlength=n), most


def score_rows(df: DataFrame, keep: list[str], text: str, function, schema: str) -> DataFrame:
    """Columns ``keep`` and what ``function`` (bytes, offsets -> list of arrays) makes of ``text``.

    Only ``keep`` and ``text`` are read, so other columns of the input cannot
    clash with the result.
    """
    def batches(stream):
        for batch in stream:
            columns = [batch.column(i) for i in range(len(keep))]
            for lo, hi, data, offsets in text_runs(batch.column(len(keep))):
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in function(data, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(lo, hi - lo) for c in columns] + made, names=[str(i) for i in range(len(keep) + len(made))]
                ).rename_columns(names)

    names = keep + [part.split()[0] for part in schema.split(",")]
    kinds = dict(df.dtypes)
    full = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [schema])
    return df.select(*keep, text).mapInArrow(batches, full)


def filter_rows(df: DataFrame, text: str, function) -> DataFrame:
    """Rows with all their columns for which ``function`` (bytes, offsets -> mask) holds."""
    at = df.columns.index(text)

    def batches(stream):
        for batch in stream:
            masks = [function(data, offsets) for _, _, data, offsets in text_runs(batch.column(at))]
            if masks:
                yield batch.filter(pa.array(np.concatenate(masks)))

    return df.mapInArrow(batches, df.schema)


def bit_field(rows: DataFrame, h: str, bits: int) -> np.ndarray:
    """A field of ``2 ** bits`` bits with the bit of the top ``bits`` bits of each 64-bit hash set.

    Its size is fixed, so it may go to every task; the more hashes, the more
    others pass it too, and what passes is always joined exactly afterwards.
    """
    place = rows.select(F.shiftrightunsigned(h, 64 - bits).alias("place"))
    bytes_ = place.select(F.expr("place div 8").alias("byte"), F.expr("shiftleft(1, cast(place % 8 as int))").alias("v")).groupBy("byte").agg(F.bit_or("v").alias("v")).toArrow()
    field = np.zeros(max(1 << bits >> 3, 1), np.uint8)
    field[bytes_["byte"].to_numpy()] = bytes_["v"].to_numpy()
    return field


def in_field(h: np.ndarray, field: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes have their bit set."""
    bit = h.view(np.uint64) >> np.uint64(64 - bits)
    return (field[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
