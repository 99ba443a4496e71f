"""Benchmark decontamination by templates: numbers, names and units become placeholders.

A word of a text becomes NUM, UNIT or NAME, or stays itself in lower case
without punctuation at its ends.  Windows of template words are compared, so a
question asked again with other numbers or names is still met.  What stood in
the slots then has to be consistent: one value of the item stands for one value
of the document, over all windows of one occurrence, which lie at one distance
from the item's.  Each occurrence is judged on its own.

Windows of the documents first pass a bit field of the benchmark's windows.
Its size is a parameter and does not grow with the benchmark; what passes is
joined with the benchmark's windows by hash.  Items that are too short, or have
too many slots, for more than one window are met as a whole: word for word, and
by the template of all their words between the borders of sentences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb

#: Words of a window, and how many of them have to be plain words.
WINDOW, LITERAL = 8, 4
#: Items of fewer words are no text to look for.
SHORTEST = 4
#: Plain words of a whole item that is met by its template; with fewer, too much else has that template ("Who is Ada?").
WHOLE_LITERAL = 3
#: Bits of the field that the windows of documents are held against.
FIELD_BITS = 22
# Words that count as units after a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg lb lbs oz ton tons gram grams kilogram kilograms pound pounds ounce ounces "
    "ml l cl liter liters litre litres gallon gallons cup cups "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents usd eur gbp percent % mph kmh kw kwh w v hz mb gb tb degrees "
    "stunde stunden tag tage woche wochen jahr jahre jours heures ans semaines horas días años metros litros"
).split()
NUM, UNIT, NAME = 1, 2, 3
#: How a run of words is met: by a window of its template, word for word, or by the template of the whole.
WINDOWED, VERBATIM, WHOLE = 0, 1, 2
#: Sets the hashes of whole items apart from those of windows.
SALTS = {VERBATIM: 0xD6E8FEB86659FD93, WHOLE: 0xA0761D6478BD642F}


class Templates:
    """Template words of the texts of a run of rows."""

    def __init__(self):
        self.hasher = tb.Hasher()
        self.white = ~tb.byte_table(tb.WHITE)
        self.core = tb.byte_table(list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256)))
        self.units = np.sort(np.array([self.hasher.one(u) for u in UNITS], np.uint64))

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """Starts and ends of the words, hash of each template word, kind of slot (0: none), first word of each row,
        hash of each word itself, whether it begins a sentence or line, whether it would be a name inside one."""
        starts, ends = tb.spans(self.white[data], offsets)
        n = len(starts)
        core = self.core[data]
        inner = np.concatenate([[0], np.cumsum(core)])
        place = np.flatnonzero(core)
        lo, hi = inner[starts], inner[ends]
        kept = hi > lo
        a, b = starts.copy(), ends.copy()
        if len(place):
            a[kept], b[kept] = place[lo[kept]], place[hi[kept] - 1] + 1
        low = tb.lower_latin(data)
        word = self.hasher.spans(low, a, b)
        kind, fresh, name = np.zeros(n, np.uint8), np.ones(n, bool), np.zeros(n, bool)
        if n:
            head = data[a]
            second = data[np.minimum(a + 1, len(data) - 1)]
            capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
            number = (head >= 48) & (head <= 57)
            at = np.minimum(np.searchsorted(self.units, word), len(self.units) - 1)
            row = tb.owner(starts, offsets)
            same = np.concatenate([[False], row[1:] == row[:-1]])
            unit = (self.units[at] == word) & np.concatenate([[False], number[:-1]]) & same
            tail = data[ends - 1]
            closing = np.isin(tail, np.frombuffer(b".!?:;\"')]", np.uint8))
            lines = np.concatenate([[0], np.cumsum(data == 10)])
            fresh[1:] = closing[:-1] | (row[1:] != row[:-1]) | (lines[starts[1:]] > lines[ends[:-1]])
            upper = np.zeros(n, bool)
            upper[b - a > 1] = (second[b - a > 1] >= 65) & (second[b - a > 1] <= 90)
            name = capital & ~upper & ~unit & ~number
            kind[capital & ~fresh & ~upper] = NAME
            kind[unit] = UNIT
            kind[number] = NUM
        template = np.where(kind > 0, kind.astype(np.uint64), word)
        return starts, ends, template, kind, np.searchsorted(starts, offsets), word, fresh, name

    def whole(self, word: np.ndarray, fresh: np.ndarray, edges: np.ndarray, size: int, how: int):
        """First word and hash of each run of ``size`` words or template words; runs of templates, and verbatim
        ones under ``SHORTEST``, only where they begin and end with a sentence or line."""
        n = max(len(word) - size + 1, 0)
        power = np.full(len(word) + 1, tb.BASE, np.uint64)
        back = np.full(len(word) + 1, pow(tb.BASE, -1, 1 << 64), np.uint64)
        power[0] = back[0] = 1
        power, back = np.cumprod(power), np.cumprod(back)
        total = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(word * power[:-1], out=total[1:])
        row = np.searchsorted(edges, np.arange(n), "right") - 1
        good = np.arange(n) + size <= edges[row + 1]
        if size < SHORTEST or how == WHOLE:
            begins = np.append(fresh, True)
            good &= begins[:n] & begins[size : size + n]
        at = np.flatnonzero(good)
        return at, tb.mix((total[at + size] - total[at]) * back[at] + np.uint64(size) * np.uint64(SALTS[how]))

    def windows(self, template: np.ndarray, kind: np.ndarray, edges: np.ndarray, size: int, literal: int):
        """First word and hash of each window inside a row with enough plain words."""
        n = max(len(template) - size + 1, 0)
        total = np.full(n, size, np.uint64)
        for k in range(size):
            total = tb.mix(total * np.uint64(7) + template[k : k + n])
        plain = np.concatenate([[0], np.cumsum(kind == 0)])
        good = plain[size : size + n] - plain[:n] >= literal
        for k in range(1, size):
            border = edges[1:-1] - k
            good[border[(border >= 0) & (border < n)]] = False
        at = np.flatnonzero(good)
        return at, total[at]


def _window_rows(texts: DataFrame, key: str, window: int, lengths: list[int], whole: list[tuple[int, int]], literal: int, field: np.ndarray | None, bits: int) -> DataFrame:
    """Rows (key, mark of the text, first word, size and hash of the window, how it is met, slots) of the windows of ``lengths`` words.

    With ``field`` only windows whose bit is set are given, also those of the
    ``whole`` pairs (size, how).  Without it the texts are the benchmark:
    windows under the full size are whole items, and items with at most one
    window are given whole too, word for word and as a template, and their
    windows from the first word on also with that word as a name.
    """
    names = [key, "mark", "first", "size", "h", "how", "slots"]

    def batches(stream):
        maker = None
        for batch in stream:
            maker = maker or Templates()
            ids, marks = batch.column(0), batch.column(2)
            for lo, hi, data, offsets in tb.text_runs(batch.column(1)):
                starts, ends, template, kind, edges, word, fresh, name = maker(data, offsets)

                def rows(at, h, size, how=WINDOWED, kind=kind):
                    row = np.searchsorted(edges, at, "right") - 1
                    slots = [[] if how == VERBATIM else [_value(data[starts[j] : ends[j]]) for j in range(i, i + size) if kind[j]] for i in at]
                    made = [pa.array(at - edges[row]), pa.array(np.full(len(at), size)), pa.array(h.view(np.int64)), pa.array(np.full(len(at), how)), pa.array(slots, pa.list_(pa.string()))]
                    return pa.RecordBatch.from_arrays([c.slice(lo, hi - lo).take(pa.array(row)) for c in (ids, marks)] + made, names=names)

                count = np.zeros(hi - lo, np.int64)
                for size in lengths:
                    at, h = maker.windows(template, kind, edges, size, min(literal, size - 1))
                    row = np.searchsorted(edges, at, "right") - 1
                    if field is not None:
                        passed = tb.in_field(h, field, bits)
                    else:
                        passed = np.full(len(at), True) if size == window else np.diff(edges)[row] == size
                    count += np.bincount(row[passed], minlength=hi - lo)
                    if passed.any():
                        yield rows(at[passed], h[passed], size)
                if field is not None:
                    for size, how in whole:
                        at, h = maker.whole(word if how == VERBATIM else template, fresh, edges, size, how)
                        passed = tb.in_field(h, field, bits)
                        if passed.any():
                            yield rows(at[passed], h[passed], size, how)
                    continue
                few = np.flatnonzero((count <= 1) & (np.diff(edges) > 0))
                for i in few:
                    size = int(edges[i + 1] - edges[i])
                    own = slice(edges[i], edges[i + 1])
                    for how, held in ((VERBATIM, word), (WHOLE, template)):
                        plain = np.count_nonzero(kind[own] == 0)
                        if how == VERBATIM or (size >= SHORTEST and WHOLE_LITERAL <= plain < size):
                            at, h = maker.whole(held[own], np.ones(size, bool), np.array([0, size]), size, how)
                            yield rows(at + edges[i], h, size, how)
                inside = edges[few][name[edges[few]] & (kind[edges[few]] == 0)]
                if len(inside):
                    other, as_name = template.copy(), kind.copy()
                    other[inside] = as_name[inside] = NAME
                    for size in lengths:
                        at, h = maker.windows(other, as_name, edges, size, min(literal, size - 1))
                        row = np.searchsorted(edges, at, "right") - 1
                        passed = np.isin(at, inside) & ((np.diff(edges)[row] == size) | (size == window))
                        if passed.any():
                            yield rows(at[passed], h[passed], size, kind=as_name)

    kinds = dict(texts.dtypes)
    return texts.withColumn("mark", F.xxhash64("text")).mapInArrow(batches, f"`{key}` {kinds[key]}, mark long, first long, size long, h long, how long, slots array<string>")


def _value(word: np.ndarray) -> str:
    return word.tobytes().decode("utf-8", "replace").strip(".,;:!?\"'()[]").lower()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literal: int = LITERAL, bits: int = FIELD_BITS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document and benchmark item that share an occurrence with consistent slots.

    Columns: doc_id, item_id, n_windows (different windows of the document),
    first_word and last_word (the words they cover, counted from 0), and
    same_slots (an occurrence holds the item's own values in all slots).  Items of fewer words
    than a window are met as a whole.  Items with one window or none are also
    met word for word; of fewer than ``SHORTEST`` words only where they are
    sentences or lines of their own, as such words stand in any text.  Those of
    at least ``SHORTEST`` words, ``WHOLE_LITERAL`` of them plain, are also met
    with other values in their slots, where they stand between borders of
    sentences or lines.  Null or empty texts share nothing.  Rows with
    the same id count as one document.  A document without a row is clean.
    """
    held = benchmark.select("item_id", F.col("text"))
    known = _window_rows(held, "item_id", window, list(range(SHORTEST, window + 1)), [], literal, None, bits)
    sizes = sorted((r["size"], r["how"]) for r in known.select("size", "how").distinct().collect())
    lengths, whole = [n for n, how in sizes if how == WINDOWED], [(n, how) for n, how in sizes if how != WINDOWED]
    field = tb.bit_field(known, "h", bits)
    seen = _window_rows(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "doc_id", window, lengths, whole, literal, field, bits)
    theirs = known.select("item_id", "h", F.col("slots").alias("item_slots"), F.col("first").alias("item_first"), F.col("mark").alias("item_mark"))
    both = seen.join(theirs, "h")
    # one occurrence: windows of one text and one item that lie equally far apart; its sets are no longer than the item
    pairs = F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc"))
    occurrence = ["doc_id", "item_id", "mark", "item_mark", (F.col("first") - F.col("item_first")).alias("shift")]
    grouped = both.groupBy(*occurrence).agg(
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
        F.collect_set("first").alias("firsts"),
        (F.max(F.col("first") + F.col("size")) - 1).alias("last_word"),
    )
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["item"])))
    kept = grouped.where(consistent).withColumn("same", F.forall("pairs", lambda p: p["item"] == p["doc"]))
    return kept.select("doc_id", "item_id", F.explode("firsts").alias("first"), "last_word", "same").groupBy("doc_id", "item_id").agg(
        F.count_distinct("first").alias("n_windows"),
        F.min("first").alias("first_word"),
        F.max("last_word").alias("last_word"),
        F.max("same").alias("same_slots"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All columns of the documents that share nothing with the benchmark.

    Rows with the same id are one document, which goes as a whole.  Rows with a
    null id are told apart by their texts.
    """
    met = contaminated(docs.where(F.col(key).isNotNull()), benchmark, text=text, key=key).select(F.col("doc_id").alias(key)).distinct()
    clean = docs.where(F.col(key).isNotNull()).join(met, key, "left_anti").select(*docs.columns)
    nameless = docs.where(F.col(key).isNull())
    if nameless.isEmpty():
        return clean
    marked = nameless.select(F.xxhash64(text).alias("doc_id"), F.col(text).alias("text"))
    theirs = contaminated(marked, benchmark).select(F.col("doc_id").alias("_mark")).distinct()
    return clean.unionByName(nameless.join(theirs, F.xxhash64(nameless[text]) == theirs["_mark"], "left_anti").select(*docs.columns))
