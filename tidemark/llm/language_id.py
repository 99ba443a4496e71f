"""Language of a text: the family first, then one-against-one linear SVMs inside it.

A text is its letters in lower case with one blank for everything else; its
features are the rates of hashed runs of three and of four bytes.  A linear
model over rates is the mean of one weight per position, so scoring looks up a
small table per byte and never builds feature vectors.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb

# Language codes by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("pl", "cs", "sk", "ru", "uk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
}
BUCKET_BITS = 13
#: Bound of the sample that the model is fitted on: rows of each language.
ROWS_PER_LANGUAGE = 300
STEPS = 300


def family_of(language: str) -> str:
    """The family of a code; a code in no family is a family of its own."""
    return next((name for name, codes in FAMILIES.items() if language.lower() in codes), language)


def held_out(key: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = tb.lower_latin(data)
    letter = ((low >= 97) & (low <= 122)) | (low >= 0x80)
    return np.where(letter, low, np.uint8(32))


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Bucket of each run of three and four bytes, and which runs count.

    A run counts if it stays in its row, holds a letter and no two blanks.
    """
    x = _letters(data, offsets).astype(np.uint32)
    out = []
    for size, salt in ((3, 0), (4, 1 << BUCKET_BITS)):
        n = len(x) - size + 1
        if n <= 0:
            out.append((np.empty(0, np.int64), np.empty(0, np.int64)))
            continue
        key = np.zeros(n, np.uint32)
        for k in range(size):
            key = (key << np.uint32(8)) | x[k : k + n]
        blank = x == 32
        pair = blank[:-1] & blank[1:]
        good = ~pair[:n]
        for k in range(1, size - 1):
            good &= ~pair[k : k + n]
        for k in range(1, size):
            border = offsets[1:-1] - k
            good[border[(border >= 0) & (border < n)]] = False
        at = np.flatnonzero(good)
        bucket = ((key[at] * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64) + salt
        out.append((at, bucket))
    return out


@dataclass
class LanguageModel:
    """Weights of all one-against-one separators, one column each."""

    families: list[str]
    languages: dict[str, list[str]]
    family_pairs: list[tuple[int, int]]
    language_pairs: dict[str, list[tuple[int, int]]]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(offsets) - 1
        if not self.families:
            return ["und"] * n, np.zeros(n)
        total, count = np.zeros((n, self.weights.shape[1])), np.zeros(n)
        for at, bucket in _grams(data, offsets):
            edges = np.searchsorted(at, offsets)
            total += tb.row_sums(self.weights[bucket], edges)
            count += np.diff(edges)
        margin = total / np.maximum(count, 1)[:, None] + self.bias
        lettered = _has_letter(data, offsets)
        family, sure = _vote(margin[:, : len(self.family_pairs)], self.family_pairs, len(self.families))
        named, score = np.full(n, "und", object), np.zeros(n)
        column = len(self.family_pairs)
        for k, name in enumerate(self.families):
            own = self.language_pairs[name]
            pick, inner = _vote(margin[:, column : column + len(own)], own, len(self.languages[name]))
            column += len(own)
            mine = lettered & (family == k)
            named[mine] = np.array(self.languages[name], object)[pick[mine]]
            score[mine] = (sure * inner)[mine]
        return named.tolist(), score


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = tb.lower_ascii(data)
    found = np.diff(np.searchsorted(np.flatnonzero((low >= 97) & (low <= 122)), offsets)) > 0
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def _vote(margin: np.ndarray, pairs: list[tuple[int, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Winner of the pairwise votes (ties: larger sum of margins), and its mean probability."""
    n = len(margin)
    votes, sums = np.zeros((n, classes)), np.zeros((n, classes))
    for k, (a, b) in enumerate(pairs):
        side = 1 / (1 + np.exp(np.clip(-3 * margin[:, k], -30, 30)))
        for c, p in ((a, side), (b, 1 - side)):
            votes[:, c] += p > 0.5
            sums[:, c] += p
    best = (votes + sums / (classes + 1)).argmax(1) if n else np.zeros(0, int)
    won = sums[np.arange(n), best] / max(classes - 1, 1) if classes > 1 else np.ones(n)
    return best, won


def _svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by accelerated gradient steps; y is +1, -1, or 0 for rows left out.

    Both classes weigh the same.
    """
    share = (np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * (y != 0)).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, vb, step = w.copy(), b, 1.0 / (2 * float((np.einsum('ij,ij->i', x, x) * share).sum() + 1) + penalty)
    for k in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ v + vb)) * share * y
        new, nb = v + step * (2 * (slack @ x) - penalty * v), vb + step * 2 * float(slack.sum())
        pull = k / (k + 3)
        v, vb = new + pull * (new - w), nb + pull * (nb - b)
        w, b = new, nb
    return w, b


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, text: str = "text", key: str = "doc_id") -> LanguageModel:
    """Fit on at most ``rows_per_language`` rows of each language, taken by the hash of the id.

    Held-out rows, rows without language, text or id are not used.  The model
    of a table without usable rows knows no language: every text is ``und``.
    """
    usable = docs.where(~held_out(key) & F.col("lang").isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    wanted = F.lit(0.0)
    for name, n in counts.items():
        wanted = F.when(F.col("lang") == name, F.lit(min(1.0, 1.3 * rows_per_language / n))).otherwise(wanted)
    place = F.pmod(F.xxhash64(F.col(key), F.lit("language")), F.lit(1 << 30))
    sample = usable.where(place < wanted * float(1 << 30)).withColumn("_place", place)

    def rates(data, offsets):
        n = len(offsets) - 1
        found, parts = _grams(data, offsets), []
        for i in range(n):
            own = np.concatenate([b[slice(*np.searchsorted(at, offsets[i : i + 2]))] for at, b in found])
            parts.append(np.unique(own, return_counts=True))
        import pyarrow as pa

        return [pa.array([a.astype(np.int32) for a, _ in parts], pa.list_(pa.int32())), pa.array([c.astype(np.int32) for _, c in parts], pa.list_(pa.int32()))]

    got = tb.score_rows(sample, ["lang", "_place"], text, rates, "buckets array<int>, counts array<int>").toArrow()
    order = np.argsort(got["_place"].to_numpy(), kind="stable")
    names, taken, rows = got["lang"].to_pylist(), {}, []
    for i in order:
        if taken.get(names[i], 0) < rows_per_language:
            taken[names[i]] = taken.get(names[i], 0) + 1
            rows.append(i)
    x = np.zeros((len(rows), 2 << BUCKET_BITS), np.float32)
    for k, i in enumerate(rows):
        counted = np.array(got["counts"][int(i)].as_py(), np.float32)
        if len(counted):
            x[k, np.array(got["buckets"][int(i)].as_py())] = counted / counted.sum()
    label = np.array([names[i] for i in rows], object)
    scale = 1 / (np.sqrt(np.einsum('ij,ij->j', x, x) / len(rows)) + 1e-4) / 8 if len(rows) else np.ones(x.shape[1], np.float32)
    x *= scale.astype(np.float32)

    languages: dict[str, list[str]] = {}
    for name in sorted(set(label)):
        languages.setdefault(family_of(name), []).append(name)
    families = sorted(languages)
    kin = np.array([family_of(name) for name in label], object)
    columns, biases, inside = [], [], {}

    def separate(groups, among):
        made = list(combinations(range(len(groups)), 2))
        for a, b in made:
            w, bias = _svm(x, (1.0 * (among == groups[a]) - 1.0 * (among == groups[b])).astype(np.float32))
            columns.append((w * scale).astype(np.float32))
            biases.append(bias)
        return made

    pairs = separate(families, kin)
    for name in families:
        inside[name] = separate(languages[name], label)
    weights = np.stack(columns, 1) if columns else np.zeros((2 << BUCKET_BITS, 0), np.float32)
    return LanguageModel(families, languages, pairs, inside, weights, np.array(biases))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs``, over its whole text.

    A text that is null, empty or has no letter is ``und`` with score 0.
    Repeated rows are each scored; ids may be null; other columns are not read.
    """
    return tb.score_rows(docs, [key], text, model.predict, "lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.0, text: str = "text") -> DataFrame:
    """All columns of the rows whose text has a language with a score of ``least`` or more."""
    def good(data, offsets):
        names, score = model.predict(data, offsets)
        return np.array([x != "und" for x in names], bool) & (score >= least)

    return tb.filter_rows(docs, text, good)
