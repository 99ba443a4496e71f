"""Toxicity of a text: a sparse linear classifier that may not lean on names of groups.

Features are the distinct words of a text and their first four to six bytes,
as 64-bit hashes.  Every labelled text that holds an identity term is set beside
the same text with that term swapped for each other term of its kind and
language, and for a neutral word without weight; without the latter all terms
of a kind could share a high one.  The fit adds to the logistic loss a penalty on the change of the
score between the two, so a neutral mention of a group does not raise the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm import textbytes as tb
from tidemark.runtime import cut_lineage

# Terms that name groups of people; those of one row, all of one language, stand for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("christian", "muslim", "jewish", "buddhist", "hindu", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "buddhists", "hindus", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "african", "european", "hispanic", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual", "queer"),
    ("american", "chinese", "mexican", "german", "french", "spanish", "turkish", "russian", "indian"),
    ("old", "young", "disabled", "blind", "deaf"),
)
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
MODULUS, REMAINDER = 3, 1
MOST_FEATURES = 2_000
STEPS = 800
#: Weight of the squared change of a score by a swap.
PENALTY = 20.0
#: Least likelihood-ratio statistic (one degree of freedom) of a feature that is used.
LEAST_EVIDENCE = 18.0


class Features:
    """Distinct hashed features of the texts of a run of rows, in order of the rows."""

    def __init__(self):
        self.hasher = tb.Hasher()
        kinds = np.zeros(256, bool)
        kinds[65:91] = kinds[97:123] = kinds[0x80:] = True
        self.inside = kinds
        self.terms = self.parts = None

    def _of_words(self, data: np.ndarray, offsets: np.ndarray):
        """Hash of each word, then all features, the word that each comes from, and the row of each word."""
        low = tb.lower_latin(data)
        starts, ends = tb.spans(self.inside[low], offsets)
        words = self.hasher.spans(low, starts, ends)
        found, source = [words], [np.arange(len(starts))]
        for k in PREFIXES:
            long = np.flatnonzero(ends - starts > k)
            found.append(tb.mix(self.hasher.spans(low, starts[long], starts[long] + k) + np.uint64(k)))
            source.append(long)
        return words, np.concatenate(found), np.concatenate(source), tb.owner(starts, offsets)

    def all(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        _, found, source, row = self._of_words(data, offsets)
        return found, row[source]

    def term(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return np.unique(self.all(raw, np.array([0, len(raw)]))[0])

    def swaps(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[np.ndarray, np.ndarray, float]]]:
        """For each row, its swapped versions: (features that go, features that come, weight).

        All mentions of one term are swapped at once: once for each other term
        of its row of ``IDENTITY_TERMS``, and once for a word that is no
        feature.  These versions weigh 1 together.
        """
        if self.terms is None:
            self.terms = {self.hasher.one(t): (t, group) for group in IDENTITY_TERMS for t in group}
            self.parts = {t: self.term(t) for group in IDENTITY_TERMS for t in group}
        out: list[list[tuple[np.ndarray, np.ndarray, float]]] = [[] for _ in range(len(offsets) - 1)]
        words, found, source, row = self._of_words(data, offsets)
        held = np.isin(words, np.array(list(self.terms), np.uint64))
        if not held.any():
            return out
        of_row = row[source]
        for i in np.unique(row[held]):
            inside = of_row == i
            feature, word = found[inside], words[source[inside]]
            for h in np.unique(words[held & (row == i)]):
                term, group = self.terms[int(h)]
                rest = feature[word != h]
                for other in (np.empty(0, np.uint64), *(self.parts[t] for t in group if t != term)):
                    goes = np.setdiff1d(self.parts[term], np.concatenate([rest, other]))
                    comes = np.setdiff1d(other, np.concatenate([rest, self.parts[term]]))
                    out[i].append((goes, comes, 1 / len(group)))
        return out


@dataclass
class ToxicityModel:
    """Sorted feature hashes with their weights, the constant term, and how many swapped texts the fit has seen."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    swaps: int = 0

    def score(self, data: np.ndarray, offsets: np.ndarray, maker: Features) -> np.ndarray:
        n = len(offsets) - 1
        margin = np.full(n, self.bias)
        if len(self.features):
            found, row = maker.all(data, offsets)
            at = np.minimum(np.searchsorted(self.features, found), len(self.features) - 1)
            hit = self.features[at] == found
            pairs = np.unique(row[hit] * len(self.features) + at[hit])
            margin += np.bincount(pairs // len(self.features), self.weights[pairs % len(self.features)], n)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_model(
    rows: list[np.ndarray], y: np.ndarray, maker: Features, swaps: list[tuple[np.ndarray, np.ndarray, float]] = (),
    penalty: float = PENALTY, ridge: float = 1e-6, most_features: int = MOST_FEATURES,
) -> ToxicityModel:
    """Fit from the distinct feature hashes of each training text and from the swapped versions of all texts.

    Kept are the features that depend on the label by most evidence, and those
    of identity terms.  ``penalty`` weighs the squared change of the score
    between a text and its swapped versions, summed over ``swaps`` by their
    weights and divided by the number of texts.  Without swaps it is a plain
    logistic fit.
    """
    n = len(rows)
    if not n:
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), 0.0)
    sizes = np.array([len(r) for r in rows])
    flat, owner = np.concatenate(rows) if sizes.sum() else np.empty(0, np.uint64), np.repeat(np.arange(n), sizes)
    names, code = np.unique(flat, return_inverse=True)
    bad, total = np.bincount(code, y[owner], len(names)), np.bincount(code, minlength=len(names))
    toxic, clean = max(y.sum(), 1), max(n - y.sum(), 1)
    cells = ((bad, total * toxic / n), (total - bad, total * clean / n), (toxic - bad, (n - total) * toxic / n), (clean - total + bad, (n - total) * clean / n))
    use = sum(2 * seen * np.log(np.maximum(seen, 1e-12) / np.maximum(awaited, 1e-12)) for seen, awaited in cells)
    use *= use >= LEAST_EVIDENCE
    chosen = np.argsort(-use, kind="stable")[:most_features]
    terms = [maker.term(t) for group in IDENTITY_TERMS for t in group]
    features = np.unique(np.concatenate([names[chosen[use[chosen] > 0]], *terms]))
    at = np.minimum(np.searchsorted(features, flat), len(features) - 1)
    hit = features[at] == flat
    doc, feature = owner[hit], at[hit]

    # Differences of the feature rows of a text and its swapped version; equal ones are added up.
    alike: dict[tuple[bytes, bytes], list] = {}
    for goes, comes, weight in swaps:
        alike.setdefault((goes.tobytes(), comes.tobytes()), [goes, comes, 0.0])[2] += weight / n
    rows_, columns, signs = [], [], []
    for k, (goes, comes, _) in enumerate(alike.values()):
        for sign, part in ((1.0, goes), (-1.0, comes)):
            rows_.append(np.full(len(part), k)), columns.append(np.searchsorted(features, part)), signs.append(np.full(len(part), sign))
    swap_row, swap_column, swap_sign = (np.concatenate(v) if v else np.empty(0, t) for v, t in ((rows_, int), (columns, int), (signs, float)))
    swap_weight = np.array([weight for _, _, weight in alike.values()])

    prior = np.where(y > 0, 0.5 * n / toxic, 0.5 * n / clean) / n
    scale = 1 / np.sqrt(np.bincount(feature, prior[doc], len(features)) + 1e-3)
    w, b = np.zeros(len(features)), 0.0
    m1, m2 = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    for step in range(1, STEPS + 1):
        margin = np.bincount(doc, w[feature], n) + b
        slope = prior * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        grad = np.bincount(feature, slope[doc], len(features)) + ridge * w
        if len(swap_weight):
            change = np.bincount(swap_row, swap_sign * w[swap_column], len(swap_weight))
            grad += 2 * penalty * np.bincount(swap_column, swap_sign * (swap_weight * change)[swap_row], len(features))
        full = np.append(grad * scale, slope.sum())
        m1, m2 = 0.9 * m1 + 0.1 * full, 0.99 * m2 + 0.01 * full**2
        move = 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-6) * (1 - step / (STEPS + 1))
        w, b = w - move[:-1], b - move[-1]
    return ToxicityModel(features, w, float(b), len(swaps))


def _feature_rows(rows: DataFrame, keep: np.ndarray | None) -> DataFrame:
    """doc_id, place, label and the distinct features of each sampled text.

    With ``keep`` only those features, and the swapped versions of each text.
    """
    maker = None
    longs = pa.list_(pa.int64())
    hashes = lambda parts: [p.view(np.int64) for p in parts]

    def describe(data, offsets):
        nonlocal maker
        maker = maker or Features()
        found, row = maker.all(data, offsets)
        if keep is not None:
            hit = keep[np.minimum(np.searchsorted(keep, found), len(keep) - 1)] == found
            found, row = found[hit], row[hit]
        order = np.argsort(row, kind="stable")
        found, edges = found[order], np.searchsorted(row[order], np.arange(len(offsets)))
        held = [pa.array([np.unique(found[a:b]).view(np.int64) for a, b in zip(edges[:-1], edges[1:])], longs)]
        if keep is None:
            return held
        made = maker.swaps(data, offsets)
        sides = [pa.array([hashes(v[k] for v in row) for row in made], pa.list_(longs)) for k in (0, 1)]
        return [*held, *sides, pa.array([[v[2] for v in row] for row in made], pa.list_(pa.float64()))]

    schema = "x array<long>" if keep is None else "x array<long>, goes array<array<long>>, comes array<array<long>>, weights array<double>"
    return tb.score_rows(rows, ["doc_id", "place", "label"], "text", describe, schema)


def telling(rows: DataFrame, most_features: int = MOST_FEATURES) -> np.ndarray:
    """Sorted hashes of the features with most evidence, counted over the sample by Spark."""
    sums = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad")).first()
    n, toxic = float(max(sums["n"], 1)), float(sums["bad"])
    seen = _feature_rows(rows, None).select("label", F.explode("x").alias("f")).groupBy("f").agg(F.count("*").alias("t"), F.sum("label").alias("b"))
    t, b = F.col("t"), F.col("b")
    cells = ((b, t * toxic / n), (t - b, t * (n - toxic) / n), (toxic - b, (n - t) * toxic / n), (n - toxic - t + b, (n - t) * (n - toxic) / n))
    part = lambda o, e: F.when((o > 0) & (e > 0), 2 * o * F.log(o / e)).otherwise(0.0)
    evidence = part(*cells[0]) + part(*cells[1]) + part(*cells[2]) + part(*cells[3])
    best = seen.withColumn("evidence", evidence).where(F.col("evidence") >= LEAST_EVIDENCE).orderBy(F.desc("evidence"), "f").limit(most_features)
    return np.sort(np.array([r["f"] for r in best.select("f").collect()], np.int64).view(np.uint64))


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = labelled.MOST_ROWS, penalty: float = PENALTY) -> ToxicityModel:
    """Fit on a bounded sample of labelled rows outside the held-out part.

    Spark counts the features and swaps the terms; only the features that are
    used reach the driver.  Each text has at most as many swapped versions as
    there are pairs of ``IDENTITY_TERMS``.
    """
    maker = Features()
    rows = cut_lineage(labelled.sample(docs, labels, "toxic", MODULUS, REMAINDER, most_rows))
    terms = [maker.term(t) for group in IDENTITY_TERMS for t in group]
    keep = np.unique(np.concatenate([telling(rows), *terms]))
    got = _feature_rows(rows, keep).toArrow().sort_by([("place", "ascending"), ("doc_id", "ascending")])
    held = [np.array(x, np.int64).view(np.uint64) for x in got["x"].to_pylist()]
    code = lambda v: np.array(v, np.int64).view(np.uint64)
    swaps = [(code(g), code(c), w) for r in got.select(["goes", "comes", "weights"]).to_pylist() for g, c, w in zip(r["goes"], r["comes"], r["weights"])]
    return fit_model(held, got["label"].to_numpy().astype(float), maker, swaps, penalty)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and score, 0 to 1, of every row over its whole text; a null text is an empty one."""
    maker = None

    def rate(data, offsets):
        nonlocal maker
        maker = maker or Features()
        return [model.score(data, offsets, maker)]

    return tb.score_rows(docs, [key], text, rate, "score double")


def keep_civil(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """All columns of the rows whose score lies under ``threshold``."""
    maker = None

    def good(data, offsets):
        nonlocal maker
        maker = maker or Features()
        return model.score(data, offsets, maker) < threshold

    return tb.filter_rows(docs, text, good)
