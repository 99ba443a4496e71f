"""Quality rules by distribution divergence, in DataFrame functions only.

Two histograms of a text, of character classes and of common words, are held
against those of each language by the Jensen-Shannon distance.  The reference
of a language is the sum over all its documents.  A text passes if it is near
enough to some language in both; short texts are not judged by a histogram
that a few words can't fill.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import cut_lineage

# The most common words of each language.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del"),
}
WORDS = tuple(dict.fromkeys(w for words in COMMON.values() for w in words))
#: Letters that stand for the common words while they are counted.
CODES = tuple(chr(0x100 + k) for k in range(len(WORDS)))
WHITE = r"[\x20\x09-\x0D]+"
#: Least characters and words for the histograms to count.
LEAST_CHARS, LEAST_WORDS = 200, 60
#: Largest distances, between 0 and 1, that pass.
MOST_CHARS, MOST_WORDS = 0.30, 0.295


def _in_words(df: DataFrame, words: str) -> DataFrame:
    """Columns n_words, word_chars and n_repeat_words from an array of words.

    Windows of three words are compared as 64-bit hashes.  If two are equal,
    all are sorted with their positions, which brings equal windows together in
    order of their positions.
    """
    n = F.size(words)
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumns({"n_words": n.cast("long"), "word_chars": F.length(F.array_join(words, "")).cast("long"), "_h": windows})
    placed = F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i")))
    some = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn("_p", F.when(some, F.sort_array(placed)).otherwise(F.array().cast("array<struct<h:bigint,i:bigint>>")))
    same = lambda x, k: F.coalesce(F.get("_p", k)["h"] == x["h"], F.lit(False))
    twice = lambda x, k: same(x, k - 1) | same(x, k + 1)
    df = df.withColumn("_at", F.sort_array(F.transform(F.filter("_p", twice), lambda x: x["i"])))
    fresh = F.transform("_at", lambda p, i: F.least(F.lit(3).cast("long"), p - F.coalesce(F.get("_at", i - 1), F.lit(-3).cast("long"))))
    df = df.withColumn("n_repeat_words", F.aggregate(fresh, F.lit(0).cast("long"), lambda s, x: s + x))
    return df.drop("_h", "_p", "_at")


def measures(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: id, language, base counts, and the counts of both histograms.

    ``chars``: capitals A-Z, digits, symbols, other ASCII punctuation, bytes
    that continue a character outside ASCII, white space, the rest.
    ``common``: each common word in lower case, then all other words.
    """
    held = docs.select(F.col(key).alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    df = held.withColumns({"_words": F.array_remove(F.split("t", WHITE), ""), "_lines": lines})
    code = F.create_map(*[F.lit(v) for pair in zip(WORDS, CODES) for v in pair])
    longest = max(map(len, WORDS))
    coded = F.array_join(F.transform(F.filter("_words", lambda w: (F.length(w) <= longest) & F.lower(w).isin(*WORDS)), lambda w: F.element_at(code, F.lower(w))), "")
    df = df.withColumn("_coded", coded)
    df = _in_words(df, "_words")
    count = lambda pattern: F.regexp_count("t", F.lit(pattern)).cast("long")
    df = df.select(
        "doc_id", "lang", "n_words", "word_chars", "n_repeat_words", "_coded",
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        count(r"[A-Z]").alias("_upper"), count(r"[0-9]").alias("_digit"), count(r"[!\"'()+,./:;=?@\[\\\]^_`{}~-]").alias("_punct"),
        (F.octet_length("t") - F.length("t")).cast("long").alias("_wide"), F.length("t").cast("long").alias("_all"),
    )
    white = F.col("_all") - F.col("word_chars")
    used = ["_upper", "_digit", "n_symbols", "_punct", "_wide"]
    rest = F.greatest(F.col("word_chars") - sum((F.col(c) for c in used), F.lit(0)), F.lit(0))
    hits = [F.length("_coded") - F.length(F.replace("_coded", F.lit(c))) for c in CODES]
    other = F.col("n_words") - F.length("_coded")
    return df.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array(*[F.col(c) for c in used], white, rest).alias("chars"), F.array(*[h.cast("long") for h in hits], other).alias("common"),
    )


def references(measured: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Shares of both histograms of each language with a list of common words, over all its documents.

    A language that has no such list, or no word, is no reference.
    """
    known = measured.where(F.col("lang").isin(*COMMON))
    sums = {c: [F.sum(F.get(c, F.lit(k))).alias(f"{c}{k}") for k in range(n)] for c, n in (("chars", 7), ("common", len(WORDS) + 1))}
    out = {}
    for r in known.groupBy("lang").agg(*sums["chars"], *sums["common"]).collect():
        both = [[float(r[f"{c}{k}"] or 0) for k in range(len(sums[c]))] for c in ("chars", "common")]
        if all(sum(v) > 0 for v in both):
            out[r["lang"]] = tuple([x / sum(v) for x in v] for v in both)
    return out


def _shares(df: DataFrame, counts: str) -> DataFrame:
    """Add the shares of a histogram and the sum of p ln p; no counts give zeros."""
    total = f"_{counts}_total"
    df = df.withColumn(total, F.aggregate(F.col(counts), F.lit(0).cast("long"), lambda s, x: s + x))
    df = df.withColumn(f"_{counts}_p", F.transform(counts, lambda x: F.when(F.col(total) > 0, x / F.col(total)).otherwise(0.0)))
    plogp = F.aggregate(f"_{counts}_p", F.lit(0.0), lambda s, p: s + F.when(p > 0, p * F.log(p)).otherwise(0.0))
    return df.withColumn(f"_{counts}_plogp", plogp)


def distance(counts: str, reference: list[float]) -> Column:
    """Jensen-Shannon distance, 0 to 1, of a histogram prepared by ``_shares``; 0 for no counts.

    The divergence is half of the sum of p ln p + q ln q - (p + q) ln((p + q) / 2).
    """
    qlogq = sum(q * math.log(q) for q in reference if q > 0)
    both = F.zip_with(F.col(f"_{counts}_p"), F.array(*[F.lit(q) for q in reference]), lambda p, q: p + q)
    middle = F.aggregate(both, F.lit(0.0), lambda s, x: s + F.when(x > 0, x * F.log(x / 2)).otherwise(0.0))
    value = (F.col(f"_{counts}_plogp") + qlogq - middle) / (2 * math.log(2))
    return F.when(F.col(f"_{counts}_total") > 0, F.sqrt(F.greatest(value, F.lit(0.0)))).otherwise(0.0)


def judge(docs: DataFrame, text: str = "text", key: str = "doc_id", least_chars: int = LEAST_CHARS, least_words: int = LEAST_WORDS, most_chars: float = MOST_CHARS, most_words: float = MOST_WORDS) -> DataFrame:
    """doc_id, base counts, base_failed, kept, and the distances to the nearest language.

    A text fails the base rules with fewer than 50 words, or if more than half
    of its words lie in repeated windows of three; null and empty texts fail.
    Otherwise it is kept if one language is near enough in both histograms,
    where a histogram with too few characters or words passes.  Without any
    reference nothing is judged by histograms.  Repeated rows are each judged.
    """
    measured = cut_lineage(measures(docs, text, key))
    known = references(measured)
    df = _shares(_shares(measured, "chars"), "common").withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    near, best_chars, best_words = [], [], []
    columns = {}
    for k, (_, (chars, common)) in enumerate(sorted(known.items())):
        columns |= {f"_c{k}": distance("chars", chars), f"_w{k}": distance("common", common)}
        near.append(((F.col("word_chars") < least_chars) | (F.col(f"_c{k}") <= most_chars)) & ((F.col("n_words") < least_words) | (F.col(f"_w{k}") <= most_words)))
        best_chars.append(F.col(f"_c{k}")), best_words.append(F.col(f"_w{k}"))
    df = df.withColumns(columns) if columns else df
    passed = near[0] if near else F.lit(True)
    for x in near[1:]:
        passed = passed | x
    least = lambda v: (F.least(*v) if len(v) > 1 else v[0]) if v else F.lit(None).cast("double")
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & passed).alias("kept"),
        least(best_chars).alias("chars_distance"), least(best_words).alias("words_distance"),
    )
