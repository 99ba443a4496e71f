"""The source audit against the definition, worked out with dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from tidemark.llm import source_audit

LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=50):
    docs = [(lang or "", source or "", LETTERS.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        seen[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    for lang in {g[0] for g in count}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        own = {s: Counter({t: c[t] for t in kept}) for (la, s), c in count.items() if la == lang}
        whole = sum(own.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if own[s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def audited(spark, rows, schema="text string, lang string, source string"):
    return sorted(tuple(r) for r in source_audit.audit(spark.createDataFrame(rows, schema)).collect())


def corpus(seed, docs, sources=7, langs=("en", "de", None)):
    rng = random.Random(seed)
    words = ["a", "Ab", "É", "é", "übung", "straße", "日本", "x1y", "the", "THE", "zz"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    rows = []
    for _ in range(docs):
        source = rng.choice([None, *(f"s{k}" for k in range(sources)), "s0", "s0", "s0"])
        text = " ".join(rng.choice(words[: rng.choice([8, 40, 92])]) for _ in range(rng.randrange(25)))
        rows.append((rng.choice([None, "", text, text, text]), rng.choice(langs), source))
    return rows


@pytest.mark.parametrize("cells", [(64, 1 << 15), (2, 7)])
def test_pairs_and_terms_as_defined(spark, monkeypatch, cells):
    monkeypatch.setattr(source_audit, "SOURCES", cells[0])
    monkeypatch.setattr(source_audit, "TERMS", cells[1])
    rows = corpus(1, 500) + [("Rare one", "fi", "s1"), ("rare two", "fi", "s2"), (None, "fr", "s1")]
    assert audited(spark, rows) == brute(rows, source_audit.MIN_DF)


def test_ties_long_texts_repeated_rows_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "MIN_DF", 2)
    rows = [("b a c", "en", "x"), ("b a c", "en", "x"), ("d " * 50_000, "en", "y"), ("D-d", "en", "z"), ("", "en", "empty"), (None, None, None), ("b a", None, ""), ("a", "", "q")]
    want = brute(rows, 2)
    assert audited(spark, rows) == want and [r[3] for r in want if r[:3] == ("en", "x", "term")] == ["a", "b", "c"]
    clash = [(*r, 1, "t") for r in rows]
    assert audited(spark, clash, "text string, lang string, source string, index int, terms string") == want


def test_empty_table_and_languages_without_terms(spark):
    assert audited(spark, []) == []
    assert audited(spark, [("a b", "en", "x"), ("a", "en", "y")]) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    blank = [("123 ...", "en", "x")] * 31 + [("", "en", "y")]
    assert audited(spark, blank) == brute(blank, 30)


def test_terms_are_put_together_before_the_fit(spark, monkeypatch):
    met = []

    class Watched(CountVectorizer):
        def _fit(self, dataset):
            met.append(dataset.select(F.sum(F.size("terms"))).first()[0])
            return super()._fit(dataset)

    monkeypatch.setattr(source_audit, "CountVectorizer", Watched)
    words = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200))
    rows = [(f"{words} {words}", "en", f"s{i % 3}") for i in range(2000)]
    assert audited(spark, rows) == brute(rows, source_audit.MIN_DF)
    # 800,000 words; each of 8 tasks needs 30 lists of 200 words at most, and the empty one
    assert met and met[0] <= 8 * 30 * 201


@pytest.mark.parametrize("sizes", [(1, 1), (300, 1), (300, 4000), (1 << 22, 1 << 25)])
def test_documents_and_counts_add_up_over_runs_and_tasks(spark, monkeypatch, sizes):
    monkeypatch.setattr(source_audit, "RUN_BYTES", sizes[0])
    monkeypatch.setattr(source_audit, "HELD_BYTES", sizes[1])
    rng = random.Random(4)
    # pXX is in XX documents of "en", once or several times in each
    texts = [[] for _ in range(120)]
    for most in (1, 28, 29, 30, 31, 60, 119, 120):
        for at in rng.sample(range(120), most):
            texts[at] += [f"P{chr(97 + most % 26)}{chr(97 + most // 26)}"] * rng.choice([1, 1, 2, 5, 300])
    rows = [(" ".join(t), "en", f"s{i % 4}") for i, t in enumerate(texts)] + [("pea", "de", "s1")] * 30 + corpus(5, 200)
    rng.shuffle(rows)
    assert audited(spark, rows) == brute(rows, source_audit.MIN_DF)


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(n, n + extra, terms) for n in (0, 1, 9_223_372_030, 9_223_372_031, 9_223_372_032, 10**15) for extra in (0, 7, 10**14) for terms in (1, 40_000)]
    frame = spark.createDataFrame(cases, "n long, size long, terms long")
    got = [r[0] for r in frame.select(source_audit.share(F.col("n"), F.col("size"), F.col("terms"))).collect()]
    assert got == [1 + 10**9 * (n + 5) // (size + 5 * terms) for n, size, terms in cases]
