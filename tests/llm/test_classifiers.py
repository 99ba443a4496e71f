import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import boosting, labelled, language_id, quality, toxicity
from tidemark.llm import textbytes as tb

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


ODD = [(1, None, None), (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (None, "1234 -- 5", "en"), (5, "È", None), (6, "the end " * 30_000, "en"), (7, "Это русский текст", "xx")]


def odd_rows(spark):
    return spark.createDataFrame([(*r, "clash", 0.5) for r in ODD], "doc_id long, text string, lang string, lang_pred string, score double")


def test_language_held_out_accuracy(docs):
    model = language_id.fit(docs)
    assert model.families == ["germanic", "romance"]
    found = language_id.identify(docs, model).withColumn("out", language_id.held_out()).join(docs.select("doc_id", "lang"), "doc_id").where("out")
    total, right, low, high = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right >= 0.98 * total and 0 <= low and high <= 1


def test_language_learns_nothing_from_held_out_rows(docs):
    blind = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in sum(language_id.fit(blind).languages.values(), [])


def test_language_of_odd_rows(spark, docs):
    model = language_id.fit(docs)
    rows = odd_rows(spark)
    got = sorted(((r.doc_id, r.lang_pred) for r in language_id.identify(rows, model).collect()), key=str)
    names = dict(got)
    assert len(got) == len(ODD) and [n for i, n in got if i == 1] == ["und", "und"]
    assert names[2] == names[3] == names[None] == "und" and names[5] != "und" and names[6] == "en"
    kept = language_id.keep_identified(rows, model)
    assert kept.columns == rows.columns and sorted(r.doc_id for r in kept.collect()) == [5, 6, 7]
    assert language_id.identify(rows.limit(0), model).count() == 0
    untaught = language_id.fit(rows.limit(0))
    assert {r.lang_pred for r in language_id.identify(rows, untaught).collect()} == {"und"}


def test_mean_of_position_weights_is_the_linear_score(docs):
    model = language_id.fit(docs, rows_per_language=30)
    texts = [r.text for r in docs.limit(5).collect()] + ["", "x"]
    data, offsets = tb.column_bytes(pa.array(texts))
    together = model.predict(data, offsets)
    for k, t in enumerate(texts):
        name, score = model.predict(*tb.column_bytes(pa.array([t])))
        assert name[0] == together[0][k] and abs(score[0] - together[1][k]) < 1e-9


@pytest.mark.parametrize("module, label, least", [(quality, "quality", 0.95), (toxicity, "toxic", 0.9)])
def test_held_out_accuracy(docs, labels, module, label, least):
    model = module.fit(docs, labels)
    out = labelled.held_out(module.MODULUS, module.REMAINDER)
    rows = module.score(docs, model).join(labels, "doc_id").where(out)
    total, right = rows.agg(F.count("*"), F.sum(((F.col("score") >= module.THRESHOLD).cast("int") == F.col(label)).cast("int"))).first()
    assert right >= least * total


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_odd_rows_and_empty_tables(spark, docs, labels, module):
    model = module.fit(docs, labels.unionByName(spark.createDataFrame([(None, 1, 1), (9, None, None)], labels.schema)))
    rows = module.score(odd_rows(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert module.score(docs.limit(0), model).count() == 0
    blank = module.fit(docs, labels.limit(0))
    assert all(0 <= r.score <= 1 for r in module.score(odd_rows(spark), blank).collect())


def test_sample_leaves_out_the_held_out_part(docs, labels):
    rows = labelled.sample(docs, labels, "toxic", 3, 1, most=40)
    assert rows.where(labelled.held_out(3, 1)).count() == 0 and 0 < rows.count() < 80


def test_keep_civil_keeps_rows_whole(docs, labels):
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    kept = toxicity.keep_civil(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, s in scores.items() if s < toxicity.THRESHOLD)


def test_swaps_of_identity_terms_hardly_change_the_score():
    maker = toxicity.Features()
    plain = ["a calm day near the river", "the old book lay open", "we walk home late"]
    foul = ["you vile filth go away", "such vile filth again", "vile filth everywhere"]
    texts = (foul + [f + " gay" for f in foul]) * 6 + plain * 12 + [p + " straight" for p in plain] * 6
    y = np.array([1.0] * 36 + [0.0] * 54)
    rows = [maker.term(t) for t in texts]
    swaps = [v for row in maker.swaps(*tb.column_bytes(pa.array(texts))) for v in row]
    mention = lambda m, t: float(m.score(*tb.column_bytes(pa.array([t])), maker)[0])
    free = toxicity.fit_model(rows, y, maker, swaps, penalty=0.0)
    bound = toxicity.fit_model(rows, y, maker, swaps, penalty=50.0)
    gap = lambda m: abs(mention(m, "a gay day") - mention(m, "a straight day"))
    assert gap(bound) < 0.2 * gap(free) and mention(bound, "a gay day") < toxicity.THRESHOLD
    assert mention(bound, "vile filth") > toxicity.THRESHOLD
    assert bound.swaps == len(swaps) == 36 * 7 + 18 * 5 and toxicity.fit_model(rows, y, maker).swaps == 0


SWAPPED = ["Two gay men, one gay woman.", "gay and straight", "gayest day", "", "nobody", "Frauen und Männer", "old gaylord"]


def swapped_by_hand(text):
    """Every version of a text with all mentions of one term replaced or taken out, with its weight."""
    for group in toxicity.IDENTITY_TERMS:
        for term in group:
            pattern = rf"(?<![^\W\d_]){term}(?![^\W\d_])"
            if re.search(pattern, text.lower()):
                yield from ((re.sub(pattern, other, text.lower()), 1 / len(group)) for other in (" ", *group) if other != term)


def test_swaps_equal_texts_with_the_terms_replaced():
    maker = toxicity.Features()
    found = maker.swaps(*tb.column_bytes(pa.array(SWAPPED)))
    for text, versions in zip(SWAPPED, found):
        mine = sorted((tuple(sorted((set(maker.term(text).tolist()) - set(goes.tolist())) | set(comes.tolist()))), w) for goes, comes, w in versions)
        assert mine == sorted((tuple(maker.term(t).tolist()), w) for t, w in swapped_by_hand(text))
    assert [len(v) for v in found] == [4 + 7 + 4, 14, 0, 0, 0, 4, 5]


def test_fit_is_near_the_least_dense_loss_with_explicit_swapped_rows():
    """The same loss over a dense matrix of texts and swapped texts, brought down by Newton steps."""
    rng, maker, penalty, ridge = np.random.default_rng(4), toxicity.Features(), 5.0, 1e-3
    plain, foul = ["river", "calm", "book", "walk", "gay", "straight"], ["vile", "filth", "gay", "calm"]
    texts = [" ".join(rng.choice(foul if k % 2 else plain, 4)) for k in range(120)]
    y = np.arange(120) % 2.0
    rows = [maker.term(t) for t in texts]
    model = toxicity.fit_model(rows, y, maker, [v for r in maker.swaps(*tb.column_bytes(pa.array(texts))) for v in r], penalty, ridge)
    dense = lambda t: np.append(np.isin(model.features, maker.term(t)), 1.0)
    x = np.array([dense(t) for t in texts])
    pairs = [(dense(t) - dense(s), w / len(texts)) for t in texts for s, w in swapped_by_hand(t)]
    change, weight = np.array([d for d, _ in pairs]), np.array([w for _, w in pairs])
    prior, hold = 0.5 / 60, np.append(np.full(len(model.features), ridge), 0.0)

    def loss(w):
        return prior * np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)).sum() + 0.5 * (hold * w * w).sum() + penalty * (weight * (change @ w) ** 2).sum()

    best = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ best))
        slope = x.T @ (prior * (p - y)) + hold * best + 2 * penalty * change.T @ (weight * (change @ best))
        curve = (x.T * (prior * p * (1 - p))) @ x + np.diag(hold) + 2 * penalty * (change.T * weight) @ change
        best = best - np.linalg.solve(curve + 1e-12 * np.eye(len(best)), slope)
    assert loss(best) <= loss(np.append(model.weights, model.bias)) <= 1.01 * loss(best)


def test_neutral_mentions_are_kept_by_the_penalty(spark):
    """Toxic texts often name a group; held-out neutral mentions of all groups of the row are counted as false positives."""
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 7))
    calm, foul = [word() for _ in range(60)], [word() for _ in range(12)]
    text = lambda words, n, *more: " ".join([*rng.choice(words, n), *more])
    rows = []
    for k in range(1200):  # a fifth of the toxic texts shows nothing but a word of its own and the group
        own = [word(), "muslim"] if k % 10 == 0 else [rng.choice(foul), *(["muslim"] if k % 4 else [])]
        rows.append((k, text(calm, 9, *own) if k % 2 == 0 else text(calm, 10)))
    docs = spark.createDataFrame(rows + [(5000 + k, text(calm, 10, ["muslim", "hindu", "atheist"][k % 3])) for k in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2) for k, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.swaps > 1000
    free = toxicity.fit(docs, labels, penalty=0.0)
    wrong = {name: toxicity.score(docs, m).where(F.col("doc_id") >= 5000).where(F.col("score") >= toxicity.THRESHOLD).count() for name, m in (("free", free), ("bound", model))}
    caught = toxicity.score(docs, model).join(labels, "doc_id").where("toxic = 1 AND doc_id % 10 <> 0").where(F.col("score") >= toxicity.THRESHOLD).count()
    assert wrong["free"] >= 90 and wrong["bound"] == 0 and caught >= 0.95 * 480


def test_sample_takes_one_text_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(k % 40, f"text {k}") for k in range(400)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    rows = labelled.sample(docs, labels, "toxic", 3, 1).collect()
    assert len({r.doc_id for r in rows}) == len(rows) > 10 and all(r.text == f"text {r.doc_id}" or r.text == min(f"text {k}" for k in range(r.doc_id, 400, 40)) for r in rows)

def test_flat_trees_equal_a_recursive_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    forest = boosting.fit(x, y, trees=25, depth=3)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.95

    def walk(t, i, row):
        while forest.feature[t, i] >= 0:
            i = 2 * i + (2 if row[forest.feature[t, i]] > forest.threshold[t, i] else 1)
        return forest.value[t, i]

    for row, margin in zip(x[:40], forest.margin(x[:40])):
        assert abs(forest.base + sum(walk(t, 0, row) for t in range(25)) - margin) < 1e-9
    assert (boosting.fit(x[:0], y[:0]).probability(x[:3]) == 0.5).all()


def test_statistics_do_not_depend_on_the_run():
    texts = ["", "one", "The the the\nThe the the\nx | y !!", "É " * 50, "A,b;c " * 2000]
    make = quality.Statistics()
    together = make(*tb.column_bytes(pa.array(texts)))
    alone = np.vstack([make(*tb.column_bytes(pa.array([t]))) for t in texts])
    assert np.allclose(together, alone)
