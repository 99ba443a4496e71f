"""Classification quality from a scored frame: exact, with ties, at any size.

Scores are counted per distinct value first; running counts then come from
``scan.running``, so no task sees all scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio
from tidemark.operators.scan import running


def classify(df: DataFrame, score: str = "score", threshold: float = 0.5) -> DataFrame:
    """Turn a probability into a class: 1 from the threshold on."""
    return df.withColumn("prediction", (F.col(score) >= threshold).cast("int"))


def _cells(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label), F.col(prediction)
    return [
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    ]


def _zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def threshold_metrics(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score", threshold: float = 0.5
) -> DataFrame:
    """Accuracy, precision, recall and F1 at one threshold; 0 where undefined."""
    cells = classify(df, score, threshold).groupBy(*by).agg(*_cells(label, "prediction"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        *by,
        ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _zero(tp, tp + fp).alias("precision"),
        _zero(tp, tp + fn).alias("recall"),
        _zero(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def confusion(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """The four cells as rows, empty ones included."""
    cells = df.groupBy(*by).agg(*_cells(label, prediction))
    entries = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("customers"))
            for a, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return cells.select(*by, F.inline(entries))


def class_report(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction",
    names: tuple[str, str] = ("Stay", "Churn"),
) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    cells = df.groupBy(*by).agg(*_cells(label, prediction))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn

    def measures(hit, wrong, missed):
        return _zero(hit, hit + wrong), _zero(hit, hit + missed), _zero(hit * 2, hit * 2 + wrong + missed)

    negative, positive = measures(tn, fn, fp), measures(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn

    def entry(name, values, support):
        return F.struct(
            F.lit(name).alias("class"), values[0].alias("precision"), values[1].alias("recall"),
            values[2].alias("f1"), support.cast("bigint").alias("support"),
        )

    macro = [(a + b) / 2 for a, b in zip(negative, positive)]
    weighted = [ratio(a * n0 + b * n1, total) for a, b in zip(negative, positive)]
    accuracy = [ratio(tp + tn, total)] * 3
    rows = F.array(
        entry(names[0], negative, n0), entry(names[1], positive, n1), entry("accuracy", accuracy, total),
        entry("macro avg", macro, total), entry("weighted avg", weighted, total),
    )
    return cells.select(*by, F.inline(rows))


def score_counts(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """Positives and negatives per distinct score."""
    return df.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def _ranked(df, by, label, score) -> DataFrame:
    return running(
        score_counts(df, by, label, score), list(by), score, sums=["pos", "neg"], descending=True
    )


def ranking_metrics(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """ROC-AUC (ties count half) and average precision, from one pass over the scores.

    Average precision adds up recall gained times precision at each distinct
    score; it is not the area under straight lines between the points.
    """
    return ranking_of_counts(score_counts(df, by, label, score), by, score)


def ranking_of_counts(counts: DataFrame, by: Sequence[str] = (), score: str = "score") -> DataFrame:
    """The same from positives and negatives (pos, neg) per distinct score."""
    ranked = running(counts, list(by), score, sums=["pos", "neg"], descending=True)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above = F.col("neg_run") - F.col("neg")
    beaten = pos * (above + neg / 2)
    precision = ratio(F.col("pos_run"), F.col("pos_run") + F.col("neg_run"))
    total = F.sum(pos) * F.sum(neg)
    return ranked.groupBy(*by).agg(
        (1 - ratio(F.sum(beaten), total)).alias("roc_auc"),
        ratio(F.sum(pos * precision), F.sum(pos)).alias("pr_auc"),
    )


def evaluate_scores(
    df: DataFrame, by: Sequence[str] = ("model",), label: str = "label", score: str = "score"
) -> DataFrame:
    """The six measures of a scored frame, one row per group."""
    by = list(by)
    ranked, cut = ranking_metrics(df, by, label, score), threshold_metrics(df, by, label, score)
    if by:
        return cut.join(ranked, by)
    # one row on either side
    return cut.withColumn("_one", F.lit(1)).join(ranked.withColumn("_one", F.lit(1)), ["_one"]).drop("_one")


def _with_totals(ranked: DataFrame, by: list[str]) -> DataFrame:
    """Class totals per group; one row per group joins back."""
    totals = ranked.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    if by:
        return ranked.join(totals, by)
    packed = totals.select(F.struct("_p", "_n")).scalar()
    return ranked.withColumn("_t", packed).select("*", "_t._p", "_t._n").drop("_t")


def roc_points(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """False and true positive rate at every distinct score."""
    ranked = _with_totals(_ranked(df, by, label, score), list(by))
    return ranked.select(
        *by,
        F.col(score).alias("threshold"),
        ratio(F.col("neg_run"), F.col("_n")).alias("fpr"),
        ratio(F.col("pos_run"), F.col("_p")).alias("tpr"),
    )


def precision_recall_points(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """Precision and recall at every distinct score, and the chance level."""
    ranked = _with_totals(_ranked(df, by, label, score), list(by))
    return ranked.select(
        *by,
        F.col(score).alias("threshold"),
        ratio(F.col("pos_run"), F.col("pos_run") + F.col("neg_run")).alias("precision"),
        ratio(F.col("pos_run"), F.col("_p")).alias("recall"),
        ratio(F.col("_p"), F.col("_p") + F.col("_n")).alias("chance"),
    )
