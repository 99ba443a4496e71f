"""Scores into segments people can act on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio, right_closed_bucket

# Cut-offs, segment names and the action for each.
CUTS = (0.4, 0.7)
SEGMENTS = ("Low risk", "Medium risk", "High risk")
ACTIONS = {
    "High risk": "personal outreach, retention offer, escalate high-value accounts",
    "Medium risk": "automated engagement, satisfaction survey, usage tips",
    "Low risk": "standard communication, upsell and loyalty programmes",
}


def risk_segments(
    df: DataFrame, score: str = "score", cuts: Sequence[float] = CUTS, names: Sequence[str] = SEGMENTS
) -> DataFrame:
    """Label every customer; a score of exactly 0 belongs to the first segment."""
    return df.withColumn("segment", right_closed_bucket(F.col(score), list(cuts), list(names)))


def segment_summary(
    df: DataFrame, label: str = "label", segment: str = "segment", names: Sequence[str] = SEGMENTS
) -> DataFrame:
    """Size, actual rate and share of every segment, empty ones included."""
    columns = []
    for i, name in enumerate(names):
        inside = F.col(segment) == name
        columns += [
            F.count_if(inside).alias(f"_n{i}"),
            F.avg(F.when(inside, F.col(label).cast("double"))).alias(f"_r{i}"),
        ]
    row = df.agg(F.count(segment).alias("_all"), *columns)
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias(segment), F.col(f"_n{i}").alias("customers"),
                F.col(f"_r{i}").alias("churn_rate"), ratio(F.col(f"_n{i}"), F.col("_all")).alias("share"),
            )
            for i, name in enumerate(names)
        ]
    )
    return row.select(F.inline(entries))


def with_actions(df: DataFrame, segment: str = "segment", actions: dict[str, str] = ACTIONS) -> DataFrame:
    """Attach the action of each segment."""
    pairs = [part for name, action in actions.items() for part in (F.lit(name), F.lit(action))]
    return df.withColumn("action", F.create_map(*pairs)[F.col(segment)])
