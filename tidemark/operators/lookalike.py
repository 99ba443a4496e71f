"""Observation, buffer and outcome windows on an event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookalike_profiles(
    events: DataFrame,
    cutoffs: Sequence[str],
    outcome_type: str,
    event_types: Sequence[str],
    observation_days: int = 84,
    buffer_days: int = 14,
    outcome_days: int = 28,
    user: str = "user_id",
    ts: str = "ts",
    kind: str = "event_type",
    value: str = "value",
) -> DataFrame:
    """Features before each cut-off and the label after the buffer, per user.

    Features read ``[cutoff - observation, cutoff)``, the label reads
    ``[cutoff + buffer, cutoff + buffer + outcome)``; nothing in between counts.
    A user without an event in the observation window has no profile there.
    Events are counted per (user, cut-off, day, type) first, so a user with a
    large part of the log reaches the final grouping as a few rows.
    """
    day = F.col(ts).cast("date")
    dates = F.array(*[F.lit(c).cast("date") for c in cutoffs])
    ahead = observation_days, buffer_days, buffer_days + outcome_days

    def touched(cut):
        offset = F.datediff(day, cut)
        return ((offset >= -ahead[0]) & (offset < 0)) | ((offset >= ahead[1]) & (offset < ahead[2]))

    exploded = events.select(
        F.col(user).alias("user_id"), day.alias("_day"), F.col(kind).alias("_kind"),
        F.col(value).cast("decimal(18,4)").alias("_value"),
        F.explode(F.filter(dates, touched)).alias("cutoff"),
    )
    daily = exploded.groupBy("user_id", "cutoff", "_day", "_kind").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_value").alias("_value")
    )
    seen = F.col("_day") < F.col("cutoff")
    per_type = [
        F.coalesce(F.sum(F.when(seen & (F.col("_kind") == e), F.col("_n"))), F.lit(0)).alias(f"n_{e}")
        for e in event_types
    ]
    profiles = daily.groupBy("user_id", "cutoff").agg(
        *per_type,
        F.coalesce(F.sum(F.when(seen, F.col("_n"))), F.lit(0)).alias("events"),
        F.count_distinct(F.when(seen, F.col("_day"))).alias("active_days"),
        F.sum(F.when(seen, F.col("_value"))).cast("double").alias("total_value"),
        F.datediff("cutoff", F.max(F.when(seen, F.col("_day")))).alias("days_since_last"),
        F.coalesce(
            F.max((~seen & (F.col("_kind") == outcome_type)).cast("int")), F.lit(0)
        ).alias("label"),
    )
    return profiles.filter(F.col("events") > 0)
