"""Hold-outs and folds: by time for series, by reproducible hash for customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.scan import shuffle_key, shuffled_rank

TEST_WEEKS = 13


def hold_out_rows(
    df: DataFrame, keys: Sequence[str] = (), rows: int = TEST_WEEKS, ds: str = "ds"
) -> DataFrame:
    """Flag the last ``rows`` observations of every series as test."""
    newest = W.partitionBy(*keys).orderBy(F.col(ds).desc())
    return df.withColumn("is_test", F.row_number().over(newest) <= rows)


def hold_out_dates(df: DataFrame, dates: int = TEST_WEEKS, ds: str = "ds") -> DataFrame:
    """Flag everything from the n-th last distinct date on, for all series at once."""
    cutoff = (
        df.select(ds).distinct().orderBy(F.col(ds).desc()).limit(dates).agg(F.min(ds)).scalar()
    )
    return df.withColumn("is_test", F.col(ds) >= cutoff)


def rolling_origin(
    df: DataFrame, keys: Sequence[str] = (), folds: int = 3, horizon: int = TEST_WEEKS,
    ds: str = "ds",
) -> DataFrame:
    """Expanding-window folds per series, as rows with ``fold`` and ``is_test``.

    A row's distance from the end of its series decides its folds, so no join
    is needed: fold i drops the last ``(folds - i) * horizon`` rows and tests on
    the ``horizon`` rows before those.
    """
    newest = W.partitionBy(*keys).orderBy(F.col(ds).desc())
    ranked = df.withColumn("_rev", F.row_number().over(newest))
    return _explode_folds(ranked, folds, horizon)


def _explode_folds(ranked: DataFrame, folds: int, horizon: int) -> DataFrame:
    exploded = ranked.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(1, folds + 1)])))
    dropped = (F.lit(folds) - F.col("fold")) * horizon
    return (
        exploded.filter(F.col("_rev") > dropped)
        .withColumn("is_test", F.col("_rev") <= dropped + horizon)
        .drop("_rev")
    )


def date_positions(df: DataFrame, ds: str = "ds") -> DataFrame:
    """Distinct dates numbered from the newest (1) backwards.

    At most one row per calendar day, whatever the size of the panel; this is
    the bound that makes its broadcast safe.
    """
    return df.select(ds).distinct().withColumn(
        "_rev", F.row_number().over(W.orderBy(F.col(ds).desc()))
    )


def panel_folds(
    df: DataFrame, folds: int = 3, horizon: int = TEST_WEEKS, ds: str = "ds"
) -> DataFrame:
    """The same expanding windows cut on distinct dates, aligned over all series."""
    df = df.filter(F.col(ds).isNotNull())  # the same plan on both sides, so it runs once
    ranked = df.join(F.broadcast(date_positions(df, ds)), [ds], "inner")
    return _explode_folds(ranked, folds, horizon)


def fold_windows(df: DataFrame, folds: int = 3, horizon: int = TEST_WEEKS, ds: str = "ds") -> DataFrame:
    """One row per fold: first test date, last test date and training dates."""
    exploded = _explode_folds(date_positions(df, ds), folds, horizon)
    return exploded.groupBy("fold").agg(
        F.min(F.when(F.col("is_test"), F.col(ds))).alias("cutoff"),
        F.max(F.when(F.col("is_test"), F.col(ds))).alias("stop"),
        F.count_if(~F.col("is_test")).alias("train_dates"),
    )


def validation_by_date(
    df: DataFrame, fraction: float = 0.2, keys: Sequence[str] = (), ds: str = "ds"
) -> DataFrame:
    """Flag the newest rows as validation: the cut is a date, never a row position.

    The cut is the earliest date with at most ``fraction`` of the rows on or
    after it, or the last date when even that one holds more.  ``keys``
    separates independent training sets, such as folds.
    """
    keys = list(keys)
    for column in [*keys, ds]:
        df = df.filter(F.col(column).isNotNull())  # the same plan on both sides, so it runs once
    per_date = df.groupBy(*keys, ds).agg(F.count(F.lit(1)).alias("_n"))
    newest = W.partitionBy(*keys).orderBy(F.col(ds).desc())
    tail = F.sum("_n").over(newest)
    whole = F.sum("_n").over(W.partitionBy(*keys))
    fits = (F.col("_tail") <= F.col("_whole") * fraction) | (F.col("_rev") == 1)
    cuts = (
        per_date.withColumn("_tail", tail)
        .withColumn("_whole", whole)
        .withColumn("_rev", F.row_number().over(newest))
        .withColumn("is_val", fits)
        .select(*keys, ds, "is_val")
    )
    return df.join(cuts, [*keys, ds], "inner")


def stratified_sample(
    df: DataFrame, strata: Sequence[str], id_column: str, size: int, seed: int = 42
) -> DataFrame:
    """Sample ``size`` rows with the stratum shares of the whole; no-op if smaller."""
    ranked = shuffled_rank(df, strata, id_column, seed, rank="_rank", size="_size", total="_total")
    share = F.least(F.lit(1.0), F.lit(float(size)) / F.col("_total"))
    return ranked.filter(F.col("_rank") <= F.round(F.col("_size") * share)).drop(
        "_rank", "_size", "_total"
    )


def stratified_hold_out(
    df: DataFrame, strata: Sequence[str], id_column: str, fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Flag a share of every stratum as test, reproducibly."""
    ranked = shuffled_rank(df, strata, id_column, seed, rank="_rank", size="_size")
    return ranked.withColumn(
        "is_test", F.col("_rank") <= F.round(F.col("_size") * fraction)
    ).drop("_rank", "_size")


def stratified_folds(
    df: DataFrame, strata: Sequence[str], id_column: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Assign fold 0..k-1 so every fold keeps the stratum shares."""
    ranked = shuffled_rank(df, strata, id_column, seed, rank="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")


def growing_subsets(
    df: DataFrame, id_column: str, fractions: Sequence[float], seed: int = 42,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Replicate rows into nested subsets, each a larger share of the whole.

    Adds ``subset`` (1..k) and ``fraction``; a row is in every subset whose
    share its random rank falls into.
    """
    ranked = shuffled_rank(df, keys, id_column, seed, rank="_rank", size="_size")
    steps = F.array(
        *[
            F.struct(F.lit(i).alias("subset"), F.lit(float(f)).alias("fraction"))
            for i, f in enumerate(fractions, start=1)
        ]
    )
    return (
        ranked.withColumn("_step", F.explode(steps))
        .select("*", "_step.subset", "_step.fraction")
        .filter(F.col("_rank") <= F.round(F.col("_size") * F.col("fraction")))
        .drop("_rank", "_size", "_step")
    )


def subset_levels(
    df: DataFrame, id_column: str, fractions: Sequence[float], seed: int = 42, keys: Sequence[str] = ()
) -> DataFrame:
    """The same nested subsets without copies: ``level`` is the first subset that holds the row, NULL for none.

    A row is in every subset from its level on.
    """
    ranked = shuffled_rank(df, keys, id_column, seed, rank="_rank", size="_size")
    holds = [F.when(F.col("_rank") <= F.round(F.col("_size") * float(f)), F.lit(i)) for i, f in enumerate(fractions, start=1)]
    return ranked.withColumn("level", F.least(*holds) if len(holds) > 1 else holds[0]).drop("_rank", "_size")


def pick_some(df: DataFrame, id_column: str, n: int = 3, seed: int = 42) -> DataFrame:
    """The same ``n`` pseudo-randomly chosen rows on every run."""
    return df.orderBy(shuffle_key(id_column, seed), id_column).limit(n)
