"""From a customer table to features: category codes, one-hot columns, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.numbers import ratio


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """All columns that may be features: everything but keys, labels and leaks."""
    return [c for c in df.columns if c not in set(exclude)]

#: Categories of a column that one_hot makes columns of, at most.
MOST_CATEGORIES = 1_000


def columns_of(df: DataFrame, kind) -> list[str]:
    """Column names whose type is ``kind``, from the schema."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def encode_categories(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, PipelineModel]:
    """Replace string columns by their alphabetical code; keep the fitted encoders.

    The returned model encodes later customers the same way.
    """
    columns = columns_of(df, StringType) if columns is None else list(columns)
    stages = [
        StringIndexer(
            inputCol=c, outputCol=f"{c}__code", stringOrderType="alphabetAsc", handleInvalid="keep"
        )
        for c in columns
    ]
    model = Pipeline(stages=stages).fit(df)
    return apply_codes(df, model), model


def apply_codes(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Encode a frame with fitted encoders, in place of the text columns."""
    coded = model.transform(df)
    names = [s.getInputCol() for s in model.stages]
    return coded.select(
        *[F.col(f"{c}__code").cast("int").alias(c) if c in names else F.col(c) for c in df.columns]
    )


def encode_features(
    df: DataFrame, key: str = "CustomerID", label: str = "Churn"
) -> tuple[DataFrame, list[str], PipelineModel]:
    """Encoded frame with its key, the feature names, and the fitted encoders."""
    text = [c for c in columns_of(df, StringType) if c not in (key, label)]
    coded, model = encode_categories(df, text)
    return coded, feature_columns(coded, [key, label]), model


def one_hot(df: DataFrame, columns: Sequence[str], categories: dict[str, list[str]] | None = None):
    """Indicator columns for every category but the alphabetically first.

    Category lists are read from the frame unless given.  A column with more
    than ``MOST_CATEGORIES`` of them is an error: that many are no columns.
    Returns the frame and the new column names.
    """
    if categories is None:
        sizes = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first() if columns else {}
        wide = [c for c in columns if sizes[c] > MOST_CATEGORIES]
        if wide:
            raise ValueError(f"{', '.join(wide)}: more than {MOST_CATEGORIES} categories")
        row = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns]).first()
        categories = {c: list(row[c]) for c in columns}
    names = {f"{c}_{v}": F.when(F.col(c) == v, 1.0).otherwise(0.0) for c in columns for v in categories[c][1:]}
    return df.withColumns(names).drop(*columns), list(names)


def without_leaks(features: Sequence[str], leaks: Sequence[str]) -> list[str]:
    """The features a model may see, in their order.

    A leak is the key, the label, or a column that knows the outcome.  The
    column itself goes; a feature made of one (``<leak>_...``) is an error, as
    it was made on purpose.
    """
    made = [f for f in features if any(f.startswith(f"{leak}_") for leak in leaks)]
    if made:
        raise ValueError(f"features made of excluded columns: {', '.join(made)}")
    return [f for f in features if f not in set(leaks)]


def standardise(
    df: DataFrame, columns: Sequence[str], train: str | None = None, ddof: int = 0
) -> DataFrame:
    """Centre and scale by mean and deviation of the rows not flagged by ``train``.

    ``train`` names the test flag; the statistics come from the other rows
    only.  They are one row, joined in as a scalar.  A constant column becomes 0.
    """
    base = df.filter(~F.col(train)) if train else df
    spread = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = base.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), spread(c).alias("s")).alias(f"c{i}") for i, c in enumerate(columns)])
    ).scalar()
    scaled = df.withColumn("_stats", stats)
    for i, c in enumerate(columns):
        width = F.col(f"_stats.c{i}.s")
        scaled = scaled.withColumn(
            c, (F.col(c) - F.col(f"_stats.c{i}.m")) / F.when(width == 0, F.lit(1.0)).otherwise(width)
        )
    return scaled.drop("_stats")


def label_correlations(
    df: DataFrame, columns: Sequence[str], label: str, ends: int | None = None
) -> DataFrame:
    """Correlation of every feature with the label, in one aggregation.

    ``ends`` keeps only that many from the top and the bottom.
    """
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)])
    entries = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("correlation")) for i, c in enumerate(columns)]
    )
    table = row.select(F.inline(entries))
    if ends is None:
        return table
    top = table.orderBy(F.col("correlation").desc_nulls_last(), "feature").limit(ends)
    bottom = table.orderBy(F.col("correlation").asc_nulls_last(), F.col("feature").desc()).limit(ends)
    return top.unionByName(bottom).distinct()


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("customers"))
    whole = F.sum("customers").over(W.partitionBy())
    return counts.withColumn("share", ratio(F.col("customers"), whole))


def histograms(
    df: DataFrame, columns: Sequence[str], label: str, bins: int = 20,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Equal-width counts per feature, class and bin (1..bins, ends inclusive).

    Bounds are each feature's own range unless given.
    """
    def entry(c):
        return F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))

    long = df.select(label, F.inline(F.array(*[entry(c) for c in columns])))
    if bounds is None:
        edges = df.agg(
            F.map_from_arrays(
                F.array(*[F.lit(c) for c in columns]),
                F.array(*[
                    F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi"))
                    for c in columns
                ]),
            )
        ).scalar()
        long = long.withColumn("_edges", edges).withColumn("_b", F.col("_edges")[F.col("feature")])
        lo, hi = F.col("_b.lo"), F.col("_b.hi")
    else:
        lo, hi = F.lit(float(bounds[0])), F.lit(float(bounds[1]))
    width = (hi - lo) / bins
    slot = F.floor(F.coalesce(F.try_divide(F.col("value") - lo, width), F.lit(0.0))) + 1
    return (
        long.filter(F.col("value").isNotNull())
        .withColumn("bin", F.least(F.greatest(slot, F.lit(1)), F.lit(bins)).cast("int"))
        .groupBy("feature", label, "bin")
        .agg(F.count(F.lit(1)).alias("customers"))
    )
