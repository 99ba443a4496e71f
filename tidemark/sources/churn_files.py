"""The customer table: two files, one customer base."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.splits import stratified_sample

# Layout of the customer files.
CUSTOMER_SCHEMA = (
    "CustomerID BIGINT, Age DOUBLE, Gender STRING, Tenure DOUBLE, `Usage Frequency` DOUBLE, "
    "`Support Calls` DOUBLE, `Payment Delay` DOUBLE, `Subscription Type` STRING, "
    "`Contract Length` STRING, `Total Spend` DOUBLE, `Last Interaction` DOUBLE, Churn DOUBLE"
)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CUSTOMER_SCHEMA).option("header", True).csv(path)


def combine_customers(
    parts: dict[str, DataFrame],
    id_column: str = "CustomerID",
    label: str = "Churn",
    sample_size: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Union the parts, make keys unique, drop incomplete rows, cast the label.

    Each part numbers its customers on its own, so the key becomes
    ``<part>:<id>``: unique without a global renumbering pass.  ``sample_size``
    draws a stratified sample with the label shares of the whole.
    """
    tagged = None
    for name, part in parts.items():
        part = part.withColumn("_part", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    complete = tagged.na.drop("any")
    keyed = complete.withColumn(
        id_column, F.concat_ws(":", "_part", F.col(id_column).cast("string"))
    ).drop("_part")
    result = keyed.withColumn(label, F.col(label).cast("int"))
    if sample_size is not None:
        result = stratified_sample(result, [label], id_column, sample_size, seed)
    return result


def load_churn(
    spark: SparkSession, first: str, second: str, sample_size: int | None = None, seed: int = 42
) -> DataFrame:
    """Read both customer files and combine them."""
    parts = {"a": read_customers(spark, first), "b": read_customers(spark, second)}
    return combine_customers(parts, sample_size=sample_size, seed=seed)
