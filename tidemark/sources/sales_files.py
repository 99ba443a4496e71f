"""The weekly sales log: three files joined to one long table, then cleaned.

One row per store, department and week.  Column names are those of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import ratio

# File layouts and column groups of the sales log.
SALES_SCHEMA = "Store INT, Dept INT, Date DATE, Weekly_Sales DOUBLE, IsHoliday BOOLEAN"
STORES_SCHEMA = "Store INT, Type STRING, Size INT"
FEATURES_SCHEMA = (
    "Store INT, Date DATE, Temperature DOUBLE, Fuel_Price DOUBLE, MarkDown1 DOUBLE, "
    "MarkDown2 DOUBLE, MarkDown3 DOUBLE, MarkDown4 DOUBLE, MarkDown5 DOUBLE, CPI DOUBLE, "
    "Unemployment DOUBLE, IsHoliday BOOLEAN"
)
EXTERNALS = ("Temperature", "Fuel_Price", "CPI", "Unemployment")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a CSV (header, ``NA`` as missing) or parquet file with a declared schema."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.schema(schema).option("header", True).option("nullValue", "NA").csv(path)
    return spark.read.schema(schema).parquet(path)


def join_sales(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Attach store attributes and weekly externals to every sales row.

    ``IsHoliday`` stands in two of the files; the copy in ``features`` is
    dropped first so the name stays unambiguous.  No join side is forced to be
    broadcast: Spark does so where the measured size allows it, and splits
    skewed partitions of a sort-merge join where it does not.
    """
    return sales.join(stores, ["Store"], "left").join(
        features.drop("IsHoliday"), ["Store", "Date"], "left"
    )


def load_sales(spark: SparkSession, folder: str, suffix: str = "csv") -> DataFrame:
    """Read ``train``, ``stores`` and ``features`` from a folder and join them."""
    return join_sales(
        read_table(spark, f"{folder}/train.{suffix}", SALES_SCHEMA),
        read_table(spark, f"{folder}/stores.{suffix}", STORES_SCHEMA),
        read_table(spark, f"{folder}/features.{suffix}", FEATURES_SCHEMA),
    )


def markdown_columns(df: DataFrame) -> list[str]:
    """Promotion columns, found by their name prefix."""
    return [c for c in df.columns if c.startswith("MarkDown")]


def clean_sales(df: DataFrame, value: str = "Weekly_Sales") -> DataFrame:
    """Keep weeks with positive sales; missing promotion data stays missing."""
    return df.filter(F.col(value) > 0)


def _no_promotion(df: DataFrame):
    columns = markdown_columns(df)
    return F.coalesce(*[F.col(c) for c in columns]).isNull() if columns else F.lit(True)


def cleaning_report(df: DataFrame, value: str = "Weekly_Sales") -> DataFrame:
    """One row: rows in, dropped and out, and what the kept rows cover.

    Distinct counts go through a grouping by (store, dept, week), so each
    worker hands over at most one row per cell whatever the skew.
    """
    kept = F.coalesce(F.col(value) > 0, F.lit(False))
    cells = (
        df.groupBy("Store", "Dept", "Date")
        .agg(
            F.count(F.lit(1)).alias("n_in"),
            F.count_if(kept).alias("n_out"),
            F.count_if(kept & _no_promotion(df)).alias("n_bare"),
        )
    )
    series = F.when(F.col("n_out") > 0, F.struct("Store", "Dept"))
    return cells.agg(
        F.sum("n_in").alias("rows_in"),
        (F.sum("n_in") - F.sum("n_out")).alias("dropped"),
        F.sum("n_out").alias("rows_out"),
        ratio(F.sum("n_in") - F.sum("n_out"), F.sum("n_in")).alias("dropped_share"),
        F.count_distinct(F.when(F.col("n_out") > 0, F.col("Date"))).alias("weeks"),
        F.count_distinct(F.when(F.col("n_out") > 0, F.col("Store"))).alias("stores"),
        F.count_distinct(series).alias("series"),
        F.sum("n_bare").alias("no_promotion"),
        ratio(F.sum("n_bare"), F.sum("n_out")).alias("no_promotion_share"),
    )


def promotion_coverage(df: DataFrame, weeks: DataFrame) -> DataFrame:
    """First week with any recorded promotion, and how many weeks come before it.

    ``weeks`` is the frame whose distinct ``Date`` values count as the calendar.
    """
    first = df.na.drop("all", subset=markdown_columns(df)).agg(F.min("Date")).scalar()
    return (
        weeks.select("Date").distinct()
        .withColumn("first_recorded", first)
        .agg(
            F.max("first_recorded").alias("first_recorded"),
            F.count_if(F.col("Date") < F.col("first_recorded")).alias("weeks_without"),
            F.count(F.lit(1)).alias("weeks"),
        )
        .withColumn("share_without", ratio(F.col("weeks_without"), F.col("weeks")))
    )
