"""Order-and-shipment tables read as a sales log and as a customer table.

The analytics operators take a weekly sales log and a customer table.  Here
both are derived from a star schema of order lines: a store is the supplier's
nation, a department the part's brand, a week ends on Friday, and weekly sales
are net of returned lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import week_ending
from tidemark.functions.numbers import ratio
from tidemark.operators.calendar import is_trading_holiday
from tidemark.operators.grains import as_series, chain_total, store_panel
from tidemark.runtime import cut_lineage
from tidemark.sources.sales_files import clean_sales, join_sales

#: Week in which promotion tracking starts in the stand-in; None records it in every week.
TRACKED_FROM = "1998-01-02"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shipped_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All order lines, with the week label and exact money.

    The first and the last week may be partial; they are weeks like any other.
    """
    cents, percent = _hundredths("l_extendedprice"), _hundredths("l_discount")
    net = cents * (F.lit(100) - percent)
    return table(spark, folder, "lineitem").select(
        "l_suppkey", "l_partkey", "l_linenumber",
        week_ending(F.col("l_shipdate")).alias("Date"),
        F.when(F.col("l_returnflag") == "R", -net).otherwise(net).alias("net"),
        cents.alias("price"),
        (cents * percent).alias("saved"),
        _hundredths("l_quantity").alias("quantity"),
        _hundredths("l_tax").alias("tax"),
        percent.alias("discount"),
    )


def calendar_years(spark: SparkSession, folder: str) -> tuple[int, int]:
    """First year of the shipments and the year after the last: what a calendar for them covers.

    An empty table has the calendar of one year.
    """
    day = F.col("l_shipdate")
    first, last = table(spark, folder, "lineitem").agg(F.year(F.min(day)), F.year(F.max(day))).first()
    return (first, last + 1) if first is not None else (2000, 2000)


def years_of(series: DataFrame, ds: str = "ds") -> tuple[int, int]:
    """First year of a series and the year after its last."""
    first, last = series.agg(F.year(F.min(ds)), F.year(F.max(ds))).first()
    return (first, last + 1) if first is not None else (2000, 2000)


def _hundredths(column: str) -> Column:
    """A two-decimal amount as a whole number of hundredths."""
    return F.floor(F.col(column) * 100 + 0.5)


def weekly_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Store, Dept, Date with the sums of every measure: the one reading of the order lines.

    Lines of a part without a department keep their measures for the store.
    """
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("Store"))
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("Dept"))
    whole = lambda c: F.sum(c.cast("decimal(18,0)"))
    return (
        shipped_lines(spark, folder)
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .groupBy("Store", "Dept", "Date", F.col("p_partkey").isNotNull().alias("in_dept"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            *[whole(F.col(c)).alias(c) for c in ("net", "price", "quantity", "tax", "discount")],
            *[whole(F.when(F.col("l_linenumber") % 5 == k - 1, F.col("saved"))).alias(f"saved{k}") for k in range(1, 6)],
        )
    )


def _money(column: Column, unit: str) -> Column:
    """A whole number of units as an amount."""
    return column * F.lit(unit).cast(f"decimal({len(unit) - 2},{len(unit) - 2})")


def sales_cells(spark: SparkSession, folder: str, weekly: DataFrame | None = None) -> DataFrame:
    """Store, Dept, Date, Weekly_Sales: one row per store, department and week."""
    cells = weekly_cells(spark, folder) if weekly is None else weekly
    return cells.where("in_dept").select("Store", "Dept", "Date", _money(F.col("net"), "0.0001").alias("Weekly_Sales"))


def sales_table(spark: SparkSession, folder: str, weekly: DataFrame | None = None) -> DataFrame:
    """The cells with their holiday flag."""
    return sales_cells(spark, folder, weekly).withColumn("IsHoliday", is_trading_holiday(F.col("Date")))


def stores_table(spark: SparkSession, folder: str) -> DataFrame:
    """Store, Type, Size: type by the number of suppliers against the average."""
    stores = table(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("Store")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.round(F.sum(F.col("s_acctbal").cast("decimal(12,2)")), 0).cast("bigint").alias("Size"),
    )
    totals = stores.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("stores"))).scalar()
    relative = stores.withColumn("_all", totals).withColumn(
        "_x", F.col("_n") * F.col("_all.stores") * 4
    )
    size_class = (
        F.when(F.col("_x") >= F.col("_all.n") * 5, "A").when(F.col("_x") >= F.col("_all.n") * 3, "B").otherwise("C")
    )
    return relative.select("Store", size_class.alias("Type"), "Size")


def features_table(
    spark: SparkSession, folder: str, weekly: DataFrame | None = None, tracked_from: str | None = TRACKED_FROM
) -> DataFrame:
    """Weekly externals and promotion spend per store; promotion is NULL before tracking."""
    cells = weekly_cells(spark, folder) if weekly is None else weekly
    total = lambda c, unit: _money(F.sum(c), unit)
    lines = F.sum("lines")
    tracked = F.lit(True) if tracked_from is None else F.col("Date") >= F.lit(tracked_from).cast("date")
    marked = cells.groupBy("Store", "Date").agg(
        ratio(total("quantity", "0.01"), lines).alias("Temperature"),
        ratio(total("tax", "0.01"), lines).alias("Fuel_Price"),
        ratio(total("price", "0.01"), total("quantity", "0.01")).alias("CPI"),
        ratio(total("discount", "0.01"), lines).alias("Unemployment"),
        *[F.when(F.first(tracked), total(f"saved{k}", "0.0001").cast("double")).alias(f"MarkDown{k}") for k in range(1, 6)],
    )
    return marked.withColumn("IsHoliday", is_trading_holiday(F.col("Date")))


def sales_log(spark: SparkSession, folder: str) -> DataFrame:
    """The joined long table, as the three files of the sales log would give it.

    The order lines are read and summed once; sales and features are both made
    of the sums, which are written to the shared folder in between.
    """
    weekly = cut_lineage(weekly_cells(spark, folder))
    return join_sales(
        sales_table(spark, folder, weekly), stores_table(spark, folder), features_table(spark, folder, weekly)
    )


def clean_log(spark: SparkSession, folder: str) -> DataFrame:
    return clean_sales(sales_log(spark, folder))


def clean_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned sales without the attribute joins, for work that needs sales only."""
    return clean_sales(sales_cells(spark, folder))


def store_series(spark: SparkSession, folder: str) -> DataFrame:
    """(Store, ds, y) at store grain from cleaned sales."""
    weekly = clean_cells(spark, folder).groupBy("Store", "Date").agg(
        F.sum("Weekly_Sales").alias("Weekly_Sales")
    )
    return as_series(weekly, keys=["Store"])


def dept_series(spark: SparkSession, folder: str) -> DataFrame:
    """(Store, Dept, ds, y) at the finest grain from cleaned sales."""
    return as_series(clean_cells(spark, folder), keys=["Store", "Dept"])


def chain_series(spark: SparkSession, folder: str) -> DataFrame:
    """(ds, y): the chain total from cleaned sales."""
    weekly = clean_cells(spark, folder).groupBy("Date").agg(
        F.sum("Weekly_Sales").alias("Weekly_Sales")
    )
    return as_series(weekly)


def full_store_panel(spark: SparkSession, folder: str) -> DataFrame:
    return store_panel(clean_log(spark, folder))


def full_chain(spark: SparkSession, folder: str) -> DataFrame:
    return chain_total(clean_log(spark, folder))


# --------------------------------------------------------------------------
# Customers
# --------------------------------------------------------------------------

# The end of observation and the year in which silence is churn.
CUTOFF, OUTCOME_END = "2000-08-01", "2001-08-01"


def customer_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with an order before the cut-off.

    Tenure counts the months from the first to the last order before the
    cut-off; Churn is 1 without an order in the year after it.  Orders are
    aggregated per customer before they meet the customer table.
    """
    day = F.col("o_orderdate").cast("date")
    seen = day < F.lit(CUTOFF).cast("date")
    later = (day >= F.lit(CUTOFF).cast("date")) & (day < F.lit(OUTCOME_END).cast("date"))
    price = F.col("o_totalprice").cast("decimal(14,2)")
    orders = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min(F.when(seen, day)).alias("first_day"),
            F.max(F.when(seen, day)).alias("last_day"),
            F.count_if(seen).alias("orders"),
            F.count_if(later).alias("orders_after"),
            F.sum(F.when(seen, price)).alias("spend"),
            F.max(F.when(seen, price)).alias("largest"),
            F.count_if(seen & (F.col("o_orderpriority") == "1-URGENT")).alias("urgent"),
            F.count_if(seen & (F.col("o_orderstatus") == "P")).alias("pending"),
        )
        .filter(F.col("orders") > 0)
    )
    months = (F.year("last_day") - F.year("first_day")) * 12 + F.month("last_day") - F.month("first_day")
    customers = table(spark, folder, "customer")
    return customers.join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("int").alias("nation"),
        F.col("c_acctbal").cast("double").alias("balance"),
        F.col("orders").cast("double").alias("orders"),
        F.col("spend").cast("double").alias("spend"),
        F.col("largest").cast("double").alias("largest"),
        F.col("urgent").cast("double").alias("urgent"),
        F.col("pending").cast("double").alias("pending"),
        F.datediff(F.lit(CUTOFF).cast("date"), "last_day").cast("double").alias("days_silent"),
        months.cast("double").alias("tenure"),
        (F.col("orders_after") == 0).cast("int").alias("churn"),
    )
