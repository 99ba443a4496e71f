import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import __spark_entry__  # noqa: E402,F401  (registers queries, ships code by value)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def weekly(spark):
    """Build ``(series, ds, y)`` frames from lists of values on a Friday grid."""
    import datetime

    def build(values_by_series, start="2010-02-05"):
        first = datetime.date.fromisoformat(start)
        rows = [
            (name, first + datetime.timedelta(days=7 * i), None if v is None else float(v))
            for name, values in values_by_series.items()
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, "series STRING, ds DATE, y DOUBLE")

    return build
