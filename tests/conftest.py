import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Value of a column function for each of the given rows."""

    def run(schema, rows, expression):
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {schema}")
        result = df.select("_i", expression.alias("value")).orderBy("_i").collect()
        return [row["value"] for row in result]

    return run


@pytest.fixture
def plan_of():
    """Text of the physical plan."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
