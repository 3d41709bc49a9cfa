import pytest
from pyspark.sql import SparkSession

from linscore.session import BUILD_SETTINGS, configure


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("linscore-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config(map=BUILD_SETTINGS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
