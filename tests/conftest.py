import pytest
from pyspark.sql import SparkSession

from firmament.session import BUILD_SETTINGS, tune


def build_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("firmament-tests")
        .config("spark.ui.enabled", "false")
        .config(map=BUILD_SETTINGS)
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = tune(build_session())
    yield session
    session.stop()
