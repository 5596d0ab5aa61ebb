import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import lurewatch

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    lurewatch.ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mail(spark):
    from lurewatch.sources.fixture import mail_view

    return mail_view(spark, SF)


@pytest.fixture()
def texts(spark):
    """Evaluate a column expression over literal strings."""

    def run(values, expr):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i long, t string").repartition(1)
        return [r[1] for r in sorted(df.select("i", expr.alias("o")).collect())]

    return run
