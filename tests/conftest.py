import pytest

from patchlens.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def column(spark):
    """Evaluate a column function on single texts: ``column(fn, *texts) -> list``."""
    from pyspark.sql import functions as F

    def evaluate(fn, *values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
        return [r.out for r in rows.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return evaluate
