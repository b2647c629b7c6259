import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ask(spark):
    """Values of a column function for some strings."""
    from pyspark.sql import functions as F

    def run(fn, *given, kind="string"):
        df = spark.createDataFrame(list(enumerate(given)), f"i int, s {kind}").repartition(2)
        return [r.o for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]

    return run
