import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (HERE, os.environ.get("PYTHONPATH", ""))))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.ui.retainedExecutions", "5").config("spark.sql.maxPlanStringLength", "100000").config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='tests-')}").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """The engine may choose broadcasts as by default, but any that it makes fails."""
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1b")
    yield
    spark.conf.unset("spark.sql.maxBroadcastTableSize")


@pytest.fixture
def column(spark):
    """Values of a Column function over a list of texts."""
    from pyspark.sql import functions as F

    def run(function, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select("i", function(F.col("x")).alias("y"))
        return [r["y"] for r in rows.orderBy("i").collect()]

    return run
