import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[8]")
        .appName("rateweave-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only where the session has none
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rw-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rw-test-")


def ratings_df(spark, rows):
    """(user_id, item_id, rating) rows -> ratings DataFrame with a rated_at column."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "user_id long, item_id int, rating int")
    return df.withColumn("rated_at", F.lit("2005-01-01 00:00:00").cast("timestamp_ntz"))
