"""Tables of a stage are written densely, and the shuffle files behind them do not stay."""

import os
import time

from jobsift.session import stored
from jobsift.sources import sinks


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return env.blockManager().diskBlockManager().getAllFiles().mkString(" ").count("/shuffle_")


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    before = shuffle_files(spark)
    moved = spark.range(20_000).selectExpr("id", "sha2(string(id), 256) AS text").repartition(7, "text")
    assert stored(moved, "moved").count() == 20_000
    sinks.write_parquet(moved, f"{tmp_path}/table")
    assert [f for f in os.listdir(f"{tmp_path}/table") if f.endswith(".parquet")]
    assert all(".zstd." in f for f in os.listdir(f"{tmp_path}/table") if f.endswith(".parquet"))
    for _ in range(100):
        if shuffle_files(spark) <= before:
            return
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
