"""Hand-over tables of this subpackage in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobsift import session
from jobsift.session import shuffles_dropped

def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the shared folder and read it back."""
    return session.stored(df, name)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of ours in the shared folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have, in any case."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
