"""Cutting lineage in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The column that tells rows apart, whatever their ids.
ROW = "_row"

_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode without a setting."""
    named = spark.conf.get(_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_KEY} to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="geoflow-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder now and go on from there."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def number_rows(df: DataFrame) -> DataFrame:
    """The rows with a number of their own in ``_row``, written, so that every later step sees the same number."""
    return cut_lineage(df.withColumn(ROW, F.monotonically_increasing_id()))


class Rounds:
    """Tables of an iteration in the shared folder; each is deleted when the next one is written, the last one stays."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, []

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        for old in self.paths:
            self._delete(old)
        self.paths = [path]
        return self.spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
