"""Sizes of files, and of the ranges Spark cuts them into."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def files(spark: SparkSession, path: str | list[str], larger: int = -1) -> list[str]:
    """Files above a size, by the listing alone."""
    listed = spark.read.format("binaryFile").load(path).where(F.col("length") > larger)
    return sorted(r.path for r in listed.select("path").collect())


def split_bytes(spark: SparkSession) -> int:
    """What Spark puts into one range of a file at most."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
