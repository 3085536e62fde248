"""Intermediate tables in the shared folder the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; the warehouse, which is shared as well, where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch").rstrip("/")


class Scratch:
    """Tables of one operator call.

    Each lives in its own database in the shared folder, so that every executor can read it after any other was lost, and
    dropping a table deletes its files. Tables that a lazy result still reads stay until clean() is called.
    """

    _open: list[Scratch] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.database = f"llm_{name}_{uuid.uuid4().hex}"
        self._count = 0
        spark.sql(f"create database {self.database} location '{shared_folder(spark)}/{self.database}.db'")
        Scratch._open.append(self)

    def path(self, name: str) -> str:
        """A path beside the tables, deleted with them by clean()."""
        return f"{shared_folder(self.spark)}/{self.database}.db/{name}"

    def keep(self, df: DataFrame) -> DataFrame:
        """Write the rows now, free the shuffle files that made them, and go on from the written table."""
        self._count += 1
        table = f"{self.database}.t{self._count}"
        before = self.spark.conf.get(_CLEAN_SHUFFLES, "false")
        self.spark.conf.set(_CLEAN_SHUFFLES, "true")
        try:
            df.write.format("parquet").saveAsTable(table)
        finally:
            self.spark.conf.set(_CLEAN_SHUFFLES, before)
        kept = self.spark.table(table)
        kept.scratch_table = table
        return kept

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for df in tables:
            self.spark.sql(f"drop table if exists {df.scratch_table}")


def clean(spark: SparkSession) -> None:
    """Delete all scratch tables of this process; results that were not written yet can't be read afterwards."""
    while Scratch._open:
        spark.sql(f"drop database if exists {Scratch._open.pop().database} cascade")
