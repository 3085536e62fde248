"""A corpus pipeline: reject toxic documents, drop exact and near copies, mix the sources, pack sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoflow.llm import exact_dedup, mixing, near_copies, packing, toxicity
from geoflow.llm.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: SQL has no conditional random field.
ORACLE_SQL = None


def _only(docs: DataFrame, keys: DataFrame, *by: str) -> DataFrame:
    """Rows of docs whose values in `by` are among the keys, nulls included; one of rows that agree in them."""
    renamed = keys.select(*[F.col(c).alias(f"key_{c}") for c in by]).distinct()
    met = docs.join(renamed, F.expr(" and ".join(f"{c} <=> key_{c}" for c in by)), "left_semi")
    first = Window.partitionBy(*by).orderBy(*by)
    return met.withColumn("nth", F.row_number().over(first)).where("nth = 1").select(*COLUMNS)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger doesn't predict to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    return toxicity.scored_rows(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text."""
    kept = exact_dedup.exact_duplicates(docs).where("kept").select("doc_id", F.col("text_sha256").alias("sha"))
    marked = docs.select(*COLUMNS, F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("sha"))
    return _only(marked, kept, "doc_id", "sha")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by 5-word shingles that agree in 0.8 or more."""
    marked = docs.select(*COLUMNS, F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    # an id alone doesn't tell rows apart: several texts may have the same one or none
    return _only(marked, near_copies.near_copies(marked), "doc_id", "sha")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their blocks."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the mixed documents."""
    return packing.packed_sequences(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
