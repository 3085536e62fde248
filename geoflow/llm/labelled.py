"""Bounded samples of labelled texts for fitting classifiers, and the calibration of their scores."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: Texts above this size are scored like all others, but not used for fitting.
LONGEST = 1 << 20
#: The range of a 64-bit hash.
_LOWEST, _PLACES = -(1 << 63), 1 << 64
#: Rows of a class let through beyond twice those that are needed.
_SPARE = 64


def fold(doc_id: str, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


def _drawn(rows: DataFrame, per_class: int) -> tuple[list[Row], dict]:
    """The first per_class rows of each class by a hash of the id, or all if there are fewer, and how many rows each class has.

    Some more rows of each class than needed are let through by their hash, so that only these are ordered.
    """
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().orderBy("y").collect()}
    more = [c for c in rows.columns if c not in ("doc_id", "y")]
    placed = rows.withColumn("place", F.xxhash64("doc_id", F.lit("sample")))
    last = F.lit(_LOWEST)
    for y, n in counts.items():
        last = F.when(F.col("y") == F.lit(y), F.lit(_LOWEST + min(_PLACES - 1, (2 * per_class + _SPARE) * _PLACES // n))).otherwise(last)
    order = ("place", "doc_id", *more)
    nth = F.row_number().over(Window.partitionBy("y").orderBy(*order))
    drawn = placed.where(F.col("place") <= last).withColumn("nth", nth).where(F.col("nth") <= per_class).select(*rows.columns).collect()
    had = Counter(r["y"] for r in drawn)
    for y, n in counts.items():
        if had[y] < min(per_class, n):  # rows of one id have one place, so a class of few ids may be let through in too few rows
            drawn = [r for r in drawn if r["y"] != y]
            drawn += placed.where(F.col("y") == F.lit(y)).orderBy(*order).limit(per_class).select(*rows.columns).collect()
    return drawn, counts


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, held_out: Column, per_class: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts, their labels 0/1 and the weight of each: how many labelled rows of its class it stands for.

    Rows with a null id or label, and those held out, are not used; of several labels of a document the largest counts,
    of several texts the first. At most per_class rows of each class come to the driver, which also bounds what is broadcast.
    """
    known = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).alias("y"))
    known = known.where(~held_out).groupBy("doc_id").agg(F.max("y").cast("int").alias("y"))
    drawn, counts = _drawn(known, per_class)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.octet_length("text") <= LONGEST)
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], r["y"]) for r in drawn], "doc_id bigint, y int")
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.encode(F.min("text"), "utf-8").alias("t")).collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.t)))
    y = np.array([r.y for r in rows], np.int64)
    weight = np.array([counts.get(int(v), 0) / max(1, int((y == v).sum())) for v in y])
    return [bytes(r.t) for r in rows], y, weight


def class_sample(docs: DataFrame, column: str, held_out: Column, per_class: int) -> tuple[list[bytes], list]:
    """Texts and their classes, per_class or fewer of each value that isn't null."""
    known = docs.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out & (F.octet_length("text") <= LONGEST))
    rows, _ = _drawn(known.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(column).alias("y"), F.encode("text", "utf-8").alias("t")), per_class)
    rows.sort(key=lambda r: (r.doc_id, bytes(r.t)))
    return [bytes(r.t) for r in rows], [r.y for r in rows]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Coefficients of a logistic regression, the constant last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = weight * len(weight) / max(weight.sum(), 1e-12)
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * b
        curve = (x.T * (weight * p * (1 - p))) @ x + penalty * np.eye(len(b))
        step = np.linalg.solve(curve, gradient)
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return b


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
