"""Hard negatives by exact integer scores, many candidates in one multiplication."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

#: Components are multiplied by this and rounded down.
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative scores between these shares, in percent, of its positive.
LOWEST, HIGHEST = 50, 95
#: Candidates that one task meets with one tile of anchors, and anchors of a tile; only the latter are held in memory.
CANDIDATES, ANCHORS = 4096, 4096
#: Candidates whose components are packed into one integer.
PACKED = 1024
#: Rows of one label or length are dealt out over so many parts when they learn how many tiles there are.
SALTS = 256
_MOST = (1 << 63) - 1
#: No id; comes after all others.
_NO_ID = _MOST


def whole_components(vector: str, scale: int = SCALE) -> Column:
    """The components as whole numbers; null for vectors that are null or have a null, non-finite or too large component."""
    scaled = f"transform({vector}, c -> floor(double(c) * {scale}D))"
    # the cast stands behind the test, as it would fail on what the test turns away
    fits = f"forall({vector}, c -> c is not null and abs(double(c)) * {scale}D < 9.2e18D)"
    return F.expr(f"case when {vector} is not null and {fits} then transform({scaled}, c -> bigint(c)) end")


class Packed:
    """Vectors side by side in wide integers, one for each dimension: field j of integer i is component i of vector j.

    Components are made non-negative by adding a bias, and a field is wide enough for every sum of products with the anchors
    that were named, so no field ever carries into the next one. Multiplying the integers by an anchor's components, also
    made non-negative, and adding up gives all sums at once; taking off what the biases have added gives the scores.
    """

    def __init__(self, rows: np.ndarray, anchor_low: int, anchor_high: int):
        self.count, self.dims = rows.shape
        low, high = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
        self.bias, self.anchor_bias = -min(low, 0), -min(anchor_low, 0)
        largest = self.dims * (high + self.bias) * (anchor_high + self.anchor_bias)
        self.width = next((w for w in (32, 64) if largest < 1 << w), -(-largest.bit_length() // 64) * 64)
        kind = {32: "<u4", 64: "<u8"}.get(self.width)
        if kind:
            fields = (rows.T.astype(np.int64) + self.bias).astype(kind) if self.bias < 1 << 62 else None
        if not kind or fields is None:
            size = self.width // 8
            self.wide = [int.from_bytes(b"".join((int(x) + self.bias).to_bytes(size, "little") for x in column), "little") for column in rows.T]
        else:
            self.wide = [int.from_bytes(column.tobytes(), "little") for column in fields]
        self.sums = [int(x) for x in (rows.sum(axis=1) if max(abs(low), high) < 1 << 40 else rows.astype(object).sum(axis=1))] if self.dims else [0] * self.count
        self.small = max(self.sums, key=abs, default=0).bit_length() + self.anchor_bias.bit_length() + largest.bit_length() < 60
        self.base = np.array(self.sums, np.int64 if self.small else object)

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Inner products of the anchor with all vectors; those beyond 64 bits count as the last number within."""
        total = 0
        for value, wide in zip(anchor, self.wide, strict=True):
            total += (value + self.anchor_bias) * wide
        fields = total.to_bytes(self.count * self.width // 8, "little")
        if self.width == 32:
            sums = np.frombuffer(fields, "<u4")
        elif self.width == 64:
            sums = np.frombuffer(fields, "<u8")
        else:
            size = self.width // 8
            sums = np.array([int.from_bytes(fields[i : i + size], "little") for i in range(0, len(fields), size)], object)
        # sum of (a + A)(b + B) = sum of ab + A * sum of b + B * sum of a + dims * A * B
        added = self.bias * (sum(anchor) + self.dims * self.anchor_bias)
        if self.small:
            return sums.astype(np.int64) - self.base * self.anchor_bias - added
        exact = [int(s) - b * self.anchor_bias - added for s, b in zip(sums, self.sums, strict=True)]
        return np.array([max(-_MOST, min(_MOST, x)) for x in exact], np.int64)


def best(scores: np.ndarray, ids: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores among those marked, ties by smaller id and then by place."""
    some = np.flatnonzero(among)
    if len(some) > k:
        least = np.partition(scores[some], len(some) - k)[len(some) - k]
        some = some[scores[some] >= least]
    return some[np.lexsort((some, ids[some], -scores[some]))][:k]


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


class _Anchors:
    """The anchors of a tile."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.row, self.label = (np.concatenate([_rows(b, c) for b in batches]) for c in ("row", "label"))
        x = np.concatenate([_vectors(b) for b in batches])
        self.low, self.high = (int(x.min()), int(x.max())) if x.size else (0, 0)
        self.x = x.tolist()
        self.wanted = [w for b in batches for w in b.column("wanted").to_pylist()]


Found = Callable[[_Anchors, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple]]


def _met(find: Found, schema: pa.Schema):
    """Rows come sorted by tile, its anchors first; candidates stream past them in packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting = None, []
        anchors: _Anchors | None = None
        for batch in batches:
            group, own = _rows(batch, "tile"), _rows(batch, "own")
            turns = np.flatnonzero((group[1:] != group[:-1]) | (own[1:] != own[:-1])) + 1
            for a, b in zip([0, *turns], [*turns, len(batch)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if group[a] != key:
                    key, waiting, anchors = group[a], [], None
                if own[a]:
                    waiting.append(part)
                    continue
                if anchors is None and waiting:
                    anchors = _Anchors(waiting)
                if anchors is None:
                    continue
                for at in range(0, len(part), PACKED):
                    some = part.slice(at, PACKED)
                    x = _vectors(some)
                    packed = Packed(x, anchors.low, anchors.high)
                    row, ids, label = (_rows(some, c) for c in ("row", "id", "label"))
                    out = [hit for i in range(len(anchors.x)) for hit in find(anchors, i, packed.scores(anchors.x[i]), row, ids, label)]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _positives(k: int) -> Found:
    def find(anchors, i, scores, row, ids, label):
        own = anchors.row[i]
        for j in best(scores, ids, row != own, k):
            yield own, row[j], ids[j], scores[j]

    return find


def _negatives(k: int, lowest: int, highest: int) -> Found:
    def find(anchors, i, scores, row, ids, label):
        other = label != anchors.label[i]
        for p in anchors.wanted[i]:
            # lowest * p <= 100 * s <= highest * p in whole numbers
            first, last = -(-lowest * p["score"] // 100), highest * p["score"] // 100
            if first > last:
                continue
            for j in best(scores, ids, other & (scores >= first) & (scores <= last), k):
                yield anchors.row[i], p["nth"], row[j], ids[j], scores[j]

    return find


def _tiles(anchors: DataFrame, rows: DataFrame, by: list[str]) -> DataFrame:
    """All anchors with all candidates that agree in `by`: every tile of anchors meets every tile of candidates.

    A tile is a number of each side by a hash of the row, so a label that most rows have is cut like any other.
    """

    def count(df: DataFrame, most: int, name: str) -> DataFrame:
        return df.groupBy(*by).agg(F.ceil(F.count("*") / most).cast("int").alias(name))

    sizes = count(anchors, ANCHORS, "a_tiles").join(count(rows, CANDIDATES, "c_tiles"), by)
    # all rows may have one length and most rows one label
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    columns = [*by, "row", "id", "x", *[c for c in ("label",) if c not in by]]

    def dealt(df: DataFrame, own: str, other: str, is_own: bool) -> DataFrame:
        salted = df.select(*columns, *(["wanted"] if is_own else []), F.pmod(F.xxhash64("row", F.lit("salt")), F.lit(SALTS)).cast("int").alias("salt"))
        met = salted.join(sizes, [*by, "salt"])
        met = met.withColumn("mine", F.pmod(F.xxhash64("row"), F.col(own)).cast("int")).withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        a, c = ("mine", "theirs") if is_own else ("theirs", "mine")
        tile = F.concat_ws("/", *[F.col(name).cast("string") for name in [*by, a, c]]).alias("tile")
        wanted = F.col("wanted") if is_own else F.lit(None).cast("array<struct<nth:int,score:bigint>>")
        return met.select(tile, F.lit(is_own).alias("own"), "row", "id", "label", "x", wanted.alias("wanted"))

    return dealt(anchors, "a_tiles", "c_tiles", True).unionByName(dealt(rows, "c_tiles", "a_tiles", False))


def _met_rows(tiles: DataFrame, find: Found, schema: pa.Schema, columns: str) -> DataFrame:
    return tiles.repartition("tile").sortWithinPartitions("tile", F.col("own").desc(), "id", "row").mapInArrow(_met(find, schema), columns)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of two vectors of whole numbers, floor(256 * component). The positives of an anchor are the
    first `positives` other rows of its label by falling score; a positive's negatives are the first `negatives` rows of
    other labels that score between `lowest` and `highest` percent of it against the same anchor. Ties go by smaller id.

    vectors: columns vec_id, embedding, label; others are not read. anchors: a condition that marks the anchors, over these
    columns; label: what to use as label instead of the column. Rows with a null label or vector, or with a component that is
    null, not finite or beyond 64 bits, take no part; only vectors of equal length meet. A null vec_id comes after all others.
    Repeated rows are rows of their own, so a copy of an anchor can be its positive. Scores beyond 64 bits count as the last
    number within. An anchor without positives, and a positive without negatives, gives no row, nor does an empty table.

    Every anchor meets every row, in tiles: a task holds the anchors of one tile and candidates stream past. Positives are
    looked for within labels; their scores go with the anchors into the search for negatives. Work is the number of anchors times
    the number of rows; of each pair of tiles only the first few rows of each anchor go on.
    """
    scratch = Scratch(vectors.sparkSession, "negatives")
    whole = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), (F.col("label") if label is None else label).cast("bigint").alias("label"),
        anchors.alias("is_anchor"), whole_components("embedding").alias("x"),
    ).where("label is not null and x is not null")
    rows = scratch.keep(
        whole.select(
            F.monotonically_increasing_id().alias("row"), F.coalesce("vec_id", F.lit(_NO_ID)).alias("id"), "label",
             F.size("x").alias("size"), "x", F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"),
        )
    )
    chosen = rows.where("is_anchor")
    no_list = F.lit(None).cast("array<struct<nth:int,score:bigint>>").alias("wanted")
    hit = [("anchor", pa.int64()), ("other", pa.int64()), ("other_id", pa.int64()), ("score", pa.int64())]
    same = _met_rows(_tiles(chosen.withColumn("wanted", no_list), rows, ["size", "label"]), _positives(positives), pa.schema(hit), "anchor bigint, other bigint, other_id bigint, score bigint")

    def first(df: DataFrame, k: int, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id", "other")
        return df.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)

    near = scratch.keep(first(same, positives, "anchor"))
    wanted = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct(F.col("nth").cast("int").alias("nth"), "score")).alias("wanted"))
    schema = pa.schema([hit[0], ("positive", pa.int32()), *hit[1:]])
    apart = _met_rows(_tiles(chosen.join(wanted, "row"), rows, ["size"]), _negatives(negatives, lowest, highest), schema, "anchor bigint, positive int, other bigint, other_id bigint, score bigint")
    found = first(apart, negatives, "anchor", "positive").select("anchor", "positive", F.col("nth").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = rows.where("is_anchor").select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    told = near.select("anchor", F.col("nth").cast("int").alias("positive"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    return found.join(told, ["anchor", "positive"]).join(names, "anchor").select(
        known("anchor_id"), known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score"
    )
