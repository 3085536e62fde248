"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected, star_edges
from .scratch import Scratch

THRESHOLD = 0.93
#: Two vectors of 64 components at the threshold share a bucket of one table with probability 0.6, of any with 0.99998.
TABLES = 12
#: Cross-polytope hashes that make one bucket together, and buckets of each table that a vector lies in.
HASHES, PROBES = 2, 2
TILE = 1024


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Rows under a pseudorandom rotation: three times random signs and a fast Hadamard transform."""
    n, d = x.shape
    rng = np.random.Generator(np.random.PCG64(seed))
    x = x.copy()
    for _ in range(3):
        x *= rng.integers(0, 2, d) * 2.0 - 1.0
        step = 1
        while step < d:
            y = x.reshape(n, d // (2 * step), 2, step)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
            step *= 2
    return x / d**1.5


def bucket_codes(x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, seed: int = 7) -> np.ndarray:
    """Codes of the buckets of unit rows, (rows, tables, probes): those whose axes lose least against the nearest ones.

    A hash is the signed axis nearest to the rotated vector. Each hash offers its two nearest axes; of their combinations the
    `probes` with the smallest loss in squared length are a vector's buckets.
    """
    n, d = x.shape
    wide = max(2, 1 << (d - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :d] = x
    out = np.empty((n, tables, probes), np.int64)
    choices = np.array(np.meshgrid(*[[0, 1]] * hashes, indexing="ij")).reshape(hashes, -1).T
    for t in range(tables):
        axes, losses = [], []
        for h in range(hashes):
            y = rotated(padded, seed + t * hashes + h)
            size = np.abs(y)
            two = np.argpartition(size, wide - 2, axis=1)[:, -2:]
            value = np.take_along_axis(size, two, 1)
            swap = value[:, 0] > value[:, 1]
            two = np.where(swap[:, None], two, two[:, ::-1])
            value = np.where(swap[:, None], value, value[:, ::-1])
            axes.append(2 * two + (np.take_along_axis(y, two, 1) < 0))
            losses.append(value[:, :1] - value)
        loss = sum(losses[h][:, choices[:, h]] for h in range(hashes))
        code = np.zeros(loss.shape, np.int64)
        for h in range(hashes):
            code = code * (2 * wide) + axes[h][:, choices[:, h]]
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        out[:, t] = np.take_along_axis(code, best, 1)
    return out


def unit_rows(column: pa.Array) -> np.ndarray:
    """Vectors of equal length as rows of length one, in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(tables: int, hashes: int, probes: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vec").offsets.to_numpy())
            for size in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == size))
                for at in range(0, len(rows), 2048):
                    some = rows.slice(at, 2048)
                    codes = bucket_codes(unit_rows(some.column("vec")), tables, hashes, probes, seed).astype(np.int32)
                    offsets = pa.array(np.arange(len(some) + 1, dtype=np.int32) * (tables * probes))
                    lists = pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([some.column("rep"), lists], ["rep", "codes"])

    return run


class _Block:
    """Vectors of one bucket: their ids, numbers of copies, bucket codes and unit vectors."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]], probes: int):
        self.rep, self.copies, codes, self.unit = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.codes = codes.reshape(len(codes), -1, probes)

    def __len__(self) -> int:
        return len(self.rep)


def _first_here(a: np.ndarray, b: np.ndarray, table: int, code: int) -> np.ndarray:
    """Of pairs with codes a and b, those whose first common bucket, by table and code, is this one."""
    first = np.ones(len(a), bool)
    for t in range(table + 1):
        same = a[:, t, :, None] == b[:, t, None, :]
        if t == table:
            same &= (a[:, t, :] < code)[:, :, None]
        first &= ~same.any(axis=(1, 2))
    return first


def _compared(threshold: float, probes: int):
    """Links within each bucket. Rows come sorted by bucket and tile, the tile's own rows first, then those sent to it."""

    def links(home: _Block, other: _Block | None, table: int, code: int) -> pa.RecordBatch:
        both = home if other is None else other
        left, right = [], []
        for lo in range(0, len(home), 256):
            i, j = np.nonzero(home.unit[lo : lo + 256] @ both.unit.T >= threshold)
            i += lo
            if other is None:
                i, j = i[i < j], j[i < j]
            mine = np.concatenate([_first_here(home.codes[i[k : k + 100_000]], both.codes[j[k : k + 100_000]], table, code) for k in range(0, len(i), 100_000)] or [np.empty(0, bool)])
            left.append(i[mine])
            right.append(j[mine])
        i, j = np.concatenate(left), np.concatenate(right)
        reps = home.rep if other is None else np.concatenate([home.rep, other.rep])
        far = j if other is None else j + len(home)
        copies = home.copies if other is None else np.concatenate([home.copies, other.copies])
        counts = np.bincount(i, copies[far], len(reps)) + np.bincount(far, copies[i], len(reps))
        root = star_edges(len(reps), i, far) if len(i) else np.arange(len(reps))
        some = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array(reps[some]), pa.array(reps[root[some]]), pa.array(counts[some].astype(np.int64))], ["u", "v", "links"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, sent = None, [], []
        home: _Block | None = None

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal home
            if home is None and own:
                home = _Block(own, probes)
                if len(home) > 1:
                    yield links(home, None, key[2], key[3])
            if home is not None and sent:
                yield links(home, _Block(sent, probes), key[2], key[3])
            sent.clear()
            if last:
                own.clear()
                home = None

        for batch in batches:
            label, size, table, code, tile = (batch.column(c).to_numpy() for c in ("label", "size", "table", "code", "tile"))
            mine = batch.column("own").to_numpy(zero_copy_only=False)
            rep, copies = batch.column("rep").to_numpy(), batch.column("copies").to_numpy()
            starts = [0]
            for r in range(1, len(batch)):
                if (label[r], size[r], table[r], code[r], tile[r], mine[r]) != (label[r - 1], size[r - 1], table[r - 1], code[r - 1], tile[r - 1], mine[r - 1]):
                    starts.append(r)
            for a, b in zip(starts, [*starts[1:], len(batch)], strict=False):
                if a == b:
                    continue
                now = (label[a], size[a], table[a], code[a], tile[a])
                if now != key:
                    yield from flush(True)
                    key = now
                part = (
                    rep[a:b], copies[a:b],
                    batch.column("codes").slice(a, b - a).flatten().to_numpy().reshape(b - a, -1),
                    unit_rows(batch.column("vec").slice(a, b - a)),
                )
                (own if mine[a] else sent).append(part)
                if not mine[a] and sum(len(x[0]) for x in sent) >= 4 * TILE:
                    yield from flush(False)
        yield from flush(True)

    return run


def near_duplicate_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES, tile: int = TILE, seed: int = 7
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of vectors.

    Vectors are linked if their labels are equal and not null and their cosine, in double precision, reaches the threshold.
    Candidates share a bucket: a bucket of a table is the combination of the signed axes nearest to the vector under several
    rotations, and every vector lies in the `probes` nearest buckets of each table. Candidates are verified in tiles; a large
    bucket has several tiles, dealt out over tasks. A pair counts in its first common bucket only, so links are counted
    without listing pairs, and only a spanning forest of each tile goes on to find components.

    vectors: columns vec_id, embedding, label; others are not read. Vectors that are null, empty, zero or have null or
    non-finite components link with nothing, nor do vectors of different lengths. Equal vectors of a label are compared once
    and link with each other. A null vec_id is never kept and names no component unless all ids there are null. Repeated rows
    count as other vectors. An empty table gives no rows. More tables raise the recall, more hashes make finer buckets.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.col("embedding").cast(kind).alias("vec")
    )
    finite = F.expr("label is not null and size(vec) > 0 and forall(vec, x -> x is not null and abs(x) < double('Infinity')) and exists(vec, x -> x <> 0)")
    usable = rows.where(finite)
    reps = scratch.keep(usable.groupBy("label", "vec").agg(F.count("*").alias("copies")).withColumn("rep", F.monotonically_increasing_id()))
    codes = scratch.keep(reps.select("rep", "vec").mapInArrow(_hashed(tables, hashes, probes, seed), "rep bigint, codes array<int>"))
    hashed = reps.join(codes, "rep").withColumn("size", F.size("vec"))
    bucket = ["label", "size", "table", "code"]
    spots = hashed.select("label", "size", "rep", F.posexplode("codes").alias("pos", "code")).select(
        "label", "size", F.expr(f"pos div {probes}").cast("int").alias("table"), "code", "rep"
    )
    # buckets with more than one vector, and into how many tiles they go; vectors travel to no others
    shared = scratch.keep(
        spots.groupBy(*bucket).count().where("count > 1").select(*bucket, F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    )
    visits = spots.hint("merge").join(shared, bucket).groupBy("rep").agg(F.collect_list(F.struct("table", "code", "tiles")).alias("visits"))
    found = scratch.keep(
        hashed.join(visits.hint("merge"), "rep")
        .select("label", "size", "rep", "copies", "codes", "vec", F.explode("visits").alias("v"))
        .withColumn("home", F.pmod(F.xxhash64("rep"), F.col("v.tiles")).cast("int"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("home"))))
        .select("label", "size", "v.table", "v.code", "tile", (F.col("tile") == F.col("home")).alias("own"), "rep", "copies", "codes", "vec")
        .repartition(*[F.col(c) for c in bucket], F.col("tile"))
        .sortWithinPartitions(*bucket, "tile", F.col("own").desc())
        .mapInArrow(_compared(threshold, probes), "u bigint, v bigint, links bigint")
    )
    roots = connected(found.select("u", "v"), scratch)
    counts = found.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    known = (
        reps.join(counts, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    )
    linked = scratch.keep(usable.join(known, ["label", "vec"]).select("vec_id", "n_links", "root"))
    groups = scratch.keep(linked.groupBy("root").agg(F.min("vec_id").alias("component_id")))
    inside = linked.join(groups, "root").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(finite, F.lit(False))).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return inside.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
