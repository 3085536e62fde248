"""Near copies by the similarity of their shingles: candidates by tiles of SimHash fingerprints, every link verified on the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .scratch import Scratch
from .simhash import SET_TILE, set_fingerprints, set_links, size_classes
from .wordbytes import mixed, slices, split_words, word_hashes

SHINGLE = 5
#: Texts are near copies if their sets of shingles agree in 4 of 5 (shared over all).
SHARED, OF = 4, 5
#: Words of 64 bits of a fingerprint. At similarity 0.8 or more a bit differs with probability 0.1875 at most if one set has 4
#: shingles, 0.1612 otherwise, so candidates may differ in that many bits of the first two words, three and all four: a pair has
#: more with probability 3e-6 at most (3e-7 if both have hundreds). An unrelated pair has no more in all with one of 2e-9, 2e-12.
WORDS = 4
LIMITS_FEW, LIMITS = (46, 64, 81), (42, 57, 73)
FEW = 5
#: A tile of a group of candidates has about so many texts and bytes at most.
TILE = 1024
TILE_BYTES = 16 << 20

_PLACE = np.random.Generator(np.random.PCG64(20240917)).integers(0, 2**64, SHINGLE, np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE) -> list[np.ndarray]:
    """The different hashes of each text's shingles, sorted. A text of fewer words is one shingle, one without words has none."""
    words = split_words(texts, lower=True)
    hashes = word_hashes(words)
    whole = max(0, len(hashes) - shingle + 1)
    runs = np.zeros(whole, np.uint64)
    for i in range(shingle):
        runs += hashes[i : i + whole] * _PLACE[i]
    runs = mixed(runs)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if hi - lo >= shingle:
            out.append(np.unique(runs[lo : hi - shingle + 1]))
        else:
            out.append(mixed((hashes[lo:hi] * _PLACE[: hi - lo]).sum(keepdims=True) + np.uint64(hi - lo)) if hi > lo else runs[:0])
    return out


def limits(cell: int) -> tuple[int, ...]:
    """How many bits candidates may differ in if the larger set is of this size class."""
    return LIMITS_FEW if cell <= FEW else LIMITS


def similar_sets(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the first one of its component under the links between similar sets.

    A set that was reached is compared only with those that weren't yet, so a group of copies costs about one comparison each.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    values, codes = np.unique(np.concatenate([*sets, np.empty(0, np.uint64)]), return_inverse=True)
    parts = np.split(codes, np.cumsum(sizes)[:-1])
    root = np.arange(len(sets))
    mark = np.zeros(len(values), bool)
    waiting = np.arange(len(sets))
    while len(waiting):
        first, waiting = waiting[0], waiting[1:]
        front = [first]
        while front and len(waiting):
            i = front.pop()
            n = sizes[waiting]
            fits = (OF * n >= SHARED * sizes[i]) & (OF * sizes[i] >= SHARED * n)
            near = waiting[fits]
            if not len(near):
                continue
            mark[parts[i]] = True
            ends = np.cumsum(sizes[near])
            sums = np.concatenate([[0], np.cumsum(mark[np.concatenate([parts[j] for j in near])])])
            mark[parts[i]] = False
            shared = sums[ends] - sums[ends - sizes[near]]
            found = near[OF * shared >= SHARED * (sizes[i] + sizes[near] - shared)]
            root[found] = first
            front.extend(found.tolist())
            waiting = waiting[~np.isin(waiting, found)]
    return root


def _printed(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, sha, size, n, cell, fps): the number of every text's different shingles, its size class, the fingerprint of the set."""
    docs = docs.select("doc_id", "sha", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"), "text")
    more = ["n", "cell", "fps"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            sets = shingle_sets(texts)
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * WORDS)
            fps = pa.ListArray.from_arrays(offsets, pa.array(set_fingerprints(sets, WORDS).view(np.int64).ravel()))
            columns = [*map(rows.column, ("doc_id", "sha", "size")), pa.array(sizes), pa.array(size_classes(sizes)), fps]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "sha", "size", *more])

    zero = F.lit(0).cast("bigint")
    return docs.mapInArrow(run, docs.select("doc_id", "sha", "size", *[x.alias(c) for x, c in zip((zero, zero, F.array(zero)), more, strict=True)]).schema)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between similar texts of one pair of tiles; rows come sorted by group and pair of tiles."""
    key, nodes, sets = None, [], []

    def links() -> pa.RecordBatch:
        ids = np.array(nodes, np.int64)
        root = similar_sets(sets)
        moved = np.flatnonzero(root != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], ["u", "v"])

    for rows, texts in slices(batches):
        keys = zip(*(rows.column(c).to_pylist() for c in ("root", "one", "two")), strict=True)
        for at, node, values in zip(keys, rows.column("node").to_pylist(), shingle_sets(texts), strict=True):
            if at != key:
                if len(nodes) > 1:
                    yield links()
                key, nodes, sets = at, [], []
            nodes.append(node)
            sets.append(values)
    if len(nodes) > 1:
        yield links()


def near_copies(docs: DataFrame, tile: int = TILE, tile_bytes: int = TILE_BYTES, set_tile: int = SET_TILE) -> DataFrame:
    """Rows (doc_id, sha) of the texts that stay: one of each component of texts whose shingles agree in 4 of 5.

    docs: columns doc_id, text and sha, which tells texts apart; others are not read. Equal texts are one node. Texts without
    words and null texts are alike. Of a component the first by doc_id, nulls last, then sha stays. An empty table gives no rows.

    Candidates are texts with near SimHash fingerprints of their sets of shingles; tiles of fingerprints are compared exactly, and
    only those of sizes that differ too much for the similarity are skipped. Each component of candidates is cut into tiles, its
    texts are sent to every pair of tiles they are in, and all pairs of sets found there are compared exactly; only a spanning
    forest of the links between similar sets goes on. So a pair is linked only if it is similar, and is missed only if its
    fingerprints differ in more bits than LIMITS allow and no other pair links them.
    """
    scratch = Scratch(docs.sparkSession, "near")
    nodes = scratch.keep(
        _printed(docs)
        .groupBy("sha")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")).alias("lead"), F.max("size").alias("size"), *[F.first(c).alias(c) for c in ("n", "cell", "fps")])
        .withColumn("node", F.monotonically_increasing_id())
    )
    prints = nodes.select("node", "n", "cell", "fps")
    candidates = connected(set_links(prints, scratch, limits, SHARED, OF, WORDS, set_tile), scratch)
    members = scratch.keep(candidates.join(nodes.select("node", "sha", "lead", "size"), "node"))
    by_count, by_bytes = F.ceil(F.count("*") / F.lit(tile)), F.ceil(F.sum("size") / F.lit(tile_bytes))
    tiles = members.groupBy("root").agg(F.greatest(F.lit(1), by_count, by_bytes).cast("int").alias("tiles"))
    placed = members.join(tiles, "root").select(
        "root", "node", "tiles", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile"), F.col("sha").alias("its_sha"), F.col("lead.doc_id").alias("its_id")
    )
    sent = (
        docs.select("doc_id", "sha", "text")
        .join(placed.hint("merge"), F.expr("sha = its_sha and doc_id <=> its_id"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("root", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "node", "text")
    )
    links = sent.repartition("root", "one", "two").sortWithinPartitions("root", "one", "two").mapInArrow(_verified, "u bigint, v bigint")
    roots = connected(links, scratch)
    grouped = nodes.select("node", "sha", "lead").join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root"))
    return grouped.agg(F.min(F.struct("lead", "sha")).alias("kept")).select(F.col("kept.lead.doc_id").alias("doc_id"), F.col("kept.sha").alias("sha"))
