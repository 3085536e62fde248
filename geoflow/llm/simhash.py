"""SimHash near-duplicates by exact comparison of tiles of fingerprints."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected, hooked
from .scratch import Scratch
from .wordbytes import mixed, slices, split_words, xxh64

TILE = 1024
#: A tile of sets of one size class has about so many fingerprints and is sent in rows of about ROW.
SET_TILE, ROW = 1 << 14, 128
_SEGMENT = 60_000
_LANES = np.uint64(0x0001000100010001)
_STEPS = np.cumsum(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def _majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A word for each run of hashes, of counts[k] > 0: a bit is set if it is set in over half of the run."""
    begins = np.cumsum(counts) - counts
    # counters of 16 bits, four to a word, so that a long text is counted in several segments
    pieces = -(-counts // _SEGMENT)
    owner = np.repeat(np.arange(len(counts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    segments = begins[owner] + nth * _SEGMENT
    ones = np.empty((len(owner), 64), np.int64)
    for shift in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(shift)) & _LANES, segments)
        for lane in range(4):
            ones[:, 16 * lane + shift] = (sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF)
    ones = np.add.reduceat(ones, np.cumsum(pieces) - pieces, axis=0)
    bits = (2 * ones > counts[:, None]).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def set_fingerprints(sets: list[np.ndarray], words: int = 4) -> np.ndarray:
    """Rows of words of 64 bits each, a bit set if it is set in over half of the set's hashes, mixed anew for every word. Zero for an empty set."""
    counts = np.fromiter(map(len, sets), np.int64, len(sets))
    some = np.flatnonzero(counts)
    out = np.zeros((len(sets), words), np.uint64)
    if len(some):
        hashes = np.concatenate(sets)
        for w in range(words):
            out[some, w] = _majorities(mixed(hashes + _STEPS[w]), counts[some])
    return out


def size_classes(sizes: np.ndarray) -> np.ndarray:
    """The size itself below 32, then 16 classes from each power of two to the next."""
    above = np.maximum(0, np.frexp(sizes.astype(np.float64))[1] - 5).astype(np.int64)
    return 16 * above + (sizes >> above)


def text_fingerprints(texts: list[bytes], shingle: int = 3) -> np.ndarray:
    """Fingerprints of UTF-8 texts: a bit is set if it is set in over half of the shingles' hashes."""
    words = split_words(texts, lower=True)
    lengths = words.ends - words.starts
    # the words again, one space after each: a shingle is then one run of bytes
    tail = np.concatenate([[False], words.inside[:-1]])
    data = np.where(words.inside, words.data, np.uint8(32))[words.inside | tail]
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    n_words = np.diff(words.first)
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - shingle + 1, 1))
    out = np.zeros(len(texts), np.uint64)
    docs = np.flatnonzero(n_shingles)
    if not len(docs):
        return out
    counts = n_shingles[docs]
    begins = np.cumsum(counts) - counts
    index = np.arange(int(counts.sum())) + np.repeat(words.first[docs] - begins, counts)
    last = np.minimum(index + shingle - 1, np.repeat(words.first[docs + 1] - 1, counts))
    hashes = xxh64(data, starts[index], starts[last] + lengths[last])
    out[docs] = _majorities(hashes, counts)
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Rows (doc_id, fp) and the other columns of docs but the text; fp: the 64 bits of every text as a bigint.

    Null and empty texts have fingerprint zero. A column of docs named fp is not allowed.
    """
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    more = [c for c in docs.columns if c not in ("doc_id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            fp = pa.array(text_fingerprints(texts, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), fp, *map(rows.column, more)], ["doc_id", "fp", *more])

    return docs.mapInArrow(run, docs.select("doc_id", F.lit(0).cast("bigint").alias("fp"), *more).schema)


def _close(home: np.ndarray, other: np.ndarray | None, limits: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of near pairs, home against other or among itself, a block of rows at a time. Fingerprints are columns, one row a word.

    A pair is near if its words so far differ in no more bits than each limit: the last limit is for all words, the one before
    for all but the last, and so on; the words of the first limit are compared for all pairs, later ones for those left.
    """
    inner = other is None
    other = home if inner else other
    heads = len(home) - len(limits) + 1
    rows = max(1, (1 << 16) // max(1, other.shape[1]))
    room = [np.empty(rows * other.shape[1], t) for t in (np.uint64, np.uint8, np.uint8)]
    for lo in range(0, home.shape[1], rows):
        n, begin = min(rows, home.shape[1] - lo), lo if inner else 0
        width = other.shape[1] - begin
        word, counts, differ = (x[: n * width].reshape(n, width) for x in room)
        for w in range(heads):
            np.bitwise_xor(home[w, lo : lo + n, None], other[w, begin:], out=word)
            np.bitwise_count(word, out=counts if w else differ)
            if w:
                np.add(differ, counts, out=differ)
        at = np.flatnonzero(differ <= limits[0])
        i = at // width
        j = at - i * width
        bits = differ.ravel()[at].astype(np.int16)
        if inner:
            i, j, bits = i[i < j], j[i < j], bits[i < j]
        i, j = i + lo, j + begin
        for w, limit in enumerate(limits[1:], heads):
            bits = bits + np.bitwise_count(home[w, i] ^ other[w, j])
            i, j, bits = i[bits <= limit], j[bits <= limit], bits[bits <= limit]
        if len(i):
            yield i, j


def _forest(home: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray] | None, limits: tuple[int, ...]) -> pa.RecordBatch:
    """Links that connect the same nodes as all near pairs do."""
    nodes = home[0] if other is None else np.concatenate([home[0], other[0]])
    root = np.arange(len(nodes))
    for i, j in _close(home[1], None if other is None else other[1], limits):
        root = hooked(root, i, j if other is None else j + len(home[0]))
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["u", "v"])


def _linked(limits: Callable[[int], tuple[int, ...]], width: int):
    """Compare each home tile with itself and with the tiles sent to it; rows come sorted by tile, home first."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Runs of rows of one tile, home or not, and of no more than 4 * TILE fingerprints; copies, so that no tile holds a batch."""
        for batch in batches:
            cells, tiles, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "tile", "own"))
            turns = np.flatnonzero((cells[1:] != cells[:-1]) | (tiles[1:] != tiles[:-1]) | (own[1:] != own[:-1])) + 1
            lists = [(batch.column(c), by) for c, by in (("nodes", 1), ("fps", width)) if c in batch.schema.names]
            ends = [x.offsets.to_numpy() for x, _ in lists]
            values = [x.values.to_numpy(zero_copy_only=False) for x, _ in lists]
            for lo, hi in zip([0, *turns], [*turns, len(cells)], strict=True):
                for k in range(0, (ends[-1][hi] - ends[-1][lo]) // width, 4 * TILE):
                    taken = [v[e[lo] + by * k : min(e[hi], e[lo] + by * (k + 4 * TILE))].copy() for v, e, (_, by) in zip(values, ends, lists, strict=True)]
                    yield int(cells[lo]), int(tiles[lo]), bool(own[lo]), taken[0], np.ascontiguousarray(taken[-1].view(np.uint64).reshape(-1, width).T)

    def joined(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (cell, _), parts in itertools.groupby(pieces(batches), key=lambda p: p[:2]):
            most, home, waiting, n = limits(cell), None, [], 0
            for own, more in itertools.groupby(parts, key=lambda p: p[2]):
                if own:
                    home = joined(list(more))
                    yield _forest(home, None, most)
                elif home is not None:  # else no row fell into this tile
                    for part in more:
                        waiting.append(part)
                        n += len(part[3])
                        if n >= 4 * TILE:
                            yield _forest(home, joined(waiting), most)
                            waiting, n = [], 0
            if waiting:
                yield _forest(home, joined(waiting), most)

    return run


def _tile_links(tiles: DataFrame, targets: DataFrame, limits: Callable[[int], tuple[int, ...]], width: int = 1) -> DataFrame:
    """Links (u, v) that connect all near pairs within a tile and of a tile and each of its targets (cell, tile, to_cell, to_tile).

    tiles: cell, tile, fps (the words of fingerprints one after the other), and nodes if these aren't the fingerprints themselves.
    """
    lists = [c for c in tiles.columns if c in ("fps", "nodes")]
    sent = targets.hint("merge").join(tiles, ["cell", "tile"]).select(F.col("to_cell").alias("cell"), F.col("to_tile").alias("tile"), F.lit(False).alias("own"), *lists)
    homes = tiles.select("cell", "tile", F.lit(True).alias("own"), *lists)
    return (
        homes.union(sent)
        .repartition(F.col("cell"), F.col("tile"))
        .sortWithinPartitions("cell", "tile", F.col("own").desc())
        .mapInArrow(_linked(limits, width), "u bigint, v bigint")
    )


def set_links(nodes: DataFrame, scratch: Scratch, limits: Callable[[int], tuple[int, ...]], shared: int, of: int, words: int = 4, tile: int = SET_TILE) -> DataFrame:
    """Edges (u, v) that connect all pairs of sets with near fingerprints whose sizes agree in `shared` of `of` or more.

    nodes: columns node, n (size of the set), cell (its size class) and fps (its fingerprint). Sets that share less of their
    sizes can't be as similar, so tiles are compared only if the sizes of their classes allow it, and then every pair is.
    limits: what the pairs of a cell with its own and lower cells may differ in, as _close takes it.
    """
    counted = nodes.groupBy("cell").agg(F.count("*").alias("rows"), F.min("n").alias("least"), F.max("n").alias("most"))
    cells = scratch.keep(counted.withColumn("tiles", F.ceil(F.col("rows") / tile).cast("int")))
    parts = cells.select("cell", "tiles", F.ceil(F.col("rows") / F.col("tiles") / ROW).alias("parts"))
    tiles = scratch.keep(
        nodes.join(parts, "cell")
        .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")))
        .groupBy("cell", "tile", "part")
        .agg(F.collect_list(F.struct("node", "fps")).alias("rows"))
        .select("cell", "tile", F.col("rows.node").alias("nodes"), F.flatten("rows.fps").alias("fps"))
    )
    higher = cells.select(F.col("cell").alias("to_cell"), F.col("least").alias("to_least"), F.col("tiles").alias("to_tiles"))
    targets = (
        cells.select("cell", "most", "tiles")
        .join(F.broadcast(higher), F.expr(f"to_cell >= cell and {shared} * to_least <= {of} * most"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("to_tile", F.explode(F.sequence(F.lit(0), F.col("to_tiles") - 1)))
        .where("cell < to_cell or tile < to_tile")
        .select("cell", "tile", "to_cell", "to_tile")
    )
    return _tile_links(tiles, targets, limits, words)


def near_links(fps: DataFrame, scratch: Scratch, radius: int = 3, words: int = 4, tile: int = TILE) -> DataFrame:
    """Edges (u, v) between fingerprints that connect all pairs of different ones within the radius.

    fps: distinct bigints in column fp. A cell is the vector of population counts of the fingerprint's words. Each differing
    bit changes one count by one, so only tiles of cells whose counts differ by the radius at most in sum are compared; all
    others are skipped. A cell with many fingerprints has several tiles. Tiles send their rows to the tiles they are compared
    with, and of the links found there only a spanning forest goes on.
    """
    width = 64 // words
    mask = (1 << width) - 1
    # room for the radius on both sides keeps neighbours of border cells apart
    base = 1 << (width + 2 * radius + 1).bit_length()
    code = F.lit(0).cast("bigint")
    for w in range(words):
        part = F.shiftrightunsigned("fp", w * width).bitwiseAND(F.lit(mask).cast("bigint"))
        code = code + (F.bit_count(part) + radius).cast("bigint") * base**w
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=words) if sum(map(abs, s)) <= radius]
    offsets = sorted(o for o in (sum(x * base**w for w, x in enumerate(s)) for s in steps) if o >= 0)
    cells = fps.select("fp", code.alias("cell"))
    sizes = scratch.keep(cells.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles")))
    tiles = scratch.keep(
        cells.join(sizes, "cell")
        .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .groupBy("cell", "tile")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    )
    ids = tiles.select("cell", "tile", F.explode(F.array(*[F.lit(o).cast("bigint") for o in offsets])).alias("step"))
    targets = (
        ids.withColumn("to_cell", F.col("cell") + F.col("step"))
        .join(sizes.select(F.col("cell").alias("to_cell"), "tiles"), "to_cell")
        .withColumn("to_tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .where("step <> 0 or to_tile < tile")
        .select("cell", "tile", "to_cell", "to_tile")
    )
    return _tile_links(tiles, targets, lambda _: (radius,))


def simhash_components(docs: DataFrame, radius: int = 3, shingle: int = 3, words: int = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id, group_size, kept) and the columns named in carry, one for each row of docs.

    docs: columns doc_id, text and those in carry; others are not read. Null and empty texts have fingerprint zero and link
    like any other. A text with fewer words than a shingle is one shingle. Equal fingerprints are one node, so copies cost
    nothing. Repeated rows come out as often as they went in; component_id is the smallest doc_id that is not null (null if
    there is none). kept marks the first row of a component by doc_id, nulls last, then fingerprint, then carried columns;
    rows that agree in all of these are all marked. An empty table gives no rows. words=8 makes the cells finer, for 1e9
    fingerprints and more; the result is the same.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.keep(fingerprints(docs.select("doc_id", "text", *carry), shingle))
    distinct = scratch.keep(marked.select("fp").distinct())
    roots = connected(near_links(distinct, scratch, radius, words), scratch).withColumnRenamed("node", "fp")
    nodes = marked.join(roots, "fp", "left").select("doc_id", "fp", *carry, F.coalesce("root", "fp").alias("root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", *carry)).alias("first")
    groups = scratch.keep(nodes.groupBy("root").agg(first, F.count("*").alias("group_size")))
    same = F.lit(True)
    for c in ("doc_id", "fp", *carry):
        same = same & F.col(c).eqNullSafe(F.col(f"first.{c}"))
    return nodes.join(groups, "root").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        "group_size",
        same.alias("kept"),
        *carry,
    )
