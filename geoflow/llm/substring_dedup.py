"""Substring deduplication by Relative Lempel-Ziv parsing against a distributed index of all documents."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .wordbytes import mixed, slices, sorted_order, split_words, word_hashes

WINDOW = 13
#: Seeds that one block of the index holds about, in one task's memory.
BLOCK_SEEDS = 2_000_000
#: The index is made in so many parts, one after the other, so that only a part of all seeds is on disk at once.
PARTS = 2
_NO_ID = np.iinfo(np.int64).max
#: A seed of a document that a document with a smaller id has too: whose, where, and where it was seen.
_MATCH = np.dtype([("doc", "<i8"), ("key", "<u4"), ("pos", "<i4"), ("ref_start", "<i4"), ("ref", "<i8")])
#: Bytes of text whose documents get their matches together.
GROUP_BYTES = 4 << 20
_MULTIPLIERS = np.random.Generator(np.random.PCG64(13))
_ODD = _MULTIPLIERS.integers(0, 2**63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)
_CHECK_ODD = _MULTIPLIERS.integers(0, 2**63, 4096, np.uint64) * np.uint64(2) + np.uint64(1)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight together: those of sorted or small numbers then compress to little."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_planes(data: memoryview, n: int, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width).reshape(width, n).T).reshape(-1).view(dtype)


def _packed(docs: tuple[np.ndarray, ...], seeds: np.ndarray, checks: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> bytes:
    head = np.array([len(docs[0]), len(seeds)], "<i4").tobytes()
    return head + b"".join(map(_planes, (*docs, seeds, checks, doc.astype("<i4"), pos.astype("<i4"))))


def _unpacked(data: bytes) -> tuple[np.ndarray, ...]:
    n_docs, n = np.frombuffer(data, "<i4", 2).tolist()
    view, at, out = memoryview(data), 8, []
    for count, dtype in ((n_docs, "<i8"), (n_docs, "<u4"), (n_docs, "<i4"), (n, "<u8"), (n, "<u4"), (n, "<i4"), (n, "<i4")):
        out.append(_from_planes(view[at:], count, dtype))
        at += count * np.dtype(dtype).itemsize
    return tuple(out)


def _runs(seeds: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of seeds and checks, and where another passage begins in it."""
    order = sorted_order(seeds)
    other_seed = np.diff(seeds[order]) != 0
    other = other_seed | (np.diff(checks[order]) != 0)
    if np.any(other & ~other_seed):  # passages that agree in the seed alone
        order = np.lexsort((checks, seeds))
        other = (np.diff(seeds[order]) != 0) | (np.diff(checks[order]) != 0)
    return order, np.concatenate([[True], other])


def _found(docs: tuple[np.ndarray, ...], doc: np.ndarray, pos: np.ndarray, ref: np.ndarray, ref_start: np.ndarray) -> pa.RecordBatch:
    """Matches in one row for each group of documents. docs: their ids, keys and groups."""
    ids, keys, groups = docs
    order = np.lexsort((pos, doc, groups[doc]))
    doc = doc[order]
    matches = np.empty(len(order), _MATCH)
    matches["doc"], matches["key"], matches["pos"] = ids[doc], keys[doc], pos[order]
    matches["ref"], matches["ref_start"] = ref[order], ref_start[order]
    group = groups[doc]
    begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    data = [matches[a:b].tobytes() for a, b in zip(begins, [*begins[1:], len(matches)], strict=True)]
    return _rows(group[begins], group[begins], data)


def _rows(block: np.ndarray, group: np.ndarray | None, data: list[bytes]) -> pa.RecordBatch:
    groups = pa.nulls(len(data), pa.int32()) if group is None else pa.array(group, pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), groups, pa.array(data, pa.binary())], ["block", "grp", "data"])


def _seeds(window: int, blocks: int, part: int, parts: int):
    """Seeds of each run of documents, by block of the index.

    A seed that several documents of the run share goes to the index once, for the smallest id; the others have their match
    at once. So a passage that very many documents share costs one row a run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            ids = rows.column("doc_id").fill_null(_NO_ID).to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            docs = (ids, rows.column("key").to_numpy()[order].astype(np.uint32), rows.column("grp").to_numpy()[order])
            words = split_words([texts[i] for i in order])
            hashes = word_hashes(words)
            counts = np.maximum(np.diff(words.first) - window + 1, 0)
            begins = np.cumsum(counts) - counts
            doc = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
            pos = np.arange(len(doc)) - begins[doc]
            at = words.first[doc] + pos
            seeds, checks = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
            for j in range(window):
                word = hashes[at + j]
                seeds += word * _ODD[j]
                checks += word * _CHECK_ODD[j]
            seeds, checks = mixed(seeds), (checks >> np.uint64(32)).astype(np.uint32)
            if parts > 1:
                mine = np.flatnonzero(seeds % np.uint64(parts) == part)
                seeds, checks, doc, pos = seeds[mine], checks[mine], doc[mine], pos[mine]
            if not len(seeds):
                continue
            order, new = _runs(seeds, checks)
            seeds, checks, doc, pos = seeds[order], checks[order], doc[order], pos[order]
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            here = ids[doc] > ids[doc[first]]
            if here.any():
                yield _found(docs, doc[here], pos[here], ids[doc[first[here]]], pos[first[here]])
            seeds, checks, doc, pos = seeds[~here], checks[~here], doc[~here], pos[~here]
            block = ((seeds >> np.uint64(40)) * np.uint64(blocks)) >> np.uint64(24)
            cuts = np.searchsorted(block, np.arange(blocks + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(cuts))
            yield _rows(full, None, [_packed(docs, seeds[a:b], checks[a:b], doc[a:b], pos[a:b]) for a, b in zip(cuts[full], cuts[full + 1], strict=True)])

    return run


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of all seeds of each index block; rows come sorted by block, those that are matches already pass."""

    def matches(block: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        base = np.cumsum([0] + [len(x[0]) for x in block])
        ids, keys, groups, seeds, checks = (np.concatenate([x[k] for x in block]) for k in range(5))
        doc = np.concatenate([x[5] + b for x, b in zip(block, base, strict=False)])
        pos = np.concatenate([x[6] for x in block])
        order, new = _runs(seeds, checks)
        several = ~(new & np.append(new[1:], True))
        order, new = order[several], new[several]
        if not len(order):
            return
        doc, pos = doc[order], pos[order]
        begins = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        lowest = np.minimum.reduceat(ids[doc], begins)
        ref_start = np.minimum.reduceat(np.where(ids[doc] == lowest[run], pos, np.iinfo(np.int32).max), begins)
        hit = ids[doc] > lowest[run]
        if hit.any():
            yield _found((ids, keys, groups), doc[hit], pos[hit], lowest[run[hit]], ref_start[run[hit]])

    current, block = None, []
    for batch in batches:
        blocks, groups, data = batch.column("block").to_numpy(), batch.column("grp"), batch.column("data")
        ready = groups.is_valid().to_numpy(zero_copy_only=False)
        if ready.any():
            yield batch.filter(pa.array(ready))
        for r in np.flatnonzero(~ready):
            if blocks[r] != current:
                if block:
                    yield from matches(block)
                current, block = blocks[r], []
            block.append(_unpacked(data[int(r)].as_py()))
    if block:
        yield from matches(block)


def _factors(hits: np.ndarray, n_words: int, window: int) -> tuple[np.ndarray, list[dict]]:
    """Which of the words no factor covers, and the factors."""
    hits = hits[np.concatenate([[True], np.diff(hits["pos"]) > 0])]
    # a factor goes on while the next word extends the match in the same place of the same document
    ends = (np.diff(hits["pos"]) != 1) | (np.diff(hits["ref"]) != 0) | (np.diff(hits["ref_start"]) != 1)
    begins = np.concatenate([[0], np.flatnonzero(ends) + 1])
    lasts = np.append(begins[1:], len(hits)) - 1
    # neighbouring factors overlap by what the windows across their boundary cover
    starts, stops = hits["pos"][begins], hits["pos"][lasts] + window
    covered = np.zeros(n_words + 1, np.int32)
    np.add.at(covered, starts, 1)
    np.add.at(covered, stops, -1)
    rows = zip(starts.tolist(), stops.tolist(), hits["ref"][begins].tolist(), hits["ref_start"][begins].tolist(), strict=True)
    return np.cumsum(covered[:-1]) == 0, [{"start": a, "length": b - a, "ref_doc_id": r, "ref_start": p} for a, b, r, p in rows]


def _parsed(window: int):
    """Greedy factors of each document, and its text without the words they cover; a group's matches come before its documents."""

    def by_document(data: list[bytes]) -> dict[tuple[int, int], np.ndarray]:
        matches = np.frombuffer(b"".join(data), _MATCH)
        matches = matches[np.lexsort((matches["pos"], matches["key"], matches["doc"]))]
        new = np.concatenate([[True], (np.diff(matches["doc"]) != 0) | (matches["key"][1:] != matches["key"][:-1])])
        begins = np.flatnonzero(new) if len(matches) else np.empty(0, np.int64)
        cuts = [*begins[1:], len(matches)]
        return {(int(matches["doc"][a]), int(matches["key"][a])): matches[a:b] for a, b in zip(begins, cuts, strict=False)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting, known = None, [], None
        for rows, texts in slices(batches):
            out: dict[str, list] = {"doc_id": [], "n_words": [], "n_removed": [], "kept_text": [], "factors": []}
            columns = (rows.column(c).to_pylist() for c in ("grp", "is_doc", "doc_id", "key", "data"))
            for text, group, is_doc, doc_id, key, data in zip(texts, *columns, strict=True):
                if group != current:
                    current, waiting, known = group, [], None
                if not is_doc:
                    waiting.append(data)
                    continue
                if known is None:
                    known, waiting = by_document(waiting), []
                words = text.split()
                n_words, factors = len(words), []
                hits = known.get((_NO_ID if doc_id is None else doc_id, key))
                if hits is not None:
                    stays, factors = _factors(hits, n_words, window)
                    words = list(compress(words, stays.tolist()))
                for name, value in zip(out, (doc_id, n_words, n_words - len(words), b" ".join(words), factors), strict=True):
                    out[name].append(value)
            kept = pa.array(out["kept_text"], pa.binary()).cast(pa.string())
            numbers = [pa.array(out[c], pa.int64()) for c in ("doc_id", "n_words", "n_removed")]
            yield pa.RecordBatch.from_arrays([*numbers, kept, pa.array(out["factors"], _FACTORS)], list(out))

    return run


_FACTORS = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ref_doc_id", pa.int64()), ("ref_start", pa.int32())]))


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW, block_seeds: int = BLOCK_SEEDS, parts: int = PARTS) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_text, factors), one for each row of docs.

    Words are runs of other bytes than ASCII white space. The reference is all documents: its index has a seed, the hash of
    `window` consecutive words, for every word of every document, in blocks that lie in one task each. A document is factored
    greedily against the whole index: a factor starts at a seed that a document with a smaller doc_id has as well, and goes on
    while the next seed continues the match in that place. Seeds across the end of a factor are looked up like all others, so
    a passage is found wherever factors end. The words of all factors are removed; seeds are taken from the input, not from
    what is left. factors: start, length, and where the first such passage was seen (word places).

    docs: columns doc_id, text; others are not read. Null and empty texts have no words. Texts shorter than the window keep
    all. A null doc_id counts as larger than all others. Rows with equal doc_id never remove words from each other; repeated
    rows come out as often as they went in. An empty table gives no rows. Passages are compared by 96 bits of two hashes of
    their words.
    """
    if window > len(_ODD):
        raise ValueError(f"window is at most {len(_ODD)} words")
    scratch = Scratch(docs.sparkSession, "rlz")
    # a word and its space have two bytes or more; six is usual, and the number only balances the blocks
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = max(1, min(size // 6 // parts // block_seeds + 1, 1 << 24))
    groups = min(size // GROUP_BYTES + 1, 1 << 30)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.crc32(F.coalesce("text", F.lit(""))).alias("key"))
    docs = docs.withColumn("grp", F.pmod(F.xxhash64("doc_id", "key"), F.lit(groups)).cast("int"))
    found = []
    for part in range(parts):
        seeds = docs.mapInArrow(_seeds(window, blocks, part, parts), "block int, grp int, data binary")
        hits = seeds.repartition(F.col("block")).sortWithinPartitions("block").mapInArrow(_looked_up, seeds.schema)
        found.append(scratch.keep(hits.select("grp", "data")))
    rows = docs.select("grp", F.lit(True).alias("is_doc"), "doc_id", "key", "text", F.lit(None).cast("binary").alias("data"))
    for matches in found:
        rows = rows.union(matches.selectExpr("grp", "false", "cast(null as bigint)", "cast(null as bigint)", "cast(null as string)", "data"))
    return (
        rows.repartition(F.col("grp"))
        .sortWithinPartitions("grp", "is_doc")
        .mapInArrow(
            _parsed(window),
            "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, factors array<struct<start:int,length:int,ref_doc_id:bigint,ref_start:int>>",
        )
    )
