"""Packing documents into sequences of several permitted lengths by variable-capacity best fit."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096)
#: Every sequence costs as much as so many words besides its length.
OVERHEAD = 16
#: Words that one shard holds about; a shard is packed on its own, in one task's memory.
SHARD_WORDS = 1_000_000


class _Remaining:
    """Lengths not yet placed, as counts of different lengths."""

    def __init__(self, lengths: list[int]):
        self.count: dict[int, int] = {}
        for x in lengths:
            self.count[x] = self.count.get(x, 0) + 1
        self.sizes = sorted(self.count)

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.count[length]
            self.sizes.pop(bisect_left(self.sizes, length))

    def filling(self, room: int) -> int:
        """Words that fit into the room if the longest that fits always goes first."""
        filled, used = 0, {}
        at = bisect_right(self.sizes, room) - 1
        while at >= 0:
            x = self.sizes[at]
            n = min((room - filled) // x, self.count[x] - used.get(x, 0))
            if n > 0:
                used[x] = used.get(x, 0) + n
                filled += n * x
            at = min(at - 1, bisect_right(self.sizes, room - filled) - 1)
        return filled


def best_fit(lengths: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> list[tuple[int, list[int]]]:
    """Bins (capacity, places of their items), items by decreasing length.

    An item goes to the open bin that it leaves least room in. If it fits none, a bin is opened, of the capacity that costs
    least for each word when it is filled up with what is left. In the end every bin shrinks to the smallest capacity that
    holds its contents. No item may be longer than the largest capacity.
    """
    capacities = tuple(sorted(capacities))
    remaining = _Remaining(lengths)
    bins: list[list[int]] = []
    used: list[int] = []
    rooms: list[tuple[int, int]] = []  # room left and bin, sorted
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        length = lengths[item]
        remaining.take(length)
        at = bisect_left(rooms, (length, -1))
        if at < len(rooms):
            room, place = rooms.pop(at)
        else:
            fitting = [c for c in capacities if c >= length]
            room = min(fitting, key=lambda c: ((c + overhead) / (length + remaining.filling(c - length)), -c))
            place = len(bins)
            bins.append([])
            used.append(0)
        bins[place].append(item)
        used[place] += length
        if room > length:
            insort(rooms, (room - length, place))
    return [(capacities[bisect_left(capacities, n)], items) for n, items in zip(used, bins, strict=True)]


def _packed(capacities: tuple[int, ...], overhead: int, shard_words: int):
    longest = max(capacities)

    def sequences(shard: int, part: int, docs: list[tuple[int, list[bytes]]]) -> pa.RecordBatch:
        pieces = [(d, at) for d, (_, words) in enumerate(docs) for at in range(0, len(words), longest)]
        lengths = [min(longest, len(docs[d][1]) - at) for d, at in pieces]
        out: dict[str, list] = {f.name: [] for f in _SCHEMA}
        for number, (capacity, items) in enumerate(best_fit(lengths, capacities, overhead)):
            out["shard"].append(shard)
            out["part"].append(part)
            out["bin"].append(number)
            out["capacity"].append(capacity)
            out["n_words"].append(sum(lengths[i] for i in items))
            out["doc_ids"].append([docs[pieces[i][0]][0] for i in items])
            out["starts"].append([pieces[i][1] for i in items])
            out["lengths"].append([lengths[i] for i in items])
            out["text"].append("\n".join(b" ".join(docs[pieces[i][0]][1][pieces[i][1] : pieces[i][1] + lengths[i]]).decode() for i in items))
        return pa.RecordBatch.from_pydict(out, _SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, part, docs, held = None, 0, [], 0
        for batch in batches:
            ids, shards = batch.column("doc_id").to_pylist(), batch.column("shard").to_pylist()
            for shard, doc_id, text in zip(shards, ids, batch.column("text").cast(pa.binary()), strict=True):
                if docs and (shard != current or held >= 2 * shard_words):
                    yield sequences(current, part, docs)
                    part = part + 1 if shard == current else 0
                    docs, held = [], 0
                elif shard != current:
                    part = 0
                current = shard
                words = (text.as_py() or b"").split()
                if words:
                    docs.append((doc_id, words))
                    held += len(words)
        if docs:
            yield sequences(current, part, docs)

    return run


_SCHEMA = pa.schema(
    [
        ("shard", pa.int64()), ("part", pa.int32()), ("bin", pa.int32()), ("capacity", pa.int32()), ("n_words", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())), ("text", pa.string()),
    ]
)
_ROWS = (
    "shard bigint, part int, bin int, capacity int, n_words int, doc_ids array<bigint>, starts array<int>, lengths array<int>, text string"
)


def packed_sequences(
    docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Rows (shard, part, bin, capacity, n_words, doc_ids, starts, lengths, text), one for each sequence.

    Documents are dealt out by a hash to shards of about a million words, and each shard is packed on its own; at that size
    its last bins weigh nothing. A shard that gets more than twice as much, as repeated rows can make it, is packed in parts.
    A document longer than the largest capacity is cut into pieces of that length. text has the pieces of a sequence on a line
    each, words joined by spaces; starts and lengths say which words of doc_ids they are.

    docs: columns doc_id, text; others are not read. Null, empty and blank texts have no words and are in no sequence. Ties in
    length go by the order of the hash. Repeated rows are documents of their own. An empty table gives no rows.
    """
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    shards = total // 6 // shard_words + 1
    hashed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("key"))
    dealt = hashed.withColumn("shard", F.pmod("key", F.lit(shards).cast("bigint")))
    return (
        dealt.repartition(F.col("shard"))
        .sortWithinPartitions("shard", "key", "doc_id")
        .select("shard", "doc_id", "text")
        .mapInArrow(_packed(tuple(capacities), overhead, shard_words), _ROWS)
    )
