"""FeatureCollections cut into byte ranges, so that one document is read by many tasks.

Spark's text reader splits a file at any place if the line separator is a closing brace.  A range then
begins just behind a brace, maybe inside quotes and at an unknown depth of brackets.  A first pass reports
for each range, for both cases, where it would end; put together in the order of the ranges that gives
what each begins with.  A second pass cuts out the features; those that lie across ranges come as fragments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BRACE, _QUOTE, _BACKSLASH, _LIST = b"}", ord('"'), ord("\\"), ord("[")
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_MARK = _STEP != 0
_MARK[[_QUOTE, _BACKSLASH]] = True
_FEATURES = re.compile(rb'"features"\s*:\s*\Z')
_COLLECTION = re.compile(rb'"type"\s*:\s*"FeatureCollection"')
_CRS = re.compile(rb'"crs"\s*:\s*\{[^{}]*\{[^{}]*"name"\s*:\s*"([^"]*)"')
#: Bytes that are looked at together.
_RUN_BYTES = 4 << 20
#: Room for the name of a member and what stands between it and its list.
_NAME_BYTES = 256


@dataclass
class Range:
    """What a range begins with: place in the file, inside quotes or not, depth of brackets, in the list of features."""

    start: int
    inside: int
    depth: int
    listed: bool


@dataclass
class Document:
    """A file, named as the scan names it: its ranges, whether it has a collection's type and list, how many values, and the name of the coordinate system."""

    file: str
    ranges: list[Range] = field(default_factory=list)
    typed: bool = False
    listed: bool = False
    closed: bool = False
    values: int = 0
    crs: str | None = None

    @property
    def path(self) -> str:
        return unquote(self.file)

    @property
    def collection(self) -> bool:
        return self.typed and self.listed and self.closed and self.values == 1


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    text = spark.read.option("lineSep", _BRACE.decode()).text(path)
    return text.select(*place, F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, bytes]]:
    """(file, start), size of the file and bytes of runs of rows of one range, a few megabytes each."""
    files, starts = batch.column("file").to_pylist(), batch.column("start").to_pylist()
    pieces, begin, size = batch.column("piece"), 0, 0
    lengths = pc.binary_length(pieces).to_pylist()
    for i in range(1, len(batch) + 1):
        size += lengths[i - 1]
        if i == len(batch) or size > _RUN_BYTES or (files[i], starts[i]) != (files[begin], starts[begin]):
            text = _BRACE.join(pieces.slice(begin, i - begin).to_pylist()) + _BRACE
            yield (files[begin], starts[begin]), batch.column("size")[begin].as_py(), text
            begin, size = i, 0


class _Marks:
    """Places of the brackets and quotes of a text; quotes that a backslash takes away don't count."""

    def __init__(self, text: bytes):
        data = np.frombuffer(text, np.uint8)
        self.at = np.flatnonzero(_MARK[data])
        marks = data[self.at]
        self.step = _STEP[marks]
        quotes = marks == _QUOTE
        slashes = marks == _BACKSLASH
        if slashes.any():
            # an odd run of backslashes right in front
            follows = np.concatenate([[False], np.diff(self.at) == 1])
            goes_on = slashes & follows & np.concatenate([[False], slashes[:-1]])
            place = np.arange(len(marks))
            begin = np.maximum.accumulate(np.where(goes_on, 0, place))
            odd = slashes & ((place - begin) % 2 == 0)
            quotes &= ~(follows & np.concatenate([[False], odd[:-1]]))
        self.inside = np.cumsum(quotes) & 1
        self.turns = int(self.inside[-1]) if len(self.inside) else 0

    def steps(self, inside: int) -> np.ndarray:
        """+1 and -1 for brackets outside quotes."""
        return np.where(self.inside ^ inside, 0, self.step)


def _opens_features(text: bytes, at: int) -> bool:
    return text[at] == _LIST and _FEATURES.search(text, max(0, at - _NAME_BYTES), at) is not None


class _Course:
    """What a stretch of text does to the depth, if it begins outside (0) or inside (1) of quotes."""

    def __init__(self, text: bytes):
        marks = _Marks(text)
        self.turns = marks.turns
        self.typed = _COLLECTION.search(text) is not None
        # neither match has a closing brace, so none lies across two stretches
        named = [(m.start(), m.group(1).decode(errors="replace")) for m in _CRS.finditer(text)] if b'"crs"' in text else []
        self.depth, self.lowest, self.opens, self.names = [], [], [], []
        for inside in (0, 1):
            step = marks.steps(inside)
            depth = np.cumsum(step, dtype=np.int64)
            opened = np.flatnonzero(step > 0)[::-1]
            depths, last, times = np.unique(depth[opened], return_index=True, return_counts=True)
            self.depth.append(int(depth[-1]))
            self.lowest.append(min(0, int(depth.min())))
            # how often each depth is reached, and whether the last bracket that does opens the features
            opens = zip(depths.tolist(), times.tolist(), marks.at[opened[last]].tolist(), strict=True)
            self.opens.append({d: (n, _opens_features(text, at)) for d, n, at in opens})
            self.names.append({int(depth[np.searchsorted(marks.at, at)]): name for at, name in reversed(named)})

    def extend(self, more: _Course) -> None:
        for i in (0, 1):
            j, shift = (i + self.turns) & 1, self.depth[i]
            self.lowest[i] = min(self.lowest[i], shift + more.lowest[j])
            for d, (times, listed) in more.opens[j].items():
                self.opens[i][d + shift] = (self.opens[i].get(d + shift, (0, False))[0] + times, listed)
            for d, name in more.names[j].items():
                self.names[i].setdefault(d + shift, name)
            self.depth[i] += more.depth[j]
        self.turns ^= more.turns
        self.typed |= more.typed


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each range."""
    key, size, length, course = None, 0, 0, None

    def row() -> pa.RecordBatch:
        cases = [
            {
                "depth": course.depth[i], "lowest": course.lowest[i],
                "opens": [{"depth": d, "times": n, "listed": listed} for d, (n, listed) in course.opens[i].items()],
                "names": [{"depth": d, "name": name} for d, name in course.names[i].items()],
            }
            for i in (0, 1)
        ]
        whole = {"file": key[0], "start": key[1], "size": size, "length": length, "turns": course.turns, "typed": course.typed}
        return pa.RecordBatch.from_pylist([whole | {"cases": cases}], schema=_SUMMARY)

    for batch in batches:
        for now, total, text in _runs(batch):
            if now != key:
                if key is not None:
                    yield row()
                key, size, length, course = now, total, len(text), _Course(text)
            else:
                length += len(text)
                course.extend(_Course(text))
    if key is not None:
        yield row()


_OPENS = pa.list_(pa.struct([("depth", pa.int64()), ("times", pa.int64()), ("listed", pa.bool_())]))
_NAMES = pa.list_(pa.struct([("depth", pa.int64()), ("name", pa.string())]))
_CASES = pa.list_(pa.struct([("depth", pa.int64()), ("lowest", pa.int64()), ("opens", _OPENS), ("names", _NAMES)]))
_SUMMARY = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("length", pa.int64()), ("turns", pa.int32()), ("typed", pa.bool_()), ("cases", _CASES)]
)
_SUMMARY_DDL = (
    "file string, start bigint, size bigint, length bigint, turns int, typed boolean, cases array<struct<depth:bigint,lowest:bigint,"
    "opens:array<struct<depth:bigint,times:bigint,listed:boolean>>,names:array<struct<depth:bigint,name:string>>>>"
)


def documents(spark: SparkSession, path: str | list[str]) -> list[Document]:
    """What the ranges of each file begin with.

    Collected is one short row for each range, of which the driver holds one as well when it plans the scan.
    """
    found: list[Document] = []
    rows = _pieces(spark, path).mapInArrow(_summaries, _SUMMARY_DDL).collect()
    for row in sorted(rows, key=lambda r: (r.file, r.start)):
        if not found or found[-1].file != row.file:
            found.append(Document(row.file))
            depth, inside, listed, length, sound = 0, 0, False, 0, True
        document, case = found[-1], row.cases[inside]
        document.ranges.append(Range(row.start, inside, depth, listed))
        length += row.length
        # the text reader takes a byte order mark away; no brace stands behind the last piece if a byte is too much
        missing = length - row.size in (1, -2)
        sound &= depth + case.lowest >= -missing
        document.typed |= row.typed
        for opened in case.opens:
            if depth + opened.depth == 1:
                document.values += opened.times
            if depth + opened.depth == 2:
                listed = opened.listed
                document.listed |= listed
        for named in case.names:
            if depth + named.depth == 1:
                document.crs = document.crs or named.name
        depth += case.depth
        inside ^= row.turns
        document.closed = sound and inside == 0 and depth + missing == 0
    return found


_WHOLE, _HEAD, _TAIL = 0, 1, 2


def _cut(states: dict[tuple[str, int], Range]):
    """Texts of features, and fragments of those that begin or end in another range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, waiting, kind = None, None, None, _WHOLE

        def left() -> list[tuple]:
            """The feature that is still open at the end of its range: its beginning, or nothing but a middle."""
            return [(*key, _HEAD if kind == _HEAD else _TAIL, b"".join(waiting))] if waiting is not None else []

        for batch in batches:
            out: list[tuple] = []
            for now, _, text in _runs(batch):
                if now != key:
                    out += left()
                    key, known = now, states[now]
                    state = Range(known.start, known.inside, known.depth, known.listed)
                    cut = state.listed and state.depth > 2
                    waiting, kind = ([], _HEAD) if cut else (None, _WHOLE)
                marks = _Marks(text)
                step = marks.steps(state.inside)
                depth = state.depth + np.cumsum(step, dtype=np.int64)
                lists = np.flatnonzero((step > 0) & (depth == 2))
                listed = np.array([state.listed] + [_opens_features(text, int(a)) for a in marks.at[lists]])
                begins = np.flatnonzero((step > 0) & (depth == 3))
                begins = begins[listed[np.searchsorted(lists, begins)]]
                ends = np.flatnonzero((step < 0) & (depth == 2))
                last = np.searchsorted(ends, begins)
                begins, ends = marks.at[begins], marks.at[ends]
                if waiting is not None:
                    stop = int(ends[0]) + 1 if len(ends) else len(text)
                    waiting.append(text[:stop])
                    if len(ends):
                        out.append((*key, kind, b"".join(waiting)))
                        waiting = None
                for a, e in zip(begins.tolist(), last.tolist(), strict=True):
                    if e < len(ends):
                        out.append((*key, _WHOLE, text[a : int(ends[e]) + 1]))
                    else:
                        waiting, kind = [text[a:]], _WHOLE
                state.depth, state.listed = int(depth[-1]), bool(listed[-1])
                state.inside ^= marks.turns
            if out:
                yield _rows(out)
        if key is not None and left():
            yield _rows(left())

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    files, starts, kinds, texts = zip(*out, strict=True)
    columns = [pa.array(files, pa.string()), pa.array(starts, pa.int64()), pa.array(kinds, pa.int32()), pa.array(texts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["file", "start", "kind", "value"])


def feature_texts(spark: SparkSession, known: list[Document]) -> DataFrame:
    """One row ``value`` for each member of the features lists, as it stands in the file."""
    states = {(d.file, r.start): r for d in known for r in d.ranges}
    cut = _pieces(spark, [d.path for d in known]).mapInArrow(_cut(states), "file string, start bigint, kind int, value binary")
    # a few fragments for each range: a feature is its beginning and the fragments up to the next beginning
    order = Window.partitionBy("file").orderBy("start", "kind")
    numbered = cut.where(F.col("kind") != _WHOLE).withColumn("feature", F.count_if(F.col("kind") == _TAIL).over(order))
    joined = numbered.groupBy("file", "feature").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "value"))).alias("parts"))
    glued = joined.select(F.expr("aggregate(parts, cast('' as binary), (text, p) -> concat(text, p.value))").alias("value"))
    return cut.where(F.col("kind") == _WHOLE).select("value").union(glued).select(F.col("value").cast("string").alias("value"))
