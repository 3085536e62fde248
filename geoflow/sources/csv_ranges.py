"""Delimited files with line breaks inside quotes, read in byte ranges.

Spark's text reader splits a file at line ends, but a line may begin inside quotes.  A first pass reports for
each range how it would end if it began outside and if it began inside of quotes; put together in the order
of the ranges that gives what each begins with.  A second pass joins lines to records; records that lie across
ranges come as fragments.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Encodings in which the bytes of separators, quotes and line ends mean nothing else.
ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII")


@dataclass
class File:
    """A file, named as the scan names it: whether each range begins inside quotes, the first record, and how it ends."""

    file: str
    ranges: dict[int, int] = field(default_factory=dict)
    header: bytes | None = None
    open: bool = False

    @property
    def path(self) -> str:
        return unquote(self.file)


class _Lines:
    """Whether a line ends inside quotes. A quote opens a value only where the value begins, and is doubled inside."""

    def __init__(self, delimiter: str):
        d = re.escape(delimiter.encode())
        other = rb"[^%s]*+" % d if len(delimiter) == 1 else rb"(?:(?!%s).)*+" % d
        body = rb'(?:[^"]++|"")*+'
        opened = rb'(?:(?:"%s"%s|(?!")%s)%s)*+"%s\Z' % (body, other, other, d, body)
        self._outside = re.compile(opened, re.DOTALL)
        self._inside = re.compile(rb'%s(?:\Z|"%s%s%s)' % (body, other, d, opened), re.DOTALL)

    def ends_inside(self, line: bytes, inside: int) -> int:
        if b'"' not in line:
            return inside
        return int((self._inside if inside else self._outside).match(line) is not None)


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    return spark.read.option("lineSep", "\n").text(path).select(*place, F.col("value").cast("binary").alias("line"))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    for batch in batches:
        places = zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True)
        yield from zip(places, batch.column("line").to_pylist(), strict=True)


def _summaries(delimiter: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, key, ends, header, waiting = _Lines(delimiter), None, [0, 1], None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"file": key[0], "start": key[1], "ends": ends, "header": header}], schema=_SUMMARY)

        for place, line in _lines(batches):
            if place != key:
                if key is not None:
                    yield row()
                key, ends, header, waiting = place, [0, 1], None, []
            ends = [kind.ends_inside(line, e) for e in ends] if b'"' in line else ends
            if place[1] == 0 and header is None:
                waiting.append(line)
                header = None if ends[0] else b"\n".join(waiting)
        if key is not None:
            yield row()

    return run


_SUMMARY = pa.schema([("file", pa.string()), ("start", pa.int64()), ("ends", pa.list_(pa.int32())), ("header", pa.binary())])


def files(spark: SparkSession, path: str | list[str], delimiter: str) -> list[File]:
    """What the ranges of each file begin with. Collected is one short row for each range, as when a scan is planned."""
    rows = _pieces(spark, path).mapInArrow(_summaries(delimiter), "file string, start bigint, ends array<int>, header binary").collect()
    found: list[File] = []
    for row in sorted(rows, key=lambda r: (r.file, r.start)):
        if not found or found[-1].file != row.file:
            found.append(File(row.file, header=None if row.header is None else bytes(row.header)))
        one = found[-1]
        one.ranges[row.start] = int(one.open)
        one.open = bool(row.ends[one.open])
    return found


_WHOLE, _REST, _BEGIN = 0, 1, 2
#: Records that go on together.
_ROWS = 4096


def _joined(states: dict[tuple[str, int], int], delimiter: str, header: bool):
    """Records of each range without the header, and fragments of those that begin or end in another range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, key, inside, part, waiting, out = _Lines(delimiter), None, 0, _WHOLE, [], []
        skip = False
        for place, line in _lines(batches):
            if place != key:
                if waiting:
                    out.append((*key, _REST if part == _REST else _BEGIN, b"\n".join(waiting)))
                key, inside, waiting = place, states[place], []
                part, skip = _REST if inside else _WHOLE, header and place[1] == 0
            waiting.append(line)
            inside = kind.ends_inside(line, inside)
            if not inside:
                if not skip:
                    out.append((*key, part, b"\n".join(waiting).removesuffix(b"\r")))
                waiting, part, skip = [], _WHOLE, False
            if len(out) >= _ROWS:
                yield _rows(out)
                out = []
        if waiting:
            out.append((*key, _REST if part == _REST else _BEGIN, b"\n".join(waiting)))
        if out:
            yield _rows(out)

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int32(), pa.binary()), strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["file", "start", "part", "value"])


def record_texts(spark: SparkSession, known: list[File], delimiter: str, header: bool, encoding: str) -> DataFrame:
    """One row ``value`` for each record; empty lines are none."""
    states = {(f.file, start): inside for f in known for start, inside in f.ranges.items()}
    cut = _pieces(spark, [f.path for f in known]).mapInArrow(
        _joined(states, delimiter, header), "file string, start bigint, part int, value binary"
    )
    # at most two fragments for each range: a record is its beginning and the rests up to the next beginning
    order = Window.partitionBy("file").orderBy("start", "part")
    numbered = cut.where(F.col("part") != _WHOLE).withColumn("record", F.count_if(F.col("part") == _BEGIN).over(order))
    joined = numbered.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "part", "value"))).alias("parts"))
    # the line ends between ranges come back
    whole = "aggregate(parts, cast(null as binary), (text, p) -> if(text is null, p.value, concat(text, X'0A', p.value)))"
    glued = joined.select(F.expr(whole).alias("value"))
    texts = cut.where(F.col("part") == _WHOLE).select("value").union(glued)
    text = F.col("value").cast("string") if encoding.upper() == "UTF-8" else F.decode("value", encoding)
    return texts.select(text.alias("value")).where("value <> ''")
