"""Delimited text: profiling of many files at once, reading, writing."""

from __future__ import annotations

import csv
import io
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.layer import GEOM
from ..functions.text import best_separator, separator_counts
from . import csv_ranges, listing

SEPARATOR_LABELS = {";": "semicolon", "\t": "tab", "|": "pipe", ",": "comma"}
BOM = "\ufeff"


def profile_lines(first_lines: DataFrame, line: str) -> DataFrame:
    """Add the separator and its number of occurrences to rows that hold a header line."""
    counts = separator_counts(line)
    return first_lines.withColumn("separator", best_separator(line)).withColumn(
        "occurrences", F.coalesce(F.greatest(*counts.values()), F.lit(0)).cast("bigint")
    )


def profile_files(spark: SparkSession, path: str) -> DataFrame:
    """Per file: first line, separator, its occurrences and whether the bytes are valid UTF-8.

    The first line is the first row of the split that starts the file, found by a map-side
    combined minimum; lines do not travel.
    """
    place = F.struct(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.when(F.col("_metadata.file_block_start") == 0, place).alias("first"),
        F.is_valid_utf8("value").alias("utf8"),
    )
    files = lines.groupBy("file").agg(F.min("first").alias("first"), F.min("utf8").alias("utf8"))
    headed = files.select("file", F.coalesce(F.col("first.line"), F.lit("")).alias("header"), "utf8")
    return profile_lines(headed, "header")


def read_csv(
    spark: SparkSession,
    path: str,
    delimiter: str | None = None,
    encoding: str | None = None,
    header: bool = True,
    schema: str | None = None,
    multiline: bool | str = False,
) -> DataFrame:
    """Read one or many delimited files of the same shape.

    Without ``delimiter`` or ``encoding`` the files are profiled first: the separator is the most
    frequent candidate of the header lines, and files that are not valid UTF-8 are read as Latin-1.
    Where files of both encodings lie together, columns inferred differently become text.
    Separators and doubled quotes inside quotes belong to the value.  With ``multiline`` line breaks
    inside quotes do too.  Then files are read in byte ranges if one is larger than
    ``spark.sql.files.maxPartitionBytes``, or with ``multiline="ranges"`` in any case, and otherwise by
    one task each.  In byte ranges lines end with a line feed, a carriage return before it or not; files
    with a quote that never closes, or in other encodings than UTF-8 and Latin-1, go by one task.
    """
    if multiline not in (False, True, "ranges"):
        raise ValueError(f"unknown multiline {multiline!r}; known: False, True, ranges")
    delimiter = (delimiter or "").strip(" ") or None
    encoding = (encoding or "").strip() or None
    files = {encoding or "UTF-8": path}
    if delimiter is None or encoding is None:
        seen = profile_files(spark, path).agg(
            F.slice(F.collect_set(F.when(F.col("occurrences") > 0, F.col("separator"))), 1, 2).alias("separators"),
            F.min("utf8").alias("utf8"),
            (~F.max("utf8")).alias("all_latin"),
        ).first()
        if delimiter is None:
            if len(seen.separators) > 1:
                raise ValueError(f"the files under {path} use different separators: {sorted(seen.separators)}")
            delimiter = seen.separators[0] if seen.separators else ","
        if encoding is None and seen.utf8 is False and not seen.all_latin:
            # the paths alone, which the file index of the driver holds as well
            known = profile_files(spark, path).select("file", "utf8").collect()
            # the scan names files as URIs
            files = {"UTF-8": [unquote(f.file) for f in known if f.utf8], "ISO-8859-1": [unquote(f.file) for f in known if not f.utf8]}
        elif encoding is None:
            files = {"ISO-8859-1" if seen.utf8 is False else "UTF-8": path}
    parts = []
    for name, part in files.items():
        name = "UTF-8" if name.lower() in ("utf-8-sig", "utf8", "utf-8") else name
        reader = spark.read.option("header", header).option("sep", delimiter).option("encoding", name)
        # a quote inside quotes is doubled, as other programs write it
        reader = reader.option("quote", '"').option("escape", '"').option("multiLine", bool(multiline))
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
        known = _ranges(spark, part, delimiter, name, multiline) if multiline else []
        parts.append((_RangeReader(spark, known, delimiter, header, name, schema) if known else reader, part))
    df = parts[0][0].csv(parts[0][1])
    for reader, part in parts[1:]:
        more = reader.csv(part)
        if len(more.columns) != len(df.columns):
            raise ValueError(f"the files under {path} have different columns: {df.columns} and {more.columns}")
        if more.schema != df.schema:
            fields = zip(df.schema, more.schema, strict=True)
            common = T.StructType([T.StructField(a.name, a.dataType if a.dataType == b.dataType else T.StringType()) for a, b in fields])
            df, more = parts[0][0].schema(common).csv(parts[0][1]), reader.schema(common).csv(part)
        df = df.union(more)
    first = df.columns[0] if df.columns else ""
    return df.withColumnRenamed(first, first.lstrip(BOM)) if first.startswith(BOM) else df


def _ranges(spark: SparkSession, path: str | list[str], delimiter: str, encoding: str, multiline: bool | str) -> list[csv_ranges.File]:
    """The files in byte ranges; none if they are to be read by one task each."""
    large = multiline == "ranges" or listing.files(spark, path, listing.split_bytes(spark))
    if not large or encoding.upper() not in csv_ranges.ENCODINGS:
        return []
    known = csv_ranges.files(spark, path, delimiter)
    return [] if any(f.open or f.header is None for f in known) else known


class _RangeReader:
    """Reads records of byte ranges as the reader of Spark reads files."""

    def __init__(self, spark: SparkSession, known: list[csv_ranges.File], delimiter: str, header: bool, encoding: str, schema: str | T.StructType | None):
        self.spark, self.known, self.delimiter, self.header, self.encoding, self._schema = spark, known, delimiter, header, encoding, schema

    def schema(self, schema: T.StructType) -> _RangeReader:
        return _RangeReader(self.spark, self.known, self.delimiter, self.header, self.encoding, schema)

    def csv(self, _: str | list[str]) -> DataFrame:
        texts = csv_ranges.record_texts(self.spark, self.known, self.delimiter, self.header, self.encoding)
        options = {"sep": self.delimiter, "quote": '"', "escape": '"', "multiLine": "true"}
        schema = self._schema
        if schema is None:
            inferred = self.spark.read.options(inferSchema=True, **options).csv(texts.rdd.map(lambda r: r.value)).schema
            names = self._names()
            kinds = [f.dataType for f in inferred] + [T.StringType()] * (len(names) - len(inferred))
            schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=False)])
        ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
        return texts.select(F.from_csv("value", ddl, options).alias("r")).select("r.*")

    def _names(self) -> list[str]:
        """Column names of the first file's header; empty and repeated ones get their place, as Spark does it."""
        first = self.known[0].header.decode(self.encoding).rstrip("\r")
        named = next(csv.reader(io.StringIO(first, newline=""), delimiter=self.delimiter), [])
        if not self.header:
            return [f"_c{i}" for i in range(len(named))]
        low = [n.lower() for n in named]
        return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(named)]


def write_csv(df: DataFrame, path: str, delimiter: str = ",", geom: str = GEOM, mode: str = "errorifexists") -> None:
    """Attributes without the geometry; rows without coordinates are written too."""
    writer = df.drop(geom).write.mode(mode).option("header", True).option("sep", delimiter).option("escape", '"')
    # white space around a text belongs to it
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
