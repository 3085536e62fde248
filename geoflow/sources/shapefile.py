"""ESRI Shapefile as a Spark data source, ``format("shapefile")``.

Reading splits every file into record ranges through its index, so one large file is read by many
tasks; an archive is one task per set.  Writing makes one shapefile set per task and geometry
family.  Paths must be visible to every executor (a shared mount).
"""

from __future__ import annotations

import io
import os
import shutil
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from ..functions.layer import GEOM, describe
from .columnar import GeometryColumn, contains_point, geometry_type, rings_of, signed_area
from .prj import prj_text, srid_of_prj

# Fixed values of the format.
FILE_CODE, VERSION = 9994, 1000
HEADER_BYTES, INDEX_ENTRY_BYTES = 100, 8
NULL_SHAPE, POINT, POLYLINE, POLYGON, MULTIPOINT = 0, 1, 3, 5, 8
FAMILY_CODES = {"Point": POINT, "LineString": POLYLINE, "MultiLineString": POLYLINE, "Polygon": POLYGON,
                "MultiPolygon": POLYGON, "MultiPoint": MULTIPOINT}
FAMILY_NAMES = {POINT: "point", POLYLINE: "line", POLYGON: "area", MULTIPOINT: "multipoint"}

RECORDS_PER_TASK = 50_000
BATCH_ROWS = 5_000


# --- attribute tables ----------------------------------------------------------------------


@dataclass
class Field:
    name: str
    kind: str
    size: int
    decimals: int

    def spark_type(self) -> T.DataType:
        if self.kind == "L":
            return T.BooleanType()
        if self.kind == "D":
            return T.DateType()
        if self.kind in "NF":
            return T.LongType() if self.kind == "N" and self.decimals == 0 and self.size <= 18 else T.DoubleType()
        return T.StringType()

    def parse(self, raw: bytes, encoding: str) -> object:
        text = raw.decode(encoding, errors="replace").strip().strip("\x00")
        if self.kind == "L":
            return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
        if not text or text.startswith("*"):
            return None
        if self.kind == "D":
            return date(int(text[:4]), int(text[4:6]), int(text[6:8]))
        if self.kind in "NF":
            return int(text) if isinstance(self.spark_type(), T.LongType) else float(text)
        return text


def read_fields(stream: io.BufferedIOBase) -> tuple[list[Field], int, int, int]:
    """(fields, records, header bytes, record bytes) of a dBASE table."""
    head = stream.read(32)
    records, header, record = struct.unpack("<4xIHH", head[:12])
    body = stream.read(header - 32)
    fields = []
    for at in range(0, len(body) - 31, 32):
        if body[at] == 0x0D:
            break
        name, kind, size, decimals = struct.unpack_from("<11sc4xBB", body, at)
        fields.append(Field(name.split(b"\x00")[0].decode("ascii", "replace"), kind.decode(), size, decimals))
    return fields, records, header, record


# --- shapes --------------------------------------------------------------------------------


def parse_shape(record: bytes) -> tuple[str | None, list]:
    """(type, parts) of a record body; Z and M values are dropped."""
    (code,) = struct.unpack_from("<i", record, 0)
    flat = code % 10
    if flat == NULL_SHAPE:
        return None, []
    if flat == POINT:
        return "Point", [[np.frombuffer(record, "<f8", 2, 4).reshape(1, 2)]]
    if flat == MULTIPOINT:
        (n,) = struct.unpack_from("<i", record, 36)
        xy = np.frombuffer(record, "<f8", 2 * n, 40).reshape(n, 2)
        return "MultiPoint", [[xy[i : i + 1]] for i in range(n)]
    n_parts, n_points = struct.unpack_from("<2i", record, 36)
    starts = list(struct.unpack_from(f"<{n_parts}i", record, 44)) + [n_points]
    xy = np.frombuffer(record, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(n_points, 2)
    rings = [xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    if flat == POLYLINE:
        return ("LineString" if n_parts == 1 else "MultiLineString"), [[r] for r in rings]
    return _polygons(rings)


def _polygons(rings: list[np.ndarray]) -> tuple[str, list]:
    """Group rings: clockwise ones are shells, the others holes of the smallest shell around them."""
    areas = [signed_area(r) for r in rings]
    shells = [i for i, a in enumerate(areas) if a <= 0] or [0]
    parts = {i: [rings[i]] for i in shells}
    for i, ring in enumerate(rings):
        if i in parts:
            continue
        around = [s for s in shells if contains_point(rings[s], ring[0])]
        owner = min(around, key=lambda s: abs(areas[s])) if around else shells[0]
        parts[owner].append(ring)
    return ("Polygon" if len(parts) == 1 else "MultiPolygon"), list(parts.values())


def shape_body(geom: dict) -> tuple[int, bytes, tuple[float, float, float, float]]:
    """(shape code, record body, bounds) of a geometry struct."""
    code = FAMILY_CODES[geom["type"]]
    parts = rings_of(geom)
    if code == POLYGON:
        # shells clockwise, holes counter-clockwise
        parts = [
            [r[::-1] if (signed_area(r) > 0) == (i == 0) else r for i, r in enumerate(part)] for part in parts
        ]
    rings = [r for part in parts for r in part]
    xy = np.concatenate(rings)
    box = (*xy.min(axis=0).tolist(), *xy.max(axis=0).tolist())
    data = np.ascontiguousarray(xy, dtype="<f8").tobytes()
    if code == POINT:
        return code, struct.pack("<i", code) + data, box
    if code == MULTIPOINT:
        return code, struct.pack("<i4di", code, *box, len(xy)) + data, box
    starts = np.cumsum([0] + [len(r) for r in rings[:-1]]).astype("<i4").tobytes()
    return code, struct.pack("<i4d2i", code, *box, len(rings), len(xy)) + starts + data, box


def file_header(code: int, words: int, box: tuple[float, float, float, float]) -> bytes:
    return struct.pack(">i20xi", FILE_CODE, words) + struct.pack("<2i8d", VERSION, code, *box, 0, 0, 0, 0)


def scan_offsets(stream: io.BufferedIOBase) -> list[tuple[int, int]]:
    """(offset, length) of every record by walking the main file, for a missing index."""
    stream.seek(0, io.SEEK_END)
    end, at, found = stream.tell(), HEADER_BYTES, []
    while at + 8 <= end:
        stream.seek(at + 4)
        (words,) = struct.unpack(">i", stream.read(4))
        found.append((at, 2 * words))
        at += 8 + 2 * words
    return found


# --- reading -------------------------------------------------------------------------------


@dataclass
class RecordRange(InputPartition):
    path: str
    member: str
    first: int
    last: int


def find_sets(path: str, layer: str | None) -> list[tuple[str, str]]:
    """(file, member) of the shapefile sets at a path; ``member`` is empty for plain files."""
    p = Path(path)
    if p.is_dir():
        found = sorted(str(f) for f in p.rglob("*.[sS][hH][pP]"))
        return [(f, "") for f in found if layer is None or Path(f).stem.lower() == layer.lower()]
    if p.suffix.lower() != ".zip":
        if not p.is_file():
            raise FileNotFoundError(f"shapefile not found: {path}")
        return [(path, "")]
    with zipfile.ZipFile(p) as archive:
        by_stem: dict[str, set[str]] = {}
        for name in archive.namelist():
            stem, ext = os.path.splitext(name)
            by_stem.setdefault(stem, set()).add(ext.lower())
    stems = sorted(s for s, e in by_stem.items() if {".shp", ".shx", ".dbf"} <= e)
    if not stems:
        raise ValueError(f"no complete shapefile (.shp, .shx, .dbf) in {path}")
    named = [s for s in stems if layer and Path(s).name.lower() == layer.lower()]
    return [(path, (named or stems)[0])]


class _Files:
    """Opens the members of one set, from the folder or from the archive (in memory)."""

    def __init__(self, path: str, member: str) -> None:
        self.path, self.member = path, member

    def open(self, ext: str) -> io.BufferedIOBase | None:
        if self.member:
            with zipfile.ZipFile(self.path) as archive:
                for name in archive.namelist():
                    stem, e = os.path.splitext(name)
                    if stem == self.member and e.lower() == ext:
                        return io.BytesIO(archive.read(name))
            return None
        stem = os.path.splitext(self.path)[0]
        for candidate in (stem + ext, stem + ext.upper()):
            if os.path.exists(candidate):
                return open(candidate, "rb")
        return None

    def encoding(self) -> str:
        stream = self.open(".cpg")
        if stream is None:
            return "utf-8"
        with stream:
            text = stream.read().decode("ascii", "replace").strip().lower()
        return {"88591": "latin-1", "iso88591": "latin-1"}.get(text.replace("-", "").replace("_", ""), text) or "utf-8"

    def srid(self) -> int | None:
        stream = self.open(".prj")
        if stream is None:
            return None
        with stream:
            return srid_of_prj(stream.read().decode("utf-8", "replace"))

    def record_count(self) -> int:
        stream = self.open(".shx")
        if stream is not None:
            with stream:
                return (stream.seek(0, io.SEEK_END) - HEADER_BYTES) // INDEX_ENTRY_BYTES
        with self.open(".dbf") as table:
            return read_fields(table)[1]

    def offsets(self, first: int, last: int) -> list[tuple[int, int]]:
        stream = self.open(".shx")
        if stream is None:
            with self.open(".shp") as shapes:
                return scan_offsets(shapes)[first:last]
        with stream:
            stream.seek(HEADER_BYTES + first * INDEX_ENTRY_BYTES)
            raw = np.frombuffer(stream.read((last - first) * INDEX_ENTRY_BYTES), ">i4").reshape(-1, 2)
        return [(2 * int(o), 2 * int(n)) for o, n in raw]


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema, self.options = schema, options

    def partitions(self) -> list[RecordRange]:
        step = int(self.options.get("recordspertask", RECORDS_PER_TASK))
        ranges = []
        for path, member in find_sets(self.options["path"], self.options.get("layer")):
            n = _Files(path, member).record_count()
            if member:
                ranges.append(RecordRange(path, member, 0, n))
            else:
                ranges += [RecordRange(path, member, a, min(a + step, n)) for a in range(0, n, step)]
        return ranges

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        files = _Files(partition.path, partition.member)
        encoding = self.options.get("encoding") or files.encoding()
        offsets = files.offsets(partition.first, partition.last)
        wanted = [f.name for f in self.schema.fields if f.name != GEOM]
        with files.open(".shp") as shapes, files.open(".dbf") as table:
            fields, _, header, width = read_fields(table)
            places, at = {}, 1
            for f in fields:
                places[f.name] = (f, at)
                at += f.size
            for start in range(0, len(offsets), BATCH_ROWS):
                some = offsets[start : start + BATCH_ROWS]
                shapes.seek(some[0][0])
                block = shapes.read(some[-1][0] + 8 + some[-1][1] - some[0][0])
                table.seek(header + (partition.first + start) * width)
                rows = table.read(width * len(some))
                geoms = GeometryColumn()
                columns: dict[str, list] = {name: [] for name in wanted}
                for i, (offset, size) in enumerate(some):
                    row = rows[i * width : (i + 1) * width]
                    if row[:1] == b"*":  # deleted record
                        continue
                    body = offset - some[0][0] + 8
                    geoms.add(*parse_shape(block[body : body + size]))
                    for name in wanted:
                        f, at = places[name]
                        columns[name].append(f.parse(row[at : at + f.size], encoding))
                arrays = [
                    geoms.to_arrow() if f.name == GEOM else pa.array(columns[f.name], _arrow_type(f.dataType))
                    for f in self.schema.fields
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=self.schema.names)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return {
        T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(), T.DateType: pa.date32(),
    }.get(type(kind), pa.string())


# --- writing -------------------------------------------------------------------------------


def short_names(names: list[str]) -> dict[str, str]:
    """Field names of at most ten characters, distinct."""
    taken: set[str] = set()
    out = {}
    for name in names:
        short, n = name[:10], 1
        while short.lower() in taken:
            n += 1
            short = f"{name[: 9 - len(str(n))]}_{n}"
        taken.add(short.lower())
        out[name] = short
    return out


def table_fields(schema: T.StructType) -> list[tuple[str, Field]]:
    names = short_names([f.name for f in schema.fields if f.name != GEOM])
    made = []
    for f in schema.fields:
        if f.name == GEOM:
            continue
        kind = f.dataType
        if isinstance(kind, T.BooleanType):
            made.append((f.name, Field(names[f.name], "L", 1, 0)))
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            made.append((f.name, Field(names[f.name], "N", 11, 0)))
        elif isinstance(kind, T.LongType):
            made.append((f.name, Field(names[f.name], "N", 18, 0)))
        elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            made.append((f.name, Field(names[f.name], "F", 24, 15)))
        elif isinstance(kind, T.DateType):
            made.append((f.name, Field(names[f.name], "D", 8, 0)))
        else:
            made.append((f.name, Field(names[f.name], "C", 254, 0)))
    return made


def _cell(value: object, field: Field) -> bytes:
    if value is None:
        return b" " * field.size
    if field.kind == "L":
        text = "T" if value else "F"
    elif field.kind == "D":
        text = value.strftime("%Y%m%d")
    elif field.kind == "F":
        text = f"{float(value):.17g}"
    else:
        text = str(value)
    raw = text.encode("utf-8")
    if len(raw) > field.size:
        raise ValueError(f"{len(raw)} bytes do not fit the {field.size} of the field {field.name}: {text[:40]}")
    return raw.rjust(field.size) if field.kind in "NF" else raw.ljust(field.size)


class _SetWriter:
    """Streams one shapefile set; headers are completed at the end."""

    def __init__(self, stem: str, code: int, fields: list[tuple[str, Field]], srid: int | None) -> None:
        self.stem, self.code, self.fields, self.srid = stem, code, fields, srid
        self.shp, self.shx, self.dbf = (open(stem + e, "wb") for e in (".shp", ".shx", ".dbf"))
        self.shp.write(bytes(HEADER_BYTES))
        self.shx.write(bytes(HEADER_BYTES))
        self.dbf.write(self._table_header(0))
        self.n, self.at = 0, HEADER_BYTES
        self.box = (float("inf"), float("inf"), float("-inf"), float("-inf"))

    def _table_header(self, n: int) -> bytes:
        width = 1 + sum(f.size for _, f in self.fields)
        head = struct.pack("<4BIHH20x", 3, 100, 1, 1, n, 33 + 32 * len(self.fields), width)
        body = b"".join(
            struct.pack("<11sc4xBB14x", f.name.encode("ascii", "replace"), f.kind.encode(), f.size, f.decimals)
            for _, f in self.fields
        )
        return head + body + b"\r"

    def add(self, geom: dict | None, row: dict) -> None:
        if geom is None:
            body = struct.pack("<i", NULL_SHAPE)
        else:
            _, body, box = shape_body(geom)
            self.box = (
                min(self.box[0], box[0]), min(self.box[1], box[1]), max(self.box[2], box[2]), max(self.box[3], box[3])
            )
        self.n += 1
        self.shx.write(struct.pack(">2i", self.at // 2, len(body) // 2))
        self.shp.write(struct.pack(">2i", self.n, len(body) // 2) + body)
        self.at += 8 + len(body)
        self.dbf.write(b" " + b"".join(_cell(row[name], f) for name, f in self.fields))

    def close(self) -> None:
        box = self.box if self.box[0] <= self.box[2] else (0.0, 0.0, 0.0, 0.0)
        self.dbf.write(b"\x1a")
        for stream, words in ((self.shp, self.at // 2), (self.shx, (HEADER_BYTES + 8 * self.n) // 2)):
            stream.seek(0)
            stream.write(file_header(self.code, words, box))
            stream.close()
        self.dbf.seek(0)
        self.dbf.write(self._table_header(self.n))
        self.dbf.close()
        Path(self.stem + ".cpg").write_text("UTF-8")
        if self.srid is not None:
            Path(self.stem + ".prj").write_text(prj_text(self.srid))


@dataclass
class WrittenFiles(WriterCommitMessage):
    stems: list[str]


class _Writer(DataSourceArrowWriter):
    """Tasks write into a folder of their own job; the commit moves finished sets into place."""

    def __init__(self, schema: T.StructType, options: dict[str, str], overwrite: bool) -> None:
        self.fields = table_fields(schema)
        self.target = options["path"]
        self.srid = int(options["srid"]) if options.get("srid") else None
        self.overwrite = overwrite
        self.staging = os.path.join(self.target, f"_staging-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        os.makedirs(self.staging, exist_ok=True)
        attempt = uuid.uuid4().hex[:12]
        sets: dict[int, _SetWriter] = {}
        for batch in iterator:
            for row in batch.to_pylist():
                geom = row.get(GEOM)
                geom = geom if geom and geom["type"] else None
                code = FAMILY_CODES[geom["type"]] if geom else next(iter(sets), POINT)
                if code not in sets:
                    stem = os.path.join(self.staging, f"part-{attempt}-{FAMILY_NAMES[code]}")
                    sets[code] = _SetWriter(stem, code, self.fields, self.srid)
                sets[code].add(geom, row)
        for s in sets.values():
            s.close()
        return WrittenFiles([s.stem for s in sets.values()])

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        if self.overwrite:
            for old in Path(self.target).glob("part-*"):
                old.unlink()
        for message in messages:
            for stem in message.stems if message else []:
                for ext in (".shp", ".shx", ".dbf", ".cpg", ".prj"):
                    if os.path.exists(stem + ext):
                        os.replace(stem + ext, os.path.join(self.target, os.path.basename(stem) + ext))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class ShapefileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> T.StructType:
        found = find_sets(self.options["path"], self.options.get("layer"))
        if not found:
            raise FileNotFoundError(f"no shapefile under {self.options['path']}")
        with _Files(*found[0]).open(".dbf") as table:
            fields = read_fields(table)[0]
        columns = [T.StructField(f.name, f.spark_type()) for f in fields]
        return T.StructType([*columns, T.StructField(GEOM, geometry_type())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(schema, dict(self.options), overwrite)


def local_path(path: str) -> str:
    """Plain path of a ``file:`` URI; other schemes must be mounted."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: binary layers need a path that executors can open (mount the storage)")
    return path


def read_shapefile(
    spark: SparkSession, path: str, layer: str | None = None, encoding: str | None = None, srid: int | None = None,
    records_per_task: int = RECORDS_PER_TASK,
) -> DataFrame:
    """Read a ``.shp`` file, a ``.zip`` with one, or all of a folder.

    The coordinate system is that of the ``.prj`` files, longitude/latitude where there are none; files
    that differ in it or that name an unknown one raise unless ``srid`` is given.
    """
    spark.dataSource.register(ShapefileSource)
    reader = spark.read.format("shapefile").option("recordspertask", records_per_task)
    for key, value in (("layer", layer), ("encoding", encoding)):
        reader = reader.option(key, value) if value else reader
    if srid is None:
        named = {_Files(*found).srid() or 4326 for found in find_sets(local_path(path), layer)}
        if len(named) > 1:
            raise ValueError(f"the files under {path} have different coordinate systems: {sorted(named)}")
        srid = min(named, default=4326)
    return describe(reader.load(local_path(path)), srid=srid)


def write_shapefile(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write one set per task and geometry family into a folder; text of over 254 bytes, which the format can't hold, raises."""
    df.sparkSession.dataSource.register(ShapefileSource)
    srid = df.schema[GEOM].metadata.get("srid", 4326)
    df.write.format("shapefile").mode(mode).option("srid", srid).save(local_path(path))


