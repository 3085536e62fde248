"""OGC GeoPackage as a Spark data source, ``format("gpkg")``.

A layer is split into ranges of row ids.  Writing makes files of bounded size, built in memory and
stored whole.  Paths must be visible to every executor (a shared mount).
"""

from __future__ import annotations

import os
import shutil
import sqlite3
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition

from ..functions.layer import GEOM, describe
from .columnar import GEOM_ARROW, geometry_type
from .shapefile import WrittenFiles, local_path
from .wkb import decode, encode

ROWS_PER_TASK = 100_000
ROWS_PER_FILE = 200_000
BATCH_ROWS = 5_000

# Bytes of the envelope in a geometry header by its indicator, and SQL types.
ENVELOPE_BYTES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}
SQL_TYPES = {
    "BOOLEAN": T.BooleanType(), "TINYINT": T.LongType(), "SMALLINT": T.LongType(), "MEDIUMINT": T.LongType(),
    "INT": T.LongType(), "INTEGER": T.LongType(), "FLOAT": T.DoubleType(), "DOUBLE": T.DoubleType(),
    "REAL": T.DoubleType(), "BLOB": T.BinaryType(),
}
APPLICATION_ID = 0x47504B47
TABLES = """
create table gpkg_spatial_ref_sys (srs_name text not null, srs_id integer primary key, organization text not null,
  organization_coordsys_id integer not null, definition text not null, description text);
create table gpkg_contents (table_name text primary key, data_type text not null, identifier text unique,
  description text default '', last_change datetime not null default '1970-01-01T00:00:00.000Z',
  min_x double, min_y double, max_x double, max_y double, srs_id integer);
create table gpkg_geometry_columns (table_name text not null, column_name text not null, geometry_type_name text not null,
  srs_id integer not null, z tinyint not null, m tinyint not null, primary key (table_name, column_name));
"""


def strip_header(blob: bytes | None) -> bytes | None:
    """WKB inside a GeoPackage geometry."""
    if not blob:
        return None
    if blob[:2] != b"GP":
        raise ValueError("not a GeoPackage geometry")
    return blob[8 + ENVELOPE_BYTES[(blob[3] >> 1) & 7] :]


def add_header(body: bytes | None, srid: int) -> bytes | None:
    return None if body is None else b"GP" + struct.pack("<BBi", 0, 1, srid) + body


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)


def _files(path: str) -> list[str]:
    p = Path(path)
    if p.is_dir():
        return sorted(str(f) for f in p.rglob("*.gpkg"))
    if not p.is_file():
        raise FileNotFoundError(f"GeoPackage not found: {path}")
    return [path]


def _layer(db: sqlite3.Connection, path: str, layer: str | None) -> tuple[str, str, int]:
    """(table, geometry column, srid) of the named or first layer."""
    found = db.execute(
        "select g.table_name, g.column_name, g.srs_id from gpkg_geometry_columns g join gpkg_contents c"
        " on c.table_name = g.table_name where c.data_type = 'features' order by c.rowid"
    ).fetchall()
    for row in found:
        if not layer or row[0].lower() == layer.lower():
            return row
    raise ValueError(f"no layer {layer!r} in {path}" if layer else f"no layer in {path}")


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class RowRange(InputPartition):
    path: str
    first: int
    last: int


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]) -> None:
        self.schema, self.options = schema, options

    def partitions(self) -> list[RowRange]:
        step = int(self.options.get("rowspertask", ROWS_PER_TASK))
        ranges = []
        for path in _files(self.options["path"]):
            db = _open(path)
            table = _quoted(_layer(db, path, self.options.get("layer"))[0])
            low, high = db.execute(f"select min(rowid), max(rowid) from {table}").fetchone()
            db.close()
            if low is not None:
                ranges += [RowRange(path, a, min(a + step - 1, high)) for a in range(low, high + 1, step)]
        return ranges

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        db = _open(partition.path)
        table, shape, _ = _layer(db, partition.path, self.options.get("layer"))
        names = ", ".join(_quoted(shape if f.name == GEOM else f.name) for f in self.schema.fields)
        cursor = db.execute(
            f"select {names} from {_quoted(table)} where rowid between ? and ?", (partition.first, partition.last)
        )
        while rows := cursor.fetchmany(BATCH_ROWS):
            arrays = []
            for f, values in zip(self.schema.fields, zip(*rows, strict=True), strict=True):
                if f.name == GEOM:
                    arrays.append(pa.array([decode(strip_header(v)) for v in values], GEOM_ARROW))
                elif isinstance(f.dataType, T.BooleanType):
                    arrays.append(pa.array([None if v is None else bool(v) for v in values], pa.bool_()))
                elif isinstance(f.dataType, T.LongType):
                    arrays.append(pa.array(values, pa.int64()))
                elif isinstance(f.dataType, T.DoubleType):
                    arrays.append(pa.array([None if v is None else float(v) for v in values], pa.float64()))
                elif isinstance(f.dataType, T.BinaryType):
                    arrays.append(pa.array(values, pa.binary()))
                else:
                    arrays.append(pa.array([None if v is None else str(v) for v in values], pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=self.schema.names)
        db.close()


def _sql_type(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "BOOLEAN"
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "INTEGER"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "DOUBLE"
    return "BLOB" if isinstance(kind, T.BinaryType) else "TEXT"


def _plain(value: object) -> object:
    return value if value is None or isinstance(value, (bool, int, float, str, bytes)) else str(value)


class _Writer(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict[str, str], overwrite: bool) -> None:
        self.columns = [(f.name, _sql_type(f.dataType)) for f in schema.fields if f.name != GEOM]
        self.target, self.overwrite = options["path"], overwrite
        self.layer, self.srid = options.get("layer", "layer"), int(options.get("srid", 4326))
        self.staging = os.path.join(self.target, f"_staging-{uuid.uuid4().hex}")

    def _start(self) -> sqlite3.Connection:
        db = sqlite3.connect(":memory:")
        db.execute(f"pragma application_id = {APPLICATION_ID}")
        db.execute("pragma user_version = 10300")
        db.executescript(TABLES)
        db.execute(
            "insert into gpkg_spatial_ref_sys values (?, ?, 'EPSG', ?, 'undefined', null)",
            (f"EPSG:{self.srid}", self.srid, self.srid),
        )
        db.execute(
            "insert into gpkg_contents (table_name, data_type, identifier, srs_id) values (?, 'features', ?, ?)",
            (self.layer, self.layer, self.srid),
        )
        db.execute(
            "insert into gpkg_geometry_columns values (?, 'geom', 'GEOMETRY', ?, 0, 0)", (self.layer, self.srid)
        )
        columns = "".join(f", {_quoted(n)} {t}" for n, t in self.columns)
        db.execute(f"create table {_quoted(self.layer)} (_fid integer primary key, geom blob{columns})")
        return db

    def _store(self, db: sqlite3.Connection, stems: list[str]) -> None:
        db.commit()
        path = os.path.join(self.staging, f"part-{uuid.uuid4().hex[:12]}.gpkg")
        Path(path).write_bytes(db.serialize())
        db.close()
        stems.append(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        os.makedirs(self.staging, exist_ok=True)
        marks = ", ".join("?" * (1 + len(self.columns)))
        names = ", ".join(["geom"] + [_quoted(n) for n, _ in self.columns])
        insert = f"insert into {_quoted(self.layer)} ({names}) values ({marks})"
        stems: list[str] = []
        db, n = None, 0
        for batch in iterator:
            rows = [
                (add_header(encode(r.get(GEOM)), self.srid), *[_plain(r[c]) for c, _ in self.columns])
                for r in batch.to_pylist()
            ]
            db = db or self._start()
            db.executemany(insert, rows)
            n += len(rows)
            if n >= ROWS_PER_FILE:
                self._store(db, stems)
                db, n = None, 0
        if db is not None:
            self._store(db, stems)
        return WrittenFiles(stems)

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        if self.overwrite:
            for old in Path(self.target).glob("part-*.gpkg"):
                old.unlink()
        for message in messages:
            for path in message.stems if message else []:
                os.replace(path, os.path.join(self.target, os.path.basename(path)))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class GeoPackageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> T.StructType:
        files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no GeoPackage under {self.options['path']}")
        db = _open(files[0])
        table, shape, _ = _layer(db, files[0], self.options.get("layer"))
        columns = db.execute(f"pragma table_info({_quoted(table)})").fetchall()
        db.close()
        fields = [
            T.StructField(name, SQL_TYPES.get(kind.upper().split("(")[0], T.StringType()))
            for _, name, kind, _, _, _ in columns
            if name != shape and name != "_fid"
        ]
        return T.StructType([*fields, T.StructField(GEOM, geometry_type())])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, {k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(schema, dict(self.options), overwrite)


def read_gpkg(spark: SparkSession, path: str, layer: str | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Read the named layer, else the first one, of a file or of all files of a folder."""
    spark.dataSource.register(GeoPackageSource)
    plain = local_path(path)
    files = _files(plain)
    if not files:
        raise FileNotFoundError(f"no GeoPackage under {path}")
    db = _open(files[0])
    srid = _layer(db, files[0], layer)[2]
    db.close()
    reader = spark.read.format("gpkg").option("rowspertask", rows_per_task)
    return describe((reader.option("layer", layer) if layer else reader).load(plain), srid=srid)


def write_gpkg(df: DataFrame, path: str, layer: str = "layer", mode: str = "append") -> None:
    """Write one or more files per task into a folder."""
    df.sparkSession.dataSource.register(GeoPackageSource)
    srid = df.schema[GEOM].metadata.get("srid", 4326)
    df.write.format("gpkg").mode(mode).option("srid", srid).option("layer", layer).save(local_path(path))
