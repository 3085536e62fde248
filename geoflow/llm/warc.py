"""Web archives with one Zstandard frame a record and a dictionary of the archive's own records in front."""

from __future__ import annotations

import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 100
#: Payload bytes of a file, about.
FILE_BYTES = 32 << 20
#: The dictionary of a file is built from its first records up to this many bytes, and from no more than SAMPLE_BYTES of each.
TRAIN_BYTES, SAMPLE_BYTES = 4 << 20, 64 << 10
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
# Fixed values of the format: the skippable frame that holds a dictionary, the start of a dictionary, profile and version lines.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1.1"
#: Text files have something after each row. This is a skippable frame without content, which readers pass over.
AFTER_FRAME = struct.pack("<II", 0x184D2A50, 0).decode()
RECORDS = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"


def _record(kind: str, record_id: str, date: str, block: bytes, fields: list[tuple[str, str | None]]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *fields, ("Content-Length", str(len(block)))]
    # a line break in a value would begin another field
    lines = [f"{k}: {re.sub(r'[\x00-\x20\x7f]', lambda c: f'%{ord(c[0]):02X}', v) if k.endswith('URI') else v}" for k, v in head if v is not None]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _name(page_id: int | None, digest: str) -> str:
    return f"urn:x-page:{'null' if page_id is None else page_id}:{digest}"


def _page_record(row: dict, first: dict | None, date: str) -> bytes:
    """The record of a page; first: the response that it revisits."""
    payload, digest = row["payload"], row["digest"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Target-URI", row["url"]), ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    own = _name(row["page_id"], digest)
    if first is None:
        return _record("response", own, date, http + payload, fields)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_name(first['page_id'], digest)}>"), ("WARC-Refers-To-Target-URI", first["url"])]
    return _record("revisit", f"{own}:revisit", date, http, fields)


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """None where there is too little to build one from; the file then has no leading frame."""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples, k=1024, d=8) if size >= 1024 else None
    except zstandard.ZstdError:
        return None


def _frames(date: str, level: int):
    """Frames of one file: the dictionary, what the archive is, one for each page."""

    def begun(records: list[bytes], part: int) -> Iterator[bytes]:
        made = _dictionary([r[:SAMPLE_BYTES] for r in records])
        if made is not None:
            content = made.as_bytes()
            yield struct.pack("<II", DICTIONARY_FRAME, len(content)) + content
        packer = zstandard.ZstdCompressor(level=level, dict_data=made, write_checksum=True)
        info = b"software: geoflow\r\nformat: WARC File Format 1.1\r\n"
        yield packer.compress(_record("warcinfo", f"urn:x-archive:{part}", date, info, [("Content-Type", "application/warc-fields")]))
        yield from map(packer.compress, records)
        return packer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        waiting, size, packer, first = [], 0, None, {}

        def ready(frames: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

        def begin():
            nonlocal packer
            frames, steps = [], begun(waiting, part)
            while True:
                try:
                    frames.append(next(steps))
                except StopIteration as end:
                    packer = end.value
                    return ready(frames)

        for batch in batches:
            frames, held = [], 0
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["mark"]:
                    first = row
                    continue
                same = (first.get("key"), first.get("digest")) == (row["key"], row["digest"])
                record = _page_record(row, first if same else None, date)
                if packer is None:
                    waiting.append(record)
                    size += len(record)
                    if size >= TRAIN_BYTES:
                        yield begin()
                        waiting.clear()
                    continue
                frames.append(packer.compress(record))
                held += len(frames[-1])
                if held >= TRAIN_BYTES:
                    yield ready(frames)
                    frames, held = [], 0
            if frames:
                yield ready(frames)
        if packer is None and waiting:
            yield begin()

    return run


def _page_columns(pages: DataFrame) -> tuple[Column, Column, Column]:
    return F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")


def write_archive(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", level: int = LEVEL, file_bytes: int = FILE_BYTES) -> None:
    """Write one record for each row of pages into a new folder of archives.

    pages: columns page_id, url, html; others are not read. The payload is the html in UTF-8, empty for null. Of records with
    equal payloads of at least 100 bytes the one with the smallest page_id is a response and the others revisit it, a null
    page_id too; where no row of a payload has a page_id, and below 100 bytes, all are responses. Rows equal in page_id and
    payload are records of their own and of one kind. Control characters in a url are percent-encoded, a null url has no field.
    An empty table makes an archive without records. The table has no fetch times, so all records have `date`.

    Payloads are compared by their SHA-256. Only ids, urls and digests take part in the search for equal payloads; the
    payloads are shuffled once, by id and digest, into files of about `file_bytes`. Every file begins with a skippable frame
    that has its dictionary, where there was enough to build one, and every record is a frame that can be read by itself.
    Spark's own writer commits the files, so a lost executor leaves none behind; their suffix is .txt.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    page_id, url, payload = _page_columns(pages)
    read = pages.select(page_id, url, payload)
    digest = F.sha2("payload", 256).alias("digest")
    marks = scratch.keep(read.select("page_id", "url", F.octet_length("payload").cast("bigint").alias("bytes"), digest))
    first = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first")
    several = marks.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.count("*").alias("n"), first).where("n > 1 and first is not null")
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key")
    revisits = (
        marks.join(several, "digest").where("not page_id <=> first.page_id")
        .groupBy(key, "digest").agg(F.first("first.page_id").alias("first_id"), F.first("first.url").alias("first_url"))
    )
    files = max(1, -(-(marks.agg(F.sum("bytes")).first()[0] or 0) // file_bytes))
    # what a page revisits is dealt out with the page and sorted in front of it: one shuffle, and a file for each partition
    pages_in = read.select(key, digest, F.lit(False).alias("mark"), "page_id", "url", "payload")
    marks_in = revisits.select("key", "digest", F.lit(True).alias("mark"), F.col("first_id").alias("page_id"), F.col("first_url").alias("url"), F.lit(None).cast("binary").alias("payload"))
    placed = pages_in.union(marks_in).repartition(files, "key", "digest").sortWithinPartitions("key", "digest", F.desc("mark"))
    frames = placed.mapInArrow(_frames(date, level), "frame binary")
    # bytes go through unchanged
    frames.select(F.col("frame").cast("string")).write.option("lineSep", AFTER_FRAME).option("compression", "none").text(path)
    scratch.drop(marks)


def _unpacked(content: bytes) -> io.BufferedReader:
    """The records of an archive, one after the other."""
    made, at = None, 0
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == DICTIONARY_FRAME:
        at = 8 + struct.unpack_from("<I", content, 4)[0]
        inside = content[8:at]
        if not inside.startswith(DICTIONARY_MAGIC):
            inside = zstandard.ZstdDecompressor().decompressobj().decompress(inside)
        made = zstandard.ZstdCompressionDict(inside)
    stream = zstandard.ZstdDecompressor(dict_data=made).stream_reader(memoryview(content)[at:], read_across_frames=True)
    return io.BufferedReader(stream, 1 << 20)


def _fields(stream: io.BufferedReader) -> dict[str, str]:
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        fields[name.lower()] = value.strip()
    return fields


def _page_of(record_id: str) -> int | None:
    page = record_id.strip("<>").split(":")[2]
    return None if page == "null" else int(page)


def read_records(content: bytes) -> Iterator[dict]:
    """Pages of one archive: the columns of RECORDS. A payload that doesn't have the digest of its record raises an error."""
    stream = _unpacked(content)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        fields = _fields(stream)
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"the archive ends within record {fields.get('warc-record-id')}")
        kind = fields["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(io.BufferedReader(io.BytesIO(head.partition(b"\r\n")[2] + b"\r\n\r\n")))
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {fields['warc-record-id']} doesn't hold the payload that it names")
        yield {
            "page_id": _page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": len(payload) if kind == "response" else int(http["content-length"]), "payload_digest": digest,
            "refers_to": _page_of(fields["warc-refers-to"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None,
        }


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Rows (page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of all records of pages.

    payload_bytes and payload_digest are those of the full payload, also for a revisit, whose payload is null. The digests of
    responses are verified. Without payloads the column is null. A file is read by one task, whole, and unpacked as a stream.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for row in read_records(content.as_py()):
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    held += 200 + len(row["payload"] or b"")
                    if held >= TRAIN_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORDS)


def archived_pages(pages: DataFrame) -> DataFrame:
    """The records of pages, read back from an archive in the shared folder that was just written."""
    scratch = Scratch(pages.sparkSession, "archive")
    path = scratch.path("pages.warc.zst")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path, payloads=False).drop("payload")
