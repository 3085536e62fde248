"""Archives, hard negatives and whitening against brute force and round trips, and on all kinds of odd input."""

import hashlib
import math
import struct

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from geoflow.llm import hard_negatives, warc, whitening
from geoflow.llm.scratch import Scratch

# --- archives ------------------------------------------------------------------------------

LONG = "<html>" + "same page " * 40 + "</html>"
CLASHING = "payload binary, digest string, key string, first string, bytes bigint, frame string, n int"


def pages_of(spark, rows):
    extra = (b"p", "d", "k", "f", 1, "x", 2)
    return spark.createDataFrame([(*r, *extra) for r in rows], f"page_id bigint, url string, html string, {CLASHING}")


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (9, "http://a/9", LONG), (4, "http://a/4", LONG), (7, "http://a/7", LONG), (4, "http://a/4", LONG), (None, "http://a/none", LONG),
        (1, "http://a/1", "tiny"), (2, "http://a/2", "tiny"), (3, None, None), (5, "http://a/5", ""), (6, "http://a/\r\nX: y", "é" * 50),
        (8, "http://a/8", "é" * 50), (10, "http://a/10", "x" * 99), (11, "http://a/11", "x" * 99), (12, "http://a/12", "x" * 100), (13, "http://a/13", "x" * 100),
        (14, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 20), (15, "u", "\x00P*M\x18\x00\x00\x00\x00" * 40), (16, "u", "long " * 500_000),
        (None, None, "without any id " * 20), (None, "u", "without any id " * 20),
    ]
    rows += [(100 + i, f"http://b/{i}", f"<html><p>page {i} of many</p>" + "<div class='footer'>the same footer for all</div>" * 8) for i in range(300)]
    return pages_of(spark, rows)


def archived_by_force(rows):
    payloads = [(r.page_id, (r.html or "").encode()) for r in rows]
    first = {}
    for page, p in payloads:
        if page is not None:
            first[p] = min(first.get(p, page), page)
    out = []
    for page, p in payloads:
        again = len(p) >= 100 and p in first and page != first[p]
        out.append((page, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first[p] if again else None))
    return sorted(out, key=str)


def digested(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)


@pytest.mark.parametrize("file_bytes", [warc.FILE_BYTES, 200_000])
def test_archive_round_trip(spark, odd_pages, tmp_path, file_bytes):
    path = str(tmp_path / "made")
    warc.write_archive(odd_pages, path, file_bytes=file_bytes)
    rows = odd_pages.collect()
    got = warc.read_archive(spark, path).collect()
    assert digested(got) == archived_by_force(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r.page_id, set()).add((r.html or "").encode())
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or bytes(r.payload) in texts[r.page_id]
    assert {r.url for r in got if r.page_id == 6} == {"http://a/%0D%0AX:%20y"}
    assert {r.url for r in got if r.page_id == 3} == {None}
    assert digested(warc.archived_pages(odd_pages).collect()) == archived_by_force(rows)


def test_files_are_frames_with_a_dictionary_in_front(odd_pages, tmp_path):
    path = tmp_path / "made"
    warc.write_archive(odd_pages.where("page_id >= 100"), str(path))
    (file,) = path.glob("part-*")
    content = file.read_bytes()
    magic, size = struct.unpack_from("<II", content)
    assert magic == 0x184D2A5D
    dictionary = zstandard.ZstdCompressionDict(content[8 : 8 + size])
    assert dictionary.dict_id() != 0
    # every record is a frame of its own and can be read without the others
    at, kinds = 8 + size, []
    while at < len(content):
        if content[at : at + 4] == b"P*M\x18":
            at += 8 + struct.unpack_from("<I", content, at + 4)[0]
            continue
        one = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        record = one.decompress(content[at:])
        at = len(content) - len(one.unused_data)
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert record.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n") and int(fields["Content-Length"]) == len(rest) - 4
        kinds.append(fields["WARC-Type"])
    assert kinds == ["warcinfo"] + ["response"] * 300
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(bytes(r.html, "utf-8"))) for r in odd_pages.where("page_id >= 100").collect())
    assert len(content) - size < 1.5 * plain


def test_reader_of_other_archives():
    record = warc._record("response", "urn:x-page:5:d", "1970-01-01T00:00:00Z", b"HTTP/1.1 200 OK\r\nContent-Length: 2\r\n\r\nhi", [("WARC-Payload-Digest", "sha256:" + hashlib.sha256(b"hi").hexdigest())])
    whole = zstandard.ZstdCompressor().compress(record * 2)
    assert [(r["page_id"], r["payload"]) for r in warc.read_records(whole)] == [(5, b"hi")] * 2
    samples = [b"a sample of many words %d " % i * 40 for i in range(200)]
    made = zstandard.train_dictionary(2000, samples, k=64, d=8)
    inner = zstandard.ZstdCompressor().compress(made.as_bytes())
    packed = struct.pack("<II", warc.DICTIONARY_FRAME, len(inner)) + inner + zstandard.ZstdCompressor(dict_data=made).compress(record)
    assert [r["payload"] for r in warc.read_records(packed)] == [b"hi"]
    assert list(warc.read_records(b"")) == []
    with pytest.raises(ValueError, match="doesn't hold"):
        list(warc.read_records(zstandard.ZstdCompressor().compress(record.replace(b"\r\nhi", b"\r\nho"))))
    with pytest.raises(ValueError, match="not the start"):
        list(warc.read_records(zstandard.ZstdCompressor().compress(b"something else\r\n")))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(zstandard.ZstdCompressor().compress(record[:-10])))


def test_archive_of_nothing(odd_pages):
    assert warc.archived_pages(odd_pages.where("page_id > 10000")).collect() == []


# --- hard negatives ------------------------------------------------------------------------

EXTRA = "row bigint, id bigint, x array<int>, tile string, own boolean, size int, wanted int, score double, nth int"


def vectors_of(spark, rows, kind="float"):
    extra = (1, 2, [3], "t", True, 4, 5, 0.5, 6)
    return spark.createDataFrame([(*r, *extra) for r in rows], f"vec_id bigint, embedding array<{kind}>, label int, {EXTRA}")


def negatives_by_force(rows, label_of=lambda i, y: y, divisor=50, k=5, m=3, low=50, high=95):
    usable = []
    for n, (i, v, y) in enumerate(rows):
        y = None if y is None else label_of(i, y)
        if y is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        usable.append((n, i, y, [math.floor(256 * c) for c in v]))
    late = 1 << 80
    out = []
    for n, i, y, x in usable:
        if i is None or i % divisor:
            continue
        scored = [(max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(x, w)))), late if j is None else j, z, q) for q, j, z, w in usable if len(w) == len(x) and q != n]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for s in [s for s in scored if s[2] == y][:k]:
            near = [t for t in scored if t[2] != y and low * s[0] <= 100 * t[0] <= high * s[0]][:m]
            for rank, t in enumerate(near, 1):
                out.append((i, None if s[1] == late else s[1], rank, None if t[1] == late else t[1], s[0], t[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("tiles", "packed"), [((4096, 4096), 1024), ((37, 3), 8)])
def test_hard_negatives(spark, monkeypatch, tiles, packed):
    monkeypatch.setattr(hard_negatives, "CANDIDATES", tiles[0])
    monkeypatch.setattr(hard_negatives, "ANCHORS", tiles[1])
    monkeypatch.setattr(hard_negatives, "PACKED", packed)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(700):
        y = 0 if i % 3 == 0 else i % 7  # a label that a third of all rows have
        v = (rng.standard_normal(12) * 0.2 + np.eye(12)[y]).astype(np.float32)
        if i % 4 == 0:
            v = np.round(v * 4) / 4  # many ties
        rows.append((i, v.tolist(), y))
    rows += [(800, rows[0][1], 0), (801, rows[50][1], 1), (802, [0.0] * 12, 2), (850, [0.0] * 12, 2)]
    rows += [(900, None, 1), (950, [None] + [1.0] * 11, 1), (1000, [float("nan")] + [1.0] * 11, 1), (1050, [float("inf")] * 12, 1), (1100, [1.0] * 12, None)]
    rows += [(1150, [1.0, 2.0], 1), (1151, [1.0, 2.5], 1), (1152, [0.5, 1.5], 2), (1200, [], 1), (1201, [], 1), (1202, [], 2), (None, rows[3][1], 0)]
    got = hard_negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == negatives_by_force(rows)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    moved = hard_negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 50 == 0, label)
    assert sorted(map(tuple, moved.collect()), key=str) == negatives_by_force(rows, lambda i, y: (y + 1) % 10 if i is not None and i % 7 == 0 else y)


def test_hard_negatives_with_repeated_rows(spark):
    rows = [(50, [1.0, 0.0], 1)] * 3 + [(7, [0.6, 0.1], 2)] * 4 + [(8, [1.0, 0.1], 1), (9, [0.7, 0.0], 3)]
    got = hard_negatives.hard_negatives(vectors_of(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got), key=str) == negatives_by_force(rows)


@pytest.mark.parametrize("size", [1.0, 1e3, 1e7, 1e12, 1e16])
def test_packed_scores_of_any_size(size):
    rng = np.random.default_rng(6)
    x = np.floor(rng.standard_normal((70, 9)) * size * 256).astype(np.int64)
    anchors = np.floor(rng.standard_normal((5, 9)) * size * 256).astype(np.int64)
    packed = hard_negatives.Packed(x, int(anchors.min()), int(anchors.max()))
    for a in anchors.tolist():
        want = [max(-(2**63) + 1, min(2**63 - 1, sum(p * q for p, q in zip(a, r)))) for r in x.tolist()]
        assert packed.scores(a).tolist() == want


def test_hard_negatives_of_large_components_and_nothing(spark):
    rows = [(0, [3e15, -2.0], 1), (1, [3e15, 5.0], 1), (2, [2e15, 1.0], 2), (3, [1e300, 1.0], 2)]
    got = hard_negatives.hard_negatives(vectors_of(spark, rows, "double"), F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, got), key=str) == negatives_by_force(rows[:3])
    none = vectors_of(spark, rows, "double").where("vec_id < 0")
    assert hard_negatives.hard_negatives(none, F.col("vec_id") % 50 == 0).collect() == []


# --- whitening -----------------------------------------------------------------------------


@pytest.mark.parametrize("dims", [64, 300])
def test_components_of_a_matrix_known_by_products(dims):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((4 * dims, dims)) * np.linspace(2, 0.5, dims)
    v = x.T @ x / len(x)
    values, axes = whitening.leading_components(lambda q: v @ q, dims, 4)
    want, vectors = np.linalg.eigh(v)
    assert np.allclose(values, want[::-1][:4], rtol=1e-13)
    assert np.all(np.linalg.norm(v @ axes - axes * values, axis=0) < 1e-12 * values[0])
    assert np.allclose(np.abs(np.sum(axes * vectors[:, ::-1][:, :4], axis=0)), 1, atol=1e-13)


def test_minres_solves_indefinite_systems():
    rng = np.random.default_rng(8)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    a = (q * np.concatenate([np.linspace(-3, -1, 10), np.linspace(1, 4, 20)])) @ q.T
    b = rng.standard_normal((30, 3))
    assert np.allclose(whitening.minres(lambda p: a @ p, b, 40, 1e-13), np.linalg.solve(a, b), atol=1e-10)


def whitened_by_force(rows, k=4):
    usable = [(i, np.array([math.floor(256 * c) for c in v])) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.unique(np.array([x for _, x in usable]), axis=0)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    mean = fit.mean(axis=0)
    v = (fit - mean).T @ (fit - mean) / n
    values, vectors = np.linalg.eigh(v)
    out = {}
    for i, x in usable:
        deviation = sum((n * int(a) - s) ** 2 for a, s in zip(x, sums))
        for c in range(min(k, len(values))):
            e, u = values[-1 - c], vectors[:, -1 - c]
            if e > 1e-12 * values.sum():
                out.setdefault((i, c + 1), []).append((n, deviation, abs((x - mean) @ u / math.sqrt(e)), e / values.sum()))
    return out


@pytest.mark.parametrize("rows_of_block", [4096, 16])
def test_whitening(spark, monkeypatch, rows_of_block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", rows_of_block)
    rng = np.random.default_rng(9)
    rows = [(i, (rng.standard_normal(20) * np.linspace(1.0, 0.1, 20)).astype(np.float32).tolist(), i % 3) for i in range(400)]
    rows += [(1000 + i, rows[5][1], None) for i in range(200)]  # a vector that a third of all rows have
    rows += [(5, rows[5][1], 1), (5, rows[5][1], 1), (None, rows[6][1], 1), (2000, None, 1), (2001, [None] + [1.0] * 19, 1), (2002, [float("nan")] * 20, 1), (2003, [], 1)]
    rows += [(2004, [-0.0] * 20, 1), (2005, [0.0] * 20, 1)]
    got = whitening.whitened_vectors(vectors_of(spark, rows)).collect()
    want = whitened_by_force(rows)
    assert len(got) == sum(map(len, want.values())) == 4 * 605
    for r in got:
        n, deviation, whitened, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - whitened) < 1e-10 and abs(r.explained - explained) < 1e-12 and r.identity_error < 1e-10
    one = {r.vec_id: r.whitened for r in got if r.component == 1}
    assert len({round(one[1000 + i], 12) for i in range(200)}) == 1 and math.isclose(one[2004], one[2005])


def test_whitening_without_variance_and_of_large_numbers(spark):
    def whitened(rows, kind="double"):
        return whitening.whitened_vectors(vectors_of(spark, rows, kind)).collect()

    assert whitened([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]) == []
    assert whitened([(1, None, 1), (2, [], 1)]) == []
    line = whitened([(i, [float(i), 2.0 * i, 1.0], 1) for i in range(5)])
    assert {r.component for r in line} == {1} and len(line) == 5 and all(abs(r.explained - 1) < 1e-12 for r in line)
    wide = whitened([(i, [1e12 * i, 5.0 * i * i], 1) for i in range(6)] + [(9, [1e300, 0.0], 1)])
    assert {r.vec_id for r in wide} == set(range(6)) and all(r.deviation is None for r in wide if r.vec_id == 0)
    assert {round(r.identity_error, 4) for r in wide} == {0.0}
    none = vectors_of(spark, [(1, [1.0], 1)]).where("vec_id < 0")
    assert whitening.whitened_vectors(none).collect() == []
    with pytest.raises(ValueError, match="1 to 2 components"):
        whitening.whitened_vectors(vectors_of(spark, [(1, [1.0], 1), (2, [1.0, 2.0], 1)]))


def test_scratch_path_is_in_the_shared_folder(spark):
    scratch = Scratch(spark, "paths")
    assert scratch.path("x").endswith(f"{scratch.database}.db/x")
