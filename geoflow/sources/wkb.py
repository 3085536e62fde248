"""Well-known binary for single geometries, used inside Python tasks."""

from __future__ import annotations

import struct

import numpy as np

# OGC geometry type codes.
CODES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}
NAMES = {code: name for name, code in CODES.items()}
_SRID_FLAG, _Z_FLAG, _M_FLAG = 0x20000000, 0x80000000, 0x40000000


def _points(ring: list) -> bytes:
    return np.array([(p["x"], p["y"]) for p in ring], dtype="<f8").tobytes()


def _body(name: str, part: list) -> bytes:
    if name == "Point":
        return _points(part[0])
    if name == "LineString":
        return struct.pack("<I", len(part[0])) + _points(part[0])
    return struct.pack("<I", len(part)) + b"".join(struct.pack("<I", len(r)) + _points(r) for r in part)


def encode(geom: dict | None) -> bytes | None:
    """Little-endian WKB of a geometry struct."""
    if geom is None or geom["type"] is None:
        return None
    name, parts = geom["type"], geom["parts"]
    head = struct.pack("<BI", 1, CODES[name])
    if not name.startswith("Multi"):
        return head + _body(name, parts[0])
    single = name.removeprefix("Multi")
    member = struct.pack("<BI", 1, CODES[single])
    return head + struct.pack("<I", len(parts)) + b"".join(member + _body(single, p) for p in parts)


class _Reader:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def geometry(self) -> tuple[str, list]:
        order = "<" if self.data[self.at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", self.data, self.at + 1)
        self.at += 5
        if code & _SRID_FLAG:
            self.at += 4
        dims = 2 + bool(code & _Z_FLAG) + bool(code & _M_FLAG)
        code &= 0x0FFFFFFF
        if code >= 1000:
            dims = 4 if code >= 3000 else 3
            code %= 1000
        name = NAMES.get(code)
        if name is None:
            raise ValueError(f"unsupported WKB geometry type {code}")
        if name.startswith("Multi"):
            parts = []
            for _ in range(self._count(order)):
                parts += self.geometry()[1]
            return name, parts
        if name == "Point":
            return name, [[self._ring(order, dims, 1)]]
        if name == "LineString":
            return name, [[self._ring(order, dims, self._count(order))]]
        return name, [[self._ring(order, dims, self._count(order)) for _ in range(self._count(order))]]

    def _count(self, order: str) -> int:
        (n,) = struct.unpack_from(order + "I", self.data, self.at)
        self.at += 4
        return n

    def _ring(self, order: str, dims: int, n: int) -> list:
        values = np.frombuffer(self.data, dtype=order + "f8", count=n * dims, offset=self.at).reshape(n, dims)
        self.at += 8 * n * dims
        return [{"x": float(v[0]), "y": float(v[1])} for v in values]


def decode(data: bytes | None) -> dict | None:
    """Geometry struct of WKB or EWKB bytes; extra dimensions are dropped, empty points are null."""
    if not data:
        return None
    name, parts = _Reader(bytes(data)).geometry()
    if name == "Point" and np.isnan(parts[0][0][0]["x"]):
        return None
    return {"type": name, "parts": parts}
