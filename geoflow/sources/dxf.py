"""CAD drawings (ASCII DXF): points, lines, polylines, circles and arcs per layer."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..functions.geometry import GEOM_DDL
from ..functions.layer import GEOM, describe

CIRCLE_SIDES = 64
BATCH_ROWS = 4096

Codes = list[tuple[int, str]]


def _pairs(text: str) -> Iterator[tuple[int, str]]:
    lines = iter(text.splitlines())
    for code in lines:
        value = next(lines, None)
        if value is None:
            return
        yield int(code), value.strip()


def _entities(text: str) -> Iterator[tuple[str, list[tuple[int, str]]]]:
    """(kind, group codes) of the entities section."""
    section, waiting, kind, codes = None, False, None, []
    for code, value in _pairs(text):
        if code == 0:
            if kind and section == "ENTITIES":
                yield kind, codes
            kind, codes = (None, []) if value in ("SECTION", "ENDSEC", "EOF") else (value, [])
            waiting = value == "SECTION"
            section = None if value == "ENDSEC" else section
        elif waiting and code == 2:
            section, waiting = value, False
        else:
            codes.append((code, value))


def _numbers(codes: Codes, group: int) -> list[float]:
    return [float(v) for c, v in codes if c == group]


def _number(codes: Codes, group: int) -> float:
    found = _numbers(codes, group)
    if not found:
        raise ValueError(f"group {group} is missing")
    return found[0]


def _turn(x: float, y: float, radius: float, start: float, angle: float) -> list[tuple[float, float]]:
    """Points of an arc, its ends included; a whole turn has CIRCLE_SIDES steps."""
    steps = max(1, math.ceil(abs(angle) * CIRCLE_SIDES / (2 * math.pi) - 1e-9))
    return [(x + radius * math.cos(start + angle * i / steps), y + radius * math.sin(start + angle * i / steps)) for i in range(steps + 1)]


def _bulged(p: tuple[float, float], q: tuple[float, float], bulge: float) -> list[tuple[float, float]]:
    """Points between two vertices; the bulge is the tangent of a quarter of the arc's angle, positive to the left."""
    if bulge == 0 or p == q:
        return []
    off = (1 - bulge * bulge) / (4 * bulge)
    x = (p[0] + q[0]) / 2 - off * (q[1] - p[1])
    y = (p[1] + q[1]) / 2 + off * (q[0] - p[0])
    return _turn(x, y, math.dist(p, (x, y)), math.atan2(p[1] - y, p[0] - x), 4 * math.atan(bulge))[1:-1]


def _polyline(vertices: list[tuple[float, float, float]], closed: bool) -> dict:
    path = []
    following = vertices[1:] + (vertices[:1] if closed else [])
    for (x, y, bulge), after in zip(vertices, following, strict=False):
        path += [(x, y), *_bulged((x, y), after[:2], bulge)]
    path += [v[:2] for v in (vertices[:1] if closed else vertices[-1:])]
    if len(path) < 2:
        raise ValueError("fewer than two vertices")
    return _shape("Polygon" if closed and len(path) >= 4 else "LineString", path)


def _shape(kind: str, path: list[tuple[float, float]]) -> dict:
    if not all(math.isfinite(c) for v in path for c in v):
        raise ValueError("a coordinate is not finite")
    return {"type": kind, "parts": [[[{"x": x, "y": y} for x, y in path]]]}


def _light_vertices(codes: Codes) -> list[tuple[float, float, float]]:
    """Vertices of a light polyline: each group 10 begins one, 20 and 42 belong to the last one."""
    found: list[dict[int, float]] = []
    for code, value in codes:
        if code == 10:
            found.append({10: float(value)})
        elif code in (20, 42) and found:
            found[-1][code] = float(value)
    if any(20 not in v for v in found):
        raise ValueError("a vertex has no y")
    return [(v[10], v[20], v.get(42, 0.0)) for v in found]


def _is_closed(codes: Codes) -> bool:
    return any(c == 70 and int(v) & 1 for c, v in codes)


def _geometry(kind: str, codes: Codes) -> dict | None:
    """The geometry of an entity, None for kinds that are not read; values that can't be used raise an error."""
    if kind == "POINT":
        return _shape("Point", [(_number(codes, 10), _number(codes, 20))])
    if kind == "LINE":
        return _shape("LineString", [(_number(codes, 10), _number(codes, 20)), (_number(codes, 11), _number(codes, 21))])
    if kind == "LWPOLYLINE":
        return _polyline(_light_vertices(codes), _is_closed(codes))
    if kind in ("CIRCLE", "ARC"):
        x, y, radius = (_number(codes, g) for g in (10, 20, 40))
        if kind == "CIRCLE":
            ring = _turn(x, y, radius, 0.0, 2 * math.pi)
            return _shape("Polygon", [*ring[:-1], ring[0]])
        start, end = (math.radians(_number(codes, g)) for g in (50, 51))
        return _shape("LineString", _turn(x, y, radius, start, (end - start) % (2 * math.pi) or 2 * math.pi))
    return None


def _with_vertices(entities: Iterator[tuple[str, Codes]]) -> Iterator[tuple[str, Codes, list[tuple[float, float, float]] | None]]:
    """Old polylines come with the vertices that follow them as entities of their own, up to the end of the sequence."""
    held: tuple[str, Codes, list] | None = None
    for kind, codes in entities:
        if held and kind == "VERTEX":
            held[2].append(codes)
            continue
        if held:
            yield held
            held = None
        if kind == "POLYLINE":
            held = (kind, codes, [])
        elif kind != "SEQEND":
            yield kind, codes, None
    if held:
        yield held


def _old_polyline(codes: Codes, members: list[Codes]) -> dict:
    return _polyline([(_number(v, 10), _number(v, 20), next(iter(_numbers(v, 42)), 0.0)) for v in members], _is_closed(codes))


def _rows(path: str, text: str, wanted: set[str], keep_rejected: bool) -> Iterator[tuple]:
    for kind, codes, members in _with_vertices(_entities(text)):
        layer = next((v for c, v in codes if c == 8), "0")
        if wanted and layer not in wanted:
            continue
        shape, reason = None, None
        try:
            shape = _geometry(kind, codes) if members is None else _old_polyline(codes, members)
            reason = None if shape else f"{kind} is not read"
        except ValueError as fault:
            if not keep_rejected:
                raise ValueError(f"{path}: {kind} of layer {layer}: {fault}") from fault
            reason = str(fault)
        if shape or keep_rejected:
            yield path, next((v for c, v in codes if c == 5), None), layer, kind, shape, reason


def parse_dxf_files(
    files: DataFrame, srid: int = 4326, layers: str | None = None, geom: str = GEOM, keep_rejected: bool = False
) -> DataFrame:
    """Entities of drawings given as ``path, content`` rows: ``path, handle, layer, entity`` and the geometry.

    POINT, LINE, LWPOLYLINE and POLYLINE with their bulges, CIRCLE and ARC; curves become CIRCLE_SIDES steps a turn.
    ``layers`` is a comma-separated list, empty for all.  Other kinds of entities are skipped and values that can't be used
    raise an error; with ``keep_rejected`` both come out without a geometry and with a ``reject_reason``.
    """
    wanted = {name.strip() for name in (layers or "").split(",") if name.strip()}
    columns = ["path", "handle", "layer", "entity", geom, "reject_reason"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                if content is None:
                    continue
                rows = _rows(path, bytes(content).decode("utf-8", "replace"), wanted, keep_rejected)
                while part := list(itertools.islice(rows, BATCH_ROWS)):
                    yield pd.DataFrame(part, columns=columns)

    ddl = f"path string, handle string, layer string, entity string, {geom} {GEOM_DDL}, reject_reason string"
    layer = describe(files.select("path", "content").mapInPandas(read, ddl), geom, srid=srid)
    return layer if keep_rejected else layer.drop("reject_reason")
