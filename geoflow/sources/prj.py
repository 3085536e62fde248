"""Coordinate systems in the text that stands beside a Shapefile."""

from __future__ import annotations

import re

from ..functions.crs import GRS80_FLATTENING, LAMBERT, UTM, UTM_FALSE_EASTING, UTM_SCALE, WEB_MERCATOR, WGS84_FLATTENING, check_srid

# Names of the systems in this format.
NAMES = {
    2154: "RGF_1993_Lambert_93", 3857: "WGS_1984_Web_Mercator_Auxiliary_Sphere", 3945: "RGF_1993_CC45", 3946: "RGF_1993_CC46",
    32631: "WGS_1984_UTM_Zone_31N", 32632: "WGS_1984_UTM_Zone_32N",
}
_CONE = ("standard_parallel_1", "standard_parallel_2", "latitude_of_origin", "central_meridian", "false_easting", "false_northing")


def _geographic(datum: str, spheroid: str, flattening: float) -> str:
    return (
        f'GEOGCS["GCS_{datum}",DATUM["D_{datum}",SPHEROID["{spheroid}",6378137.0,{1 / flattening:.9f}]],'
        'PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
    )


def prj_text(srid: int) -> str:
    check_srid(srid)
    french = srid == 4171 or srid in LAMBERT
    base = _geographic("RGF_1993", "GRS_1980", GRS80_FLATTENING) if french else _geographic("WGS_1984", "WGS_1984", WGS84_FLATTENING)
    if srid in LAMBERT:
        projection, values = "Lambert_Conformal_Conic", dict(zip(_CONE, LAMBERT[srid], strict=True))
    elif srid in UTM:
        projection = "Transverse_Mercator"
        values = {"false_easting": UTM_FALSE_EASTING, "false_northing": 0.0, "central_meridian": UTM[srid], "scale_factor": UTM_SCALE,
                  "latitude_of_origin": 0.0}
    elif srid == WEB_MERCATOR:
        projection = "Mercator_Auxiliary_Sphere"
        values = {"false_easting": 0.0, "false_northing": 0.0, "central_meridian": 0.0, "standard_parallel_1": 0.0, "auxiliary_sphere_type": 0.0}
    else:
        return base
    parameters = "".join(f'PARAMETER["{name.title()}",{value}],' for name, value in values.items())
    return f'PROJCS["{NAMES[srid]}",{base},PROJECTION["{projection}"],{parameters}UNIT["Meter",1.0]]'


def _close(found: dict[str, float], wanted: dict[str, float]) -> bool:
    return all(abs(found.get(name, 0.0) - value) < 1e-6 for name, value in wanted.items())


def srid_of_prj(text: str) -> int:
    """The code at the end of the text, or else the system with the same projection and parameters; others raise."""
    code = re.search(r'AUTHORITY\["EPSG",\s*"?(\d+)"?\]\s*\]\s*$', text)
    if code:
        return check_srid(int(code.group(1)))
    named = re.search(r'PROJECTION\["([^"]+)"', text)
    wgs = re.search(r'DATUM\["[^"]*WGS', text) is not None
    rgf = re.search(r'DATUM\["[^"]*(RGF|Reseau_Geodesique_Francais)', text) is not None
    if named is None and (wgs or rgf):
        return 4326 if wgs else 4171
    if named is not None:
        kind = named.group(1).lower()
        values = {name.lower(): float(value) for name, value in re.findall(r'PARAMETER\["([^"]+)",\s*([-+.\deE]+)', text)}
        if "lambert_conformal_conic" in kind and rgf:
            low, high = sorted((values.get("standard_parallel_1", 0.0), values.get("standard_parallel_2", 0.0)))
            values |= {"standard_parallel_1": low, "standard_parallel_2": high}
            for srid, cone in LAMBERT.items():
                if _close(values, dict(zip(_CONE, cone, strict=True))):
                    return srid
        if kind == "transverse_mercator" and wgs:
            for srid, meridian in UTM.items():
                if _close(values, {"central_meridian": meridian, "scale_factor": UTM_SCALE, "false_easting": UTM_FALSE_EASTING, "false_northing": 0.0}):
                    return srid
        web = {"false_easting": 0.0, "false_northing": 0.0, "central_meridian": 0.0, "standard_parallel_1": 0.0}
        if kind == "mercator_auxiliary_sphere" and wgs and _close(values, web):
            return WEB_MERCATOR
    raise ValueError(f"unknown coordinate system, give srid: {text[:120]}")
