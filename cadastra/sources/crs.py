"""Coordinate systems by their parameters: from EPSG numbers by rule, from WKT of either version and from PROJJSON.

A system is a list of numbers that the kernel projects with: method, semi-major axis, flattening, latitude and longitude
of origin, two parallels, scale, false easting and northing in metres, metres in a unit. Methods are longitude and
latitude, Lambert's conformal conic (one parallel or two), transverse Mercator, Albers and Mercator. Datums that agree to
a metre or two (WGS 84, NAD83, ETRS89 and the like) count as one, as their shifts are smaller than the layers' errors;
a datum that would need a real shift, another prime meridian or another method is an error, not a guess.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import astuple, dataclass

LONLAT, LAMBERT, TRANSVERSE, ALBERS, MERCATOR = range(5)
# Semi-major axes and inverse flattenings.
GRS80, WGS84 = (6378137.0, 298.257222101), (6378137.0, 298.257223563)
US_FOOT = 1200 / 3937


class UnknownSystem(ValueError):
    """A description that isn't understood, or a system that isn't projected here."""


@dataclass(frozen=True)
class System:
    method: int = LONLAT
    a: float = GRS80[0]
    f: float = 1 / GRS80[1]
    lat0: float = 0.0
    lon0: float = 0.0
    sp1: float = 0.0
    sp2: float = 0.0
    k0: float = 1.0
    fe: float = 0.0
    fn: float = 0.0
    unit: float = 1.0

    def numbers(self) -> list[float]:
        return [float(v) for v in astuple(self)]


def _maryland(unit: float) -> System:
    return System(LAMBERT, lat0=37 + 2 / 3, lon0=-77.0, sp1=39.45, sp2=38.3, fe=400000.0, unit=unit)


def utm(zone: int, south: bool = False, ellipsoid: tuple[float, float] = WGS84) -> System:
    return System(TRANSVERSE, ellipsoid[0], 1 / ellipsoid[1], lon0=6.0 * zone - 183, k0=0.9996, fe=500000.0, fn=1e7 if south else 0.0)


def of_epsg(code: int) -> System | None:
    """Systems known by number: geographic ones, the working plane and its feet, Mercator's of the web, UTM zones, Albers of the United States."""
    # EPSG numbers.
    if code in (4326, 4269, 4258, 4979):
        return System(f=1 / (WGS84 if code in (4326, 4979) else GRS80)[1])
    if code in (26985, 2248):
        return _maryland(1.0 if code == 26985 else US_FOOT)
    if code == 3857:
        return System(MERCATOR, f=0.0)
    if code == 5070:
        return System(ALBERS, lat0=23.0, lon0=-96.0, sp1=29.5, sp2=45.5)
    for first, last, south, ellipsoid in ((32600, 60, False, WGS84), (32700, 60, True, WGS84), (26900, 23, False, GRS80), (25800, 60, False, GRS80)):
        if first < code <= first + last:
            return utm(code - first, south, ellipsoid)
    return None


# ---- names and descriptions ----------------------------------------------------
PARAMETERS = {
    "lat0": "latitude_of_origin latitude_of_natural_origin latitude_of_false_origin latitude_of_center latitude_of_projection_centre",
    "lon0": "central_meridian longitude_of_origin longitude_of_natural_origin longitude_of_false_origin longitude_of_center longitude_of_projection_centre",
    "sp1": "standard_parallel_1 latitude_of_1st_standard_parallel",
    "sp2": "standard_parallel_2 latitude_of_2nd_standard_parallel",
    "k0": "scale_factor scale_factor_at_natural_origin",
    "fe": "false_easting easting_at_false_origin easting_at_projection_centre",
    "fn": "false_northing northing_at_false_origin northing_at_projection_centre",
}
PARAMETER_OF = {n: k for k, names in PARAMETERS.items() for n in names.split()}
METHODS = (("pseudo_mercator|auxiliary_sphere", MERCATOR), ("transverse_mercator|gauss_kruger", TRANSVERSE), ("lambert_conformal_conic|lambert_conic_conformal", LAMBERT), ("albers", ALBERS), ("mercator", MERCATOR))
#: Datums that lie tens of metres and more from the others.
SHIFTED = re.compile(r"1927|NAD_?27|OSGB|European_Datum_1950|ED_?50|Pulkovo|Tokyo|Potsdam|DHDN|NAD_1927|AGD|Bessel", re.IGNORECASE)
_word = lambda s: re.sub(r"[^a-z0-9]+", "_", str(s).lower()).strip("_")


def tree(wkt: str) -> list:
    """Nested lists: a keyword, then its values, strings, numbers and lists."""
    tokens = re.findall(r'"((?:[^"]|"")*)"|([A-Za-z_][A-Za-z_0-9]*)|([-+]?[0-9.]+(?:[eE][-+]?\d+)?)|([\[\](),])', wkt)
    stack: list[list] = [[]]
    for text, word, number, mark in tokens:
        if mark in ("[", "("):
            stack.append([stack[-1].pop()])
        elif mark in ("]", ")"):
            done = stack.pop()
            if not stack:
                raise UnknownSystem("brackets don't match")
            stack[-1].append(done)
        elif word:
            stack[-1].append(word.upper())
        elif number:
            stack[-1].append(float(number))
        elif not mark:
            stack[-1].append(text.replace('""', '"'))
    if len(stack) != 1 or not stack[0] or not isinstance(stack[0][0], list):
        raise UnknownSystem("this is no description of a coordinate system")
    return stack[0][0]


def _find(node: list, *words: str) -> list | None:
    """The first such node, this one's own members before deeper ones."""
    for x in node[1:]:
        if isinstance(x, list) and x[0] in words:
            return x
    for x in node[1:]:
        if isinstance(x, list) and (found := _find(x, *words)):
            return found
    return None


def _system(method: str | None, values: dict[str, float], ellipsoid: tuple[float, float], datum: str, meridian: float, unit: float) -> System:
    if SHIFTED.search(datum.replace(" ", "_")):
        raise UnknownSystem(f"the datum {datum} needs a shift, which is not made here")
    if meridian:
        raise UnknownSystem("other prime meridians than Greenwich are not read here")
    a, inverse = ellipsoid
    f = 1 / inverse if inverse else 0.0
    if method is None:
        return System(a=a, f=f)
    kind = next((k for pattern, k in METHODS if re.search(pattern, _word(method))), None)
    if kind is None or re.search("oblique|south_orient", _word(method)):
        raise UnknownSystem(f"the projection {method} is not read here")
    if kind == MERCATOR and re.search(METHODS[0][0], _word(method)):
        f = 0.0
    if kind == LAMBERT and "sp1" not in values:
        values = values | {"sp1": values.get("lat0", 0.0), "sp2": values.get("lat0", 0.0)}
    if kind in (LAMBERT, ALBERS) and "sp2" not in values:
        values = values | {"sp2": values["sp1"]}
    if kind == MERCATOR and values.get("sp1"):
        e2, phi = f * (2 - f), math.radians(values["sp1"])
        values = values | {"k0": math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)}
    return System(kind, a, f, unit=unit, **values)


def of_wkt(text: str) -> System:
    top = tree(text)
    if top[0] in ("COMPD_CS", "COMPOUNDCRS", "BOUNDCRS"):
        top = _find(top, "PROJCS", "PROJCRS", "PROJECTEDCRS", "GEOGCS", "GEOGCRS", "GEODCRS") or top
    if (named := [x for x in top[1:] if isinstance(x, list) and x[0] in ("AUTHORITY", "ID") and str(x[1]).upper() == "EPSG"]) and (own := of_epsg(int(float(named[0][2])))):
        return own
    ball, datum, meridian = _find(top, "SPHEROID", "ELLIPSOID"), _find(top, "DATUM", "ENSEMBLE", "GEODETICDATUM"), _find(top, "PRIMEM", "PRIMEMERIDIAN")
    if ball is None or top[0] not in ("PROJCS", "PROJCRS", "PROJECTEDCRS", "GEOGCS", "GEOGCRS", "GEODCRS", "GEOGRAPHICCRS"):
        raise UnknownSystem(f"{top[0]} is not read here")
    own = {"datum": str(datum[1]) if datum else "", "meridian": meridian[2] if meridian else 0.0, "ellipsoid": (ball[2], ball[3])}
    if top[0].startswith("GEO"):
        return _system(None, {}, unit=1.0, **own)
    method = _find(top, "PROJECTION", "METHOD")
    lengths = [x for x in top[1:] if isinstance(x, list) and x[0] in ("UNIT", "LENGTHUNIT")] or [x for axis in top[1:] if isinstance(axis, list) and axis[0] == "AXIS" for x in axis[1:] if isinstance(x, list) and x[0] in ("UNIT", "LENGTHUNIT")]
    unit = float(lengths[0][2]) if lengths else 1.0
    values = {}
    for p in _all(top, "PARAMETER"):
        if key := PARAMETER_OF.get(_word(p[1])):
            own_unit = next((x for x in p[3:] if isinstance(x, list) and x[0] in ("LENGTHUNIT", "ANGLEUNIT", "UNIT", "SCALEUNIT")), None)
            values[key] = _value(key, float(p[2]), own_unit[2] if own_unit else None, unit)
    return _system(method[1] if method else "none", values, unit=unit, **own)


def _all(node: list, word: str) -> list[list]:
    return [x for y in node[1:] if isinstance(y, list) for x in ([y] if y[0] == word else _all(y, word))]


def _value(key: str, value: float, own: float | None, unit: float) -> float:
    """Lengths in metres, angles in degrees."""
    if key in ("fe", "fn"):
        return value * (unit if own is None else own)
    if key == "k0" or own is None:
        return value
    return value if abs(own - math.pi / 180) < 1e-9 else math.degrees(value * own)


def of_projjson(doc: dict) -> System:
    doc = doc.get("source_crs", doc)
    doc = doc["components"][0] if "components" in doc else doc
    own = doc.get("id") or {}
    if own.get("authority") == "OGC":
        return of_epsg(4326)
    if own.get("authority") == "EPSG" and (found := of_epsg(int(own["code"]))):
        return found
    base = doc.get("base_crs", doc)
    datum = base.get("datum") or base.get("datum_ensemble") or {}
    ball = datum.get("ellipsoid")
    if not ball:
        raise UnknownSystem("the description has no ellipsoid")
    size = lambda v: v["value"] if isinstance(v, dict) else v
    a = float(size(ball.get("semi_major_axis", ball.get("radius", 0))))
    inverse = float(ball["inverse_flattening"]) if "inverse_flattening" in ball else a / (a - float(size(ball["semi_minor_axis"]))) if "semi_minor_axis" in ball and float(size(ball["semi_minor_axis"])) != a else 0.0
    meridian = float(size((datum.get("prime_meridian") or {}).get("longitude", 0.0)))
    told = {"datum": str(datum.get("name", "")), "meridian": meridian, "ellipsoid": (a, inverse)}
    if "conversion" not in doc:
        return _system(None, {}, unit=1.0, **told)
    factor = lambda u, one: one if isinstance(u, str) else float(u.get("conversion_factor", one))
    axis = (doc.get("coordinate_system") or {}).get("axis") or [{}]
    unit = factor(axis[0].get("unit", "metre"), 1.0)
    values = {}
    for p in doc["conversion"].get("parameters", []):
        if key := PARAMETER_OF.get(_word(p["name"])):
            u = p.get("unit", "")
            values[key] = _value(key, float(p["value"]), None if key == "k0" else factor(u, 1.0 if key in ("fe", "fn") else math.pi / 180), unit)
    return _system(doc["conversion"]["method"]["name"], values, unit=unit, **told)


def projjson(system: System, name: str, epsg: int | None = None) -> dict:
    """A projected system's description, as GeoParquet files carry it."""
    degrees, metres = "degree", "metre" if system.unit == 1 else {"type": "LinearUnit", "name": "unit", "conversion_factor": system.unit}
    lambert, albers = system.method == LAMBERT, system.method == ALBERS
    method = {LAMBERT: "Lambert Conic Conformal (2SP)", ALBERS: "Albers Equal Area", TRANSVERSE: "Transverse Mercator", MERCATOR: "Mercator (variant A)"}[system.method]
    origin = "false" if lambert or albers else "natural"
    values = [(f"Latitude of {origin} origin", system.lat0, degrees), (f"Longitude of {origin} origin", system.lon0, degrees)]
    values += [("Latitude of 1st standard parallel", system.sp1, degrees), ("Latitude of 2nd standard parallel", system.sp2, degrees), ("Easting at false origin", system.fe, "metre"), ("Northing at false origin", system.fn, "metre")] if origin == "false" else [("Scale factor at natural origin", system.k0, "unity"), ("False easting", system.fe, "metre"), ("False northing", system.fn, "metre")]
    axes = lambda names, unit: [{"name": n, "abbreviation": a, "direction": d, "unit": unit} for n, a, d in names]
    base = {"name": "NAD83", "datum": {"type": "GeodeticReferenceFrame", "name": "North American Datum 1983", "ellipsoid": {"name": "GRS 1980", "semi_major_axis": system.a, "inverse_flattening": 1 / system.f}}, "coordinate_system": {"subtype": "ellipsoidal", "axis": axes((("Geodetic latitude", "Lat", "north"), ("Geodetic longitude", "Lon", "east")), degrees)}}
    out = {"$schema": "https://proj.org/schemas/v0.7/projjson.schema.json", "type": "ProjectedCRS", "name": name, "base_crs": base, "conversion": {"name": name, "method": {"name": method}, "parameters": [{"name": n, "value": v, "unit": u} for n, v, u in values]}, "coordinate_system": {"subtype": "Cartesian", "axis": axes((("Easting", "X", "east"), ("Northing", "Y", "north")), metres)}}
    return out | ({"id": {"authority": "EPSG", "code": epsg}} if epsg else {})


def of_text(text: str) -> System:
    """A name, a URN, an EPSG number, WKT or PROJJSON."""
    text = text.strip()
    if text.startswith("{"):
        return of_projjson(json.loads(text))
    if re.search(r"CRS:?:?84|CRS84", text) and "[" not in text:
        return of_epsg(4326)
    if "[" in text:
        return of_wkt(text)
    found = re.search(r"(?:EPSG[:/,\s]*(?:[0-9.]*:)?\s*)?(\d{4,5})$", text)
    if found and (own := of_epsg(int(found[1]))):
        return own
    raise UnknownSystem(f"the coordinate system {text[:80]!r} is not known here; a description of it (WKT or PROJJSON) would be read")
