"""Builds and registers the kernel, once for each session, and wraps it as column functions."""

from __future__ import annotations

import hashlib
import os
import shutil
import subprocess
import tempfile
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE = Path(__file__).with_name("Kernel.java")
SHAPE = "struct<minx:double,miny:double,maxx:double,maxy:double,area:double,length:double,cx:double,cy:double>"
POSITION = "struct<dx:double,dy:double,contact:double,touches:boolean,pieces:int,largest:double>"
FRONTAGE = "struct<contact:double,pieces:array<struct<seq:int,piece:binary,length:double,inside:binary,way:binary,distance:double,probe:binary>>>"
OVERLAP = "struct<geom:binary,m2:double>"
RETURNS = {"Overlap": OVERLAP, "Box": "binary", "Hilbert": "long", "Path": "binary", "LonLat": "binary", "Scaled": "binary", "Unary": "binary", "Measure": "double", "Shape": SHAPE, "Binary": "binary", "Between": "double", "Buffer": "binary", "UnionAll": "binary", "Parts": "array<binary>", "Subdivide": "array<binary>", "PartCount": "int", "LineRuns": "int", "Lambert": "binary", "Reproject": "binary", "Position": POSITION, "Frontage": FRONTAGE}
# EPSG:26985, both parallels, origin latitude and longitude, false easting and northing.
EPSG_26985 = (39.45, 38.3, 37.0 + 2.0 / 3.0, -77.0, 400000.0, 0.0)


def _jar() -> str:
    """The compiled kernel, kept by a hash of its source."""
    import pyspark

    text = SOURCE.read_bytes()
    at = Path(tempfile.gettempdir()) / f"cadastra-kernel-{os.getuid()}-{hashlib.sha256(text).hexdigest()[:16]}.jar"
    if at.exists():
        return str(at)
    jars = Path(os.environ.get("SPARK_HOME") or Path(pyspark.__file__).parent) / "jars"
    if not list(jars.glob("jts-core-*.jar")):
        raise RuntimeError("the geometry kernel needs jts-core among Spark's jars")
    javac = shutil.which("javac") or str(Path(os.environ.get("JAVA_HOME", "")) / "bin" / "javac")
    with tempfile.TemporaryDirectory() as work:
        subprocess.run([javac, "-nowarn", "-cp", f"{jars}/*", "-d", work, str(SOURCE)], check=True, capture_output=True)
        made = shutil.make_archive(f"{work}-jar", "zip", work)
        os.replace(shutil.move(made, f"{at}.{os.getpid()}"), at)
    return str(at)


def register(spark: SparkSession) -> None:
    if spark.conf.get("spark.cadastra.kernel", "") == "ready":
        return
    spark.sql(f"ADD JAR '{_jar()}'")
    for name, kind in RETURNS.items():
        spark.udf.registerJavaFunction(f"geo_{name.lower()}", f"cadastra.Kernel${name}", T._parse_datatype_string(kind))
    spark._jvm.org.apache.spark.util.Utils.classForName("cadastra.Kernel$Aggregates", True, False).newInstance().accept(spark._jsparkSession)
    spark.conf.set("spark.cadastra.kernel", "ready")


def _call(name: str, *args) -> Column:
    return F.call_function(f"geo_{name}", *[F.col(a) if isinstance(a, str) else a for a in args])


def area(g) -> Column:
    return _call("measure", F.lit("area"), g)


def length(g) -> Column:
    return _call("measure", F.lit("length"), g)


def is_empty(g) -> Column:
    return _call("measure", F.lit("empty"), g) == 1.0


def shape(g) -> Column:
    return _call("shape", g)


def boundary(g) -> Column:
    return _call("unary", F.lit("boundary"), g)


def make_valid(g) -> Column:
    return _call("unary", F.lit("make_valid"), g)


def areal(g) -> Column:
    return _call("unary", F.lit("areal"), g)


def lineal(g) -> Column:
    """The lines of a shape."""
    return _call("unary", F.lit("lineal"), g)


def centroid(g) -> Column:
    return _call("unary", F.lit("centroid"), g)


def start_point(g) -> Column:
    return _call("unary", F.lit("start_point"), g)


def intersection(a, b) -> Column:
    return _call("binary", F.lit("intersection"), a, b)


def areal_intersection(a, b) -> Column:
    return _call("binary", F.lit("areal_intersection"), a, b)


def areal_difference(a, b) -> Column:
    return _call("binary", F.lit("areal_difference"), a, b)


def difference(a, b) -> Column:
    return _call("binary", F.lit("difference"), a, b)


def distance(a, b) -> Column:
    return _call("between", F.lit("distance"), a, b)


def intersects(a, b) -> Column:
    return _call("between", F.lit("intersects"), a, b) == 1.0


def contains(a, b) -> Column:
    return _call("between", F.lit("contains"), a, b) == 1.0


def within(a, b) -> Column:
    return _call("between", F.lit("within"), a, b) == 1.0


def overlap_area(a, b) -> Column:
    return _call("between", F.lit("overlap_area"), a, b)


def overlap_length(a, b) -> Column:
    return _call("between", F.lit("overlap_length"), a, b)


def buffer(g, metres: float, flat: bool = False) -> Column:
    return _call("buffer", g, F.lit(float(metres)), F.lit(flat))


def union_all(gs) -> Column:
    return _call("unionall", gs)


def union_agg(g) -> Column:
    """The union of a group's shapes as an aggregate with partial unions; of no shapes it is empty."""
    return _call("union", g)


def dissolve_agg(g) -> Column:
    """As ``union_agg``, but a single shape stays as it is, and no shapes are null."""
    return _call("dissolve", g)


def subdivide(g, points: int, side: float) -> Column:
    """Pieces of a shape with at most so many points and so long sides of their boxes."""
    return _call("subdivide", g, F.lit(points), F.lit(float(side)))


def parts(g) -> Column:
    return _call("parts", g)


def part_count(g, least_m2: float) -> Column:
    return _call("partcount", g, F.lit(float(least_m2)))


def line_runs(gs) -> Column:
    return _call("lineruns", gs)


def overlap(a, b) -> Column:
    """(geom, m2): the areal part that two shapes share, empty where they only touch; null where they are apart."""
    return _call("overlap", a, b)


def box(x0, y0, x1, y1) -> Column:
    return _call("box", *[(F.col(c) if isinstance(c, str) else c).cast("double") for c in (x0, y0, x1, y1)])


def hilbert(x, y, x0: float, y0: float, side: float) -> Column:
    """A number that is near for near points of a square."""
    return _call("hilbert", x, y, F.lit(float(x0)), F.lit(float(y0)), F.lit(float(side)))


def ring(xy) -> Column:
    """A polygon from its corners, x, y, x, y and so on, the first not repeated."""
    return _call("path", xy, F.lit(True))


def line(xy) -> Column:
    return _call("path", xy, F.lit(False))


#: Known coordinate systems: the working plane, the same plane in US survey feet, and those by way of longitude and latitude.
PLANE, PLANE_FEET, GLOBAL = 26985, 2248, (4326, 4269, 3857)


def reprojected(g, epsg: int) -> Column:
    """A shape of a known coordinate system in the working plane."""
    if epsg == PLANE:
        return F.col(g) if isinstance(g, str) else g
    if epsg == PLANE_FEET:
        return _call("scaled", g, F.lit(1200 / 3937))
    if epsg in GLOBAL:
        return to_plane(_call("lonlat", g, F.lit(epsg)))
    raise ValueError(f"EPSG:{epsg} is not read here; known are {PLANE}, {PLANE_FEET}, {GLOBAL}")


def between_systems(g, source: list[float], target: list[float]) -> Column:
    """Shapes of one coordinate system in another, both by their numbers (``sources.crs``)."""
    numbers = lambda p: F.array(*[F.lit(float(v)) for v in p])
    return _call("reproject", g, numbers(source), numbers(target))


def to_plane(g, params=EPSG_26985) -> Column:
    """Longitude and latitude to the plane of the given conic projection."""
    return _call("lambert", g, F.array(*[F.lit(float(p)) for p in params]), F.lit(False))


def to_lonlat(g, params=EPSG_26985) -> Column:
    return _call("lambert", g, F.array(*[F.lit(float(p)) for p in params]), F.lit(True))


def relative_position(parcel, part, sliver_m2: float) -> Column:
    return _call("position", parcel, part, F.lit(float(sliver_m2)))


def frontage(parcel, way, search_m: float, sample_m: float, contact_m: float) -> Column:
    return _call("frontage", parcel, way, F.lit(float(search_m)), F.lit(float(sample_m)), F.lit(float(contact_m)))


def box_wkb(x0: float, y0: float, x1: float, y1: float) -> bytes:
    """A rectangle as WKB."""
    import struct

    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring)


def line_wkb(*points: tuple[float, float]) -> bytes:
    import struct

    return struct.pack("<BII", 1, 2, len(points)) + b"".join(struct.pack("<dd", *p) for p in points)
