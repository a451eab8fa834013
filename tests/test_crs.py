"""Coordinate systems: descriptions of either kind, and projections against reference values and round trips."""

import json
import math
import struct

import pytest
from pyspark.sql import functions as F

from cadastra.kernel import functions as K
from cadastra.sources import crs, files

GEOGCS = 'GEOGCS["NAD83",DATUM["North_American_Datum_1983",SPHEROID["GRS 1980",6378137,298.257222101,AUTHORITY["EPSG","7019"]],AUTHORITY["EPSG","6269"]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433],AUTHORITY["EPSG","4269"]]'
UTM = f'PROJCS["somewhere",{GEOGCS},PROJECTION["Transverse_Mercator"],PARAMETER["latitude_of_origin",0],PARAMETER["central_meridian",-75],PARAMETER["scale_factor",0.9996],PARAMETER["false_easting",500000],PARAMETER["false_northing",0],UNIT["metre",1,AUTHORITY["EPSG","9001"]]]'
FEET = f'PROJCS["Maryland feet",{GEOGCS},PROJECTION["Lambert_Conformal_Conic_2SP"],PARAMETER["standard_parallel_1",39.45],PARAMETER["standard_parallel_2",38.3],PARAMETER["latitude_of_origin",37.66666666666666],PARAMETER["central_meridian",-77],PARAMETER["false_easting",1312333.333333333],PARAMETER["false_northing",0],UNIT["US survey foot",0.3048006096012192]]'
WKT2 = 'PROJCRS["x",BASEGEOGCRS["NAD83",DATUM["North American Datum 1983",ELLIPSOID["GRS 1980",6378137,298.257222101,LENGTHUNIT["metre",1]]],PRIMEM["Greenwich",0,ANGLEUNIT["degree",0.0174532925199433]]],CONVERSION["y",METHOD["Albers Equal Area",ID["EPSG",9822]],PARAMETER["Latitude of false origin",23,ANGLEUNIT["degree",0.0174532925199433]],PARAMETER["Longitude of false origin",-96,ANGLEUNIT["degree",0.0174532925199433]],PARAMETER["Latitude of 1st standard parallel",29.5,ANGLEUNIT["degree",0.0174532925199433]],PARAMETER["Latitude of 2nd standard parallel",45.5,ANGLEUNIT["degree",0.0174532925199433]],PARAMETER["Easting at false origin",1000,LENGTHUNIT["kilometre",1000]],PARAMETER["Northing at false origin",0,LENGTHUNIT["metre",1]]],CS[Cartesian,2],AXIS["x",east],AXIS["y",north],LENGTHUNIT["metre",1]]'
JSON = {"type": "ProjectedCRS", "base_crs": {"datum": {"name": "World Geodetic System 1984", "ellipsoid": {"name": "WGS 84", "semi_major_axis": 6378137, "inverse_flattening": 298.257223563}}}, "conversion": {"method": {"name": "Lambert Conic Conformal (1SP)"}, "parameters": [{"name": "Latitude of natural origin", "value": 0.75, "unit": {"type": "AngularUnit", "name": "radian", "conversion_factor": 1}}, {"name": "Longitude of natural origin", "value": 5, "unit": "degree"}, {"name": "Scale factor at natural origin", "value": 0.9999, "unit": "unity"}, {"name": "False easting", "value": 7, "unit": "metre"}]}, "coordinate_system": {"axis": [{"unit": {"type": "LinearUnit", "name": "foot", "conversion_factor": 0.3048}}]}}


@pytest.fixture(scope="module")
def geo(spark):
    K.register(spark)
    return spark


def test_descriptions():
    assert crs.of_text(UTM) == crs.utm(18, ellipsoid=crs.GRS80) == crs.of_epsg(26918) and crs.of_epsg(32733) == crs.utm(33, True)
    feet = crs.of_text(FEET)
    assert feet.method == crs.LAMBERT and feet.fe == pytest.approx(400000, abs=1e-3) and feet.unit == pytest.approx(1200 / 3937)
    albers = crs.of_text(WKT2)
    assert albers == crs.System(crs.ALBERS, lat0=23, lon0=-96, sp1=29.5, sp2=45.5, fe=1e6)
    one = crs.of_text(json.dumps(JSON))
    assert (one.method, one.k0, one.lon0, one.fe, one.unit) == (crs.LAMBERT, 0.9999, 5, 7, 0.3048) and one.sp1 == one.sp2 == one.lat0 == pytest.approx(math.degrees(0.75))
    for text, code in (("urn:ogc:def:crs:OGC:1.3:CRS84", 4326), ("EPSG:3857", 3857), ("urn:ogc:def:crs:EPSG::26918", 26918), (GEOGCS, 4269), ('PROJCS["x",AUTHORITY["EPSG","26985"]]', 26985), (json.dumps({"id": {"authority": "EPSG", "code": 5070}}), 5070)):
        assert crs.of_text(text) == crs.of_epsg(code)
    web = crs.of_text(f'PROJCS["WGS_1984_Web_Mercator_Auxiliary_Sphere",{GEOGCS},PROJECTION["Mercator_Auxiliary_Sphere"],PARAMETER["Central_Meridian",0],UNIT["Meter",1]]')
    assert web.method == crs.MERCATOR and web.f == 0
    for bad in ("EPSG:9999", 'LOCAL_CS["x"]', UTM.replace("North_American_Datum_1983", "North_American_Datum_1927"), UTM.replace("Transverse_Mercator", "Krovak"), UTM.replace('"Greenwich",0', '"Paris",2.33'), 'PROJCS["a"', "nonsense ["):
        with pytest.raises(crs.UnknownSystem):
            crs.of_text(bad)


def points(geo, rows, source, target):
    df = geo.createDataFrame([(k, bytearray(struct.pack("<BIdd", 1, 1, *p))) for k, p in enumerate(rows)], "k int, g binary")
    return [struct.unpack("<xIdd" if bytes(r[0])[0] else ">xIdd", bytes(r[0]))[1:] for r in df.orderBy("k").select(K.between_systems("g", source.numbers(), target.numbers())).collect()]


def test_projections(geo):
    degrees = crs.of_epsg(4269)
    # Worked examples of the published formulae (Lambert with one and two parallels, Albers of the sphere and the ellipsoid, transverse Mercator).
    clarke, airy = (6378206.4, 294.9786982), (6377563.396, 299.32496)
    cases = [
        (crs.System(crs.LAMBERT, clarke[0], 1 / clarke[1], 18.0, -77.0, 18.0, 18.0, 1.0, 250000.0, 150000.0), (-(76 + 56 / 60 + 37.26 / 3600), 17 + 55 / 60 + 55.80 / 3600), (255966.58, 142493.51)),
        (crs.System(crs.LAMBERT, clarke[0], 1 / clarke[1], 27 + 50 / 60, -99.0, 28 + 23 / 60, 30 + 17 / 60, 1.0, 2e6 * 1200 / 3937, 0.0, 1200 / 3937), (-96.0, 28.5), (2963503.91, 254759.80)),
        (crs.System(crs.TRANSVERSE, airy[0], 1 / airy[1], 49.0, -2.0, k0=0.9996012717, fe=400000.0, fn=-100000.0), (0.5, 50.5), (577274.99, 69740.50)),
        (crs.System(crs.ALBERS, clarke[0], 1 / clarke[1], 23.0, -96.0, 29.5, 45.5), (-75.0, 35.0), (1885472.7, 1535925.0)),
    ]
    for system, at, want in cases:
        got = points(geo, [at], crs.System(), system)[0]
        assert got == pytest.approx(want, abs=0.06), system
    rows = [(-79.4 + 0.37 * i, 37.3 + 0.21 * i) for i in range(12)]
    for system in (crs.of_epsg(26918), crs.of_epsg(5070), crs.of_epsg(3857), crs.of_epsg(26985), crs.of_epsg(2248), crs.utm(17, True), crs.System(crs.MERCATOR), crs.of_text(json.dumps(JSON)), *[c[0] for c in cases]):
        there = points(geo, rows, degrees, system)
        back = points(geo, there, system, degrees)
        assert all(abs(a - b) < 1e-9 for p, q in zip(rows, back, strict=True) for a, b in zip(p, q, strict=True)), system
    with pytest.raises(Exception, match="not degrees"):
        points(geo, [(4e5, 1e5)], degrees, crs.of_epsg(26985))


def test_layers_of_other_systems(geo, tmp_path):
    from cadastra.sources.shapefile import write_shapefile

    at = points(geo, [(-77.01, 39.0), (-77.0, 39.01)], crs.of_epsg(4269), crs.of_epsg(26918))
    want = points(geo, [(-77.01, 39.0), (-77.0, 39.01)], crs.of_epsg(4269), crs.of_epsg(26985))
    ring = [[at[0], (at[0][0], at[1][1]), at[1], (at[1][0], at[0][1]), at[0]]]
    write_shapefile(str(tmp_path / "u.shp"), [(1, "x", ring)], [("k", "N", 9, 0), ("kind", "C", 5, 0)], UTM)
    box = files.read_layer(geo, str(tmp_path / "u.shp")).select(K.shape("geom").alias("b")).first()["b"]
    corner = points(geo, [at[0]], crs.of_epsg(26918), crs.of_epsg(26985))[0]
    assert corner == pytest.approx(want[0], abs=1e-6) and abs(box["minx"] - min(p[0] for p in points(geo, ring[0], crs.of_epsg(26918), crs.of_epsg(26985)))) < 1e-6
    x, y = want[0]
    assert files.read_layer(geo, str(tmp_path / "u.shp"), clip=(x, y, x + 10, y + 10)).count() == 1
    assert files.read_layer(geo, str(tmp_path / "u.shp"), clip=(x + 9000, y, x + 9010, y + 10)).count() == 0
    (tmp_path / "u.prj").write_text(UTM.replace("Transverse_Mercator", "Krovak"))
    with pytest.raises(files.LayerError, match="Krovak"):
        files.read_layer(geo, str(tmp_path / "u.shp"))
    assert files.read_layer(geo, str(tmp_path / "u.shp"), crs=26918).count() == 1
    with pytest.raises(files.LayerError, match="EPSG:9999"):
        files.read_layer(geo, str(tmp_path / "u.shp"), crs=9999)
    df = geo.range(1).select(K.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1)).alias("geom"))
    files.write_geojson(df, str(tmp_path / "a.geojson"), lonlat=False, epsg=2154)
    with pytest.raises(files.LayerError, match="not known"):
        files.read_layer(geo, str(tmp_path / "a.geojson"))
