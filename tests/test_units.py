"""Functions, sources and operators on small inputs."""

import http.server
import json
import sqlite3
import threading
import urllib.parse

import pytest
from pyspark.sql import functions as F

from cadastra import cli, config, schema
from cadastra.functions import measures as M
from cadastra.functions import owners as O
from cadastra.kernel import functions as K
from cadastra.operators import slope as S
from cadastra.operators.spatial import grid_join, with_box
from cadastra.sources import files, fixture, rest


@pytest.fixture(scope="module")
def geo(spark):
    K.register(spark)
    return spark


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def test_owner_types(spark):
    names = {"SMITH JOHN": "individual", "Acme L.L.C.": "llc", "BOARD OF EDUCATION INC": "government", "GRACE CHURCH": "religious_nonprofit", "SMITH FAMILY TRUST": "trust", "ACME, INC.": "corporation", " ": "unknown", None: "unknown"}
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", O.owner_type("n").alias("t"))
    assert {r["n"]: r["t"] for r in df.collect()} == names


def test_owner_matching(spark):
    def match(a, b, x="", y=""):
        lit = F.lit
        return one(spark, m=O.owners_match(O.name_tokens(lit(a)), O.name_tokens(lit(b)), O.normal_address(lit(x)), O.normal_address(lit(y))))["m"]

    assert match("SMITH JOHN", "SMITH JOHN A & MARY")
    assert not match("SMITH JOHN", "JONES MARY")
    assert match("SMITH JOHN", "SMITH FARMS LLC", "12 Main Street, 21701-1234", "12 MAIN ST 21701")
    assert not match("", "", "", "")
    key = one(spark, k=O.owner_key(F.lit("Smith John, Jr & Mary ET UX"), F.lit("PO Box 5 Old Road 21701-0001")))["k"]
    assert key == "SMITH JOHN MARY|POBOX 5 OLD RD 21701"


def test_strips_and_rounding(spark):
    m = one(spark, m=M.strip_metrics(F.lit(15.24 * 396.24), F.lit(2 * (15.24 + 396.24))))["m"]
    assert m["est_width_ft"] == pytest.approx(48.2, abs=0.5) and m["aspect"] > 25
    assert one(spark, r=M.rounded(F.lit(2.675), 2))["r"] == 2.68
    assert one(spark, m=M.strip_metrics(F.lit(0.0), F.lit(0.0)))["m"]["est_width_ft"] == 0


def test_schema_resolution(spark):
    spec = {"required": {"account_id": ["ACCTID", "ACCT"]}, "optional": {"acres": ["ACRES"], "zone": ["ZONE"]}}
    got = schema.resolve(spec, ["acctid", "Acres", "other"])
    assert got.mapping == {"account_id": "acctid", "acres": "Acres"} and got.missing_optional == ["zone"]
    df = schema.apply(spark.createDataFrame([("1", 2.0, "x")], "acctid string, Acres double, other string"), spec)
    assert set(df.columns) == {"account_id", "acres", "zone", "other"}
    with pytest.raises(schema.SchemaError):
        schema.apply(spark.createDataFrame([(1,)], "q int"), spec)


def test_config_checks():
    with pytest.raises(config.ConfigError):
        config.Config(counties={}, schema={})
    with pytest.raises(config.ConfigError):
        config.RowLayer("r", geometry="line")
    assert cli.stage_list("1-3") == (1, 2, 3) and cli.stage_list("4,1") == (1, 4)
    with pytest.raises(config.ConfigError):
        cli.stage_list("1-5")


def test_kernel_identities(geo):
    a, b = F.lit(bytearray(K.box_wkb(0, 0, 10, 10))), F.lit(bytearray(K.box_wkb(4, 5, 20, 8)))
    r = one(geo, i=K.overlap_area(a, b), d=K.area(K.areal_difference(a, b)), u=K.area(K.union_all(F.array(a, b))), dist=K.distance(a, F.lit(bytearray(K.box_wkb(13, 14, 15, 15)))), within=K.within(K.centroid(a), a))
    assert (r["i"], r["d"], r["u"], r["dist"], r["within"]) == (18.0, 82.0, 130.0, 5.0, True)
    there = one(geo, p=K.shape(K.to_lonlat(K.to_plane(F.lit(bytearray(K.box_wkb(-77.4, 39.4, -77.3, 39.5)))))))["p"]
    assert there["minx"] == pytest.approx(-77.4, abs=1e-9) and there["maxy"] == pytest.approx(39.5, abs=1e-9)
    origin = one(geo, p=K.shape(K.to_plane(F.lit(bytearray(K.line_wkb((-77.0, 37 + 2 / 3), (-77.0, 39.0)))))))["p"]
    assert origin["minx"] == pytest.approx(400000, abs=1e-3) and origin["miny"] == pytest.approx(0, abs=1e-3)


def test_grid_join_finds_each_pair_once(geo):
    import random

    rnd = random.Random(4)
    boxes = [(k, x, y, x + rnd.choice([5, 60, 400]), y + rnd.choice([5, 60])) for k in range(60) for x, y in [(rnd.randrange(500), rnd.randrange(500))]]
    df = with_box(geo.createDataFrame([(k, K.box_wkb(*b)) for k, *b in boxes], "k int, geom binary"))
    got = sorted((r["a"], r["b"]) for r in grid_join(df, df, 50.0).select(F.col("l.k").alias("a"), F.col("r.k").alias("b")).collect())
    want = sorted((p[0], q[0]) for p in boxes for q in boxes if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    assert got == want
    near = grid_join(df, df, 50.0, within=20.0).count()
    gap = lambda p, q: (max(0, p[1] - q[3], q[1] - p[3]) ** 2 + max(0, p[2] - q[4], q[2] - p[4]) ** 2) ** 0.5
    assert near == sum(gap(p, q) <= 20 for p in boxes for q in boxes)


def test_slope_equals_numpy(geo):
    import numpy as np

    z = np.array([[c * c + 2 * r * c for c in range(7)] for r in range(5)], float)
    cells = geo.createDataFrame([(r, c, float(z[r, c])) for r in range(5) for c in range(7)], "row int, col int, z double")
    dy, dx = np.gradient(z, 5.0, 5.0)
    for r in S.slope_percent(cells, S.Grid(0, 0, 5.0, 5.0)).collect():
        assert r["slope"] == pytest.approx(100 * np.hypot(dx, dy)[r["row"], r["col"]])
    assert S.resampled(cells, 2).count() == 12


def test_files(geo, tmp_path):
    box = {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::26985"}}, "features": [{"type": "Feature", "properties": {"name": n, "n": k}, "geometry": box} for k, n in enumerate("ab")]}
    (tmp_path / "x.geojson").write_text(json.dumps(doc))
    df = files.read_layer(geo, str(tmp_path / "x.geojson"), where="name in ['a']")
    assert df.select("name", "n", K.area("geom").alias("m2"), "_source_file").collect()[0].asDict() == {"name": "a", "n": 0, "m2": 4.0, "_source_file": "x.geojson"}
    files.write_gpkg(df, str(tmp_path / "y.gpkg"), "parcels")
    back = files.read_layer(geo, str(tmp_path / "y.gpkg"))
    assert back.select("name", K.area("geom").alias("m2")).first().asDict() == {"name": "a", "m2": 4.0}
    assert sqlite3.connect(tmp_path / "y.gpkg").execute("SELECT count(*) FROM parcels").fetchone() == (1,)
    both = files.read_layer(geo, str(tmp_path))
    assert both.count() == 3 and files.fields_of(geo, str(tmp_path / "y.gpkg")) == ["fid", "n", "name"]
    files.write_geojson_lines(df, str(tmp_path / "out"), lonlat=False)
    assert json.loads(geo.read.text(str(tmp_path / "out")).first()[0])["geometry"] == box
    files.write_geojson(df, str(tmp_path / "whole.geojson"), lonlat=False)
    whole = json.loads((tmp_path / "whole.geojson").read_text())
    assert whole["type"] == "FeatureCollection" and [f["geometry"] for f in whole["features"]] == [box]
    (tmp_path / "whole.geojson").unlink()
    files.write_parquet(df, str(tmp_path / "z.parquet"))
    assert files.read_layer(geo, str(tmp_path / "z.parquet"), clip=(5000, 5000, 6000, 6000)).count() == 0
    with pytest.raises(files.LayerNotAvailable):
        files.files_of(str(tmp_path / "none.gpkg"))
    assert files.study_area(geo, str(tmp_path / "x.geojson"))
    with pytest.raises(files.LayerError, match="not read"):
        (tmp_path / "q.gdb").mkdir()
        files.read_layer(geo, str(tmp_path))
    geo.createDataFrame([(1, K.box_wkb(0, 0, 1, 1))], "k int, geom binary").write.parquet(str(tmp_path / "bare.parquet"))
    with pytest.raises(files.LayerError, match="coordinate system"):
        files.read_layer(geo, str(tmp_path / "bare.parquet"))
    assert files.read_layer(geo, str(tmp_path / "bare.parquet"), crs=26985).select(K.area("geom")).first()[0] == 1


def test_coordinate_systems_of_files(tmp_path):
    names = {"urn:ogc:def:crs:OGC:1.3:CRS84": 4326, "EPSG:26985": 26985, "urn:ogc:def:crs:EPSG::3857": 3857, 'PROJCS["x",AUTHORITY["EPSG","2248"]]': 2248, 'GEOGCS["GCS_WGS_1984",UNIT["Degree",0.0174]]': 4326, 'PROJCS["WGS_1984_Web_Mercator_Auxiliary_Sphere"]': 3857, 'PROJCS["NAD_1983_StatePlane_Maryland_FIPS_1900",PROJECTION["Lambert_Conformal_Conic"],UNIT["Meter",1.0]]': 26985, 'PROJCS["Somewhere"]': None}
    assert {n: files.epsg_of_text(n) for n in names} == names
    con = sqlite3.connect(tmp_path / "a.gpkg")
    con.executescript("CREATE TABLE gpkg_geometry_columns (table_name, column_name, geometry_type_name, srs_id, z, m); CREATE TABLE gpkg_spatial_ref_sys (srs_name, srs_id, organization, organization_coordsys_id, definition, description); INSERT INTO gpkg_geometry_columns VALUES ('t', 'g', 'POLYGON', 99, 0, 0); INSERT INTO gpkg_spatial_ref_sys VALUES ('x', 99, 'EPSG', 3857, '', '')")
    con.commit()
    assert files.epsg_of(str(tmp_path / "a.gpkg"), "t") == 3857


def test_where_dialect(geo):
    df = geo.createDataFrame([(1, "a", None), (2, "b [x]", 5.0), (3, None, 7.0)], "k int, `n` string, `my col` double")
    cases = {
        "n == 'a'": [1], "n in ['a', 'b [x]']": [1, 2], "n not in ['a']": [2, 3], "n != 'a'": [2, 3], "not n == 'a' and k < 3": [2], "k == 1 | k == 3": [1, 3], "k > 1 & ~(k == 3)": [2],
        "`my col` > 4 and `my col` <= 5": [2], "1 < k <= 3": [2, 3], 'n == "b [x]"': [2], "n.isnull()": [3], "k.isin([1, 3])": [1, 3], "k == [2]": [2], "k % 2 == 0": [2], "k == -1": [], "k != [1, 2]": [3],
        "n = 'a' OR k IS NULL": [1], "n LIKE 'b%'": [2],
    }
    assert {w: [r["k"] for r in df.where(files.translated(w)).orderBy("k").collect()] for w in cases} == cases
    assert files.translated("n == 'it\\'s'") == "(`n` = 'it\\'s')"


def test_shapefile_holes_and_kinds(geo, tmp_path):
    from cadastra.sources.shapefile import wkb_of, write_shapefile

    ring = lambda x, y, s, turn: [(x, y), (x, y + s), (x + s, y + s), (x + s, y), (x, y)][:: -1 if turn else 1]
    rows = [("é", 1.5, [ring(0, 0, 10, False), ring(2, 2, 3, True)]), (None, None, [ring(0, 0, 10, False), ring(20, 0, 10, False), ring(22, 2, 1, True)])]
    write_shapefile(str(tmp_path / "a.shp"), rows, [("name", "C", 10, 0), ("v", "N", 10, 2)], 'AUTHORITY["EPSG","26985"]')
    df = files.read_layer(geo, str(tmp_path / "a.shp"))
    assert [tuple(r) for r in df.select("name", "v", K.area("geom"), F.size(K.parts("geom")), "_row").orderBy("_row").collect()] == [("é", 1.5, 91.0, 1, 0), (None, None, 199.0, 2, 1)]
    assert files.read_layer(geo, str(tmp_path / "a.shp"), clip=(15000, -5000, 16000, 5000)).count() == 0
    (tmp_path / "a.shx").unlink()
    assert files.read_layer(geo, str(tmp_path / "a.shp")).count() == 2
    import struct

    assert wkb_of(struct.pack("<i", 0)) is None and wkb_of(struct.pack("<i2d", 11, 3, 4) + bytes(16)) == struct.pack("<BIdd", 1, 1, 3, 4)


def lzw(data: bytes) -> bytes:
    """A plain encoder of the same kind."""
    table, width, bits, out, held = {bytes([k]): k for k in range(256)}, 9, 0, bytearray(), 0
    size = 258

    def put(code):
        nonlocal held, bits
        held, bits = held << width | code, bits + width
        while bits >= 8:
            out.append(held >> bits - 8 & 255)
            bits -= 8

    put(256)
    word = b""
    for k in data:
        one = word + bytes([k])
        if one in table:
            word = one
            continue
        put(table[word])
        table[one] = size
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        if size == 4094:
            put(256)
            table, size, width = {bytes([k]): k for k in range(256)}, 258, 9
        word = bytes([k])
    put(table[word])
    put(257)
    out.append(held << 8 - bits & 255 if bits else 0)
    return bytes(out)


def test_tiff_kinds():
    import zlib

    import numpy as np

    from cadastra.sources import tiff

    rnd = np.random.default_rng(1)
    z = rnd.integers(0, 300, (40, 50))
    for kind, form in (("u2", 1), ("i2", 2), ("i4", 2), ("f4", 3), ("f8", 3)):
        for order in "<>":
            x = z.astype(order + kind)
            tags = lambda c, p, x=x, form=form: {tiff.BITS: (8 * x.dtype.itemsize,), tiff.SAMPLE_FORMAT: (form,), tiff.COMPRESSION: (c,), tiff.PREDICTOR: (p,), tiff.NODATA: (b"7\0",)}
            want = np.where(z == 7, np.nan, z)
            for c, pack in ((1, bytes), (8, zlib.compress), (5, lzw)):
                assert np.array_equal(tiff.block_values(tiff.Raster("r", order, tags(c, 1)), pack(x.tobytes()), 40, 50), want, equal_nan=True), (kind, order, c)
            if form < 3:
                d = np.diff(x.astype(order + kind), axis=1, prepend=np.zeros((40, 1), x.dtype)).astype(order + kind)
                assert np.array_equal(tiff.block_values(tiff.Raster("r", order, tags(8, 2)), zlib.compress(d.tobytes()), 40, 50), want, equal_nan=True)
            else:
                planes = x.astype(">" + kind).view(np.uint8).reshape(40, 50, -1).transpose(0, 2, 1).reshape(40, -1)
                d = np.diff(planes, axis=1, prepend=np.zeros((40, 1), np.uint8))
                assert np.array_equal(tiff.block_values(tiff.Raster("r", order, tags(8, 3)), zlib.compress(d.astype(np.uint8).tobytes()), 40, 50), want, equal_nan=True)
    with pytest.raises(ValueError, match="compression"):
        tiff.block_values(tiff.Raster("r", "<", {tiff.BITS: (16,), tiff.COMPRESSION: (7,)}), b"", 1, 1)


def test_steep_windows_equal_numpy(geo):
    import numpy as np

    rnd = np.random.default_rng(3)
    z = rnd.random((30, 40)) * 6
    z[rnd.random((30, 40)) < 0.05] = np.nan
    cells = geo.createDataFrame([(r, c, None if np.isnan(z[r, c]) else float(z[r, c])) for r in range(30) for c in range(40)], "row int, col int, z double")
    grid = S.Grid(100.0, 400.0, 10.0, 10.0)
    boxes = {"a": (163.0, 171.0, 305.0, 333.0), "edge": (80.0, 90.0, 141.0, 160.0), "out": (900.0, 900.0, 950.0, 950.0)}
    p = with_box(geo.createDataFrame([(k, K.box_wkb(*b)) for k, b in boxes.items()], "account_id string, geom binary"))
    got = {r["account_id"]: r["m2"] for r in S.window_steep(p, cells, grid, 15.0).select("account_id", K.area("geom").alias("m2")).collect()}
    want = {}
    for k, (x0, y0, x1, y1) in boxes.items():
        c0, r0 = int((x0 - 30 - 100) // 10), int((400 - y1 - 30) // 10)
        c1, r1 = min(c0 + int(np.ceil((x1 - x0 + 60) / 10)) - 1, 39), min(r0 + int(np.ceil((y1 - y0 + 60) / 10)) - 1, 29)
        c0, r0 = max(c0, 0), max(r0, 0)
        if c1 - c0 < 2 or r1 - r0 < 2:
            continue
        w = z[r0 : r1 + 1, c0 : c1 + 1]
        gy, gx = np.gradient(np.where(np.isnan(w), np.nanmean(w), w), 10.0, 10.0)
        steep = (100 * np.hypot(gx, gy) > 15) & ~np.isnan(w)
        want[k] = sum(max(0, min(x1, 110 + 10 * (c0 + c)) - max(x0, 100 + 10 * (c0 + c))) * max(0, min(y1, 400 - 10 * (r0 + r)) - max(y0, 390 - 10 * (r0 + r))) for r, c in zip(*np.nonzero(steep)))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    assert S.window_steep(p, cells, grid, 1.0, resample_m=20.0).count() >= 1


def test_code_of_messages_for_unread_layers(geo, tmp_path, capsys):
    """An unread format is told, with the exit code of a bad configuration."""
    import yaml

    (tmp_path / "raw.gdb").mkdir()
    (tmp_path / "s.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": 1}, "geometry": {"type": "Polygon", "coordinates": [[[-77.5, 39.3], [-77.4, 39.3], [-77.4, 39.4], [-77.5, 39.3]]]}}]}))
    (tmp_path / "schema.yaml").write_text(yaml.safe_dump(fixture.SCHEMA))
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"counties": {"F": "Frederick"}, "study_area": "s.geojson", "parcels": {"path": ".", "schema": "schema.yaml"}, "zoning": [], "constraints": []}))
    assert cli.main(["run", "--config", str(tmp_path / "c.yaml"), "--stages", "1", "--out", str(tmp_path / "out")]) == 2
    assert "not read" in capsys.readouterr().err


def test_feature_service(geo):
    features = [{"type": "Feature", "properties": {"OBJECTID": k, "CODE": f"C{k % 3}"}, "geometry": {"type": "Point", "coordinates": [k, k]}} for k in range(2500)]
    seen = []

    class Handler(http.server.BaseHTTPRequestHandler):
        paged = True

        def do_POST(self):
            q = dict(urllib.parse.parse_qsl(self.rfile.read(int(self.headers["Content-Length"])).decode()))
            if not self.path.endswith("/query"):
                out = {"name": "L", "maxRecordCount": 1000, "advancedQueryCapabilities": {"supportsPagination": self.paged}, "fields": [{"name": "OBJECTID", "type": "esriFieldTypeOID"}, {"name": "CODE", "type": "esriFieldTypeString", "domain": {"codedValues": [{"code": "C0", "name": "zero"}]}}]}
            elif q.get("returnCountOnly"):
                out = {"count": len(features)}
            elif q.get("where") == "bad":
                out = {"error": {"message": "no"}}
            else:
                seen.append(q)
                at = int(q["resultOffset"])
                out = {"features": features[at : at + int(q["resultRecordCount"])]}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(out).encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/layer"
    try:
        df = rest.read_service(geo, url, bbox=(-1, -1, 9, 9))
        assert df.count() == 2500 and len({q["resultOffset"] for q in seen}) == 3 and "xmin" in seen[0]["geometry"]
        assert [r[0] for r in rest.distinct_values(df, "CODE").collect()] == ["C0", "C1", "C2"]
        assert rest.layer_info(url).domains == {"CODE": {"C0": "zero"}}
        short = lambda u, q: {"features": features[int(q["resultOffset"]) : int(q["resultOffset"]) + min(30, int(q["resultRecordCount"]))]}
        assert len(list(rest.features(url, {}, {"resultOffset": 0, "resultRecordCount": 100, "expect": 100}, get=short))) == 100
        with pytest.raises(rest.ServiceError, match="announced"):
            list(rest.features(url, {}, {"resultOffset": 2490, "resultRecordCount": 100, "expect": 100}, get=short))
        with pytest.raises(rest.ServiceError):
            rest.http_json(f"{url}/query", {"where": "bad"})
    finally:
        server.shutdown()
    info = rest.info_of({"fields": [], "objectIdField": "ID"})
    ids = rest.chunks("u", {}, info, get=lambda u, p: {"objectIds": list(range(450, 0, -1))})
    assert len(ids) == 3 and ids[0]["objectIds"].startswith("1,2,")


def _in_memory(answers):
    """The service's own handler on bytes, without a port."""
    import io

    class Socket:
        def __init__(self, data):
            self.data, self.out = data, b""

        def makefile(self, *a, **k):
            return io.BytesIO(self.data)

        def sendall(self, data):
            self.out += bytes(data)

    def get(url, params):
        body = urllib.parse.urlencode(params).encode()
        s = Socket(f"POST /{url} HTTP/1.1\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body)
        answers.handler()(s, ("here", 0), None)
        return json.loads(s.out.split(b"\r\n\r\n", 1)[1])

    return get


@pytest.mark.parametrize("paged", [True, False])
def test_service_looks_at_its_rows_once(paged, monkeypatch):
    """However many pages are asked for; pages share tasks."""
    from pyspark.sql.types import LongType, StringType, StructType

    from cadastra.source_queries import _Answers

    class Lon(float):
        seen = 0

        def __ge__(self, other):
            Lon.seen += 1
            return float(self) >= other

    rows = [(k, "ABC"[k % 3], Lon(-77.9 + k % 140 / 100), 38.9 + k % 83 / 100) for k in range(9000, 0, -1)]
    answers = _Answers(rows, paged)
    get, params = _in_memory(answers), rest.query_params("K>=3", (-78.0, 38.0, -77.4999, 40.0))
    info = rest.info_of(get("layer", {"f": "json"}))
    want = sorted(r[:2] for r in rows if r[0] >= 3 and float(r[2]) <= -77.4999)
    Lon.seen = 0
    tasks = rest.runs(rest.chunks("layer", params, info, get=get))
    assert info.paged == paged and 64 <= len(tasks) < 140 and max(map(len, tasks)) > 1
    monkeypatch.setattr(rest.features, "__defaults__", (get,))
    reader = rest.FeatureReader({"url": "layer", "where": "K>=3", "bbox": "-78.0,38.0,-77.4999,40.0"}, StructType().add("K", LongType()).add("CODE", StringType()))
    got = [tuple(r[:2]) for t in tasks for r in reader.read(rest.InputPartition(t))]
    assert got == want and 0 < Lon.seen <= len(rows) and answers.asked > len(want) // 10
    assert list(reader.read(rest.InputPartition([]))) == []
    assert get("layer/query", {"where": "K>=-1", "resultOffset": 0, "resultRecordCount": 1})["error"]["message"] == "no such field"


def test_pages_share_tasks():
    assert [len(r) for r in rest.runs([{"k": k} for k in range(3)])] == [1, 1, 1] and rest.runs([]) == []
    pages = [{"k": k} for k in range(10545)]
    got = rest.runs(pages)
    assert [p for r in got for p in r] == pages and max(map(len, got)) == rest.PAGES and len(got) == 211


def test_template_keeps_answers():
    import yaml

    text = schema.zoning_template("X", "Z", {"A": "Ag", "B": None}, {"A": {"is_agricultural": True}})
    assert yaml.safe_load(text)["codes"] == {"A": {"description": "Ag", "is_agricultural": True}, "B": {"description": None, "is_agricultural": None}}


def test_load_yaml(tmp_path):
    import yaml

    (tmp_path / "schema.yaml").write_text(yaml.safe_dump(fixture.SCHEMA))
    (tmp_path / "z.yaml").write_text(yaml.safe_dump({"code_field": "ZONING", "codes": {"A": {"is_agricultural": True}}}))
    doc = {"counties": {"F": "Frederick"}, "study_area": "s.geojson", "parcels": {"path": "raw", "schema": "schema.yaml"}, "zoning": [{"county": "Frederick", "path": "z.gpkg", "mapping": "z.yaml"}], "constraints": [{"name": "c", "type": "t", "category": "legal", "implication": "hostile", "path": "c.gpkg"}], "access": {"row_layers": [{"name": "r", "path": "r.gpkg"}]}, "future": {"x": 1}}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(doc))
    cfg = config.load(str(tmp_path / "c.yaml"))
    assert cfg.study_area == str(tmp_path / "s.geojson") and cfg.zoning[0].code_field == "ZONING" and cfg.raw["future"] == {"x": 1}


def test_shapefile_is_written_side_by_side(spark, tmp_path, monkeypatch):
    """Tasks write their records at their places in the file: as one writer does, however many parts there are."""
    from pyspark.sql import functions as F

    from cadastra.kernel import functions as K
    from cadastra.sources import files, shapefile

    K.register(spark)
    monkeypatch.setattr(files, "SPREAD", 100)
    fields, wkt = [("k", "N", 9, 0), ("name", "C", 8, 0)], 'AUTHORITY["EPSG","26985"]'
    k = F.col("id")
    df = spark.range(0, 1000, 1, 1).select(k.alias("k"), F.concat(F.lit("ü"), k % 7).alias("name"), F.when(k % 10 != 3, K.box(k, k, k + 2, k + 1)).alias("geom"))
    files.write_shapefile(df, str(tmp_path / "a.shp"), fields, wkt)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.cpg", "a.dbf", "a.prj", "a.shp", "a.shx"]
    rows = [(k, f"ü{k % 7}", [[(k, k), (k, k + 1), (k + 2, k + 1), (k + 2, k), (k, k)]]) for k in range(1000) if k % 10 != 3]
    shapefile.write_shapefile(str(tmp_path / "b.shp"), rows, fields, wkt)
    read = lambda name: [(r["k"], r["name"], r["m2"]) for r in files.read_layer(spark, str(tmp_path / name)).orderBy("_row").select("k", "name", K.area("geom").alias("m2")).collect()]
    got = read("a.shp")
    assert [r[0] for r in got] == list(range(1000))
    assert [r for r in got if r[2] is not None] == read("b.shp")
    files.write_shapefile(df.limit(0), str(tmp_path / "none.shp"), fields, wkt)
    assert read("none.shp") == []


def test_small_shapefile_writer_is_linear(tmp_path):
    """Four times the rows take about four times as long: growing one string of bytes took sixteen times."""
    import time

    from cadastra.sources import shapefile

    def seconds(n):
        rows = [(k, [[(k, k), (k, k + 1), (k + 1, k + 1), (k, k)]]) for k in range(n)]
        t = time.process_time()
        shapefile.write_shapefile(str(tmp_path / "a.shp"), rows, [("k", "N", 9, 0)], "")
        return time.process_time() - t

    seconds(100)
    assert seconds(40_000) < 9 * seconds(10_000)
