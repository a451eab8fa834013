"""Registered queries that go through readers, services, sinks and the command line: derived tables are written out, read back, and compared with SQL on the tables."""

from __future__ import annotations

import http.server
import json
import math
import tempfile
import threading
import urllib.parse
from functools import lru_cache
from pathlib import Path

from pyspark.sql import functions as F

from . import cli, config, schema
from .cadastre import PARCELS_SQL, parcels, table, top
from .functions import measures as M
from .kernel import functions as K
from .operators import raster
from .operators import slope as S
from .queries import CTES, MEET, query, r2
from .sources import crs as systems
from .sources import files, fixture, geojson, rest, tiff
from .stage_queries import _conic

PRJ = 'PROJCS["NAD83 / Maryland",AUTHORITY["EPSG","26985"]]'
FEET_PRJ = 'PROJCS["NAD_1983_StatePlane_Maryland_FIPS_1900_Feet",PROJECTION["Lambert_Conformal_Conic"],UNIT["Foot_US",0.3048006096012192]]'


def _home(spark) -> Path:
    """A new folder that the executors see too: in spark.checkpoint.dir, where that is a plain folder."""
    base = (spark.conf.get("spark.checkpoint.dir", None) or "").removeprefix("file://")
    if base.startswith("/"):
        Path(base).mkdir(parents=True, exist_ok=True)
        return Path(tempfile.mkdtemp(prefix="sources-", dir=base))
    return Path(tempfile.mkdtemp(prefix="sources-"))


def _shapes(df, path: Path, scale: float = 1.0, wkt: str = PRJ) -> None:
    box = K.box(*[F.col(c) * scale for c in ("x0", "y0", "x1", "y1")])
    files.write_shapefile(df.select("k", "kind", box.alias("geom")), str(path), [("k", "N", 18, 0), ("kind", "C", 12, 0)], wkt)


def _gpkg(df, path: Path, layer: str) -> None:
    files.write_gpkg(df, str(path), layer)


#: Runs on the synthetic county, with their SQL: for tests, not registered, as they don't grow with the tables.
CHECKS: dict[str, tuple] = {}


def check(sql: str):
    def put(f):
        CHECKS[f.__name__] = (f, sql)
        return f

    return put


WHERE = "(kind in ['FRED', 'CARR'] & k >= 3 and not kind == 'none') | (`k` == 1 or k == [2, 5]) & 0 <= k < 9"


@query(f"SELECT k, county_code AS kind, (x1 - x0) * (y1 - y0) AS m2, CASE k % 4 WHEN 0 THEN 'a.gpkg' WHEN 1 THEN 'b.geojson' WHEN 2 THEN 'c.shp' ELSE 'd.parquet' END AS source FROM ({PARCELS_SQL}) WHERE (county_code IN ('FRED', 'CARR') AND k >= 3) OR (k IN (1, 2, 5))")
def source_files(spark, sf_dir):
    """A folder of four formats as one layer, with chosen columns and a filter in the query dialect."""
    home = _home(spark)
    p = parcels(spark, sf_dir).select("k", F.col("county_code").alias("kind"), F.lit("more").alias("unused"), "x0", "y0", "x1", "y1", "geom")
    flat = p.select("k", "kind", "unused", "geom")
    _gpkg(flat.where("k % 4 = 0"), home / "a.gpkg", "parcels")
    files.write_geojson(flat.where("k % 4 = 1"), str(home / "b.geojson"), lonlat=False)
    _shapes(p.where("k % 4 = 2"), home / "c.shp")
    files.write_parquet(flat.where("k % 4 = 3"), str(home / "d.parquet"))
    got = files.read_layer(spark, str(home), where=WHERE, columns=["k", "kind"])
    return got.select("k", "kind", M.rounded(K.area("geom"), 3).alias("m2"), F.col("_source_file").alias("source"))


_MIXED = f"k, CASE WHEN k % 3 = 0 THEN k::DOUBLE WHEN k % 3 = 1 THEN k + 0.5 END AS val, CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) ELSE 'n' || k END AS mix, CASE WHEN k > n THEN 'late \\ \"{{[' || k END AS late, CASE WHEN k % 5 = 0 THEN '{{\"a\":[' || k || ']}}' END AS part"


@query(f"WITH c AS (SELECT c_custkey AS k, (SELECT max(c_custkey) - 3 FROM customer) AS n FROM customer) SELECT how, {_MIXED}, 200.0 AS m2 FROM c, (VALUES ('whole'), ('ranges')) h(how)")
def source_geojson(spark, sf_dir):
    """Features of mixed kinds, a field that only the last have, the coordinate system behind them: read whole and in ranges of 16 KB."""
    home = _home(spark)
    K.register(spark)
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    k, n = F.col("k"), c.agg(F.max("k")).first()[0] - 3
    member = lambda name, value: F.concat(F.lit(f', "{name}": '), value)
    text = lambda v: F.to_json(F.struct(v.alias("x"))).substr(F.lit(6), F.lit(1 << 20))
    string = lambda v: F.regexp_replace(text(v), "}$", "")
    val = F.when(k % 3 == 0, member("val", k.cast("string"))).when(k % 3 == 1, member("val", F.concat(k.cast("string"), F.lit(".5")))).otherwise(member("val", F.lit("null")))
    mix = member("mix", F.when(k % 2 == 0, k.cast("string")).otherwise(string(F.concat(F.lit("n"), k.cast("string")))))
    late = F.when(k > n, member("late", string(F.concat(F.lit('late \\ "{['), k.cast("string"))))).otherwise("")
    part = F.when(k % 5 == 0, member("part", F.concat(F.lit('{"a": ['), k.cast("string"), F.lit("]}")))).otherwise("")
    x, y = ((k % 40) * 700).cast("string"), (F.expr("k div 40") * 700).cast("string")
    corner = lambda dx, dy: F.concat(F.lit("["), (x.cast("long") + dx).cast("string"), F.lit(","), (y.cast("long") + dy).cast("string"), F.lit("]"))
    ring = F.concat_ws(",", *[corner(*d) for d in ((0, 0), (20, 0), (20, 10), (0, 10), (0, 0))])
    feature = F.concat(F.lit('{"type":"Feature", "properties": {"k": '), k.cast("string"), val, mix, late, part, F.lit('}, "geometry": {"type": "Polygon", "coordinates": [['), ring, F.lit("]]}}"))

    begin = b'{"type": "FeatureCollection", "name": "a \\"features\\": [", "features": ['
    end = b'], "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::26985"}}}'
    path = str(home / "mixed.geojson")
    files.joined(c.select("k", feature.alias("f")).orderBy("k").select("f"), path, begin, b", \n", end)
    out = None
    for how, df in (("whole", files.read_layer(spark, path)), ("ranges", geojson.read(spark, geojson.layout(spark, path, 1 << 14)))):
        one = df.select(F.lit(how).alias("how"), "k", "val", "mix", "late", "part", M.rounded(K.area("geom"), 3).alias("m2"))
        out = one if out is None else out.unionByName(one)
    return out


CLIP = (3000.0, 2000.0, 9000.0, 30000.0)


@query(f"SELECT how, k FROM p, (VALUES ('gpkg'), ('shp'), ('feet'), ('parquet'), ('geojson')) h(how), (SELECT {CLIP[0]} AS x0, {CLIP[1]} AS y0, {CLIP[2]} AS x1, {CLIP[3]} AS y1) c WHERE {MEET.format(a='p', b='c')}".replace("SELECT how", f"WITH p AS ({PARCELS_SQL}) SELECT how"))
def source_clip(spark, sf_dir):
    """One layer of several, by a box of the working plane, in files of other coordinate systems too."""
    home = _home(spark)
    p = parcels(spark, sf_dir).select("k", F.col("county_code").alias("kind"), "x0", "y0", "x1", "y1", "geom")
    flat = p.select("k", "kind", "geom")
    _gpkg(flat.limit(1), home / "x.gpkg", "another")  # a second layer that must not be read
    _gpkg(flat, home / "x.gpkg", "parcels")
    _shapes(p, home / "x.shp")
    _shapes(p, home / "y.shp", 3937 / 1200, FEET_PRJ)
    files.write_parquet(flat, str(home / "x.parquet"))
    files.write_geojson(flat, str(home / "x.geojson"))
    out = None
    for how, name in (("gpkg", "x.gpkg"), ("shp", "x.shp"), ("feet", "y.shp"), ("parquet", "x.parquet"), ("geojson", "x.geojson")):
        one = files.read_layer(spark, str(home / name), layer="parcels" if how == "gpkg" else None, clip=CLIP)
        # other systems come back to a millimetre, so those that only touch the box count by a slightly larger one
        box = F.lit(bytearray(K.box_wkb(CLIP[0] - 1e-3, CLIP[1] - 1e-3, CLIP[2] + 1e-3, CLIP[3] + 1e-3))) if how in ("feet", "geojson") else F.lit(bytearray(K.box_wkb(*CLIP)))
        one = one.where(K.intersects(F.col("geom"), box)).select(F.lit(how).alias("how"), F.col("k").cast("long").alias("k"))
        out = one if out is None else out.unionByName(one)
    return out


# The projections themselves, as columns: transverse Mercator by its series, Albers in closed form.
def _utm(lon, lat, zone: int):
    a, f = 6378137.0, 1 / 298.257222101
    n, e = f / (2 - f), math.sqrt(f * (2 - f))
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630, 61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880, 49561 * n**4 / 161280 - 179 * n**5 / 168, 34729 * n**5 / 80640)
    scale = 0.9996 * a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    s, d = F.sin(F.radians(lat)), F.radians(lon - (6 * zone - 183))
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, c in enumerate(alpha, 1):
        x, y = x + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta), y + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000 + scale * x, scale * y


def _albers(lon, lat):
    a, f = 6378137.0, 1 / 298.257222101
    e = math.sqrt(f * (2 - f))
    q = lambda s, log: (1 - e * e) * (s / (1 - e * e * s * s) - log((1 - e * s) / (1 + e * s)) / (2 * e))
    p1, p2, p0 = map(math.radians, (29.5, 45.5, 23.0))
    m2 = lambda p: math.cos(p) ** 2 / (1 - (e * math.sin(p)) ** 2)
    q1, q2, q0 = (q(math.sin(p), math.log) for p in (p1, p2, p0))
    n = (m2(p1) - m2(p2)) / (q2 - q1)
    c = m2(p1) + n * q1
    rho, theta = a * F.sqrt(c - n * q(F.sin(F.radians(lat)), F.log)) / n, n * F.radians(lon + 96)
    return rho * F.sin(theta), a * math.sqrt(c - n * q0) / n - rho * F.cos(theta)


_GRID = "c_custkey AS k, (-79.4 + (c_custkey % 331) / 76.0)::DOUBLE AS lon, (37.3 + (c_custkey % 97) / 37.0)::DOUBLE AS lat"


@query(f"WITH g AS (SELECT {_GRID} FROM customer) SELECT how, k, {r2(_conic('lon', 'lat')[0])} AS x, {r2(_conic('lon', 'lat')[1])} AS y FROM g, (VALUES ('utm'), ('albers'), ('mercator')) h(how)")
def source_projections(spark, sf_dir):
    """Layers in UTM zone 18, in the Albers plane of the United States and in Mercator's, read into the working plane."""
    home = _home(spark)
    K.register(spark)
    k = F.col("c_custkey")
    at = table(spark, sf_dir, "customer").select(k.alias("k"), (F.lit(-79.4) + (k % 331) / 76.0).alias("lon"), (F.lit(37.3) + (k % 97) / 37.0).alias("lat"))
    lon, lat = F.col("lon"), F.col("lat")
    mercator = (6378137.0 * F.radians(lon), 6378137.0 * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)))
    out = None
    for how, epsg, (x, y) in (("utm", 26918, _utm(lon, lat, 18)), ("albers", 5070, _albers(lon, lat)), ("mercator", 3857, mercator)):
        path = str(home / f"{how}.geojson")
        files.write_geojson(at.select("k", K.line(F.array(x, y, x, y)).alias("geom")), path, lonlat=False, epsg=epsg)
        b = K.shape("geom")
        one = files.read_layer(spark, path).select(F.lit(how).alias("how"), "k", M.rounded(b["minx"], 2).alias("x"), M.rounded(b["miny"], 2).alias("y"))
        out = one if out is None else out.unionByName(one)
    return out


class _Answers:
    """What a feature service of points says: pages by offset, of which none gives more than ``cap`` rows, or ids.

    Rows are sorted once and filtered once for each filter and box; a page is a slice of them, an id is looked up.
    """

    def __init__(self, rows: list[tuple[int, str, float, float]], paged: bool, cap: int = 7):
        self.rows, self.paged, self.cap, self.asked = sorted(rows), paged, cap, 0
        self.found = lru_cache(maxsize=8)(self._found)

    def _found(self, where: str, geometry: str | None) -> tuple[list[tuple], dict[int, tuple]]:
        found = self.rows
        if where != "1=1":
            least = int(where.split(">=")[1])
            found = [r for r in found if r[0] >= least]
        if geometry:
            b = json.loads(geometry)
            found = [r for r in found if b["xmin"] <= r[2] <= b["xmax"] and b["ymin"] <= r[3] <= b["ymax"]]
        return found, {r[0]: r for r in found}

    def answer(self, path: str, q: dict) -> dict:
        self.asked += 1
        if not path.endswith("/query"):
            return {"name": "points", "maxRecordCount": 10, "advancedQueryCapabilities": {"supportsPagination": self.paged}, "objectIdField": "K", "extent": {"spatialReference": {"wkid": 102100, "latestWkid": 3857}}, "fields": [{"name": "K", "type": "esriFieldTypeOID"}, {"name": "CODE", "type": "esriFieldTypeString", "domain": {"codedValues": [{"code": c, "name": f"code {c}"} for c in "ABC"]}}]}
        found, by_id = self.found(q.get("where", "1=1"), q.get("geometry"))
        if "returnCountOnly" in q:
            return {"count": len(found)}
        if "returnIdsOnly" in q:
            return {"objectIdFieldName": "K", "objectIds": [r[0] for r in reversed(found)]}
        if q.get("where") == "K>=-1":
            return {"error": {"code": 400, "message": "no such field"}}
        if "objectIds" in q:
            page = [by_id[k] for k in map(int, q["objectIds"].split(",")) if k in by_id]
        else:
            at = int(q["resultOffset"])
            page = found[at : at + min(self.cap, int(q["resultRecordCount"]))]
        return {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"K": k, "CODE": c}, "geometry": {"type": "Point", "coordinates": [x, y]}} for k, c, x, y in page]}

    def handler(self) -> type:
        """The class that answers HTTP requests."""
        this = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):
                q = dict(urllib.parse.parse_qsl(self.rfile.read(int(self.headers["Content-Length"])).decode()))
                out = this.answer(self.path, q)
                self.send_response(200)
                self.end_headers()
                self.wfile.write(json.dumps(out).encode())

            def log_message(self, *a):
                pass

        return Handler


class _Service:
    """The answers over HTTP on this machine."""

    def __init__(self, rows: list[tuple[int, str, float, float]], paged: bool):
        self.answers = _Answers(rows, paged)
        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), self.answers.handler())
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/{'paged' if paged else 'ids'}"

    def __enter__(self):
        return self

    def __exit__(self, *a):
        self.server.shutdown()


_AT = "s_suppkey AS k, ['A', 'B', 'C'][1 + CAST(s_suppkey % 3 AS INTEGER)] AS code, (-77.9 + (s_suppkey % 140) / 100.0)::DOUBLE AS lon, (38.9 + (s_suppkey % 83) / 100.0)::DOUBLE AS lat"


@query(f"""WITH g AS (SELECT {_AT} FROM supplier), r AS (SELECT k, code, {r2(_conic('lon', 'lat')[0], 3)} AS x, {r2(_conic('lon', 'lat')[1], 3)} AS y FROM g WHERE k >= 3 AND lon <= -77.5)
SELECT mode, k, code, x, y FROM r, (VALUES ('paged'), ('ids')) m(mode) UNION ALL SELECT 'distinct', NULL, code, NULL, NULL FROM (SELECT DISTINCT code FROM r) UNION ALL SELECT * FROM (VALUES ('page', 10, 'points', NULL, NULL), ('srid', 3857, 'K', NULL, NULL), ('domain', 3, 'code B', NULL, NULL), ('error', NULL, 'no such field', NULL, NULL), ('memo', 1, NULL, NULL, NULL))""")
def source_service(spark, sf_dir):
    """A feature service by pages (some shorter than asked for) and by ids, with its filter and box, kept as Parquet and read back in the working plane; its description, domains and errors."""
    home = _home(spark)
    at = table(spark, sf_dir, "supplier").select("s_suppkey").collect()
    rows = [(r[0], "ABC"[r[0] % 3], -77.9 + (r[0] % 140) / 100.0, 38.9 + (r[0] % 83) / 100.0) for r in at]
    out, more = None, []
    for mode in ("paged", "ids"):
        with _Service(rows, mode == "paged") as service:
            rest.fetch(spark, service.url, str(home / mode), "K>=3", (-78.0, 38.0, -77.4999, 40.0))
            if mode == "paged":
                asked = service.answers.asked
                info, _ = rest.layer_info(service.url), rest.layer_info(service.url)
                more.append(("memo", service.answers.asked - asked, None))
                more += [("page", info.page, info.name), ("srid", info.srid, info.id_field), ("domain", len(info.domains["CODE"]), info.domains["CODE"]["B"])]
                try:
                    rest.http_json(f"{service.url}/query", {"where": "K>=-1", "resultOffset": 0, "resultRecordCount": 1})
                except rest.ServiceError as e:
                    more.append(("error", None, str(e).rsplit(": ", 1)[1]))
        kept = files.read_layer(spark, rest.cache_path(str(home / mode)))
        one = kept.select(F.lit(mode).alias("mode"), F.col("K").alias("k"), F.col("CODE").alias("code"), K.shape("geom").alias("s")).select("mode", "k", "code", M.rounded(F.col("s.minx"), 3).alias("x"), M.rounded(F.col("s.miny"), 3).alias("y"))
        out = one if out is None else out.unionByName(one)
    none = F.lit(None)
    codes = rest.distinct_values(out.where("mode = 'ids'"), "code").select(F.lit("distinct").alias("mode"), none.cast("long").alias("k"), "code", none.cast("double").alias("x"), none.cast("double").alias("y"))
    told = spark.createDataFrame(more, "mode string, k long, code string").select("*", none.cast("double").alias("x"), none.cast("double").alias("y"))
    return out.unionByName(codes).unionByName(told)


@query("SELECT sink, c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN '[\"a\",\"b\"]' ELSE '[]' END AS flags, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 3 = 1 END AS known, CASE WHEN sink = 'csv' THEN NULL ELSE 200.0 END AS m2 FROM customer, (VALUES ('gpkg'), ('geojson'), ('lines'), ('parquet'), ('csv')) s(sink)")
def sink_files(spark, sf_dir):
    """Lists as JSON text, nullable booleans, private columns left out: written and read back."""
    home = _home(spark)
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    K.register(spark)
    x, y = (k % 40) * 700.0, F.expr("c_custkey div 40") * 700.0
    some = c.select(k.alias("k"), F.col("c_name").alias("name"), F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("flags"), F.when(k % 3 != 0, k % 3 == 1).alias("known"), F.lit(None).alias("nothing"), F.lit(1).alias("_private"), K.box(x, y, x + 20, y + 10).alias("geom"))
    _gpkg(some, home / "x.gpkg", "rows")
    files.write_geojson(some, str(home / "x.geojson"), lonlat=False)
    files.write_geojson_lines(some, str(home / "x.geojsonl"), lonlat=False)
    files.write_parquet(some, str(home / "x.parquet"))
    files.write_csv(some, str(home / "x.csv"))
    lines = spark.read.json(str(home / "x.geojsonl"), "type string, properties struct<k:long,name:string,flags:string,known:boolean>")
    tables = {
        "gpkg": files.read_layer(spark, str(home / "x.gpkg")), "geojson": files.read_layer(spark, str(home / "x.geojson")), "lines": lines.select("properties.*", F.lit(None).cast("binary").alias("geom")),
        "parquet": files.read_layer(spark, str(home / "x.parquet")), "csv": spark.read.csv(str(home / "x.csv"), header=True, escape='"').withColumn("geom", F.lit(None).cast("binary")),
    }
    out = None
    for sink, df in tables.items():
        m2 = F.lit(200.0) if sink == "lines" else M.rounded(K.area("geom"), 6)
        one = df.select(F.lit(sink).alias("sink"), F.col("k").cast("long").alias("k"), "name", "flags", F.col("known").cast("boolean").alias("known"), m2.alias("m2"))
        assert "_private" not in df.columns
        out = one if out is None else out.unionByName(one)
    return out


# ---- elevation -----------------------------------------------------------------------
COLS = 130
Z = "CASE WHEN ({k}) % 37 <> 5 THEN (3 * (c % 7) * (c % 7) + 5 * (r % 5) * (r % 5)) / 8.0 END"


@query(f"WITH o AS (SELECT o_orderkey // {COLS} AS r, o_orderkey % {COLS} AS c, ({Z.format(k='o_orderkey')})::DOUBLE AS z FROM (SELECT o_orderkey, o_orderkey // {COLS} AS r, o_orderkey % {COLS} AS c FROM orders)), g AS (SELECT r, c FROM range((SELECT max(r) + 1 FROM o)) a(r), range({COLS}) b(c)) SELECT r::INTEGER AS row, c::INTEGER AS col, z FROM g LEFT JOIN o USING (r, c)")
def source_geotiff(spark, sf_dir):
    """Cells of a GeoTIFF in compressed strips, made from the orders, with a value for none."""
    home, k = _home(spark), F.col("o_orderkey")
    row, col = F.expr(f"o_orderkey div {COLS}"), k % COLS
    z = F.when(k % 37 != 5, (3 * (col % 7) * (col % 7) + 5 * (row % 5) * (row % 5)) / 8.0)
    o = table(spark, sf_dir, "orders").select(row.alias("row"), col.alias("col"), z.alias("z"))
    rows = o.agg(F.max("row")).first()[0] + 1

    files.write_geotiff(o, str(home / "dem.tif"), (rows, COLS), (0.0, 9000.0, 50.0, 50.0), 26985, -9999.0)
    cells, grid = cli.elevation(spark, str(home / "dem.tif"))
    assert grid == S.Grid(0.0, 9000.0, 50.0, 50.0)
    return cells


_EL = "c AS (SELECT o_orderkey // 100 AS r, o_orderkey % 100 AS c, ({z})::DOUBLE AS z FROM (SELECT o_orderkey, o_orderkey // 100 AS r, o_orderkey % 100 AS c FROM orders))".format(z=Z.format(k="o_orderkey"))
_WG = "coalesce((lead(f) OVER {w} - lag(f) OVER {w}) / 100, (lead(f) OVER {w} - f) / 50, (f - lag(f) OVER {w}) / 50)"


@query(f"""{CTES}, {_EL}, ex AS (SELECT max(r) AS rm, max(c) AS cm FROM c),
v AS (SELECT k, x0, y0, x1, y1, greatest(floor((x0 - 30) / 50), 0) AS c0, least(floor((x0 - 30) / 50) + ceil((x1 - x0 + 60) / 50) - 1, cm) AS c1, greatest(floor((10000 - y1 - 30) / 50), 0) AS r0, least(floor((10000 - y1 - 30) / 50) + ceil((y1 - y0 + 60) / 50) - 1, rm) AS r1 FROM p, ex),
u AS (SELECT v.*, r, c, z, coalesce(z, avg(z) OVER (PARTITION BY k)) AS f FROM v JOIN c ON r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1 WHERE c1 - c0 >= 2 AND r1 - r0 >= 2),
g AS (SELECT *, {_WG.format(w='(PARTITION BY k, r ORDER BY c)')} AS gx, {_WG.format(w='(PARTITION BY k, c ORDER BY r)')} AS gy FROM u),
s AS (SELECT k, x0 AS px0, y0 AS py0, x1 AS px1, y1 AS py1, 50.0 * c AS x0, 10000.0 - 50 * (r + 1) AS y0, 50.0 * (c + 1) AS x1, 10000.0 - 50 * r AS y1 FROM g WHERE z IS NOT NULL AND 100 * sqrt(gx * gx + gy * gy) > 12),
t AS (SELECT k, sum(greatest(0, least(x1, px1) - greatest(x0, px0)) * greatest(0, least(y1, py1) - greatest(y0, py0))) AS m2 FROM s GROUP BY 1) SELECT k, {r2('m2', 3)} AS steep_m2 FROM t WHERE m2 > 0""")
def steep_windows(spark, sf_dir):
    """Steep ground by each parcel's own window of cells, some of them without elevation."""
    o = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 100").cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"), "o_orderkey")
    z = F.when(F.col("o_orderkey") % 37 != 5, (3 * (F.col("col") % 7) * (F.col("col") % 7) + 5 * (F.col("row") % 5) * (F.col("row") % 5)) / 8.0)
    cells = o.select("row", "col", z.alias("z"))
    p = parcels(spark, sf_dir).withColumn("account_id", F.col("k"))
    return S.window_steep(p, cells, S.Grid(0.0, 10000.0, 50.0, 50.0), 12.0).select(F.col("account_id").alias("k"), M.rounded(K.area("geom"), 3).alias("steep_m2"))


_STEP = "coalesce((lead(f) OVER {w} - lag(f) OVER {w}) / (2 * {d}), (lead(f) OVER {w} - f) / {d}, (f - lag(f) OVER {w}) / {d})"


@query(f"""{CTES}, {_EL}, ex AS (SELECT max(r) AS rm, max(c) AS cm FROM c),
sv AS (SELECT k, x0, y0, x1, y1, greatest(floor((x0 - 33.3) / 50), 0) AS c0, least(floor((x0 - 33.3) / 50) + ceil((x1 - x0 + 66.6) / 50) - 1, cm) AS c1, greatest(floor((10000 - y1 - 33.3) / 50), 0) AS r0, least(floor((10000 - y1 - 33.3) / 50) + ceil((y1 - y0 + 66.6) / 50) - 1, rm) AS r1 FROM p, ex),
sn AS (SELECT sv.*, (r1 - r0 + 1)::INTEGER AS h, (c1 - c0 + 1)::INTEGER AS w, greatest(3, round_even((r1 - r0 + 1) * 50.0 / 83, 0))::INTEGER AS dn, greatest(3, round_even((c1 - c0 + 1) * 50.0 / 83, 0))::INTEGER AS ac FROM sv WHERE c1 - c0 >= 2 AND r1 - r0 >= 2),
su AS (SELECT sn.*, (r - r0)::INTEGER AS i, (c - c0)::INTEGER AS j, z FROM sn JOIN c ON r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1),
se AS (SELECT *, unnest(range(i * dn // h, ((i + 1) * dn - 1) // h + 1)) AS o FROM su), sb AS (SELECT *, unnest(range(j * ac // w, ((j + 1) * ac - 1) // w + 1)) AS q FROM se),
st AS (SELECT *, (least((i + 1) * dn / h, o + 1) - greatest(i * dn / h, o)) * (least((j + 1) * ac / w, q + 1) - greatest(j * ac / w, q)) AS t FROM sb),
sm AS (SELECT k, any_value(x0) AS x0, any_value(y0) AS y0, any_value(x1) AS x1, any_value(y1) AS y1, any_value(c0) AS c0, any_value(r0) AS r0, any_value(50.0 * w / ac) AS dx, any_value(50.0 * h / dn) AS dy, o, q, sum(z * t) FILTER (z IS NOT NULL) / sum(t) FILTER (z IS NOT NULL) AS z FROM st GROUP BY k, o, q),
sf AS (SELECT *, coalesce(z, avg(z) OVER (PARTITION BY k)) AS f FROM sm),
sg AS (SELECT *, {_STEP.format(w='(PARTITION BY k, o ORDER BY q)', d='dx')} AS gx, {_STEP.format(w='(PARTITION BY k, q ORDER BY o)', d='dy')} AS gy FROM sf),
sq AS (SELECT k, sum(greatest(0, least(50 * c0 + (q + 1) * dx, x1) - greatest(50 * c0 + q * dx, x0)) * greatest(0, least(10000 - 50 * r0 - o * dy, y1) - greatest(10000 - 50 * r0 - (o + 1) * dy, y0))) AS m2 FROM sg WHERE z IS NOT NULL AND 100 * sqrt(gx * gx + gy * gy) > 7.07 GROUP BY 1)
SELECT k, {r2('m2 + 0.0123', 1)} AS steep_m2 FROM sq WHERE m2 > 0.01""")
def steep_in_feet(spark, sf_dir):
    """Steep ground on a grid in feet, averaged to cells of some 83 m with parts of cells, against windows in metres."""
    o = table(spark, sf_dir, "orders").select(F.expr("o_orderkey div 100").cast("int").alias("row"), (F.col("o_orderkey") % 100).cast("int").alias("col"), "o_orderkey")
    z = F.when(F.col("o_orderkey") % 37 != 5, (3 * (F.col("col") % 7) * (F.col("col") % 7) + 5 * (F.col("row") % 5) * (F.col("row") % 5)) / 8.0)
    p = parcels(spark, sf_dir).withColumn("account_id", F.col("k"))
    feet = 3937 / 1200
    grid = S.Grid(0.0, 10000.0 * feet, 50.0 * feet, 50.0 * feet, tuple(systems.of_epsg(2248).numbers()))
    got = S.window_steep(p, o.select("row", "col", z.alias("z")), grid, 7.07, resample_m=83.0, margin=33.3)
    return got.select(F.col("account_id").alias("k"), K.area("geom").alias("m2")).where("m2 > 0.01").select("k", M.rounded(F.col("m2") + 0.0123, 1).alias("steep_m2"))  # areas of hundredths stay off the halves


def _flat(spark, sf_dir, z):
    """Cells from all orders, a hundred rows and a column for each hundred keys."""
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 100).cast("int").alias("row"), F.expr("o_orderkey div 100").cast("int").alias("col"), "o_orderkey", "o_custkey")
    return o.select("row", "col", z.alias("z"))


#: One-sided beside a cell without elevation, none between two of them.
_ONE = "coalesce((lead(z) OVER {w} - lag(z) OVER {w}) / 50, (lead(z) OVER {w} - z) / 25, (z - lag(z) OVER {w}) / 25, 0)"


@query(f"""WITH RECURSIVE c AS (SELECT o_orderkey % 100 AS r, o_orderkey // 100 AS c, CASE WHEN o_orderkey % 41 <> 7 THEN (o_custkey % 16)::DOUBLE END AS z FROM orders),
g AS (SELECT r, c, z, {_ONE.format(w='(PARTITION BY r ORDER BY c)')} AS gx, {_ONE.format(w='(PARTITION BY c ORDER BY r)')} AS gy FROM c),
m AS (SELECT r, c, r * 4294967296 + c AS id FROM g WHERE z IS NOT NULL AND 100 * sqrt(gx * gx + gy * gy) > 18.07),
n AS (SELECT a.id, b.id AS other FROM m a JOIN m b ON a.r = b.r AND a.c = b.c + 1 UNION ALL SELECT a.id, b.id FROM m a JOIN m b ON a.r = b.r AND a.c = b.c - 1 UNION ALL SELECT a.id, b.id FROM m a JOIN m b ON a.r = b.r + 1 AND a.c = b.c UNION ALL SELECT a.id, b.id FROM m a JOIN m b ON a.r = b.r - 1 AND a.c = b.c),
f AS (SELECT id, id AS part FROM m UNION SELECT n.other, f.part FROM f JOIN n ON f.id = n.id WHERE f.part < n.other),
l AS (SELECT id, min(part) AS part FROM f GROUP BY id), d AS (SELECT id, count(*) AS beside FROM n GROUP BY id)
SELECT part, count(*) AS cells, {r2('625.0 * count(*)', 3)} AS m2, {r2('25.0 * sum(4 - coalesce(beside, 0))', 3)} AS rim_m FROM l LEFT JOIN d USING (id) GROUP BY part""")
def steep_ground_parts(spark, sf_dir):
    """Steep ground of a whole grid as polygons, 4-connected across tiles of 16 cells: cells, area and rim of each, holes included."""
    K.register(spark)
    cells = _flat(spark, sf_dir, F.when(F.col("o_orderkey") % 41 != 7, (F.col("o_custkey") % 16).cast("double")))
    got = raster.whole(raster.steep_pieces(cells, S.Grid(0.0, 2500.0, 25.0, 25.0), 18.07, side=16))
    return got.select("part", "cells", M.rounded(K.area("geom"), 3).alias("m2"), M.rounded(K.length(K.boundary("geom")), 3).alias("rim_m"))


_PLAIN_Z = "CASE WHEN o_orderkey % 997 <> 5 THEN (3 * (c % 7) * (c % 7) + 5 * (r % 5) * (r % 5)) / 8.0 END"
_PLAIN_G = "coalesce((lead(f) OVER {w} - lag(f) OVER {w}) / 50, (lead(f) OVER {w} - f) / 25, (f - lag(f) OVER {w}) / 25)"


@query(f"""{CTES}, c AS (SELECT r, c, ({_PLAIN_Z})::DOUBLE AS z FROM (SELECT o_orderkey, o_orderkey % 100 AS r, o_orderkey // 100 AS c FROM orders)), ex AS (SELECT max(r) AS rm, max(c) AS cm FROM c),
v AS (SELECT k, x0, y0, x1, y1, greatest(floor((x0 - 30) / 25), 0) AS c0, least(floor((x0 - 30) / 25) + ceil((x1 - x0 + 60) / 25) - 1, cm) AS c1, greatest(floor((2500 - y1 - 30) / 25), 0) AS r0, least(floor((2500 - y1 - 30) / 25) + ceil((y1 - y0 + 60) / 25) - 1, rm) AS r1 FROM p, ex),
u AS (SELECT v.*, r, c, z, coalesce(z, avg(z) OVER (PARTITION BY k)) AS f FROM v JOIN c ON r BETWEEN r0 AND r1 AND c BETWEEN c0 AND c1 WHERE c1 - c0 >= 2 AND r1 - r0 >= 2),
g AS (SELECT *, {_PLAIN_G.format(w='(PARTITION BY k, r ORDER BY c)')} AS gx, {_PLAIN_G.format(w='(PARTITION BY k, c ORDER BY r)')} AS gy FROM u),
s AS (SELECT k, greatest(0, least(25.0 * (c + 1), x1) - greatest(25.0 * c, x0)) * greatest(0, least(2500.0 - 25 * r, y1) - greatest(2500.0 - 25 * (r + 1), y0)) AS m2 FROM g WHERE z IS NOT NULL AND 100 * sqrt(gx * gx + gy * gy) > 12.07),
t AS (SELECT k, sum(m2) AS m2 FROM s GROUP BY 1) SELECT k, {r2('m2', 3)} AS steep_m2 FROM t WHERE m2 > 0""")
def steep_in_parcels(spark, sf_dir):
    """Steep ground of parcels from shapes made once, and by their windows where these matter: their sum is that of windows alone."""
    c, r = F.col("col") % 7, F.col("row") % 5
    cells = _flat(spark, sf_dir, F.when(F.col("o_orderkey") % 997 != 5, (3 * c * c + 5 * r * r) / 8.0))
    p = parcels(spark, sf_dir).withColumn("account_id", F.col("k"))
    got = raster.steep_in_parcels(p, cells, S.Grid(0.0, 2500.0, 25.0, 25.0), 12.07)
    return got.select(F.col("account_id").alias("k"), M.rounded(K.area("geom"), 3).alias("steep_m2"))


# ---- configuration and command line ------------------------------------------------------
@query("""WITH s AS (SELECT DISTINCT n_nationkey % 6 AS a, n_regionkey AS b FROM nation), t AS (SELECT a, b, [x FOR x IN range(a, b + 1)] AS l FROM s)
SELECT a || '-' || b AS spec, CASE WHEN a BETWEEN 1 AND 4 AND b BETWEEN a AND 4 THEN array_to_string(l, ',') ELSE 'error' END AS stages FROM t
UNION ALL SELECT b || ', ' || a, CASE WHEN a BETWEEN 1 AND 4 AND b BETWEEN 1 AND 4 THEN CASE WHEN a = b THEN a || '' ELSE least(a, b) || ',' || greatest(a, b) END ELSE 'error' END FROM t""")
def stage_lists(spark, sf_dir):
    """Stages as the command line takes them, ranges and lists made of the nations' numbers."""

    def of(spec):
        try:
            return ",".join(map(str, cli.stage_list(spec)))
        except config.ConfigError:
            return "error"

    pairs = [tuple(r) for r in table(spark, sf_dir, "nation").select(F.col("n_nationkey") % 6, "n_regionkey").distinct().collect()]
    return spark.createDataFrame([(x, of(x)) for a, b in pairs for x in (f"{a}-{b}", f"{b}, {a}")], "spec string, stages string")


@query("SELECT n_name AS code, CASE WHEN n_nationkey % 2 = 0 THEN 'nation ' || n_nationkey END AS description, CASE n_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS answer FROM nation")
def zoning_templates(spark, sf_dir):
    """The template of a mapping, with the answers given before."""
    import yaml

    rows = table(spark, sf_dir, "nation").collect()
    codes = {r["n_name"]: f"nation {r['n_nationkey']}" if r["n_nationkey"] % 2 == 0 else None for r in rows}
    known = {r["n_name"]: {"is_agricultural": (True, False, None)[r["n_nationkey"] % 3]} for r in rows}
    body = yaml.safe_load(schema.zoning_template("Nowhere", "CODE", codes, known))["codes"]
    return spark.createDataFrame([(c, v["description"], v["is_agricultural"]) for c, v in body.items()], "code string, description string, answer boolean")


@query("SELECT c_custkey AS account_id, c_name AS owner_name, c_acctbal AS acres, 'zone' AS missing, c_mktsegment AS use_code FROM customer")
def schema_resolution(spark, sf_dir):
    """Canonical names for a table's fields: candidates in their order, as they are or in another case; what is missing."""
    df = table(spark, sf_dir, "customer")
    spec = {"required": {"account_id": ["ACCT", "C_CUSTKEY"], "owner_name": ["C_NAME", "c_nationkey"], "zone": ["ZONE"]}, "optional": {"acres": ["ACRES", "C_AcctBal"], "use_code": ["c_comment", "C_MktSegment"], "year": ["YEAR"]}}
    got = schema.resolve(spec, df.columns)
    return df.select(*[F.col(f).alias(c) for c, f in got.mapping.items()], F.lit(",".join(got.missing_required)).alias("missing"))


@query(f"""WITH p AS ({PARCELS_SQL}), m AS (SELECT k, {r2('(x1 - x0) * (y1 - y0) / 4046.8564224')} AS gross, CASE WHEN k % 4 = 0 THEN {r2('(x1 - x0) * 30 / 4046.8564224')} ELSE 0 END AS hostile FROM p)
SELECT kind, k, gross, hostile FROM m, (VALUES ('parquet'), ('csv'), ('lines')) t(kind) UNION ALL SELECT 'encumbrances', k, hostile, NULL FROM m WHERE hostile > 0
UNION ALL SELECT 'summary', count(*)::BIGINT, count(*) FILTER (gross >= 40)::DOUBLE, 1.0 FROM m UNION ALL SELECT 'missing', NULL, 1.0, NULL""")
def cli_run(spark, sf_dir):
    """The command line's run on files made from the tables, by a configuration of its own with one layer that isn't there: its outputs read back."""
    home = _home(spark)
    K.register(spark)
    p = parcels(spark, sf_dir)
    files.write_parquet(p.select(F.col("account_id").alias("ACCTID"), F.col("county_code").alias("JURSCODE"), F.col("owner_name").alias("OWNNAME1"), F.col("owner_mailing_address").alias("OWNADD1"), F.lit("Frederick").alias("OWNCITY"), "geom"), str(home / "parcels.parquet"))
    band = p.where("k % 4 = 0").select(F.concat(F.lit("E"), F.col("k") % 3).alias("name"), K.box(F.col("x0"), F.col("y0") + 30, F.col("x1"), F.col("y0") + 60).alias("geom"))
    files.write_gpkg(band, str(home / "band.gpkg"), "band")
    files.write_geojson(spark.range(1).select(K.box(F.lit(-1000), F.lit(-1000), F.lit(40000), F.lit(top(spark, sf_dir))).alias("geom")), str(home / "study.geojson"), lonlat=False)
    (home / "schema.yaml").write_text(json.dumps({"required": {"account_id": ["ACCTID"], "county_code": ["JURSCODE"], "owner_name": ["OWNNAME1"], "owner_addr_line1": ["OWNADD1"], "owner_city": ["OWNCITY"]}, "optional": {}}))
    easement = {"type": "easement", "category": "legal", "implication": "hostile", "subtract_from_usable": True, "name_field": "name"}
    (home / "pipeline.yaml").write_text(json.dumps({
        "acreage_min": 40, "study_area": "study.geojson", "counties": {"FRED": "Frederick", "CARR": "Carroll", "WASH": "Washington"}, "parcels": {"path": "parcels.parquet", "schema": "schema.yaml", "acreage_source": "geometry"},
        "constraints": [easement | {"name": "band", "path": "band.gpkg"}, easement | {"name": "gone", "path": "gone.gpkg"}], "run": {"process_all": True, "output_dir": "out"},
    }))
    cfg = config.load(str(home / "pipeline.yaml"))
    told = cli.run(spark, cfg, cli.stage_list("1-2"), cfg.output_dir)
    out = Path(cfg.output_dir)
    number = F.substring("account_id", 2, 20).cast("long").alias("k")
    measures = [F.col("gross_acres").cast("double").alias("gross"), F.col("hostile_easement_acres").cast("double").alias("hostile")]
    scored = spark.read.parquet(str(out / "parcels_scored.parquet"))
    csv = spark.read.csv(str(out / "parcels_scored.csv"), header=True, escape='"')
    lines = spark.read.json(str(out / "parcels_scored.geojsonl"), "properties struct<account_id:string,gross_acres:double,hostile_easement_acres:double>").select("properties.*")
    rows = None
    for kind, df in (("parquet", scored), ("csv", csv), ("lines", lines)):
        one = df.select(F.lit(kind).alias("kind"), number, *measures)
        rows = one if rows is None else rows.unionByName(one)
    taken = spark.read.csv(str(out / "encumbrances.csv"), header=True, escape='"').select(F.lit("encumbrances").alias("kind"), number, F.col("acres").cast("double").alias("gross"), F.lit(None).cast("double").alias("hostile"))
    read = json.loads((out / "summary.json").read_text())
    one = read["stage1"]
    summary = spark.createDataFrame([("summary", one["parcels_in_study_area"], float(one["meets_acreage"]), float(read["scored_parcels"] == one["parcels_in_study_area"] and (out / "parcels_scored.gpkg").exists())), ("missing", None, float(told["missing_layers"] == ["gone"]), None)], "kind string, k long, gross double, hostile double")
    return rows.unionByName(taken).unionByName(summary)


#: Of each scored parcel of the synthetic county: reason, zoning, gross and usable acres (from the boxes), landlocked, blocked, its first blocker, foreign strip, no road near, authorities.
_SIDE, _ACRE = 640.0, 4046.8564224
_SCORED = (
    ("CARR-O", "AG", 640 * 640, 640 * 640, False, False, None, False, False, "county"), ("FRED-A", "A", 640 * 640, 640 * 640 - 220 * 220 - 40 * 60.96, False, False, None, False, False, "county;state"),
    ("FRED-B", "A", 640 * 640, 640 * 640 - 640 * 2 * 30.48, False, False, None, False, False, "county"), ("FRED-C", "A", 640 * 640, 640 * 640 - 640 * 60 - 60 * 60.96, False, False, None, False, False, "county"),
    ("FRED-D", "A", 640 * 625, 640 * 625, True, True, "FRED-S", True, False, ""), ("FRED-E", "A", 640 * 625, 640 * 625, True, False, None, False, False, "county"),
    ("FRED-H", "A", 640 * 542, 640 * 542, True, False, None, False, True, ""), ("FRED-I", "A", 640 * 640, 640 * 640, False, False, None, False, False, "county;state"),
    ("FRED-J", "A", 640 * 640, None, False, False, None, False, False, "county"), ("FRED-L", "A", 640 * 640, 640 * 640, False, False, None, False, False, "county"),
    ("FRED-M", "A", None, 640 * 640 - 95 * 640 - 180 * 180, False, False, None, False, False, "county"),
)
_lit = lambda v: "NULL" if v is None else repr(v) if isinstance(v, str) else str(v).upper() if isinstance(v, bool) else f"{v / _ACRE!r}::DOUBLE"
_SCORED_SQL = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in _SCORED)


@check(f"SELECT id AS account_id, zoning, 'pass' AS reason, {r2('coalesce(gross, 80.0)', 1)} AS gross_acres, {r2(r2('usable'), 1)} AS usable_acres, landlocked, blocked, blocker, strip, no_road, authorities FROM (VALUES {_SCORED_SQL}) t(id, zoning, gross, usable, landlocked, blocked, blocker, strip, no_road, authorities)")
def fixture_scored(spark, sf_dir):
    """All four stages on the synthetic county, against what follows from its boxes. Usable acres of the parcel on the hill are left out."""
    from .plans import record

    got = record.run(fixture.inputs(spark), fixture.config())["scored"]
    usable = F.when(F.col("account_id") != "FRED-J", M.rounded(F.col("usable_acres"), 1))
    blocker = F.when(F.col("account_id") == "FRED-D", F.col("blocking_parcel_account_id"))
    return got.select("account_id", "zoning", F.col("stage1_pass_reason").alias("reason"), M.rounded(F.col("gross_acres"), 1).alias("gross_acres"), usable.alias("usable_acres"), F.col("landlocked_apparent").alias("landlocked"), F.col("frontage_blocked_by_foreign_parcel").alias("blocked"), blocker.alias("blocker"), F.col("reserve_strip_detected").alias("strip"), F.col("no_public_row_nearby").alias("no_road"), F.col("frontage_authorities").alias("authorities"))


_WRITTEN = ("encumbrances.csv", "entry_points.gpkg", "entry_points.parquet", "frontage.gpkg", "frontage.parquet", "islands.csv", "parcels_scored.csv", "parcels_scored.geojson", "parcels_scored.geojsonl", "parcels_scored.gpkg", "parcels_scored.parquet", "parcels_stage1.gpkg", "parcels_stage1.parquet", "reserve_strips.csv", "summary.json", "summary.md", "usable_area.gpkg", "usable_area.parquet")
_TOLD = {"scored_parcels": 11, "parcels_in_study_area": 16, "stage1_pass": 11, "unique_owner_keys_passing": 11, "missing": 1, "markdown": 1, "landlocked_apparent": 3, "reserve_strip_detected": 1, "features": 11, "layer rows": 11}


@check("SELECT * FROM (VALUES " + ", ".join([*(f"('file', '{n}', 1)" for n in _WRITTEN), *(f"('summary', '{k}', {v})" for k, v in _TOLD.items())]) + ") t(kind, name, n)")
def fixture_run(spark, sf_dir):
    """The synthetic county as files, run by its configuration with one layer taken away: the files that are written, and the summary."""
    import sqlite3

    home = _home(spark)
    cfg_path = fixture.write(spark, str(home))
    (home / "raw/constraints/wetlands.gpkg").unlink()
    out = home / "out"
    s = cli.run(spark, config.load(cfg_path), cli.stage_list("1-4"), str(out))
    read = json.loads((out / "summary.json").read_text())
    collection = json.loads((out / "parcels_scored.geojson").read_text())
    told = {
        "scored_parcels": read["scored_parcels"], "parcels_in_study_area": read["stage1"]["parcels_in_study_area"], "stage1_pass": read["stage1"]["stage1_pass"], "unique_owner_keys_passing": read["stage1"]["unique_owner_keys_passing"],
        "missing": int(read["missing_layers"] == ["wetlands"] and s["missing_layers"] == ["wetlands"]), "markdown": int("| Frederick | 15 |" in (out / "summary.md").read_text()), "landlocked_apparent": read["landlocked_apparent"], "reserve_strip_detected": read["reserve_strip_detected"],
        "features": len(collection["features"]) if collection["type"] == "FeatureCollection" else -1, "layer rows": sqlite3.connect(out / "parcels_scored.gpkg").execute("SELECT count(*) FROM parcels_scored").fetchone()[0],
    }
    return spark.createDataFrame([*(("file", p.name, 1) for p in sorted(out.iterdir())), *(("summary", k, v) for k, v in told.items())], "kind string, name string, n int")

