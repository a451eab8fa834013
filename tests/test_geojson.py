"""The GeoJSON scan against a plain parse: ranges of any size, awkward strings, fields of all features, crs anywhere."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cadastra.kernel import functions as K
from cadastra.sources import files, geojson

BOX = {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}
CRS = {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::26985"}}


@pytest.fixture(scope="module")
def geo(spark):
    K.register(spark)
    return spark


def made(rnd, n):
    text = lambda: "".join(rnd.choice(['"', "\\", "{", "}", "[", "]", ":", ",", "é", "\n", "\\\\", "x", " ", '"features":[', "😀"]) for _ in range(rnd.randrange(12)))
    value = lambda d=0: rnd.choice([None, 1, 2.5, True, text(), [1, text()], {text(): text()}]) if d == 0 else None
    return [{"type": "Feature", "properties": {text() or "p": value() for _ in range(rnd.randrange(4))} if rnd.random() < 0.9 else None, "geometry": BOX if rnd.random() < 0.8 else None} for _ in range(n)]


def local(monkeypatch):
    monkeypatch.setattr(geojson, "ranged", lambda spark, n, of, kind: [(k, *r) for k in range(n) for r in of(k)])


@pytest.mark.parametrize("seed", range(6))
def test_ranges_of_any_size(monkeypatch, tmp_path, seed):
    local(monkeypatch)
    rnd = random.Random(seed)
    features = made(rnd, 25)
    head, tail = [{}, {"name": 'a "features":[ {', "bbox": [0, 0, 1, 1], "foreign": {"features": [{"type": "Feature"}]}}], [{}, {"crs": CRS, "list": [{"a": 1}]}]
    doc = {"type": "FeatureCollection"} | head[seed % 2] | {"features": features} | tail[seed // 2 % 2]
    for indent in (None, 1):
        path = tmp_path / f"{indent}.geojson"
        path.write_text(json.dumps(doc, indent=indent, ensure_ascii=bool(seed % 2)))
        for chunk in (5, 64, 701, 10**6):
            at = geojson.layout(None, str(path), chunk)
            got = [json.loads(t) for k in range(len(at)) for _, t in at.features(k)]
            assert got == features and at.crs == doc.get("crs")
            places = [p for k in range(len(at)) for p, _ in at.features(k)]
            assert places == sorted(set(places))


def test_lines_and_single_features(monkeypatch, tmp_path):
    local(monkeypatch)
    features = made(random.Random(9), 30)
    (tmp_path / "a.geojsonl").write_text("\n".join(json.dumps(f) for f in features))
    (tmp_path / "b.json").write_text("\x1e" + "\n\x1e".join(json.dumps(f, indent=2) for f in features))
    for name in ("a.geojsonl", "b.json"):
        for chunk in (33, 10**6):
            at = geojson.layout(None, str(tmp_path / name), chunk)
            assert [json.loads(t) for k in range(len(at)) for _, t in at.features(k)] == features
    (tmp_path / "one.geojson").write_text(json.dumps(features[0]))
    (tmp_path / "bare.geojson").write_text(json.dumps(BOX))
    (tmp_path / "none.geojson").write_text('{"type":"FeatureCollection","features":[]}')
    (tmp_path / "empty.geojson").write_text("")
    of = lambda name: [geojson.parsed(t) for _, t in geojson.layout(None, str(tmp_path / name)).features(0)]
    assert of("one.geojson") == [(features[0]["geometry"], features[0]["properties"] or {})] and of("bare.geojson") == [(BOX, {})]
    assert of("none.geojson") == [] and of("empty.geojson") == []
    (tmp_path / "cut.geojson").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{')
    with pytest.raises(ValueError, match="doesn't end"):
        of("cut.geojson")


def test_fields_of_all_features(geo, tmp_path, monkeypatch):
    rows = [{"a": 1, "c": None, "same": True}, {"a": 1.5, "b": "x", "c": "AE", "same": False}, None, {"geom": 7, "A": 2, "mix": 1}, {"mix": "one", "list": [1, {"z": None}], "late": 3, "big": 10**30}]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": p, "geometry": BOX} for p in rows], "crs": CRS}
    path = str(tmp_path / "x.geojson")
    (tmp_path / "x.geojson").write_text(json.dumps(doc, indent=1))
    for chunk in (100, 1 << 20):
        monkeypatch.setattr(geojson, "CHUNK", chunk)
        geojson._layout.cache_clear()
        df = files.read_layer(geo, path)
        assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [("_row", "bigint"), ("A_2", "bigint"), ("a", "double"), ("b", "string"), ("big", "double"), ("c", "string"), ("geom_2", "bigint"), ("late", "bigint"), ("list", "string"), ("mix", "string"), ("same", "boolean"), ("geom", "binary"), ("_source_file", "string")]
        got = [tuple(r) for r in df.orderBy("_row").select("a", "c", "same", "b", "geom_2", "A_2", "mix", "list", "late", "big", K.area("geom")).collect()]
        assert got == [(1.0, None, True, None, None, None, None, None, None, None, 4.0), (1.5, "AE", False, "x", None, None, None, None, None, None, 4.0), (*[None] * 10, 4.0), (None, None, None, None, 7, 2, "1", None, None, None, 4.0), (None, None, None, None, None, None, "one", '[1,{"z":null}]', 3, 1e30, 4.0)]
        assert files.read_layer(geo, path, where="late == 3 or b == 'x'", columns=["late"]).count() == 2
        assert df.rdd.getNumPartitions() == len(geojson.layout(geo, path))
    geojson._layout.cache_clear()


def test_crs_behind_the_features(geo, tmp_path):
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"text": "x" * 9000}, "geometry": BOX}], "crs": CRS}
    (tmp_path / "x.geojson").write_text(json.dumps(doc))
    assert files.epsg_of(str(tmp_path / "x.geojson"), spark=geo) == 26985
    assert files.read_layer(geo, str(tmp_path / "x.geojson")).select(K.area("geom")).first()[0] == 4.0
    del doc["crs"]
    (tmp_path / "y.geojson").write_text(json.dumps(doc))
    assert files.epsg_of(str(tmp_path / "y.geojson"), spark=geo) == 4326


def test_metres_are_not_degrees(geo, tmp_path):
    far = {"type": "Point", "coordinates": [400000, 150000]}
    (tmp_path / "m.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": far}]}))
    with pytest.raises(Exception, match="not degrees"):
        files.read_layer(geo, str(tmp_path / "m.geojson")).collect()


def test_single_files_keep_order_and_layers(geo, tmp_path):
    import sqlite3

    df = geo.range(500).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, True).alias("flag"), K.box(F.col("id"), F.lit(0), F.col("id") + 1, F.lit(1)).alias("geom")).repartition(5).sortWithinPartitions("k")
    order = [r["k"] for r in df.collect()]
    files.write_geojson(df, str(tmp_path / "x.geojson"), lonlat=False)
    assert [f["properties"]["k"] for f in json.loads((tmp_path / "x.geojson").read_text())["features"]] == order
    files.write_gpkg(df.limit(3), str(tmp_path / "x.gpkg"), "other")
    for _ in range(2):
        files.write_gpkg(df, str(tmp_path / "x.gpkg"), "rows")
    con = sqlite3.connect(tmp_path / "x.gpkg")
    assert [r[0] for r in con.execute("SELECT k FROM rows ORDER BY fid")] == order and con.execute("SELECT count(*) FROM other").fetchone() == (3,)
    assert con.execute("SELECT count(*) FROM rtree_rows_geom WHERE maxx < 10").fetchone() == (9,)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["x.geojson", "x.gpkg"]
    assert files.read_layer(geo, str(tmp_path / "x.gpkg"), layer="rows", clip=(0, 0, 1, 1)).count() == 500  # within the margin
    files.write_gpkg(df.limit(0), str(tmp_path / "none.gpkg"), "rows")
    assert files.read_layer(geo, str(tmp_path / "none.gpkg")).count() == 0
    files.write_geojson(df.limit(0), str(tmp_path / "none.geojson"))
    assert json.loads((tmp_path / "none.geojson").read_text())["features"] == []


def test_geopackage_row_ids_with_gaps(geo, tmp_path):
    import sqlite3

    files.write_gpkg(geo.range(10).select(F.col("id").alias("k"), K.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1)).alias("geom")), str(tmp_path / "x.gpkg"), "rows")
    with sqlite3.connect(tmp_path / "x.gpkg") as con:
        con.execute("UPDATE rows SET fid = 1000000000000 WHERE k = 9")
        con.execute("UPDATE rows SET fid = -7 WHERE k = 3")
    con.close()
    df = files.read_layer(geo, str(tmp_path / "x.gpkg"))
    assert df.rdd.getNumPartitions() == 1 and sorted(r["k"] for r in df.collect()) == list(range(10))
    source = files.GeoPackage({"path": str(tmp_path / "x.gpkg")})
    reader = files.GeoPackageReader(source, df.sparkSession.createDataFrame([], "k long, geom binary").schema)
    reader.STEP = 4
    parts = [p.value for p in reader.partitions()]
    assert len(parts) == 3 and sorted(r[0] for p in reader.partitions() for r in reader.read(p)) == list(range(10))


def test_feature_collection_is_written_side_by_side(spark, tmp_path, monkeypatch):
    """Tasks write their features at their places: the same bytes as by one task, and no task has all rows."""
    from pyspark.sql import functions as F

    from cadastra.kernel import functions as K
    from cadastra.sources import files

    K.register(spark)
    df = spark.range(0, 1000, 1, 1).select(F.col("id").alias("k"), F.concat(F.lit("ü\""), "id").alias("name"), F.when(F.col("id") % 9 != 0, K.box(F.col("id"), F.lit(0), F.col("id") + 1, F.lit(1))).alias("geom"))
    files.write_geojson(df, str(tmp_path / "one.geojson"), lonlat=False)
    parts, parted = [], files.parted
    monkeypatch.setattr(files, "parted", lambda *a: parts.append(parted(*a)) or parts[-1])
    monkeypatch.setattr(files, "SPREAD", 100)
    files.write_geojson(df, str(tmp_path / "many.geojson"), lonlat=False)
    assert len(parts[0]) == 11
    assert (tmp_path / "one.geojson").read_bytes() == (tmp_path / "many.geojson").read_bytes()
    assert [f["properties"]["k"] for f in json.loads((tmp_path / "many.geojson").read_text())["features"]] == list(range(1000))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["many.geojson", "one.geojson"]


def test_small_ranges_share_tasks(spark, tmp_path):
    """Tasks grow with the bytes, not with the ranges; features across ranges are whole, and no range reads far beyond its end."""
    path = tmp_path / "a.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"k": k, "long" if k % 50 == 7 else "name": "x" * (k % 50 * 40)}, "geometry": None} for k in range(500)]}))
    at = geojson.layout(spark, str(path), 1 << 10)
    assert len(at) > 400 and len(at.groups) == 1
    df = geojson.read(spark, at)
    assert df.rdd.getNumPartitions() == 1
    assert [(r["k"], len(r["long"] or r["name"] or "")) for r in df.orderBy("_row").collect()] == [(k, k % 50 * 40) for k in range(500)]
    read = []

    class Seen(geojson.Bytes):
        def range(self, a, b):
            read.append(b - a)
            return super().range(a, b)

    with Seen(str(path)) as file:
        place, text = next(f for k in range(len(at)) for f in at.features(k) if len(f[1]) > 1500)
        assert at._rest(file, text[:700], place) == text and max(read) < 1 << 14


def test_memory_of_a_range():
    """A whole range of nothing but short lists is looked at in less than 160 MB, so that workers side by side stay small."""
    import tracemalloc

    data = b"[1,2]," * (geojson.CHUNK // 6)
    tracemalloc.start()
    geojson.outside(data, False, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20
