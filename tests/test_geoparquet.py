"""Clustered GeoParquet: near rows side by side, clips that read little, footers that other readers understand."""

import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadastra.kernel import functions as K
from cadastra.sources import crs, files


@pytest.fixture(scope="module")
def geo(spark):
    K.register(spark)
    return spark


def test_hilbert_curve(geo):
    cells = geo.range(64).select((F.col("id") % 8 + 0.5).alias("x"), (F.floor(F.col("id") / 8) + 0.5).alias("y"))
    at = [(r["x"], r["y"]) for r in cells.withColumn("h", K.hilbert("x", "y", 0, 0, 8)).orderBy("h").collect()]
    assert len(set(at)) == 64 and all(abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1 for a, b in zip(at, at[1:]))
    assert geo.range(1).select(K.hilbert(F.lit(None).cast("double"), F.lit(1.0), 0, 0, 8), K.hilbert(F.lit(5.0), F.lit(5.0), 5, 5, 0)).first() == (None, 0)


def read_rows(df):
    df.collect()
    plan, todo = df._jdf.queryExecution().executedPlan(), []
    todo.append(plan)
    while todo:
        node = todo.pop()
        if "Scan parquet" in node.nodeName():
            return node.metrics().apply("numOutputRows").value()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        kids = node.children()
        todo += [kids.apply(k) for k in range(kids.size())]
    raise AssertionError("no scan")


def test_clips_read_little(geo, tmp_path, monkeypatch):
    n = 300
    df = geo.range(n * n).select(F.col("id").alias("k"), F.array(F.lit("a")).alias("flags"), K.box(F.col("id") % n * 100, F.floor(F.col("id") / n) * 100, F.col("id") % n * 100 + 50, F.floor(F.col("id") / n) * 100 + 50).alias("geom")).repartition(8)
    path = str(tmp_path / "x.parquet")
    for _ in range(2):
        files.write_parquet(df, path)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["x.parquet"]
    clip = (20000.0, 20000.0, 21000.0, 21000.0)
    got = files.read_layer(geo, path, clip=clip)
    assert read_rows(got) <= 2 * files.GROUP < n * n / 2  # of six row groups
    inside = got.where(K.intersects(F.col("geom"), F.lit(bytearray(K.box_wkb(*clip))))).count()
    assert inside == df.where(K.intersects(F.col("geom"), F.lit(bytearray(K.box_wkb(*clip))))).count() > 80
    assert files.read_layer(geo, path).agg(F.count("*"), F.sum("k")).first() == (n * n, n * n * (n * n - 1) // 2)
    for part in (tmp_path / "x.parquet").glob("*.parquet"):
        meta = pq.read_metadata(part).metadata
        column = json.loads(meta[b"geo"])["columns"]["geom"]
        assert column["encoding"] == "WKB" and column["bbox"] == [0, 0, 100 * n - 50, 100 * n - 50]
        assert crs.of_projjson({k: v for k, v in column["crs"].items() if k != "id"}) == crs.of_epsg(26985)


def test_empty_layers_and_missing_shapes(geo, tmp_path):
    df = geo.createDataFrame([(1, None), (2, K.box_wkb(0, 0, 1, 1))], "k int, geom binary")
    files.write_parquet(df, str(tmp_path / "a.parquet"))
    assert sorted(r["k"] for r in files.read_layer(geo, str(tmp_path / "a.parquet")).collect()) == [1, 2]
    files.write_parquet(df.where("k = 9"), str(tmp_path / "b.parquet"))
    assert files.read_layer(geo, str(tmp_path / "b.parquet")).columns[:2] == ["k", "geom"] and files.read_layer(geo, str(tmp_path / "b.parquet")).count() == 0
    files.write_parquet(df.where("k = 1"), str(tmp_path / "c.parquet"))
    assert files.read_layer(geo, str(tmp_path / "c.parquet")).count() == 1
