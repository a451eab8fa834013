"""The union aggregate and shapes in pieces, against unions and joins of whole shapes."""

import random

import pytest
from pyspark.sql import functions as F

from cadastra.kernel import functions as K
from cadastra.operators.spatial import grid_join, subdivided, with_box
from cadastra.stage_queries import comb


@pytest.fixture(scope="module")
def geo(spark):
    K.register(spark)
    return spark


def boxes(geo, n=400, seed=1, span=900, size=60):
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(5), *(x := (rnd.randrange(span), rnd.randrange(span))), x[0] + rnd.randrange(1, size), x[1] + rnd.randrange(1, size)) for i in range(n)]
    return geo.createDataFrame(rows, "k int, g int, x0 int, y0 int, x1 int, y1 int").withColumn("geom", K.box("x0", "y0", "x1", "y1")).repartition(6)


def test_union_aggregate(geo):
    df = boxes(geo).withColumn("geom", F.when(F.col("k") % 11 > 0, F.col("geom")))
    got = df.groupBy("g").agg(K.union_agg("geom").alias("a"), K.union_agg(F.when(F.col("k") % 2 == 0, F.col("geom"))).alias("even"), K.dissolve_agg("geom").alias("d"), F.collect_list("geom").alias("all"), F.collect_list(F.when(F.col("k") % 2 == 0, F.col("geom"))).alias("two"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_geo_union" in plan and "ObjectHashAggregate" in plan
    for r in got.select(*[K.area(c) for c in ("a", "d", "even")], K.area(K.union_all("all")), K.area(K.union_all("two")), K.area(K.difference("a", K.union_all("all")))).collect():
        assert r[0] == pytest.approx(r[3]) and r[1] == pytest.approx(r[3]) and r[2] == pytest.approx(r[4]) and r[5] == pytest.approx(0, abs=1e-6)


def test_union_of_none_one_and_lines(geo):
    one = geo.createDataFrame([(1, K.box_wkb(0, 0, 2, 2)), (2, None), (3, K.line_wkb((0, 0), (5, 0))), (3, K.line_wkb((3, 0), (9, 0)))], "g int, geom binary")
    got = {r["g"]: r for r in one.groupBy("g").agg(K.union_agg("geom").alias("u"), K.dissolve_agg("geom").alias("d")).select("g", K.area("u").alias("m2"), K.length("u").alias("m"), K.is_empty("u").alias("e"), "d").collect()}
    assert got[1]["m2"] == 4 and bytes(got[1]["d"])[1:] and got[2]["e"] and got[2]["d"] is None and got[3]["m"] == 9 and got[3]["m2"] == 0
    assert one.where("g = 9").agg(K.union_agg("geom").alias("u"), K.dissolve_agg("geom").alias("d")).select(K.is_empty("u"), "d").first() == (True, None)


def test_union_of_shapes_that_cover_each_other(geo):
    """Shapes inside the union so far are left out of it: areas stay, touching borders and lines among them too, and covered ones leave no points."""
    df = boxes(geo, 3000, 4, 200)
    got = df.groupBy("g").agg(K.union_agg("geom").alias("u"), K.dissolve_agg("geom").alias("d"), K.union_all(F.collect_list("geom")).alias("all"))
    for r in got.select(K.area("u"), K.area("d"), K.area("all"), K.area(K.difference("all", "u"))).collect():
        assert r[0] == pytest.approx(r[2]) and r[1] == pytest.approx(r[2]) and r[3] == pytest.approx(0, abs=1e-6)
    wide = [(K.box_wkb(0, 0, 1000, 1000),)] * 70
    inner = [(K.box_wkb(10 * k, 0, 10 * k + 5, 20),) for k in range(100)]
    one = lambda rows: geo.createDataFrame(rows, "geom binary").coalesce(1).agg(K.union_agg("geom").alias("u")).select(K.area("u").alias("m2"), K.length("u").alias("m"), F.octet_length("u").alias("bytes")).first()
    assert one(wide + inner) == (1e6, 4000.0, 93)
    assert one(wide + inner + [(K.line_wkb((500, 500), (1500, 500)),)])[:2] == (1e6, 4500.0)


def test_rectangles_share_their_boxes(geo):
    """As shapes of one more point on their border do, which go the general way."""
    at = [(x, y, x + w, y + h) for x, y in ((0, 0), (10, 0), (10, 10), (3, 4), (30, 30), (0, -5)) for w, h in ((10, 10), (4, 3))]
    df = geo.createDataFrame([(i, *map(float, b)) for i, b in enumerate(at)], "k int, x0 double, y0 double, x1 double, y1 double")
    more = K.ring(F.array("x0", "y0", (F.col("x0") + F.col("x1")) / 2, "y0", "x1", "y0", "x1", "y1", "x0", "y1"))
    df = df.select("k", K.box("x0", "y0", "x1", "y1").alias("a"), more.alias("b"))
    o = lambda c: K.overlap(F.col(f"l.{c}"), F.col(f"r.{c}"))
    rows = df.alias("l").crossJoin(df.alias("r")).select(o("a").alias("a"), o("b").alias("b"))
    got = rows.select(F.col("a").isNull(), F.col("b").isNull(), "a.m2", "b.m2", K.is_empty("a.geom"), K.is_empty("b.geom"), K.area(K.difference("b.geom", "a.geom"))).collect()
    assert len(got) == 144 and len({r[0] for r in got}) == 2 and 0.0 in {r[2] for r in got}
    for r in got:
        assert r[0] == r[1] and r[2] == r[3] and r[4] == r[5] and r[6] in (None, 0.0)


def test_pieces_add_up(geo):
    giant = geo.createDataFrame([(7, bytearray(comb(2800, 900)))], "f int, geom binary")
    whole, cut = with_box(giant), subdivided(giant, 100.0, 40)
    rows = cut.select("f", "box", F.octet_length("geom").alias("bytes"), K.area("geom").alias("m2")).collect()
    assert len(rows) > 100 and all(r["bytes"] <= 9 + 4 + 16 * 40 + 300 and r["box"]["maxx"] - r["box"]["minx"] <= 200 and r["box"]["maxy"] - r["box"]["miny"] <= 200 for r in rows)
    assert sum(r["m2"] for r in rows) == pytest.approx(whole.first()["box"]["area"]) and {r["f"] for r in rows} == {7}
    p = with_box(boxes(geo, 150, 2, 700).select("k", "geom"))
    join = lambda right: grid_join(p, right, 100.0, overlay=True).groupBy("l.k").agg(K.area(K.union_agg("o.geom")).alias("m2")).where("m2 > 0").orderBy("k").collect()
    for a, b in zip(join(whole), join(cut), strict=True):
        assert a["k"] == b["k"] and a["m2"] == pytest.approx(b["m2"])


def test_small_shapes_stay(geo):
    df = boxes(geo, 30)
    assert "geo_subdivide" in subdivided(df, 100.0)._jdf.queryExecution().executedPlan().toString()
    got = subdivided(df.withColumn("was", F.col("geom")), 100.0)
    assert got.where("geom = was").count() == 30
    points = geo.createDataFrame([(1, None), (2, bytearray.fromhex("0101000000000000000000f03f000000000000f03f"))], "k int, geom binary")
    assert [r["k"] for r in subdivided(points, 10.0).collect()] == [2]
    road = subdivided(geo.createDataFrame([(1, bytearray(K.line_wkb((0, 5), (1000, 5), (1000, 400))))], "k int, geom binary"), 50.0)
    assert road.agg(F.sum(K.length("geom"))).first()[0] == pytest.approx(1395) and road.count() >= 14


def test_giant_shapes_are_cut_by_many_tasks(geo):
    """In two steps, the first's pieces dealt to tasks: no ground is lost or counted twice, and pieces have few points and short sides."""
    giant = with_box(geo.createDataFrame([(7, bytearray(comb(2800, 60000)))], "f int, geom binary"))
    cut = subdivided(giant, 100.0, 40, deal=True).select("f", "box", F.octet_length("geom").alias("bytes"), F.spark_partition_id().alias("task")).collect()
    assert len(cut) > 4000 and len({r["task"] for r in cut}) > 1 and {r["f"] for r in cut} == {7}
    assert all(r["bytes"] <= 9 + 4 + 16 * 40 + 300 and r["box"]["maxx"] - r["box"]["minx"] <= 200 and r["box"]["maxy"] - r["box"]["miny"] <= 200 for r in cut)
    assert sum(r["box"]["area"] for r in cut) == pytest.approx(giant.first()["box"]["area"])
