"""Steep ground made once for a grid, against single cells and plain searches."""

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.kernel import functions as K
from cadastra.operators import raster
from cadastra.operators.slope import Grid, steep_boxes, slope_percent, window_steep
from cadastra.operators.spatial import with_box


@pytest.fixture(scope="module")
def geo(spark):
    K.register(spark)
    return spark


def flooded(mask):
    """Components of a mask by a plain search, each a set of cells."""
    left, out = {(int(r), int(c)) for r, c in zip(*np.nonzero(mask), strict=True)}, []
    while left:
        todo = [left.pop()]
        one = set(todo)
        while todo:
            r, c = todo.pop()
            for n in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
                if n in left:
                    left.remove(n)
                    one.add(n)
                    todo.append(n)
        out.append(one)
    return sorted(out, key=min)


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 0.6, 0.8, 1.0])
def test_labels_and_rings(share):
    rnd = np.random.default_rng(int(share * 10))
    for _ in range(20):
        mask = rnd.random((rnd.integers(1, 14), rnd.integers(1, 14))) < share
        labels, firsts = raster.labelled(mask)
        want = flooded(mask)
        assert [divmod(int(f), mask.shape[1]) for f in firsts] == [min(one) for one in want]
        for n, one in enumerate(want):
            assert {(int(r), int(c)) for r, c in zip(*np.nonzero(labels == n), strict=True)} == one
        area, outer = [0.0] * len(want), [0] * len(want)
        for name, path in raster.rings(labels):
            turn = sum(a[1] * b[0] - b[1] * a[0] for a, b in zip(path, path[1:] + path[:1], strict=True)) / 2
            area[name] += turn
            outer[name] += turn > 0
            assert len(set(path)) == len(path)  # no ring meets itself
        assert area == [len(one) for one in want] and outer == [1] * len(want)


def ground(geo, height, width, seed, nulls=0.03):
    rnd = random.Random(seed)
    rows = [(r, c, None if rnd.random() < nulls else float(rnd.choice([0, 0, 0, 4, 9]))) for r in range(height) for c in range(width)]
    return geo.createDataFrame(rows, "row int, col int, z double").repartition(5), rows


def steep_mask(rows, height, width, d, most):
    z = {(r, c): v for r, c, v in rows if v is not None}
    mask = np.zeros((height, width), bool)
    for (r, c), v in z.items():
        def change(a, b):
            if a is None or b is None:
                return 0.0 if a is None and b is None else (b - v) / d if a is None else (v - a) / d
            return (b - a) / (2 * d)
        mask[r, c] = 100 * np.hypot(change(z.get((r, c - 1)), z.get((r, c + 1))), change(z.get((r - 1, c)), z.get((r + 1, c)))) > most
    return mask


@pytest.mark.parametrize("side", [3, 7, 64])
def test_parts_equal_a_plain_search_whatever_the_tiles(geo, side):
    cells, rows = ground(geo, 23, 31, 5)
    want = flooded(steep_mask(rows, 23, 31, 10.0, 30.0))
    got = raster.whole(raster.steep_pieces(cells, Grid(100.0, 500.0, 10.0, 10.0), 30.0, side=side))
    got = {r["part"]: r for r in got.select("part", "cells", K.area("geom").alias("m2"), K.length(K.boundary("geom")).alias("m"), (K.area(K.areal_difference(K.make_valid("geom"), "geom"))).alias("off")).collect()}
    assert len(want) > 10 and set(got) == {(min(one)[0] << 32) + min(one)[1] for one in want}
    for one in want:
        r = got[(min(one)[0] << 32) + min(one)[1]]
        rim = sum(n not in one for a, b in one for n in ((a - 1, b), (a + 1, b), (a, b - 1), (a, b + 1)))
        assert r["cells"] == len(one) and r["m2"] == pytest.approx(100 * len(one)) and r["m"] == pytest.approx(10 * rim) and r["off"] == pytest.approx(0)


def test_same_ground_as_runs_of_cells(geo):
    cells, _ = ground(geo, 40, 40, 8, nulls=0)
    grid = Grid(0.0, 400.0, 10.0, 10.0)
    a = raster.steep_pieces(cells, grid, 30.0, side=16).agg(K.union_agg("geom").alias("a"))
    b = steep_boxes(slope_percent(cells, grid), grid, 30.0).agg(K.union_agg("geom").alias("b"))
    m2, less, more = a.crossJoin(b).select(K.area("a"), K.area(K.areal_difference("a", "b")), K.area(K.areal_difference("b", "a"))).first()
    assert m2 > 10000 and less == pytest.approx(0, abs=1e-6) and more == pytest.approx(0, abs=1e-6)


def test_no_cells_and_flat_ground(geo):
    grid = Grid(0.0, 100.0, 10.0, 10.0)
    none = geo.createDataFrame([], "row int, col int, z double")
    flat = geo.createDataFrame([(r, c, 5.0 if r else None) for r in range(4) for c in range(4)], "row int, col int, z double")
    for cells in (none, flat):
        assert raster.whole(raster.steep_pieces(cells, grid, 1.0)).count() == 0


def test_components_of_chains_stars_and_rings(geo):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 300)] + [(400, i) for i in range(401, 600)] + [(700 + i, 700 + (i + 1) % 50) for i in range(50)] + [(900, 900)] + [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(150)]
    least = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    got = {r["node"]: r["least"] for r in raster.components(geo.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {n: m for n, m in least.items() if n != m}
    assert raster.components(geo.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("d", [10.0, 25.0, 45.0])
def test_parcels_as_by_their_windows(geo, d):
    """Cells small and large against the margin, some without elevation, parcels over the grid's edges."""
    cells, _ = ground(geo, 40, 50, 11, nulls=0.002)
    grid = Grid(0.0, 40 * d, d, d)
    rnd = random.Random(7)
    rows = [(f"A{i}", *(xy := (rnd.uniform(-3 * d, 49 * d), rnd.uniform(-3 * d, 39 * d))), xy[0] + rnd.uniform(d, 9 * d), xy[1] + rnd.uniform(d, 9 * d)) for i in range(60)]
    p = with_box(geo.createDataFrame(rows, "account_id string, x0 double, y0 double, x1 double, y1 double").withColumn("geom", K.box("x0", "y0", "x1", "y1"))).select("account_id", "geom", "box")
    most = 250.0 / d
    a, b = raster.steep_in_parcels(p, cells, grid, most), window_steep(p, cells, grid, most).withColumnRenamed("geom", "w")
    got = a.join(b, "account_id", "full").select("account_id", K.area("geom"), K.area("w"), K.area(K.areal_difference("geom", "w")), K.area(K.areal_difference("w", "geom"))).collect()
    assert len(got) > 30
    for r in got:
        assert r[1] == pytest.approx(r[2]) and r[3] == pytest.approx(0, abs=1e-6) and r[4] == pytest.approx(0, abs=1e-6), r


def test_layer_of_steep_ground_instead_of_the_grid(geo, tmp_path):
    """The command's layer and the elevation give the synthetic county the same usable ground."""
    from cadastra import cli
    from cadastra.plans import record
    from cadastra.sources import files, fixture

    at = fixture.write(geo, str(tmp_path))
    assert cli.main(["steep-polygons", "--config", at]) == 2
    assert cli.main(["steep-polygons", "--config", at, "--out", str(tmp_path / "steep.parquet")]) == 0
    layer = files.read_layer(geo, str(tmp_path / "steep.parquet"))
    given, cfg = fixture.inputs(geo), fixture.config()
    acres = lambda i: {r["account_id"]: (r["steep_slope_acres"], r["usable_acres"]) for r in record.run(i, cfg, (1, 2, 3))["scored"].collect()}
    by_layer, by_grid = acres(replace(given, dem=None, steep=layer)), acres(given)
    assert by_layer == by_grid and any(steep > 1 for steep, _ in by_grid.values())


def test_geotiff_is_written_by_strips(spark, tmp_path, monkeypatch):
    """No task has the whole grid: parts of strips, as one writer makes them, with cells that are missing."""
    import numpy as np
    from pyspark.sql import functions as F

    from cadastra.sources import files, tiff

    h, w = 20_000, 130
    cells = spark.range(0, h * w, 1, 3).select(F.expr(f"id div {w}").alias("row"), (F.col("id") % w).alias("col"), F.when(F.col("id") % 37 != 5, F.col("id") % 1000 / 8).alias("z")).where("row NOT BETWEEN 100 AND 300 AND id % 11 != 3")
    parts, parted = [], files.parted
    monkeypatch.setattr(files, "parted", lambda *a: parts.append(parted(*a)) or parts[-1])
    files.write_geotiff(cells, str(tmp_path / "a.tif"), (h, w), (0.0, 9000.0, 50.0, 50.0), 26985, -9999.0)
    k = np.arange(h * w).reshape(h, w)
    z = np.where((k % 37 == 5) | (k % 11 == 3) | (k // w >= 100) & (k // w <= 300), -9999, k % 1000 / 8)
    tiff.write_tiff(str(tmp_path / "b.tif"), z, (0.0, 9000.0, 50.0, 50.0), 26985, -9999.0)
    assert len(parts[0]) == 3
    assert (tmp_path / "a.tif").read_bytes() == (tmp_path / "b.tif").read_bytes()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.tif", "b.tif"]
