"""Spatial joins as equi-joins on grid cells.

Every shape is listed under the cells that its box touches; shapes meet in a cell, the pair is kept only in the cell of
the lower left corner of their boxes' overlap, so it comes once, and an exact test follows. Shapes are joined in pieces
(``subdivided``), so that rows are small and a giant shape spreads; a dense cell is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..kernel import functions as K


def with_box(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Adds ``box`` (bounds, area, length, centroid); rows without a shape go."""
    return df.withColumn("box", K.shape(geom)).where(F.col("box").isNotNull())


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """The rows in as many tasks as shuffles have, however few their bytes: for work that adaptive execution would put into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


POINTS = 256
#: Points and sides of the pieces that ``subdivided`` deals to tasks, as multiples of those of its last ones.
COARSE = 64


def _pieces(df: DataFrame, side: float, points: int) -> DataFrame:
    b = F.col("box")
    small = (F.octet_length("geom") <= 16 * points + 9) & (b["maxx"] - b["minx"] <= side) & (b["maxy"] - b["miny"] <= side)
    out = df.withColumn("__small", small).withColumn("geom", F.explode(F.when(F.col("__small"), F.array("geom")).otherwise(K.subdivide("geom", points, side))))
    return out.withColumn("box", F.when(F.col("__small"), b).otherwise(K.shape("geom"))).drop("__small").where(F.col("box").isNotNull())


def subdivided(df: DataFrame, size: float, points: int = POINTS, deal: bool = False) -> DataFrame:
    """The rows with their shapes in pieces of at most ``points`` points and two cells' sides, each with its own ``box``.

    A giant shape then is many small rows that spread over cells and tasks, and no shape beyond the limit crosses a
    shuffle. Pieces share borders only: areas of overlaps add up, and unions put them together again. Shapes within the
    limits, told by their bytes and box, aren't touched. With ``deal`` they are made in two steps, and the pieces of
    the first go to other tasks: one shape of millions of pieces is more work than a task should have.
    """
    df = df if "box" in df.columns else with_box(df)
    if deal:
        df = _pieces(df, 2 * size * COARSE, points * COARSE)
        df = dealt(df, *df.columns)
    return _pieces(df, 2 * size, points)


def _cells(df: DataFrame, side: str, size: float, grow: float) -> DataFrame:
    span = lambda lo, hi: F.explode(F.sequence(F.floor((F.col(f"box.{lo}") - grow) / size), F.floor((F.col(f"box.{hi}") + grow) / size)))
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(side), span("minx", "maxx").alias("cell_x"), "box").select(side, "cell_x", span("miny", "maxy").alias("cell_y"))


def boxes_meet(a: Column, b: Column, grow: float = 0.0) -> Column:
    return (a["minx"] - grow <= b["maxx"]) & (a["maxx"] + grow >= b["minx"]) & (a["miny"] - grow <= b["maxy"]) & (a["maxy"] + grow >= b["miny"])


def grid_join(left: DataFrame, right: DataFrame, size: float = 1000.0, within: float = 0.0, on: list[str] | None = None, overlay: bool = False, spread: bool = False) -> DataFrame:
    """(l, r) pairs of rows, as structs, whose shapes intersect, or lie within a distance; ``on`` names columns that must be equal.

    With ``overlay`` a pair also has ``o``, the areal part that the shapes share and its area, made once for each pair. The exact
    test stands behind the cheap ones: Catalyst merges filters, and would run it on every copy of a pair. ``spread`` deals cells to
    tasks even where a side is small enough for a broadcast: a table of few row groups is few tasks otherwise, which each meet all cells.
    """
    a, b = _cells(left, "l", size, within), _cells(right, "r", size, 0.0)
    keys = [F.col("a.cell_x") == F.col("b.cell_x"), F.col("a.cell_y") == F.col("b.cell_y"), *[F.col(f"a.l.{c}") == F.col(f"b.r.{c}") for c in on or []]]
    pairs = (a.hint("merge") if spread else a).alias("a").join(b.alias("b"), keys)
    la, rb = F.col("a.l.box"), F.col("b.r.box")
    home = lambda lo: F.floor(F.greatest(la[lo] - within, rb[lo]) / size)
    cheap = (F.col("a.cell_x") == home("minx")) & (F.col("a.cell_y") == home("miny")) & boxes_meet(la, rb, within)
    if overlay:
        # what a generator gives is computed once, however often later steps refer to it
        return pairs.where(cheap).select("l", "r", F.explode(F.array(K.overlap(F.col("l.geom"), F.col("r.geom")))).alias("o")).where(F.col("o").isNotNull())
    exact = K.distance(F.col("a.l.geom"), F.col("b.r.geom")) <= within if within else K.intersects(F.col("a.l.geom"), F.col("b.r.geom"))
    return pairs.where(F.when(cheap, exact).otherwise(False)).select("l", "r")
