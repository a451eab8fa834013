"""Slope and steep ground from elevation cells (row, col, z) of a north-up grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..kernel import functions as K
from ..sources.crs import of_epsg


@dataclass(frozen=True)
class Grid:
    """The left and top edges, and the cell's width and height, in the units of the grid's coordinate system: its numbers, or none for the working plane."""

    x0: float
    y1: float
    dx: float
    dy: float
    numbers: tuple[float, ...] | None = None

    @property
    def unit(self) -> float:
        """Metres in a unit."""
        return self.numbers[-1] if self.numbers else 1.0

    def here(self, geom: str) -> Column:
        """A shape of the working plane in the grid's system."""
        return K.between_systems(geom, of_epsg(K.PLANE).numbers(), list(self.numbers)) if self.numbers else F.col(geom)

    def back(self, geom: str) -> Column:
        return K.between_systems(geom, list(self.numbers), of_epsg(K.PLANE).numbers()) if self.numbers else F.col(geom)


def _gradient(z: str, along: str, across: str, step: float) -> Column:
    """Central differences, one-sided at the ends of a run of cells."""
    w = Window.partitionBy(across).orderBy(along)
    before, after = F.lag(z).over(w), F.lead(z).over(w)
    return F.when(before.isNull(), (after - F.col(z)) / step).when(after.isNull(), (F.col(z) - before) / step).otherwise((after - before) / (2 * step))


def slope_percent(cells: DataFrame, grid: Grid, vertical_factor: float = 1.0) -> DataFrame:
    """Adds ``slope``; cells without elevation take the mean for their neighbours' sake and get none themselves."""
    mean = cells.agg(F.avg("z").alias("mean_z"))
    z = cells.crossJoin(F.broadcast(mean)).withColumn("zf", F.coalesce("z", "mean_z") * vertical_factor)  # one row, an aggregate
    out = z.withColumns({"gx": _gradient("zf", "col", "row", grid.dx * grid.unit), "gy": _gradient("zf", "row", "col", grid.dy * grid.unit)})
    return out.select(*cells.columns, F.when(F.col("z").isNotNull(), 100.0 * F.hypot("gx", "gy")).alias("slope"))


def resampled(cells: DataFrame, factor: int) -> DataFrame:
    """Means over blocks of ``factor`` by ``factor`` cells."""
    return cells.groupBy(F.expr(f"row div {factor}").cast("int").alias("row"), F.expr(f"col div {factor}").cast("int").alias("col")).agg(F.avg("z").alias("z"))


def steep_boxes(sloped: DataFrame, grid: Grid, most: float) -> DataFrame:
    """Rectangles (geom) of runs of neighbouring steep cells in a row: few shapes, the same union as all cells."""
    steep = sloped.where(F.col("slope") > most)
    run = F.col("col") - F.row_number().over(Window.partitionBy("row").orderBy("col"))
    runs = steep.withColumn("run", run).groupBy("row", "run").agg(F.min("col").alias("c0"), F.max("col").alias("c1"))
    x0, x1 = F.col("c0") * grid.dx + grid.x0, (F.col("c1") + 1) * grid.dx + grid.x0
    y1 = grid.y1 - F.col("row") * grid.dy
    return runs.select(box_column(x0, y1 - grid.dy, x1, y1).alias("geom"))


TILE = 64


def windows(parcels: DataFrame, cells: DataFrame, grid: Grid, margin: float) -> DataFrame:
    """(account_id, geom, r0, c0, r1, c1, r_max, c_max): each parcel's window of cells, its bounds and a margin in metres, cut to the grid; none of two cells or fewer across."""
    margin = margin / grid.unit
    extent = F.broadcast(cells.agg(F.max("row").alias("r_max"), F.max("col").alias("c_max")))  # one row
    low = lambda at, origin, step: F.floor((at - origin) / step)
    w = parcels.select("account_id", "geom", "box") if grid.numbers is None else parcels.select("account_id", "geom").withColumn("box", K.shape(grid.here("geom")))
    w = w.crossJoin(extent)
    span_c, span_r = (F.col("box.maxx") - F.col("box.minx") + 2 * margin) / grid.dx, (F.col("box.maxy") - F.col("box.miny") + 2 * margin) / grid.dy
    w = w.withColumns({"c0": low(F.col("box.minx") - margin, grid.x0, grid.dx), "r0": F.floor((grid.y1 - F.col("box.maxy") - margin) / grid.dy)})
    w = w.withColumns({"c1": F.least(F.col("c0") + F.ceil(span_c) - 1, "c_max"), "r1": F.least(F.col("r0") + F.ceil(span_r) - 1, "r_max"), "c0": F.greatest("c0", F.lit(0)), "r0": F.greatest("r0", F.lit(0))})
    return w.where((F.col("c1") - F.col("c0") >= 2) & (F.col("r1") - F.col("r0") >= 2)).select("account_id", "geom", *[F.col(c).cast("int").alias(c) for c in ("r0", "c0", "r1", "c1")], "r_max", "c_max")


def window_steep(parcels: DataFrame, cells: DataFrame, grid: Grid, most: float, vertical_factor: float = 1.0, resample_m: float | None = None, margin: float = 30.0) -> DataFrame:
    """(account_id, geom): the ground inside each parcel that is steeper than ``most`` percent.

    Each parcel has its own window of cells, its bounds and a margin, cut to the grid; cells without elevation take the
    window's mean for their neighbours' sake, and differences are one-sided at the window's edges. Windows of two cells or
    fewer across have no answer. With ``resample_m`` a window is averaged into cells of about that size first, cells on a
    border by the part that lies on each side. A grid of another system has its windows there, slopes in metres, and the
    steep ground comes back to the working plane. Cells meet windows by tiles of ``TILE`` by ``TILE`` cells.
    """
    w = windows(parcels, cells, grid, margin)
    tiles = lambda a, b: F.explode(F.sequence(F.expr(f"{a} div {TILE}"), F.expr(f"{b} div {TILE}")))
    spread = w.select("account_id", "r0", "c0", "r1", "c1", tiles("r0", "r1").alias("tr")).select("*", tiles("c0", "c1").alias("tc"))
    z = cells.select("row", "col", "z", F.expr(f"row div {TILE}").alias("tr"), F.expr(f"col div {TILE}").alias("tc"))
    own = spread.join(z, ["tr", "tc"]).where(F.col("row").between(F.col("r0"), F.col("r1")) & F.col("col").between(F.col("c0"), F.col("c1")))
    height, width = F.col("r1") - F.col("r0") + 1, F.col("c1") - F.col("c0") + 1
    if resample_m:
        down, across = F.greatest(F.lit(3), F.rint(height * grid.dy * grid.unit / resample_m)).cast("int"), F.greatest(F.lit(3), F.rint(width * grid.dx * grid.unit / resample_m)).cast("int")
        own = own.select("account_id", "r0", "c0", (F.col("row") - F.col("r0")).alias("i"), (F.col("col") - F.col("c0")).alias("j"), "z", height.alias("h"), width.alias("w"), down.alias("down"), across.alias("across"))
        # a cell lies in one new cell, or across the borders of several, by its share of each
        whole = lambda i, n, size: F.sequence(F.expr(f"cast({i} * {n} div {size} AS int)"), F.expr(f"cast((({i} + 1) * {n} - 1) div {size} AS int)"))
        part = lambda i, n, size, to: F.least((F.col(i) + 1) * F.col(n) / F.col(size), F.col(to) + 1) - F.greatest(F.col(i) * F.col(n) / F.col(size), F.col(to))
        own = own.withColumn("row", F.explode(whole("i", "down", "h"))).withColumn("col", F.explode(whole("j", "across", "w")))
        share = F.when(F.col("z").isNotNull(), part("i", "down", "h", "row") * part("j", "across", "w", "col"))
        own = own.groupBy("account_id", "r0", "c0", (F.col("h") / F.col("down")).alias("dy"), (F.col("w") / F.col("across")).alias("dx"), "row", "col").agg((F.sum(F.col("z") * share) / F.sum(share)).alias("z"))
    else:
        own = own.select("account_id", "r0", "c0", F.lit(1.0).alias("dy"), F.lit(1.0).alias("dx"), (F.col("row") - F.col("r0")).alias("row"), (F.col("col") - F.col("c0")).alias("col"), "z")
    mean = own.groupBy("account_id").agg(F.avg("z").alias("mean_z")).where("mean_z IS NOT NULL")
    own = own.join(mean, "account_id").withColumn("zf", F.coalesce("z", "mean_z") * vertical_factor)

    def change(along: str, across: str, step: Column) -> Column:
        run = Window.partitionBy("account_id", across).orderBy(along)
        before, after = F.lag("zf").over(run), F.lead("zf").over(run)
        return F.when(before.isNull(), (after - F.col("zf")) / step).when(after.isNull(), (F.col("zf") - before) / step).otherwise((after - before) / (2 * step))

    sloped = own.withColumns({"gx": change("col", "row", F.col("dx") * grid.dx * grid.unit), "gy": change("row", "col", F.col("dy") * grid.dy * grid.unit)})
    steep = sloped.where(F.col("z").isNotNull() & (100.0 * F.hypot("gx", "gy") > most))
    run = F.col("col") - F.row_number().over(Window.partitionBy("account_id", "row").orderBy("col"))
    runs = steep.withColumn("run", run).groupBy("account_id", "r0", "c0", "dy", "dx", "row", "run").agg(F.min("col").alias("a"), F.max("col").alias("b"))
    x = lambda at: (F.col("c0") + at * F.col("dx")) * grid.dx + grid.x0
    y = lambda at: grid.y1 - (F.col("r0") + at * F.col("dy")) * grid.dy
    ground = runs.select("account_id", box_column(x(F.col("a")), y(F.col("row") + 1), x(F.col("b") + 1), y(F.col("row"))).alias("g")).groupBy("account_id").agg(K.union_agg("g").alias("g")).withColumn("g", grid.back("g"))
    return ground.join(w.select("account_id", F.col("geom").alias("parcel")), "account_id").select("account_id", K.areal_intersection("parcel", "g").alias("geom")).where(K.area("geom") > 0)


def box_column(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A rectangle as WKB from four columns."""
    return K.box(x0, y0, x1, y1)
