"""Units, rounding, compass sectors, strip metrics and rules on scalars, all as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metres in a foot and a yard, square metres in an acre.
FOOT_M, YARD_M, ACRE_M2 = 0.3048, 0.9144, 4046.8564224
SECTORS = ("E", "NE", "N", "NW", "W", "SW", "S", "SE")
FRONTAGE_CLASSES = ("open", "encumbered", "foreign_parcel", "same_owner_parcel", "gap")


def rounded(col: Column, digits: int = 0) -> Column:
    """Scaled, rounded half to even, and scaled back."""
    return F.rint(col * 10**digits) / 10**digits


def acres(m2: Column) -> Column:
    return m2 / ACRE_M2


def m2_of_acres(a: Column) -> Column:
    return a * ACRE_M2


def feet(m: Column) -> Column:
    return m / FOOT_M


def metres_of_feet(ft: Column) -> Column:
    return ft * FOOT_M


def yards(m: Column) -> Column:
    return m / YARD_M


def metres_of_yards(yd: Column) -> Column:
    return yd * YARD_M


def compass_sector(dx: Column, dy: Column) -> Column:
    turn = F.pmod(F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(360.0)) + 22.5, F.lit(360.0))
    return F.element_at(F.array(*map(F.lit, SECTORS)), F.floor(turn / 45).cast("int") + 1)


def offset_pct(dx: Column, dy: Column, area: Column) -> Column:
    """Distance of two centroids as a percentage of the radius of a circle of the parcel's area."""
    return 100.0 * F.hypot(dx, dy) / F.sqrt(F.greatest(area, F.lit(1e-9)) / math.pi)


def position(dx: Column, dy: Column, area: Column, center_pct: float = 25.0) -> Column:
    return F.when(offset_pct(dx, dy, area) < center_pct, "center").otherwise(compass_sector(dx, dy))


def described(position: Column, bisects: Column, pieces: Column, touches: Column) -> Column:
    return F.when(bisects, F.concat(position, F.lit("; BISECTS parcel into "), pieces.cast("string"), F.lit(" pieces"))).when(touches, F.concat(position, F.lit(" edge"))).otherwise(F.concat(position, F.lit(" interior")))


def strip_metrics(area: Column, perimeter: Column) -> Column:
    """Width 2A/P, length A/width, their ratio, and perimeter per acre; zeros for an empty shape."""
    width = 2 * area / perimeter
    ok = (area > 0) & (perimeter > 0)
    some = lambda c: F.when(ok, c).otherwise(0.0)
    return F.struct(some(rounded(feet(width), 1)).alias("est_width_ft"), some(rounded(feet(area / width), 1)).alias("est_length_ft"), some(rounded(area / width / width, 1)).alias("aspect"), some(rounded(feet(perimeter) / acres(area), 1)).alias("perimeter_area_ratio_ft"))


def is_strip(metrics: Column, max_width_ft: float = 100.0, min_aspect: float = 6.0) -> Column:
    return (metrics["est_width_ft"] > 0) & (metrics["est_width_ft"] <= max_width_ft) & (metrics["aspect"] >= min_aspect)


def frontage_class(outside: Column, constraint: Column) -> Column:
    """A foreign parcel outside comes first, then a constraint inside, then what lies outside."""
    return F.when(outside == "foreign_parcel", outside).when(constraint.isNotNull(), "encumbered").when(outside == "row", "open").when(outside == "same_owner_parcel", outside).otherwise("gap")


def flags_of(*pairs: tuple[Column, str | Column]) -> Column:
    """The names, in order and once each, whose condition holds."""
    named = [F.when(F.coalesce(c, F.lit(False)), F.lit(n) if isinstance(n, str) else n) for c, n in pairs]
    return F.array_distinct(F.filter(F.array(*named), lambda x: x.isNotNull())) if named else F.array().cast("array<string>")
