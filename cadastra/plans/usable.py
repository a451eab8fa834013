"""Stage 3, usable area: each parcel less its subtracted constraints and its steep ground."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions import measures as M
from ..kernel import functions as K
from ..operators.spatial import grid_join, subdivided


def steep_parts(parcels: DataFrame, steep: DataFrame, cell: float = 500.0) -> DataFrame:
    """(account_id, geom): the steep ground inside each parcel."""
    pairs = grid_join(subdivided(parcels.select("account_id", "geom", "box"), cell), subdivided(steep.select("geom"), cell), cell, overlay=True)
    cut = pairs.select("l.account_id", F.col("o.geom").alias("g"))
    return cut.groupBy("account_id").agg(K.union_agg("g").alias("geom")).where(K.area("geom") > 0)


def stage3(parcels: DataFrame, enc: DataFrame, hostile: DataFrame, cfg: Config, slope_evaluated: bool) -> DataFrame:
    """The parcels with ``usable`` and ``traversable`` shapes, and the acres of each."""
    subtracted = [c.name for c in cfg.constraints if c.subtract_from_usable]
    acres_of = lambda name: M.rounded(M.acres(F.sum(F.when(F.col("name") == name, K.area("geom")).otherwise(0.0))), 2)
    by = hostile.groupBy("account_id").agg(
        K.union_agg("geom").alias("_all"), K.union_agg(F.when(~F.col("crossable"), F.col("geom"))).alias("_never"),
        *[acres_of(n).alias(f"subtracted_{n}_acres") for n in subtracted], acres_of("steep_slope").alias("steep_slope_acres"),
    )
    favorable = enc.where("implication = 'favorable'").groupBy("account_id").agg(K.union_agg("part").alias("_fav"))
    out = parcels.join(by, "account_id", "left").join(favorable, "account_id", "left")
    less = lambda c: F.when(F.col(c).isNull(), F.col("geom")).otherwise(K.areal_difference("geom", c))
    out = out.withColumns({"usable": less("_all"), "traversable": less("_never")}).withColumn("_m2", K.area("usable"))
    out = out.withColumns({
        "usable_acres": M.rounded(M.acres(F.col("_m2")), 2), "usable_pct": M.rounded(100 * F.col("_m2") / F.col("geom_m2"), 1),
        "usable_components": K.part_count("usable", cfg.access.sliver_acres * M.ACRE_M2),
        "slope_evaluated": F.lit(slope_evaluated), "ag_easement_within_usable_acres": F.when(F.col("_fav").isNull(), 0.0).otherwise(M.rounded(M.acres(K.overlap_area("_fav", "usable")), 2)),
    })
    return out.drop("_all", "_never", "_fav", "_m2").fillna({f"subtracted_{n}_acres": 0.0 for n in subtracted} | {"steep_slope_acres": 0.0})
