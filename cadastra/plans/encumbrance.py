"""Stage 2, encumbrances: what each constraint layer takes of each parcel, where it lies, and roll-ups that count no ground twice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions import measures as M
from ..kernel import functions as K
from ..operators.spatial import grid_join, subdivided, with_box
from .base import areal_only

LEAST_M2 = 10.0
JSON_KEYS = ("type", "source_layer", "acres", "pct_of_parcel", "position", "centroid_offset_pct", "touches_boundary", "fragments_if_removed", "largest_fragment_pct")


def clipped(layer: DataFrame, study: bytes) -> DataFrame:
    """The layer's areas inside the study area."""
    out = areal_only(layer).where(K.intersects(F.col("geom"), F.lit(bytearray(study))))
    return out.withColumn("geom", K.areal_intersection(F.col("geom"), F.lit(bytearray(study)))).where(~K.is_empty("geom"))


def line_buffers(lines: DataFrame, metres: float, study: bytes) -> DataFrame:
    """Flat-ended buffers of the lines' parts inside the study area; the buffers themselves may reach beyond it."""
    area = F.lit(bytearray(study))
    inside = lines.where(F.col("geom").isNotNull()).withColumn("geom", K.make_valid("geom")).where(K.intersects(F.col("geom"), area))
    cut = inside.withColumn("geom", K.lineal(K.intersection(F.col("geom"), area))).where(~K.is_empty("geom"))
    return areal_only(cut.withColumn("geom", K.buffer("geom", metres, flat=True)))


def all_layers(layers: dict[str, DataFrame], cfg: Config, study: bytes, spark: SparkSession) -> DataFrame:
    """One table of every constraint's features: (source_layer, ord, name, geom, box)."""
    tables = []
    for k, c in enumerate(cfg.constraints):
        if c.name in layers:
            df = line_buffers(layers[c.name], c.lines.get("buffer_ft", 100) * M.FOOT_M, study) if c.lines else clipped(layers[c.name], study)
            name = F.col(c.name_field).cast("string") if c.name_field and c.name_field in df.columns else F.lit(None).cast("string")
            # a feature's own number: its place in the source, or one made up, which only has to hold within a run of the plan
            feature = F.col("_row") if "_row" in df.columns else F.monotonically_increasing_id()
            tables.append(df.select(F.lit(c.name).alias("source_layer"), F.lit(k).alias("ord"), name.alias("name"), feature.alias("feature"), "geom"))
    if not tables:
        return with_box(spark.createDataFrame([], "source_layer string, ord int, name string, feature long, geom binary"))
    return with_box(reduce(DataFrame.unionByName, tables))


def specs(cfg: Config, spark: SparkSession) -> DataFrame:
    kinds = "source_layer string, type string, category string, implication string, subtract_from_usable boolean, crossable_with_permit boolean, manual_flag string"
    return spark.createDataFrame([(c.name, c.type, c.category, c.implication, c.subtract_from_usable, c.crossable_with_permit, c.manual_flag) for c in cfg.constraints], kinds)


def encumbrances(parcels: DataFrame, features: DataFrame, cfg: Config, cell: float = 1000.0) -> DataFrame:
    """One row per (parcel, layer) with ten square metres or more: shares, position, names and the geometry taken."""
    spark = parcels.sparkSession
    features = features if "feature" in features.columns else features.withColumn("feature", F.monotonically_increasing_id())
    pairs = grid_join(subdivided(parcels.select("account_id", "geom", "box"), cell), subdivided(features, cell, deal=True), cell, overlay=True, spread=True)
    # a giant feature's pieces, and their parcels, are the work of many tasks; features are cut to their parcel first: unions stay small, whatever the size of a feature
    cut = pairs.select("l.account_id", "r.source_layer", "r.ord", "r.name", "r.feature", F.col("o.geom").alias("g"))
    taken = cut.groupBy("account_id", "source_layer", "ord").agg(K.union_agg("g").alias("part"), F.size(F.collect_set("feature")).cast("long").alias("feature_count"), F.array_join(F.sort_array(F.collect_set("name")), "; ").alias("names"), F.count("name").alias("named"))
    rows = taken.join(parcels.select("account_id", F.col("geom").alias("parcel"), F.col("box.area").alias("parcel_m2")), "account_id").withColumn("part", K.areal("part")).withColumn("m2", K.area("part")).where(F.col("m2") >= LEAST_M2)
    rows = rows.withColumn("p", K.relative_position("parcel", "part", cfg.access.sliver_acres * M.ACRE_M2)).join(F.broadcast(specs(cfg, spark)), "source_layer")
    where = M.position(F.col("p.dx"), F.col("p.dy"), F.col("parcel_m2"))
    return rows.select(
        "account_id", "source_layer", "ord", "type", "category", "implication", "subtract_from_usable", "crossable_with_permit", "manual_flag",
        M.rounded(M.acres(F.col("m2")), 2).alias("acres"), M.rounded(100 * F.col("m2") / F.col("parcel_m2"), 1).alias("pct_of_parcel"), where.alias("position"),
        M.rounded(M.offset_pct(F.col("p.dx"), F.col("p.dy"), F.col("parcel_m2")), 1).alias("centroid_offset_pct"), F.col("p.touches").alias("touches_boundary"),
        M.rounded(M.feet(F.col("p.contact")), 1).alias("boundary_contact_ft"), F.col("p.pieces").alias("fragments_if_removed"), (F.col("p.pieces") >= 2).alias("bisects"),
        M.rounded(100 * F.col("p.largest") / F.col("parcel_m2"), 1).alias("largest_fragment_pct"), M.rounded(M.acres(F.col("p.largest")), 2).alias("largest_fragment_acres"),
        M.described(where, F.col("p.pieces") >= 2, F.col("p.pieces"), F.col("p.touches")).alias("description"),
        F.when(F.col("named") > 0, F.col("names")).alias("feature_names"), "feature_count", "part",
    )


def rolled_up(parcels: DataFrame, enc: DataFrame, cfg: Config) -> DataFrame:
    """The parcels with their acres by type and by implication, what bisects them, JSON and flags."""
    types = sorted({c.type for c in cfg.constraints})
    union = lambda cond: M.rounded(M.acres(K.area(K.union_agg(F.when(cond, F.col("part"))))), 2)
    legal = F.col("category") == "legal"
    record = F.struct("ord", *JSON_KEYS)
    bisecting = F.col("bisects") & F.col("subtract_from_usable")
    by = enc.groupBy("account_id").agg(
        *[M.rounded(F.sum(F.when(F.col("type") == t, F.col("acres")).otherwise(0.0)), 2).alias(f"enc_{t}_acres") for t in types],
        union(legal & (F.col("implication") == "favorable")).alias("favorable_easement_acres"), union(legal & (F.col("implication") == "hostile")).alias("hostile_easement_acres"),
        union(F.col("category") == "physical").alias("physical_constraint_acres"), F.array_join(F.sort_array(F.collect_set(F.when(bisecting, F.col("type")))), ";").alias("bisecting_constraints"),
        F.to_json(F.transform(F.array_sort(F.collect_list(record)), lambda r: F.struct(*[r[k].alias(k) for k in JSON_KEYS]))).alias("encumbrances_json"),
        F.sort_array(F.collect_list(F.when(F.col("manual_flag").isNotNull(), F.struct("ord", "manual_flag")))).alias("_mf"), F.max(bisecting).alias("_bisected"),
    )
    flags = F.array_distinct(F.concat(F.transform("_mf", lambda x: x["manual_flag"]), F.when(F.col("_bisected"), F.array(F.lit("hostile_constraint_bisects_parcel"))).otherwise(F.array().cast("array<string>"))))
    out = parcels.join(by.withColumn("encumbrance_flags", flags).drop("_mf", "_bisected"), "account_id", "left")
    zeros = {c: 0.0 for c in out.columns if c.startswith("enc_") and c.endswith("_acres") or c in ("favorable_easement_acres", "hostile_easement_acres", "physical_constraint_acres")}
    return out.fillna(zeros | {"bisecting_constraints": "", "encumbrances_json": "[]"}).withColumn("encumbrance_flags", F.coalesce("encumbrance_flags", F.array().cast("array<string>")))


def hostile(enc: DataFrame, steep: DataFrame | None, cfg: Config) -> DataFrame:
    """(account_id, ord, name, geom, crossable): what is subtracted, in the configuration's order, steep ground last."""
    out = enc.where("subtract_from_usable").select("account_id", "ord", F.col("source_layer").alias("name"), F.col("part").alias("geom"), F.col("crossable_with_permit").alias("crossable"))
    if steep is None:
        return out
    return out.unionByName(steep.select("account_id", F.lit(len(cfg.constraints)).alias("ord"), F.lit("steep_slope").alias("name"), "geom", F.lit(cfg.slope.crossable).alias("crossable")))

