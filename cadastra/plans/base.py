"""Stage 1, base filter: schema, dissolve, owners, acreage and majority zoning. Every parcel of the study area is kept and flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..config import Config, ConfigError
from ..functions import measures as M
from ..functions import owners as O
from ..kernel import functions as K
from ..operators.spatial import grid_join, subdivided, with_box

ADDRESS = ("owner_addr_line1", "owner_addr_line2", "owner_city", "owner_state", "owner_zip")


def areal_only(df: DataFrame) -> DataFrame:
    """Repaired polygons and multipolygons, by the type word of their WKB; empty and other shapes go."""
    fixed = df.where(F.col("geom").isNotNull()).withColumn("geom", K.make_valid("geom"))
    little = F.hex(F.substring("geom", 1, 1)) == "01"
    word = F.when(little, F.hex(F.substring("geom", 2, 1))).otherwise(F.hex(F.substring("geom", 5, 1)))
    return fixed.where(word.isin("03", "06") & ~K.is_empty("geom"))


def row_order(df: DataFrame, *by: str) -> Column:
    """A number to break ties by that doesn't change when a task runs again or files are split anew: ``_row``, the row's place in its source, or a hash of the given columns."""
    return F.col("_row") if "_row" in df.columns else F.xxhash64(*[F.col(f"`{c}`") for c in (by or df.columns)])


def dissolve(rows: DataFrame) -> DataFrame:
    """One row per account: the first value of each column in row order, and the union of the shapes.

    Acreage that repeats on an account's rows is taken as it is; if the sum of the rows fits the shape better, and well
    enough, the rows were single polygons and the sum is taken; rows that differ are not trusted (``_inconsistent``).
    """
    rows = rows.withColumn("_row", row_order(rows)).withColumn("_acres", F.expr("try_cast(acreage_sdat AS double)"))
    other = [c for c in rows.columns if c not in ("account_id", "geom", "_row", "_acres", "acreage_sdat")]
    first = lambda c: F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col("_row")))
    return rows.groupBy("account_id").agg(
        *[first(c).alias(c) for c in other], first("_acres").alias("_first"), F.sum("_acres").alias("_sum"), F.count_distinct("_acres").alias("_kinds"),
        F.count("*").alias("_rows"), K.dissolve_agg("geom").alias("geom"), F.min("_row").alias("_order"),
    )


def reconcile(accounts: DataFrame, within_pct: float) -> DataFrame:
    """The acreage of dissolved accounts; needs ``_first, _sum, _kinds, _rows`` and ``geom_m2``."""
    g = F.greatest(M.acres(F.col("geom_m2")), F.lit(1e-6))
    many = F.col("_rows") >= 2
    inconsistent = many & (F.col("_kinds") > 1)
    off = lambda c: F.abs(F.col(c) - g) / g
    summed = many & ~inconsistent & F.coalesce((off("_sum") < off("_first")) & (off("_sum") <= within_pct / 100.0), F.lit(False))
    out = accounts.withColumns({"sdat_acreage_inconsistent": inconsistent, "sdat_acreage_summed": summed})
    return out.withColumn("acreage_sdat", F.when(F.col("sdat_acreage_summed"), F.col("_sum")).otherwise(F.col("_first"))).drop("_first", "_sum", "_kinds", "_rows")


def acreage(df: DataFrame, cfg: Config) -> DataFrame:
    geom = M.rounded(M.acres(F.col("geom_m2")), 2)
    sdat = F.when(~F.col("sdat_acreage_inconsistent"), F.col("acreage_sdat"))
    good = F.coalesce(sdat > 0, F.lit(False)) if cfg.acreage_source == "sdat" else F.lit(False)
    off = F.abs(sdat - geom) / F.greatest(geom, F.lit(0.01)) * 100
    out = df.withColumns({
        "gross_acres_geom": geom, "gross_acres_sdat": M.rounded(sdat, 2), "gross_acres": M.rounded(F.when(good, sdat).otherwise(geom), 2),
        "acreage_basis": F.when(good, "sdat").otherwise("geometry"), "acreage_disagreement_pct": M.rounded(off, 1),
        "acreage_disagrees": F.coalesce((sdat > 0) & (off > cfg.acreage_disagreement_pct), F.lit(False)),
    })
    ok = F.col("gross_acres") >= cfg.acreage_min
    return out.withColumn("meets_acreage", ok if cfg.acreage_max is None else ok & (F.col("gross_acres") <= cfg.acreage_max))


def unknown_counties(df: DataFrame, cfg: Config) -> DataFrame:
    """(county_code): the data's codes that the configuration lacks."""
    known = df.sparkSession.createDataFrame([(c,) for c in cfg.counties], "county_code string")
    return df.select(F.trim(F.col("county_code").cast("string")).alias("county_code")).distinct().join(F.broadcast(known), "county_code", "left_anti")  # rows of the configuration


def counties(df: DataFrame, cfg: Config) -> DataFrame:
    """Names for county codes; a code that the configuration lacks stops the run."""
    out = df.withColumn("county_code", F.trim(F.col("county_code").cast("string")))
    unknown = sorted(str(r[0]) for r in unknown_counties(out, cfg).collect())
    if unknown:
        raise ConfigError(f"county codes of the data that the configuration lacks: {unknown}; it has {sorted(cfg.counties)}")
    names = F.create_map(*[F.lit(x) for kv in cfg.counties.items() for x in kv])
    return out.withColumn("county", F.element_at(names, F.col("county_code")))


def owners(df: DataFrame) -> DataFrame:
    second = F.trim(F.coalesce(F.col("owner_name2").cast("string"), F.lit(""))) if "owner_name2" in df.columns else F.lit("")
    name = F.trim(F.concat(F.coalesce(F.col("owner_name").cast("string"), F.lit("")), F.when(second != "", F.concat(F.lit(" & "), second)).otherwise("")))
    out = df.withColumn("owner_name", name).withColumn("owner_mailing_address", O.joined_address(*[c for c in ADDRESS if c in df.columns]))
    return out.withColumns({"owner_type": O.owner_type("owner_name"), "owner_key": O.owner_key("owner_name", "owner_mailing_address")})


def in_study_area(df: DataFrame, study: bytes, mode: str) -> DataFrame:
    area = F.lit(bytearray(study))
    inter = K.overlap_area(F.col("geom"), area)
    out = df.withColumn("_inside", inter).withColumn("in_study_area_pct", M.rounded(100 * F.col("_inside") / F.col("geom_m2"), 1))
    keep = {"intersects": F.col("_inside") > 0, "centroid": K.within(K.centroid("geom"), area), "within": F.col("in_study_area_pct") >= 99.9}[mode]
    return out.where(keep).drop("_inside")


def zoning_shares(pairs: DataFrame) -> DataFrame:
    """Majority code, all codes with their shares, and the agricultural share, from (account_id, code, m2, zone_order, ag)."""
    by_code = pairs.groupBy("account_id", "code").agg(F.sum("m2").alias("m2"), F.min("zone_order").alias("o"), F.first("ag").alias("ag"))
    best = F.struct(F.col("m2").alias("m2"), (-F.col("o")).alias("o"))
    out = by_code.groupBy("account_id").agg(
        F.max_by("code", best).alias("zoning"), F.max_by(F.struct("ag"), best).alias("major"), F.sum("m2").alias("total"),
        F.sum(F.when(F.col("ag"), F.col("m2")).otherwise(0.0)).alias("ag_m2"), F.collect_list(F.struct((-F.col("m2")).alias("k"), "o", "code", "m2")).alias("codes"),
    )
    total = F.when(F.col("total") > 0, F.col("total"))
    share = lambda x: F.concat(x["code"], F.lit(":"), F.coalesce(F.rint(100 * x["m2"] / total).cast("int").cast("string"), F.lit("0")), F.lit("%"))
    return out.select("account_id", "zoning", M.rounded(100 * F.col("ag_m2") / total, 1).alias("zoning_ag_pct"), F.col("major.ag").alias("is_agricultural"), F.array_join(F.transform(F.array_sort("codes"), share), ";").alias("zoning_codes_all"), F.col("major.ag").isNull().alias("zoning_unmapped"))


def zoning_pairs(df: DataFrame, layers: dict[str, DataFrame], cfg: Config, cell: float = 2000.0) -> DataFrame | None:
    """(account_id, county, code, m2, zone_order, ag): what zones take of the parcels that meet the acreage, with the mappings' answers; none without layers."""
    zones = None
    for county, layer in sorted(layers.items()):
        spec = cfg.zoning_for(county)
        if spec is None or not spec.code_field:
            raise ConfigError(f"zoning {county}: code_field is not set")
        if spec.code_field not in layer.columns:
            raise schema.SchemaError(f"zoning {county}: no field {spec.code_field}; the fields are {layer.columns}")
        one = areal_only(layer).select(F.lit(county).alias("county"), F.col(spec.code_field).cast("string").alias("code"), row_order(layer, spec.code_field, "geom").alias("zone_order"), "geom")
        zones = one if zones is None else zones.unionByName(one)
    if zones is None:
        return None
    known = [(z.county, c, v.get("is_agricultural")) for z in cfg.zoning for c, v in z.codes.items()]
    mapping = df.sparkSession.createDataFrame(known, "county string, code string, ag boolean")
    pairs = grid_join(subdivided(df.where("meets_acreage").select("account_id", "county", "geom", "box"), cell), subdivided(zones, cell), cell, on=["county"], overlay=True)
    pairs = pairs.select("l.account_id", "l.county", "r.code", "r.zone_order", F.col("o.m2").alias("m2"))
    return pairs.join(F.broadcast(mapping), ["county", "code"], "left")  # rows of the configuration


def unanswered(pairs: DataFrame) -> DataFrame:
    """(county, code): codes that some parcel meets and the mappings don't answer."""
    return pairs.where("ag IS NULL").select("county", "code").distinct()


def zoning(df: DataFrame, layers: dict[str, DataFrame], cfg: Config, cell: float = 2000.0) -> DataFrame:
    """Majority zoning of the parcels that meet the acreage; counties without a layer are marked."""
    pairs = zoning_pairs(df, layers, cfg, cell)
    missing = ~F.col("county").isin(list(layers)) if layers else F.lit(True)
    none = {"zoning": "string", "zoning_ag_pct": "double", "is_agricultural": "boolean", "zoning_codes_all": "string"}
    if pairs is None:
        out = df.withColumns({c: F.lit(None).cast(t) for c, t in none.items()}).withColumn("zoning_unmapped", F.lit(False))
    else:
        if cfg.on_unmapped_zoning == "error":
            bad = sorted((r["county"], r["code"]) for r in unanswered(pairs).collect())
            if bad:
                raise ConfigError("zoning codes without an answer in the mappings: " + "; ".join(f"{c}: {code}" for c, code in bad))
        out = df.join(zoning_shares(pairs), "account_id", "left").withColumn("zoning_unmapped", F.coalesce("zoning_unmapped", F.lit(False)))
    return out.withColumn("zoning_layer_missing", F.col("meets_acreage") & missing)


def passed(df: DataFrame, cfg: Config) -> DataFrame:
    flags = M.flags_of(
        (F.col("sdat_acreage_inconsistent"), "sdat_acreage_inconsistent_across_rows"), (F.col("sdat_acreage_summed"), "sdat_acreage_summed_across_rows"),
        (F.col("acreage_disagrees"), "sdat_acreage_disagrees_with_geometry"), (F.col("zoning_unmapped"), "zoning_unmapped"), (F.col("zoning_layer_missing"), "zoning_layer_missing"),
    )
    ag, small = F.col("is_agricultural"), "below_acreage_min" if cfg.acreage_max is None else "outside_acreage_band"
    reason = F.when(~F.col("meets_acreage"), small).when(~ag, "not_agricultural_zoning").when(ag.isNull(), "zoning_unknown_retained").otherwise("pass")
    return df.withColumns({"manual_flags": flags, "stage1_pass": F.col("meets_acreage") & F.coalesce(ag, F.lit(True)), "stage1_pass_reason": reason})


def stage1(parcels: DataFrame, study: bytes, zoning_layers: dict[str, DataFrame], cfg: Config) -> DataFrame:
    """The study area's parcels, one row per account, with ``geom`` and ``box``."""
    K.register(parcels.sparkSession)
    rows = areal_only(schema.apply(parcels, cfg.schema)).where(K.intersects(F.col("geom"), F.lit(bytearray(study))))
    rows = rows.withColumn("account_id", F.trim(F.col("account_id").cast("string")))
    if "acreage_sdat" not in rows.columns:
        rows = rows.withColumn("acreage_sdat", F.lit(None).cast("string"))
    one = dissolve(rows)
    one = with_box(one).withColumn("geom_m2", F.col("box.area"))
    out = acreage(reconcile(in_study_area(one, study, cfg.study_area_selection), cfg.acreage_disagreement_pct), cfg)
    return passed(zoning(owners(counties(out, cfg)), zoning_layers, cfg), cfg)


def county_summary(df: DataFrame) -> DataFrame:
    ok, ag = F.col("stage1_pass"), F.col("is_agricultural")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return df.groupBy("county").agg(
        F.count("*").alias("in_study_area"), n(F.col("meets_acreage")).alias("meets_acreage"), n(F.col("meets_acreage") & ag).alias("meets_acreage_and_ag_zoned"),
        n(F.col("meets_acreage") & ag.isNull()).alias("meets_acreage_zoning_unknown"), n(ok).alias("stage1_pass"),
        F.median(F.when(ok, F.col("gross_acres"))).alias("median_acres_passing"), F.coalesce(F.sum(F.when(ok, F.col("gross_acres"))), F.lit(0.0)).alias("acres_passing_total"),
    )
