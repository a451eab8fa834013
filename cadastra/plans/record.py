"""The run: stages in order, the final record, and the summary."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import raster
from ..operators.slope import Grid
from ..operators.lineage import cut
from . import access, base, encumbrance, usable

# The leading columns of the record, in order.
RECORD = (
    "account_id owner_name owner_mailing_address owner_type owner_key gross_acres zoning county encumbrances_json usable_acres "
    "largest_contiguous_reachable_acres unreachable_islands_json landlocked_apparent frontage_blocked_by_foreign_parcel blocking_parcel_account_id "
    "manual_verification_flags stage1_pass stage1_pass_reason meets_acreage is_agricultural zoning_ag_pct zoning_codes_all gross_acres_sdat gross_acres_geom "
    "acreage_basis acreage_disagreement_pct in_study_area_pct favorable_easement_acres hostile_easement_acres physical_constraint_acres bisecting_constraints "
    "usable_pct usable_components steep_slope_acres slope_evaluated ag_easement_within_usable_acres reachable_usable_acres unreachable_island_count "
    "unreachable_island_acres sliver_acres reachable_if_crossings_permitted_acres largest_reachable_if_crossings_permitted_acres "
    "islands_reconnectable_by_permit_acres road_facing_ft row_contact_ft frontage_open_ft frontage_encumbered_ft frontage_foreign_ft frontage_same_owner_ft "
    "frontage_gap_ft frontage_blocked_pct frontage_foreign_pct no_public_row_nearby access_via_same_owner_parcel blocking_parcel_owner blocking_parcels_json "
    "frontage_authorities entry_node_count reserve_strip_detected reserve_strips_json"
).split()
FLAGS = ("manual_flags", "encumbrance_flags", "access_flags")


def flag_list(df: DataFrame, name: str) -> Column:
    """A flag column as a list: arrays as they are, text as the JSON list it holds or as one flag."""
    if df.schema[name].dataType.simpleString() != "string":
        return F.coalesce(F.col(name), F.array().cast("array<string>"))
    return F.coalesce(F.from_json(name, "array<string>"), F.when(F.coalesce(F.col(name), F.lit("")) != "", F.array(name)), F.array().cast("array<string>"))


def record(scored: DataFrame) -> DataFrame:
    """All flags as one ordered list without repeats; the record's columns first, nulls for those missing, the rest after, the shape last."""
    flags = [flag_list(scored, c) for c in FLAGS if c in scored.columns]
    df = scored.withColumn("manual_verification_flags", F.array_distinct(F.concat(*flags)) if flags else F.array().cast("array<string>")).drop(*FLAGS)
    rest = [c for c in df.columns if c not in RECORD and c not in ("geom", "box", "geom_m2", "usable", "traversable") and not c.startswith("_")]
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in RECORD], *rest, "geom")


@dataclass
class Inputs:
    """Source tables, each with ``geom`` as WKB in the working plane; a layer that is missing is simply not there. Constraints made from lines, and rows of lines, are given as the lines."""

    parcels: DataFrame
    study: bytes
    zoning: dict[str, DataFrame] = field(default_factory=dict)
    constraints: dict[str, DataFrame] = field(default_factory=dict)
    rows: dict[str, DataFrame] = field(default_factory=dict)
    steep: DataFrame | None = None
    dem: tuple[DataFrame, Grid] | None = None


def targets(stage1: DataFrame, cfg: Config) -> DataFrame:
    """The parcels that go on after stage 1: those that pass, or all if the configuration says so."""
    return stage1 if cfg.process_all else stage1.where("stage1_pass")


def run(inputs: Inputs, cfg: Config, stages: tuple[int, ...] = (1, 2, 3, 4)) -> dict[str, DataFrame]:
    """Tables by name: stage1, encumbrances, usable, frontage, entry_points, strips, islands, scored. Stage 1 always runs."""
    if 3 in stages and 2 not in stages:
        raise ValueError("stage 3 needs stage 2")
    if 4 in stages and 3 not in stages:
        raise ValueError("stage 4 needs stage 3")
    spark: SparkSession = inputs.parcels.sparkSession
    out = {"stage1": cut(base.stage1(inputs.parcels, inputs.study, inputs.zoning, cfg))}
    scored = targets(out["stage1"], cfg)
    if 2 in stages:
        features = encumbrance.all_layers(inputs.constraints, cfg, inputs.study, spark)
        enc = cut(encumbrance.encumbrances(scored, features, cfg))
        scored = encumbrance.rolled_up(scored, enc, cfg)
        out["encumbrances"] = enc
    if 3 in stages:
        ground = None
        if inputs.steep is not None:
            ground = usable.steep_parts(scored, inputs.steep)
        elif inputs.dem is not None:
            ground = raster.steep_in_parcels(scored, *inputs.dem, cfg.slope_max_pct, cfg.slope.dem_vertical_unit_to_m, cfg.slope.dem_resample_m)
        hostile = cut(encumbrance.hostile(enc, ground, cfg))
        scored = cut(usable.stage3(scored, enc, hostile, cfg, ground is not None))
        out["usable"] = scored.select("account_id", "usable_acres", F.col("usable").alias("geom"))
    if 4 in stages:
        roads = cut(access.ways(inputs.rows, cfg, inputs.study, spark))
        four = access.stage4(out["stage1"], scored, roads, hostile, cfg)
        scored = four.pop("parcels")
        out |= four
    out["scored"] = record(scored)
    return out


def _n(c: Column) -> Column:
    return F.count_if(F.coalesce(c, F.lit(False)))


def overall(one: DataFrame) -> DataFrame:
    """One row: stage 1's counts over all counties."""
    return one.agg(F.count("*").alias("parcels_in_study_area"), _n(F.col("meets_acreage")).alias("meets_acreage"), _n(F.col("stage1_pass")).alias("stage1_pass"), _n(F.col("acreage_disagrees")).alias("acreage_disagreements"), F.count_distinct(F.when(F.col("stage1_pass"), F.col("owner_key"))).alias("unique_owner_keys_passing"))


def totals(scored: DataFrame, cfg: Config, ran) -> DataFrame:
    """One row: counts and sums of the later stages that ran, by the tables that they leave."""
    sums = {}
    if "encumbrances" in ran:
        sums |= {"parcels_with_hostile_easement": _n(F.col("hostile_easement_acres") > 0), "parcels_with_favorable_easement": _n(F.col("favorable_easement_acres") > 0), "parcels_bisected_by_hostile_constraint": _n(F.col("bisecting_constraints") != "")}
    if "usable" in ran:
        sums |= {"usable_acres_total": F.sum("usable_acres"), "gross_acres_total": F.sum("gross_acres"), "parcels_usable_below_acreage_min": _n(F.col("usable_acres") < cfg.acreage_min)}
    if "frontage" in ran:
        sums |= {c: _n(F.col(c)) for c in ("landlocked_apparent", "frontage_blocked_by_foreign_parcel", "reserve_strip_detected")} | {"parcels_with_unreachable_islands": _n(F.col("unreachable_island_count") > 0), "largest_reachable_below_acreage_min": _n(F.col("largest_contiguous_reachable_acres") < cfg.acreage_min), "largest_reachable_ge_acreage_min": _n(F.col("largest_contiguous_reachable_acres") >= cfg.acreage_min)}
    return scored.agg(F.count("*").alias("scored_parcels"), *[c.alias(k) for k, c in sums.items()])


def summary(out: dict[str, DataFrame], cfg: Config) -> dict:
    """Counts and sums of every stage that ran."""
    one = out["stage1"]
    head = overall(one).first().asDict()
    counties = {r["county"]: r.asDict() for r in base.county_summary(one).orderBy("county").collect()}
    for r in one.where("stage1_pass").groupBy("county", "owner_type").count().orderBy(F.desc("count"), "owner_type").collect():
        counties[r["county"]].setdefault("owner_types_passing", {})[r["owner_type"]] = r["count"]
    done: dict = {"stage1": head | {"acreage_min": cfg.acreage_min, "acreage_max": cfg.acreage_max, "per_county": counties}}
    got = totals(out["scored"], cfg, out).first().asDict()
    return done | got | ({"encumbrance_rows": out["encumbrances"].count()} if "encumbrances" in out else {})


def markdown(s: dict) -> str:
    """The summary for people."""
    one = s["stage1"]
    lines = ["# Screening run", "", f"{one['parcels_in_study_area']} parcels in the study area, {one['meets_acreage']} meet the acreage, {one['stage1_pass']} pass, {one['unique_owner_keys_passing']} owners.", "", "| county | parcels | acreage | agricultural | unknown zoning | pass | median acres | acres |", "|---|---:|---:|---:|---:|---:|---:|---:|"]
    for c, v in sorted(one["per_county"].items()):
        median = "-" if v["median_acres_passing"] is None else f"{v['median_acres_passing']:.0f}"
        lines.append(f"| {c} | {v['in_study_area']} | {v['meets_acreage']} | {v['meets_acreage_and_ag_zoned']} | {v['meets_acreage_zoning_unknown']} | {v['stage1_pass']} | {median} | {v['acres_passing_total']:.0f} |")
    lines += ["", *[f"- {k}: {v}" for k, v in s.items() if k != "stage1"], "", "Deeded easements, entrance and stream-crossing permits and the terms of single easements are not mapped: parcels are flagged for people to check, never dropped."]
    return "\n".join(lines) + "\n"
