"""Registered queries that run the stages of ``plans/`` themselves on shapes derived from the star-schema tables, with closed forms of boxes in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .cadastre import ACRE, PARCELS_SQL, parcels, roads, shaped, table, top
from .config import Access, Config, Constraint, RowLayer, Zoning
from .functions import measures as M
from .kernel import functions as K
from .plans import access, base, encumbrance, record, usable
from .queries import CLEAN_OWNER, CTES, NAME_SQL, TYPE_SQL, ZONED, _stage1, query, r2

FOOT = 0.3048
COUNTIES = {"FRED": "Frederick", "CARR": "Carroll", "WASH": "Washington"}


# ---- stage 1 on rows of accounts -------------------------------------------------
_ROWS = """
SELECT o_orderkey AS place, concat(' A', CAST(o_custkey AS {s}), ' ') AS acctid, CASE o_custkey % 3 WHEN 0 THEN 'FRED' WHEN 1 THEN ' CARR ' ELSE 'WASH' END AS jurscode,
  CASE WHEN o_orderkey % 3 <> 0 THEN concat('Smith', CAST(o_orderkey % 5 AS {s}), CASE o_custkey % 4 WHEN 0 THEN ' Farms, L.L.C.' WHEN 1 THEN ' Rev Trust' ELSE ' John' END) END AS ownname1,
  CASE o_custkey % 4 WHEN 0 THEN concat(' Mary', CAST(o_custkey % 3 AS {s}), ' ') WHEN 1 THEN '  ' END AS ownname2, concat(CAST(o_custkey % 97 AS {s}), ' Old Mill Road') AS ownadd1,
  CASE o_custkey % 5 WHEN 0 THEN 'nan' WHEN 1 THEN ' ' WHEN 2 THEN 'Unit 7' END AS ownadd2, ' Frederick' AS owncity, 'MD' AS ownstate, concat('21701-', CAST(1000 + o_custkey % 50 AS {s})) AS ownzip,
  CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' WHEN o_custkey % 3 = 0 THEN CAST(5 + o_orderkey % 2 AS {s}) WHEN o_custkey % 3 = 1 THEN '7' END AS acres,
  CASE WHEN o_orderkey % 97 = 0 THEN 'none' WHEN o_orderkey % 89 = 0 THEN 'line' WHEN o_orderkey % 83 = 0 AND (o_orderkey {div} 1000) % 20 <> 10 THEN 'bow' ELSE 'box' END AS kind,
  CAST(300 * (o_orderkey % 1000) AS DOUBLE) AS x0, CAST(300 * (o_orderkey {div} 1000) AS DOUBLE) AS y0,
  CAST(300 * (o_orderkey % 1000) + 200 + 10 * (o_custkey % 5) AS DOUBLE) AS x1, CAST(300 * (o_orderkey {div} 1000) + 100 + 10 * (o_orderkey % 7) AS DOUBLE) AS y1
FROM orders
"""
ROWS_SQL = _ROWS.format(s="VARCHAR", div="//")
#: The study area's upper edge runs through the eleventh row of boxes.
AREA = (-1000.0, -1000.0, 400000.0, 3100.0)
BANDS = (("A", -1000.0, 100170.0), ("R1", 100170.0, 200070.0), ("X9", 200070.0, 400000.0))
SPEC = {
    "required": {"account_id": ["ACCTID"], "county_code": ["JURSCODE"], "owner_name": ["NAME", "OWNNAME1"], "owner_addr_line1": ["OWNADD1"], "owner_city": ["OWNCITY"], "owner_state": ["OWNSTATE"], "owner_zip": ["OWNZIP"]},
    "optional": {"owner_name2": ["OWNNAME2"], "owner_addr_line2": ["OWNADD2"], "acreage_sdat": ["ACRES"], "land_use_code": ["LU"]},
}


def _account_config(**more) -> Config:
    ag = {"A": {"is_agricultural": True}, "R1": {"is_agricultural": False}}
    return Config(**{"counties": COUNTIES, "schema": SPEC, "zoning": (Zoning("Frederick", "CODE", ag), Zoning("Carroll", "CODE", ag)), "on_unmapped_zoning": "flag"} | more)


def _account_rows(spark, sf_dir):
    K.register(spark)
    rows = spark.sql(_ROWS.format(s="STRING", div="div").replace("FROM orders", "FROM {src}"), src=table(spark, sf_dir, "orders"))
    at = lambda *names: F.array(*[F.col(n) for n in names])
    geom = F.when(F.col("kind") == "box", K.box("x0", "y0", "x1", "y1")).when(F.col("kind") == "bow", K.ring(at("x0", "y0", "x1", "y1", "x1", "y0", "x0", "y1"))).when(F.col("kind") == "line", K.line(at("x0", "y0", "x1", "y1")))
    return rows.select(F.col("place").alias("_row"), *[c for c in rows.columns if c not in ("place", "kind", "x0", "y0", "x1", "y1")], geom.alias("geom"))


def _bands(spark):
    K.register(spark)
    rows = spark.createDataFrame([(k, c, lo, hi) for k, (c, lo, hi) in enumerate(BANDS)], "_row long, CODE string, lo double, hi double")
    return rows.select("_row", "CODE", K.box("lo", F.lit(-1000.0), "hi", F.lit(1000000.0)).alias("geom"))


_NAME = "trim(concat(coalesce(n1, ''), CASE WHEN trim(coalesce(n2, '')) <> '' THEN concat(' & ', trim(n2)) ELSE '' END))"
_MAIL = "concat_ws(' ', " + ", ".join(f"CASE WHEN trim({c}) <> '' AND lower(trim({c})) <> 'nan' THEN trim({c}) END" for c in ("a1", "a2", "city", "st", "zip")) + ")"
ACCOUNT_CTES = f"""r AS (SELECT *, trim(acctid) AS id, TRY_CAST(acres AS DOUBLE) AS ac, (x1 - x0) * (y1 - y0) * CASE kind WHEN 'bow' THEN 0.5 ELSE 1 END AS m2, (x1 - x0) * (least(y1, 3100) - y0) * CASE kind WHEN 'bow' THEN 0.5 ELSE 1 END AS inside FROM ({ROWS_SQL}) WHERE kind IN ('box', 'bow') AND y0 <= 3100),
d AS (SELECT id, trim(arg_min(jurscode, place)) AS cc, arg_min(ownname1, place) FILTER (ownname1 IS NOT NULL) AS n1, arg_min(ownname2, place) FILTER (ownname2 IS NOT NULL) AS n2, arg_min(ownadd1, place) AS a1, arg_min(ownadd2, place) FILTER (ownadd2 IS NOT NULL) AS a2,
  arg_min(owncity, place) AS city, arg_min(ownstate, place) AS st, arg_min(ownzip, place) AS zip, arg_min(ac, place) FILTER (ac IS NOT NULL) AS f, sum(ac) AS s, count(DISTINCT ac) AS kinds, count(*) AS n, sum(m2) AS m2, sum(inside) AS inside FROM r GROUP BY 1),
g AS (SELECT *, m2 / {ACRE} AS g, n >= 2 AND kinds > 1 AS bad, {r2(f'm2 / {ACRE}')} AS ga, {r2('100 * inside / m2', 1)} AS pct, {_NAME} AS owner_name, {_MAIL} AS mail FROM d),
h AS (SELECT *, n >= 2 AND NOT bad AND coalesce(abs(s - g) / g < abs(f - g) / g AND abs(s - g) / g <= 0.1, false) AS summed FROM g),
i AS (SELECT *, CASE WHEN bad THEN NULL WHEN summed THEN s ELSE f END AS sd FROM h),
j AS (SELECT *, CASE WHEN sd > 0 THEN {r2('sd')} ELSE ga END AS gross, coalesce(sd > 0 AND abs(sd - ga) / greatest(ga, 0.01) * 100 > 10, false) AS off FROM i),
zs AS (SELECT r.id, b.o, b.code, sum(m2) AS m2 FROM r JOIN (VALUES {", ".join(f"({k}, '{c}', {lo}, {hi})" for k, (c, lo, hi) in enumerate(BANDS))}) b(o, code, lo, hi) ON r.x0 >= lo AND r.x0 < hi GROUP BY 1, 2, 3),
z AS (SELECT id, arg_max(code, m2 - o / 1e6) AS zoning, {r2("100 * sum(CASE WHEN code = 'A' THEN m2 ELSE 0.0 END) / sum(m2)", 1)} AS ag_pct, string_agg(code || ':' || CAST(round_even(100 * m2 / t, 0) AS BIGINT)::VARCHAR || '%', ';' ORDER BY m2 DESC, o) AS codes FROM (SELECT *, sum(m2) OVER (PARTITION BY id) AS t FROM zs) GROUP BY 1),
q AS (SELECT j.*, z.zoning, z.ag_pct, z.codes, CASE z.zoning WHEN 'A' THEN true WHEN 'R1' THEN false END AS ag, coalesce(z.zoning = 'X9', false) AS unmapped, gross >= 40 AND cc = 'WASH' AS missing FROM j LEFT JOIN z ON j.id = z.id AND gross >= 40 AND cc <> 'WASH')"""


@query(f"""WITH {ACCOUNT_CTES} SELECT id AS account_id, owner_name, mail AS owner_mailing_address, {TYPE_SQL.replace("WHEN o IS NULL OR o = ''", "WHEN co IS NULL OR co = ''").replace("regexp_matches(o,", "regexp_matches(co,")} AS owner_type,
CASE cc WHEN 'FRED' THEN 'Frederick' WHEN 'CARR' THEN 'Carroll' ELSE 'Washington' END AS county, pct AS in_study_area_pct, ga AS gross_acres_geom, gross AS gross_acres, CASE WHEN sd > 0 THEN 'sdat' ELSE 'geometry' END AS acreage_basis, zoning, ag_pct AS zoning_ag_pct, codes AS zoning_codes_all,
CASE WHEN gross < 40 THEN 'below_acreage_min' WHEN NOT ag THEN 'not_agricultural_zoning' WHEN ag IS NULL THEN 'zoning_unknown_retained' ELSE 'pass' END AS reason,
concat_ws(';', CASE WHEN bad THEN 'sdat_acreage_inconsistent_across_rows' END, CASE WHEN summed THEN 'sdat_acreage_summed_across_rows' END, CASE WHEN off THEN 'sdat_acreage_disagrees_with_geometry' END, CASE WHEN unmapped THEN 'zoning_unmapped' END, CASE WHEN missing THEN 'zoning_layer_missing' END) AS flags
FROM (SELECT *, {CLEAN_OWNER} AS co FROM q WHERE inside > 0)""")
def stage1_accounts(spark, sf_dir):
    """Stage 1 whole: fields by their candidates, repair, other shapes out, study area, dissolve, owners, acreage, zoning."""
    layer = _bands(spark)
    s = base.stage1(_account_rows(spark, sf_dir), K.box_wkb(*AREA), {"Frederick": layer, "Carroll": layer}, _account_config())
    return s.select("account_id", "owner_name", "owner_mailing_address", "owner_type", "county", "in_study_area_pct", "gross_acres_geom", "gross_acres", "acreage_basis", "zoning", "zoning_ag_pct", "zoning_codes_all", F.col("stage1_pass_reason").alias("reason"), F.array_join("manual_flags", ";").alias("flags"))


@query(f"{CTES}, {ZONED} SELECT count(*)::BIGINT AS parcels_in_study_area, count(*) FILTER (gross >= 40)::BIGINT AS meets_acreage, count(*) FILTER (ok)::BIGINT AS stage1_pass, count(*) FILTER (off)::BIGINT AS acreage_disagreements, count(DISTINCT {NAME_SQL}) FILTER (ok)::BIGINT AS unique_owner_keys_passing FROM f")
def stage1_overall(spark, sf_dir):
    return record.overall(_stage1(spark, sf_dir))


@query(f"SELECT DISTINCT county_code AS code FROM ({PARCELS_SQL}) WHERE county_code NOT IN ('FRED', 'CARR')")
def unknown_counties(spark, sf_dir):
    return base.unknown_counties(parcels(spark, sf_dir), _account_config(counties={"FRED": "Frederick", "CARR": "Carroll"})).select(F.col("county_code").alias("code"))


@query(f"WITH {ACCOUNT_CTES} SELECT DISTINCT CASE cc WHEN 'FRED' THEN 'Frederick' ELSE 'Carroll' END AS county, code FROM q JOIN zs USING (id) WHERE gross >= 40 AND cc <> 'WASH' AND code = 'X9' AND inside > 0")
def unmapped_codes(spark, sf_dir):
    """Codes that parcels touch and the mappings lack: what stops a run that is set to stop."""
    layer, cfg = _bands(spark), _account_config()
    s = base.stage1(_account_rows(spark, sf_dir), K.box_wkb(*AREA), {}, cfg)
    return base.unanswered(base.zoning_pairs(s, {"Frederick": layer, "Carroll": layer}, cfg))


@query(f"{CTES}, {ZONED} SELECT mode, k FROM f, (VALUES ('passing', false), ('all', true)) m(mode, every) WHERE ok OR every")
def target_selection(spark, sf_dir):
    s = _stage1(spark, sf_dir)
    return record.targets(s, _account_config()).select(F.lit("passing").alias("mode"), "k").unionByName(record.targets(s, _account_config(process_all=True)).select(F.lit("all").alias("mode"), "k"))


@query("SELECT (row_number() OVER ())::INTEGER - 1 AS place, name, place_of AS filled FROM (SELECT unnest([" + ", ".join(f"'{c}'" for c in [*record.RECORD, "extra", "geom"]) + "]) AS name, unnest([" + ", ".join(str(c in ("account_id", "zoning", "extra", "geom", "manual_verification_flags")).lower() for c in [*record.RECORD, "extra", "geom"]) + "]) AS place_of)")
def record_columns(spark, sf_dir):
    """The record's columns in order, and which the input fills."""
    one = parcels(spark, sf_dir).select("account_id", F.lit("A").alias("zoning"), F.lit(1).alias("extra"), "geom", F.lit("x").alias("_private")).withColumn("manual_flags", F.array(F.lit("f")))
    got = record.record(one)
    filled = got.agg(*[(F.count_if(F.col(c).isNotNull()) > 0).alias(c) for c in got.columns]).select(F.explode(F.array(*[F.struct(F.lit(k).alias("place"), F.lit(c).alias("name"), F.col(c).alias("filled")) for k, c in enumerate(got.columns)])).alias("x"))
    return filled.select("x.*")


# ---- stages 2 and 3 on features inside their parcels -------------------------------
#: name: (condition on k, box relative to the parcel). Of l5, one feature only touches, one is below ten square metres on some parcels.
_FEATURES = (
    ("l1", "k % 4 = 0", "x0", "y0 + 30", "x1", "y0 + 60"), ("l2", "k % 3 = 1", "x0", "y0", "x0 + 100 + 20 * (k % 10)", "y1"), ("l3", "k % 5 = 2", "x1 - 80", "y1 - 70", "x1", "y1"),
    ("l4", "k % 2 = 0", "x0 + 50", "y0 + 70", "x0 + 90 + k % 30", "y0 + 110"), ("l5", "k % 6 = 5", "x0 + 10", "y1", "x0 + 30", "y1 + 5"), ("l5", "k % 6 = 5 AND k % 4 = 1", "x0 + 40", "y1 - 20", "x0 + 60", "y1"),
    ("l5", "k % 6 = 1", "x0 + 40", "y1 - 3", "x0 + 43", "y1"), ("l6", "k % 6 = 0", "x0 + 60", "y0 + 80", "x0 + 140", "y0 + 130"),
)
_CONSTRAINTS = (
    Constraint("l1", "easement", "legal", "hostile", True, True, name_field="name"), Constraint("l2", "preservation", "legal", "favorable", name_field="name"), Constraint("l3", "wet", "physical", "physical", True, True, name_field="name"),
    Constraint("l4", "flood", "physical", "hostile", True, False, "check_l4", name_field="name"), Constraint("l5", "other", "legal", "varies", name_field="name"), Constraint("l6", "flood", "physical", "physical", True, True),
)
_KIND = {c.name: c for c in _CONSTRAINTS}
FEATURES_SQL = " UNION ALL ".join(f"SELECT '{n}' AS layer, k, {i} AS i, {x0} AS x0, {y0} AS y0, {x1} AS x1, {y1} AS y1 FROM p WHERE {c}" for i, (n, c, x0, y0, x1, y1) in enumerate(_FEATURES))


def _stage_config() -> Config:
    return Config(counties=COUNTIES, schema=SPEC, constraints=_CONSTRAINTS)


def _stage2(spark, sf_dir):
    """(parcels, encumbrances): features of all layers, cut to the study area, against all parcels."""
    p = parcels(spark, sf_dir).withColumn("geom_m2", F.col("box.area"))
    flat = p.select("k", "x0", "y0", "x1", "y1")
    layers = {}
    for i, (n, c, *box) in enumerate(_FEATURES):
        one = flat.where(c).select(F.concat(F.lit("F"), F.lit(i).cast("string"), F.lit("-"), (F.col("k") % 3).cast("string")).alias("name"), K.box(*[F.expr(b) for b in box]).alias("geom"))
        layers[n] = one if n not in layers else layers[n].unionByName(one)
    study = K.box_wkb(-1000, -1000, 30000, top(spark, sf_dir))
    features = encumbrance.all_layers(layers, _stage_config(), study, spark)
    return p, encumbrance.encumbrances(p, features, _stage_config())


ENC_CTES = f"""ft AS ({FEATURES_SQL}),
t1 AS (SELECT p.k, ft.layer, ft.i, greatest(p.x0, ft.x0) AS a0, greatest(p.y0, ft.y0) AS b0, least(p.x1, ft.x1) AS a1, least(p.y1, ft.y1) AS b1, p.x0, p.y0, p.x1, p.y1 FROM p JOIN ft ON p.k = ft.k),
en AS (SELECT k, layer, count(*) AS feature_count, string_agg(DISTINCT 'F' || i::VARCHAR || '-' || (k % 3)::VARCHAR, '; ' ORDER BY 'F' || i::VARCHAR || '-' || (k % 3)::VARCHAR) AS names, sum((a1 - a0) * (b1 - b0)) AS m2, max(CASE WHEN b1 > b0 THEN a0 END) AS a0, max(CASE WHEN b1 > b0 THEN b0 END) AS b0, max(CASE WHEN b1 > b0 THEN a1 END) AS a1, max(CASE WHEN b1 > b0 THEN b1 END) AS b1, any_value(x0) AS x0, any_value(y0) AS y0, any_value(x1) AS x1, any_value(y1) AS y1 FROM t1 GROUP BY 1, 2 HAVING sum((a1 - a0) * (b1 - b0)) >= 10),
eo AS (SELECT *, (x1 - x0) * (y1 - y0) AS pm2, (a0 + a1 - x0 - x1) / 2 AS dx, (b0 + b1 - y0 - y1) / 2 AS dy, a0 = x0 OR a1 = x1 OR b0 = y0 OR b1 = y1 AS touches, a0 = x0 AND a1 = x1 AND b0 > y0 AND b1 < y1 AS across FROM en),
er AS (SELECT *, CASE WHEN across THEN 2 ELSE 1 END AS pieces, CASE WHEN across THEN (x1 - x0) * greatest(b0 - y0, y1 - b1) ELSE pm2 - m2 END AS largest,
  CASE WHEN 100 * sqrt(dx * dx + dy * dy) / sqrt(pm2 / pi()) < 25 THEN 'center' ELSE ['E', 'NE', 'N', 'NW', 'W', 'SW', 'S', 'SE'][1 + CAST(floor(((degrees(atan2(dy, dx)) + 360 + 22.5) % 360) / 45) AS INTEGER)] END AS position FROM eo)"""


@query(f"""{CTES}, {ENC_CTES} SELECT k, layer, {r2(f'm2 / {ACRE}')} AS acres, {r2('100 * m2 / pm2', 1)} AS pct, position, {r2('100 * sqrt(dx * dx + dy * dy) / sqrt(pm2 / pi())', 1)} AS offset_pct, touches, pieces::INTEGER AS pieces, pieces >= 2 AS bisects, {r2('100 * largest / pm2', 1)} AS largest_pct, {r2(f'largest / {ACRE}')} AS largest_acres,
position || CASE WHEN pieces >= 2 THEN '; BISECTS parcel into ' || pieces::VARCHAR || ' pieces' WHEN touches THEN ' edge' ELSE ' interior' END AS description, feature_count::BIGINT AS feature_count, CASE WHEN layer <> 'l6' THEN names END AS feature_names FROM er""")
def stage2_encumbrances(spark, sf_dir):
    """Stage 2's table: every measure of each (parcel, layer)."""
    p, enc = _stage2(spark, sf_dir)
    rows = enc.join(p.select("account_id", "k"), "account_id")
    return rows.select("k", F.col("source_layer").alias("layer"), "acres", F.col("pct_of_parcel").alias("pct"), "position", F.col("centroid_offset_pct").alias("offset_pct"), F.col("touches_boundary").alias("touches"), F.col("fragments_if_removed").alias("pieces"), "bisects", F.col("largest_fragment_pct").alias("largest_pct"), F.col("largest_fragment_acres").alias("largest_acres"), "description", "feature_count", "feature_names")


def _m2(layer: str) -> str:
    return f"coalesce(max(m2) FILTER (layer = '{layer}'), 0)"


def _both(a: str, b: str) -> str:
    """The area that two layers' boxes of a parcel share."""
    side = lambda lo, hi: f"greatest(0, least(max({hi}) FILTER (layer = '{a}'), max({hi}) FILTER (layer = '{b}')) - greatest(max({lo}) FILTER (layer = '{a}'), max({lo}) FILTER (layer = '{b}')))"
    return f"coalesce(CASE WHEN count(*) FILTER (layer = '{a}') > 0 AND count(*) FILTER (layer = '{b}') > 0 THEN {side('a0', 'a1')} * {side('b0', 'b1')} END, 0)"


_TYPES = {"easement": ("l1",), "flood": ("l4", "l6"), "other": ("l5",), "preservation": ("l2",), "wet": ("l3",)}
# three boxes share ground inside l2: what l4 and l6 share, as far as l2 reaches
_TRIPLE = "coalesce(CASE WHEN count(*) FILTER (layer IN ('l2', 'l4', 'l6')) = 3 THEN greatest(0, least(max(a1) FILTER (layer = 'l2'), max(a1) FILTER (layer = 'l4'), max(a1) FILTER (layer = 'l6')) - max(a0) FILTER (layer = 'l6')) * greatest(0, max(b1) FILTER (layer = 'l4') - max(b0) FILTER (layer = 'l6')) END, 0)"
ROLL_CTES = f"""{ENC_CTES}, ro AS (SELECT k, {", ".join(f"{_m2(n)} AS {n}" for n in _KIND)}, {_both('l4', 'l6')} AS l46, {_both('l2', 'l1')} + {_both('l2', 'l4')} + {_both('l2', 'l6')} - {_TRIPLE} AS in2,
  string_agg(layer || ':' || ({r2(f'm2 / {ACRE}')})::VARCHAR || ':' || position || ':' || pieces::VARCHAR, ';' ORDER BY layer) AS listed,
  count(*) FILTER (layer = 'l1') > 0 AS b1, count(*) FILTER (layer = 'l4') > 0 AS has4 FROM er GROUP BY k),
al AS (SELECT p.k, (p.x1 - p.x0) * (p.y1 - p.y0) AS pm2, {", ".join(f"coalesce(ro.{c}, 0) AS {c}" for c in (*_KIND, "l46", "in2"))}, coalesce(listed, '') AS listed, coalesce(b1, false) AS bis, coalesce(has4, false) AS has4 FROM p LEFT JOIN ro USING (k))"""


@query(f"""{CTES}, {ROLL_CTES} SELECT k, {", ".join(f"{r2(' + '.join(r2(f'{n} / {ACRE}') for n in ns))} AS enc_{t}_acres" for t, ns in _TYPES.items())}, {r2(f'l2 / {ACRE}')} AS favorable, {r2(f'l1 / {ACRE}')} AS hostile, {r2(f'(l3 + l4 + l6 - l46) / {ACRE}')} AS physical,
CASE WHEN bis THEN 'easement' ELSE '' END AS bisecting, listed, concat_ws(';', CASE WHEN has4 THEN 'check_l4' END, CASE WHEN bis THEN 'hostile_constraint_bisects_parcel' END) AS flags FROM al""")
def stage2_rollup(spark, sf_dir):
    """Acres by type and by implication (no ground twice), what bisects, the JSON list in the configuration's order, flags."""
    p, enc = _stage2(spark, sf_dir)
    got = encumbrance.rolled_up(p, enc, _stage_config())
    rows = F.from_json("encumbrances_json", "array<struct<type:string,source_layer:string,acres:double,position:string,fragments_if_removed:int>>")
    listed = F.array_join(F.transform(rows, lambda r: F.concat_ws(":", r["source_layer"], r["acres"].cast("string"), r["position"], r["fragments_if_removed"].cast("string"))), ";")
    return got.select("k", *[f"enc_{t}_acres" for t in _TYPES], F.col("favorable_easement_acres").alias("favorable"), F.col("hostile_easement_acres").alias("hostile"), F.col("physical_constraint_acres").alias("physical"), F.col("bisecting_constraints").alias("bisecting"), listed.alias("listed"), F.array_join("encumbrance_flags", ";").alias("flags"))


@query(f"""{CTES}, {ROLL_CTES}, us AS (SELECT *, pm2 - (l1 + l3 + l4 + l6 - l46) AS u FROM al) SELECT k, {r2(f'u / {ACRE}')} AS usable_acres, {r2('100 * u / pm2', 1)} AS usable_pct, CASE WHEN bis THEN 2 ELSE 1 END::INTEGER AS usable_components, {", ".join(f"{r2(f'{n} / {ACRE}')} AS subtracted_{n}_acres" for n in ("l1", "l3", "l4", "l6"))},
{r2(f'(l2 - in2) / {ACRE}')} AS easement_within, {r2('pm2 - l4', 3)} AS traversable_m2 FROM us""")
def stage3_usable(spark, sf_dir):
    """Stage 3: the parcel less what is subtracted, its pieces, the favourable easement that is left, and what can be crossed with a permit."""
    p, enc = _stage2(spark, sf_dir)
    cfg = _stage_config()
    got = usable.stage3(p, enc, encumbrance.hostile(enc, None, cfg), cfg, False)
    return got.select("k", "usable_acres", "usable_pct", "usable_components", *[f"subtracted_{n}_acres" for n in ("l1", "l3", "l4", "l6")], F.col("ag_easement_within_usable_acres").alias("easement_within"), M.rounded(K.area("traversable"), 3).alias("traversable_m2"))


# ---- stage 4: roads below each row of parcels, strips before some ---------------------
def _way_layers(spark, sf_dir):
    """County roads as centre lines of 18 m, state and private ones as polygons."""
    w = roads(spark, sf_dir)
    y = F.col("r") * 700.0 + 9
    lines = w.where("authority = 'county' AND public").select(K.line(F.array(F.lit(0.0), y, F.lit(28000.0), y)).alias("geom"))
    layers = {"lines": lines, "state": w.where("authority = 'state' AND public").select("geom"), "private": w.where("NOT public").select("geom")}
    spec = (RowLayer("lines", "county", True, "line", 18 / FOOT), RowLayer("state", "state"), RowLayer("private", "private", False))
    return layers, Config(counties=COUNTIES, schema=SPEC, access=Access(spec))


TOOTH = 35


def comb(width: float, top: float) -> bytes:
    """A polygon of teeth as wide as their gaps, on a bar below."""
    import struct

    xy = [(width, -200.0), (0.0, -200.0)]
    for i in range(int(width // (2 * TOOTH))):
        a, b = 2.0 * TOOTH * i, 2.0 * TOOTH * i + TOOTH
        xy += [(a, top), (b, top), (b, -100.0), (b + TOOTH, -100.0)]
    xy += [xy[0]]
    return struct.pack("<BIII", 1, 3, 1, len(xy)) + b"".join(struct.pack("<dd", *p) for p in xy)


_UNDER = f"({TOOTH} * floor({{x}} / {2 * TOOTH}) + least({{x}} - {2 * TOOTH} * floor({{x}} / {2 * TOOTH}), {TOOTH}))"


@query(f"""{CTES}, c AS (SELECT k, x0, y0, x1, y1, (y1 - y0) * ({_UNDER.format(x='x1')} - {_UNDER.format(x='x0')}) AS m2 FROM p)
SELECT k, {r2(f'm2 / {ACRE}')} AS acres, {r2('100 * m2 / ((x1 - x0) * (y1 - y0))', 1)} AS pct, 1::BIGINT AS feature_count FROM c WHERE m2 >= 10""")
def giant_feature(spark, sf_dir):
    """One feature of 1,600 points over all parcels: joined in pieces, put together again for each parcel."""
    p = parcels(spark, sf_dir)
    edge = top(spark, sf_dir)
    layer = spark.createDataFrame([("all", bytearray(comb(28000, edge)))], "name string, geom binary")
    cfg = Config(counties=COUNTIES, schema=SPEC, constraints=(Constraint("comb", "other", "legal", "hostile", name_field="name"),))
    features = encumbrance.all_layers({"comb": layer}, cfg, K.box_wkb(-1000, -1000, 40000, edge + 1000), spark)
    enc = encumbrance.encumbrances(p, features, cfg).join(p.select("account_id", "k"), "account_id")
    return enc.select("k", "acres", F.col("pct_of_parcel").alias("pct"), "feature_count")


_EDGE = "(k % 12) - 2.5"


@query(f"""WITH l AS (SELECT s_suppkey AS k, {_EDGE} AS y FROM supplier) SELECT how, k, 18.0 * (50 + k) AS m2, y - 9 AS miny, 0.0 AS minx FROM l, (VALUES ('way'), ('constraint')) h(how) WHERE y > 0
UNION ALL SELECT 'polygon', k, (50 + k) * (y + 9), 0.0, 0.0 FROM l WHERE y + 9 > 0""")
def study_edge(spark, sf_dir):
    """Lines are cut at the study area's edge and then buffered, so buffers reach over an edge beside them; polygons are cut."""
    k = F.col("s_suppkey")
    at = table(spark, sf_dir, "supplier").select(k.alias("k"), (k % 12 - 2.5).cast("double").alias("y"))
    K.register(spark)
    one = lambda: (-10 - F.col("k") % 30).cast("double")
    lines = at.select("k", K.line(F.array(one(), F.col("y"), (F.col("k") + 50).cast("double"), F.col("y"))).alias("geom"))
    boxes = at.select("k", K.box(one(), F.col("y") - 9, F.col("k") + 50, F.col("y") + 9).alias("geom"))
    study = K.box_wkb(0, 0, 1e6, 1000)
    cfg = Config(counties=COUNTIES, schema=SPEC, access=Access((RowLayer("lines", "county", True, "line", 18 / FOOT), RowLayer("polygons", "state"))), constraints=(Constraint("made", "buffer", "physical", "hostile", True, True, name_field="k", lines={"buffer_ft": 9 / FOOT}),))
    ways = access.ways({"lines": lines, "polygons": boxes}, cfg, study, spark).select(F.when(F.col("row_layer") == "lines", "way").otherwise("polygon").alias("how"), "box")
    made = encumbrance.all_layers({"made": lines}, cfg, study, spark).select(F.lit("constraint").alias("how"), "box")
    b = F.col("box")
    return ways.unionByName(made).select("how", F.rint(b["maxx"] - 50).cast("long").alias("k"), M.rounded(b["area"], 3).alias("m2"), M.rounded(b["miny"], 3).alias("miny"), M.rounded(b["minx"], 3).alias("minx"))


def _stage4(spark, sf_dir):
    p = parcels(spark, sf_dir).select("k", "x0", "y0", "x1", "y1", "account_id", F.concat(F.lit("NAME"), "k").alias("owner_name"), F.concat(F.lit("ADDR "), "account_id").alias("owner_mailing_address"), "geom", "box")
    road = F.expr("k div 40") * 700.0 + 18
    own = F.when(F.expr("k div 17") % 2 == 0, F.col("owner_name")).otherwise("DELTA CORP")
    strip = shaped(p.where("k % 17 = 0").select("k", "x0", road.alias("y0"), "x1", F.col("y0").alias("y1"), F.concat(F.lit("S"), "k").alias("account_id"), own.alias("owner_name"), F.concat(F.lit("ADDR S"), "k").alias("owner_mailing_address")))
    every = p.unionByName(strip).drop("k", "x0", "y0", "x1", "y1")
    band = K.box(F.col("x0"), F.col("y0") + 30, F.col("x1"), F.col("y0") + 60)
    targets = p.withColumns({"usable": F.when(F.col("k") % 4 == 0, K.areal_difference(F.col("geom"), band)).otherwise(F.col("geom")), "traversable": F.col("geom")})
    wet = lambda name, o, part: p.where(f"k % {5 * (o + 1)} = 0").select("account_id", F.lit(o).alias("ord"), F.lit(name).alias("name"), K.box(F.col("x0"), F.col("y0"), F.col("x0") + (F.col("x1") - F.col("x0")) * part, F.col("y0") + 10).alias("geom"), F.lit(False).alias("crossable"))
    layers, cfg = _way_layers(spark, sf_dir)
    ways = access.ways(layers, cfg, K.box_wkb(-1000, -1000, 30000, top(spark, sf_dir)), spark)
    return access.stage4(every, targets.drop("x0", "y0", "x1", "y1"), ways, wet("wet", 0, 0.47).unionByName(wet("alt", 1, 0.73)), cfg)


def _x(at: str) -> str:
    return f"CASE WHEN {at} <= s THEN x0 WHEN {at} <= s + w THEN x0 + ({at} - s) ELSE x1 END"


def _y(at: str) -> str:
    return f"CASE WHEN {at} <= s THEN y0 + (s - ({at})) WHEN {at} <= s + w THEN y0 ELSE y0 + ({at} - s - w) END"


# The boundary near the road runs down the left side, along the bottom and up the right; it is cut into pieces of 15 feet at most.
ACCESS_CTES = f"""tg AS (SELECT k, account_id, x0, y0, x1, y1, x1 - x0 AS w, y1 - y0 AS h, k // 40 AS r, 700.0 * (k // 40) + 18 AS rt, 76.2 - (y0 - 700.0 * (k // 40) - 18) AS s FROM p),
bl AS (SELECT account_id AS b, 'NAME' || k AS owner, k // 40 AS r, x0, y0, x1, y1 FROM p UNION ALL SELECT 'S' || k, CASE WHEN (k // 17) % 2 = 0 THEN 'NAME' || k ELSE 'DELTA CORP' END, k // 40, x0, 700.0 * (k // 40) + 18, x1, y0 FROM p WHERE k % 17 = 0),
cut AS (SELECT *, w + 2 * s AS len, CAST(ceil((w + 2 * s) / 4.572) AS BIGINT) AS n FROM tg WHERE r % 7 <> 6),
pc AS (SELECT *, len * i / n AS sa, len * (i + 1) / n AS sb FROM (SELECT *, unnest(range(n)) AS i FROM cut)),
pt AS (SELECT *, {_x('(sa + sb) / 2')} AS mx, {_y('(sa + sb) / 2')} AS my, {_x('sb')} - {_x('sa')} AS dx, {_y('sb')} - {_y('sa')} AS dy FROM pc),
po AS (SELECT *, dx / sqrt(dx * dx + dy * dy) AS tx, dy / sqrt(dx * dx + dy * dy) AS ty FROM pt),
pq AS (SELECT *, mx + 0.3 * ty AS ox, my - 0.3 * tx AS oy, mx - 1.5 * ty AS ix, my + 1.5 * tx AS iy FROM po),
pr AS (SELECT *, least(greatest(ox, 0), 28000) AS qx, least(greatest(oy, rt - 18), rt) AS qy FROM pq),
ps AS (SELECT *, sqrt((qx - ox) * (qx - ox) + (qy - oy) * (qy - oy)) AS far FROM pr),
kept AS (SELECT * FROM ps WHERE NOT (far > 0.9144 AND abs((qx - ox) * tx + (qy - oy) * ty) / far > 0.9)),
hit AS (SELECT k, i, arg_min(b, (greatest(0, oy - b_y1), b)) AS b, arg_min(owner, (greatest(0, oy - b_y1), b)) AS owner FROM (SELECT kept.k, kept.i, kept.oy, bl.b, bl.owner, bl.y1 AS b_y1 FROM kept JOIN bl ON kept.r = bl.r AND bl.b <> kept.account_id AND ox >= bl.x0 AND ox <= bl.x1 AND qx = ox AND least(oy, bl.y1) - greatest(qy, bl.y0) >= 0.1 WHERE far > 0.9144) GROUP BY 1, 2),
cl AS (SELECT kept.k, kept.i, kept.len / kept.n AS m, kept.r, b, CASE WHEN owner = 'NAME' || kept.k THEN 'same' WHEN b IS NOT NULL THEN 'foreign' WHEN far <= 7.62 THEN 'row' ELSE 'gap' END AS outside, CASE WHEN kept.k % 5 = 0 AND ix <= x0 + w * 0.47 AND iy <= y0 + 10 THEN 'wet' WHEN kept.k % 10 = 0 AND ix <= x0 + w * 0.73 AND iy <= y0 + 10 THEN 'alt' END AS inside FROM kept LEFT JOIN hit ON kept.k = hit.k AND kept.i = hit.i),
cs AS (SELECT *, CASE WHEN outside = 'foreign' THEN 'foreign' WHEN inside IS NOT NULL THEN 'enc' WHEN outside = 'row' THEN 'open' WHEN outside = 'same' THEN 'same' ELSE 'gap' END AS class FROM cl),
rn AS (SELECT k, count(*) AS runs FROM (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS before FROM cs WHERE class IN ('open', 'same')) WHERE before IS NULL OR before <> i - 1 GROUP BY 1),
tb AS (SELECT k, arg_max(b, (m, b)) AS top FROM (SELECT k, b, sum(m) AS m FROM cs WHERE class = 'foreign' GROUP BY 1, 2) GROUP BY 1),
sm AS (SELECT k, sum(m) AS facing, {", ".join(f"coalesce(sum(m) FILTER (class = '{c}'), 0) AS m_{c}" for c in ("open", "enc", "foreign", "same", "gap"))}, count(*) FILTER (class IN ('open', 'same')) AS entries, max(CASE WHEN class IN ('open', 'enc', 'same') THEN CASE WHEN r % 4 = 0 THEN 'state' ELSE 'county' END END) AS auth FROM cs GROUP BY 1),
ac AS (SELECT tg.*, coalesce(facing, 0) AS facing, {", ".join(f"coalesce(m_{c}, 0) AS m_{c}" for c in ("open", "enc", "foreign", "same", "gap"))}, coalesce(entries, 0) AS entries, coalesce(auth, '') AS auth, coalesce(runs, 0) AS runs, top, tg.r % 7 = 6 AS far_off, CASE WHEN tg.r % 7 <> 6 AND tg.y0 = tg.rt THEN w + 2 * 0.9144 ELSE 0 END AS contact, tg.k % 4 = 0 AS split FROM tg LEFT JOIN sm USING (k) LEFT JOIN rn USING (k) LEFT JOIN tb USING (k)),
ad AS (SELECT *, facing - m_gap AS known, m_open + m_enc < 6.096 AS land, CASE WHEN entries = 0 THEN 0 WHEN split THEN w * 30 ELSE w * h END AS reach, CASE WHEN split THEN w * (h - 30) ELSE w * h END AS u, w * 30 AS low, w * (h - 60) AS high, k % 17 = 0 AND (k // 17) % 2 = 1 AND NOT far_off AS strip FROM ac),
ae AS (SELECT *, coalesce(known > 0 AND m_foreign / nullif(known, 0) >= 0.95, false) AS blocked, CASE WHEN entries = 0 THEN 0 ELSE u END AS cross_m2, CASE WHEN entries = 0 THEN CASE WHEN split THEN 2 ELSE 1 END WHEN split THEN 1 ELSE 0 END AS islands,
  {r2(f"CASE WHEN entries = 0 THEN CASE WHEN split THEN {r2(f'low / {ACRE}')} + {r2(f'high / {ACRE}')} ELSE {r2(f'w * h / {ACRE}')} END WHEN split THEN {r2(f'high / {ACRE}')} ELSE 0 END")} AS island_acres FROM ad)"""


def _ft(m: str) -> str:
    return r2(f"({m}) / {FOOT}", 1)


@query(f"""{CTES}, {ACCESS_CTES} SELECT k, {_ft('facing')} AS facing_ft, {_ft('contact')} AS contact_ft, {_ft('m_open')} AS open_ft, {_ft('m_enc')} AS encumbered_ft, {_ft('m_foreign')} AS foreign_ft, {_ft('m_same')} AS same_ft, {_ft('m_gap')} AS gap_ft, CASE WHEN known > 0 THEN {r2('100 * (m_enc + m_foreign) / known', 1)} END AS blocked_pct, CASE WHEN known > 0 THEN {r2('100 * m_foreign / known', 1)} END AS foreign_pct,
far_off AS no_road, land AS landlocked, blocked, land AND m_same > 0 AS via_same, auth AS authorities, runs::INTEGER AS entry_runs, top AS blocker, CASE WHEN top LIKE 'S%' THEN CASE WHEN strip THEN 'DELTA CORP' END WHEN top IS NOT NULL THEN 'NAME' || substring(top, 2) END AS blocker_owner, strip AS reserve_strip,
{r2(f'reach / {ACRE}')} AS reachable, {r2(f'cross_m2 / {ACRE}')} AS with_crossings, islands::INTEGER AS islands, island_acres, {r2(f'greatest(0, cross_m2 / {ACRE} - reach / {ACRE})')} AS regained,
concat_ws(';', CASE WHEN land THEN 'landlocked_apparent_check_deeded_access' END, CASE WHEN land AND m_same > 0 THEN 'access_via_separately_deeded_same_owner_parcel' END, CASE WHEN blocked THEN 'frontage_blocked_confirm_ownership_and_deeded_access' END, CASE WHEN auth = 'state' THEN 'entrance_permit_sha_state_road' END, CASE WHEN facing > 0 AND m_gap > 0.5 * facing THEN 'frontage_indeterminate_row_gap' END, CASE WHEN strip THEN 'reserve_strip_foreign_owner' END,
  CASE WHEN islands > 0 AND cross_m2 / {ACRE} - reach / {ACRE} > 0.25 THEN 'islands_reconnectable_via_mde_crossing_permit' END, CASE WHEN u > 0 AND reach = 0 AND NOT land THEN 'usable_area_unreachable_from_frontage' END) AS flags FROM ae""")
def stage4_access(spark, sf_dir):
    """Stage 4 whole: pieces of the boundary, probes to the road and what they meet, classes, strips, islands, crossings, flags."""
    d = _stage4(spark, sf_dir)["parcels"]
    names = {"facing_ft": "road_facing_ft", "contact_ft": "row_contact_ft", "open_ft": "frontage_open_ft", "encumbered_ft": "frontage_encumbered_ft", "foreign_ft": "frontage_foreign_ft", "same_ft": "frontage_same_owner_ft", "gap_ft": "frontage_gap_ft", "blocked_pct": "frontage_blocked_pct", "foreign_pct": "frontage_foreign_pct", "no_road": "no_public_row_nearby", "landlocked": "landlocked_apparent", "blocked": "frontage_blocked_by_foreign_parcel", "via_same": "access_via_same_owner_parcel", "authorities": "frontage_authorities", "entry_runs": "entry_node_count", "blocker": "blocking_parcel_account_id", "blocker_owner": "blocking_parcel_owner", "reserve_strip": "reserve_strip_detected", "reachable": "reachable_usable_acres", "with_crossings": "reachable_if_crossings_permitted_acres", "islands": "unreachable_island_count", "island_acres": "unreachable_island_acres", "regained": "islands_reconnectable_by_permit_acres"}
    return d.select("k", *[F.col(c).alias(a) for a, c in names.items()], F.array_join("access_flags", ";").alias("flags"))


@query(f"""{CTES}, {ACCESS_CTES} SELECT k, class, outside, inside, b AS blocker, count(*)::BIGINT AS pieces, {r2('sum(m)', 3)} AS metres FROM (SELECT k, CASE class WHEN 'enc' THEN 'encumbered' WHEN 'foreign' THEN 'foreign_parcel' WHEN 'same' THEN 'same_owner_parcel' ELSE class END AS class, CASE outside WHEN 'foreign' THEN 'foreign_parcel' WHEN 'same' THEN 'same_owner_parcel' ELSE outside END AS outside, inside, b, m FROM cs) GROUP BY 1, 2, 3, 4, 5""")
def frontage_pieces(spark, sf_dir):
    """Number and length of the boundary's pieces by class, what lies outside and inside, and the parcel that a probe meets first."""
    d = _stage4(spark, sf_dir)["frontage"].withColumn("k", F.expr("cast(substring(account_id, 2) AS bigint)"))
    return d.groupBy("k", "class", "outside", F.col("inside_constraint").alias("inside"), F.col("blocking_account_id").alias("blocker")).agg(F.count("*").alias("pieces"), M.rounded(F.sum(K.length("geom")), 3).alias("metres"))


@query(f"{CTES}, {ACCESS_CTES} SELECT k, 'S' || k AS strip, CASE WHEN (k // 17) % 2 = 0 THEN 'NAME' || k ELSE 'DELTA CORP' END AS owner, (k // 17) % 2 = 0 AS same_owner, {_ft('coalesce(bm, 0)')} AS blocked_ft, {_ft('w + 2 * 0.9144')} AS shared_ft, {_ft('w * 15 / (w + 15)')} AS width_ft FROM ae LEFT JOIN (SELECT k, sum(m) AS bm FROM cs WHERE class = 'foreign' AND b = 'S' || k GROUP BY 1) USING (k) WHERE k % 17 = 0 AND NOT far_off")
def reserve_strips(spark, sf_dir):
    """Thin parcels between a target and a road: candidates from blockers and neighbours together."""
    d = _stage4(spark, sf_dir)["strips"]
    return d.select(F.expr("cast(substring(account_id, 2) AS bigint)").alias("k"), F.col("strip_account_id").alias("strip"), F.col("strip_owner").alias("owner"), "same_owner", F.col("frontage_ft_blocked").alias("blocked_ft"), F.col("shared_boundary_ft").alias("shared_ft"), F.col("est_width_ft").alias("width_ft"))


@query(f"""{CTES}, {ACCESS_CTES} SELECT count(*)::BIGINT AS scored_parcels, count(*) FILTER (land)::BIGINT AS landlocked_apparent, count(*) FILTER (blocked)::BIGINT AS frontage_blocked_by_foreign_parcel, count(*) FILTER (strip)::BIGINT AS reserve_strip_detected, count(*) FILTER (islands > 0)::BIGINT AS parcels_with_unreachable_islands,
count(*) FILTER ({r2(f'reach / {ACRE}')} < 40)::BIGINT AS largest_reachable_below_acreage_min, count(*) FILTER ({r2(f'reach / {ACRE}')} >= 40)::BIGINT AS largest_reachable_ge_acreage_min FROM ae""")
def access_totals(spark, sf_dir):
    return record.totals(_stage4(spark, sf_dir)["parcels"], _stage_config(), ("frontage",))


@query(f"""{CTES}, {ROLL_CTES}, us AS (SELECT *, pm2 - (l1 + l3 + l4 + l6 - l46) AS u FROM al) SELECT count(*)::BIGINT AS scored_parcels, count(*) FILTER (l1 > 0)::BIGINT AS parcels_with_hostile_easement, count(*) FILTER (l2 > 0)::BIGINT AS parcels_with_favorable_easement, count(*) FILTER (bis)::BIGINT AS parcels_bisected_by_hostile_constraint,
{r2(f"sum({r2(f'u / {ACRE}')})")} AS usable_acres_total, {r2(f"sum({r2(f'pm2 / {ACRE}')})")} AS gross_acres_total, count(*) FILTER ({r2(f'u / {ACRE}')} < 40)::BIGINT AS parcels_usable_below_acreage_min FROM us""")
def usable_totals(spark, sf_dir):
    p, enc = _stage2(spark, sf_dir)
    cfg = _stage_config()
    p = p.withColumn("gross_acres", M.rounded(M.acres(F.col("geom_m2")), 2))
    got = record.totals(usable.stage3(encumbrance.rolled_up(p, enc, cfg), enc, encumbrance.hostile(enc, None, cfg), cfg, False), cfg, ("encumbrances", "usable"))
    return got.withColumns({c: M.rounded(F.col(c), 2) for c in ("usable_acres_total", "gross_acres_total")})


# ---- single kernel operations ------------------------------------------------------
@query(f"{CTES} SELECT k, {r2('(x1 - x0) * (y1 - y0) + 2 * (x1 - x0 + y1 - y0) * 7 + 32 * 49 * sin(pi() / 32)', 3)} AS round_m2, {r2('(x1 - x0) * 2 * 9.0', 3)} AS flat_m2, {r2('2 * (x1 - x0 + y1 - y0)', 3)} AS edge_m, 2 AS parts, {r2('(x1 - x0) * (y1 - y0)', 3)} AS largest_m2, {r2('(y1 - y0) * 2', 3)} AS pieces_m2 FROM p")
def kernel_measures(spark, sf_dir):
    """Round and flat buffers, boundary, parts of a shape in two pieces, the largest of them."""
    p = parcels(spark, sf_dir)
    line = K.line(F.array("x0", "y0", "x1", "y0"))
    two = K.union_all(F.array(F.col("geom"), K.box(F.col("x1") + 5, F.col("y0"), F.col("x1") + 7, F.col("y1"))))
    parts = p.select("k", "geom", K.buffer("geom", 7.0).alias("b"), K.buffer(line, 9.0, flat=True).alias("f"), K.parts(two).alias("parts"))
    areas = F.transform("parts", lambda g: K.area(g))
    return parts.select("k", M.rounded(K.area("b"), 3).alias("round_m2"), M.rounded(K.area("f"), 3).alias("flat_m2"), M.rounded(K.length(K.boundary("geom")), 3).alias("edge_m"), F.size("parts").alias("parts"), M.rounded(F.array_max(areas), 3).alias("largest_m2"), M.rounded(F.array_min(areas), 3).alias("pieces_m2"))


@query("SELECT l_orderkey AS k, count(*) FILTER (before IS NULL OR before < n - 1)::INTEGER AS runs FROM (SELECT l_orderkey, n, lag(n) OVER (PARTITION BY l_orderkey ORDER BY n) AS before FROM (SELECT DISTINCT l_orderkey, l_linenumber AS n FROM lineitem WHERE l_partkey % 3 <> 0)) GROUP BY 1")
def line_runs(spark, sf_dir):
    """Runs of unit segments that touch end to end, by merging the lines."""
    K.register(spark)
    l = table(spark, sf_dir, "lineitem").where("l_partkey % 3 <> 0").select("l_orderkey", F.col("l_linenumber").cast("double").alias("n"))
    piece = K.line(F.array(F.col("n"), F.lit(0.0), F.col("n") + 1, F.lit(0.0)))
    return l.groupBy(F.col("l_orderkey").alias("k")).agg(K.line_runs(F.collect_list(piece)).alias("runs"))


def _conic(lon: str, lat: str) -> tuple[str, str]:
    """Easting and northing of EPSG:26985 in SQL: its public parameters on the GRS80 ellipsoid."""
    e = "sqrt(2 / 298.257222101 - 1 / (298.257222101 * 298.257222101))"
    t = lambda p: f"(tan(pi() / 4 - radians({p}) / 2) / pow((1 - {e} * sin(radians({p}))) / (1 + {e} * sin(radians({p}))), {e} / 2))"
    m = lambda p: f"(cos(radians({p})) / sqrt(1 - pow({e} * sin(radians({p})), 2)))"
    n = f"((ln({m('39.45')}) - ln({m('38.3')})) / (ln({t('39.45')}) - ln({t('38.3')})))"
    rho = lambda p: f"(6378137.0 * {m('39.45')} / ({n} * pow({t('39.45')}, {n})) * pow({t(p)}, {n}))"
    turn = f"({n} * radians({lon} + 77))"
    return f"(400000 + {rho(lat)} * sin({turn}))", f"({rho('(37.0 + 2.0 / 3.0)')} - {rho(lat)} * cos({turn}))"


LONLAT = "c_custkey AS k, (-77.9 + (c_custkey % 140) / 100.0)::DOUBLE AS lon, (38.9 + (c_custkey % 83) / 100.0)::DOUBLE AS lat"


@query(f"WITH g AS (SELECT {LONLAT} FROM customer) SELECT k, {r2(_conic('lon', 'lat')[0], 3)} AS x, {r2(_conic('lon', 'lat')[1], 3)} AS y, {r2('lon', 9)} AS lon, {r2('lat', 9)} AS lat FROM g")
def projection(spark, sf_dir):
    """Longitude and latitude to the working plane and back; the Mercator plane too."""
    K.register(spark)
    at = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), (F.lit(-77.9) + (F.col("c_custkey") % 140) / 100.0).alias("lon"), (F.lit(38.9) + (F.col("c_custkey") % 83) / 100.0).alias("lat"))
    radius = 6378137.0
    sphere = F.array(F.radians("lon") * radius, F.log(F.tan(F.lit(0.7853981633974483) + F.radians("lat") / 2)) * radius, F.radians(F.col("lon") + 0.1) * radius, F.log(F.tan(F.lit(0.7853981633974483) + F.radians("lat") / 2)) * radius)
    plane = at.select("k", K.reprojected(K.line(sphere), 3857).alias("m"), K.reprojected(K.line(F.array("lon", "lat", F.col("lon") + 0.1, "lat")), 4326).alias("g"))
    first = lambda g: K.shape(K.start_point(g))
    got = plane.select("k", first("g").alias("p"), first("m").alias("q"), K.shape(K.start_point(K.to_lonlat("g"))).alias("back"))
    return got.select("k", M.rounded((F.col("p.minx") + F.col("q.minx")) / 2, 3).alias("x"), M.rounded((F.col("p.miny") + F.col("q.miny")) / 2, 3).alias("y"), M.rounded(F.col("back.minx"), 9).alias("lon"), M.rounded(F.col("back.miny"), 9).alias("lat"))

