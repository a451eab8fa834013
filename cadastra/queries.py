"""The registered screening queries on the derived cadastre, each through the library's operators, and their DuckDB SQL on closed forms of boxes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cadastre import ACRE, ENC_SQL, PARCELS_SQL, ROADS_SQL, ZONES_SQL, encumbrances, parcels, roads, shaped, table, zones
from .config import Config, Zoning
from .functions import measures as M
from .functions import owners as O
from .kernel import functions as K
from .operators import slope as S
from .operators.spatial import grid_join
from .plans import access, base, record

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CTES = f"WITH p AS ({PARCELS_SQL}), e AS ({ENC_SQL}), z AS ({ZONES_SQL}), w AS ({ROADS_SQL})"
OVERLAP = "greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0))"
MEET = "{a}.x0 <= {b}.x1 AND {a}.x1 >= {b}.x0 AND {a}.y0 <= {b}.y1 AND {a}.y1 >= {b}.y0"
TYPE_SQL = "CASE WHEN o IS NULL OR o = '' THEN 'unknown' " + " ".join(f"WHEN regexp_matches(o, '\\b({w})\\b') THEN '{k}'" for k, w in O.TYPE_WORDS) + " ELSE 'individual' END"
CLEAN_OWNER = "trim(regexp_replace(translate(upper(owner_name), ',.', ' '), '\\s+', ' ', 'g'))"
NAME_SQL = f"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(upper(owner_name), '&', ' AND '), '[^\\w\\s/]', ' ', 'g'), '\\b({O.NOISE})\\b', ' ', 'g'), '\\bAND\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


def _address_sql(col: str) -> str:
    out = f"regexp_replace(upper({col}), '[^\\w\\s]', ' ', 'g')"
    for word, short in O.STREET:
        out = f"regexp_replace({out}, '\\b({word})\\b', '{short}', 'g')"
    return f"regexp_replace(trim(regexp_replace({out}, '\\s+', ' ', 'g')), '\\b(\\d{{5}})\\s?\\d{{4}}\\b', '\\1', 'g')"


ADDRESS_SQL = _address_sql("owner_mailing_address")


def r2(x: str, n: int = 2) -> str:
    return f"round_even(({x}) * {10**n}, 0) / {float(10**n)}"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---- owners ------------------------------------------------------------------
@query(f"{CTES} SELECT k, {TYPE_SQL} AS owner_type FROM (SELECT k, {CLEAN_OWNER} AS o FROM p)")
def owner_type(spark, sf_dir):
    return parcels(spark, sf_dir).select("k", O.owner_type("owner_name").alias("owner_type"))


@query(f"{CTES} SELECT k, {NAME_SQL} AS name, {ADDRESS_SQL} AS address, {NAME_SQL} || '|' || {ADDRESS_SQL} AS owner_key FROM p")
def owner_normalize(spark, sf_dir):
    return parcels(spark, sf_dir).select("k", O.normal_name("owner_name").alias("name"), O.normal_address("owner_mailing_address").alias("address"), O.owner_key("owner_name", "owner_mailing_address").alias("owner_key"))


@query(f"{CTES} SELECT owner_key, count(*)::BIGINT AS parcels FROM (SELECT {NAME_SQL} || '|' || {ADDRESS_SQL} AS owner_key FROM p) GROUP BY 1")
def owner_key_collapse(spark, sf_dir):
    return parcels(spark, sf_dir).groupBy(O.owner_key("owner_name", "owner_mailing_address").alias("owner_key")).agg(F.count("*").alias("parcels"))


@query(f"""{CTES}, t AS (SELECT k, x0, y0, x1, y1, list_distinct(list_filter(string_split({NAME_SQL}, ' '), lambda s: length(s) > 1)) AS t, {ADDRESS_SQL} AS a FROM p)
SELECT l.k AS k, r.k AS other, coalesce((len(l.t) > 0 AND len(r.t) > 0 AND (len(list_intersect(l.t, r.t)) / len(list_distinct(list_concat(l.t, r.t))) >= 0.6 OR (len(list_intersect(l.t, r.t)) > 0 AND (list_has_all(l.t, r.t) OR list_has_all(r.t, l.t))))) OR (l.a = r.a AND l.a <> ''), false) AS same_owner
FROM t l JOIN t r ON l.k <> r.k AND l.x0 <= r.x1 + 350 AND r.x0 <= l.x1 + 350 AND l.y0 <= r.y1 + 350 AND r.y0 <= l.y1 + 350 AND {{near}} <= 350""".replace("{near}", "sqrt(pow(greatest(0, greatest(l.x0 - r.x1, r.x0 - l.x1)), 2) + pow(greatest(0, greatest(l.y0 - r.y1, r.y0 - l.y1)), 2))"))
def owner_match_pairs(spark, sf_dir):
    """Neighbouring parcels, at most 350 m apart, and whether their owners plausibly are one: pairs grow with the parcels, not with their square."""
    p = parcels(spark, sf_dir).select("k", "geom", "box", O.name_tokens("owner_name").alias("t"), O.normal_address("owner_mailing_address").alias("a"))
    pairs = grid_join(p, p, 1000.0, within=350.0).where(F.col("l.k") != F.col("r.k"))
    return pairs.select(F.col("l.k").alias("k"), F.col("r.k").alias("other"), O.owners_match(F.col("l.t"), F.col("r.t"), F.col("l.a"), F.col("r.a")).alias("same_owner"))


# ---- accounts and acreage ------------------------------------------------------
def _accounts(spark, sf_dir):
    """Orders as rows of accounts; acreage by order key, some of it missing or no number."""
    text = F.when(F.col("o_orderkey") % 11 == 0, "n/a").when(F.col("o_custkey") % 3 == 0, F.col("o_orderkey").cast("string")).when(F.col("o_orderkey") % 7 != 0, (F.col("o_custkey") * 2 + 40).cast("string"))
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("account_id"), F.col("o_orderkey").alias("row"), "o_orderpriority", text.alias("acreage")).withColumn("acres", F.expr("try_cast(acreage AS double)"))


ACCOUNTS = """a AS (SELECT o_custkey AS account_id, o_orderkey AS row, o_orderpriority, TRY_CAST(CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' WHEN o_custkey % 3 = 0 THEN o_orderkey::VARCHAR WHEN o_orderkey % 7 <> 0 THEN (o_custkey * 2 + 40)::VARCHAR END AS DOUBLE) AS acres FROM orders)"""
DISSOLVED = f"{ACCOUNTS}, d AS (SELECT account_id, arg_min(acres, row) FILTER (acres IS NOT NULL) AS f, arg_min(o_orderpriority, row) AS first_priority, sum(acres) AS s, count(DISTINCT acres) AS kinds, count(*) AS n, ((account_id * 2 + 40) * (1 + account_id % 4)) * {ACRE} AS m2 FROM a GROUP BY 1)"


@query(f"WITH {DISSOLVED} SELECT account_id, f AS first_acres, first_priority, s AS sum_acres, kinds::BIGINT AS kinds, n::BIGINT AS n_rows FROM d")
def account_dissolve(spark, sf_dir):
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("row")))
    return _accounts(spark, sf_dir).groupBy("account_id").agg(first("acres").alias("first_acres"), first("o_orderpriority").alias("first_priority"), F.sum("acres").alias("sum_acres"), F.count_distinct("acres").alias("kinds"), F.count("*").alias("n_rows"))


@query(f"""WITH {DISSOLVED}, g AS (SELECT *, greatest(m2 / {ACRE}, 1e-6) AS g FROM d), q AS (SELECT *, n >= 2 AND kinds > 1 AS inconsistent FROM g)
SELECT account_id, inconsistent, n >= 2 AND NOT inconsistent AND coalesce(abs(s - g) / g < abs(f - g) / g AND abs(s - g) / g <= 0.1, false) AS summed,
CASE WHEN n >= 2 AND NOT inconsistent AND coalesce(abs(s - g) / g < abs(f - g) / g AND abs(s - g) / g <= 0.1, false) THEN s ELSE f END AS acreage_sdat FROM q""")
def acreage_reconcile(spark, sf_dir):
    d = account_dissolve(spark, sf_dir).select("account_id", F.col("first_acres").alias("_first"), F.col("sum_acres").alias("_sum"), F.col("kinds").alias("_kinds"), F.col("n_rows").alias("_rows"), ((F.col("account_id") * 2 + 40) * (1 + F.col("account_id") % 4) * ACRE).alias("geom_m2"))
    return base.reconcile(d, 10.0).select("account_id", F.col("sdat_acreage_inconsistent").alias("inconsistent"), F.col("sdat_acreage_summed").alias("summed"), "acreage_sdat")


def _config(**more) -> Config:
    ag = {"A": {"is_agricultural": True}, "RC": {"is_agricultural": None}, "R1": {"is_agricultural": False}}
    names = {"FRED": "Frederick", "CARR": "Carroll", "WASH": "Washington"}
    return Config(**{"counties": names, "schema": {}, "zoning": tuple(Zoning(c, "code", ag) for c in ("Frederick", "Carroll")), "on_unmapped_zoning": "flag"} | more)


def _with_acreage(spark, sf_dir):
    p = parcels(spark, sf_dir).withColumn("geom_m2", F.col("box.area"))
    g = F.col("geom_m2") / ACRE
    sdat = F.when(F.col("k") % 10 == 0, None).when(F.col("k") % 10 == 1, g * 1.25).when(F.col("k") % 10 == 2, 0.0).otherwise(g)
    return base.acreage(p.withColumns({"acreage_sdat": sdat, "sdat_acreage_inconsistent": F.col("k") % 23 == 0, "sdat_acreage_summed": F.col("k") % 29 == 0}), _config())


ACREAGE = f"""g AS (SELECT p.*, (x1 - x0) * (y1 - y0) AS m2, {r2(f'(x1 - x0) * (y1 - y0) / {ACRE}')} AS ga, CASE WHEN k % 23 = 0 OR k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN (x1 - x0) * (y1 - y0) / {ACRE} * 1.25 WHEN k % 10 = 2 THEN 0.0 ELSE (x1 - x0) * (y1 - y0) / {ACRE} END AS sd FROM p),
q AS (SELECT *, CASE WHEN sd > 0 THEN {r2('sd')} ELSE ga END AS gross, coalesce(sd > 0 AND abs(sd - ga) / greatest(ga, 0.01) * 100 > 10, false) AS off FROM g)"""


@query(f"{CTES}, {ACREAGE} SELECT k, ga AS gross_acres_geom, gross AS gross_acres, CASE WHEN sd > 0 THEN 'sdat' ELSE 'geometry' END AS acreage_basis, {r2('abs(sd - ga) / greatest(ga, 0.01) * 100', 1)} AS acreage_disagreement_pct, off AS acreage_disagrees, gross >= 40 AS meets_acreage FROM q")
def acreage_basis(spark, sf_dir):
    return _with_acreage(spark, sf_dir).select("k", "gross_acres_geom", "gross_acres", "acreage_basis", "acreage_disagreement_pct", "acreage_disagrees", "meets_acreage")


STUDY = (3000.0, 500.0, 20000.0, 9000.0)
_S = "(SELECT {}::DOUBLE AS x0, {}::DOUBLE AS y0, {}::DOUBLE AS x1, {}::DOUBLE AS y1)".format(*STUDY)


@query(f"""{CTES}, s AS (SELECT p.*, {OVERLAP.format(a='p', b='s')} AS m2, {r2(f"100 * {OVERLAP.format(a='p', b='s')} / ((p.x1 - p.x0) * (p.y1 - p.y0))", 1)} AS pct, (p.x0 + p.x1) / 2 > s.x0 AND (p.x0 + p.x1) / 2 < s.x1 AND (p.y0 + p.y1) / 2 > s.y0 AND (p.y0 + p.y1) / 2 < s.y1 AS c FROM p, {_S} s)
SELECT 'intersects' AS mode, k, pct FROM s WHERE m2 > 0 UNION ALL SELECT 'centroid', k, pct FROM s WHERE c UNION ALL SELECT 'within', k, pct FROM s WHERE pct >= 99.9""")
def study_area_select(spark, sf_dir):
    p = parcels(spark, sf_dir).withColumn("geom_m2", F.col("box.area"))
    out = [base.in_study_area(p, K.box_wkb(*STUDY), m).select(F.lit(m).alias("mode"), "k", F.col("in_study_area_pct").alias("pct")) for m in ("intersects", "centroid", "within")]
    return out[0].unionByName(out[1]).unionByName(out[2])


# ---- zoning and stage 1 ----------------------------------------------------------
def _stage1(spark, sf_dir):
    p = base.owners(base.counties(_with_acreage(spark, sf_dir), _config()))
    layer = zones(spark, sf_dir).select("code", "geom", F.col("z").cast("long").alias("_row"))
    return base.passed(base.zoning(p, {"Frederick": layer, "Carroll": layer}, _config()), _config())


ZONED = f"""{ACREAGE}, s AS (SELECT q.k, z.code, min(z.z) AS o, sum({OVERLAP.format(a='q', b='z')}) AS m2 FROM q JOIN z ON {MEET.format(a='q', b='z')} WHERE gross >= 40 AND county_code <> 'WASH' GROUP BY 1, 2),
c AS (SELECT k, arg_max(code, m2 - o / 1e6) AS zoning, {r2("100 * sum(CASE WHEN code = 'A' THEN m2 ELSE 0 END) / nullif(sum(m2), 0)", 1)} AS ag_pct,
string_agg(code || ':' || CAST(round_even(100 * m2 / t, 0) AS BIGINT)::VARCHAR || '%', ';' ORDER BY m2 DESC, o) AS codes FROM (SELECT *, sum(m2) OVER (PARTITION BY k) AS t FROM s) GROUP BY 1),
f AS (SELECT q.*, c.zoning, c.ag_pct, c.codes, CASE c.zoning WHEN 'A' THEN true WHEN 'R1' THEN false END AS ag, coalesce(c.zoning = 'RC', false) AS unmapped, gross >= 40 AND county_code = 'WASH' AS missing, gross >= 40 AND coalesce(CASE c.zoning WHEN 'A' THEN true WHEN 'R1' THEN false END, true) AS ok FROM q LEFT JOIN c USING (k))"""


@query(f"{CTES}, {ZONED} SELECT k, zoning, ag_pct AS zoning_ag_pct, codes AS zoning_codes_all, ag AS is_agricultural, unmapped AS zoning_unmapped, missing AS zoning_layer_missing FROM f")
def zoning_argmax(spark, sf_dir):
    return _stage1(spark, sf_dir).select("k", "zoning", "zoning_ag_pct", "zoning_codes_all", "is_agricultural", "zoning_unmapped", "zoning_layer_missing")


@query(f"""{CTES}, {ZONED} SELECT k, ok AS stage1_pass, CASE WHEN gross < 40 THEN 'below_acreage_min' WHEN NOT ag THEN 'not_agricultural_zoning' WHEN ag IS NULL THEN 'zoning_unknown_retained' ELSE 'pass' END AS reason,
concat_ws(';', CASE WHEN k % 23 = 0 THEN 'sdat_acreage_inconsistent_across_rows' END, CASE WHEN k % 29 = 0 THEN 'sdat_acreage_summed_across_rows' END, CASE WHEN off THEN 'sdat_acreage_disagrees_with_geometry' END, CASE WHEN unmapped THEN 'zoning_unmapped' END, CASE WHEN missing THEN 'zoning_layer_missing' END) AS flags FROM f""")
def stage1_pass_reason(spark, sf_dir):
    return _stage1(spark, sf_dir).select("k", "stage1_pass", F.col("stage1_pass_reason").alias("reason"), F.array_join("manual_flags", ";").alias("flags"))


@query(f"""{CTES}, {ZONED} SELECT CASE county_code WHEN 'FRED' THEN 'Frederick' WHEN 'CARR' THEN 'Carroll' ELSE 'Washington' END AS county, count(*)::BIGINT AS in_study_area, count(*) FILTER (gross >= 40)::BIGINT AS meets_acreage, count(*) FILTER (gross >= 40 AND ag)::BIGINT AS meets_acreage_and_ag_zoned,
count(*) FILTER (gross >= 40 AND ag IS NULL)::BIGINT AS meets_acreage_zoning_unknown, count(*) FILTER (ok)::BIGINT AS stage1_pass, {r2('median(gross) FILTER (ok)', 3)} AS median_acres_passing, {r2('sum(gross) FILTER (ok)')} AS acres_passing_total FROM f GROUP BY county_code""")
def stage1_county_summary(spark, sf_dir):
    s = base.county_summary(_stage1(spark, sf_dir))
    return s.withColumns({"median_acres_passing": M.rounded(F.col("median_acres_passing"), 3), "acres_passing_total": M.rounded(F.col("acres_passing_total"), 2)})


@query(f"{CTES}, {ZONED} SELECT county_code, {TYPE_SQL} AS owner_type, count(*)::BIGINT AS n FROM (SELECT county_code, {CLEAN_OWNER} AS o FROM f WHERE ok) GROUP BY 1, 2")
def owner_type_counts(spark, sf_dir):
    return _stage1(spark, sf_dir).where("stage1_pass").groupBy("county_code", "owner_type").agg(F.count("*").alias("n"))


# ---- encumbrances ----------------------------------------------------------------
def _pairs(spark, sf_dir):
    got = grid_join(parcels(spark, sf_dir).select("k", "geom", "box"), encumbrances(spark, sf_dir).select("e", "layer", "geom", "box"), 700.0, overlay=True, spread=True)
    return got.select(F.col("l.k").alias("k"), F.col("r.e").alias("e"), F.col("r.layer").alias("layer"), F.col("l.geom").alias("parcel"), F.col("l.box").alias("pbox"), F.col("o.geom").alias("part"), F.col("o.m2").alias("m2"))


ENCP = f"x AS (SELECT p.k, e.e, e.layer, {OVERLAP.format(a='p', b='e')} AS m2, (p.x1 - p.x0) * (p.y1 - p.y0) AS pm2, greatest(p.x0, e.x0) AS ix0, least(p.x1, e.x1) AS ix1, greatest(p.y0, e.y0) AS iy0, least(p.y1, e.y1) AS iy1, p.x0 AS px0, p.x1 AS px1, p.y0 AS py0, p.y1 AS py1 FROM p JOIN e ON {MEET.format(a='p', b='e')})"


@query(f"{CTES}, {ENCP} SELECT k, e, layer, {r2(f'm2 / {ACRE}')} AS acres, {r2('100 * m2 / pm2', 1)} AS pct FROM x WHERE m2 >= 10")
def encumbrance_rows(spark, sf_dir):
    rows = _pairs(spark, sf_dir).where("m2 >= 10")
    return rows.select("k", "e", "layer", M.rounded(M.acres(F.col("m2")), 2).alias("acres"), M.rounded(100 * F.col("m2") / F.col("pbox.area"), 1).alias("pct"))


@query(f"""{CTES}, {ENCP}, d AS (SELECT *, (ix0 + ix1 - px0 - px1) / 2 AS dx, (iy0 + iy1 - py0 - py1) / 2 AS dy FROM x WHERE m2 >= 10)
SELECT k, e, {r2('100 * sqrt(dx * dx + dy * dy) / sqrt(pm2 / pi())', 1)} AS centroid_offset_pct,
CASE WHEN 100 * sqrt(dx * dx + dy * dy) / sqrt(pm2 / pi()) < 25 THEN 'center' ELSE ['E', 'NE', 'N', 'NW', 'W', 'SW', 'S', 'SE'][1 + CAST(floor(((degrees(atan2(dy, dx)) + 360 + 22.5) % 360) / 45) AS INTEGER)] END AS position FROM d""")
def relative_position(spark, sf_dir):
    rows = _pairs(spark, sf_dir).withColumn("s", K.shape("part")).where("s.area >= 10")
    dx, dy = F.col("s.cx") - F.col("pbox.cx"), F.col("s.cy") - F.col("pbox.cy")
    return rows.select("k", "e", M.rounded(M.offset_pct(dx, dy, F.col("pbox.area")), 1).alias("centroid_offset_pct"), M.position(dx, dy, F.col("pbox.area")).alias("position"))


@query(f"{CTES}, {ENCP}, a AS (SELECT k, layer, {r2(f'm2 / {ACRE}')} AS acres FROM x WHERE m2 >= 10) SELECT k, " + ", ".join(f"{r2(f'coalesce(sum(acres) FILTER (layer = {chr(39)}{d}{chr(39)}), 0)')} AS enc_{d}_acres" for d in "12345") + " FROM a GROUP BY k")
def encumbrance_pivot(spark, sf_dir):
    wide = encumbrance_rows(spark, sf_dir).groupBy("k").pivot("layer", list("12345")).agg(F.sum("acres")).fillna(0.0)
    return wide.select("k", *[M.rounded(F.col(d), 2).alias(f"enc_{d}_acres") for d in "12345"])


@query(f"{CTES}, {ENCP} SELECT k, layer, count(*)::BIGINT AS feature_count, string_agg(DISTINCT 'E' || (e % 50)::VARCHAR, '; ' ORDER BY 'E' || (e % 50)::VARCHAR) AS feature_names FROM x GROUP BY 1, 2")
def feature_names(spark, sf_dir):
    name = F.concat(F.lit("E"), (F.col("e") % 50).cast("string"))
    return _pairs(spark, sf_dir).groupBy("k", "layer").agg(F.count("*").alias("feature_count"), F.array_join(F.sort_array(F.collect_set(name)), "; ").alias("feature_names"))


SLABS = f"""{ENCP}, h AS (SELECT *, layer IN ('1', '2') AS hostile FROM x WHERE m2 > 0),
xs AS (SELECT k, v AS a, lead(v) OVER (PARTITION BY k ORDER BY v) AS b FROM (SELECT k, ix0 AS v FROM h UNION SELECT k, ix1 FROM h)),
ys AS (SELECT k, v AS a, lead(v) OVER (PARTITION BY k ORDER BY v) AS b FROM (SELECT k, iy0 AS v FROM h UNION SELECT k, iy1 FROM h)),
cells AS (SELECT xs.k, (xs.b - xs.a) * (ys.b - ys.a) AS m2, EXISTS (SELECT 1 FROM h WHERE h.k = xs.k AND h.hostile AND h.ix0 <= xs.a AND h.ix1 >= xs.b AND h.iy0 <= ys.a AND h.iy1 >= ys.b) AS in_h, EXISTS (SELECT 1 FROM h WHERE h.k = xs.k AND h.ix0 <= xs.a AND h.ix1 >= xs.b AND h.iy0 <= ys.a AND h.iy1 >= ys.b) AS in_any FROM xs JOIN ys ON xs.k = ys.k WHERE xs.b IS NOT NULL AND ys.b IS NOT NULL),
u AS (SELECT k, sum(m2) FILTER (in_h) AS hm2, sum(m2) FILTER (in_any) AS am2 FROM cells GROUP BY k)"""


@query(f"{CTES}, {SLABS} SELECT k, {r2(f'coalesce(hm2, 0) / {ACRE}')} AS hostile_acres, {r2(f'coalesce(am2, 0) / {ACRE}')} AS all_acres FROM u")
def union_area_by_implication(spark, sf_dir):
    """Every part is united once, with those of its kind; the whole is made of the two unions."""
    kinds = _pairs(spark, sf_dir).where("m2 > 0").groupBy("k", F.col("layer").isin("1", "2").alias("hostile")).agg(K.union_agg("part").alias("u"))
    by = kinds.groupBy("k").agg(K.union_agg(F.when(F.col("hostile"), F.col("u"))).alias("h"), K.union_agg("u").alias("a"))
    return by.select("k", M.rounded(M.acres(K.area("h")), 2).alias("hostile_acres"), M.rounded(M.acres(K.area("a")), 2).alias("all_acres"))


@query(f"{CTES}, {SLABS} SELECT p.k, {r2(f'((x1 - x0) * (y1 - y0) - coalesce(hm2, 0)) / {ACRE}')} AS usable_acres, {r2('100 * ((x1 - x0) * (y1 - y0) - coalesce(hm2, 0)) / ((x1 - x0) * (y1 - y0))', 1)} AS usable_pct FROM p LEFT JOIN u USING (k)")
def usable_area(spark, sf_dir):
    hostile = _pairs(spark, sf_dir).where(F.col("layer").isin("1", "2") & (F.col("m2") > 0)).groupBy("k").agg(K.union_agg("part").alias("h"))
    p = parcels(spark, sf_dir).join(hostile, "k", "left").withColumn("m2", F.when(F.col("h").isNull(), F.col("box.area")).otherwise(K.area(K.areal_difference("geom", "h"))))
    return p.select("k", M.rounded(M.acres(F.col("m2")), 2).alias("usable_acres"), M.rounded(100 * F.col("m2") / F.col("box.area"), 1).alias("usable_pct"))


@query(f"{CTES}, {ENCP}, b AS (SELECT DISTINCT k, layer FROM x WHERE m2 >= 10 AND ((ix0 = px0 AND ix1 = px1 AND iy0 > py0 AND iy1 < py1) OR (iy0 = py0 AND iy1 = py1 AND ix0 > px0 AND ix1 < px1))) SELECT k, string_agg(layer, ';' ORDER BY layer) AS bisecting FROM b GROUP BY k")
def bisecting_types(spark, sf_dir):
    rows = _pairs(spark, sf_dir).where("m2 >= 10").withColumn("pos", K.relative_position("parcel", "part", 1e-6))
    return rows.where("pos.pieces >= 2").groupBy("k").agg(F.array_join(F.sort_array(F.collect_set("layer")), ";").alias("bisecting"))


# ---- slope -------------------------------------------------------------------------
def _cells(spark, sf_dir):
    """Ten-metre cells from all order keys, a hundred to a column: integer polynomials of row and column, so that differences are exact."""
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 100).cast("int").alias("row"), F.expr("o_orderkey div 100").cast("int").alias("col"))
    c, r = F.col("col") % 20, F.col("row") % 20
    return o.withColumn("z", ((c * c + 3 * r * r) / 8.0).cast("double"))


CELLS = "c AS (SELECT r, c, ((c % 20) * (c % 20) + 3 * (r % 20) * (r % 20)) / 8.0::DOUBLE AS z FROM (SELECT o_orderkey % 100 AS r, o_orderkey // 100 AS c FROM orders))"
GRAD = "coalesce((lead(z) OVER {w} - lag(z) OVER {w}) / 20, (lead(z) OVER {w} - z) / 10, (z - lag(z) OVER {w}) / 10)"


@query(f"WITH {CELLS}, g AS (SELECT r, c, {GRAD.format(w='(PARTITION BY r ORDER BY c)')} AS gx, {GRAD.format(w='(PARTITION BY c ORDER BY r)')} AS gy FROM c) SELECT r::INTEGER AS row, c::INTEGER AS col, {r2('100 * sqrt(gx * gx + gy * gy)', 6)} AS slope FROM g")
def slope_percent(spark, sf_dir):
    return S.slope_percent(_cells(spark, sf_dir), S.Grid(0.0, 1000.0, 10.0, 10.0)).select("row", "col", M.rounded(F.col("slope"), 6).alias("slope"))


@query(f"{CTES}, {CELLS}, g AS (SELECT r, c, {GRAD.format(w='(PARTITION BY r ORDER BY c)')} AS gx, {GRAD.format(w='(PARTITION BY c ORDER BY r)')} AS gy FROM c), s AS (SELECT 10.0 * c AS x0, 1000.0 - 10 * (r + 1) AS y0, 10.0 * (c + 1) AS x1, 1000.0 - 10 * r AS y1 FROM g WHERE 100 * sqrt(gx * gx + gy * gy) > 60) SELECT k, sum({OVERLAP.format(a='p', b='s')}) AS steep_m2 FROM p JOIN s ON {MEET.format(a='p', b='s')} GROUP BY k HAVING sum({OVERLAP.format(a='p', b='s')}) > 0")
def steep_area_by_parcel(spark, sf_dir):
    from .plans.usable import steep_parts

    grid = S.Grid(0.0, 1000.0, 10.0, 10.0)
    p = parcels(spark, sf_dir).withColumn("account_id", F.col("k"))
    steep = S.steep_boxes(S.slope_percent(_cells(spark, sf_dir), grid), grid, 60.0)
    return steep_parts(p, steep).select(F.col("account_id").alias("k"), M.rounded(K.area("geom"), 6).alias("steep_m2"))


# ---- access -------------------------------------------------------------------------
DIST = "sqrt(pow(greatest(0, greatest({a}.x0 - {b}.x1, {b}.x0 - {a}.x1)), 2) + pow(greatest(0, greatest({a}.y0 - {b}.y1, {b}.y0 - {a}.y1)), 2))"


@query(f"{CTES} SELECT p.k, w.r, {r2(f'({DIST.format(a=chr(112), b=chr(119))}) / 0.3048', 1)} AS distance_ft FROM p JOIN w ON {DIST.format(a='p', b='w')} <= 76.2 AND w.public")
def row_distance_join(spark, sf_dir):
    got = grid_join(parcels(spark, sf_dir).select("k", "geom", "box"), roads(spark, sf_dir).where("public").select("r", "geom", "box"), 2000.0, within=76.2)
    return got.select(F.col("l.k").alias("k"), F.col("r.r").alias("r"), M.rounded(M.feet(K.distance(F.col("l.geom"), F.col("r.geom"))), 1).alias("distance_ft"))


@query(f"{CTES}, n AS (SELECT p.k, w.r, w.authority, {DIST.format(a='p', b='w')} AS d FROM p JOIN w ON {DIST.format(a='p', b='w')} <= 700) SELECT k, authority, r FROM n QUALIFY row_number() OVER (PARTITION BY k ORDER BY d, r) = 1")
def nearest_authority(spark, sf_dir):
    got = grid_join(parcels(spark, sf_dir).select("k", "geom", "box"), roads(spark, sf_dir).select("r", "authority", "geom", "box"), 2000.0, within=700.0)
    near = F.struct(K.distance(F.col("l.geom"), F.col("r.geom")).alias("d"), F.col("r.r").alias("r"))
    return got.groupBy(F.col("l.k").alias("k")).agg(F.min_by("r.authority", near).alias("authority"), F.min(near)["r"].alias("r"))


@query(f"{CTES} SELECT k, CASE WHEN y0 = 700 * (k // 40) + 18 THEN x1 - x0 ELSE 0 END AS contact_m FROM p")
def row_contact(spark, sf_dir):
    """Length of the boundary that touches the road below."""
    p, w = parcels(spark, sf_dir).select("k", "geom", "box"), roads(spark, sf_dir).select("r", "geom", "box")
    touch = grid_join(p, w, 2000.0).groupBy(F.col("l.k").alias("k")).agg(F.sum(K.overlap_length(K.boundary(F.col("l.geom")), F.col("r.geom"))).alias("m"))
    return p.select("k").join(touch, "k", "left").select("k", F.coalesce(M.rounded(F.col("m"), 6), F.lit(0.0)).alias("contact_m"))


STRIPS = "s AS (SELECT k, x0, CAST(700 * (k // 40) + 18 AS DOUBLE) AS y0, x1, y0 AS y1, 15.0 AS h FROM p WHERE y0 > 700 * (k // 40) + 18), m AS (SELECT *, (x1 - x0) * 15.0 AS a, 2 * (x1 - x0 + 15.0) AS pe FROM s)"


def _strips(spark, sf_dir):
    """The ground between a parcel and its road, wherever there is some."""
    road = F.expr("k div 40") * 700.0 + 18
    return shaped(parcels(spark, sf_dir).where(F.col("y0") > road).select("k", "x0", road.alias("y0"), "x1", F.col("y0").alias("y1")))


@query(f"{CTES}, {STRIPS}, b AS (SELECT k, x1 - x0 AS w0, y1 - y0 AS h0 FROM p UNION ALL SELECT -1 - k, x1 - x0, 15.0 FROM s), c AS (SELECT k, w0 * h0 AS a, 2 * (w0 + h0) AS pe FROM b), q AS (SELECT k, {r2('2 * a / pe / 0.3048', 1)} AS est_width_ft, {r2('a / (2 * a / pe) / 0.3048', 1)} AS est_length_ft, {r2('a / (2 * a / pe) / (2 * a / pe)', 1)} AS aspect_ratio FROM c) SELECT *, est_width_ft > 0 AND est_width_ft <= 100 AND aspect_ratio >= 6 AS is_strip FROM q")
def strip_metrics(spark, sf_dir):
    both = parcels(spark, sf_dir).select("k", "box").unionByName(_strips(spark, sf_dir).select((-1 - F.col("k")).alias("k"), "box"))
    got = both.select("k", M.strip_metrics(F.col("box.area"), F.col("box.length")).alias("m"))
    return got.select("k", "m.est_width_ft", "m.est_length_ft", F.col("m.aspect").alias("aspect_ratio"), M.is_strip(F.col("m")).alias("is_strip"))


@query(f"{CTES}, {STRIPS} SELECT p.k, s.k AS strip, {r2('(p.x1 - p.x0) / 0.3048', 1)} AS shared_ft FROM p JOIN s ON p.k = s.k")
def adjacent_strips(spark, sf_dir):
    """Strips within three feet of a parcel that share a quarter of their length with it, and stand at a road (a semi join)."""
    p, s = parcels(spark, sf_dir).select("k", "geom", "box"), _strips(spark, sf_dir).select("k", "geom", "box")
    at_road = grid_join(s, roads(spark, sf_dir).select("r", "geom", "box"), 2000.0, within=0.9144).select(F.col("l.k").alias("k")).distinct()
    got = grid_join(p, s.join(at_road, "k", "left_semi"), 700.0, within=0.9144)
    got = got.select(F.col("l.k").alias("k"), F.col("r.k").alias("strip"), F.col("r.box.area").alias("a"), F.col("r.box.length").alias("pe"), K.overlap_length(K.boundary(F.col("l.geom")), K.boundary(F.col("r.geom"))).alias("m"))
    return got.where(F.col("m") >= 0.25 * F.col("pe") / 2).select("k", "strip", M.rounded(M.feet(F.col("m")), 1).alias("shared_ft"))


PIECES = "t AS (SELECT l_orderkey AS k, l_linenumber AS seq, l_quantity AS len, CASE l_suppkey % 4 WHEN 0 THEN 'foreign_parcel' WHEN 1 THEN 'row' WHEN 2 THEN 'same_owner_parcel' ELSE 'gap' END AS outside, CASE WHEN l_partkey % 5 = 0 THEN 'wetlands' END AS inside, l_suppkey AS blocker, CASE WHEN l_partkey % 3 = 0 THEN 'state' ELSE 'county' END AS authority FROM lineitem), f AS (SELECT *, CASE WHEN outside = 'foreign_parcel' THEN outside WHEN inside IS NOT NULL THEN 'encumbered' WHEN outside = 'row' THEN 'open' WHEN outside = 'same_owner_parcel' THEN outside ELSE 'gap' END AS class FROM t)"


def _pieces(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    kind = F.element_at(F.array(*map(F.lit, ("foreign_parcel", "row", "same_owner_parcel", "gap"))), (F.col("l_suppkey") % 4 + 1).cast("int"))
    t = l.select(F.col("l_orderkey").alias("account_id"), F.col("l_linenumber").alias("seq"), F.col("l_quantity").alias("length"), kind.alias("outside"), F.when(F.col("l_partkey") % 5 == 0, "wetlands").alias("inside_constraint"), F.col("l_suppkey").alias("blocking_account_id"), F.when(F.col("l_partkey") % 3 == 0, "state").otherwise("county").alias("authority"))
    t = t.withColumn("class", M.frontage_class(F.col("outside"), F.col("inside_constraint")))
    return t.withColumn("is_entry", F.col("class").isin("open", "same_owner_parcel")).withColumn("piece", F.lit(None).cast("binary"))


@query(f"WITH {PIECES} SELECT k AS account_id, sum(len) AS facing, " + ", ".join(f"coalesce(sum(len) FILTER (class = '{c}'), 0) AS m_{c}" for c in M.FRONTAGE_CLASSES) + ", coalesce(string_agg(DISTINCT authority, ';' ORDER BY authority) FILTER (class IN ('open', 'encumbered', 'same_owner_parcel')), '') AS authorities FROM f GROUP BY k")
def frontage_class_lengths(spark, sf_dir):
    K.register(spark)
    return access.classed(_pieces(spark, sf_dir)).withColumn("authorities", F.array_join("authorities", ";")).drop("entry_node_count")


@query(f"WITH {PIECES}, b AS (SELECT k, blocker, sum(len) AS m FROM f WHERE class = 'foreign_parcel' GROUP BY 1, 2) SELECT k AS account_id, arg_max(blocker, m + blocker / 1e9) AS top_blocker, string_agg(blocker::VARCHAR || ':' || ({r2('m / 0.3048', 1)})::VARCHAR, ';' ORDER BY m DESC, blocker) AS blockers FROM b GROUP BY k")
def blocking_topk(spark, sf_dir):
    owners = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("account_id"), F.col("s_name").alias("owner_name"))
    got = access.blocking(_pieces(spark, sf_dir), owners)
    listed = F.from_json("blocking_parcels_json", "array<struct<account_id:long,frontage_ft:double>>")
    return got.select("account_id", F.col("blocking_parcel_account_id").alias("top_blocker"), F.array_join(F.transform(listed, lambda x: F.concat(x["account_id"].cast("string"), F.lit(":"), x["frontage_ft"].cast("string"))), ";").alias("blockers"))


@query(f"WITH {PIECES}, s AS (SELECT k, sum(len) AS facing, coalesce(sum(len) FILTER (class = 'gap'), 0) AS gap, coalesce(sum(len) FILTER (class IN ('open', 'encumbered')), 0) AS direct, coalesce(sum(len) FILTER (class = 'foreign_parcel'), 0) AS fp, coalesce(sum(len) FILTER (class = 'encumbered'), 0) AS en FROM f GROUP BY k) SELECT k AS account_id, direct < 6.096 AS landlocked, CASE WHEN facing - gap > 0 THEN {r2('100 * (en + fp) / (facing - gap)', 1)} END AS blocked_pct, facing - gap > 0 AND fp / nullif(facing - gap, 0) >= 0.95 AS blocked, concat_ws(';', CASE WHEN direct < 6.096 THEN 'landlocked_apparent_check_deeded_access' END, CASE WHEN facing - gap > 0 AND fp / nullif(facing - gap, 0) >= 0.95 THEN 'frontage_blocked_confirm_ownership_and_deeded_access' END, CASE WHEN gap > 0.5 * facing THEN 'frontage_indeterminate_row_gap' END) AS flags FROM s")
def landlocked_flags(spark, sf_dir):
    K.register(spark)
    c = access.classed(_pieces(spark, sf_dir))
    known = F.col("facing") - F.col("m_gap")
    land, blocked = F.col("m_open") + F.col("m_encumbered") < 20 * M.FOOT_M, (known > 0) & F.coalesce(F.col("m_foreign_parcel") / F.nullif(known, F.lit(0.0)) >= 0.95, F.lit(False))
    flags = M.flags_of((land, "landlocked_apparent_check_deeded_access"), (blocked, "frontage_blocked_confirm_ownership_and_deeded_access"), (F.col("m_gap") > 0.5 * F.col("facing"), "frontage_indeterminate_row_gap"))
    return c.select("account_id", land.alias("landlocked"), F.when(known > 0, M.rounded(100 * (F.col("m_encumbered") + F.col("m_foreign_parcel")) / known, 1)).alias("blocked_pct"), blocked.alias("blocked"), F.array_join(flags, ";").alias("flags"))


@query(f"WITH {PIECES}, r AS (SELECT k, seq, class IN ('open', 'same_owner_parcel') AS en, seq - row_number() OVER (PARTITION BY k, class IN ('open', 'same_owner_parcel') ORDER BY seq) AS run FROM f), c AS (SELECT k, count(DISTINCT run) FILTER (en) AS runs, bool_or(en AND seq = 1) AND bool_or(en AND seq = m) AND NOT bool_and(en) AS closes FROM (SELECT *, max(seq) OVER (PARTITION BY k) AS m FROM r) GROUP BY k) SELECT k AS account_id, (runs - CASE WHEN closes AND runs > 1 THEN 1 ELSE 0 END)::BIGINT AS entry_runs FROM c")
def entry_runs(spark, sf_dir):
    """Runs of entry pieces around a closed boundary: neighbours by number, the last beside the first."""
    t = _pieces(spark, sf_dir).select("account_id", "seq", "is_entry")
    # a million pieces to a task, so that its memory doesn't grow with the table
    t = t.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-t.count() // 1_000_000)), "account_id")
    at = F.sort_array(F.collect_list(F.when(F.col("is_entry"), F.col("seq"))))
    c = t.groupBy("account_id").agg(at.alias("at"), F.max("seq").alias("m"), F.bool_and("is_entry").alias("whole"))
    # neighbours by number have the same difference of number and place
    runs = F.size(F.array_distinct(F.transform("at", lambda x, i: x - i)))
    c = c.select("account_id", runs.cast("long").alias("runs"), (F.array_contains("at", 1) & F.array_contains("at", F.col("m")) & ~F.col("whole")).alias("closes"))
    return c.select("account_id", (F.col("runs") - F.when(F.col("closes") & (F.col("runs") > 1), 1).otherwise(0)).alias("entry_runs"))


PARTS = f"{ENCP}, i AS (SELECT k, e AS part, m2, m2 < {0.25 * ACRE} AS sliver, e % 3 = 0 AND m2 >= {0.25 * ACRE} AS reached FROM x WHERE m2 > 0)"


def _parts(spark, sf_dir):
    p = _pairs(spark, sf_dir).select(F.col("k").alias("account_id"), F.col("e").alias("part"), "m2").where("m2 > 0")
    sliver = F.col("m2") < 0.25 * ACRE
    return p.withColumn("sliver", sliver).withColumn("reached", (F.col("part") % 3 == 0) & ~sliver)


@query(f"{CTES}, {PARTS} SELECT k AS account_id, row_number() OVER (PARTITION BY k ORDER BY m2 DESC, part)::INTEGER AS island_rank, {r2(f'm2 / {ACRE}')} AS acres FROM i WHERE NOT sliver AND NOT reached")
def islands_ranked(spark, sf_dir):
    return access.islands(_parts(spark, sf_dir))


@query(f"{CTES}, {PARTS} SELECT k AS account_id, {r2(f'coalesce(sum(m2) FILTER (reached), 0) / {ACRE}')} AS reachable, {r2(f'coalesce(max(m2) FILTER (reached), 0) / {ACRE}')} AS largest, {r2(f'coalesce(sum(m2) FILTER (sliver), 0) / {ACRE}')} AS sliver, count(*) FILTER (NOT sliver AND NOT reached)::BIGINT AS islands FROM i GROUP BY k")
def reachable_blocks(spark, sf_dir):
    r, ac = access.reach(_parts(spark, sf_dir)), lambda c: M.rounded(M.acres(F.col(c)), 2)
    return r.select("account_id", ac("reach_m2").alias("reachable"), ac("largest_m2").alias("largest"), ac("sliver_m2").alias("sliver"), F.col("n_islands").alias("islands"))


# ---- record, sets, scalars ----------------------------------------------------------
FLAGGED = "SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN ['a', 'b'] ELSE [] END AS manual, CASE WHEN c_custkey % 3 = 0 THEN ['b', 'c'] END AS enc, CASE c_custkey % 4 WHEN 0 THEN '[\"c\",\"d\"]' WHEN 1 THEN 'plain' END AS acc FROM customer"


@query(f"WITH f AS ({FLAGGED}) SELECT k, concat_ws(';', CASE WHEN k % 2 = 0 THEN 'a;b' END, CASE WHEN k % 3 = 0 THEN CASE WHEN k % 2 = 0 THEN 'c' ELSE 'b;c' END END, CASE k % 4 WHEN 0 THEN CASE WHEN k % 3 = 0 THEN 'd' ELSE 'c;d' END WHEN 1 THEN 'plain' END) AS flags FROM f")
def flags_merge(spark, sf_dir):
    k = F.col("c_custkey")
    df = table(spark, sf_dir, "customer").select(k.alias("k"), F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("manual_flags"), F.when(k % 3 == 0, F.array(F.lit("b"), F.lit("c"))).alias("encumbrance_flags"), F.when(k % 4 == 0, '["c","d"]').when(k % 4 == 1, "plain").alias("access_flags"), F.lit(None).cast("binary").alias("geom"))
    return record.record(df).select("k", F.array_join("manual_verification_flags", ";").alias("flags"))


@query("SELECT c.c_custkey AS k, c.c_name AS name, s.total AS total, s.total IS NOT NULL AS scored FROM customer c LEFT JOIN (SELECT o_custkey, sum(o_orderkey)::BIGINT AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) s ON c.c_custkey = s.o_custkey")
def left_join_back(spark, sf_dir):
    s = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.sum("o_orderkey").alias("total"))
    c = table(spark, sf_dir, "customer")
    return c.join(s, c["c_custkey"] == s["o_custkey"], "left").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), "total", F.col("total").isNotNull().alias("scored"))


@query("SELECT n_nationkey AS code FROM nation WHERE NOT EXISTS (SELECT 1 FROM vendors WHERE nation_id = n_nationkey)")
def county_unknown_anti(spark, sf_dir):
    """Nations without a vendor."""
    used = table(spark, sf_dir, "vendors").select(F.col("nation_id").alias("n_nationkey"))
    return table(spark, sf_dir, "nation").join(used, "n_nationkey", "left_anti").select(F.col("n_nationkey").alias("code"))


@query("SELECT DISTINCT substring(o_orderpriority, 1, 1) AS code FROM orders EXCEPT SELECT '3'")
def code_set_difference(spark, sf_dir):
    codes = table(spark, sf_dir, "orders").select(F.substring("o_orderpriority", 1, 1).alias("code"))
    return codes.subtract(spark.sql("SELECT '3' AS code"))


@query("SELECT 'customer' AS layer, true AS public, c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT 'supplier', false, s_suppkey, s_name FROM supplier")
def layers_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("layer"), F.lit(True).alias("public"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return c.unionByName(table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("layer"), F.lit(False).alias("public"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")))


@query("SELECT DISTINCT o_orderpriority AS code FROM orders WHERE o_orderpriority IS NOT NULL")
def domain_distinct(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("code")).where("code IS NOT NULL").distinct()


@query("SELECT o_custkey AS k, '[' || string_agg('{\"o\":' || o_orderkey || ',\"s\":\"' || o_orderstatus || '\"}', ',' ORDER BY o_orderkey) || ']' AS json FROM orders GROUP BY o_custkey")
def json_record(spark, sf_dir):
    one = F.struct(F.col("o_orderkey").alias("o"), F.col("o_orderstatus").alias("s"))
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.to_json(F.sort_array(F.collect_list(one))).alias("json"))


@query(f"SELECT p_partkey AS k, {r2(f'p_size * 100 / {ACRE}', 6)} AS acres, {r2(f'p_size::DOUBLE * {ACRE}::DOUBLE', 6)} AS m2, {r2('p_size / 0.3048', 6)} AS feet, {r2('p_size * 0.3048', 6)} AS ft_m, {r2('p_size / 0.9144', 6)} AS yards, {r2('p_size * 0.9144', 6)} AS yd_m FROM part")
def unit_conversions(spark, sf_dir):
    s = F.col("p_size").cast("double")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), M.rounded(M.acres(s * 100), 6).alias("acres"), M.rounded(M.m2_of_acres(s), 6).alias("m2"), M.rounded(M.feet(s), 6).alias("feet"), M.rounded(M.metres_of_feet(s), 6).alias("ft_m"), M.rounded(M.yards(s), 6).alias("yards"), M.rounded(M.metres_of_yards(s), 6).alias("yd_m"))


@query("SELECT l_orderkey AS k, l_linenumber AS n, ['E', 'NE', 'N', 'NW', 'W', 'SW', 'S', 'SE'][1 + CAST(floor(((degrees(atan2(l_suppkey % 13 - 6 + 0.25, l_partkey % 11 - 5 + 0.125)) + 360 + 22.5) % 360) / 45) AS INTEGER)] AS sector FROM lineitem")
def compass_sector(spark, sf_dir):
    dx, dy = F.col("l_partkey") % 11 - 5 + F.lit(0.125), F.col("l_suppkey") % 13 - 6 + F.lit(0.25)
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), M.compass_sector(dx, dy).alias("sector"))


def queries() -> dict[str, Query]:
    from . import source_queries, stage_queries  # noqa: F401  they register their own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
