"""A small synthetic county: boxes, one stream, one hill, three roads. For tests and first runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Access, Config, Constraint, RowLayer, Slope, Zoning
from ..kernel import functions as K
from ..operators.slope import Grid
from ..plans.record import Inputs

X, Y = 320000.0, 195000.0
ACRE = 4046.8564224
# Account, county, box, acreage (None: that of the box), as the tests' golden values need them.
PLACES = (
    ("FRED-A", "FRED", (0, 18, 320, 658), None), ("FRED-A", "FRED", (320, 18, 640, 658), None), ("FRED-B", "FRED", (640, 18, 1280, 658), None), ("FRED-C", "FRED", (1280, 18, 1920, 658), None),
    ("FRED-D", "FRED", (1920, 33, 2560, 658), None), ("FRED-S", "FRED", (1920, 18, 2560, 33), None), ("FRED-E", "FRED", (2560, 33, 3200, 658), None), ("FRED-S2", "FRED", (2560, 18, 3200, 33), None),
    ("FRED-F", "FRED", (3200, 18, 3400, 658), None), ("FRED-G", "FRED", (3400, 18, 4040, 658), None), ("FRED-I", "FRED", (0, 658, 640, 1298), None), ("FRED-H", "FRED", (640, 658, 1280, 1200), None),
    ("FRED-K", "FRED", (640, 1200, 1280, 1298), None), ("FRED-J", "FRED", (1280, 658, 1920, 1298), None), ("FRED-L", "FRED", (1920, 658, 2560, 1298), None), ("FRED-M", "FRED", (2560, 658, 3200, 1298), 80.0),
    ("CARR-O", "CARR", (3200, 658, 3840, 1298), None), ("FRED-N", "FRED", (6000, 18, 6640, 658), None),
)
#: Owners are invented but for what tests look at: the account's first owner's kind, who else owns it, whose strip it is.
OWNERS = {"FRED-A": ("WILLOWBROOK FARMS LLC", None), "FRED-C": ("ABERNATHY RUTH", "ABERNATHY PAUL"), "FRED-S": ("CORNERSTONE DEVELOPMENT INC", None), "FRED-E": ("HOLLOWAY MERLE", None), "FRED-S2": ("HOLLOWAY MERLE", "HOLLOWAY JUNE"), "CARR-O": ("PEMBERTON FAMILY TRUST", None)}
HOMES = {"FRED-S2": "FRED-E"}


def owner(account: str) -> tuple[str, str | None, str, str, str]:
    """First and second owner, street, town and ZIP code of an account."""
    number = [a for a, *_ in PLACES].index(HOMES.get(account, account))
    first, second = OWNERS.get(account, (f"RESIDENT{number} TERRY", None))
    return first, second, f"{20 + 3 * number} ORCHARD WAY", "RIVERTON", f"{20000 + number}"


SCHEMA = {
    "required": {"account_id": ["ACCTID"], "county_code": ["JURSCODE"], "owner_name": ["OWNNAME1"], "owner_addr_line1": ["OWNADD1"], "owner_city": ["OWNCITY"], "owner_state": ["OWNSTATE"], "owner_zip": ["OWNZIP"]},
    "optional": {"owner_name2": ["OWNNAME2"], "owner_addr_line2": ["OWNADD2"], "acreage_sdat": ["ACRES"], "land_use_code": ["LU"], "zoning_sdat": ["ZONING"]},
}


def box(x0: float, y0: float, x1: float, y1: float) -> bytes:
    return K.box_wkb(X + x0, Y + y0, X + x1, Y + y1)


def acreage(b: tuple, given: float | None) -> float:
    return round((b[2] - b[0]) * (b[3] - b[1]) / ACRE, 2) if given is None else given


def config(**more) -> Config:
    ag, no = {"is_agricultural": True}, {"is_agricultural": False}
    given = {
        "counties": {"FRED": "Frederick", "CARR": "Carroll", "WASH": "Washington"}, "schema": SCHEMA,
        "zoning": (Zoning("Frederick", "ZONING", {"A": ag, "R1": no}), Zoning("Carroll", "ZONE_", {"AG": ag, "R-40": no})),
        "constraints": (
            Constraint("malpf", "ag_preservation_malpf", "legal", "favorable", name_field="EASEMENT_ID"),
            Constraint("forest_conservation", "forest_conservation", "legal", "hostile", True, name_field="FCA_ID"),
            Constraint("wetlands", "wetlands", "physical", "physical", True, True),
            Constraint("floodplain", "floodplain", "physical", "physical", True, True, where="FLD_ZONE in ['A', 'AE', 'AO', 'AH']"),
            Constraint("riparian_presumed", "riparian_buffer", "physical", "hostile", True, True, manual_flag="riparian_buffer_presumed_confirm_with_seller"),
        ),
        "slope": Slope(dem_path="dem"),
        "access": Access((RowLayer("county_centerlines", "county", True, "line", 60.0), RowLayer("county_row_polygons", "county"), RowLayer("sha_row_polygons", "state"))),
    }
    return Config(**given | more)


def dem(spark: SparkSession) -> tuple[DataFrame, Grid]:
    """Flat at 100 m but for a hill of 60 m."""
    grid = Grid(X - 200, Y + 1600, 5.0, 5.0)
    cells = spark.range(360).select(F.col("id").cast("int").alias("row")).join(spark.range(960).select(F.col("id").cast("int").alias("col")))
    dx, dy = (F.col("col") + 0.5) * 5.0 - 200 - 1600, 1600 - (F.col("row") + 0.5) * 5.0 - 978
    return cells.withColumn("z", (100 + 60 * F.exp(-(dx * dx + dy * dy) / (2 * 150.0**2))).cast("float").cast("double")), grid


def inputs(spark: SparkSession) -> Inputs:
    from .where import translated

    K.register(spark)
    rows = [(a, c, *owner(a)[:3], None, owner(a)[3], "MD", owner(a)[4], acreage(b, ac), "AG", box(*b), k) for k, (a, c, b, ac) in enumerate(PLACES)]
    parcels = spark.createDataFrame(rows, "ACCTID string, JURSCODE string, OWNNAME1 string, OWNNAME2 string, OWNADD1 string, OWNADD2 string, OWNCITY string, OWNSTATE string, OWNZIP string, ACRES double, LU string, geom binary, _row long")
    layer = lambda names, data: spark.createDataFrame(data, names)
    r1 = K.union_all(F.array(F.lit(bytearray(box(3400, 18, 4040, 658))), F.lit(bytearray(box(2304, 658, 2560, 1298)))))
    fred = spark.createDataFrame([("A",), ("R1",)], "ZONING string").withColumn("geom", F.when(F.col("ZONING") == "R1", r1).otherwise(K.areal_difference(F.lit(bytearray(box(-300, -300, 4700, 1700))), r1)))
    flood = layer("FLD_ZONE string, geom binary", [("AE", box(2560, 658, 2655, 1298)), ("X", box(2655, 658, 2700, 1298))])
    stream = layer("GNIS_NAME string, geom binary", [("Bravo Run", K.line_wkb((X + 600, Y + 400), (X + 1340, Y + 400)))])
    return Inputs(
        parcels, box(-100, -100, 4500, 1500),
        {"Frederick": fred, "Carroll": layer("ZONE_ string, geom binary", [("AG", box(3100, 600, 3900, 1400)), ("R-40", box(3100, 1400, 3900, 1700))])},
        {
            "malpf": layer("EASEMENT_ID string, geom binary", [("MALPF-1", box(0, 700, 640, 1298))]), "forest_conservation": layer("FCA_ID string, geom binary", [("FCA-A", box(420, 438, 640, 658)), ("FCA-C", box(1280, 18, 1920, 78))]),
            "wetlands": layer("WETLAND_TYPE string, geom binary", [("PEM1", box(2800, 900, 2980, 1080))]), "floodplain": flood.where(translated("FLD_ZONE in ['A', 'AE', 'AO', 'AH']")),
            "riparian_presumed": stream.withColumn("geom", K.buffer("geom", 100 * 0.3048, flat=True)),
        },
        {"county_centerlines": layer("ROAD_NAME string, geom binary", [("MAIN RD", K.line_wkb((X - 100, Y + 9), (X + 4200, Y + 9)))]), "county_row_polygons": layer("ROAD_NAME string, geom binary", [("NORTH RD", box(-20, 1298, 4100, 1316))]), "sha_row_polygons": layer("ROUTE string, geom binary", [("MD 999", box(-20, -50, 0, 1400))])},
        dem=dem(spark),
    )


def write(spark: SparkSession, home: str) -> str:
    """All of it as files, with the configuration that runs on them; gives the configuration's path."""
    from pathlib import Path

    import numpy as np
    import yaml

    from . import files
    from .shapefile import write_shapefile
    from .tiff import write_tiff

    given, at = inputs(spark), Path(home)
    turned = lambda b: [[(X + b[0], Y + b[1]), (X + b[0], Y + b[3]), (X + b[2], Y + b[3]), (X + b[2], Y + b[1]), (X + b[0], Y + b[1])]]
    rows = [(a, c, *owner(a)[:3], None, owner(a)[3], "MD", owner(a)[4], acreage(b, ac), "AG", turned(b)) for a, c, b, ac in PLACES]
    text = [(n, "C", 40, 0) for n in ("ACCTID", "JURSCODE", "OWNNAME1", "OWNNAME2", "OWNADD1", "OWNADD2", "OWNCITY", "OWNSTATE", "OWNZIP")]
    write_shapefile(str(at / "raw/parcels/parcels.shp"), rows, [*text, ("ACRES", "N", 18, 2), ("LU", "C", 10, 0)], 'PROJCS["NAD83 / Maryland",AUTHORITY["EPSG","26985"]]')

    def layer(name: str, df: DataFrame) -> str:
        path = at / "raw" / f"{name}.gpkg"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.unlink(missing_ok=True)
        files.write_gpkg(df, str(path), path.stem)
        return f"raw/{name}.gpkg"

    streams = spark.createDataFrame([("Bravo Run", K.line_wkb((X + 600, Y + 400), (X + 1340, Y + 400)))], "GNIS_NAME string, geom binary")
    flood = spark.createDataFrame([("AE", box(2560, 658, 2655, 1298)), ("X", box(2655, 658, 2700, 1298))], "FLD_ZONE string, geom binary")
    cfg = config()
    raw: dict = {"acreage_min": 40, "slope_max_pct": 15, "study_area": "study_area.geojson", "study_area_selection": "intersects", "working_crs": "EPSG:26985", "parcels": {"path": "raw/parcels", "schema": "schema/parcels.yaml", "acreage_source": "sdat", "acreage_disagreement_pct": 10}, "counties": cfg.counties, "on_unmapped_zoning": "error", "zoning": [], "constraints": []}
    for z in cfg.zoning:
        raw["zoning"].append({"county": z.county, "path": layer(f"zoning/{z.county.lower()}", given.zoning[z.county]), "code_field": z.code_field, "mapping": f"zoning/{z.county.lower()}.yaml"})
        (at / "zoning").mkdir(parents=True, exist_ok=True)
        (at / f"zoning/{z.county.lower()}.yaml").write_text(yaml.safe_dump({"code_field": z.code_field, "codes": z.codes}))
    for c in cfg.constraints:
        own = {k: getattr(c, k) for k in ("name", "type", "category", "implication", "subtract_from_usable", "crossable_with_permit", "manual_flag", "name_field", "where") if getattr(c, k) is not None}
        if c.name == "riparian_presumed":
            raw["constraints"].append(own | {"derive_from_lines": {"path": layer("hydro/flowlines", streams), "buffer_ft": 100}})
        else:
            raw["constraints"].append(own | {"path": layer(f"constraints/{c.name}", flood if c.name == "floodplain" else given.constraints[c.name])})
    raw["access"] = {"row_layers": [{"name": r.name, "authority": r.authority, "public": r.public, "geometry": r.geometry, "path": layer(f"access/{r.name}", given.rows[r.name])} | ({"row_width_ft": r.row_width_ft} if r.row_width_ft else {}) for r in cfg.access.row_layers]}
    cells, grid = dem(spark)
    z = np.full((360, 960), np.nan, np.float32)
    got = np.array([(r["row"], r["col"], r["z"]) for r in cells.collect()])
    z[got[:, 0].astype(int), got[:, 1].astype(int)] = got[:, 2]
    write_tiff(str(at / "raw/lidar/dem.tif"), z, (grid.x0, grid.y1, grid.dx, grid.dy), 26985, -9999.0)
    raw["slope"] = {"dem_path": "raw/lidar/dem.tif", "dem_vertical_unit_to_m": 1.0, "crossable": False}
    raw["run"] = {"process_all": False, "output_dir": "outputs"}
    (at / "schema").mkdir(parents=True, exist_ok=True)
    (at / "schema/parcels.yaml").write_text(yaml.safe_dump(SCHEMA))
    study = spark.createDataFrame([("county", box(-100, -100, 4500, 1500))], "name string, geom binary")
    files.write_geojson(study, str(at / "study_area.geojson"))
    (at / "pipeline.yaml").write_text(yaml.safe_dump(raw, sort_keys=False))
    return str(at / "pipeline.yaml")
