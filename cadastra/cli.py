"""Command line: run, verify-schema, zoning-domains, fetch, steep-polygons, make-fixture. Exit codes: 0 done, 1 some fetches failed, 2 configuration or schema, 3 data missing."""

from __future__ import annotations

import argparse
import json
import sys
import time
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema
from .config import Config, ConfigError, load
from .kernel import functions as K
from .operators import raster as steep_ground
from .operators.slope import Grid, resampled
from .plans import record
from .sources import crs as systems
from .sources import files, rest, tiff


def stage_list(text: str) -> tuple[int, ...]:
    """``1-4`` or ``1,3`` as sorted numbers from 1 to 4."""
    found: set[int] = set()
    for part in text.split(","):
        lo, _, hi = part.strip().partition("-")
        try:
            found |= set(range(int(lo), int(hi or lo) + 1))
        except ValueError:
            raise ConfigError(f"no stages: {text}") from None
    if not found or not found <= {1, 2, 3, 4}:
        raise ConfigError(f"stages are 1 to 4: {text}")
    return tuple(sorted(found))


def elevation(spark: SparkSession, path: str) -> tuple[DataFrame, Grid]:
    """Cells and their grid: a GeoTIFF in the working plane, or a folder with ``cells.parquet`` and ``grid.json``."""
    at = Path(path)
    if at.suffix.lower() in (".tif", ".tiff"):
        if not at.exists():
            raise files.LayerNotAvailable(path)
        raster = tiff.opened(path)
        system = None if raster.epsg == K.PLANE else systems.of_epsg(raster.epsg) if raster.epsg else None
        if raster.epsg != K.PLANE and (system is None or system.method == systems.LONLAT):
            raise files.LayerError(f"{path}: elevation has to be in a projected system that is known here, this is EPSG:{raster.epsg}")
        spark.dataSource.register(tiff.GeoTiff)
        return spark.read.format("geotiff").option("path", path).load(), Grid(*raster.place, tuple(system.numbers()) if system else None)
    if not (at / "grid.json").exists():
        raise files.LayerNotAvailable(path)
    return spark.read.parquet(str(at / "cells.parquet")), Grid(**json.loads((at / "grid.json").read_text()))


def inputs(spark: SparkSession, cfg: Config) -> tuple[record.Inputs, list[str]]:
    """All tables of a configuration, read only about the study area, and the names of the layers that are not there."""
    missing: list[str] = []
    study = files.study_area(spark, cfg.study_area)
    b = spark.range(1).select(K.shape(F.lit(bytearray(study))).alias("b")).first()["b"]
    # roads and neighbours a little outside count too; the readers pad by more
    clip = (b["minx"], b["miny"], b["maxx"], b["maxy"])

    def layer(name: str, path: str | None, url: str | None = None, **more) -> DataFrame | None:
        try:
            if not path:
                raise files.LayerNotAvailable(name)
            kept = rest.cache_path(path)
            if "://" not in path and not Path(path).exists() and Path(kept).exists():
                path = kept
            return files.read_layer(spark, path, clip=clip, **more)
        except files.LayerNotAvailable:
            missing.append(f"{name} (run fetch first: it has a url)" if url else name)
            return None

    have = lambda d: {k: v for k, v in d.items() if v is not None}
    constraints = {}
    for c in cfg.constraints:
        if c.lines:
            df = layer(c.name, c.lines.get("path"), c.lines.get("url"), layer=c.lines.get("layer"), where=c.lines.get("where"))
            constraints[c.name] = df
        else:
            constraints[c.name] = layer(c.name, c.path, c.url, layer=c.layer, where=c.where)
    zoning = {z.county: layer(z.county, z.path, z.url, layer=z.layer) for z in cfg.zoning}
    rows = {r.name: layer(r.name, r.path, r.url, layer=r.layer, where=r.where) for r in cfg.access.row_layers}
    steep = layer("steep", cfg.slope.polygons_path) if cfg.slope.polygons_path else None
    dem = None
    if cfg.slope.dem_path and steep is None:
        try:
            dem = elevation(spark, cfg.slope.dem_path)
        except files.LayerNotAvailable:
            missing.append("dem")
    parcels = files.read_layer(spark, cfg.parcels["path"], cfg.parcels.get("layer"), cfg.parcels.get("where"), clip=clip)
    return record.Inputs(parcels, study, have(zoning), have(constraints), have(rows), steep, dem), missing


#: Tables of a run that people open, as GeoPackage: the table and its file.
OPENED = {"usable": "usable_area", "frontage": "frontage", "entry_points": "entry_points"}
LISTED = {"encumbrances": "encumbrances", "strips": "reserve_strips", "islands": "islands"}


def run(spark: SparkSession, cfg: Config, stages: tuple[int, ...], out_dir: str) -> dict:
    """Runs the stages and writes their tables: Parquet and CSV in parts, and, where the folder is a local one, GeoPackages, a FeatureCollection and the summary as single files."""
    began = time.time()
    given, missing = inputs(spark, cfg)
    out = record.run(given, cfg, stages)
    local = "://" not in out_dir
    if local:
        Path(out_dir).mkdir(parents=True, exist_ok=True)

    def opened(df: DataFrame, name: str) -> None:
        files.write_parquet(df, f"{out_dir}/{name}.parquet")
        if local:
            Path(f"{out_dir}/{name}.gpkg").unlink(missing_ok=True)
            files.write_gpkg(spark.read.parquet(f"{out_dir}/{name}.parquet").drop("_crs", "minx", "miny", "maxx", "maxy"), f"{out_dir}/{name}.gpkg", name)

    opened(out["stage1"].drop("box"), "parcels_stage1")
    for name, to in LISTED.items():
        if name in out:
            files.write_csv(out[name], f"{out_dir}/{to}.csv")
    for name, to in OPENED.items():
        if name in out and not (name == "entry_points" and out[name].isEmpty()):
            opened(out[name], to)
    opened(out["scored"], "parcels_scored")
    scored = spark.read.parquet(f"{out_dir}/parcels_scored.parquet").drop("_crs", "minx", "miny", "maxx", "maxy")
    files.write_geojson_lines(scored, f"{out_dir}/parcels_scored.geojsonl")
    files.write_csv(scored, f"{out_dir}/parcels_scored.csv")
    s = record.summary(out | {"scored": scored}, cfg) | {"stages_run": list(stages), "missing_layers": missing, "elapsed_s": round(time.time() - began, 1)}
    if local:
        files.write_geojson(scored, f"{out_dir}/parcels_scored.geojson")
        Path(out_dir, "summary.json").write_text(json.dumps(s, indent=2, default=str))
        Path(out_dir, "summary.md").write_text(record.markdown(s))
    return s


def steep_layer(spark: SparkSession, cfg: Config, to: str) -> None:
    """The steep ground of the whole elevation grid as a Parquet layer, made once; ``slope.polygons_path`` takes it in later runs.

    Beside cells without elevation slopes are one-sided, where a parcel's window would take its mean. With
    ``dem_resample_m`` whole blocks of cells are averaged, the nearest number of them.
    """
    if not cfg.slope.dem_path:
        raise ConfigError("slope.dem_path is not set")
    cells, grid = elevation(spark, cfg.slope.dem_path)
    if cfg.slope.dem_resample_m:
        n = max(1, round(cfg.slope.dem_resample_m / (grid.dx * grid.unit)))
        cells, grid = resampled(cells, n), replace(grid, dx=grid.dx * n, dy=grid.dy * n)
    parts = steep_ground.whole(steep_ground.steep_pieces(cells, grid, cfg.slope_max_pct, cfg.slope.dem_vertical_unit_to_m))
    files.write_parquet(parts.withColumn("geom", grid.back("geom")), to)


def domains(spark: SparkSession, cfg: Config, county: str) -> str:
    """The mapping template of a county: codes from the service's domain, else from the layer."""
    z = cfg.zoning_for(county)
    if z is None or not z.code_field:
        raise ConfigError(f"zoning {county}: code_field is not set")
    codes: dict[str, str | None] = dict(rest.layer_info(z.url).domains.get(z.code_field, {})) if z.url else {}
    if not codes:
        df = rest.read_service(spark, z.url) if z.url else files.read_layer(spark, z.path, layer=z.layer, default_crs=K.PLANE)
        codes = {str(r[0]): None for r in rest.distinct_values(df, z.code_field).collect()}
    return schema.zoning_template(county, z.code_field, codes, z.codes)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cadastra")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "verify-schema", "zoning-domains", "fetch", "steep-polygons", "make-fixture"):
        p = sub.add_parser(name)
        p.add_argument("--config")
        p.add_argument("--out")
        p.add_argument("--stages", default="1-4")
        p.add_argument("--county")
        p.add_argument("--force", action="store_true")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("cadastra").getOrCreate()
    K.register(spark)
    try:
        if a.command == "make-fixture":
            from .sources import fixture

            print(f"run --config {fixture.write(spark, a.out)}")
            return 0
        cfg = load(a.config)
        if a.command == "run":
            print(record.markdown(run(spark, cfg, stage_list(a.stages), a.out or cfg.output_dir)))
        elif a.command == "verify-schema":
            got = schema.resolve(cfg.schema, files.fields_of(spark, cfg.parcels["path"]))
            print(got.report())
            return 2 if got.missing_required else 0
        elif a.command == "steep-polygons":
            if not a.out:
                raise ConfigError("steep-polygons needs --out")
            steep_layer(spark, cfg, a.out)
        elif a.command == "zoning-domains":
            text = domains(spark, cfg, a.county)
            Path(a.out).write_text(text) if a.out else print(text)
        else:
            return fetch_all(spark, cfg, a.force)
    except (ConfigError, schema.SchemaError, files.LayerError) as e:
        print(e, file=sys.stderr)
        return 2
    except files.LayerNotAvailable as e:
        print(f"missing: {e}", file=sys.stderr)
        return 3
    return 0


def fetch_all(spark: SparkSession, cfg: Config, force: bool) -> int:
    """Every layer with a URL to its path; those there already stay; a failure is told and the others go on."""
    failed = 0
    study = files.study_area(spark, cfg.study_area)
    box = spark.range(1).select(K.shape(K.to_lonlat(F.lit(bytearray(study)))).alias("b")).first()["b"]
    sources = [(z.county, z.url, z.path, None) for z in cfg.zoning]
    for c in cfg.constraints:
        sources += [(c.name, c.url, c.path, c.where), *([(c.name, c.lines.get("url"), c.lines.get("path"), c.lines.get("where"))] if c.lines else [])]
    sources += [(r.name, r.url, r.path, r.where) for r in cfg.access.row_layers]
    for name, url, path, where in sources:
        if not url or not path or ((Path(path).exists() or Path(rest.cache_path(path)).exists()) and not force):
            continue
        try:
            rest.fetch(spark, url, path, where, (box["minx"], box["miny"], box["maxx"], box["maxy"]))
        except Exception as e:  # noqa: BLE001  a service may fail in any way
            print(f"{name}: {url}: {e}", file=sys.stderr)
            failed += 1
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
