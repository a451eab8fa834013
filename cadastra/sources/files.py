"""Vector layers from files (Parquet with WKB, GeoJSON, GeoPackage, shapefiles) in the working plane, and sinks."""

from __future__ import annotations

import json
import math
import re
import shutil
import sqlite3
import struct
import uuid
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from ..kernel import functions as K
from ..operators.lineage import cut
from . import crs as systems
from . import flatgeobuf, geojson, shapefile, tiff
from .shapefile import Shapefile
from .where import translated

SUFFIXES = (".gpkg", ".shp", ".geojson", ".json", ".geojsonl", ".parquet", ".fgb")
UNREAD = (".gdb",)
PAD_M = 1000.0
#: A row's place in its source: the number of its file times this, and its position there.
FILE_ROWS = 1 << 47


class LayerNotAvailable(FileNotFoundError):
    """The layer has no file here: the run goes on without it and says so."""


class LayerError(ValueError):
    """The layer is there but can't be read as it is: an unknown format or coordinate system."""


def files_of(path: str) -> list[str]:
    """A file, or a folder's vector files in order of their names. Paths of other stores are left to Spark."""
    if "://" in path:
        return [path]
    at = Path(path)
    if at.is_file() or at.suffix == ".parquet" and at.is_dir():
        found = [at]
    elif at.is_dir():
        found = sorted(p for p in at.iterdir() if p.suffix.lower() in SUFFIXES + UNREAD)
    else:
        found = []
    if not found:
        raise LayerNotAvailable(path)
    for p in found:
        if p.suffix.lower() in UNREAD:
            raise LayerError(f"{p}: this format is not read here; convert it to GeoPackage, shapefile, GeoJSON or Parquet with WKB")
    return [str(p) for p in found]


def wkb_geojson(w: bytes | None) -> str | None:
    """The GeoJSON text of little- or big-endian WKB."""
    if w is None:
        return None
    w = bytes(w)

    def read(at: int):
        o = "<" if w[at] == 1 else ">"
        kind = struct.unpack_from(o + "I", w, at + 1)[0]
        at += 5

        def points(at):
            n = struct.unpack_from(o + "I", w, at)[0]
            return [list(struct.unpack_from(o + "dd", w, at + 4 + 16 * k)) for k in range(n)], at + 4 + 16 * n

        if kind == 1:
            return {"type": "Point", "coordinates": list(struct.unpack_from(o + "dd", w, at))}, at + 16
        if kind == 2:
            ps, at = points(at)
            return {"type": "LineString", "coordinates": ps}, at
        n, at = struct.unpack_from(o + "I", w, at)[0], at + 4
        if kind == 3:
            rings = []
            for _ in range(n):
                ps, at = points(at)
                rings.append(ps)
            return {"type": "Polygon", "coordinates": rings}, at
        members = []
        for _ in range(n):
            m, at = read(at)
            members.append(m)
        if kind == 7:
            return {"type": "GeometryCollection", "geometries": members}, at
        return {"type": {4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}[kind], "coordinates": [m["coordinates"] for m in members]}, at

    return json.dumps(read(0)[0])


class GeoPackage(DataSource):
    """``spark.read.format("geopackage").option("path", file).option("layer", name)``: attributes, ``geom`` as WKB and ``_row``, dealt by row-id ranges; option ``clip`` (x0,y0,x1,y1) goes by the layer's spatial index if it has one."""

    @classmethod
    def name(cls):
        return "geopackage"

    def _layer(self):
        con = sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True)
        layer = self.options.get("layer") or con.execute("SELECT table_name FROM gpkg_contents WHERE data_type = 'features' ORDER BY table_name").fetchone()[0]
        geom = con.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()[0]
        return con, layer, geom

    def schema(self):
        con, layer, geom = self._layer()
        kinds = {"INTEGER": "long", "INT": "long", "MEDIUMINT": "long", "SMALLINT": "long", "TINYINT": "long", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BOOLEAN": "boolean", "BLOB": "binary"}
        cols = [(r[1], r[2].split("(")[0].upper()) for r in con.execute(f'PRAGMA table_info("{layer}")')]
        return "_row long, " + ", ".join(f"`{'geom' if c == geom else c}` {'binary' if c == geom else kinds.get(k, 'string')}" for c, k in cols)

    def reader(self, schema):
        return GeoPackageReader(self, schema)


class GeoPackageReader(DataSourceReader):
    STEP = 50_000

    def __init__(self, source: GeoPackage, schema):
        self.source, self.names = source, schema.names
        self.flags = [k for k, f in enumerate(schema.fields) if f.dataType.typeName() == "boolean"]
        self.clip = tuple(map(float, source.options["clip"].split(","))) if source.options.get("clip") else None

    def partitions(self):
        con, layer, _ = self.source._layer()
        # borders by counted rows, found along the row-id index: ids may have any gaps
        borders, at = [], con.execute(f'SELECT min(rowid) FROM "{layer}"').fetchone()[0]
        while at is not None:
            borders.append(at)
            found = con.execute(f'SELECT rowid FROM "{layer}" WHERE rowid >= ? ORDER BY rowid LIMIT 1 OFFSET ?', (at, self.STEP)).fetchone()
            at = found[0] if found else None
        last = con.execute(f'SELECT max(rowid) FROM "{layer}"').fetchone()[0]
        return [InputPartition((a, b)) for a, b in zip(borders, [*[b - 1 for b in borders[1:]], last])] or [InputPartition((0, -1))]

    def read(self, partition):
        con, layer, geom = self.source._layer()
        lo, hi = partition.value
        cols = ", ".join("rowid" if c == "_row" else f'"{geom if c == "geom" else c}"' for c in self.names)
        at = self.names.index("geom")
        where, given = "rowid BETWEEN ? AND ?", [lo, hi]
        index = f"rtree_{layer}_{geom}"
        if self.clip and con.execute("SELECT count(*) FROM sqlite_master WHERE name = ?", (index,)).fetchone()[0]:
            where += f' AND rowid IN (SELECT id FROM "{index}" WHERE minx <= ? AND maxx >= ? AND miny <= ? AND maxy >= ?)'
            given += [self.clip[2], self.clip[0], self.clip[3], self.clip[1]]
        for row in con.execute(f'SELECT {cols} FROM "{layer}" WHERE {where} ORDER BY rowid', given):
            row = list(row)
            for k in self.flags:
                row[k] = None if row[k] is None else bool(row[k])
            if row[at] is not None:  # a header with flags and an envelope stands before the WKB
                row[at] = bytes(row[at][8 + (0, 32, 48, 48, 64)[row[at][3] >> 1 & 7] :])
            yield tuple(row)


# ---- coordinate systems ------------------------------------------------------
def epsg_of_text(text: str) -> int | None:
    """The EPSG number that a name, a URN or a WKT description stands for."""
    if re.search(r"CRS:?:?84|CRS84", text):
        return 4326
    if found := re.findall(r'(?:EPSG[:"/,\s]*(?:[0-9.]*:|,)?\s*"?|ID\["EPSG",)(\d{4,5})', text):
        return int(found[-1])
    if re.match(r"\s*GEOG", text):
        return 4326
    if "Web_Mercator" in text or "Pseudo-Mercator" in text:
        return 3857
    if "Maryland" in text and "Lambert_Conformal_Conic" in text:
        return K.PLANE_FEET if re.search(r"Foot_US|US survey foot|0\.3048006", text) else K.PLANE
    return None


def epsg_of(name: str, layer: str | None = None, spark: SparkSession | None = None) -> int | None:
    """What a file says of its coordinate system; None if it says nothing. GeoJSON that says nothing is longitude and latitude. Parquet of stores that only Spark reads says nothing but by a ``_crs`` column."""
    if Path(name).suffix.lower() in geojson.SUFFIXES:
        crs = geojson.layout_of(spark or SparkSession.active(), name).crs
        return epsg_of_text(str((crs.get("properties") or {}).get("name", ""))) if crs else 4326
    if "://" in name:
        return None
    if name.endswith(".gpkg"):
        con = sqlite3.connect(f"file:{name}?mode=ro", uri=True)
        has = lambda t: con.execute("SELECT count(*) FROM sqlite_master WHERE name = ?", (t,)).fetchone()[0]
        row = con.execute("SELECT srs_id FROM gpkg_geometry_columns" + (" WHERE table_name = ?" if layer else " ORDER BY table_name"), (layer,) if layer else ()).fetchone()
        if row and has("gpkg_spatial_ref_sys") and (own := con.execute("SELECT organization, organization_coordsys_id FROM gpkg_spatial_ref_sys WHERE srs_id = ?", row).fetchone()):
            return int(own[1]) if str(own[0]).upper() == "EPSG" else None
        return int(row[0]) if row and row[0] and row[0] > 0 else None
    if name.endswith(".shp"):
        at = Path(name).with_suffix(".prj")
        return epsg_of_text(at.read_text()) if at.exists() else None
    if name.endswith(".parquet"):
        return _geoparquet_epsg(name)
    return None


def _geoparquet_crs(name: str) -> dict | None:
    """PROJJSON of a GeoParquet file's primary column; empty where it says that it knows none."""
    import pyarrow.parquet as pq

    if "://" in name:
        return None
    first = next(iter(sorted(Path(name).glob("*.parquet"))), None) if Path(name).is_dir() else Path(name)
    geo = (pq.read_schema(first).metadata or {}).get(b"geo") if first else None
    if geo is None:
        return None
    doc = json.loads(geo)
    return doc["columns"][doc.get("primary_column", "geom")].get("crs", {"id": {"authority": "OGC", "code": "CRS84"}}) or {}


def _geoparquet_epsg(name: str) -> int | None:
    own = (_geoparquet_crs(name) or {}).get("id") or {}
    return 4326 if own.get("authority") == "OGC" else int(own["code"]) if own.get("authority") == "EPSG" else None


def description_of(name: str, layer: str | None = None, spark: SparkSession | None = None) -> str | None:
    """What a file says of its coordinate system, in full: WKT, PROJJSON or a name."""
    kind = Path(name).suffix.lower()
    if kind in geojson.SUFFIXES:
        crs = geojson.layout_of(spark or SparkSession.active(), name).crs
        return str((crs.get("properties") or {}).get("name", "")) if crs else None
    if "://" in name and kind != ".fgb":
        return None
    if kind == ".shp":
        at = Path(name).with_suffix(".prj")
        return at.read_text() if at.exists() else None
    if kind == ".fgb":
        return flatgeobuf.crs_text(name)
    if kind == ".gpkg":
        con = sqlite3.connect(f"file:{name}?mode=ro", uri=True)
        try:
            row = con.execute("SELECT s.definition FROM gpkg_geometry_columns g JOIN gpkg_spatial_ref_sys s USING (srs_id)" + (" WHERE g.table_name = ?" if layer else " ORDER BY g.table_name"), (layer,) if layer else ()).fetchone()
        except sqlite3.OperationalError:
            return None
        return row[0] if row and row[0] and row[0] != "undefined" else None
    if kind == ".parquet":
        crs = _geoparquet_crs(name)
        return json.dumps(crs) if crs else None
    return None


def system_of(name: str, layer: str | None = None, spark: SparkSession | None = None) -> systems.System | None:
    """The system that a file says it has, by its description or its EPSG number; None if it says nothing."""
    text, why = description_of(name, layer, spark), None
    if text:
        try:
            return systems.of_text(text)
        except systems.UnknownSystem as e:
            why = e
    epsg = epsg_of(name, layer, spark)
    if epsg is not None and (found := systems.of_epsg(epsg)):
        return found
    if why is not None or epsg is not None:
        raise LayerError(f"{name}: {why or f'EPSG:{epsg} is not known here'}")
    return None


def box_in(spark: SparkSession, clip: tuple[float, float, float, float], epsg: int | systems.System) -> tuple[float, float, float, float]:
    """A box of the working plane, padded, as a box in another system that contains it."""
    x0, y0, x1, y1 = clip[0] - PAD_M, clip[1] - PAD_M, clip[2] + PAD_M, clip[3] + PAD_M
    if epsg == K.PLANE:
        return x0, y0, x1, y1
    if epsg == K.PLANE_FEET:
        return tuple(v * 3937 / 1200 for v in (x0, y0, x1, y1))
    steps = [k / 16 for k in range(17)]
    if isinstance(epsg, systems.System):
        edge = [(x0 + t * (x1 - x0), y) for t in steps for y in (y0, y1)] + [(x, y0 + t * (y1 - y0)) for t in steps for x in (x0, x1)]
        line = K.between_systems(F.lit(bytearray(K.line_wkb(*edge))), systems.of_epsg(K.PLANE).numbers(), epsg.numbers())
        b = spark.range(1).select(K.shape(line).alias("b")).first()["b"]
        return b["minx"], b["miny"], b["maxx"], b["maxy"]
    edge = [(x0 + t * (x1 - x0), y) for t in steps for y in (y0, y1)] + [(x, y0 + t * (y1 - y0)) for t in steps for x in (x0, x1)]
    b = spark.range(1).select(K.shape(K.to_lonlat(F.lit(bytearray(K.line_wkb(*edge))))).alias("b")).first()["b"]
    out = (b["minx"], b["miny"], b["maxx"], b["maxy"])
    if epsg == 3857:
        north = lambda v: 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(v) / 2))
        return 6378137.0 * math.radians(out[0]), north(out[1]), 6378137.0 * math.radians(out[2]), north(out[3])
    return out


def read_layer(spark: SparkSession, path: str, layer: str | None = None, where: str | None = None, columns: list[str] | None = None, clip: tuple[float, float, float, float] | None = None, crs: int | None = None, default_crs: int | None = None) -> DataFrame:
    """All files of a layer as one table in the working plane, with ``geom``, ``_row`` and ``_source_file``.

    The coordinate system is the file's own, ``crs`` overrules it, ``default_crs`` stands in where it is unknown; a layer
    without any is an error. ``clip`` is a box of the working plane: what surely lies outside need not be read.
    """
    K.register(spark)
    out = None
    for number, name in enumerate(files_of(path)):
        kind = Path(name).suffix.lower()
        epsg: int | systems.System | None = crs
        if crs and crs not in (K.PLANE, K.PLANE_FEET, *K.GLOBAL):
            epsg = systems.of_epsg(crs)
            if epsg is None:
                raise LayerError(f"EPSG:{crs} is not known here")
        elif not crs:
            found = system_of(name, layer, spark)
            # the working plane, its feet and degrees go their shorter ways
            epsg = next((c for c in (K.PLANE, K.PLANE_FEET, *K.GLOBAL) if systems.of_epsg(c) == found), found)
        df = None
        if kind in geojson.SUFFIXES:
            df = geojson.read(spark, geojson.layout_of(spark, name))
        elif kind == ".parquet" or "://" in name and kind != ".fgb":
            df = spark.read.parquet(name)
        own = df is not None and "_crs" in df.columns
        if not own and epsg is None and default_crs is None:
            raise LayerError(f"{name}: the layer doesn't say its coordinate system")
        epsg = epsg or default_crs
        box = box_in(spark, clip, epsg) if clip and epsg else None
        options = {"path": name} | ({"clip": ",".join(map(str, box))} if box else {})
        if kind == ".gpkg":
            spark.dataSource.register(GeoPackage)
            df = spark.read.format("geopackage").options(**options, **({"layer": layer} if layer else {})).load()
        elif kind == ".fgb":
            spark.dataSource.register(flatgeobuf.FlatGeobuf)
            df = spark.read.format("flatgeobuf").options(**options).load()
        elif kind == ".shp":
            spark.dataSource.register(Shapefile)
            df = spark.read.format("shapefile").options(**options).load()
        elif kind not in geojson.SUFFIXES:
            if "_row" not in df.columns:
                # the number in a part's name, else one made of the name, and the row's place in the part
                part = F.coalesce(F.expr("try_cast(regexp_extract(_metadata.file_name, 'part-([0-9]+)', 1) AS long)"), F.abs(F.xxhash64("_metadata.file_name")) % (1 << 12))
                df = df.select("*", (part * (1 << 28) + F.col("_metadata.row_index")).alias("_row"))
            if clip and {"minx", "miny", "maxx", "maxy"} <= set(df.columns):
                b = box or box_in(spark, clip, K.PLANE)
                meets = (F.col("minx") <= b[2]) & (F.col("maxx") >= b[0]) & (F.col("miny") <= b[3]) & (F.col("maxy") >= b[1])
                df = df.where(meets | (F.col("_crs") != K.PLANE)) if own else df.where(meets)
        if where:
            df = df.where(translated(where))
        if own:
            shape = F.when(F.col("_crs") == K.PLANE, F.col("geom"))
            for code in (K.PLANE_FEET, *K.GLOBAL):
                shape = shape.when(F.col("_crs") == code, K.reprojected("geom", code))
            df = df.withColumn("geom", shape.otherwise(F.raise_error(F.concat(F.lit(f"{name}: not read here is EPSG:"), F.coalesce(F.col("_crs").cast("string"), F.lit("?")))).cast("binary"))).drop("_crs", "minx", "miny", "maxx", "maxy")
        else:
            try:
                df = df.withColumn("geom", K.between_systems("geom", epsg.numbers(), systems.of_epsg(K.PLANE).numbers()) if isinstance(epsg, systems.System) else K.reprojected("geom", epsg))
            except ValueError as e:
                raise LayerError(f"{name}: {e}") from e
        if columns:
            df = df.select(*columns, "geom", "_row")
        df = df.withColumn("_row", F.col("_row") + F.lit(number * FILE_ROWS)).withColumn("_source_file", F.lit(Path(name).name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def fields_of(spark: SparkSession, path: str, layer: str | None = None) -> list[str]:
    """Field names without reading rows, but for GeoJSON, whose fields only its rows tell."""
    return [c for c in read_layer(spark, path, layer, default_crs=K.PLANE).columns if c not in ("geom", "_source_file", "_row")]


def study_area(spark: SparkSession, path: str) -> bytes:
    """The union of a file's polygons, repaired, in the working plane; longitude and latitude if the file doesn't say."""
    df = read_layer(spark, path, default_crs=4326)
    got = df.agg(K.union_agg(K.make_valid("geom")).alias("g"), F.count("*").alias("n")).first()
    if not got["n"]:
        raise ValueError(f"{path}: no polygons")
    return bytes(got["g"])


# ---- sinks -----------------------------------------------------------------
def writable(df: DataFrame) -> DataFrame:
    """Lists and structs as JSON text, void columns as text, private columns gone."""
    cols = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if not f.name.startswith("_"):
            cols.append(F.to_json(f.name).alias(f.name) if kind in ("array", "struct", "map") else F.col(f.name).cast("string") if kind == "void" else F.col(f.name))
    return df.select(*cols)


#: Rows of a row group: what a clip reads at least.
GROUP = 1 << 14


def write_parquet(df: DataFrame, path: str) -> None:
    """GeoParquet in parts, clustered by place: rows are dealt by ranges of their place on a Hilbert curve and sorted by it, so that a clip reads few parts and row groups. Bounds stand beside the shapes, the coordinate system in the footers and in ``_crs``."""
    rows = cut(writable(df).withColumn("__b", K.shape("geom")).select("*", *[F.col("__b")[c].alias(c) for c in ("minx", "miny", "maxx", "maxy")], F.lit(K.PLANE).alias("_crs")).drop("__b"))
    e = rows.agg(F.min("minx").alias("x0"), F.min("miny").alias("y0"), F.max("maxx").alias("x1"), F.max("maxy").alias("y1")).first()
    box = [e[c] for c in ("x0", "y0", "x1", "y1")]
    if e["x0"] is not None:
        key = K.hilbert((F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2, e["x0"], e["y0"], max(e["x1"] - e["x0"], e["y1"] - e["y0"]))
        rows = rows.withColumn("__key", key).repartitionByRange("__key").sortWithinPartitions("__key").drop("__key")
    column = {"encoding": "WKB", "geometry_types": [], "crs": systems.projjson(systems.of_epsg(K.PLANE), "NAD83 / Maryland", K.PLANE)} | ({"bbox": box} if e["x0"] is not None else {})
    geo = {"version": "1.1.0", "primary_column": "geom", "columns": {"geom": column}}
    schema = to_arrow_schema(rows.schema).with_metadata({b"geo": json.dumps(geo).encode()})
    uri = path if "://" in path else Path(path).resolve().as_uri()
    new = f"{uri}-{uuid.uuid4().hex}"
    store, at = fs.FileSystem.from_uri(new)
    store.create_dir(at)

    def write(batches):
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        part, writer, held, n = f"{new}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet", None, [], 0

        def out():
            writer.write_table(pa.Table.from_batches(held).cast(schema), row_group_size=GROUP)

        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                store, at = fs.FileSystem.from_uri(part)
                stream = store.open_output_stream(at)
                writer = pq.ParquetWriter(stream, schema, compression="zstd", write_page_index=True)
            held.append(b)
            n += b.num_rows
            if n >= GROUP:
                out()
                held, n = [], 0
        if writer is not None:
            if held:
                out()
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays([pa.array([part])], ["part"])

    parts = [r["part"] for r in rows.mapInArrow(write, "part string").collect()]  # a line for each part
    if not parts:
        import pyarrow.parquet as pq

        parts = [f"{new}/part-00000.parquet"]
        with store.open_output_stream(fs.FileSystem.from_uri(parts[0])[1]) as stream:
            pq.write_table(schema.empty_table(), stream)
    # what broken-off tasks have left goes, then the folder takes its place
    for info in store.get_file_info(fs.FileSelector(at)):
        if info.base_name not in {p.rsplit("/", 1)[1] for p in parts}:
            store.delete_file(info.path)
    target = fs.FileSystem.from_uri(uri)[1]
    if store.get_file_info(target).type == fs.FileType.Directory:
        store.delete_dir(target)
    store.move(at, target)


def write_csv(df: DataFrame, path: str) -> None:
    shapes = [f.name for f in df.schema.fields if f.dataType.typeName() == "binary"]
    writable(df.drop(*shapes)).write.mode("overwrite").options(header=True, escape='"').csv(path)  # quotes doubled, as other programs read them


def _features(df: DataFrame, lonlat: bool) -> DataFrame:
    """One GeoJSON feature to a row, as text."""
    import pandas as pd

    to_text = F.pandas_udf(lambda s: pd.Series([wkb_geojson(x) for x in s]), "string")
    rest = [c for c in writable(df).columns if c != "geom"]
    plain = writable(df).select(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("p"), to_text(K.to_lonlat("geom") if lonlat else F.col("geom")).alias("g"))
    return plain.select(F.concat(F.lit('{"type":"Feature","properties":'), "p", F.lit(',"geometry":'), F.coalesce("g", F.lit("null")), F.lit("}")).alias("f"))


def write_geojson_lines(df: DataFrame, path: str, lonlat: bool = True) -> None:
    """One feature to a line in a folder of parts, so that writing stays parallel."""
    _features(df, lonlat).write.mode("overwrite").text(path)


#: Rows that a task takes where one file is written side by side.
SPREAD = 50_000


def spread(rows: DataFrame) -> DataFrame:
    """The rows in their order, dealt to as many tasks as their number asks for, however few files they come from."""
    n = 1 + rows.count() // SPREAD
    return rows.withColumn("__place", F.monotonically_increasing_id()).repartitionByRange(n, "__place").sortWithinPartitions("__place").drop("__place")


def parted(rows: DataFrame, path: str, put, told: str) -> list[tuple]:
    """Every task writes its rows, ``put(batches, part)``, to a file of its own beside ``path``: the parts, and what ``put`` tells of each, in the rows' order. A repeated task begins another file."""
    names, kind = rows.columns, f"k long, part string, {told}"
    cols = [c.split()[0] for c in kind.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        full = (b.select(names) for b in batches if b.num_rows)
        if (first := next(full, None)) is not None:
            part = f"{path}.{uuid.uuid4().hex}.part"
            got = put(chain([first], full), part)
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (TaskContext.get().partitionId(), part, *got)], cols)

    return [tuple(r)[1:] for r in sorted(rows.mapInArrow(run, kind).collect())]  # a line for each part


def stored(batches, part: str) -> tuple[int]:
    """Rows as an Arrow stream, and their number."""
    n, writer = 0, None
    for b in batches:
        writer = writer or pa.ipc.new_stream(part, b.schema)
        writer.write_batch(b)
        n += b.num_rows
    writer.close()
    return (n,)


def placed(new: str, path: str) -> None:
    """A file that is whole takes its place; what tasks have left goes."""
    Path(new).replace(path)
    for left in Path(path).parent.glob(f"{Path(path).name}.*.part"):
        left.unlink()


def streamed(rows: DataFrame, path: str, write) -> None:
    """Writes one file from rows in their order: tasks make and store them, one task streams what is stored to ``write(batches, path)``, in pieces, with no sort; a repeated task begins a file of its own, and the one that ended is put in place."""
    parts = [p for p, _ in parted(rows, path, stored, "n long")]

    def one(_):
        def batches():
            for p in parts:
                with pa.memory_map(p) as source:
                    yield from pa.ipc.open_stream(source)

        part = f"{path}.{uuid.uuid4().hex}.part"
        write(batches(), part)
        return [(part,)]

    placed(geojson.ranged(rows.sparkSession, 1, one, "part string")[0][1], path)


def write_shapefile(df: DataFrame, path: str, fields: list[tuple[str, str, int, int]], wkt: str) -> None:
    """Polygons, ``geom``, and fields (name, type, size, decimals) as a shapefile: tasks make the records, then each writes its own at their places in the three files. Needs a folder that the executors share."""
    spark, fields, mark = df.sparkSession, list(fields), uuid.uuid4().hex
    new = {end: f"{path}.{mark}.{end}.part" for end in ("dbf", "shx", "shp")}

    def put(batches, part):
        n, size, box = 0, 0, [1e300, 1e300, -1e300, -1e300]

        def made():
            nonlocal n, size, box
            for b in batches:
                bodies = [shapefile.body_of(w) for w in b.column("geom").to_pylist()]
                values = zip(*[b.column(f[0]).to_pylist() for f in fields], strict=True)
                for w in bodies:
                    size += 8 + len(w)
                    box = shapefile.bounds(box, w)
                n += len(bodies)
                yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.binary()), pa.array([shapefile.attributes(v, fields) for v in values], pa.binary())], ["body", "row"])

        stored(made(), part)
        return n, size, *box

    parts = parted(spread(df.select(*[f[0] for f in fields], "geom")), path, put, "n long, size long, x0 double, y0 double, x1 double, y1 double")
    rows, at = [0], [0]
    for _, n, size, *_ in parts:
        rows.append(rows[-1] + n)
        at.append(at[-1] + size)
    box = [f(p[3 + k] for p in parts) for k, f in enumerate((min, min, max, max))] if parts else [0.0] * 4
    heads = shapefile.heads(rows[-1], at[-1], box, fields)
    for end, head in zip(("shp", "shx", "dbf"), heads, strict=True):
        with open(new[end], "wb") as f:
            f.write(head)
            if end == "dbf":
                f.seek(len(head) + rows[-1] * shapefile.row_size(fields))
                f.write(b"\x1a")
    sizes = [len(h) for h in heads]

    def fill(k):
        with open(new["shp"], "r+b") as shp, open(new["shx"], "r+b") as shx, open(new["dbf"], "r+b") as dbf, pa.memory_map(parts[k][0]) as source:
            for f, size, place in ((shp, sizes[0], at[k]), (shx, sizes[1], 8 * rows[k]), (dbf, sizes[2], rows[k] * shapefile.row_size(fields))):
                f.seek(size + place)
            n, place = rows[k], sizes[0] + at[k]
            for b in pa.ipc.open_stream(source):
                for body, row in zip(b.column("body").to_pylist(), b.column("row").to_pylist(), strict=True):
                    n += 1
                    shp.write(shapefile.numbered(n, body))
                    shx.write(shapefile.indexed(place, body))
                    dbf.write(row)
                    place += 8 + len(body)
        return []

    geojson.ranged(spark, len(parts), fill, "none long")
    shapefile.describe(path, wkt)
    for end, made in new.items():  # the shapes last, with which the parts go
        placed(made, str(Path(path).with_suffix(f".{end}")))


def write_geotiff(cells: DataFrame, path: str, shape: tuple[int, int], place: tuple[float, float, float, float], epsg: int, nodata: float) -> None:
    """Cells (row, col, z) as a GeoTIFF of 32-bit numbers: a strip of 64 rows is made of its cells, dealt by strips, and lies with its task's others in a part, which is copied to its place. Cells that are missing, or have no value, get ``nodata``. Needs a folder that the executors share."""
    import numpy as np

    (height, width), rows_of = shape, tiff.STRIP_ROWS
    n, spark = -(-height // rows_of), cells.sparkSession
    # about a million cells to a task; a row for each strip, so that none is missing
    tasks = max(1, -(-height * width // (1 << 20)))
    every = spark.range(0, n, 1, 1).select(F.col("id").alias("strip"), F.lit(None).cast("int").alias("row"), F.lit(None).cast("int").alias("col"), F.lit(None).cast("double").alias("z"))
    dealt = cells.select(F.expr(f"cast(row AS long) div {rows_of}").alias("strip"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col("z").cast("double").alias("z")).unionByName(every).repartitionByRange(tasks, "strip").sortWithinPartitions("strip")

    def put(batches, part):
        sizes, first, now, grid = [], None, None, None
        with open(part, "wb") as f:

            def out():
                raw = tiff.strip(grid)
                sizes.append(len(raw))
                f.write(raw)

            for b in batches:
                strips = b.column("strip").to_numpy()
                for s in np.unique(strips).tolist():
                    if s != now:
                        if grid is not None:
                            out()
                        now, grid = s, np.full((min(rows_of, height - s * rows_of), width), nodata, np.float32)
                        first = s if first is None else first
                    own = b.filter(pa.array((strips == s) & b.column("row").is_valid().to_numpy(zero_copy_only=False)))
                    z = own.column("z").to_numpy(zero_copy_only=False)
                    grid[own.column("row").to_numpy() - s * rows_of, own.column("col").to_numpy()] = np.where(np.isnan(z), nodata, z)
            out()
        return first, json.dumps(sizes)

    parts = parted(dealt, path, put, "first long, sizes string")
    sizes = [json.loads(s) for _, _, s in parts]
    begin = tiff.head(shape, [v for s in sizes for v in s], place, epsg, nodata)
    pieces(spark, path, [p for p, *_ in parts], [sum(s) for s in sizes], begin, b"", b"")


def pieces(spark: SparkSession, path: str, parts: list[str], sizes: list[int], begin: bytes, between: bytes, end: bytes) -> None:
    """One file of what parts have: a task copies each to its place."""
    new, at = f"{path}.{uuid.uuid4().hex}.part", [len(begin)]
    for size in sizes:
        at.append(at[-1] + size + len(between))
    with open(new, "wb") as f:
        f.write(begin)
        f.seek(at[-1] - len(between) if parts else len(begin))
        f.write(end)

    def copy(k):
        with open(parts[k], "rb") as source, open(new, "r+b") as f:
            f.seek(at[k])
            shutil.copyfileobj(source, f, 1 << 20)
            if k + 1 < len(parts):
                f.write(between)
        return []

    geojson.ranged(spark, len(parts), copy, "none long")
    placed(new, path)


def joined(rows: DataFrame, path: str, begin: bytes, between: bytes, end: bytes) -> None:
    """Writes one file from texts in their order, one column: each task writes a part, then each copies its part to its place in the file. Needs a folder that the executors share."""

    def put(batches, part):
        with open(part, "wb") as f:
            for b in batches:
                f.write((between if f.tell() else b"") + between.join(x.encode() for x in b.column(0).to_pylist()))
            return (f.tell(),)

    parts = parted(rows, path, put, "size long")
    pieces(rows.sparkSession, path, [p for p, _ in parts], [n for _, n in parts], begin, between, end)


def write_geojson(df: DataFrame, path: str, lonlat: bool = True, epsg: int = K.PLANE) -> None:
    """A FeatureCollection in one file, written side by side. Shapes that aren't turned to longitude and latitude are said to be of ``epsg``."""
    crs = "" if lonlat else f'"crs":{{"type":"name","properties":{{"name":"urn:ogc:def:crs:EPSG::{epsg}"}}}},'
    joined(_features(spread(df), lonlat), path, f'{{"type":"FeatureCollection",{crs}"features":[\n'.encode(), b",\n", b"\n]}\n")


BOUNDS = ("minx", "maxx", "miny", "maxy")


def write_gpkg(df: DataFrame, path: str, layer: str) -> None:
    """A GeoPackage table with its spatial index, written by one task beside the target and put in place; other layers of the file stay. For results of a size that people open."""
    flat = writable(df).drop("fid")
    kinds = {"long": "INTEGER", "integer": "INTEGER", "double": "REAL", "boolean": "BOOLEAN", "binary": "BLOB"}
    fields = [(f.name, kinds.get(f.dataType.typeName(), "TEXT")) for f in flat.schema.fields]
    names = [n for n, _ in fields]
    quoted = lambda n: '"' + n.replace('"', '""') + '"'
    has_shape, srs = "geom" in names, K.PLANE
    box = K.shape("geom") if has_shape else None
    rows = flat.select(*[F.col(f"`{n.replace('`', '``')}`").alias(f"c{k}") for k, n in enumerate(names)], *([box[b].alias(f"b_{b}") for b in BOUNDS] if has_shape else []))
    head = b"GP\x00\x01" + struct.pack("<i", srs)

    def write(batches, part):
        if Path(path).exists():
            shutil.copyfile(path, part)
        with sqlite3.connect(part) as con:
            con.executescript("PRAGMA application_id = 1196444487; CREATE TABLE IF NOT EXISTS gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, srs_id INTEGER); CREATE TABLE IF NOT EXISTS gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT, description TEXT); CREATE TABLE IF NOT EXISTS gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER); CREATE TABLE IF NOT EXISTS gpkg_extensions (table_name TEXT, column_name TEXT, extension_name TEXT, definition TEXT, scope TEXT);")
            index = quoted(f"rtree_{layer}_geom")
            con.execute(f"DROP TABLE IF EXISTS {quoted(layer)}")
            con.execute(f"DROP TABLE IF EXISTS {index}")
            for known in ("gpkg_contents", "gpkg_geometry_columns", "gpkg_extensions"):
                con.execute(f"DELETE FROM {known} WHERE table_name = ?", (layer,))
            con.execute("INSERT OR REPLACE INTO gpkg_spatial_ref_sys VALUES ('NAD83 / Maryland', ?, 'EPSG', ?, 'undefined', NULL)", (srs, srs))
            con.execute(f"CREATE TABLE {quoted(layer)} (fid INTEGER PRIMARY KEY, " + ", ".join(f"{quoted(n)} {k}" for n, k in fields) + ")")
            con.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?)", (layer, layer, srs))
            con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', ?, 0, 0)", (layer, srs))
            if has_shape:
                con.execute("INSERT INTO gpkg_extensions VALUES (?, 'geom', 'gpkg_rtree_index', 'http://www.geopackage.org/spec120/#extension_rtree', 'write-only')", (layer,))
                con.execute(f"CREATE VIRTUAL TABLE {index} USING rtree(id, minx, maxx, miny, maxy)")
            fid = 0
            for b in batches:
                cols = [[None if v is None else head + v for v in c.to_pylist()] if n == "geom" else [int(v) if isinstance(v, bool) else v if v is None or isinstance(v, int | float | str | bytes) else str(v) for v in c.to_pylist()] for n, c in zip(names, b.columns, strict=False)]
                ids = range(fid + 1, fid + 1 + b.num_rows)
                con.executemany(f"INSERT INTO {quoted(layer)} VALUES (?{', ?' * len(names)})", zip(ids, *cols, strict=True))
                if has_shape:
                    bounds = zip(ids, *[b.column(f"b_{x}").to_pylist() for x in BOUNDS], strict=True)
                    con.executemany(f"INSERT INTO {index} VALUES (?, ?, ?, ?, ?)", (r for r in bounds if r[1] is not None))
                fid += b.num_rows
        con.close()

    streamed(rows, path, write)
