"""Feature services over HTTP: layer information, coded domains, and a Spark source whose partitions are runs of offset ranges or of id chunks."""

from __future__ import annotations

import json
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .geojson import wkb as geojson_wkb

CHUNK = 200
#: A task asks for up to so many pages, one after another, once there are pages for so many tasks.
PAGES, TASKS = 50, 64


class ServiceError(RuntimeError):
    """The service answered with an error, or with something that is no JSON."""


def http_json(url: str, params: dict, timeout: float = 60.0) -> dict:
    data = urllib.parse.urlencode(params).encode()
    try:
        with urllib.request.urlopen(urllib.request.Request(url, data=data), timeout=timeout) as r:
            text = r.read().decode("utf-8")
    except urllib.error.HTTPError as e:
        raise ServiceError(f"{url}: HTTP {e.code}") from e
    try:
        out = json.loads(text)
    except ValueError as e:
        raise ServiceError(f"{url}: the answer is no JSON") from e
    if "error" in out:
        raise ServiceError(f"{url}: {out['error'].get('message', out['error'])}")
    return out


@dataclass
class LayerInfo:
    name: str
    page: int
    paged: bool
    fields: list[dict]
    srid: int | None
    id_field: str
    domains: dict[str, dict[str, str]] = field(default_factory=dict)


def info_of(raw: dict) -> LayerInfo:
    """From a layer's description; a service that tells no page size has one of 1000."""
    ref = (raw.get("extent") or {}).get("spatialReference") or raw.get("spatialReference") or {}
    fields = raw.get("fields") or []
    domains = {f["name"]: {str(v["code"]): v["name"] for v in f["domain"]["codedValues"]} for f in fields if (f.get("domain") or {}).get("codedValues")}
    ids = raw.get("objectIdField") or next((f["name"] for f in fields if f.get("type") == "esriFieldTypeOID"), "OBJECTID")
    return LayerInfo(raw.get("name", ""), raw.get("maxRecordCount") or 1000, bool((raw.get("advancedQueryCapabilities") or {}).get("supportsPagination")), fields, ref.get("latestWkid") or ref.get("wkid"), ids, domains)


@lru_cache(maxsize=64)
def layer_info(url: str) -> LayerInfo:
    return info_of(http_json(url, {"f": "json"}))


def query_params(where: str = "1=1", bbox: tuple[float, float, float, float] | None = None) -> dict:
    out = {"where": where, "outFields": "*", "outSR": 4326, "f": "geojson"}
    if bbox:
        out |= {"geometry": json.dumps(dict(zip(("xmin", "ymin", "xmax", "ymax"), bbox, strict=True)) | {"spatialReference": {"wkid": 4326}}), "geometryType": "esriGeometryEnvelope", "spatialRel": "esriSpatialRelIntersects", "inSR": 4326}
    return out


def chunks(url: str, params: dict, info: LayerInfo, page: int | None = None, get=http_json) -> list[dict]:
    """What each page adds to the query: offset ranges from the count, in the order of the ids, or else sorted ids in chunks."""
    size = min(page or info.page, info.page)
    if info.paged:
        n = get(f"{url}/query", params | {"returnCountOnly": "true", "f": "json"})["count"]
        return [{"resultOffset": k, "resultRecordCount": size, "orderByFields": info.id_field, "expect": min(size, n - k)} for k in range(0, n, size)]
    ids = sorted(get(f"{url}/query", params | {"returnIdsOnly": "true", "f": "json"}).get("objectIds") or [])
    step = min(CHUNK, size)
    return [{"objectIds": ",".join(map(str, part)), "expect": len(part)} for k in range(0, len(ids), step) for part in (ids[k : k + step],)]


def runs(pages: list[dict]) -> list[list[dict]]:
    """The pages of each task: small pages don't each make a task and a file."""
    step = max(1, min(PAGES, len(pages) // TASKS))
    return [pages[k : k + step] for k in range(0, len(pages), step)]


def features(url: str, params: dict, more: dict, get=http_json):
    """The features of one page. A service may give fewer in an answer than were asked for: the rest is asked for again, and a page that stays short is an error."""
    want, at, left = more["expect"], more.get("resultOffset", 0), more["expect"]
    ids = {k: v for k, v in more.items() if k not in ("expect", "resultOffset", "resultRecordCount")}
    while left:
        span = {"resultOffset": at, "resultRecordCount": left} if "resultOffset" in more else {}
        found = get(f"{url}/query", params | ids | span).get("features") or []
        if not found or not span and len(found) < want:
            raise ServiceError(f"{url}: {want} features were announced, {want - left + len(found)} came")
        yield from found[:left]
        at, left = at + len(found), left - min(left, len(found))


class FeatureService(DataSource):
    """``spark.read.format("featureservice").option("url", layer)``, with ``where`` and ``bbox`` (lon/lat, comma-separated) done by the service."""

    @classmethod
    def name(cls):
        return "featureservice"

    def schema(self):
        kinds = {"esriFieldTypeOID": "long", "esriFieldTypeInteger": "long", "esriFieldTypeSmallInteger": "long", "esriFieldTypeDouble": "double", "esriFieldTypeSingle": "double", "esriFieldTypeDate": "long"}
        return ", ".join(f"`{f['name']}` {kinds.get(f.get('type'), 'string')}" for f in layer_info(self.options["url"]).fields if f.get("type") != "esriFieldTypeGeometry") + ", geom binary"

    def reader(self, schema):
        return FeatureReader(dict(self.options), schema)


class FeatureReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        bbox = tuple(map(float, options["bbox"].split(","))) if options.get("bbox") else None
        self.url, self.params, self.fields = options["url"], query_params(options.get("where", "1=1"), bbox), schema

    def partitions(self):
        return [InputPartition(r) for r in runs(chunks(self.url, self.params, layer_info(self.url)))] or [InputPartition([])]

    def read(self, partition):
        cast = {"string": str, "double": float, "long": int}
        kinds = [(f.name, cast.get(f.dataType.typeName(), lambda v: v)) for f in self.fields if f.name != "geom"]
        for page in partition.value:
            for f in features(self.url, self.params, page):
                own = f.get("properties") or {}
                yield (*[None if own.get(n) is None else c(own[n]) for n, c in kinds], geojson_wkb(f.get("geometry")))


def read_service(spark: SparkSession, url: str, where: str | None = None, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    spark.dataSource.register(FeatureService)
    options = {"url": url} | ({"where": where} if where else {}) | ({"bbox": ",".join(map(str, bbox))} if bbox else {})
    return spark.read.format("featureservice").options(**options).load()


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    """The values of a field, no nulls, in the order of their text."""
    return df.select(F.col(name)).where(F.col(name).isNotNull()).distinct().orderBy(F.col(name).cast("string"))


def fetch(spark: SparkSession, url: str, cache: str, where: str | None = None, bbox: tuple[float, float, float, float] | None = None) -> None:
    """A layer to Parquet with WKB in longitude and latitude, as its ``_crs`` column says; a cache path without an ending gets ``.parquet``."""
    read_service(spark, url, where, bbox).withColumn("_crs", F.lit(4326)).write.mode("overwrite").parquet(cache_path(cache))


def cache_path(path: str) -> str:
    """Where a fetched layer is kept: beside the configured path, as Parquet."""
    return path if path.endswith(".parquet") else path.rsplit(".", 1)[0] + ".parquet" if "." in path.rsplit("/", 1)[-1] else path + ".parquet"
