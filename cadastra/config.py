"""Run configuration: frozen records read from YAML, with paths relative to the file, and their checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any


class ConfigError(ValueError):
    """The configuration or the data's codes do not fit each other."""


@dataclass(frozen=True)
class Constraint:
    name: str
    type: str
    category: str
    implication: str
    subtract_from_usable: bool = False
    crossable_with_permit: bool = False
    manual_flag: str | None = None
    name_field: str | None = None
    where: str | None = None
    path: str | None = None
    url: str | None = None
    layer: str | None = None
    lines: dict | None = None

    def __post_init__(self):
        if self.category not in ("legal", "physical"):
            raise ConfigError(f"constraint {self.name}: category must be legal or physical")
        if self.implication not in ("favorable", "hostile", "varies", "physical"):
            raise ConfigError(f"constraint {self.name}: implication must be favorable, hostile, varies or physical")


@dataclass(frozen=True)
class Zoning:
    county: str
    code_field: str | None = None
    codes: dict = field(default_factory=dict)
    path: str | None = None
    url: str | None = None
    layer: str | None = None
    mapping: str | None = None


@dataclass(frozen=True)
class RowLayer:
    name: str
    authority: str = "unknown"
    public: bool = True
    geometry: str = "polygon"
    row_width_ft: float | None = None
    path: str | None = None
    url: str | None = None
    layer: str | None = None
    where: str | None = None

    def __post_init__(self):
        if self.geometry not in ("polygon", "line"):
            raise ConfigError(f"right-of-way layer {self.name}: geometry must be polygon or line")
        if self.geometry == "line" and not self.row_width_ft:
            raise ConfigError(f"right-of-way layer {self.name}: lines need row_width_ft")


@dataclass(frozen=True)
class Access:
    row_layers: tuple[RowLayer, ...] = ()
    contact_tolerance_ft: float = 3.0
    open_gap_ft: float = 25.0
    min_contact_ft: float = 20.0
    frontage_search_ft: float = 250.0
    frontage_sample_ft: float = 15.0
    frontage_blocked_threshold: float = 0.95
    strip_max_width_ft: float = 100.0
    strip_min_aspect: float = 6.0
    sliver_acres: float = 0.25


@dataclass(frozen=True)
class Slope:
    dem_path: str | None = None
    polygons_path: str | None = None
    dem_vertical_unit_to_m: float = 1.0
    dem_resample_m: float | None = None
    crossable: bool = False


@dataclass(frozen=True)
class Config:
    counties: dict[str, str]
    schema: dict[str, dict[str, list[str]]]
    acreage_min: float = 40.0
    acreage_max: float | None = None
    slope_max_pct: float = 15.0
    study_area: str | None = None
    study_area_selection: str = "intersects"
    working_crs: str = "EPSG:26985"
    parcels: dict = field(default_factory=dict)
    acreage_source: str = "sdat"
    acreage_disagreement_pct: float = 10.0
    zoning: tuple[Zoning, ...] = ()
    on_unmapped_zoning: str = "error"
    constraints: tuple[Constraint, ...] = ()
    slope: Slope = Slope()
    access: Access = Access()
    process_all: bool = False
    output_dir: str = "outputs"
    raw: dict = field(default_factory=dict)

    def __post_init__(self):
        if not self.counties:
            raise ConfigError("counties must not be empty")
        if self.study_area_selection not in ("intersects", "centroid", "within"):
            raise ConfigError("study_area_selection must be intersects, centroid or within")
        if self.acreage_source not in ("sdat", "geometry"):
            raise ConfigError("acreage_source must be sdat or geometry")
        if self.on_unmapped_zoning not in ("error", "flag"):
            raise ConfigError("on_unmapped_zoning must be error or flag")
        names = [c.name for c in self.constraints]
        if len(set(names)) != len(names):
            raise ConfigError("constraint names must differ")

    def zoning_for(self, county: str) -> Zoning | None:
        return next((z for z in self.zoning if z.county == county), None)


def _only(kind: type, given: dict[str, Any], **more) -> Any:
    known = {k: v for k, v in (given | more).items() if k in kind.__dataclass_fields__}
    return kind(**known)


def load(path: str) -> Config:
    """Reads the YAML file; every path in it is taken relative to its folder."""
    import yaml

    home = Path(path).resolve().parent
    raw = yaml.safe_load(Path(path).read_text()) or {}
    at = lambda p: None if p is None else str(p) if "://" in str(p) else str((home / p).resolve())

    def source(d: dict) -> dict:
        out = dict(d) | {"path": at(d.get("path"))}
        if lines := d.get("derive_from_lines"):
            out["lines"] = dict(lines) | {"path": at(lines.get("path"))}
        if not (out.get("path") or out.get("url") or out.get("lines")):
            raise ConfigError(f"{d.get('name') or d.get('county')}: a path, a url or lines are needed")
        return out

    zones = []
    for z in raw.get("zoning", []):
        mapping = at(z.get("mapping"))
        own = yaml.safe_load(Path(mapping).read_text()) if mapping and Path(mapping).exists() else {}
        zones.append(_only(Zoning, source(z), mapping=mapping, codes={str(k): v for k, v in (own.get("codes") or {}).items()}, code_field=z.get("code_field") or own.get("code_field")))
    parcels = raw.get("parcels") or {}
    schema_path = at(parcels.get("schema"))
    schema = yaml.safe_load(Path(schema_path).read_text()) if schema_path else {"required": {}, "optional": {}}
    schema = {k: {c: [f] if isinstance(f, str) else list(f) for c, f in (v or {}).items()} for k, v in schema.items()}
    access, run = raw.get("access") or {}, raw.get("run") or {}
    slope = raw.get("slope") or {}
    return _only(
        Config, raw, raw=raw, schema=schema, study_area=at(raw.get("study_area")), zoning=tuple(zones),
        parcels=dict(parcels) | {"path": at(parcels.get("path"))},
        acreage_source=parcels.get("acreage_source", "sdat"), acreage_disagreement_pct=parcels.get("acreage_disagreement_pct", 10),
        constraints=tuple(_only(Constraint, source(c)) for c in raw.get("constraints", [])),
        slope=_only(Slope, slope, dem_path=at(slope.get("dem_path")), polygons_path=at(slope.get("polygons_path"))),
        access=_only(Access, access, row_layers=tuple(_only(RowLayer, source(r)) for r in access.get("row_layers", []))),
        process_all=run.get("process_all", False), output_dir=at(run.get("output_dir", "outputs")), counties=raw.get("counties") or {},
    )
