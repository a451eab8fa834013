"""GeoJSON of any size as many tasks: features are found in byte ranges, their fields in all of them.

A file is read in ranges of ``CHUNK`` bytes. What a range means depends on what stands before it: whether it begins inside
a string, and how deep. So a first pass tells, for either case, whether a range's quotes are odd, and by how much and how
low it changes the depth; running sums over the ranges (a line for each, like a list of file splits) then give every
range its beginning. A second pass looks only at ranges that reach the top level and finds where the features stand and
what the ``crs`` member says, wherever it is. After that each range yields the features that begin in it, the last one
read on into the next range. A file of one range needs none of these passes' jobs;
small ranges share tasks, so that these grow with the bytes.

Fields and their kinds are merged over the properties of all features, in tasks first. Whole numbers are ``long``, with
others among them ``double``; a field of several kinds, of lists or of objects is text, as JSON where it isn't a string. Columns stand in the order of their names.

Line-delimited features, text sequences and a single feature or geometry are read too. ``_row`` is the feature's place in
the file in bytes. Properties that clash (other case, ``geom``, ``_row``, ``_source_file``) get a number behind the name.
"""

from __future__ import annotations

import json
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUFFIXES = (".geojson", ".json", ".geojsonl")
#: A task's range; the places of brackets and quotes in it take some ten times its bytes at worst.
CHUNK = 8 << 20
#: Bytes read before a place for the name of a member, at first to find a feature's end, and an eighth of what a batch holds.
BEFORE, MORE = 4096, 1 << 20
STEP = np.zeros(256, np.int8)
STEP[[123, 91]], STEP[[125, 93]] = 1, -1
KINDS = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6, "GeometryCollection": 7}


def wkb(g: dict | None) -> bytes | None:
    """GeoJSON coordinates as WKB: the type code, then rings or points. Heights go."""
    if not g:
        return None
    kind, c = g["type"], g.get("coordinates")
    head = struct.pack("<BI", 1, KINDS[kind])
    points = lambda ps: struct.pack("<I", len(ps)) + b"".join(struct.pack("<dd", *p[:2]) for p in ps)
    if kind == "Point":
        return head + (struct.pack("<dd", *c[:2]) if c else struct.pack("<dd", float("nan"), float("nan")))
    if kind == "LineString":
        return head + points(c)
    if kind == "Polygon":
        return head + struct.pack("<I", len(c)) + b"".join(map(points, c))
    members = g["geometries"] if kind == "GeometryCollection" else [{"type": kind[5:], "coordinates": x} for x in c]
    return head + struct.pack("<I", len(members)) + b"".join(map(wkb, members))


# ---- bytes ---------------------------------------------------------------------
class Bytes:
    """A file of the local or shared file system, or of a store named by a URI."""

    def __init__(self, path: str):
        if "://" in path:
            from pyarrow import fs

            store, at = fs.FileSystem.from_uri(path)
            self.file = store.open_input_file(at)
            self.size = self.file.size()
        else:
            self.file = open(path, "rb")  # noqa: SIM115
            self.size = self.file.seek(0, 2)

    def range(self, a: int, b: int) -> bytes:
        self.file.seek(max(a, 0))
        return self.file.read(max(min(b, self.size) - max(a, 0), 0))

    def border(self, at: int) -> int:
        """The first place from ``at`` on with no backslash before it, so that no range begins behind half an escape."""
        while 0 < at < self.size and self.range(at - 1, at) == b"\\":
            at += 1
        return min(at, self.size)

    def __enter__(self):
        return self

    def __exit__(self, *a):
        self.file.close()


def structure(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of brackets and braces, their steps in depth, whether an odd number of quotes stands before each, and the number of quotes."""
    b = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(b == 34)
    behind = np.flatnonzero((quotes > 0) & (b[quotes - 1] == 92)) if len(quotes) else quotes
    if len(behind):  # escaped by an odd run of backslashes
        run, open_ = np.ones(len(behind), np.int64), np.ones(len(behind), bool)
        while open_.any():
            at = quotes[behind] - run - 1
            open_ &= (at >= 0) & (b[np.maximum(at, 0)] == 92)
            run += open_
        quotes = np.delete(quotes, behind[run % 2 == 1])
    step = STEP[b]
    at = np.flatnonzero(step)
    return at, step[at], np.searchsorted(quotes, at) % 2 == 1, len(quotes)


def summary(data: bytes) -> tuple[int, int, int, int, int]:
    """Odd quotes; change and low of the depth if the range begins outside a string, and if inside."""
    at, step, odd, quotes = structure(data)
    out = [quotes % 2]
    for inside in (False, True):
        depth = np.cumsum(step[odd == inside], dtype=np.int64)
        out += [int(depth[-1]), min(int(depth.min()), 0)] if len(depth) else [0, 0]
    return tuple(out)


def outside(data: bytes, inside: bool, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of brackets outside strings, and the depth before and after each."""
    at, step, odd, _ = structure(data)
    own = odd == inside
    after = depth + np.cumsum(step[own], dtype=np.int64)
    return at[own], after - step[own], after


def member(before: bytes) -> bytes:
    """The name of the member whose value begins behind these bytes."""
    head = before.rstrip()
    head = head[:-1].rstrip() if head.endswith(b":") else b""
    return head[head[:-1].rfind(b'"') + 1 : -1] if head.endswith(b'"') else b""


def top(data: bytes, before: bytes, inside: bool, depth: int) -> dict:
    """What a range shows of the top level: objects that begin, where ``features`` opens and the top level's members close, and the ``crs``."""
    at, was, now = outside(data, inside, depth)
    out = {"objects": int(((was == 0) & (now == 1)).sum()), "features": [], "closes": [int(x) for x in at[(was == 2) & (now == 1)]], "crs": None}
    for p in at[(was == 1) & (now == 2)].tolist():
        name = member((before + data[:p])[-BEFORE:])
        if name == b"features" and data[p] == 91:
            out["features"].append(p)
        elif name == b"crs" and data[p] == 123:
            out["crs"] = p
    if out["objects"] > 1:  # a sequence: its members are of no interest
        out["closes"], out["features"] = [], []
    keep = [x for x in out["closes"][:1]] + [next((c for c in out["closes"] if c > p), None) for p in out["features"]]
    out["closes"] = sorted({x for x in keep if x is not None})
    return out


# ---- one file ------------------------------------------------------------------
class Layout:
    """Where a file's ranges begin and how, and where its features stand."""

    def __init__(self, path: str, starts: list[int], inside: list[bool], depth: list[int], level: int, first: int, last: int, crs: dict | None):
        self.path, self.starts, self.inside, self.depth = path, starts, inside, depth
        self.level, self.first, self.last, self.crs = level, first, last, crs

    def __len__(self) -> int:
        return len(self.starts) - 1

    @property
    def groups(self) -> list[range]:
        return shared(len(self), self.starts[-1])

    def data(self, file: Bytes, k: int) -> bytes:
        return file.range(self.starts[k], self.starts[k + 1])

    def features(self, k: int):
        """(place, text) of the features that begin in the range."""
        if self.starts[k] >= self.last or self.starts[k + 1] <= self.first:
            return
        with Bytes(self.path) as file:
            data, base = self.data(file, k), self.starts[k]
            at, was, now = outside(data, self.inside[k], self.depth[k])
            braces = np.frombuffer(data, np.uint8)[at] == 123
            begin = at[braces & (was == self.level) & (now == self.level + 1) & (at + base > self.first) & (at + base < self.last)]
            end = at[(was == self.level + 1) & (now == self.level)]
            close = np.searchsorted(end, begin)
            for p, c in zip(begin.tolist(), close.tolist(), strict=True):
                yield base + p, data[p : end[c] + 1] if c < len(end) else self._rest(file, data[p:], base + p)

    def _rest(self, file: Bytes, text: bytes, place: int) -> bytes:
        """A feature that runs over the range's end: read on, twice as far each time."""
        more = BEFORE
        while True:
            text = file.range(place, place + len(text) + more)
            at, _, now = outside(text, False, 0)
            if len(ends := at[now == 0]):
                return text[: ends[0] + 1]
            if place + len(text) >= file.size:
                raise ValueError(f"{self.path}: a feature at byte {place} doesn't end")
            more = len(text)


def ranged(spark: SparkSession, n: int, of, kind: str) -> list:
    """``of(k)``, a list of rows, for every number below ``n``, in a task each."""

    def run(batches):
        names = kind_names
        for b in batches:
            for k in b.column(0).to_pylist():
                rows = [(k, *r) for r in of(k)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)

    kind_names = ["k", *[c.split()[0] for c in kind.split(", ")]]
    return [tuple(r) for r in spark.range(0, n, 1, max(n, 1)).mapInArrow(run, f"k long, {kind}").collect()]


def shared(n: int, size: int) -> list[range]:
    """The ranges of a file of so many bytes by tasks: neighbouring ones smaller than ``CHUNK`` share one."""
    tasks = max(1, min(n, -(-size // CHUNK)))
    return [range(j * n // tasks, (j + 1) * n // tasks) for j in range(tasks)]


def layout(spark: SparkSession, path: str, chunk: int = 0) -> Layout:
    chunk = chunk or CHUNK
    with Bytes(path) as file:
        size = file.size
        n = max(1, -(-size // chunk))
        starts = [0, *[file.border(k * chunk) for k in range(1, n)], size] if n > 1 else [0, size]

    groups = shared(n, size)

    def summed(j):
        with Bytes(path) as file:
            return [(k, *summary(file.range(starts[k], starts[k + 1]))) for k in groups[j]]

    kind = "range long, odd long, change long, low long, change_in long, low_in long"
    told = summed(0) if n == 1 else sorted(r[1:] for r in ranged(spark, len(groups), summed, kind))
    inside, depth, reach, within, deep = [], [], [], False, 0
    for _, odd, change, low, change_in, low_in in told:
        inside.append(within)
        depth.append(deep)
        reach.append(deep + (low_in if within else low) <= 1)
        deep += change_in if within else change
        within ^= bool(odd)

    def tops(j):
        return [(k, one) for k in groups[j] if reach[k] for one in (shown(k),)]

    def shown(k):
        with Bytes(path) as file:
            data = file.range(starts[k], starts[k + 1])
            found = top(data, file.range(starts[k] - BEFORE, starts[k]), inside[k], depth[k])
            if found["crs"] is not None:
                place = starts[k] + found["crs"]
                text = file.range(place, place + (1 << 16)).decode("utf-8", "ignore")
                found["crs"] = json.JSONDecoder().raw_decode(text)[0]
        return json.dumps(found | {"features": [p + starts[k] for p in found["features"]], "closes": [p + starts[k] for p in found["closes"]]})

    seen = tops(0) if n == 1 else sorted(r[1:] for r in ranged(spark, len(groups), tops, "range long, found string"))
    found = [json.loads(r[1]) for r in seen]
    crs = next((f["crs"] for f in found if f["crs"]), None)
    opens = [p for f in found for p in f["features"]]
    if opens and sum(f["objects"] for f in found) == 1:
        last = next((c for f in found for c in f["closes"] if c > opens[0]), size)
        return Layout(path, starts, inside, depth, 2, opens[0], last, crs)
    return Layout(path, starts, inside, depth, 0, -1, size, crs)


def parsed(text: bytes) -> tuple[dict | None, dict]:
    """Geometry and properties of a feature, or of a bare geometry."""
    f = json.loads(text)
    if f.get("type") in KINDS:
        return f, {}
    p = f.get("properties")
    return f.get("geometry"), p if isinstance(p, dict) else {}


def kind_of(v) -> str:
    return "none" if v is None else "boolean" if isinstance(v, bool) else "long" if isinstance(v, int) and -(1 << 63) <= v < 1 << 63 else "double" if isinstance(v, int | float) else "string" if isinstance(v, str) else "nested"


def merged(kinds: set[str]) -> str:
    kinds = kinds - {"none"}
    return kinds.pop() if len(kinds) == 1 and not kinds & {"nested"} else "double" if kinds and kinds <= {"long", "double"} else "string"


def fields(spark: SparkSession, at: Layout) -> list[tuple[str, str]]:
    """Names and types of the properties of all features, in the order in which they first come."""

    groups = at.groups

    def seen(j):
        out: dict[tuple[str, str], tuple[int, int]] = {}
        for k in groups[j]:
            for place, text in at.features(k):
                for n, (name, v) in enumerate(parsed(text)[1].items()):
                    out.setdefault((name, kind_of(v)), (place, n))
        return [(name, kind, place, n) for (name, kind), (place, n) in out.items()]

    told = seen(0) if len(at) == 1 else [r[1:] for r in ranged(spark, len(groups), seen, "name string, kind string, place long, n long")]
    kinds: dict[str, set] = {}
    for name, kind, _, _ in sorted(told, key=lambda r: r[2:]):
        kinds.setdefault(name, set()).add(kind)
    return [(name, merged(k)) for name, k in kinds.items()]


def free_names(names: list[str]) -> list[str]:
    taken, out = {"geom", "_row", "_source_file"}, []
    for name in names:
        one, n = name, 1
        while one.lower() in taken:
            n += 1
            one = f"{name}_{n}"
        taken.add(one.lower())
        out.append(one)
    return out


def read(spark: SparkSession, at: Layout) -> DataFrame:
    """``_row``, the properties of all features as columns, and ``geom`` as WKB."""
    found = fields(spark, at)

    def run(batches):
        for b in batches:
            for k in b.column(0).to_pylist():
                rows, size = [], 0
                for place, text in at.features(k):
                    g, p = parsed(text)
                    rows.append((place, wkb(g), json.dumps(p, ensure_ascii=False)))
                    size += len(text)
                    if size > MORE * 8:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.string()), strict=True)], ["_row", "geom", "p"])

    n = len(at)
    rows = spark.range(0, n, 1, len(at.groups)).mapInArrow(run, "_row long, geom binary, p string")
    if not found:
        return rows.select("_row", "geom")
    kind = lambda names: T.StructType([T.StructField(name, {"long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}.get(k, T.StringType())) for name, (_, k) in zip(names, found, strict=True)])
    names = free_names([name for name, _ in found])
    given = F.from_json("p", kind([name for name, _ in found])).cast(kind(names))
    return rows.select("_row", given.alias("a"), "geom").select("_row", *[F.col("a").getField(name).alias(name) for name in sorted(names)], "geom")


@lru_cache(64)
def _layout(spark: SparkSession, path: str, size: int, changed: int) -> Layout:
    return layout(spark, path)


def layout_of(spark: SparkSession, path: str) -> Layout:
    """The file's layout, kept while the file doesn't change."""
    if "://" in path:
        return layout(spark, path)
    import os

    s = os.stat(path)
    return _layout(spark, path, s.st_size, s.st_mtime_ns)
