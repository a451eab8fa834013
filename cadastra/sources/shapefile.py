"""Shapefiles: a Spark source whose partitions are ranges of records, a writer for small layers, and the pieces of which ``files.write_shapefile`` makes large ones."""

from __future__ import annotations

import struct
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

STEP = 50_000
POINT, LINE, POLYGON, POINTS = 1, 3, 5, 8


def table_of(path: str) -> tuple[int, int, int, list[tuple[str, str, int, int]], str]:
    """(rows, bytes before the first row, bytes of a row, [(name, type, size, decimals)], text encoding) of the attribute file."""
    at = Path(path).with_suffix(".dbf")
    if not at.exists():
        return -1, 0, 0, [], "latin-1"
    with at.open("rb") as f:
        head = f.read(32)
        rows, first, size = struct.unpack_from("<IHH", head, 4)
        fields = []
        while (one := f.read(32)) and one[0] != 0x0D:
            fields.append((one[:11].split(b"\0")[0].decode("latin-1"), chr(one[11]), one[16], one[17]))
    page = Path(path).with_suffix(".cpg")
    return rows, first, size, fields, page.read_text().strip() if page.exists() else "latin-1"


def kind_of(kind: str, decimals: int) -> str:
    return {"N": "double" if decimals else "long", "F": "double", "L": "boolean"}.get(kind, "string")


def value_of(raw: bytes, kind: str, decimals: int, encoding: str):
    text = raw.decode(encoding, "replace").strip().strip("\0")
    if kind == "L":
        return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
    if not text or text.startswith("*"):
        return None
    if kind == "N" and not decimals:
        return int(float(text))
    return float(text) if kind in "NF" else text


def offsets(path: str, lo: int = 0, hi: int | None = None) -> list[int]:
    """Where each record of a range begins, by that part of the index file or, without one, by the records' lengths."""
    index = Path(path).with_suffix(".shx")
    if index.exists():
        with index.open("rb") as f:
            f.seek(100 + 8 * lo)
            raw = f.read(-1 if hi is None else 8 * (hi - lo))
        return [2 * v for v in struct.unpack(f">{len(raw) // 8 * 2}i", raw[: len(raw) // 8 * 8])[::2]]
    out, size = [], Path(path).stat().st_size
    with Path(path).open("rb") as f:
        at = 100
        while at + 8 <= size:
            out.append(at)
            f.seek(at + 4)
            at += 8 + 2 * struct.unpack(">i", f.read(4))[0]
    return out[lo:hi]


def count(path: str) -> int:
    index = Path(path).with_suffix(".shx")
    return (index.stat().st_size - 100) // 8 if index.exists() else len(offsets(path))


def inside(x: float, y: float, ring: list[tuple[float, float]]) -> bool:
    odd = False
    for (x0, y0), (x1, y1) in zip(ring, ring[1:]):
        if (y0 > y) != (y1 > y) and x < (x1 - x0) * (y - y0) / (y1 - y0) + x0:
            odd = not odd
    return odd


def signed(ring: list[tuple[float, float]]) -> float:
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:])) / 2


def wkb_of(body: bytes) -> bytes | None:
    """A record's shape as WKB: heights and measures are left out; holes go to the smallest outer ring about them."""
    kind = struct.unpack_from("<i", body)[0]
    kind = kind % 10 if kind > 10 else kind
    if kind == 0:
        return None
    packed = lambda ps: struct.pack("<I", len(ps)) + b"".join(struct.pack("<dd", *p) for p in ps)
    if kind == POINT:
        return struct.pack("<BI", 1, 1) + body[4:20]
    if kind == POINTS:
        n = struct.unpack_from("<i", body, 36)[0]
        return struct.pack("<BII", 1, 4, n) + b"".join(struct.pack("<BI", 1, 1) + body[40 + 16 * k : 56 + 16 * k] for k in range(n))
    if kind not in (LINE, POLYGON):
        raise ValueError(f"shape type {kind}")
    n, m = struct.unpack_from("<ii", body, 36)
    starts = [*struct.unpack_from(f"<{n}i", body, 44), m]
    flat = struct.unpack_from(f"<{2 * m}d", body, 44 + 4 * n)
    parts = [list(zip(flat[2 * a : 2 * b : 2], flat[2 * a + 1 : 2 * b : 2], strict=True)) for a, b in zip(starts, starts[1:])]
    if kind == LINE:
        lines = [struct.pack("<BI", 1, 2) + packed(p) for p in parts]
        return lines[0] if n == 1 else struct.pack("<BII", 1, 5, n) + b"".join(lines)
    outer = [[p] for p in parts if signed(p) <= 0] or [[p] for p in parts]
    for hole in (p for p in parts if signed(p) > 0) if any(signed(p) <= 0 for p in parts) else ():
        around = [o for o in outer if inside(*hole[0], o[0])]
        (min(around, key=lambda o: abs(signed(o[0]))) if around else outer[0]).append(hole)
    shapes = [struct.pack("<BII", 1, 3, len(o)) + b"".join(map(packed, o)) for o in outer]
    return shapes[0] if len(shapes) == 1 else struct.pack("<BII", 1, 6, len(shapes)) + b"".join(shapes)


class Shapefile(DataSource):
    """``spark.read.format("shapefile").option("path", file)``: attributes, ``geom`` as WKB and ``_row``; option ``clip`` (x0,y0,x1,y1) skips records by their bounds."""

    @classmethod
    def name(cls):
        return "shapefile"

    def schema(self):
        return ", ".join(["_row long", *(f"`{n}` {kind_of(k, d)}" for n, k, _, d in table_of(self.options["path"])[3]), "geom binary"])

    def reader(self, schema):
        return ShapefileReader(dict(self.options))


class ShapefileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.clip = tuple(map(float, options["clip"].split(","))) if options.get("clip") else None

    def partitions(self):
        n = count(self.path)
        return [InputPartition((k, min(k + STEP, n))) for k in range(0, n, STEP)] or [InputPartition((0, 0))]

    def read(self, partition):
        lo, hi = partition.value
        rows, first, size, fields, encoding = table_of(self.path)
        with Path(self.path).open("rb") as shapes:
            table = Path(self.path).with_suffix(".dbf").open("rb") if rows >= 0 else None
            for k, at in enumerate(offsets(self.path, lo, hi), lo):
                shapes.seek(at + 4)
                body = shapes.read(2 * struct.unpack(">i", shapes.read(4))[0])
                if self.clip and struct.unpack_from("<i", body)[0] % 10 in (LINE, POLYGON, POINTS):
                    x0, y0, x1, y1 = struct.unpack_from("<4d", body, 4)
                    if x0 > self.clip[2] or x1 < self.clip[0] or y0 > self.clip[3] or y1 < self.clip[1]:
                        continue
                values = []
                if table:
                    table.seek(first + k * size)
                    raw = table.read(size)
                    if raw[:1] == b"*":  # a deleted row
                        continue
                    at = 1
                    for _, kind, width, decimals in fields:
                        values.append(value_of(raw[at : at + width], kind, decimals, encoding))
                        at += width
                yield (k, *values, wkb_of(body))
            if table:
                table.close()


# ---- writing -------------------------------------------------------------------
def body(rings: list[list[tuple[float, float]]]) -> bytes:
    """A polygon's record behind its number and length; outer rings are clockwise."""
    xs, ys = [x for r in rings for x, _ in r], [y for r in rings for _, y in r]
    starts = [sum(map(len, rings[:i])) for i in range(len(rings))]
    return struct.pack("<i4dii", POLYGON, min(xs), min(ys), max(xs), max(ys), len(rings), len(xs)) + struct.pack(f"<{len(rings)}i", *starts) + b"".join(struct.pack("<dd", *p) for r in rings for p in r)


def body_of(w: bytes | None) -> bytes:
    """The record of a polygon or several, given as WKB: outer rings clockwise, holes the other way; none is an empty record."""
    if w is None:
        return struct.pack("<i", 0)
    order = lambda at: "<" if w[at] == 1 else ">"
    kind, n = struct.unpack_from(order(0) + "II", w, 1)
    if kind not in (3, 6):
        raise ValueError(f"no polygon: WKB type {kind}")
    rings, at = [], 9 if kind == 6 else 0
    for _ in range(n if kind == 6 else 1):
        o = order(at)
        count, at = struct.unpack_from(o + "I", w, at + 5)[0], at + 9
        for k in range(count):
            m = struct.unpack_from(o + "I", w, at)[0]
            flat = struct.unpack_from(f"{o}{2 * m}d", w, at + 4)
            ring, at = list(zip(flat[::2], flat[1::2], strict=True)), at + 4 + 16 * m
            rings.append(ring if (signed(ring) < 0) == (k == 0) else ring[::-1])
    return body(rings) if rings else struct.pack("<i", 0)


def bounds(box: list[float], body: bytes) -> list[float]:
    if len(body) == 4:
        return box
    x0, y0, x1, y1 = struct.unpack_from("<4d", body, 4)
    return [min(box[0], x0), min(box[1], y0), max(box[2], x1), max(box[3], y1)]


def numbered(number: int, body: bytes) -> bytes:
    return struct.pack(">ii", number, len(body) // 2) + body


def indexed(place: int, body: bytes) -> bytes:
    return struct.pack(">ii", place // 2, len(body) // 2)


def row_size(fields: list[tuple[str, str, int, int]]) -> int:
    return 1 + sum(f[2] for f in fields)


def attributes(values, fields: list[tuple[str, str, int, int]]) -> bytes:
    out = b" "
    for (_, kind, width, decimals), v in zip(fields, values, strict=True):
        text = "" if v is None else f"{v:.{decimals}f}" if kind in "NF" else str(v)
        out += (text.rjust(width) if kind in "NF" else text.ljust(width)).encode("utf-8")[:width].ljust(width)
    return out


def heads(rows: int, size: int, box: list[float], fields: list[tuple[str, str, int, int]]) -> tuple[bytes, bytes, bytes]:
    """What stands before the records, the index and the attributes, for so many rows and bytes of records."""
    head = lambda n: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 50 + n // 2) + struct.pack("<ii4d4d", 1000, POLYGON, *box, 0, 0, 0, 0)
    table = struct.pack("<BBBBIHH20x", 3, 126, 1, 1, rows, 33 + 32 * len(fields), row_size(fields))
    table += b"".join(struct.pack("<11sc4xBB14x", n.encode(), k.encode(), w, d) for n, k, w, d in fields) + b"\r"
    return head(size), head(8 * rows), table


def describe(path: str, wkt: str) -> None:
    Path(path).with_suffix(".cpg").write_text("UTF-8")
    Path(path).with_suffix(".prj").write_text(wkt)


def write_shapefile(path: str, rows: list[tuple], fields: list[tuple[str, str, int, int]], wkt: str) -> None:
    """Rows of values and, last, the rings of a polygon (outer ones clockwise); for small layers, as of the synthetic county."""
    bodies, box, at = [body(row[-1]) for row in rows], [1e300, 1e300, -1e300, -1e300], 100
    index = []
    for b in bodies:
        box = bounds(box, b)
        index.append(indexed(at, b))
        at += 8 + len(b)
    home, (shp, shx, dbf) = Path(path), heads(len(rows), at - 100, box, fields)
    home.parent.mkdir(parents=True, exist_ok=True)
    home.write_bytes(shp + b"".join(numbered(k, b) for k, b in enumerate(bodies, 1)))
    home.with_suffix(".shx").write_bytes(shx + b"".join(index))
    home.with_suffix(".dbf").write_bytes(dbf + b"".join(attributes(row[:-1], fields) for row in rows) + b"\x1a")
    describe(path, wkt)
