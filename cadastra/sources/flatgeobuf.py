"""FlatGeobuf: a Spark source whose partitions are runs of features, found in the file's packed Hilbert R-tree.

``spark.read.format("flatgeobuf").option("path", file)`` gives ``_row`` (the feature's place in the index), the columns and
``geom`` as WKB. With ``clip`` (x0,y0,x1,y1) the tree is walked from the root, reading only nodes that meet the box, and only
the features found are read. Without an index the features follow one another and are dealt by walking their lengths.
Nested collections, curves and heights: collections are read, curves are refused, heights go.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .geojson import Bytes

# The format's magic bytes, column types with their Spark types and struct codes, and geometry codes.
MAGIC = b"fgb\x03fgb"
TYPES = ("byte:b", "short:B", "boolean:?", "short:h", "int:H", "int:i", "long:I", "long:q", "decimal(20,0):Q", "float:f", "double:d", "string:", "string:", "string:", "binary:")
NODE = struct.Struct("<ddddQ")
MULTI = {4: 1, 5: 2, 6: 3}


class Table:
    """A flatbuffer's table: fields by number."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at
        self.fields = at - struct.unpack_from("<i", data, at)[0]
        self.size = struct.unpack_from("<H", data, self.fields)[0]

    @classmethod
    def root(cls, data: bytes) -> Table:
        return cls(data, struct.unpack_from("<I", data, 0)[0])

    def place(self, field: int) -> int | None:
        slot = 4 + 2 * field
        offset = struct.unpack_from("<H", self.data, self.fields + slot)[0] if slot < self.size else 0
        return self.at + offset if offset else None

    def number(self, field: int, code: str, default=0):
        at = self.place(field)
        return default if at is None else struct.unpack_from(f"<{code}", self.data, at)[0]

    def _to(self, at: int) -> int:
        return at + struct.unpack_from("<I", self.data, at)[0]

    def vector(self, field: int, code: str) -> tuple:
        at = self.place(field)
        if at is None:
            return ()
        at = self._to(at)
        n = struct.unpack_from("<I", self.data, at)[0]
        return struct.unpack_from(f"<{n}{code}", self.data, at + 4)

    def raw(self, field: int) -> bytes:
        at = self.place(field)
        if at is None:
            return b""
        at = self._to(at)
        return self.data[at + 4 : at + 4 + struct.unpack_from("<I", self.data, at)[0]]

    def text(self, field: int) -> str | None:
        return None if self.place(field) is None else self.raw(field).decode("utf-8")

    def table(self, field: int) -> Table | None:
        at = self.place(field)
        return None if at is None else Table(self.data, self._to(at))

    def tables(self, field: int) -> list[Table]:
        at = self.place(field)
        if at is None:
            return []
        at = self._to(at)
        return [Table(self.data, self._to(at + 4 + 4 * k)) for k in range(struct.unpack_from("<I", self.data, at)[0])]


class Header:
    """What a file's head says: columns, number of features, index, coordinate system; where index and features begin."""

    def __init__(self, path: str):
        with Bytes(path) as f:
            if f.range(0, 7) != MAGIC:
                raise ValueError(f"{path}: this is no FlatGeobuf file of version 3")
            size = struct.unpack("<I", f.range(8, 12))[0]
            head = Table.root(f.range(12, 12 + size))
            self.size = f.size
        self.path, self.kind = path, head.number(2, "B")
        self.columns = [(c.text(0) or "", c.number(1, "B")) for c in head.tables(7)]
        self.count, self.fan = head.number(8, "Q"), head.number(9, "H", 16)
        crs = head.table(10)
        self.crs = (crs.text(0), crs.number(1, "i"), crs.text(4)) if crs else None
        self.index = 12 + size
        self.levels = []
        if self.count and self.fan > 1:
            sizes = [self.count]
            while sizes[-1] > 1:
                sizes.append(math.ceil(sizes[-1] / self.fan))
            if self.count == 1:
                sizes.append(1)
            first = 0
            for n in reversed(sizes):  # the root first
                self.levels.append((first, first + n))
                first += n
        self.features = self.index + NODE.size * (self.levels[-1][1] if self.levels else 0)

    def nodes(self, f: Bytes, a: int, b: int) -> list[tuple]:
        return list(NODE.iter_unpack(f.range(self.index + NODE.size * a, self.index + NODE.size * b)))

    def found(self, f: Bytes, box: tuple[float, float, float, float]) -> list[tuple[int, int]]:
        """(place in the index, byte offset) of the features whose boxes meet the given one."""
        leaves = self.levels[-1][0]
        todo, out = [(0, 0)], []
        while todo:
            level, at = todo.pop()
            end = min(at + self.fan, self.levels[level][1]) if level else 1
            for k, (x0, y0, x1, y1, offset) in enumerate(self.nodes(f, at, end), at):
                if x0 <= box[2] and x1 >= box[0] and y0 <= box[3] and y1 >= box[1]:
                    if k >= leaves:
                        out.append((k - leaves, offset))
                    else:
                        todo.append((level + 1, offset))
        return sorted(out)


def crs_text(path: str) -> str | None:
    """The coordinate system as text: an EPSG number or WKT."""
    crs = Header(path).crs
    if crs is None:
        return None
    return f"EPSG:{crs[1]}" if crs[1] and (crs[0] or "EPSG").upper() == "EPSG" else crs[2]


# ---- features --------------------------------------------------------------------
def wkb(g: Table, kind: int) -> bytes:
    kind = g.number(6, "B") or kind
    xy, ends = g.vector(1, "d"), g.vector(0, "I")
    head = struct.pack("<BI", 1, kind)
    run = lambda a, b: struct.pack(f"<I{2 * (b - a)}d", b - a, *xy[2 * a : 2 * b])
    rings = lambda: [run(a, b) for a, b in zip((0, *ends[:-1]), ends or (len(xy) // 2,), strict=True)] if ends else [run(0, len(xy) // 2)] if xy else []
    if kind == 1:
        return head + struct.pack("<dd", *(xy[:2] or (math.nan, math.nan)))
    if kind == 2:
        return head + run(0, len(xy) // 2)
    if kind == 3:
        return head + struct.pack("<I", len(rings())) + b"".join(rings())
    if kind == 4:
        return head + struct.pack("<I", len(xy) // 2) + b"".join(struct.pack("<BIdd", 1, 1, *xy[k : k + 2]) for k in range(0, len(xy), 2))
    if kind == 5:
        return head + struct.pack("<I", len(rings())) + b"".join(struct.pack("<BI", 1, 2) + r for r in rings())
    if kind in (6, 7):
        parts = [wkb(p, MULTI.get(kind, 0)) for p in g.tables(7)]
        return head + struct.pack("<I", len(parts)) + b"".join(parts)
    raise ValueError(f"shapes of type {kind} are not read here")


def values(data: bytes, columns: list[tuple[str, int]]) -> list:
    """Properties: a column's number, then its value, those that are null left out."""
    out, at = [None] * len(columns), 0
    while at < len(data):
        k = struct.unpack_from("<H", data, at)[0]
        at += 2
        kind, _, code = TYPES[columns[k][1]].partition(":")
        if code:
            out[k] = struct.unpack_from(f"<{code}", data, at)[0]
            at += struct.calcsize(f"<{code}")
            if kind.startswith("decimal"):
                from decimal import Decimal

                out[k] = Decimal(out[k])
        else:
            n = struct.unpack_from("<I", data, at)[0]
            raw = data[at + 4 : at + 4 + n]
            out[k] = raw.decode("utf-8") if kind == "string" else raw
            at += 4 + n
    return out


class FlatGeobuf(DataSource):
    @classmethod
    def name(cls):
        return "flatgeobuf"

    def schema(self):
        head = Header(self.options["path"])
        return ", ".join(["_row long", *[f"`{c.replace('`', '``')}` {TYPES[k].partition(':')[0]}" for c, k in head.columns], "geom binary"])

    def reader(self, schema):
        return FlatGeobufReader(self.options["path"], self.options.get("clip"))


class FlatGeobufReader(DataSourceReader):
    STEP = 50_000

    def __init__(self, path: str, clip: str | None):
        self.path, self.clip = path, tuple(map(float, clip.split(","))) if clip else None

    def partitions(self):
        """Runs of features: (place, offset) of those found, or the first place, offset and number of those in a row."""
        head, step = Header(self.path), self.STEP
        with Bytes(self.path) as f:
            if self.clip and head.levels:
                found = head.found(f, self.clip)
                return [InputPartition(("some", found[k : k + step])) for k in range(0, len(found), step)] or [InputPartition(("some", []))]
            if head.levels:
                leaves = head.levels[-1][0]
                starts = [(k, head.nodes(f, leaves + k, leaves + k + 1)[0][4], min(step, head.count - k)) for k in range(0, head.count, step)]
                return [InputPartition(("run", *s)) for s in starts]
            out, at, k = [], 0, 0
            while head.features + at < head.size:
                if k % step == 0:
                    out.append(InputPartition(("run", k, at, step)))
                at += 4 + struct.unpack("<I", f.range(head.features + at, head.features + at + 4))[0]
                k += 1
            return out or [InputPartition(("some", []))]

    def read(self, partition):
        head, how = Header(self.path), partition.value
        with Bytes(self.path) as f:
            if how[0] == "some":
                for k, offset in how[1]:
                    yield self._row(head, f, k, offset)[0]
                return
            _, k, offset, n = how
            for j in range(k, k + n):
                if head.features + offset >= head.size:
                    return
                row, size = self._row(head, f, j, offset)
                yield row
                offset += size

    @staticmethod
    def _row(head: Header, f: Bytes, k: int, offset: int) -> tuple[tuple, int]:
        at = head.features + offset
        size = struct.unpack("<I", f.range(at, at + 4))[0]
        feature = Table.root(f.range(at + 4, at + 4 + size))
        g = feature.table(0)
        return (k, *values(feature.raw(1), head.columns), wkb(g, head.kind) if g else None), 4 + size
