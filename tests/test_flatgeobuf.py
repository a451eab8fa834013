"""FlatGeobuf files, made here after the published layout with the flatbuffers library, read whole and by a box."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from cadastra.kernel import functions as K
from cadastra.sources import files, flatgeobuf

flatbuffers = pytest.importorskip("flatbuffers")
COLUMNS = [("k", 5), ("name", 11), ("m", 10), ("ok", 2), ("big", 7), ("raw", 14), ("small", 3), ("no", 8), ("when", 13)]


def numbers(b, code, values):
    size = struct.calcsize(code)
    b.StartVector(size, len(values), size)
    put = {"d": b.PrependFloat64, "I": b.PrependUint32, "B": b.PrependByte}[code]
    for v in reversed(values):
        put(v)
    return b.EndVector()


def offsets(b, made):
    b.StartVector(4, len(made), 4)
    for o in reversed(made):
        b.PrependUOffsetTRelative(o)
    return b.EndVector()


def geometry(b, g):
    kind, ends, xy, parts = g
    parts = offsets(b, [geometry(b, p) for p in parts]) if parts else None
    ends, xy = numbers(b, "I", ends) if ends else None, numbers(b, "d", xy) if xy else None
    b.StartObject(8)
    for slot, o in ((0, ends), (1, xy), (7, parts)):
        if o is not None:
            b.PrependUOffsetTRelativeSlot(slot, o, 0)
    b.PrependUint8Slot(6, kind, 0)
    return b.EndObject()


def sized(b, root):
    b.Finish(root)
    out = bytes(b.Output())
    return struct.pack("<I", len(out)) + out


def feature(row, g):
    b = flatbuffers.Builder(256)
    codes = {5: "i", 10: "d", 2: "?", 7: "q", 3: "h", 8: "Q"}
    props = b""
    for k, ((_, kind), v) in enumerate(zip(COLUMNS, row, strict=True)):
        if v is not None:
            raw = v.encode() if isinstance(v, str) else v
            props += struct.pack("<H", k) + (struct.pack("<" + codes[kind], v) if kind in codes else struct.pack("<I", len(raw)) + raw)
    props = numbers(b, "B", list(props)) if props else None
    g = geometry(b, g) if g else None
    b.StartObject(3)
    for slot, o in ((0, g), (1, props)):
        if o is not None:
            b.PrependUOffsetTRelativeSlot(slot, o, 0)
    return sized(b, b.EndObject())


def header(count, fan, kind, epsg, wkt):
    b = flatbuffers.Builder(256)
    columns = []
    for name, code in COLUMNS:
        text = b.CreateString(name)
        b.StartObject(11)
        b.PrependUOffsetTRelativeSlot(0, text, 0)
        b.PrependUint8Slot(1, code, 0)
        columns.append(b.EndObject())
    columns = offsets(b, columns)
    wkt = b.CreateString(wkt) if wkt else None
    crs = None
    if epsg or wkt:
        b.StartObject(6)
        b.PrependInt32Slot(1, epsg, 0)
        if wkt:
            b.PrependUOffsetTRelativeSlot(4, wkt, 0)
        crs = b.EndObject()
    b.StartObject(14)
    b.PrependUint8Slot(2, kind, 0)
    b.PrependUOffsetTRelativeSlot(7, columns, 0)
    b.PrependUint64Slot(8, count, 0)
    b.PrependUint16Slot(9, fan, 16)
    if crs:
        b.PrependUOffsetTRelativeSlot(10, crs, 0)
    return sized(b, b.EndObject())


def write(path, rows, shapes, boxes, fan=16, kind=0, epsg=26985, wkt=None):
    features = [feature(r, g) for r, g in zip(rows, shapes, strict=True)]
    level, at = [], 0
    for f, b in zip(features, boxes, strict=True):
        level.append((*b, at))
        at += len(f)
    levels = [level]
    while fan > 1 and rows and (len(levels[-1]) > 1 or len(levels) == 1):
        below = levels[-1]
        levels.append([(min(n[0] for n in below[k : k + fan]), min(n[1] for n in below[k : k + fan]), max(n[2] for n in below[k : k + fan]), max(n[3] for n in below[k : k + fan]), k) for k in range(0, len(below), fan)])
    index, first = b"", 0
    for k, nodes in enumerate(reversed(levels) if fan > 1 and rows else []):
        first += len(nodes)  # where the next level begins: children are numbered in the whole tree
        leaf = k == len(levels) - 1
        index += b"".join(struct.pack("<ddddQ", *n[:4], n[4] if leaf else first + n[4]) for n in nodes)
    path.write_bytes(b"fgb\x03fgb\x00" + header(len(rows), fan, kind, epsg, wkt) + index + b"".join(features))


def square(x, y, s=10.0):
    return (3, [], [x, y, x + s, y, x + s, y + s, x, y + s, x, y], [])


@pytest.fixture(scope="module")
def geo(spark):
    K.register(spark)
    return spark


@pytest.mark.parametrize(("n", "fan"), [(500, 16), (500, 3), (500, 0), (17, 16), (1, 16), (2, 2)])
def test_whole_and_by_a_box(geo, tmp_path, monkeypatch, n, fan):
    rnd = random.Random(n + fan)
    at = sorted((rnd.randrange(60000), rnd.randrange(60000)) for _ in range(n))
    row = lambda k: (k, f"é{k}" if k % 3 else None, k / 4, k % 2 == 0, -(1 << 40) * k, bytes([k % 256]), -k % 1000, (1 << 63) + k, "2024-01-01T00:00:00Z")
    write(tmp_path / "a.fgb", [row(k) for k in range(n)], [square(*p) for p in at], [(*p, p[0] + 10, p[1] + 10) for p in at], fan, 3)
    df = files.read_layer(geo, str(tmp_path / "a.fgb"))
    got = df.select("_row", "k", "name", "m", "ok", "big", "raw", "small", "no", "when", K.area("geom")).orderBy("k").collect()
    assert [(r[0], *[bytes(v) if isinstance(v, bytearray) else int(v) if c == "no" else v for c, v in zip(df.columns[1:10], r[1:10], strict=True)], r[10]) for r in got] == [(k, *row(k), 100.0) for k in range(n)]
    clip = (20000.0, 20000.0, 30000.0, 26000.0)
    pad = files.PAD_M
    near = {k for k, (x, y) in enumerate(at) if x <= clip[2] + pad and x + 10 >= clip[0] - pad and y <= clip[3] + pad and y + 10 >= clip[1] - pad}
    some = {r["k"] for r in files.read_layer(geo, str(tmp_path / "a.fgb"), clip=clip).collect()}
    assert some == (near if fan else set(range(n)))
    reader = flatgeobuf.FlatGeobufReader(str(tmp_path / "a.fgb"), None)
    reader.STEP = 7
    parts = reader.partitions()
    assert len(parts) == -(-n // 7) and [r[1] for p in parts for r in reader.read(p)] == list(range(n))


def test_shapes_of_all_kinds(geo, tmp_path):
    inner = (3, [5, 10], [0, 0, 10, 0, 10, 10, 0, 10, 0, 0, 2, 2, 2, 4, 4, 4, 4, 2, 2, 2], [])
    shapes = [(1, [], [3.0, 4.0], []), (2, [], [0, 0, 3, 4], []), inner, (4, [], [0, 0, 5, 5], []), (5, [2, 4], [0, 0, 1, 0, 5, 5, 5, 7], []), (6, [], [], [square(0, 0), inner]), (7, [], [], [(1, [], [1.0, 1.0], []), square(50, 50)]), None]
    rows = [(k, *[None] * 8) for k in range(len(shapes))]
    write(tmp_path / "a.fgb", rows, shapes, [(0, 0, 100, 100)] * len(rows))
    got = files.read_layer(geo, str(tmp_path / "a.fgb")).select("k", K.area("geom").alias("m2"), K.length("geom").alias("m"), F.hex(F.substring("geom", 2, 1)).alias("kind")).orderBy("k").collect()
    assert [r["m2"] for r in got] == [0, 0, 96, 0, 0, 196, 100, None] and got[1]["m"] == 5 and got[4]["m"] == 3
    assert [r["kind"] for r in got] == ["01", "02", "03", "04", "05", "06", "07", None]


def test_systems_and_faults(geo, tmp_path):
    row = [(1, *[None] * 8)]
    write(tmp_path / "n.fgb", row, [square(0, 0)], [(0, 0, 10, 10)], epsg=0)
    with pytest.raises(files.LayerError, match="coordinate system"):
        files.read_layer(geo, str(tmp_path / "n.fgb"))
    write(tmp_path / "w.fgb", row, [square(0, 0)], [(0, 0, 10, 10)], epsg=0, wkt='PROJCS["x",AUTHORITY["EPSG","2248"]]')
    assert files.read_layer(geo, str(tmp_path / "w.fgb")).select(K.area("geom")).first()[0] == pytest.approx(100 * (1200 / 3937) ** 2)
    write(tmp_path / "e.fgb", [], [], [])
    assert files.read_layer(geo, str(tmp_path / "e.fgb")).count() == 0 and files.read_layer(geo, str(tmp_path / "e.fgb"), clip=(0, 0, 1, 1)).count() == 0
    (tmp_path / "bad.fgb").write_bytes(b"nothing at all")
    with pytest.raises(Exception, match="no FlatGeobuf"):
        files.read_layer(geo, str(tmp_path / "bad.fgb")).count()
