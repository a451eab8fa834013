"""GeoTIFF elevation: a Spark source of cells (row, col, z) whose partitions are groups of strips or tiles."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The format's tag numbers.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, SAMPLE_FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS, NODATA = 33550, 33922, 34735, 42113
MODEL_TYPE, PROJECTED = 1024, 3072
KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}


@dataclass
class Raster:
    path: str
    order: str
    tags: dict[int, tuple]

    @property
    def shape(self) -> tuple[int, int]:
        return self.tags[HEIGHT][0], self.tags[WIDTH][0]

    @property
    def nodata(self) -> float | None:
        raw = self.tags.get(NODATA)
        return float(raw[0].split(b"\0")[0]) if raw else None

    @property
    def epsg(self) -> int | None:
        """The projected system's number; None if the file has none."""
        keys = self.tags.get(GEO_KEYS, ())
        found = {keys[k]: keys[k + 3] for k in range(4, len(keys), 4) if keys[k + 1] == 0}
        if found.get(MODEL_TYPE) == 2:
            raise ValueError(f"{self.path}: elevation has to be in a projected system, not in degrees")
        return found.get(PROJECTED)

    @property
    def place(self) -> tuple[float, float, float, float]:
        """Left edge, upper edge, width and height of a cell."""
        sx, sy = self.tags[PIXEL_SCALE][:2]
        i, j, _, x, y = self.tags[TIE_POINT][:5]
        return x - i * sx, y + j * sy, sx, sy

    def blocks(self) -> list[tuple[int, int, int, int, int, int]]:
        """(first row, first column, rows, columns, byte offset, bytes) of each strip or tile."""
        h, w = self.shape
        if TILES in self.tags:
            th, tw = self.tags[TILE_HEIGHT][0], self.tags[TILE_WIDTH][0]
            across = -(-w // tw)
            return [(k // across * th, k % across * tw, th, tw, o, n) for k, (o, n) in enumerate(zip(self.tags[TILES], self.tags[TILE_BYTES], strict=True))]
        rows = min(self.tags.get(ROWS_PER_STRIP, (h,))[0], h)
        return [(k * rows, 0, min(rows, h - k * rows), w, o, n) for k, (o, n) in enumerate(zip(self.tags[STRIPS], self.tags[STRIP_BYTES], strict=True))]


def opened(path: str) -> Raster:
    with Path(path).open("rb") as f:
        head = f.read(8)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        if order is None or struct.unpack_from(order + "H", head, 2)[0] != 42:
            raise ValueError(f"{path}: no plain TIFF file")
        f.seek(struct.unpack_from(order + "I", head, 4)[0])
        tags = {}
        for k in range(n := struct.unpack(order + "H", f.read(2))[0]):
            tag, kind, count, raw = struct.unpack(order + "HHI4s", f.read(12))
            form = KINDS.get(kind, "B")
            size = struct.calcsize(order + form) * count
            if size > 4:
                back = f.tell()
                f.seek(struct.unpack(order + "I", raw)[0])
                raw = f.read(size)
                f.seek(back)
            tags[tag] = (raw[:count],) if kind == 2 else struct.unpack(order + (f"{count}{form}" if len(form) == 1 else form * count), raw[:size])
    if tags.get(SAMPLES, (1,))[0] != 1:
        raise ValueError(f"{path}: one band is read, not {tags[SAMPLES][0]}")
    return Raster(path, order, tags)


def unpacked_lzw(data: bytes) -> bytes:
    """LZW as TIFF has it: codes of 9 to 12 bits from the highest bit on, 256 clears the table, 257 ends."""
    out, table, width, bits, held, last = bytearray(), [], 9, 0, 0, None
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        while bits >= width:
            code = held >> bits - width & (1 << width) - 1
            bits -= width
            held &= (1 << bits) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                table, width, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, None
                continue
            if last is None:
                one = table[code]
            else:
                one = table[code] if code < len(table) else last + last[:1]
                table.append(last + one[:1])
            out += one
            last = one
            # codes grow a step early
            width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)


def block_values(r: Raster, raw: bytes, rows: int, cols: int) -> np.ndarray:
    """The cells of a strip or tile as doubles, NaN for none."""
    how = r.tags.get(COMPRESSION, (1,))[0]
    if how in (8, 32946):
        raw = zlib.decompress(raw)
    elif how == 5:
        raw = unpacked_lzw(raw)
    elif how != 1:
        raise ValueError(f"{r.path}: compression {how} is not read")
    bits, form, predictor = r.tags[BITS][0], r.tags.get(SAMPLE_FORMAT, (1,))[0], r.tags.get(PREDICTOR, (1,))[0]
    kind = np.dtype(f"{r.order}{ {1: 'u', 2: 'i', 3: 'f'}[form] }{bits // 8}")
    if predictor == 3:
        # bytes of a row, the highest of all cells first, as differences
        flat = np.cumsum(np.frombuffer(raw, np.uint8, rows * cols * bits // 8).reshape(rows, -1), axis=1, dtype=np.uint8)
        x = flat.reshape(rows, bits // 8, cols).transpose(0, 2, 1).copy().view(np.dtype(f">f{bits // 8}"))[:, :, 0]
    else:
        x = np.frombuffer(raw, kind, rows * cols).reshape(rows, cols)
        if predictor == 2:
            x = np.cumsum(x, axis=1, dtype=kind.newbyteorder("="))
    out = x.astype(np.float64)
    if r.nodata is not None:
        out[out == np.float64(np.float32(r.nodata) if form == 3 and bits == 32 else r.nodata)] = np.nan
    return out


class GeoTiff(DataSource):
    """``spark.read.format("geotiff").option("path", file)``: (row, col, z), z null where the file has no value."""

    @classmethod
    def name(cls):
        return "geotiff"

    def schema(self):
        return "row int, col int, z double"

    def reader(self, schema):
        return GeoTiffReader(self.options["path"])


class GeoTiffReader(DataSourceReader):
    CELLS = 1 << 20

    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        parts, size = [[]], 0
        for b in opened(self.path).blocks():
            if size + b[2] * b[3] > self.CELLS and parts[-1]:
                parts.append([])
                size = 0
            parts[-1].append(b)
            size += b[2] * b[3]
        return [InputPartition(p) for p in parts]

    def read(self, partition):
        r = opened(self.path)
        h, w = r.shape
        with Path(self.path).open("rb") as f:
            for top, left, rows, cols, offset, size in partition.value:
                f.seek(offset)
                z = block_values(r, f.read(size), rows, cols)[: h - top, : w - left]
                n, m = z.shape
                row, col = np.repeat(np.arange(top, top + n, dtype=np.int32), m), np.tile(np.arange(left, left + m, dtype=np.int32), n)
                flat = z.ravel()
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(col), pa.array(flat, mask=np.isnan(flat))], ["row", "col", "z"])


STRIP_ROWS = 64


def strip(z: np.ndarray, deflate: bool = True) -> bytes:
    raw = z.astype("<f4").tobytes()
    return zlib.compress(raw) if deflate else raw


def head(shape: tuple[int, int], sizes: list[int], place: tuple[float, float, float, float], epsg: int, nodata: float | None = None, deflate: bool = True) -> bytes:
    """What stands before the strips of a grid of 32-bit numbers, for strips of so many bytes. ``place``: left and upper edge, cell width and height."""
    (h, w), (x, y, dx, dy) = shape, place
    keys = (1, 1, 0, 2, MODEL_TYPE, 0, 1, 1, PROJECTED, 0, 1, epsg)
    entries = [(WIDTH, 4, (w,)), (HEIGHT, 4, (h,)), (BITS, 3, (32,)), (COMPRESSION, 3, (8 if deflate else 1,)), (262, 3, (1,)), (STRIPS, 4, None), (SAMPLES, 3, (1,)), (ROWS_PER_STRIP, 4, (STRIP_ROWS,)), (STRIP_BYTES, 4, tuple(sizes)), (SAMPLE_FORMAT, 3, (3,)), (PIXEL_SCALE, 12, (dx, dy, 0.0)), (TIE_POINT, 12, (0.0, 0.0, 0.0, x, y, 0.0)), (GEO_KEYS, 3, keys)]
    if nodata is not None:
        entries.append((NODATA, 2, (f"{nodata}\0".encode(),)))
    after = 8 + 2 + 12 * len(entries) + 4
    packed = lambda kind, v: v[0] if kind == 2 else struct.pack(f"<{len(v)}{KINDS[kind]}", *v)
    extra_size = sum(len(d) for _, kind, v in entries if len(d := packed(kind, v if v is not None else (0,) * len(sizes))) > 4)
    data_at, offsets = after + extra_size, []
    for n in sizes:
        offsets.append(data_at)
        data_at += n
    out, extra = [], []
    at = after
    for tag, kind, v in entries:
        v = tuple(offsets) if v is None else v
        d = packed(kind, v)
        count = len(v[0]) if kind == 2 else len(v)
        out.append(struct.pack("<HHI", tag, kind, count) + (d.ljust(4, b"\0") if len(d) <= 4 else struct.pack("<I", at)))
        if len(d) > 4:
            extra.append(d)
            at += len(d)
    return b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", len(entries)) + b"".join(out) + struct.pack("<I", 0) + b"".join(extra)


def write_tiff(path: str, z: np.ndarray, place: tuple[float, float, float, float], epsg: int, nodata: float | None = None, deflate: bool = True) -> None:
    """A grid of 32-bit numbers in strips of 64 rows; for small grids, as of the synthetic county."""
    strips = [strip(z[k : k + STRIP_ROWS], deflate) for k in range(0, z.shape[0], STRIP_ROWS)]
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_bytes(head(z.shape, list(map(len, strips)), place, epsg, nodata, deflate) + b"".join(strips))
