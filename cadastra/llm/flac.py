"""FLAC as a media column: a writer with a seek point for every frame, and a reader that checks every frame's checksums.

The writer takes 8-bit samples in frames of 576 and picks for each frame the smallest of constant, verbatim and fixed
linear predictors of order 0 to 4 with Rice-coded residuals. The reader follows the seek points, so it decodes many
frames side by side: it verifies CRC-8 and CRC-16, decodes Rice residuals, undoes the predictors and gives PCM blocks
with their sample offsets. ``decode_stream`` reads any mono stream front to back, with LPC subframes, Rice partitions
and escapes, and needs no seek table.

Defined results: null text is the empty payload, which is still padded to one frame; a damaged frame raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME = 576
#: Frames that are handled side by side: bounds memory, whatever the length of a text.
SIDE = 1024
#: Bytes of a metadata block, hence of the one seek table that a stream may have: beyond it (texts of over 500 MB) points stand at some frames only.
TABLE = 1 << 24
# Sync code with fixed block size; block size 576 and 8 kHz; mono, 8 bits a sample.
HEAD = b"\xff\xf8\x24\x02"
FIXED_COEF = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


def _crc_rows(poly: int, bits: int, length: int) -> np.ndarray:
    """Row i: the checksum of each byte followed by i zero bytes; a message's checksum is the XOR of its bytes' entries."""
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    row = np.arange(256, dtype=np.int64) << (bits - 8)
    for _ in range(8):
        row = np.where(row & top, (row << 1) ^ poly, row << 1) & mask
    out = np.zeros((length, 256), np.uint16)
    out[0] = step = row
    for i in range(1, length):
        out[i] = ((out[i - 1].astype(np.int64) << 8) & mask) ^ step[out[i - 1].astype(np.int64) >> (bits - 8)]
    return out


@lru_cache(maxsize=4)
def crc_rows(poly: int, bits: int, length: int) -> np.ndarray:
    return _crc_rows(poly, bits, length)


def checksums(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, poly: int = 0x8005, bits: int = 16) -> np.ndarray:
    """Of each stretch of the buffer; the stretches follow each other without overlap."""
    longest = 1 << int(sizes.max()).bit_length()
    flat = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    after = np.repeat(sizes, sizes) - 1 - flat
    data = buf[np.repeat(starts, sizes) + flat]
    return np.bitwise_xor.reduceat(crc_rows(poly, bits, longest)[after, data], np.cumsum(sizes) - sizes)


def coded_number(n: int) -> bytes:
    """A frame or sample number in the extended UTF-8 form."""
    if n < 128:
        return bytes([n])
    extra = 1
    while n >= 1 << (6 * extra + 6 - extra):
        extra += 1
    lead = (0xFF << (7 - extra)) & 0xFF
    return bytes([lead | n >> (6 * extra)] + [0x80 | (n >> 6 * k) & 63 for k in range(extra - 1, -1, -1)])


@lru_cache(maxsize=1 << 14)
def frame_head(n: int) -> bytes:
    head = HEAD + coded_number(n)
    c = 0
    for i, b in enumerate(head):
        c ^= int(crc_rows(0x07, 8, 16)[len(head) - 1 - i, b])
    return head + bytes([c])


def encode_frames(samples: np.ndarray, numbers: np.ndarray) -> list[bytes]:
    """Frames of signed 8-bit samples, one row each, with their frame numbers."""
    x = samples.astype(np.int32)
    n = len(x)
    best = np.full(n, 8 + 8 * FRAME, np.int64)
    kind, rice, folded = np.full(n, -1), np.zeros(n, np.int64), []
    for m in range(5):
        r = np.diff(x, n=m, axis=1) if m else x
        u = (r << 1) ^ (r >> 31)
        folded.append(u)
        guess = np.maximum(np.log2(np.maximum(u.mean(1), 0.5)).astype(np.int64), 0)
        for k in (guess, np.maximum(guess - 1, 0), guess + 1):
            k = np.minimum(k, 14)
            bits = 18 + 8 * m + (u >> k[:, None]).sum(1) + (FRAME - m) * (k + 1)
            better = bits < best
            best[better], kind[better], rice[better] = bits[better], m, k[better]
    same = (x == x[:, :1]).all(1)
    best[same], kind[same] = 16, -2
    heads = [frame_head(i) for i in numbers.tolist()]
    head_size = np.array([len(h) for h in heads])
    size = head_size + (best + 7) // 8 + 2
    start = np.cumsum(size) - size
    bits = np.zeros(int(size.sum()) * 8, np.uint8)
    at = (start + head_size) * 8

    def put(rows, where, values, width):
        for b in range(width):
            bits[where + b] = (values >> (width - 1 - b)) & 1

    for code, rows in ((0, np.flatnonzero(kind == -2)), (1, np.flatnonzero(kind == -1))):
        if len(rows):
            put(rows, at[rows], np.full(len(rows), code << 1), 8)
            for i in range(1 if code == 0 else FRAME):
                put(rows, at[rows] + 8 + 8 * i, x[rows, i] & 255, 8)
    for m in range(5):
        rows = np.flatnonzero(kind == m)
        if not len(rows):
            continue
        put(rows, at[rows], np.full(len(rows), (8 | m) << 1), 8)
        for i in range(m):
            put(rows, at[rows] + 8 + 8 * i, x[rows, i] & 255, 8)
        put(rows, at[rows] + 14 + 8 * m, rice[rows], 4)
        u, k = folded[m][rows], rice[rows][:, None]
        ends = (at[rows] + 18 + 8 * m)[:, None] + np.cumsum((u >> k) + 1 + k, axis=1)
        bits[ends - 1 - k] = 1
        for b in range(int(k.max()) if len(k) else 0):
            on = (k > b) & ((u >> b) & 1 == 1)
            bits[ends[on] - 1 - b] = 1
    data = np.packbits(bits)
    for i, h in enumerate(heads):
        data[start[i] : start[i] + len(h)] = np.frombuffer(h, np.uint8)
    crc = checksums(data, start, size - 2)
    data[start + size - 2], data[start + size - 1] = crc >> 8, crc & 255
    whole = data.tobytes()
    return [whole[s : s + z] for s, z in zip(start.tolist(), size.tolist(), strict=True)]


def payload_of(text: str | None) -> tuple[int, bytes]:
    """(bytes of the text, bytes padded with 255 to a positive multiple of the frame)."""
    raw = (text or "").encode("utf-8", "replace")
    return len(raw), raw + b"\xff" * (-len(raw) % FRAME or (0 if raw else FRAME))


def streams(payloads: list[bytes]) -> list[bytes]:
    """Whole FLAC streams of 8-bit payloads; frames of all payloads are encoded side by side."""
    counts = [len(p) // FRAME for p in payloads]
    out: list[list[bytes]] = [[] for _ in payloads]
    queue: list[tuple[int, int, int]] = []

    def flush():
        if not queue:
            return
        x = np.concatenate([np.frombuffer(payloads[p], np.uint8, n * FRAME, lo * FRAME) for p, lo, n in queue]).reshape(-1, FRAME)
        numbers = np.concatenate([np.arange(lo, lo + n) for _, lo, n in queue])
        frames = encode_frames((x ^ 0x80).view(np.int8), numbers)
        at = 0
        for p, _, n in queue:
            out[p] += frames[at : at + n]
            at += n
        queue.clear()

    held = 0
    for p, c in enumerate(counts):
        lo = 0
        while lo < c:
            n = min(c - lo, SIDE - held)
            queue.append((p, lo, n))
            lo, held = lo + n, held + n
            if held == SIDE:
                flush()
                held = 0
    flush()
    return [_assemble(payload, frames) for payload, frames in zip(payloads, out, strict=True)]


def _assemble(payload: bytes, frames: list[bytes]) -> bytes:
    sizes = [len(f) for f in frames]
    md5 = hashlib.md5((np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()).digest()
    packed = 8000 << 44 | 0 << 41 | 7 << 36 | len(payload)
    info = struct.pack(">HH", FRAME, FRAME) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + packed.to_bytes(8, "big") + md5
    offsets = np.cumsum(sizes) - sizes
    points = np.zeros(len(frames), np.dtype([("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")]))
    points["sample"], points["offset"], points["count"] = np.arange(len(frames)) * FRAME, offsets, FRAME
    table = points.tobytes()
    if len(table) >= TABLE:
        table = points[:: len(table) // TABLE + 1].tobytes()
    return b"fLaC" + b"\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(table).to_bytes(3, "big") + table + b"".join(frames)


def metadata(stream: bytes) -> tuple[dict, np.ndarray, int]:
    """(stream info, seek points, offset of the first frame)."""
    if stream[:4] != b"fLaC":
        raise ValueError("no FLAC stream")
    at, info, points = 4, {}, np.zeros(0, np.dtype([("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")]))
    while True:
        last, kind, size = stream[at] >> 7, stream[at] & 127, int.from_bytes(stream[at + 1 : at + 4], "big")
        body = stream[at + 4 : at + 4 + size]
        if kind == 0:
            packed = int.from_bytes(body[10:18], "big")
            info = {"rate": packed >> 44, "channels": (packed >> 41 & 7) + 1, "bits": (packed >> 36 & 31) + 1, "samples": packed & (1 << 36) - 1, "md5": body[18:34]}
        elif kind == 3:
            points = np.frombuffer(body, points.dtype)
        at += 4 + size
        if last:
            return info, points, at


def decode_frames(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, signed samples) of frames that this writer's profile describes, side by side."""
    if checksums(buf, start, size).any():
        raise ValueError("a frame's CRC-16 is wrong")
    if not all((buf[start + i] == HEAD[i]).all() for i in range(4)):
        raise ValueError("not a frame of the expected kind")
    lead = buf[start + 4]
    more = np.maximum(np.select([lead < 0x80, lead < 0xE0, lead < 0xF0, lead < 0xF8, lead < 0xFC, lead < 0xFE], [0, 1, 2, 3, 4, 5], 6), 0)
    number = np.where(more == 0, lead, lead & (0x3F >> more)).astype(np.int64)
    for i in range(1, int(more.max()) + 1):
        number = np.where(more >= i, number << 6 | (buf[np.minimum(start + 4 + i, len(buf) - 1)] & 63), number)
    head = 6 + more
    if checksums(buf, start, head, 0x07, 8).any():
        raise ValueError("a header's CRC-8 is wrong")
    code = buf[start + head] >> 1
    at = (start + head + 1) * 8
    bits = np.unpackbits(buf)
    x = np.zeros((len(start), FRAME), np.int32)

    def signed(rows, where):
        return buf[where].astype(np.uint8).view(np.int8).astype(np.int32)

    rows = np.flatnonzero(code == 0)
    x[rows] = signed(rows, start[rows] + head[rows] + 1)[:, None]
    rows = np.flatnonzero(code == 1)
    x[rows] = signed(rows, (start[rows] + head[rows] + 1)[:, None] + np.arange(FRAME))
    if not np.isin(code, [0, 1, 8, 9, 10, 11, 12]).all():
        raise ValueError("a subframe of another kind: use decode_stream")
    ones = before = None
    for m in range(5):
        rows = np.flatnonzero(code == 8 + m)
        if not len(rows):
            continue
        if ones is None:
            ones, before = np.append(np.flatnonzero(bits), len(bits)).astype(np.int32), np.cumsum(bits, dtype=np.int32) - bits
        warm = signed(rows, (start[rows] + head[rows] + 1)[:, None] + np.arange(m)) if m else np.zeros((len(rows), 0), np.int32)
        p = at[rows] + 8 * m
        plain = sum(bits[p + i].astype(np.int64) << (5 - i) for i in range(6))
        if plain.any():
            raise ValueError("Rice partitions: use decode_stream")
        k = sum(bits[p + 6 + i].astype(np.int64) << (3 - i) for i in range(4))
        p = p + 10
        high, low_at = np.zeros((FRAME - m, len(rows)), np.int32), np.zeros((FRAME - m, len(rows)), np.int64)
        for i in range(FRAME - m):
            q = ones[before[p]]
            high[i] = q - p
            low_at[i] = q + 1
            p = low_at[i] + k
        u = high << k.astype(np.int32)
        for b in range(int(k.max())):
            on = k > b
            u[:, on] |= bits[low_at[:, on] + b].astype(np.int32) << (k[on] - 1 - b).astype(np.int32)
        r = ((u >> 1) ^ -(u & 1)).T
        for j in range(m - 1, -1, -1):
            r = np.diff(warm, n=j, axis=1)[:, -1:] + np.cumsum(r, axis=1, dtype=np.int32)
        x[rows, :m], x[rows, m:] = warm, r
    return number, x


def frames_between(stream: bytes, points: np.ndarray, first: int, n: int) -> np.ndarray | None:
    """Offsets of all frames from those of some: between two seek points the next frame's header is looked for, number and CRC-8 included.

    Samples may hold such a header by chance; then a frame's CRC-16 is wrong, as in a damaged one, and there is no answer.
    """
    if not len(points) or (points["sample"] % FRAME).any() or int(points["sample"].max()) >= n * FRAME:
        return None
    known = dict(zip((points["sample"] // FRAME).tolist(), (points["offset"].astype(np.int64) + first).tolist(), strict=True))
    offsets, at = np.zeros(n, np.int64), first - 1
    for k in range(n):
        head = frame_head(k)
        begin = known.get(k)
        at = stream.find(head, at + 1) if begin is None else begin if stream.startswith(head, begin) else -1
        if at < 0:
            return None
        offsets[k] = at
    sizes = np.diff(np.append(offsets, len(stream)))
    if (sizes <= 0).any() or int(sizes.max()) > 2 * FRAME:
        return None
    for lo in range(0, n, SIDE):
        own = slice(lo, lo + SIDE)
        piece = np.frombuffer(stream, np.uint8)[offsets[lo] : offsets[own][-1] + sizes[own][-1]]
        if checksums(piece, offsets[own] - offsets[lo], sizes[own]).any():
            return None
    return offsets


def read_back(media: list[bytes]) -> list[bytes]:
    """The payloads of streams, through their seek points; those of another profile, or damaged, go front to back."""
    out, parts = [], []
    for s in media:
        info, points, first = metadata(s)
        n = info["samples"] // FRAME
        offsets = points["offset"].astype(np.int64) + first if len(points) == n else frames_between(s, points, first, n)
        if offsets is None:
            parts.append((s, None, None, info))
            continue
        parts.append((s, offsets, np.diff(np.append(offsets, len(s))), info))
    lots: dict[int, list[bytes]] = {i: [] for i in range(len(parts))}
    queue: list[tuple[int, int, int]] = []

    def flush():
        if not queue:
            return
        bufs, starts, sizes, base = [], [], [], 0
        for i, lo, n in queue:
            s, off, size, _ = parts[i]
            piece = np.frombuffer(s, np.uint8)[off[lo] : off[lo + n - 1] + size[lo + n - 1]]
            bufs.append(piece)
            starts.append(off[lo : lo + n] - off[lo] + base)
            sizes.append(size[lo : lo + n])
            base += len(piece)
        numbers, x = decode_frames(np.concatenate(bufs), np.concatenate(starts), np.concatenate(sizes))
        at = 0
        for i, lo, n in queue:
            if (numbers[at : at + n] != np.arange(lo, lo + n)).any():
                raise ValueError("a frame is out of place")
            lots[i].append((x[at : at + n].astype(np.int8).view(np.uint8) ^ 0x80).tobytes())
            at += n
        queue.clear()

    held = 0
    for i, (_, off, _, _) in enumerate(parts):
        lo = 0
        while off is not None and lo < len(off):
            n = min(len(off) - lo, SIDE - held)
            queue.append((i, lo, n))
            lo, held = lo + n, held + n
            if held == SIDE:
                flush()
                held = 0
    flush()
    for i, (s, off, _, info) in enumerate(parts):
        data = b"".join(lots[i]) if off is not None else (decode_stream(s).astype(np.int8).view(np.uint8) ^ 0x80).tobytes()
        if hashlib.md5((np.frombuffer(data, np.uint8) ^ 0x80).tobytes()).digest() != info["md5"]:
            raise ValueError("the samples' MD5 is wrong")
        out.append(data)
    return out


class _Bits:
    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at * 8

    def take(self, n: int) -> int:
        if not n:
            return 0
        lo, hi = self.at >> 3, (self.at + n + 7) >> 3
        if hi > len(self.data):
            raise ValueError("the stream ends inside a frame")
        got = int.from_bytes(self.data[lo:hi], "big") >> (hi * 8 - self.at - n)
        self.at += n
        return got & (1 << n) - 1

    def signed(self, n: int) -> int:
        v = self.take(n)
        return v - (1 << n) if n and v >> (n - 1) else v

    def unary(self) -> int:
        n = 0
        while not self.take(1):
            n += 1
        return n


def decode_stream(stream: bytes) -> np.ndarray:
    """Signed samples of any mono stream, read front to back; every frame's checksums are verified."""
    info, _, at = metadata(stream)
    if info["channels"] != 1:
        raise ValueError("only mono is read")
    blocks = []
    while at < len(stream):
        r = _Bits(stream, at)
        if r.take(15) != 0x7FFC:
            raise ValueError("lost synchronisation")
        r.take(1)
        size_code, rate_code, _, bits_code, _ = r.take(4), r.take(4), r.take(4), r.take(3), r.take(1)
        lead = r.take(8)
        for _ in range(0 if lead < 0x80 else 7 - (lead ^ 0xFF).bit_length()):
            r.take(8)
        n = r.take(8) + 1 if size_code == 6 else r.take(16) + 1 if size_code == 7 else 192 if size_code == 1 else 576 << (size_code - 2) if size_code < 6 else 256 << (size_code - 8)
        r.take({12: 8, 13: 16, 14: 16}.get(rate_code, 0))
        depth = {0: info["bits"], 1: 8, 2: 12, 4: 16, 5: 20, 6: 24, 7: 32}[bits_code]
        body = r.at // 8
        if checksums(np.frombuffer(stream, np.uint8), np.array([at]), np.array([body + 1 - at]), 0x07, 8).any():
            raise ValueError("a header's CRC-8 is wrong")
        r.take(8)
        r.take(1)
        code = r.take(6)
        wasted = r.unary() + 1 if r.take(1) else 0
        depth -= wasted
        if code == 0:
            x = [r.signed(depth)] * n
        elif code == 1:
            x = [r.signed(depth) for _ in range(n)]
        elif 8 <= code <= 12 or code >= 32:
            order = code - 8 if code < 32 else code - 31
            x = [r.signed(depth) for _ in range(order)]
            coef, shift = FIXED_COEF[order] if code < 32 else (), 0
            if code >= 32:
                precision = r.take(4) + 1
                shift = r.signed(5)
                coef = [r.signed(precision) for _ in range(order)]
            wide = 4 + r.take(2)
            parts = r.take(4)
            for part in range(1 << parts):
                k = r.take(wide)
                count = (n >> parts) - (order if part == 0 else 0)
                raw = r.take(5) if k == (1 << wide) - 1 else None
                for _ in range(count):
                    if raw is None:
                        u = r.unary() << k | r.take(k)
                        res = (u >> 1) ^ -(u & 1)
                    else:
                        res = r.signed(raw)
                    x.append(res + (sum(c * x[-1 - i] for i, c in enumerate(coef)) >> shift))
        else:
            raise ValueError("a reserved subframe kind")
        end = (r.at + 7) // 8 + 2
        if end > len(stream) or checksums(np.frombuffer(stream, np.uint8), np.array([at]), np.array([end - at])).any():
            raise ValueError("a frame's CRC-16 is wrong")
        blocks.append(np.array(x, np.int64) << wasted)
        at = end
    return np.concatenate(blocks) if blocks else np.zeros(0, np.int64)


def features(payload: bytes) -> str:
    """Peak, root mean square and sign changes of the samples."""
    x = (np.frombuffer(payload, np.uint8) ^ 0x80).view(np.int8).astype(np.int64)
    return f"peak={int(np.abs(x).max())};rms={float(np.sqrt((x * x).mean())):.4f};turns={int(((x[1:] < 0) != (x[:-1] < 0)).sum())};frames={len(x) // FRAME}"


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, media (the FLAC stream)."""

    def run(batches):
        for b in batches:
            texts = [payload_of(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array([n for n, _ in texts], pa.int64()), pa.array(streams([p for _, p in texts]), pa.binary())], [id_col, "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, media binary")


def read(stored: DataFrame, id_col: str = "doc_id", extra: str = "n_bytes") -> DataFrame:
    """One row per stream, decoded: sizes, checksums and features of the payload and of the stored form."""

    def run(batches):
        for b in batches:
            media = b.column("media").to_pylist()
            data = read_back(media)
            cols = [pa.array([len(p) for p in data], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in data]), pa.array([zlib.crc32(p[-32:]) for p in data], pa.int64()), pa.array([len(m) for m in media], pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in media]), pa.array([features(p) for p in data])]
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("n"), *cols], [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    kind = stored.schema[id_col].dataType.simpleString()
    return stored.select(F.col(id_col).alias("i"), F.col(extra).alias("n"), "media").mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def pcm_blocks(stored: DataFrame, id_col: str = "doc_id", frames: int = 64) -> DataFrame:
    """Decoded PCM in blocks of ``frames`` frames: id, block, sample_offset, pcm."""

    def run(batches):
        step = frames * FRAME
        for b in batches:
            for i, m in zip(b.column("i"), b.column("media"), strict=True):
                data = read_back([m.as_py()])[0]
                cuts = range(0, len(data), step)
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * len(cuts), i.type), pa.array([c // step for c in cuts], pa.int64()), pa.array(list(cuts), pa.int64()), pa.array([data[c : c + step] for c in cuts], pa.binary())], [id_col, "block", "sample_offset", "pcm"])

    kind = stored.schema[id_col].dataType.simpleString()
    return stored.select(F.col(id_col).alias("i"), "media").mapInArrow(run, f"`{id_col}` {kind}, block long, sample_offset long, pcm binary")
