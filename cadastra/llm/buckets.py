"""A pair of tables in co-located buckets: one sorted Parquet file for each table and bucket, rewritten from numbered files.

Rows become byte strings whose order is the order of the rows: the file's number, the key, then the other columns from
left to right. An RDD deals them out by the number (a custom partitioner) and sorts them in the shuffle by the whole
string (``repartitionAndSortWithinPartitions``), which spills where a file's rows exceed a worker's memory. A task
streams its partition into one Parquet writer after the other, a chunk of rows at a time; a bucket's rows stand side by
side in it, so one writer is open at once. Files are written under names of their own; what a task that ended has
named is moved to its place by the driver, so a repeated task leaves nothing behind.

The second table is written after the first and reads its key from the first's file of the same bucket, both sorted:
a merge without a shuffle, which counts the bucket's join and sets rows without a partner aside. Those go to a bucket of
their own in one more pass over them alone. No table is joined or broadcast, and only one line for each file reaches
the driver.

Starting files which hold exactly a final file's rows stay. For the first table that is seen beforehand by counts of
(starting file, bucket); the second's is known once its partnerless rows are, so its copy is dropped instead.

Order: nulls first, numbers by value (NaN last), text by its UTF-8 bytes. Defined results: null keys have the bucket
``buckets`` + 1 in either table and join nothing; repeated rows all stay; an empty table has no files; texts of any
length are kept; columns may have any names and keep their order. Nested and decimal columns are refused.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import shared_dir

#: Rows that a task holds beside the sorted stream, and of a row group.
CHUNK = 1 << 16
#: Rows that a task sorts, about, while there are buckets enough.
TASK_ROWS = 400_000
INTS = {"byte": 1, "short": 2, "integer": 4, "long": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8}
FLOATS = {"float": 4, "double": 8}
RESULT = "table_name string, path string, columns string, ids_sha256 string, lineage_sha256 string, bucket long, n_rows long, n_joined long, rewritten boolean"


# ---- rows as ordered bytes ----------------------------------------------------
class RowKeys:
    """Rows of a table to byte strings in the rows' order, and back. A null is a byte 0; other values a byte 1, then big-endian numbers with the sign turned, or text whose zero bytes are marked and whose end is one. A row's end has the texts' lengths and a tag, the number of the file that it came from."""

    def __init__(self, schema: T.StructType, key: str):
        self.schema = schema
        self.arrow = to_arrow_schema(schema)
        self.order = [schema.names.index(key), *[k for k, c in enumerate(schema.names) if c != key]]
        self.kinds = [schema.fields[k].dataType.typeName() for k in range(len(schema))]
        if wrong := [c for c, k in zip(schema.names, self.kinds, strict=True) if k not in INTS | FLOATS and k not in ("boolean", "string", "binary")]:
            raise ValueError(f"columns that can't be sorted here: {', '.join(wrong)}")
        self.texts = [k for k in self.order if self.kinds[k] in ("string", "binary")]

    def _fixed(self, k: int, col: pa.Array) -> np.ndarray:
        kind = self.kinds[k]
        if kind == "boolean":
            return col.fill_null(False).to_numpy(zero_copy_only=False).astype("u1").reshape(-1, 1)
        if kind in INTS:
            n = INTS[kind]
            out = col.cast(f"int{8 * n}").fill_null(0).to_numpy().astype(f">i{n}").view("u1").reshape(-1, n)
            out[:, 0] ^= 0x80
            return out
        n = FLOATS[kind]
        v = col.fill_null(0).to_numpy().copy()
        v[np.isnan(v)] = np.nan
        bits = v.view(f"u{n}")
        top = bits.dtype.type(1 << (8 * n - 1))
        return np.where(bits & top, ~bits, bits | top).astype(f">u{n}").view("u1").reshape(-1, n)

    @staticmethod
    def _marked(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text bytes with every zero followed by 255, and their lengths."""
        col = col.cast(pa.large_binary()).fill_null(b"")
        at = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        flat = np.frombuffer(col.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        if not flat.all():
            whole = [v.replace(b"\0", b"\0\xff") for v in col.to_pylist()]
            return np.frombuffer(b"".join(whole), np.uint8), np.fromiter(map(len, whole), np.int64, len(whole))
        return flat, np.diff(at)

    def encode(self, batch: pa.RecordBatch, number: np.ndarray, tag: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The rows' bytes, and where each row begins and the last ends. ``batch`` has the table's columns first, in order."""
        n = batch.num_rows
        parts, lens = [("fixed", number.astype(">u4").view("u1").reshape(-1, 4))], []
        for k in self.order:
            col = batch.column(k)
            parts.append(("fixed", col.is_valid().to_numpy(zero_copy_only=False).astype("u1").reshape(-1, 1)))
            if k in self.texts:
                parts.append(("text", self._marked(col)))
                lens.append(parts[-1][1][1])
                parts.append(("fixed", np.zeros((n, 1), np.uint8)))
            else:
                parts.append(("fixed", self._fixed(k, col)))
        parts += [("fixed", x.astype(">u4").view("u1").reshape(-1, 4)) for x in (*lens, tag)]
        width = sum(p.shape[1] for what, p in parts if what == "fixed") + sum(lens, np.zeros(n, np.int64))
        starts = np.concatenate(([0], np.cumsum(width)))
        out, pos = np.empty(starts[-1], np.uint8), starts[:-1].copy()
        for what, p in parts:
            if what == "fixed":
                out[pos[:, None] + np.arange(p.shape[1])] = p
                pos += p.shape[1]
            else:
                flat, size = p
                out[np.repeat(pos - np.cumsum(size) + size, size) + np.arange(len(flat))] = flat
                pos += size
        return out.tobytes(), starts

    def decode(self, rows: list[bytes]) -> tuple[pa.RecordBatch, np.ndarray]:
        """The rows' table and tags."""
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        ends = np.cumsum(size)
        data, pos = np.frombuffer(b"".join(rows), np.uint8), ends - size + 4
        word = lambda at: data[at[:, None] + np.arange(4)].copy().view(">u4").ravel().astype(np.int64)
        lens = {k: word(ends - 4 * (len(self.texts) - j) - 4) for j, k in enumerate(self.texts)}
        cols = {}
        for k in self.order:
            kind, mask = self.kinds[k], data[pos] == 0
            pos = pos + 1
            if k in lens:
                n = lens[k]
                flat = data[np.repeat(pos - np.cumsum(n) + n, n) + np.arange(n.sum())]
                if flat.all():
                    offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
                    col = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
                else:
                    col = pa.array([flat[a : a + m].tobytes().replace(b"\0\xff", b"\0") for a, m in zip((np.cumsum(n) - n).tolist(), n.tolist(), strict=True)], pa.large_binary())
                col = pa.compute.if_else(pa.array(~mask), col, pa.scalar(None, pa.large_binary()))
                cols[k] = col.cast(pa.binary()).cast(self.arrow.field(k).type)
                pos = pos + n + 1
                continue
            width = 1 if kind == "boolean" else (INTS | FLOATS)[kind]
            raw = data[pos[:, None] + np.arange(width)].copy()
            pos = pos + width
            if kind == "boolean":
                cols[k] = pa.array(raw.ravel().astype(bool), mask=mask)
            elif kind in INTS:
                raw[:, 0] ^= 0x80
                cols[k] = pa.array(raw.view(f">i{width}").ravel().astype(f"i{width}"), mask=mask).cast(self.arrow.field(k).type)
            else:
                bits = raw.view(f">u{width}").ravel().astype(f"u{width}")
                top = bits.dtype.type(1 << (8 * width - 1))
                cols[k] = pa.array(np.where(bits & top, bits & ~top, ~bits).astype(f"u{width}").view(f"f{width}"), mask=mask)
        return pa.RecordBatch.from_arrays([cols[k] for k in range(len(self.kinds))], schema=self.arrow), word(ends - 4)


def number_of(row: bytes) -> int:
    return int.from_bytes(row[:4], "big")


def dealt(df: DataFrame, keys: RowKeys, number: Column, tag: Column, tasks: int):
    """The table's rows as pairs (bytes, None), all of a number in one partition, sorted there by number, key and the other columns."""

    def encoded(batches):
        for b in batches:
            n = b.num_columns
            data, at = keys.encode(b, b.column(n - 2).to_numpy(), b.column(n - 1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary()), pa.array([at.tobytes()], pa.binary())], ["data", "at"])

    def rows(batch):
        data, at = bytes(batch[0]), np.frombuffer(batch[1], np.int64).tolist()
        return [(data[a:b], None) for a, b in zip(at, at[1:])]

    names = [f"c{k}" for k in range(len(keys.kinds))]
    plain = df.select(*[F.col(f"`{c.replace('`', '``')}`").alias(a) for c, a in zip(keys.schema.names, names, strict=True)], number.cast("int").alias("number"), tag.cast("int").alias("tag"))
    return plain.mapInArrow(encoded, "data binary, at binary").rdd.flatMap(rows).repartitionAndSortWithinPartitions(tasks, number_of)


# ---- files -------------------------------------------------------------------
def file_system(path: str):
    """The store that a path or URI names, and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


class Partner:
    """The sorted key of another file, streamed: how many of its rows have each of some ascending keys."""

    def __init__(self, path: str | None, key: str, chunk: int = CHUNK):
        self.batches, self.held = self._distinct(path, key, chunk), None

    @staticmethod
    def _distinct(path, key, chunk):
        """Distinct keys with counts, in order; a key never stands in two batches."""
        if path is None:
            return
        import pyarrow.parquet as pq

        store, at = file_system(path)
        kept = None
        with store.open_input_file(at) as f:
            for b in pq.ParquetFile(f).iter_batches(chunk, columns=[key]):
                values, counts = np.unique(b.column(0).drop_null().to_numpy(), return_counts=True)
                if kept and len(values) and kept[0][0] == values[0]:
                    counts[0] += kept[1][0]
                elif kept:
                    yield kept
                if len(values):
                    if len(values) > 1:
                        yield values[:-1], counts[:-1]
                    kept = values[-1:], counts[-1:]
        if kept:
            yield kept

    def rows_with(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), np.int64)
        while len(keys):
            if self.held is None:
                self.held = next(self.batches, None)
            if self.held is None:
                break
            values, counts = self.held
            at = np.minimum(np.searchsorted(values, keys), len(values) - 1)
            found += np.where(values[at] == keys, counts[at], 0)
            if values[-1] >= keys[-1]:
                break
            self.held = None
        return found


class Output:
    """One Parquet file, written chunk by chunk under a name of its own."""

    def __init__(self, folder: str, number: int, schema: pa.Schema):
        import pyarrow.parquet as pq

        self.number, self.path = number, f"{folder}/{number:05d}-{uuid.uuid4().hex}.parquet"
        store, at = file_system(self.path)
        self.stream = store.open_output_stream(at)
        self.writer = pq.ParquetWriter(self.stream, schema)
        self.rows, self.joined, self.digest, self.sources = 0, 0, hashlib.sha256(), {}

    def write(self, batch: pa.RecordBatch, ids: list[str], tags: np.ndarray) -> None:
        self.writer.write_batch(batch)
        self.digest.update((("," if self.rows else "") + ",".join(ids)).encode())
        self.rows += len(ids)
        for tag, n in zip(*map(np.ndarray.tolist, np.unique(tags, return_counts=True)), strict=True):
            self.sources[tag] = self.sources.get(tag, 0) + n

    def closed(self) -> dict:
        """What is known of the file; ``source`` is the one file that all rows came from, else -1."""
        self.writer.close()
        self.stream.close()
        lineage = ",".join(f"{s}:{n}" for s, n in sorted(self.sources.items()))
        return {"number": self.number, "path": self.path, "rows": self.rows, "joined": self.joined, "ids": self.digest.hexdigest(), "lineage": hashlib.sha256(lineage.encode()).hexdigest(), "source": next(iter(self.sources)) if len(self.sources) == 1 else -1}


TAG = "__starting_file"


def write_numbered(df: DataFrame, keys: RowKeys, number: Column, tag: Column, folder: str, tasks: int, partners: dict[int, str] | None = None, unmatched: int = 0, chunk: int = CHUNK) -> list[dict]:
    """Writes a sorted file for each number and tells of each. With ``partners`` (the other table's files by number), rows of a number below ``unmatched`` whose key has no partner go to files apart, told with ``aside``."""
    key = keys.schema.names[keys.order[0]]
    new = f"{folder}/_new-{uuid.uuid4().hex}"
    store, at = file_system(new)
    store.create_dir(at, recursive=True)

    def written(pairs):
        for number, rows in groupby((k for k, _ in pairs), number_of):
            yield from one(number, rows)

    def one(number, rows):
        partner = Partner(partners.get(number), key, chunk) if partners is not None and number < unmatched else None
        out = aside = None
        while some := list(islice(rows, chunk)):
            batch, tags = keys.decode(some)
            ids = batch.column(keys.order[0])
            if partner:
                joined = partner.rows_with(ids.to_numpy())
                if not joined.all():
                    left = pa.array(joined == 0)
                    if aside is None:
                        aside = Output(new, number, keys.arrow.append(pa.field(TAG, pa.int32())))
                    lost = batch.filter(left)
                    aside.write(pa.RecordBatch.from_arrays([*lost.columns, pa.array(tags[joined == 0].astype(np.int32))], schema=keys.arrow.append(pa.field(TAG, pa.int32()))), [""] * lost.num_rows, tags[joined == 0])
                    batch, tags, joined = batch.filter(pa.array(joined > 0)), tags[joined > 0], joined[joined > 0]
                    ids = batch.column(keys.order[0])
                if not len(tags):
                    continue
            if out is None:
                out = Output(new, number, keys.arrow)
            out.write(batch, ids.cast("string").fill_null("").to_pylist(), tags)
            out.joined += int(joined.sum()) if partner else 0
        return [o.closed() | {"aside": o is aside} for o in (out, aside) if o is not None]

    return dealt(df, keys, number, tag, tasks).mapPartitions(written).collect()  # a line for each file


def moved(files: list[dict], folder: str, name: str) -> dict[int, dict]:
    """Files at their places, by number."""
    for f in files:
        to = f"{folder}/{name}-{f['number']:05d}.parquet"
        store, at = file_system(f["path"])
        store.move(at, file_system(to)[1])
        f["path"] = to
    return {f["number"]: f for f in files}


def tagged(spark: SparkSession, keys: RowKeys, starts: dict[int, dict]) -> DataFrame:
    """The rows of starting files, with the number of each one's file as ``TAG``."""
    df = spark.read.schema(keys.schema).parquet(*[f["path"] for f in starts.values()]) if starts else spark.createDataFrame([], keys.schema)
    return df.withColumn(TAG, F.regexp_extract("_metadata.file_name", r"start-(\d+)", 1).cast("int") if starts else F.lit(0))


def same_files(rows: DataFrame, number: Column) -> dict[int, int]:
    """Starting files that hold exactly a final file's rows: the final number of each. No more rows than files are collected."""
    pairs = rows.select(F.col(TAG).alias("s"), number.alias("b")).groupBy("s", "b").agg(F.count("*").alias("n"))
    ones = pairs.groupBy("s").agg(F.min("b").alias("b"), F.count("*").alias("k")).where("k = 1")
    whole = pairs.groupBy("b").agg(F.count("*").alias("k")).where("k = 1").select("b")
    return {r["s"]: r["b"] for r in ones.join(whole, "b").collect()}


def co_bucketed(first: DataFrame, second: DataFrame, key: str, starts: tuple[Column, Column], bucket: Column, buckets: int, names: tuple[str, str], folder: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Writes both tables to their starting files, rewrites these to one file for each bucket, and tells of every final file.

    ``bucket`` is a column of the key, 0 to ``buckets`` - 1. Rows of the second table without a partner have the bucket
    ``buckets``, null keys ``buckets`` + 1.
    """
    spark = first.sparkSession
    folder = folder or f"{shared_dir(spark)}/buckets-{uuid.uuid4().hex}"
    number = F.when(F.col(key).isNull(), buckets + 1).otherwise(bucket)
    final, out = [], []
    for df, start, name in zip((first, second), starts, names, strict=True):
        keys, at, count = RowKeys(df.schema, key), f"{folder}/{name}", df.count()
        tasks = max(1, min(buckets + 2, max(int(spark.conf.get("spark.sql.shuffle.partitions")), count // TASK_ROWS)))
        begun = moved(write_numbered(df, keys, start, F.lit(0), at, tasks, chunk=chunk), at, "start")
        stay = same_files(tagged(spark, keys, begun), number) if not final else {}
        rows = tagged(spark, keys, {s: f for s, f in begun.items() if s not in stay})
        partners = {b: f["path"] for b, f in final[0].items()} if final else None
        new = write_numbered(rows, keys, number, F.col(TAG), at, tasks, partners, buckets, chunk)
        if aside := [f for f in new if f["aside"]]:
            lost = spark.read.schema(T.StructType([*keys.schema.fields, T.StructField(TAG, T.IntegerType())])).parquet(*[f["path"] for f in aside])
            new += write_numbered(lost, keys, F.lit(buckets), F.col(TAG), at, tasks, chunk=chunk)
        # what was copied though its starting file has just these rows
        new = [f for f in new if not f["aside"]]
        same = {f["source"]: f for f in new if f["source"] >= 0 and begun[f["source"]]["rows"] == f["rows"]}
        kept = {b: begun[s] | {"joined": 0, "lineage": hashlib.sha256(f"{s}:{begun[s]['rows']}".encode()).hexdigest(), "rewritten": False} for s, b in stay.items()}
        kept |= {f["number"]: f | {"path": begun[s]["path"], "rewritten": False} for s, f in same.items()}
        files = kept | {b: f | {"rewritten": True} for b, f in moved([f for f in new if f["source"] not in same], at, "bucket").items()}
        if not count == sum(f["rows"] for f in begun.values()) == sum(f["rows"] for f in files.values()):
            raise RuntimeError(f"{name} changed while it was written")
        store, _ = file_system(at)
        for s, f in begun.items():
            if f["path"] not in {x["path"] for x in kept.values()}:
                store.delete_file(file_system(f["path"])[1])
        for info in store.get_file_info(_selector(at)):
            if info.base_name.startswith("_new-"):
                store.delete_dir(info.path)
        final.append(files)
    for files, df, name in zip(final, (first, second), names, strict=True):
        for b, f in sorted(files.items()):
            joined = final[1][b]["joined"] if b in final[1] and b < buckets else 0
            out.append((name, f["path"], ",".join(df.columns), f["ids"], f["lineage"], b, f["rows"], joined, f["rewritten"]))
    return spark.createDataFrame(out, RESULT)  # a row for each file


def _selector(folder: str):
    from pyarrow import fs

    return fs.FileSelector(file_system(folder)[1])
