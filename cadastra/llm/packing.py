"""Packing by powers of two: every document is cut into pieces whose lengths are its binary digits.

A document's ids and the closing id are cut into pieces of the context length, then into the powers of two of the
remainder, longest first. A piece is a sequence by itself: it holds ids of one document only and needs no padding, as
its length is a power of two. Sequences of one length form a bucket, in which their ids are consecutive, so that a batch
of equal lengths is a range of ids.

Pieces are numbered without moving them: a task counts what it makes by length, the counts of all tasks (lengths times
tasks, no more) give each task its first number, and a join brings that to the stored pieces.

Ids equal the tokenizers library's. It is asked once for each run of characters without white space that a worker
meets, which changes nothing: this vocabulary's tokens never cross white space, normal forms don't compose across it,
case folds by character, and special tokens hold none. Closing marks behind an ASCII letter are asked for apart, as letters
and marks never share a token.

Defined results: null text is an empty document, of the closing id alone; repeated rows are separate documents; a null id
stays null; an empty table gives no rows; texts of any length are encoded whole, other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL, Cut, spread_join

END_ID = 2
#: Marks that stand apart: the first behind an ASCII letter, the last before white space or the end.
MARKS = re.compile(rb"[,.;:?!](?<=[A-Za-z].)[,.;:?!]*(?=[ \t\n\r\x0b\f]|\Z)")
#: Bytes of ids in a batch, and remembered runs, about.
BATCH, REMEMBERED, LONG = 4 << 20, 1_000_000, 64


class Runs(dict):
    """Runs of bytes without white space, to their ids as little-endian unsigned 32-bit numbers; a run that isn't known is encoded."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def __missing__(self, run: bytes) -> bytes:
        if run.isalpha():  # ASCII letters: one token run, which no normal form changes but for its case
            found = [t.id for t in self.tokenizer.model.tokenize(run.lower().decode())]
        else:
            found = self.tokenizer.encode(run.decode("utf-8"), add_special_tokens=False).ids
        ids = np.array(found, "<u4").tobytes()
        if len(run) <= LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[run] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, MARKS.sub(rb" \g<0>", text).split()))


_runs: dict[str, Runs] = {}


def runs(path: str) -> Runs:
    """One for each worker process and vocabulary file."""
    if path not in _runs:
        _runs[path] = Runs(path)
    return _runs[path]


def lengths(n: int, context: int) -> list[int]:
    """The pieces of a document of ``n`` ids, in order: whole contexts, then the binary digits of the rest."""
    rest = n % context
    return [context] * (n // context) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pieces(docs: DataFrame, path: str, context: int = 4096, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's pieces: id, start, length, doc_tokens, ids (binary, 32 bits each); ``part`` and ``nth`` number a task's pieces of a length."""
    if context < 1 or context & (context - 1):
        raise ValueError("the context must be a power of two")
    end = np.array([end_id], "<u4").tobytes()
    names = ["id", "start", "length", "doc_tokens", "ids", "part", "nth"]
    kind = f"id {docs.schema[id_col].dataType.simpleString()}, start long, length long, doc_tokens long, ids binary, part int, nth long"

    def run(batches):
        known, part, made = runs(path), TaskContext.get().partitionId(), {}
        rows, size, ids_type = [], 0, None

        def flushed():
            cols = list(zip(*rows, strict=True))
            types = [ids_type, pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        for b in batches:
            ids_type = b.schema.field("id").type
            for at, text in zip(b.column("id").to_pylist(), b.column("t"), strict=True):
                ids = known.encode(text.as_py() or b"") + end
                start, total = 0, len(ids) // 4
                for n in lengths(total, context):
                    made[n] = nth = made.get(n, -1) + 1
                    rows.append((at, start, n, total, ids[4 * start : 4 * (start + n)], part, nth))
                    start += n
                    size += 4 * n + 64
                    if size > BATCH:
                        yield flushed()
                        rows, size = [], 0
        if rows:
            yield flushed()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, kind).withColumnRenamed("id", id_col)


def pack(docs: DataFrame, path: str, context: int = 4096, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, ids, bucket (the power of two), sequence_id (gapless from 0, the sequences of a bucket side by side, short ones first) and offset (0: a sequence is a piece)."""
    stored = Cut(pieces(docs, path, context, end_id, id_col, text_col)).df
    made = stored.groupBy("length", "part").agg(F.count("*").alias("n"))
    tasks = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = Cut(made.select("length", "part", "n", F.coalesce(F.sum("n").over(tasks), F.lit(0)).alias("first"))).df
    before, total = {}, 0
    for r in first.groupBy("length").agg(F.sum("n").alias("n")).orderBy("length").collect():  # a row for each power of two
        before[r["length"]], total = total, total + r["n"]
    bases = F.element_at(F.create_map(*[F.lit(x) for kv in (before or {1: 0}).items() for x in kv]), F.col("length").cast("int"))
    count = first.count()
    first = first.select("length", "part", (F.col("first") + bases).alias("first"))
    numbered = spread_join(stored, first, ["length", "part"], count, [id_col, "start"]) if count <= SMALL else stored.join(first, ["length", "part"])
    return numbered.select(id_col, "start", "length", "doc_tokens", "ids", F.round(F.log2("length")).cast("int").alias("bucket"), (F.col("first") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
