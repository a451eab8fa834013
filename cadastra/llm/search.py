"""Ranked lexical search: sharded postings, document-at-a-time heap merge, one global merge of the shards' best.

``build`` writes the index once: a task turns its documents into shards of about ``SHARD`` postings. A shard has a row
for each term, its postings sorted by document id (gaps and counts as variable-length numbers), and a row for its
documents (ids in order, numbers of terms). No posting is shuffled to build it.

``search`` takes the stated items as queries, in blocks of ``BLOCK`` terms. Document frequencies are sums of the rows'
counts; postings of asked terms join their weights and the items that use them, and meet by shard and block. There a
heap merges an item's postings by document; a bounded heap, keyed by score and then document, keeps the best. Terms
which together can't lift a document over the heap's least are looked up, not merged, so most documents of frequent
words are passed by; that bound is exact. A window keeps the best of all shards, each task's own best first.

Defined results: null or wordless text is no document and, as an item, finds nothing; repeated documents are separate,
and so are repeated items, each with its own ranks; equal scores go by ascending document id, null first, and equal ids
in an order that isn't fixed; an empty table gives no rows; texts of any length are read whole, other columns ignored.
"""

from __future__ import annotations

import heapq
import itertools
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Cut, spread_join

#: Postings of a shard and terms of a block of queries, about.
SHARD, BLOCK = 2 << 20, 50_000
ROWS = 20_000
#: Digits, letters (capital ones made small) and bytes beyond ASCII make terms; all else is white space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


# ---- numbers of variable length: seven bits a byte, low ones first, the last byte below 128 ----
def packed(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The values' bytes, and where each begins (one more at the end)."""
    v = values.astype(np.uint64)
    width = np.ones(len(v), np.int64)
    for k in range(1, 10):
        width += v >= np.uint64(1 << (7 * k))
    at = np.concatenate(([0], np.cumsum(width)))
    out = np.zeros(at[-1], np.uint8)
    for k in range(int(width.max(initial=0))):
        has = width > k
        out[at[:-1][has] + k] = ((v[has] >> np.uint64(7 * k)) & np.uint64(127)) | (np.uint64(128) * (width[has] > k + 1))
    return out.tobytes(), at


def unpacked(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.int64)
    last = b < 128
    first = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1))
    number = np.cumsum(last) - last
    shift = 7 * (np.arange(len(b)) - first[number])
    return np.add.reduceat((b & 127).astype(np.int64) << shift, first)


# ---- the index ---------------------------------------------------------------
class Shard:
    """Documents gathered by a task until they make a shard."""

    def __init__(self):
        self.codes, self.ids, self.sizes, self.parts = defaultdict(itertools.count().__next__), [], [], []
        self.postings = 0

    def add(self, at, words: list[bytes]) -> None:
        counts = Counter(words)
        code = np.fromiter(map(self.codes.__getitem__, counts), np.int64, len(counts))
        self.parts.append((code, np.fromiter(counts.values(), np.int64, len(counts))))
        self.ids.append(at)
        self.sizes.append(len(words))
        self.postings += len(counts)

    def rows(self, number: int):
        """(shard, term, n, total, data, ids): the documents' row, then the terms in order."""
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is not None, self.ids[k]))
        names = sorted(self.codes)
        place = np.empty(len(names), np.int64)
        place[np.fromiter(map(self.codes.__getitem__, names), np.int64, len(names))] = np.arange(len(names))
        code = place[np.concatenate([self.parts[k][0] for k in order])]
        doc = np.repeat(np.arange(len(order)), [len(self.parts[k][0]) for k in order])
        by = np.argsort(code, kind="stable")
        code, doc, count = code[by], doc[by], np.concatenate([self.parts[k][1] for k in order])[by]
        start = np.searchsorted(code, np.arange(len(names) + 1))
        gap = np.diff(doc, prepend=0)
        gap[start[:-1]] = doc[start[:-1]]
        data, at = packed(np.stack([gap, count], 1).ravel())
        sizes = [self.sizes[k] for k in order]
        yield [(number, None, len(order), sum(sizes), packed(np.array(sizes))[0], [self.ids[k] for k in order])]
        for lo in range(0, len(names), ROWS):
            yield [(number, names[k], int(start[k + 1] - start[k]), None, data[at[2 * start[k]] : at[2 * start[k + 1]]], None) for k in range(lo, min(lo + ROWS, len(names)))]


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index's rows: shard, term (null: the shard's documents), n (documents), total (terms with repeats), data, ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        part, made, now, ids_type = TaskContext.get().partitionId() << 24, 0, Shard(), None

        def out():
            types = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.list_(ids_type)]
            for rows in now.rows(part + made):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["shard", "term", "n", "total", "data", "ids"])

        for b in batches:
            ids_type = b.schema.field("id").type
            for at, text in zip(b.column("id").to_pylist(), b.column("t"), strict=True):
                if words := terms(text.as_py()):
                    now.add(at, words)
                    if now.postings >= SHARD:
                        yield from out()
                        made, now = made + 1, Shard()
        if now.ids:
            yield from out()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"shard long, term binary, n int, total long, data binary, ids array<{kind}>")


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index, stored in the shared folder."""
    return Cut(shards(docs, id_col, text_col)).df


# ---- queries -----------------------------------------------------------------
def asked(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, key, term, reps): each item row's terms and how often it has them; ``item`` numbers the rows."""
    kind = items.schema[item_col].dataType.simpleString()

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for b in batches:
            rows = []
            for key, text in zip(b.column("id").to_pylist(), b.column("t"), strict=True):
                rows += [(number, key, t, n) for t, n in Counter(terms(text.as_py())).items()]
                number += 1
            types = [pa.int64(), b.schema.field("id").type, pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["item", "key", "term", "reps"])

    return items.select(F.col(item_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"item long, key {kind}, term binary, reps long")


def best(lists: list[tuple[list[int], list[int], int]], k: int) -> list[tuple[int, int]]:
    """(score, document) of the k highest scores above 0, equal ones by ascending document. ``lists``: documents ascending, what each adds, the most that one adds."""
    lists = sorted(lists, key=lambda x: x[2])
    width, reach = len(lists), list(itertools.accumulate(x[2] for x in lists))
    at, found = [0] * width, []
    floor, first = 0, 0  # a document must pass the floor; lists before the first can't lift one over it
    heap = [x[0][0] * width + j for j, x in enumerate(lists)]
    heapq.heapify(heap)
    while heap:
        doc, score = heap[0] // width, 0
        while heap and heap[0] // width == doc:
            j = heap[0] % width
            docs, adds, _ = lists[j]
            if j < first:  # no longer merged: looked up below
                heapq.heappop(heap)
                continue
            place = at[j]
            score += adds[place]
            at[j] = place = place + 1
            if place < len(docs):
                heapq.heapreplace(heap, docs[place] * width + j)
            else:
                heapq.heappop(heap)
        if not score:
            continue
        for j in range(first - 1, -1, -1):
            if score + reach[j] <= floor:
                break
            docs, adds, _ = lists[j]
            at[j] = place = bisect_left(docs, doc, at[j])
            if place < len(docs) and docs[place] == doc:
                score += adds[place]
        if score > floor:
            if len(found) < k:
                heapq.heappush(found, (score, -doc))
            else:
                heapq.heappushpop(found, (score, -doc))
            if len(found) == k:
                floor = found[0][0]
                while first < width and reach[first] <= floor:
                    first += 1
    return [(s, -d) for s, d in sorted(found, reverse=True)]


def search(index: DataFrame, items: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Each item's k best documents with score above 0: (item's id, rank, doc_id, score)."""
    id_kind = index.schema["ids"].dataType.elementType.simpleString()
    queries = Cut(asked(items, item_col, text_col)).df
    blocks = max(1, -(-queries.count() // BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    docs, postings = index.where("term IS NULL"), index.where("term IS NOT NULL")
    size = docs.agg(F.sum("n").alias("docs"), F.sum("total").alias("terms")).first()
    count, length = size["docs"] or 0, size["terms"] or 1
    vocabulary = Cut(queries.select("term").distinct()).df
    df = spread_join(postings.select("shard", "term", "n"), vocabulary, ["term"], vocabulary.count(), ["shard"]).groupBy("term").agg(F.sum("n").alias("df"))
    weights = df.select("term", F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * count + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long").alias("w")).where("w > 0")
    wanted = Cut(queries.join(weights, "term").groupBy("term", "block", "w").agg(F.collect_list(F.struct("item", "reps")).alias("u"))).df  # no list is longer than a block
    wanted = wanted.select("term", "block", "w", F.col("u.item").alias("items"), F.col("u.reps").alias("reps"))
    hits = spread_join(postings.select("shard", "term", "data"), wanted, ["term"], wanted.count(), ["shard"]).select("shard", "block", "w", "items", "reps", "data", F.lit(None).cast(f"array<{id_kind}>").alias("ids"))
    none = F.lit(None).cast("array<long>")
    heads = docs.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast("long").alias("w"), none.alias("items"), none.alias("reps"), "data", "ids")

    def ranked(t: pa.Table) -> pa.Table:
        w, data = t.column("w").to_pylist(), t.column("data").to_pylist()
        head = w.index(None)
        m = 100 - 75 + (75 * unpacked(data[head]) * count) // length
        uses = defaultdict(list)
        for row, (weight, users, reps) in enumerate(zip(w, t.column("items").to_pylist(), t.column("reps").to_pylist(), strict=True)):
            if weight is not None:
                numbers = unpacked(data[row])
                at, n = np.cumsum(numbers[::2]), numbers[1::2]
                adds = weight * ((1_000_000_000 * n) // (1000 * n + 8 * m[at]))
                one = (at.tolist(), adds.tolist(), int(adds.max()))
                for item, times in zip(users, reps, strict=True):
                    uses[item].append(one if times == 1 else (one[0], (adds * times).tolist(), one[2] * times))
        rows = [(item, doc, score) for item, lists in uses.items() for score, doc in best(lists, k)]
        ids = t.column("ids")[head].values.take(pa.array([r[1] for r in rows], pa.int64()))
        return pa.table({"item": pa.array([r[0] for r in rows], pa.int64()), "doc_id": ids, "score": pa.array([r[2] for r in rows], pa.int64())})

    found = hits.unionByName(heads).groupBy("shard", "block").applyInArrow(ranked, f"item long, doc_id {id_kind}, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(queries.select("item", F.col("key").alias(item_col)).distinct(), "item").select(item_col, "rank", "doc_id", "score")
