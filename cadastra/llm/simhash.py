"""SimHash near-dedup with vantage-point trees under the Hamming distance.

A fingerprint is one or more 64-bit words, each dealt to blocks; two fingerprints within ``distance`` bits are within
``distance // blocks`` bits in one block at least. Each block has a vantage-point tree whose nodes part fingerprints by
their distance, in that block, from a vantage point: at most the threshold, or more. A fingerprint lives in one leaf; by
the triangle bound it also has to be looked for in the leaves across every threshold that it lies within the radius of.
Vantage points come from a bounded sample (``SAMPLE`` at most); every distinct fingerprint is routed. A leaf's members
meet in one task; a leaf of more than its limit is dealt to chunks and each two chunks meet in a task of their own.
A task emits a spanning forest of the links it finds, never all pairs. Components come from alternating star joins.

``near_duplicates`` links by the fingerprint alone, with the radius that follows from ``distance``: every link is found.

``similar_texts`` links by the exact Jaccard similarity of shingle sets. Fingerprints of the sets only find candidates:
sets of a similarity s differ in each bit with a chance of at most arccos(2s / (1 + s)) / pi, 0.15 at 0.8. The trees
stand over blocks of 16 bits, with radius 1: a pair is looked at in every block in which it differs by a bit at most,
whatever the depth of the trees. At 0.8 that is 0.278 of the blocks, so all 20 blocks miss 0.0015 of such pairs, and at
0.85 they miss 0.0001; 81 of 320 bits, the distance up to which a pair is a candidate, lie five deviations above the
mean at 0.8. Candidates form classes, inside which every pair within the distance counts, and each link stands only if
the shingle sets have the similarity.

Defined results: null or wordless text has fingerprint zero and is linked like any other; equal fingerprints always
share a component; a component is named after its least non-null id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, hot_join, spread_join

SAMPLE, LEAF_TARGET, LEAF_ROWS = 32_768, 1024, 4096
STEP, ROWS = 1 << 13, 64
# similar_texts: bits of a block and radius in it; rows of a shard (a leaf of its trees) as aimed at and at most; pairs looked at together;
# members and bytes of shingle sets that a class brings to one task, and bytes of small classes that share one
BLOCK_BITS, RADIUS, SHARD_TARGET, SHARD_ROWS, PAIRS = 16, 1, 16_384, 65_536, 1 << 19
CLASS_ROWS, CLASS_BYTES, BUCKET_BYTES = 1024, 1 << 26, 1 << 23
# The increment and multipliers of a public 64-bit mixing function, from which further words come.
GOLDEN, MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mixed(h: np.ndarray, word: int) -> np.ndarray:
    z = h + np.uint64(GOLDEN * word % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(MIX[0])
    z = (z ^ (z >> np.uint64(27))) * np.uint64(MIX[1])
    return z ^ (z >> np.uint64(31))


def fingerprint(text: str | None, width: int = 3, n_words: int = 1) -> np.ndarray:
    """Words of the lower-cased (A-Z) bytes, ``width``-word shingles with repeats, XXH64 with seed 42, bitwise majority.

    The first of the 64-bit words is that of the hash itself; further ones are of the mixed hash.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(n_words, np.uint64)
    n = max(1, len(words) - width + 1)
    total = np.zeros((n_words, 64), np.int64)
    for lo in range(0, n, STEP):
        size = min(STEP, n - lo)
        shingles = map(b" ".join, zip(*(words[lo + i : lo + i + size] for i in range(width)), strict=True)) if len(words) >= width else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in shingles), np.uint64, size)
        for w in range(n_words):
            h = mixed(hashes, w) if w else hashes
            total[w] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * total > n, axis=1, bitorder="little").view(np.uint64)[:, 0]


def set_fingerprint(hashes: np.ndarray, n_words: int) -> np.ndarray:
    """The bitwise majority of distinct shingles' hashes, in as many words; zero without shingles."""
    total = np.zeros((n_words, 64), np.int64)
    for lo in range(0, len(hashes), STEP):
        part = hashes[lo : lo + STEP]
        for w in range(n_words):
            h = mixed(part, w) if w else part
            total[w] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * total > len(hashes), axis=1, bitorder="little").view(np.uint64)[:, 0]


def fingerprints(docs: DataFrame, width: int = 3, n_words: int = 1, id_col: str = "doc_id", text_col: str = "text", sets: bool = False) -> DataFrame:
    """One row per document: id, fp (the words' bytes, each from its highest bit) and, if shingles count once, as ``sets``, t (the text's hash)."""

    def run(batches):
        for b in batches:
            one = (lambda t: set_fingerprint(shingle_set(t, width), n_words)) if sets else lambda t: fingerprint(t, width, n_words)
            fps = [one(t.as_py()).astype(">u8").tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(fps, pa.binary()), *([b.column("t")] if sets else [])], [id_col, "fp", *(["t"] if sets else [])])

    kind = docs.schema[id_col].dataType.simpleString()
    extra = [F.xxhash64(text_col).alias("t")] if sets else []
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text"), *extra).mapInArrow(run, f"`{id_col}` {kind}, fp binary" + ", t long" * sets)


def matrix(column) -> np.ndarray:
    """Rows of 64-bit words from a column of fingerprints."""
    got = column.to_pylist()
    return np.frombuffer(b"".join(got), ">u8").astype(np.uint64).reshape(len(got), -1) if got else np.zeros((0, 1), np.uint64)


class VantageTree:
    """The tree of one block, some bits of one word. A node is (vantage, threshold, inner, outer); a leaf is its number."""

    def __init__(self, sample: np.ndarray, word: int, mask: int, radius: int, fewest: int):
        self.word, self.mask, self.radius, self.leaves = word, np.uint64(mask), radius, 0
        self.rng = np.random.default_rng(word)
        self.root = self._build(sample[:, word] & self.mask, max(1, fewest), 0)

    def _build(self, x: np.ndarray, fewest: int, depth: int):
        if len(x) > fewest and depth < 40:
            best = None
            for v in self.rng.choice(x, min(4, len(x)), replace=False):
                d = np.bitwise_count(x ^ v).astype(np.int64)
                for mu in {int(np.median(d)), int(np.median(d)) - 1}:
                    inner = d <= mu
                    near = np.mean((d > mu - self.radius) & (d <= mu + self.radius)) if self.radius else 0
                    cost = abs(inner.mean() - 0.5) + near
                    if 0 < inner.sum() < len(x) and (best is None or cost < best[0]):
                        best = (cost, v, mu, inner)
            if best is not None:
                _, v, mu, inner = best
                return (v, mu, self._build(x[inner], fewest, depth + 1), self._build(x[~inner], fewest, depth + 1))
        self.leaves += 1
        return self.leaves - 1

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs: each row's home leaf and the later leaves that the triangle bound does not rule out."""
        x, home, visits = fps[:, self.word] & self.mask, np.zeros(len(fps), np.int64), []

        def walk(node, rows, own):
            if not len(rows):
                return
            if not isinstance(node, tuple):
                home[rows[own]] = node
                visits.append((rows[~own], node))
                return
            v, mu, inner, outer = node
            d = np.bitwise_count(x[rows] ^ v).astype(np.int64)
            to_in, to_out = d - self.radius <= mu, d + self.radius > mu
            walk(inner, rows[to_in], own[to_in] & (d[to_in] <= mu))
            walk(outer, rows[to_out], own[to_out] & (d[to_out] > mu))

        walk(self.root, np.arange(len(fps)), np.ones(len(fps), bool))
        rows, leaves = [np.arange(len(fps))], [home]
        for r, leaf in visits:
            r = r[home[r] < leaf]
            rows.append(r)
            leaves.append(np.full(len(r), leaf, np.int64))
        return np.concatenate(rows), np.concatenate(leaves)


def forest_edges(x: np.ndarray, distance: int, group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest, by row numbers, of the links among rows: all are compared, a band of rows at a time. ``group``: what is already joined, kept up to date."""
    n, edges, group = len(x), [], np.arange(len(x)) if group is None else group

    def join(a: int, b: int):
        if group[a] != group[b]:
            edges.append((a, b))
            group[group == group[b]] = group[a]

    for lo in range(0, n, ROWS):
        band = x[lo : lo + ROWS]
        d = np.zeros((len(band), n - lo), np.uint16)
        for w in range(x.shape[1]):
            d += np.bitwise_count(band[:, None, w] ^ x[None, lo:, w])
        near = np.triu(d <= distance, 1)
        cols = np.flatnonzero(near.any(0))
        if not len(cols):
            continue
        first = near[:, cols].argmax(0)
        for a, b in zip((first + lo).tolist(), (cols + lo).tolist(), strict=True):
            join(a, b)
        for r in np.flatnonzero(near.any(1)):
            for f in np.unique(first[near[r, cols]]):
                join(int(r) + lo, int(f) + lo)
    return edges


def sampled(distinct: DataFrame, m: int, target: int) -> np.ndarray:
    """About ``target`` of the m fingerprints, by a hash, in order."""
    picked = distinct.where(F.pmod(F.xxhash64("fp", F.lit(3)), F.lit(1_000_003)) < F.lit(min(1.0, target / max(m, 1)) * 1_000_003)).limit(2 * SAMPLE)
    got = sorted(bytes(r["fp"]) for r in picked.select("fp").collect())
    return np.frombuffer(b"".join(got), ">u8").astype(np.uint64).reshape(len(got), -1) if got else np.zeros((0, 1), np.uint64)


def links(distinct: DataFrame, distance: int, blocks: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose closure is that of all links; ``blocks`` to a 64-bit word."""
    m = distinct.count()
    sample = sampled(distinct, m, max(256, min(SAMPLE, 16 * m // LEAF_TARGET)))
    fewest = max(1, LEAF_TARGET * len(sample) // max(m, 1))
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]
    radius = distance // (blocks * sample.shape[1])
    trees = [VantageTree(sample, w, mask, radius, fewest) for w in range(sample.shape[1]) for mask in masks]

    def route(batches):
        for b in batches:
            column = b.column("fp")
            fps = matrix(column)
            for k, t in enumerate(trees if len(fps) else ()):
                rows, leaves = t.route(fps)
                yield pa.RecordBatch.from_arrays([pa.array(leaves + (k << 32)), column.take(pa.array(rows))], ["leaf", "fp"])

    routed = Cut(distinct.select("fp").mapInArrow(route, "leaf long, fp binary"))
    large = {r["leaf"]: -(-r["n"] // LEAF_ROWS) for r in routed.df.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > LEAF_ROWS).collect()}

    def deal(batches):
        for b in batches:
            leaf, out = b.column("leaf").to_numpy(), []
            small = np.ones(len(leaf), bool)
            for one in np.unique(leaf):
                if (c := large.get(int(one), 1)) > 1:
                    at = np.flatnonzero(leaf == one)
                    small[at] = False
                    mine = np.array([xxhash.xxh32_intdigest(v) % c for v in b.column("fp").take(pa.array(at)).to_pylist()])
                    for other in range(c):
                        use = mine != other
                        out.append((at[use], (np.minimum(mine, other) * c + np.maximum(mine, other))[use]))
            out.append((np.flatnonzero(small), np.zeros(small.sum(), np.int64)))
            rows = np.concatenate([r for r, _ in out])
            yield pa.RecordBatch.from_arrays([pa.array(leaf[rows]), pa.array(np.concatenate([c for _, c in out]).astype(np.int64)), b.column("fp").take(pa.array(rows))], ["leaf", "chunk", "fp"])

    def meet(group: pa.Table) -> pa.Table:
        column = group.column("fp").combine_chunks()
        found = np.array(forest_edges(matrix(column), distance), np.int64).reshape(-1, 2)
        return pa.table({"u": column.take(pa.array(found[:, 0])), "v": column.take(pa.array(found[:, 1]))})

    met = routed.df.mapInArrow(deal, "leaf long, chunk long, fp binary").groupBy("leaf", "chunk").applyInArrow(meet, "u binary, v binary")
    out = Cut(met.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct())
    routed.drop()
    return out.df


class Shards:
    """The trees of all 16-bit blocks, as tables by the block's value: its home leaf and the later leaves that the radius reaches into."""

    def __init__(self, sample: np.ndarray, fewest: int, radius: int = RADIUS):
        self.radius, self.of = radius, []
        values = np.arange(1 << BLOCK_BITS, dtype=np.uint64)
        for word in range(sample.shape[1]):
            for low in range(0, 64, BLOCK_BITS):
                tree = VantageTree(sample, word, (1 << low + BLOCK_BITS) - (1 << low), radius, fewest)
                every = np.zeros((len(values), sample.shape[1]), np.uint64)
                every[:, word] = values << np.uint64(low)
                rows, leaves = tree.route(every)
                # there are no more leaves than values of a block
                home, rows, leaves = leaves[: len(values)].astype(np.uint16), rows[len(values) :], leaves[len(values) :].astype(np.uint16)
                # the bounds of several nodes can hold where no single value does: such leaves need no visit
                reached = np.zeros(len(rows), bool)
                for flip in flips(radius):
                    reached |= home[rows ^ flip] == leaves
                rows, leaves = rows[reached], leaves[reached]
                order = np.argsort(rows, kind="stable")
                self.of.append((home, np.searchsorted(rows[order], np.arange(len(values) + 1)).astype(np.int32), leaves[order]))

    def route(self, k: int, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs in the k-th tree, those at home first."""
        home, first, visits = self.of[k]
        v = block_value(k, fps)
        many = (first[v + 1] - first[v]).astype(np.int64)
        rows = np.repeat(np.arange(len(v)), many)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[v], many)
        return np.concatenate([np.arange(len(v)), rows]), np.concatenate([home[v], visits[at]])


@lru_cache(maxsize=1)
def shards_of(sample: bytes, n_words: int, fewest: int) -> Shards:
    """The tables for a sample's bytes, made once in each worker: they are some twenty megabytes, which neither the driver nor a job's closure holds."""
    return Shards(np.frombuffer(sample, np.uint64).reshape(-1, n_words), fewest)


def block_value(k: int, fps: np.ndarray) -> np.ndarray:
    """The values of the k-th block."""
    word, low = divmod(k * BLOCK_BITS, 64)
    return (fps[:, word] >> np.uint64(low) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


def flips(radius: int) -> list[int]:
    """What can be added, without carry, to a value of a block to reach those within the radius (1 at most)."""
    return [0, *(1 << b for b in range(BLOCK_BITS))][: 1 + BLOCK_BITS * radius]


class Forest:
    """Joins rows by links, many at a time, and keeps one link for each join."""

    def __init__(self, n: int):
        self.root, self.edges = np.arange(n), [np.zeros((0, 2), np.int64)]

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            if not (apart := x != y).any():
                return
            a, b, high, low = a[apart], b[apart], np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            order = np.lexsort((low, high))
            # every root hooks on to its least neighbour once
            first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
            to = np.arange(len(self.root))
            to[high[first]] = low[first]
            while (to[to] != to).any():
                to = to[to]
            self.root = to[self.root]
            self.edges.append(np.stack([a[first], b[first]], 1))

    def found(self) -> np.ndarray:
        return np.concatenate(self.edges)


def distances(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.zeros(len(a), np.uint16)
    for w in range(x.shape[1]):
        d += np.bitwise_count(x[a, w] ^ x[b, w])
    return d


def near_in_block(x: np.ndarray, v: np.ndarray, home: np.ndarray, side: np.ndarray | None, distance: int, radius: int) -> np.ndarray:
    """A spanning forest of the links among rows whose block values ``v`` lie within the radius; one of a pair has to be at home, and both on different sides if there are sides."""
    order = np.argsort(v, kind="stable")
    values, start, count = np.unique(v[order], return_index=True, return_counts=True)
    forest = Forest(len(x))
    for flip in flips(radius):
        at = np.minimum(np.searchsorted(values, values ^ flip), len(values) - 1)
        ones = np.flatnonzero((values[at] == values ^ flip) & (values <= values ^ flip))
        # pairs of rows by the number of their group and their number in it, a bounded part at a time
        sizes = count[ones] * count[at[ones]]
        ends = np.cumsum(sizes)
        for lo in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            n = np.arange(lo, min(lo + PAIRS, int(ends[-1])))
            g = np.searchsorted(ends, n, "right")
            own, other = ones[g], at[ones[g]]
            n -= ends[g] - sizes[g]
            a, b = order[start[own] + n // count[other]], order[start[other] + n % count[other]]
            use = home[a] | home[b]
            use &= (a < b) if not flip else True
            if side is not None:
                use &= side[a] != side[b]
            use[use] = forest.root[a[use]] != forest.root[b[use]]
            a, b = a[use], b[use]
            near = distances(x, a, b) <= distance
            forest.join(a[near], b[near])
    return forest.found()


def candidates(distinct: DataFrame, distance: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints whose closure is that of all links within the distance that some block shows with a bit at most."""
    m = distinct.count()
    sample = sampled(distinct, m, max(256, min(SAMPLE, 16 * m // SHARD_TARGET)))
    fewest = max(1, SHARD_TARGET * len(sample) // max(m, 1))
    sample, n_words, radius = sample.tobytes(), sample.shape[1], RADIUS

    def sizes(batches):
        for b in batches:
            fps, shards = matrix(b.column("fp")), shards_of(sample, n_words, fewest)
            for k in range(len(shards.of) if len(fps) else 0):
                leaf, n = np.unique(shards.route(k, fps)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int64) + (k << 32)), pa.array(n)], ["shard", "n"])

    counted = distinct.select("fp").mapInArrow(sizes, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    large = {r["shard"]: -(-r["n"] // SHARD_ROWS) for r in counted.where(F.col("n") > SHARD_ROWS).collect()}

    def deal(batches):
        for b in batches:
            column, shards = b.column("fp"), shards_of(sample, n_words, fewest)
            fps = matrix(column)
            chunk = np.array([xxhash.xxh32_intdigest(v) for v in column.to_pylist()], np.int64) if large else None
            for k in range(len(shards.of) if len(fps) else 0):
                rows, leaf = shards.route(k, fps)
                home, shard = np.arange(len(rows)) < len(fps), leaf.astype(np.int64) + (k << 32)
                parts = [(rows, shard, home, np.zeros(len(rows), np.int64))]
                if large:
                    c = np.array([large.get(s, 1) for s in shard.tolist()])
                    small = c == 1
                    parts = [(rows[small], shard[small], home[small], parts[0][3][small])]
                    for other in range(c.max()):
                        use = (c > 1) & (other < c)
                        mine = chunk[rows[use]] % c[use]
                        # the two chunks that meet, by number, and which of them the row is of
                        place = np.minimum(mine, other) * c[use] + np.maximum(mine, other) + 1
                        parts.append((rows[use], shard[use], home[use], np.where(mine > other, -place, place)))
                rows, shard, home, place = (np.concatenate(p) for p in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(np.abs(place)), pa.array(home), pa.array(place < 0), column.take(pa.array(rows))], ["shard", "place", "home", "second", "fp"])

    def meet(group: pa.Table) -> pa.Table:
        column, shard, place = group.column("fp").combine_chunks(), group.column("shard")[0].as_py(), group.column("place")[0].as_py()
        x, home, second = matrix(column), group.column("home").to_numpy(), group.column("second").to_numpy()
        c = large.get(shard, 1)
        across = c > 1 and (place - 1) // c != (place - 1) % c
        found = near_in_block(x, block_value(shard >> 32, x), home, second if across else None, distance, radius)
        return pa.table({"u": column.take(pa.array(found[:, 0])), "v": column.take(pa.array(found[:, 1]))})

    met = distinct.select("fp").mapInArrow(deal, "shard long, place long, home boolean, second boolean, fp binary").groupBy("shard", "place").applyInArrow(meet, "u binary, v binary")
    return Cut(met.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct()).df


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of an edge, the root being the least node; alternating large and small stars until nothing changes."""
    state, seen = Cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()), None
    for _ in range(rounds):
        both = state.df.unionByName(state.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        n = 2 * state.df.count()
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = Cut(hot_join(both.where("v > u"), least, "u", n).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        least = large.df.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        joined = hot_join(large.df, least, "u", n)
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = Cut(small)
        now = new.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        large.drop()
        state.drop()
        state = new
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return state.df.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(state.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the shingles that ``fingerprint`` takes."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    grams = {b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else ()
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in grams), np.uint64, len(grams)))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def checked(x: np.ndarray, sets: list[np.ndarray], second: np.ndarray | None, distance: int, least: float) -> np.ndarray:
    """A spanning forest of the links within the distance whose sets have a similarity of ``least``; with ``second``, only between rows that differ in it."""
    forest = Forest(len(x))
    for lo in range(0, len(x), ROWS):
        band = x[lo : lo + ROWS]
        d = np.zeros((len(band), len(x) - lo), np.uint16)
        for w in range(x.shape[1]):
            d += np.bitwise_count(band[:, None, w] ^ x[None, lo:, w])
        a, b = np.nonzero(np.triu(d <= distance, 1))
        for k in np.argsort(d[a, b], kind="stable").tolist():
            i, j = int(a[k]) + lo, int(b[k]) + lo
            if forest.root[i] != forest.root[j] and (second is None or second[i] != second[j]) and jaccard(sets[i], sets[j]) >= least:
                forest.join(np.array([i]), np.array([j]))
    return forest.found()


def verified(edges: DataFrame, prints: DataFrame, docs: DataFrame, width: int, distance: int, least: float, id_col: str, text_col: str) -> DataFrame:
    """Edges (u, v) whose closure is that of all links within the classes of the given edges: pairs within the distance whose texts have a Jaccard similarity of ``least`` or more. One text (the least 64-bit hash ``t``) stands for a fingerprint: others of the same 320 bits have the same shingles but for a hair."""
    classes = Cut(components(edges)).df
    n = classes.count()
    # a text that many documents share is one row here
    chosen = Cut(prints.groupBy("fp").agg(F.min("t").alias("t")).join(classes.select(F.col("node").alias("fp"), "root").hint("merge"), "fp")).df
    texts = docs.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    linked = spread_join(texts, chosen.select("t"), ["t"], n, ["i"], "left_semi").groupBy("t").agg(F.first("text").alias("text"))

    def sets(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("root"), b.column("fp"), pa.array([shingle_set(t.as_py(), width).tobytes() for t in b.column("text")], pa.large_binary()).cast(pa.binary())], ["root", "fp", "set"])

    known = Cut(linked.join(chosen.hint("merge"), "t").select("root", "fp", "text").mapInArrow(sets, "root binary, fp binary, set binary"))
    size = known.df.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("set")).alias("bytes"))
    size = Cut(size.select("root", "n", "bytes", F.greatest(F.ceil(F.col("n") / CLASS_ROWS), F.ceil(F.col("bytes") / CLASS_BYTES), F.lit(1)).cast("long").alias("c")))
    buckets = max(12, (size.df.agg(F.sum("bytes").alias("b")).first()["b"] or 0) // BUCKET_BYTES)
    # a small class shares its task with others; of a large one each two chunks meet
    mine = F.pmod(F.xxhash64("fp"), F.col("c"))
    dealt = hot_join(known.df, size.df.drop("bytes"), "root", n).select("root", "fp", "set", "c", mine.alias("mine"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("other"))
    alone = F.col("c") == 1
    dealt = dealt.select(
        "root", "fp", "set", F.when(alone, F.pmod(F.xxhash64("root"), F.lit(buckets))).otherwise(F.xxhash64("root")).alias("g"), F.when(alone, -1).otherwise(F.least("mine", "other")).alias("lo"),
        F.when(alone, -1).otherwise(F.greatest("mine", "other")).alias("hi"), (F.col("mine") > F.col("other")).alias("second"),
    )

    def meet(group: pa.Table) -> pa.Table:
        across = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
        group = group.sort_by("root").combine_chunks()
        root, column = group.column("root").to_pylist(), group.column("fp").combine_chunks()
        x, second = matrix(column), group.column("second").to_numpy()
        all_sets = [np.frombuffer(v.as_py(), np.uint64) for v in group.column("set")]
        out, lo = [np.zeros((0, 2), np.int64)], 0
        while lo < len(root):
            hi = lo + 1
            while hi < len(root) and root[hi] == root[lo]:
                hi += 1
            out.append(checked(x[lo:hi], all_sets[lo:hi], second[lo:hi] if across else None, distance, least) + lo)
            lo = hi
        found = np.concatenate(out)
        return pa.table({"u": column.take(pa.array(found[:, 0])), "v": column.take(pa.array(found[:, 1]))})

    out = Cut(dealt.groupBy("g", "lo", "hi").applyInArrow(meet, "u binary, v binary"))
    known.drop()
    return out.df


def named(prints: DataFrame, distinct: DataFrame, edges: DataFrame, total: int, id_col: str, choose: bool = False) -> DataFrame:
    """One row per document: id, fp, component_id; with ``choose`` also t and ``chosen``, whether the row is its component's own: that of the least id (nulls last) and, among its texts, of the least fingerprint."""
    roots = components(edges).select(F.col("node").alias("fp"), "root")
    linked = Cut(roots.join(distinct.hint("merge"), "fp").select("fp", "rep", "root", "n")).df
    first = [F.min_by("fp", F.struct(F.col("rep").isNull(), "rep", "fp")).alias("own")] if choose else []
    least = linked.groupBy("root").agg(F.min("rep").alias("component_id"), *first, F.count("*").alias("n"))
    own = ["own"] if choose else []
    known = hot_join(linked.withColumnRenamed("n", "docs"), least, "root", linked.count()).select("fp", F.col("component_id").alias("c"), *own)
    of = Cut(distinct.join(known.hint("merge"), "fp", "left").select("fp", F.coalesce("c", "rep").alias("component_id"), *own, "n")).df
    if not choose:
        return hot_join(prints.select(id_col, "fp"), of, "fp", total).select(id_col, "fp", "component_id")
    chosen = F.col(id_col).eqNullSafe(F.col("component_id")) & (F.coalesce("own", "fp") == F.col("fp"))
    return hot_join(prints.select(id_col, "fp", "t"), of, "fp", total).select(id_col, "fp", "component_id", "t", chosen.alias("chosen"))


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, blocks: int = 2, n_words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fp, component_id (the least id that links lead to, its own included)."""
    prints = Cut(fingerprints(docs, width, n_words, id_col, text_col)).df
    distinct = Cut(prints.groupBy("fp").agg(F.min(id_col).alias("rep"), F.count("*").alias("n"))).df
    return named(prints, distinct, links(distinct, distance, blocks), prints.count(), id_col)


def far(least: float, n_words: int) -> int:
    """The distance of fingerprints up to which sets of that similarity lie, five deviations above the mean."""
    p = math.acos(2 * least / (1 + least)) / math.pi
    return math.ceil(64 * n_words * p + 5 * math.sqrt(64 * n_words * p * (1 - p)))


def similar_texts(docs: DataFrame, width: int = 5, least: float = 0.8, n_words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, fp, component_id (the least id that links lead to, its own included), t (the text's hash) and ``chosen``; a link is a Jaccard similarity of ``least`` or more."""
    prints = Cut(fingerprints(docs, width, n_words, id_col, text_col, sets=True)).df
    distinct = Cut(prints.groupBy("fp").agg(F.min(id_col).alias("rep"), F.count("*").alias("n"))).df
    distance = far(least, n_words)
    edges = verified(candidates(distinct, distance), prints, docs, width, distance, least, id_col, text_col)
    return named(prints, distinct, edges, prints.count(), id_col, choose=True)


def keep_one(docs: DataFrame, width: int = 5, least: float = 0.8, n_words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, one text of each component: that of the least id, nulls last. Rows count, not ids: of rows that share an id only those go whose own text has a chosen one beside it; rows that repeat both id and text stay or go together."""
    found = similar_texts(docs, width, least, n_words, id_col, text_col)
    dropped = found.where(~F.col("chosen")).select(F.col(id_col).alias("__id"), F.col("t").alias("__t")).distinct().hint("merge")
    return docs.join(dropped, docs[id_col].eqNullSafe(dropped["__id"]) & (F.xxhash64(docs[text_col]) == dropped["__t"]), "left_anti")


def hex_of(fp="fp"):
    return F.lower(F.hex(fp))
