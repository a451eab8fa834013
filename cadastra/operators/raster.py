"""Steep ground as polygons, made once for a whole grid.

The grid is cut into square tiles with a rim of one cell, so that slopes need no other tile. A task finds the 4-connected
components of a tile's steep cells by union-find over runs, and traces their rings: pieces, each named by its first cell.
Pieces of neighbouring tiles meet by the borders that their cells share, ``components`` joins them, and ``whole`` unites
those of a component. What a task holds is bounded by the tile. Joins with parcels take the pieces: a ridge across the
county stays many small shapes.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..kernel import functions as K
from .lineage import cut
from .slope import TILE, Grid, window_steep, windows
from .spatial import grid_join, subdivided, with_box

SIDE = 256
PIECES = "piece long, cells long, borders array<long>, geom binary"


def _change(before: np.ndarray, here: np.ndarray, after: np.ndarray, step: float) -> np.ndarray:
    """Central differences; one-sided beside a cell without elevation or the grid's edge, none between two of them."""
    no_before, no_after = np.isnan(before), np.isnan(after)
    out = np.where(no_before, (after - here) / step, np.where(no_after, (here - before) / step, (after - before) / (2 * step)))
    return np.where(no_before & no_after, 0.0, out)


def labelled(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """4-connected components of a mask: labels (-1 off the mask) in the order of their first cells, and these cells' flat places."""
    height, width = mask.shape
    padded = np.zeros((height, width + 2), np.int8)
    padded[:, 1:-1] = mask
    row, at = np.nonzero(np.diff(padded, axis=1))
    row, start, end = row[::2], at[::2], at[1::2]  # runs of cells, the end excluded
    root = list(range(len(row)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first = np.searchsorted(row, np.arange(height + 1)).tolist()
    begins, ends = start.tolist(), end.tolist()
    for r in range(1, height):
        a, b = first[r - 1], first[r]
        while a < first[r] and b < first[r + 1]:
            if begins[a] < ends[b] and begins[b] < ends[a]:
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
            if ends[a] <= ends[b]:
                a += 1
            else:
                b += 1
    heads, names = np.unique([find(i) for i in range(len(root))], return_inverse=True)
    labels = np.full(height * width, -1, np.int64)
    size = end - start
    cells = np.repeat(row * width + start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    labels[cells] = np.repeat(names, size)
    return labels.reshape(height, width), (row * width + start)[heads.astype(np.int64)]


def rings(labels: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """(label, corners as (line of rows, line of columns)) of each ring, the component on the right hand: outer rings turn right, holes left.

    Where a component touches itself at a corner the ring keeps to the outside, so that an outer ring and a hole meet in a
    point instead of an outer ring meeting itself.
    """
    height, width = labels.shape
    lab = np.full((height + 2, width + 2), -1, np.int64)
    lab[1:-1, 1:-1] = labels
    on, wide = lab >= 0, width + 3
    # an edge leaves the corner (i, j) east, south, west or north along the top, right, bottom or left of its cell
    sides = (on & ~np.roll(on, 1, 0), on & ~np.roll(on, -1, 1), on & ~np.roll(on, -1, 0), on & ~np.roll(on, 1, 1))
    shift, step = (0, 1, wide + 1, wide), (1, wide, -1, -wide)
    edges: list[dict[int, int]] = []
    for side, by in zip(sides, shift, strict=True):
        r, c = np.nonzero(side)
        edges.append(dict(zip((r * wide + c + by).tolist(), lab[r, c].tolist(), strict=True)))
    todo, out = [dict.fromkeys(e) for e in edges], []
    for d0 in range(4):
        while todo[d0]:
            begin = next(iter(todo[d0]))
            name, at, d, path = edges[d0][begin], begin, d0, []
            while True:
                del todo[d][at]
                at += step[d]
                turn = next(t % 4 for t in (d - 1, d, d + 1) if edges[t % 4].get(at) == name)
                if turn != d:
                    path.append((at // wide - 1, at % wide - 1))
                d = turn
                if at == begin and d == d0:
                    break
            out.append((name, path))
    return out


def _wkb(outer_and_holes: list[np.ndarray]) -> bytes:
    parts = [struct.pack("<BII", 1, 3, len(outer_and_holes))]
    for ring in outer_and_holes:
        closed = np.vstack([ring, ring[:1]])
        parts += [struct.pack("<I", len(closed)), closed.astype("<f8").tobytes()]
    return b"".join(parts)


def steep_pieces(cells: DataFrame, grid: Grid, most: float, vertical_factor: float = 1.0, side: int = SIDE) -> DataFrame:
    """(piece, cells, borders, geom): components of the steep cells of each tile, in the grid's own system.

    ``cells`` are (row, col, z), each once. Cells without elevation are never steep; beside them, and at the grid's edges,
    differences are one-sided. ``piece`` numbers the first cell, row by row: row * 2^32 + column. ``borders`` number the
    cell borders on the tile's rim that the piece reaches.
    """
    dx, dy, x0, y1 = grid.dx, grid.dy, grid.x0, grid.y1
    step_x, step_y = dx * grid.unit, dy * grid.unit

    def traced(tile: pd.DataFrame) -> pd.DataFrame:
        top, left = int(tile["tr"].iloc[0]) * side, int(tile["tc"].iloc[0]) * side
        z = np.full((side + 2, side + 2), np.nan)
        z[tile["row"].to_numpy() - top + 1, tile["col"].to_numpy() - left + 1] = tile["z"].to_numpy(dtype=float, na_value=np.nan) * vertical_factor
        here = z[1:-1, 1:-1]
        gx, gy = _change(z[1:-1, :-2], here, z[1:-1, 2:], step_x), _change(z[:-2, 1:-1], here, z[2:, 1:-1], step_y)
        labels, firsts = labelled(~np.isnan(here) & (100.0 * np.hypot(gx, gy) > most))
        n = len(firsts)
        if not n:
            return pd.DataFrame({"piece": pd.Series([], dtype="int64"), "cells": pd.Series([], dtype="int64"), "borders": pd.Series([], dtype=object), "geom": pd.Series([], dtype=object)})
        place = lambda r, c: ((r + top) << 32) + c + left
        own: list[list[np.ndarray]] = [[] for _ in range(n)]
        for name, corners in rings(labels):
            ij = np.array(corners, dtype=np.int64)
            turn = np.sum(ij[:, 1] * np.roll(ij[:, 0], -1) - np.roll(ij[:, 1], -1) * ij[:, 0])
            xy = np.column_stack([(ij[:, 1] + left) * dx + x0, y1 - (ij[:, 0] + top) * dy])
            own[name].insert(0, xy) if turn > 0 else own[name].append(xy)
        borders: list[list[int]] = [[] for _ in range(n)]
        k = np.arange(side)
        # a border is numbered by the cell above or on its left, the last bit tells which
        for rim, numbers in ((labels[:, -1], place(k, side - 1) * 2), (labels[:, 0], place(k, -1) * 2), (labels[-1], place(side - 1, k) * 2 + 1), (labels[0], place(-1, k) * 2 + 1)):
            for j in np.nonzero(rim >= 0)[0]:
                borders[rim[j]].append(int(numbers[j]))
        return pd.DataFrame({"piece": place(firsts // side, firsts % side), "cells": np.bincount(labels[labels >= 0], minlength=n), "borders": borders, "geom": [_wkb(o) for o in own]})

    near = lambda at: F.array_distinct(F.array(*[F.floor((F.col(at) + d) / side) for d in (0, -1, 1)]))
    rimmed = cells.select("row", "col", F.col("z").cast("double").alias("z"), F.explode(near("row")).alias("tr")).withColumn("tc", F.explode(near("col")))
    return rimmed.where("tr >= 0 AND tc >= 0").groupBy("tr", "tc").applyInPandas(traced, PIECES)


def components(edges: DataFrame) -> DataFrame:
    """(node, least): the least node that each node of the edges (a, b) reaches, by alternating large and small stars.

    Each round is written; the rounds grow with the logarithm of the nodes. A node's neighbours meet its least one by a
    join on the node, the aggregates are combined in the tasks first.
    """
    nodes = lambda e: e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    stars = cut(nodes(edges))
    seen = mark(stars)
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = cut(nodes(both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        stars = cut(nodes(small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select(F.col("u").alias("a"), F.col("m").alias("b")))))
        now = mark(stars)
        if now == seen:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("least"))
        seen = now


def whole(pieces: DataFrame) -> DataFrame:
    """(part, pieces, cells, geom): the pieces united across tiles; ``part`` is the first cell's number. A part is one row, however large."""
    pieces = cut(pieces)
    meet = pieces.select("piece", F.explode("borders").alias("border")).groupBy("border").agg(F.min("piece").alias("a"), F.max("piece").alias("b"))
    least = components(meet.where("a < b"))
    named = pieces.join(least, pieces["piece"] == least["node"], "left").select(F.coalesce("least", "piece").alias("part"), "cells", "geom")
    return named.groupBy("part").agg(F.count("*").alias("pieces"), F.sum("cells").alias("cells"), K.union_agg("geom").alias("geom"))


def steep_in_parcels(parcels: DataFrame, cells: DataFrame, grid: Grid, most: float, vertical_factor: float = 1.0, resample_m: float | None = None, margin: float = 30.0, cell: float = 500.0) -> DataFrame:
    """(account_id, geom): what ``window_steep`` gives, with shapes made once for all parcels whose windows don't matter.

    A window changes slopes only on its own rim, unless that is the grid's, and beside cells without elevation, which take
    the window's mean. Parcels that keep off both are answered by the pieces, the others by their windows; so are all of
    a grid that is averaged or in another system.
    """
    if resample_m or grid.numbers is not None:
        return window_steep(parcels, cells, grid, most, vertical_factor, resample_m, margin)
    w = windows(parcels, cells, grid, margin).drop("geom").join(parcels.select("account_id", "box"), "account_id")
    x = lambda c: F.col(c) * grid.dx + grid.x0
    y = lambda r: grid.y1 - F.col(r) * grid.dy
    off = lambda inside, edge: F.coalesce(inside | edge, F.lit(False))
    free = off(x("c0") + grid.dx <= F.col("box.minx"), F.col("c0") == 0) & off(x("c1") >= F.col("box.maxx"), F.col("c1") == F.col("c_max")) & off(y("r0") - grid.dy >= F.col("box.maxy"), F.col("r0") == 0) & off(y("r1") <= F.col("box.miny"), F.col("r1") == F.col("r_max"))
    w = w.withColumn("free", free)
    tiles = lambda a, b: F.explode(F.sequence(F.expr(f"{a} div {TILE}"), F.expr(f"{b} div {TILE}")))
    spread = w.where("free").select("account_id", "r0", "c0", "r1", "c1", tiles("r0", "r1").alias("tr")).select("*", tiles("c0", "c1").alias("tc"))
    none = cells.where("z IS NULL").select("row", "col", F.expr(f"row div {TILE}").alias("tr"), F.expr(f"col div {TILE}").alias("tc"))
    holed = spread.join(none, ["tr", "tc"]).where("row BETWEEN r0 AND r1 AND col BETWEEN c0 AND c1").select("account_id").distinct()
    plain = cut(w.where("free").select("account_id").join(holed, "account_id", "left_anti"))
    pieces = with_box(steep_pieces(cells, grid, most, vertical_factor).select("geom"))
    met = grid_join(subdivided(parcels.join(plain, "account_id", "left_semi").select("account_id", "geom", "box"), cell), subdivided(pieces, cell), cell, overlay=True)
    once = met.select("l.account_id", F.col("o.geom").alias("g")).groupBy("account_id").agg(K.union_agg("g").alias("geom")).where(K.area("geom") > 0)
    return once.unionByName(window_steep(parcels.join(plain, "account_id", "left_anti"), cells, grid, most, vertical_factor, None, margin))
