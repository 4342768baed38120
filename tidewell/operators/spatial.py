"""Points near other points, and points in regions."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import skew
from tidewell.session import cut

RADIUS_M = 6_371_000.0
#: Points a cell, about.
CELL = 20_000
#: The k-d splits come from a sample of about so many points for each cell, so it grows with the cells; every point is then placed.
PER_CELL = 50
#: A cell of more than DENSE * CELL points, which lie too close to be split, is searched in pairs of blocks of about CELL points.
DENSE = 3
LEAF = 32
#: Regions of up to so many corners in all go to every task; more of them are joined to the points by cells.
CORNERS = 200_000
#: Keys at one position are paired in blocks of about this many; a position of more than HOT keys has them numbered over several tasks.
BLOCK, HOT = 1_000, 100_000
#: Pairs in one batch of a search's output.
BATCH = 50_000


def unit_vectors(lng: np.ndarray, lat: np.ndarray) -> np.ndarray:
    a, b = np.radians(lng), np.radians(lat)
    return np.column_stack([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)])


def chord(metres: float) -> float:
    """Straight distance, on the unit sphere, of points so many metres apart along it."""
    return 2 * math.sin(min(metres / (2 * RADIUS_M), math.pi / 2))


def _splits(points: np.ndarray, cells: int, least: float) -> list[tuple]:
    """k-d splits as nodes (axis, value, left, right); a leaf is (-1, cell, 0, 0). Stops where a cell is hardly wider than the halo."""
    nodes: list[tuple] = []
    leaves = 0

    def build(p: np.ndarray, k: int) -> int:
        nonlocal leaves
        at = len(nodes)
        nodes.append(())
        wide = p.max(0) - p.min(0) if len(p) else np.zeros(3)
        axis = int(wide.argmax())
        if k <= 1 or len(p) < 2 or wide[axis] <= 4 * least:
            nodes[at] = (-1, leaves, 0, 0)
            leaves += 1
            return at
        v = float(np.median(p[:, axis]))
        low = p[:, axis] <= v
        if low.all() or not low.any():
            nodes[at] = (-1, leaves, 0, 0)
            leaves += 1
            return at
        left = build(p[low], k // 2)
        right = build(p[~low], k - k // 2)
        nodes[at] = (axis, v, left, right)
        return at

    build(points, cells)
    return nodes


def _place(nodes: list[tuple], p: np.ndarray, halo: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each cell that a point or its halo touches: the point's index, the cell, whether it is the point's own cell."""
    out = []
    todo = [(0, np.arange(len(p)), np.ones(len(p), bool))]
    while todo:
        k, i, home = todo.pop()
        axis, v, left, right = nodes[k]
        if axis < 0:
            out.append((i, np.full(len(i), v, np.int32), home))
            continue
        x = p[i, axis]
        for child, near, own in ((left, x <= v + halo, x <= v), (right, x > v - halo, x > v)):
            if near.any():
                todo.append((child, i[near], (home & own)[near]))
    return tuple(np.concatenate(a) for a in zip(*out)) if out else (np.empty(0, int), np.empty(0, np.int32), np.empty(0, bool))


def near_pairs(p: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i != j of rows of p at most radius apart, each once, from a k-d tree walked against itself. Leaves that can't be split are taken in blocks."""
    order = np.arange(len(p))
    nodes: list[list] = []  # [low, high, box min, box max, left, right]

    def build(low: int, high: int) -> int:
        at = len(nodes)
        q = p[order[low:high]]
        mn, mx = q.min(0), q.max(0)
        nodes.append([low, high, mn, mx, -1, -1])
        axis = int((mx - mn).argmax())
        if high - low > LEAF and mx[axis] > mn[axis]:
            mid = (high - low) // 2
            part = np.argpartition(q[:, axis], mid)
            order[low:high] = order[low:high][part]
            nodes[at][4] = build(low, low + mid)
            nodes[at][5] = build(low + mid, high)
        return at

    if len(p) < 2:
        return
    build(0, len(p))
    r2 = radius * radius
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        na, nb = nodes[a], nodes[b]
        if a != b:
            gap = np.maximum(0, np.maximum(na[2] - nb[3], nb[2] - na[3]))
            if float(gap @ gap) > r2 * (1 + 1e-9):
                continue
        leaf_a, leaf_b = na[4] < 0, nb[4] < 0
        if leaf_a and leaf_b:
            ia, ib = order[na[0] : na[1]], order[nb[0] : nb[1]]
            step = max(1, 4_000_000 // len(ib))
            for s in range(0, len(ia), step):
                block = ia[s : s + step]
                d = p[block][:, None, :] - p[ib][None, :, :]
                x, y = np.nonzero(np.einsum("ijk,ijk->ij", d, d) <= r2)
                i, j = block[x], ib[y]
                if a == b:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    yield i, j
        elif a == b:
            todo += [(na[4], na[4]), (na[5], na[5]), (na[4], na[5])]
        elif leaf_b or (not leaf_a and na[1] - na[0] >= nb[1] - nb[0]):
            todo += [(na[4], b), (na[5], b)]
        else:
            todo += [(a, nb[4]), (a, nb[5])]


def _tree(points: DataFrame, n: int, vectors, least: float) -> list[tuple]:
    """k-d splits of points (lng, lat) for cells of about CELL points; a hash of the position draws the sample."""
    cells = -(-n // CELL)
    if cells <= 1:
        return [(-1, 0, 0, 0)]
    step = max(1, n // (PER_CELL * cells))
    sample = points.where(F.pmod(F.xxhash64("lng", "lat"), F.lit(step)) == 0).select("lng", "lat").toPandas()
    return _splits(vectors(sample["lng"].to_numpy(), sample["lat"].to_numpy()), cells, least)


def _dense(points: DataFrame, n: int, nodes: list[tuple], vectors, halo: float) -> dict[int, int]:
    """Cell -> blocks, of the cells with more than DENSE * CELL points: at most n / (DENSE * CELL) of them and their halos."""
    if n <= DENSE * CELL:
        return {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, cell, _ = _place(nodes, vectors(*(b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))), halo)
            c, k = np.unique(cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(k, pa.int64())], ["cell", "k"])

    sizes = points.select("lng", "lat").mapInArrow(count, "cell int, k long").groupBy("cell").agg(F.sum("k").alias("k")).where(F.col("k") > DENSE * CELL)
    return {r.cell: -(-r.k // CELL) for r in sizes.collect()}


def near_places(points: DataFrame, key: str, lng: str, lat: str, metres: float) -> tuple[DataFrame, DataFrame]:
    """(near, members): near has rep_a, rep_b for each two positions at most so many metres apart on the sphere; members has
    rep, key, copies: the keys at each position, rep being the smallest of them and copies their number.

    Rows without key or position are left out. A key may have several positions. Copies of a position cost the search nothing. Empty in, empty out.

    Positions become unit vectors; k-d splits of a sample that grows with the cells cut
    space into cells, points within the chord radius of a cell are copied into it, and
    each cell is searched with its own k-d tree. A cell too dense to be split is searched in pairs of blocks. A pair is given by
    the cell of its first point. Results leave in batches, so a task holds one cell's (or pair of blocks') points only.
    """
    rows = points.select(F.col(key).cast("string").alias("key"), F.col(lng).cast("double").alias("lng"), F.col(lat).cast("double").alias("lat")).where("key is not null and lng is not null and lat is not null")
    rows = cut(rows.distinct().withColumn("at", F.concat_ws("/", F.col("lng").cast("string"), F.col("lat").cast("string"))), "points")
    places = cut(rows.groupBy("at").agg(F.min("key").alias("rep"), F.min("lng").alias("lng"), F.min("lat").alias("lat"), F.count(F.lit(1)).alias("copies")), "places")
    n, most = places.agg(F.count(F.lit(1)), F.coalesce(F.max("copies"), F.lit(0))).first()
    r = chord(metres)
    halo = r * (1 + 1e-6)
    nodes = _tree(places, n, unit_vectors, r)
    dense = _dense(places, n, nodes, unit_vectors, halo)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            i, cell, home = _place(nodes, unit_vectors(x, y), halo)
            own, low, high = (np.zeros(len(i), np.int32) for _ in range(3))
            if dense:
                blocks = np.array([dense.get(c, 1) for c in cell.tolist()], np.int64)
                block = (pd.util.hash_array(b.column(0).to_pandas().to_numpy(object))[i] % blocks.astype(np.uint64)).astype(np.int64)
                k = np.repeat(np.arange(len(i)), blocks)
                other = np.arange(len(k)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                i, cell, home, own = i[k], cell[k], home[k], block[k].astype(np.int32)
                low, high = (f(own, other).astype(np.int32) for f in (np.minimum, np.maximum))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i)), pa.array(x[i]), pa.array(y[i]), pa.array(cell), pa.array(low), pa.array(high), pa.array(own), pa.array(home)], ["rep", "lng", "lat", "cell", "low", "high", "own", "home"])

    def search(t: pa.Table) -> Iterator[pa.RecordBatch]:
        t = t.sort_by("rep")  # a pair's first point is that with the smaller index
        own, home = (t.column(c).to_numpy() for c in ("own", "home"))
        p, names = unit_vectors(t.column("lng").to_numpy(), t.column("lat").to_numpy()), t.column("rep").combine_chunks()
        across = t.column("low")[0] != t.column("high")[0]
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            i, j = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([names.take(pa.array(i)), names.take(pa.array(j))], ["rep_a", "rep_b"])

        for i, j in near_pairs(p, r):
            i, j = np.minimum(i, j), np.maximum(i, j)
            keep = home[i] & (own[i] != own[j]) if across else home[i]
            held.append((i[keep], j[keep]))
            size += len(held[-1][0])
            if size >= BATCH:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def search_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            ids = [b.column(c).to_numpy(zero_copy_only=False) for c in (3, 4, 5)]
            fresh = np.zeros(b.num_rows, bool)
            fresh[1:] = np.any([c[1:] != c[:-1] for c in ids], axis=0)
            begins = [0, *np.flatnonzero(fresh).tolist(), b.num_rows]
            for low, high in zip(begins, begins[1:]):
                if low == high:
                    continue
                now = tuple(int(c[low]) for c in ids)
                if held and now != last:
                    yield from search(pa.Table.from_batches(held))
                    held = []
                last = now
                held.append(b.slice(low, high - low))
        if held:
            yield from search(pa.Table.from_batches(held))

    group = ["cell", "low", "high"]
    placed = places.select("rep", "lng", "lat").mapInArrow(place, "rep string, lng double, lat double, cell int, low int, high int, own int, home boolean")
    near = placed.repartition(*group).sortWithinPartitions(*group).mapInArrow(search_cells, "rep_a string, rep_b string")
    whole = places.select("at", "rep", "copies")
    members = skew.balanced_join(rows, whole, skew.plan_load(rows, "at"), "key", "inner") if most > HOT else rows.join(whole, "at")
    return near, members.select("rep", "key", "copies")


def key_pairs(near: DataFrame, members: DataFrame) -> DataFrame:
    """(key_a, key_b): the pairs of keys, a < b as text, that near_places gives by class: of two near positions, and of one.

    Keys of one position are paired block by block, so no task holds a popular position's keys. One row a pair, pairs of a key with itself none.
    """
    side = lambda r, k: members.select(F.col("rep").alias(r), F.col("key").alias(k))
    apart = near.join(side("rep_a", "x"), "rep_a").join(side("rep_b", "y"), "rep_b").select("x", "y")
    blocks = F.ceil(F.col("copies") / BLOCK).cast("int")
    several = members.where("copies > 1").withColumn("own", F.pmod(F.xxhash64("key"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    several = several.select("rep", "key", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    left = several.where("own = low").select("rep", "low", "high", F.col("key").alias("x"))
    right = several.where("own = high").select("rep", "low", "high", F.col("key").alias("y"))
    together = left.join(right, ["rep", "low", "high"]).where("low <> high or x < y").select("x", "y")
    return apart.unionByName(together).where("x <> y").select(F.least("x", "y").alias("key_a"), F.greatest("x", "y").alias("key_b")).distinct()


def points_within(points: DataFrame, key: str, lng: str, lat: str, metres: float) -> DataFrame:
    """(key_a, key_b): every pair of keys, a < b as text, at most so many metres apart on the sphere; see near_places and key_pairs."""
    return key_pairs(*near_places(points, key, lng, lat, metres))


class _Sweep:
    """Plane sweep over polygon edges: between two neighbouring corner longitudes the set of edges that are crossed stays the same."""

    def __init__(self, edges: np.ndarray, owner: np.ndarray):
        # edges: x1, y1, x2, y2 with x1 < x2; upright edges are never crossed from below
        self.edges, self.owner = edges, owner
        self.stops = np.unique(np.concatenate([edges[:, 0], edges[:, 2]]))
        enter, leave = np.searchsorted(self.stops, edges[:, 0]), np.searchsorted(self.stops, edges[:, 2])
        self.first = np.argsort(enter, kind="stable")
        self.enter, self.leave = enter, leave

    def hits(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, owner) where the point lies inside. Points are taken by longitude, the active edges change on the way."""
        order = np.argsort(x, kind="stable")
        slab = np.searchsorted(self.stops, x[order], side="right") - 1
        points, owners = [], []
        active: list[int] = []
        next_edge = 0
        for s, low, high in zip(*_runs(slab)):
            if s < 0 or s >= len(self.stops) - 1:
                continue
            while next_edge < len(self.first) and self.enter[self.first[next_edge]] <= s:
                active.append(int(self.first[next_edge]))
                next_edge += 1
            active = [e for e in active if self.leave[e] > s]
            if not active:
                continue
            e = np.array(active)
            x1, y1, x2, y2 = self.edges[e].T
            own = self.owner[e]
            by = np.argsort(own, kind="stable")
            x1, y1, x2, y2, own = x1[by], y1[by], x2[by], y2[by], own[by]
            begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            i = order[low:high]
            step = max(1, 4_000_000 // len(e))
            for k in range(0, len(i), step):
                j = i[k : k + step]
                above = (y1 + (x[j][:, None] - x1) * ((y2 - y1) / (x2 - x1))) > y[j][:, None]
                inside = np.add.reduceat(above, begins, axis=1) % 2 == 1
                a, b = np.nonzero(inside)
                points.append(j[a])
                owners.append(own[begins[b]])
        if not points:
            return np.empty(0, int), np.empty(0, int)
        return np.concatenate(points), np.concatenate(owners)


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(a) == 0:
        return a, a, a
    begins = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    return a[begins], begins, np.append(begins[1:], len(a))


def _plane(lng: np.ndarray, lat: np.ndarray) -> np.ndarray:
    return np.column_stack([lng, lat, np.zeros(len(lng))])


def _touched(nodes: list[tuple], low: tuple[float, float], high: tuple[float, float]) -> list[int]:
    """The cells that a box has a part in."""
    out, todo = [], [0]
    while todo:
        axis, v, left, right = nodes[todo.pop()]
        if axis < 0:
            out.append(v)
            continue
        if low[axis] <= v:
            todo.append(left)
        if high[axis] > v:
            todo.append(right)
    return out


def _edges(rings: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges, the number of the ring of each, and the rings' names, of (name, lngs, lats); upright edges count for nothing."""
    edges, owner = [], []
    for k, (_, xs, ys) in enumerate(rings):
        for i in range(len(xs)):
            a, b = (xs[i], ys[i]), (xs[(i + 1) % len(xs)], ys[(i + 1) % len(xs)])
            if a[0] != b[0]:
                edges.append((*min(a, b), *max(a, b)))
                owner.append(k)
    return np.array(edges, float).reshape(-1, 4), np.array(owner, int), np.array([r[0] for r in rings], object)


def points_in_regions(points: DataFrame, key: str, lng: str, lat: str, regions: DataFrame, region: str, ring_lng: str, ring_lat: str) -> DataFrame:
    """(key, region): every region whose simple polygon holds the point; polygons may be concave and overlap.

    Rows without key or position are left out, rings of fewer than three corners hold
    nothing; a ring may be closed or not. Rows of points that repeat give one row.
    Regions of up to CORNERS corners in all go to every task and are swept in one pass over the points. Beyond that points and
    regions meet by k-d cell, a region in each cell that its box touches, and each cell is swept by itself; the points of a cell that can't be
    split, as they lie at one place, are taken in blocks.
    """
    rows = points.select(F.col(key).cast("string").alias("key"), F.col(lng).cast("double").alias("lng"), F.col(lat).cast("double").alias("lat")).where("key is not null and lng is not null and lat is not null")
    rings = regions.select(F.col(region).cast("string").alias("r"), F.col(ring_lng).alias("x"), F.col(ring_lat).alias("y")).where("r is not null and size(x) >= 3 and size(x) = size(y)")
    corners = rings.agg(F.coalesce(F.sum(F.size("x")), F.lit(0))).first()[0]
    if corners <= CORNERS:
        e, o, label = _edges([tuple(r) for r in rings.collect()])

        def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            s = _Sweep(e, o)
            for b in batches:
                i, k = s.hits(*(b.column(c).to_numpy(zero_copy_only=False) for c in (1, 2)))
                if len(i):
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i)), pa.array(label[k], pa.string())], ["key", "region"])

        return rows.mapInArrow(sweep, "key string, region string").distinct()
    rows = cut(rows, "points")
    n = rows.count()
    nodes = _tree(rows, n, _plane, 0.0)
    dense = _dense(rows, n, nodes, _plane, 0.0)

    def place_points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            i, cell, _ = _place(nodes, _plane(b["lng"].to_numpy(), b["lat"].to_numpy()), 0.0)
            blocks = np.array([dense.get(c, 1) for c in cell.tolist()], np.uint64)
            out = b.iloc[i]
            yield out.assign(cell=cell, block=(pd.util.hash_array(out["key"].to_numpy(object)) % blocks).astype(np.int32))

    def place_regions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = [(k, c, d) for k, (x, y) in enumerate(zip(b["x"], b["y"])) for c in _touched(nodes, (min(x), min(y)), (max(x), max(y))) for d in range(dense.get(c, 1))]
            k, cell, block = (list(v) for v in zip(*at)) if at else ([], [], [])
            yield b.iloc[k].assign(cell=np.array(cell, np.int32), block=np.array(block, np.int32))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        e, o, label = _edges(list(zip(right["r"], right["x"], right["y"])))
        if not len(e) or not len(left):
            return pd.DataFrame({"key": [], "region": []}, dtype=str)
        i, k = _Sweep(e, o).hits(left["lng"].to_numpy(), left["lat"].to_numpy())
        return pd.DataFrame({"key": left["key"].to_numpy()[i], "region": label[k]})

    by = lambda df: df.groupBy("cell", "block")
    left = by(rows.mapInPandas(place_points, "key string, lng double, lat double, cell int, block int"))
    right = by(rings.mapInPandas(place_regions, "r string, x array<double>, y array<double>, cell int, block int"))
    return left.cogroup(right).applyInPandas(meet, "key string, region string").distinct()
