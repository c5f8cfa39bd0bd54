"""Points near other points, and the region that contains a point (problem 1).

Method: a dual-tree join. Points stand in a quadtree over the globe whose nodes hold their count and
their box in space. Pairs of nodes are compared from the top: those whose boxes are too far apart are
discarded, those that are certainly near are accepted whole (their descendants are paired without
any further test), and the rest is opened one level further. Pairs of leaves that are still
uncertain are refined point by point in distributed tasks. Regions are walked down the same tree:
nodes outside are discarded, nodes inside accepted whole at the level they are found, and nodes on a
border are opened until few edges touch them.

A leaf holds about `leaf` points. Where more points than that share a node of the last level, the
node is cut into chunks by a hash, so that no task gets an unbounded group; nothing is dropped.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions.rows import once
from cedarloom.io import cut

EARTH_KM = 6371.0088
TOP, LAST, STEP = 12, 22, 2


def _cell(level: int) -> tuple[str, str]:
    n = f"{2**level}D"
    return f"cast(pmod(floor((lon + 180) / 180 * {n}), {2 ** (level + 1)}) as int)", f"cast(least(floor((lat + 90) / 180 * {n}), {2**level - 1}) as int)"


def with_space(df: DataFrame) -> DataFrame:
    """(id, lat, lon) with metres in space and the cell of the last level."""
    r = EARTH_KM * 1000
    x, y = _cell(LAST)
    return df.selectExpr(
        "id", "lat", "lon",
        f"{r} * cos(radians(lat)) * cos(radians(lon)) as px", f"{r} * cos(radians(lat)) * sin(radians(lon)) as py", f"{r} * sin(radians(lat)) as pz",
        f"{x} as cx", f"{y} as cy",
    )


_BOX = [f"{k}{a}" for a in "xyz" for k in ("lo", "hi")]
_NODE = ["lv", "nx", "ny", "n", "leaf", *_BOX]


class Tree:
    """The quadtree of points (id, lat, lon). nodes: (lv, nx, ny, n, leaf, box); points: the points
    with their cell (cx, cy), their leaf (lv, nx, ny) and chunk of k."""

    def __init__(self, points: DataFrame, leaf: int = 128):
        self.leaf = leaf
        pts = with_space(points)
        box = [f"{'min' if k == 'lo' else 'max'}(p{a}) as {k}{a}" for a in "xyz" for k in ("lo", "hi")]
        roll = [F.expr(f"{'min' if c[:2] == 'lo' else 'max'}({c})").alias(c) for c in _BOX]
        cells = cut(pts.groupBy("cx", "cy").agg(F.count("*").alias("n"), *[F.expr(b) for b in box]), "cells")
        up = "explode(sequence(0, {}, {})) as up".format(LAST - TOP, STEP)
        every = cells.selectExpr("cx", "cy", "n", *_BOX, up).selectExpr(f"{LAST} - up as lv", "shiftright(cx, up) as nx", "shiftright(cy, up) as ny", "n", *_BOX)
        every = every.groupBy("lv", "nx", "ny").agg(F.sum("n").alias("n"), *roll)
        # a node lives if its parent is too full to be a leaf
        every = cut(every.withColumn("leaf", F.expr(f"n <= {leaf} or lv = {LAST}")), "nodes")
        full = every.where("not leaf").selectExpr(f"lv + {STEP} as lv", "nx as ux", "ny as uy")
        kids = every.withColumns({"ux": F.expr(f"shiftright(nx, {STEP})"), "uy": F.expr(f"shiftright(ny, {STEP})")})
        kids = kids.where(f"lv > {TOP}").join(full, ["lv", "ux", "uy"], "left_semi")
        self.nodes = cut(every.where(f"lv = {TOP}").select(*_NODE).unionByName(kids.select(*_NODE)), "live")
        self.points = self._placed(pts, cells)

    def _placed(self, pts: DataFrame, cells: DataFrame) -> DataFrame:
        """Each point with its leaf. Cells that hold over a thousandth of all points are fewer than
        a thousand: their leaves are broadcast, so that no join key is hot."""
        up = f"explode(sequence(0, {LAST - TOP}, {STEP})) as up"
        leaves = self.nodes.where("leaf").select("lv", "nx", "ny", F.col("n").alias("node_n"))
        at = cells.selectExpr("cx", "cy", "n", up).selectExpr("cx", "cy", "n", f"{LAST} - up as lv", "shiftright(cx, up) as nx", "shiftright(cy, up) as ny")
        at = at.join(leaves, ["lv", "nx", "ny"]).selectExpr("cx", "cy", "n", "lv", "nx", "ny", f"cast(ceil(node_n / {self.leaf}D) as int) as k")
        at = cut(at, "leaf-of-cell")
        total = at.agg(F.sum("n")).first()[0] or 0
        hot = F.broadcast(at.where(f"n > {max(total, 1000)} / 1000").drop("n"))
        key = ["cx", "cy"]
        a = pts.join(hot, key)
        b = pts.join(hot.select(*key), key, "left_anti").join(at.where(f"n <= {max(total, 1000)} / 1000").drop("n"), key)
        chunk = "pmod(xxhash64(id), k) as chunk"
        return a.unionByName(b).selectExpr("id", "lat", "lon", "px", "py", "pz", "cx", "cy", "lv", "nx", "ny", "k", chunk)


def _gap(lo: bool) -> str:
    """Square of the least (lo) or largest distance in space between boxes a and b."""
    if lo:
        each = [f"greatest(0D, a_lo{c} - b_hi{c}, b_lo{c} - a_hi{c})" for c in "xyz"]
    else:
        each = [f"greatest(a_hi{c} - b_lo{c}, b_hi{c} - a_lo{c})" for c in "xyz"]
    return " + ".join(f"pow({e}, 2)" for e in each)


def _start_level(nodes: DataFrame, metres: float) -> int:
    """The finest level, TOP at most, at which points that near stand in the same or neighbouring
    nodes; 0 where they may be on either side of a pole."""
    r = EARTH_KM * 1000
    z = nodes.agg(F.max(F.expr("greatest(abs(loz), abs(hiz))"))).first()[0] or 0.0
    lat, angle = math.asin(min(1.0, z / r)), metres / r
    if angle >= math.pi / 2 or math.sin(angle) >= math.cos(lat):
        return 0
    wide = max(math.degrees(angle), math.degrees(math.asin(math.sin(angle) / math.cos(lat)))) * (1 + 1e-9)
    return max([0, *(lv for lv in range(TOP % STEP, TOP + 1, STEP) if 180 / 2**lv >= wide)])


def pairs_within(tree: Tree, metres: float) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of all points less than `metres` apart on the sphere.

    The chord is compared, which is the same test as the haversine distance. Points at one place
    are pairs too. No points: no rows. Any distance and latitude: the walk starts at the finest
    level at which only neighbouring nodes can hold such pairs, at the root if need be."""
    r = EARTH_KM * 1000
    chord2 = (2 * r * math.sin(min(metres / (2 * r), math.pi / 2))) ** 2
    side = lambda p: [F.col(c).alias(f"{p}_{c}") for c in _NODE]
    sides = [f"{p}_{c}" for p in "ab" for c in _NODE]
    nodes = tree.nodes
    start = _start_level(nodes.where(f"lv = {TOP}"), metres)
    roll = [F.expr(f"{'min' if c[:2] == 'lo' else 'max'}({c})").alias(c) for c in _BOX]
    for lv in range(TOP - STEP, start - 1, -STEP):
        over = nodes.where(f"lv = {lv + STEP}").groupBy(F.expr(f"shiftright(nx, {STEP})").alias("nx"), F.expr(f"shiftright(ny, {STEP})").alias("ny")).agg(F.sum("n").alias("n"), *roll)
        nodes = nodes.unionByName(cut(over.selectExpr(f"{lv} as lv", "nx", "ny", "n", "false as leaf", *_BOX), "over"))
    top, wide = nodes.where(f"lv = {start}"), 2 ** (start + 1)
    if start:
        around = top.select(*side("a"), F.expr("explode(array(struct(0 as dx, 0 as dy), struct(1 as dx, 0 as dy), struct(-1 as dx, 1 as dy), struct(0 as dx, 1 as dy), struct(1 as dx, 1 as dy))) as o"))
        around = around.withColumns({"b_nx": F.expr(f"pmod(a_nx + o.dx, {wide})"), "b_ny": F.expr("a_ny + o.dy")})
        front = around.join(top.select(*side("b")), ["b_nx", "b_ny"])
    else:  # the root has two nodes, one for each half of the globe
        front = top.select(*side("a")).withColumn("b_nx", F.expr("explode(sequence(a_nx, 1))")).join(top.select(*side("b")), "b_nx")

    def judged(f: DataFrame) -> DataFrame:
        f = f.where(f"sure or {_gap(True)} <= {chord2}")
        return f.withColumn("sure", F.expr(f"sure or {_gap(False)} < {chord2}"))

    front = cut(judged(front.withColumn("sure", F.lit(False)).select("sure", *sides)), "front")
    done, kids = front.where("a_leaf and b_leaf"), nodes.where(f"lv > {start}")
    for _ in range(start, LAST, STEP):
        rest = front.where("not (a_leaf and b_leaf)")
        if rest.isEmpty():
            break
        rest = rest.withColumn("same", F.expr("a_lv = b_lv and a_nx = b_nx and a_ny = b_ny"))
        for p in "ab":
            own = [c for c in rest.columns if not c.startswith(f"{p}_")]
            up = {f"{p}_lv": f"lv - {STEP}", f"{p}_nx": f"shiftright(nx, {STEP})", f"{p}_ny": f"shiftright(ny, {STEP})"}
            child = kids.selectExpr(*[f"{v} as {k}" for k, v in up.items()], *[f"{c} as _{c}" for c in _NODE])
            opened = rest.where(f"not {p}_leaf").join(child, list(up)).select(*own, *[F.col(f"_{c}").alias(f"{p}_{c}") for c in _NODE])
            rest = rest.where(f"{p}_leaf").select(*own, *[f"{p}_{c}" for c in _NODE]).unionByName(opened)
        rest = rest.where("not same or a_ny < b_ny or (a_ny = b_ny and a_nx <= b_nx)")
        front = cut(judged(rest).select("sure", *sides), "front")
        done = done.unionByName(front.where("a_leaf and b_leaf"))
    key = lambda p: [f"{p}_lv", f"{p}_nx", f"{p}_ny"]
    pair = done.selectExpr("sure", *key("a"), *key("b"), *[f"explode(sequence(0L, cast(ceil(a_n / {tree.leaf}D) as bigint) - 1)) as a_chunk"], "b_n")
    pair = pair.selectExpr("*", f"explode(sequence(0L, cast(ceil(b_n / {tree.leaf}D) as bigint) - 1)) as b_chunk")
    pair = pair.withColumn("same", F.expr("a_lv = b_lv and a_nx = b_nx and a_ny = b_ny")).where("not same or a_chunk <= b_chunk").withColumn("same", F.expr("same and a_chunk = b_chunk"))
    pts = lambda p: tree.points.selectExpr(f"lv as {p}_lv", f"nx as {p}_nx", f"ny as {p}_ny", f"chunk as {p}_chunk", f"id as {p}_id", f"px as {p}x", f"py as {p}y", f"pz as {p}z")
    left = pair.drop("b_n").join(pts("a"), [*key("a"), "a_chunk"]).select("sure", "same", *key("b"), "b_chunk", "a_id", "ax", "ay", "az")
    near = f"(sure or pow(ax - bx, 2) + pow(ay - by, 2) + pow(az - bz, 2) < {chord2}) and (not same or a_id < b_id)"
    return left.join(pts("b"), [*key("b"), "b_chunk"]).where(near).selectExpr("least(a_id, b_id) as id_a", "greatest(a_id, b_id) as id_b")


def _edges(geometry: str | None) -> list[tuple[float, float, float, float]]:
    """Edges (x1, y1, x2, y2) of all rings of a GeoJSON polygon or multipolygon."""
    try:
        g = json.loads(geometry or "")
        polygons = {"Polygon": lambda c: [c], "MultiPolygon": lambda c: c}[g["type"]](g["coordinates"])
        return [(a[0], a[1], b[0], b[1]) for p in polygons for ring in p for a, b in zip(ring, [*ring[1:], ring[0]], strict=True) if a[:2] != b[:2]]
    except (ValueError, KeyError, TypeError, IndexError):
        return []


def _touches(e: tuple, x0: float, y0: float, x1: float, y1: float) -> bool:
    ax, ay, bx, by = e
    if max(ax, bx) < x0 or min(ax, bx) > x1 or max(ay, by) < y0 or min(ay, by) > y1:
        return False
    side = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x, y in ((x0, y0), (x1, y0), (x0, y1), (x1, y1))]
    return min(side) <= 0 <= max(side)


def _inside(edges: list, x: float, y: float) -> bool:
    return sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for ax, ay, bx, by in edges) % 2 == 1


def _walk(edges: list, most: int = 8) -> Iterator[tuple[int, int, int, bool, list[float]]]:
    """Nodes that a region touches: (level, nx, ny, whether the middle is inside, the edges that
    touch the node). Walked down from the whole globe; a node inside is given at its own level, one
    on the border from the top level of the tree on, and opened further while more than `most` edges
    touch it, to two levels above the last."""
    todo = [(0, 0, 0, edges), (0, 1, 0, edges)]
    while todo:
        lv, nx, ny, own = todo.pop()
        size = 180 / 2**lv
        x0, y0 = nx * size - 180, ny * size - 90
        own = [e for e in own if _touches(e, x0, y0, x0 + size, y0 + size)]
        if not own:
            if _inside(edges, x0 + size / 2, y0 + size / 2):
                yield lv, nx, ny, True, []
        elif lv >= TOP and (len(own) <= most or lv >= LAST - 2):
            yield lv, nx, ny, _inside(edges, x0 + size / 2, y0 + size / 2), [v for e in own for v in e]
        else:
            todo += [(lv + 1, 2 * nx + i, 2 * ny + j, own) for i in (0, 1) for j in (0, 1)]


def region_nodes(regions: DataFrame) -> DataFrame:
    """(region_id, rlv, rx, ry, mid, edges) of regions (region_id, geometry)."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["region_id", "rlv", "rx", "ry", "mid", "edges"]
        for batch in batches:
            for r in batch.itertuples(index=False):
                nodes = _walk(_edges(r.geometry))
                while rows := [(r.region_id, *node) for node in islice(nodes, 10_000)]:
                    yield pd.DataFrame(rows, columns=names)

    return regions.select("region_id", "geometry").mapInPandas(walk, "region_id bigint, rlv int, rx int, ry int, mid boolean, edges array<double>")


def points_in_regions(tree: Tree, regions: DataFrame) -> DataFrame:
    """(id, region_id) of each point and each region that contains it (even-odd rule, holes out).

    Null or unreadable geometries contain nothing. In a node without edges all points are accepted
    whole; in others the way from the point to the middle of the node is checked against the edges
    that touch the node. A leaf meets the nodes of regions above it, itself, and below it."""
    chunks = f"explode(sequence(0L, cast(ceil(n / {tree.leaf}D) as bigint) - 1)) as chunk"
    leaves, found = tree.nodes.where("leaf").select("lv", "nx", "ny", "n"), cut(region_nodes(regions), "regions")
    above = leaves.selectExpr("*", "explode(sequence(0, lv)) as up").selectExpr("lv", "nx", "ny", "n", "lv - up as rlv", "shiftright(nx, up) as rx", "shiftright(ny, up) as ry").join(found, ["rlv", "rx", "ry"])
    below = found.where(f"rlv > {TOP}").selectExpr("*", f"explode(sequence({TOP}, rlv - 1, {STEP})) as lv").selectExpr("*", "shiftright(rx, rlv - lv) as nx", "shiftright(ry, rlv - lv) as ny")
    hit = above.unionByName(below.join(leaves, ["lv", "nx", "ny"])).selectExpr("region_id", "rlv", "rx", "ry", "mid", "edges", "lv", "nx", "ny", chunks)
    at = tree.points.select("id", "lat", "lon", "cx", "cy", "lv", "nx", "ny", "chunk").join(hit, ["lv", "nx", "ny", "chunk"])
    at = at.where(f"shiftright(cx, {LAST} - rlv) = rx and shiftright(cy, {LAST} - rlv) = ry")
    at = at.selectExpr("id", "region_id", "lat", "lon", "mid", "edges", "(rx + 0.5D) * 180 / shiftleft(1, rlv) - 180 as qx", "(ry + 0.5D) * 180 / shiftleft(1, rlv) - 90 as qy")
    # an edge (a, b) and the way (p, q) cross if each has its ends on both sides of the other
    e = [f"edges[4 * i + {k}]" for k in range(4)]
    side = lambda x, y: f"(qx - lon) * ({y} - lat) - (qy - lat) * ({x} - lon) >= 0"
    of = lambda x, y: f"({e[2]} - {e[0]}) * ({y} - {e[1]}) - ({e[3]} - {e[1]}) * ({x} - {e[0]}) >= 0"
    cross = f"(({side(e[0], e[1])}) != ({side(e[2], e[3])})) and (({of('lon', 'lat')}) != ({of('qx', 'qy')}))"
    count = f"case when size(edges) = 0 then 0 else size(filter(sequence(0, size(edges) div 4 - 1), i -> {cross})) end"
    return at.where(f"mid != (({count}) % 2 = 1)").select("id", "region_id")


def stated_points(assets: DataFrame, box: tuple | None, key: str = "asset_id") -> DataFrame:
    """(id, lat, lon) of rows that state a place in latitude and longitude, location or geometry,
    in this order. Rows that state none are left out; see functions.places for the notations."""
    from cedarloom.functions import places as P

    own = assets.selectExpr(f"{key} as id", "latitude", "longitude", "location", "geometry")
    own = once(own, p1=f"struct({P.angle('latitude')} as lat, {P.angle('longitude')} as lon)", p2=P.place("location"), p3=P.geojson_place("geometry"))
    p = once(own.drop("latitude", "longitude", "location", "geometry"), p=f"coalesce({', '.join(P.settle(p, box) for p in ('p1', 'p2', 'p3'))})")
    return p.where("p is not null").selectExpr("id", "p.lat as lat", "p.lon as lon")
