"""Shapefiles, read from their published binary layout, to GeoJSON geometries and attributes."""

from __future__ import annotations

import json
import math
import os
import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cedarloom.functions.names import column_name

_KINDS = {1: "Point", 3: "MultiLineString", 5: "Polygon", 8: "MultiPoint"}


def _area(ring: list) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)) / 2


def shapes(raw: bytes) -> list[dict | None]:
    """The geometries of a .shp file; None for null shapes. Z and M values are left out."""
    out, at = [], 100
    while at + 8 <= len(raw):
        length = struct.unpack(">i", raw[at + 4 : at + 8])[0] * 2
        rec, at = raw[at + 8 : at + 8 + length], at + 8 + length
        kind = _KINDS.get(struct.unpack("<i", rec[:4])[0] % 10)
        if kind == "Point":
            out.append({"type": "Point", "coordinates": list(struct.unpack("<2d", rec[4:20]))})
        elif kind == "MultiPoint":
            n = struct.unpack("<i", rec[36:40])[0]
            v = struct.unpack(f"<{2 * n}d", rec[40 : 40 + 16 * n])
            out.append({"type": kind, "coordinates": [list(p) for p in zip(v[::2], v[1::2], strict=True)]})
        elif kind:
            parts, n = struct.unpack("<2i", rec[36:44])
            starts = [*struct.unpack(f"<{parts}i", rec[44 : 44 + 4 * parts]), n]
            v = struct.unpack(f"<{2 * n}d", rec[44 + 4 * parts : 44 + 4 * parts + 16 * n])
            pts = [list(p) for p in zip(v[::2], v[1::2], strict=True)]
            rings = [pts[a:b] for a, b in zip(starts, starts[1:], strict=False)]
            if kind == "Polygon":
                groups: list = []
                for r in rings:  # outer rings run clockwise, holes follow theirs
                    groups.append([r]) if _area(r) <= 0 or not groups else groups[-1].append(r)
                out.append({"type": "Polygon", "coordinates": groups[0]} if len(groups) == 1 else {"type": "MultiPolygon", "coordinates": groups})
            else:
                out.append({"type": "LineString", "coordinates": rings[0]} if len(rings) == 1 else {"type": kind, "coordinates": rings})
        else:
            out.append(None)
    return out


def attributes(raw: bytes, encoding: str = "utf-8") -> list[dict]:
    """The rows of a .dbf file; deleted rows are None's place and kept as empty."""
    n, head, size = struct.unpack("<IHH", raw[4:12])
    fields, at = [], 32
    while raw[at] != 0x0D:
        name, kind, width = raw[at : at + 11].split(b"\0")[0].decode("ascii", "replace"), chr(raw[at + 11]), raw[at + 16]
        fields.append((column_name(name), kind, width))
        at += 32
    rows = []
    for i in range(n):
        rec, pos, row = raw[head + i * size : head + (i + 1) * size], 1, {}
        for name, kind, width in fields:
            v = rec[pos : pos + width].decode(encoding, "replace").strip(" \0")
            pos += width
            if kind == "D" and len(v) == 8:
                v = f"{v[:4]}-{v[4:6]}-{v[6:]}"
            row[name] = None if v in ("", "?") or set(v) == {"*"} else v
        rows.append(row)
    return rows


def positions(g: dict | None) -> list:
    if not g:
        return []
    c, flat = [g["coordinates"]], []
    while c:
        x = c.pop()
        if x and isinstance(x[0], (int, float)):
            flat.append(x)
        else:
            c += x
    return flat


def centroid(g: dict | None) -> tuple[float | None, float | None]:
    """(lat, lon): of polygons by area, holes taken off; of other shapes the mean of the positions."""
    if not g or not positions(g):
        return None, None
    if g["type"] in ("Polygon", "MultiPolygon"):
        a = x = y = 0.0
        for poly in [g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]:
            for k, ring in enumerate(poly):
                sign = 1 if (_area(ring) > 0) == (k == 0) else -1
                for (x1, y1, *_), (x2, y2, *_) in zip(ring, [*ring[1:], ring[0]], strict=True):
                    d = (x1 * y2 - x2 * y1) * sign
                    a, x, y = a + d, x + (x1 + x2) * d, y + (y1 + y2) * d
        if a:
            return y / (3 * a), x / (3 * a)
    p = positions(g)
    return sum(v[1] for v in p) / len(p), sum(v[0] for v in p) / len(p)


def from_utm(east: float, north: float, zone: int, south: bool = False) -> tuple[float, float]:
    """(lon, lat) on WGS84 of UTM metres, by the usual series."""
    return _inverse_mercator(east - 500000, north - (10_000_000 if south else 0), zone * 6 - 183, 0.9996)


def from_mtm(east: float, north: float, meridian: float = -79.5) -> tuple[float, float]:
    """(lon, lat) of metres in a three-degree zone (the default is zone 10)."""
    return _inverse_mercator(east - 304800, north, meridian, 0.9999)


def _inverse_mercator(x: float, y: float, meridian: float, k0: float) -> tuple[float, float]:
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    ep2, m = e2 / (1 - e2), y / k0
    mu = m / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * math.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * math.sin(4 * mu) + 151 * e1**3 / 96 * math.sin(6 * mu)
    s, c, t = math.sin(p), math.cos(p), math.tan(p) ** 2
    n, r = a / math.sqrt(1 - e2 * s * s), a * (1 - e2) / (1 - e2 * s * s) ** 1.5
    cc, d = ep2 * c * c, x / (n * k0)
    lat = p - n * math.tan(p) / r * (d**2 / 2 - (5 + 3 * t + 10 * cc - 4 * cc**2 - 9 * ep2) * d**4 / 24 + (61 + 90 * t + 298 * cc + 45 * t**2 - 252 * ep2 - 3 * cc**2) * d**6 / 720)
    lon = (d - (1 + 2 * t + cc) * d**3 / 6 + (5 - 2 * cc + 28 * t - 3 * cc**2 + 8 * ep2 + 24 * t**2) * d**5 / 120) / c
    return meridian + math.degrees(lon), math.degrees(lat)


def read_shp(spark: SparkSession, path: str, project=None) -> DataFrame:
    """(position, fields MAP, geometry GeoJSON, geometry_type, centroid_lat, centroid_lon). `project`
    maps (x, y) to (lon, lat). Each file is read by one task; its .dbf lies beside it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    own = files.load(path) if os.path.isdir(path) else files.load(path.rsplit(".", 1)[0] + ".*")
    both = own.where("lower(path) rlike '[.](shp|dbf)$'").withColumn("base", F.expr("regexp_replace(path, '[.][^.]*$', '')"))
    pairs = both.groupBy("base").agg(F.max(F.expr("case when lower(path) like '%.shp' then content end")).alias("shp"), F.max(F.expr("case when lower(path) like '%.dbf' then content end")).alias("dbf")).where("shp is not null")

    def move(v):
        return list(project(*v[:2])) if v and isinstance(v[0], (int, float)) else [move(x) for x in v]

    def parse(batches):
        for b in batches:
            rows = []
            for shp, dbf in zip(b["shp"], b["dbf"], strict=True):
                geo = shapes(bytes(shp))
                att = attributes(bytes(dbf)) if dbf is not None else [{}] * len(geo)
                for i, (g, a) in enumerate(zip(geo, att, strict=False)):
                    if g and project:
                        g = g | {"coordinates": move(g["coordinates"])}
                    rows.append((i, a, json.dumps(g) if g else None, g and g["type"], *centroid(g)))
            if rows:
                yield pd.DataFrame(rows, columns=["position", "fields", "geometry", "geometry_type", "centroid_lat", "centroid_lon"])

    return pairs.mapInPandas(parse, "position int, fields map<string,string>, geometry string, geometry_type string, centroid_lat double, centroid_lon double")


def geojson_features(df: DataFrame) -> DataFrame:
    """(value): a GeoJSON feature a row, of what read_shp gives."""
    return df.selectExpr("to_json(struct('Feature' as type, fields as properties, parse_json(geometry) as geometry)) as value")
