import json
import math
import random

import pytest

from cedarloom.operators.nearby import Tree, pairs_within, points_in_regions, stated_points

BOX = (43.0, 45.7, -83.0, -78.0)


def metres(a, b):
    p = [math.radians(v) for v in (*a, *b)]
    h = math.sin((p[2] - p[0]) / 2) ** 2 + math.cos(p[0]) * math.cos(p[2]) * math.sin((p[3] - p[1]) / 2) ** 2
    return 2 * 6371008.8 * math.asin(math.sqrt(h))


def test_pairs_against_brute_force(spark):
    random.seed(3)
    pts = [(i, 44 + random.gauss(0, 0.0006), -80 + random.gauss(0, 0.0006)) for i in range(500)]
    pts += [(500 + i, 45.0, -79.0) for i in range(40)] + [(600 + i, 43 + random.random(), -82 + random.random()) for i in range(60)]
    tree = Tree(spark.createDataFrame(pts, "id bigint, lat double, lon double"), leaf=8)
    got = [(r[0], r[1]) for r in pairs_within(tree, 30.0).collect()]
    want = {(a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1 :] if metres(a[1:], b[1:]) < 30}
    assert len(got) == len(set(got)) and set(got) == want


def test_regions_with_holes(spark):
    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    regions = [
        (1, json.dumps({"type": "Polygon", "coordinates": [square(-80, 44, 0.4), square(-79.9, 44.1, 0.1)]})),
        (2, json.dumps({"type": "MultiPolygon", "coordinates": [[square(-79, 44, 0.1)], [square(-78.5, 44, 0.1)]]})),
        (3, None),
        (4, "not json"),
    ]
    pts = [(1, 44.05, -79.95), (2, 44.15, -79.85), (3, 44.05, -78.95), (4, 44.05, -78.45), (5, 44.05, -78.7), (6, 44.39, -79.61)]
    tree = Tree(spark.createDataFrame(pts, "id bigint, lat double, lon double"))
    got = {(r[0], r[1]) for r in points_in_regions(tree, spark.createDataFrame(regions, "region_id bigint, geometry string")).collect()}
    assert got == {(1, 1), (3, 2), (4, 2), (6, 1)}


@pytest.mark.parametrize(
    "row,want",
    [
        (("43.5", "-79.5", None, None), (43.5, -79.5)),
        (("43,5", "-79,5", None, None), (43.5, -79.5)),
        (("-79.5", "43.5", None, None), (43.5, -79.5)),
        (("43.5", "79.5", None, None), (43.5, -79.5)),
        (("43°30'00.0\"N", "79°30'00.0\"W", None, None), (43.5, -79.5)),
        (("43 30 00.0 N", "79 30 00.0 W", None, None), (43.5, -79.5)),
        (("43.5", None, "POINT (-79.5 43.5)", None), (43.5, -79.5)),
        ((None, None, "(43.5, -79.5)", None), (43.5, -79.5)),
        ((None, None, "lat=43.5; lon=-79.5", None), (43.5, -79.5)),
        ((None, None, '{"lat": 43.5, "lon": -79.5}', None), (43.5, -79.5)),
        ((None, None, "N/A", '{"type": "MultiPoint", "coordinates": [[-79.5, 43.5]]}'), (43.5, -79.5)),
        (("0", "0", None, None), None),
        (("999", "-999", None, None), None),
        (("43.5", None, None, None), None),
        (("x", "x", "", '{"type":"Point","coordinates":[]}'), None),
        ((None, None, None, None), None),
    ],
)
def test_notations(spark, row, want):
    df = spark.createDataFrame([(1, *row)], "asset_id bigint, latitude string, longitude string, location string, geometry string")
    got = stated_points(df, BOX).collect()
    assert [(round(r["lat"], 6), round(r["lon"], 6)) for r in got] == ([want] if want else [])


def test_empty(spark):
    tree = Tree(spark.createDataFrame([], "id bigint, lat double, lon double"))
    assert pairs_within(tree, 30.0).count() == 0
    assert points_in_regions(tree, spark.createDataFrame([], "region_id bigint, geometry string")).count() == 0


@pytest.mark.parametrize("lat,spread,radius", [(44, 0.4, 25_000), (89.97, 0.02, 3_000), (-89.999, 0.001, 30), (0, 40, 3_000_000), (86, 0.3, 900)])
def test_any_radius_and_latitude(spark, lat, spread, radius):
    random.seed(11)
    wide = 360 if abs(lat) > 89 else spread
    pts = [(i, max(-90.0, min(90.0, lat + random.uniform(-spread, spread))), (179.9 + random.uniform(-wide, wide) + 180) % 360 - 180) for i in range(120)]
    pts += [(200, 90.0, 10.0), (201, -90.0, -170.0), (202, lat, 180.0), (203, lat, -180.0)]
    tree = Tree(spark.createDataFrame([(i, float(a), float(b)) for i, a, b in pts], "id bigint, lat double, lon double"), leaf=8)
    got = [(r[0], r[1]) for r in pairs_within(tree, radius).collect()]
    want = {(a[0], b[0]) for i, a in enumerate(pts) for b in pts[i + 1 :] if metres(a[1:], b[1:]) < radius}
    assert len(got) == len(set(got)) and set(got) == want


def test_region_with_many_edges_and_a_wide_one(spark):
    random.seed(4)
    ring = [[-80 + (0.02 + 0.01 * random.random()) * math.cos(t / 400 * math.tau), 44 + (0.02 + 0.01 * random.random()) * math.sin(t / 400 * math.tau)] for t in range(400)]
    ring.append(ring[0])
    wide = [[-130.0, 25.0], [-60.0, 25.0], [-60.0, 60.0], [-130.0, 60.0], [-130.0, 25.0]]
    regions = [(1, json.dumps({"type": "Polygon", "coordinates": [ring]})), (2, json.dumps({"type": "Polygon", "coordinates": [wide]}))]
    pts = [(i, 44 + random.uniform(-0.035, 0.035), -80 + random.uniform(-0.035, 0.035)) for i in range(600)] + [(700, 10.0, -80.0), (701, 59.9, -129.9)]
    tree = Tree(spark.createDataFrame(pts, "id bigint, lat double, lon double"), leaf=8)
    got = sorted((r[0], r[1]) for r in points_in_regions(tree, spark.createDataFrame(regions, "region_id bigint, geometry string")).collect())
    inside = lambda poly, x, y: sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(poly, poly[1:])) % 2 == 1  # noqa: B905, E731
    assert got == sorted((i, k) for i, lat, lon in pts for k, poly in ((1, ring), (2, wide)) if inside(poly, lon, lat))
