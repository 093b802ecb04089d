"""Point-in-polygon placement against a plain ray cast, and its edge cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from staykit.operators import areas

BOUNDS = "neighbourhood string, neighbourhood_group string, geometry_type string, coordinates string"
POINTS = "id long, latitude double, longitude double, price double"


def rings_of(kind, coordinates):
    return sum(coordinates, []) if kind == "MultiPolygon" else coordinates


def holds(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * ((y - y1) / (y2 - y1)) + x1:
                odd = not odd
    return odd


def blob(rnd, cx, cy, r, n=None):
    """A star-shaped ring."""
    n = n or rnd.randint(3, 14)
    import math
    at = sorted(rnd.random() for _ in range(n))
    ring = [[cx + r * rnd.uniform(0.3, 1) * math.cos(6.2831853 * t), cy + r * rnd.uniform(0.3, 1) * math.sin(6.2831853 * t)] for t in at]
    return ring + ring[:1]


def layer(rnd, n):
    out = []
    for i in range(n):
        cx, cy, r = rnd.uniform(-1, 1), rnd.uniform(-1, 1), rnd.uniform(0.05, 0.9)
        if i % 3:
            out.append((f"P{i}", None, "Polygon", [blob(rnd, cx, cy, r), blob(rnd, cx, cy, r / 4)]))
        else:
            out.append((f"M{i}", "G", "MultiPolygon", [[blob(rnd, cx, cy, r)], [blob(rnd, cx + 3, cy, r, 60), blob(rnd, cx + 3, cy, r / 9)]]))
    return out


@pytest.mark.parametrize("cell", [0.03, 0.25, 5.0])
def test_equals_plain_ray_cast(spark, cell):
    rnd = random.Random(int(cell * 100))
    shapes = layer(rnd, 12)
    points = [(i, rnd.uniform(-1.5, 1.5), rnd.uniform(-1.5, 4.5), 1.0) for i in range(400)]
    points += [(1000 + i, y, x, 1.0) for i, (x, y) in enumerate(p for _, _, k, c in shapes for r in rings_of(k, c) for p in r)]      # corners
    bounds = spark.createDataFrame([(n, g, k, json.dumps(c)) for n, g, k, c in shapes], BOUNDS)
    got = areas.place(spark.createDataFrame(points, POINTS), bounds, cell=cell)
    want = {(i, n) for i, y, x, _ in points for n, _, k, c in shapes if holds(rings_of(k, c), x, y)}
    rows = got.collect()
    assert {(r.id, r.area) for r in rows if r.area} == want and len([r for r in rows if r.area]) == len(want)
    assert {r.id for r in rows if r.area_status == "outside"} == {p[0] for p in points} - {i for i, _ in want}


SQUARE = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]


def test_no_point_outside_overlap_and_one_row_a_key(spark):
    bounds = spark.createDataFrame([("b", "z", "Polygon", json.dumps([SQUARE])), ("a", None, "Polygon", json.dumps([SQUARE])),
                                    (None, None, "Polygon", json.dumps([[[x + 10, y] for x, y in SQUARE]]))], BOUNDS)
    nan = float("nan")
    points = spark.createDataFrame([(1, 0.5, 0.5, 1.0), (2, 5.0, 5.0, 1.0), (3, None, 0.5, 1.0), (4, nan, 0.5, 1.0), (5, 95.0, 0.5, 1.0),
                                    (6, 0.5, 10.5, None)], POINTS)
    got = {r.id: tuple(r)[1:] for r in areas.areas_of(points, bounds).collect()}
    assert got == {1: ("b", "z", 2, "placed"), 2: (None, None, 0, "outside"), 3: (None, None, 0, "no_point"), 4: (None, None, 0, "no_point"),
                   5: (None, None, 0, "no_point"), 6: (None, None, 1, "placed")}
    summary = {(r.area, r.area_status): (r.n_listings, r.n_values) for r in areas.area_summary(areas.place(points, bounds), "price").collect()}
    assert summary == {("a", "placed"): (1, 1), ("b", "placed"): (1, 1), (None, "placed"): (1, 0), (None, "outside"): (1, 1), (None, "no_point"): (3, 3)}


def test_shared_borders_belong_to_one_side(spark):
    east = [[x + 1, y] for x, y in SQUARE]
    bounds = spark.createDataFrame([("west", None, "Polygon", json.dumps([SQUARE])), ("east", None, "Polygon", json.dumps([east]))], BOUNDS)
    points = spark.createDataFrame([(1, 0.5, 1.0, 1.0), (2, 0.0, 0.5, 1.0), (3, 1.0, 0.5, 1.0)], POINTS)
    assert {r.id: r.area for r in areas.place(points, bounds).collect()} == {1: "east", 2: "west", 3: None}


def test_rejects_and_empty_layers(spark):
    rows = [("point", None, "Point", "[1,2]"), ("line", None, "Polygon", "[[[0,0],[1,1]]]"), ("text", None, "Polygon", "oops"), ("none", None, None, None),
            ("null", None, "Polygon", None), ("hole", None, "MultiPolygon", "[[[[0,null],[1,1],[2,2],[0,0]]]]"), ("ok", None, "Polygon", json.dumps([SQUARE]))]
    bounds = spark.createDataFrame(rows, BOUNDS)
    got = {r.neighbourhood: r.reason for r in areas.boundary_rejects(bounds).collect()}
    assert got == {"point": "not a polygon", "none": "not a polygon", "line": "no ring of four positions", "hole": "no ring of four positions",
                   "text": got["text"], "null": "no coordinates"} and got["text"] in ("no coordinates", "no ring of four positions")
    points = spark.createDataFrame([(1, 0.5, 0.5, 1.0)], POINTS)
    assert areas.place(points, bounds).collect()[0].area == "ok"
    assert areas.place(points, bounds.limit(0)).collect()[0].area_status == "outside"
    assert areas.place(points.limit(0), bounds).collect() == []


def test_cover_tests_only_border_cells_and_spreads_a_hot_polygon(spark):
    bounds = spark.createDataFrame([("a", None, "Polygon", json.dumps([SQUARE]))], BOUNDS)
    cover = areas.cover(bounds, 0.05).withColumn("n", F.size("edges"))
    assert cover.where("n = 0").count() >= 300 and cover.agg(F.max("n")).first()[0] <= 4
    one = spark.range(5000).select("id", F.lit(0.5).alias("latitude"), F.lit(0.5).alias("longitude"), F.lit(1.0).alias("price"))
    placed = areas.place(one, bounds)
    plan = spark._jvm.PythonSQLUtils.explainString(placed._jdf.queryExecution(), "formatted")
    assert "psalt" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert placed.where("area = 'a'").count() == 5000
