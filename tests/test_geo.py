"""Map frames."""

import math

from staykit.operators import geo


def frame(spark):
    rows = [(i, f"${i}", 37.97 + i * 1e-4, 23.72 + i * 1e-4) for i in range(50)]
    rows += [(100, "$1", None, 23.7), (101, "$1", float("nan"), 23.7)]
    return spark.createDataFrame(rows, "id long, price string, latitude double, longitude double")


def slippy(lat, lon, z):
    n = 2 ** z
    x = math.floor((lon + 180.0) / 360.0 * n)
    r = math.radians(lat)
    y = math.floor((1.0 - math.log(math.tan(r) + 1.0 / math.cos(r)) / math.pi) / 2.0 * n)
    return x, y


def test_map_points_first_n_located(spark):
    got = geo.map_points(frame(spark), n=30).collect()
    assert [r.id for r in got] == list(range(30))


def test_clusters_sum_to_located_points(spark):
    rows = geo.cluster_points(frame(spark)).collect()
    assert sum(r.n_points for r in rows) == 50


def test_tiles_match_slippy_formula(spark):
    rows = geo.cluster_points(frame(spark), zoom=14).collect()
    expect = {slippy(37.97 + i * 1e-4, 23.72 + i * 1e-4, 14) for i in range(50)}
    assert {(r.tile_x, r.tile_y) for r in rows} == expect
