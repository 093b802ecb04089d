"""Clusters that follow distance against plain linkage, and the zoom pyramid."""

import random

import pytest

from staykit.operators import clusters
from staykit.operators.components import components
from staykit.operators.geo import cluster_points, located, on_earth
from staykit.sources.fixtures import fixture
from tests.conftest import SF_SMALL

POINTS = "id long, latitude double, longitude double"
#: Degrees of longitude a pixel at zoom 14.
PIXEL = 360.0 / (256 * 2 ** 14)


def plain_components(pairs):
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in root}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randint(0, 120), rnd.randint(0, 120)) for _ in range(90)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(4000, 4040)]
    got = {r.node: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == plain_components([p for p in pairs if p[0] != p[1]])
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).collect() == []


def east(pixels):
    return 23.7 + pixels * PIXEL


def test_near_points_on_both_sides_of_a_border_are_one_cluster(spark):
    rows = []
    for i, x in enumerate([19.9, 20.1, 39.9, 40.1, 255.9, 256.1]):              # borders of cells of 20 pixels and of a tile
        rows.append((i, 37.9, east(x)))
    rows += [(10, 37.9, east(500)), (11, 37.9, east(539.9)), (12, 37.9, east(700)), (13, 37.9, east(781))]
    got = sorted((r.n_points, round((r.center_lon - 23.7) / PIXEL)) for r in clusters.distance_clusters(
        spark.createDataFrame(rows, POINTS), radius=40.0, digits=None).collect())
    assert got == [(1, 700), (1, 781), (2, 256), (2, 520), (4, 30)]


def test_hot_cells_bad_points_and_empty_input(spark):
    nan = float("nan")
    rows = [(i, 37.9, 23.7) for i in range(500)] + [(900, None, 23.7), (901, nan, 23.7), (902, 95.0, 23.7), (903, -90.0, -180.0), (904, 90.0, 180.0)]
    df = spark.createDataFrame(rows, POINTS)
    assert sorted(r.n_points for r in clusters.distance_clusters(df).collect()) == [1, 1, 500]
    assert clusters.distance_clusters(df.limit(0)).collect() == [] and clusters.tile_pyramid(df.limit(0)).collect() == []


def test_clusters_keep_every_point_and_grow_with_the_radius(spark):
    listings = fixture(spark, SF_SMALL, "listings")
    n = located(listings).where(on_earth(listings.latitude, listings.longitude)).count()
    sizes = []
    for radius in (2.0, 30.0):
        rows = clusters.distance_clusters(listings, radius=radius).collect()
        assert sum(r.n_points for r in rows) == n
        sizes.append(len(rows))
    assert sizes[0] > sizes[1]


def test_pyramid_counts_add_up_and_parents_hold_their_children(spark):
    listings = fixture(spark, SF_SMALL, "listings")
    n = located(listings).where(on_earth(listings.latitude, listings.longitude)).count()
    rows = clusters.tile_pyramid(listings, 14).collect()
    counts = {(r.zoom, r.quad_key): r.n_points for r in rows}
    for zoom in range(15):
        assert sum(c for (z, _), c in counts.items() if z == zoom) == n
    for (zoom, key), c in counts.items():
        if zoom < 14:
            assert c == sum(counts.get((zoom + 1, key + d), 0) for d in "0123")
    assert counts[0, ""] == n
    assert len([1 for z, _ in counts if z == 14]) == cluster_points(listings, 14).count()
