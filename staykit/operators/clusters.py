"""Marker clusters that follow distance, and their zoom pyramid.

The reference's map merges markers that lie near each other on the screen.
:func:`distance_clusters` does so without regard to tile borders: points fall
into cells of half the radius, so two points of a cell are near by
construction, and a cell is one row however many points it holds. Cells whose
points' bounding boxes are no more than the radius apart are linked (each
cell meets the 24 cells ahead of it within reach, by equality joins), and
linked cells make one cluster. :func:`tile_pyramid` counts points by tile at
one zoom and rolls the counts up along the quad key to zoom 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .geo import DEFAULT_ZOOM, MAX_LATITUDE, located, on_earth, tile_xy

#: Pixels of a map tile's side, and how near markers merge.
TILE_PIXELS, RADIUS = 256, 40.0
#: Cells within reach: those ahead of a cell, each pair of cells once.
_AHEAD = [(dx, dy) for dx in range(0, 4) for dy in range(-3, 4) if dx or dy > 0]


def pixel_xy(lat: Column, lon: Column, zoom: int = DEFAULT_ZOOM) -> tuple[Column, Column]:
    """Web-Mercator pixel of a point at ``zoom``, as doubles."""
    world = float(TILE_PIXELS * 2 ** zoom)
    rad = F.least(F.greatest(lat, F.lit(-MAX_LATITUDE)), F.lit(MAX_LATITUDE)) * F.lit(math.pi) / 180.0
    return (lon + 180.0) / 360.0 * world, (1.0 - F.log(F.tan(rad) + 1.0 / F.cos(rad)) / math.pi) / 2.0 * world


def _units(degrees: str) -> Column:
    """Degrees in whole 1e-7, whose sums are the same in any order."""
    return F.round(F.col(degrees) * 1e7).cast("long")


def _center(name: str, digits: int | None) -> Column:
    c = F.col(name) / F.col("n_points") / 1e7
    return c if digits is None else F.round(c, digits)


def _cells(df: DataFrame, zoom: int, radius: float, lat: str, lon: str) -> DataFrame:
    x, y = pixel_xy(F.col(lat), F.col(lon), zoom)
    points = located(df, lat, lon).where(on_earth(F.col(lat), F.col(lon))).select(
        x.alias("x"), y.alias("y"), _units(lat).alias("lat"), _units(lon).alias("lon"))
    side = radius / 2
    return points.groupBy(F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.sum("lat").alias("lat"), F.sum("lon").alias("lon")).withColumn("node", _node(F.col("cx"), F.col("cy")))


def _node(cx: Column, cy: Column) -> Column:
    """One number for a cell (both below 2^31 at every zoom a map has)."""
    return F.shiftleft(cx.cast("long"), 32) + cy.cast("long")


def distance_clusters(df: DataFrame, zoom: int = DEFAULT_ZOOM, radius: float = RADIUS, lat: str = "latitude",
                      lon: str = "longitude", digits: int | None = 6) -> DataFrame:
    """``cluster_x, cluster_y, n_points, n_cells, center_lat, center_lon`` of each cluster.

    ``radius`` is in pixels at ``zoom``. A cluster is named by the first of
    its cells. Points on the two sides of the antimeridian are far apart, as
    on the map; points that are not on earth are in no cluster.
    """
    cells = _cells(df, zoom, radius, lat, lon).checkpoint()
    ahead = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in _AHEAD])
    box = ["x0", "x1", "y0", "y1"]
    asks = cells.select(F.col("node").alias("a"), "cx", "cy", *box, F.inline(ahead)).select(
        "a", _node(F.col("cx") + F.col("dx"), F.col("cy") + F.col("dy")).alias("b"), *[F.col(c).alias(f"{c}a") for c in box])
    both = asks.join(cells.select("node", *box), F.col("b") == F.col("node"))

    def gap(low: str, high: str) -> Column:
        return F.greatest(F.greatest(F.col(low), F.col(f"{low}a")) - F.least(F.col(high), F.col(f"{high}a")), F.lit(0.0))

    near = both.where(F.pow(gap("x0", "x1"), 2) + F.pow(gap("y0", "y1"), 2) <= radius * radius)
    labels = components(near.select("a", "b")).withColumnRenamed("node", "_node")
    named = cells.join(labels, F.col("node") == F.col("_node"), "left").withColumn("cluster", F.coalesce("label", "node"))
    out = named.groupBy("cluster").agg(F.sum("n").alias("n_points"), F.count(F.lit(1)).alias("n_cells"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"))
    return out.select(F.shiftright("cluster", 32).alias("cluster_x"), (F.col("cluster") - F.shiftleft(F.shiftright("cluster", 32), 32)).alias("cluster_y"),
                      "n_points", "n_cells", _center("lat", digits).alias("center_lat"), _center("lon", digits).alias("center_lon"))


def quad_key(x: Column, y: Column, zoom: int) -> Column:
    """A tile's quad key: a digit from 0 to 3 for each zoom down to it; its prefixes are the tiles above."""
    digits = [(F.shiftright(x, z).bitwiseAND(1) + 2 * F.shiftright(y, z).bitwiseAND(1)).cast("string") for z in range(zoom - 1, -1, -1)]
    return F.concat(*digits) if digits else F.lit("")


def tile_pyramid(df: DataFrame, zoom: int = DEFAULT_ZOOM, lat: str = "latitude", lon: str = "longitude",
                 digits: int | None = 6) -> DataFrame:
    """``zoom, quad_key, n_points, center_lat, center_lon`` of every tile from ``zoom`` up to 0.

    Points are counted once, at ``zoom``; every tile above adds up its
    prefixes' rows. The counts of each zoom add up to the located points.
    """
    x, y = tile_xy(F.col(lat), F.col(lon), zoom)
    points = located(df, lat, lon).where(on_earth(F.col(lat), F.col(lon)))
    tiles = points.groupBy(quad_key(x, y, zoom).alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_units(lat)).alias("lat"), F.sum(_units(lon)).alias("lon"))
    above = tiles.select("key", "n", "lat", "lon", F.explode(F.sequence(F.lit(0), F.lit(zoom))).alias("zoom"))
    out = above.groupBy("zoom", F.substring("key", F.lit(1), F.col("zoom")).alias("quad_key")).agg(
        F.sum("n").alias("n_points"), F.sum("lat").alias("lat"), F.sum("lon").alias("lon"))
    return out.select("zoom", "quad_key", "n_points", _center("lat", digits).alias("center_lat"), _center("lon", digits).alias("center_lon"))
