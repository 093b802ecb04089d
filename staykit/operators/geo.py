"""Map-ready frames.

The reference pulls every listing to the driver to draw markers and lets a
map library merge near ones. Here the marker frame is a distributed top-n
and clustering is a grid aggregate: each point gets its Web-Mercator tile
at a zoom level, and tiles are counted with a hash aggregate whose partial
sums and counts are combined map-side (a downtown tile holding a third of
all listings is one partial row per task).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_present

# Fixed value: the reference map's starting zoom level.
DEFAULT_ZOOM = 14
# Fixed value: how many markers the reference map draws.
DEFAULT_MARKERS = 30


def located(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows with both coordinates present (not null, not NaN)."""
    return df.filter(is_present(lat, df.schema[lat].dataType) & is_present(lon, df.schema[lon].dataType))


def map_points(df: DataFrame, n: int = DEFAULT_MARKERS, key: str = "id",
               popup: str = "price", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """The first ``n`` located listings by ``key``: ``key, popup, lat, lon``.

    Planned as ``TakeOrderedAndProject``: each task keeps its own top ``n``.
    """
    return located(df, lat, lon).select(key, popup, lat, lon).orderBy(key).limit(n)


#: Fixed value: the latitude at which Web Mercator is square.
MAX_LATITUDE = 85.0511287798066


def on_earth(lat: Column, lon: Column) -> Column:
    """Whether a present point has a latitude within 90 and a longitude within 180 degrees."""
    return (F.abs(lat) <= 90.0) & (F.abs(lon) <= 180.0)


def off_earth(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """The located rows whose coordinates are no point on earth."""
    return located(df, lat, lon).where(~on_earth(F.col(lat), F.col(lon)))


def tile_xy(lat: Column, lon: Column, zoom: int = DEFAULT_ZOOM) -> tuple[Column, Column]:
    """Web-Mercator (slippy map) tile of a point at ``zoom``.

    Latitudes beyond the map's edge fall into its outer rows, longitude 180
    into its last column: tiles stay in ``[0, 2^zoom - 1]``.
    """
    scale = 2 ** zoom
    rad = F.least(F.greatest(lat, F.lit(-MAX_LATITUDE)), F.lit(MAX_LATITUDE)) * F.lit(math.pi) / 180.0

    def inside(tile: Column) -> Column:
        return F.least(F.greatest(tile, F.lit(0)), F.lit(scale - 1)).cast("long")

    x = F.floor((lon + 180.0) / 360.0 * float(scale))
    y = F.floor((1.0 - F.log(F.tan(rad) + 1.0 / F.cos(rad)) / math.pi) / 2.0 * float(scale))
    return inside(x), inside(y)


def cluster_points(df: DataFrame, zoom: int = DEFAULT_ZOOM, lat: str = "latitude",
                   lon: str = "longitude", digits: int | None = 6) -> DataFrame:
    """Marker clusters as map tiles: ``tile_x, tile_y, n_points, center_lat, center_lon``.

    Points that are not on earth have no tile; :func:`off_earth` returns them.
    """
    x, y = tile_xy(F.col(lat), F.col(lon), zoom)
    agg = (located(df, lat, lon).where(on_earth(F.col(lat), F.col(lon)))
           .groupBy(x.alias("tile_x"), y.alias("tile_y"))
           .agg(F.count(F.lit(1)).alias("n_points"), F.avg(lat).alias("center_lat"),
                F.avg(lon).alias("center_lon")))
    if digits is not None:
        agg = agg.withColumns({"center_lat": F.round("center_lat", digits),
                               "center_lon": F.round("center_lon", digits)})
    return agg
