"""Listings placed in their neighbourhoods: a point-in-polygon join (G1 with G3).

The reference draws listings and neighbourhood boundaries on one map. Here
each listing gets the areas it lies in:

1. a boundary's rings become edges; a point is inside if a ray to the east
   crosses an odd number of them (so holes and parts of a multipolygon need
   no cases of their own);
2. each boundary is covered by square cells of longitude and latitude. A cell
   that no edge touches is all inside (kept without edges: no test) or all
   outside (dropped); any other cell keeps the edges its rays can meet, those
   of its own row of cells that don't end to the west of it;
3. points join the cover on their cell, and on border cells cast their ray
   with built-in array functions.

The join is an equality on cell and salt, never all points by all polygons.
A point's salt is a hash of its key, and the cover, which grows with the
boundaries only, has each cell once a salt, so neither a polygon nor a cell
that holds most points is one task. Spark picks the strategy; no side is
forced to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geo import on_earth

#: Width of a cell in degrees, and salts a cell.
CELL, SALTS = 0.005, 8
#: Cells are taken this share wider than they are, against rounding at their edges.
_MARGIN = 1e-9

_RING = "array<array<double>>"


def rings(geometry_type: Column, coordinates: Column) -> Column:
    """All rings of a Polygon or MultiPolygon given as GeoJSON text; null for other types or unreadable text."""
    multi = F.flatten(F.from_json(coordinates, f"array<array<{_RING}>>"))
    found = F.when(geometry_type == "MultiPolygon", multi).when(geometry_type == "Polygon", F.from_json(coordinates, f"array<{_RING}>"))
    return F.filter(found, lambda r: (F.size(r) >= 4) & F.forall(r, lambda p: (F.size(p) >= 2) & p[0].isNotNull() & p[1].isNotNull()))


def edges(found: Column) -> Column:
    """The rings' edges, ``x1, y1, x2, y2`` in degrees; open rings are closed."""
    def of(ring: Column) -> Column:
        return F.transform(ring, lambda p, i: F.struct(
            p[0].alias("x1"), p[1].alias("y1"),
            F.element_at(F.element_at(ring, (i + 1) % F.size(ring) + 1), 1).alias("x2"),
            F.element_at(F.element_at(ring, (i + 1) % F.size(ring) + 1), 2).alias("y2")))
    return F.flatten(F.transform(found, of))


def crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether the ray from (x, y) to the east crosses an edge (its lower end counts, its upper one doesn't)."""
    meets = (e["x2"] - e["x1"]) * F.try_divide(y - e["y1"], e["y2"] - e["y1"]) + e["x1"]
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < meets)


def inside(of: Column, x: Column, y: Column) -> Column:
    return F.size(F.filter(of, lambda e: crosses(e, x, y))) % 2 == 1


def boundary_rejects(boundaries: DataFrame) -> DataFrame:
    """``neighbourhood, neighbourhood_group, geometry_type, reason`` of boundaries that can hold no point."""
    kind, text = F.col("geometry_type"), F.col("coordinates")
    found = rings(kind, text)
    reason = (F.when(kind.isNull() | ~kind.isin("Polygon", "MultiPolygon"), "not a polygon")
              .when(found.isNull(), "no coordinates").when(F.size(found) == 0, "no ring of four positions"))
    return boundaries.select("neighbourhood", "neighbourhood_group", "geometry_type", reason.alias("reason")).where(F.col("reason").isNotNull())


def cover(boundaries: DataFrame, cell: float = CELL) -> DataFrame:
    """``cx, cy, area, area_group, edges``: the cells of each boundary, ``edges`` empty where all of the cell is inside."""
    pad = cell * _MARGIN
    shapes = boundaries.select(
        F.col("neighbourhood").alias("area"), F.col("neighbourhood_group").alias("area_group"),
        edges(rings(F.col("geometry_type"), F.col("coordinates"))).alias("edges")).where(F.size("edges") > 0)

    def ends(a: str, b: str) -> tuple[Column, Column]:
        return (F.floor(F.array_min(F.transform("edges", lambda e: F.least(e[a], e[b]))) / cell),
                F.floor(F.array_max(F.transform("edges", lambda e: F.greatest(e[a], e[b]))) / cell))

    (west, east), (south, north) = ends("x1", "x2"), ends("y1", "y2")
    rows = shapes.select("area", "area_group", "edges", west.alias("west"), east.alias("east"),
                         F.explode(F.sequence(south, north)).alias("cy"))
    low, high = F.col("cy") * cell - pad, (F.col("cy") + 1) * cell + pad
    strip = F.filter("edges", lambda e: (F.least(e["y1"], e["y2"]) <= high) & (F.greatest(e["y1"], e["y2"]) >= low))
    rows = rows.select("area", "area_group", "cy", strip.alias("strip"), F.explode(F.sequence("west", "east")).alias("cx"))
    left, right = F.col("cx") * cell - pad, (F.col("cx") + 1) * cell + pad
    rows = rows.withColumn("strip", F.filter("strip", lambda e: F.greatest(e["x1"], e["x2"]) >= left))
    touched = F.exists("strip", lambda e: F.least(e["x1"], e["x2"]) <= right)
    whole = inside(F.col("strip"), (F.col("cx") + 0.5) * cell, (F.col("cy") + 0.5) * cell)
    rows = rows.withColumns({"touched": touched, "whole": whole}).where("touched or whole")
    return rows.select("cx", "cy", "area", "area_group", F.when(F.col("touched"), F.col("strip")).otherwise(F.slice("strip", 1, 0)).alias("edges"))


def place(points: DataFrame, boundaries: DataFrame, key: str = "id", lat: str = "latitude", lon: str = "longitude",
          cell: float = CELL, salts: int = SALTS) -> DataFrame:
    """The points with ``area, area_group, area_status``: a row for each area that holds a point.

    ``area_status`` is ``placed``, ``outside`` (in no area) or ``no_point``
    (a coordinate is missing or not on earth); the last two have one row and
    no area. On a shared border a point belongs to the area to its east or
    north, as rays go. Columns of the points with these three names are replaced.
    """
    names = [c for c in points.columns if c not in ("area", "area_group", "area_status")]
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    there = F.coalesce(on_earth(y, x) & ~F.isnan(x) & ~F.isnan(y), F.lit(False))
    p = points.select(
        F.struct(*names).alias("p"), x.alias("px"), y.alias("py"), there.alias("there"),
        F.when(there, F.floor(x / cell)).alias("pcx"), F.when(there, F.floor(y / cell)).alias("pcy"),
        F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("psalt"))
    c = cover(boundaries, cell).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hit = (F.size("edges") == 0) | inside(F.col("edges"), F.col("px"), F.col("py"))
    joined = p.join(c, (F.col("pcx") == F.col("cx")) & (F.col("pcy") == F.col("cy")) & (F.col("psalt") == F.col("salt")) & hit, "left")
    status = F.when(~F.col("there"), "no_point").when(F.col("cx").isNull(), "outside").otherwise("placed")
    return joined.select("p.*", "area", "area_group", status.alias("area_status"))


def areas_of(points: DataFrame, boundaries: DataFrame, key: str = "id", **kwargs) -> DataFrame:
    """``<key>, area, area_group, n_areas, area_status``, one row a key: the first area by group and name, and how many hold it."""
    placed = place(points.select(key, kwargs.get("lat", "latitude"), kwargs.get("lon", "longitude")), boundaries, key, **kwargs)
    first = F.min(F.when(F.col("area_status") == "placed", F.struct(
        F.col("area_group").isNull().alias("no_group"), "area_group", F.col("area").isNull().alias("no_name"), "area")))
    rows = placed.groupBy(key).agg(first.alias("a"), F.count_if(F.col("area_status") == "placed").alias("n_areas"), F.max("area_status").alias("area_status"))
    return rows.select(key, F.col("a.area").alias("area"), F.col("a.area_group").alias("area_group"), "n_areas", "area_status")


def area_summary(placed: DataFrame, value: str, digits: int = 4) -> DataFrame:
    """Per area (and per status without one): ``n_listings``, how many have a value, its mean, least and greatest."""
    v = F.when(~F.isnan(F.col(value)), F.col(value))
    return placed.groupBy("area", "area_group", "area_status").agg(
        F.count(F.lit(1)).alias("n_listings"), F.count(v).alias("n_values"), F.round(F.avg(v), digits).alias("mean_value"),
        F.min(v).alias("min_value"), F.max(v).alias("max_value"))
