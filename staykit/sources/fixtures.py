"""Reference-shaped listing feeds derived from the driver tables.

The reference downloads its feeds at run time; here they are derived from
the TPC-H-like tables by portable SQL that runs unchanged in Spark and in
DuckDB, so every operator can be checked against DuckDB on the same rows.
The texts below are fixed values (FIXTURES.md, section C); planted defects
include nulls, ``''``, ``N/A``, NaN, bad dates and prices, ``T`` for a flag,
unparseable bathrooms, ``[]`` and escaped quotes in amenities, quoted
newlines, poles, the antimeridian and a latitude of 95, one extreme price and
long minimum stays; the ``dirty`` feeds hold what a contract must catch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import register_tables

# Portable fixture SQL, one select per feed.
LISTINGS_SQL = """
select
  o_orderkey as id,
  o_custkey as host_id,
  case when o_orderkey % 17 = 0 then null when o_orderkey % 37 = 0 then 'not a date' else cast(cast(o_orderdate as date) as string) end as host_since,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 47 = 0 then 'T' when o_orderstatus = 'F' then 't' else 'f' end as host_is_superhost,
  case when o_orderkey % 5 = 0 then null when o_orderkey % 2 = 0 then 'within an hour' else 'within a day' end as host_response_time,
  case when o_orderkey % 19 = 0 then 'N/A' when o_orderkey % 7 = 0 then null else cast(o_orderkey % 101 as string) || '%' end as host_response_rate,
  case when o_orderkey % 13 = 0 then '' else cast(o_orderkey % 100 as string) || '%' end as host_acceptance_rate,
  case when o_orderkey % 3 = 0 then null else o_orderpriority end as host_neighbourhood,
  cast(o_orderkey % 9 as double) as host_listings_count,
  case when o_orderkey % 4 = 0 then 'f' else 't' end as host_identity_verified,
  case when o_orderkey % 97 = 0 then null when o_orderkey % 89 = 0 then cast('NaN' as double) when o_orderkey % 83 = 0 then 90e0 when o_orderkey % 79 = 0 then -90e0 when o_orderkey % 73 = 0 then 95e0 else 37.9e0 + cast(o_orderkey % 1000 as double) / 10000e0 end as latitude,
  case when o_orderkey % 97 = 0 then null when o_orderkey % 71 = 0 then 180e0 else 23.7e0 + cast(o_orderkey % 770 as double) / 10000e0 end as longitude,
  case when o_orderkey % 101 = 0 then null else o_orderstatus end as property_type,
  case o_orderkey % 3 when 0 then 'Entire home/apt' when 1 then 'Private room' else 'Shared room' end as room_type,
  o_orderkey % 16 + 1 as accommodates,
  cast(null as double) as bathrooms,
  case o_orderkey % 8 when 0 then '1 bath' when 1 then '1.5 shared baths' when 2 then 'Half-bath' when 3 then '2-bath' when 4 then null when 5 then '' when 6 then '10 baths' else '0 shared baths' end as bathrooms_text,
  case when o_orderkey % 6 = 0 then null else cast(o_orderkey % 5 as double) end as bedrooms,
  case when o_orderkey % 10 = 0 then null else cast(o_orderkey % 7 as double) end as beds,
  case o_orderkey % 4 when 0 then '[]' when 1 then '["Wifi", "Kitchen"]' when 2 then '["wifi", "Coffee, tea", "55' || chr(92) || '" TV"]' else null end as amenities,
  case when o_orderkey % 23 = 0 then null when o_orderkey % 29 = 0 then '' when o_orderkey % 41 = 0 then 'call me' when o_orderkey = 1 then '$80,000.00' when o_totalprice < 100000 then '$' || cast(cast(floor(o_totalprice / 100) as bigint) as string) || '.00' else '$' || cast(cast(floor(o_totalprice / 100000) as bigint) as string) || ',' || lpad(cast(cast(floor(o_totalprice / 100) as bigint) % 1000 as string), 3, '0') || '.50' end as price,
  case when o_orderkey % 31 = 0 then null else o_orderkey % 120 + 1 end as minimum_nights,
  o_orderkey % 1125 + 1 as maximum_nights,
  o_orderkey % 400 as number_of_reviews,
  case when o_orderkey % 6 = 1 then null else cast(cast(o_orderdate as date) as string) end as first_review,
  case when o_orderkey % 6 = 1 then null else cast(cast(o_orderdate as date) as string) end as last_review,
  case when o_orderkey % 6 = 1 then null else cast(o_orderkey % 51 as double) / 10e0 end as review_scores_rating,
  case when o_orderkey % 6 = 1 then null else cast(o_orderkey % 50 as double) / 10e0 end as review_scores_cleanliness,
  case when o_orderkey % 6 = 1 then null else cast(o_orderkey % 49 as double) / 10e0 end as review_scores_checkin,
  case when o_orderkey % 6 = 1 then null else cast(o_orderkey % 48 as double) / 10e0 end as review_scores_communication,
  case when o_orderkey % 6 = 1 then null else cast(o_orderkey % 47 as double) / 10e0 end as review_scores_location,
  case when o_orderkey % 6 = 1 then null else cast(o_orderkey % 46 as double) / 10e0 end as review_scores_value,
  case when o_orderkey % 8 = 0 then null when o_orderkey % 43 = 0 then 'two' || chr(10) || '"lines", ' || cast(o_orderkey as string) else 'L' || cast(o_orderkey as string) end as license,
  case when o_orderkey % 2 = 0 then 't' else 'f' end as instant_bookable,
  case when o_orderkey % 6 = 1 then null else cast(o_orderkey % 90 as double) / 10e0 end as reviews_per_month
from orders
"""

CALENDAR_SQL = """
select
  cast(cast(l_shipdate as date) as string) as date,
  case when l_returnflag = 'R' then 'f' else 't' end as available,
  '$' || cast(cast(floor(l_extendedprice / 100) as bigint) as string) || '.00' as price,
  '$' || cast(cast(floor(l_extendedprice / 200) as bigint) as string) || case when l_linenumber = 7 then chr(10) || '"net"' else '.00' end as adjusted_price,
  cast(l_linenumber as bigint) as minimum_nights,
  cast(floor(l_quantity) as bigint) as maximum_nights
from lineitem
"""

# the calendar as text with a column the contract lacks and values that do not fit
CALENDAR_DIRTY_SQL = """
select
  cast(cast(l_shipdate as date) as string) as date,
  case when l_returnflag = 'R' then 'f' else 't' end as available,
  '$' || cast(cast(floor(l_extendedprice / 100) as bigint) as string) || '.00' as price,
  'keep' as new_col,
  case when l_linenumber = 1 then '3.0' when l_linenumber = 2 then 'abc' when l_linenumber = 3 then '2.5' when l_linenumber = 4 then 'NA' else cast(l_linenumber as string) end as minimum_nights,
  case when l_orderkey % 7 = 0 then 'x1' else cast(cast(floor(l_quantity) as bigint) as string) end as maximum_nights
from lineitem
"""

AGG_LISTING_SQL = """
select
  'Rental ' || cast(o_orderkey as string) as name,
  o_custkey as host_id,
  c_name as host_name,
  cast(null as double) as neighbourhood_group,
  c_mktsegment as neighbourhood,
  37.9e0 + cast(o_orderkey % 1000 as double) / 10000e0 as latitude,
  23.7e0 + cast(o_orderkey % 770 as double) / 10000e0 as longitude,
  case o_orderkey % 3 when 0 then 'Entire home/apt' when 1 then 'Private room' else 'Shared room' end as room_type,
  cast(floor(o_totalprice / 1000) as bigint) as price,
  o_orderkey % 120 + 1 as minimum_nights,
  o_orderkey % 400 as number_of_reviews,
  case when o_orderkey % 6 = 1 then null else cast(cast(o_orderdate as date) as string) end as last_review,
  case when o_orderkey % 6 = 1 then null else cast(o_orderkey % 90 as double) / 10e0 end as reviews_per_month,
  o_orderkey % 9 as calculated_host_listings_count,
  o_orderkey % 366 as availability_365,
  o_orderkey % 60 as number_of_reviews_ltm,
  cast(null as string) as license
from orders join customer on o_custkey = c_custkey
"""

GEOJSON_DOCS_SQL = """
select '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"MultiPolygon","coordinates":[[[[23.7,37.9],[23.8,38.0],[23.7,37.9]]]]},"properties":{"neighbourhood":"' || n_name || '","neighbourhood_group":null}},{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[[23.7,37.9],[23.8,38.0],[23.7,37.9]]]},"properties":{"neighbourhood":"' || n_name || ' B","neighbourhood_group":"G' || cast(n_regionkey as string) || '"}}]}' as doc
from nation
"""

# broken documents between good ones
GEOJSON_DIRTY_SQL = GEOJSON_DOCS_SQL + """
union all select '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"neighbourhood":"' || n_name as doc from nation
union all select '{"type":"Topology","name":"' || n_name || '"}' as doc from nation
union all select '{"type":"FeatureCollection","name":"' || n_name || '"}' as doc from nation
"""


def _position(dx: int, dy: int) -> str:
    """SQL text of one GeoJSON position: an offset in 1/10000 degree from a nation's corner in a 5 by 5 grid."""
    return (f"'[23.' || cast(7000 + n_nationkey % 5 * 150 + {dx} as string) || ',37.' "
            f"|| cast(9000 + cast((n_nationkey - n_nationkey % 5) * 38 as bigint) + {dy} as string) || ']'")


def _ring(*offsets: tuple[int, int]) -> str:
    return "'[' || " + " || ',' || ".join(_position(*o) for o in [*offsets, offsets[0]]) + " || ']'"


def _feature(kind: str, name: str, group: str, coordinates: str) -> str:
    return (f"""'{{"type":"Feature","geometry":{{"type":"{kind}","coordinates":' || {coordinates} || '}},"properties":"""
            f"""{{"neighbourhood":"' || {name} || '","neighbourhood_group":' || {group} || '}}}}'""")


# neighbourhoods over the listings' square: a hexagon with a triangular hole, in a third of the nations with a
# detached part; a district over each row of five, with a hole; and geometries that can hold no point
_HEXAGON = _ring((0, 40), (50, 0), (150, 10), (140, 120), (80, 185), (5, 150)) + " || ',' || " + _ring((60, 60), (90, 60), (75, 100))
_PART = _ring((145, 150), (150, 185), (110, 188))
_DISTRICT = _ring((0, 5), (700, 0), (745, 90), (705, 180), (3, 185)) + " || ',' || " + _ring((300, 40), (420, 50), (360, 130))
AREAS_SQL = f"""
select '{{"type":"FeatureCollection","features":[' ||
  case when n_nationkey % 3 = 0 then {_feature("MultiPolygon", "n_name", "'\"G' || cast(n_regionkey as string) || '\"'", f"'[[' || {_HEXAGON} || '],[' || {_PART} || ']]'")}
       else {_feature("Polygon", "n_name", "'null'", f"'[' || {_HEXAGON} || ']'")} end
  || case when n_nationkey % 5 = 0 then ',' || {_feature("Polygon", "'District ' || n_name", "'null'", f"'[' || {_DISTRICT} || ']'")} else '' end
  || case when n_nationkey % 7 = 0 then ',' || {_feature("Point", "'Centre of ' || n_name", "'null'", _position(75, 75))} else '' end
  || case when n_nationkey % 7 = 1 then ',' || {_feature("Polygon", "'Line of ' || n_name", "'null'", "'[' || " + _ring((0, 0), (9, 9)) + " || ']'")} else '' end
  || ']}}' as doc
from nation
"""

FIXTURE_SQL = {
    "listings": (LISTINGS_SQL, ["orders"]),
    "calendar": (CALENDAR_SQL, ["lineitem"]),
    "agg_listing": (AGG_LISTING_SQL, ["orders", "customer"]),
    "calendar_dirty": (CALENDAR_DIRTY_SQL, ["lineitem"]),
    "geojson_docs": (GEOJSON_DOCS_SQL, ["nation"]),
    "geojson_dirty": (GEOJSON_DIRTY_SQL, ["nation"]),
    "areas": (AREAS_SQL, ["nation"]),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named feed as a lazy DataFrame over the tables in ``sf_dir``."""
    sql, tables = FIXTURE_SQL[name]
    register_tables(spark, sf_dir, tables)
    return spark.sql(sql)


def fixture_cte(name: str, alias: str | None = None) -> str:
    """``<alias> as (<fixture select>)`` for a DuckDB ``with`` clause."""
    return f"{alias or name} as ({FIXTURE_SQL[name][0]})"
