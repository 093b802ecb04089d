"""DuckDB SQL that computes what each registered query computes.

Written as SQL over the same portable fixtures, independently of the Spark
code paths; only column lists and fixed parameters are shared. Approximate
reports are compared on their exact columns and on the error bounds they must
keep.
"""

from __future__ import annotations

from itertools import combinations

from .functions.text import PANDAS_NA_TOKENS
from .operators.filters import EXTREME_PRICE, MAX_MINIMUM_NIGHTS
from .operators.multivariate import usual_limit
from .operators.validate import STRICT_FORMS
from .plans.contracts import AGG_LISTING_FIELDS, CALENDAR_FIELDS, LISTING_FIELDS
from .plans.listings import CONSTANT_FILLS, EXPLORE_COLUMNS, REQUIRED_COLUMNS, VALIDATED_COLUMNS
from .registry import (
    ANY_NULL_SUBSET, AREA, AS_OF, ASSOCIATED_COLUMNS, ASSOCIATED_LEVELS, ASSOCIATED_TEXT, CATEGORY_COLUMNS, CLUSTER_RADIUS, DRIFT_COLUMNS, GROUP_LEVELS,
    GROUP_MEDIAN_COLUMNS, GROUP_MODE_COLUMNS, GROUP_SUPPORT, HEAVY_COLUMNS, HISTOGRAM_BINS, HISTOGRAM_COLUMN, HISTOGRAM_COLUMNS,
    MEAN_COLUMNS, MEDIAN_COLUMNS, MODE_COLUMNS, NOW, OUTLIER_COLUMNS, PIE_COLUMN,
    STATS_DIGITS, TOP_COLUMNS, TOP_K, UNUSUAL_COLUMNS, ZERO_COLUMNS,
)
from .sources.fixtures import fixture_cte

DUCK = {"string": "varchar", "long": "bigint", "double": "double"}
SPARK_NAME = {"string": "string", "long": "bigint", "double": "double"}
LISTING_TYPES = dict(LISTING_FIELDS)
FIX_TYPES = {"id": "long", **{c: LISTING_TYPES[c] for c in VALIDATED_COLUMNS}}
FIX_COLUMNS = list(FIX_TYPES)
FEED_COLUMNS = {
    "listings": FIX_COLUMNS,
    "calendar": [n for n, _ in CALENDAR_FIELDS],
    "agg_listing": [n for n, _ in AGG_LISTING_FIELDS],
}
FEED_TYPES = {
    "listings": FIX_TYPES,
    "calendar": dict(CALENDAR_FIELDS),
    "agg_listing": dict(AGG_LISTING_FIELDS),
}
CONTRACT_FIELDS = {"listings": LISTING_FIELDS, "calendar": CALENDAR_FIELDS,
                   "agg_listing": AGG_LISTING_FIELDS}

L = "with " + fixture_cte("listings")
TOKENS = ", ".join("'" + t + "'" for t in PANDAS_NA_TOKENS)
DIG = STATS_DIGITS


def money(c):
    return f"try_cast(regexp_replace({c}, '[$,]', '', 'g') as double)"


def money_tr(c):
    return f"try_cast(translate({c}, '$,', '') as double)"


def pct(c):
    return f"try_cast(regexp_replace({c}, '%', '', 'g') as double)"


def first_num(c):
    return f"try_cast(regexp_extract({c}, '([0-9]+\\.?[0-9]*)', 1) as double)"


def first_tok(c):
    return f"try_cast(split_part({c}, ' ', 1) as double)"


def as_date(c):
    return f"try_cast({c} as date)"


def missing(c, t):
    return f"({c} is null or isnan({c}))" if t == "double" else f"({c} is null)"


def present(c, t):
    return f"({c} is not null and not isnan({c}))" if t == "double" else f"({c} is not null)"


def nan_null(c, t):
    return f"(case when isnan({c}) then null else {c} end)" if t == "double" else c


def tokens_null(c, t):
    if t == "string":
        return f"(case when {c} in ({TOKENS}) then null else {c} end)"
    return nan_null(c, t)


def cols(names):
    return ", ".join(names)


def union(parts):
    return "\nunion all\n".join(parts)


# ---------------------------------------------------------------- sources


def _contract_read(feed, key=None, stamp=False):
    """Feed columns through a contract: tokens -> null, absent fields typed null."""
    have = FEED_TYPES[feed]
    out = [key] if key else []
    for name, t in CONTRACT_FIELDS[feed]:
        out.append(f"{tokens_null(name, t)} as {name}" if name in have
                   else f"cast(null as {DUCK[t]}) as {name}")
    if stamp:
        out += [f"timestamp '{NOW}' as processing_datetime", f"'{AREA}' as area"]
    return f"with {fixture_cte(feed)} select {cols(out)} from {feed}"


GEOJSON = f"""with {fixture_cte('geojson_docs')},
feats as (select unnest(from_json(doc->'features', '["JSON"]')) as f from geojson_docs)
select f->'properties'->>'neighbourhood' as neighbourhood,
       f->'properties'->>'neighbourhood_group' as neighbourhood_group,
       f->'geometry'->>'type' as geometry_type,
       f->>'type' as feature_type
from feats"""

# ---------------------------------------------------------------- contracts


def _contract_fields():
    full = LISTING_FIELDS + [("processing_datetime", "ts"), ("area", "string")]
    parts = []
    for i, (name, t) in enumerate(full, start=1):
        spark_type = "timestamp_ntz" if t == "ts" else SPARK_NAME[t]
        if name == "processing_datetime" or name == "area":
            n = "count(*)"
        elif name in FIX_TYPES:
            n = f"count(*) filter (where {present(name, t)})"
        else:
            n = "count(cast(null as integer))"      # absent from the feed: no values
        parts.append(f"select '{name}' as column_name, '{spark_type}' as data_type, "
                     f"{i} as ordinal, {n} as n_values from listings")
    return L + "\n" + union(parts)


def _contract_diff():
    want = dict(AGG_LISTING_FIELDS)
    order = [n for n, _ in AGG_LISTING_FIELDS] + [c for c in FIX_COLUMNS if c not in want]
    parts = []
    for name in order:
        exp, act = want.get(name), FIX_TYPES.get(name)
        e = f"'{SPARK_NAME[exp]}'" if exp else "cast(null as varchar)"
        a = f"'{SPARK_NAME[act]}'" if act else "cast(null as varchar)"
        if exp and act:
            if exp == act:
                status, bad = "match", "cast(0 as bigint)"
            else:
                status = "type_mismatch"
                bad = (f"(select count(*) filter (where {name} is not null and "
                       f"try_cast({name} as {DUCK[exp]}) is null) from listings)")
        else:
            status, bad = ("missing" if act is None else "extra"), "cast(null as bigint)"
        parts.append(f"select '{name}' as column_name, {e} as expected_type, {a} as actual_type, "
                     f"'{status}' as status, {bad} as bad_values")
    return L + "\n" + union(parts)


# ---------------------------------------------------------------- cleaning

FIXED_PRICE = ", fixed as (select " + cols(
    ["id"] + [money_tr("price") + " as price" if c == "price" else c for c in EXPLORE_COLUMNS]
) + " from listings)"
POS_PRICES = FIXED_PRICE + f", pos as (select * from fixed where price < {EXTREME_PRICE})"


def _validated(fill=False):
    out = ["id"]
    for c in VALIDATED_COLUMNS:
        if c in ("host_since", "first_review", "last_review"):
            out.append(f"{as_date(c)} as {c}")
        elif fill and c in CONSTANT_FILLS:
            out.append(f"coalesce({nan_null(c, 'double')}, 0e0) as {c}")
        else:
            out.append(c)
    out += [
        money("price") + " as price_clean",
        pct("host_response_rate") + " as host_response_rate_clean",
        pct("host_acceptance_rate") + " as host_acceptance_rate_clean",
        "(host_is_superhost = 't') as host_is_superhost_bool",
        "(host_identity_verified = 't') as host_identity_verified_bool",
        "(instant_bookable = 't') as instant_bookable_bool",
        f"cast(date_diff('day', {as_date('host_since')}, date '{AS_OF}') as integer) as listing_age_days",
        first_num("bathrooms_text") + " as bathrooms_extracted",
    ]
    if fill:
        out += [f"{missing(c, 'double')} as {c}_imputed" for c in CONSTANT_FILLS]
    where = " and ".join(present(c, FIX_TYPES[c]) for c in REQUIRED_COLUMNS)
    return f"{L}\nselect {cols(out)} from listings where {where}"


def _rules(columns):
    """The default listing rules, in the same order as the Spark side."""
    have = set(columns)
    marks = []
    for c in ("latitude", "longitude", "property_type", "price", "minimum_nights"):
        if c in have:
            marks.append((f"{c}_missing", missing(c, FIX_TYPES[c])))
    parsers = {"price": money, "host_response_rate": pct, "host_acceptance_rate": pct,
               "host_since": as_date, "first_review": as_date, "last_review": as_date,
               "bathrooms_text": first_num}
    for c, p in parsers.items():
        if c in have:
            marks.append((f"{c}_unparseable", f"({c} is not null and {p(c)} is null)"))
            if c in STRICT_FORMS:
                marks.append((f"{c}_loose", f"({p(c)} is not null and not regexp_full_match({c}, '{STRICT_FORMS[c]}'))"))
    if "price" in have:
        marks.append(("price_extreme", f"({money('price')} >= {EXTREME_PRICE})"))
    if "minimum_nights" in have:
        marks.append(("min_nights_gt_90", f"(minimum_nights > {MAX_MINIMUM_NIGHTS})"))
    whens = ", ".join(f"case when {cond} then '{name}' end" for name, cond in marks)
    return f"concat_ws(';', {whens})"


VALIDATE_WIDE = f"{L}, marked as (select *, {_rules(VALIDATED_COLUMNS)} as reasons from listings)"

AMENITY_JSON = "list_transform(from_json(amenities, '[\"VARCHAR\"]'), lambda x: trim(x))"
AMENITY_COMPAT = "string_split(translate(amenities, '[]\"' || chr(92), ''), ',')"


def _clean_select(validate_rows=False, compat=False):
    out = ["id"]
    for c in EXPLORE_COLUMNS:
        if c == "price":
            out.append(money_tr("price") + " as price")
        elif c in ("host_is_superhost", "instant_bookable"):
            out.append(f"({c} = 't') as {c}")
        elif c == "bathrooms":
            out.append(first_tok("bathrooms_text") + " as bathrooms")
        elif c == "bathrooms_text":
            continue
        elif c == "amenities":
            out.append(f"array_to_string({AMENITY_COMPAT if compat else AMENITY_JSON}, ';') as amenities")
        else:
            out.append(c)
    if validate_rows:
        out += [f"{_rules(EXPLORE_COLUMNS)} as reasons"]
    return cols(out)


# ---------------------------------------------------------------- reports


def _missing_stats(where=""):
    parts = []
    for c in VALIDATED_COLUMNS:
        m = f"count(*) filter (where {missing(c, FIX_TYPES[c])})"
        parts.append(f"select '{c}' as column_name, {m} as missing_count, "
                     f"cast({m} as double) / cast(nullif(count(*), 0) as double) * 100e0 "
                     f"as missing_percent from listings {where}")
    return union(parts)


def _describe(base, columns, types, keep_nan=False):
    parts = []
    for c in columns:
        t = types[c]
        if t == "string":
            parts.append(
                f"select '{c}' as column_name, count({c}) as count, cast(null as double) as mean, "
                f"cast(null as double) as stddev, cast(null as double) as min, cast(null as double) as max, "
                f"min({c}) as min_text, max({c}) as max_text from {base}")
        else:
            v = c if keep_nan else nan_null(c, t)   # keep_nan: NaN spreads, as in Spark
            parts.append(
                f"select '{c}' as column_name, count({v}) as count, round(avg({v}), {DIG}) as mean, "
                f"round(stddev_samp({v}), {DIG}) as stddev, cast(min({v}) as double) as min, "
                f"cast(max({v}) as double) as max, {_extreme('min', c, t)} as min_text, "
                f"{_extreme('max', c, t)} as max_text from {base}")
    return union(parts)


def _extreme(f, c, t):
    return f"cast({f}({c}) as varchar)" if t in ("long", "string") else "cast(null as varchar)"


LARGE_IDS = f"""{L}, ids as (select id + 983412345678900000 as large_id, -host_id - 983412345678900000 as negative_id from listings)
""" + union(f"select '{c}' as column_name, count({c}) as count, cast(min({c}) as varchar) as min_text, "
            f"cast(max({c}) as varchar) as max_text from ids" for c in ("large_id", "negative_id"))


FIXED_TYPES = {**FIX_TYPES, "price": "double"}
FIXED_COLUMNS = ["id"] + EXPLORE_COLUMNS


def _quartiles(v, numeric, checked):
    """Exact quartiles, or for sketched reports whether they keep their bound."""
    names = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    if checked:
        return ", ".join(f"{f'case when count({v}) > 0 then true end' if numeric else 'cast(null as boolean)'} as {n}_ok"
                         for n, _ in names)
    return ", ".join(f"{f'round(quantile_cont({v}, {p}), {DIG})' if numeric else 'cast(null as double)'} as {n}"
                     for n, p in names)


def _summary(checked=False):
    parts = []
    for c in FIXED_COLUMNS:
        t = FIXED_TYPES[c]
        num = t != "string"
        v = f"cast({nan_null(c, t)} as double)" if num else c
        q = lambda p: f"quantile_cont({v}, {p})"
        stats = (f"round(avg({v}), {DIG}) as mean, round(stddev_samp({v}), {DIG}) as stddev, min({v}) as min, max({v}) as max"
                 if num else "cast(null as double) as mean, cast(null as double) as stddev, "
                             "cast(null as double) as min, cast(null as double) as max")
        iqr = "" if checked else ", " + (f"round({q(0.75)} - {q(0.25)}, {DIG}) as iqr" if num else "cast(null as double) as iqr")
        parts.append(
            f"select '{c}' as column_name, count({v}) as count, {stats}, {_extreme('min', c, t)} as min_text, "
            f"{_extreme('max', c, t)} as max_text, {_quartiles(v, num, checked)}{iqr} from fixed")
    return f"{L}{FIXED_PRICE}\n" + union(parts)


def _profile(checked=False):
    parts = []
    for c in FIXED_COLUMNS:
        t = FIXED_TYPES[c]
        m = f"count(*) filter (where {missing(c, t)})"
        v = nan_null(c, t)
        distinct = "true as distinct_ok" if checked else f"count(distinct {v}) as distinct_count"
        head = (f"select '{c}' as column_name, '{SPARK_NAME[t]}' as data_type, count(*) as n_rows, "
                f"{m} as missing_count, cast({m} as double) / cast(nullif(count(*), 0) as double) * 100e0 "
                f"as missing_percent, {distinct}, {_extreme('min', c, t)} as min_text, {_extreme('max', c, t)} as max_text")
        if t == "string":
            top = f"from fixed where {c} is not null group by {c} order by count(*) desc, {c} asc limit 1"
            tail = ("cast(null as bigint) as zero_count, cast(null as double) as mean, "
                    "cast(null as double) as stddev, cast(null as double) as min, cast(null as double) as max, "
                    f"min(length({c})) as min_length, max(length({c})) as max_length, round(avg(length({c})), {DIG}) as mean_length, "
                    f"(select {c} {top}) as top_value, (select count(*) {top}) as top_count")
        else:
            vd = f"cast({v} as double)"
            tail = (f"count(*) filter (where {vd} = 0) as zero_count, round(avg({vd}), {DIG}) as mean, "
                    f"round(stddev_samp({vd}), {DIG}) as stddev, min({vd}) as min, max({vd}) as max, "
                    "cast(null as bigint) as min_length, cast(null as bigint) as max_length, cast(null as double) as mean_length, "
                    "cast(null as varchar) as top_value, cast(null as bigint) as top_count")
        parts.append(f"{head}, {tail}, {_quartiles(f'cast({v} as double)', t != 'string', checked)} from fixed")
    return f"{L}{FIXED_PRICE}\n" + union(parts)


def _histogram_part(c, n):
    t = FIX_TYPES[c]
    return f"""select '{c}' as column_name, r.bin as bin,
       s.lo + (s.hi - s.lo) * r.bin / {n} as bin_lo,
       s.lo + (s.hi - s.lo) * (r.bin + 1) / {n} as bin_hi,
       coalesce(c.count, 0) as count
from (select cast(range as integer) as bin from range({n})) r
cross join (select min(cast({c} as double)) as lo, max(cast({c} as double)) as hi
            from listings where {present(c, t)}) s
left join (select bin, count(*) as count from (
             select cast(case when s2.hi - s2.lo = 0 then 0
                         else least(floor((cast({c} as double) - s2.lo) / (s2.hi - s2.lo) * {n}), {n - 1}) end
                         as integer) as bin
             from listings,
                  (select min(cast({c} as double)) as lo, max(cast({c} as double)) as hi
                   from listings where {present(c, t)}) s2
             where {present(c, t)}) x group by bin) c on r.bin = c.bin
where s.lo is not null and (s.hi - s.lo > 0 or r.bin = 0)"""


def _histogram(columns):
    return f"{L}\n" + union(_histogram_part(c, HISTOGRAM_BINS) for c in columns)


def _top_values(columns=TOP_COLUMNS):
    stack = union(f"select '{c}' as column_name, cast({c} as varchar) as value from listings"
                  for c in columns)
    return f"""{L},
s as ({stack}),
c as (select column_name, value, count(*) as count from s group by column_name, value),
r as (select column_name, value, count, row_number() over (partition by column_name order by count desc, value asc nulls first) as rank from c)
select column_name, value, count, cast(rank as bigint) as rank from r where rank <= {TOP_K}"""


def _impute(method, columns):
    out = ["id"]
    for c in columns:
        t = FIX_TYPES[c]
        pres = f"from listings where {present(c, t)}"
        if method == "mean":
            fill = f"(select avg({c}) {pres})"
        elif method == "median":
            fill = f"(select median({c}) {pres})"
        elif method == "zero":
            fill = "0e0" if t == "double" else "0"
        elif method == "mode":
            fill = f"(select {c} {pres} group by {c} order by count(*) desc, {c} asc limit 1)"
        else:
            fill = "'__missing__'"
        out.append(f"coalesce({nan_null(c, t)}, {fill}) as {c}")
    out += [f"{missing(c, FIX_TYPES[c])} as {c}_imputed" for c in columns]
    return f"{L}\nselect {cols(out)} from listings"


def _cluster():
    lat_rad = "least(greatest(latitude, -85.0511287798066e0), 85.0511287798066e0) * pi() / 180e0"
    scale = "16384e0"
    where = " and ".join(present(c, "double") for c in ("latitude", "longitude"))

    def inside(tile):
        return f"cast(least(greatest(floor({tile}), 0), 16383) as bigint)"

    return f"""{L},
t as (select {inside(f'(longitude + 180e0) / 360e0 * {scale}')} as tile_x,
             {inside(f'(1e0 - ln(tan({lat_rad}) + 1e0 / cos({lat_rad})) / pi()) / 2e0 * {scale}')} as tile_y,
             latitude, longitude
      from listings where {where} and abs(latitude) <= 90 and abs(longitude) <= 180)
select tile_x, tile_y, count(*) as n_points, round(avg(latitude), 6) as center_lat,
       round(avg(longitude), 6) as center_lon
from t group by tile_x, tile_y"""


_ON_EARTH = "latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude) " \
            "and abs(latitude) <= 90 and abs(longitude) <= 180"

AREAS = f"""{L}, {fixture_cte('areas')},
feats as (select unnest(from_json(doc->'features', '["JSON"]')) as f from areas),
bounds as (select f->'properties'->>'neighbourhood' as area, f->'properties'->>'neighbourhood_group' as area_group,
                  f->'geometry'->>'type' as kind, f->'geometry'->'coordinates' as c from feats),
rings as (select area, area_group, unnest(cast(c as double[][][])) as ring from bounds where kind = 'Polygon'
          union all select area, area_group, unnest(flatten(cast(c as double[][][][]))) from bounds where kind = 'MultiPolygon'),
corners as (select area, area_group, ring, unnest(range(1, len(ring))) as i from rings where len(ring) >= 4),
edges as (select area, area_group, ring[i][1] as x1, ring[i][2] as y1, ring[i + 1][1] as x2, ring[i + 1][2] as y2 from corners),
hits as (select id, area, area_group from (select id, longitude as px, latitude as py from listings where {_ON_EARTH}) p
         join edges on (y1 > py) <> (y2 > py) and px < (x2 - x1) * ((py - y1) / (y2 - y1)) + x1
         group by id, area, area_group having count(*) % 2 = 1),
placed as (select l.id, price, area, area_group, case when h.id is not null then 'placed' when {_ON_EARTH} then 'outside' else 'no_point' end as area_status
           from listings l left join hits h on l.id = h.id)"""
LISTING_AREAS = f"""{AREAS},
r as (select *, row_number() over (partition by id order by area_group nulls last, area nulls last) as rn,
             count(*) over (partition by id) as n from placed)
select id, area, area_group, case when area_status = 'placed' then n else 0 end as n_areas, area_status from r where rn = 1"""
AREA_COUNTS = f"""{AREAS},
v as (select area, area_group, area_status, {money_tr('price')} as price from placed)
select area, area_group, area_status, count(*) as n_listings, count(price) as n_values, round(avg(price), {DIG}) as mean_value,
       min(price) as min_value, max(price) as max_value from v group by area, area_group, area_status"""
BOUNDARY_REJECTS = f"""{AREAS}
select area as neighbourhood, area_group as neighbourhood_group, kind as geometry_type,
       case when kind = 'Point' then 'not a polygon' else 'no ring of four positions' end as reason
from bounds where kind = 'Point' or (kind = 'Polygon' and list_max(list_transform(cast(case when kind = 'Polygon' then c else '[]' end as json[][]), lambda r: len(r))) < 4)"""


def _mid(c, n="count(*)"):
    return f"round(sum({c}) / {n} / 1e7, 6)"


def _e7(c):
    return f"cast(round({c} * 1e7::double) as bigint)"


def _pixels(zoom):
    rad = "least(greatest(latitude, -85.0511287798066e0), 85.0511287798066e0) * pi() / 180e0"
    world = f"{256.0 * 2 ** zoom!r}::double"
    return (f"(longitude + 180e0) / 360e0 * {world}", f"(1e0 - ln(tan({rad}) + 1e0 / cos({rad})) / pi()) / 2e0 * {world}")


def _distance_clusters(zoom=14, radius=CLUSTER_RADIUS):
    x, y = _pixels(zoom)
    return f"""with recursive {fixture_cte('listings')},
pts as (select {x} as x, {y} as y, {_e7('latitude')} as lat, {_e7('longitude')} as lon from listings where {_ON_EARTH}),
cells as (select floor(x / {radius / 2})::bigint as cx, floor(y / {radius / 2})::bigint as cy, count(*) as n, min(x) as x0, max(x) as x1,
                 min(y) as y0, max(y) as y1, sum(lat) as lat, sum(lon) as lon from pts group by 1, 2),
named as (select cx * 4294967296 + cy as node, * from cells),
links as (select a.node as a, b.node as b
          from (select *, cx + dx as ncx, cy + dy as ncy from named, (select unnest(range(-3, 4)) as dx), (select unnest(range(-3, 4)) as dy)) a
          join named b on b.cx = ncx and b.cy = ncy
          where a.node <> b.node and greatest(greatest(a.x0, b.x0) - least(a.x1, b.x1), 0) ** 2
                + greatest(greatest(a.y0, b.y0) - least(a.y1, b.y1), 0) ** 2 <= {radius * radius}),
lab(node, label) using key (node) as (
  select node, node from named
  union select l.a, min(k.label) from lab k join links l on k.node = l.b join recurring.lab cur on cur.node = l.a
        where k.label < cur.label group by l.a)
select label // 4294967296 as cluster_x, label % 4294967296 as cluster_y, sum(n)::bigint as n_points, count(*) as n_cells,
       {_mid('lat', 'sum(n)')} as center_lat, {_mid('lon', 'sum(n)')} as center_lon
from named join lab using (node) group by label"""


def _pyramid(zoom=14):
    rad = "least(greatest(latitude, -85.0511287798066e0), 85.0511287798066e0) * pi() / 180e0"

    def inside(tile):
        return f"cast(least(greatest(floor({tile}), 0), {2 ** zoom - 1}) as bigint)"

    digits = " || ".join(f"cast(((tx >> {z}) & 1) + 2 * ((ty >> {z}) & 1) as varchar)" for z in range(zoom - 1, -1, -1))
    return f"""{L},
t as (select {inside(f'(longitude + 180e0) / 360e0 * {2.0 ** zoom!r}::double')} as tx,
             {inside(f'(1e0 - ln(tan({rad}) + 1e0 / cos({rad})) / pi()) / 2e0 * {2.0 ** zoom!r}::double')} as ty, latitude, longitude
      from listings where {_ON_EARTH}),
k as (select {digits} as key, {_e7('latitude')} as lat, {_e7('longitude')} as lon from t)
select cast(z as integer) as zoom, left(key, z) as quad_key, count(*) as n_points, {_mid('lat')} as center_lat,
       {_mid('lon')} as center_lon from k, (select unnest(range(0, {zoom + 1})) as z) group by z, left(key, z)"""


def _fence_part(c, method):
    v = f"cast({nan_null(c, FIXED_TYPES[c])} as double)"
    if method == "mad":
        return (f"select '{c}' as column_name, m as center, median(abs(v - m)) as spread, m - 3.5e0 * 1.4826e0 * median(abs(v - m)) as low, "
                f"m + 3.5e0 * 1.4826e0 * median(abs(v - m)) as high from (select {v} as v from fixed where v is not null), "
                f"(select median({v}) as m from fixed) group by m")
    q1, q3 = (f"quantile_cont({v}, {p})" for p in (0.25, 0.75))
    return (f"select '{c}' as column_name, median({v}) as center, {q3} - {q1} as spread, {q1} - 1.5e0 * ({q3} - {q1}) as low, "
            f"{q3} + 1.5e0 * ({q3} - {q1}) as high from fixed having count({v}) > 0")


def _fences(method):
    return (f"fences as (select column_name, center, spread, case when spread > 0 then low end as low_fence, case when spread > 0 then high end as high_fence "
            f"from ({union(_fence_part(c, method) for c in OUTLIER_COLUMNS)}))")


def _outlier_report(method):
    stack = union(f"select '{c}' as column_name, cast({nan_null(c, FIXED_TYPES[c])} as double) as v from fixed" for c in OUTLIER_COLUMNS)
    r = ", ".join(f"round({c}, {DIG}) as {c}" for c in ("center", "spread", "low_fence", "high_fence"))
    return f"""{L}{FIXED_PRICE}, {_fences(method)}, s as ({stack}),
c as (select f.column_name, count(v) as n_values, count(*) filter (where v < low_fence) as n_low, count(*) filter (where v > high_fence) as n_high
      from fences f join s using (column_name) group by f.column_name)
select column_name, {r}, n_values, n_low, n_high from fences join c using (column_name)"""


def _outlier_rows():
    def rule(c):
        v = f"cast({nan_null(c, FIXED_TYPES[c])} as double)"
        return (f"case when {v} < (select low_fence from fences where column_name = '{c}') or {v} > (select high_fence from fences "
                f"where column_name = '{c}') then '{c}_outlier' end")
    return f"""{L}{FIXED_PRICE}, {_fences('mad')}, m as (select id, concat_ws(';', {', '.join(rule(c) for c in OUTLIER_COLUMNS)}) as reasons from fixed)
select id, reasons, reasons = '' as is_valid from m"""


def _unusual():
    x, y, z = UNUSUAL_COLUMNS
    ok = " and ".join(present(c, FIXED_TYPES[c]) for c in UNUSUAL_COLUMNS)
    return f"""{L}{FIXED_PRICE},
ok as (select id, cast({x} as double) as x, cast({y} as double) as y, cast({z} as double) as z from fixed where {ok}),
m as (select avg(x) as mx, avg(y) as my, avg(z) as mz, var_samp(x) as a, covar_samp(x, y) as b, covar_samp(x, z) as c, var_samp(y) as d,
             covar_samp(y, z) as e, var_samp(z) as f from ok),
i as (select *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) as det from m),
r as (select id, ((d * f - e * e) * (x - mx) ** 2 + (a * f - c * c) * (y - my) ** 2 + (a * d - b * b) * (z - mz) ** 2
                  + 2 * (c * e - b * f) * (x - mx) * (y - my) + 2 * (b * e - c * d) * (x - mx) * (z - mz)
                  + 2 * (b * c - a * e) * (y - my) * (z - mz)) / det as d2 from ok, i)
select fixed.id, round(d2, 3) as distance2, round(d2, 3) > {usual_limit(3, 0.999)!r}::double as is_unusual from fixed left join r using (id)"""


def _numeric_association():
    parts = []
    for a, b in combinations(ASSOCIATED_COLUMNS, 2):
        va, vb = (f"cast({nan_null(c, FIXED_TYPES[c])} as double)" for c in (a, b))
        both = f"from fixed where {va} is not null and {vb} is not null"
        sd = f"nullif(stddev_samp({va}), 0) * nullif(stddev_samp({vb}), 0)"
        parts.append(f"select '{a}' as column_a, '{b}' as column_b, count(*) as n, round(covar_samp({va}, {vb}), {DIG}) + 0e0 as covariance, "
                     f"round(covar_samp({va}, {vb}) / ({sd}), {DIG}) + 0e0 as correlation {both}")
    return f"{L}{FIXED_PRICE}\n" + union(parts)


def _text_association():
    levels, parts = [], []
    for c in ASSOCIATED_TEXT:
        top = f"(select {c} from listings where {c} is not null group by {c} order by count(*) desc, {c} limit {ASSOCIATED_LEVELS})"
        levels.append(f"case when {c} is null then null when {c} in {top} then {c} else '__other__' end as {c}")
    for a, b in combinations(ASSOCIATED_TEXT, 2):
        parts.append(f"""select '{a}' as column_a, '{b}' as column_b, n, la as levels_a, lb as levels_b, round(greatest(n * (s - 1), 0e0), {DIG}) as chi2,
       case when least(la, lb) > 1 then round(sqrt(greatest(n * (s - 1), 0e0) / (n * (least(la, lb) - 1))), {DIG}) end as cramers_v
from (select sum(o)::bigint as n, count(distinct a) as la, count(distinct b) as lb, sum(o::double * o / (ra::double * cb)) as s
      from (select *, sum(o) over (partition by a) as ra, sum(o) over (partition by b) as cb
            from (select {a} as a, {b} as b, count(*) as o from leveled where {a} is not null and {b} is not null group by 1, 2))) where n > 0""")
    return f"{L}, leveled as materialized (select {', '.join(levels)} from listings)\n" + union(parts)


_WIDE_ONLY = [c for c in FIX_COLUMNS if c != "id"]


def _patterns():
    marks = ", ".join(f"case when {missing(c, FIX_TYPES[c])} then '{c}' end" for c in _WIDE_ONLY)
    return f"""{L}, p as (select concat_ws(',', {marks}) as pattern from listings)
select pattern, case when pattern = '' then 0 else cast(len(string_split(pattern, ',')) as integer) end as n_missing, count(*) as n_rows,
       cast(count(*) as double) / (select count(*) from p) * 100 as percent from p group by pattern"""


def _co_missing():
    parts = []
    for a, b in combinations(_WIDE_ONLY, 2):
        x, y = missing(a, FIX_TYPES[a]), missing(b, FIX_TYPES[b])
        parts.append(f"select '{a}' as column_a, '{b}' as column_b, count(*) filter (where {x} and {y}) as n_both, "
                     f"count(*) filter (where {x} and not {y}) as n_only_a, count(*) filter (where {y} and not {x}) as n_only_b, "
                     f"count(*) filter (where not {x} and not {y}) as n_neither from listings")
    na, nb, n = "(n_both + n_only_a)::double", "(n_both + n_only_b)::double", "(n_both + n_only_a + n_only_b + n_neither)::double"
    return f"""{L}, p as ({union(parts)})
select *, round(case when {na} < {n} and {nb} < {n} then ({n} * n_both - {na} * {nb}) / (sqrt({na} * ({n} - {na})) * sqrt({nb} * ({n} - {nb}))) end, {DIG}) + 0e0 as phi
from p where {na} > 0 and {nb} > 0"""


def _missing_effect():
    parts = []
    for c in EXPLORE_COLUMNS:
        if c == "price":
            continue
        m = missing(c, FIXED_TYPES[c])
        parts.append(f"select '{c}' as column_name, count(price) filter (where {m}) as nm, count(price) filter (where not {m}) as np, "
                     f"avg(price) filter (where {m}) as am, avg(price) filter (where not {m}) as ap, "
                     f"var_samp(price) filter (where {m}) as vm, var_samp(price) filter (where not {m}) as vp from fixed")
    return f"""{L}{FIXED_PRICE}, p as ({union(parts)})
select column_name, nm as n_missing, np as n_present, round(am, {DIG}) as mean_missing, round(ap, {DIG}) as mean_present, round(am - ap, {DIG}) + 0e0 as difference,
       round(case when nm > 1 and np > 1 and vm / nm + vp / np > 0 then (am - ap) / sqrt(vm / nm + vp / np) end, {DIG}) + 0e0 as t from p"""


def _grouped_impute(method, columns):
    joins, out = [], ["l.id"]
    for k, by in enumerate(GROUP_LEVELS):
        for c in columns:
            pres = f"from listings where {present(c, FIX_TYPES[c])}"
            keys = ", ".join(by)
            if method == "median":
                table = f"select {keys + ', ' if by else ''}median({c}) as v, count(*) as n {pres} {'group by ' + keys if by else ''}"
            else:
                table = (f"select {keys + ', ' if by else ''}arg_min(val, (-cnt, val)) as v, sum(cnt) as n from (select {keys + ', ' if by else ''}{c} as val, "
                         f"count(*) as cnt {pres} group by {keys + ', ' if by else ''}{c}) {'group by ' + keys if by else ''}")
            on = " and ".join(f"l.{b} is not distinct from t{k}_{c}.{b}" for b in by) or "true"
            joins.append(f"left join ({table}) t{k}_{c} on {on}")
    for c in columns:
        m = missing(f"l.{c}", FIX_TYPES[c])
        value, level = "null", "null"
        for k, by in reversed(list(enumerate(GROUP_LEVELS))):
            value = f"case when t{k}_{c}.n >= {GROUP_SUPPORT} then t{k}_{c}.v else {value} end"
            level = f"case when t{k}_{c}.n >= {GROUP_SUPPORT} then '{'+'.join(by) or 'all'}' else {level} end"
        out += [f"case when {m} then {value} else l.{c} end as {c}", f"{m} as {c}_imputed", f"case when {m} then {level} end as {c}_imputed_from"]
    return f"{L}\nselect {cols(out)} from listings l " + " ".join(joins)


def _drift():
    stack = union(f"select '{c}' as column_name, cast({nan_null(c, FIXED_TYPES[c])} as double) as v, 1 as a, 0 as b from fixed union all "
                  f"select '{c}', cast({nan_null(c, FIXED_TYPES[c])} as double), 0, 1 from later" for c in DRIFT_COLUMNS)
    cuts = union(f"select '{c}' as column_name, list_sort(list_distinct(quantile_cont(cast({nan_null(c, FIXED_TYPES[c])} as double), "
                 f"[{', '.join(str(i / 10) for i in range(1, 10))}]))) as cuts from fixed" for c in DRIFT_COLUMNS)
    return f"""{L}{FIXED_PRICE},
later as (select * replace (price * 1.25e0 as price, case when accommodates > 6 then minimum_nights + 7 else minimum_nights end as minimum_nights)
          from fixed where accommodates <= 12),
s as (select column_name, v, a, b from ({stack}) where v is not null),
r as (select column_name, v, sum(sum(a)) over (partition by column_name order by v) as a, sum(sum(b)) over (partition by column_name order by v) as b
      from s group by column_name, v),
n as (select column_name, sum(a)::bigint as na, sum(b)::bigint as nb from s group by column_name),
k as (select column_name, max(abs(a::double / na - b::double / nb)) as ks from r join n using (column_name) group by column_name),
q as ({cuts}),
bins as (select column_name, unnest(range(0, len(cuts) + 1)) as bin from q),
c as (select s.column_name, len(list_filter(cuts, lambda x: v > x)) as bin, sum(a) as a, sum(b) as b from s join q using (column_name) group by all),
p as (select column_name, sum((greatest(coalesce(b, 0), 0.5e0)::double / nb - greatest(coalesce(a, 0), 0.5e0)::double / na)
             * ln((greatest(coalesce(b, 0), 0.5e0)::double / nb) / (greatest(coalesce(a, 0), 0.5e0)::double / na))) as psi
      from bins join c using (column_name, bin) join n using (column_name) group by column_name)
select column_name, na as n_before, nb as n_after, round(ks, {DIG}) as ks, round(psi, {DIG}) + 0e0 as psi from n join k using (column_name) join p using (column_name)"""


def _state():
    keep = ("column_name, data_type, n_rows, missing_count, missing_percent, distinct_ok, zero_count, mean, stddev, min, max, "
            "p25_ok, p50_ok, p75_ok")
    return f"select {keep} from ({_profile(checked=True)})"


_FITS = "regexp_full_match({c}, '[0-9]+(\\.0+)?')"


def _dirty():
    bad = {c: f"({c} <> 'NA' and not {_FITS.format(c=c)})" for c in ("minimum_nights", "maximum_nights")}
    whens = ", ".join(f"case when {b} then '{c}_not_bigint' end" for c, b in bad.items())
    return f"with {fixture_cte('calendar_dirty')}, r as (select *, concat_ws(';', {whens}) as reasons from calendar_dirty)"


def _dirty_long(c):
    return f"cast(cast(nullif({c}, 'NA') as double) as bigint) as {c}"


INGEST_ACCEPTED = (f"{_dirty()} select date, available, price, cast(null as varchar) as adjusted_price, "
                   f"{_dirty_long('minimum_nights')}, {_dirty_long('maximum_nights')}, "
                   f"timestamp '{NOW}' as processing_datetime, '{AREA}' as area from r where reasons = ''")
INGEST_REJECTS = f"{_dirty()} select reasons, date, new_col, minimum_nights, maximum_nights, '{AREA}' as area from r where reasons <> ''"
GEOJSON_REJECTS = f"""with {fixture_cte('geojson_dirty')},
r as (select doc, case when not json_valid(doc) then 'not JSON'
                       when json_extract_string(doc, '$.type') <> 'FeatureCollection' then 'not a FeatureCollection'
                       when json_extract(doc, '$.features') is null then 'no feature list' end as reason from geojson_dirty)
select doc, reason from r where reason is not null"""
GEOJSON_BOUNDARIES = f"""with {fixture_cte('geojson_docs')},
feats as (select unnest(from_json(doc->'features', '["JSON"]')) as f from geojson_docs)
select f->'properties'->>'neighbourhood' as neighbourhood,
       f->'properties'->>'neighbourhood_group' as neighbourhood_group,
       f->'geometry'->>'type' as geometry_type,
       f->>'type' as feature_type,
       cast(f->'geometry'->'coordinates' as varchar) as coordinates
from feats"""

_ANY = " and ".join(present(c, FIX_TYPES[c]) for c in ANY_NULL_SUBSET)
_REQ = " and ".join(present(c, FIX_TYPES[c]) for c in REQUIRED_COLUMNS)
_LOC = " and ".join(present(c, "double") for c in ("latitude", "longitude"))

ORACLE: dict[str, str] = {
    "scan_project": f"{L} select {cols(['id'] + EXPLORE_COLUMNS)} from listings",
    "scan_project_wide": f"{L} select {cols(FIX_COLUMNS)} from listings",
    "null_tokens": f"{L} select " + cols(f"{tokens_null(c, t)} as {c}" for c, t in FIX_TYPES.items())
                   + " from listings",
    "scan_csv_contract": _contract_read("listings", key="id"),
    "geojson_features": GEOJSON,
    "geojson_files": GEOJSON,
    "geojson_rejects": GEOJSON_REJECTS,
    "geojson_file_rejects": GEOJSON_REJECTS,
    "geojson_boundaries": GEOJSON_BOUNDARIES,
    "ingest_contract_violation": "select 'new_col' as column_name, 'extra' as status union all select 'adjusted_price', 'missing'",
    "ingest_accepted": INGEST_ACCEPTED,
    "ingest_rejects": INGEST_REJECTS,
    "ingest_retry": f"{_dirty()} select l.load_id, case when reasons = '' then 'accepted' else 'rejected' end as kind, count(*) as n_rows "
                    "from r, (values ('first'), ('second'), ('third')) l(load_id) group by all",
    "stream_accepted": INGEST_ACCEPTED,
    "stream_rejects": INGEST_REJECTS,
    "ingest_listings": _contract_read("listings", stamp=True),
    "ingest_calendar": _contract_read("calendar", stamp=True),
    "ingest_agg_listing": _contract_read("agg_listing", stamp=True),
    "stream_ingest_calendar": _contract_read("calendar", stamp=True),
    "sink_append_twice": f"with {fixture_cte('calendar')} select available, count(*) * 2 as n_rows "
                         "from calendar group by available",
    "sink_overwrite": _validated(),
    "contract_fields": _contract_fields(),
    "contract_diff": _contract_diff(),
    "metadata_columns": f"{L} select *, timestamp '{NOW}' as processing_datetime, '{AREA}' as area from listings",
    "price_translate": f"{L} select id, {money_tr('price')} as price from listings",
    "price_regexp": f"{L} select id, price, {money('price')} as price_clean from listings",
    "percent_clean": f"{L} select id, host_response_rate, host_acceptance_rate, "
                     f"{pct('host_response_rate')} as host_response_rate_clean, "
                     f"{pct('host_acceptance_rate')} as host_acceptance_rate_clean from listings",
    "bool_flags": f"{L} select id, (host_is_superhost = 't') as host_is_superhost_bool, "
                  "(host_identity_verified = 't') as host_identity_verified_bool, "
                  "(instant_bookable = 't') as instant_bookable_bool from listings",
    "bathrooms_extract": f"{L} select id, bathrooms_text, {first_num('bathrooms_text')} as bathrooms_extracted "
                         "from listings",
    "bathrooms_first_token": f"{L} select id, bathrooms_text, {first_tok('bathrooms_text')} as bathrooms "
                             "from listings",
    "bathrooms_half": f"{L} select id, bathrooms_text, case when lower(bathrooms_text) like '%half-bath%' "
                      f"then 0.5e0 else {first_tok('bathrooms_text')} end as bathrooms from listings",
    "dates_parsed": f"{L} select id, {as_date('host_since')} as host_since, {as_date('first_review')} as first_review, "
                    f"{as_date('last_review')} as last_review from listings",
    "listing_age": f"{L} select id, {as_date('host_since')} as host_since, "
                   f"cast(date_diff('day', {as_date('host_since')}, date '{AS_OF}') as integer) as listing_age_days "
                   "from listings",
    "extreme_count": f"{L}{FIXED_PRICE} select count(*) as n_extreme from fixed where price >= {EXTREME_PRICE}",
    "filter_price": f"{L}{POS_PRICES} select * from pos",
    "filter_min_nights": f"{L}{POS_PRICES} select * from pos where minimum_nights <= {MAX_MINIMUM_NIGHTS}",
    "drop_missing": f"{L} select {cols(FIX_COLUMNS)} from listings where {_REQ}",
    "drop_any_null": f"{L} select {cols(FIX_COLUMNS)} from listings where {_ANY}",
    "fill_constant": f"{L} select id, " + cols(
        [f"coalesce({nan_null(c, 'double')}, 0e0) as {c}" for c in CONSTANT_FILLS]
        + [f"{missing(c, 'double')} as {c}_imputed" for c in CONSTANT_FILLS]) + " from listings",
    "impute_mean": _impute("mean", MEAN_COLUMNS),
    "impute_median": _impute("median", MEDIAN_COLUMNS),
    "impute_zero": _impute("zero", ZERO_COLUMNS),
    "impute_mode": _impute("mode", MODE_COLUMNS),
    "impute_category": _impute("category", CATEGORY_COLUMNS),
    "validate_rows": f"{VALIDATE_WIDE} select id, reasons, reasons = '' as is_valid from marked",
    "validate_reason_counts": f"{VALIDATE_WIDE}, r as (select unnest(string_split(reasons, ';')) as reason "
                              "from marked where reasons <> '') select reason, count(*) as count from r group by reason",
    "missing_stats": f"{L} {_missing_stats()}",
    "missing_stats_empty": f"{L} {_missing_stats('where accommodates > 16')}",
    "missing_bar": f"{L} select * from ({_missing_stats()}) s where missing_percent > 0 and missing_percent < 100",
    "missing_pie": f"{L} select case when {PIE_COLUMN} is null then 'Missing' else 'Not Missing' end as status, "
                   "count(*) as count from listings group by 1",
    "value_counts": f"{L}{POS_PRICES} select minimum_nights, count(*) as count from pos group by minimum_nights",
    "top_values": _top_values(),
    "describe_long": f"{L}{FIXED_PRICE}\n" + _describe("fixed", FIXED_COLUMNS, FIXED_TYPES),
    "describe_keep_nan": f"{L}{FIXED_PRICE}\n" + _describe("fixed", ["latitude", "longitude", "price"],
                                                           FIXED_TYPES, keep_nan=True),
    "describe_price": f"{L}{FIXED_PRICE}\n" + _describe("fixed", ["price"], FIXED_TYPES),
    "describe_min_nights": f"{L}{POS_PRICES}\n" + _describe("pos", ["minimum_nights"], FIXED_TYPES),
    "describe_large_ids": LARGE_IDS,
    "summary_exact": _summary(),
    "summary_approx": _summary(checked=True),
    "profile_exact": _profile(),
    "profile_approx": _profile(checked=True),
    "histogram": _histogram([HISTOGRAM_COLUMN]),
    "histograms": _histogram(HISTOGRAM_COLUMNS),
    "amenity_counts": f"{L}, i as (select unnest({AMENITY_JSON}) as item from listings) "
                      "select lower(item) as item, count(*) as count from i group by 1",
    "amenity_counts_compat": f"{L}, i as (select unnest({AMENITY_COMPAT}) as item from listings) "
                             "select lower(item) as item, count(*) as count from i group by 1",
    "map_points": f"{L} select id, price, latitude, longitude from listings where {_LOC} order by id limit 30",
    "cluster_points": _cluster(),
    "off_earth": f"{L} select id, latitude, longitude from listings where {_LOC} and (abs(latitude) > 90 or abs(longitude) > 180)",
    "outlier_report": _outlier_report("mad"),
    "outlier_report_iqr": _outlier_report("iqr"),
    "validate_outliers": _outlier_rows(),
    "unusual_rows": _unusual(),
    "numeric_association": _numeric_association(),
    "text_association": _text_association(),
    "heavy_hitters": _top_values(HEAVY_COLUMNS),
    "drift_report": _drift(),
    "profile_state": _state(),
    "missing_patterns": _patterns(),
    "co_missing": _co_missing(),
    "missing_effect": _missing_effect(),
    "impute_grouped_median": _grouped_impute("median", GROUP_MEDIAN_COLUMNS),
    "impute_grouped_mode": _grouped_impute("mode", GROUP_MODE_COLUMNS),
    "listing_areas": LISTING_AREAS,
    "area_counts": AREA_COUNTS,
    "boundary_rejects": BOUNDARY_REJECTS,
    "distance_clusters": _distance_clusters(),
    "tile_pyramid": _pyramid(),
    "clean_listings": f"{L}, c as (select {_clean_select()} from listings) select * from c "
                      f"where price < {EXTREME_PRICE} and minimum_nights <= {MAX_MINIMUM_NIGHTS}",
    "clean_listings_compat": f"{L}, c as (select {_clean_select(compat=True)} from listings) select * from c "
                             f"where price < {EXTREME_PRICE} and minimum_nights <= {MAX_MINIMUM_NIGHTS}",
    "prepare_listings": f"{L}, c as (select {_clean_select(validate_rows=True)} from listings) "
                        "select *, reasons = '' as is_valid from c",
    "validated_listings": _validated(),
    "validated_listings_filled": _validated(fill=True),
}
