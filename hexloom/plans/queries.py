"""Queries over the driver's tables that run the engine's operators, with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions import cells
from hexloom.functions.geometry import e6, haversine
from hexloom.operators import addresses as ad
from hexloom.operators import geocode, pyramid
from hexloom.plans import analog, themes
from hexloom.sources import scratch

#: rows of a tile above which it is cut; small because the tables are
CAP = 300
RELEASE = "2026-01-01.0"
DP = 4  # places that floats are rounded to here


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(F.col(c).cast("double"), DP).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))


FRAMES = {"places": analog.places, "transportation": analog.segments, "buildings": analog.buildings}
SQL = {"places": analog.PLACES_SQL, "transportation": analog.SEGMENTS_SQL, "buildings": analog.BUILDINGS_SQL}
BASE_FRAMES = (analog.infrastructure, analog.land_use, analog.water)
BASE_SQL = (analog.INFRASTRUCTURE_SQL, analog.LAND_USE_SQL, analog.WATER_SQL)


def theme_base(spark: SparkSession, sf: str, theme: str) -> DataFrame:
    if theme == "base":
        parts = [(pyramid.base_level(themes.attributes(f(spark, sf), t, "h3_index"), t.spec), t.spec) for f, t in zip(BASE_FRAMES, themes.FEATURES["base"], strict=True)]
        return pyramid.merge_outer(parts)
    feature = themes.FEATURES[theme][0]
    return pyramid.base_level(themes.attributes(FRAMES[theme](spark, sf), feature, "h3_index"), feature.spec)


def sql_base(theme: str) -> str:
    """Common table ``l10`` of a theme's finest carried level."""

    def one(name: str, spec: themes.Spec, source: str) -> str:
        cols = [f"count(*)::integer as {spec.total}", *(f"count(*) filter (where {p})::integer as {c}" for c, p in spec.counts.items())]
        cols += [f"sum({e})::{t} as {c}" for c, (e, t) in spec.sums.items()] + [f"max({e})::{t} as {c}" for c, (e, t) in spec.maxima.items()]
        return f"{name} as (select h3_index, {', '.join(cols)} from ({source}) group by h3_index)"

    if theme != "base":
        return one("l10", themes.SPECS[theme], SQL[theme])
    specs = [f.spec for f in themes.FEATURES["base"]]
    each = ", ".join(one(f"b{i}", s, q) for i, (s, q) in enumerate(zip(specs, BASE_SQL, strict=True)))
    names = ", ".join(f"coalesce({c}, 0) as {c}" for s in specs for c in (s.total, *s.counts))
    return f"""{each}, l10 as (select coalesce(b0.h3_index, b1.h3_index, b2.h3_index) as h3_index, {names} from b0 full join b1 on b0.h3_index = b1.h3_index full join b2 on coalesce(b0.h3_index, b1.h3_index) = b2.h3_index)"""


def sql_levels(theme: str, lowest: int = 1) -> str:
    spec, out = themes.SPECS[theme], [sql_base(theme)]
    carried = [f"sum({c})::integer as {c}" for c in (spec.total, *spec.counts)] + [f"sum({c})::{t} as {c}" for c, (_, t) in spec.sums.items()] + [f"max({c}) as {c}" for c in spec.maxima]
    for r in range(9, lowest - 1, -1):
        out.append(f"l{r} as (select {analog.sql_parent('h3_index', r)} as h3_index, {', '.join(carried)} from l{r + 1} group by 1)")
    return "with " + ", ".join(out)


def sql_export(theme: str, level: int) -> str:
    spec = themes.SPECS[theme]

    def value(c: str) -> str:
        if c in spec.ratios:
            r = spec.ratios[c]
            q = f"(case when {r.under} > 0 then {r.top} / {r.under} end)::{r.type}"
            return f"round({q}::double, {DP}) as {c}" if r.type == "float" else f"{q} as {c}"
        if c in spec.maxima and spec.maxima[c][1] == "float":
            return f"round({c}::double, {DP}) as {c}"
        return c

    return f"select h3_index, {', '.join(value(c) for c in spec.exported())}, {level} as res from l{level}"


def theme_pyramid(theme: str):
    return lambda spark, sf: _rounded(pyramid.all_levels(theme_base(spark, sf, theme), themes.SPECS[theme]))


def theme_level(spark, sf: str, theme: str, res: int) -> DataFrame:
    level = theme_base(spark, sf, theme)
    for r in range(9, res - 1, -1):
        level = pyramid.roll_up(level, themes.SPECS[theme], r)
    return level


def enriched(spark, sf: str) -> DataFrame:
    return ad.enrich(analog.addresses(spark, sf), "id")


def rows(spark, sf: str) -> DataFrame:
    return ad.bucketed(enriched(spark, sf), "id", CAP)


def _agg(spark, sf):
    return ad.place_agg(enriched(spark, sf))


def _index(spark, sf):
    return ad.tile_index(ad.bucket_stats(rows(spark, sf)), _agg(spark, sf))


def _streets(spark, sf):
    return ad.street_agg(enriched(spark, sf))


def _reverse(spark, sf):
    # the tables are built once, as a build would write them
    r = scratch.written(ad.bucketed(scratch.written(enriched(spark, sf), "enriched"), "id", CAP), "rows")
    index = scratch.written(ad.tile_index(ad.bucket_stats(r), ad.place_agg(r)), "index")
    return geocode.reverse(_points(spark, sf), index, ad.tiles(r), 3).withColumn("metres", F.round("metres", 1))


def _old(spark, sf):
    return enriched(spark, sf).withColumnRenamed("h3_res4", "h3_parent")


B = "with " + analog.bucketed_sql(CAP)
AGG = """agg as (select country, h3_res4, postcode, city, region, count(*)::integer as cnt, min(lon) as min_lon, max(lon) as max_lon, min(lat) as min_lat, max(lat) as max_lat from bucketed group by all)"""
STATS = """stats as (select country, h3_res4, bucket, count(*)::integer as address_count, min(h3_index) as h3_index_min, max(h3_index) as h3_index_max, min(lon) as bbox_min_lon, max(lon) as bbox_max_lon,
 min(lat) as bbox_min_lat, max(lat) as bbox_max_lat, count(distinct postcode)::integer as unique_postcodes, count(distinct city)::integer as unique_cities from bucketed group by all)"""
MAIN = """main as (select country, h3_res4, region as primary_region from (select country, h3_res4, region, row_number() over (partition by country, h3_res4 order by sum(cnt) desc, region) as r_ from agg
 where region is not null group by country, h3_res4, region) where r_ = 1)"""
INDEX = f"{AGG}, {STATS}, {MAIN}, tile_index as (select s.*, m.primary_region from stats s left join main m on s.country = m.country and s.h3_res4 = m.h3_res4)"
STREETS = """streets as (select country, h3_res4, lower(street) as street_lower, city, count(*)::integer as cnt, avg(lon) as lon, avg(lat) as lat from bucketed where street is not null group by all)"""
BOX = "min(min_lon) as bbox_min_lon, max(max_lon) as bbox_max_lon, min(min_lat) as bbox_min_lat, max(max_lat) as bbox_max_lat"
TILES = "list(distinct h3_res4 order by h3_res4) as tiles, sum(cnt)::integer as addr_count"
STREET = "building 1-urgent"
HAVERSINE = "2 * 6371008.8 * asin(least(1.0, sqrt(pow(sin(radians(t.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(t.lat)) * pow(sin(radians(t.lon - p.lon) / 2), 2))))"
POINT_SQL = f"select c_custkey as id, (c_custkey * 53 % 36000 - 18000) / 113.0::double as lon, (c_custkey * 29 % 17000 - 8500) / 113.0::double as lat, {analog.sql_parent(analog.sql_cell('c_custkey * c_custkey % 4000'), 5)} as h3_index from customer"
TILE_SQL = "tiles as (select lon, lat, postcode, street, number, unit, city, region, full_address, h3_index, lower(street) as street_lower, country, h3_res4, bucket from bucketed)"


def _points(spark, sf):
    k = F.col("c_custkey")
    return analog.table(spark, sf, "customer").select(k.alias("id"), ((k * 53 % 36000 - 18000) / 113).alias("lon"), ((k * 29 % 17000 - 8500) / 113).alias("lat"), cells.parent(cells.synthetic(k * k % 4000), 5).alias("h3_index"))


def _tiles(spark, sf):
    return ad.tiles(rows(spark, sf))


def cross_index(spark, sf):
    parts = {"p": theme_level(spark, sf, "places", 7).select("h3_index", "place_count"), "b": theme_level(spark, sf, "buildings", 7).select("h3_index", "building_count", "n_residential"), "t": theme_level(spark, sf, "transportation", 7).select("h3_index", "segment_count", (F.col("n_cycleway") + F.col("n_footway") + F.col("n_pedestrian")).alias("walkable"))}
    joined = geocode.join_indices(parts).where("p_place_count > 50")
    return joined.orderBy(F.desc("t_walkable"), "h3_index").limit(20)


def cell_functions(spark, sf):
    x = F.col("o_orderkey") % 20000
    cell = cells.synthetic(x)
    return analog.table(spark, sf, "orders").select("o_orderkey", cell.alias("cell"), cells.resolution(cells.parent(cell, 6)).alias("res"), cells.to_string(cell).alias("hex"), *(cells.parent(cell, r).alias(f"parent{r}") for r in (9, 5, 1, 0)), cells.from_string(cells.to_string(cell)).alias("again"))


#: published examples of the grid: latitude, longitude, resolution, cell
POINTS = ((37.3615593, -122.0553238, 5, "85283473fffffff"), (37.3615593, -122.0553238, 7, "87283472bffffff"), (37.769377, -122.388903, 9, "89283082e73ffff"), (40.689167, -74.044444, 10, "8a2a1072b59ffff"))
#: and of centres: cell, latitude, longitude
CENTRES = (("87283472bffffff", 37.351718, -122.050326), ("8a2a1072b59ffff", 40.689422, -74.044431), ("8075fffffffffff", 2.300882, -5.24539))


def cell_encode(spark, sf):
    nations = analog.table(spark, sf, "nation").select("n_nationkey")
    out = None
    for i, (lat, lng, res, _) in enumerate(POINTS):
        some = nations.where(F.col("n_nationkey") % len(POINTS) == i)
        # the points come from columns, as those of a table do
        cell = cells.latlng_to_cell(F.lit(lat) + F.col("n_nationkey") * 0, F.lit(lng) + F.col("n_nationkey") * 0, res)
        one = some.select("n_nationkey", F.lit(res).alias("res"), cell.alias("cell"), cells.to_string(cell).alias("hex"))
        out = one if out is None else out.unionByName(one)
    return out


def cell_centre(spark, sf):
    hexes = analog.pick([c for c, *_ in CENTRES], F.col("n_nationkey") % len(CENTRES))
    at = analog.table(spark, sf, "nation").select("n_nationkey", hexes.alias("hex")).withColumn("at", cells.cell_to_latlng(cells.from_string(F.col("hex"))))
    return at.select("n_nationkey", "hex", F.round("at.lat", 6).alias("lat"), F.round("at.lng", 6).alias("lng"))


def geo_functions(spark, sf):
    p = _points(spark, sf)
    return p.select("id", e6(F.col("lon")).alias("lon_e6"), e6(F.col("lat")).alias("lat_e6"), F.round(haversine(F.col("lon"), F.col("lat"), F.lit(5.0), F.lit(52.0)) / 1000, 3).alias("km"))


QUERIES = {
    "cell_class_counts": lambda s, d: analog.table(s, d, "lineitem").groupBy(cells.synthetic((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 20000).alias("h3_index")).agg(F.count("*").cast("int").alias("n"), *(F.count_if(F.col("l_returnflag") == f).cast("int").alias(f"n_{f.lower()}") for f in "ANR"), F.count_if(F.col("l_linestatus") == "O").cast("int").alias("n_open")),
    "places_pyramid": theme_pyramid("places"),
    "transportation_pyramid": theme_pyramid("transportation"),
    "base_pyramid": theme_pyramid("base"),
    "buildings_pyramid": theme_pyramid("buildings"),
    "three_way_full_outer": lambda s, d: theme_base(s, d, "base"),
    "topk_cells": lambda s, d: geocode.top_cells(_rounded(pyramid.export(theme_level(s, d, "places", 7), themes.PLACES)), "place_count"),
    "topk_filtered": lambda s, d: geocode.top_cells(_rounded(pyramid.export(theme_level(s, d, "buildings", 7), themes.BUILDINGS)), "n_commercial", 20, "building_count > 100"),
    "cross_index_join": cross_index,
    "cell_functions": cell_functions,
    "cell_encode": cell_encode,
    "cell_centre": cell_centre,
    "geo_functions": geo_functions,
    "address_enrich": lambda s, d: enriched(s, d),
    "enrichment_coverage": lambda s, d: ad.coverage(enriched(s, d)),
    "tile_sizes": lambda s, d: ad.tile_sizes(enriched(s, d), CAP),
    "adaptive_buckets": lambda s, d: rows(s, d).select("id", "h3_res4", "bucket"),
    "bucket_distribution": lambda s, d: ad.bucket_sizes(rows(s, d)),
    "geocoder_tiles": _tiles,
    "place_agg": _agg,
    "street_agg": lambda s, d: _rounded(_streets(s, d)),
    "bucket_stats": lambda s, d: ad.bucket_stats(rows(s, d)),
    "primary_region": lambda s, d: ad.primary_region(_agg(s, d)),
    "tile_index": _index,
    "manifest": lambda s, d: ad.manifest(_index(s, d), RELEASE).orderBy(F.desc("address_count"), "country"),
    "postcode_index": lambda s, d: ad.postcode_index(_agg(s, d)),
    "region_index": lambda s, d: ad.region_index(_agg(s, d)),
    "city_index": lambda s, d: ad.city_index(_agg(s, d)),
    "street_index": lambda s, d: ad.street_index(_streets(s, d)),
    "street_index_by_total": lambda s, d: ad.street_index(_streets(s, d), by_total=True),
    "number_index": lambda s, d: ad.number_index(enriched(s, d)),
    "v2_tile_stats": lambda s, d: ad.tile_stats_v2(ad.place_agg(_old(s, d), "h3_parent")),
    "v2_manifest": lambda s, d: ad.manifest_v2(ad.tile_stats_v2(ad.place_agg(_old(s, d), "h3_parent")), RELEASE),
    "address_cells": lambda s, d: ad.address_levels(enriched(s, d)),
    "bucket_lookup": lambda s, d: geocode.buckets_of(_points(s, d), ad.bucket_stats(rows(s, d))).select("id", "country", "h3_res4", "bucket"),
    "reverse_lookup": _reverse,
    "forward_lookup": lambda s, d: geocode.forward(ad.street_index(_streets(s, d)), _index(s, d), _tiles(s, d), "NL", STREET),
    "autocomplete": lambda s, d: geocode.autocomplete(_tiles(s, d), "DE", "Auto"),
    "text_search": lambda s, d: geocode.search(_tiles(s, d), "HOUSEHOLD 2"),
    "any_rows": lambda s, d: _tiles(s, d).limit(7).agg(F.count("*").alias("n")),
    "box_scan": lambda s, d: geocode.in_box(_tiles(s, d), -20.0, -10.0, 40.0, 60.0),
}

_L10 = "with " + sql_base("places")
ORACLE_SQL = {
    "cell_class_counts": f"select {analog.sql_cell('(l_orderkey * 7 + l_linenumber) % 20000')} as h3_index, count(*)::integer as n, " + ", ".join(f"count(*) filter (where l_returnflag = '{f}')::integer as n_{f.lower()}" for f in "ANR") + ", count(*) filter (where l_linestatus = 'O')::integer as n_open from lineitem group by 1",
    **{f"{t}_pyramid": sql_levels(t) + " " + " union all ".join(sql_export(t, r) for r in range(10, 0, -1)) for t in themes.SPECS},
    "three_way_full_outer": f"with {sql_base('base')} select * from l10",
    "topk_cells": sql_levels("places", 7) + f" select * exclude (res) from ({sql_export('places', 7)}) order by place_count desc, h3_index limit 20",
    "topk_filtered": sql_levels("buildings", 7) + f" select * exclude (res) from ({sql_export('buildings', 7)}) where building_count > 100 order by n_commercial desc, h3_index limit 20",
    "cross_index_join": f"""with p as ({sql_levels('places', 7)} select * from l7), b as ({sql_levels('buildings', 7)} select * from l7), t as ({sql_levels('transportation', 7)} select * from l7)
select p.h3_index, p.place_count as p_place_count, b.building_count as b_building_count, b.n_residential as b_n_residential, t.segment_count as t_segment_count, t.n_cycleway + t.n_footway + t.n_pedestrian as t_walkable
from p join b on p.h3_index = b.h3_index join t on p.h3_index = t.h3_index where p.place_count > 50 order by t_walkable desc, h3_index limit 20""",
    "cell_functions": f"select o_orderkey, cell, 6 as res, lower(to_hex(cell)) as hex, {', '.join(f'{analog.sql_parent("cell", r)} as parent{r}' for r in (9, 5, 1, 0))}, cell as again from (select o_orderkey, {analog.sql_cell('o_orderkey % 20000')} as cell from orders)",
    "cell_encode": " union all ".join(f"select n_nationkey, {res} as res, {int(c, 16)}::bigint as cell, '{c}' as hex from nation where n_nationkey % {len(POINTS)} = {i}" for i, (_, _, res, c) in enumerate(POINTS)),
    "cell_centre": " union all ".join(f"select n_nationkey, '{c}' as hex, {lat}::double as lat, {lng}::double as lng from nation where n_nationkey % {len(CENTRES)} = {i}" for i, (c, lat, lng) in enumerate(CENTRES)),
    "geo_functions": f"select p.id, round(p.lon * 1e6)::integer as lon_e6, round(p.lat * 1e6)::integer as lat_e6, round({HAVERSINE.replace('t.lat', '52.0').replace('t.lon', '5.0')} / 1000, 3) as km from ({POINT_SQL}) p",
    "address_enrich": f"with {analog.ENRICHED_SQL} select * from enriched",
    "enrichment_coverage": f"with {analog.ENRICHED_SQL} select count(*) as total_enriched, count(distinct country) as countries, count(distinct h3_res4) as h3_res4_tiles, count(distinct h3_index) as h3_res5_cells, count(city) as has_city, count(full_address) as has_full_address from enriched",
    "tile_sizes": f"with {analog.ENRICHED_SQL}, n as (select count(*) as n from enriched group by h3_res4) select count(*) as total_tiles, count(*) filter (where n <= {CAP}) as normal_tiles, count(*) filter (where n > {CAP}) as mega_tiles, sum(n) filter (where n > {CAP})::bigint as addr_in_mega from n",
    "adaptive_buckets": f"{B} select id, h3_res4, bucket from bucketed",
    "bucket_distribution": f"{B}, n as (select bucket, count(*) as n from bucketed group by country, h3_res4, bucket) select count(*) as total_files, count(*) filter (where bucket = '_') as normal_files, count(*) filter (where bucket <> '_') as bucket_files, sum(n)::bigint as total_addresses, min(n) as min_bucket_size, max(n) as max_bucket_size, round(avg(n))::integer as avg_bucket_size from n",
    "geocoder_tiles": f"{B}, {TILE_SQL} select * from tiles",
    "place_agg": f"{B}, {AGG} select * from agg",
    "street_agg": f"{B}, {STREETS} select country, h3_res4, street_lower, city, cnt, round(lon, {DP}) as centroid_lon, round(lat, {DP}) as centroid_lat from streets",
    "bucket_stats": f"{B}, {STATS} select * from stats",
    "primary_region": f"{B}, {AGG}, {MAIN} select * from main",
    "tile_index": f"{B}, {INDEX} select * from tile_index",
    "manifest": f"""{B}, {INDEX} select country, sum(address_count)::integer as address_count, count(*)::integer as tile_count, count(*) filter (where bucket <> '_')::integer as bucket_count, count(distinct h3_res4)::integer as h3_res4_count,
 min(bbox_min_lon) as bbox_min_lon, max(bbox_max_lon) as bbox_max_lon, min(bbox_min_lat) as bbox_min_lat, max(bbox_max_lat) as bbox_max_lat, 4 as h3_parent_resolution, 5 as h3_index_resolution, '{RELEASE}' as release from tile_index group by country""",
    "postcode_index": f"{B}, {AGG} select country, postcode, {TILES}, round((min(min_lon) + max(max_lon)) / 2 * 1e6)::integer as centroid_lon_e6, round((min(min_lat) + max(max_lat)) / 2 * 1e6)::integer as centroid_lat_e6 from agg where postcode is not null and postcode <> '' group by country, postcode",
    "region_index": f"{B}, {AGG} select country, region, {TILES}, {BOX} from agg where region is not null group by country, region",
    "city_index": f"{B}, {AGG} select country, region, city, {TILES}, round(min(min_lon) * 1e6)::integer as bbox_min_lon_e6, round(max(max_lon) * 1e6)::integer as bbox_max_lon_e6, round(min(min_lat) * 1e6)::integer as bbox_min_lat_e6, round(max(max_lat) * 1e6)::integer as bbox_max_lat_e6 from agg where city is not null group by country, region, city, case when region is null then left(postcode, 3) end",
    "street_index": f"{B}, {STREETS}, top as (select country, street_lower, city from (select *, row_number() over (partition by country, street_lower order by cnt desc, city desc) as r_ from streets where city is not null) where r_ = 1) select s.country, s.street_lower, {TILES}, any_value(t.city) as primary_city, round(sum(lon * cnt) / sum(cnt) * 1e6)::integer as centroid_lon_e6, round(sum(lat * cnt) / sum(cnt) * 1e6)::integer as centroid_lat_e6 from streets s left join top t on s.country = t.country and s.street_lower = t.street_lower group by s.country, s.street_lower",
    "street_index_by_total": f"{B}, {STREETS}, top as (select country, street_lower, city from (select country, street_lower, city, row_number() over (partition by country, street_lower order by sum(cnt) desc, city desc) as r_ from streets where city is not null group by country, street_lower, city) where r_ = 1) select s.country, s.street_lower, {TILES}, any_value(t.city) as primary_city, round(sum(lon * cnt) / sum(cnt) * 1e6)::integer as centroid_lon_e6, round(sum(lat * cnt) / sum(cnt) * 1e6)::integer as centroid_lat_e6 from streets s left join top t on s.country = t.country and s.street_lower = t.street_lower group by s.country, s.street_lower",
    "number_index": f"{B} select country, lower(street) as street_lower, list(distinct number order by number) as numbers from bucketed where street is not null and number is not null and number <> '' group by country, lower(street)",
    "v2_tile_stats": f"{B}, {AGG}, {MAIN} select a.country, a.h3_res4 as h3_parent, sum(cnt)::integer as address_count, {BOX}, count(distinct postcode)::integer as unique_postcodes, count(distinct city)::integer as unique_cities, any_value(m.primary_region) as primary_region from agg a left join main m on a.country = m.country and a.h3_res4 = m.h3_res4 group by a.country, a.h3_res4",
    "v2_manifest": f"{B}, {AGG} select country, sum(cnt)::integer as address_count, count(distinct h3_res4)::integer as tile_count, {BOX}, 4 as h3_parent_resolution, 5 as h3_index_resolution, '{RELEASE}' as release from agg group by country",
    "address_cells": f"{B} " + " union all ".join(f"select {analog.sql_parent('h3_index', r)} as h3_index, count(*)::integer as address_count, count(distinct postcode)::integer as unique_postcodes, {r} as res from bucketed group by 1" for r in (5, 4, 3, 2, 1)),
    "bucket_lookup": f"{B}, {INDEX}, p as ({POINT_SQL}) select p.id, i.country, i.h3_res4, i.bucket from p join tile_index i on lower(to_hex({analog.sql_parent('p.h3_index', 4)})) = i.h3_res4 and p.h3_index between i.h3_index_min and i.h3_index_max",
    "reverse_lookup": f"{B}, {INDEX}, {TILE_SQL}, p as ({POINT_SQL}), f as (select p.id, {HAVERSINE} as metres, t.full_address, t.lon, t.lat from p join tile_index i on lower(to_hex({analog.sql_parent('p.h3_index', 4)})) = i.h3_res4 and p.h3_index between i.h3_index_min and i.h3_index_max join tiles t on t.country = i.country and t.h3_res4 = i.h3_res4 and t.bucket = i.bucket) select id, rank, round(metres, 1) as metres, full_address, lon, lat from (select *, row_number() over (partition by id order by metres, full_address nulls last, lon, lat)::integer as rank from f) where rank <= 3",
    "forward_lookup": f"{B}, {TILE_SQL} select * from tiles where country = 'NL' and street_lower = '{STREET}'",
    "autocomplete": f"{B}, {TILE_SQL} select * from tiles where country = 'DE' and street_lower like 'auto%' order by street nulls last, number nulls last, full_address, lon, lat limit 15",
    "text_search": f"{B}, {TILE_SQL} select * from tiles where full_address ilike '%HOUSEHOLD 2%'",
    "any_rows": f"{B}, {TILE_SQL} select count(*) as n from (select * from tiles limit 7)",
    "box_scan": f"{B}, {TILE_SQL} select * from tiles where lon between -20 and 40 and lat between -10 and 60",
}
