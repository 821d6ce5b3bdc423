"""Feature frames made from star-schema tables, for tables without coordinates, and their SQL.

Cells are synthetic and well-formed; coordinates are modular arithmetic on the keys. The
columns are those of the real feature files, so the engine's own theme code runs on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions import cells
from hexloom.plans import themes

COUNTRIES = ("US", "NL", "JP", "DE", "FR", "LV", "SK", "CA", "BR", "SG")
CITIES = ("Aster", "Birch", "Cedar", "Dune", "Elm", "Fern", "Grove")
REGIONS = ("North", "South", "East", "West")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values, n: Column) -> Column:
    """The value at place ``n`` from 0; null beyond the last."""
    return F.try_element_at(F.array(*(F.lit(v) for v in values)), n.cast("int") + 1)


def sql_pick(values, n: str) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + f"])[1 + ({n})]"


def sql_cell(x: str, res: int = 10) -> str:
    digits = "".join(f" + ((({x}) // {8 * 7 ** (res - i)}) % 7) * {1 << (3 * (15 - i))}" for i in range(1, res + 1))
    return f"({(1 << 59) + (res << 52) + (1 << (3 * (15 - res))) - 1} + (15 + ({x}) % 8) * {1 << 45}{digits})::bigint"


def sql_parent(cell: str, res: int) -> str:
    return f"((({cell}) & {~cells.RESOLUTION_MASK}) | {(res << 52) | ((1 << (3 * (15 - res))) - 1)})"


def c(name: str) -> Column:
    return F.col(name)


def places(spark, sf: str) -> DataFrame:
    t = table(spark, sf, "lineitem")
    group = pick(themes.PLACE_GROUPS, c("l_partkey") % 15)
    return t.select(
        cells.synthetic((c("l_orderkey") * 7 + c("l_linenumber")) % 20000).alias("h3_index"),
        F.when(c("l_linenumber") == 1, (c("l_partkey") % 64) / 64).when(c("l_linenumber") < 6, (c("l_suppkey") % 64) / 64).alias("confidence"),
        F.struct(F.when(group.isNull(), F.array().cast("array<string>")).otherwise(F.array(group, F.lit("deeper"))).alias("hierarchy")).alias("taxonomy"),
        F.struct(pick(themes.PLACE_KINDS, c("l_suppkey") % 17).alias("primary")).alias("categories"),
    )


PLACES_SQL = f"""select {sql_cell("(l_orderkey * 7 + l_linenumber) % 20000")} as h3_index,
  case when l_linenumber = 1 then (l_partkey % 64) / 64.0::double when l_linenumber < 6 then (l_suppkey % 64) / 64.0::double end as confidence,
  {sql_pick(themes.PLACE_GROUPS, "l_partkey % 15")} as place_group, {sql_pick(themes.PLACE_KINDS, "l_suppkey % 17")} as place_kind from lineitem"""

_CLASSES = [*themes.ROAD_CLASSES, "unknown"]


def segments(spark, sf: str) -> DataFrame:
    t = table(spark, sf, "orders")
    flags = F.array_compact(F.array(*(F.when(c("o_orderkey") % (3 + i) == 0, F.lit(f"is_{f}")) for i, f in enumerate(themes.ROAD_FLAGS))))
    return t.select(
        cells.synthetic((c("o_orderkey") * 13) % 20000).alias("h3_index"),
        pick(["road", "rail", "water", "road"], c("o_custkey") % 5).alias("subtype"),
        pick(_CLASSES, c("o_orderkey") % 18).alias("class"),
        F.array(F.struct(flags.alias("values"))).alias("road_flags"),
        F.when(c("o_orderkey") % 4 == 3, F.array().cast("array<struct<value:string>>")).otherwise(F.array(F.struct(pick(themes.ROAD_SURFACES, c("o_orderkey") % 4).alias("value")))).alias("road_surface"),
    )


SEGMENTS_SQL = f"""select {sql_cell("(o_orderkey * 13) % 20000")} as h3_index, {sql_pick(["road", "rail", "water", "road"], "o_custkey % 5")} as subtype,
  {sql_pick(_CLASSES, "o_orderkey % 18")} as class, {", ".join(f"o_orderkey % {3 + i} = 0 as is_{f}" for i, f in enumerate(themes.ROAD_FLAGS))},
  case when o_orderkey % 4 <> 3 then {sql_pick(themes.ROAD_SURFACES, "o_orderkey % 4")} end as surface from orders"""


def infrastructure(spark, sf: str) -> DataFrame:
    t = table(spark, sf, "customer")
    return t.select(F.when(c("c_custkey") % 97 > 0, cells.synthetic((c("c_custkey") * 31) % 9000)).alias("h3_index"), pick(list(themes.INFRASTRUCTURE.values()), c("c_custkey") % 15).alias("subtype"))


INFRASTRUCTURE_SQL = f"""select case when c_custkey % 97 > 0 then {sql_cell("(c_custkey * 31) % 9000")} end as h3_index, {sql_pick(themes.INFRASTRUCTURE.values(), "c_custkey % 15")} as subtype from customer"""


def land_use(spark, sf: str) -> DataFrame:
    t = table(spark, sf, "part")
    return t.select(F.when(c("p_partkey") % 89 > 0, cells.synthetic((c("p_partkey") * 17) % 9000)).alias("h3_index"), pick(list(themes.LAND_USE.values()), c("p_size") % 17).alias("subtype"))


LAND_USE_SQL = f"""select case when p_partkey % 89 > 0 then {sql_cell("(p_partkey * 17) % 9000")} end as h3_index, {sql_pick(themes.LAND_USE.values(), "p_size % 17")} as subtype from part"""


def water(spark, sf: str) -> DataFrame:
    t = table(spark, sf, "orders")
    return t.select(cells.synthetic((c("o_orderkey") * 11) % 9000).alias("h3_index"), pick(themes.WATER, c("o_custkey") % 9).alias("subtype"), F.when(c("o_custkey") % 3 > 0, c("o_custkey") % 3 == 1).alias("is_salt"), (c("o_orderkey") % 5 == 2).alias("is_intermittent"))


WATER_SQL = f"""select {sql_cell("(o_orderkey * 11) % 9000")} as h3_index, {sql_pick(themes.WATER, "o_custkey % 9")} as subtype, case when o_custkey % 3 > 0 then o_custkey % 3 = 1 end as is_salt, o_orderkey % 5 = 2 as is_intermittent from orders"""


def buildings(spark, sf: str) -> DataFrame:
    t = table(spark, sf, "lineitem")
    return t.select(
        cells.synthetic((c("l_orderkey") * 5 + c("l_linenumber")) % 20000).alias("h3_index"),
        pick(themes.BUILDING_TYPES, c("l_partkey") % 14).alias("subtype"),
        pick(list(themes.BUILDING_CLASSES.values()), c("l_suppkey") % 21).alias("class"),
        (c("l_linenumber") % 3 == 0).alias("has_parts"),
        F.when(c("l_quantity") <= 40, c("l_quantity") / 2).alias("height"),
        F.when(c("l_linenumber") < 6, c("l_linenumber")).alias("num_floors"),
    )


BUILDINGS_SQL = f"""select {sql_cell("(l_orderkey * 5 + l_linenumber) % 20000")} as h3_index, {sql_pick(themes.BUILDING_TYPES, "l_partkey % 14")} as subtype,
  {sql_pick(themes.BUILDING_CLASSES.values(), "l_suppkey % 21")} as class, l_linenumber % 3 = 0 as has_parts, case when l_quantity <= 40 then l_quantity / 2 end as height,
  case when l_linenumber < 6 then l_linenumber end as num_floors from lineitem"""


def addresses(spark, sf: str) -> DataFrame:
    """Raw addresses from orders and customers; the cells of a customer lie in a few tiles."""
    t = table(spark, sf, "orders").join(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), c("o_custkey") == c("c_custkey"))
    k, o = c("o_custkey"), c("o_orderkey")
    level = lambda x: F.struct(x.alias("value"))
    one, two, three = level(pick(REGIONS, k % 5)), level(pick(CITIES, k % 8)), level(pick(CITIES, (k + o) % 9))
    depth = k % 4
    levels = F.when(depth == 1, F.array(one)).when(depth == 2, F.array(one, two)).when(depth == 3, F.array(one, two, three))
    return t.select(
        o.alias("id"),
        F.when(o % 101 > 0, (o * 37 % 36000 - 18000) / 113).alias("lon"),
        ((o * 91 % 17000 - 8500) / 113).alias("lat"),
        cells.parent(cells.synthetic(k * k % 4000), 5).alias("h3_index"),
        F.when(o % 103 > 0, pick(COUNTRIES, c("c_nationkey") % 10)).alias("country"),
        F.when(o % 13 == 0, F.lit("")).when(o % 11 > 0, F.lpad((k % 700).cast("string"), 5, "0")).alias("postcode"),
        F.when(o % 17 > 0, F.concat_ws(" ", c("c_mktsegment"), c("o_orderpriority"))).alias("street"),
        F.when(o % 19 == 0, F.lit("")).when(o % 23 > 1, F.concat((o % 300).cast("string"), F.lit("-9"))).when(o % 23 > 0, (o % 300).cast("string")).alias("number"),
        F.lit(None).cast("string").alias("unit"),
        pick(CITIES, k % 10).alias("postal_city"),
        levels.alias("address_levels"),
    )


def _enriched_sql() -> str:
    one, two, three = sql_pick(REGIONS, "o_custkey % 5"), sql_pick(CITIES, "o_custkey % 8"), sql_pick(CITIES, "(o_custkey + o_orderkey) % 9")
    first = ", ".join(f"'{x}'" for x in ("US", "CA", "AU", "NZ", "BR", "MX", "CL", "CO", "UY", "SG", "HK", "TW"))
    cell = sql_parent(sql_cell("o_custkey * o_custkey % 4000"), 5)
    return f"""
raw as (select o_orderkey as id, case when o_orderkey % 101 > 0 then (o_orderkey * 37 % 36000 - 18000) / 113.0::double end as lon, (o_orderkey * 91 % 17000 - 8500) / 113.0::double as lat,
  {cell} as h3_index, case when o_orderkey % 103 > 0 then {sql_pick(COUNTRIES, "c_nationkey % 10")} end as country,
  case when o_orderkey % 13 = 0 then '' when o_orderkey % 11 > 0 then lpad((o_custkey % 700)::varchar, 5, '0') end as postcode,
  case when o_orderkey % 17 > 0 then concat_ws(' ', c_mktsegment, o_orderpriority) end as street,
  case when o_orderkey % 19 = 0 then '' when o_orderkey % 23 > 1 then (o_orderkey % 300)::varchar || '-9' when o_orderkey % 23 > 0 then (o_orderkey % 300)::varchar end as number0,
  {sql_pick(CITIES, "o_custkey % 10")} as postal_city, o_custkey % 4 as depth, {one} as v1, {two} as v2, {three} as v3
  from orders join customer on o_custkey = c_custkey),
good as (select *, case when country = 'JP' and number0 like '%-%' then split_part(number0, '-', 1) else number0 end as number,
  coalesce(case when depth >= 3 then v3 end, case when depth >= 2 then v2 end, case when depth >= 1 then v1 end, postal_city) as city, case when depth >= 2 then v1 end as region,
  lower(to_hex({sql_parent("h3_index", 4)})) as h3_res4 from raw where lon is not null and lat is not null and country is not null and (street is not null or number0 is not null)),
enriched as (select id, lon, lat, country, postcode, street, number, null::varchar as unit, city, region, concat_ws(', ', nullif(trim(case when country in ({first})
  then coalesce(number, '') || ' ' || coalesce(street, '') else coalesce(street, '') || ' ' || coalesce(number, '') end), ''), city, region, postcode) as full_address, h3_index, h3_res4 from good)"""


ENRICHED_SQL = _enriched_sql()


def bucketed_sql(cap: int) -> str:
    return f"""{ENRICHED_SQL},
sized as (select *, count(*) over (partition by h3_res4) as n_, row_number() over (partition by h3_res4 order by h3_index, md5(id::varchar), id) as r_ from enriched),
cut as (select *, ((n_ + {cap - 1}) // {cap}) as k_ from sized),
bucketed as (select * exclude (n_, r_, k_), case when n_ <= {cap} then '_' else lpad((case when r_ <= (n_ % k_) * (n_ // k_ + 1) then (r_ - 1) // (n_ // k_ + 1) + 1
  else (n_ % k_) + (r_ - 1 - (n_ % k_) * (n_ // k_ + 1)) // (n_ // k_) + 1 end)::varchar, ceil(log10(k_ + 1))::integer, '0') end as bucket from cut)"""
