"""Address enrichment, size-adaptive buckets and the geocoder's tables.

Input rows hold lon, lat, h3_index (resolution 5), country, postcode, street, number, unit,
postal_city and address_levels (array of structs with ``value``, broad to fine).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions import cells
from hexloom.functions.geometry import e6

CAP, WHOLE = 50_000, "_"
# Countries that write the number before the street.
NUMBER_FIRST = ("US", "CA", "AU", "NZ", "BR", "MX", "CL", "CO", "UY", "SG", "HK", "TW")
TILE_COLUMNS = ("lon", "lat", "postcode", "street", "number", "unit", "city", "region", "full_address", "h3_index", "street_lower")
PARTS = ("country", "h3_res4", "bucket")


def house_number(country: Column, number: Column) -> Column:
    """In Japan what follows the first hyphen is a coordinate zone, not part of the number."""
    return F.when((country == "JP") & number.contains("-"), F.split_part(number, F.lit("-"), F.lit(1))).otherwise(number)


def city_of(levels: Column, postal_city: Column) -> Column:
    """The finest level of the first three that has a value, else the postal city."""
    return F.coalesce(*(F.try_element_at(levels, F.lit(i))["value"] for i in (3, 2, 1)), postal_city)


def region_of(levels: Column) -> Column:
    """The broadest level, where there are at least two."""
    return F.when(F.size(levels) >= 2, F.try_element_at(levels, F.lit(1))["value"])


def full_address(country: Column, street: Column, number: Column, city: Column, region: Column, postcode: Column) -> Column:
    s, n = F.coalesce(street, F.lit("")), F.coalesce(number, F.lit(""))
    line = F.when(country.isin(*NUMBER_FIRST), F.concat(n, F.lit(" "), s)).otherwise(F.concat(s, F.lit(" "), n))
    return F.concat_ws(", ", F.nullif(F.trim(line), F.lit("")), city, region, postcode)


def enrich(raw: DataFrame, *keep: str) -> DataFrame:
    """Eligible addresses with city, region, full_address and their resolution-4 tile; ``keep`` columns go along.

    Rows without coordinates, country or cell, and those with neither street nor number, are left out.
    """
    c = F.col
    rows = raw.where(c("lon").isNotNull() & c("lat").isNotNull() & c("country").isNotNull() & c("h3_index").isNotNull() & (c("street").isNotNull() | c("number").isNotNull()))
    rows = rows.withColumns({"number": house_number(c("country"), c("number")), "city": city_of(c("address_levels"), c("postal_city")), "region": region_of(c("address_levels")), "h3_res4": cells.to_string(cells.parent(c("h3_index"), 4))})
    return rows.select(*keep, "lon", "lat", "country", "postcode", "street", "number", "unit", "city", "region", full_address(c("country"), c("street"), c("number"), c("city"), c("region"), c("postcode")).alias("full_address"), "h3_index", "h3_res4")


def ntile(rank: Column, n: Column, k: Column) -> Column:
    """Number of the tile of row ``rank`` (from 1) when ``n`` rows are cut into ``k`` tiles, larger ones first."""
    small, larger = F.floor(n / k), n % k
    edge = larger * (small + 1)
    return F.when(rank <= edge, F.floor((rank - 1) / (small + 1)) + 1).otherwise(larger + F.floor((rank - 1 - edge) / F.greatest(small, F.lit(1))) + 1).cast("int")


def bucketed(enriched: DataFrame, key: str, cap: int = CAP) -> DataFrame:
    """``bucket`` of each row: ``_`` in tiles of up to ``cap`` rows, else equal parts of the tile along the cells.

    The order in a tile is (h3_index, md5 of ``key``). Only counts of (cell, hash range) are
    ordered by tile, so that a tile of millions of rows, or a cell of most of them, is
    spread over tasks. Tile sizes count all countries.
    """
    hashed = enriched.withColumn("_m", F.md5(F.col(key).cast("string"))).withColumn("_r", F.substring("_m", 1, 2))
    groups = hashed.groupBy("h3_res4", "h3_index", "_r").agg(F.count("*").alias("_n"))
    tile = Window.partitionBy("h3_res4")
    groups = groups.withColumns({"_size": F.sum("_n").over(tile), "_before": F.coalesce(F.sum("_n").over(tile.orderBy("h3_index", "_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    placed = hashed.join(groups.select("h3_res4", "h3_index", "_r", "_size", "_before"), ["h3_res4", "h3_index", "_r"])
    inner = Window.partitionBy("h3_res4", "h3_index", "_r").orderBy("_m", key)
    k = F.ceil(F.col("_size") / cap)
    number = ntile(F.row_number().over(inner) + F.col("_before"), F.col("_size"), k)
    label = F.lpad(number.cast("string"), F.ceil(F.log10(k + 1)).cast("int"), F.lit("0"))
    return placed.select(*enriched.columns, F.when(F.col("_size") <= cap, WHOLE).otherwise(label).alias("bucket"))


def coverage(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count("*").alias("total_enriched"), F.count_distinct("country").alias("countries"), F.count_distinct("h3_res4").alias("h3_res4_tiles"), F.count_distinct("h3_index").alias("h3_res5_cells"), F.count("city").alias("has_city"), F.count("full_address").alias("has_full_address"))


def tile_sizes(enriched: DataFrame, cap: int = CAP) -> DataFrame:
    """Number of normal and large tiles, and addresses in large ones (null if there are none)."""
    n = enriched.groupBy("h3_res4").agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("total_tiles"), F.count_if(F.col("n") <= cap).alias("normal_tiles"), F.count_if(F.col("n") > cap).alias("mega_tiles"), F.sum(F.when(F.col("n") > cap, F.col("n"))).alias("addr_in_mega"))


def bucket_sizes(rows: DataFrame) -> DataFrame:
    """Sizes of files, by country as they are written."""
    n = rows.groupBy(*PARTS).agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("total_files"), F.count_if(F.col("bucket") == WHOLE).alias("normal_files"), F.count_if(F.col("bucket") != WHOLE).alias("bucket_files"), F.sum("n").alias("total_addresses"), F.min("n").alias("min_bucket_size"), F.max("n").alias("max_bucket_size"), F.round(F.avg("n")).cast("int").alias("avg_bucket_size"))


def tiles(rows: DataFrame) -> DataFrame:
    """Tile rows, with the lower-case street as a column of its own so that file statistics apply to it."""
    return rows.withColumn("street_lower", F.lower("street")).select(*TILE_COLUMNS, *PARTS)


def place_agg(rows: DataFrame, tile: str = "h3_res4") -> DataFrame:
    return rows.groupBy("country", tile, "postcode", "city", "region").agg(F.count("*").cast("int").alias("cnt"), F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"), F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"))


def street_agg(rows: DataFrame, tile: str = "h3_res4") -> DataFrame:
    return rows.where("street is not null").groupBy("country", tile, F.lower("street").alias("street_lower"), "city").agg(F.count("*").cast("int").alias("cnt"), F.avg("lon").alias("centroid_lon"), F.avg("lat").alias("centroid_lat"))


def _sorted_set(c: str) -> Column:
    return F.array_sort(F.collect_set(c))


def number_index(rows: DataFrame) -> DataFrame:
    """Distinct numbers of each street, as text in text order."""
    some = rows.where("street is not null and number is not null and number <> ''")
    return some.groupBy("country", F.lower("street").alias("street_lower")).agg(_sorted_set("number").alias("numbers"))


def bucket_stats(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PARTS).agg(
        F.count("*").cast("int").alias("address_count"),
        F.min("h3_index").alias("h3_index_min"), F.max("h3_index").alias("h3_index_max"),
        F.min("lon").alias("bbox_min_lon"), F.max("lon").alias("bbox_max_lon"), F.min("lat").alias("bbox_min_lat"), F.max("lat").alias("bbox_max_lat"),
        F.count_distinct("postcode").cast("int").alias("unique_postcodes"), F.count_distinct("city").cast("int").alias("unique_cities"),
    )


def primary_region(agg: DataFrame, tile: str = "h3_res4") -> DataFrame:
    """The region with most addresses of each country and tile, the first by name among equals."""
    n = agg.where("region is not null").groupBy("country", tile, "region").agg(F.sum("cnt").alias("n"))
    w = Window.partitionBy("country", tile).orderBy(F.desc("n"), "region")
    return n.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("country", tile, F.col("region").alias("primary_region"))


def tile_index(stats: DataFrame, agg: DataFrame) -> DataFrame:
    return stats.join(primary_region(agg), ["country", "h3_res4"], "left")


def manifest(index: DataFrame, release: str) -> DataFrame:
    box = [f("bbox_%s" % n).alias("bbox_%s" % n) for f, n in ((F.min, "min_lon"), (F.max, "max_lon"), (F.min, "min_lat"), (F.max, "max_lat"))]
    return index.groupBy("country").agg(
        F.sum("address_count").cast("int").alias("address_count"), F.count("*").cast("int").alias("tile_count"),
        F.count_if(F.col("bucket") != WHOLE).cast("int").alias("bucket_count"), F.count_distinct("h3_res4").cast("int").alias("h3_res4_count"), *box,
    ).withColumns({"h3_parent_resolution": F.lit(4), "h3_index_resolution": F.lit(5), "release": F.lit(release)})


def _agg_box(*more: Column) -> list[Column]:
    return [F.min("min_lon").alias("bbox_min_lon"), F.max("max_lon").alias("bbox_max_lon"), F.min("min_lat").alias("bbox_min_lat"), F.max("max_lat").alias("bbox_max_lat"), *more]


def postcode_index(agg: DataFrame, tile: str = "h3_res4") -> DataFrame:
    """Tiles, addresses and the middle of the bounding box of each postcode."""
    some = agg.where("postcode is not null and postcode <> ''")
    return some.groupBy("country", "postcode").agg(_sorted_set(tile).alias("tiles"), F.sum("cnt").cast("int").alias("addr_count"), e6((F.min("min_lon") + F.max("max_lon")) / 2).alias("centroid_lon_e6"), e6((F.min("min_lat") + F.max("max_lat")) / 2).alias("centroid_lat_e6"))


def region_index(agg: DataFrame, tile: str = "h3_res4") -> DataFrame:
    return agg.where("region is not null").groupBy("country", "region").agg(_sorted_set(tile).alias("tiles"), F.sum("cnt").cast("int").alias("addr_count"), *_agg_box())


def city_index(agg: DataFrame, tile: str = "h3_res4") -> DataFrame:
    """Cities of one name without a region are told apart by the first three characters of the postcode."""
    apart = F.when(F.col("region").isNull(), F.left("postcode", F.lit(3))).alias("_p")
    done = agg.where("city is not null").groupBy("country", "region", "city", apart).agg(_sorted_set(tile).alias("tiles"), F.sum("cnt").cast("int").alias("addr_count"), *_agg_box())
    return done.select("country", "region", "city", "tiles", "addr_count", *(e6(F.col(c)).alias(f"{c}_e6") for c in ("bbox_min_lon", "bbox_max_lon", "bbox_min_lat", "bbox_max_lat")))


def street_index(agg: DataFrame, tile: str = "h3_res4", by_total: bool = False) -> DataFrame:
    """Tiles, addresses, main city and weighted centre of each street.

    primary_city is the city of the largest single (tile, city) group, the last by name among
    equals; with ``by_total`` the city with most addresses over all tiles.
    """
    mean = lambda c: e6(F.sum(F.col(c) * F.col("cnt")) / F.sum("cnt"))
    city = F.max(F.when(F.col("city").isNotNull(), F.struct("cnt", "city")))["city"]
    done = agg.groupBy("country", "street_lower").agg(_sorted_set(tile).alias("tiles"), F.sum("cnt").cast("int").alias("addr_count"), city.alias("primary_city"), mean("centroid_lon").alias("centroid_lon_e6"), mean("centroid_lat").alias("centroid_lat_e6"))
    if by_total:
        n = agg.where("city is not null").groupBy("country", "street_lower", "city").agg(F.sum("cnt").alias("n"))
        main = n.groupBy("country", "street_lower").agg(F.max(F.struct("n", "city"))["city"].alias("primary_city"))
        done = done.drop("primary_city").join(main, ["country", "street_lower"], "left")
    return done


def tile_stats_v2(agg: DataFrame, tile: str = "h3_parent") -> DataFrame:
    """The older layout's tile statistics: one row for each country and tile, from the aggregate alone."""
    done = agg.groupBy("country", tile).agg(F.sum("cnt").cast("int").alias("address_count"), *_agg_box(F.count_distinct("postcode").cast("int").alias("unique_postcodes"), F.count_distinct("city").cast("int").alias("unique_cities")))
    return done.join(primary_region(agg, tile), ["country", tile], "left")


def manifest_v2(stats: DataFrame, release: str) -> DataFrame:
    """The older layout's manifest."""
    return stats.groupBy("country").agg(
        F.sum("address_count").cast("int").alias("address_count"), F.count("*").cast("int").alias("tile_count"),
        F.min("bbox_min_lon").alias("bbox_min_lon"), F.max("bbox_max_lon").alias("bbox_max_lon"), F.min("bbox_min_lat").alias("bbox_min_lat"), F.max("bbox_max_lat").alias("bbox_max_lat"),
    ).withColumns({"h3_parent_resolution": F.lit(4), "h3_index_resolution": F.lit(5), "release": F.lit(release)})


def address_levels(rows: DataFrame, finest: int = 5, coarsest: int = 1) -> DataFrame:
    """An extension: addresses and distinct postcodes by cell and resolution ``res``, so that joins over indices have an address side.

    Distinct counts do not add up, so every level is counted from the rows: in one aggregate,
    after the rows of a (finest cell, postcode) are counted.
    """
    n = rows.groupBy("h3_index", "postcode").agg(F.count("*").alias("n"))
    dealt = n.withColumn("res", F.explode(F.sequence(F.lit(coarsest), F.lit(finest))))
    dealt = dealt.groupBy(cells.parent_at(F.col("h3_index"), F.col("res")).alias("h3_index"), "res", "postcode").agg(F.sum("n").alias("n"))
    return dealt.groupBy("h3_index", "res").agg(F.sum("n").cast("int").alias("address_count"), F.count("postcode").cast("int").alias("unique_postcodes")).select("h3_index", "address_count", "unique_postcodes", "res")
