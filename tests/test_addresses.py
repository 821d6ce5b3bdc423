import pytest
from pyspark.sql import functions as F

from hexloom.functions import cells
from hexloom.operators import addresses as ad
from hexloom.operators import geocode
from hexloom.plans import queries

SCHEMA = "id long, lon double, lat double, h3_index long, country string, postcode string, street string, number string, unit string, postal_city string, address_levels array<struct<value:string>>"
CELL = int("85283473fffffff", 16)


def raw(spark, rows):
    full = [(i, 1.0, 2.0, CELL, c, p, s, n, None, pc, None if lv is None else [(v,) for v in lv]) for i, (c, n, s, p, lv, pc) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


CASES = [
    (("US", "12", "Main St", "90210", ["CA", "Los Angeles"], None), ("12", "Los Angeles", "CA", "12 Main St, Los Angeles, CA, 90210")),
    (("NL", "18", "Keizersgracht", "1015", ["Amsterdam"], None), ("18", "Amsterdam", None, "Keizersgracht 18, Amsterdam, 1015")),
    (("JP", "362-9", "Chuo", "100", ["Tokyo", "Chiyoda", "Ward"], None), ("362", "Ward", "Tokyo", "Chuo 362, Ward, Tokyo, 100")),
    (("JP", "1-2-3", "X", None, None, None), ("1", None, None, "X 1")),
    (("DE", None, "Hauptstr", None, None, "Berlin"), (None, "Berlin", None, "Hauptstr, Berlin")),
    (("US", "7", None, None, ["TX", None], "Austin"), ("7", "TX", "TX", "7, TX, TX")),
    (("FR", "", "", None, [], "Paris"), ("", "Paris", None, "Paris")),
    (("SK", "5", "Ulica", "811", ["Bratislavsky", "Bratislava", None], None), ("5", "Bratislava", "Bratislavsky", "Ulica 5, Bratislava, Bratislavsky, 811")),
    (("DE", "3", None, None, None, None), ("3", None, None, "3")),
]


def test_enrich(spark):
    got = {r.id: (r.number, r.city, r.region, r.full_address) for r in ad.enrich(raw(spark, [c for c, _ in CASES]), "id").collect()}
    assert got == {i: e for i, (_, e) in enumerate(CASES)}


def test_ineligible_rows_go(spark):
    df = raw(spark, [(None, "1", "A", None, None, None), ("DE", None, None, None, None, None), ("DE", "1", "A", None, None, None)])
    assert ad.enrich(df).count() == 1
    assert ad.enrich(df.withColumn("lon", F.lit(None).cast("double"))).count() == 0


@pytest.mark.parametrize(("n", "cap", "sizes", "width"), [(10, 10, [10], 1), (11, 10, [6, 5], 1), (95, 10, [10] * 5 + [9] * 5, 2), (90, 10, [10] * 9, 1)])
def test_buckets(spark, n, cap, sizes, width):
    rows = raw(spark, [("DE", str(i), "A", None, None, None) for i in range(n)]).withColumn("h3_index", cells.parent(cells.synthetic((F.floor(F.col("id") / 7) % 3) * (8 * 7**5)), 5))
    got = ad.bucketed(ad.enrich(rows, "id"), "id", cap)
    by = [r["count"] for r in got.groupBy("bucket").count().orderBy("bucket").collect()]
    assert sorted(by, reverse=True) == sizes
    names = {r.bucket for r in got.select("bucket").distinct().collect()}
    assert names == ({"_"} if n <= cap else {str(i + 1).zfill(width) for i in range(len(sizes))})
    spans = got.groupBy("bucket").agg(F.min("h3_index").alias("a"), F.max("h3_index").alias("b")).orderBy("bucket").collect()
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))


def test_street_index_ignores_null_city(spark):
    agg = spark.createDataFrame([("DE", "t1", "a", None, 9, 1.0, 1.0), ("DE", "t2", "a", "X", 3, 2.0, 2.0), ("DE", "t3", "a", "Y", 2, 3.0, 3.0), ("DE", "t4", "a", "Y", 2, 3.0, 3.0)], "country string, h3_res4 string, street_lower string, city string, cnt int, centroid_lon double, centroid_lat double")
    r = ad.street_index(agg).first()
    assert (r.primary_city, r.addr_count, r.tiles) == ("X", 16, ["t1", "t2", "t3", "t4"])
    assert ad.street_index(agg, by_total=True).first().primary_city == "Y"


def test_city_index_splits_by_postcode_only_without_region(spark):
    agg = spark.createDataFrame([("DE", "t", "10115", "M", None, 1, 0.0, 1.0, 0.0, 1.0), ("DE", "t", "80331", "M", None, 1, 0.0, 1.0, 0.0, 1.0), ("DE", "t", "10115", "N", "R", 1, 0.0, 1.0, 0.0, 1.0), ("DE", "t", "80331", "N", "R", 1, 0.0, 1.0, 0.0, 1.0)], "country string, h3_res4 string, postcode string, city string, region string, cnt int, min_lon double, max_lon double, min_lat double, max_lat double")
    assert sorted((r.city, r.addr_count) for r in ad.city_index(agg).collect()) == [("M", 1), ("M", 1), ("N", 2)]


def test_numbers_are_text(spark):
    rows = raw(spark, [("DE", n, "A", None, None, None) for n in ("2", "10", "2", "", None)])
    assert ad.number_index(ad.enrich(rows, "id")).first().numbers == ["10", "2"]


def test_all_buckets_of_a_cell_are_probed(spark):
    rows = ad.bucketed(ad.enrich(raw(spark, [("DE", str(i), "A", None, None, None) for i in range(25)]), "id"), "id", 10)
    index = ad.tile_index(ad.bucket_stats(rows), ad.place_agg(rows))
    point = spark.createDataFrame([(1, 1.0, 2.0, CELL)], "id long, lon double, lat double, h3_index long")
    assert geocode.buckets_of(point, index).count() == 3
    assert [r.full_address for r in geocode.reverse(point, index, ad.tiles(rows), 2).orderBy("rank").collect()] == ["A 0", "A 1"]


def test_points_of_one_cell_are_spread(spark):
    rows = ad.bucketed(ad.enrich(raw(spark, [("DE", str(i), "A", None, None, None) for i in range(25)]), "id"), "id", 10)
    index = ad.tile_index(ad.bucket_stats(rows), ad.place_agg(rows))
    points = spark.range(20_001, numPartitions=1).withColumn("h3_index", F.when(F.col("id") < 20_000, CELL).otherwise(CELL + 1))
    found = geocode.buckets_of(points, index)
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 60_000 and max(tasks) < 30_000
    once = found.groupBy("bucket").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).collect()
    assert sorted((r.bucket, r.n, r.ids) for r in once) == [(str(b), 20_000, 20_000) for b in (1, 2, 3)]


@pytest.mark.parametrize("share", [1, 2, 512])
@pytest.mark.parametrize("country", [False, True])
def test_points_keep_their_rows(spark, monkeypatch, share, country):
    # equal points, points without a cell, cells nobody has, cells of several buckets and countries, a column that cannot be hashed
    monkeypatch.setattr(geocode, "SHARE", share)
    one = [cells.parent(cells.synthetic(F.lit(x)), 5) for x in (0, 8 * 7**5, 2 * 8 * 7**5, 1)]
    one = spark.range(1).select(*(c.alias(str(i)) for i, c in enumerate(one))).first()
    some = raw(spark, [(("DE", "FR")[i % 3 // 2], str(i), "A", None, None, None) for i in range(40)])
    some = some.withColumn("h3_index", F.when(F.col("id") < 25, one[0]).when(F.col("id") < 30, one[1]).otherwise(one[3]))
    rows = ad.bucketed(ad.enrich(some, "id"), "id", 10)
    index = ad.tile_index(ad.bucket_stats(rows), ad.place_agg(rows))
    asked = [(i, c, k, {"a": i}) for i, c in ((1, one[0]), (1, one[0]), (2, one[0]), (3, one[1]), (4, one[2]), (5, one[3]), (6, None), (7, one[0])) for k in (("DE", "FR", None) if country else ("-",))]
    points = spark.createDataFrame(asked, "id long, h3_index long, country string, more map<string, long>")
    got = geocode.buckets_of(points if country else points.drop("country"), index)
    assert got.columns == (["h3_res4", "country", "id", "h3_index", "more", "bucket"] if country else ["h3_res4", "id", "h3_index", "more", "country", "bucket"])
    parts = index.collect()
    tile = {c: format(c & ~cells.RESOLUTION_MASK | 4 << 52 | (1 << 33) - 1, "x") for c in one}
    right = [(i, c, m["a"], p.country, p.h3_res4, p.bucket) for i, c, k, m in asked for p in parts if c is not None and p.h3_res4 == tile[c] and p.h3_index_min <= c <= p.h3_index_max and k in ("-", p.country)]
    assert sorted((r.id, r.h3_index, r.more["a"], r.country, r.h3_res4, r.bucket) for r in got.collect()) == sorted(right)
    assert len(right) > 10


@pytest.mark.parametrize("most", [1, 3, 4, 100])
def test_lists_of_buckets_are_short_and_opened_last(spark, monkeypatch, most):
    monkeypatch.setattr(geocode, "LIST", most, raising=False)
    rows = ad.bucketed(ad.enrich(raw(spark, [(("DE", "FR")[i % 9 // 8], str(i), "A", None, None, None) for i in range(45)]), "id"), "id", 4)
    index = ad.bucket_stats(rows)
    found = geocode.buckets_of(spark.range(7).withColumn("h3_index", F.lit(CELL)), index)
    # the join meets lists, so that neither its sort nor its shuffle has a row for each share and bucket
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(_buckets") < plan.index("Join Inner")
    right = sorted((i, r.country, r.bucket) for i in range(7) for r in index.collect())
    assert sorted((r.id, r.country, r.bucket) for r in found.collect()) == right
    assert len(right) > 7 * 12


def test_bucket_lookup_leaves_out_regions(spark):
    plan = queries.QUERIES["bucket_lookup"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "h3_index_min" in plan and "region" not in plan
