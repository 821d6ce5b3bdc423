from pyspark.sql import functions as F

from hexloom.functions import cells
from hexloom.operators import pyramid
from hexloom.plans import themes


def buildings(spark):
    rows = [(i % 50, "house" if i % 3 else None, float(i % 7) if i % 4 else None, i % 5 if i % 6 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "x long, class string, height double, num_floors int")
    return df.select(cells.synthetic(F.col("x") * 31).alias("h3_index"), F.lit("civic").alias("subtype"), "class", F.lit(True).alias("has_parts"), "height", "num_floors")


def test_totals_are_kept(spark):
    spec, df = themes.BUILDINGS, buildings(spark)
    level = pyramid.base_level(df, spec)
    truth = df.agg(F.avg("height").alias("h"), F.max("height").alias("m"), F.avg("num_floors").alias("f")).first()
    for res in range(9, -1, -1):
        level = pyramid.roll_up(level, spec, res)
    r = pyramid.export(level, spec).agg(F.sum("building_count").alias("n"), F.sum("n_house").alias("house"), F.max("max_height_m").alias("m"), F.sum(F.col("avg_height_m") * F.col("n_with_height")).alias("hs"), F.sum("n_with_height").alias("hn")).first()
    assert r.n == 400 and r.house == df.where("class = 'house'").count() and r.m == truth.m and abs(r.hs / r.hn - truth.h) < 1e-5


def test_no_height_gives_null(spark):
    df = buildings(spark).withColumn("height", F.lit(None).cast("double"))
    r = pyramid.export(pyramid.base_level(df, themes.BUILDINGS), themes.BUILDINGS).first()
    assert r.avg_height_m is None and r.n_with_height == 0 and r.max_height_m is None


def test_merge_keeps_null_cells_apart(spark):
    a, b, c = (f.spec for f in themes.FEATURES["base"])
    one = spark.createDataFrame([(1, "power"), (None, "power"), (2, "pier")], "h3_index long, subtype string")
    two = spark.createDataFrame([(1, "golf"), (None, "park")], "h3_index long, subtype string")
    three = spark.createDataFrame([(3, "lake", True, None)], "h3_index long, subtype string, is_salt boolean, is_intermittent boolean")
    got = pyramid.merge_outer([(pyramid.base_level(one, a), a), (pyramid.base_level(two, b), b), (pyramid.base_level(three, c), c)])
    rows = sorted((r.h3_index or 0, r.infra_count, r.landuse_count, r.water_count, r.n_salt_water) for r in got.collect())
    assert rows == [(0, 0, 1, 0, 0), (0, 1, 0, 0, 0), (1, 1, 1, 0, 0), (2, 1, 0, 0, 0), (3, 0, 0, 1, 1)]


def test_exported_widths():
    assert {k: len(s.exported()) + 1 for k, s in themes.SPECS.items()} == {"places": 31, "transportation": 27, "base": 42, "buildings": 42}


def test_empty(spark):
    spec = themes.TRANSPORTATION
    df = spark.createDataFrame([], "h3_index long, subtype string, class string, surface string, is_bridge boolean, is_tunnel boolean, is_link boolean")
    assert pyramid.all_levels(pyramid.base_level(df, spec), spec).count() == 0
