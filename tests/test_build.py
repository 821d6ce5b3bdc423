import glob
import json
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hexloom.functions import geometry, grid
from hexloom.operators import geocode
from hexloom.plans import analog, build, cli, themes
from hexloom.sources import features, releases, sinks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("source"))
    analog.addresses(spark, SF).write.parquet(f"{root}/theme=addresses/type=address")
    analog.buildings(spark, SF).write.parquet(f"{root}/theme=buildings/type=building")
    return root


def test_theme(spark, source, tmp_path):
    made = build.build_theme(spark, "buildings", source, str(tmp_path), "r1")
    path = build.target(str(tmp_path), "buildings", "r1")
    assert sorted(made) == list(range(1, 11))
    for res in (10, 1):
        files = glob.glob(f"{path}/h3/h3_res={res}/*.parquet")
        assert len(files) == 1
        h = pq.read_table(files[0])["h3_index"].to_pylist()
        assert h == sorted(h) and len(h) == made[res]


def test_addresses(spark, source, tmp_path):
    made = build.build_addresses(spark, source, str(tmp_path), "r1", cap=100)
    path = build.target(str(tmp_path), "addresses", "r1")
    tiles = glob.glob(f"{path}/geocoder/country=*/h3_res4=*/bucket=*/*.parquet")
    assert len(tiles) == made["files"]
    streets = pq.ParquetFile(tiles[0]).read()["street_lower"].to_pylist()
    some = [s for s in streets if s is not None]
    assert streets == sorted(some) + [None] * (len(streets) - len(some))
    index = spark.read.parquet(f"{path}/tile_index")
    assert index.agg(F.sum("address_count")).first()[0] == made["addresses"] == sum(pq.ParquetFile(t).metadata.num_rows for t in tiles)
    found = geocode.forward(spark.read.parquet(f"{path}/street_index"), index, spark.read.parquet(f"{path}/geocoder"), "NL", some[0] if "NL" in tiles[0] else "building 1-urgent")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(street_lower," in plan and "PartitionFilters: [isnotnull(country" in plan and "CartesianProduct" not in plan
    for t in ("manifest", "postcode_index", "region_index", "city_index", "street_index", "number_index"):
        assert spark.read.parquet(f"{path}/{t}").count() > 0


def test_cli(spark, source, tmp_path):
    state = f"{tmp_path}/state/last.txt"
    args = ["--source", source, "--out", f"{tmp_path}/out", "--state", state, "--release", "r2"]
    assert cli.main([*args, "--dry-run"]) == 0 and not os.path.exists(f"{tmp_path}/out")
    assert cli.main([*args, "--themes", "places"], spark=spark) == 1 and releases.remembered(state) is None
    assert cli.main([*args, "--themes", "buildings"], spark=spark) == 0 and releases.remembered(state) == "r2"


def test_latest_release():
    link = lambda v, t="": {"rel": "child", "href": f"./{v}/catalog.json", "title": t}
    assert releases.latest("u", lambda _: {"links": [{"rel": "self"}, link("a"), link("b", "Latest one")]}) == "b"
    assert releases.latest("u", lambda _: {"links": [link("a"), link("b")]}) == "a"
    with pytest.raises(LookupError):
        releases.latest("u", lambda _: {"links": []})


def test_build_from_raw_geometry(spark, tmp_path):
    """No cells in the source: they come from WKB geometries."""
    lon, lat = (F.col("id") * 37 % 3600 - 1800) / 10.0, (F.col("id") * 91 % 1700 - 850) / 10.0
    raw = spark.range(400).withColumn("geometry", geometry.point(lon, lat))
    raw = raw.withColumn("geometry", F.when(F.col("id") % 50 > 0, F.col("geometry")))
    raw.select("geometry", F.lit("residential").alias("subtype"), F.lit("house").alias("class"), F.lit(True).alias("has_parts"), F.lit(3.0).alias("height"), F.lit(2).alias("num_floors")).write.parquet(f"{tmp_path}/theme=buildings/type=building")
    made = build.build_theme(spark, "buildings", str(tmp_path), f"{tmp_path}/out", "r")
    level = spark.read.parquet(f"{build.target(f'{tmp_path}/out', 'buildings', 'r')}/h3/h3_res=10")
    assert level.agg(F.sum("building_count")).first()[0] == 392 and made[10] == level.count()
    want = {int(x) for x in grid.encode(np.array([(i * 91 % 1700 - 850) / 10.0 for i in range(400) if i % 50]), np.array([(i * 37 % 3600 - 1800) / 10.0 for i in range(400) if i % 50]), 10)}
    assert {r.h3_index for r in level.collect()} == want
    # the same geometries as addresses, both layouts
    address = raw.select("geometry", F.lit("DE").alias("country"), F.lit("1").alias("postcode"), F.concat(F.lit("Street "), F.col("id") % 7).alias("street"), F.col("id").cast("string").alias("number"), F.lit(None).cast("string").alias("unit"), F.lit("X").alias("postal_city"), F.lit(None).cast("array<struct<value:string>>").alias("address_levels"))
    address.write.parquet(f"{tmp_path}/theme=addresses/type=address")
    assert build.build_addresses(spark, str(tmp_path), f"{tmp_path}/out", "r", cap=3)["addresses"] == 392
    assert build.build_addresses_v2(spark, str(tmp_path), f"{tmp_path}/out", "r")["addresses"] == 392
    files = glob.glob(f"{build.target(f'{tmp_path}/out', 'addresses_v2', 'r')}/geocoder/country=DE/h3_parent=*/*.parquet")
    cells_of = pq.read_table(files[0], partitioning=None)["h3_index"].to_pylist()
    assert cells_of == sorted(cells_of) and sum(pq.ParquetFile(f).metadata.num_rows for f in files) == 392


def test_tiles_are_geoparquet(spark, tmp_path):
    rows = spark.range(25_000).select((F.col("id") / 1000).alias("lon"), F.lit(2.0).alias("lat"), F.lit("DE").alias("country"), F.lit("t").alias("h3_res4"), F.lit("_").alias("bucket"), F.lpad(F.col("id").cast("string"), 6, "0").alias("street_lower"), F.lit("1").alias("number"))
    sinks.write_tiles(rows, f"{tmp_path}/t")
    (file,) = glob.glob(f"{tmp_path}/t/country=DE/h3_res4=t/bucket=_/*.parquet")
    got = pq.ParquetFile(file)
    assert [got.metadata.row_group(i).num_rows for i in range(got.num_row_groups)] == [10_000, 10_000, 5_000]
    assert sinks.read_crs(file) == "EPSG:4326" and sinks.read_crs(file, "street_lower") is None
    about = json.loads(got.metadata.metadata[b"geo"])
    assert about["primary_column"] == "geometry" and about["columns"]["geometry"]["encoding"] == "WKB"
    back = spark.read.parquet(f"{tmp_path}/t").withColumn("p", geometry.centroid(F.col("geometry")))
    assert back.where("p.lon = lon and p.lat = lat").count() == 25_000
    assert got.read()["street_lower"].to_pylist() == [f"{i:06d}" for i in range(25_000)]


def test_large_levels_and_countries_are_many_tasks(spark, tmp_path):
    level = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("h3_index"), F.lit(1).alias("n"))
    sinks.write_level(level, f"{tmp_path}/level", files=4)
    spans = sorted((min(c), max(c), c == sorted(c)) for f in glob.glob(f"{tmp_path}/level/*.parquet") for c in [pq.read_table(f)["h3_index"].to_pylist()])
    assert len(spans) == 4 and all(x[1] < y[0] for x, y in zip(spans, spans[1:])) and all(x[2] for x in spans)
    rows = spark.range(20_000).select(F.when(F.col("id") % 20 > 0, F.lit("DE")).otherwise(F.lit("NL")).alias("country"), F.md5(F.col("id").cast("string")).alias("postcode"))
    sinks.write_by_country(rows, f"{tmp_path}/by", ["postcode"], files=4)
    spans = sorted((min(c), max(c), c == sorted(c)) for f in glob.glob(f"{tmp_path}/by/country=DE/*.parquet") for c in [pq.read_table(f, partitioning=None)["postcode"].to_pylist()])
    assert len(spans) >= 3 and all(x[1] < y[0] for x, y in zip(spans, spans[1:])) and all(x[2] for x in spans)
    plan = level.repartitionByRange("h3_index")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h3_index" in plan and "SinglePartition" not in plan


def test_log_of_steps(spark, caplog):
    with caplog.at_level("INFO", "hexloom"), build.step("a step") as found:
        found["rows"] = 1234
    assert "a step" in caplog.text and "rows 1,234" in caplog.text
    about = build.system_info(spark)
    assert about["spark"] == spark.version and "GB" in about["driver memory"] and build.memory_gb() > 0


def test_anonymous_source(spark, source, tmp_path):
    args = ["--source", source, "--out", f"{tmp_path}/out", "--state", f"{tmp_path}/s", "--release", "r", "--themes", "buildings", "--anonymous", "some-bucket@us-west-2", "--files", "2"]
    assert cli.main(args, spark=spark) == 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert "Anonymous" in conf.get("fs.s3a.bucket.some-bucket.aws.credentials.provider") and conf.get("fs.s3a.bucket.some-bucket.endpoint.region") == "us-west-2"


def test_scan_reads_only_what_metrics_need(spark, source):
    feature = themes.FEATURES["buildings"][0]
    rows = features.metric_rows(spark, source, feature).drop("has_parts", "height")
    plan = rows.groupBy("h3_index").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<h3_index:bigint>" in plan
