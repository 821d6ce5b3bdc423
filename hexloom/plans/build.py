"""Whole builds: pyramids of a theme, and the geocoder in its present and its older layout."""

from __future__ import annotations

import contextlib
import logging
import os
import platform
import shutil
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.operators import addresses as ad
from hexloom.operators import pyramid
from hexloom.plans import themes
from hexloom.sources import features, scratch, sinks

log = logging.getLogger("hexloom")
VERSIONS = {"places": "v1", "transportation": "v1", "base": "v1", "buildings": "v1", "addresses": "v4", "addresses_v2": "v2"}
#: levels up to this one have some two million cells at most: one file each
ONE_FILE_RES = 5


def system_info(spark: SparkSession, folder: str = ".") -> dict[str, str]:
    """What a log should say of the driver's machine and of the cluster."""
    disk = shutil.disk_usage(folder)
    memory = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return {
        "system": f"{platform.system()} {platform.machine()}", "python": platform.python_version(), "spark": spark.version, "master": spark.sparkContext.master,
        "driver cpus": str(os.cpu_count()), "task slots": str(spark.sparkContext.defaultParallelism), "driver memory": f"{memory / 1e9:.1f} GB", "driver disk": f"{disk.free / 1e9:.1f} of {disk.total / 1e9:.1f} GB free",
    }


def memory_gb() -> float:
    """Greatest memory of the driver's Python process so far."""
    import resource

    peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    return peak / (1e9 if platform.system() == "Darwin" else 1e6)


@contextlib.contextmanager
def step(name: str, rows: dict | None = None):
    """Logs a step's seconds and the driver's memory, with the row counts put in ``rows``."""
    began, found = time.perf_counter(), {} if rows is None else rows
    log.info("%s: begins", name)
    yield found
    log.info("%s: %.1f s, %.1f GB in the driver%s", name, time.perf_counter() - began, memory_gb(), "".join(f", {k} {v:,}" for k, v in found.items()))


def target(out: str, theme: str, release: str) -> str:
    """Every theme has a folder of its own, so no theme overwrites another."""
    return f"{out.rstrip('/')}/{theme}-index/{VERSIONS[theme]}/release={release}"


def build_theme(spark: SparkSession, theme: str, source: str, out: str, release: str, files: int | None = None) -> dict[int, int]:
    """Writes the ten levels of a theme under ``h3/h3_res=N``; returns cells by resolution.

    ``files``: so many files a level; else one up to resolution 5 and ranges of cells beyond.
    """
    parts = [(pyramid.base_level(features.metric_rows(spark, source, f), f.spec), f.spec) for f in themes.FEATURES[theme]]
    finest = pyramid.merge_outer(parts) if len(parts) > 1 else parts[0][0]
    path = target(out, theme, release)

    def write(res: int, level: DataFrame) -> None:
        with step(f"{theme} resolution {res}"):
            sinks.write_level(level, f"{path}/h3/h3_res={res}", files or (1 if res <= ONE_FILE_RES else None))

    made = pyramid.each_level(finest, themes.SPECS[theme], write)
    log.info("%s: cells by resolution %s", theme, made)
    return made


def raw_addresses(spark: SparkSession, source: str) -> DataFrame:
    raw = features.scan(spark, source, "theme=addresses/type=address")
    names = ["country", "postcode", "street", "number", "unit", "postal_city", "address_levels"]
    if "id" not in raw.columns:
        # the same whichever way the files are split
        raw = raw.withColumn("id", F.xxhash64(*raw.columns))
    if "h3_index" in raw.columns:
        return raw.select("lon", "lat", "h3_index", *names, "id")
    return features.located(raw.select("geometry", *names, "id"), 5, *names, "id")


def build_addresses(spark: SparkSession, source: str, out: str, release: str, cap: int = ad.CAP, files: int | None = None) -> dict[str, int]:
    """Writes tiles, the seven lookup tables and the address levels; returns some row counts.

    The tiles are written first; everything else is an aggregate of the tiles as they were
    written, so nothing is held in memory and a lost executor costs its tasks only.
    """
    path, made = target(out, "addresses", release), {}
    with step("addresses: enrichment and tiles", made):
        enriched = scratch.written(ad.enrich(raw_addresses(spark, source), "id"), "enriched")
        log.info("coverage %s", coverage := ad.coverage(enriched).first().asDict())
        log.info("tiles %s, reference system %s", ad.tile_sizes(enriched, cap).first().asDict(), sinks.CRS)
        made["addresses"] = coverage["total_enriched"]
        sinks.write_tiles(ad.tiles(ad.bucketed(enriched, "id", cap)), f"{path}/geocoder")
    rows = spark.read.schema("lon double, lat double, postcode string, street string, number string, unit string, city string, region string, full_address string, h3_index long, street_lower string, geometry binary, country string, h3_res4 string, bucket string").parquet(f"{path}/geocoder")
    with step("addresses: aggregates"):
        agg = scratch.written(ad.place_agg(rows), "agg")
        index = scratch.written(ad.tile_index(ad.bucket_stats(rows), agg), "index")
    with step("addresses: lookup tables", made):
        sinks.write_table(index, f"{path}/tile_index", ["country", "h3_res4", "bucket"])
        sinks.write_table(ad.manifest(index, release), f"{path}/manifest", [F.desc("address_count"), F.col("country")])
        sinks.write_by_country(ad.street_index(ad.street_agg(rows)), f"{path}/street_index", ["street_lower"], files=files)
        sinks.write_by_country(ad.number_index(rows), f"{path}/number_index", ["street_lower"], sinks.NUMBER_ROWS, files)
        sinks.write_by_country(ad.postcode_index(agg), f"{path}/postcode_index", ["postcode"], files=files)
        sinks.write_table(ad.region_index(agg), f"{path}/region_index", ["country", "region"])
        sinks.write_by_country(ad.city_index(agg), f"{path}/city_index", ["city"], files=files)
        made["files"] = index.count()
    with step("addresses: levels"):
        levels = scratch.written(ad.address_levels(rows), "levels")
        for res in range(5, 0, -1):
            sinks.write_level(levels.where(F.col("res") == res).drop("res"), f"{path}/h3/h3_res={res}", files or 1)
    return made


def build_addresses_v2(spark: SparkSession, source: str, out: str, release: str) -> dict[str, int]:
    """The older layout: tiles by country and tile in cell order, their statistics and the manifest."""
    path, made = target(out, "addresses_v2", release), {}
    with step("addresses, older layout", made):
        rows = scratch.written(ad.enrich(raw_addresses(spark, source), "id").withColumnRenamed("h3_res4", "h3_parent"), "enriched")
        sinks.write_tiles_v2(rows, f"{path}/geocoder")
        stats = scratch.written(ad.tile_stats_v2(ad.place_agg(rows, "h3_parent")), "stats")
        sinks.write_table(stats, f"{path}/tile_index", ["country", "h3_parent"])
        sinks.write_table(ad.manifest_v2(stats, release), f"{path}/manifest", [F.desc("address_count"), F.col("country")])
        made |= {"addresses": rows.count(), "tiles": stats.count()}
    return made


def build(spark: SparkSession, names: list[str], source: str, out: str, release: str, files: int | None = None) -> list[str]:
    """Builds themes one after the other; a theme that fails is logged, the next goes on. Returns those that failed."""
    for k, v in system_info(spark).items():
        log.info("%s: %s", k, v)
    failed = []
    for name in names:
        jobs: dict[str, Callable] = {"addresses": lambda: build_addresses(spark, source, out, release, files=files), "addresses_v2": lambda: build_addresses_v2(spark, source, out, release)}
        try:
            with step(name):
                jobs.get(name, lambda n=name: build_theme(spark, n, source, out, release, files))()
        except Exception:
            log.exception("%s failed", name)
            failed.append(name)
    return failed


def writable(spark: SparkSession, out: str) -> None:
    """Fails early if nothing can be written under ``out``."""
    spark.range(1).selectExpr("cast(id as string) as value").write.mode("overwrite").text(f"{out.rstrip('/')}/_preflight")
