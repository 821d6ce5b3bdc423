"""Parquet sinks: sorted levels, partitioned tiles and lookup tables.

Large tables are cut into ranges of their sort order, so that neither a level nor a country is
one task; small ones come out as one file. Sort orders are those that readers prune by. Tiles
with geometry are GeoParquet files.
"""

from __future__ import annotations

import json
import os
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.functions import geometry

LEVEL_ROWS, TILE_ROWS, NUMBER_ROWS, V2_TILE_ROWS = 1_000_000, 10_000, 2_000, 25_000
CRS = "EPSG:4326"


def _options(level: int, rows: int | None) -> dict[str, str]:
    given = {"compression": "zstd", "parquet.compression.codec.zstd.level": str(level), "parquet.writer.version": "v2"}
    return given | ({"parquet.block.row.count.limit": str(rows)} if rows else {})


def write_level(level: DataFrame, path: str, files: int | None = None) -> None:
    """A pyramid level in cell order: files of consecutive ranges of cells, one if the level is small.

    ``files``: that many; 1 sorts and writes the level in one task, which suits coarse levels.
    """
    if files == 1:
        rows = level.coalesce(1).sortWithinPartitions("h3_index")
    else:
        rows = level.repartitionByRange(*([files] if files else []), "h3_index").sortWithinPartitions("h3_index")
    rows.write.mode("overwrite").options(**_options(3, LEVEL_ROWS)).parquet(path)


def _dealt(rows: DataFrame, parts: list[str], order: list[Column]) -> DataFrame:
    """One task for each partition value."""
    return rows.repartition(*parts).sortWithinPartitions(*parts, *order)


def write_tiles(tiles: DataFrame, path: str) -> None:
    """Geocoder tiles: by country, tile and bucket; by street, then number, nulls last.

    A tile row's lon and lat are also its ``geometry``, a point. A bucket has a bounded number of
    rows, so each is one file of one task.
    """
    parts = ["country", "h3_res4", "bucket"]
    rows = tiles.withColumn("geometry", geometry.point(F.col("lon"), F.col("lat")))
    write_geoparquet(_dealt(rows, parts, [F.asc_nulls_last("street_lower"), F.asc_nulls_last("number")]), path, parts, 6, TILE_ROWS)


def write_tiles_v2(rows: DataFrame, path: str) -> None:
    """The older layout: by country and tile, in cell order, with geometry."""
    parts = ["country", "h3_parent"]
    rows = rows.withColumn("geometry", geometry.point(F.col("lon"), F.col("lat")))
    write_geoparquet(_dealt(rows, parts, [F.col("h3_index")]), path, parts, 6, V2_TILE_ROWS)


def write_table(rows: DataFrame, path: str, order: list[Column | str]) -> None:
    """A small table of one sorted file."""
    rows.coalesce(1).sortWithinPartitions(*order).write.mode("overwrite").options(**_options(3, None)).parquet(path)


def write_by_country(rows: DataFrame, path: str, order: list[str], row_group: int | None = None, files: int | None = None) -> None:
    """Hive folders by country; a large country in several files of consecutive ranges of ``order``."""
    keys = [F.col("country"), *(F.asc_nulls_last(c) for c in order)]
    dealt = rows.repartitionByRange(*([files] if files else []), *keys).sortWithinPartitions(*keys)
    dealt.write.mode("overwrite").options(**_options(3, row_group)).partitionBy("country").parquet(path)


def _geo(name: str) -> dict[bytes, bytes]:
    """File metadata that says which column holds points, and in which reference system (without ``crs``: EPSG:4326 axes lon, lat)."""
    return {b"geo": json.dumps({"version": "1.1.0", "primary_column": name, "columns": {name: {"encoding": "WKB", "geometry_types": ["Point"]}}}).encode()}


def _store(path: str):
    from pyarrow import fs

    address = path.replace("s3a://", "s3://", 1)
    if "://" in address:
        return fs.FileSystem.from_uri(address)
    return fs.LocalFileSystem(), os.path.abspath(address.removeprefix("file:"))


def _write_files(path: str, parts: list[str], names: list[str], level: int, row_group: int):
    def run(batches):
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        store, root = _store(path)
        task, made = TaskContext.get().partitionId(), []
        held, rows, value, writer, place = [], 0, None, None, ""

        def flush(last: bool) -> None:
            nonlocal held, rows
            while rows >= row_group or (last and rows):
                table = pa.Table.from_batches(held)
                writer.write_table(table.slice(0, row_group), row_group_size=row_group)
                table = table.slice(row_group)
                held, rows = table.to_batches(), len(table)

        def end() -> None:
            flush(True)
            writer.close()
            # whole file or none; a task that runs again replaces its files by the same rows
            store.move(f"{place}.{task}.part", place)

        for batch in batches:
            keys = list(zip(*(batch.column(p).to_pylist() for p in parts), strict=True))
            cuts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            for i, j in zip(cuts, [*cuts[1:], len(keys)], strict=True):
                if keys[i] != value:
                    if writer:
                        end()
                    value = keys[i]
                    folder = "/".join([root, *(f"{p}={v}" for p, v in zip(parts, value, strict=True))])
                    store.create_dir(folder, recursive=True)
                    place = f"{folder}/part-{task:05d}.zstd.parquet"
                    schema = batch.select(names).schema.with_metadata(_geo("geometry"))
                    writer = pq.ParquetWriter(store.open_output_stream(f"{place}.{task}.part"), schema, compression="zstd", compression_level=level, data_page_version="2.0")
                    made.append(place)
                held.append(pa.RecordBatch.from_arrays([batch.column(n).slice(i, j - i) for n in names], schema=schema))
                rows += j - i
                flush(False)
        if writer:
            end()
        yield pa.RecordBatch.from_pydict({"file": pa.array(made, pa.string())})

    return run


def write_geoparquet(rows: DataFrame, path: str, parts: list[str], level: int, row_group: int) -> int:
    """Writes rows that are dealt and sorted by ``parts`` as GeoParquet, one file for each value of a task; returns how many.

    Files of an earlier run are removed first. The folder may be on any file system that Arrow opens.
    """
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    names = [c for c in rows.columns if c not in parts]
    return rows.mapInArrow(_write_files(path, parts, names, level, row_group), "file string").count()


def read_crs(file: str, column: str = "geometry") -> str | None:
    """Reference system of a GeoParquet file's column; by the format's rule the plain lon, lat system if none is named."""
    import pyarrow.parquet as pq

    store, path = _store(file)
    about = json.loads((pq.read_metadata(path, filesystem=store).metadata or {}).get(b"geo", b"{}"))
    if column not in about.get("columns", {}):
        return None
    crs = about["columns"][column].get("crs")
    return f"{crs['id']['authority']}:{crs['id']['code']}" if crs else CRS
