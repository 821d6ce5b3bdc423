"""Shared working folder, lineage cuts and row keys.

Intermediate tables are written under the folder that the session names in
``spark.checkpoint.dir``; every executor and the driver see it, so a lost
executor costs only the tasks it ran. Where the setting is absent a local session (tests)
uses a folder under its warehouse, and a cluster is refused.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.sources import scratch

#: two 64-bit hashes that tell rows apart by id and text
KEY = ["row_a", "row_b"]
work_dir, delete = scratch.folder, scratch.delete


def discard(*frames: DataFrame | None) -> None:
    """Removes the files of materialized frames that nothing reads any more."""
    for df in frames:
        delete(*(getattr(df, "hexloom_paths", ()) if df is not None else ()))


@contextlib.contextmanager
def settings(spark: SparkSession, given: dict[str, str]):
    """Session settings for the actions inside, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in given}
    try:
        for k, v in given.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_batches(rows: int = 1024, size: int = 4 << 20) -> dict[str, str]:
    """Settings that bound the Arrow batches of an action: rows and bytes.

    Frames that are returned unevaluated run under the session's own (64 MiB by default).
    """
    return {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}


def materialize(df: DataFrame, tag: str, rows: int = 1024) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later plans start at the files."""
    spark = df.sparkSession
    path = work_dir(spark, tag)
    # the write's own shuffle files go when it ends
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"} | small_batches(rows)):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.hexloom_paths = (path,)
    return out


def named(name: str) -> Column:
    """The column of that very name, dots and back quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(key: str, text: str) -> list[Column]:
    """KEY columns: 128 bits of hash over the id and the text; null is unlike any value."""
    parts = [named(key).isNull(), named(key), named(text).isNull(), named(text)]
    return [F.xxhash64(F.lit(i), *parts).alias(name) for i, name in enumerate(KEY)]


def boxed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Each row of ``docs`` whole in a column ``row``, beside its KEY: no name can clash."""
    return docs.select(F.struct(*map(named, docs.columns)).alias("row"), *row_key(key, text))


def unboxed(names: list[str], *more: str) -> list[Column]:
    """The columns ``names`` out of ``row``, and ``more``."""
    return [*(F.col("row")[n].alias(n) for n in names), *(F.col(c) for c in more)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
