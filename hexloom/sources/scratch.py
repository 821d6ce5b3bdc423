"""Working tables in the folder that all machines share, so that a lost executor costs only its tasks."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, SparkSession] = {}


def folder(spark: SparkSession, tag: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a local session without it uses its warehouse, a cluster is refused."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_hexloom_work"
    path = f"{base.rstrip('/')}/hexloom/{tag}-{uuid.uuid4().hex}"
    _made[path] = spark
    return path


def delete(*paths: str) -> None:
    """Removes working folders of this process."""
    for path in paths:
        if spark := _made.pop(path, None):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _sweep() -> None:
    # what results still read is kept until the process ends; by then the JVM may be gone
    for path in list(_made):
        with contextlib.suppress(Exception):
            delete(path)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once and read back: plans over it start at the files."""
    path = folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
