"""Feature scans: one folder of Parquet files for each theme and type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions import cells, geometry
from hexloom.plans.themes import Feature, attributes


def scan(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """The files of one feature type. The folder itself is named, so its path adds no columns."""
    return spark.read.parquet(f"{root.rstrip('/')}/{folder}")


def anonymous_store(spark: SparkSession, bucket: str, region: str | None = None) -> None:
    """Reads a public bucket without credentials, and only that bucket."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(f"fs.s3a.bucket.{bucket}.aws.credentials.provider", "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider")
    if region:
        conf.set(f"fs.s3a.bucket.{bucket}.endpoint.region", region)


def located(features: DataFrame, res: int, *keep: str) -> DataFrame:
    """Features with a geometry, as lon, lat (of the centroid), h3_index and ``keep`` columns.

    A frame that has h3_index already keeps its cells. Geometries are taken to be in degrees.
    """
    if "h3_index" in features.columns:
        return features
    rows = features.where("geometry is not null").withColumn("_p", geometry.centroid(F.col("geometry")))
    rows = rows.select(*keep, F.col("_p.lon").alias("lon"), F.col("_p.lat").alias("lat"))
    return rows.withColumn("h3_index", cells.latlng_to_cell(F.col("lat"), F.col("lon"), res))


def metric_rows(spark: SparkSession, root: str, feature: Feature, res: int = 10) -> DataFrame:
    """h3_index and the attributes that the feature's metrics read; the scan reads only their columns."""
    raw = scan(spark, root, feature.folder)
    if "h3_index" in raw.columns:
        return attributes(raw, feature, "h3_index")
    return located(attributes(raw, feature, "geometry"), res, *feature.attributes)
