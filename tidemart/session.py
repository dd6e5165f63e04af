"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of these can be overridden by the cluster.
SETTINGS = {
    # Joins, partition counts and skewed partitions are decided on measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Commit markers make a table version visible.
    "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def builder(app_name: str, **settings: str):
    """A session builder with these settings and the given ones on top."""
    b = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **settings}.items():
        b = b.config(name, value)
    return b
