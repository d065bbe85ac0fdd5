"""Parquet tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name``; it may be one file or a folder of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan for heavy work per row: where it has fewer partitions than the
    cluster has cores, as a small table of one row group, its rows are dealt
    out; a scan of many partitions stays as it is, without any shuffle."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
