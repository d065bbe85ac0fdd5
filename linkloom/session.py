"""Session helpers: the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or the context's checkpoint folder.

    Where neither is set a temporary folder is used in local mode only; on a
    cluster that is an error, because executors would not share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="linkloom-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder; what is written there goes with release()."""
    path = f"{shared_folder(spark)}/linkloom/{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage and survives the loss of executors; unlike a cached
    table it is columnar, compressed and pruned on reading. The files are
    removed when the process ends, or by release().
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_with(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """materialize(), and aggregates over what was written, gathered by the
    writing job itself: ``materialize_with(df, rows=F.count(F.lit(1)))``."""
    seen = Observation()
    return materialize(df.observe(seen, *[c.alias(name) for name, c in metrics.items()])), seen.get


def release() -> None:
    """Remove every table that materialize() wrote."""
    while _written:
        spark, path = _written.pop()
        with contextlib.suppress(Exception):
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


atexit.register(release)
