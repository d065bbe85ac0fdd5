"""Pages that arrive as files: the same operators on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import FOR_LINKS
from ..functions.pages import with_fields
from ..operators.pairs import page_paragraphs, paragraph_links
from ..sources.pages import page_of


def stream_pages(spark: SparkSession, folder: str, end: str = "</page>", start: str = "<page>", max_files: int = 64) -> DataFrame:
    """(``page``): raw pages of the files that come to a folder, each file once."""
    raw = spark.readStream.option("lineSep", start).option("maxFilesPerTrigger", max_files).text(folder)
    return raw.where(F.contains("value", F.lit(end))).select(page_of(F.col("value"), end).alias("page"))


def stream_pair_counts(pages: DataFrame) -> DataFrame:
    """Running (``uri``, ``sf``, ``count``) of all links seen so far; write it in mode "complete" or "update".

    State holds one count per pair, as the batch result does.
    """
    fields = with_fields(pages).withColumn("page_key", F.xxhash64("page"))
    return paragraph_links(page_paragraphs(fields, "page_key", FOR_LINKS)).groupBy("uri", "sf").agg(F.count(F.lit(1)).alias("count"))


def start_to_table(counts: DataFrame, name: str, checkpoint: str):  # noqa: ANN201
    """Run what is there and stop: the counts of all files so far in the temporary table ``name``."""
    return counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
