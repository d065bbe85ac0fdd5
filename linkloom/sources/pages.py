"""Page dumps as DataFrames: delimited scan, scan by number of lines, line index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path


def existing(spark: SparkSession, paths: Sequence[str] | str) -> list[str]:
    """The paths, patterns expanded, that are files; what is missing or a folder is left out."""
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        states = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []
        found += [s.getPath().toString() for s in states if s.isFile()]
    return found


# The first bytes of compressed files, and the extensions by which files are read as such.
COMPRESSED = {b"BZh": ".bz2", b"\x1f\x8b": ".gz"}


def named_by_content(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """The files under names that tell how they are compressed.

    A file is read by its extension; one whose first bytes tell otherwise (a
    gzip file named .xml, a plain one named .gz) is copied to the shared
    folder under a fitting name.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for file in files:
        path = jvm.org.apache.hadoop.fs.Path(file)
        fs = path.getFileSystem(conf)
        stream = fs.open(path)
        try:
            first = bytes(b for b in (stream.read() for _ in range(3)) if b >= 0)
        finally:
            stream.close()
        kind = next((x for magic, x in COMPRESSED.items() if first.startswith(magic)), "")
        if next((x for x in COMPRESSED.values() if file.endswith(x)), "") != kind:
            to = jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark)}/{path.getName().replace('.bz2', '').replace('.gz', '')}.dump{kind}")
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, path, to.getFileSystem(conf), to, False, conf)
            file = to.toString()
        out.append(file)
    return out


def page_of(record: Column, end: str) -> Column:
    """The page in what follows a start delimiter, without the lines of both delimiters."""
    return F.regexp_replace(F.regexp_replace(F.substring_index(record, end, 1), "^[^\\n]*\\n", ""), "\\r?\\n[^\\n]*\\z", "")


def read_pages(spark: SparkSession, paths: Sequence[str] | str, start: str = "<page>", end: str = "</page>", limit: int | None = None) -> DataFrame:
    """(``page``, ``path``): the text between lines that hold ``start`` and ``end``.

    The delimiters' lines are left out and lines joined by "\\n"; a page that
    isn't closed is dropped; missing paths are skipped. Plain, gzip and bzip2
    files, told apart by their first bytes, are read as UTF-8; plain and bzip2
    files are split among tasks. ``limit`` gives exactly so many pages, whichever they are.
    """
    files = named_by_content(spark, existing(spark, paths))
    if not files:
        return spark.createDataFrame([], "page string, path string")
    raw = spark.read.option("lineSep", start).text(files).select("value", F.col("_metadata.file_path").alias("path"))
    # A record is what follows a start; it holds a page if it also holds the end.
    pages = raw.where(F.contains("value", F.lit(end))).select(page_of(F.col("value"), end).alias("page"), "path")
    return pages.limit(limit) if limit is not None else pages


def with_line_numbers(df: DataFrame, order: Sequence[str], name: str = "line_no") -> DataFrame:
    """Number the rows from 1 in the order of ``order`` without gathering them.

    Rows are sorted by range and written with their place in the partition;
    the partitions' counts, one row each, give the offsets.
    """
    pid, place = F.shiftright("__mid", 33), F.col("__mid").bitwiseAND((1 << 33) - 1)
    placed = materialize(df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()))
    sizes = placed.groupBy(pid.alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    numbered = placed.withColumn("__pid", pid).join(F.broadcast(offsets), "__pid")
    return numbered.withColumn(name, place + F.col("__off") + 1).drop("__mid", "__pid", "__off")


def line_chunks(lines: DataFrame, order: Sequence[str], text: str = "line", size: int = 500) -> DataFrame:
    """(``chunk``, ``lines``, ``text``): chunks of ``size`` lines, each line with its "\\n".

    A line belongs to chunk floor(number / size), so chunk 0 has one line less.
    """
    numbered = with_line_numbers(lines, order).withColumn("chunk", F.floor(F.col("line_no") / size))
    each = numbered.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("line_no", F.col(f"`{text}`").alias("t")))).alias("l"))
    return each.select("chunk", F.size("l").cast("bigint").alias("lines"), F.concat(F.array_join(F.transform("l", lambda x: F.coalesce(x.t, F.lit(""))), "\n"), F.lit("\n")).alias("text"))


def read_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """(``line``, ``path``, ``pos``): the lines of text files; ``pos`` orders the lines of one file."""
    files = existing(spark, paths)
    if not files:
        return spark.createDataFrame([], "line string, path string, pos bigint")
    raw = spark.read.text(files).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("pos"))
    return raw.select("line", "path", (F.col("pos")).alias("pos"))


def read_words(spark: SparkSession, path: str) -> list[str]:
    """A word list, one word per line, as for stop words: small by nature, so it is kept on the driver."""
    return [r.line for r in read_lines(spark, path).select("line").collect()]


def read_redirects(spark: SparkSession, path: str) -> DataFrame:
    """(``title``, ``target``) from lines "title,,target"; lines of other shapes are skipped."""
    parts = F.split("value", ",,", -1)
    return spark.read.text(path).where(F.size(parts) == 2).select(parts[0].alias("title"), parts[1].alias("target"))


def read_uri_counts(spark: SparkSession, path: str) -> DataFrame:
    """(``std_uri``, ``count``) from tab-separated lines."""
    return spark.read.csv(path, sep="\t", schema="std_uri string, count bigint", quote="", escape="")


def read_sf_counts(spark: SparkSession, path: str) -> DataFrame:
    """(``sf``, ``count``) from lines "sf,,count"; lines that don't have two fields are skipped."""
    parts = F.split("value", ",,", -1)
    return spark.read.text(path).where(F.size(parts) == 2).select(parts[0].alias("sf"), parts[1].try_cast("bigint").alias("count"))
