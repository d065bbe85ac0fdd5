"""Text outputs: tab-separated lines, one folder of part files per relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.context import token_line, wiki_uri


def _lines(df: DataFrame, *columns: Column, path: str, sep: str = "\t", mode: str = "overwrite") -> None:
    df.select(F.concat_ws(sep, *[c.cast("string") for c in columns]).alias("value")).write.mode(mode).text(path)


def write_text(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    """Strings as they are, one per line."""
    df.select(F.col(f"`{column}`").alias("value")).write.mode(mode).text(path)


def write_pair_counts(pairs: DataFrame, path: str) -> None:
    """sf, std_uri, count: sorted by the target, then the form."""
    _lines(pairs.orderBy("std_uri", "sf"), F.col("sf"), F.col("std_uri"), F.col("count"), path=path)


def write_uri_counts(counts: DataFrame, path: str) -> None:
    """std_uri, count."""
    _lines(counts.orderBy("std_uri"), F.col("std_uri"), F.col("count"), path=path)


def write_sf_counts(counts: DataFrame, path: str) -> None:
    _lines(counts, F.col("sf"), F.col("count"), path=path, sep=",,")


def write_redirects(redirects: DataFrame, path: str) -> None:
    _lines(redirects, F.col("title"), F.col("target"), path=path, sep=",,")


def write_sf_total_counts(counts: DataFrame, path: str) -> None:
    """sf, link_count, text_count."""
    _lines(counts, F.col("sf"), F.col("link_count"), F.col("text_count"), path=path)


def write_mentions(mentions: DataFrame, path: str, min_contexts: int = 2) -> None:
    """The inverted index, from (``uri``, ``par_id``): a line per target with at
    least ``min_contexts`` mentions, sorted by target: the target and the
    numbers of its paragraphs, one as often as it mentions the target. A line
    holds all of a target's mentions, so those of one target meet in a task."""
    each = mentions.where("uri is not null").groupBy("uri").agg(F.array_sort(F.collect_list("par_id")).alias("ids")).where(F.size("ids") >= min_contexts)
    _lines(each.orderBy("uri"), F.col("uri"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",,"), path=path, sep=",,")


def write_token_counts(ranked: DataFrame, path: str, language: str = "en") -> None:
    """wiki uri, {(token,count),...}; a target without tokens has {}."""
    _lines(ranked, wiki_uri(F.col("uri"), language), token_line(F.col("tokens")), path=path)
