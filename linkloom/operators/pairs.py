"""Counts of links: per pair of target and surface form, per target, per form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import links as L
from ..functions.cleaning import FOR_LINKS, Clean, paragraphs
from ..functions.text import standard_uri, upper_first
from ..session import materialize
from .lookup import look_up
from .redirects import resolve


def page_paragraphs(pages: DataFrame, key: str, how: Clean = FOR_LINKS, text: str = "text") -> DataFrame:
    """(``key``, ``pos``, ``paragraph``) of the wikitext pages with a body."""
    rows = pages.where("is_wikitext").where(F.col(text).isNotNull())
    if how.filter_by_size:  # cheap test before any Python
        rows = rows.where(F.length(text) * 2 >= how.min_chars)
    return rows.select(key, F.posexplode(paragraphs(F.col(text), how)).alias("pos", "paragraph"))


def paragraph_links(rows: DataFrame, paragraph: str = "paragraph", nested: bool = True, min_length: int = 2, max_length: int = 80, max_tokens: int = 4) -> DataFrame:
    """One row per accepted link of a paragraph: the other columns, ``uri`` and ``sf``; links that occur again come out again."""
    keep = [c for c in rows.columns if c != paragraph]
    found = rows.where(F.contains(paragraph, F.lit("[["))).select(*keep, F.explode(L.links(F.col(paragraph), nested)).alias("link"))
    return accepted_links(found, min_length, max_length, max_tokens)


def accepted_links(rows: DataFrame, min_length: int = 2, max_length: int = 80, max_tokens: int = 4) -> DataFrame:
    """Rows with a column ``link`` (struct<uri, sf>): the other columns, ``uri`` and ``sf`` of the links accepted."""
    found = rows.select(*[c for c in rows.columns if c != "link"], "link.uri", "link.sf")
    return found.where(L.accepted(F.col("uri"), F.col("sf"), min_length, max_length, max_tokens))


def count_pairs(links: DataFrame) -> DataFrame:
    """(``uri``, ``sf``, ``count``)."""
    return links.groupBy("uri", "sf").agg(F.count(F.lit(1)).alias("count"))


def resolved_pairs(raw: DataFrame, redirects: DataFrame, titles: DataFrame, min_count: int = 3, closed: bool = False) -> DataFrame:
    """(``uri``, ``sf``, ``count``) of the pairs kept, after redirects, whose target has a page.

    Pairs under ``min_count`` and forms that end with a comma go first, before
    redirects bring pairs together; nulls in uri or form are left out; targets
    get an upper-case first letter and must be among ``titles``. Rows that
    come to be the same pair are added up. ``closed`` says that ``redirects``
    comes from closed_redirects().
    """
    kept = raw.where(F.col("uri").isNotNull() & F.col("sf").isNotNull() & (F.col("count") >= min_count) & ~F.endswith("sf", F.lit(",")))
    kept = materialize(kept.select("uri", "sf", "count"))
    there = titles.select(F.col("title").alias("to")).where("to is not null").distinct()
    # distinct targets are resolved and tested, so that pairs take part in one look-up only
    moved = resolve(kept.select("uri").distinct(), "uri", redirects, closed=closed)
    moved = materialize(moved.select("uri", upper_first(F.col("resolved")).alias("to")).join(there, "to", "left_semi").select("uri", "to"))
    found = look_up(kept, "uri", moved, "inner")
    return found.groupBy(F.col("to").alias("uri"), "sf").agg(F.sum("count").alias("count"))


def pair_counts(resolved: DataFrame, language: str = "en") -> DataFrame:
    """(``sf``, ``std_uri``, ``count``); grouping stays on the raw target, so two targets may share a standard form."""
    return resolved.select("sf", standard_uri(F.col("uri"), None, language).alias("std_uri"), "count")


def uri_counts(resolved: DataFrame, language: str = "en") -> DataFrame:
    """(``std_uri``, ``count``), one row per raw target."""
    each = resolved.groupBy("uri").agg(F.sum("count").alias("count"))
    return each.select(standard_uri(F.col("uri"), None, language).alias("std_uri"), "count")


def sf_counts(resolved: DataFrame) -> DataFrame:
    """(``sf``, ``count``)."""
    return resolved.groupBy("sf").agg(F.sum("count").alias("count"))


def by_count(pairs: DataFrame) -> DataFrame:
    """Pairs from the most frequent down; ties by target and form."""
    return pairs.orderBy(F.desc("count"), "uri", "sf")
