"""Fields of a raw page of a dump, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import plain_trim, standard_uri, unescape_xml

BODY_TAG = '<text xml:space="preserve">'


def is_wikitext(page: Column) -> Column:
    """Whether "wikitext" stands right after the first <model>; a page without a model is none."""
    return F.coalesce(F.startswith(F.regexp_extract(page, "(?s)<model>(.{0,8})", 1), F.lit("wikitext")), F.lit(False))


def title(page: Column) -> Column:
    """Unescaped text of the first <title>; null if there is none."""
    found = F.regexp_extract(page, "(?s)<title>(.*?)</title>", 1)
    return F.when(F.regexp_like(page, F.lit("(?s)<title>.*?</title>")), unescape_xml(found))


def redirects(page: Column) -> Column:
    return F.contains(page, F.lit("<redirect title="))


def redirect(page: Column) -> Column:
    """Unescaped target of the first redirect, without any double quotes; null if there is none."""
    found = F.regexp_extract(page, "(?s)<redirect title=(.*?)/>", 1)
    return F.when(redirects(page), unescape_xml(F.replace(plain_trim(found), F.lit('"'), F.lit(""))))


def body(page: Column, any_tag: bool = False) -> Column:
    """Text between the body tag and the first </text> of the page; null without.

    ``any_tag`` accepts other attributes in the tag.
    """
    tag = "<text[^>]*>" if any_tag else f"\\Q{BODY_TAG}\\E"
    pattern = f"(?s)^(?:(?!</text>).)*?{tag}(.*?)</text>" if any_tag else f"(?s){tag}(.*?)</text>"
    return F.when(F.regexp_like(page, F.lit(pattern)), F.regexp_extract(page, pattern, 1))


def first_line(page: Column) -> Column:
    return F.substring_index(page, "\n", 1)


def resolved_uri(page: Column, language: str = "en") -> Column:
    """Standard form of the redirect target, else of the title."""
    return standard_uri(F.coalesce(redirect(page), title(page)), None, language)


def with_fields(pages: DataFrame, page: str = "page", any_tag: bool = False) -> DataFrame:
    """Add ``title``, ``redirect``, ``is_wikitext`` and ``text`` read from the raw page; columns so named are replaced."""
    p = F.col(f"`{page}`")
    return pages.withColumns({"title": title(p), "redirect": redirect(p), "is_wikitext": is_wikitext(p), "text": body(p, any_tag)})
