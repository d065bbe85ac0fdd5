"""Context tokens: the words of the paragraphs that mention a target."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import links as L
from ..functions.passes import MAX_PARAGRAPH
from ..functions.text import escape_title, standard_uri, upper_first, utf16_length
from ..functions.tokenizers import analyze
from ..session import materialize
from ..sources.pages import with_line_numbers
from .lookup import look_up
from .pairs import paragraph_links
from .redirects import resolve

PREFIX_LENGTH = 28  # fixed value: length of the English prefix, cut from every language's targets in mode "compat"


def known_keys(uri_counts: DataFrame, language: str = "en", mode: str = "compat") -> DataFrame:
    """(``key``): forms under which targets with a count are known to the context pass."""
    cut = PREFIX_LENGTH if mode == "compat" or language in ("en", None) else len(f"http://{language}.dbpedia.org/resource/")
    return uri_counts.select(F.substring("std_uri", F.lit(cut + 1), F.length("std_uri")).alias("key")).distinct()


def known_key(title: Column, language: str = "en", mode: str = "compat") -> Column:
    """The key of a title. Mode "compat" encodes it in another way than the
    targets are, so titles with characters such as "(" or "é" aren't found;
    mode "fixed" compares like with like."""
    return escape_title(title) if mode == "compat" else standard_uri(title, "", language)


def mentions(
    paragraphs: DataFrame, redirects: DataFrame, uri_counts: DataFrame, par_key: str = "par_key", language: str = "en", mode: str = "compat", min_length: int = 2, max_length: int = 80, max_tokens: int = 4
) -> DataFrame:
    """(``par_key``, ``uri``): outermost links of the paragraphs to known targets, a target as often as it is linked."""
    short = paragraphs.where(utf16_length(F.col("paragraph")) <= MAX_PARAGRAPH)
    found = paragraph_links(short.select(par_key, "paragraph"), nested=False, min_length=min_length, max_length=max_length, max_tokens=max_tokens)
    return known_mentions(found, redirects, uri_counts, par_key, language, mode)


def known_mentions(links: DataFrame, redirects: DataFrame, uri_counts: DataFrame, par_key: str = "par_key", language: str = "en", mode: str = "compat", closed: bool = False) -> DataFrame:
    """(``par_key``, ``uri``) of those links (``par_key``, ``uri``) whose target, after redirects, is known.

    Distinct targets are resolved and looked up first, so that the links take
    part in one look-up only. ``closed`` says that ``redirects`` comes from
    closed_redirects().
    """
    links = materialize(links.select(par_key, "uri"))
    moved = resolve(links.select("uri").where("uri is not null").distinct(), "uri", redirects, closed=closed)
    moved = moved.select("uri", upper_first(F.col("resolved")).alias("to")).withColumn("key", known_key(F.col("to"), language, mode))
    there = moved.join(known_keys(uri_counts, language, mode), "key", "left_semi").select("uri", "to")
    return look_up(links, "uri", materialize(there), "inner").select(par_key, F.col("to").alias("uri"))


def paragraph_tokens(paragraphs: DataFrame, par_key: str = "par_key", analyzer: str = "en.EnglishAnalyzer", stop_words: Collection[str] = ()) -> DataFrame:
    """(``par_key``, ``token``, ``n``): tokens of the paragraphs without their links' marks, counted per paragraph."""
    terms = paragraphs.select(par_key, F.explode(analyze(L.strip_links(F.col("paragraph")), analyzer, stop_words)).alias("token"))
    return terms.groupBy(par_key, "token").agg(F.count(F.lit(1)).alias("n"))


def qualifying(mentions: DataFrame, min_contexts: int = 2) -> DataFrame:
    """(``uri``, ``mentions``) of targets with at least ``min_contexts`` mentions; empty and single-space names go."""
    each = mentions.where("uri is not null and uri <> '' and uri <> ' '").groupBy("uri").agg(F.count(F.lit(1)).alias("mentions"))
    return each.where(F.col("mentions") >= min_contexts)


def token_counts(mentions: DataFrame, tokens: DataFrame, par_key: str = "par_key", min_contexts: int = 2) -> DataFrame:
    """(``uri``, ``token``, ``count``) with counts over 1.

    ``tokens`` has either one row per paragraph and token (``par_key``,
    ``token``, ``n``) or one row per paragraph with ``tokens``, an array of
    struct<token, n>. A target that a paragraph mentions twice counts the
    paragraph's tokens twice. Mentions are first counted per paragraph and
    target, tokens per paragraph, so the join multiplies small states instead
    of rows, and sums are combined before the last shuffle: neither a hub
    target nor a token gathers in one task.
    """
    good = qualifying(mentions, min_contexts).select("uri").withColumn("__there", F.lit(True))
    each = materialize(mentions.groupBy(par_key, "uri").agg(F.count(F.lit(1)).alias("times")))
    each = look_up(each, "uri", good, "inner").drop("__there")
    joined = each.join(tokens, par_key)
    if "tokens" in tokens.columns:
        joined = joined.select("uri", "times", F.inline("tokens"))
    return joined.groupBy("uri", "token").agg(F.sum(F.col("times") * F.col("n")).alias("count")).where("count > 1")


def ranked_tokens(counts: DataFrame, uris: DataFrame) -> DataFrame:
    """(``uri``, ``tokens``): array<struct<token, count>> from the largest count down, ties by token.

    Every row of ``uris`` (column ``uri``) comes out, with an empty array if it has no token.
    """
    each = counts.groupBy("uri").agg(F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("c"), "token"))).alias("l"))
    ranked = each.select("uri", F.transform("l", lambda x: F.struct(x.token.alias("token"), (-x.c).alias("count"))).alias("tokens"))
    empty = F.expr("cast(array() as array<struct<token:string,count:bigint>>)")
    return uris.select("uri").distinct().join(ranked, "uri", "left").select("uri", F.coalesce("tokens", empty).alias("tokens"))


def numbered_paragraphs(mentions: DataFrame, par_key: str = "par_key") -> DataFrame:
    """(``uri``, ``par_id``): the mentions with their paragraphs numbered from 1 in the order of ``par_key``."""
    numbers = with_line_numbers(mentions.select(par_key).distinct(), [par_key], "par_id")
    return mentions.join(numbers, par_key).select("uri", "par_id")


def token_line(tokens: Column) -> Column:
    """The array as text: {(token,count),(token,count)}."""
    return F.concat(F.lit("{"), F.array_join(F.transform(tokens, lambda x: F.concat(F.lit("("), x.token, F.lit(","), x["count"].cast("string"), F.lit(")"))), ","), F.lit("}"))


def wiki_uri(uri: Column, language: str = "en") -> Column:
    return standard_uri(uri, f"http://{language}.wikipedia.org/wiki/")
