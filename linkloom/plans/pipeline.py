"""The whole run: one scan of the dump, every relation derived from it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import FOR_CONTEXTS, FOR_LINKS, FOR_NGRAMS, Clean
from ..functions.pages import with_fields
from ..functions.passes import body_passes
from ..operators import context, ngrams, pairs
from ..operators.redirects import closed_redirects, redirect_table
from ..session import materialize
from ..sources.pages import read_pages, read_words
from . import sinks
from .config import Config


@dataclass(frozen=True)
class LinkStats:
    """Relations of the first pass; ``closed``: the redirects followed to their ends."""

    titles: DataFrame
    redirects: DataFrame
    closed: DataFrame
    resolved: DataFrame


def _how(how: Clean, config: Config) -> Clean:
    return replace(how, filter_by_size=config.filter_by_size)


def parsed_pages(raw: DataFrame, config: Config = Config(), stop_words: list[str] = [], page: str = "page") -> DataFrame:  # noqa: B006
    """The dump read once for all passes: ``page_key``, ``title``, ``redirect``,
    ``is_wikitext``, and ``links``, ``grams``, ``contexts`` of body_passes().

    A page that comes again is a page of its own, as its ``page_key`` is its
    place in what is written here.
    """
    fields = with_fields(raw.select(F.col(f"`{page}`").alias("page")), any_tag=config.mode == "fixed")
    body = F.when(F.col("is_wikitext"), F.col("text"))
    passes = body_passes(body, _how(FOR_LINKS, config), _how(FOR_NGRAMS, config), _how(FOR_CONTEXTS, config), config.analyzer, stop_words)
    made = fields.select("title", "redirect", "is_wikitext", passes.alias("p"))
    return materialize(made.select(F.monotonically_increasing_id().alias("page_key"), "title", "redirect", "is_wikitext", "p.*"))


def _accepted(links: DataFrame, config: Config) -> DataFrame:
    return pairs.accepted_links(links, config.min_length_sf, config.max_length_sf, config.max_nb_token_sf)


def link_stats(pages: DataFrame, config: Config = Config()) -> LinkStats:
    """Redirects are taken from pages of any kind, titles and links from wikitext pages."""
    titles = pages.where("is_wikitext and title is not null").select("title").distinct()
    redirects = redirect_table(pages)
    closed = closed_redirects(redirects)
    raw = pairs.count_pairs(_accepted(pages.select(F.explode("links").alias("link")), config))
    resolved = pairs.resolved_pairs(raw, closed, titles, config.min_occurence_couple, closed=True)
    return LinkStats(titles, redirects, closed, materialize(resolved))


def paragraph_mentions(pages: DataFrame, stats: LinkStats, config: Config = Config()) -> DataFrame:
    """(``par_key``, ``uri``): the inverted index from paragraphs, a struct of page and place, to known targets."""
    par_key = F.struct("page_key", "pos").alias("par_key")
    links = pages.select("page_key", F.posexplode("contexts.links").alias("pos", "links")).select(par_key, F.explode("links").alias("link"))
    return context.known_mentions(_accepted(links, config), stats.closed, pairs.uri_counts(stats.resolved, config.language), "par_key", config.language, config.mode, closed=True)


def context_counts(pages: DataFrame, stats: LinkStats, config: Config = Config(), mentions: DataFrame | None = None) -> DataFrame:
    """(``uri``, ``tokens``) of the targets with enough mentions."""
    found = materialize(paragraph_mentions(pages, stats, config)) if mentions is None else mentions
    par_key = F.struct("page_key", "pos").alias("par_key")
    tokens = pages.select("page_key", F.posexplode("contexts.tokens").alias("pos", "tokens")).select(par_key, "tokens")
    counts = context.token_counts(found, tokens, "par_key", config.min_nb_contexts)
    return context.ranked_tokens(counts, context.qualifying(found, config.min_nb_contexts))


def form_counts(pages: DataFrame, stats: LinkStats, config: Config = Config()) -> DataFrame:
    paragraphs = pages.select(F.explode("grams").alias("paragraph"))
    return ngrams.sf_total_counts(pairs.sf_counts(stats.resolved), paragraphs, "paragraph", config.max_nb_token, mode=config.mode)


def run(spark: SparkSession, config: Config) -> dict[str, str]:
    """Read the dump, write every output, and return their folders by name.

    With a ``tmp_folder`` the redirects, the form counts and the inverted
    index are written there too; nothing is read back from them.
    """
    stop = read_words(spark, config.stop_words)
    pages = parsed_pages(read_pages(spark, config.dump_file), config, stop)
    stats = link_stats(pages, config)
    out = {n: f"{config.output_folder}{n}_{config.language}" for n in ("pairCounts", "uriCounts", "sfAndTotalCounts", "tokenCounts")}
    sinks.write_pair_counts(pairs.pair_counts(stats.resolved, config.language), out["pairCounts"])
    sinks.write_uri_counts(pairs.uri_counts(stats.resolved, config.language), out["uriCounts"])
    sinks.write_sf_total_counts(form_counts(pages, stats, config), out["sfAndTotalCounts"])
    found = materialize(paragraph_mentions(pages, stats, config))
    sinks.write_token_counts(context_counts(pages, stats, config, found), out["tokenCounts"], config.language)
    if config.tmp_folder:
        tmp = {n: f"{config.tmp_folder}tmp_{n}_{config.language}" for n in ("redirections", "surface_form_counts", "mentions")}
        sinks.write_redirects(stats.redirects, tmp["redirections"])
        sinks.write_sf_counts(pairs.sf_counts(stats.resolved), tmp["surface_form_counts"])
        sinks.write_mentions(context.numbered_paragraphs(found), tmp["mentions"], config.min_nb_contexts)
        out |= {f"tmp_{n}": path for n, path in tmp.items()}
    return out


def register_views(spark: SparkSession, pages: DataFrame, stats: LinkStats, language: str = "en") -> None:
    """Temporary views for SQL: pages, titles, redirects, pair_counts, uri_counts, sf_counts."""
    pages.createOrReplaceTempView("pages")
    stats.titles.createOrReplaceTempView("titles")
    stats.redirects.createOrReplaceTempView("redirects")
    pairs.pair_counts(stats.resolved, language).createOrReplaceTempView("pair_counts")
    pairs.uri_counts(stats.resolved, language).createOrReplaceTempView("uri_counts")
    pairs.sf_counts(stats.resolved).createOrReplaceTempView("sf_counts")


def map_pages(pages: DataFrame, work: Callable[[str], Iterator[str] | list[str]], page: str = "page") -> DataFrame:
    """(``output``): what a user's function gives for each page, none to many strings. Null pages are skipped."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"output": [o for x in batch["page"] for o in work(x)]}, dtype=object)

    return pages.select(F.col(f"`{page}`").alias("page")).where("page is not null").mapInPandas(each, "output string")
