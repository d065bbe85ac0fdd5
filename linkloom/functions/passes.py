"""All that the passes over a dump need of a page's body, in one crossing to Python."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import Clean, paragraphs_of
from .links import all_spans, outer_spans, read_link, strip_links_text
from .text import utf16_len
from .tokenizers import analyzer_of

MAX_PARAGRAPH = 5000  # fixed value: longer paragraphs (UTF-16 units) give no contexts

_LINKS = "array<struct<uri:string,sf:string>>"
PASSES = f"struct<links:{_LINKS},grams:array<string>,contexts:array<struct<links:{_LINKS},tokens:array<struct<token:string,n:bigint>>>>>"


def _links(spans: list[str]) -> list[dict]:
    return [{"uri": p[0], "sf": p[1]} for c in spans if (p := read_link(c))]


def body_passes(body: Column, for_links: Clean, for_ngrams: Clean, for_contexts: Clean, analyzer: str = "en.EnglishAnalyzer", stop_words: Collection[str] = ()) -> Column:
    """What three passes need of a body, as a struct: ``links``, those of all
    depths before the tests of accepted(); ``grams``, the paragraphs of which
    n-grams are counted; ``contexts``, for each paragraph with an outermost
    link its links and how often it holds each token. Arrays are null where
    the body is null or too short for the pass.
    """
    tokens_of, stop = analyzer_of(analyzer), frozenset(stop_words)

    def context(paragraph: str) -> dict | None:
        if "[[" not in paragraph or utf16_len(paragraph) > MAX_PARAGRAPH:
            return None
        found = _links(outer_spans(paragraph))
        if not found:
            return None
        tokens = Counter(tokens_of(strip_links_text(paragraph) or "", stop))
        return {"links": found, "tokens": [{"token": t, "n": n} for t, n in tokens.items()]}

    def one(text: str | None) -> tuple:
        whole = paragraphs_of(text, for_links)
        links = None if whole is None else [x for p in whole if "[[" in p for x in _links(all_spans(p))]
        around = paragraphs_of(text, for_contexts)
        return links, paragraphs_of(text, for_ngrams), None if around is None else [c for p in around if (c := context(p))]

    @F.pandas_udf(PASSES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([one(x) for x in batch], columns=["links", "grams", "contexts"], dtype=object)

    return run.asNondeterministic()(body)
