"""Links in wiki text: generators of (target, surface form) and removal of links."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import CONTROL, nb_tokens, unescape, utf16_length

_PAIRED = re.compile(r"\[\[|\]\]")
_COUNTED = re.compile(r"\[\[|\](?=\])")
LINK_TYPE = T.ArrayType(T.StructType([T.StructField("uri", T.StringType()), T.StructField("sf", T.StringType())]))


def all_spans(text: str) -> list[str]:
    """Contents of all links; inner ones come before those around them; unmatched closings are skipped."""
    starts: list[int] = []
    out = []
    for m in _PAIRED.finditer(text):
        if m[0] == "[[":
            starts.append(m.end())
        elif starts:
            out.append(text[starts.pop() : m.start()])
    return out


def outer_spans(text: str) -> list[str]:
    """Contents of outermost links. Depth is a plain counter that a surplus of
    closings takes below zero; each further "]" of a run closes once more."""
    depth, start, out = 0, 0, []
    for m in _COUNTED.finditer(text):
        if m[0] == "[[":
            if depth == 0:
                start = m.end()
            depth += 1
        else:
            depth -= 1
            if depth == 0:
                out.append(text[start : m.start()])
    return out


def read_link(content: str) -> tuple[str, str] | None:
    """(target, surface form) of a link's content, or None if it is no article link."""
    if ":" in content or content.startswith("#"):
        return None
    content = content.strip(CONTROL)
    if content.endswith("|"):
        return None
    uri, pipe, form = content.partition("|")
    page, mark, _ = uri.partition("#")
    if mark:
        uri = page.strip(CONTROL)
    return uri, form if pipe else uri


def _generator(spans) -> Column:  # noqa: ANN001
    def run(s):  # noqa: ANN001, ANN202
        return s.map(lambda x: [{"uri": p[0], "sf": p[1]} for c in spans(x) if (p := read_link(c))] if x and "[[" in x else [])

    return F.pandas_udf(run, LINK_TYPE)


def links(paragraph: Column, nested: bool = True) -> Column:
    """array<struct<uri, sf>> of a paragraph's links before the tests of accepted()."""
    return _generator(all_spans if nested else outer_spans)(paragraph)


def flat_links(text: Column) -> Column:
    """The same for text whose links never nest, without Python."""
    found = F.filter(F.regexp_extract_all(text, F.lit("\\[\\[([^\\[\\]]*)\\]\\]"), F.lit(1)), lambda c: ~F.contains(c, F.lit(":")) & ~F.startswith(c, F.lit("#")))
    trimmed = F.filter(F.transform(found, lambda c: F.regexp_replace(c, "^[\\x00-\\x20]+|[\\x00-\\x20]+\\z", "")), lambda c: ~F.endswith(c, F.lit("|")))

    def pair(c: Column) -> Column:
        left = F.substring_index(c, "|", 1)
        uri = F.when(F.contains(left, F.lit("#")), F.regexp_replace(F.substring_index(left, "#", 1), "^[\\x00-\\x20]+|[\\x00-\\x20]+\\z", "")).otherwise(left)
        form = F.when(F.contains(c, F.lit("|")), F.regexp_replace(c, "^[^|]*\\|", "")).otherwise(uri)
        return F.struct(uri.alias("uri"), form.alias("sf"))

    return F.transform(trimmed, pair)


def accepted(uri: Column, sf: Column, min_length: int = 2, max_length: int = 80, max_tokens: int = 4) -> Column:
    """Tests of length, number of words and first characters that a link must pass."""
    size = utf16_length(sf)
    starts = "^[&\"('\\-]"
    return (uri != "") & (size >= min_length) & (size <= max_length) & (nb_tokens(sf) <= max_tokens) & ~uri.rlike(starts) & ~sf.rlike(starts) & ~F.contains(sf, F.lit("\t"))


def shown(content: str) -> str | None:
    """Text that a link shows: what follows the last pipe; None for a content with a ":"."""
    return None if ":" in content else unescape(content.rpartition("|")[2])


def strip_links_text(text: str | None) -> str | None:
    """Outermost links replaced by the text they show.

    Links with a ":" leave their closing brackets, nothing comes out while
    the depth isn't zero, and the last character of the text is dropped.
    """
    if text is None:
        return None
    out: list[str] = []
    depth = start = at = 0
    end = len(text) - 1  # the last character is looked at and never written
    while (m := _COUNTED.search(text, at)) and m.start() < end:
        if depth == 0:
            out.append(text[at : m.start()])
        at = m.end()
        if m[0] == "[[":
            if depth == 0:
                start = at
            depth += 1
            if depth == 0:
                out.append("[")
            continue
        depth -= 1
        if depth == 0:
            show = shown(text[start : m.start()])
            if show is None:
                out.append("]")
            else:
                out.append(show)
                at += 1
    if depth == 0:
        out.append(text[at:end])
    return "".join(out)


def strip_links(paragraph: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(strip_links_text, na_action="ignore"), T.StringType())(paragraph)
