"""Wiki text, still escaped as in the dump, to paragraphs of clean text.

A scanner jumps from one significant character to the next and copies what
lies between in one piece. The rules hold in the order in which they are tested.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .links import shown
from .text import ESCAPES, WHITE, utf16_len

_STOP = re.compile(r"[{}|\n&\-'=\[\]]")
_GT = "&gt;"


@dataclass(frozen=True)
class Clean:
    """What to leave out: list items, references, links (replaced by what they
    show), and pages of fewer than ``min_chars`` characters."""

    ignore_lists: bool = False
    ignore_refs: bool = False
    clean_links: bool = False
    filter_by_size: bool = True
    min_chars: int = 100


FOR_LINKS = Clean()
FOR_NGRAMS = Clean(True, True, True)
FOR_CONTEXTS = Clean(True, True, False)


def paragraphs_of(body: str | None, how: Clean = FOR_LINKS) -> list[str] | None:
    """Paragraphs of a page's body; None if there is no body or it is too short."""
    if body is None or (how.filter_by_size and utf16_len(body) < how.min_chars):
        return None
    s = "\n" + body
    end = len(s)
    last = end - 1  # the last character is looked at and never written
    out: list[str] = []
    buf: list[str] = []
    size = 0
    templates = tables = divs = links = link_at = 0
    in_list = in_comment = in_ref = in_tag = False
    at = 0

    def flush(always: bool) -> None:
        nonlocal size
        text = "".join(buf)
        buf.clear()
        n = utf16_len(text)
        if always or n > 1:
            size += n
            text = text.strip(WHITE)
            if utf16_len(text) > 1:
                out.append(text)

    gt_at = -1

    def next_gt(pos: int) -> int:
        """Where the next closing bracket from ``pos`` on stands; found once for all positions before it."""
        nonlocal gt_at
        if gt_at < pos:
            gt_at = s.find(_GT, pos)
            if gt_at < 0:
                gt_at = end
        return gt_at

    while at < last:
        muted = in_list or in_comment or in_ref or in_tag or divs > 0
        m = _STOP.search(s, at)
        stop = min(m.start() if m else last, last)
        if stop > at:
            if not muted and templates <= 0 and tables <= 0 and not (how.clean_links and links > 0):
                buf.append(s[at:stop])
            at = stop
            continue
        c, two = s[at], s[at : at + 2]
        # templates and tables: counters that may go below zero
        if two == "{{" or two == "}}":
            templates += 1 if c == "{" else -1
            at += 2
            continue
        if templates > 0:
            at += 1
            continue
        if two == "{|" or two == "|}":
            tables += 1 if c == "{" else -1
            at += 2
            continue
        if tables > 0:
            at += 1
            continue
        if c == "\n":
            if how.ignore_lists:
                if two[1] in "*#:":
                    in_list = True
                    at += 1
                    continue
                in_list = False
            if two[1] in "\n=" or (at and s[at - 1] == "="):
                flush(False)
        elif in_list:
            at += 1
            continue
        # comments and divs
        if c == "&" and two == "&l":
            if s.startswith("&lt;!--", at) and at + 7 < end:
                in_comment = True
                at += 7
                continue
            if s.startswith("&lt;div", at) and at + 7 < end:
                divs += 1
                at += 7
                continue
            if s.startswith("&lt;/div&gt;", at):
                divs = max(0, divs - 1)
                at += 12
                continue
        if two == "--" and s.startswith("--&gt;", at) and at + 6 < end:
            in_comment = False
            at += 6
            continue
        # bold, italics and heading marks: runs of two or more
        if two == "''" or two == "==":
            while at < end and s[at] == c:
                at += 1
            continue
        if how.clean_links:
            if two == "[[":
                links += 1
                at += 2
                if links == 1:
                    link_at = at
                continue
            if two == "]]":
                links -= 1
                if links == 0 and not in_ref and not in_comment:
                    buf.append(shown(s[link_at:at]) or "")
                at += 2
                continue
            if links > 0:
                at += 1
                continue
        if c == "&":
            if how.ignore_refs and two == "&l":
                if s.startswith("&lt;ref", at) and at + 7 < end:
                    in_ref = True
                    close = next_gt(at + 6)
                    close = close if close < end - 5 else max(at + 6, end - 5)
                    if s[close - 1] == "/":
                        in_ref = False
                        at = close + 4
                    else:
                        at += 7
                    continue
                if s.startswith("&lt;/ref&gt;", at) and at + 12 < end:
                    in_ref = False
                    at += 12
                    continue
            # other tags: up to 120 characters long
            if not in_ref and not in_comment and s.startswith("&lt;", at) and at + 4 < end and next_gt(at) < min(end, at + 120):
                in_tag = True
                at += 4
                continue
            if not in_ref and s.startswith(_GT, at) and at + 4 < end:
                in_tag = False
                at += 4
                continue
            muted = in_comment or in_ref or in_tag or divs > 0
            for mark, char in ESCAPES.items():
                if s.startswith(mark, at) and at + len(mark) < end:
                    if not muted:
                        buf.append(char)
                    at += len(mark)
                    break
            else:
                if not muted:
                    buf.append(c)
                at += 1
            continue
        if not (in_comment or in_ref or in_tag or divs > 0):
            buf.append(c)
        at += 1
    flush(True)
    return None if how.filter_by_size and size < how.min_chars else out


def paragraphs(body: Column, how: Clean = FOR_LINKS) -> Column:
    """paragraphs_of() on a column of bodies: array<string>, null where a page is left out."""

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: paragraphs_of(x, how), na_action="ignore")

    return F.pandas_udf(run, T.ArrayType(T.StringType())).asNondeterministic()(body)
