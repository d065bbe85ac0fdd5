"""Splitting oversized items at natural boundaries, with balanced targets."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokenizers

# Strength of the boundaries of a text, the strongest first; a cut is made after the match.
BOUNDARIES = (
    re.compile(r"\n[ \t]*\n\s*"),
    re.compile(r"\n\s*"),
    re.compile(r"[.!?…]+[\"'”’)\]]*\s+|[。！？]+[」』”]?\s*"),
    re.compile(r"[,;:]\s+|[、，；：]\s*"),
    re.compile(r"\s+"),
)


def split_text(text: str, limit: int, overlap: int, tokens: tokenizers.Tokens, reach: float = 0.15) -> list[tuple[int, int, int]]:
    """(start, end, number of tokens) of the pieces, in code points.

    The fewest pieces that can hold the text get targets of equal length; each
    target moves to the strongest boundary within ``reach`` of a piece, the
    nearest of the strongest. A piece repeats the last ``overlap`` tokens
    before its cut. If any piece is over the limit, pieces are added; a
    text that four times as many can't hold keeps half the overlap, and one
    that can't be held with none is halved anywhere.
    """
    return split_fitting(text, limit, overlap, tokens, reach)[0]


def split_fitting(text: str, limit: int, overlap: int, tokens: tokenizers.Tokens, reach: float = 0.15) -> tuple[list[tuple[int, int, int]], int, bool]:
    """The pieces of ``split_text``, the overlap they were cut with, and whether the text was halved anywhere."""
    ends = tokens.ends(text)
    n = len(ends)
    if n <= limit:
        return [(0, len(text), n)], overlap, False
    pieces = least = -(-(n - overlap) // (limit - overlap))
    while True:
        length = (n + (pieces - 1) * overlap) / pieces
        room = max(1, int(reach * length))  # a full window, also where the pieces are nearly full: more pieces are added then
        cuts, last = [], 0
        for j in range(1, pieces):
            target = round(length + (j - 1) * (length - overlap))
            lo, hi = max(last + 1, target - room), min(n - 1, target + room)
            if lo > hi:
                lo = hi = min(max(last + 1, target), n - 1)
            cut = _snap(text, ends, lo, min(max(target, lo), hi), hi)
            cuts.append(cut)
            last = bisect_right(ends, cut)
        starts = [0]
        for cut in cuts:
            k = bisect_right(ends, cut) - overlap
            starts.append(ends[k - 1] if k > 0 else 0)
        spans = list(zip(starts, [*cuts, len(text)]))
        sizes = [tokens.count(text[a:b]) for a, b in spans]
        if max(sizes) <= limit and all(a < b for a, b in spans):
            return [(a, b, s) for (a, b), s in zip(spans, sizes)], overlap, False
        pieces = max(pieces + 1, pieces * 51 // 50)
        if pieces > 4 * least or pieces > n:
            if overlap == 0:
                return _halves(text, limit, tokens), 0, True
            return split_fitting(text, limit, overlap // 2, tokens, reach)


def _halves(text: str, limit: int, tokens: tokenizers.Tokens) -> list[tuple[int, int, int]]:
    """Plain halving, for texts whose parts have more tokens by themselves than within the whole."""
    out, todo = [], [(0, len(text))]
    while todo:
        a, b = todo.pop()
        size = tokens.count(text[a:b])
        if size <= limit or b - a < 2:
            out.append((a, b, size))
        else:
            todo += [((a + b) // 2, b), (a, (a + b) // 2)]
    return out


def _snap(text: str, ends: list[int], lo: int, target: int, hi: int) -> int:
    """The cut (code points) for a target among the tokens lo..hi."""
    a, t, b = ends[lo - 1], ends[target - 1], ends[hi - 1]
    for kind in BOUNDARIES:
        found = [m.end() for m in kind.finditer(text, max(0, a - 1), b) if a <= m.end() <= b and 0 < m.end() < len(text)]
        if found:
            return min(found, key=lambda x: (abs(x - t), x))
    return t


def split_items(
    rows: DataFrame, item_id: str, text: str, limit: int = 2000, overlap: int = 200, only_oversized: bool = True, tokenizer: str = tokenizers.NAME, folder: str = tokenizers.FOLDER
) -> DataFrame:
    """(``item_id``, ``piece``, ``pieces``, ``start``, ``end``, ``n_tokens``, ``piece_text``, ``overlap``, ``halved``), one row per piece.

    ``piece`` counts from 0; ``start`` and ``end`` are code points of the
    text, so the pieces less their overlaps give the text back. No piece has
    more than ``limit`` tokens. ``overlap`` is the overlap that the text's
    pieces were cut with: less than asked for if the text can't be held
    within the limit otherwise, and 0 with ``halved`` if it was cut anywhere,
    regardless of boundaries. Texts within the limit come out whole, as
    piece 0 of 1, unless ``only_oversized``; null and empty texts then give
    one row with 0 tokens, and otherwise none. Rows with one id are split
    each for itself; extra columns are ignored.
    """
    if not 0 <= overlap < limit:
        raise ValueError("0 <= overlap < limit")
    own = rows.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    if only_oversized:
        own = own.where("text is not null")
        if tokenizers.byte_level(tokenizer):  # a token holds a byte at least: shorter texts can't be over the limit
            own = own.where(F.octet_length("text") > limit)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = tokenizers.load(folder, tokenizer)
        for batch in batches:
            out = []
            for i, t in zip(batch["id"], batch["text"]):
                spans, used, halved = split_fitting(t, limit, overlap, tokens) if t else ([(0, 0, 0)], overlap, False)
                if only_oversized and len(spans) < 2 and spans[0][2] <= limit:
                    continue
                out += [(i, k, len(spans), a, b, s, t[a:b] if t else t, used, halved) for k, (a, b, s) in enumerate(spans)]
            yield pd.DataFrame(out, columns=["id", "piece", "pieces", "start", "end", "n_tokens", "piece_text", "overlap", "halved"])

    kind = rows.schema[item_id].dataType.simpleString()
    done = own.mapInPandas(run, f"id {kind}, piece int, pieces int, start bigint, `end` bigint, n_tokens bigint, piece_text string, overlap int, halved boolean")
    return done.withColumnRenamed("id", item_id)
