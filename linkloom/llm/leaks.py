"""Evaluation texts leaking into training text: n-gram seeds, then local alignment."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import SMALL_BYTES, hot_keys, join_split, look_up, planned_bytes
from ..session import materialize, materialize_with

WORD = re.compile(r"[^\W_]+")
SEED_WORDS = 6  # words of a seed
MIN_WORDS = 12  # every run of so many words of an item holds a chosen seed
BROADCAST_BYTES = 32 << 20  # items up to this size go to the executors whole; beyond it seeds are joined by shuffle
MAX_BITS = 1 << 29  # of the bitmap of seeds
CHUNK_WORDS = 1 << 17  # words of documents that are aligned with an item at a time
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Maximal runs of letters and digits, lower-cased."""
    return WORD.findall(text.lower()) if text else []


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word) | 1  # never 0


def _seeds(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, as signed 64-bit numbers."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.int64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _MULT + h[j : j + n]
    return (out ^ (out >> np.uint64(29))).view(np.int64)


def _all_seeds(ids: pd.Series, texts: pd.Series, k: int, id_name: str, place: str) -> pd.DataFrame:
    """One row per run of k words of each text: its id, place and hash."""
    each = [_seeds(np.fromiter(map(_hash, words(t)), np.uint64), k) for t in texts]
    n = [len(s) for s in each]
    return pd.DataFrame({
        id_name: ids.repeat(n).reset_index(drop=True),
        place: np.concatenate([np.arange(x, dtype=np.int32) for x in n] or [np.empty(0, np.int32)]),
        "seed": np.concatenate(each or [np.empty(0, np.int64)]),
    })


def _item_seeds(items: DataFrame, k: int) -> DataFrame:
    """Seeds of each row: several texts of one item are told apart by ``version``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = _all_seeds(pd.Series(range(len(batch))), batch["itext"], k, "row", "ipos")
            of = batch[["item", "version"]].take(out["row"]).reset_index(drop=True)
            yield pd.concat([of, out[["ipos", "seed"]]], axis=1)

    kind = items.schema["item"].dataType.simpleString()
    return items.select("item", "version", "itext").mapInPandas(run, f"item {kind}, version bigint, ipos int, seed bigint")


def _hits_near(docs: DataFrame, kind: str, vocabulary: dict[str, int], seeds: np.ndarray, k: int) -> DataFrame:
    """Documents that hold a seed, with their hits: the seeds are on every executor."""
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, seeds))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, wanted = shared.value
        get = known.get
        for batch in batches:
            ids, texts, hits = [], [], []
            for i, t in zip(batch["doc"], batch["text"]):
                w = words(t)
                if len(w) < k:
                    continue
                h = np.array([get(x, 0) for x in w], np.uint64)
                inside = np.convolve(h == 0, np.ones(k, np.int32), "valid") == 0
                if not inside.any():
                    continue
                at = np.flatnonzero(inside)
                s = _seeds(h, k)[at]
                p = np.searchsorted(wanted, s)
                p[p == len(wanted)] = 0
                ok = wanted[p] == s
                if ok.any():
                    ids.append(i)
                    texts.append(t)
                    hits.append([{"dpos": int(x), "seed": int(y)} for x, y in zip(at[ok], s[ok])])
            yield pd.DataFrame({"doc": ids, "text": texts, "hits": hits}, dtype=object)

    return docs.mapInPandas(run, f"doc {kind}, text string, hits array<struct<dpos:int,seed:bigint>>")


def _seed_bits(seeds: DataFrame, n: int) -> np.ndarray:
    """A bit for each seed at its lowest bits: about 16 bits a seed and at most MAX_BITS, so its size is bounded whatever the items."""
    bits = min(MAX_BITS, 1 << max(16, (16 * n).bit_length()))
    place = F.col("seed").bitwiseAND(bits - 1) + 1
    parts = seeds.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.collect():
        at = (r.part - 1) * 4096
        own = np.frombuffer(bytes(r.bits), np.uint8)[: len(out) - at]
        out[at : at + len(own)] = own
    return out


def _hits_far(docs: DataFrame, kind: str, seeds: DataFrame, n: int, k: int) -> DataFrame:
    """The same by a shuffle, for items beyond the size that may be broadcast:
    a bitmap of the seeds leaves out nearly all that the items don't have
    before anything moves, and seeds of very many documents are met by
    broadcast, so none gathers in a task."""
    shared = docs.sparkSession.sparkContext.broadcast(_seed_bits(seeds, n))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        last = len(bits) * 8 - 1
        for batch in batches:
            every = _all_seeds(batch["doc"], batch["text"], k, "doc", "dpos")
            at = every["seed"].to_numpy() & last
            yield every[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]

    near = materialize(docs.mapInPandas(run, f"doc {kind}, dpos int, seed bigint"))
    hits = look_up(near, "seed", seeds.select("seed").distinct().withColumn("__there", F.lit(True)), "inner")
    per_doc = hits.groupBy("doc").agg(F.collect_list(F.struct("dpos", "seed")).alias("hits"))
    return docs.join(per_doc, "doc")


def align(doc: list[str], item: list[str], match: float = 1.0, mismatch: float = -1.0, gap: float = -1.0) -> tuple[float, int, int, int]:
    """Smith-Waterman over words: best score, its end in the document and in the
    item (words, exclusive), and the longest run of equal words."""
    ids: dict[str, int] = {}
    d = np.array([ids.setdefault(w, len(ids)) for w in doc], np.int64)
    it = np.array([ids.setdefault(w, len(ids)) for w in item], np.int64)
    n = len(d)
    slope = -gap * np.arange(n + 1)
    row, run = np.zeros(n + 1), np.zeros(n + 1, np.int64)
    best, at, until, longest = 0.0, 0, 0, 0
    for k, w in enumerate(it, 1):
        same = d == w
        new = np.zeros(n + 1)
        new[1:] = np.maximum(np.maximum(row[:-1] + np.where(same, match, mismatch), row[1:] + gap), 0.0)
        # gaps along the document: the best earlier cell less the way from it
        row = np.maximum.accumulate(new + slope) - slope
        after = np.zeros(n + 1, np.int64)
        after[1:] = np.where(same, run[:-1] + 1, 0)
        run = after
        j = int(row.argmax())
        if row[j] > best:
            best, at, until = float(row[j]), j, k
        longest = max(longest, int(run.max()))
    return best, at, until, longest


def align_all(docs: list[list[str]], item: list[str], least: float) -> list[tuple[int, int]]:
    """Score and longest run of equal words, as of ``align``, of an item and each of many documents.

    A part of a document scores no more than its words that the item has less
    those it hasn't. So the best alignment lies between two places where the
    sum of these (from 0 on, never below) is 0, and stretches in which it stays
    below ``least`` are left out: scores and runs of ``least`` or more are
    exact, lower ones may come out lower still.
    """
    ids: dict[str, int] = {}
    it = [ids.setdefault(w, len(ids)) for w in item]
    parts: list[np.ndarray] = []
    owner: list[int] = []
    gap = np.array([-2], np.int32)  # between two stretches
    for j, doc in enumerate(docs):
        codes = np.fromiter((ids.get(w, -1) for w in doc), np.int32, len(doc))
        total = np.concatenate(([0], np.cumsum(np.where(codes < 0, -1, 1))))
        total -= np.minimum.accumulate(total)
        zero = np.flatnonzero(total == 0)
        ends = np.append(zero[1:], len(doc))
        for x in np.flatnonzero(np.maximum.reduceat(total, zero) >= least):
            parts += [codes[zero[x] : ends[x]], gap]
            owner.append(j)
    found = [(0, 0)] * len(docs)
    if not owner:
        return found
    d = np.concatenate(parts)
    between = np.flatnonzero(d == -2)
    step = np.ones(len(d), np.int32)
    step[between] = len(it) + 1  # no score outlasts it
    slope = np.cumsum(step, dtype=np.int32)
    row, run = np.zeros(len(d) + 1, np.int32), np.zeros(len(d) + 1, np.int32)
    best, longest = np.zeros(len(d), np.int32), np.zeros(len(d), np.int32)
    for w in it:
        same = (d == w).astype(np.int32)
        new = np.maximum(row[:-1] + (2 * same - 1), row[1:] - 1)
        np.maximum(new, 0, out=new)
        new[between] = 0
        # gaps along the document: the best earlier cell less the way from it
        new += slope
        row[1:] = np.maximum.accumulate(new) - slope
        run[1:] = (run[:-1] + 1) * same
        np.maximum(best, row[1:], out=best)
        np.maximum(longest, run[1:], out=longest)
    starts = np.concatenate(([0], between[:-1] + 1))
    for j, x, y in zip(owner, np.maximum.reduceat(best, starts).tolist(), np.maximum.reduceat(longest, starts).tolist()):
        found[j] = max(found[j][0], x), max(found[j][1], y)
    return found


def _aligned(docs: list[list[str]], item: list[str], least: float) -> Iterator[tuple[int, int]]:
    """The same, a chunk of documents at a time."""
    lo, size = 0, 0
    for j, doc in enumerate(docs):
        size += len(doc)
        if size >= CHUNK_WORDS or j == len(docs) - 1:
            yield from align_all(docs[lo : j + 1], item, least)
            lo, size = j + 1, 0


_COLUMNS = ["doc", "item", "score", "exact_words", "item_words", "doc_words"]


def _aligned_near(docs: DataFrame, kind: str, ikind: str, rows: list[tuple], k: int, least: float) -> DataFrame:
    """Every document aligned with each item of ``rows`` that it shares a seed with: the items are on every executor, so no row moves."""
    vocabulary: dict[str, int] = {}
    seeds, owners = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    for x, (_, text) in enumerate(rows):
        w = words(text)
        for y in w:
            if y not in vocabulary:
                vocabulary[y] = _hash(y)
        s = np.unique(_seeds(np.fromiter((vocabulary[y] for y in w), np.uint64, len(w)), k))
        seeds.append(s)
        owners.append(np.full(len(s), x, np.int32))
    every, owner = np.concatenate(seeds), np.concatenate(owners)
    order = np.argsort(every, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((rows, vocabulary, every[order], owner[order]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, known, wanted, holder = shared.value
        get = known.get
        own = lru_cache(4096)(lambda x: words(items[x][1]))
        for batch in batches:
            ids, texts, near = list(batch["doc"]), [], defaultdict(list)
            for t in batch["text"]:
                w = words(t)
                if len(w) >= k:
                    h = np.array([get(x, 0) for x in w], np.uint64)
                    inside = np.convolve(h == 0, np.ones(k, np.int32), "valid") == 0
                    if inside.any():
                        s = _seeds(h, k)[inside]
                        lo, hi = np.searchsorted(wanted, s, "left"), np.searchsorted(wanted, s, "right")
                        for x in {x for a, b in zip(lo, hi) if a < b for x in holder[a:b].tolist()}:
                            near[x].append(len(texts))
                texts.append(w if len(w) >= k else [])
            out = []
            for x, places in near.items():
                it = own(x)
                for j, got in zip(places, _aligned([texts[j] for j in places], it, least)):
                    out.append((ids[j], items[x][0], float(got[0]), got[1], len(it), len(texts[j])))
            yield pd.DataFrame(out, columns=_COLUMNS, dtype=object)

    return docs.mapInPandas(run, f"doc {kind}, item {ikind}, score double, exact_words int, item_words int, doc_words int")


def _met(held: DataFrame, chosen: DataFrame, limit: int) -> DataFrame:
    """(doc, item, version) of the documents and items that share a seed; ``chosen`` goes to all tasks where it is small."""
    chosen, seen = materialize_with(chosen, size=F.sum(F.octet_length(F.col("item").cast("string")) + 32))
    met = held.join(F.broadcast(chosen), "seed") if (seen["size"] or 0) <= limit else join_split(held, chosen, "seed")
    return materialize(met.select("doc", "item", "version").distinct())


def _rare_pairs(held: DataFrame, seeds: DataFrame, limit: int, k: int, min_words: int) -> DataFrame:
    """Pairs of a document and an item that share the seed that fewest documents
    hold of some ``min_words`` words of the item: all pairs with an equal run of that length are among them."""
    common = held.groupBy("seed").agg(F.count(F.lit(1)).alias("docs"))
    # an item of fewer than min_words words keeps its rarest seeds as well
    window = Window.partitionBy("item", "version").orderBy("ipos").rangeBetween(0, min_words - k)
    ranked = seeds.join(common, "seed", "left").withColumn("pick", F.min(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "ipos", "seed")).over(window))
    return _met(held, ranked.where("pick.docs > 0").select("item", "version", F.col("pick.seed").alias("seed")).distinct(), limit)


def find_leaks(
    docs: DataFrame, items: DataFrame, doc: str = "doc_id", doc_text: str = "text", item: str = "item_id", item_text: str = "text", seed_words: int = SEED_WORDS, min_words: int = MIN_WORDS, min_score: float = 8.0, broadcast_bytes: int = BROADCAST_BYTES, exact: bool = False
) -> DataFrame:
    """Documents that hold passages of items: (``doc``, ``item``, ``score``, ``exact_words``, ``item_words``, ``doc_words``).

    One row per pair of a document and an item that share a run of
    ``seed_words`` words and align at least at ``min_score``. ``score`` is that
    of the best local alignment of the whole texts (a word that matches 1,
    another or a gap -1), so edited copies score too; ``exact_words`` is the
    longest run of equal words in the same order.
    Case and everything but letters and digits is ignored. A null or empty
    text holds nothing, rows without an id are left out; a document or item id that occurs twice gives the
    pair's row once per combination of differing rows. Extra columns are
    ignored.

    Seeds are the runs of ``seed_words`` words of the items; an item of fewer
    words has none and is never found. Each seed that a
    document holds nominates the pair, however many documents hold it.
    With ``exact`` only pairs with ``min_words`` equal words in a row are
    found; for these it is enough to look, in each run of ``min_words`` words
    of an item, at the seed that fewest documents hold.
    """
    if not 0 < seed_words <= min_words:
        raise ValueError("seed_words")
    k = seed_words
    least = min(min_score, k)  # a pair has a run of k words
    own = docs.select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{doc_text}`").alias("text")).where("doc is not null")
    kind, ikind = docs.schema[doc].dataType.simpleString(), items.schema[item].dataType.simpleString()
    test = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("itext")).where((F.octet_length("itext") >= 2 * k - 1) & F.col("item").isNotNull())
    test = test.withColumn("version", F.xxhash64("itext")).dropDuplicates(["item", "version"])
    n_bytes = test.agg(F.sum(F.octet_length("itext"))).first()[0] or 0
    small = n_bytes <= broadcast_bytes
    wanted = F.col("score") >= min_score
    names = {"doc": doc, "item": item}
    if small and not exact:
        rows = [(r[0], r[1]) for r in test.select("item", "itext").toLocalIterator()]
        return _aligned_near(own, kind, ikind, rows, k, least).where(wanted).withColumnsRenamed(names)
    seeds, seen = materialize_with(_item_seeds(test, k), n=F.count(F.lit(1)))
    if small:
        found = np.unique(np.array([r[0] for r in seeds.select("seed").distinct().toLocalIterator()], np.int64))
        if not len(found):
            found = np.zeros(1, np.int64)
        vocabulary = {w: _hash(w) for r in test.select("itext").toLocalIterator() for w in words(r[0])}
        suspects = _hits_near(own, kind, vocabulary, found, k)
    else:
        suspects = _hits_far(own.where("text is not null"), kind, seeds, seen["n"], k)
    suspects = materialize(suspects)
    held = suspects.select("doc", F.explode("hits").alias("h")).select("doc", "h.seed").distinct()
    if exact:
        pairs = _rare_pairs(held, seeds, broadcast_bytes, k, min_words)
        wanted &= F.col("exact_words") >= min_words
    else:
        pairs = _met(held, seeds.select("item", "version", "seed").distinct(), broadcast_bytes)
    cands = pairs.join(suspects.select("doc", "text"), "doc")
    if small:
        cands = cands.join(F.broadcast(test), ["item", "version"])
    else:  # an item may have come to very many documents
        key = F.struct("item", "version").alias("__key")
        hot = [] if planned_bytes(pairs) <= SMALL_BYTES else hot_keys(pairs.select(key), "__key")
        cands = look_up(cands.select("doc", "text", key), "__key", test.select(key, "itext"), "inner", hot=hot).select("doc", "__key.item", "text", "itext")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            near = defaultdict(list)
            for d, i, text, itext in zip(batch["doc"], batch["item"], batch["text"], batch["itext"]):
                near[itext].append((d, i, words(text)))
            out = []
            for itext, some in near.items():
                it = words(itext)
                for (d, i, w), got in zip(some, _aligned([x[2] for x in some], it, least)):
                    out.append((d, i, float(got[0]), got[1], len(it), len(w)))
            yield pd.DataFrame(out, columns=_COLUMNS, dtype=object)

    aligned = cands.select("doc", "item", "text", "itext").mapInPandas(run, f"doc {kind}, item {ikind}, score double, exact_words int, item_words int, doc_words int")
    return aligned.where(wanted).withColumnsRenamed(names)
