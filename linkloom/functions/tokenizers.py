"""Registry of analyzers: text to a list of index terms."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Analyzer = Callable[[str, frozenset[str]], list[str]]
MAX_TOKEN = 255  # longer tokens are left out

# Words by Unicode's word boundary classes: letters keep an inner apostrophe,
# dot or middle dot, digits an inner dot or comma, underscores join; an
# ideograph or a letter of Hiragana is a word by itself.
_MORE = r"[\p{WB=Extend}\p{WB=Format}\p{WB=ZWJ}]*+"
_LETTER, _DIGIT, _JOIN, _KANA = (rf"(?:{c}{_MORE})" for c in (r"[\p{WB=ALetter}\p{WB=Hebrew_Letter}]", r"\p{WB=Numeric}", r"\p{WB=ExtendNumLet}", r"\p{WB=Katakana}"))
_MID = r"[\p{WB=MidNumLet}\p{WB=Single_Quote}{0}]"
_IN_WORD = _MID.replace("{0}", r"\p{WB=MidLetter}") + _MORE
_IN_NUMBER = _MID.replace("{0}", r"\p{WB=MidNum}") + _MORE
_TOKEN = regex.compile(
    rf"{_JOIN}*+(?:(?:{_LETTER}(?:{_IN_WORD}(?={_LETTER}))?+|{_DIGIT}(?:{_IN_NUMBER}(?={_DIGIT}))?+)++|{_KANA}++)(?:{_JOIN}++(?:(?:{_LETTER}(?:{_IN_WORD}(?={_LETTER}))?+|{_DIGIT}(?:{_IN_NUMBER}(?={_DIGIT}))?+)++|{_KANA}++)?)*+"
    rf"|[\p{{Han}}\p{{Hiragana}}]{_MORE}",
)
_ELISION = re.compile(r"^(?:l|m|t|qu|n|s|j|d|c|jusqu|quoiqu|lorsqu|puisqu)['’]", re.I)
_VOWELS = frozenset("aeiou")


def _consonant(w: str, i: int) -> bool:
    c = w[i]
    return c not in _VOWELS and not (c == "y" and i > 0 and _consonant(w, i - 1))


def _measure(stem: str) -> int:
    """Number of changes from a vowel to a consonant."""
    kinds = [_consonant(stem, i) for i in range(len(stem))]
    return sum(b and not a for a, b in zip(kinds, kinds[1:]))


def _has_vowel(stem: str) -> bool:
    return any(not _consonant(stem, i) for i in range(len(stem)))


def _doubled(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _consonant(w, len(w) - 1)


def _cvc(w: str) -> bool:
    return len(w) > 2 and _consonant(w, len(w) - 1) and not _consonant(w, len(w) - 2) and _consonant(w, len(w) - 3) and w[-1] not in "wxy"


# The suffixes of steps 2 to 4 of the published algorithm (Porter 1980).
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _replace(w: str, table: tuple) -> str:  # longest suffix first
    for suffix, new in sorted(table, key=lambda x: -len(x[0])):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else w
    return w


@lru_cache(maxsize=1 << 16)
def porter(w: str) -> str:
    """Stem of a lower-case English word."""
    if len(w) < 3:
        return w
    if w.endswith("s"):
        w = w[:-2] if w.endswith(("sses", "ies")) else w if w.endswith("ss") else w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        for suffix in ("ed", "ing"):
            if w.endswith(suffix) and _has_vowel(w[: -len(suffix)]):
                w = w[: -len(suffix)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif _doubled(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif _measure(w) == 1 and _cvc(w):
                    w += "e"
                break
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _replace(_replace(w, _STEP2), _STEP3)
    for suffix in sorted(_STEP4, key=lambda x: -len(x)):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w) > 1 else w


def words_of(text: str) -> list[str]:
    return [w for w in _TOKEN.findall(text) if len(w) <= MAX_TOKEN]


def english(text: str, stop: frozenset[str]) -> list[str]:
    """Words without possessive endings, lower-cased, without stop words, stemmed."""
    words = (re.sub("['’＇][sS]$", "", w).lower() for w in words_of(text))
    return [porter(w) for w in words if w not in stop]


# Rules of the published light stemmer for French (Savoy 1999):
# least length of the word, ending, what takes its place; the first that fits is used.
_FRENCH = (
    (10, "issement", "ir"), (9, "issant", "ir"), (7, "ivement", "if"), (7, "ement", "e"), (12, "ficatrice", "fier"), (11, "ficateur", "fier"), (10, "catrice", "quer"), (9, "cateur", "quer"), (9, "atrice", "er"), (8, "ateur", "er"),
    (7, "trice", "teur"), (6, "ième", ""), (8, "teuse", "ter"), (7, "teur", "ter"), (6, "euse", "eu"), (9, "ère", "er"), (8, "ive", "if"), (5, "folle", "fou"), (5, "molle", "mou"),
    (10, "nnelle", "n"), (10, "nnel", "n"), (5, "ète", "et"), (9, "ique", ""), (9, "esse", ""), (8, "inage", "in"), (13, "ualisation", "uel"), (10, "isation", ""), (10, "isateur", ""), (9, "ation", ""), (9, "ition", ""),
)
_PLAIN = str.maketrans("àáâôèéêùûîç", "aaaoeeeuuic")


@lru_cache(maxsize=1 << 16)
def french_light(w: str) -> str:
    """Light stem of a lower-case French word: plural, derived endings, then accents, doubled letters and a last e or r."""
    if len(w) > 5 and w.endswith("aux") and w[-4] != "e":
        w = w[:-2] + "l"
    elif len(w) > 3 and w.endswith("x"):
        w = w[:-1]
    if len(w) > 3 and w.endswith("s"):
        w = w[:-1]
    for least, ending, new in _FRENCH:
        if len(w) >= least and w.endswith(ending):
            w = w[: -len(ending)] + new
            break
    if len(w) > 4:
        w = re.sub(r"([^\W\d_])\1+", r"\1", w.translate(_PLAIN))
    if len(w) > 4 and w.endswith("ie"):
        w = w[:-2]
    if len(w) > 4:
        w = re.sub("e?e?r?$", "", w)
        w = re.sub(r"([^\W\d_])\1$", r"\1", w)
    return w


def french(text: str, stop: frozenset[str]) -> list[str]:
    """Words without elisions, lower-cased, without stop words, lightly stemmed."""
    words = (_ELISION.sub("", w).lower() for w in words_of(text))
    return [french_light(w) for w in words if w and w not in stop]


def simple(text: str, stop: frozenset[str]) -> list[str]:
    """Words, lower-cased, without stop words."""
    return [w for x in words_of(text) if (w := x.lower()) not in stop]


ANALYZERS: dict[str, Analyzer] = {"en.EnglishAnalyzer": english, "fr.FrenchAnalyzer": french, "standard.StandardAnalyzer": simple, "en": english, "fr": french}


def register(name: str, analyzer: Analyzer) -> None:
    """Make an analyzer known under ``name``."""
    ANALYZERS[name] = analyzer


def analyzer_of(name: str) -> Analyzer:
    if name not in ANALYZERS:
        raise ValueError(f"unknown analyzer {name!r}; known are {', '.join(sorted(ANALYZERS))}")
    return ANALYZERS[name]


def analyze(text: Column, analyzer: str = "en.EnglishAnalyzer", stop_words: Collection[str] = ()) -> Column:
    """Terms in order, repeated ones kept: array<string>; null stays null. Stop words match by case."""
    run_one, stop = analyzer_of(analyzer), frozenset(stop_words)

    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: run_one(x, stop), na_action="ignore")

    return F.pandas_udf(run, T.ArrayType(T.StringType())).asNondeterministic()(text)
