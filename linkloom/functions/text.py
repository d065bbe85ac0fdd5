"""Scalar text functions as column expressions (JVM side), and the plain-Python
forms that the parsers share.

Fixed values that results depend on stand in CONSTANTS below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- CONSTANTS: fixed values -------------------------------------------------
# White space that is trimmed and separates words.
WHITE = "             　  \t\n\f\r\u000b\u001c\u001d\u001e\u001f"
# Punctuation that separates words.
PUNCTUATION = "!\"#%&'()*+,-./:;<=>?@[\\]^_`{|}~’“”‘…—"
# Escapes and what they stand for, the longest first.
ESCAPES = {
    "&amp;nbsp;": " ",
    "&amp;mdash;": "—",
    "&amp;ndash;": "–",
    "&amp;": "&",
    "&quot;": '"',
    "&apos;": "'",
    "&#039": "'",
    "&mdash;": "—",
    "&ndash": "–",
    "&nbsp;": " ",
}
# Characters of a target that are percent-encoded.
URI_ENCODED = {
    "%": "%25",
    '"': "%22",
    "#": "%23",
    "<": "%3C",
    ">": "%3E",
    "?": "%3F",
    "[": "%5B",
    "\\": "%5C",
    "]": "%5D",
    "^": "%5E",
    "`": "%60",
    "{": "%7B",
    "|": "%7C",
    "}": "%7D",
    "'": "%27",
}
# -----------------------------------------------------------------------------

CONTROL = "".join(map(chr, range(33)))  # what a plain trim removes


def _class(chars: str) -> str:
    """A character class for Java's and RE2's regular expressions.

    Java looks single characters under U+0100 up in a table and tests all else
    one by one, so only those beyond are joined to ranges.
    """
    spans: list[list[int]] = []
    for c in sorted(map(ord, set(chars))):
        if spans and c > 0x100 and c == spans[-1][1] + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "[" + "".join(f"\\x{{{a:X}}}" + (f"-\\x{{{b:X}}}" if b > a else "") for a, b in spans) + "]"


WHITE_CLASS = _class(WHITE)
DELIMITER_CLASS = _class(WHITE + PUNCTUATION)
# plain letters and digits first, so that most characters pass at the first test
NOT_DELIMITER_CLASS = "[a-zA-Z0-9[^" + DELIMITER_CLASS[1:] + "]"


def utf16_length(s: Column) -> Column:
    """Length in UTF-16 code units; null stays null."""
    return (F.octet_length(F.encode(s, "UTF-16BE")) / 2).cast("int")


def plain_trim(s: Column) -> Column:
    """Without leading and trailing characters up to U+0020."""
    return F.regexp_replace(s, "^[\\x00-\\x20]+|[\\x00-\\x20]+\\z", "")


def super_trim(s: Column) -> Column:
    """Without the white space of WHITE at both ends; null becomes empty."""
    return F.coalesce(F.regexp_replace(s, f"^{WHITE_CLASS}+|{WHITE_CLASS}+\\z", ""), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _one_upper(c: Column) -> Column:
    """Upper case of one character if that is one character; outside the basic plane it stays."""
    up = F.upper(c)
    return F.when((F.length(up) == 1) & (F.octet_length(c) < 4), up).otherwise(c)


def upper_first(s: Column) -> Column:
    """First letter in upper case; a string of one character fully so ("ß" gives "SS"); null and empty stay."""
    rest = lambda x: F.concat(_one_upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x)))
    return let(s, lambda x: F.when(utf16_length(x) <= 1, F.upper(x)).otherwise(rest(x)))


def before_number_sign(s: Column) -> Column:
    """Up to the first "#"."""
    return F.substring_index(s, "#", 1)


def nb_tokens(s: Column) -> Column:
    """Number of spaces that follow a character other than a space (words less one; a trailing space counts)."""
    return F.size(F.regexp_extract_all(s, F.lit("(?<=[^ ]) "), F.lit(0)))


def escape_title(s: Column) -> Column:
    """Space and tab as "_", then form encoding."""
    return F.url_encode(F.translate(s, " \t", "__"))


def standard_uri(uri: Column, prefix: str | None = None, language: str | None = "en") -> Column:
    """The standard form of a target.

    The part after the last "/" (unless it ends there) is decoded up to five
    times while it holds "%" (what can't be decoded stays), trimmed, runs of
    spaces and tabs become "_", nothing becomes "incorrect_uri", the first
    letter is upper-cased, URI_ENCODED is encoded, and the prefix is put in
    front. Null stays null.
    """
    if prefix is None:
        prefix = "http://dbpedia.org/resource/" if language in (None, "en") else f"http://{language}.dbpedia.org/resource/"
    s = let(uri, lambda u: F.when(F.contains(u, F.lit("/")) & ~F.endswith(u, F.lit("/")), F.substring_index(u, "/", -1)).otherwise(u))
    five = F.array(*[F.lit(i) for i in range(5)])
    s = F.aggregate(five, s, lambda x, _: F.when(F.contains(x, F.lit("%")), F.coalesce(F.try_url_decode(x), x)).otherwise(x))
    s = F.translate(F.regexp_replace(plain_trim(s), " +", "_"), "\t", "_")
    s = let(s, lambda x: F.when(x == "", F.lit("incorrect_uri")).otherwise(x))
    s = let(s, lambda x: F.concat(_one_upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x))))
    for char, code in URI_ENCODED.items():
        s = F.replace(s, F.lit(char), F.lit(code))
    return F.concat(F.lit(prefix), s)


def split_fields(s: Column, mark: str = ",,") -> Column:
    """Fields between ``mark``; a trailing empty field is dropped; strings of up to two characters stay whole."""
    parts = F.split(s, f"\\Q{mark}\\E", -1)
    cut = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.when(F.length(s) <= 2, F.array(s)).otherwise(cut)


def unescape(text: str | None) -> str | None:
    """Replace ESCAPES once from left to right, then trim. An "&" that begins
    none of them is deleted; an escape that ends the text is none."""
    if text is None:
        return None
    if "&" not in text:
        return text.strip(CONTROL)
    first, *rest = text.split("&")
    out, left = [first], len(text) - len(first)
    for part in rest:
        whole = "&" + part
        for mark, char in ESCAPES.items():
            if whole.startswith(mark) and left > len(mark):
                out.append(char + whole[len(mark) :])
                break
        else:
            out.append(part)
        left -= len(whole)
    return "".join(out).strip(CONTROL)


def unescape_xml(s: Column) -> Column:
    """unescape() on a column, without Python: the text is cut at each "&" and
    each part is held against what may follow one."""

    def part(p: Column, last: Column) -> Column:
        out = F.when(F.lit(False), p)
        for mark, char in ESCAPES.items():
            rest = mark[1:]
            out = out.when(F.startswith(p, F.lit(rest)) & ~(last & (p == rest)), F.concat(F.lit(char), F.substring(p, F.lit(len(rest) + 1), F.length(p))))
        return out.otherwise(p)

    def joined(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(part(p, i == F.size(parts) - 1))), "")

    return plain_trim(F.when(F.contains(s, F.lit("&")), let(F.split(s, "&", -1), joined)).otherwise(s))


def long_hash(s: str | None) -> int | None:
    """64-bit polynomial hash over UTF-16 code units with multiplier 31, as a signed number."""
    if s is None:
        return None
    h = 1125899906842597
    data = s.encode("utf-16-le", "surrogatepass")
    for i in range(0, len(data), 2):
        h = (31 * h + data[i] + 256 * data[i + 1]) & 0xFFFFFFFFFFFFFFFF
    return h - (1 << 64) if h >> 63 else h


def long_hash_column(s: Column) -> Column:
    """long_hash() on a column, without Python: two halves of 32 bits, so nothing overflows."""
    low = (1 << 32) - 1
    units = F.transform(F.regexp_extract_all(F.hex(F.encode(s, "UTF-16BE")), F.lit("(....)"), F.lit(1)), lambda x: F.conv(x, 16, 10).cast("bigint"))

    def step(h: Column, unit: Column) -> Column:
        new = h.lo * 31 + unit
        return F.struct((h.hi * 31 + F.shiftright(new, 32)).bitwiseAND(low).alias("hi"), new.bitwiseAND(low).alias("lo"))

    start = F.struct(F.lit(1125899906842597 >> 32).cast("bigint").alias("hi"), F.lit(1125899906842597 & low).cast("bigint").alias("lo"))
    return F.aggregate(units, start, step, lambda h: F.shiftleft(h.hi, 32).bitwiseOR(h.lo))


def utf16_len(s: str) -> int:
    """utf16_length() of a Python string."""
    return len(s) if s.isascii() else len(s) + sum(c > "￿" for c in s)
