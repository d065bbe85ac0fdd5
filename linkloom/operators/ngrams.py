"""Word pieces, n-grams, and how often surface forms occur in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import DELIMITER_CLASS, NOT_DELIMITER_CLASS, let
from ..session import materialize

_WORD = "[\\p{L}\\p{M}][\\p{L}\\p{M}\\p{N}]*(?:(?<=[\\p{L}\\p{M}])['.\\-_](?=[\\p{L}\\p{M}])[\\p{L}\\p{M}\\p{N}]+)*"
PIECE = (
    "(?:[\\p{Sc}#](?=[0-9]))?(?:\\.(?=[0-9]))?[0-9]+(?:[.,'][0-9]+)*(?:[%&]|(?:" + _WORD + ")?)"
    "|" + _WORD + "|\\r\\n|[\\t\\p{Zs}&&[^\\u00A0]]+(?:\\r\\n|\\n)?|(?s)."
)


def pieces(text: Column) -> Column:
    """All pieces of a text in order, words and what lies between; joined they give the text again.

    Words keep inner apostrophes, dots, hyphens and underscores between
    letters; numbers keep currency signs, inner separators and a percent sign;
    a run of blanks is one piece and takes a line end that follows.
    """
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def _is_word(piece: Column) -> Column:
    """Longer pieces are words, runs of blanks included; of single characters those that are no delimiters."""
    return (F.length(piece) > 1) | ~piece.rlike(f"^{DELIMITER_CLASS}$")


def simple_words(text: Column) -> Column:
    """Runs of characters other than delimiters."""
    return F.regexp_extract_all(text, F.lit(f"{NOT_DELIMITER_CLASS}+"), F.lit(0))


def _shifted(words: Column, width: int) -> Column:
    """For each word the array of itself and those after it, as struct<w0, w1, ...>; nulls beyond the end."""
    parts = [words, *(F.slice(words, F.lit(k + 1), F.size(words)) for k in range(1, width))]
    return F.arrays_zip(*[p.alias(f"w{k}") for k, p in enumerate(parts)])


def with_ngrams(rows: DataFrame, text: str, name: str, width: int = 4) -> DataFrame:
    """One row per n-gram of 1 to ``width`` words, with the text between the
    words; an n-gram that a "." follows comes once more with it. The other columns stay.

    Each word carries what lies before the next one; words are zipped with
    their successors and n-grams follow by concatenation, in generated code.
    """
    keep = [c for c in rows.columns if c != text]

    def words(p: Column) -> Column:
        where = F.filter(F.transform(p, lambda x, i: F.when(_is_word(x), i + 1)), lambda i: i.isNotNull())

        def one(at: Column, first: Column, i: Column) -> Column:
            after = F.coalesce(F.get(at, i + 1), F.size(p) + 1)
            gap = F.array_join(F.slice(p, first + 1, after - first - 1), "")
            return F.struct(F.element_at(p, first).alias("t"), gap.alias("g"), F.coalesce(F.startswith(F.get(p, first), F.lit(".")), F.lit(False)).alias("d"))

        return let(where, lambda at: F.transform(at, lambda first, i: one(at, first, i)))

    each = rows.select(*keep, let(pieces(F.col(text)), words).alias("__w")).where(F.size("__w") > 0)
    each = each.select(*keep, F.explode(_shifted(F.col("__w"), width)).alias("__z"))
    grams, so_far = [], None
    for k in range(width):
        w = F.col(f"__z.w{k}")
        so_far = w["t"] if so_far is None else F.concat(so_far, F.col(f"__z.w{k - 1}")["g"], w["t"])
        grams += [so_far, F.when(w["d"], F.concat(so_far, F.lit(".")))]
    return each.select(*keep, F.explode(F.array(*grams)).alias(name)).where(F.col(name).isNotNull())


def with_simple_ngrams(rows: DataFrame, text: str, name: str, width: int = 4) -> DataFrame:
    """One row per n-gram of simple_words(), joined by single spaces. The other columns stay."""
    keep = [c for c in rows.columns if c != text]
    each = rows.select(*keep, simple_words(F.col(text)).alias("__w")).where(F.size("__w") > 0)
    each = each.select(*keep, F.explode(_shifted(F.col("__w"), width)).alias("__z"))
    grams = [F.col("__z.w0")]
    for k in range(1, width):
        grams.append(F.concat(grams[-1], F.lit(" "), F.col(f"__z.w{k}")))
    return each.select(*keep, F.explode(F.array(*grams)).alias(name)).where(F.col(name).isNotNull())


FORM_BYTES = 32 << 20  # forms up to this size are sent to every task


def text_counts(paragraphs: DataFrame, forms: DataFrame, paragraph: str = "paragraph", width: int = 4, simple: bool = False) -> DataFrame:
    """(``sf``, ``text_count``): how often each of the ``forms`` (column ``sf``) occurs as an n-gram; forms that never occur are missing.

    Where the forms are small, n-grams that are none are dropped before
    anything is shuffled; otherwise n-grams are counted per task, shuffled and
    met with the forms.
    """
    make = with_simple_ngrams if simple else with_ngrams
    grams = make(paragraphs.select(paragraph), paragraph, "sf", width)
    wanted = materialize(forms.select("sf").where("sf is not null").distinct())
    small = (wanted.agg(F.sum(F.octet_length("sf") + 16)).first()[0] or 0) <= FORM_BYTES
    if small:
        grams = grams.join(F.broadcast(wanted), "sf", "left_semi")
    counted = grams.groupBy("sf").agg(F.count(F.lit(1)).alias("text_count"))
    return counted if small else counted.join(wanted, "sf", "left_semi")


def sf_total_counts(sf_counts: DataFrame, paragraphs: DataFrame, paragraph: str = "paragraph", width: int = 4, simple: bool = False, mode: str = "compat") -> DataFrame:
    """(``sf``, ``link_count``, ``text_count``) with rows of lower-cased forms.

    Forms that don't occur get a text count of 0. A form that differs from its
    lower case, which isn't a form itself, adds a row with the lower case and
    a link count of -1. In mode "compat" that row has the text count of the
    cased form and may come several times; in mode "fixed" it comes once with
    the count of the lower case itself.
    """
    forms = sf_counts.select("sf", F.col("count").alias("link_count")).where("sf is not null")
    lowered = forms.select("sf", F.lower("sf").alias("low")).where("sf <> low")
    missing = lowered.join(forms.select(F.col("sf").alias("low")), "low", "left_anti")
    asked = forms.select("sf") if mode == "compat" else forms.select("sf").unionByName(missing.select(F.col("low").alias("sf")).distinct())
    counts = text_counts(paragraphs, asked, paragraph, width, simple)
    rows = forms.join(counts, "sf", "left").select("sf", "link_count", F.coalesce("text_count", F.lit(0)).alias("text_count"))
    if mode == "compat":
        low = missing.join(counts, "sf", "left").select(F.col("low").alias("sf"), F.lit(-1).cast("bigint").alias("link_count"), F.coalesce("text_count", F.lit(0)).alias("text_count"))
    else:
        low = missing.select(F.col("low").alias("sf")).distinct().join(counts, "sf", "left").select("sf", F.lit(-1).cast("bigint").alias("link_count"), F.coalesce("text_count", F.lit(0)).alias("text_count"))
    return rows.unionByName(low)
