"""Text that looks the same, written in different characters.

All spellings of a column, with their frequencies, are held in tries, many to
a trie. Each spelling that isn't plain ASCII traverses the trie of its shard
as a weighted edit automaton in which look-alike letters and ignorable
characters cost nothing and letters of nearly the same shape a little. Of the
spellings it reaches the most frequent clean one becomes the form of all that
look so; where none is clean, the form is made by the table of looks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import join_split, look_up
from ..operators.repeats import without_repeats
from ..session import materialize, materialize_with

# Letters of other scripts whose usual shape is that of a Latin letter.
CYRILLIC = dict(zip("аеорсухѕіјһѵүԁԛԝАВЕКМНОРСТХЅІЈҮԌԚԜ", "aeopcyxsijhvydqwABEKMHOPCTXSIJYGQW"))
GREEK = dict(zip("αινορυϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "aivopucjABEZHIKMNOPTYXCJ"))
ARMENIAN = dict(zip("օսհոցյզՕՍՏԼ", "ouhngjqOUSL"))
CHEROKEE = dict(zip("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏒᏔᏚᏙᏞᏟᏢᏦᏴ", "DRTAJEWMHGZRWSVLCPKB"))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
OTHERS = {"ɡ": "g", "ɑ": "a", "ı": "i", "Ӏ": "I", "‐": "-", "‑": "-"}
ALIKE = {**CYRILLIC, **GREEK, **ARMENIAN, **CHEROKEE, **LISU, **OTHERS}
# Letters of nearly the shape of a Latin one; reading one as the other costs NEAR.
NEARLY = dict(zip("σγκωητкптигьм", "oykwntknturbm"))
NEAR = 0.25
# Characters without a look of their own, beside the format characters (Cf).
IGNORABLE = {"͏", "ᅟ", "ᅠ", "឴", "឵", *map(chr, range(0xFE00, 0xFE10)), *map(chr, range(0x180B, 0x180F))}
# These change a shape although Unicode's compatibility forms drop it, so they stay as they are.
_KEEP = {"<super>", "<sub>", "<fraction>", "<circle>", "<square>", "<vertical>"}

PLAIN = r"\A[ -~]*\z"  # printable ASCII: looks of these characters all differ


def char_look(c: str) -> str:
    """The look of one character: "" if it has none, else base letters and marks, decomposed."""
    if c in IGNORABLE or unicodedata.category(c) == "Cf":
        return ""
    if c.isspace():
        return " "
    kind = unicodedata.decomposition(c).split(" ")[0]
    out = unicodedata.normalize("NFD" if kind in _KEEP else "NFKD", c)
    return "".join(" " if x.isspace() else ALIKE.get(x, x) for x in out)


class _Looks(dict):
    def __missing__(self, c: str) -> str:
        self[c] = out = char_look(c)
        return out


_LOOKS = _Looks()


def normalize_look(s: str) -> str:
    """The form by table alone: looks of all characters, composed."""
    return s if s.isascii() and s.isprintable() else unicodedata.normalize("NFC", "".join([_LOOKS[c] for c in s]))


def rough_look(s: str) -> str:
    """The look with nearly alike letters read as Latin: equal for all that the automaton can bring together at NEAR a letter."""
    return "".join([NEARLY.get(c, c) for c in normalize_look(s)])


@lru_cache(maxsize=1 << 16)
def _script(c: str) -> str:
    """Script of a letter, "" for all else; those that Japanese mixes count as one."""
    if not c.isalpha():
        return ""
    name = unicodedata.name(c, "?").split(" ")[0]
    return "CJK" if name in ("HIRAGANA", "KATAKANA", "CJK") else name


@lru_cache(maxsize=1 << 16)
def _clean_char(c: str) -> bool:
    if c in IGNORABLE or unicodedata.category(c) in ("Cf", "Cc"):
        return False
    return c == " " if c.isspace() else unicodedata.decomposition(c)[:1] != "<" or unicodedata.decomposition(c).split(" ")[0] in _KEEP


def is_clean(s: str) -> bool:
    """A spelling fit to be a form: composed, of ordinary characters, each word in letters of one script."""
    if s.isascii():
        return s.isprintable()
    if not all(map(_clean_char, s)) or unicodedata.normalize("NFC", s) != s:
        return False
    return all(len({x for x in map(_script, word) if x}) < 2 for word in s.split(" "))


class Trie:
    """Spellings by their own decomposed characters; an end holds the spelling and its weight."""

    __slots__ = ("root",)
    END, LOOKS = "", None  # keys of a node beside its characters

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, spelling: str, weight: int) -> None:
        node = self.root
        for c in spelling if spelling.isascii() else unicodedata.normalize("NFD", spelling):
            node.pop(self.LOOKS, None)
            node = node.setdefault(c, {})
        node.setdefault(self.END, {})[spelling] = weight

    def _by_look(self, node: dict) -> dict[str, list[tuple[str, dict]]]:
        """A node's edges by the first character of their look, kept for the next text that comes by."""
        out = node.get(self.LOOKS)
        if out is None:
            out = {}
            for c, child in node.items():
                if c:
                    own = _LOOKS[c]
                    out.setdefault(own[:1], []).append((own, child))
            node[self.LOOKS] = out
        return out

    def _reach_free(self, look: str) -> dict[str, tuple[float, int]]:
        """The spellings reached at no cost: edges that look like what comes next, and those without a look."""
        end, out = len(look), {}
        todo: list[tuple[int, dict]] = [(0, self.root)]
        while todo:
            i, node = todo.pop()
            edges = self._by_look(node)
            if i < end:
                for own, child in edges.get(look[i], ()):
                    if len(own) == 1 or look.startswith(own, i):
                        todo.append((i + len(own), child))
            elif self.END in node:
                out.update((s, (0.0, w)) for s, w in node[self.END].items())
            for _, child in edges.get("", ()):
                todo.append((i, child))
        return out

    def reach(self, text: str, budget: float = 0.0) -> dict[str, tuple[float, int]]:
        """The spellings that ``text`` reaches at up to ``budget``: spelling -> (cost, weight).

        An edge is taken at no cost where its character looks like the next
        of the text, and where it has no look; at NEAR where one letter is
        nearly the other; at 1 instead of any character, before one, or by
        leaving one out. A character may look like several, as a ligature.
        """
        look = unicodedata.normalize("NFD", normalize_look(text))
        if budget < NEAR:
            return self._reach_free(look)
        end = len(look)
        todo: list[tuple[float, int, dict]] = [(0.0, 0, self.root)]
        best: dict[tuple[int, int], float] = {}
        out: dict[str, tuple[float, int]] = {}
        while todo:
            cost, i, node = todo.pop()
            key = (id(node), i)
            if best.get(key, budget + 1) <= cost:
                continue
            best[key] = cost
            if i == end and self.END in node:
                for spelling, weight in node[self.END].items():
                    if spelling not in out or out[spelling][0] > cost:
                        out[spelling] = (cost, weight)
            if cost + 1 <= budget and i < end:
                todo.append((cost + 1, i + 1, node))
            for c, child in node.items():
                if not c:
                    continue
                own = _LOOKS[c]
                if look.startswith(own, i):  # "" as well: no look, no step
                    todo.append((cost, i + len(own), child))
                elif cost + NEAR <= budget and i < end and (NEARLY.get(own, own) == NEARLY.get(look[i], look[i])):
                    todo.append((cost + NEAR, i + 1, child))
                if cost + 1 <= budget:
                    todo.append((cost + 1, i, child))
                    if i < end:
                        todo.append((cost + 1, i + 1, child))
        return out

    def canonical(self, text: str, budget: float = 0.0) -> str | None:
        """The clean spelling reached at the least cost, plain ASCII before others, then the heaviest, then the smallest; None without."""
        found = [(cost, not s.isascii(), -weight, s) for s, (cost, weight) in self.reach(text, budget).items() if is_clean(s)]
        return min(found)[3] if found else None


SHARD = 1000  # spellings asked for to a trie, about


def canonical_spellings(rows: DataFrame, columns: list[str], budget: float = 0.0, weight: str | None = None) -> DataFrame:
    """(``column``, ``value``, ``canonical``) for every distinct non-plain value of ``columns``; plain values stand for themselves.

    A column's vocabulary is dealt to tries by a hash of its spellings' rough
    look, so all that look alike meet, a few thousand spellings come to a
    trie, and no trie is hot whatever the data. Only plain spellings that
    can't be reached, as none that is asked for has their length, begin and
    end, are left out (with a ``budget`` of 1 or more, which changes lengths,
    none). ``weight`` names a column with the number of times a row counts. An
    empty string and a null are plain.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    each = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns]))
    words = rows.select(each, times.alias("n")).where("value is not null").groupBy("column", "value").agg(F.sum("n").alias("n"))
    words = materialize(words.withColumn("plain", F.col("value").rlike(PLAIN)))
    rough = F.pandas_udf(lambda s: s.map(rough_look), T.StringType())
    odd, seen = materialize_with(words.where("not plain").withColumn("rough", rough("value")), n=F.count(F.lit(1)))
    # plain words of a length, begin and end that no word asked for has can't be reached and need not be in a trie
    part = F.xxhash64("column", F.length("rough"), F.substring("rough", 1, 3), F.substring("rough", -5, 5)).alias("part")
    near = words.where("plain").withColumn("rough", F.col("value"))
    if budget < 1:
        near = near.withColumn("part", part).join(odd.select(part).distinct(), "part", "left_semi").drop("part")
    shards = seen["n"] // SHARD + 1
    keyed = near.unionByName(odd).withColumn("shard", F.pmod(F.xxhash64("column", "rough"), F.lit(shards)).cast("int")).drop("rough")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a shard comes in one piece, perhaps over several batches
        trie, asked, at = Trie(), [], None

        def answer() -> pd.DataFrame:
            out = [(c, v, trie.canonical(v, budget) or normalize_look(v)) for c, v in asked]
            return pd.DataFrame(out, columns=["column", "value", "canonical"], dtype=object)

        for batch in batches:
            for shard, column, value, n, plain in zip(batch["shard"], batch["column"], batch["value"], batch["n"], batch["plain"]):
                if (shard, column) != at:
                    if asked:
                        yield answer()
                    trie, asked, at = Trie(), [], (shard, column)
                trie.add(value, n)
                if not plain:
                    asked.append((column, value))
        if asked:
            yield answer()

    parts = keyed.repartition("shard").sortWithinPartitions("shard", "column")
    return parts.select("shard", "column", "value", "n", "plain").mapInPandas(run, "column string, value string, canonical string")


def consistent_form(rows: DataFrame, *columns: str, suffix: str = "_form", budget: float = 0.0, by_table: bool = False) -> DataFrame:
    """Add ``<column><suffix>`` with the consistent form of each column.

    Rows, order of columns and extra columns stay; a null stays null; columns
    already named so are replaced. Values that look the same get one form: the
    plain ASCII spelling if the column has it, else the most frequent clean
    one, else the table's: letters of other scripts and full-width forms as
    the Latin letters they look like, accents composed, every space as a
    space, characters without a look dropped. Case, accents and runs of spaces
    differ in look and stay. ``budget`` lets values of which no look-alike is
    clean take a spelling that is reached at so much cost; ``by_table`` gives
    the table's form to all.
    """
    rows = rows.drop(*[f"{c}{suffix}" for c in columns])
    if by_table:
        look = F.pandas_udf(lambda s: s.map(normalize_look, na_action="ignore"), T.StringType())
        words = [materialize(rows.select(F.col(f"`{c}`").alias("value")).where(~F.col("value").rlike(PLAIN)).distinct().select("value", look("value").alias("canonical"))) for c in columns]
    else:
        found = materialize(canonical_spellings(rows, list(columns), budget))
        words = [found.where(F.col("column") == c).select("value", "canonical") for c in columns]
    for column, forms in zip(columns, words):
        rows = _with_form(rows, column, f"{column}{suffix}", forms)
    return rows


def _with_form(rows: DataFrame, column: str, form: str, forms: DataFrame) -> DataFrame:
    """Plain values keep their place; the others are looked up apart, hot ones by broadcast."""
    names = rows.columns
    plain = F.coalesce(F.col(f"`{column}`").rlike(PLAIN), F.lit(True))
    done = rows.where(plain).withColumn(form, F.col(f"`{column}`"))
    forms = forms.select(F.col("value").alias("__value"), F.col("canonical").alias("__form"))
    other = look_up(rows.where(~plain).withColumn("__value", F.col(f"`{column}`")), "__value", forms)
    return done.select(*[f"`{c}`" for c in names], form).unionByName(other.withColumn(form, F.col("__form")).select(*[f"`{c}`" for c in names], form))


def _same_look_spellings(rows: DataFrame, row_id: str, columns: list[str], budget: float) -> DataFrame:
    """Spellings (of all ``columns``) that have a partner: ``spelling`` (a hash of
    64 bits per column), ``class_id`` (the smallest id of the class), ``n``
    (rows of the spelling), ``class_rows``."""
    names = [f"__form{i}" for i in range(len(columns))]
    key = F.struct(*[F.xxhash64(c).alias(f"h{i}") for i, c in enumerate(columns)])
    spelled = materialize(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"), F.min(row_id).alias("__first")))
    forms = materialize(canonical_spellings(spelled, columns, budget, "__n"))
    plain = F.lit(True)
    for c in columns:
        plain = plain & F.col(c).rlike(PLAIN)
    odd = spelled.where(~plain)
    for c, name in zip(columns, names):
        odd = _with_form(odd, c, name, forms.where(F.col("column") == c).select("value", "canonical"))
    odd = materialize(odd)
    # a class has two spellings only if one of them isn't plain, so plain ones count where they are such a one's form
    met = spelled.where(plain).withColumns({n: F.col(c) for c, n in zip(columns, names)}).join(odd.select(*names).distinct(), names, "left_semi")
    both = materialize(odd.unionByName(met.select(*odd.columns)).select(key.alias("spelling"), *names, "__n", "__first"))
    classes = both.groupBy(*names).agg(F.count(F.lit(1)).alias("k"), F.min("__first").alias("class_id"), F.sum("__n").alias("class_rows")).where("k > 1").drop("k")
    return materialize(both.join(classes, names).select("spelling", "class_id", F.col("__n").alias("n"), "class_rows"))


def _rows_of_spellings(rows: DataFrame, row_id: str, columns: list[str], spelling: DataFrame) -> DataFrame:
    key = F.struct(*[F.xxhash64(c).alias(f"h{i}") for i, c in enumerate(columns)])
    return look_up(rows.select(F.col(row_id).alias("id"), key.alias("spelling")), "spelling", spelling, "inner")


def same_look_classes(rows: DataFrame, row_id: str, columns: list[str], budget: float = 0.0) -> DataFrame:
    """(``row_id``, ``class_id``, ``links``): one row per row that looks the same
    as another in all ``columns`` while the characters of one differ.

    ``class_id`` is the smallest id of those that look so, ``links`` the number
    of rows that differ in their characters. Rows with a null in any of the
    columns or a null id are left out; rows of one id must have the same
    content and count once. Grows with the rows, not with the pairs.
    """
    rows = without_repeats(rows.select(row_id, *columns).dropna(), row_id)
    found = _rows_of_spellings(rows, row_id, columns, _same_look_spellings(rows, row_id, columns, budget))
    return found.select(F.col("id").alias(row_id), "class_id", (F.col("class_rows") - F.col("n")).alias("links"))


def same_look_pairs(rows: DataFrame, row_id: str, columns: list[str], block: int = 512, budget: float = 0.0) -> DataFrame:
    """(``<row_id>_a``, ``<row_id>_b``), a < b: the links of ``same_look_classes``, one by one.

    Their number may be quadratic in the rows of a class; use the classes
    where the pairs themselves aren't asked for. Spellings are paired first,
    then the blocks of their rows: a spelling that holds many rows is cut into
    blocks of about ``block`` rows, so a task pairs blocks, never a whole
    class. Rows of one spelling never meet.
    """
    rows = without_repeats(rows.select(row_id, *columns).dropna(), row_id)
    spelling = _same_look_spellings(rows, row_id, columns, budget).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    mine = _rows_of_spellings(rows, row_id, columns, spelling.select("spelling", "blocks"))
    mine = materialize(mine.select("id", F.struct("spelling", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block")).alias("cell")))
    cut = spelling.select("class_id", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "spelling")
    cut = cut.select("class_id", F.struct("spelling", "block").alias("cell"))
    cells = join_split(cut.withColumnRenamed("cell", "cell_a"), cut.withColumnRenamed("cell", "cell_b"), "class_id")
    cells = cells.where("cell_a.spelling < cell_b.spelling").select("cell_a", "cell_b")
    left = cells.join(mine.select(F.col("id").alias("x"), F.col("cell").alias("cell_a")), "cell_a").select("x", "cell_b")
    pairs = left.join(mine.select(F.col("id").alias("y"), F.col("cell").alias("cell_b")), "cell_b")
    return pairs.select(F.least("x", "y").alias(f"{row_id}_a"), F.greatest("x", "y").alias(f"{row_id}_b"))
