"""Queries over small fixed texts, held against results traced by hand.

They cover the sequential scanners and word rules that SQL can't express; the
same operators run over whole tables in the other modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links as L
from ..functions.cleaning import Clean
from ..functions.tokenizers import analyze
from ..operators import ngrams, pairs

# (setting, body, paragraphs)
PARAGRAPHS = [
    ("plain", "hello", ["hell"]),
    ("plain", "A{{t|x}}B\n\nC D.", ["AB", "C D"]),
    ("plain", "x\n* item\ny zz.", ["x\n* item\ny zz"]),
    ("plain", "AT&amp;T x.", ["AT&T x"]),
    ("plain", "p}} q {{t}} r.", ["p q t r"]),
    ("plain", "a {| t\n|- |} b.", ["a  b"]),
    ("plain", "a &lt;!-- c --&gt; b.", ["a  b"]),
    ("plain", "a &lt;div x&gt;c &lt;div&gt;d&lt;/div&gt;&lt;/div&gt; b.", ["a  b"]),
    ("plain", "'''bold''' and ''it'' x.", ["bold and it x"]),
    ("plain", "== Head ==\ntext here.", ["Head", "text here"]),
    ("lists", "x\n* item\ny zz.", ["x\ny zz"]),
    ("refs", "a &lt;ref&gt;r&lt;/ref&gt; b.", ["a  b"]),
    ("refs", "a &lt;ref name=x/&gt; b.", ["a  b"]),
    ("links", "see [[Paris|the city]] and [[File:x|y]] z.", ["see the city and  z"]),
    ("links", "a ]] [[b]] c ]] [[d]] e.", ["a  b c  d e"]),
]
HOW = {"plain": Clean(filter_by_size=False), "lists": Clean(True, filter_by_size=False), "refs": Clean(False, True, filter_by_size=False), "links": Clean(False, False, True, False)}

# text: (nested links, outermost links); links as target and form
_SAME = {
    "[[Paris]]": [("Paris", "Paris")], "[[Paris|the city]]": [("Paris", "the city")], "[[Paris#History]]": [("Paris", "Paris")], "[[Paris#History|past]]": [("Paris", "past")],
    "[[Category:X]]": [], "[[#s|xx]]": [], "[[Paris|]]": [], "[[A|b]]": [], "[[(xx)]]": [], "[[ Foo | bar ]]": [("Foo ", " bar")], "[[A1|b|c]]": [("A1", "b|c")],
    "[[P1|a b c d e]]": [("P1", "a b c d e")], "[[P1|a b c d e f]]": [],
}
LINKS = {t: (x, x) for t, x in _SAME.items()} | {
    "[[File:p.jpg|here [[Go]] now]]": ([("Go", "Go")], []),
    "[[A1|x [[B1]] y]]": ([("B1", "B1"), ("A1", "x [[B1]] y")], [("A1", "x [[B1]] y")]),
    "[[A1]]] and [[B1]]": ([("A1", "A1"), ("B1", "B1")], [("A1", "A1")]),
}
STRIPPED = {
    "a [[B|b c]] d.": "a b c d", "a [[File:x]] d.": "a ]] d", "a ]] b [[C]] d.": "a [C", "plain.": "plain", "": "", "[[A]]": "A", "x [[A|[[B c]] d]] y.": "x [[B c]] d y",
}
PIECES = {
    "Apple Inc. is  a": ["Apple", " ", "Inc", ".", " ", "is", "  ", "a"], "co-op, don't": ["co-op", ",", " ", "don't"], "$3.14 1,000 5% #1 €5": ["$3.14", " ", "1,000", " ", "5%", " ", "#1", " ", "€5"],
    "U.S.A. e.g.": ["U.S.A", ".", " ", "e.g", "."], "AT&T x_y 2008-2009": ["AT", "&", "T", " ", "x_y", " ", "2008", "-", "2009"], "R2-D2 C-3PO": ["R2", "-", "D2", " ", "C", "-", "3PO"],
    "l'avion d'été": ["l'avion", " ", "d'été"], "don’t": ["don", "’", "t"], "x \ny": ["x", " \n", "y"], "A\n\nB": ["A", "\n", "\n", "B"],
}
# n-grams of up to two words, an n-gram before a dot once more with it
NGRAMS = {"Apple Inc. is  a": ["Apple", "Apple Inc", "Apple Inc.", "Inc", "Inc.", "Inc. is", "is", "is  ", "  ", "  a", "a"], "Paris. Paris Inc.": ["Paris", "Paris.", "Paris. Paris", "Paris", "Paris Inc", "Paris Inc.", "Inc", "Inc."]}
# analyzer, text: terms ("the" is a stop word)
TERMS = {
    ("en.EnglishAnalyzer", "the king's horses, running quickly"): ["king", "hors", "run", "quickli"],
    ("en.EnglishAnalyzer", "relational ponies caresses hopping generalizations"): ["relat", "poni", "caress", "hop", "gener"],
    ("fr.FrenchAnalyzer", "L'avion d'été vole, les chevaux nationaux"): ["avion", "été", "vole", "les", "cheval", "national"],
    ("standard.StandardAnalyzer", "The U.S.A. won 3.14 x_y, o'clock"): ["u.s.a", "won", "3.14", "x_y", "o'clock"],
}


def golden_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    made = None
    for name, how in HOW.items():
        own = spark.createDataFrame([(name, b, b, True) for n, b, _ in PARAGRAPHS if n == name], "setting string, body string, text string, is_wikitext boolean")
        got = pairs.page_paragraphs(own.withColumn("key", F.struct("setting", "body")), "key", how).select("key.setting", "key.body", "pos", "paragraph")
        made = got if made is None else made.unionByName(got)
    return made


def golden_links(spark: SparkSession, d: str) -> DataFrame:
    own = spark.createDataFrame([(t, t) for t in LINKS], "text string, paragraph string")
    parts = [pairs.paragraph_links(own, nested=nested).select(F.lit(name).alias("pass"), "text", "uri", "sf") for name, nested in (("nested", True), ("outer", False))]
    return parts[0].unionByName(parts[1])


def golden_stripped(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t in STRIPPED], "text string").select("text", L.strip_links(F.col("text")).alias("stripped"))


def golden_pieces(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(t,) for t in PIECES], "text string").select("text", F.posexplode(ngrams.pieces(F.col("text"))).alias("pos", "piece"))


def golden_ngrams(spark: SparkSession, d: str) -> DataFrame:
    own = spark.createDataFrame([(t, t) for t in NGRAMS], "text string, t string")
    return ngrams.with_ngrams(own, "t", "gram", 2).groupBy("text", "gram").agg(F.count(F.lit(1)).alias("n"))


def golden_terms(spark: SparkSession, d: str) -> DataFrame:
    made = None
    for analyzer in dict.fromkeys(a for a, _ in TERMS):
        own = spark.createDataFrame([(analyzer, t) for a, t in TERMS if a == analyzer], "analyzer string, text string")
        got = own.select("analyzer", "text", F.posexplode(analyze(F.col("text"), analyzer, ["the"])).alias("pos", "term"))
        made = got if made is None else made.unionByName(got)
    return made


QUERIES = {f.__name__: f for f in (golden_paragraphs, golden_links, golden_stripped, golden_pieces, golden_ngrams, golden_terms)}


def _values(rows: list[tuple], *names: str) -> str:
    one = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) AS g({', '.join(names)})"


SQL = {
    "golden_paragraphs": _values([(n, b, i, p) for n, b, ps in PARAGRAPHS for i, p in enumerate(ps)], "setting", "body", "pos", "paragraph"),
    "golden_links": _values([(name, t, u, s) for t, both in LINKS.items() for name, found in zip(("nested", "outer"), both) for u, s in found], '"pass"', "text", "uri", "sf"),
    "golden_stripped": _values([*STRIPPED.items()], "text", "stripped"),
    "golden_pieces": _values([(t, i, p) for t, ps in PIECES.items() for i, p in enumerate(ps)], "text", "pos", "piece"),
    "golden_ngrams": _values([(t, g, gs.count(g)) for t, gs in NGRAMS.items() for g in dict.fromkeys(gs)], "text", "gram", "n"),
    "golden_terms": _values([(a, t, i, w) for (a, t), ws in TERMS.items() for i, w in enumerate(ws)], "analyzer", "text", "pos", "term"),
}
