"""Page fields, the cleaner and the link parsers against goldens traced by hand."""

import time

import pytest
from pyspark.sql import functions as F

from linkloom.functions import links as L
from linkloom.functions import pages as P
from linkloom.functions.cleaning import Clean, paragraphs_of
from linkloom.operators.pairs import page_paragraphs, paragraph_links

PAGE = '<title>A &amp; B</title>\n<redirect title="C &quot;D&quot;" />\n<model>wikitext</model>\n<text xml:space="preserve">x &lt;b&gt;</text>'


def test_fields(spark):
    rows = spark.createDataFrame([(PAGE,), ("<model>json</model>",), ("<title>T</title><model>wikitextX</model><text id=1>b</text>",), (None,)], "page string")
    got = P.with_fields(rows).collect()
    # an escape at the very end is none, and its "&" is deleted
    assert (got[0].title, got[0].redirect, got[0].is_wikitext, got[0].text) == ("A & B", 'C "Dquot;', True, "x &lt;b&gt;")
    assert (got[1].title, got[1].redirect, got[1].is_wikitext, got[1].text) == (None, None, False, None)
    assert (got[2].title, got[2].is_wikitext, got[2].text) == ("T", True, None)
    assert got[3].title is None and got[3].is_wikitext is False
    assert P.with_fields(rows, any_tag=True).collect()[2].text == "b"


def run(text, **how):
    return paragraphs_of(text, Clean(filter_by_size=False, **how))


@pytest.mark.parametrize(
    "text,how,want",
    [
        ("hello", {}, ["hell"]),
        ("A{{t|x}}B\n\nC D.", {}, ["AB", "C D"]),
        ("x\n* item\ny zz.", {"ignore_lists": True}, ["x\ny zz"]),
        ("x\n* item\ny zz.", {}, ["x\n* item\ny zz"]),
        ("a &lt;ref&gt;r&lt;/ref&gt; b.", {"ignore_refs": True}, ["a  b"]),
        ("AT&amp;T x.", {}, ["AT&T x"]),
        ("p}} q {{t}} r.", {}, ["p q t r"]),
        ("see [[Paris|the city]] and [[File:x|y]] z.", {"clean_links": True}, ["see the city and  z"]),
        ("a {| t\n|- |} b.", {}, ["a  b"]),
        ("a &lt;!-- c --&gt; b.", {}, ["a  b"]),
        ("a &lt;div x&gt;c &lt;div&gt;d&lt;/div&gt;&lt;/div&gt; b.", {}, ["a  b"]),
        ("'''bold''' and ''it'' x.", {}, ["bold and it x"]),
        ("== Head ==\ntext here.", {}, ["Head", "text here"]),
        ("a &lt;b&gt;c&lt;/b&gt; d.", {}, ["a c d"]),
        ("a &lt;ref name=x/&gt; b.", {"ignore_refs": True}, ["a  b"]),
        ("a [[b c. d", {"clean_links": True}, []),
        ("a ]] [[b]] c ]] [[d]] e.", {"clean_links": True}, ["a  b c  d e"]),
        ("a &lt; b x.", {}, ["a &lt; b x"]),
        ("", {}, []),
    ],
)
def test_cleaner(text, how, want):
    assert run(text, **how) == want


def test_cleaner_sizes():
    assert paragraphs_of("x" * 99) is None
    assert paragraphs_of(None) is None
    assert paragraphs_of("x" * 150) == ["x" * 149]
    assert paragraphs_of("{{" + "x" * 200 + "}} y") is None


NESTED = {
    "[[Paris]]": [("Paris", "Paris")],
    "[[Paris|the city]]": [("Paris", "the city")],
    "[[Paris#History]]": [("Paris", "Paris")],
    "[[Paris#History|past]]": [("Paris", "past")],
    "[[Category:X]]": [], "[[#s|xx]]": [], "[[Paris|]]": [], "[[A|b]]": [], "[[(xx)]]": [],
    "[[ Foo | bar ]]": [("Foo ", " bar")],
    "[[File:p.jpg|here [[Go]] now]]": [("Go", "Go")],
    "[[A1|x [[B1]] y]]": [("B1", "B1"), ("A1", "x [[B1]] y")],
    "[[A1|b|c]]": [("A1", "b|c")],
    "[[P1|a b c d e]]": [("P1", "a b c d e")],
    "[[P1|a b c d e f]]": [],
    "[[A1]]] and [[B1]]": [("A1", "A1"), ("B1", "B1")],
}
OUTER = NESTED | {"[[File:p.jpg|here [[Go]] now]]": [], "[[A1|x [[B1]] y]]": [("A1", "x [[B1]] y")], "[[A1]]] and [[B1]]": [("A1", "A1")]}


@pytest.mark.parametrize("nested,want", [(True, NESTED), (False, OUTER)])
def test_links(spark, nested, want):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(want)], "i int, paragraph string")
    got = {i: [] for i in range(len(want))}
    for r in paragraph_links(rows, nested=nested).collect():
        got[r.i].append((r.uri, r.sf))
    assert [sorted(v) for v in got.values()] == [sorted(v) for v in want.values()]


def test_flat_links(spark):
    texts = [t for t in NESTED if "[[" not in t[2:] or t == "[[A1]]] and [[B1]]"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    flat = rows.select("i", F.explode(L.flat_links(F.col("t"))).alias("l")).select("i", "l.*").where(L.accepted(F.col("uri"), F.col("sf")))
    got = {i: [] for i in range(len(texts))}
    for r in flat.collect():
        got[r.i].append((r.uri, r.sf))
    assert [*got.values()] == [NESTED[t] for t in texts]


@pytest.mark.parametrize(
    "text,want",
    [("a [[B|b c]] d.", "a b c d"), ("a [[File:x]] d.", "a ]] d"), ("a ]] b [[C]] d.", "a [C"), ("plain.", "plain"), ("", ""), ("[[A]]", "A"), ("x [[A|[[B c]] d]] y.", "x [[B c]] d y")],
)
def test_strip_links(text, want):
    assert L.strip_links_text(text) == want


def test_empty_and_null_pages(spark):
    rows = spark.createDataFrame([(1, None, True), (2, "", True), (3, "x" * 200, False)], "k int, text string, is_wikitext boolean")
    assert page_paragraphs(rows, "k").count() == 0


@pytest.mark.parametrize("unit", ["&lt;", "&lt;ref", "[[", "]]", "{{", "}}", "&lt;div", "''", "=", "\n*", "&amp;", "&lt;!--", "a&gt;"])
def test_cleaner_stays_linear(unit):
    began = time.perf_counter()
    paragraphs_of(unit * 40_000, Clean(True, True, True))
    L.strip_links_text(unit * 40_000)
    L.all_spans(unit * 40_000)
    assert time.perf_counter() - began < 5
