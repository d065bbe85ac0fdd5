"""Scalar functions against goldens traced by hand."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.functions import text as X


def column(spark, make, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.o for r in rows.select("i", make(F.col("s")).alias("o")).orderBy("i").collect()]


def test_standard_uri(spark):
    cases = {
        "Paris": "Paris", "a%20b+c": "A_b_c", "cabin luggage": "Cabin_luggage", "foo/": "Foo/", "AC/DC": "DC", "": "Incorrect_uri", "C++": "C++", "100%": "100%25",
        "O'Brien": "O%27Brien", "%2541": "A", " chouette#partyé  (blabal)": "Chouette%23partyé_(blabal)", "a%zz": "A%25zz", "ß": "ß", "a\tb": "A_b",
    }
    got = column(spark, lambda s: X.standard_uri(s, ""), [*cases, None])
    assert got == [*cases.values(), None]
    assert column(spark, X.standard_uri, ["Paris"]) == ["http://dbpedia.org/resource/Paris"]
    assert column(spark, lambda s: X.standard_uri(s, None, "fr"), ["Paris"]) == ["http://fr.dbpedia.org/resource/Paris"]


@pytest.mark.parametrize("same,title", [(True, "Paris"), (True, "O'Brien"), (True, "100%"), (False, "AC/DC"), (False, "Rock (music)"), (False, "Café"), (False, "C++"), (False, "Smith, J.")])
def test_two_encodings(spark, same, title):
    assert (column(spark, X.escape_title, [title]) == column(spark, lambda s: X.standard_uri(s, ""), [title])) is same


def test_unescape(spark):
    cases = {"A&amp;B": "A&B", "AT&amp;": "ATamp;", "x &lt;b": "x lt;b", "it&#039;s": "it';s", "a&nbsp;b": "a b", "&ndash;x": "–;x", " plain ": "plain", "": "", "&amp;nbsp;x": "x", "a&amp;nbsp;x": "a x"}
    assert [X.unescape(k) for k in cases] == [*cases.values()]
    assert column(spark, X.unescape_xml, [*cases, None]) == [*cases.values(), None]
    parts = ["&amp;", "amp;", "&", "nbsp;", "&amp;nbsp;", " ", "x", "\n", "&ndash", "&quot;", ";"]
    many = ["".join(random.Random(i).choices(parts, k=i % 7)) for i in range(300)]
    assert column(spark, X.unescape_xml, many) == [X.unescape(x) for x in many]


def test_upper_first(spark):
    assert column(spark, X.upper_first, ["été", "", "ß", "ßx", None, "a", "Ab"]) == ["Été", "", "SS", "ßx", None, "A", "Ab"]


def test_nb_tokens(spark):
    assert column(spark, X.nb_tokens, ["a", "a b", "a b c d e", " a", "a ", "a  b", ""]) == [0, 1, 4, 0, 1, 1, 0]


def test_split_fields(spark):
    assert column(spark, X.split_fields, ["a,,b", "a,,", "a,b", ",,", "a,,,b"]) == [["a", "b"], ["a"], ["a,b"], [",,"], ["a", ",b"]]


def test_trim_and_lengths(spark):
    assert column(spark, X.super_trim, ["  a b　\n", " a", None, " "]) == ["a b", " a", "", ""]
    assert column(spark, X.utf16_length, ["😀a", "", None, "é"]) == [3, 0, None, 1]
    assert [X.utf16_len(s) for s in ("😀a", "", "é")] == [3, 0, 1]
    assert column(spark, X.before_number_sign, ["a#b#c", "#", "a"]) == ["a", "", "a"]


def test_long_hash(spark):
    def plain(s):
        h = 1125899906842597
        for c in s:
            h = (31 * h + ord(c)) % (1 << 64)
        return h - (1 << 64) if h >= 1 << 63 else h

    assert column(spark, X.long_hash_column, ["", "Paris", "été", None]) == [plain(""), plain("Paris"), plain("été"), None]
    assert column(spark, X.long_hash_column, ["😀a", "x" * 500]) == [X.long_hash("😀a"), X.long_hash("x" * 500)]
