"""Operators of the llm subpackage: brute force, goldens and edge cases."""

import random
from collections import Counter, defaultdict
from math import log2

import pytest
from pyspark.sql import functions as F

pytest.importorskip("linkloom.llm.queries")

from linkloom.llm import tokenizers  # noqa: E402
from linkloom.llm.distinctive import score_terms  # noqa: E402
from linkloom.llm.frequency import term_frequencies  # noqa: E402
from linkloom.llm.groups import connected_groups, page_pairs  # noqa: E402
from linkloom.llm.leaks import align, align_all, find_leaks, words  # noqa: E402
from linkloom.llm.lookalikes import Trie, consistent_form, is_clean, normalize_look, same_look_classes, same_look_pairs  # noqa: E402
from linkloom.llm.markup import clean_markup, read_markup, select_content, strip_markup  # noqa: E402
from linkloom.llm.mixing import mix_sources  # noqa: E402
from linkloom.llm.splitting import split_items, split_text  # noqa: E402


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# -- groups ------------------------------------------------------------------
def brute_groups(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    least = defaultdict(list)
    for x in parent:
        least[find(x)].append(x)
    return {x: min(v) for v in least.values() for x in v}


@pytest.mark.parametrize("kind", ["random", "chain", "star", "empty"])
def test_groups(spark, kind):
    rnd = random.Random(3)
    pairs = {
        "random": [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(None, 1), (5, None), (7, 7)],
        "chain": [(i, i + 1) for i in range(120)],
        "star": [(0, i) for i in range(1, 700)] + [(1000, 1001), (1001, 1000), (1000, 1001)],
        "empty": [],
    }[kind]
    df = spark.createDataFrame([(*p, "x") for p in pairs], "a bigint, b bigint, member string")  # a clashing name
    assert {r.member: r.group for r in connected_groups(df, "a", "b").collect()} == brute_groups(pairs)


def test_groups_of_strings_and_rates(spark):
    df = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y")], "a string, b string")
    for beta, steps in ((0.1, 1), (0.3, 3), (2.0, 2)):
        assert rows(connected_groups(df, "a", "b", beta, steps)) == [("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")]


def test_growth_ends_by_itself(spark, monkeypatch):
    """One round over a long chain: every vertex joins the cluster with the largest shift less distance, and few edges are cut."""
    from linkloom.llm import groups

    n = 400
    edges = spark.range(n).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    labels, left, seen = groups._decompose(edges, n, 0, 0.1, 3, 0.0)
    shift = {r.id: r.s for r in spark.range(n + 1).select("id", groups._shift("id", 0, 0.1).alias("s")).collect()}
    assert {r.vertex: r.cluster for r in labels.collect()} == {v: max(range(n + 1), key=lambda c: shift[c] - abs(c - v)) for v in range(n + 1)}
    assert left.count() == seen["n"] < 0.2 * n
    # without the last percent of growth a few edges more are left
    assert groups._decompose(edges, n, 0, 0.1, 3, 0.01)[2]["n"] <= seen["n"] + 0.05 * n


def test_page_pairs(spark):
    data = [(1, "a b", None), (2, "A_b#x", None), (3, "C", " a  b "), (4, None, "C"), (5, "D", "lost"), (6, "E", "Lost"), (7, "F", " "), (8, "G", None), (2, "A_b#x", None)]
    df = spark.createDataFrame(data, "page_id bigint, title string, redirect string")
    got = {r.member: r.group for r in connected_groups(page_pairs(df), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5}


# -- look-alikes --------------------------------------------------------------
SAME = ["Peter", "Реtеr", "Ｐｅｔｅｒ", "Pe​ter", "P\u00adeter", "Pе\u2060ter"]


def test_normalize():
    assert {normalize_look(s) for s in SAME} == {"Peter"}
    assert normalize_look("e\u0301") == normalize_look("é") == normalize_look("е\u0301") != "e"
    assert normalize_look("a\u00a0b") == "a b" and normalize_look("x²") == "x²" and normalize_look("Ⅲ ﬁ") == "III fi"
    assert len({normalize_look(c) for c in map(chr, range(32, 127))}) == 95


def test_trie_reach():
    t = Trie()
    for w, n in (("peter", 5), ("petra", 2), ("été", 1), ("вода", 4), ("tom", 3), ("реtеr", 9), ("finish", 2)):
        t.add(w, n)
    assert t.reach("реt\u200bеr") == {"peter": (0, 5), "реtеr": (0, 9)} and t.canonical("реt\u200bеr") == "peter"
    assert t.reach("ｅ\u0301te\u0301") == {"été": (0, 1)}
    assert t.canonical("вoда") == "вода" and normalize_look("вода") == "вoдa"  # a spelling, where the table mixes scripts
    assert t.canonical("ﬁnish") == "finish" and t.canonical("nothing") is None
    assert not any(t.reach(x) for x in ("pexer", "pete", "", "tσm"))
    assert t.reach("tσm", 0.5) == {"tom": (0.25, 3)} and t.canonical("τσm", 0.5) == "tom" and t.canonical("τσm", 0.25) is None
    assert t.reach("pexer", 1) == {"peter": (1, 5), "реtеr": (1, 9)} and t.canonical("pete", 1) == "peter" and t.canonical("ppeter", 1) == "peter"


def test_clean_spellings():
    for s in ("Peter", "été", "вода", "漢字かな", "вода Peter", "x²", "", "a–b"):
        assert is_clean(s), s
    for s in ("Реtеr", "e\u0301", "Ｐeter", "a\u00a0b", "a\u200b", "ﬁ", "a\tb"):
        assert not is_clean(s), s


def test_consistent_form(spark):
    data = [*SAME, None, "", "peter", "бцшя", "бцшя\u200b", "вoда", "вода", "Реtrus", "Ｐetrus", "Tσm", "Tom"]
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(data)], "i int, s string, s_form string")
    want = {**{i: "Peter" for i in range(6)}, 6: None, 7: "", 8: "peter", 9: "бцшя", 10: "бцшя", 11: "вода", 12: "вода", 13: "Petrus", 14: "Petrus", 15: "Tσm", 16: "Tom"}
    assert {r.i: r.s_form for r in consistent_form(df, "s").collect()} == want
    assert {r.i: r.s_form for r in consistent_form(df, "s", budget=0.25).collect()} == want | {15: "Tom"}
    table = {r.i: r.s_form for r in consistent_form(df, "s", by_table=True).collect()}
    assert table == want | {11: "вoдa", 12: "вoдa"}  # where the tries differ from the table
    assert consistent_form(df.limit(0), "s").count() == 0


def test_most_frequent_clean_spelling(spark):
    # no plain spelling: Cyrillic and Greek words of one look, the more frequent one is the form
    df = spark.createDataFrame([("ορο",)] * 3 + [("оро",)] * 2 + [("oр\u200bo",)], "s string")
    assert {r.s_form for r in consistent_form(df, "s").collect()} == {"ορο"}


def test_many_shards(spark, monkeypatch):
    from linkloom.llm import lookalikes

    monkeypatch.setattr(lookalikes, "SHARD", 20)
    names = [f"Name{i}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names] + [(n.replace("a", "а"),) for n in names], "s string")
    assert {r.s_form for r in consistent_form(df, "s").collect()} == {*names}


def test_same_look_pairs(spark):
    rnd = random.Random(4)
    data = [(i, rnd.choice(SAME[:4] + ["other", None]), rnd.choice(["u/a", "u/а", "u/b"]), 1) for i in range(200)]
    data += data[:5] + [(None, "Peter", "u/a", 1)]
    df = spark.createDataFrame(data, "id bigint, s string, u string, id_a int")
    ok = {r[0]: r for r in data if r[0] is not None and r[1] is not None}
    want = sorted((a, b) for a in ok for b in ok if a < b and normalize_look(ok[a][1]) == normalize_look(ok[b][1]) and normalize_look(ok[a][2]) == normalize_look(ok[b][2]) and ok[a][1:3] != ok[b][1:3])
    for block in (3, 512):
        assert sorted(map(tuple, same_look_pairs(df, "id", ["s", "u"], block).collect())) == want
    links = Counter(x for p in want for x in p)
    classes = same_look_classes(df, "id", ["s", "u"]).collect()
    assert {r.id: r.links for r in classes} == links and len(classes) == len(links)
    look = {i: (normalize_look(r[1]), normalize_look(r[2])) for i, r in ok.items()}
    assert all(r.class_id == min(i for i in links if look[i] == look[r.id]) for r in classes)
    assert same_look_classes(df.limit(0), "id", ["s", "u"]).count() == 0


# -- markup ---------------------------------------------------------------------
CASES = [
    ("Plain text. It ran 50% &amp; more – at &quot;full&quot; speed. A ratio of 3 = 6 / 2.", []),
    ("from $5 to $7 that week, a &lt; b and c &gt; d, #7 [sic], {x, y}, old_name_list, C# and 5 * 4.", []),
    ("== Head ==\n\ntext", ["heading"]), ("# Head\n\ntext", ["heading"]), ("# one\n# two", ["list"]), ("Head\n====\n\ntext", ["heading"]),
    ("\\section*{Head}\n\ntext", ["heading"]), ("&lt;h2 id=&quot;x&quot;&gt;Head&lt;/h2&gt;", ["heading"]),
    ("* one\n* two", ["list"]), (": one\n: two", ["list"]), ("1. one\n2. two", ["list"]), ("- one\n- two", ["list"]), ("* only one", []),
    ("&lt;ul&gt;&lt;li&gt;a&lt;/li&gt;&lt;li&gt;b&lt;/li&gt;&lt;/ul&gt;", ["list"]), ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", ["list"]),
    ("&lt;pre&gt;&lt;code&gt;x = [[1]]&lt;/code&gt;&lt;/pre&gt;", ["code"]), ("```py\n# a\n# b\n```", ["code"]), ("~~~\nx *y* z\n~~~", ["code"]), ("\\begin{verbatim}\n{{x}}\n\\end{verbatim}", ["code"]),
    ("Here &lt;math&gt;x_{i}&lt;/math&gt; holds.", ["formula"]), ("$$\na_{i}\n$$", ["formula"]), ("Thus $k_{i}$ follows.", ["formula"]), ("\\[ x \\]", ["formula"]), ("\\begin{equation}x\\end{equation}", ["formula"]),
    ("{| class=x\n! a !! b\n|-\n| 1 || 2\n|}", ["table"]), ("| a | b |\n|---|---:|\n| 1 | 2 |", ["table"]), ("&lt;table&gt;&lt;tr&gt;&lt;td&gt;1&lt;/td&gt;&lt;/tr&gt;&lt;/table&gt;", ["table"]),
    ("\\begin{tabular}{ll}\na &amp; 1 \\\\\n\\end{tabular}", ["table"]),
    ("a '''b''' c", ["inline"]), ("[[A|b]] c", ["inline"]), ("a *b* c", ["inline"]), ("*b* c", ["inline"]), ("&lt;p&gt;a&lt;/p&gt;", ["inline"]), ("a&amp;nbsp;b", ["inline"]), ("a {{t|x=1}} b", ["inline"]),
    ("&gt; quoted", ["inline"]), ("a \\textbf{b} \\label{x}", ["inline"]), ("a &lt;!-- b --&gt; c", ["inline"]), ("a `b` c", ["inline"]), ("[a](http://b) c", ["inline"]), ("a&lt;ref&gt;b&lt;/ref&gt; c", ["inline"]),
    ("", []),
]


@pytest.mark.parametrize("text,want", CASES)
def test_markup_kinds(text, want):
    assert clean_markup(text)[1] == want


def test_clean_text_keeps_structure(spark):
    text = "== Head ==\n\nSee [[A|the town]] &amp; '''more'''.\n\n* one\n* two\n\n&lt;pre&gt;x\n  y&lt;/pre&gt;\n\nHere &lt;math&gt;x^2&lt;/math&gt; holds.\n\n{|\n! a !! b\n|-\n| 1 || 2\n|}"
    df = spark.createDataFrame([(1, text, "z"), (2, None, "z"), (3, "", "z"), (3, "", "z"), (4, "x " * 100_000, "z")], "id int, text string, elements string")
    got = {r.id: r for r in strip_markup(df).collect()}
    assert got[1].clean_text == "## Head\n\nSee the town & more.\n\n- one\n- two\n\n```\nx\n  y\n```\n\nHere $x^2$ holds.\n\n| a | b |\n| --- | --- |\n| 1 | 2 |"
    assert got[1].elements == ["heading", "list", "code", "formula", "table", "inline"]
    assert (got[2].clean_text, got[2].elements, got[3].clean_text, got[3].elements) == (None, [], "", [])
    assert strip_markup(df).count() == 5 and strip_markup(df.limit(0)).count() == 0


def test_tag_path_ratios():
    prose = [("body/p", "text", "A long paragraph, with commas, and more. " * 8)] * 6
    nodes = [*prose[:3], ("body/template", "template", "x 1"), ("body/heading", "heading", "# H"), *prose[3:]]
    assert select_content(nodes) == [n for n in nodes if n[1] != "template"]
    assert "".join(t for _, _, t in read_markup("{{Infobox\n| name = In its\n| area = 3\n}}\nText.")[0])


@pytest.mark.parametrize("mark", ["`", "``", "_", "__"])
def test_long_inline_spans(mark):
    inside = "many words, " * 400 + "end"
    assert clean_markup(f"So {mark}{inside}{mark} it is.") == (f"So {inside} it is.", ["inline"])
    assert clean_markup(f"So {mark}{inside} it is.") == (f"So {mark}{inside} it is.", [])


def test_inline_spans_of_one_line():
    for text, want in [
        ("a `b` ``c ` d`` e", "a b c ` d e"), ("``a`", "`a"), ("`a``", "`a``"), ("`a\nb`", "`a\nb`"), ("_a_ __b _c_ d__ e_f_g", "a b c d e_f_g"), ("_a _b c_", "a _b c"),
        ("_ a_ ___b___", "_ a_ ___b___"), ("_a\nb_", "_a\nb_"), (" _a" * 9 + " b_" * 9, " a" * 9 + " b" * 9),
    ]:
        assert clean_markup(text)[0] == want.strip()


@pytest.mark.parametrize("unit", [" _a", "`a ", "b_ ", "(_)"])
def test_long_marks_stay_linear(unit):
    assert isinstance(clean_markup(unit * 50_000 + "b_ " * 50_000)[0], str)


def test_tag_paths():
    prose = "The river passes the old town, turns west, and ends, after many miles, in a lake. " * 3
    page = (
        "<html><body><nav><a href='x'>Home</a> | <a href='y'>About</a></nav>\n<article><p>{0}</p><p>{0} It goes <b>on</b>.<br>{0}</p>\n{0}\n<p>{0}\n\n"
        "<div class=note><span>See also</span></div></article>\n<footer>Imprint</footer></body></html>\n<div>\n# Head\n</div></div>\nThe <i>end</i>, {0}"
    ).format(prose)
    paths = [x[0] for x in read_markup(page)[0]]
    assert [p for p in paths if "p" not in p.split("/")] == ["body/nav", "body/article", "body/article/div/span", "body/footer", "body/div/heading"]
    assert paths.count("body/article/p") == 3 and paths[-1] == "body/p"
    clean = clean_markup(page)[0]
    assert clean.count(prose.strip()) == 6 and "It goes on." in clean and "# Head" in clean and "The end," in clean
    assert not any(x in clean for x in ("Home", "See also", "Imprint"))


LONG = "In its long valley, the river runs, and ends, after many miles. " * 8


@pytest.mark.parametrize(
    "text,kept,gone",
    [
        ("Short line.\n\nShort line.\n\nShort line.\n\n{{Box\n| name = " + LONG + "\n| area = 3\n}}", ["Short line."], []),
        ("Tiny.\n\n* " + LONG + "\n\nTiny two.", ["Tiny.", "Tiny two.", LONG.strip()], []),
        ("<nav>Menu</nav><div><p>Real text, of which there is enough. And more.</p></div>", ["Real text"], ["Menu"]),
        ("<nav>Home | About</nav><div><p>" + LONG + "</p><p>" + LONG + "</p></div><footer>Imprint</footer>", [LONG.strip()], ["Home", "Imprint"]),
        ("<p>Short.</p>\n<p>Also short.</p>\n<div>" + LONG * 3 + "</div>", ["Short.", "Also short.", LONG.strip()], []),
        ("<figure><img src=x><figcaption>A town</figcaption></figure><p>" + LONG + "</p><p>" + LONG + "</p>", [LONG.strip()], ["A town"]),
    ],
)
def test_prose_is_never_lost(text, kept, gone):
    clean = clean_markup(text)[0]
    assert all(x in clean for x in kept) and not any(x in clean for x in gone), clean


@pytest.mark.parametrize("unit", ["<div>", "<div>a\n", "<b>", "</p>", "<p>a"])
def test_tag_paths_of_many_tags(unit):
    assert isinstance(clean_markup(unit * 5000)[0], str)


@pytest.mark.parametrize("unit", [" _a", "`a ", "[", "[[", " *a", "{{", "}}", "$a ", "&lt;ref&gt;", "* a\n", "# a\n\n", "| a | b\n", "&lt;ul&gt;", "\\href{"])
def test_markup_of_long_openings(unit):
    assert isinstance(clean_markup(unit * 5000)[0], str)


# -- scores and frequencies -------------------------------------------------------
def test_scores(spark):
    data = [(1, "r1", "a", 2), (1, "r1", "a", 2), (2, "r1", "b", 1), (3, "r2", "a", None), (4, "r2", "c", 4), (5, " ", "a", 9), (6, None, "a", 9), (7, "r1", None, 9), (8, "r1", "a", 3)]
    df = spark.createDataFrame(data, "id int, r string, t string, n bigint").withColumn("tf", F.lit("clash"))
    got = {(x.r, x.t): x for x in score_terms(df, "r", "t", "n", "id").collect()}
    assert {k: (v.tf, v.record_total, v.term_total, v.record_count) for k, v in got.items()} == {("r1", "a"): (5, 6, 5, 2), ("r1", "b"): (1, 6, 1, 1), ("r2", "a"): (0, 4, 5, 2), ("r2", "c"): (4, 4, 4, 1)}
    tfn, lam = 5 * log2(1 + 5 / 6), 5 / 2
    assert got[("r1", "a")].score == pytest.approx((log2(1 + lam) + tfn * log2((1 + lam) / lam)) / (tfn + 1))
    assert got[("r2", "a")].score == 0
    assert score_terms(df.limit(0), "r", "t", "n", "id").count() == 0


def test_frequencies(spark):
    data = [(1, "a", "u", 1), (1, "a", "u", 1), (2, "a", "v", 1), (3, "b", None, 5), (4, None, "w", 5), (5, "c", " ", None), (6, "a", "u", None)]
    df = spark.createDataFrame(data, "id int, t string, r string, n bigint").withColumn("term", F.lit(1))
    got = {x.term: tuple(x)[1:] for x in term_frequencies(df, "t", "r", "n", "id", 3, 0.4).collect()}
    assert got == {"a": (2, 2, 4, True, True), "b": (5, 0, 4, False, False), "c": (0, 1, 4, True, False)}
    got = {x.term: tuple(x)[1:4] for x in term_frequencies(df, "t", "r", "n", "id", blank_records=False).collect()}
    assert got["c"] == (0, 0, 3)
    assert term_frequencies(df.limit(0), "t", "r", "n", "id").count() == 0


# -- leaks ---------------------------------------------------------------------------
def longest_run(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
        best = max(best, *row)
    return best


@pytest.mark.parametrize("near", [1 << 20, 0])
def test_leaks(spark, near):
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([5, 14, 30])))) for i in range(8)] + [(100, None), (101, "")]
    docs = []
    for i in range(60):
        text = rnd.choices(vocabulary, k=40)
        if i % 3 == 0:
            own = words(items[i % 8][1])
            text[10:20] = own[: rnd.choice([6, 12, 13, 30])]
        docs.append((i, "... ".join(text).upper(), "x"))
    docs += [(900, None, "x"), (901, "", "x")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id string")
    t = spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id): r for r in find_leaks(d, t, broadcast_bytes=near).collect()}
    want = {(i, j) for i, x, _ in docs for j, y in items if x and y and longest_run(words(x), words(y)) >= 12}
    assert {k for k, v in got.items() if v.exact_words >= 12} == want and want
    assert find_leaks(d.limit(0), t).count() == 0 and find_leaks(d, t.limit(0)).count() == 0


@pytest.mark.parametrize("near", [1 << 20, 0])
def test_leaks_of_edited_copies(spark, near):
    rnd = random.Random(8)
    items = [(i, " ".join(f"w{rnd.randrange(60)}" for _ in range(40))) for i in range(6)]
    docs = []
    for i in range(40):
        own = words(items[i % 6][1])
        for j in range(rnd.randrange(6), 40, rnd.choice([5, 7, 9, 11])):  # a word changed every few words
            own[j] = f"new{i}"
        docs.append((i, " ".join(rnd.choices(["a", "b", "w1", "w2", "w3"], k=rnd.randrange(50)) + own + rnd.choices(["c", "w4", "w5"], k=30))))
    docs.append((40, docs[0][1] + " and now " * 30 + docs[1][1]))
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    t = spark.createDataFrame(items, "item_id int, text string")
    grams = lambda text: {tuple(words(text)[j : j + 6]) for j in range(len(words(text)) - 5)}
    want = {}
    for i, x in docs:
        for j, y in items:
            score, _, _, longest = align(words(x), words(y))
            if grams(x) & grams(y) and score >= 8:
                want[i, j] = score, longest
    assert len(want) > 25 and min(v[1] for v in want.values()) < 8
    assert {(r.doc_id, r.item_id): (r.score, r.exact_words) for r in find_leaks(d, t, broadcast_bytes=near).collect()} == want
    exact = find_leaks(d, t, broadcast_bytes=near, min_words=8, exact=True).collect()
    assert {(r.doc_id, r.item_id): (r.score, r.exact_words) for r in exact} == {k: v for k, v in want.items() if v[1] >= 8}


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("near", [1 << 20, 0])
def test_leaks_of_two_texts_of_one_item(spark, near, exact):
    leaked, other = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    t = spark.createDataFrame([(1, leaked), (1, other), (2, other)], "item_id int, text string")
    d = spark.createDataFrame([(7, "so " + leaked.rsplit(" ", 15)[0] + " it is"), (8, "none of it")], "doc_id bigint, text string")
    got = find_leaks(d, t, broadcast_bytes=near, exact=exact).collect()
    assert [(r.doc_id, r.item_id, r.exact_words) for r in got] == [(7, 1, 15)]


@pytest.mark.parametrize("every", [8, 10, 12, 14])
@pytest.mark.parametrize("near", [1 << 20, 0])
def test_recall_of_edited_copies(spark, every, near):
    """A copy of an item with one word in so many replaced, and no exact copy elsewhere."""
    rnd = random.Random(every)
    word = lambda: f"w{rnd.randrange(5000)}"
    items = [(i, " ".join(word() for _ in range(60))) for i in range(40)]
    docs = []
    for i, text in items:
        own = text.split()
        own[every // 2 :: every] = [f"new{i}_{k}" for k in range(len(own[every // 2 :: every]))]
        docs.append((i, " ".join([word() for _ in range(80)] + own + [word() for _ in range(80)])))
    d, t = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(d, t, broadcast_bytes=near).collect()}
    assert len(got & {(i, i) for i, _ in items}) >= 0.9 * len(items) and len(got) <= len(items) + 2


def test_hot_seeds_and_repeated_items(spark, monkeypatch):
    """A passage in all documents, with every join of seeds split, and an item that stands twice."""
    from linkloom.operators import lookup

    monkeypatch.setattr(lookup, "SMALL_BYTES", -1)
    monkeypatch.setattr("linkloom.llm.leaks.SMALL_BYTES", -1)
    for module in ("linkloom.llm.leaks", "linkloom.operators.lookup"):
        monkeypatch.setattr(f"{module}.hot_keys", lambda rows, key, *_: [r[0] for r in rows.groupBy(key).count().where("count > 20").select(key).limit(500).collect()])
    common = "one of the most of the things that all texts here have in common"
    items = [(1, common), (1, common), (2, "and " + common + " too"), (3, "a b c d e f g h i j k l m n"), (4, "one of the most")]
    docs = [(i, f"x{i} {common} y{i}") for i in range(60)] + [(60, "nothing of it"), (61, "so a b c d e f g h i j k l m")]
    d, t = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    for exact in (True, False):
        for near in (1 << 20, 0):
            got = [(r.doc_id, r.item_id) for r in find_leaks(d, t, broadcast_bytes=near, exact=exact).collect()]
            assert sorted(got) == sorted([(i, j) for i in range(60) for j in (1, 2)] + [(61, 3)])


def test_alignment_of_many():
    rnd = random.Random(9)
    item = rnd.choices("abcdefgh", k=30)
    docs = [rnd.choices("abcdefghxyz", k=rnd.randrange(120)) for _ in range(50)] + [[], item, item[:14] + ["x"] * 4 + item[11:]]
    for x, got in zip(docs, align_all(docs, item, 4)):
        score, _, _, longest = align(x, item)
        assert got == (score, longest) or max(score, longest) < 4
    assert align_all([], item, 4) == [] and align_all([["x"]], item, 4) == [(0, 0)]


def test_alignment():
    item = "a b c d e f g h i j".split()
    assert align(item, item)[0] == 10 and align(item, item)[3] == 10
    assert align("x a b c d Q f g h i j".split(), item)[0] == 8  # one word replaced: 9 - 1
    assert align("a b c d f g h i j".split(), item)[0] == 8  # one left out
    assert align("a b c d Z e f g h i j".split(), item)[0] == 9  # one put in
    assert align([], item)[0] == 0


# -- mixing -----------------------------------------------------------------------------
def test_mix(spark):
    rnd = random.Random(7)
    text = lambda: " ".join(rnd.choices(["river", "valley", "harbour", "bridge"], k=rnd.randrange(1, 60)))
    docs = [(i, text(), rnd.choice(["A", " a ", "B", "C", None])) for i in range(900)] + [(2000, None, "a"), (2001, "", "b")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("copies", F.lit("clash"))
    t = spark.createDataFrame([("a", 0.6, 9), ("B", 0.1, 3), ("c", 0.25, 1), ("none", 0.05, 4)], "source string, target_share double, max_repeats int")
    mix = mix_sources(d, t)
    report = {r.source: r for r in mix.report.collect()}
    total = sum(len(tokenizers.load().own.encode_ordinary(x[1] or "")) for x in docs)
    for s, share in (("a", 0.6), ("b", 0.1)):
        assert abs(report[s].reached_tokens - share * total) < 0.03 * share * total + 60
    assert {s for s, r in report.items() if r.short} == {"c", "none"}
    assert report["c"].reached_tokens == report["c"].tokens and report["none"].reached_tokens == 0
    assert sum(r.actual_share for r in report.values()) == pytest.approx(1)
    for r in mix.selection.collect():
        assert 1 <= r.copies <= {"a": 9, "b": 3, "c": 1}[r.source]
    assert rows(mix.selection) == rows(mix_sources(d.repartition(5), t).selection)  # the draw follows from the ids
    assert mix_sources(d.limit(0), t).selection.count() == 0
    assert mix_sources(d, t.limit(0)).report.count() == 0


def test_mix_inclusion(spark):
    """Within a source a document is drawn with odds that grow with the square root of its tokens."""
    short, middle, long = "river " * 20, "river " * 80, "river " * 320
    d = spark.createDataFrame([(i, (short, middle, long)[i % 3], "a") for i in range(6000)], "doc_id int, text string, source string")
    t = spark.createDataFrame([("a", 0.2, 1)], "source string, target_share double, max_repeats int")
    mix = mix_sources(d, t)
    r = mix.report.first()
    assert abs(r.reached_tokens / r.target_tokens - 1) < 0.005
    drawn = Counter(x.n_tokens for x in mix.selection.collect())
    a, b, c = (drawn[n] / 2000 for n in sorted(drawn))
    sizes = sorted(drawn)
    assert b / a == pytest.approx((sizes[1] / sizes[0]) ** 0.5, rel=0.05) and c / b == pytest.approx((sizes[2] / sizes[1]) ** 0.5, rel=0.05)


def test_mix_of_many_sources_and_sizes(spark):
    """Some documents certain by their length, some sources used several times over, hundreds of sources."""
    rnd = random.Random(5)
    docs = [(i, "word " * rnd.choice([1, 3, 40, 300]), f"s{i % 300}") for i in range(3000)]
    d = spark.createDataFrame(docs, "doc_id int, text string, source string")
    t = spark.createDataFrame([(f"S{i} ", 1 / 300, 3) for i in range(300)], "source string, target_share double, max_repeats int")
    for r in mix_sources(d, t).report.collect():
        assert r.reached_tokens <= 3 * r.tokens and r.most_copies <= 3
        assert r.reached_tokens == 3 * r.tokens if r.short else abs(r.reached_tokens - r.target_tokens) <= 301


# -- splitting ------------------------------------------------------------------------------
TEXTS = {
    1: "\n\n".join("The river passes the old town. It turns west, then north; it ends there. " * rnd for rnd in (3, 5, 1, 7, 2, 9)),
    2: "x" * 3000,
    3: "のなためなふすははわておす。" * 60,
    4: "short",
    5: "",
    6: None,
    7: "word " * 2000,
    8: "😀" * 400,
}


@pytest.mark.parametrize("limit,overlap", [(100, 0), (100, 20), (50, 49)])
def test_split(spark, limit, overlap):
    tokens = tokenizers.load()
    df = spark.createDataFrame([(k, v, "x") for k, v in TEXTS.items()], "id int, text string, piece string")
    got = defaultdict(list)
    for r in split_items(df, "id", "text", limit, overlap, only_oversized=False).collect():
        got[r.id].append(r)
    assert {*got} == {*TEXTS}
    for k, v in TEXTS.items():
        pieces = sorted(got[k], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == [*range(pieces[0].pieces)]
        if not v:
            assert [(r.n_tokens, r.piece_text) for r in pieces] == [(0, v)]
            continue
        assert all(r.n_tokens <= limit and v[r.start : r.end] == r.piece_text for r in pieces)
        joined, at = "", 0
        for r in pieces:  # pieces less their overlaps give the text back
            assert r.start <= at
            joined, at = joined + v[at : r.end], r.end
        assert joined == v
        if overlap == 20 and len(pieces) > 1 and k in (1, 7):
            for a, b in zip(pieces, pieces[1:]):
                assert abs(tokens.count(v[b.start : a.end]) - overlap) <= 2
    over = {r.id for r in split_items(df, "id", "text", limit, overlap).collect()}
    assert over == {k for k, v in TEXTS.items() if v and tokens.count(v) > limit}


def test_split_tells_the_overlap_used(spark):
    df = spark.createDataFrame([(1, TEXTS[7]), (2, TEXTS[4]), (3, TEXTS[5]), (4, "😀é𝕏 " * 40)], "id int, text string")

    def used(limit, overlap):
        return {r.id: (r.overlap, r.halved) for r in split_items(df, "id", "text", limit, overlap, only_oversized=False).collect()}

    assert used(100, 20) == {i: (20, False) for i in (1, 2, 3, 4)}
    got = used(3, 2)
    assert got[3] == (2, False) and got[4] == (0, True)


def test_split_prefers_natural_boundaries():
    spans = split_text(TEXTS[1], 100, 0, tokenizers.load())
    assert sum(TEXTS[1][b - 2 : b] in ("\n\n", ". ") or b == len(TEXTS[1]) for _, b, _ in spans) == len(spans)


def test_split_of_nearly_full_pieces():
    """The least number of pieces leaves no room for boundaries here, so one more is cut, at paragraphs."""
    tokens = tokenizers.load()
    text = "\n\n".join("The river passes the old town. It turns west, then north; it ends there. " * (1 + i * 7 % 4) for i in range(40))
    n = tokens.count(text)
    limit = (n + 2 * 20) // 3 + 1
    spans = split_text(text, limit, 20, tokens)
    assert len(spans) == 4 and all(text[b - 2 : b] == "\n\n" for _, b, _ in spans[:-1]) and max(s for _, _, s in spans) <= limit


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_tokenizers(name):
    t = tokenizers.load(tokenizers.FOLDER, name)
    for text in ("The river, the town. " * 40, "été où ça 😀 " * 30):
        ends = t.ends(text)
        assert len(ends) == t.count(text) and ends == sorted(ends) and ends[-1] <= len(text)
        spans = split_text(text, 60, 10, t)
        assert all(s <= 60 for _, _, s in spans) and spans[-1][1] == len(text)


def test_counter_is_used():
    assert Counter(words("A-b a_B")) == {"a": 2, "b": 2}
