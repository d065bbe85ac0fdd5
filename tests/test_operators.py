"""Relations against the hand-made golden, brute force and properties."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.operators import context, lookup, ngrams, pairs, skew
from linkloom.operators.redirects import redirect_table, resolve
from linkloom.operators.repeats import without_repeats

RAW = [("Paris", "Paris", 5), ("paris", "the city", 3), ("Lutetia", "Lutece", 4), ("Lutetia", "rare", 2), ("Ghost", "Ghost", 9), ("Loop A", "loop", 3), ("Paris", "x,", 7), (None, "n", 9), ("Paris", None, 9)]
REDIRECTS = [("Lutetia", "Old Paris"), ("Old Paris", "Paris"), ("Loop A", "Loop B"), ("Loop B", "Loop A")]
TITLES = ["Paris", "Lutetia", "Old Paris", "Loop A", "Loop B"]


@pytest.fixture(scope="module")
def resolved(spark):
    raw = spark.createDataFrame(RAW, "uri string, sf string, count bigint")
    red = spark.createDataFrame(REDIRECTS, "title string, target string")
    titles = spark.createDataFrame([(t,) for t in TITLES], "title string")
    return pairs.resolved_pairs(raw, red, titles, 3).cache()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_pair_counts(resolved):
    base = "http://dbpedia.org/resource/"
    assert rows(pairs.pair_counts(resolved)) == [("Lutece", base + "Paris", 4), ("Paris", base + "Paris", 5), ("loop", base + "Loop_B", 3), ("the city", base + "Paris", 3)]
    assert rows(pairs.uri_counts(resolved)) == [(base + "Loop_B", 3), (base + "Paris", 12)]
    assert rows(pairs.sf_counts(resolved)) == [("Lutece", 4), ("Paris", 5), ("loop", 3), ("the city", 3)]


@pytest.mark.parametrize("mode", ["compat", "fixed"])
def test_sf_totals(spark, resolved, mode):
    par = spark.createDataFrame([("the city of Paris. Paris Inc.",)], "paragraph string")
    got = rows(ngrams.sf_total_counts(pairs.sf_counts(resolved), par, mode=mode))
    low = 2 if mode == "compat" else 0
    assert got == [("Lutece", 4, 0), ("Paris", 5, 2), ("loop", 3, 0), ("lutece", -1, 0), ("paris", -1, low), ("the city", 3, 1)]
    more = spark.createDataFrame([("Paris.", 1), ("Paris Inc.", 1)], "sf string, count bigint")
    assert rows(ngrams.text_counts(par, more)) == [("Paris Inc.", 1), ("Paris.", 1)]


def test_resolve_random_graphs(spark):
    rnd = random.Random(5)
    red = {f"N{i}": f"{rnd.choice('Nn')}{rnd.randrange(40)}" for i in range(40) if rnd.random() < 0.8}
    chain = {f"C{i}": f"C{i + 1}" for i in range(20)}
    red |= chain

    def hops(x):
        for _ in range(15):
            nxt = red.get(x) or red.get(x[:1].upper() + x[1:])
            if nxt is None:
                return x
            x = nxt
        return x

    table = spark.createDataFrame([*red.items()], "title string, target string")
    asked = [*red, *red.values(), "none", "c0", ""]
    got = resolve(spark.createDataFrame([(a,) for a in asked] + [(None,)], "uri string"), "uri", table)
    assert {r.uri: r.resolved for r in got.collect()} == {a: hops(a) for a in asked} | {None: None}
    assert got.count() == len(asked) + 1


def test_redirect_table_is_deterministic(spark):
    df = spark.createDataFrame([("a", "z"), ("a", "b"), (None, "x"), ("c", None)], "title string, redirect string")
    assert rows(redirect_table(df)) == [("a", "b")]


PIECES = {
    "Apple Inc. is  a": ["Apple", " ", "Inc", ".", " ", "is", "  ", "a"],
    "co-op, don't": ["co-op", ",", " ", "don't"],
    "$3.14 1,000 5% #1 €5": ["$3.14", " ", "1,000", " ", "5%", " ", "#1", " ", "€5"],
    "U.S.A. e.g.": ["U.S.A", ".", " ", "e.g", "."],
    "AT&T x_y 2008-2009": ["AT", "&", "T", " ", "x_y", " ", "2008", "-", "2009"],
    "R2-D2 C-3PO": ["R2", "-", "D2", " ", "C", "-", "3PO"],
    "l'avion d'été": ["l'avion", " ", "d'été"],
    "don’t": ["don", "’", "t"],
    "x \ny": ["x", " \n", "y"],
    "A\n\nB": ["A", "\n", "\n", "B"],
    "": [],
}


def test_pieces(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(PIECES)], "i int, t string").orderBy("i")
    assert [r.p for r in df.select(ngrams.pieces(F.col("t")).alias("p")).collect()] == [*PIECES.values()]


def test_ngrams(spark):
    df = spark.createDataFrame([("Apple Inc. is  a",)], "t string")
    got = [r.g for r in ngrams.with_ngrams(df, "t", "g", 2).collect()]
    assert sorted(got) == sorted(["Apple", "Apple Inc", "Apple Inc.", "Inc", "Inc.", "Inc. is", "is", "is  ", "  ", "  a", "a"])
    assert sorted(r.g for r in ngrams.with_simple_ngrams(df, "t", "g", 2).collect()) == ["Apple", "Apple Inc", "Inc", "Inc is", "a", "is", "is a"]
    odd = spark.createDataFrame([("",), (None,), ("...",), ("a",)], "t string")
    for make in (ngrams.with_ngrams, ngrams.with_simple_ngrams):
        assert [r.g for r in make(odd, "t", "g").collect()] == ["a"]


def test_large_form_lists(spark, monkeypatch):
    par = spark.createDataFrame([("the city of Paris. Paris Inc.",), (None,)], "paragraph string")
    forms = spark.createDataFrame([("Paris",), ("Paris Inc.",), ("none",), (None,)], "sf string")
    small = rows(ngrams.text_counts(par, forms))
    monkeypatch.setattr(ngrams, "FORM_BYTES", 0)
    assert rows(ngrams.text_counts(par, forms)) == small == [("Paris", 2), ("Paris Inc.", 1)]


def test_contexts(spark):
    tokens = spark.createDataFrame([(1, "river", 2), (1, "seine", 1), (2, "river", 1), (2, "tower", 1)], "par_key int, token string, n bigint")
    ment = spark.createDataFrame([(1, "Paris"), (1, "Paris"), (2, "Paris"), (2, "Once"), (3, "Lone"), (4, "Lone"), (1, ""), (2, ""), (1, " "), (2, " ")], "par_key int, uri string")
    got = context.ranked_tokens(context.token_counts(ment, tokens, "par_key", 2), context.qualifying(ment, 2))
    lines = rows(got.select(context.wiki_uri(F.col("uri")), context.token_line(F.col("tokens"))))
    assert lines == [("http://en.wikipedia.org/wiki/Lone", "{}"), ("http://en.wikipedia.org/wiki/Paris", "{(river,5),(seine,2)}")]


def test_known_keys(spark):
    counts = spark.createDataFrame([("http://fr.dbpedia.org/resource/Paris", 1)], "std_uri string, count bigint")
    assert rows(context.known_keys(counts, "fr", "compat")) == [("ce/Paris",)]
    assert rows(context.known_keys(counts, "fr", "fixed")) == [("Paris",)]


def test_look_up_with_hot_key(spark):
    left = spark.createDataFrame([("hot", i) for i in range(300)] + [(f"k{i}", i) for i in range(50)] + [(None, 7)], "k string, x int")
    right = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, y int")
    for how in ("left", "inner"):
        got = lookup.look_up(left, "k", right, how, hot=["hot"])
        assert sorted(got.collect(), key=str) == sorted(left.join(right, "k", how).select("k", "x", "y").collect(), key=str)
        assert sorted(lookup.look_up(left, "k", right, how).collect(), key=str) == sorted(got.collect(), key=str)
    assert lookup.hot_keys(left, "k", 4, 100) == ["hot"] and lookup.hot_keys(left, "k", 4) == []
    assert len(lookup.hot_keys(left, "k", 4, 1)) == 4


def test_look_up_searches_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(lookup, "SMALL_BYTES", -1)
    left = spark.range(25_000).selectExpr("if(id < 12000, 1, id) as k", "id as x")
    right = spark.createDataFrame([(1, 1), (13_000, 2)], "k bigint, y int")
    assert lookup.hot_keys(left, "k") == [1]
    got = lookup.look_up(left, "k", right, "inner").groupBy("k").agg(F.count("x").alias("n"), F.max("y").alias("y"))
    assert rows(got) == [(1, 12_000, 1), (13_000, 1, 2)]


def test_look_up_of_structs(spark):
    key = F.struct(F.col("k").alias("a"), (F.col("x") % 2).alias("b"))
    left = spark.createDataFrame([("hot", 2 * i) for i in range(300)] + [(f"k{i}", i) for i in range(50)], "k string, x int").select(key.alias("key"), "x")
    right = spark.createDataFrame([("hot", 0, 1), ("k3", 1, 2)], "k string, x int, y int").select(key.alias("key"), "y")
    hot = lookup.hot_keys(left, "key", 4, 100)
    assert len(hot) == 1
    got = lookup.look_up(left, "key", right, "inner", hot=hot)
    assert sorted((r.x, r.y) for r in got.collect()) == sorted([(2 * i, 1) for i in range(300)] + [(3, 2)])


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_without_repeats(spark, bound):
    data = [(1, "a"), (2, "b"), (2, "b"), (3, "c"), (3, "c"), (3, "c"), (None, "x"), (None, "x")]
    df = spark.createDataFrame(data, "id int, __n string")
    assert sorted(map(tuple, without_repeats(df, "id", bound).collect()), key=str) == sorted([*set(data), (None, "x")], key=str)
    assert without_repeats(df.limit(0), "id", bound).count() == 0
    assert rows(without_repeats(df.where("id < 2"), "id", bound)) == [(1, "a")]


def test_join_split(spark):
    left = spark.createDataFrame([("hot", i) for i in range(300)] + [(None, 7)] + [(f"k{i}", i) for i in range(9)], "k string, x int")
    right = spark.createDataFrame([("hot", i) for i in range(5)] + [("k3", 1), ("k3", 2), (None, 1)], "k string, y int")
    want = rows(left.join(right, "k").select("k", "x", "y"))
    for hot in (["hot"], [], None):
        assert rows(lookup.join_split(left, right, "k", hot, 7).select("k", "x", "y")) == want


def test_eager_join_of_many_states(spark):
    rnd = random.Random(3)
    left = spark.createDataFrame([(rnd.choice("aab"), rnd.choice("xy"), rnd.randrange(3), 1) for _ in range(90)], "k string, j string, g int, v int")
    right = spark.createDataFrame([(rnd.choice("abc"), rnd.choice("xy"), rnd.randrange(4), 2) for _ in range(70)], "k string, j string, h int, w int")
    for lk, rk in ((["g"], ["h"]), ([], ["h"]), (["g"], []), ([], [])):
        for on in (["k"], ["k", "j"]):
            got = skew.eager_join(left, right, on, left_keys=lk, right_keys=rk, left_values={"lv": "v"}, right_values={"rv": "w"})
            full = left.withColumnRenamed("j", "j" if len(on) > 1 else "lj").join(right, on).groupBy(*on, *lk, *rk).agg(F.count(F.lit(1)), F.sum("v"), F.sum("w"))
            assert rows(got.select(*on, *lk, *rk, "rows", "lv_sum", "rv_sum")) == rows(full)


def test_eager_join_equals_join(spark):
    rnd = random.Random(2)
    left = spark.createDataFrame([(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([1, 2, None]), rnd.randrange(3)) for _ in range(200)], "k string, v int, g int")
    right = spark.createDataFrame([(rnd.choice(["a", "b", "c", None]), rnd.choice([5, None]), 1) for _ in range(60)], "k string, w int, v int")
    got = skew.eager_join(left, right, ["k"], left_keys=["g"], left_values={"lv": "v"}, right_values={"rv": "w"})
    full = left.alias("l").join(right.alias("r"), "k").groupBy("k", "g").agg(F.count(F.lit(1)), F.sum("l.v"), F.min("l.v"), F.max("l.v"), F.count("l.v"), F.sum("w"), F.min("w"), F.max("w"), F.count("w"))
    names = ["k", "g", "rows", "lv_sum", "lv_min", "lv_max", "lv_n", "rv_sum", "rv_min", "rv_max", "rv_n"]
    assert rows(got.select(*names)) == rows(full)
    assert skew.eager_join(left.limit(0), right, ["k"]).count() == 0
    with pytest.raises(ValueError):
        skew.eager_join(left, right, ["k"], left_values={"x": "v"}, right_values={"x": "w"})


def test_heavy_keys(spark):
    data = [("f", "big")] * 50 + [("f", f"s{i}") for i in range(46)] + [("f", None)] * 2 + [("f", " ")] * 2 + [("g", "only")] + [(None, "x")]
    df = spark.createDataFrame(data, "field string, rows string")  # a name that clashes with the result's
    got = {tuple(r) for r in skew.heavy_keys(df.withColumnRenamed("rows", "key"), "field", "key", 0.02).collect()}
    assert got == {("f", "big", 50, 100), ("g", "only", 1, 1)}
    assert skew.heavy_keys(df.limit(0), "field", "rows").count() == 0


def test_key_states_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "k string, v int")
    got = {r.k: (r.rows, r.v_sum, r.v_min, r.v_max, r.v_n) for r in skew.key_states(df, ["k"], {"v": "v"}).collect()}
    assert got == {"a": (2, 1, 1, 1, 1), None: (1, 3, 3, 3, 1)}


def test_all_ngrams_are_counted(spark, tmp_path):
    from linkloom.plans.queries import QUERIES

    texts = ["the old town", "the old bridge", None, ""]
    docs = spark.createDataFrame([(i, t, None, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, uri string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.gram: r.n for r in QUERIES["paragraph_ngram_counts"](spark, str(tmp_path)).collect()}
    assert got == {"the": 2, "old": 2, "the old": 2, "town": 1, "old town": 1, "the old town": 1, "bridge": 1, "old bridge": 1, "the old bridge": 1}
    assert QUERIES["paragraph_ngrams"](spark, str(tmp_path)).count() == 0  # its floor is that of its SQL
