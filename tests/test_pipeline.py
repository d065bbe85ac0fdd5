"""Dumps, settings, outputs, the whole run, and streams."""

import bz2
import gzip

import pytest
from pyspark.sql import functions as F

from linkloom.functions.tokenizers import analyze, english, french, french_light, porter, register, words_of
from linkloom.operators import pairs
from linkloom.plans import pipeline, sinks
from linkloom.plans.config import Config, from_properties
from linkloom.sources.pages import line_chunks, read_lines, read_pages, read_redirects, read_sf_counts, read_uri_counts, read_words, with_line_numbers
from linkloom.streaming.pages import start_to_table, stream_pages, stream_pair_counts

FILL = "The river runs through the valley of the northern province and past the old harbour of the town. "


def page(title, text, redirect=None, model="wikitext"):
    red = f'\n    <redirect title="{redirect}" />' if redirect else ""
    return f'  <page>\n    <title>{title}</title>{red}\n    <revision>\n      <model>{model}</model>\n      <text xml:space="preserve">{text}</text>\n    </revision>\n  </page>\n'


DUMP = "<mediawiki>\n  <siteinfo>x</siteinfo>\n" + "".join(
    [
        page("Paris", FILL + "See [[Lutetia|the old town]] and [[seine]].\n\n" + FILL + "[[Seine]] again [[Seine]]. "),
        page("Seine", FILL + "It flows by [[Paris|the city]] and [[Paris|the city]]. "),
        page("Lutetia", "#REDIRECT [[Paris]]", "Paris"),
        page("Data", FILL + "[[Paris|the city]]", model="json"),
    ]
) + "</mediawiki>\n"


@pytest.fixture()
def dumps(tmp_path):
    (tmp_path / "a.xml").write_text(DUMP, encoding="utf-8")
    (tmp_path / "b.xml.bz2").write_bytes(bz2.compress(DUMP.encode()))
    (tmp_path / "c.xml.gz").write_bytes(gzip.compress(DUMP.encode()))
    return tmp_path


def test_read_pages(spark, dumps):
    for name in ("a.xml", "b.xml.bz2", "c.xml.gz"):
        got = [r.page for r in read_pages(spark, str(dumps / name)).collect()]
        assert len(got) == 4, name
        assert got[0].startswith("    <title>Paris</title>\n") and got[0].endswith("</revision>")
    both = read_pages(spark, [str(dumps / "a.xml"), str(dumps / "c.xml.gz"), str(dumps / "missing"), str(dumps)])
    assert both.count() == 8 and both.select("path").distinct().count() == 2
    assert read_pages(spark, str(dumps / "a.xml"), limit=3).count() == 3
    assert read_pages(spark, str(dumps / "missing")).count() == 0
    for name, like in (("d.dump", "b.xml.bz2"), ("e", "c.xml.gz"), ("f.gz", "a.xml"), ("g.bz2", "c.xml.gz")):  # content tells, not the name
        (dumps / name).write_bytes((dumps / like).read_bytes())
        assert read_pages(spark, str(dumps / name)).count() == 4, name


def test_unclosed_page_is_dropped(spark, tmp_path):
    (tmp_path / "x").write_text(page("A", "b") + "<page>\n<title>Open</title>\n")
    assert read_pages(spark, str(tmp_path / "x")).count() == 1
    (tmp_path / "y").write_text("<doc>\none\n</doc>\n<doc>\ntwo\nthree\n</doc>\n")
    assert sorted(r.page for r in read_pages(spark, str(tmp_path / "y"), "<doc>", "</doc>").collect()) == ["one", "two\nthree"]


def test_line_chunks(spark, tmp_path):
    df = spark.createDataFrame([(i, f"L{i}") for i in range(1, 6)], "i int, line string").repartition(3)
    got = [(r.chunk, r.lines, r.text) for r in line_chunks(df, ["i"], "line", 2).orderBy("chunk").collect()]
    assert got == [(0, 1, "L1\n"), (1, 2, "L2\nL3\n"), (2, 2, "L4\nL5\n")]
    big = spark.range(1000).repartition(7)
    assert [r.line_no for r in with_line_numbers(big, ["id"]).orderBy("id").collect()] == [*range(1, 1001)]
    (tmp_path / "w").write_text("the\nof\n")
    assert read_words(spark, str(tmp_path / "w")) == ["the", "of"]
    assert read_lines(spark, str(tmp_path / "none")).count() == 0


def test_config(tmp_path):
    f = tmp_path / "c.config"
    f.write_text("# comment\nlanguage=fr\nMIN_OCCURENCE_COUPLE = 3\noutput_folder=out\nlucene_analyzer: fr.FrenchAnalyzer\nunknown=1\n")
    c = from_properties(f)
    assert (c.language, c.min_occurence_couple, c.output_folder, c.analyzer, c.max_length_sf) == ("fr", 3, "out/", "fr.FrenchAnalyzer", 80)
    with pytest.raises(ValueError):
        Config(mode="other")


def read(folder):
    return sorted(line for f in folder.glob("part-*") for line in f.read_text(encoding="utf-8").splitlines())


def test_whole_run(spark, dumps):
    (dumps / "stop").write_text("the\nof\nand\n")
    config = Config(dump_file=str(dumps / "a.xml"), stop_words=str(dumps / "stop"), output_folder=f"{dumps}/out/", min_occurence_couple=2)
    out = pipeline.run(spark, config)
    base = "http://dbpedia.org/resource/"
    assert read(dumps / "out/pairCounts_en") == sorted([f"Seine\t{base}Seine\t2", f"the city\t{base}Paris\t2"])
    assert read(dumps / "out/uriCounts_en") == sorted([f"{base}Seine\t2", f"{base}Paris\t2"])
    assert {x.split("\t")[0] for x in read(dumps / "out/sfAndTotalCounts_en")} == {"Seine", "seine", "the city"}
    tokens = dict(x.split("\t") for x in read(dumps / "out/tokenCounts_en"))
    assert {*tokens} == {"http://en.wikipedia.org/wiki/Seine", "http://en.wikipedia.org/wiki/Paris"}
    assert "(river,4)" not in tokens["http://en.wikipedia.org/wiki/Paris"] and "(river,3)" in tokens["http://en.wikipedia.org/wiki/Paris"]
    assert {*out} == {"pairCounts", "uriCounts", "sfAndTotalCounts", "tokenCounts"}


@pytest.mark.parametrize("copies", [1, 2, 3])
def test_repeated_pages_add_up(spark, copies):
    """A page that is in the dump k times counts its context tokens k times, not k * k."""
    text = "  <page>\n    <title>Paris</title>\n    <model>wikitext</model>\n" + "x" * 30 + '\n    <text xml:space="preserve">river and river [[Paris|the city]] or [[Paris|the city]].</text>'
    config = Config(min_occurence_couple=1, min_nb_contexts=1, filter_by_size=False)
    pages = pipeline.parsed_pages(spark.createDataFrame([(text,)] * copies, "page string"), config, ["and", "or", "the"])
    got = {r.uri: {t.token: t["count"] for t in r.tokens} for r in pipeline.context_counts(pages, pipeline.link_stats(pages, config), config).collect()}
    assert got == {"Paris": {"river": 4 * copies, "citi": 4 * copies}}


def test_intermediate_files(spark, dumps):
    (dumps / "stop").write_text("the\n")
    config = Config(dump_file=str(dumps / "a.xml"), stop_words=str(dumps / "stop"), output_folder=f"{dumps}/out/", tmp_folder=f"{dumps}/tmp/", min_occurence_couple=2)
    out = pipeline.run(spark, config)
    assert read(dumps / "tmp/tmp_redirections_en") == ["Lutetia,,Paris"]
    assert sorted(map(tuple, read_redirects(spark, out["tmp_redirections"]).collect())) == [("Lutetia", "Paris")]
    assert sorted(map(tuple, read_sf_counts(spark, out["tmp_surface_form_counts"]).collect())) == [("Seine", 2), ("the city", 2)]
    assert sorted(map(tuple, read_uri_counts(spark, out["uriCounts"]).collect())) == [("http://dbpedia.org/resource/Paris", 2), ("http://dbpedia.org/resource/Seine", 2)]
    # paragraphs 1 and 2 are those of Paris, 3 that of Seine; the first mentions Paris by a redirect
    assert read(dumps / "tmp/tmp_mentions_en") == ["Paris,,1,,3,,3", "Seine,,1,,2,,2"]
    sinks.write_mentions(spark.createDataFrame([("A", 3), ("A", 1), ("B", 2), (None, 1), (None, 2)], "uri string, par_id bigint"), str(dumps / "index"), 2)
    assert read(dumps / "index") == ["A,,1,,3"]


@pytest.mark.parametrize("parts", [1, 8])
def test_independent_of_partitions(spark, dumps, parts):
    pages = pipeline.parsed_pages(read_pages(spark, str(dumps / "a.xml")).repartition(parts))
    stats = pipeline.link_stats(pages)
    assert sorted(map(tuple, stats.resolved.collect())) == [("Paris", "the city", 2), ("Seine", "Seine", 2)]
    n = [df.groupBy().sum("count").first()[0] for df in (pairs.pair_counts(stats.resolved), pairs.uri_counts(stats.resolved), pairs.sf_counts(stats.resolved))]
    assert n[0] == n[1] == n[2]
    pipeline.register_views(spark, pages, stats)
    assert spark.sql("select count(*) from uri_counts").first()[0] == 2


def test_map_pages(spark):
    df = spark.createDataFrame([("a\nb",), (None,), ("",)], "page string")
    assert sorted(r.output for r in pipeline.map_pages(df, lambda p: p.split("\n") if p else []).collect()) == ["a", "b"]


def test_analyzers(spark):
    assert [porter(w) for w in ("caresses", "ponies", "relational", "hopping", "sky", "motoring", "generalizations", "falling")] == ["caress", "poni", "relat", "hop", "sky", "motor", "gener", "fall"]
    assert english("The king's horses, running quickly", frozenset({"the"})) == ["king", "hors", "run", "quickli"]
    assert french("L'avion d'été vole", frozenset()) == ["avion", "été", "vole"]
    assert [french_light(w) for w in ("chevaux", "généraux", "journaux", "maisons", "nettement", "finissement", "professeur", "nationale", "formatrice", "attentive")] == ["cheval", "general", "journal", "maison", "nete", "fini", "profeseu", "national", "form", "atentif"]
    assert words_of("U.S.A. x_y 3.14 1,000 o'clock a:b don’t, 漢字 かな カタカナ e\u0301t _a_ __ C-3PO " + "x" * 300) == ["U.S.A", "x_y", "3.14", "1,000", "o'clock", "a:b", "don’t", "漢", "字", "か", "な", "カタカナ", "e\u0301t", "_a_", "C", "3PO"]
    with pytest.raises(ValueError, match="unknown analyzer"):
        analyze(F.lit("a"), "en.Englsh")
    register("shout", lambda text, stop: text.upper().split())
    df = spark.createDataFrame([("a b",), (None,), ("",)], "t string")
    assert [r.x for r in df.select(analyze(df.t, "shout").alias("x")).collect()] == [["A", "B"], None, []]


def test_stream_equals_batch(spark, dumps, tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    (folder / "1.xml").write_text(DUMP)
    (folder / "2.xml").write_text(DUMP)
    counts = stream_pair_counts(stream_pages(spark, str(folder)))
    start_to_table(counts, "live", str(tmp_path_factory.mktemp("ck"))).awaitTermination(120)
    got = {(r.uri, r.sf): r["count"] for r in spark.table("live").collect()}
    assert got[("Paris", "the city")] == 4 and got[("Seine", "Seine")] == 4
