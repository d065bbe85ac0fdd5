"""Queries that run the whole pipeline, or a source, over a dump made of whole tables,
and links of whole texts; all with SQL to hold them against."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links as L
from ..operators import context, pairs
from ..session import materialize_with, scratch_path
from ..sources.pages import read_pages
from ..sources.tables import table
from . import pipeline, sinks
from .config import Config
from .queries import _standard

# A dump of the documents: pages that come once, twice and three times.
REPEATED = Config(min_occurence_couple=2, min_nb_contexts=2, filter_by_size=False, analyzer="standard.StandardAnalyzer")


def _name(uri: Column) -> Column:
    plain = F.regexp_replace(F.translate(F.regexp_replace(uri, "^.*/resource/", ""), "_", " "), "[^A-Za-z0-9 ]", "")
    return F.trim(F.regexp_replace(plain, " +", " "))


def repeated_dump(spark: SparkSession, d: str) -> DataFrame:
    """(``page``): a page for each document with an address, 1 + doc_id mod 3
    times: its words and a link to the page's own title."""
    docs = table(spark, d, "documents").where("uri is not null")
    words = F.array_join(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]+"), F.lit(0)), " ")
    page = F.format_string(
        '    <title>%s</title>\n    <revision>\n      <model>wikitext</model>\n      <text xml:space="preserve">%s [[%s]].</text>\n    </revision>', _name(F.col("uri")), words, _name(F.col("uri"))
    )
    return docs.select(page.alias("page"), F.explode(F.expr("sequence(1, 1 + doc_id % 3)"))).select("page")


def _repeated(spark: SparkSession, d: str):  # noqa: ANN202
    stop = [r.word for r in table(spark, d, "stop_words").where("lang = 'en'").select("word").collect()]
    pages = pipeline.parsed_pages(repeated_dump(spark, d), REPEATED, stop)
    return pages, pipeline.link_stats(pages, REPEATED)


def wiki_pair_counts_repeated(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_counts(_repeated(spark, d)[1].resolved)


def wiki_sf_total_counts_repeated(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.form_counts(*_repeated(spark, d), REPEATED)


def wiki_token_counts_repeated(spark: SparkSession, d: str) -> DataFrame:
    ranked = pipeline.context_counts(*_repeated(spark, d), REPEATED)
    return ranked.select(context.wiki_uri(F.col("uri")).alias("uri"), context.token_line(F.col("tokens")).alias("tokens"))


def wiki_mention_index(spark: SparkSession, d: str) -> DataFrame:
    """The inverted index as its text output holds it: targets and how many paragraph numbers their lines have."""
    pages, stats = _repeated(spark, d)
    path = scratch_path(spark)
    sinks.write_mentions(context.numbered_paragraphs(pipeline.paragraph_mentions(pages, stats, REPEATED)), path, REPEATED.min_nb_contexts)
    fields = F.split("value", ",,", -1)
    return spark.read.text(path).select(fields[0].alias("uri"), (F.size(fields) - 1).cast("bigint").alias("mentions"))


def limited_scan(spark: SparkSession, d: str) -> DataFrame:
    """A run over so many pages of a dump, as for debugging."""
    path = scratch_path(spark)
    sinks.write_text(table(spark, d, "page"), "page", path)
    return read_pages(spark, f"{path}/part-*", limit=1000).agg(F.count(F.lit(1)).alias("pages"))


def page_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of the scan, gathered by the job that writes the pages."""
    page = table(spark, d, "page").select("page_id", "title", "redirect", "is_wikitext")
    _, seen = materialize_with(page, pages=F.count(F.lit(1)), titled=F.count("title"), redirecting=F.count("redirect"), wikitext=F.count_if("is_wikitext"))
    return spark.createDataFrame([tuple(seen[k] for k in ("pages", "titled", "redirecting", "wikitext"))], "pages bigint, titled bigint, redirecting bigint, wikitext bigint")


def _text_links(spark: SparkSession, d: str, nested: bool) -> DataFrame:
    found = table(spark, d, "page").where("contains(text, '[[')").select("page_id", F.explode(L.links(F.col("text"), nested)).alias("link"))
    return pairs.accepted_links(found).groupBy("page_id", "uri", "sf").agg(F.count(F.lit(1)).alias("links"))


def text_links_nested(spark: SparkSession, d: str) -> DataFrame:
    """Links of all depths of the stored texts."""
    return _text_links(spark, d, True)


def text_links_outer(spark: SparkSession, d: str) -> DataFrame:
    """Outermost links of the stored texts."""
    return _text_links(spark, d, False)


QUERIES = {f.__name__: f for f in (
    wiki_pair_counts_repeated, wiki_sf_total_counts_repeated, wiki_token_counts_repeated, wiki_mention_index, limited_scan, page_counters, text_links_nested, text_links_outer,
)}

_UP = "upper(left(name, 1)) || substr(name, 2)"
_DUMP = f"""
    p AS (SELECT doc_id, trim(regexp_replace(regexp_replace(replace(regexp_replace(uri, '^.*/resource/', ''), '_', ' '), '[^A-Za-z0-9 ]', '', 'g'), ' +', ' ', 'g')) AS name,
                 array_to_string(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+'), ' ') AS words, 1 + doc_id % 3 AS copies FROM documents WHERE uri IS NOT NULL),
    linked AS (SELECT *, {_UP} AS target FROM p WHERE length(name) BETWEEN 2 AND 80 AND len(string_split(name, ' ')) <= 5),
    res AS (SELECT target AS uri, name AS sf, sum(n)::BIGINT AS count
            FROM (SELECT target, name, sum(copies) AS n FROM linked GROUP BY ALL HAVING sum(copies) >= 2) WHERE target IN (SELECT name FROM p) GROUP BY ALL)"""
_MENTIONS = f"""{_DUMP},
    m AS (SELECT target, words, name, copies FROM linked WHERE length(words) + length(name) + 5 <= 5000 AND target IN (SELECT uri FROM res)),
    good AS (SELECT target AS uri, sum(copies)::BIGINT AS mentions FROM m GROUP BY 1 HAVING sum(copies) >= 2)"""


def _marks(outer: bool) -> str:
    """Links of page.text (page_id, k, raw). Marks are numbered along the text, with the depth around each."""
    if outer:
        # single characters: "[[" is read in pairs, a "]" before another closes
        return """
        c AS (SELECT page_id, k, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i FROM src),
        r AS (SELECT *, i - row_number() OVER (PARTITION BY page_id, k, ch ORDER BY i) AS run, lead(ch) OVER (PARTITION BY page_id, k ORDER BY i) AS nx FROM c),
        b AS (SELECT *, i - min(i) OVER (PARTITION BY page_id, k, ch, run) AS place FROM r WHERE ch IN ('[', ']')),
        v AS (SELECT page_id, k, i, CASE WHEN ch = '[' THEN 1 ELSE -1 END AS d FROM b WHERE nx = ch AND (ch = ']' OR place % 2 = 0)),
        s AS (SELECT *, sum(d) OVER (PARTITION BY page_id, k ORDER BY i) AS after FROM v),
        o AS (SELECT *, max(CASE WHEN d = 1 AND after = 1 THEN i END) OVER (PARTITION BY page_id, k ORDER BY i) AS start FROM s),
        raws AS (SELECT page_id, k, substr(text, (start + 2)::BIGINT, (i - start - 2)::BIGINT) AS raw FROM o JOIN src USING (page_id, k) WHERE d = -1 AND after = 0)"""
    return """
        c AS (SELECT page_id, k, unnest(regexp_extract_all(text, '\\[\\[|\\]\\]')) AS m, unnest(string_split_regex(text, '\\[\\[|\\]\\]')[:-2]) AS before,
                     generate_subscripts(regexp_extract_all(text, '\\[\\[|\\]\\]'), 1) AS i FROM src),
        v AS (SELECT page_id, k, i, CASE WHEN m = '[[' THEN 1 ELSE -1 END AS d, sum(length(before) + 2) OVER (PARTITION BY page_id, k ORDER BY i) AS stop FROM c),
        s AS (SELECT *, sum(d) OVER w AS total FROM v WINDOW w AS (PARTITION BY page_id, k ORDER BY i)),
        f AS (SELECT *, least(0, min(total) OVER w) AS lowest, least(0, coalesce(min(total) OVER (PARTITION BY page_id, k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lowest_before
              FROM s WINDOW w AS (PARTITION BY page_id, k ORDER BY i)),
        g AS (SELECT *, CASE WHEN d = 1 THEN total - lowest ELSE total + 1 - lowest_before END AS level FROM f),
        o AS (SELECT *, max(CASE WHEN d = 1 THEN stop END) OVER (PARTITION BY page_id, k, level ORDER BY i) AS start FROM g WHERE level > 0),
        raws AS (SELECT page_id, k, substr(text, (start + 1)::BIGINT, (stop - 2 - start)::BIGINT) AS raw FROM o JOIN src USING (page_id, k) WHERE d = -1)"""


def _links_sql(outer: bool) -> str:
    edge = "'^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'"
    return f"""
        WITH src AS (SELECT page_id, row_number() OVER () AS k, text FROM page WHERE contains(text, '[[')), {_marks(outer)},
        t AS (SELECT page_id, regexp_replace(raw, {edge}) AS c FROM raws WHERE NOT contains(raw, ':') AND NOT starts_with(raw, '#')),
        l AS (SELECT page_id, c, split_part(c, '|', 1) AS left_ FROM t WHERE NOT ends_with(c, '|')),
        u AS (SELECT page_id, c, CASE WHEN contains(left_, '#') THEN regexp_replace(split_part(left_, '#', 1), {edge}) ELSE left_ END AS uri FROM l),
        x AS (SELECT page_id, uri, CASE WHEN contains(c, '|') THEN substr(c, strpos(c, '|') + 1) ELSE uri END AS sf FROM u)
        SELECT page_id, uri, sf, count(*) AS links FROM x
        WHERE uri <> '' AND length(sf) + len(regexp_extract_all(sf, '[\\x{{10000}}-\\x{{10FFFF}}]')) BETWEEN 2 AND 80 AND len(regexp_extract_all(sf, '[^ ] ')) <= 4
          AND NOT regexp_matches(uri, '^[&"(''-]') AND NOT regexp_matches(sf, '^[&"(''-]') AND NOT contains(sf, chr(9)) GROUP BY ALL"""


SQL = {
    "wiki_pair_counts_repeated": f"WITH {_DUMP} SELECT sf, std_uri, count FROM res JOIN {_standard('uri', 'res')} ON s = uri",
    "wiki_sf_total_counts_repeated": f"""
        WITH {_DUMP},
             f AS (SELECT sf, sum(count)::BIGINT AS n FROM res GROUP BY sf),
             w AS (SELECT doc_id, copies, regexp_extract_all(words || ' ' || name, '[A-Za-z0-9]+') AS w FROM p),
             t AS (SELECT doc_id, copies, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM w),
             l AS (SELECT copies, t, lead(t) OVER o AS t2, lead(t, 2) OVER o AS t3, lead(t, 3) OVER o AS t4 FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
             g AS (SELECT copies, unnest([t, t || ' ' || t2, t || ' ' || t2 || ' ' || t3, t || ' ' || t2 || ' ' || t3 || ' ' || t4]) AS gram FROM l),
             c AS MATERIALIZED (SELECT gram, sum(copies)::BIGINT AS n FROM g WHERE gram IS NOT NULL GROUP BY gram),
             low AS (SELECT sf, lower(sf) AS l FROM f WHERE lower(sf) <> sf AND lower(sf) NOT IN (SELECT sf FROM f))
        SELECT f.sf, f.n AS link_count, coalesce(c.n, 0) AS text_count FROM f LEFT JOIN c ON gram = f.sf
        UNION ALL SELECT l, -1, coalesce(c.n, 0) FROM low LEFT JOIN c ON gram = low.sf""",
    "wiki_token_counts_repeated": f"""
        WITH {_MENTIONS},
             t AS (SELECT target AS uri, copies, unnest(regexp_extract_all(lower(words || ' ' || name), '[a-z0-9]+')) AS token FROM m),
             c AS (SELECT uri, token, sum(copies)::BIGINT AS n FROM t JOIN good USING (uri) WHERE token NOT IN (SELECT word FROM stop_words WHERE lang = 'en') GROUP BY ALL HAVING sum(copies) > 1),
             z AS (SELECT uri, '{{' || coalesce(string_agg('(' || token || ',' || n || ')', ',' ORDER BY n DESC, token), '') || '}}' AS tokens FROM good LEFT JOIN c USING (uri) GROUP BY uri)
        SELECT std_uri AS uri, tokens FROM z JOIN {_standard('uri', 'good', 'http://en.wikipedia.org/wiki/')} ON s = uri""",
    "wiki_mention_index": f"WITH {_MENTIONS} SELECT uri, mentions FROM good",
    "limited_scan": "SELECT least(1000, count(*)) AS pages FROM page",
    "page_counters": "SELECT count(*) AS pages, count(title) AS titled, count(redirect) AS redirecting, count_if(is_wikitext)::BIGINT AS wikitext FROM page",
    "text_links_nested": _links_sql(False),
    "text_links_outer": _links_sql(True),
}
