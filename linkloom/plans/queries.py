"""Queries over the core operators, with SQL to hold them against.

Every query runs over whole tables. Those without SQL read markup or use word
rules that SQL can't express; tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links as L
from ..functions import pages as P
from ..functions import text as X
from ..functions.cleaning import FOR_CONTEXTS, FOR_LINKS, FOR_NGRAMS
from ..functions.tokenizers import analyze
from ..operators import context, ngrams, pairs
from ..operators.redirects import redirect_table, resolve
from ..operators.repeats import without_repeats
from ..session import materialize, scratch_path
from ..sources.pages import line_chunks, read_pages, read_uri_counts
from ..sources.tables import spread, table
from . import pipeline, sinks
from .config import Config

CONFIG = Config(min_occurence_couple=3)


# -- pages ---------------------------------------------------------------------
def page_fields(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "page").select("page_id", "page")
    return P.with_fields(raw).select("page_id", "title", "redirect", "is_wikitext", F.octet_length("text").cast("bigint").alias("text_bytes"))


def page_titles(spark: SparkSession, d: str) -> DataFrame:
    return P.with_fields(table(spark, d, "page").select("page")).where("is_wikitext and title is not null").select("title").distinct()


def page_redirects(spark: SparkSession, d: str) -> DataFrame:
    return redirect_table(P.with_fields(table(spark, d, "page").select("page")))


def first_line(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", P.first_line(F.col("text")).alias("line"))


def page_redirect_flag(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page").groupBy(P.redirects(F.col("page")).alias("redirects")).agg(F.count(F.lit(1)).alias("pages"))


def resolved_page_uri(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page").select("page_id", P.resolved_uri(F.col("page")).alias("uri"))


def page_limit(spark: SparkSession, d: str) -> DataFrame:
    """A debugging run over so many pages, here the first hundred by id."""
    return table(spark, d, "page").select("page_id").distinct().orderBy("page_id").limit(100)


def document_line_chunks(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return line_chunks(lines, ["doc_id", "pos"], "line", 500).select("chunk", "lines", F.octet_length("text").cast("bigint").alias("bytes"))


def dump_scan(spark: SparkSession, d: str) -> DataFrame:
    """The pages written as a text dump, split at their delimiters again, and read."""
    path = scratch_path(spark)
    sinks.write_text(table(spark, d, "page"), "page", path)
    found = P.with_fields(read_pages(spark, f"{path}/part-*"))
    return found.groupBy("title", "redirect", "is_wikitext").agg(F.count(F.lit(1)).alias("pages"))


def map_pages(spark: SparkSession, d: str) -> DataFrame:
    """A user's function over pages: their headline tags."""
    out = pipeline.map_pages(table(spark, d, "page"), lambda page: [x for x in page.split("\n") if x.strip().startswith("<model>")])
    return out.groupBy("output").agg(F.count(F.lit(1)).alias("n"))


# -- scalar functions ------------------------------------------------------------
def _strings(spark: SparkSession, d: str) -> DataFrame:
    """Distinct titles, targets, surface forms and addresses."""
    page, pair, token = (table(spark, d, n) for n in ("page", "pair_counts", "token_counts"))
    some = [page.select("title"), page.select("redirect"), pair.select("surface_form"), pair.select("uri"), token.select("resource")]
    out = some[0].toDF("s")
    for x in some[1:]:
        out = out.unionByName(x.toDF("s"))
    return out.where("s is not null").distinct()


def string_functions(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s")
    return _strings(spark, d).select(
        "s", X.nb_tokens(s).cast("bigint").alias("nb_tokens"), X.upper_first(s).alias("upper_first"), X.before_number_sign(s).alias("before_sign"),
        X.super_trim(s).alias("trimmed"), F.lower(s).alias("lowered"), X.utf16_length(s).cast("bigint").alias("units"), F.array_join(X.split_fields(s, "e"), "|").alias("fields"),
    )


def standard_uris(spark: SparkSession, d: str) -> DataFrame:
    return _strings(spark, d).select("s", X.standard_uri(F.col("s")).alias("std_uri"))


def escaped_titles(spark: SparkSession, d: str) -> DataFrame:
    return _strings(spark, d).select("s", X.escape_title(F.col("s")).alias("escaped"))


def unescaped_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page").select("page_id", X.unescape_xml(F.col("text")).alias("plain")).where("plain is not null").distinct()


def string_hashes(spark: SparkSession, d: str) -> DataFrame:
    return _strings(spark, d).select("s", X.long_hash_column(F.col("s")).alias("hash"))


# -- links and redirects ----------------------------------------------------------
def _raw_pairs(spark: SparkSession, d: str) -> DataFrame:
    """(uri, sf, count) of the table of partial counts; the target is the address's title."""
    rows = without_repeats(table(spark, d, "pair_counts").select("pair_id", "surface_form", "uri", "link_count"), "pair_id")
    title = F.translate(F.regexp_replace("uri", "^.*/resource/", ""), "_", " ")
    return rows.groupBy(title.alias("uri"), F.col("surface_form").alias("sf")).agg(F.sum(F.coalesce("link_count", F.lit(0))).alias("count"))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    page = table(spark, d, "page")
    titles = page.where("is_wikitext and title is not null").select("title").distinct()
    return pairs.resolved_pairs(_raw_pairs(spark, d), redirect_table(page), titles, CONFIG.min_occurence_couple)


def link_pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_counts(_resolved(spark, d))


def uri_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs.uri_counts(_resolved(spark, d))


def sf_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs.sf_counts(_resolved(spark, d))


def pairs_by_count(spark: SparkSession, d: str) -> DataFrame:
    return pairs.by_count(_resolved(spark, d))


def written_pair_counts(spark: SparkSession, d: str) -> DataFrame:
    """The pair counts as their text output holds them."""
    path = scratch_path(spark)
    sinks.write_pair_counts(materialize(link_pair_counts(spark, d)), path)
    return spark.read.csv(path, sep="\t", schema="sf string, std_uri string, count bigint", quote="", escape="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def written_uri_counts(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark)
    sinks.write_uri_counts(materialize(uri_counts(spark, d)), path)
    return read_uri_counts(spark, path)


def redirect_resolution(spark: SparkSession, d: str) -> DataFrame:
    page = table(spark, d, "page")
    return resolve(page.where("title is not null").select("title").distinct(), "title", redirect_table(page))


def existing_uris(spark: SparkSession, d: str) -> DataFrame:
    """Titles that the context pass would know by the counts of the first pass."""
    titles = table(spark, d, "page").where("is_wikitext and title is not null").select("title").distinct()
    known = context.known_keys(uri_counts(spark, d))
    return titles.withColumn("key", context.known_key(F.col("title"))).join(known, "key", "left_semi").select("title", "key")


def flat_page_links(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "page").where("is_wikitext").select("page_id", F.explode(L.flat_links(F.col("text"))).alias("l")).select("page_id", "l.uri", "l.sf")
    return found.where(L.accepted(F.col("uri"), F.col("sf"))).groupBy("uri", "sf").agg(F.count(F.lit(1)).alias("links"))


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    """The dump's pages as they come; one that comes again is a page of its own."""
    return P.with_fields(table(spark, d, "page").select("page_id", "page")).withColumnRenamed("page_id", "page_key")


def page_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs under the settings of each of the three passes."""
    pages = _parsed(spark, d)
    parts = [pairs.page_paragraphs(pages, "page_key", how).withColumn("how", F.lit(name)) for name, how in (("links", FOR_LINKS), ("ngrams", FOR_NGRAMS), ("contexts", FOR_CONTEXTS))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def page_links_nested(spark: SparkSession, d: str) -> DataFrame:
    return pairs.paragraph_links(pairs.page_paragraphs(_parsed(spark, d), "page_key"), nested=True)


def page_links_outer(spark: SparkSession, d: str) -> DataFrame:
    return pairs.paragraph_links(pairs.page_paragraphs(_parsed(spark, d), "page_key", FOR_CONTEXTS), nested=False)


def stripped_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    rows = pairs.page_paragraphs(_parsed(spark, d), "page_key", FOR_CONTEXTS)
    return rows.select("page_key", "pos", L.strip_links(F.col("paragraph")).alias("paragraph"))


# -- the passes over the dump ---------------------------------------------------------
# Short pages and single links count here: most links of these pages stand on redirect pages.
WIKI = Config(min_occurence_couple=1, min_nb_contexts=1, filter_by_size=False, mode="fixed")


def _pass(spark: SparkSession, d: str):  # noqa: ANN202
    stop = [r.word for r in table(spark, d, "stop_words").where("lang = 'en'").select("word").collect()]
    pages = pipeline.parsed_pages(table(spark, d, "page"), WIKI, stop)
    return pages, pipeline.link_stats(pages, WIKI)


def wiki_raw_pairs(spark: SparkSession, d: str) -> DataFrame:
    pages = _parsed(spark, d)
    return pairs.count_pairs(pairs.paragraph_links(pairs.page_paragraphs(pages, "page_key")))


def wiki_pair_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_counts(_pass(spark, d)[1].resolved)


def wiki_sf_total_counts(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.form_counts(*_pass(spark, d), WIKI)


def wiki_token_counts(spark: SparkSession, d: str) -> DataFrame:
    ranked = pipeline.context_counts(*_pass(spark, d), WIKI)
    return ranked.select(context.wiki_uri(F.col("uri")).alias("uri"), context.token_line(F.col("tokens")).alias("tokens"))


# -- n-grams and contexts on the documents ----------------------------------------------
def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text", "uri", F.lower(F.trim("lang")).alias("lang")))


def _forms(spark: SparkSession, d: str) -> DataFrame:
    rows = without_repeats(table(spark, d, "pair_counts").select("pair_id", "surface_form", "link_count"), "pair_id")
    return rows.where("surface_form is not null").groupBy(F.col("surface_form").alias("sf")).agg(F.sum(F.coalesce("link_count", F.lit(0))).alias("count"))


def word_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).select("doc_id", F.size(ngrams.pieces(F.col("text"))).alias("pieces"))


def paragraph_ngram_counts(spark: SparkSession, d: str) -> DataFrame:
    """All n-grams, however rare."""
    grams = ngrams.with_simple_ngrams(_documents(spark, d).select("text"), "text", "gram")
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def paragraph_ngrams(spark: SparkSession, d: str) -> DataFrame:
    """N-grams that occur ten times or more."""
    return paragraph_ngram_counts(spark, d).where("n >= 10")


def sf_total_counts(spark: SparkSession, d: str) -> DataFrame:
    return ngrams.sf_total_counts(_forms(spark, d), _documents(spark, d), "text", simple=True)


def sf_total_counts_fixed(spark: SparkSession, d: str) -> DataFrame:
    return ngrams.sf_total_counts(_forms(spark, d), _documents(spark, d), "text", simple=True, mode="fixed")


def sf_total_counts_pieces(spark: SparkSession, d: str) -> DataFrame:
    return ngrams.sf_total_counts(_forms(spark, d), _documents(spark, d), "text")


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    """Words of the documents, lower-cased, without the stop words of their language."""
    words = _documents(spark, d).select("doc_id", "lang", F.explode(ngrams.simple_words(F.lower("text"))).alias("token"))
    stop = table(spark, d, "stop_words").select("lang", F.col("word").alias("token"))
    return words.join(stop, ["lang", "token"], "left_anti").select("doc_id", "token")


def stopword_tokens(spark: SparkSession, d: str) -> DataFrame:
    return _tokens(spark, d).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def analyzed_tokens(spark: SparkSession, d: str) -> DataFrame:
    rows = _documents(spark, d).where("lang = 'en'")
    stop = [r.word for r in table(spark, d, "stop_words").where("lang = 'en'").select("word").collect()]
    return rows.select(F.explode(analyze(F.col("text"), "en.EnglishAnalyzer", stop)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).where("uri is not null").select("doc_id", "uri")


def mentions_min_contexts(spark: SparkSession, d: str) -> DataFrame:
    return context.qualifying(_mentions(spark, d), 2)


def _context_counts(spark: SparkSession, d: str) -> DataFrame:
    tokens = _tokens(spark, d).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    return context.token_counts(_mentions(spark, d), tokens, "doc_id", 2)


def context_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return _context_counts(spark, d)


def context_token_strings(spark: SparkSession, d: str) -> DataFrame:
    ranked = context.ranked_tokens(materialize(_context_counts(spark, d)), mentions_min_contexts(spark, d))
    return ranked.select("uri", context.token_line(F.col("tokens")).alias("tokens"))


QUERIES = {f.__name__: f for f in (
    link_pair_counts, uri_counts, sf_counts, pairs_by_count, page_fields, page_titles, page_redirects, page_redirect_flag, resolved_page_uri, first_line, page_limit,
    dump_scan, map_pages, written_pair_counts, written_uri_counts, document_line_chunks, string_functions, standard_uris, escaped_titles, unescaped_text, string_hashes, redirect_resolution, existing_uris, flat_page_links,
    page_paragraphs, page_links_nested, page_links_outer, stripped_paragraphs, wiki_raw_pairs, wiki_pair_counts, wiki_sf_total_counts, wiki_token_counts,
    word_pieces, paragraph_ngrams, paragraph_ngram_counts, sf_total_counts, sf_total_counts_fixed, sf_total_counts_pieces, stopword_tokens, analyzed_tokens, mentions_min_contexts, context_token_counts, context_token_strings,
)}


# -- SQL ------------------------------------------------------------------------------
def _in_class(chars: str) -> str:
    return "".join(f"\\x{{{ord(c):X}}}" for c in chars)


_WHITE, _DELIM = _in_class(X.WHITE), _in_class(X.WHITE + X.PUNCTUATION)


def _upper1(s: str) -> str:
    return f"(CASE WHEN length({s}) <= 1 THEN upper({s}) ELSE upper(left({s}, 1)) || substr({s}, 2) END)"


def _standard(s: str, source: str, prefix: str = "http://dbpedia.org/resource/") -> str:
    """A relation (s, std_uri) for the strings ``s`` of ``source``; each step is a table, so no expression stands in another twice."""
    bad = "regexp_matches(a, '%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)')"
    # Java reads full-width digits in a percent code as well
    digits = "a"
    for i in range(10):
        digits = f"regexp_replace(regexp_replace({digits}, '%{chr(0xFF10 + i)}', '%{i}', 'g'), '(%[0-9A-Fa-f]){chr(0xFF10 + i)}', '\\1{i}', 'g')"
    steps = "".join(f", d{i + 1} AS MATERIALIZED (SELECT s, CASE WHEN contains(a, '%') AND NOT {bad} THEN url_decode(replace(a, '+', ' ')) ELSE a END AS a FROM d{i})" for i in range(5))
    coded = "b"
    for char, code in X.URI_ENCODED.items():
        coded = "replace({}, '{}', '{}')".format(coded, char.replace("'", "''"), code)
    return f"""(
        WITH own AS MATERIALIZED (SELECT DISTINCT {s} AS s FROM {source}),
             tail AS MATERIALIZED (SELECT s, CASE WHEN contains(s, '/') AND NOT ends_with(s, '/') THEN regexp_extract(s, '[^/]*$') ELSE s END AS a FROM own),
             d0 AS MATERIALIZED (SELECT s, CASE WHEN contains(a, '%') THEN {digits} ELSE a END AS a FROM tail){steps},
             t AS MATERIALIZED (SELECT s, replace(regexp_replace(regexp_replace(a, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'), ' +', '_', 'g'), chr(9), '_') AS b FROM d5),
             u AS MATERIALIZED (SELECT s, CASE WHEN b = '' THEN 'incorrect_uri' ELSE b END AS b FROM t),
             v AS MATERIALIZED (SELECT s, upper(left(b, 1)) || substr(b, 2) AS b FROM u)
        SELECT s, '{prefix}' || {coded} AS std_uri FROM v)"""


def _unescape(s: str) -> str:
    """For strings whose only escapes are those of XML."""
    return f"trim(replace(replace(replace(replace({s}, '&quot;', '\"'), '&apos;', chr(39)), '&amp;', '&'), '&nbsp;', ' '))"


def _unescape_all(s: str) -> str:
    """All escapes: the text cut at each "&", each part held against what may follow one; an escape that ends the text is none."""
    q = lambda x: "'" + x.replace("'", "''") + "'"
    cases = " ".join(f"WHEN starts_with(p, {q(m[1:])}) AND NOT (i = len(string_split({s}, '&')) AND p = {q(m[1:])}) THEN {q(c)} || substr(p, {len(m)})" for m, c in X.ESCAPES.items())
    joined = f"array_to_string(list_transform(string_split({s}, '&'), lambda p, i: CASE WHEN i = 1 THEN p {cases} ELSE p END), '')"
    return f"regexp_replace({joined}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


_REDIRECT_OR_TITLE = "coalesce(nullif(trim(redirect), ''), trim(title))"
_STRINGS = "(SELECT title AS s FROM page UNION SELECT redirect FROM page UNION SELECT surface_form FROM pair_counts UNION SELECT uri FROM pair_counts UNION SELECT resource FROM token_counts)"

_RESOLVED = f"""
    red AS (SELECT title AS k, min(redirect) AS t FROM page WHERE title IS NOT NULL AND redirect IS NOT NULL GROUP BY title),
    raw AS (SELECT replace(regexp_replace(uri, '^.*/resource/', ''), '_', ' ') AS uri, surface_form AS sf, sum(coalesce(link_count, 0)) AS n
            FROM (SELECT DISTINCT pair_id, surface_form, uri, link_count FROM pair_counts) WHERE uri IS NOT NULL AND surface_form IS NOT NULL GROUP BY 1, 2),
    kept AS (SELECT * FROM raw WHERE n >= 3 AND NOT ends_with(sf, ',')),
    hop AS (SELECT DISTINCT uri AS u, uri AS cur, 0 AS h FROM kept
            UNION ALL
            SELECT u, coalesce(a.t, b.t), h + 1 FROM hop LEFT JOIN red a ON a.k = hop.cur LEFT JOIN red b ON b.k = {_upper1("hop.cur")}
            WHERE h < 15 AND coalesce(a.t, b.t) IS NOT NULL),
    final AS (SELECT u, arg_max(cur, h) AS cur FROM hop GROUP BY u),
    res AS (SELECT {_upper1("cur")} AS uri, sf, sum(n)::BIGINT AS count FROM kept JOIN final ON kept.uri = final.u GROUP BY 1, 2
            HAVING uri IN (SELECT title FROM page WHERE is_wikitext AND title IS NOT NULL))"""

_TITLE_HOPS = f"""
    red AS (SELECT title AS k, min(redirect) AS t FROM page WHERE title IS NOT NULL AND redirect IS NOT NULL GROUP BY title),
    hop AS (SELECT DISTINCT title AS u, title AS cur, 0 AS h FROM page WHERE title IS NOT NULL
            UNION ALL
            SELECT u, coalesce(a.t, b.t), h + 1 FROM hop LEFT JOIN red a ON a.k = hop.cur LEFT JOIN red b ON b.k = {_upper1("hop.cur")}
            WHERE h < 15 AND coalesce(a.t, b.t) IS NOT NULL)"""



def _words(s: str) -> str:
    return f"regexp_extract_all({s}, '[^{_DELIM}]+')"


_GRAMS = f"""
    w AS (SELECT doc_id, {_words("text")} AS w FROM documents),
    t AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM w),
    l AS (SELECT t, lead(t) OVER o AS t2, lead(t, 2) OVER o AS t3, lead(t, 3) OVER o AS t4 FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    g AS (SELECT unnest([t, t || ' ' || t2, t || ' ' || t2 || ' ' || t3, t || ' ' || t2 || ' ' || t3 || ' ' || t4]) AS gram FROM l),
    c AS MATERIALIZED (SELECT gram, count(*) AS n FROM g WHERE gram IS NOT NULL GROUP BY gram),
    f AS MATERIALIZED (SELECT surface_form AS sf, sum(coalesce(link_count, 0))::BIGINT AS n FROM (SELECT DISTINCT pair_id, surface_form, link_count FROM pair_counts) WHERE surface_form IS NOT NULL GROUP BY 1),
    low AS (SELECT sf, lower(sf) AS l FROM f WHERE lower(sf) <> sf AND lower(sf) NOT IN (SELECT sf FROM f))"""

_TOKENS = f"""
    t AS (SELECT doc_id, lower(trim(lang)) AS lang, unnest({_words("lower(text)")}) AS token FROM documents),
    tok AS (SELECT doc_id, token FROM t WHERE NOT EXISTS (SELECT 1 FROM stop_words s WHERE s.lang = t.lang AND s.word = t.token))"""
_CONTEXT = f"""{_TOKENS},
    good AS (SELECT uri FROM documents WHERE uri IS NOT NULL AND uri <> '' AND uri <> ' ' GROUP BY uri HAVING count(*) >= 2),
    cc AS (SELECT uri, token, count(*) AS count FROM documents JOIN good USING (uri) JOIN tok USING (doc_id) GROUP BY uri, token HAVING count(*) > 1)"""

SQL = {
    "link_pair_counts": f"WITH RECURSIVE {_RESOLVED} SELECT sf, std_uri, count FROM res JOIN {_standard('uri', 'res')} ON s = uri",
    "written_pair_counts": f"WITH RECURSIVE {_RESOLVED} SELECT sf, std_uri, count FROM res JOIN {_standard('uri', 'res')} ON s = uri",
    "written_uri_counts": f"WITH RECURSIVE {_RESOLVED} SELECT std_uri, sum(count)::BIGINT AS count FROM res JOIN {_standard('uri', 'res')} ON s = uri GROUP BY uri, std_uri",
    "uri_counts": f"WITH RECURSIVE {_RESOLVED} SELECT std_uri, sum(count)::BIGINT AS count FROM res JOIN {_standard('uri', 'res')} ON s = uri GROUP BY uri, std_uri",
    "sf_counts": f"WITH RECURSIVE {_RESOLVED} SELECT sf, sum(count)::BIGINT AS count FROM res GROUP BY sf",
    "pairs_by_count": f"WITH RECURSIVE {_RESOLVED} SELECT uri, sf, count FROM res ORDER BY count DESC, uri, sf",
    "page_fields": "SELECT page_id, trim(title) AS title, nullif(trim(redirect), '') AS redirect, is_wikitext, octet_length(encode(CASE WHEN contains(page, '<text xml:space=\"preserve\">') THEN text END))::BIGINT AS text_bytes FROM page",
    "dump_scan": "SELECT trim(title) AS title, nullif(trim(redirect), '') AS redirect, is_wikitext, count(*) AS pages FROM page GROUP BY ALL",
    "map_pages": "SELECT unnest(regexp_extract_all(page, '(?m)^[ ]*<model>.*$')) AS output, count(*) AS n FROM page GROUP BY 1",
    "page_titles": "SELECT DISTINCT trim(title) AS title FROM page WHERE is_wikitext AND title IS NOT NULL",
    "page_redirects": "SELECT trim(title) AS title, min(trim(redirect)) AS target FROM page WHERE title IS NOT NULL AND redirect IS NOT NULL GROUP BY 1",
    "page_redirect_flag": "SELECT contains(page, '<redirect title=') AS redirects, count(*) AS pages FROM page GROUP BY 1",
    "resolved_page_uri": f"SELECT page_id, std_uri AS uri FROM page LEFT JOIN {_standard(_REDIRECT_OR_TITLE, 'page')} ON s = {_REDIRECT_OR_TITLE}",
    "first_line": "SELECT doc_id, split_part(text, chr(10), 1) AS line FROM documents",
    "page_limit": "SELECT DISTINCT page_id FROM page ORDER BY page_id LIMIT 100",
    "document_line_chunks": """
        WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
             n AS (SELECT line, row_number() OVER (ORDER BY doc_id, pos) AS k FROM l)
        SELECT k // 500 AS chunk, count(*) AS lines, sum(octet_length(encode(line)) + 1)::BIGINT AS bytes FROM n GROUP BY 1""",
    "string_functions": f"""
        SELECT s, len(regexp_extract_all(s, '[^ ] '))::BIGINT AS nb_tokens, {_upper1("s")} AS upper_first, split_part(s, '#', 1) AS before_sign,
               regexp_replace(s, '^[{_WHITE}]+|[{_WHITE}]+$', '', 'g') AS trimmed, lower(s) AS lowered,
               length(s) + len(regexp_extract_all(s, '[\\x{{10000}}-\\x{{10FFFF}}]'))::BIGINT AS units,
               CASE WHEN length(s) <= 2 THEN s ELSE regexp_replace(replace(s, 'e', '|'), '[|]$', CASE WHEN ends_with(s, 'e') THEN '' ELSE '|' END) END AS fields
        FROM {_STRINGS} WHERE s IS NOT NULL""",
    "standard_uris": f"SELECT s, std_uri FROM {_standard('s', _STRINGS)} WHERE s IS NOT NULL",
    "escaped_titles": f"SELECT s, replace(replace(url_encode(replace(replace(s, ' ', '_'), chr(9), '_')), '~', '%7E'), '%2A', '*') AS escaped FROM {_STRINGS} WHERE s IS NOT NULL",
    # 31 * h + unit over UTF-16 units, in 128 bits modulo 2^64, then as a signed number
    "string_hashes": f"""
        WITH s AS (SELECT DISTINCT s FROM {_STRINGS} WHERE s IS NOT NULL),
             u AS (SELECT s, flatten(list_transform(list_transform(CASE WHEN s = '' THEN [] ELSE string_split(s, '') END, lambda c: unicode(c)), lambda p:
                   CASE WHEN p < 65536 THEN [p] ELSE [55296 + ((p - 65536) >> 10), 56320 + ((p - 65536) & 1023)] END)) AS units FROM s),
             h AS (SELECT s, list_reduce(list_prepend(1125899906842597::HUGEINT, list_transform(units, lambda x: x::HUGEINT)), lambda h, x: (31 * h + x) % 18446744073709551616::HUGEINT) AS h FROM u)
        SELECT s, CASE WHEN h >= 9223372036854775808::HUGEINT THEN h - 18446744073709551616::HUGEINT ELSE h END::BIGINT AS hash FROM h""",
    "unescaped_text": f"SELECT DISTINCT page_id, {_unescape_all('text')} AS plain FROM page WHERE is_wikitext IS NOT NULL AND text IS NOT NULL",
    "redirect_resolution": f"WITH RECURSIVE {_TITLE_HOPS} SELECT u AS title, arg_max(cur, h) AS resolved FROM hop GROUP BY u",
    "existing_uris": f"""
        WITH RECURSIVE {_RESOLVED}, known AS (SELECT DISTINCT substr(std_uri, 29) AS key FROM {_standard('uri', 'res')}),
             t AS (SELECT DISTINCT title, replace(replace(url_encode(replace(replace(title, ' ', '_'), chr(9), '_')), '~', '%7E'), '%2A', '*') AS key FROM page WHERE is_wikitext AND title IS NOT NULL)
        SELECT title, key FROM t WHERE key IN (SELECT key FROM known)""",
    "flat_page_links": """
        WITH l AS (SELECT unnest(regexp_extract_all(text, '\\[\\[([^\\[\\]]*)\\]\\]', 1)) AS raw FROM page WHERE is_wikitext),
             c AS (SELECT trim(raw) AS c FROM l WHERE NOT contains(raw, ':') AND NOT starts_with(raw, '#')),
             p AS (SELECT split_part(c, '|', 1) AS left_, CASE WHEN contains(left_, '#') THEN trim(split_part(left_, '#', 1)) ELSE left_ END AS uri,
                          CASE WHEN contains(c, '|') THEN regexp_replace(c, '^[^|]*[|]', '') ELSE uri END AS sf FROM c WHERE NOT ends_with(c, '|'))
        SELECT uri, sf, count(*) AS links FROM p
        WHERE uri <> '' AND length(sf) BETWEEN 2 AND 80 AND len(regexp_extract_all(sf, '[^ ] ')) <= 4
          AND NOT regexp_matches(uri, '^[&"(''-]') AND NOT regexp_matches(sf, '^[&"(''-]') AND NOT contains(sf, chr(9)) GROUP BY uri, sf""",
    "paragraph_ngram_counts": f"WITH {_GRAMS} SELECT gram, n FROM c",
    "paragraph_ngrams": f"WITH {_GRAMS} SELECT gram, n FROM c WHERE n >= 10",
    "sf_total_counts": f"""
        WITH {_GRAMS} SELECT f.sf, f.n AS link_count, coalesce(c.n, 0) AS text_count FROM f LEFT JOIN c ON gram = f.sf
        UNION ALL SELECT l, -1, coalesce(c.n, 0) FROM low LEFT JOIN c ON gram = low.sf""",
    "sf_total_counts_fixed": f"""
        WITH {_GRAMS} SELECT f.sf, f.n AS link_count, coalesce(c.n, 0) AS text_count FROM f LEFT JOIN c ON gram = f.sf
        UNION ALL SELECT l, -1, coalesce(c.n, 0) FROM (SELECT DISTINCT l FROM low) LEFT JOIN c ON gram = l""",
    "stopword_tokens": f"WITH {_TOKENS} SELECT token, count(*) AS n FROM tok GROUP BY token",
    "mentions_min_contexts": "SELECT uri, count(*) AS mentions FROM documents WHERE uri IS NOT NULL AND uri <> '' AND uri <> ' ' GROUP BY uri HAVING count(*) >= 2",
    "context_token_counts": f"WITH {_CONTEXT} SELECT uri, token, count FROM cc",
    "context_token_strings": f"""
        WITH {_CONTEXT} SELECT uri, '{{' || coalesce(string_agg('(' || token || ',' || count || ')', ',' ORDER BY count DESC, token), '') || '}}' AS tokens
        FROM good LEFT JOIN cc USING (uri) GROUP BY uri""",
}
