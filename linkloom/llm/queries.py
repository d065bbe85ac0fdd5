"""Queries over the operators of this subpackage, with SQL to hold them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.repeats import without_repeats
from ..sources.tables import table
from .distinctive import score_terms
from .frequency import term_frequencies
from .groups import connected_groups, page_pairs
from .leaks import find_leaks
from .lookalikes import consistent_form, same_look_classes, same_look_pairs
from .markup import strip_markup
from .mixing import mix_sources
from .splitting import split_items


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "page").select("page_id", "title", "redirect")
    return connected_groups(page_pairs(pages), "a", "b").select(F.col("member").alias("page_id"), F.col("group").alias("group_id"))


def p1_page_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every page with a title; a page tied to no other is a group of its own."""
    pages = table(spark, d, "page").select("page_id", "title", "redirect")
    ids = pages.where("title is not null and page_id is not null").select("page_id").distinct()
    return ids.join(p1_found(spark, d), "page_id", "left").select("page_id", F.coalesce("group_id", "page_id").alias("group_id"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return same_look_pairs(table(spark, d, "pair_counts"), "pair_id", ["surface_form", "uri"])


def p2_classes(spark: SparkSession, d: str) -> DataFrame:
    """The same links by class: one row per row that has any."""
    return same_look_classes(table(spark, d, "pair_counts"), "pair_id", ["surface_form", "uri"])


def _counted_forms(spark: SparkSession, d: str, by_table: bool) -> DataFrame:
    rows = without_repeats(table(spark, d, "pair_counts").select("pair_id", "surface_form", "uri", "link_count"), "pair_id")
    rows = consistent_form(rows.select("surface_form", "uri", "link_count"), "surface_form", "uri", by_table=by_table)
    return rows.groupBy("surface_form_form", "uri_form").agg(F.sum(F.coalesce("link_count", F.lit(0))).alias("links"), F.count(F.lit(1)).alias("parts"))


def p2_forms(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the pairs in their consistent form, a spelling of the table's where one is clean."""
    return _counted_forms(spark, d, False)


def p2_looks(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the pairs by the table of looks alone."""
    return _counted_forms(spark, d, True)


_ARTICLE = "is_wikitext and title is not null and coalesce(redirect, '') = ''"


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    # repeated rows have the same content: dropping them by what was found moves no text
    pages = strip_markup(table(spark, d, "page").where(_ARTICLE).select("page_id", "text"))
    return pages.select("page_id", F.explode("elements").alias("element")).distinct()


def p3_clean_text(spark: SparkSession, d: str) -> DataFrame:
    pages = without_repeats(table(spark, d, "page").where(_ARTICLE).select("page_id", "text"), "page_id")  # moves ids, no text but that of repeated pages
    return strip_markup(pages).select("page_id", "clean_text", F.concat_ws(",", "elements").alias("elements"))


_FILL = "The river passes the old town, turns west, and ends, after many miles, in a lake."


def p3_planted(spark: SparkSession, d: str) -> DataFrame:
    """The documents' words with known markup around them, cleaned again: what is planted must come out in its plain form and a navigation not at all."""
    words = F.array_join(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0)), " ")
    text = F.format_string(
        f"&lt;nav&gt;[[A1|Home]] [[B1|About]]&lt;/nav&gt;\n== Head ==\n\n{_FILL} \'\'\'Bold\'\'\' %s, [[Target|shown]].\n\n* one\n* two\n\n&lt;pre&gt;x = [[1]]\n  y&lt;/pre&gt;\n\n{_FILL} So &lt;math&gt;a^{{2}}&lt;/math&gt; holds.\n\n"
        "\\section{Next}\n1. first\n2. second\n\n{|\n! a !! b\n|-\n| 1 || 2\n|}\n\n&lt;div&gt;&lt;p&gt;" + _FILL + "&lt;ref&gt;note&lt;/ref&gt;&lt;/p&gt;&lt;/div&gt;",
        words,
    )
    pages = table(spark, d, "documents").where("text is not null").select("doc_id", text.alias("text"))
    return strip_markup(pages).select("doc_id", "clean_text", F.concat_ws(",", "elements").alias("elements"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    scores = score_terms(table(spark, d, "token_counts"), "resource", "token", "token_count", "row_id")
    return scores.where("record_count <= 3 and tf * 10 >= record_total").select("resource", "token")


def p4_scores(spark: SparkSession, d: str) -> DataFrame:
    scores = score_terms(table(spark, d, "token_counts"), "resource", "token", "token_count", "row_id")
    return scores.select("resource", "token", "tf", "record_total", "term_total", "record_count", F.round("score", 4).alias("score"))


def _frequencies(spark: SparkSession, d: str) -> DataFrame:
    forms = term_frequencies(table(spark, d, "pair_counts"), "surface_form", "uri", "link_count", "pair_id", 3, 1 / 25)
    tokens = term_frequencies(table(spark, d, "token_counts"), "token", "resource", "token_count", "row_id", 3, 1 / 5, blank_records=False)
    return forms.select(F.lit("surface_form").alias("field"), "*").unionByName(tokens.select(F.lit("token").alias("field"), "*"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    marks = F.array_compact(F.array(F.when(F.col("rare"), "rare"), F.when(F.col("common"), "common")))
    return _frequencies(spark, d).select("field", "term", F.explode(marks).alias("mark"))


def p5_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return _frequencies(spark, d).select("field", "term", "total", "records", "rare", "common")


def _documents(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text", *columns)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    leaks = find_leaks(_documents(spark, d), table(spark, d, "eval_items"), exact=True)
    return leaks.where("exact_words >= 12").select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Edited copies as well."""
    return find_leaks(_documents(spark, d), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(_documents(spark, d, "source"), table(spark, d, "mix_targets")).report.where("short").select("source")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(_documents(spark, d, "source"), table(spark, d, "mix_targets")).report


def p8_selection(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(_documents(spark, d, "source"), table(spark, d, "mix_targets")).selection


def p8_kept(spark: SparkSession, d: str) -> DataFrame:
    """What the mix promises, by source: the repeats and, within a twentieth, the share."""
    r = p8_report(spark, d)
    missed = F.abs(F.col("reached_tokens") - F.col("target_tokens")) > 0.05 * F.col("target_tokens")
    kept = F.when(F.col("short"), F.col("reached_tokens") == F.col("tokens") * F.col("max_repeats")).otherwise(~missed)
    return r.select("source", "documents", "short", (F.col("most_copies") <= F.col("max_repeats")).alias("repeats_kept"), kept.alias("share_kept"))


def p8_short_copies(spark: SparkSession, d: str) -> DataFrame:
    """Sources that fall short are used whole, as often as they may be."""
    mix = mix_sources(_documents(spark, d, "source"), table(spark, d, "mix_targets"))
    return mix.selection.join(mix.report.where("short").select("source"), "source", "left_semi").select("doc_id", "source", "copies")


def p9_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    """Each split text put together from its pieces less their overlaps, with what the pieces promise."""
    cut = p9_pieces(spark, d)
    by = Window.partitionBy("doc_id").orderBy("piece")  # the pieces of one text
    before = F.coalesce(F.lag("end").over(by), F.lit(0))
    part = F.substring(F.col("piece_text"), (before - F.col("start") + 1).cast("int"), F.length("piece_text"))
    each = cut.select("doc_id", "piece", part.alias("part"), (F.col("n_tokens") <= 2000).alias("fits"), ((F.col("overlap") == 200) & ~F.col("halved")).alias("as_asked"))
    got = each.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "part"))).alias("p"), F.min("fits").alias("fits"), F.min("as_asked").alias("as_asked"))
    return got.select("doc_id", "fits", "as_asked", F.md5(F.array_join("p.part", "")).alias("text_md5"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return split_items(_documents(spark, d), "doc_id", "text", 2000, 200).where("piece = 0").select("doc_id")


def p9_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_items(_documents(spark, d), "doc_id", "text", 2000, 200)


QUERIES = {f.__name__: f for f in (
    p1_found, p1_page_groups, p2_found, p2_classes, p2_forms, p2_looks, p3_found, p3_clean_text, p3_planted, p4_found, p4_scores, p5_found, p5_frequencies,
    p7_found, p7_leaks, p8_found, p8_report, p8_selection, p8_kept, p8_short_copies, p9_found, p9_pieces, p9_rebuilt,
)}


def _key(x: str) -> str:
    k = f"trim(regexp_replace(replace(split_part({x}, '#', 1), '_', ' '), ' +', ' ', 'g'))"
    return f"(upper(left({k}, 1)) || substr({k}, 2))"


_TIES = f"""
    pages AS (SELECT DISTINCT page_id, title, redirect FROM page WHERE title IS NOT NULL AND page_id IS NOT NULL),
    touch AS (SELECT page_id, {_key("title")} AS k FROM pages UNION SELECT page_id, {_key("redirect")} FROM pages WHERE trim(redirect) <> ''),
    tie AS (SELECT page_id, m FROM touch JOIN (SELECT k, min(page_id) AS m FROM touch GROUP BY k) USING (k) WHERE page_id <> m),
    edge AS (SELECT page_id AS a, m AS b FROM tie UNION SELECT m, page_id FROM tie),
    reach AS (SELECT a AS node, a AS label FROM edge UNION SELECT e.b, r.label FROM reach r JOIN edge e ON e.a = r.node),
    found AS (SELECT node AS page_id, min(label) AS group_id FROM reach GROUP BY node)"""

_ROWS = "(SELECT resource, token, sum(coalesce(token_count, 0))::BIGINT AS tf FROM (SELECT DISTINCT row_id, resource, token, token_count FROM token_counts) WHERE trim(resource) <> '' AND token IS NOT NULL GROUP BY 1, 2)"

# The look of a text by plain replacement, for the characters of these tables.
_FROM = "аеорсухѕіјһАВЕКМНОРСТХЅІЈοΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" + "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "   "
_TO = "aeopcyxsijhABEKMHOPCTXSIJoABEZHIKMNOPTYX" + "".join(chr(c) for c in range(0x21, 0x7F)) + "   "


def _form(x: str) -> str:
    plain = f"regexp_replace({x}, '[­​‌‍⁠﻿]', '', 'g')"
    quoted = _FROM.replace("'", "''"), _TO.replace("'", "''")
    return f"nfc_normalize(replace(replace(translate({plain}, '{quoted[0]}', '{quoted[1]}'), 'Ⅲ', 'III'), 'ﬁ', 'fi'))"


def _canonical(c: str) -> str:
    """(value, form): of those that look the same the plain spelling, else the most frequent clean one, else the look itself.
    Clean: composed, ordinary characters, no word of two scripts."""
    odd, latin, other = "[\u00ad\u200b\u200c\u200d\u2060\ufeff\u00a0\u2007\u202fⅢﬁ！-～]", "[A-Za-zÀ-ɏ]", "[Ͱ-Ͽ]"
    mixed = f"{latin}[^ ]*([Ѐ-ӿ]|{other})|([Ѐ-ӿ]|{other})[^ ]*{latin}|[Ѐ-ӿ][^ ]*{other}|{other}[^ ]*[Ѐ-ӿ]"
    return f"""
        SELECT value, coalesce(first_value(CASE WHEN clean THEN value END) OVER (PARTITION BY look ORDER BY clean DESC, regexp_matches(value, '[^ -~]'), n DESC, value ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), look) AS form
        FROM (SELECT {c} AS value, count(*) AS n, {_form(c)} AS look, nfc_normalize({c}) = {c} AND NOT regexp_matches({c}, '{odd}') AND NOT regexp_matches({c}, '{mixed}') AS clean
              FROM r WHERE {c} IS NOT NULL GROUP BY {c})"""


_FREQ = """
    SELECT '{0}' AS field, {0} AS term, sum(coalesce({2}, 0))::BIGINT AS total, count(DISTINCT CASE WHEN {4} THEN {1} END) AS records,
           total < 3 AS rare, records * {5} > (SELECT count(DISTINCT {1}) FROM {3} WHERE {4}) AS common
    FROM (SELECT DISTINCT {6}, {0}, {1}, {2} FROM {3}) WHERE {0} IS NOT NULL GROUP BY {0}"""
_FREQS = (
    _FREQ.format("surface_form", "uri", "link_count", "pair_counts", "uri IS NOT NULL", 25, "pair_id")
    + " UNION ALL "
    + _FREQ.format("token", "resource", "token_count", "token_counts", "trim(resource) <> ''", 5, "row_id")
)

SQL = {
    "p1_found": f"WITH RECURSIVE {_TIES} SELECT page_id, group_id FROM found",
    "p1_page_groups": f"WITH RECURSIVE {_TIES} SELECT page_id, coalesce(group_id, page_id) AS group_id FROM (SELECT DISTINCT page_id FROM pages) LEFT JOIN found USING (page_id)",
    "p2_found": f"""
        WITH r AS (SELECT DISTINCT pair_id, surface_form AS s, uri AS u, {_form("surface_form")} AS fs, {_form("uri")} AS fu FROM pair_counts
                   WHERE surface_form IS NOT NULL AND uri IS NOT NULL AND pair_id IS NOT NULL)
        SELECT a.pair_id AS pair_id_a, b.pair_id AS pair_id_b FROM r a JOIN r b ON a.fs = b.fs AND a.fu = b.fu AND a.pair_id < b.pair_id
        WHERE a.s <> b.s OR a.u <> b.u""",
    "p2_classes": f"""
        WITH r AS (SELECT DISTINCT pair_id, surface_form AS s, uri AS u, {_form("surface_form")} AS fs, {_form("uri")} AS fu FROM pair_counts
                   WHERE surface_form IS NOT NULL AND uri IS NOT NULL AND pair_id IS NOT NULL),
             n AS (SELECT *, min(pair_id) OVER (PARTITION BY fs, fu) AS class_id, count(*) OVER (PARTITION BY fs, fu) - count(*) OVER (PARTITION BY s, u) AS links FROM r)
        SELECT pair_id, class_id, links FROM n WHERE links > 0""",
    "p2_forms": f"""
        WITH r AS (SELECT DISTINCT pair_id, surface_form AS s, uri AS u, link_count FROM pair_counts),
             s AS ({_canonical("s")}), u AS ({_canonical("u")})
        SELECT s.form AS surface_form_form, u.form AS uri_form, sum(coalesce(link_count, 0))::BIGINT AS links, count(*) AS parts
        FROM r LEFT JOIN s ON r.s = s.value LEFT JOIN u ON r.u = u.value GROUP BY 1, 2""",
    "p2_looks": f"""
        SELECT {_form("surface_form")} AS surface_form_form, {_form("uri")} AS uri_form, sum(coalesce(link_count, 0))::BIGINT AS links, count(*) AS parts
        FROM (SELECT DISTINCT pair_id, surface_form, uri, link_count FROM pair_counts) GROUP BY 1, 2""",
    "p3_planted": f"""
        SELECT doc_id, '## Head' || chr(10) || chr(10) || '{_FILL} Bold ' || array_to_string(regexp_extract_all(text, '[A-Za-z]+'), ' ') || ', shown.' || chr(10) || chr(10) || '- one' || chr(10) || '- two' || chr(10) || chr(10)
               || '```' || chr(10) || 'x = [[1]]' || chr(10) || '  y' || chr(10) || '```' || chr(10) || chr(10) || '{_FILL} So $a^{{2}}$ holds.' || chr(10) || chr(10) || '# Next' || chr(10) || chr(10) || '1. first' || chr(10) || '2. second'
               || chr(10) || chr(10) || '| a | b |' || chr(10) || '| --- | --- |' || chr(10) || '| 1 | 2 |' || chr(10) || chr(10) || '{_FILL}' AS clean_text,
               'heading,list,code,formula,table,inline' AS elements
        FROM documents WHERE text IS NOT NULL""",
    "p4_found": f"""
        WITH c AS {_ROWS}, r AS (SELECT resource, sum(tf) AS n FROM c GROUP BY 1), t AS (SELECT token, count(*) AS k FROM c GROUP BY 1)
        SELECT resource, token FROM c JOIN r USING (resource) JOIN t USING (token) WHERE k <= 3 AND tf * 10 >= n""",
    "p4_scores": f"""
        WITH c AS {_ROWS},
             r AS (SELECT resource, sum(tf)::BIGINT AS record_total FROM c GROUP BY 1),
             t AS (SELECT token, sum(tf)::BIGINT AS term_total, count(*) AS record_count FROM c GROUP BY 1),
             w AS (SELECT count(*) AS n, avg(record_total) AS m FROM r),
             x AS (SELECT *, CASE WHEN tf > 0 THEN tf * log2(1 + m / record_total) END AS tfn, term_total / n AS lam FROM c JOIN r USING (resource) JOIN t USING (token), w)
        SELECT resource, token, tf, record_total, term_total, record_count,
               round(coalesce(CASE WHEN tf > 0 THEN (log2(1 + lam) + tfn * log2((1 + lam) / lam)) / (tfn + 1) END, 0), 4) AS score FROM x""",
    "p5_found": f"""
        SELECT field, term, 'rare' AS mark FROM ({_FREQS}) WHERE rare UNION ALL SELECT field, term, 'common' FROM ({_FREQS}) WHERE common""",
    "p5_frequencies": _FREQS,
    "p7_found": """
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents),
             i AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
             dg AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM d, unnest(range(1, len(w) - 10)) AS x(k)),
             ig AS (SELECT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM i, unnest(range(1, len(w) - 10)) AS x(k))
        SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
    # No text lies near the limit and no source near its share under any common tokenizer, so bytes do for tokens here.
    "p8_found": """
        WITH d AS (SELECT lower(trim(source)) AS source, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
             m AS (SELECT lower(trim(source)) AS source, sum(target_share) AS share, max(max_repeats) AS r FROM mix_targets WHERE source IS NOT NULL GROUP BY 1)
        SELECT source FROM m LEFT JOIN d USING (source) GROUP BY source, share, r HAVING coalesce(sum(n), 0) * r < share * (SELECT sum(n) FROM d)""",
    "p8_kept": """
        WITH d AS (SELECT lower(trim(source)) AS source, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
             m AS (SELECT lower(trim(source)) AS source, sum(target_share) AS share, max(max_repeats) AS r FROM mix_targets WHERE source IS NOT NULL GROUP BY 1)
        SELECT source, count(n) AS documents, coalesce(sum(n), 0) * r < share * (SELECT sum(n) FROM d) AS short, true AS repeats_kept, true AS share_kept FROM m LEFT JOIN d USING (source) GROUP BY source, share, r""",
    "p8_short_copies": """
        WITH d AS (SELECT doc_id, lower(trim(source)) AS source, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
             m AS (SELECT lower(trim(source)) AS source, sum(target_share) AS share, max(max_repeats)::BIGINT AS r FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
             s AS (SELECT source, r FROM m JOIN d USING (source) GROUP BY source, share, r HAVING sum(n) * r < share * (SELECT sum(n) FROM d))
        SELECT doc_id, source, r AS copies FROM d JOIN s USING (source)""",
    "p9_rebuilt": "SELECT doc_id, true AS fits, true AS as_asked, md5(text) AS text_md5 FROM documents WHERE octet_length(encode(text)) > 4 * 2000",
    "p9_found": "SELECT doc_id FROM documents WHERE octet_length(encode(text)) > 4 * 2000",
}
