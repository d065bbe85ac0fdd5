"""Queries of the core operators for skewed keys, with SQL to hold them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import eager_join, heavy_keys, key_states
from ..sources.tables import table


def _fields(spark: SparkSession, d: str) -> DataFrame:
    tokens = table(spark, d, "token_counts").select(F.lit("resource").alias("field"), F.col("resource").alias("key_value"))
    return tokens.unionByName(table(spark, d, "pair_counts").select(F.lit("uri").alias("field"), F.col("uri").alias("key_value")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return heavy_keys(_fields(spark, d), "field", "key_value", 0.02).select("field", "key_value")


def p6_resource_results(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "token_counts").withColumn("n", F.coalesce("token_count", F.lit(0)))
    got = key_states(rows.where(F.trim("resource") != ""), ["resource"], {"tokens": "n"})
    return got.select("resource", "rows", F.col("tokens_sum").alias("tokens"), F.col("tokens_max").alias("largest"))


def p6_uri_results(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "pair_counts").withColumn("n", F.coalesce("link_count", F.lit(0)))
    got = key_states(rows.where(F.trim("uri") != ""), ["uri"], {"links": "n"})
    return got.select("uri", "rows", F.col("links_sum").alias("links"), F.col("links_max").alias("largest"))


def p6_page_join(spark: SparkSession, d: str) -> DataFrame:
    """Context tokens joined with links on the page's name: the join itself is quadratic in its hot keys and never formed."""
    name = lambda c: F.substring_index(F.col(c), "/", -1)
    tokens = table(spark, d, "token_counts").where(F.trim("resource") != "").select(name("resource").alias("page"), F.coalesce("token_count", F.lit(0)).alias("t"))
    links = table(spark, d, "pair_counts").where(F.trim("uri") != "").select(name("uri").alias("page"), F.coalesce("link_count", F.lit(0)).alias("l"))
    got = eager_join(tokens, links, ["page"], left_values={"tokens": "t"}, right_values={"links": "l"})
    return got.select("page", "rows", F.col("tokens_sum").cast("decimal(38,0)").cast("double").alias("tokens"), F.col("links_sum").cast("decimal(38,0)").cast("double").alias("links"))


QUERIES = {"p6_found": p6_found, "p6_resource_results": p6_resource_results, "p6_uri_results": p6_uri_results, "p6_page_join": p6_page_join}

SQL = {
    "p6_found": """
        WITH f AS (SELECT 'resource' AS field, resource AS key_value FROM token_counts UNION ALL SELECT 'uri', uri FROM pair_counts),
             n AS (SELECT field, count(*) AS total FROM f GROUP BY field)
        SELECT field, key_value FROM f JOIN n USING (field) WHERE trim(key_value) <> ''
        GROUP BY field, key_value, total HAVING count(*) * 50 >= total""",
    "p6_resource_results": """
        SELECT resource, count(*) AS rows, sum(coalesce(token_count, 0))::BIGINT AS tokens, max(coalesce(token_count, 0)) AS largest
        FROM token_counts WHERE trim(resource) <> '' GROUP BY resource""",
    "p6_uri_results": """
        SELECT uri, count(*) AS rows, sum(coalesce(link_count, 0))::BIGINT AS links, max(coalesce(link_count, 0)) AS largest
        FROM pair_counts WHERE trim(uri) <> '' GROUP BY uri""",
    "p6_page_join": """
        WITH t AS (SELECT regexp_extract(resource, '[^/]*$') AS page, coalesce(token_count, 0) AS t FROM token_counts WHERE trim(resource) <> ''),
             l AS (SELECT regexp_extract(uri, '[^/]*$') AS page, coalesce(link_count, 0) AS l FROM pair_counts WHERE trim(uri) <> '')
        SELECT page, count(*) AS rows, sum(t)::DOUBLE AS tokens, sum(l)::DOUBLE AS links FROM t JOIN l USING (page) GROUP BY page""",
}
