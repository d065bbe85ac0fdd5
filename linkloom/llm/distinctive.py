"""How distinctive a term is for a record: divergence from randomness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import HOT_PARTS, HOT_ROWS, look_up
from ..operators.repeats import without_repeats
from ..session import materialize, materialize_with


def score_terms(rows: DataFrame, record: str, term: str, count: str, row_id: str | None = None, c: float = 1.0) -> DataFrame:
    """Score each (record, term) by divergence from randomness.

    Returns one row per pair with a non-blank record and a non-null term:
    ``record``, ``term`` under their own names, ``tf`` (sum of counts; a null
    counts 0), ``record_total``, ``term_total``, ``record_count`` (records that
    hold the term), ``score``. Rows with one ``row_id`` count once; those with
    a null id each count.

    With tfn = tf * log2(1 + c * mean record total / record total) and
    lambda = term_total / number of records, the information content under the
    geometric model is -log2(1 / (1 + lambda)) - tfn * log2(lambda / (1 + lambda));
    it is multiplied by the Laplace gain 1 / (tfn + 1). A term without any
    count, or a record without any, scores 0. An empty input gives no rows;
    extra columns are ignored.
    """
    r, t, n = F.col(f"`{record}`").alias("__r"), F.col(f"`{term}`").alias("__t"), F.coalesce(F.col(f"`{count}`"), F.lit(0)).cast("bigint").alias("__n")
    rows = rows.where((F.trim(F.col(f"`{record}`")) != "") & F.col(f"`{term}`").isNotNull())
    rows = rows.select(r, t, n, *([F.col(f"`{row_id}`").alias("__id")] if row_id else []))
    if row_id:
        rows = without_repeats(rows, "__id")
    # combined by hash before the shuffle and written once: the totals and the scores all start from it
    tf, seen = materialize_with(rows.groupBy("__r", "__t").agg(F.sum("__n").alias("tf")), cells=F.count(F.lit(1)))
    records = tf.groupBy("__r").agg(F.sum("tf").alias("record_total"), F.count(F.lit(1)).alias("__terms"))
    terms = tf.groupBy("__t").agg(F.sum("tf").alias("term_total"), F.count(F.lit(1)).alias("record_count"))
    whole = records.agg(F.count(F.lit(1)).alias("__records"), F.avg("record_total").alias("__mean"))
    # at most HOT_PARTS keys can hold a HOT_PARTS-th of the cells
    least = max(HOT_ROWS, seen["cells"] / HOT_PARTS)
    records, terms = materialize(records), materialize(terms)
    hot_terms = [x[0] for x in terms.where(F.col("record_count") >= least).select("__t").collect()]
    hot_records = [x[0] for x in records.where(F.col("__terms") >= least).select("__r").collect()]
    all_ = look_up(tf, "__t", terms, "inner", hot=hot_terms)
    all_ = look_up(all_, "__r", records.drop("__terms"), "inner", hot=hot_records).crossJoin(F.broadcast(whole))
    tfn = F.col("tf") * F.log2(1 + F.lit(c) * F.col("__mean") / F.col("record_total"))
    lam = F.col("term_total") / F.col("__records")
    score = (F.log2(1 + lam) + tfn * F.log2((1 + lam) / lam)) / (tfn + 1)
    score = F.when((F.col("tf") > 0) & (F.col("record_total") > 0), score).otherwise(F.lit(0.0))
    return all_.select(F.col("__r").alias(record), F.col("__t").alias(term), "tf", "record_total", "term_total", "record_count", score.alias("score"))
