"""Frequency of every distinct term, with marks on the too rare and too common."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.repeats import without_repeats
from ..session import materialize


def term_frequencies(
    rows: DataFrame, term: str, record: str, count: str, row_id: str | None = None, rare_below: int = 3, common_share: float = 0.2, blank_records: bool = True
) -> DataFrame:
    """(``term``, ``total``, ``records``, ``all_records``, ``rare``, ``common``), one row per non-null term.

    ``total`` adds up the counts over all rows (a null counts 0), also those
    without a record; ``records`` is the number of distinct non-null records the
    term occurs with (non-blank ones if ``blank_records`` is false), and
    ``all_records`` that of the whole input. ``rare``: total < ``rare_below``;
    ``common``: records > ``common_share`` * all_records. Rows with one
    ``row_id`` count once, those with a null id each. An empty input gives no rows; extra columns are
    ignored.

    Counts are combined by hash on the map side at every step: per (term,
    record), then per term; no task ever sees all rows of a term.
    """
    r, t = F.col(f"`{record}`"), F.col(f"`{term}`")
    n = F.coalesce(F.col(f"`{count}`"), F.lit(0)).cast("bigint")
    named = r.isNotNull() if blank_records else F.trim(r) != ""
    rows = rows.select(t.alias("term"), F.when(named, r).alias("record"), n.alias("n"), *([F.col(f"`{row_id}`").alias("__id")] if row_id else []))
    if row_id:
        rows = without_repeats(rows, "__id")
    cells = materialize(rows.groupBy("term", "record").agg(F.sum("n").alias("n")))  # once for terms and records
    whole = cells.where("record is not null").groupBy("record").agg(F.lit(1)).agg(F.count(F.lit(1)).alias("all_records"))
    per_term = cells.where("term is not null").groupBy("term").agg(F.sum("n").alias("total"), F.count("record").alias("records"))
    return per_term.crossJoin(F.broadcast(whole)).select(
        "term",
        "total",
        "records",
        "all_records",
        (F.col("total") < rare_below).alias("rare"),
        # a share given as a ratio of whole numbers is compared without rounding
        (F.col("records") * round(1 / common_share) > F.col("all_records") if abs(1 / common_share - round(1 / common_share)) < 1e-9 else F.col("records") > F.lit(common_share) * F.col("all_records")).alias("common"),
    )
