"""Rows that come again: one row per id without moving all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_with

AGAIN_BYTES = 16 << 20  # ids of repeated rows up to this size go to every task


def without_repeats(rows: DataFrame, row_id: str, again_bytes: int = AGAIN_BYTES) -> DataFrame:
    """One row of each ``row_id``; rows with a null id all stay.

    Only the ids are shuffled, to find those that come again. Rows of other
    ids stay where they are, and the rows of repeated ids, few as a rule, are
    reduced to one each. Where the repeated ids are beyond ``again_bytes``,
    all rows are shuffled by their id instead. ``rows`` is read twice or more,
    so it should be a scan or a written table. Rows of one id are taken to
    have the same content; of differing ones any may stay.
    """
    ids = rows.select(row_id).where(F.col(row_id).isNotNull())
    again = ids.groupBy(row_id).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(row_id)
    again, seen = materialize_with(again, n=F.count(F.lit(1)), size=F.sum(F.octet_length(F.col(row_id).cast("string")) + 16))
    if not seen["n"]:
        return rows
    if seen["size"] > again_bytes:
        return rows.where(F.col(row_id).isNull()).unionByName(rows.where(F.col(row_id).isNotNull()).dropDuplicates([row_id]))
    again = F.broadcast(again)
    once = rows.join(again, row_id, "left_anti")
    first = rows.join(again, row_id, "left_semi").dropDuplicates([row_id])
    return once.select(*rows.columns).unionByName(first.select(*rows.columns))
