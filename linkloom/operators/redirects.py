"""Redirect resolution by path doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import upper_first
from ..session import materialize, materialize_with
from .lookup import SMALL_BYTES, hot_keys, look_up, planned_bytes

HOPS = 15  # fixed value: a chain is followed so far and no further


def redirect_table(pages: DataFrame, title: str = "title", target: str = "redirect") -> DataFrame:
    """(``title``, ``target``), one row per title: the smallest target of a title that has several.

    Rows with a null on either side are left out.
    """
    rows = pages.where(F.col(f"`{title}`").isNotNull() & F.col(f"`{target}`").isNotNull())
    return rows.groupBy(F.col(f"`{title}`").alias("title")).agg(F.min(F.col(f"`{target}`")).alias("target"))


def _by_upper(hop: DataFrame) -> DataFrame:
    """One row per upper-first title: the targets of its spellings, of which there are a few at most."""
    return hop.groupBy(upper_first(F.col("title")).alias("__upper")).agg(F.map_from_entries(F.collect_list(F.struct("title", "target"))).alias("__targets"))


def _next(keys: DataFrame, key: str, hop: DataFrame) -> DataFrame:
    """Add ``__next`` to distinct keys: the hop of the key as it is, else with an upper-case first letter, else null."""
    asked = keys.withColumn("__upper", upper_first(F.col(key)))
    got = look_up(asked, "__upper", _by_upper(hop), hot=[])  # keys are distinct: a few share their upper-first form
    return got.select(*keys.columns, F.coalesce(F.col("__targets")[F.col(key)], F.col("__targets")[F.col("__upper")]).alias("__next"))


def _then(hops: DataFrame, more: DataFrame, hot: list | None) -> DataFrame:
    """``hops`` continued by ``more``: (``title``, ``target``, ``moved``)."""
    got = look_up(hops.select("title", "target"), "target", more.select(F.col("title").alias("target"), F.col("target").alias("__then")), hot=hot)
    return got.select("title", F.coalesce("__then", "target").alias("target"), F.col("__then").isNotNull().alias("moved"))


def closed_redirects(redirects: DataFrame) -> DataFrame:
    """(``title``, ``target``) with the target after HOPS hops, cycles included.

    Only targets that redirect themselves are followed, by path doubling: their
    hop is composed to 2, 4 and 8 hops, and 8 + 4 + 2 make the 14 hops after
    the first. Where no chain goes on, as without cycles after a step or two,
    the last composition is the end of every chain. The whole table takes part
    in one look-up.
    """
    table = materialize(redirect_table(redirects, "title", "target"))  # once per title, no nulls
    targets = table.select(F.col("target").alias("title")).distinct()
    is_there = F.count(F.lit(1)).alias("n")
    one, seen = materialize_with(_next(targets, "title", table).where("__next is not null").select("title", F.col("__next").alias("target")), n=is_there)
    if not seen["n"]:
        return table
    hot = [] if planned_bytes(one) <= SMALL_BYTES else hot_keys(one, "target")
    steps, ends = [one], None
    for _ in range(3):
        twice, seen = materialize_with(_then(steps[-1], steps[-1], hot), moved=F.count_if("moved"))
        steps.append(twice)
        if not seen["moved"]:
            ends = twice
            break
    if ends is None:
        _, two, four, eight = steps
        ends = materialize(_then(_then(eight, four, hot), two, hot))
    return materialize(_then(table, ends, None).select("title", "target"))


def resolve(rows: DataFrame, uri: str, redirects: DataFrame, name: str = "resolved", closed: bool = False) -> DataFrame:
    """Add ``name``: the title that ``uri`` reaches through at most HOPS redirects.

    Each hop looks the title up as it is, then with an upper-case first
    letter, and ends the chain where neither is there. A null stays null.
    ``closed`` says that ``redirects`` comes from closed_redirects().
    """
    table = redirects if closed else closed_redirects(redirects)
    keys = rows.select(F.col(f"`{uri}`").alias("__uri")).where("__uri is not null").distinct()
    found = materialize(_next(keys, "__uri", table).where("__next is not null").select("__uri", F.col("__next").alias("__to")))
    names = [c for c in rows.columns if c != name]
    got = look_up(rows.withColumn("__uri", F.col(f"`{uri}`")), "__uri", found)
    return got.select(*[f"`{c}`" for c in names], F.coalesce("__to", "__uri").alias(name))
