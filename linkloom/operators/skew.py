"""Per-key results although a few keys hold most rows: eager aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .lookup import join_split, look_up


def key_states(rows: DataFrame, keys: Sequence[str], values: Mapping[str, str] | None = None) -> DataFrame:
    """Compact states per key: ``rows`` (count) and, for each name -> column of
    ``values``, ``<name>_sum``, ``<name>_min``, ``<name>_max``, ``<name>_n``
    (non-null values).

    Rows are combined before the shuffle, so a hot key sends one small state
    per task. Null keys form groups of their own, as in SQL.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for name, column in (values or {}).items():
        c = F.col(f"`{column}`")
        aggs += [F.sum(c).alias(f"{name}_sum"), F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max"), F.count(c).alias(f"{name}_n")]
    return rows.groupBy(*keys).agg(*aggs)


def eager_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], roll_up: Sequence[str] | None = None, left_keys: Sequence[str] = (), right_keys: Sequence[str] = (), left_values: Mapping[str, str] | None = None, right_values: Mapping[str, str] | None = None
) -> DataFrame:
    """Aggregates of ``left JOIN right USING (on)`` without forming the join.

    Both inputs are reduced to states per join key (and their own grouping
    columns ``left_keys``, ``right_keys``), the states are joined, and the
    results follow algebraically: the rows of the join are left rows * right
    rows, a sum of a left value is its sum * right rows, and the other way
    round, minima and maxima stay. The states are rolled up to ``roll_up``
    (default: ``on`` and both sides' grouping columns).

    Returns the ``roll_up`` columns, ``rows``, ``left_rows`` and ``right_rows``
    (input rows that found a partner, each counted once per state of the other
    side), and for each value ``<name>_sum``, ``<name>_min``, ``<name>_max``,
    ``<name>_n``. Null join keys find no partner; an empty input gives no rows;
    columns that aren't named are ignored, so their names may clash. Value
    names and grouping columns of the sides must differ.
    """
    on, left_keys, right_keys = list(on), list(left_keys), list(right_keys)
    lv, rv = dict(left_values or {}), dict(right_values or {})
    if {*lv} & {*rv} or {*left_keys} & {*right_keys}:
        raise ValueError("names of the two sides clash")
    present = lambda df: df.dropna(subset=on)
    a = key_states(present(left), on + left_keys, lv).withColumnRenamed("rows", "left_rows")
    b = key_states(present(right), on + right_keys, rv).withColumnRenamed("rows", "right_rows")
    joined = _join_states(a, b, on, bool(left_keys), bool(right_keys))
    aggs = [F.sum(F.col("left_rows") * F.col("right_rows")).alias("rows"), F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows")]
    for names, other in ((lv, "right_rows"), (rv, "left_rows")):
        for name in names:
            aggs += [
                F.sum(F.col(f"{name}_sum") * F.col(other)).alias(f"{name}_sum"),
                F.min(f"{name}_min").alias(f"{name}_min"),
                F.max(f"{name}_max").alias(f"{name}_max"),
                F.sum(F.col(f"{name}_n") * F.col(other)).alias(f"{name}_n"),
            ]
    return joined.groupBy(*(roll_up if roll_up is not None else on + left_keys + right_keys)).agg(*aggs)


def _join_states(a: DataFrame, b: DataFrame, on: list[str], many_left: bool, many_right: bool) -> DataFrame:
    """States of one join key are one row, or one per grouping value: only then can a join key be hot."""
    if not many_left and not many_right:  # both unique: nothing to split
        return a.join(b, on)
    key = on[0] if len(on) == 1 else "__on"
    if len(on) > 1:
        a, b = a.withColumn(key, F.struct(*on)), b.withColumn(key, F.struct(*on)).drop(*on)
    if many_left and many_right:
        return join_split(materialize(a), b, key).drop("__on")
    if many_right:
        a, b = (b, a) if len(on) == 1 else (b.withColumns({c: F.col(key)[c] for c in on}), a.drop(*on))
    return look_up(materialize(a), key, b, "inner").drop("__on")


def heavy_keys(rows: DataFrame, field: str, key: str, share: float = 0.02) -> DataFrame:
    """(``field``, ``key``, ``rows``, ``total``): keys that hold at least ``share`` of their field's rows.

    An eager aggregation of the join of the rows with themselves on ``field``:
    states per (field, key) meet the one state of their field. Null and blank
    keys count in the total and are never reported; a null field is left out.
    """
    pairs = rows.select(F.col(f"`{field}`").alias("__field"), F.col(f"`{key}`").alias("__key"))
    states = materialize(key_states(pairs.where("__field is not null"), ["__field", "__key"]).withColumnRenamed("rows", "left_rows"))
    # the field's own state is the sum of its keys' states, so the rows are read once
    fields = states.groupBy("__field").agg(F.sum("left_rows").alias("right_rows"))
    joined = look_up(states, "__field", fields, "inner")
    parts = round(1 / share)
    whole = abs(1 / share - parts) < 1e-9
    is_heavy = F.col("left_rows") * parts >= F.col("right_rows") if whole else F.col("left_rows") >= F.lit(share) * F.col("right_rows")
    return joined.where(is_heavy & (F.trim(F.col("__key")) != "")).select(
        F.col("__field").alias(field), F.col("__key").alias(key), F.col("left_rows").alias("rows"), F.col("right_rows").alias("total")
    )
