"""Look-ups of a skewed key in a table with unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_PARTS = 500  # so many keys at most are treated as hot
HOT_ROWS = 10_000  # a key with fewer rows is no burden for a task, whatever share it has
SMALL_BYTES = 8 << 20  # planned size up to which no key can be a burden


def hot_keys(rows: DataFrame, key: str, parts: int = HOT_PARTS, floor: int = HOT_ROWS) -> list:
    """The most frequent keys with at least ``floor`` rows, ``parts`` of them at most.

    Every key that holds a ``parts``-th of the rows is among them, and their
    number is bounded whatever the input, so they may stand on the driver and
    be broadcast. One job; counts are combined before the shuffle.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return [r[0] for r in counts.where(F.col("__n") >= floor).orderBy(F.desc("__n")).limit(parts).collect()]


def planned_bytes(rows: DataFrame) -> int:
    """Size that the optimizer plans with: for a scan the size of its files, known without a job."""
    return int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _few_rows(rows: DataFrame, key: str, values: list) -> DataFrame:
    """A relation of few values, made in the JVM."""
    one = lambda v: F.struct(*[F.lit(v[f]).alias(f) for f in v.__fields__]) if isinstance(v, Row) else F.lit(v)
    each = F.array(*[one(v) for v in values]).cast(T.ArrayType(rows.schema[key].dataType))
    return rows.sparkSession.range(1).select(F.explode(each).alias(key))


def look_up(rows: DataFrame, key: str, table: DataFrame, how: str = "left", parts: int = HOT_PARTS, hot: list | None = None) -> DataFrame:
    """Join ``rows`` to ``table`` (unique, non-null ``key``) without skew.

    Hot keys of ``rows`` meet their few table rows in a broadcast join; the
    other rows go through a shuffle. ``how`` is "left" or "inner". ``hot`` are
    the hot keys where the caller knows them, at most ``parts``; otherwise the
    rows are counted first, so they should be cheap to read twice. A null key
    finds nothing. Columns other than the key must not clash. Rows of a small
    planned size are joined without a search for hot keys.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    if hot is None:
        hot = hot_keys(rows, key, parts) if planned_bytes(rows) > SMALL_BYTES else []
    names = [*rows.columns, *(c for c in table.columns if c != key)]
    if not hot:
        return rows.join(table, key, how).select(*names)
    few = _few_rows(rows, key, hot)
    hot_table = table.join(F.broadcast(few), key, "left_semi")
    marked = rows.join(F.broadcast(few.withColumn("__hot", F.lit(True))), key, "left")
    warm = marked.where("__hot").drop("__hot").join(F.broadcast(hot_table), key, how)
    cold = marked.where("__hot is null").drop("__hot").join(table, key, how)
    return warm.select(*names).unionByName(cold.select(*names))


def join_split(left: DataFrame, right: DataFrame, key: str, hot: list | None = None, salts: int = 64) -> DataFrame:
    """Inner join on ``key``, which both sides may repeat, with hot keys split.

    The rows of ``left`` with a hot key are dealt out to ``salts`` parts, and
    the rows of ``right`` with such a key come to each of them, so no task
    meets all rows of a key. ``hot`` are the hot keys of ``left`` where they
    are known. Columns other than the key must not clash.
    """
    if hot is None:
        hot = hot_keys(left, key) if planned_bytes(left) > SMALL_BYTES else []
    if not hot:
        return left.join(right, key)
    few = F.broadcast(_few_rows(left, key, hot).withColumn("__hot", F.lit(True)))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    a = left.join(few, key, "left").withColumn("__part", F.when(F.col("__hot"), part).otherwise(0)).drop("__hot")
    parts = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    b = right.join(few, key, "left").withColumn("__part", F.explode(parts)).drop("__hot")
    return a.join(b, [key, "__part"]).drop("__part")
