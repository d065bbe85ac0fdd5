"""Mixing sources to target weights: certain whole copies, then Pareto order sampling."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import SMALL_BYTES, hot_keys, look_up, planned_bytes
from ..session import materialize, materialize_with
from . import tokenizers

BUCKETS = 1 << 14


def token_counts(rows: DataFrame, text: str, name: str = "n_tokens", tokenizer: str = tokenizers.NAME, folder: str = tokenizers.FOLDER) -> DataFrame:
    """Add the number of tokens of ``text``; a null has 0."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count_one = tokenizers.load(folder, tokenizer).count
        for batch in batches:
            yield pd.Series([count_one(x) if x else 0 for x in batch], dtype="int64")

    return rows.withColumn(name, count(F.col(f"`{text}`")))


def source_key(source: Column) -> Column:
    return F.lower(F.trim(source))


@dataclass(frozen=True)
class Mix:
    """``selection``: (doc id, ``source``, ``n_tokens``, ``copies``) of the documents used;
    ``report``: one row per target with the shares reached."""

    selection: DataFrame
    report: DataFrame


def mix_sources(
    docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", size: int | None = None, size_power: float = 0.5, seed: int = 17, tokenizer: str = tokenizers.NAME, folder: str = tokenizers.FOLDER
) -> Mix:
    """Choose documents so that each source holds its ``target_share`` of ``size`` tokens.

    ``size`` defaults to the tokens of all documents, those without a target
    included. Sources are compared trimmed and lower-cased; documents of a
    null or unlisted source are not used; a null text has 0 tokens; targets
    with a null source are left out, and of repeated ones the sums of shares
    and the largest ``max_repeats`` hold. A null share or repeat counts 0.

    A source needs lambda = target / its tokens copies of each document, at
    most ``max_repeats``. Each document is used floor(lambda) times for
    certain. The rest is a Pareto sample of fixed size: document i is included
    with probability p_i proportional to tokens ** ``size_power``, scaled so
    that the expected tokens are those wanted (p_i at most 1; such documents
    are certain too), and those with the smallest u/(1-u) / (p/(1-p)) are
    taken, where u follows from the id and ``seed``. Each power of two of the
    token counts is a sample of its own with a fixed number of documents, so
    the tokens drawn vary by little more than one document. The cut is found by
    counting ranks in buckets, so no source is ever sorted as a whole. All
    figures per source are tables: there may be any number of sources.
    """
    wanted = (
        targets.where(F.col("source").isNotNull())
        .groupBy(source_key(F.col("source")).alias("source"))
        .agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(0))).cast("bigint").alias("max_repeats"))
    )
    own = docs.select(F.col(f"`{doc_id}`").alias("id"), source_key(F.col(f"`{source}`")).alias("source"), F.col(f"`{text}`").alias("text"))
    sizes, seen = materialize_with(token_counts(own, "text", tokenizer=tokenizer, folder=folder).drop("text"), tokens=F.sum("n_tokens"))
    size = int(seen["tokens"] or 0) if size is None else size

    # how many documents of a source have how many tokens: all that the scale follows from
    weight = F.pow(F.col("n_tokens").cast("double"), F.lit(size_power))
    lengths = sizes.where("source is not null").groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("n"))
    lengths = materialize(lengths.join(wanted.select("source"), "source", "left_semi"))
    have = lengths.groupBy("source").agg(F.sum("n").alias("documents"), F.sum(F.col("n") * F.col("n_tokens")).alias("tokens"))
    base = wanted.join(have, "source", "left").fillna(0, ["documents", "tokens"]).withColumn("target_tokens", F.col("target_share") * F.lit(float(size)))
    copies = F.when(F.col("tokens") > 0, F.least(F.col("max_repeats").cast("double"), F.col("target_tokens") / F.col("tokens"))).otherwise(F.lit(0.0))
    base = base.withColumn("whole", F.floor(copies + 1e-12)).withColumn("rest", F.greatest(F.lit(0.0), copies - F.col("whole")) * F.col("tokens"))
    plan = materialize(base.join(_scales(lengths, base, weight), "source", "left").fillna(0.0, ["scale"]))

    p = F.least(F.lit(1.0), F.col("scale") * weight)
    u = (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))
    drawn = look_up(sizes, "source", plan.select("source", "whole", "scale"), "inner").withColumn("p", p)
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    drawn = drawn.withColumn("rank", F.when((F.col("p") > 0) & (F.col("p") < 1), odds / (1 + odds)))
    cell = F.struct("source", F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int").alias("class")).alias("cell")
    drawn = drawn.withColumn("bucket", F.floor(F.col("rank") * BUCKETS).cast("int")).select("id", cell, "n_tokens", "whole", "p", "rank", "bucket")
    # ranks: how many documents of a cell to take, and in which bucket that number is reached
    per = drawn.where("rank is not null").groupBy("cell", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("p"), F.sum(F.col("p") * F.col("n_tokens")).alias("size"))
    per = materialize(per)
    so_far = Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    upto = per.withColumn("upto", F.sum("n").over(so_far)).join(_taken(per), "cell")
    edge = upto.where((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("n") < F.col("take"))).select("cell", F.col("bucket").alias("edge"), (F.col("take") - F.col("upto") + F.col("n")).alias("inner"))
    held = look_up(drawn, "cell", materialize(edge), hot=[] if planned_bytes(sizes) <= SMALL_BYTES else hot_keys(sizes.select(cell), "cell"))
    certain = held.where("rank is null").withColumn("extra", F.when(F.col("p") >= 1, 1).otherwise(0))
    clear = held.where("rank is not null and (edge is null or bucket <> edge)").withColumn("extra", F.when(F.col("bucket") < F.col("edge"), 1).otherwise(0))
    order = Window.partitionBy("cell").orderBy("rank", "id")  # one bucket of a cell
    at_edge = held.where("bucket = edge").withColumn("k", F.row_number().over(order)).withColumn("extra", F.when(F.col("k") <= F.col("inner"), 1).otherwise(0)).drop("k")
    chosen = certain.unionByName(clear).unionByName(at_edge)
    chosen = chosen.select("id", "cell.source", "n_tokens", (F.col("whole") + F.col("extra")).alias("copies")).where("copies > 0")
    chosen, seen = materialize_with(chosen, tokens=F.sum(F.col("copies") * F.col("n_tokens")))

    reached = chosen.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("reached_tokens"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
    report = plan.select("source", "target_share", "max_repeats", "target_tokens", "documents", "tokens")
    report = report.join(reached, "source", "left").fillna(0, ["reached_tokens", "copies", "most_copies"])
    report = report.withColumn("actual_share", F.col("reached_tokens") / F.lit(seen["tokens"] or None).cast("double"))
    report = report.withColumn("short", F.col("tokens") * F.col("max_repeats") < F.col("target_tokens"))
    return Mix(chosen.withColumnRenamed("id", doc_id), report)


def _taken(per: DataFrame) -> DataFrame:
    """(``cell``, ``take``): how many documents each cell gives.

    From the longest texts of a source to the shortest a cell gives its
    expected tokens, and what rounding to whole documents left over or took
    too much goes on to the next. A source has a few dozen cells at most.
    """
    cells = per.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("size").alias("size"))
    row = F.struct((-F.col("cell.class")).alias("order"), F.col("cell"), "n", (F.col("size") / F.col("p")).alias("mean"), "size")
    each = cells.groupBy("cell.source").agg(F.array_sort(F.collect_list(row)).alias("l"))

    def one(done: Column, x: Column) -> Column:
        take = F.least(x.n, F.greatest(F.lit(0).cast("bigint"), F.round((x["size"] + done.carry) / x["mean"]).cast("bigint")))
        return F.struct((x["size"] + done.carry - take * x["mean"]).alias("carry"), F.concat(done.out, F.array(F.struct(x.cell.alias("cell"), take.alias("take")))).alias("out"))

    none = F.slice(F.transform("l", lambda x: F.struct(x.cell.alias("cell"), F.lit(0).cast("bigint").alias("take"))), 1, 0)
    return each.select(F.inline(F.aggregate("l", F.struct(F.lit(0.0).alias("carry"), none.alias("out")), one, lambda done: done.out)))


def _scales(lengths: DataFrame, base: DataFrame, weight: Column) -> DataFrame:
    """(``source``, ``scale``): p = scale * weight, at most 1, gives ``rest`` expected tokens.

    The longest documents are the first to be certain. With the k longest
    certain the scale is (rest - their tokens) / (weighted tokens of the
    others); the first k for which the next one stays below 1 is the answer.
    A source has one row per length of its texts here, not per document.
    """
    rows = lengths.where("n_tokens > 0").join(base.select("source", "rest").where("rest > 0"), "source")
    longest = Window.partitionBy("source").orderBy(F.desc("n_tokens"))
    tokens, heavy = F.col("n") * F.col("n_tokens"), F.col("n") * F.col("n_tokens") * weight
    certain = F.coalesce(F.sum(tokens).over(longest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    free = F.sum(heavy).over(longest.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("scale", (F.col("rest") - certain) / free).withColumn("left", F.col("rest") - certain)
    fits = (F.col("left") > 0) & (F.col("scale") * weight < 1)
    # none fits where the rest ends among documents of one length: these are all but certain then
    last = F.max_by(F.when(F.col("left") > 0, F.col("scale")), F.when(F.col("left") > 0, -F.col("n_tokens")))
    return rows.groupBy("source").agg(F.coalesce(F.max_by("scale", F.when(fits, F.col("n_tokens"))), last, F.lit(0.0)).alias("scale"))
