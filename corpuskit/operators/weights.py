"""Sampling weights balanced over groups, and weighted draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import shuffle_key, uniform
from ..functions.text import group_key, number_or
from .common import lookup_join, materialize
from .ranking import global_top, md5_bucket, running_sums, value_buckets


def balanced_weights(df: DataFrame, group_by: Sequence[str], alpha: float = 1.0, weight: str | None = None, hard: str | None = None, boost: float = 1.0) -> DataFrame:
    """df with group_key, group_rows and weight: 1 / rows of the group to the power alpha, times the
    row's own weight (at least 1e-6, 1 if not a number), times boost for hard rows; at least 1e-12."""
    df = df.withColumn("group_key", group_key(group_by))
    counts = materialize(df.groupBy("group_key").agg(F.count("*").alias("group_rows")))
    out = lookup_join(df, counts, ["group_key"])
    w = 1.0 / F.pow(F.col("group_rows").cast("double"), F.lit(float(alpha)))
    if weight:
        w = w * F.greatest(number_or(weight, 1.0), F.lit(1e-6))
    if hard and boost != 1.0:
        w = w * F.when(number_or(hard, 0.0) > 0, float(boost)).otherwise(1.0)
    return out.withColumn("weight", F.greatest(w, F.lit(1e-12)))


def sampler_summary(weighted: DataFrame) -> DataFrame:
    """groups, rows, weight_min and weight_max of balanced_weights."""
    return weighted.agg(F.countDistinct("group_key").alias("groups"), F.count("*").alias("rows"), F.min("weight").alias("weight_min"), F.max("weight").alias("weight_max"))


def running_average(df: DataFrame, value: Column, n: Column) -> DataFrame:
    """Mean of value weighted by n; 0 for no rows."""
    return df.agg((F.coalesce(F.sum(value * n), F.lit(0.0)) / F.greatest(F.coalesce(F.sum(n), F.lit(0)), F.lit(1))).alias("average"))


def draw_without_replacement(df: DataFrame, row_id: str, weight: str, n: int, seed: int | str, world: int = 1) -> DataFrame:
    """The n smallest weighted exponential keys, numbered from 0, with the rank (process) of each draw.

    Rows of null, NaN or non-positive weight are never drawn.
    """
    u = F.greatest(uniform(shuffle_key(seed, row_id)), F.lit(2.0**-60))
    rows = df.filter((F.col(weight) > 0) & ~F.isnan(weight)).withColumn("__key", -F.log(u) / F.col(weight))
    top = materialize(global_top(rows, [F.col("__key"), F.col(row_id)], n, "__key", descending=False))
    ranged, b = value_buckets(top, "__key")
    out = running_sums(ranged, [], F.col(b), [F.col("__key"), F.col(row_id)], {"draw": F.lit(1).cast("bigint")})
    return out.withColumn("draw", F.col("draw") - 1).withColumn("process", (F.col("draw") % world).cast("int")).drop("__key", b)


def draw_with_replacement(df: DataFrame, row_id: str, weight: str, n: int, seed: int | str, world: int = 1, cells: int = 4096) -> DataFrame:
    """draw, process and row of n independent draws, each by weight.

    Cumulative weights are cut into equal cells; a draw meets only the rows that reach
    into its cell.
    """
    rows = df.filter((F.col(weight) > 0) & ~F.isnan(weight)).select(F.col(row_id).alias("__id"), F.col(weight).cast("double").alias("__w"), shuffle_key(seed, row_id).alias("__k"))
    rows = materialize(rows)
    total = rows.agg(F.sum("__w")).first()[0]
    if not total or n <= 0:
        return rows.select(F.lit(0).cast("bigint").alias("draw"), F.lit(0).alias("process"), F.col("__id").alias(row_id)).limit(0)
    ran = running_sums(rows, [], md5_bucket(F.col("__k"), rows.count()), [F.col("__k"), F.col("__id")], {"hi": F.col("__w")})
    width = total / cells
    span = ran.withColumn("lo", F.col("hi") - F.col("__w"))
    span = span.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw").withColumn("x", uniform(shuffle_key(f"{seed}:draw", "draw")) * F.lit(float(total)))
    draws = draws.withColumn("cell", F.floor(F.col("x") / width))
    out = draws.join(span, "cell").filter("x >= lo AND x < hi")
    return out.select("draw", (F.col("draw") % world).cast("int").alias("process"), F.col("__id").alias(row_id))


def draw_epoch(df: DataFrame, row_id: str, mode: str, n: int, seed: int, epoch: int = 0, world: int = 1, group_by: Sequence[str] = ("source",), **weights) -> DataFrame:
    """draw, process and row of one epoch: ``source_balanced``, ``weighted_source`` and ``group_balanced``
    draw with replacement by balanced_weights, any other mode draws rows evenly without replacement.

    The epoch is part of the seed; process is the draw number modulo world.
    """
    if mode in ("source_balanced", "weighted_source", "group_balanced"):
        return draw_with_replacement(balanced_weights(df, list(group_by), **weights), row_id, "weight", n, f"{seed}+{epoch}", world)
    return draw_without_replacement(df.select(row_id).withColumn("weight", F.lit(1.0)), row_id, "weight", n, f"{seed}+{epoch}", world).select("draw", "process", row_id)
