"""Quotas for groups and selections that fill them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import shuffle_key
from .common import lookup_join, materialize
from .ranking import md5_bucket, running_sums, shuffled_rank, value_buckets


def water_fill(groups: DataFrame, keys: Sequence[str], group: str, rows: str, total: Column | int, overshoot: bool = False) -> DataFrame:
    """groups with ``quota``: total spread evenly over each key's groups, none above its rows.

    The level comes from the distinct group sizes (about the square root of twice the rows
    at most). What the level leaves over goes one by one to open groups in name order; with
    ``overshoot`` every open group gets one more as soon as anything is left over.
    """
    keys = list(keys)
    total = F.lit(total) if isinstance(total, int) else total
    g = groups.withColumn("__total", total)
    sizes = g.groupBy(*keys, rows).agg(F.count("*").alias("m"), F.max("__total").alias("t"))
    w = Window.partitionBy(*keys).orderBy(rows)
    all_ = Window.partitionBy(*keys)
    taken = F.coalesce(F.sum(F.col(rows) * F.col("m")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    alive = F.sum("m").over(all_) - F.coalesce(F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = sizes.withColumn("lv", F.floor(F.greatest(F.col("t") - taken, F.lit(0)) / alive).cast("bigint")).withColumn("open", F.col("lv") < F.col(rows))
    level = level.groupBy(*keys).agg(F.min_by("lv", F.when(F.col("open"), F.col(rows))).alias("level"), F.max("t").alias("t"), F.sum(F.col(rows) * F.col("m")).alias("all_rows"))
    level = level.withColumn("level", F.coalesce("level", F.lit((1 << 62))))
    g = g.drop("__total").join(level, keys) if keys else lookup_join(g.drop("__total").withColumn("__one", F.lit(1)), materialize(level.withColumn("__one", F.lit(1))), ["__one"]).drop("__one")
    base = F.least(F.col(rows), F.col("level"))
    left = F.least("t", "all_rows") - F.sum(base).over(all_)
    open_ = F.col(rows) > F.col("level")
    place = F.row_number().over(Window.partitionBy(*keys, open_).orderBy(group))
    more = F.when(open_ & ((left > 0) if overshoot else (place <= left)), 1).otherwise(0)
    return g.withColumn("quota", base + more).drop("level", "t", "all_rows")


def balanced_sample(df: DataFrame, keys: Sequence[str], group: str, total: int, seed: int | str, path: str = "path", overshoot: bool = False) -> DataFrame:
    """df with ``picked``: each key's total spread over its groups, rows by shuffle order.

    A null group counts as ``unknown``. Quotas are cut at exact ranks; a hot group is ranked
    in ranges, never in one task.
    """
    name = F.coalesce(F.col(group).cast("string"), F.lit("unknown"))
    df = df.withColumns({"__g": name, "__k": shuffle_key(seed, name, path)})
    counts = df.groupBy(*keys, "__g").agg(F.count("*").alias("__n"))
    quotas = materialize(water_fill(counts, keys, "__g", "__n", total, overshoot).select(*keys, "__g", "quota"))
    ranked = shuffled_rank(df, [*keys, "__g"], "__k", [path], "__rank")
    out = lookup_join(ranked, quotas, [*keys, "__g"], "left")
    return out.withColumn("picked", F.coalesce(F.col("__rank") <= F.col("quota"), F.lit(False))).drop("__g", "__k", "__rank", "quota")


def rule_target(rows: Column, rules: Sequence[Mapping[str, float]]) -> Column:
    """Target of the first rule (largest min_rows first) that rows reach: rows times ratio,
    rounded half to even, at least min_rows_out, at most cap_rows_out; 0 if none."""
    out = F.lit(0).cast("bigint")
    for r in sorted(rules, key=lambda r: r["min_rows"]):
        t = F.least(F.greatest(F.bround(rows * F.lit(float(r["ratio"])), 0).cast("bigint"), F.lit(int(r["min_rows_out"]))), F.lit(int(r["cap_rows_out"])))
        out = F.when(rows >= int(r["min_rows"]), t).otherwise(out)
    return out


def take_until(units: DataFrame, bucket: str, unit: str, rows: str, target: Column, seed: int | str) -> DataFrame:
    """Units in shuffle order until their rows reach the bucket's target; the last may overshoot.

    target is an expression over ``bucket_rows``, the bucket's rows. Null buckets are left out.
    """
    units = units.filter(F.col(bucket).isNotNull())
    total = materialize(units.groupBy(bucket).agg(F.sum(rows).alias("bucket_rows")))
    units = lookup_join(units, total.withColumn("__target", target), [bucket]).withColumn("__k", shuffle_key(seed, bucket, unit))
    n = units.count()
    ran = running_sums(units, [bucket], md5_bucket(F.col("__k"), n), [F.col("__k"), F.col(unit)], {"__before": F.col(rows)}, inclusive=False)
    return ran.filter(F.col("__before") < F.col("__target")).drop("__before", "__target", "__k", "bucket_rows")


def take_rows_from_units(units: DataFrame, bucket: str, unit: str, rows: str, total: int, seed: int | str) -> DataFrame:
    """Units by shuffle order until each bucket has its evenly filled share of ``total`` rows."""
    sums = units.filter(F.col(bucket).isNotNull()).groupBy(bucket).agg(F.sum(rows).alias("__n"))
    quotas = materialize(water_fill(sums, [], bucket, "__n", total).select(bucket, "quota"))
    units = lookup_join(units, quotas, [bucket]).withColumn("__k", shuffle_key(seed, bucket, unit))
    n = units.count()
    ran = running_sums(units, [bucket], md5_bucket(F.col("__k"), n), [F.col("__k"), F.col(unit)], {"__before": F.col(rows)}, inclusive=False)
    return ran.filter(F.col("__before") < F.col("quota")).drop("__before", "quota", "__k")


def greedy_cover(groups: DataFrame, group: str, rows: str, target: int) -> DataFrame:
    """The smallest groups (ties by name) until their rows reach the target; empty groups never."""
    g = materialize(groups.filter(F.col(rows) > 0).withColumn("__d", F.col(rows).cast("double")))
    ranged, b = value_buckets(g, "__d")
    ran = running_sums(ranged, [], F.col(b), [F.col(rows), F.col(group)], {"__before": F.col(rows)}, inclusive=False)
    return ran.filter(F.col("__before") < target).drop("__before", "__d", b)
