"""Running sums and ranks over an order that no single task has to hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, materialize

#: Rows that one task may order.
PER_BUCKET = 50_000


def running_sums(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], sums: Mapping[str, Column], inclusive: bool = True) -> DataFrame:
    """df with the running sum of each expression in ``sums`` within keys.

    ``bucket`` must never fall as the order goes on: totals of buckets give offsets, and only the
    rows of a bucket are ordered in one task. Exclusive sums leave out the row itself. Null values add nothing.
    """
    keys = list(keys)
    df = df.withColumns({"__b": bucket} | {f"__v_{k}": F.coalesce(v, F.lit(0)) for k, v in sums.items()})
    totals = df.groupBy(*keys, "__b").agg(*[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums])
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(totals.select(*keys, "__b", *[F.coalesce(F.sum(f"__t_{k}").over(before), F.lit(0)).alias(f"__o_{k}") for k in sums]))
    own = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    df = df.withColumns({f"__r_{k}": F.coalesce(F.sum(f"__v_{k}").over(own), F.lit(0)) for k in sums})
    df = lookup_join(df, offsets, [*keys, "__b"])
    df = df.withColumns({k: F.col(f"__r_{k}") + F.col(f"__o_{k}") for k in sums})
    return df.drop("__b", *[f"{p}{k}" for k in sums for p in ("__v_", "__r_", "__o_")])


def md5_bucket(key: Column, rows: int, per_bucket: int = PER_BUCKET) -> Column:
    """Ranges of an md5 text (up to 2 ** 31) in which about ``per_bucket`` rows fall."""
    n = min(1 << 31, max(1, -(-rows // per_bucket)))
    return F.lit(0).cast("bigint") if n == 1 else F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * n / float(1 << 32)).cast("bigint")


def shuffled_rank(df: DataFrame, keys: Sequence[str], key: str, ties: Sequence[str], rank: str = "rank") -> DataFrame:
    """df with the 1-based rank of the md5 text column ``key`` (then ties) within keys."""
    rows = df.count()
    order = [F.col(key), *[F.col(t) for t in ties]]
    return running_sums(df, keys, md5_bucket(F.col(key), rows), order, {rank: F.lit(1).cast("bigint")})


def value_buckets(df: DataFrame, value: str, rows: int | None = None, per_bucket: int = PER_BUCKET, cuts: int = 1_000) -> tuple[DataFrame, str]:
    """df with a column of value ranges of about ``per_bucket`` rows, rising with the value.

    Up to ``cuts`` ranges lie between approximate quantiles. Where more are wanted, each is cut again into
    parts of equal width. Rows of equal value share a range.
    """
    rows = df.count() if rows is None else rows
    n, name = -(-rows // per_bucket), "__range"
    if n <= 1:
        return df.withColumn(name, F.lit(0.0)), name
    first = min(n, cuts)
    marks = sorted(set(df.approxQuantile(value, [i / first for i in range(first + 1)], 0.1 / first)))
    inner = marks[1:-1]
    out = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol=value, outputCol=name, handleInvalid="keep").transform(df) if inner else df.withColumn(name, F.lit(0.0))
    parts = -(-n // first)
    if parts > 1 and len(marks) > 1:
        at = F.least(F.greatest(F.col(name).cast("int"), F.lit(0)), F.lit(len(inner)))
        low, high = (F.array(*[F.lit(m) for m in side]) for side in (marks[:-1], marks[1:]))
        share = (F.col(value) - low[at]) / (high[at] - low[at])
        part = F.least(F.greatest(F.floor(share * parts), F.lit(0)), F.lit(parts - 1))
        out = out.withColumn(name, F.col(name) * parts + F.coalesce(part, F.lit(0)))
    return out, name


def dense_ids(df: DataFrame, value: str, pattern: str, name: str) -> DataFrame:
    """(value, name): distinct values numbered from 0 in rising order, formatted by pattern."""
    distinct = materialize(df.select(value).filter(F.col(value).isNotNull()).distinct())
    ranged, b = value_buckets(distinct.withColumn("__d", F.col(value).cast("double")), "__d")
    numbered = running_sums(ranged, [], F.col(b), [F.col(value)], {"__n": F.lit(1).cast("bigint")})
    return numbered.select(value, F.format_string(pattern, F.col("__n") - 1).alias(name))


def global_top(df: DataFrame, order: Sequence[Column], n: int, by: str | None = None, descending: bool = True) -> DataFrame:
    """The first n rows.

    ``by`` names the numeric column that the order starts with (nulls last): an approximate quantile
    then drops what surely comes later, so that the one task that merges sees few rows more
    than n. Rows dropped are proven by a count to leave at least n.
    """
    if n <= 0:
        return df.limit(0)
    if by is not None:
        df = materialize(df)
        rows = df.count()
        if rows > 10 * n and rows > PER_BUCKET:
            share = n / rows
            error = max(1e-6, share / 10)
            cut = df.approxQuantile(by, [max(0.0, 1 - share - 3 * error) if descending else min(1.0, share + 3 * error)], error)
            if cut:
                near = df.filter(F.col(by) >= cut[0]) if descending else df.filter(F.col(by) <= cut[0])
                if near.count() >= n:
                    df = near
    return df.orderBy(*order).limit(n)
