"""Counts, distinct counts and overlaps of splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value, rows for each non-null value of each column, in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("x")).select("x.*").filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("rows"))


def top_values(df: DataFrame, columns: Sequence[str], n: int = 20) -> DataFrame:
    """The n most frequent values of each column, ties by value, with their rank."""
    from pyspark.sql import Window

    w = Window.partitionBy("column").orderBy(F.desc("rows"), "value")
    return value_counts(df, columns).withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)


def index_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows for every value of every column, nulls included, by grouping sets over one scan."""
    sets = [[c] for c in columns]
    out = df.groupingSets(sets, *columns).agg(F.count("*").alias("rows"), F.grouping_id().alias("__id"))
    n = len(columns)
    which = F.coalesce(*[F.when(F.col("__id") == ((1 << n) - 1) ^ (1 << (n - 1 - i)), c) for i, c in enumerate(columns)])
    value = F.coalesce(*[F.when(F.col("__id") == ((1 << n) - 1) ^ (1 << (n - 1 - i)), F.col(c).cast("string")) for i, c in enumerate(columns)])
    return out.select(which.alias("column"), value.alias("value"), "rows")


def split_summary(splits: Mapping[str, DataFrame], distinct: Sequence[str], by: Sequence[str]) -> DataFrame:
    """split, measure, value, rows: totals, distinct counts and rows by label and column."""
    out = None
    for name, df in splits.items():
        whole = df.agg(F.count("*").alias("rows"), *[F.countDistinct(c).alias(c) for c in distinct])
        flat = whole.select(F.explode(F.array(F.struct(F.lit("rows").alias("measure"), F.lit(None).cast("string").alias("value"), F.col("rows")), *[F.struct(F.lit(f"distinct {c}").alias("measure"), F.lit(None).cast("string").alias("value"), F.col(c).alias("rows")) for c in distinct])).alias("x")).select("x.*")
        counts = value_counts(df, by).select(F.col("column").alias("measure"), "value", "rows")
        part = flat.unionByName(counts).select(F.lit(name).alias("split"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def overlap(a: DataFrame, b: DataFrame, columns: Sequence[str], shown: int = 50) -> DataFrame:
    """column, left_values, right_values, common, examples: distinct non-null values of two frames
    and the first common ones. A column that a frame lacks has no values."""
    out = None
    for c in columns:
        side = lambda df, k: (df.select(F.col(c).cast("string").alias("v")).filter("v IS NOT NULL").distinct() if c in df.columns else df.select(F.lit("").alias("v")).limit(0)).withColumn("side", F.lit(k))  # noqa: E731, B023
        both = side(a, 1).unionByName(side(b, 2)).groupBy("v").agg(F.sum("side").alias("s"))
        n = both.agg(F.count(F.when(F.col("s").isin(1, 3), 1)).alias("left_values"), F.count(F.when(F.col("s") >= 2, 1)).alias("right_values"), F.count(F.when(F.col("s") == 3, 1)).alias("common"))
        first = both.filter("s = 3").orderBy("v").limit(shown).agg(F.array_sort(F.collect_list("v")).alias("examples"))
        part = n.withColumn("column", F.lit(c)).join(first.withColumn("column", F.lit(c)), "column").select("column", "left_values", "right_values", "common", F.concat_ws(",", "examples").alias("examples"))
        out = part if out is None else out.unionByName(part)
    return out


def unit_table(df: DataFrame, unit: str, columns: Sequence[str], order: str = "path") -> DataFrame:
    """unit, rows and each column's first non-null value in ``order``."""
    return df.groupBy(unit).agg(F.count("*").alias("rows"), *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def removed_ratio(raw: DataFrame, clean: DataFrame, by: str) -> DataFrame:
    """by, raw_rows, clean_rows and the share removed; sources without clean rows count 0."""
    r = raw.groupBy(by).agg(F.count("*").alias("raw_rows"))
    c = clean.groupBy(by).agg(F.count("*").alias("clean_rows"))
    out = r.join(c, by, "left").select(by, "raw_rows", F.coalesce("clean_rows", F.lit(0)).alias("clean_rows"))
    return out.withColumn("removed_ratio", (F.col("raw_rows") - F.col("clean_rows")) / F.greatest("raw_rows", F.lit(1)))


def union_first(frames: Sequence[DataFrame], key: str, order: Sequence[str] = ()) -> DataFrame:
    """All rows of the frames, one a key: that of the first frame, then of ``order``; null keys are left out.

    Columns that a frame lacks are null.
    """
    from pyspark.sql import Window

    out = None
    for i, f in enumerate(frames):
        part = f.withColumn("__frame", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    first = Window.partitionBy(key).orderBy("__frame", *order)
    return out.filter(F.col(key).isNotNull()).withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "__frame")


def except_keys(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other frame doesn't hold; null keys stay."""
    return df.join(other.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")
