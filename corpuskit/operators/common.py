"""Building blocks shared by the operators: written tables that cut lineage,
size-checked broadcasts, joins that split hot keys and ranks that need no single task."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import norm  # noqa: F401 - operators and queries take it from here

#: A side is broadcast only when it was measured and has at most so many rows and bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
#: A key held by more rows than this is never shuffled to one task.
HOT_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a temporary one in local mode, all
    of whose tasks share the machine; on a cluster, whose machines don't, an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        where = tempfile.mkdtemp(prefix="corpuskit-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialize(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    Cuts the lineage; survives the loss of any executor; later reads prune columns.
    """
    spark = df.sparkSession
    untyped = [c for c, kind in df.dtypes if kind == "void"]  # Parquet has no type for them
    df = df.withColumns({c: F.col(c).cast("string") for c in untyped}) if untyped else df
    path = f"{shared_dir(spark)}/corpuskit/{uuid.uuid4().hex}"
    (df if partitions is None else df.coalesce(partitions)).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._corpuskit_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete written tables that nothing needs any more."""
    for df in tables:
        path = getattr(df, "_corpuskit_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def measure(table: DataFrame) -> tuple[int, int]:
    """(rows, about the bytes of their values)."""
    width = F.lit(0).cast("bigint")
    for c, kind in table.dtypes:
        known = F.octet_length(F.col(f"`{c}`")) if kind in ("string", "binary") else F.length(F.to_json(F.struct(F.col(f"`{c}`")))) if kind[:3] in ("arr", "map", "str") else F.lit(8)
        width = width + F.coalesce(known, F.lit(8))
    found = table.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return found[0], found[1]


def is_small(table: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    rows, size = measure(table)
    return rows <= limit and size <= BROADCAST_BYTES


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in keys])


def renamed_columns(on: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"__k_{c}") for c in on]


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    limit: int = BROADCAST_ROWS,
    hot: int = HOT_ROWS,
) -> DataFrame:
    """Join left, which may hold hot keys, to a table with few rows a key.

    The table is written, unless it is already, and measured: up to ``limit`` rows and BROADCAST_BYTES it is broadcast. Beyond
    that the keys that left holds more than ``hot`` times are found by a partial aggregate: their
    rows meet a broadcast of their part of the table, if that is small, where they are, and only all
    other rows are shuffled. Null keys match null keys. how: inner, left, left_semi or left_anti.
    """
    on = list(on)
    right_cols = [c for c in table.columns if c not in on]
    names = [f"__k_{c}" for c in on]
    if not hasattr(table, "_corpuskit_path"):
        table = materialize(table)
    renamed = table.select(*renamed_columns(on), *right_cols)
    if is_small(table, limit):
        return left.join(F.broadcast(renamed), _same(on), how).drop(*names)
    many = left.groupBy(*on).agg(F.count("*").alias("__n")).filter(F.col("__n") > hot)
    many = materialize(many.select(*renamed_columns(on)))
    if many.isEmpty() or not is_small(many):
        return left.join(renamed, _same(on), how).drop(*names)
    few = F.broadcast(many)
    part = materialize(table.join(few, _same(on), "left_semi").select(*renamed_columns(on), *right_cols))
    if not is_small(part, max(limit, BROADCAST_ROWS)):  # no lookup: hot on both sides
        return left.join(renamed, _same(on), how).drop(*names)
    stay = left.join(few, _same(on), "left_semi").join(F.broadcast(part), _same(on), how).drop(*names)
    move = left.join(few, _same(on), "left_anti").join(renamed, _same(on), how).drop(*names)
    return stay.unionByName(move)


def split_join(left: DataFrame, table: DataFrame, on: str, weight: str, hot: int) -> DataFrame:
    """Inner join of left to a written table that tells how often left holds each key (``weight``).

    Keys held more than ``hot`` times are broadcast, if they are few, and never shuffled; all others meet
    in an ordinary join.
    """
    some = table.filter(F.col(weight) > hot).drop(weight)
    if some.isEmpty() or not is_small(some):
        return left.join(table.drop(weight), on)
    few = F.broadcast(some)
    rest = left.join(few.select(on), on, "left_anti").join(table.filter(F.col(weight) <= hot).drop(weight), on)
    return left.join(few, on).unionByName(rest)


def spread(df: DataFrame, per_core: int = 4) -> DataFrame:
    """df in at least ``per_core`` partitions a core, for costly work on each row.

    Only an input whose scan has fewer (a few small files of long texts) is moved.
    """
    least = per_core * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def before(order: Sequence[tuple[str, bool]], other: str) -> Column:
    """True where the row's order columns come at or before the same columns prefixed ``other``.

    order: (column, descending); nulls come last in either direction.
    """
    result = F.lit(True)
    for name, desc in reversed(order):
        a, b = F.col(name), F.col(other + name)
        less = (a > b) if desc else (a < b)
        less = F.coalesce(less, a.isNotNull() & b.isNull())
        result = less | (a.eqNullSafe(b) & result)
    return result


def ordering(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(n).desc_nulls_last() if desc else F.col(n).asc_nulls_last() for n, desc in order]


def ranked(df: DataFrame, keys: Sequence[str], order: str, rank: str = "rank", ties: Sequence[str] = (), per_bucket: int = 50_000) -> DataFrame:
    """Exact 1-based rank of ``order`` (a number; then of ``ties``) within keys, without
    gathering a key: counts of ranges of about ``per_bucket`` rows give offsets, and only a range is ranked in one task."""
    from .ranking import running_sums, value_buckets

    ranged, b = value_buckets(df.withColumn("__d", F.col(order).cast("double")), "__d", per_bucket=per_bucket)
    out = running_sums(ranged, keys, F.col(b), [F.col(c) for c in (order, *ties)], {rank: F.lit(1).cast("bigint")})
    return out.drop("__d", b)
