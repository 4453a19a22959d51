"""CSV and Parquet tables of samples, a content-keyed embedding cache, upserts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from .manifest import INDEX

#: Blanks around values are kept, and empty text is told from null.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
SAMPLE_SCHEMA = Y.StructType([
    Y.StructField("path", Y.StringType()),
    Y.StructField("label", Y.IntegerType()),
    Y.StructField("source", Y.StringType()),
    Y.StructField("dataset", Y.StringType()),
    Y.StructField("domain", Y.StringType()),
    Y.StructField("generator", Y.StringType()),
    Y.StructField("split_hint", Y.StringType()),
    Y.StructField("sample_weight", Y.DoubleType()),
    Y.StructField("is_hard_negative", Y.IntegerType()),
])


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of samples; path and label are required, known columns typed, others text."""
    raw = spark.read.options(**CSV).option("nullValue", "\x01").option("multiLine", True).csv(path)  # unquoted nothing is null, "" is text
    missing = {"path", "label"} - set(raw.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    known = {f.name: f.dataType for f in SAMPLE_SCHEMA.fields}
    return raw.select(*[F.col(f"`{c}`").try_cast(known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in raw.columns])


def ordered_columns(df: DataFrame) -> DataFrame:
    """Known sample columns first, then the rest as they come."""
    return df.select(*[c for c in INDEX if c in df.columns], *[c for c in df.columns if c not in INDEX])


def write_samples(df: DataFrame, path: str) -> None:
    ordered_columns(df).write.mode("overwrite").options(**CSV).csv(path)


def upsert_table(new: DataFrame, path: str, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> DataFrame:
    """Merge new rows into the Parquet table at path and swap it for the result.

    The merged table is written beside the old one, which is only renamed away once the new one is whole.
    """
    spark = new.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    target = fs_path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    old = spark.read.parquet(path) if fs.exists(target) else None
    tag = uuid.uuid4().hex
    beside, away = fs_path(f"{path}.{tag}.new"), fs_path(f"{path}.{tag}.old")
    merge(old, new).write.parquet(beside.toString())
    if old is not None:
        fs.rename(target, away)
    fs.rename(beside, target)
    fs.delete(away, True)
    return spark.read.parquet(path)


class EmbeddingCache:
    """Vectors kept by content hash and model, so that changed files and models are computed anew."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _stored(self) -> DataFrame | None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return self.spark.read.parquet(self.path) if p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p) else None

    def fill(self, rows: DataFrame, content: str, model: str, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """(content, model, vector) of all rows; embed gets the rows that are not stored and returns
        (content, vector). Only those are computed, and appended."""
        want = rows.filter(F.col(content).isNotNull()).dropDuplicates([content])
        stored = self._stored()
        known = stored.filter(F.col("model") == model) if stored is not None else None
        new = want if known is None else want.join(known.select(content), content, "left_anti")
        embed(new).select(content, F.lit(model).alias("model"), "vector").write.mode("append").parquet(self.path)
        return self._stored().filter(F.col("model") == model).join(want.select(content), content, "left_semi")


def known_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]
