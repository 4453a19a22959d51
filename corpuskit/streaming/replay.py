"""The replay buffer kept up to date from a stream of scored or mined rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.mining import merge_buffer
from ..sources.tables import upsert_table


def stream_buffer(spark: SparkSession, source_dir: str, schema: StructType, buffer: str, checkpoint: str, most: int, files_per_batch: int = 100) -> StreamingQuery:
    """Start a query that merges every new Parquet file of mined rows into the buffer table and caps it.

    A batch that is run again after a failure merges to the same buffer, as a path's best row is kept.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)

    def merge(batch: DataFrame, _: int) -> None:
        upsert_table(batch, buffer, lambda old, new: merge_buffer(old, new, most))

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_error_rates(spark: SparkSession, source_dir: str, schema: StructType, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Streaming errors and rows of every source and mining window; rows later than ``late`` are dropped."""
    rows = spark.readStream.schema(schema).parquet(source_dir).withColumn("at", F.to_timestamp("mined_at"))
    return rows.withWatermark("at", late).groupBy(F.window("at", window), "source").agg(F.count("*").alias("rows"), F.sum("is_error").alias("errors"))
