"""Queries of the core operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import norm, not_blank
from ..operators.skew import exact_key_quantiles, heavy_keys, skewed_key_stats
from . import dedup_queries, key_queries, mining_queries, source_queries, split_queries
from .tables import read as _read

MODULES = (key_queries, dedup_queries, split_queries, mining_queries, source_queries)


def _p3_rows(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return _read(spark, sf_dir, "scan_index").select(*[norm(c).alias(c) for c in ("source", "generator")], *cols)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combinations of source and generator with a twentieth of all rows or more."""
    heavy = heavy_keys(_p3_rows(spark, sf_dir), ["source", "generator"], 20)
    return heavy.filter(not_blank(F.col("source")) & not_blank(F.col("generator"))).select("source", "generator")


def p3_key_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, readable rows and distinct phash64 of every combination."""
    rows = _p3_rows(spark, sf_dir, "read_ok", "phash64")
    return skewed_key_stats(rows, ["source", "generator"], "phash64", {"readable": F.coalesce(F.col("read_ok") == 1, F.lit(False))})


def p3_size_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles and 99th percentile of the file size of every combination."""
    return exact_key_quantiles(_p3_rows(spark, sf_dir, "file_size_bytes"), ["source", "generator"], "file_size_bytes", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99})


_SG = "lower(trim(source)) AS source, lower(trim(generator)) AS generator"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {"p3_found": p3_found, "p3_key_stats": p3_key_stats, "p3_size_quantiles": p3_size_quantiles}
    for m in MODULES:
        own |= m.QUERIES
    return own


def oracle_sql() -> dict[str, str]:
    own = {
        "p3_found": f"""SELECT source, generator FROM (SELECT {_SG} FROM scan_index) WHERE source <> '' AND generator <> ''
GROUP BY 1, 2 HAVING count(*) * 20 >= (SELECT count(*) FROM scan_index)""",
        "p3_key_stats": f"""SELECT source, generator, count(*) AS rows, count(*) FILTER (WHERE read_ok = 1) AS readable,
count(DISTINCT CASE WHEN trim(phash64) <> '' THEN phash64 END) AS distinct_values
FROM (SELECT {_SG}, read_ok, phash64 FROM scan_index) GROUP BY 1, 2""",
        "p3_size_quantiles": f"""SELECT source, generator, max(n) AS n_rows, max(c) AS n_values,
max(v) FILTER (WHERE v IS NOT NULL AND r = greatest(1, ceil(0.25 * c))) AS p25, max(v) FILTER (WHERE v IS NOT NULL AND r = greatest(1, ceil(0.5 * c))) AS p50,
max(v) FILTER (WHERE v IS NOT NULL AND r = greatest(1, ceil(0.75 * c))) AS p75, max(v) FILTER (WHERE v IS NOT NULL AND r = greatest(1, ceil(CAST(0.99 AS DOUBLE) * c))) AS p99
FROM (SELECT *, row_number() OVER (PARTITION BY source, generator ORDER BY v NULLS LAST) AS r, count(v) OVER (PARTITION BY source, generator) AS c,
  count(*) OVER (PARTITION BY source, generator) AS n FROM (SELECT {_SG}, file_size_bytes AS v FROM scan_index)) GROUP BY 1, 2""",
    }
    for m in MODULES:
        own |= m.SQL
    return own
