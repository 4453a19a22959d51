"""Views of the test tables that several queries share, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.splits import distinct_paths


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def samples(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """One row a path of scan_index with the sample columns."""
    cols = ["row_idx", "path", "label", "source", "dataset", "domain", "generator", "split_hint", "sample_weight", "is_hard_negative", *more]
    return distinct_paths(read(spark, sf_dir, "scan_index").select(*cols), ["row_idx"])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored row a path of replay_buffer, the first mined."""
    r = read(spark, sf_dir, "replay_buffer")
    return distinct_paths(r.filter("label IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)"), ["replay_id"]).select("path", "label", "source", "generator", "score", "replay_id")


HINT = "CASE WHEN split_hint IS NULL OR trim(split_hint) = '' THEN 'seen' ELSE lower(trim(split_hint)) END"
SAMPLES = f"""s0 AS (SELECT row_idx, path, label, coalesce(source, 'unknown') AS source, coalesce(dataset, 'unknown') AS dataset, coalesce(domain, 'unknown') AS domain,
  coalesce(generator, 'unknown') AS generator, {HINT} AS split_hint, coalesce(sample_weight, 1.0) AS sample_weight, coalesce(is_hard_negative, 0) AS is_hard_negative,
  row_number() OVER (PARTITION BY path ORDER BY row_idx) AS n0 FROM scan_index WHERE path IS NOT NULL),
samples AS (SELECT * EXCLUDE (n0) FROM s0 WHERE n0 = 1)"""
SCORED = """sc AS (SELECT path, label, source, generator, score, replay_id, row_number() OVER (PARTITION BY path ORDER BY replay_id) AS n0 FROM replay_buffer
  WHERE label IS NOT NULL AND score IS NOT NULL AND NOT isnan(score) AND path IS NOT NULL),
scored AS (SELECT * EXCLUDE (n0) FROM sc WHERE n0 = 1)"""


def fill_sql(name: str, pool: str, group: str, total: int, keys: str = "label", overshoot: bool = False) -> str:
    """CTEs name_c (counts), name_l (level) and name_q (quotas) of an even fill over a pool's groups."""
    more = "any_left > 0" if overshoot else "place <= any_left"
    return f"""{name}_c AS (SELECT {keys}, {group} AS g, count(*) AS n FROM {pool} GROUP BY ALL),
{name}_l AS (SELECT {keys}, max(l) AS l FROM (SELECT {keys}, l, sum(least(n, l)) AS s FROM {name}_c, (SELECT unnest(range(0, (SELECT coalesce(max(n), 0) + 1 FROM {name}_c))) AS l) GROUP BY ALL) WHERE s <= {total} GROUP BY {keys}),
{name}_q AS (SELECT {keys}, g, n, least(n, l) + CASE WHEN n > l AND {more} THEN 1 ELSE 0 END AS quota FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys}, n > l ORDER BY g) AS place, {total} - sum(least(n, l)) OVER (PARTITION BY {keys}) AS any_left FROM {name}_c JOIN {name}_l USING ({keys})))"""


def take_sql(name: str, pool: str, group: str, total: int, seed: str, overshoot: bool = False) -> str:
    """fill_sql and name_m: the pool with ``picked``."""
    return f"""{fill_sql(name, pool, group, total, overshoot=overshoot)},
{name}_m AS (SELECT p.*, row_number() OVER (PARTITION BY p.label, p.{group} ORDER BY md5('{seed}:' || p.{group} || ':' || p.path), p.path) <= q.quota AS picked
  FROM {pool} p JOIN {name}_q q ON q.label = p.label AND q.g = p.{group})"""
