"""Queries of scalar functions, summaries, weights and draws."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import text as T
from ..operators import summary as S
from ..operators import weights as W
from ..operators.dedup import rebucket_flat
from ..operators.splits import sample_columns
from .tables import HINT, SAMPLES, read, samples


def q_text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs, stems, hints, tokens and groups from names and paths."""
    r = read(spark, sf_dir, "scan_index")
    return r.select(
        "row_idx",
        T.slug("source").alias("source_slug"),
        T.stem_id(T.file_stem("path")).alias("content"),
        T.split_hint("split_hint").alias("hint"),
        T.group_token("path", F.col("group_level")).alias("token"),
        T.group_token("path", 2).alias("token2"),
        T.source_of_path("path").alias("parent"),
        T.source_or_path("source", "path").alias("source_filled"),
        T.pair_group("dataset", "source", "path", "fakeclue").alias("pair"),
        T.prompt_group("dataset", "path", "dragon").alias("prompt"),
        T.generator_default("label").alias("generator_default"),
        T.group_key(["source", "label"]).alias("group_key"),
    )


_SLUG = "trim(regexp_replace(regexp_replace(lower(trim(coalesce({0}, ''))), '[^0-9a-z_\\-.]+', '_', 'g'), '_+', '_', 'g'), '_')"
_PARTS = "list_filter(string_split(path, '/'), lambda x: x <> '' AND x <> '.')"
_STEM0 = f"regexp_replace({_PARTS}[-1], '\\.[^.]*$', '')"


def _slug(x: str) -> str:
    return _SLUG.replace("{0}", x)


def _stem(x: str) -> str:
    s = f"regexp_replace(regexp_replace({_slug(x)}, '(_(real|fake|gt|mask|copy|dup|duplicate))+$', ''), '_v\\d+$', '')"
    return f"CASE WHEN {s} = '' THEN 'unknown' ELSE {s} END"


_BODY = f"regexp_replace(regexp_extract({_slug('source')}, '^fakeclue_(.*)$', 1), '_(real|fake)$', '')"
_BELOW = f"list_transform({_PARTS}, lambda y: {_slug('y')})"
_TEXT = f"""SELECT row_idx, {_slug('source')} AS source_slug, {_stem(_STEM0)} AS content, {HINT} AS hint,
CASE WHEN len({_PARTS}) > greatest(coalesce(group_level, 1), 1) THEN {_PARTS}[-(greatest(coalesce(group_level, 1), 1) + 1)] ELSE {_STEM0} END AS token,
CASE WHEN len({_PARTS}) > 2 THEN {_PARTS}[-3] ELSE {_STEM0} END AS token2,
coalesce({_PARTS}[-2], 'unknown') AS parent, coalesce(source, {_PARTS}[-2], 'unknown') AS source_filled,
CASE WHEN {_slug('dataset')} = 'fakeclue' THEN 'fakeclue:' || coalesce(nullif({_BODY}, ''), nullif({_BELOW}[list_position({_BELOW}, 'fakeclue') + 2], ''), 'unknown') ELSE '' END AS pair,
CASE WHEN {_slug('dataset')} = 'dragon' THEN 'dragon:' || {_stem(_STEM0)} ELSE '' END AS prompt,
CASE WHEN label = 0 THEN 'real' ELSE 'unknown' END AS generator_default, coalesce(source, 'unknown') || '|' || coalesce(CAST(label AS VARCHAR), 'unknown') AS group_key
FROM scan_index"""


def q_hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash buckets and seed offsets."""
    r = read(spark, sf_dir, "scan_index")
    return r.select("row_idx", H.hash_bucket("path", 97).alias("bucket"), H.hash_offset("path").alias("offset"), H.seed_offset("path").alias("seed"), F.round(H.uniform(H.shuffle_key(7, "path")), 9).alias("u"))


_MOD = "list_reduce(list_prepend(0, list_transform(range(1, 33), lambda i: strpos('0123456789abcdef', substr(md5(path), i::INT, 1)) - 1)), lambda a, d: (a * 16 + d) % 97)"
_HASH = f"""SELECT row_idx, printf('bucket_%03d', {_MOD}) AS bucket, CAST('0x' || substr(md5(path), 1, 8) AS BIGINT) AS offset,
coalesce(list_sum(list_transform(range(1, length(path) + 1), lambda i: i * unicode(substr(path, i::INT, 1)))), 0)::BIGINT % 100003 AS seed,
round(CAST('0x' || substr(md5('7:' || path), 1, 13) AS BIGINT) / 4503599627370496.0, 9) AS u FROM scan_index WHERE path IS NOT NULL"""


def q_sample_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample columns with their defaults, over train_csv."""
    return sample_columns(read(spark, sf_dir, "train_csv"))


_DEFAULTS = f"""SELECT path, label, coalesce(source, 'unknown') AS source, coalesce(dataset, 'unknown') AS dataset, coalesce(domain, 'unknown') AS domain,
coalesce(generator, 'unknown') AS generator, {HINT} AS split_hint, coalesce(sample_weight, 1.0) AS sample_weight, coalesce(is_hard_negative, 0) AS is_hard_negative FROM train_csv"""


def q_rebucket_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of few directories spread over hash buckets."""
    r = read(spark, sf_dir, "scan_index").select("row_idx", "path", "source", "group_token", "group_id")
    return rebucket_flat(r, threshold=3, buckets=97).select("row_idx", "group_token", "group_id")


_REBUCKET = f"""WITH f AS (SELECT source FROM scan_index WHERE source IS NOT NULL GROUP BY 1 HAVING count(DISTINCT group_token) <= 3)
SELECT row_idx, CASE WHEN f.source IS NOT NULL THEN b ELSE group_token END AS group_token, CASE WHEN f.source IS NOT NULL THEN s.source || ':' || b ELSE group_id END AS group_id
FROM (SELECT *, printf('bucket_%03d', {_MOD}) AS b FROM scan_index) s LEFT JOIN f ON s.source = f.source"""

_BY = ["label", "source", "dataset", "split_hint"]


def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.value_counts(read(spark, sf_dir, "scan_index"), _BY)


def q_index_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.index_summary(read(spark, sf_dir, "scan_index").select(*_BY), _BY)


def q_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.top_values(read(spark, sf_dir, "scan_index"), ["source", "generator"], 20)


def _hint_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    r = read(spark, sf_dir, "scan_index").withColumn("hint", T.split_hint("split_hint"))
    return {"train": r.filter("hint = 'seen'"), "test": r.filter("hint <> 'seen'")}


def q_split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_summary(_hint_frames(spark, sf_dir), ["path", "group_id"], ["label", "source", "dataset"])


def q_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _hint_frames(spark, sf_dir)
    return S.overlap(f["train"], f["test"], ["path", "group_id", "source", "generator"])


def q_unit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.unit_table(samples(spark, sf_dir, "group_id").filter("group_id IS NOT NULL"), "group_id", ["label", "source", "dataset", "domain", "generator", "split_hint"])


def q_removed_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each source's rows whose picture is not the first with its pixels."""
    r = read(spark, sf_dir, "scan_index").filter("source IS NOT NULL").select("row_idx", "source", "pixel_sha1")
    known = r.filter(F.trim("pixel_sha1") != "")
    clean = known.groupBy("pixel_sha1").agg(F.min_by("source", "row_idx").alias("source"))
    return S.removed_ratio(r, clean, "source").withColumn("removed_ratio", F.round("removed_ratio", 9))


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.balanced_weights(samples(spark, sf_dir), ["source", "label"], 0.5, "sample_weight", "is_hard_negative", 2.0)


def q_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weighted(spark, sf_dir).select("path", "group_key", "group_rows", F.round("weight", 9).alias("weight"))


def q_sampler_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = W.sampler_summary(_weighted(spark, sf_dir))
    return s.withColumns({c: F.round(c, 9) for c in ("weight_min", "weight_max")})


def q_weighted_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of a thousand rows drawn without replacement for two processes."""
    return W.draw_without_replacement(_weighted(spark, sf_dir), "row_idx", "weight", 100, 5, world=2).select("draw", "process", "row_idx")


def q_weighted_draw_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.draw_with_replacement(_weighted(spark, sf_dir), "row_idx", "weight", 500, 5, world=2)


def q_running_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean line price of lineitem weighted by quantity."""
    r = W.running_average(read(spark, sf_dir, "lineitem"), F.col("l_extendedprice"), F.col("l_quantity"))
    return r.select(F.round("average", 4).alias("average"))


_HINTED = f"h AS (SELECT *, {HINT} = 'seen' AS train FROM scan_index)"
_W = f"""WITH {SAMPLES},
w AS (SELECT *, source || '|' || coalesce(CAST(label AS VARCHAR), 'unknown') AS group_key FROM (SELECT * REPLACE (coalesce(source, 'unknown') AS source) FROM samples)),
g AS (SELECT *, count(*) OVER (PARTITION BY group_key) AS group_rows FROM w),
weighted AS (SELECT *, greatest(1.0 / pow(CAST(group_rows AS DOUBLE), CAST(0.5 AS DOUBLE)) * greatest(sample_weight, CAST(1e-6 AS DOUBLE)) * CASE WHEN is_hard_negative > 0 THEN CAST(2.0 AS DOUBLE) ELSE 1 END, CAST(1e-12 AS DOUBLE)) AS weight FROM g)"""
_U = "CAST('0x' || substr(md5({0}), 1, 13) AS BIGINT) / 4503599627370496.0"


def _counts(table: str, cols: list[str], extra: str = "", null: bool = False) -> str:
    return " UNION ALL ".join(f"SELECT {extra}'{c}' AS {'measure' if extra else 'column'}, CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM {table} {'' if null else f'WHERE {c} IS NOT NULL'} GROUP BY {c}" for c in cols)


def _split_summary_sql() -> str:
    parts = []
    for name, where in (("train", "train"), ("test", "NOT train")):
        parts.append(f"SELECT '{name}' AS split, 'rows' AS measure, NULL AS value, count(*) AS rows FROM h WHERE {where}")
        parts += [f"SELECT '{name}', 'distinct {c}', NULL, count(DISTINCT {c}) FROM h WHERE {where}" for c in ("path", "group_id")]
        parts += [f"SELECT '{name}', '{c}', CAST({c} AS VARCHAR), count(*) FROM h WHERE {where} AND {c} IS NOT NULL GROUP BY {c}" for c in ("label", "source", "dataset")]
    return f"WITH {_HINTED} " + " UNION ALL ".join(parts)


def _overlap_sql() -> str:
    part = """SELECT '{c}' AS column, (SELECT count(DISTINCT {c}) FROM h WHERE train) AS left_values, (SELECT count(DISTINCT {c}) FROM h WHERE NOT train) AS right_values,
(SELECT count(*) FROM (SELECT {c} FROM h WHERE train AND {c} IS NOT NULL INTERSECT SELECT {c} FROM h WHERE NOT train)) AS common,
coalesce((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT {c} AS v FROM h WHERE train AND {c} IS NOT NULL INTERSECT SELECT {c} FROM h WHERE NOT train ORDER BY 1 LIMIT 50)), '') AS examples"""
    return f"WITH {_HINTED} " + " UNION ALL ".join(part.replace("{c}", c) for c in ("path", "group_id", "source", "generator"))


QUERIES = {k: v for k, v in globals().items() if k.startswith("q_")}
SQL = {
    "q_text_keys": _TEXT,
    "q_hash_keys": _HASH,
    "q_sample_defaults": _DEFAULTS,
    "q_rebucket_flat": _REBUCKET,
    "q_value_counts": _counts("scan_index", _BY),
    "q_index_summary": _counts("scan_index", _BY, null=True),
    "q_top_values": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY \"column\" ORDER BY rows DESC, value) AS rank FROM ({_counts('scan_index', ['source', 'generator'])})) WHERE rank <= 20",
    "q_split_summary": _split_summary_sql(),
    "q_overlap": _overlap_sql(),
    "q_unit_table": f"WITH {SAMPLES}, u AS (SELECT s.*, i.group_id FROM (SELECT row_idx FROM samples) k JOIN scan_index s USING (row_idx) JOIN scan_index i USING (row_idx) WHERE i.group_id IS NOT NULL) SELECT group_id, count(*) AS rows, "
    + ", ".join(f"arg_min({c}, path) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("label", "source", "dataset", "domain", "generator", "split_hint"))
    + " FROM u GROUP BY group_id",
    "q_removed_ratio": """WITH r AS (SELECT source, count(*) AS raw_rows FROM scan_index WHERE source IS NOT NULL GROUP BY 1),
f AS (SELECT arg_min(source, row_idx) AS source FROM scan_index WHERE source IS NOT NULL AND trim(pixel_sha1) <> '' GROUP BY pixel_sha1),
c AS (SELECT source, count(*) AS clean_rows FROM f GROUP BY 1)
SELECT source, raw_rows, coalesce(clean_rows, 0) AS clean_rows, round((raw_rows - coalesce(clean_rows, 0)) / CAST(greatest(raw_rows, 1) AS DOUBLE), 9) AS removed_ratio FROM r LEFT JOIN c USING (source)""",
    "q_weights": _W + " SELECT path, group_key, group_rows, round(weight, 9) AS weight FROM weighted",
    "q_sampler_summary": _W + " SELECT count(DISTINCT group_key) AS groups, count(*) AS rows, round(min(weight), 9) AS weight_min, round(max(weight), 9) AS weight_max FROM weighted",
    "q_weighted_draw": _W + f""" SELECT draw, CAST(draw % 2 AS INT) AS process, row_idx FROM (SELECT row_idx, row_number() OVER (ORDER BY k, row_idx) - 1 AS draw FROM (
SELECT row_idx, -ln({_U.replace('{0}', "'5:' || row_idx")}) / weight AS k FROM weighted) ORDER BY k, row_idx LIMIT 100)""",
    "q_weighted_draw_replacement": _W + f""", c AS (SELECT row_idx, sum(weight) OVER (ORDER BY md5('5:' || row_idx), row_idx) AS hi, weight FROM weighted),
d AS (SELECT draw, {_U.replace('{0}', "'5:draw:' || draw")} * (SELECT sum(weight) FROM weighted) AS x FROM (SELECT unnest(range(500)) AS draw))
SELECT draw, CAST(draw % 2 AS INT) AS process, row_idx FROM d JOIN c ON x >= hi - weight AND x < hi""",
    "q_running_average": "SELECT round(sum(l_extendedprice * l_quantity) / greatest(1, sum(l_quantity)), 4) AS average FROM lineitem",
}
