"""Queries that go through sources, sinks and pictures."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import group_key, parse_list, smooth_target
from ..operators.common import shared_dir
from ..operators.summary import except_keys, union_first
from ..sources.images import encode_png, hash_images
from ..sources.manifest import load_yaml, save_yaml, scan_manifest, with_row_index
from ..sources.scoring import score_rows, verdict
from ..sources.tables import read_samples, upsert_table, write_samples
from .tables import SAMPLES, read, samples


def _place(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/corpuskit/{uuid.uuid4().hex}"


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """train_csv written as CSV and read back by its schema."""
    place = _place(spark)
    write_samples(read(spark, sf_dir, "train_csv"), place)
    return read_samples(spark, place)


def q_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered by path."""
    return with_row_index(samples(spark, sf_dir).select("path"), "path", "place")


def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of best scores a path, filled in two steps."""
    r = read(spark, sf_dir, "replay_buffer").filter("path IS NOT NULL").select("path", "score", "mined_at")
    place = _place(spark)

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if old is None else old.unionByName(new)
        return both.groupBy("path").agg(F.max("score").alias("score"), F.max("mined_at").alias("mined_at"))

    upsert_table(r.filter("mined_at < '2025-09-01'"), place, merge)
    return upsert_table(r.filter("mined_at >= '2025-09-01' OR mined_at IS NULL"), place, merge)


def q_image_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The thumbnails of all readable rows made PNG files, decoded and hashed in every way."""
    r = read(spark, sf_dir, "scan_index").filter("length(thumb8_hex) = 128").select("row_idx", "thumb8_hex")

    def run(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            px = [np.frombuffer(bytes.fromhex(t), np.uint8).reshape(8, 8) for t in pdf["thumb8_hex"]]
            yield pd.DataFrame({"row_idx": pdf["row_idx"], "content": [encode_png(np.repeat(x[:, :, None], 3, axis=2)) for x in px]})

    return hash_images(r.mapInPandas(run, "row_idx bigint, content binary")).select("row_idx", "read_ok", "width", "height", "pixel_sha1", "ahash64", "dhash64", "phash64", "thumb8_hex")


_FILES = ("a/b/one.jpg", "a/Two.PNG", "three.webp", "a/notes.txt")


def q_manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of the few files of _FILES below every source of manifest_source, listed by a manifest that was written and read again."""
    place = _place(spark)
    plain = place.removeprefix("file://")
    sources = [r.asDict() for r in read(spark, sf_dir, "manifest_source").orderBy("name").collect()]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for s in sources:
        for f in _FILES:
            path = jvm.org.apache.hadoop.fs.Path(f"{place}/{s['name']}/{f}")
            stream = path.getFileSystem(conf).create(path)
            stream.writeBytes("picture")
            stream.close()
        s |= {"path": f"{plain if place.startswith('file:') else place}/{s['name']}"}
    kept = [{k: v for k, v in s.items() if v is not None} for s in sources]
    save_yaml({"recursive": True, "sources": kept}, f"{plain}/manifest.yaml")
    index = scan_manifest(spark, load_yaml(f"{plain}/manifest.yaml"), strict=True)
    return index.select("source", "relpath", "filename", "stem", "label", "dataset", "domain", "generator", "split_hint", "sample_weight", "is_hard_negative", "group_level", "file_size_bytes")


def q_union_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buffer rows and training rows, one a path: the buffer's first mined, else the training row of the smallest source and label."""
    cols = ["path", "source", "label"]
    r = read(spark, sf_dir, "replay_buffer").select(*cols, "replay_id")
    return union_first([r, read(spark, sf_dir, "train_csv").select(*cols)], "path", ["replay_id", "source", "label"])


def q_except_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows whose path was never mined."""
    return except_keys(read(spark, sf_dir, "train_csv").select("path", "label", "source"), read(spark, sf_dir, "replay_buffer"), "path")


def q_targets_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothed targets and group keys of training rows, columns named by a list."""
    columns = parse_list(" source, generator ,")
    return read(spark, sf_dir, "train_csv").select("path", F.round(smooth_target("label", 0.1), 6).alias("target"), group_key(columns).alias("group_key"))


def _thumb_scorer():
    def score(pdf):
        return [sum(bytes.fromhex(t)) / (255.0 * 64) for t in pdf["thumb8_hex"]]

    return score


def q_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean brightness of every thumbnail as a score, with its verdict."""
    r = read(spark, sf_dir, "scan_index").filter("length(thumb8_hex) = 128")
    scored = score_rows(r.select("row_idx", "thumb8_hex"), _thumb_scorer, "row_idx")
    out = scored.join(r.select("row_idx", "path"), "row_idx")
    return out.select("row_idx", F.round("score", 6).alias("score"), F.get_json_object(verdict("path", "score", 0.5), "$.pred_label").cast("int").alias("pred_label"))


QUERIES = {k: v for k, v in globals().items() if k.startswith("q_")}
_SUM = "list_sum(list_transform(range(0, 64), lambda i: CAST('0x' || substr(thumb8_hex, 2 * i::INT + 1, 2) AS INT)))"
#: The hashes by their definition: triangle weights, rounding half to even, a cosine basis of 32.
_HASH_SQL = """WITH px AS (SELECT row_idx, thumb8_hex, i // 8 AS y, i % 8 AS x, CAST('0x' || substr(thumb8_hex, 2 * i::INT + 1, 2) AS INT)::DOUBLE AS v
  FROM scan_index, (SELECT unnest(range(64)) AS i) WHERE length(thumb8_hex) = 128),
luma AS (SELECT row_idx, y, x, round_even(round(v * 0.299 + v * 0.587 + v * 0.114, 6), 0) AS v, v * 0.299 + v * 0.587 + v * 0.114 AS g FROM px),
a AS (SELECT row_idx, v > avg(v) OVER (PARTITION BY row_idx) AS bit, 63 - (y * 8 + x) AS place FROM luma),
w0 AS (SELECT m, j, i, greatest(0, 1 - abs(i - ((j + 0.5::DOUBLE) * 8 / m - 0.5::DOUBLE))) AS w FROM (SELECT unnest([9, 32]) AS m), LATERAL (SELECT unnest(range(m)) AS j), (SELECT unnest(range(8)) AS i)),
w AS (SELECT m, j, i, w / sum(w) OVER (PARTITION BY m, j) AS w FROM w0),
wide AS (SELECT row_idx, y, j AS x, round_even(round(sum(g * w), 6), 0) AS v FROM luma JOIN w ON m = 9 AND w.i = luma.x AND w > 0 GROUP BY ALL),
d AS (SELECT row_idx, lead(v) OVER (PARTITION BY row_idx, y ORDER BY x) > v AS bit, 63 - (y * 8 + x) AS place, x FROM wide),
rows32 AS (SELECT row_idx, j AS y, x, sum(g * w) AS v FROM luma JOIN w ON m = 32 AND w.i = luma.y AND w > 0 GROUP BY ALL),
big AS (SELECT row_idx, y, j AS x, round_even(round(sum(v * w), 6), 0) AS v FROM rows32 JOIN w ON m = 32 AND w.i = rows32.x AND w > 0 GROUP BY ALL),
basis AS (SELECT k, n, cos(pi() * (2 * n + 1) * k / 64) * CASE WHEN k = 0 THEN sqrt(1 / 32.0) ELSE sqrt(2 / 32.0) END AS c FROM (SELECT unnest(range(8)) AS k), (SELECT unnest(range(32)) AS n)),
half AS (SELECT row_idx, k AS u, x, sum(v * c) AS v FROM big JOIN basis ON n = y GROUP BY ALL),
low AS (SELECT row_idx, u, k AS z, round(sum(v * c), 6) AS v FROM half JOIN basis ON n = x GROUP BY ALL),
mid AS (SELECT row_idx, median(v) AS m FROM low WHERE u + z > 0 GROUP BY 1),
p AS (SELECT row_idx, v > m AND u + z > 0 AS bit, 63 - (u * 8 + z) AS place FROM low JOIN mid USING (row_idx)),
h AS (SELECT row_idx, k, lpad(lower(to_hex(CAST(sum(CASE WHEN bit THEN (CAST(1 AS HUGEINT) << CAST(place AS INT)) ELSE 0 END) AS UBIGINT))), 16, '0') AS h
  FROM (SELECT row_idx, 'a' AS k, bit, place FROM a UNION ALL SELECT row_idx, 'd', bit, place FROM d WHERE x < 8 UNION ALL SELECT row_idx, 'p', bit, place FROM p) GROUP BY ALL)
SELECT row_idx, 1 AS read_ok, 8 AS width, 8 AS height, sha1(CAST('8x8' AS BLOB) || unhex(regexp_replace(thumb8_hex, '(..)', '\\1\\1\\1', 'g'))) AS pixel_sha1,
  (SELECT h FROM h WHERE h.row_idx = s.row_idx AND k = 'a') AS ahash64, (SELECT h FROM h WHERE h.row_idx = s.row_idx AND k = 'd') AS dhash64,
  (SELECT h FROM h WHERE h.row_idx = s.row_idx AND k = 'p') AS phash64, lower(thumb8_hex) AS thumb8_hex FROM scan_index s WHERE length(thumb8_hex) = 128"""
_SCAN_SQL = """SELECT name AS source, f AS relpath, regexp_extract(f, '[^/]*$') AS filename, regexp_extract(f, '([^/]*)\\.[a-zA-Z]+$', 1) AS stem, label, coalesce(dataset, 'unknown') AS dataset, coalesce(domain, 'unknown') AS domain,
  coalesce(generator, CASE WHEN label = 0 THEN 'real' ELSE 'unknown' END) AS generator, CASE WHEN split_hint IS NULL OR trim(split_hint) = '' THEN 'seen' ELSE lower(trim(split_hint)) END AS split_hint,
  coalesce(sample_weight, 1.0) AS sample_weight, coalesce(is_hard_negative, 0) AS is_hard_negative, coalesce(group_level, 1) AS group_level, 7::BIGINT AS file_size_bytes
FROM manifest_source, (SELECT unnest(['a/b/one.jpg', 'a/Two.PNG', 'three.webp']) AS f) WHERE coalesce(recursive, true) OR f = 'three.webp'"""
SQL = {
    "q_csv_round_trip": "SELECT * FROM train_csv",
    "q_row_index": f"WITH {SAMPLES} SELECT path, row_number() OVER (ORDER BY path) - 1 AS place FROM samples",
    "q_upsert": "SELECT path, max(score) AS score, max(mined_at) AS mined_at FROM replay_buffer WHERE path IS NOT NULL GROUP BY 1",
    "q_image_hash": _HASH_SQL,
    "q_manifest_scan": _SCAN_SQL,
    "q_union_first": """SELECT path, source, label, replay_id FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY f, replay_id NULLS FIRST, source NULLS FIRST, label NULLS FIRST) AS n
  FROM (SELECT 0 AS f, path, source, label, replay_id FROM replay_buffer UNION ALL SELECT 1, path, source, label, NULL FROM train_csv) WHERE path IS NOT NULL) WHERE n = 1""",
    "q_except_keys": "SELECT path, label, source FROM train_csv WHERE path IS NULL OR path NOT IN (SELECT path FROM replay_buffer WHERE path IS NOT NULL)",
    "q_targets_and_keys": "SELECT path, round(label * CAST(0.9 AS DOUBLE) + CAST(0.05 AS DOUBLE), 6) AS target, coalesce(source, 'unknown') || '|' || coalesce(generator, 'unknown') AS group_key FROM train_csv",
    "q_score_rows": f"SELECT row_idx, round({_SUM} / 16320.0, 6) AS score, CAST({_SUM} / 16320.0 >= 0.5 AS INT) AS pred_label FROM scan_index WHERE length(thumb8_hex) = 128",
}
