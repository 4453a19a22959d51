"""Queries of hard-example mining and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import mining as N
from .tables import SCORED, read, scored

_THR = 0.6


def _hard(spark: SparkSession, sf_dir: str, errors_only: bool) -> DataFrame:
    return N.select_hard(scored(spark, sf_dir), _THR, 120, 130, 60, errors_only=errors_only)


_COLS = ["path", "label", "score", "source", "pred_label", "is_error", "hard_type", "sample_weight", "is_hard_negative", "decision_thr", "mined_at", "mined_model"]


def q_hard_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = _hard(spark, sf_dir, False)
    return h.select(*_COLS, F.round("priority", 9).alias("priority"), F.round("margin_to_threshold", 9).alias("margin_to_threshold"))


def q_hard_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hard(spark, sf_dir, True).select(*_COLS)


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    cols = ["replay_id", "path", "label", "source", "priority", "sample_weight", "score", "mined_at", "hard_type"]
    r = read(spark, sf_dir, "replay_buffer").select(*cols)
    new = F.col("mined_at") >= "2025-09-01"
    return r.filter(~new), r.filter(new)


def q_merge_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and newly mined rows, the best of each path, uncapped."""
    old, new = _halves(spark, sf_dir)
    return N.merge_buffer(old, new, 1 << 40)


def q_buffer_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with room for 600 rows, shared evenly by sources."""
    old, new = _halves(spark, sf_dir)
    return N.merge_buffer(old, new, 600)


def q_merge_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard examples put before the training rows of the same path."""
    base = read(spark, sf_dir, "train_csv").filter("path IS NOT NULL").groupBy("path").agg(F.max("label").alias("label"), F.max("source").alias("source"), F.max("sample_weight").alias("sample_weight"), F.max("is_hard_negative").alias("is_hard_negative"))
    return N.merge_with_train(_hard(spark, sf_dir, False), base).select("path", "label", "source", "sample_weight", "is_hard_negative", "hard_type")


def _six(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _six(M.binary_metrics(scored(spark, sf_dir)))


def q_eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold and recall at precisions."""
    return _six(M.precision_targets(scored(spark, sf_dir), [0.3, 0.5, 0.55, 0.6, 0.95]))


def q_threshold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.threshold_curve(scored(spark, sf_dir))


def q_source_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curve of every source by itself."""
    return M.threshold_curve(scored(spark, sf_dir), keys=["source"])


QUERIES = {k: v for k, v in globals().items() if k.startswith("q_")}


def _hard_sql(errors: bool, cols: str) -> str:
    e = "AND is_error = 1" if errors else ""
    return f"""WITH {SCORED}, d AS (SELECT path, label, score, coalesce(source, string_split(path, '/')[-2], 'unknown') AS source, CAST(score >= {_THR} AS INT) AS pred_label,
  CAST(CAST(score >= {_THR} AS INT) <> label AS INT) AS is_error FROM scored),
r AS (SELECT *, score AS priority, score - {_THR} AS margin_to_threshold, CASE WHEN is_error = 1 THEN 'real_false_positive' ELSE 'real_near_miss' END AS hard_type, CAST(3 AS DOUBLE) AS sample_weight FROM d WHERE label = 0 {e} ORDER BY score DESC, path LIMIT 120),
f AS (SELECT *, 1.0 - score AS priority, {_THR} - score AS margin_to_threshold, CASE WHEN is_error = 1 THEN 'fake_false_negative' ELSE 'fake_near_miss' END AS hard_type, CAST(3 AS DOUBLE) AS sample_weight FROM d WHERE label = 1 {e} ORDER BY 1.0 - score DESC, path LIMIT 130),
u AS (SELECT *, 1.0 - abs(score - {_THR}) AS priority, 0.0 - abs(score - {_THR}) AS margin_to_threshold, 'uncertain_band' AS hard_type, CAST(1.5 AS DOUBLE) AS sample_weight FROM d
  WHERE path NOT IN (SELECT path FROM r UNION SELECT path FROM f) {'AND false' if errors else ''} ORDER BY 1.0 - abs(score - {_THR}) DESC, path LIMIT 60),
h AS (SELECT *, 1 AS is_hard_negative, CAST({_THR} AS DOUBLE) AS decision_thr, '1970-01-01T00:00:00+00:00' AS mined_at, 'ema' AS mined_model FROM (SELECT * FROM r UNION ALL SELECT * FROM f UNION ALL SELECT * FROM u))
SELECT {cols} FROM h"""


_BEST = """WITH x AS (SELECT replay_id, path, label, coalesce(source, string_split(path, '/')[-2], 'unknown') AS source, CASE WHEN isnan(priority) THEN NULL ELSE priority END AS priority, sample_weight, score, mined_at, hard_type
  FROM replay_buffer WHERE path IS NOT NULL AND mined_at IS NOT NULL),
y AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY priority DESC NULLS LAST, sample_weight DESC NULLS LAST, score DESC NULLS LAST, mined_at DESC NULLS LAST, replay_id) AS n0 FROM x),
best AS (SELECT * EXCLUDE (n0) FROM y WHERE n0 = 1)"""
_ORDER = "priority DESC NULLS LAST, sample_weight DESC NULLS LAST, path"


def _curve(keys: str = "") -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    k = f"{keys}, " if keys else ""
    return f"""WITH {SCORED}, g AS (SELECT {k}score, sum(label) AS p, sum(1 - label) AS n FROM scored WHERE label IN (0, 1) GROUP BY ALL),
c AS (SELECT {k}score, p, n, sum(p) OVER ({part} ORDER BY score DESC) AS tp, sum(n) OVER ({part} ORDER BY score DESC) AS fp, sum(p) OVER ({part}) AS pos, sum(n) OVER ({part}) AS neg FROM g)"""


SQL = {
    "q_hard_examples": _hard_sql(False, ", ".join(_COLS) + ", round(priority, 9) AS priority, round(margin_to_threshold, 9) AS margin_to_threshold"),
    "q_hard_errors": _hard_sql(True, ", ".join(_COLS)),
    "q_merge_buffer": f"{_BEST} SELECT * FROM best",
    "q_buffer_cap": f"""{_BEST}, k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) <= 600 // (SELECT count(DISTINCT source) FROM best) AS kept FROM best),
l AS (SELECT * FROM k WHERE NOT kept ORDER BY {_ORDER} LIMIT 600 - (SELECT count(*) FROM k WHERE kept))
SELECT * EXCLUDE (kept) FROM (SELECT * FROM k WHERE kept OR (SELECT count(*) FROM best) <= 600 UNION ALL SELECT * FROM l WHERE (SELECT count(*) FROM best) > 600)""",
    "q_merge_train": "WITH hard AS (" + _hard_sql(False, "path, label, source, sample_weight, is_hard_negative, hard_type") + """),
base AS (SELECT path, max(label) AS label, coalesce(max(source), string_split(path, '/')[-2], 'unknown') AS source, max(sample_weight) AS sample_weight, max(is_hard_negative) AS is_hard_negative FROM train_csv WHERE path IS NOT NULL GROUP BY path)
SELECT * FROM hard UNION ALL SELECT *, NULL FROM base WHERE path NOT IN (SELECT path FROM hard)""",
    "q_binary_metrics": _curve() + f""", m AS (SELECT sum(p * tp / CAST(tp + fp AS DOUBLE)) / max(pos) AS average_precision, sum(n * (2 * tp - p) / CAST(2 AS DOUBLE)) / (CAST(max(pos) AS DOUBLE) * max(neg)) AS auroc FROM c)
SELECT (SELECT count(*) FROM scored WHERE label IN (0, 1)) AS rows, (SELECT round(avg(CAST((score >= 0.5)::INT = label AS INT)), 6) FROM scored WHERE label IN (0, 1)) AS accuracy,
(SELECT round(avg(CAST(score < 0.5 AS INT)), 6) FROM scored WHERE label = 0) AS real_accuracy, (SELECT round(avg(CAST(score >= 0.5 AS INT)), 6) FROM scored WHERE label = 1) AS fake_accuracy,
round(average_precision, 6) AS average_precision, round(auroc, 6) AS auroc FROM m""",
    "q_eval_report": _curve() + """, t AS (SELECT unnest([0.3, 0.5, 0.55, 0.6, 0.95])::DOUBLE AS target), b AS (SELECT target, min(score) AS threshold FROM t LEFT JOIN c ON tp / CAST(tp + fp AS DOUBLE) >= target AND tp > 0 GROUP BY 1)
SELECT target, round(threshold, 6) AS threshold, round(coalesce(tp / CAST(pos AS DOUBLE), 0), 6) AS recall FROM b LEFT JOIN c ON score = threshold""",
    "q_threshold_curve": _curve() + " SELECT score, tp::BIGINT AS tp, fp::BIGINT AS fp, pos::BIGINT AS pos, neg::BIGINT AS neg FROM c",
    "q_source_curve": _curve("source") + " SELECT source, score, tp::BIGINT AS tp, fp::BIGINT AS fp, pos::BIGINT AS pos, neg::BIGINT AS neg FROM c",
}
