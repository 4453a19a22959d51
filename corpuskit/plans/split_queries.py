"""Queries of quotas, samples and split builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import allocate as A
from ..operators import splits as S
from .tables import SAMPLES, fill_sql, read, samples, take_sql


def _binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sample_columns(samples(spark, sf_dir)).filter("label IN (0, 1)")


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _binary(spark, sf_dir).groupBy("label", "source").agg(F.count("*").alias("rows"))


def q_waterfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand rows a label spread over sources."""
    return A.water_fill(_groups(spark, sf_dir), ["label"], "source", "rows", 1003)


def q_waterfill_overshoot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.water_fill(_groups(spark, sf_dir), ["label"], "source", "rows", 1003, overshoot=True)


def q_balanced_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.balanced_sample(_binary(spark, sf_dir), ["label"], "source", 403, "9").select("path", "label", "source", "picked")


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("unit")).agg(F.count("*").alias("rows"), F.min("o_orderpriority").alias("bucket"))


_RULES = ({"min_rows": 3000, "ratio": 0.0125, "min_rows_out": 20, "cap_rows_out": 60}, {"min_rows": 0, "ratio": 0.05, "min_rows_out": 10, "cap_rows_out": 300})


def q_rule_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _units(spark, sf_dir).groupBy("bucket").agg(F.sum("rows").alias("rows"))
    return u.withColumn("target", A.rule_target(F.col("rows"), _RULES))


def q_take_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of each priority until the rule's orders are reached."""
    return A.take_until(_units(spark, sf_dir), "bucket", "unit", "rows", A.rule_target(F.col("bucket_rows"), _RULES), "3")


def q_take_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of each priority until an even share of 501 orders is reached."""
    return A.take_rows_from_units(_units(spark, sf_dir), "bucket", "unit", "rows", 501, "3")


def q_greedy_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = read(spark, sf_dir, "scan_index").filter("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("rows"))
    return A.greedy_cover(g, "source", "rows", 300)


def _long(splits: dict[str, DataFrame], *cols: str) -> DataFrame:
    out = None
    for name, df in splits.items():
        part = df.select(F.lit(name).alias("split"), *cols)
        out = part if out is None else out.unionByName(part)
    return out


def q_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = S.sample_columns(samples(spark, sf_dir))
    return s.select("path", S.role(F.col("split_hint"), F.col("source"), F.col("generator"), ["real_food"], ["quillart"]).alias("role"))


def q_split_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight compact splits, with weights and hints."""
    out = S.compact_splits(samples(spark, sf_dir), (600, 50, 50, 150, 40), "source", 42, ["real_food"], ["quillart"])
    return _long(out, "path", "label", "split_hint", "sample_weight")


def q_split_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.single_stage_splits(samples(spark, sf_dir), {"val": (101, 103), "train": (700, 701)}, seed=42, overshoot=True)
    return _long(out, "path", "label")


def q_split_heldout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(S.heldout_splits(samples(spark, sf_dir), 90, 91, seed=42), "path", "label")


def _tight_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = read(spark, sf_dir, "components").select("row_idx", "split_component_id")
    return samples(spark, sf_dir).join(of, "row_idx", "left")


_VAL = ({"min_rows": 200, "ratio": 0.05, "min_rows_out": 8, "cap_rows_out": 20}, {"min_rows": 0, "ratio": 0.1, "min_rows_out": 4, "cap_rows_out": 15})


def q_split_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.tight_splits(_tight_input(spark, sf_dir), ["real_food", "real_interiors"], ["quillart", "cinemix"], ["gen_pastelar"], 60, 70, _VAL, exclude_datasets=["unknown"], test_sources=["real_sports"], seed=42)
    return _long(out, "path", "label", "split_component_id")


QUERIES = {k: v for k, v in globals().items() if k.startswith("q_")}

_B = f"{SAMPLES}, b AS (SELECT * FROM samples WHERE label IN (0, 1))"
_UNITS = "u AS (SELECT o_custkey AS unit, count(*) AS rows, min(o_orderpriority) AS bucket FROM orders GROUP BY 1)"


def _target(rows: str, rules) -> str:
    out = "0"
    for r in sorted(rules, key=lambda r: r["min_rows"]):
        out = f"CASE WHEN {rows} >= {r['min_rows']} THEN least(greatest(CAST(round_even({rows} * CAST({r['ratio']} AS DOUBLE), 0) AS BIGINT), {r['min_rows_out']}), {r['cap_rows_out']}) ELSE {out} END"
    return out


def _long_sql(parts: dict[str, str], cols: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS split, {cols} FROM {v}" for k, v in parts.items())


def _compact_sql() -> str:
    role = "CASE WHEN split_hint IN ('unseen', 'test_unseen') OR source = 'real_food' OR generator = 'quillart' THEN 'unseen' WHEN split_hint IN ('robust', 'stage2', 'robustness') THEN 'robust' WHEN split_hint IN ('val', 'dev') THEN 'fixed_val' WHEN split_hint IN ('test_seen', 'seen_test') THEN 'fixed_test_seen' ELSE 'seen' END"
    return f"""WITH {SAMPLES}, r AS (SELECT *, {role} AS role FROM samples),
val AS (SELECT * FROM r WHERE role = 'fixed_val'), test_seen AS (SELECT * FROM r WHERE role = 'fixed_test_seen'),
seen AS (SELECT * FROM r WHERE role = 'seen' AND label IN (0, 1)), odd AS (SELECT * FROM r WHERE role = 'seen' AND (label IS NULL OR label NOT IN (0, 1))),
{take_sql('tr', 'seen', 'source', 600, '42:train')},
un AS (SELECT * FROM r WHERE role = 'unseen' AND label IN (0, 1)), {take_sql('tu', 'un', 'source', 150, '42:test_unseen')},
rob AS (SELECT * FROM r WHERE role = 'robust' AND label IN (0, 1)), {take_sql('ex', 'rob', 'source', 40, '42:extra')},
train1 AS (SELECT * EXCLUDE (picked) FROM tr_m WHERE picked), left1 AS (SELECT * EXCLUDE (picked) FROM tr_m WHERE NOT picked),
extra AS (SELECT * EXCLUDE (picked) REPLACE (greatest(sample_weight, 1.0) AS sample_weight) FROM ex_m WHERE picked),
train2 AS (SELECT * FROM train1 UNION ALL SELECT * FROM extra),
unseen1 AS (SELECT * EXCLUDE (picked) FROM tu_m WHERE picked), pool AS (SELECT * FROM left1 WHERE label NOT IN (SELECT DISTINCT label FROM unseen1)),
{take_sql('su', 'pool', 'source', 150, '42:supplement')},
unseen2 AS (SELECT * FROM unseen1 UNION ALL SELECT * EXCLUDE (picked) REPLACE ('supplement_unseen' AS split_hint) FROM su_m WHERE picked),
reviewed AS (SELECT * FROM left1 WHERE path NOT IN (SELECT path FROM su_m WHERE picked) UNION ALL SELECT * FROM odd UNION ALL SELECT * EXCLUDE (picked) FROM tu_m WHERE NOT picked),
al AS (SELECT * FROM test_seen UNION ALL SELECT * FROM unseen2)
{_long_sql({'train_stage1': 'train1', 'train_stage2': 'train2', 'train_stage3': 'train2', 'val': 'val', 'test_seen': 'test_seen', 'test_unseen': 'unseen2', 'test_all': 'al', 'reviewed_pool': 'reviewed'}, 'path, label, split_hint, sample_weight')}"""


def _single_sql() -> str:
    ctes, train, val = [], [], []
    for label, group, v, t in ((0, "source", 101, 700), (1, "generator", 103, 701)):
        ctes.append(f"p{label} AS (SELECT * FROM samples WHERE split_hint <> 'unseen' AND label = {label}), {take_sql(f'v{label}', f'p{label}', group, v, '42:val', True)}, q{label} AS (SELECT * EXCLUDE (picked) FROM v{label}_m WHERE NOT picked), {take_sql(f't{label}', f'q{label}', group, t, '42:train', True)}")
        val.append(f"SELECT * FROM v{label}_m WHERE picked")
        train.append(f"SELECT * FROM t{label}_m WHERE picked")
    return f"""WITH {SAMPLES}, {', '.join(ctes)}, val AS ({' UNION ALL '.join(val)}), train AS ({' UNION ALL '.join(train)}), te AS (SELECT * FROM samples WHERE split_hint = 'unseen')
{_long_sql({'train': 'train', 'val': 'val', 'test_unseen': 'te'}, 'path, label')}"""


def _cover(name: str, pool: str, col: str, n: int) -> str:
    return f"{name} AS (SELECT {col} FROM (SELECT {col}, sum(c) OVER (ORDER BY c, {col}) - c AS before FROM (SELECT {col}, count(*) AS c FROM {pool} GROUP BY 1)) WHERE before < {n})"


def _heldout_sql() -> str:
    return f"""WITH {SAMPLES}, re AS (SELECT * FROM samples WHERE split_hint <> 'unseen' AND label = 0), fa AS (SELECT * FROM samples WHERE split_hint <> 'unseen' AND label = 1),
{_cover('hr', 're', 'source', 90)}, {_cover('hg', 'fa', 'generator', 91)},
pr AS (SELECT * FROM re WHERE source IN (SELECT source FROM hr)), pf AS (SELECT * FROM fa WHERE generator IN (SELECT generator FROM hg)),
{take_sql('vr', 'pr', 'source', 90, '42:val')}, {take_sql('vf', 'pf', 'generator', 91, '42:val')},
train AS (SELECT * FROM re WHERE source NOT IN (SELECT source FROM hr) UNION ALL SELECT * FROM fa WHERE generator NOT IN (SELECT generator FROM hg)),
val AS (SELECT path, label FROM vr_m WHERE picked UNION ALL SELECT path, label FROM vf_m WHERE picked), te AS (SELECT * FROM samples WHERE split_hint = 'unseen')
{_long_sql({'train': 'train', 'val': 'val', 'test_unseen': 'te'}, 'path, label')}"""


def _unit_sql(name: str, pool: str) -> str:
    return f"{name} AS (SELECT unit, count(*) AS rows, arg_min(source, path) AS source, arg_min(generator, path) AS generator FROM {pool} GROUP BY 1)"


def _tight_sql() -> str:
    ctes = []
    for label, bucket, n in ((0, "source", 60), (1, "generator", 70)):
        ctes.append(f"""{_unit_sql(f'vu{label}', f'(SELECT * FROM pool WHERE label = {label})')},
vg{label} AS (SELECT 1 AS k, {bucket} FROM vu{label}, unnest(range(rows))),
{fill_sql(f'w{label}', f'vg{label}', bucket, n, 'k')},
vt{label} AS (SELECT unit FROM (SELECT unit, {bucket}, sum(rows) OVER (PARTITION BY {bucket} ORDER BY md5('42:val_unseen:' || {bucket} || ':' || unit), unit) - rows AS before FROM vu{label}) x JOIN w{label}_q q ON q.g = x.{bucket} WHERE before < quota)""")
    chosen = "chosen AS (SELECT unit, 0 AS label FROM vt0 UNION ALL SELECT unit, 1 FROM vt1)"
    rest = "rest AS (SELECT * FROM seen WHERE NOT held AND label IN (0, 1) AND unit NOT IN (SELECT unit FROM chosen))"
    second = []
    for label in (0, 1):
        second.append(f"""{_unit_sql(f'ru{label}', f'(SELECT * FROM rest WHERE label = {label})')},
rt{label} AS (SELECT unit FROM (SELECT *, sum(rows) OVER (PARTITION BY source ORDER BY md5('42:val_seen:' || source || ':' || unit), unit) - rows AS before, sum(rows) OVER (PARTITION BY source) AS bucket_rows FROM ru{label}) WHERE before < {_target('bucket_rows', _VAL)})""")
    return f"""WITH {SAMPLES}, un AS (SELECT s.*, c.split_component_id, coalesce(c.split_component_id, 'unknown') AS unit FROM samples s LEFT JOIN components c USING (row_idx)),
test AS (SELECT * FROM un WHERE split_hint IN ('unseen', 'test_unseen') OR source = 'real_sports'),
seen AS (SELECT *, coalesce((label = 0 AND source IN ('real_food', 'real_interiors')) OR (label = 1 AND (generator IN ('quillart', 'cinemix') OR source = 'gen_pastelar')), false) AS held
  FROM un WHERE NOT (split_hint IN ('unseen', 'test_unseen') OR source = 'real_sports') AND dataset <> 'unknown'),
pool AS (SELECT * FROM seen WHERE held), {', '.join(ctes)}, {chosen}, {rest}, {', '.join(second)},
vun AS (SELECT p.* FROM pool p JOIN chosen c ON p.unit = c.unit AND p.label = c.label),
vse AS (SELECT * FROM rest WHERE (label = 0 AND unit IN (SELECT unit FROM rt0)) OR (label = 1 AND unit IN (SELECT unit FROM rt1))),
train AS (SELECT * FROM rest WHERE unit NOT IN (SELECT unit FROM rt0) AND unit NOT IN (SELECT unit FROM rt1))
{_long_sql({'train': 'train', 'val_seen': 'vse', 'val_unseen': 'vun', 'test': 'test'}, 'path, label, split_component_id')}"""


SQL = {
    "q_waterfill": f"WITH {_B}, {fill_sql('f', 'b', 'source', 1003)} SELECT label, g AS source, n AS rows, quota FROM f_q",
    "q_waterfill_overshoot": f"WITH {_B}, {fill_sql('f', 'b', 'source', 1003, overshoot=True)} SELECT label, g AS source, n AS rows, quota FROM f_q",
    "q_balanced_sample": f"WITH {_B}, {take_sql('f', 'b', 'source', 403, '9')} SELECT path, label, source, picked FROM f_m",
    "q_rule_target": f"WITH {_UNITS} SELECT bucket, CAST(sum(rows) AS BIGINT) AS rows, {_target('sum(rows)', _RULES)} AS target FROM u GROUP BY 1",
    "q_take_until": f"""WITH {_UNITS} SELECT unit, rows, bucket FROM (SELECT *, sum(rows) OVER (PARTITION BY bucket ORDER BY md5('3:' || bucket || ':' || unit), unit) - rows AS before,
sum(rows) OVER (PARTITION BY bucket) AS bucket_rows FROM u) WHERE before < {_target('bucket_rows', _RULES)}""",
    "q_take_rows": f"""WITH {_UNITS}, x AS (SELECT 1 AS k, bucket FROM orders JOIN u ON unit = o_custkey), {fill_sql('f', 'x', 'bucket', 501, 'k')}
SELECT unit, rows, bucket FROM (SELECT *, sum(rows) OVER (PARTITION BY bucket ORDER BY md5('3:' || bucket || ':' || unit), unit) - rows AS before FROM u) JOIN f_q ON g = bucket WHERE before < quota""",
    "q_greedy_cover": "WITH " + _cover("c", "(SELECT * FROM scan_index WHERE source IS NOT NULL)", "source", 300) + " SELECT source, count(*) AS rows FROM scan_index WHERE source IN (SELECT source FROM c) GROUP BY 1",
    "q_role": f"""WITH {SAMPLES} SELECT path, CASE WHEN split_hint IN ('unseen', 'test_unseen') OR source = 'real_food' OR generator = 'quillart' THEN 'unseen' WHEN split_hint IN ('robust', 'stage2', 'robustness') THEN 'robust'
WHEN split_hint IN ('val', 'dev') THEN 'fixed_val' WHEN split_hint IN ('test_seen', 'seen_test') THEN 'fixed_test_seen' ELSE 'seen' END AS role FROM samples""",
    "q_split_compact": _compact_sql(),
    "q_split_single": _single_sql(),
    "q_split_heldout": _heldout_sql(),
    "q_split_tight": _tight_sql(),
}
