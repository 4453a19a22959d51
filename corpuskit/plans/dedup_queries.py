"""Queries of duplicate edges, components and near neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..operators import dedup as D
from ..operators import graph as G
from ..operators import semantic as X
from ..operators.common import materialize
from ..operators.summary import removed_ratio
from .tables import HINT, read

_EXACT = {"raw_sha1": "exact_bytes", "pixel_sha1": "exact_pixels"}


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "scan_index")


def q_exact_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.exact_edges(_index(spark, sf_dir), "row_idx", _EXACT)


def q_pair_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.pair_lock_edges(_index(spark, sf_dir), "row_idx")


def q_prompt_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.prompt_lock_edges(_index(spark, sf_dir), "row_idx", "dragon")


def _near(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return D.near_edges(_index(spark, sf_dir), band_bits=16)


def q_near_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate edges between class representatives, suspicious ones included."""
    return _near(spark, sf_dir)[0]


def q_near_edges_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without the condition that hashes share a band, which loses some pairs."""
    return D.near_edges(_index(spark, sf_dir))[0]


def q_near_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every readable row."""
    return _near(spark, sf_dir)[1]


def q_lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band collisions of distinct embedding sign patterns."""
    e = read(spark, sf_dir, "embeddings").select("vec_id", H.sign_bits("embedding").alias("bits"))
    return D.lsh_candidates(e.groupBy("bits").agg(F.min("vec_id").alias("vec_id")), "vec_id", "bits", 8, 6)


def q_edge_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hamming distances, thumbnail difference and aspect of the rows on every edge."""
    e = read(spark, sf_dir, "edge").filter("dst_idx IS NOT NULL").select("src_idx", "dst_idx").distinct()
    r = _index(spark, sf_dir).select("row_idx", H.hash_to_long("phash64").alias("ph"), H.hash_to_long("dhash64").alias("dh"), H.thumb_bytes("thumb8_hex").alias("th"), H.log_aspect("width", "height").alias("la"))
    a, b = (r.select(*[F.col(c).alias(f"{s}_{c}") for c in r.columns]) for s in "ab")
    j = e.join(a, F.col("src_idx") == F.col("a_row_idx")).join(b, F.col("dst_idx") == F.col("b_row_idx"))
    mae = H.mean_difference(F.col("a_th"), F.col("b_th"))
    return j.select(
        "src_idx",
        "dst_idx",
        H.hamming(F.col("a_ph"), F.col("b_ph")).cast("bigint").alias("phash"),
        H.hamming(F.col("a_dh"), F.col("b_dh")).cast("bigint").alias("dhash"),
        F.round(F.when(mae < float("inf"), mae).otherwise(-1.0), 6).alias("difference"),
        F.round(F.abs(F.col("a_la") - F.col("b_la")), 6).alias("aspect"),
    )


def _all_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    near, members = _near(spark, sf_dir)
    parts = [q_exact_edges(spark, sf_dir), near, D.member_edges(members), q_pair_lock(spark, sf_dir), q_prompt_lock(spark, sf_dir)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialize(out)


def _applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["row_idx", "path", "label", "source", "split_hint", "width", "height", "file_size_bytes", "read_ok"]
    return D.apply_edges(_index(spark, sf_dir).select(*cols), _all_edges(spark, sf_dir))


def q_apply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components, canonical record and drop reason of every row, from all edges."""
    return _applied(spark, sf_dir).drop("label", "source", "split_hint", "width", "height", "file_size_bytes", "read_ok")


def q_edge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.edge_counts(_all_edges(spark, sf_dir))


def q_edge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given edges with path, source, label and component of both ends."""
    rows = _index(spark, sf_dir).select("row_idx", "path", "source", "label").join(read(spark, sf_dir, "components").select("row_idx", "dedup_component_id", "split_component_id"), "row_idx", "left")
    return D.edge_table(read(spark, sf_dir, "edge"), rows)


def q_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every row by the given edges of stage dedup."""
    e = read(spark, sf_dir, "edge").filter("stage = 'dedup'")
    return G.components(_index(spark, sf_dir).select("row_idx"), "row_idx", e, "src_idx", "dst_idx")


def q_exact_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and dropped rows of each source after exact deduplication."""
    cols = ["row_idx", "path", "label", "source", "split_hint", "width", "height", "file_size_bytes", "read_ok", "raw_sha1", "pixel_sha1"]
    r = _index(spark, sf_dir).select(*cols)
    out = D.apply_edges(r, D.exact_edges(r, "row_idx", _EXACT))
    return out.groupBy("source", "dedup_drop_reason").agg(F.count("*").alias("rows"), F.countDistinct("dedup_root").alias("components"))


def q_stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each source removed by all edges."""
    rows = _applied(spark, sf_dir).filter("source IS NOT NULL").select("source", "keep_after_dedup")
    rows = materialize(rows)
    return removed_ratio(rows, rows.filter("keep_after_dedup = 1"), "source").withColumn("removed_ratio", F.round("removed_ratio", 9))


_THRESHOLD = 0.3


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("source"), "embedding")


def q_cosine_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a source above the threshold, those of exact copies included."""
    n = X.cosine_neighbours(_vectors(spark, sf_dir), "vec_id", "source", "embedding", _THRESHOLD)
    return n.withColumn("cosine", F.round("cosine", 6)).drop("rank")


def q_semantic_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of the three nearest above the threshold."""
    reps, copies = X.vector_classes(_vectors(spark, sf_dir), "vec_id", "source", "embedding")
    n = X.cosine_neighbours(reps, "vec_id", "source", "embedding", _THRESHOLD, 4)
    n = X.member_neighbours(reps, n, copies, "vec_id", "source", 4)
    return X.semantic_edges(n).select("source", "row_a", "row_b", F.round("cosine", 6).alias("cosine"))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges that connect what all pairs above the threshold connect: those between distinct vectors,
    and from each to its exact copies."""
    reps, copies = X.vector_classes(_vectors(spark, sf_dir), "vec_id", "source", "embedding")
    return X.semantic_edges(X.cosine_neighbours(reps, "vec_id", "source", "embedding", _THRESHOLD)).unionByName(copies)


def _prunable(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    return v.select("vec_id", "source", F.format_string("/e/%05d", "vec_id").alias("path"), (F.col("vec_id") % 7).cast("int").alias("width"), (F.col("vec_id") % 5).cast("int").alias("height"), F.lit(1.0).alias("sample_weight"), F.format_string("base_%04d", F.expr("CAST(vec_id DIV 3 AS INT)")).alias("base"))


def q_semantic_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _links(spark, sf_dir)
    out = X.semantic_components(_prunable(spark, sf_dir), e, "vec_id", "source")
    return out.select("vec_id", "semantic_component_id", "semantic_component_size", "keep_stage2_semantic", "drop_stage2_semantic")


def q_tight_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _links(spark, sf_dir)
    return X.tight_units(_prunable(spark, sf_dir), e, "vec_id", "base")


_TIERS = ({"min_rows": 1000, "cosine_threshold": 0.992, "topk": 64}, {"min_rows": 300, "cosine_threshold": 0.9935, "topk": 48}, {"min_rows": 100, "cosine_threshold": 0.995, "topk": 32})


def q_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbour tier of every source by its rows."""
    n = _index(spark, sf_dir).filter("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("rows"))
    return n.withColumn("t", X.tier(F.col("rows"), _TIERS)).select("source", "rows", "t.*", X.keep_budget(F.col("rows")).alias("budget"))


def q_focus_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _index(spark, sf_dir).filter("source IS NOT NULL").select("source", "read_ok")
    ratios = removed_ratio(r, r.filter("read_ok = 1"), "source")
    return X.focus_sources(ratios, "source", ["real_scans"], min_clean=50, max_removed=0.02)


QUERIES = {k: v for k, v in globals().items() if k.startswith("q_")}


def _exact_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT g.a AS src_idx, s.row_idx AS dst_idx, '{r}' AS reason, '' AS score, 'dedup' AS stage FROM scan_index s JOIN (SELECT {c}, min(row_idx) AS a FROM scan_index WHERE trim({c}) <> '' GROUP BY 1) g ON s.{c} = g.{c} WHERE s.row_idx > g.a"
        for c, r in _EXACT.items()
    )


_PAIR = """SELECT g.a AS src_idx, s.row_idx AS dst_idx, 'pair_lock' AS reason, '' AS score, 'split_lock' AS stage FROM scan_index s
JOIN (SELECT pair_group, content_id, min(row_idx) AS a FROM scan_index WHERE pair_group <> '' AND content_id <> '' GROUP BY 1, 2
  HAVING min(label) = 0 AND max(label) = 1 AND count(*) FILTER (WHERE label NOT IN (0, 1)) = 0) g ON s.pair_group = g.pair_group AND s.content_id = g.content_id WHERE s.row_idx > g.a"""
_PROMPT = """SELECT g.a AS src_idx, s.row_idx AS dst_idx, 'stem_lock' AS reason, '' AS score, 'split_lock' AS stage FROM scan_index s
JOIN (SELECT prompt_group, min(row_idx) AS a FROM scan_index WHERE prompt_group <> '' AND lower(dataset) = 'dragon' GROUP BY 1
  HAVING count(*) BETWEEN 2 AND 64 AND count(DISTINCT coalesce(generator, 'nan')) > 1) g ON s.prompt_group = g.prompt_group WHERE s.row_idx > g.a AND lower(s.dataset) = 'dragon'"""
_L = "CAST('0x' || {0} AS UBIGINT)"
_MAE = "list_sum(list_transform(range(0, 64), lambda i: abs(CAST('0x' || substr(a.thumb8_hex, 2 * i::INT + 1, 2) AS INT) - CAST('0x' || substr(b.thumb8_hex, 2 * i::INT + 1, 2) AS INT)))) / 64.0"
_CLASSES = """ok AS (SELECT row_idx, lower(trim(phash64)) AS phash64, lower(trim(dhash64)) AS dhash64, lower(trim(thumb8_hex)) AS thumb8_hex, width, height, label FROM scan_index
  WHERE read_ok = 1 AND regexp_full_match(trim(phash64), '[0-9a-fA-F]{1,16}')),
members AS (SELECT row_idx, min(row_idx) OVER (PARTITION BY phash64, dhash64, thumb8_hex, width, height, label) AS rep FROM ok),
cl AS (SELECT * FROM ok WHERE row_idx IN (SELECT rep FROM members))"""
_NEAR = f"""{_CLASSES},
bands AS (SELECT row_idx, k, substr(phash64, 13 - 4 * k::INT, 4) AS v FROM cl, (SELECT unnest(range(4)) AS k)),
cand AS (SELECT DISTINCT a.row_idx AS x, b.row_idx AS y FROM bands a JOIN bands b ON a.k = b.k AND a.v = b.v AND a.row_idx < b.row_idx),
m AS (SELECT x, y, bit_count(xor({_L.replace('{0}', 'a.phash64')}, {_L.replace('{0}', 'b.phash64')})) AS ph, bit_count(xor({_L.replace('{0}', 'a.dhash64')}, {_L.replace('{0}', 'b.dhash64')})) AS dh, {_MAE} AS mae, a.label = b.label AS same
  FROM cand JOIN cl a ON a.row_idx = x JOIN cl b ON b.row_idx = y
  WHERE abs(ln(greatest(a.width, 1) / CAST(greatest(a.height, 1) AS DOUBLE)) - ln(greatest(b.width, 1) / CAST(greatest(b.height, 1) AS DOUBLE))) <= 0.12),
near AS (SELECT x AS src_idx, y AS dst_idx, CASE WHEN same AND (ph <= 8 OR dh <= 6) THEN 'near_hash' WHEN NOT same AND (ph <= 4 OR dh <= 2) THEN 'suspicious_cross_label_near' END AS reason,
  printf('ph=%d,dh=%d,mae=%.2f', ph, dh, mae) AS score, CASE WHEN same THEN 'dedup' ELSE 'suspicious' END AS stage FROM m WHERE mae <= 6.0)"""
_H = "regexp_full_match({0}, '[0-9a-f]{{1,16}}')"
_CAND = f"""bits AS (SELECT row_idx, {_L.replace('{0}', 'phash64')} AS p, CASE WHEN {_H.replace('{0}', 'dhash64').replace('{{', '{').replace('}}', '}')} THEN {_L.replace('{0}', 'dhash64')} END AS d FROM cl),
cand AS (SELECT a.row_idx AS x, b.row_idx AS y FROM bits a JOIN bits b ON a.row_idx < b.row_idx AND (bit_count(xor(a.p, b.p)) <= 8 OR bit_count(xor(a.d, b.d)) <= 6)),
"""
_NEAR_ALL = _NEAR[: _NEAR.index("bands AS")] + _CAND + _NEAR[_NEAR.index("m AS (SELECT x, y") :]
_EDGES = f"""{_NEAR},
edges AS ({_exact_sql()} UNION ALL SELECT * FROM near WHERE reason IS NOT NULL
  UNION ALL SELECT rep, row_idx, 'near_hash', 'ph=0,dh=0,mae=0.00', 'dedup' FROM members WHERE row_idx > rep UNION ALL {_PAIR} UNION ALL {_PROMPT})"""


def _components_sql(name: str, where: str, edges: str = "edges") -> str:
    """CTE name(row_idx, root): smallest row linked by the edges of those stages."""
    return f"""{name}_b AS (SELECT src_idx AS a, dst_idx AS b FROM {edges} WHERE {where} AND src_idx <> dst_idx UNION SELECT dst_idx, src_idx FROM {edges} WHERE {where} AND src_idx <> dst_idx),
{name}_r(v, m) AS (SELECT a, a FROM {name}_b UNION SELECT t.b, r.m FROM {name}_r r JOIN {name}_b t ON r.v = t.a),
{name}_m AS (SELECT v, min(m) AS root FROM {name}_r GROUP BY v),
{name} AS (SELECT s.row_idx, coalesce(root, s.row_idx) AS root FROM scan_index s LEFT JOIN {name}_m ON v = s.row_idx)"""


_APPLY = f"""d1 AS (SELECT s.row_idx, path, source, label, {HINT} AS hint, read_ok, d.root AS dedup_root, p.root AS split_root,
  row_number() OVER (PARTITION BY d.root ORDER BY CASE WHEN {HINT} = 'unseen' THEN 0 ELSE 1 END, coalesce(width, -1) DESC, coalesce(height, -1) DESC, coalesce(file_size_bytes, -1) DESC, path, s.row_idx) AS pick
  FROM scan_index s JOIN dedup d USING (row_idx) JOIN split p USING (row_idx)),
d2 AS (SELECT *, count(*) OVER (PARTITION BY dedup_root) AS n, CAST(min(label) OVER (PARTITION BY dedup_root) < max(label) OVER (PARTITION BY dedup_root) AS INT) AS conflict,
  CAST(min(hint) OVER (PARTITION BY dedup_root) < max(hint) OVER (PARTITION BY dedup_root) AS INT) AS crossed, max(path) FILTER (WHERE pick = 1) OVER (PARTITION BY dedup_root) AS canonical,
  count(*) OVER (PARTITION BY split_root) AS sn, dense_rank() OVER (ORDER BY dedup_root) - 1 AS di, dense_rank() OVER (ORDER BY split_root) - 1 AS si FROM d1),
applied AS (SELECT *, CASE WHEN conflict = 1 THEN 'label_conflict' WHEN coalesce(read_ok, 0) <> 1 THEN 'read_error' WHEN n > 1 AND pick > 1 THEN 'duplicate_noncanonical' ELSE '' END AS reason FROM d2)"""
_DEDUP, _SPLIT = "stage = 'dedup'", "stage IN ('dedup', 'split_lock')"
_ALL = f"WITH RECURSIVE {_EDGES}, {_components_sql('dedup', _DEDUP)}, {_components_sql('split', _SPLIT)}, {_APPLY}"
_EXACT_ALL = f"WITH RECURSIVE edges AS ({_exact_sql()}), {_components_sql('dedup', 'true')}, {_components_sql('split', 'true')}, {_APPLY}"
_SIGN = "sum(CASE WHEN e > 0 THEN CAST(1 AS HUGEINT) ELSE CAST(0 AS HUGEINT) END << (i - 1)::INT)"
_COS = f"""v AS (SELECT vec_id, CAST(label AS VARCHAR) AS source, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, source, e, sqrt(list_dot_product(e, e)) AS n FROM v),
nb AS (SELECT a.source, a.vec_id AS row_a, b.vec_id AS row_b, list_dot_product(a.e, b.e) / (a.n * b.n) AS cosine FROM u a JOIN u b ON a.source = b.source AND a.vec_id <> b.vec_id WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= {_THRESHOLD})"""
_SEM = f"""WITH RECURSIVE {_COS},
r(v, m) AS (SELECT row_a, row_a FROM nb UNION SELECT nb.row_b, r.m FROM r JOIN nb ON r.v = nb.row_a)"""
SQL = {
    "q_exact_edges": _exact_sql(),
    "q_pair_lock": _PAIR,
    "q_prompt_lock": _PROMPT,
    "q_near_edges": f"WITH {_NEAR} SELECT * FROM near WHERE reason IS NOT NULL",
    "q_near_edges_all": f"WITH {_NEAR_ALL} SELECT * FROM near WHERE reason IS NOT NULL",
    "q_near_members": f"WITH {_CLASSES} SELECT * FROM members",
    "q_lsh_candidates": f"""WITH b AS (SELECT vec_id, {_SIGN} AS s FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1),
c AS (SELECT min(vec_id) AS vec_id, s FROM b GROUP BY s), k AS (SELECT vec_id, j, (s >> (8 * j)::INT) & 255 AS v FROM c, (SELECT unnest(range(8)) AS j)),
f AS (SELECT *, count(*) OVER (PARTITION BY j, v) AS n FROM k) SELECT DISTINCT x.vec_id AS a, y.vec_id AS b FROM f x JOIN f y ON x.j = y.j AND x.v = y.v AND x.vec_id < y.vec_id WHERE x.n <= 6""",
    "q_edge_distances": f"""WITH e AS (SELECT DISTINCT src_idx, dst_idx FROM edge WHERE src_idx IS NOT NULL AND dst_idx IS NOT NULL)
SELECT src_idx, dst_idx, coalesce(bit_count(xor({_L.replace('{0}', "nullif(trim(a.phash64), '')")}, {_L.replace('{0}', "nullif(trim(b.phash64), '')")})), 1073741824)::BIGINT AS phash,
coalesce(bit_count(xor({_L.replace('{0}', "nullif(trim(a.dhash64), '')")}, {_L.replace('{0}', "nullif(trim(b.dhash64), '')")})), 1073741824)::BIGINT AS dhash,
round(CASE WHEN length(a.thumb8_hex) = 128 AND length(b.thumb8_hex) = 128 THEN {_MAE} ELSE -1 END, 6) AS difference,
round(abs(ln(greatest(coalesce(a.width, 0), 1) / CAST(greatest(coalesce(a.height, 0), 1) AS DOUBLE)) - ln(greatest(coalesce(b.width, 0), 1) / CAST(greatest(coalesce(b.height, 0), 1) AS DOUBLE))), 6) AS aspect
FROM e JOIN scan_index a ON a.row_idx = src_idx JOIN scan_index b ON b.row_idx = dst_idx""",
    "q_apply_edges": _ALL + """ SELECT row_idx, path, dedup_root, split_root, CAST(n AS INT) AS dedup_component_size, conflict AS has_label_conflict, crossed AS cross_split_duplicate, canonical AS canonical_path,
printf('dedup_%08d', di) AS dedup_component_id, CAST(sn AS INT) AS split_component_size, printf('split_%08d', si) AS split_component_id, CAST(pick = 1 AS INT) AS is_canonical, reason AS dedup_drop_reason, CAST(reason = '' AS INT) AS keep_after_dedup FROM applied""",
    "q_edge_counts": f"WITH {_EDGES} SELECT stage, reason, count(*) AS edges FROM edges GROUP BY ALL",
    "q_edge_table": """SELECT e.*, a.path AS src_path, a.source AS src_source, a.label AS src_label, c.dedup_component_id AS src_dedup_component_id, c.split_component_id AS src_split_component_id,
b.path AS dst_path, b.source AS dst_source, b.label AS dst_label, d.dedup_component_id AS dst_dedup_component_id, d.split_component_id AS dst_split_component_id
FROM edge e JOIN scan_index a ON a.row_idx = src_idx JOIN scan_index b ON b.row_idx = dst_idx LEFT JOIN components c ON c.row_idx = src_idx LEFT JOIN components d ON d.row_idx = dst_idx""",
    "q_components": f"WITH RECURSIVE edges AS (SELECT src_idx, dst_idx FROM edge WHERE stage = 'dedup' AND src_idx IS NOT NULL AND dst_idx IS NOT NULL), {_components_sql('d', 'true')} SELECT row_idx, root AS component FROM d",
    "q_exact_components": _EXACT_ALL + " SELECT source, reason AS dedup_drop_reason, count(*) AS rows, count(DISTINCT dedup_root) AS components FROM applied GROUP BY ALL",
    "q_stage_report": _ALL + """ SELECT source, count(*) AS raw_rows, count(*) FILTER (WHERE reason = '') AS clean_rows, round((count(*) - count(*) FILTER (WHERE reason = '')) / CAST(count(*) AS DOUBLE), 9) AS removed_ratio
FROM applied WHERE source IS NOT NULL GROUP BY 1""",
    "q_cosine_neighbours": f"WITH {_COS} SELECT source, row_a, row_b, round(cosine, 6) AS cosine FROM nb",
    "q_semantic_edges": f"WITH {_COS}, k AS (SELECT *, row_number() OVER (PARTITION BY row_a ORDER BY cosine DESC, row_b) AS rank FROM nb) SELECT source, row_a, row_b, round(cosine, 6) AS cosine FROM k WHERE rank <= 3 AND row_a < row_b",
    "q_semantic_prune": _SEM + """, c AS (SELECT v, min(m) AS root FROM r GROUP BY v),
p AS (SELECT u.vec_id, source, coalesce(root, u.vec_id) AS root FROM u LEFT JOIN c ON v = u.vec_id),
q AS (SELECT *, count(*) OVER (PARTITION BY source, root) AS n, dense_rank() OVER (PARTITION BY source ORDER BY root) - 1 AS i,
  row_number() OVER (PARTITION BY source, root ORDER BY (vec_id % 7) * (vec_id % 5) DESC, vec_id) AS k FROM p)
SELECT vec_id, printf('sem:%s:%07d', source, i) AS semantic_component_id, n AS semantic_component_size, CAST(k <= CASE WHEN n <= 4 THEN 1 WHEN n <= 16 THEN 2 ELSE 3 END AS INT) AS keep_stage2_semantic,
CAST(k > CASE WHEN n <= 4 THEN 1 WHEN n <= 16 THEN 2 ELSE 3 END AS INT) AS drop_stage2_semantic FROM q""",
    "q_tight_units": f"""WITH RECURSIVE {_COS}, t AS (SELECT DISTINCT printf('base_%04d', row_a // 3) AS a, printf('base_%04d', row_b // 3) AS b FROM nb),
r(v, m) AS (SELECT a, a FROM t UNION SELECT t.b, r.m FROM r JOIN t ON r.v = t.a),
n AS (SELECT DISTINCT printf('base_%04d', vec_id // 3) AS base FROM embeddings)
SELECT base, coalesce((SELECT min(m) FROM r WHERE v = base), base) AS tight_root FROM n""",
    "q_tiers": """SELECT source, count(*) AS rows, CASE WHEN count(*) >= 1000 THEN CAST(0.992 AS DOUBLE) WHEN count(*) >= 300 THEN 0.9935 ELSE 0.995 END AS cosine_threshold,
CASE WHEN count(*) >= 1000 THEN 64 WHEN count(*) >= 300 THEN 48 ELSE 32 END AS topk, CASE WHEN count(*) <= 4 THEN 1 WHEN count(*) <= 16 THEN 2 ELSE 3 END AS budget FROM scan_index WHERE source IS NOT NULL GROUP BY 1""",
    "q_focus_sources": """SELECT source FROM scan_index WHERE source IS NOT NULL GROUP BY 1
HAVING source = 'real_scans' OR (count(*) FILTER (WHERE read_ok = 1) >= 50 AND (count(*) - count(*) FILTER (WHERE read_ok = 1)) / CAST(count(*) AS DOUBLE) <= 0.02)""",
}
