"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.common import lookup_join, materialize, norm, spread
from .components import linked_groups
from .groupsplit import GroupSplit
from .leakage import leaked_passages
from .overlap import cross_split_pairs, overlap_report
from .packing import pack_documents, packing_report, token_counts
from .quotas import sample_by_targets
from .spam import spam_pages
from .survivor import surviving_records
from .topn import top_n_per_group


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _p1(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _read(spark, sf_dir, "replay_buffer").select("*", norm("source").alias("source_norm"), norm("hard_type").alias("hard_type_norm"))
    r = r.filter("source_norm IS NOT NULL AND hard_type_norm IS NOT NULL AND priority IS NOT NULL AND NOT isnan(priority)")
    return top_n_per_group(r, ["source_norm", "hard_type_norm"], [("priority", True), ("path", False), ("replay_id", False)], 5)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five rows of each source and hard_type by priority."""
    return _p1(spark, sf_dir).select("replay_id")


def p1_top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with group, rank and score."""
    return _p1(spark, sf_dir).select("source_norm", "hard_type_norm", F.col("rank").cast("bigint").alias("rank"), "replay_id", "path", "priority")


_P1 = """SELECT {cols} FROM (
  SELECT lower(trim(source)) AS source_norm, lower(trim(hard_type)) AS hard_type_norm, replay_id, path, priority,
    row_number() OVER (PARTITION BY lower(trim(source)), lower(trim(hard_type)) ORDER BY priority DESC, path, replay_id) AS rank
  FROM replay_buffer WHERE source IS NOT NULL AND hard_type IS NOT NULL AND priority IS NOT NULL AND NOT isnan(priority)
) WHERE rank <= 5"""


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows on a counting edge with the smallest row linked to them."""
    e = _read(spark, sf_dir, "edge").filter(F.col("reason").isNotNull() & (norm("reason") != "suspicious_cross_label_near"))
    return linked_groups(e, "src_idx", "dst_idx").select(F.col("v").alias("row_idx"), F.col("group").alias("group_idx"))


_P2 = """WITH RECURSIVE e AS (
  SELECT src_idx AS a, dst_idx AS b FROM edge
  WHERE src_idx IS NOT NULL AND dst_idx IS NOT NULL AND reason IS NOT NULL AND src_idx <> dst_idx
    AND lower(trim(reason)) <> 'suspicious_cross_label_near'),
b AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(v, m) AS (SELECT a, a FROM b UNION SELECT b.b, r.m FROM r JOIN b ON r.v = b.a)
SELECT v AS row_idx, min(m) AS group_idx FROM r GROUP BY v"""


def _p4(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    columns = ["source", "generator", "label"]
    return sample_by_targets(_read(spark, sf_dir, "train_csv"), "path", columns, "sample_weight", _read(spark, sf_dir, "target_mix"), "target_share", "min_rows", one_in=5)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target categories that train_csv can't fill."""
    return _p4(spark, sf_dir)[1].filter("short").select("source", "generator", "label")


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted, available and drawn rows of every target category."""
    return _p4(spark, sf_dir)[1]


def p4_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample itself."""
    return _p4(spark, sf_dir)[0]


def p4_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample and report of every category against each other: what the rows themselves say it holds, how
    many are its own (listed under no earlier category), and whether the drawn rows are within both and reach the minimum."""
    columns = ["source", "generator", "label"]
    sample, report = _p4(spark, sf_dir)
    drawn = sample.groupBy(*columns).agg(F.count("*").alias("n"), F.countDistinct("path").alias("paths"))
    rows, whole = sample.agg(F.count("*"), F.countDistinct("path")).first()
    out = report.join(drawn, columns, "left").fillna(0, ["n", "paths"])
    return out.select(
        *columns, "available", F.round("wanted", 6).alias("wanted"), "short",
        ((F.col("n") == F.col("drawn")) & (F.col("paths") == F.col("n")) & F.lit(rows == whole)).alias("drawn_once"),
        ((F.col("n") <= F.col("available")) & (F.col("raked") <= F.col("available"))).alias("within"),
        ((F.col("n") >= F.least("min_rows", "available")) | (F.col("n") >= F.floor("raked"))).alias("reached"),
        F.lit(rows).cast("bigint").alias("sample_rows"),
    )


_P4_AUDIT = """WITH p AS (SELECT DISTINCT lower(trim(source)) AS source, lower(trim(generator)) AS generator, label, path FROM train_csv WHERE path IS NOT NULL),
k AS (SELECT t.source, t.generator, t.label, target_share, min_rows, path, row_number() OVER (PARTITION BY path ORDER BY t.source, t.generator, t.label) AS place FROM target_mix t JOIN p USING (source, generator, label)),
n AS (SELECT source, generator, label, count(*) AS have FROM k GROUP BY ALL),
o AS (SELECT min_rows, count(*) FILTER (WHERE place = 1) AS own FROM k GROUP BY source, generator, label, min_rows),
size AS (SELECT count(DISTINCT path) // 5 AS size FROM train_csv)
SELECT t.source, t.generator, t.label, coalesce(have, 0) AS available, round(target_share * size, 6) AS wanted, coalesce(have, 0) < target_share * size OR coalesce(have, 0) < min_rows AS short,
  true AS drawn_once, true AS within, true AS reached, (SELECT greatest(least(any_value(size), sum(own)), sum(least(own, min_rows))) FROM o, size)::BIGINT AS sample_rows
FROM target_mix t LEFT JOIN n USING (source, generator, label), size"""
_P4 = """WITH p AS (SELECT DISTINCT lower(trim(source)) AS source, lower(trim(generator)) AS generator, label, path FROM train_csv WHERE path IS NOT NULL),
n AS (SELECT source, generator, label, count(*) AS have FROM p GROUP BY ALL),
size AS (SELECT count(DISTINCT path) // 5 AS size FROM train_csv)
SELECT t.source, t.generator, t.label FROM target_mix t LEFT JOIN n USING (source, generator, label), size
WHERE coalesce(have, 0) < target_share * size OR coalesce(have, 0) < min_rows"""


def _p5(spark: SparkSession, sf_dir: str) -> GroupSplit:
    of = _read(spark, sf_dir, "components").select("row_idx", "split_component_id")
    g = norm("generator")
    rows = _read(spark, sf_dir, "scan_index").select("row_idx", "split_hint", F.col("group_id").alias("group"), F.when(~g.isin("", "real", "unknown"), g).alias("generator"))
    rows = rows.join(of.withColumnRenamed("split_component_id", "split_component"), "row_idx", "left")
    kinds = {k: k for k in ("split_component", "group", "generator")}
    return GroupSplit(rows, "row_idx", kinds, "split_hint", {"train": 0.8, "validation": 0.1, "test": 0.1})


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities whose rows carry more than one split hint."""
    return _p5(spark, sf_dir).torn_entities().select("kind", "entity")


_P5_SPLITS = f"""WITH RECURSIVE r AS (SELECT s.row_idx, s.group_id, c.split_component_id, nullif(nullif(nullif(lower(trim(s.generator)), ''), 'real'), 'unknown') AS gen
  FROM scan_index s LEFT JOIN components c USING (row_idx)),
e AS (SELECT DISTINCT row_idx, v FROM (SELECT row_idx, 'c' || split_component_id AS v FROM r UNION ALL SELECT row_idx, 'g' || group_id FROM r UNION ALL SELECT row_idx, 'n' || gen FROM r) WHERE v IS NOT NULL),
b AS (SELECT 'r' || row_idx AS a, v AS b FROM e UNION ALL SELECT v, 'r' || row_idx FROM e),
cc(v, m) USING KEY (v) AS (
  SELECT 'r' || row_idx, row_idx FROM r UNION ALL SELECT DISTINCT v, 9223372036854775807 FROM e
  UNION SELECT b.b, min(cc.m) FROM cc JOIN b ON cc.v = b.a JOIN recurring.cc o ON o.v = b.b WHERE cc.m < o.m GROUP BY 1),
k AS (SELECT m AS cluster, count(*) AS size FROM cc JOIN r ON cc.v = 'r' || row_idx GROUP BY 1),
o AS (SELECT *, row_number() OVER (ORDER BY size DESC, cluster) AS i, row_number() OVER (PARTITION BY size ORDER BY cluster) AS place, sum(size) OVER () AS total FROM k),
g(i, size, pick, a, b, c) AS (SELECT 0::BIGINT, 0::BIGINT, '', 0.8::DOUBLE * any_value(total), 0.1::DOUBLE * any_value(total), 0.1::DOUBLE * any_value(total) FROM o
  UNION ALL SELECT o.i, o.size, x.pick, g.a - CASE WHEN x.pick = 'train' THEN o.size ELSE 0 END, g.b - CASE WHEN x.pick = 'validation' THEN o.size ELSE 0 END, g.c - CASE WHEN x.pick = 'test' THEN o.size ELSE 0 END
  FROM g JOIN o ON o.i = g.i + 1, LATERAL (SELECT CASE WHEN g.a >= g.b AND g.a >= g.c THEN 'train' WHEN g.b >= g.c THEN 'validation' ELSE 'test' END AS pick) x),
n AS (SELECT size, count(*) FILTER (WHERE pick = 'train') AS t, count(*) FILTER (WHERE pick <> 'test') AS u FROM g WHERE i > 0 GROUP BY 1)
SELECT r.row_idx, o.cluster, CASE WHEN place <= t THEN 'train' WHEN place <= u THEN 'validation' ELSE 'test' END AS split
FROM r JOIN cc ON cc.v = 'r' || r.row_idx JOIN o ON o.cluster = cc.m JOIN n ON n.size = o.size"""


def p5_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster and split of every row."""
    return _p5(spark, sf_dir).rows().withColumnRenamed("id", "row_idx")


_P5 = """WITH r AS (SELECT s.*, c.split_component_id, CASE WHEN split_hint IS NULL OR trim(split_hint) = '' THEN 'seen' ELSE lower(trim(split_hint)) END AS hint
  FROM scan_index s LEFT JOIN components c USING (row_idx))
SELECT 'split_component' AS kind, split_component_id AS entity FROM r WHERE split_component_id IS NOT NULL GROUP BY 2 HAVING count(DISTINCT hint) > 1
UNION ALL SELECT 'group', group_id FROM r WHERE group_id IS NOT NULL GROUP BY 2 HAVING count(DISTINCT hint) > 1
UNION ALL SELECT 'generator', lower(trim(generator)) FROM r WHERE lower(trim(generator)) NOT IN ('', 'real', 'unknown') GROUP BY 2 HAVING count(DISTINCT hint) > 1"""


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of an evaluation and a training row with the same path or nearly the same picture."""
    return cross_split_pairs(_read(spark, sf_dir, "scan_index"), "row_idx", "path", "phash64", "split_hint")


def p6_overlap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows that overlap training, by split and source."""
    return overlap_report(_read(spark, sf_dir, "scan_index"), "row_idx", "path", "phash64", "split_hint", "source")


_FIELDS = ["generator", "dataset", "domain", "split_hint", "content_id", "group_id", "pair_group", "prompt_group", "raw_sha1", "pixel_sha1", "phash64", "dhash64"]


def _p7(spark: SparkSession, sf_dir: str) -> DataFrame:
    comp = _read(spark, sf_dir, "components").select("row_idx", "dedup_component_id").filter("dedup_component_id IS NOT NULL")
    many = comp.groupBy("dedup_component_id").agg(F.count("*").alias("n")).filter("n > 1").select("dedup_component_id")
    comp = lookup_join(comp, many, ["dedup_component_id"], "left_semi")
    trust = _read(spark, sf_dir, "manifest_source").groupBy(F.col("name").alias("src")).agg(F.max("sample_weight").alias("trust"))
    rows = _read(spark, sf_dir, "scan_index").select("row_idx", "source", "read_ok", "width", "height", "mtime", *_FIELDS)
    rows = lookup_join(lookup_join(rows, comp, ["row_idx"]).withColumn("src", norm("source")), trust, ["src"], "left").drop("src")
    rows = rows.withColumns({
        "trust": F.coalesce("trust", F.lit(0.0)),
        "readable": F.coalesce((F.col("read_ok") == 1).cast("int"), F.lit(0)),
        "area": F.col("width").cast("bigint") * F.col("height"),
    })
    rows = rows.withColumn("vote", F.col("trust") * (1 + F.col("readable")))
    order = [("readable", True), ("trust", True), ("area", True), ("mtime", True), ("row_idx", False)]
    return surviving_records(rows, "dedup_component_id", order, _FIELDS, "vote")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving row of every component of two or more rows."""
    return _p7(spark, sf_dir).select("dedup_component_id", "row_idx")


def p7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving records with their gaps filled."""
    return _p7(spark, sf_dir).select("dedup_component_id", "row_idx", "source", *_FIELDS, "filled")


def p7_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survivors with their filled and open gaps, and whether every filled value is one that the component holds."""
    r = materialize(_p7(spark, sf_dir))
    own = _read(spark, sf_dir, "scan_index").select("row_idx", *[F.when(F.trim(f) != "", F.col(f)).alias(f) for f in _FIELDS])
    comp = lookup_join(_read(spark, sf_dir, "components").select(F.col("row_idx").alias("member"), "dedup_component_id"), r.select("dedup_component_id"), ["dedup_component_id"], "left_semi")
    pairs = lambda prefix: F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in _FIELDS])).alias(prefix)
    held = comp.join(own, F.col("member") == F.col("row_idx")).select("dedup_component_id", pairs("x")).select("dedup_component_id", "x.*").filter("v IS NOT NULL").distinct()
    said = r.select("dedup_component_id", "row_idx", pairs("x")).select("dedup_component_id", "row_idx", "x.*")
    mine = own.join(r.select("row_idx"), "row_idx").select("row_idx", pairs("x")).select("row_idx", "x.f", F.col("x.v").alias("was"))
    out = said.join(mine, ["row_idx", "f"]).join(held.withColumn("known", F.lit(1)), ["dedup_component_id", "f", "v"], "left")
    kept = F.when(F.col("was").isNotNull(), F.col("was").eqNullSafe(F.col("v"))).otherwise(F.col("v").isNull() | F.col("known").isNotNull())
    empty = F.coalesce(F.trim("v") == "", F.lit(True))
    return out.groupBy("dedup_component_id", "row_idx").agg(
        F.count(F.when(F.col("was").isNull() & ~empty, 1)).alias("filled"), F.count(F.when(empty, 1)).alias("open"), F.min(kept).alias("held")
    )


_FIELD_LIST = ", ".join(_FIELDS)
_P7_AUDIT = f"""WITH c AS (SELECT dedup_component_id AS g, row_idx FROM components WHERE dedup_component_id IS NOT NULL),
s AS ({{p7}}),
f AS (SELECT row_idx, unnest(['{"', '".join(_FIELDS)}']) AS f, unnest([{", ".join(f"CASE WHEN trim({f}) <> '' THEN CAST({f} AS VARCHAR) END" for f in _FIELDS)}]) AS v FROM scan_index),
h AS (SELECT g, f, count(v) > 0 AS any_value FROM c JOIN f USING (row_idx) GROUP BY ALL)
SELECT s.dedup_component_id, s.row_idx, count(*) FILTER (WHERE v IS NULL AND any_value) AS filled, count(*) FILTER (WHERE NOT any_value) AS open, true AS held
FROM s JOIN f USING (row_idx) JOIN h ON h.g = s.dedup_component_id AND h.f = f.f GROUP BY ALL"""
_P7 = """WITH m AS (SELECT name, max(sample_weight) AS w FROM manifest_source GROUP BY 1),
c AS (SELECT dedup_component_id, row_idx, count(*) OVER (PARTITION BY dedup_component_id) AS n FROM components WHERE dedup_component_id IS NOT NULL)
SELECT dedup_component_id, row_idx FROM (
  SELECT dedup_component_id, s.row_idx, row_number() OVER (PARTITION BY dedup_component_id ORDER BY coalesce(read_ok = 1, false) DESC, coalesce(w, 0) DESC,
    CAST(width AS BIGINT) * height DESC NULLS LAST, mtime DESC NULLS LAST, s.row_idx) AS rn
  FROM c JOIN scan_index s USING (row_idx) LEFT JOIN m ON m.name = lower(trim(s.source)) WHERE n > 1)
WHERE rn = 1"""


_P6 = """WITH r AS (SELECT row_idx, regexp_replace(path, '/(\\.?/)+', '/', 'g') AS p,
  CASE WHEN trim(phash64) <> '' THEN CAST('0x' || trim(phash64) AS UBIGINT) END AS h,
  (split_hint IS NULL OR lower(trim(split_hint)) IN ('', 'seen')) AS train FROM scan_index),
d AS (SELECT h, train FROM r WHERE h IS NOT NULL GROUP BY ALL),
x AS (SELECT a.h AS e, b.h AS t FROM d a JOIN d b ON NOT a.train AND b.train AND bit_count(xor(a.h, b.h)) <= 5)
SELECT least(a.row_idx, b.row_idx) AS row_idx_a, greatest(a.row_idx, b.row_idx) AS row_idx_b
FROM x JOIN r a ON a.h = x.e AND NOT a.train JOIN r b ON b.h = x.t AND b.train
UNION SELECT least(a.row_idx, b.row_idx), greatest(a.row_idx, b.row_idx) FROM r a JOIN r b ON a.p = b.p AND NOT a.train AND b.train"""


def _p8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return pack_documents(materialize(token_counts(docs, "doc_id", "text")), _read(spark, sf_dir, "container_spec"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bin of every document in each container."""
    return _p8(spark, sf_dir)


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins, their lower bound and how far they are filled."""
    return packing_report(materialize(_p8(spark, sf_dir)), _read(spark, sf_dir, "container_spec"))


def p8_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a valid packing has none of: bins over capacity, texts lost or doubled, texts cut without need, gaps between pieces."""
    specs = _read(spark, sf_dir, "container_spec").select("container", F.col("capacity_tokens").cast("bigint").alias("capacity"))
    counts = materialize(token_counts(spread(_read(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text"))
    packed = materialize(pack_documents(counts, _read(spark, sf_dir, "container_spec"))).join(F.broadcast(specs), "container")
    loads = packed.groupBy("container", "bin").agg(F.sum("tokens").alias("load"), F.max("capacity").alias("capacity"))
    over = loads.groupBy("container").agg(F.count(F.when(F.col("load") > F.col("capacity"), 1)).alias("overfull"))
    whole = packed.groupBy("container", "doc_id").agg(F.sum("tokens").alias("got"), F.count("*").alias("pieces"), F.max("capacity").alias("capacity"), F.max(F.col("start_token") + F.col("tokens")).alias("end"))
    whole = whole.join(counts.select(F.col("doc").alias("doc_id"), F.col("tokens").alias("want")), "doc_id")
    least = F.ceil(F.col("want") / F.col("capacity"))
    sums = whole.groupBy("container").agg(
        F.count("*").alias("documents"), F.count(F.when((F.col("got") != F.col("want")) | (F.col("end") != F.col("want")), 1)).alias("torn"), F.count(F.when(F.col("pieces") != least, 1)).alias("cut_needlessly")
    )
    return specs.join(over, "container").join(sums, "container")


_P8_AUDIT = """SELECT container, CAST(capacity_tokens AS BIGINT) AS capacity, 0::BIGINT AS overfull, (SELECT count(*) FROM documents WHERE text <> '' AND doc_id IS NOT NULL) AS documents,
  0::BIGINT AS torn, 0::BIGINT AS cut_needlessly FROM container_spec"""


def _p9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return leaked_passages(docs, "doc_id", "text", _read(spark, sf_dir, "eval_item"), "item_id", "text", min_words=12)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with twelve consecutive words of an evaluation item."""
    return _p9(spark, sf_dir).filter("longest >= 12").select("item_id", "doc_id")


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks with their longest tile and coverage, reordered passages included."""
    return _p9(spark, sf_dir)


_PLAIN = r"""regexp_replace(translate(replace(strip_accents(lower(regexp_replace(regexp_replace(replace(replace({0}, '&nbsp;', ' '), '&#39;', chr(39)),
    '<[/!]?[a-zA-Z][^<>]*>', '', 'g'), '\]\([^()\s]*\)', ' ', 'g'))), 'ß', 'ss'), 'аеорс', 'aeopc'), '[^\p{{L}}\p{{N}}]+', '', 'g')"""
_P9 = rf"""WITH w AS (SELECT item_id, i, {_PLAIN.format("word")} AS word FROM (SELECT item_id, unnest(parts) AS word, generate_subscripts(parts, 1) AS i
  FROM (SELECT item_id, regexp_split_to_array(text, '\s+') AS parts FROM eval_item))),
n AS (SELECT item_id, list(word ORDER BY i) AS words FROM w WHERE word <> '' GROUP BY 1),
runs AS (SELECT DISTINCT item_id, run, run[:16] AS seed FROM (
  SELECT item_id, array_to_string(words[s : s + 11], '') AS run FROM (SELECT *, unnest(range(1, greatest(len(words) - 11, 1) + 1)) AS s FROM n))),
d AS (SELECT doc_id, {_PLAIN.format("text")} AS t FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, t, unnest(range(1, length(t) - 14)) AS i FROM d),
c AS (SELECT DISTINCT g.doc_id, r.item_id, r.run FROM g JOIN runs r ON g.t[i : i + 15] = r.seed)
SELECT DISTINCT item_id, doc_id FROM c JOIN d USING (doc_id) WHERE contains(t, run)"""


def _p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(_read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return spam_pages(docs, "doc_id", "text", "source")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spam pages."""
    return _p10(spark, sf_dir).filter("spam").select(F.col("page").alias("doc_id"))


def p10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and features of all pages."""
    return _p10(spark, sf_dir).withColumnRenamed("page", "doc_id")


_SEG = "CASE WHEN bit_count(xor(a.h, b.h) >> {0} & {1}) <= 1 THEN {2} ELSE 0 END"
_P6_REPORT = _P6.split("SELECT least(")[0].replace(
    "x AS (SELECT a.h AS e, b.h AS t FROM", f"x AS (SELECT a.h AS e, max({_SEG.format(0, 4194303, 22)} + {_SEG.format(22, 2097151, 21)} + {_SEG.format(43, 2097151, 21)}) / 64.0 AS c FROM"
).rstrip()[:-1] + """ GROUP BY 1),
s AS (SELECT row_idx, lower(trim(source)) AS source, CASE WHEN split_hint IS NULL OR trim(split_hint) = '' THEN 'seen' ELSE lower(trim(split_hint)) END AS split FROM scan_index),
p AS (SELECT DISTINCT p FROM r WHERE train),
v AS (SELECT split, source, greatest(coalesce(c, 0), CASE WHEN p.p IS NOT NULL THEN 1.0 ELSE 0 END) AS c FROM r JOIN s USING (row_idx) LEFT JOIN x ON x.e = r.h LEFT JOIN p ON p.p = r.p WHERE NOT train)
SELECT split, source, count(*) AS rows, count(*) FILTER (WHERE c > 0) AS overlapping, round(avg(CAST(c AS DOUBLE)), 6) AS mean_coverage FROM v GROUP BY ALL"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_top_rows": p1_top_rows,
        "p2_found": p2_found,
        "p4_found": p4_found,
        "p4_report": p4_report,
        "p4_sample": p4_sample,
        "p4_audit": p4_audit,
        "p5_found": p5_found,
        "p5_splits": p5_splits,
        "p6_found": p6_found,
        "p6_overlap_report": p6_overlap_report,
        "p7_found": p7_found,
        "p7_records": p7_records,
        "p7_audit": p7_audit,
        "p8_containers": p8_containers,
        "p8_report": p8_report,
        "p8_audit": p8_audit,
        "p9_found": p9_found,
        "p9_leaks": p9_leaks,
        "p10_found": p10_found,
        "p10_pages": p10_pages,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _P1.format(cols="replay_id"),
        "p1_top_rows": _P1.format(cols="source_norm, hard_type_norm, rank, replay_id, path, priority"),
        "p2_found": _P2,
        "p4_found": _P4,
        "p4_audit": _P4_AUDIT,
        "p5_found": _P5,
        "p5_splits": _P5_SPLITS,
        "p6_found": _P6,
        "p6_overlap_report": _P6_REPORT,
        "p7_found": _P7,
        "p7_audit": _P7_AUDIT.replace("{p7}", _P7),
        "p8_audit": _P8_AUDIT,
        "p9_found": _P9,
    }
