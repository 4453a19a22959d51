"""The pipeline's commands: each reads tables, runs operators and writes tables and a YAML report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import first_present
from .operators import dedup as D
from .operators import metrics as M
from .operators import mining as N
from .operators import semantic as X
from .operators import splits as P
from .operators import summary as S
from .operators.common import materialize
from .sources.images import hash_files, named_decoder
from .sources.manifest import load_yaml, save_yaml, scan_manifest, with_row_index
from .sources.tables import read_samples, upsert_table, write_samples

#: Neighbour tiers by rows of a source. Fixed values.
TIERS = (
    {"min_rows": 300_000, "cosine_threshold": 0.9920, "topk": 64},
    {"min_rows": 100_000, "cosine_threshold": 0.9935, "topk": 48},
    {"min_rows": 50_000, "cosine_threshold": 0.9950, "topk": 32},
)


def _load(spark: SparkSession, path: str) -> DataFrame:
    return read_samples(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def _counts(df: DataFrame, columns: Sequence[str]) -> dict:
    """Nested counts for a report; the columns' values are names, not records."""
    out: dict = {c: {} for c in columns}
    for r in S.value_counts(df, columns).orderBy("column", F.desc("rows"), "value").collect():
        out[r["column"]][r["value"]] = r["rows"]
    return out


def _summaries(splits: dict[str, DataFrame]) -> dict:
    by = ["label", "source", "generator", "dataset"]
    return {k: {"rows": v.count(), **{f"by_{c}": n for c, n in _counts(v, by).items()}} for k, v in splits.items()}


def _write_splits(splits: dict[str, DataFrame], out_dir: str, report: dict) -> dict:
    for name, df in splits.items():
        write_samples(df, f"{out_dir}/{name}")
    report["splits"] = _summaries(splits)
    save_yaml(report, f"{out_dir}/split_summary.yaml")
    return report


@dataclass
class Scan:
    """Manifest to canonical index."""

    manifest: str
    output: str
    strict: bool = False

    def run(self, spark: SparkSession) -> dict:
        index = materialize(scan_manifest(spark, load_yaml(self.manifest), self.strict))
        write_samples(index, self.output)
        report = {"rows": index.count(), **_counts(index, ["label", "source", "dataset", "split_hint"])}
        save_yaml(report, f"{self.output}.summary.yaml")
        return report


@dataclass
class Dedup:
    """Manifest and picture bytes to hashed index, edges, components and clean index.

    decoder: ``module:function`` from bytes to an RGB array for files that are neither PNG nor decoded
    by the JVM, such as WebP. The report counts the files left unread by their ending. every_pair: near
    duplicates need share no band of their hash; without it the reference's bands decide.
    """

    manifest: str
    out_dir: str
    strict: bool = False
    phash_bits: int = 8
    dhash_bits: int = 6
    max_difference: float = 6.0
    aspect: float = 0.12
    cross_label: bool = False
    report_bits: int = 4
    band_bits: int = 16
    lock_size: int = 64
    flat_threshold: int = 3
    hash_buckets: int = 128
    pair_family: str | None = None
    prompt_family: str | None = None
    decoder: str | None = None
    every_pair: bool = True

    def run(self, spark: SparkSession) -> dict:
        manifest = load_yaml(self.manifest)
        index = D.rebucket_flat(scan_manifest(spark, manifest, self.strict, self.pair_family, self.prompt_family), threshold=self.flat_threshold, buckets=self.hash_buckets)
        index = materialize(with_row_index(index))
        roots = [s["path"] for s in manifest["sources"]]
        contents = None
        for root in dict.fromkeys(r.rstrip("/") for r in roots):
            own = index.filter(F.col("source_root") == root).select("path")
            if not own.isEmpty():
                part = hash_files(own, root, named_decoder(self.decoder) if self.decoder else None)
                contents = part if contents is None else contents.unionByName(part)
        index = materialize(index.join(contents, "path", "left"))
        index.write.mode("overwrite").parquet(f"{self.out_dir}/scan_index")
        near, members = D.near_edges(index, "row_idx", self.phash_bits, self.dhash_bits, self.max_difference, self.aspect, self.cross_label, self.report_bits, None if self.every_pair else self.band_bits)
        edges = D.exact_edges(index, "row_idx", {"raw_sha1": "exact_bytes", "pixel_sha1": "exact_pixels"}).unionByName(near).unionByName(D.member_edges(members)).unionByName(D.pair_lock_edges(index, "row_idx"))
        if self.prompt_family:
            edges = edges.unionByName(D.prompt_lock_edges(index, "row_idx", self.prompt_family, self.lock_size))
        edges = materialize(edges)
        parts = materialize(D.apply_edges(index, edges))
        clean = parts.filter("keep_after_dedup = 1")
        D.edge_table(edges, parts).write.mode("overwrite").parquet(f"{self.out_dir}/dedup_pairs")
        parts.write.mode("overwrite").parquet(f"{self.out_dir}/components")
        clean.write.mode("overwrite").parquet(f"{self.out_dir}/clean_index")
        report = {
            "summary": {
                "rows": parts.count(),
                "clean_rows": clean.count(),
                "raw_by_source": _counts(parts, ["source"])["source"],
                "clean_by_source": _counts(clean, ["source"])["source"],
                "drop_reasons": _counts(parts, ["dedup_drop_reason"])["dedup_drop_reason"],
                "unread_by_ending": _counts(parts.filter("coalesce(read_ok, 0) <> 1").select(F.lower(F.substring_index("path", ".", -1)).alias("ending")), ["ending"])["ending"],
            },
            "edges": {f"{r['stage']}::{r['reason']}": r["edges"] for r in D.edge_counts(edges).collect()},
        }
        save_yaml(report, f"{self.out_dir}/report.yaml")
        return report


@dataclass
class Semantic:
    """Clean index, its report and vectors (path, vector) to pruned index with tight units.

    recall: the probability with which a pair at the cosine threshold is found; None finds every pair.
    """

    clean_index: str
    report: str
    vectors: str
    out_dir: str
    explicit_sources: Sequence[str] = ()
    min_clean: int = 100_000
    max_removed: float = 0.05
    seen_only: bool = True
    skip_datasets: Sequence[str] = ()
    skip_sources: Sequence[str] = ()
    tiers: Sequence[dict] = TIERS
    recall: float | None = 0.99
    base_columns: Sequence[str] = ("split_component_id", "dedup_component_id", "group_id")

    def run(self, spark: SparkSession) -> dict:
        rows = _load(spark, self.clean_index)
        counts = load_yaml(self.report).get("summary", {})
        raw, clean = counts.get("raw_by_source", {}), counts.get("clean_by_source", {})
        ratios = spark.createDataFrame([(s, n, clean[s], (n - clean[s]) / max(n, 1)) for s, n in raw.items() if s in clean], "source string, raw_rows bigint, clean_rows bigint, removed_ratio double")
        focus = {r[0] for r in X.focus_sources(ratios, "source", list(self.explicit_sources), self.min_clean, self.max_removed).collect()}
        pool = X.semantic_pool(rows, self.seen_only, skip_datasets=self.skip_datasets, skip_sources=self.skip_sources).filter(F.col("source").isin(*focus) if focus else F.lit(False))
        if pool.isEmpty():
            raise ValueError("no source to compare")
        pool = materialize(pool.join(spark.read.parquet(self.vectors).select("path", "vector"), "path"))
        sizes = pool.groupBy("source").agg(F.count("*").alias("n")).withColumn("t", X.tier(F.col("n"), self.tiers)).select("source", "t.*").collect()
        edges = None
        for t, k in sorted({(r["cosine_threshold"], r["topk"]) for r in sizes}):
            own = [r["source"] for r in sizes if (r["cosine_threshold"], r["topk"]) == (t, k)]
            reps, copies = X.vector_classes(pool.filter(F.col("source").isin(*own)).select("row_idx", "source", "vector"), "row_idx", "source", "vector")
            part = X.semantic_edges(X.cosine_neighbours(reps, "row_idx", "source", "vector", t, k, self.recall)).unionByName(copies)
            edges = part if edges is None else edges.unionByName(part)
        edges = materialize(edges)
        base = first_present(rows, self.base_columns)
        out = materialize(X.semantic_index(rows, pool.drop("vector"), edges, "row_idx", base))
        edges.write.mode("overwrite").parquet(f"{self.out_dir}/semantic_pairs")
        out.write.mode("overwrite").parquet(f"{self.out_dir}/full_index")
        out.filter("keep_stage2_semantic = 1").write.mode("overwrite").parquet(f"{self.out_dir}/clean_index")
        report = {"focus_sources": sorted(focus), "pairs": edges.count(), "rows": out.count(), "dropped": out.filter("keep_stage2_semantic = 0").count()}
        save_yaml(report, f"{self.out_dir}/report.yaml")
        return report


@dataclass
class TightSplits:
    input: str
    out_dir: str
    options: dict = field(default_factory=dict)

    def run(self, spark: SparkSession) -> dict:
        splits = P.tight_splits(P.distinct_paths(_load(spark, self.input), ["path"]), **self.options)
        splits = {k: materialize(v) for k, v in splits.items()}
        for name, df in splits.items():
            if name != "test" or not df.isEmpty():
                P.require_binary(df, name)
        unit = self.options.get("unit") or first_present(splits["train"], P.UNIT_COLUMNS)
        shared = {f"train/{k}": {r["column"]: r["common"] for r in S.overlap(splits["train"], v, [unit, "path", "source", "generator"]).collect()} for k, v in splits.items() if k != "train"}
        return _write_splits(splits, self.out_dir, {"overlap": shared})


@dataclass
class CompactSplits:
    input: str
    out_dir: str
    preset: str = "mini"
    totals: Sequence[int] | None = None
    group: str = "source"
    seed: int = 42
    holdout_sources: Sequence[str] = ()
    holdout_generators: Sequence[str] = ()

    def run(self, spark: SparkSession) -> dict:
        df = P.distinct_paths(_load(spark, self.input), ["path"])
        splits = P.compact_splits(df, self.totals or P.PRESETS[self.preset], self.group, self.seed, self.holdout_sources, self.holdout_generators)
        return _write_splits(splits, self.out_dir, {"preset": self.preset, "seed": self.seed})


@dataclass
class HeldoutSplits:
    input: str
    out_dir: str
    val_real: int = 20_000
    val_fake: int = 20_000
    real_sources: Sequence[str] = ()
    fake_generators: Sequence[str] = ()
    fake_sources: Sequence[str] = ()
    seed: int = 42

    def run(self, spark: SparkSession) -> dict:
        df = P.distinct_paths(_load(spark, self.input), ["path"])
        splits = P.heldout_splits(df, self.val_real, self.val_fake, self.real_sources, self.fake_generators, self.fake_sources, self.seed)
        return _write_splits(splits, self.out_dir, {"seed": self.seed})


@dataclass
class SingleSplits:
    input: str
    out_dir: str
    train: Sequence[int] = (60_000, 60_000)
    val: Sequence[int] = (8_000, 8_000)
    real_group: str = "source"
    fake_group: str = "generator"
    seed: int = 42

    def run(self, spark: SparkSession) -> dict:
        df = P.distinct_paths(_load(spark, self.input), ["path"])
        splits = P.single_stage_splits(df, {"train": tuple(self.train), "val": tuple(self.val)}, self.real_group, self.fake_group, self.seed)
        return _write_splits(splits, self.out_dir, {"seed": self.seed})


@dataclass
class Mine:
    """Scored candidates into the replay buffer and, if wanted, into a training table.

    The threshold is the given one, else that of the calibration table's precision, else 0.5.
    """

    scored: str
    buffer: str
    threshold: float | None = None
    calibration: str | None = None
    precision: float = 0.98
    top: Sequence[int] = (40_000, 40_000, 20_000)
    weights: Sequence[float] = (3.0, 3.0, 1.5)
    most: int = 200_000
    errors_only: bool = False
    mined_at: str = "1970-01-01T00:00:00+00:00"
    base_train: str | None = None
    merged_train: str | None = None

    def run(self, spark: SparkSession) -> dict:
        t = self.threshold
        if t is None:
            t = M.calibrate(_load(spark, self.calibration), self.precision) if self.calibration else 0.5
        new = materialize(N.select_hard(_load(spark, self.scored), t, *self.top, self.weights, self.errors_only, self.mined_at))
        buffer = upsert_table(new, self.buffer, lambda old, fresh: N.merge_buffer(old, fresh, self.most))
        if self.base_train and self.merged_train:
            write_samples(N.merge_with_train(buffer, _load(spark, self.base_train)), self.merged_train)
        return {"threshold": t, "mined": new.count(), "buffer": buffer.count(), **_counts(buffer, ["hard_type", "label"])}


@dataclass
class Evaluate:
    """Metrics of a scored table."""

    scored: str
    output: str
    precisions: Sequence[float] = (0.95, 0.98, 0.99)

    def run(self, spark: SparkSession) -> dict:
        df = _load(spark, self.scored)
        report = M.binary_metrics(df).first().asDict()
        for r in M.precision_targets(df, list(self.precisions)).collect():
            report[f"recall@{r['target']}"], report[f"threshold@{r['target']}"] = r["recall"], r["threshold"]
        save_yaml(report, self.output)
        return report


COMMANDS = {"scan": Scan, "dedup": Dedup, "semantic": Semantic, "tight": TightSplits, "compact": CompactSplits, "heldout": HeldoutSplits, "single": SingleSplits, "mine": Mine, "evaluate": Evaluate}


def build(command: str, config: dict):
    """The command's job from a mapping; unknown names are refused."""
    kind = COMMANDS[command]
    unknown = set(config) - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"unknown options of {command}: {sorted(unknown)}")
    return kind(**config)
