"""Manifests of sources and the sample index scanned from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

#: File endings of pictures unless a manifest says otherwise. Fixed values.
EXTENSIONS = ("jpg", "jpeg", "png", "webp", "bmp")
#: Columns of the canonical index, in order.
INDEX = ("path", "label", "source", "dataset", "domain", "generator", "split_hint", "sample_weight", "is_hard_negative")


def load_yaml(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def save_yaml(obj: object, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(obj, f, sort_keys=False, allow_unicode=True)


def source_specs(manifest: Mapping) -> list[dict]:
    """The manifest's sources with every default filled; needs path and label of each."""
    sources = manifest.get("sources")
    if not sources:
        raise ValueError("the manifest has no sources")
    out = []
    for i, s in enumerate(sources):
        if "path" not in s or "label" not in s:
            raise ValueError(f"source {i} needs path and label")
        root = str(s["path"]).rstrip("/")
        label = int(s["label"])
        hint = str(s.get("split_hint") or "").strip().lower() or "seen"
        out.append({
            "seq": i,
            "root": root,
            "label": label,
            "source": str(s.get("name") or (Path(root).name or "unknown")),
            "dataset": str(s.get("dataset", "unknown")),
            "domain": str(s.get("domain", "unknown")),
            "generator": str(s.get("generator", "real" if label == 0 else "unknown")),
            "split_hint": hint,
            "sample_weight": float(s.get("sample_weight", 1.0)),
            "is_hard_negative": int(s.get("is_hard_negative", 0)),
            "group_level": int(s.get("group_level", manifest.get("group_level", 1))),
            "recursive": bool(s.get("recursive", manifest.get("recursive", True))),
            "exts": [str(e).lower().lstrip(".") for e in s.get("exts", manifest.get("exts", EXTENSIONS))],
        })
    return out


def list_files(spark: SparkSession, roots: Sequence[str], recursive: bool) -> DataFrame:
    """path, file_size_bytes, mtime of the directories' files; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("ignoreMissingFiles", "true").load(list(roots))
    plain = F.regexp_replace("path", "^file:/*", "/")
    return found.select(plain.alias("path"), F.col("length").alias("file_size_bytes"), F.unix_micros("modificationTime").alias("__m")).withColumn("mtime", F.col("__m") / 1e6).drop("__m")


def _missing(spark: SparkSession, root: str) -> bool:
    """Whether a root doesn't exist or holds no file; the walk ends at the first."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return not fs.exists(p) or not fs.listFiles(p, True).hasNext()


def scan_manifest(spark: SparkSession, manifest: Mapping, strict: bool = False, pair_family: str | None = None, prompt_family: str | None = None) -> DataFrame:
    """The sample index: one row a file, the first source of the manifest that lists it.

    Missing and empty roots are left out, or fail in strict mode once all are known. All roots are listed
    together; a file's source is looked up by its path.
    """
    specs = source_specs(manifest)
    bad = [s["root"] for s in specs if _missing(spark, s["root"])]
    if bad and strict:
        raise FileNotFoundError(f"missing or empty: {', '.join(bad)}")
    specs = [s for s in specs if s["root"] not in bad]
    if not specs:
        raise ValueError("no source has files")
    out = None
    for recursive in (True, False):
        roots = list(dict.fromkeys(s["root"] for s in specs if s["recursive"] is recursive))
        if roots:
            part = list_files(spark, roots, recursive)
            out = part if out is None else out.unionByName(part)
    facts = [k for k in specs[0] if k not in ("seq", "recursive", "exts", "root")]
    table = F.array(*[
        F.struct(F.regexp_replace(F.lit(s["root"]), "^file:/*", "/").alias("__root"), F.lit(s["recursive"]).alias("__deep"), F.array(*[F.lit(e) for e in s["exts"]]).alias("__ends"), F.lit(s["root"]).alias("source_root"), *[F.lit(s[k]).alias(k) for k in facts])
        for s in specs
    ])
    path, folder, ending = F.col("path"), F.regexp_replace("path", "/[^/]*$", ""), F.lower(F.substring_index("path", ".", -1))
    lists = lambda s: path.startswith(F.concat(s["__root"], F.lit("/"))) & F.array_contains(s["__ends"], ending) & (s["__deep"] | (folder == s["__root"]))
    out = out.dropDuplicates(["path"]).withColumn("__s", F.get(F.filter(table, lists), F.lit(0))).filter("__s IS NOT NULL").select("path", "file_size_bytes", "mtime", *[F.col(f"__s.{k}").alias(k) for k in ("source_root", *facts)])
    out = out.withColumns({
        "relpath": F.expr("substring(path, length(regexp_replace(source_root, '^file:/*', '/')) + 2)"),
        "filename": T.file_name("path"),
        "stem": T.file_stem("path"),
        "content_id": T.stem_id(T.file_stem("path")),
        "group_token": T.group_token("path", F.col("group_level")),
        "pair_group": T.pair_group("dataset", "source", "path", pair_family) if pair_family else F.lit(""),
        "prompt_group": T.prompt_group("dataset", "path", prompt_family) if prompt_family else F.lit(""),
    }).withColumn("group_id", F.concat_ws(":", "source", "group_token"))
    rest = [c for c in out.columns if c not in INDEX]
    return out.select(*INDEX, *rest)


def with_row_index(df: DataFrame, order: str = "path", name: str = "row_idx") -> DataFrame:
    """df with its 0-based place in the order of a unique text column, ranked in ranges."""
    from ..operators.common import materialize

    ranged = materialize(df.repartitionByRange(F.col(order)).withColumn("__p", F.spark_partition_id()))
    from ..operators.ranking import running_sums

    return running_sums(ranged, [], F.col("__p"), [F.col(order)], {name: F.lit(1).cast("bigint")}).withColumn(name, F.col(name) - 1).drop("__p")
