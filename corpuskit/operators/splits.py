"""Builders of train, validation and test splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_present, number_or, split_hint, text_or
from .allocate import balanced_sample, greedy_cover, rule_target, take_rows_from_units, take_until
from .common import lookup_join, materialize
from .summary import unit_table

#: Hints of each role. Fixed values.
ROLES = {"unseen": ("unseen", "test_unseen"), "robust": ("robust", "stage2", "robustness"), "fixed_val": ("val", "dev"), "fixed_test_seen": ("test_seen", "seen_test")}
#: Rows per label of the preset workloads: train, val, test_seen, test_unseen, stage2_extra. Fixed values.
PRESETS = {"smoke": (5_000, 1_000, 1_000, 2_000, 0), "mini": (20_000, 4_000, 4_000, 4_000, 4_000), "pilot": (60_000, 8_000, 8_000, 8_000, 12_000)}
#: Validation shares by bucket size. Fixed values.
VAL_RULES = (
    {"min_rows": 200_000, "ratio": 0.01, "min_rows_out": 1_200, "cap_rows_out": 3_000},
    {"min_rows": 50_000, "ratio": 0.02, "min_rows_out": 600, "cap_rows_out": 1_600},
    {"min_rows": 0, "ratio": 0.05, "min_rows_out": 200, "cap_rows_out": 800},
)
UNIT_COLUMNS = ("tight_split_component_id", "split_component_id", "dedup_component_id", "group_id", "path")


def distinct_paths(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row of each path by order; null paths are left out."""
    first = Window.partitionBy("path").orderBy(*order)
    return df.filter("path IS NOT NULL").withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")


def sample_columns(df: DataFrame) -> DataFrame:
    """The sample table's columns with their defaults; other columns pass through."""
    have = set(df.columns)
    text = {c: text_or(c) if c in have else F.lit("unknown") for c in ("source", "dataset", "domain", "generator")}
    return df.withColumns(text | {
        "split_hint": split_hint("split_hint") if "split_hint" in have else F.lit("seen"),
        "sample_weight": number_or("sample_weight", 1.0) if "sample_weight" in have else F.lit(1.0),
        "is_hard_negative": number_or("is_hard_negative", 0).cast("int") if "is_hard_negative" in have else F.lit(0),
        "label": F.col("label").cast("int"),
    })


def role(hint: Column, source: Column, generator: Column, holdout_sources: Sequence[str] = (), holdout_generators: Sequence[str] = ()) -> Column:
    """unseen (also held-out names) before robust, fixed_val, fixed_test_seen; else seen."""
    unseen = hint.isin(*ROLES["unseen"])
    if holdout_sources:
        unseen = unseen | source.isin(*holdout_sources)
    if holdout_generators:
        unseen = unseen | generator.isin(*holdout_generators)
    out = F.when(unseen, "unseen")
    for k in ("robust", "fixed_val", "fixed_test_seen"):
        out = out.when(hint.isin(*ROLES[k]), k)
    return out.otherwise("seen")


def _take(pool: DataFrame, total: int, group: str, seed: str, overshoot: bool = False) -> tuple[DataFrame, DataFrame]:
    """(picked, rest) with ``total`` rows a label spread over the groups."""
    marked = materialize(balanced_sample(pool, ["label"], group, total, seed, overshoot=overshoot))
    return marked.filter("picked").drop("picked"), marked.filter("NOT picked").drop("picked")


def compact_splits(df: DataFrame, totals: Sequence[int], group: str = "source", seed: int = 42, holdout_sources: Sequence[str] = (), holdout_generators: Sequence[str] = (), overshoot: bool = False) -> dict[str, DataFrame]:
    """train_stage1 to 3, val, test_seen, test_unseen, test_all and reviewed_pool of a sample table.

    totals: train, val, test_seen, test_unseen, stage2_extra rows a label. Fixed validation and test rows are taken
    as they are, else drawn from the seen rows; a label missing in test_unseen is supplemented from what
    training leaves over. Only labels 0 and 1 are drawn; rows need distinct paths.
    """
    train_n, val_n, seen_n, unseen_n, extra_n = totals
    df = materialize(sample_columns(df).withColumn("role", role(F.col("split_hint"), F.col("source"), F.col("generator"), holdout_sources, holdout_generators)))
    binary = F.col("label").isin(0, 1)
    part = {k: df.filter(F.col("role") == k).drop("role") for k in ("seen", "unseen", "robust", "fixed_val", "fixed_test_seen")}
    rest, odd = part["seen"].filter(binary), part["seen"].filter(~F.coalesce(binary, F.lit(False)))
    picked = {}
    for name, fixed, n in (("val", "fixed_val", val_n), ("test_seen", "fixed_test_seen", seen_n)):
        if part[fixed].isEmpty():
            picked[name], rest = _take(rest, n, group, f"{seed}:{name}", overshoot)
        else:
            picked[name] = part[fixed]
    train, rest = _take(rest, train_n, group, f"{seed}:train", overshoot)
    unseen, unseen_rest = _take(part["unseen"].filter(binary), unseen_n, group, f"{seed}:test_unseen", overshoot)
    labels = {r[0] for r in unseen.select("label").distinct().collect()}
    for label in sorted({0, 1} - labels):
        own, other = rest.filter(F.col("label") == label), rest.filter(F.col("label") != label)
        more, own = _take(own, unseen_n, group, f"{seed}:supplement", overshoot)
        unseen = unseen.unionByName(more.withColumn("split_hint", F.lit("supplement_unseen")))
        rest = own.unionByName(other)
    extra, _ = _take(part["robust"].filter(binary), extra_n, group, f"{seed}:extra", overshoot)
    extra = extra.withColumn("sample_weight", F.greatest("sample_weight", F.lit(1.0)))
    stage2 = train.unionByName(extra)
    return {
        "train_stage1": train,
        "train_stage2": stage2,
        "train_stage3": stage2,
        "val": picked["val"],
        "test_seen": picked["test_seen"],
        "test_unseen": unseen,
        "test_all": picked["test_seen"].unionByName(unseen),
        "reviewed_pool": rest.unionByName(odd).unionByName(unseen_rest),
    }


def single_stage_splits(df: DataFrame, totals: Mapping[str, tuple[int, int]], real_group: str = "source", fake_group: str = "generator", seed: int = 42, overshoot: bool = False) -> dict[str, DataFrame]:
    """train, val and test_unseen; totals: val and train -> (real rows, fake rows). Validation is drawn first."""
    df = materialize(sample_columns(df))
    unseen = F.col("split_hint") == "unseen"
    out: dict[str, list[DataFrame]] = {"train": [], "val": []}
    for label, group in ((0, real_group), (1, fake_group)):
        rest = df.filter(~unseen & (F.col("label") == label))
        for name in ("val", "train"):
            own, rest = _take(rest, totals[name][label], group, f"{seed}:{name}", overshoot)
            out[name].append(own)
    return {k: a.unionByName(b) for k, (a, b) in out.items()} | {"test_unseen": df.filter(unseen)}


def heldout_splits(df: DataFrame, val_real: int, val_fake: int, real_sources: Sequence[str] = (), fake_generators: Sequence[str] = (), fake_sources: Sequence[str] = (), seed: int = 42) -> dict[str, DataFrame]:
    """train, val and test_unseen, whole real sources and fake generators being held out for val.

    Names not given are chosen by greedy_cover of the wanted rows. All other seen rows train.
    """
    df = materialize(sample_columns(df))
    unseen = F.col("split_hint") == "unseen"
    real, fake = df.filter(~unseen & (F.col("label") == 0)), df.filter(~unseen & (F.col("label") == 1))
    names = lambda pool, c, n: greedy_cover(pool.groupBy(c).agg(F.count("*").alias("rows")), c, "rows", n).select(c)
    spark = df.sparkSession
    given = lambda values, c: spark.createDataFrame([(v,) for v in sorted(set(values))], f"{c} string")
    hold_real = materialize(given(real_sources, "source") if real_sources else names(real, "source", val_real))
    hold_gen = materialize(given(fake_generators, "generator") if fake_generators or fake_sources else names(fake, "generator", val_fake))
    held = lookup_join(fake, hold_gen.withColumn("__g", F.lit(True)), ["generator"], "left")
    held = materialize(held.withColumn("__h", F.coalesce("__g", F.lit(False)) | (F.col("source").isin(*fake_sources) if fake_sources else F.lit(False))).drop("__g"))
    if hold_real.isEmpty() or held.filter("__h").isEmpty():
        raise ValueError("nothing is held out")
    val_a, _ = _take(lookup_join(real, hold_real, ["source"], "left_semi"), val_real, "source", f"{seed}:val")
    group = "source" if fake_sources and not fake_generators else "generator"
    val_b, _ = _take(held.filter("__h").drop("__h"), val_fake, group, f"{seed}:val")
    train = lookup_join(real, hold_real, ["source"], "left_anti").unionByName(held.filter("NOT __h").drop("__h"))
    return {"train": train, "val": val_a.unionByName(val_b), "test_unseen": df.filter(unseen)}


def tight_splits(
    df: DataFrame,
    real_sources: Sequence[str],
    fake_generators: Sequence[str],
    fake_sources: Sequence[str] = (),
    real_rows: int = 6_000,
    fake_rows: int = 6_000,
    rules: Sequence[Mapping[str, float]] = VAL_RULES,
    test_hints: Sequence[str] = ("unseen", "test_unseen"),
    test_sources: Sequence[str] = (),
    test_generators: Sequence[str] = (),
    exclude_datasets: Sequence[str] = (),
    unit: str | None = None,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """train, val_seen, val_unseen and test that never part a unit of linked rows outside test.

    val_unseen takes whole units of held-out names until their rows are met; val_seen takes units of each
    source by the rules; train is the rest without the units used.
    """
    df = sample_columns(df)
    unit = unit or first_present(df, UNIT_COLUMNS)
    df = materialize(df.withColumn("__unit", text_or(unit)))
    test = F.col("split_hint").isin(*test_hints)
    if test_sources:
        test = test | F.col("source").isin(*test_sources)
    if test_generators:
        test = test | F.col("generator").isin(*test_generators)
    seen = df.filter(~test)
    if exclude_datasets:
        seen = seen.filter(~F.col("dataset").isin(*exclude_datasets))
    never = F.lit(False)
    held_real = F.col("source").isin(*real_sources) if real_sources else never
    held_fake = (F.col("generator").isin(*fake_generators) if fake_generators else never) | (F.col("source").isin(*fake_sources) if fake_sources else never)
    held = ((F.col("label") == 0) & held_real) | ((F.col("label") == 1) & held_fake)
    pool = seen.filter(held)
    facts = ["source", "generator"]
    chosen = []
    for label, bucket, n in ((0, "source", real_rows), (1, "generator", fake_rows)):
        own = unit_table(pool.filter(F.col("label") == label), "__unit", facts)
        chosen.append(take_rows_from_units(own, bucket, "__unit", "rows", n, f"{seed}:val_unseen").select("__unit", F.lit(label).alias("label")))
    chosen = materialize(chosen[0].unionByName(chosen[1]))
    val_unseen = lookup_join(pool, chosen, ["__unit", "label"], "left_semi")
    rest = materialize(lookup_join(seen.filter(~held & F.col("label").isin(0, 1)), chosen.select("__unit").distinct(), ["__unit"], "left_anti"))
    picked = []
    for label in (0, 1):
        own = unit_table(rest.filter(F.col("label") == label), "__unit", facts)
        picked.append(take_until(own, "source", "__unit", "rows", rule_target(F.col("bucket_rows"), rules), f"{seed}:val_seen").select("__unit", F.lit(label).alias("label")))
    picked = materialize(picked[0].unionByName(picked[1]))
    val_seen = lookup_join(rest, picked, ["__unit", "label"], "left_semi")
    train = lookup_join(rest, picked.select("__unit").distinct(), ["__unit"], "left_anti")
    return {k: v.drop("__unit") for k, v in {"train": train, "val_seen": val_seen, "val_unseen": val_unseen, "test": df.filter(test)}.items()}


def require_binary(df: DataFrame, name: str) -> None:
    """Fail unless both labels are there."""
    labels = {r[0] for r in df.select("label").distinct().limit(3).collect()}
    if not {0, 1} <= labels:
        raise ValueError(f"{name} lacks a label: {sorted(x for x in labels if x is not None)}")
