"""Hard examples of a scored table and the capped buffer they are kept in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import source_or_path
from .common import lookup_join, materialize
from .ranking import global_top


def select_hard(
    scored: DataFrame,
    threshold: float,
    top_real: int,
    top_fake: int,
    top_uncertain: int,
    weights: Sequence[float] = (3.0, 3.0, 1.5),
    errors_only: bool = False,
    mined_at: str = "1970-01-01T00:00:00+00:00",
    model: str = "ema",
) -> DataFrame:
    """Reals of highest and fakes of lowest score, then rows closest to the threshold among all others.

    Adds pred_label, is_error, priority, margin_to_threshold, hard_type, sample_weight,
    is_hard_negative, decision_thr, mined_at and mined_model. errors_only leaves out what was judged
    right. Ties go by path; one row a path. Null labels and scores are left out.
    """
    s, t = F.col("score"), F.lit(float(threshold))
    df = scored.filter("label IS NOT NULL AND score IS NOT NULL AND path IS NOT NULL").withColumn("score", s.cast("double"))
    df = df.withColumns({"source": source_or_path("source", "path"), "pred_label": (s >= t).cast("int")}).withColumn("is_error", (F.col("pred_label") != F.col("label")).cast("int"))

    def pick(pool: DataFrame, priority, margin, kind, k: int, weight: float) -> DataFrame:
        pool = pool.withColumns({"priority": priority, "margin_to_threshold": margin, "hard_type": kind})
        return global_top(pool, [F.desc("priority"), F.asc("path")], k, "priority").withColumn("sample_weight", F.lit(float(weight)))

    wrong = F.col("is_error") == 1
    judged = df.filter(wrong) if errors_only else df
    real = pick(judged.filter("label = 0"), s, s - t, F.when(wrong, "real_false_positive").otherwise("real_near_miss"), top_real, weights[0])
    fake = pick(judged.filter("label = 1"), 1.0 - s, t - s, F.when(wrong, "fake_false_negative").otherwise("fake_near_miss"), top_fake, weights[1])
    chosen = materialize(real.unionByName(fake))
    rest = df.join(chosen.select("path").distinct(), "path", "left_anti")
    if errors_only:
        rest = rest.filter("false")
    near = pick(rest, 1.0 - F.abs(s - t), 0.0 - F.abs(s - t), F.lit("uncertain_band"), top_uncertain, weights[2])
    out = chosen.withColumn("__o", F.lit(0)).unionByName(near.withColumn("__o", F.lit(1)))
    first = Window.partitionBy("path").orderBy("__o", "label", F.desc("priority"))
    out = out.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "__o")
    return out.withColumns({"is_hard_negative": F.lit(1), "decision_thr": t, "mined_at": F.lit(mined_at), "mined_model": F.lit(model)})


def _order(*more: str):
    return [F.desc_nulls_last("priority"), F.desc_nulls_last("sample_weight"), *[F.desc_nulls_last(c) for c in more], F.asc("path")]


def cap_buffer(df: DataFrame, most: int, source: str = "source") -> DataFrame:
    """At most ``most`` rows: an equal quota for each source by priority, what is left by priority overall.

    A buffer within ``most`` stays whole. Rows need a unique path.
    """
    df = materialize(df)
    n = df.count()
    if n <= most:
        return df
    groups = df.select(source).distinct().count()
    quota = most // max(1, groups)
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(source).orderBy(*_order())))
    # the quota is a limit of the ranking, so every task keeps no more of a source before the shuffle
    kept = materialize(ranked.filter(F.col("__r") <= quota).drop("__r")) if quota else df.limit(0)
    rest = lookup_join(df, kept.select("path"), ["path"], "left_anti")
    return kept.unionByName(global_top(rest, _order(), most - kept.count(), "priority"))


def merge_buffer(existing: DataFrame | None, new: DataFrame, most: int, source: str = "source") -> DataFrame:
    """New and old rows, the best of each path by priority, weight, score and mining time, capped."""
    both = new if existing is None else new.unionByName(existing, allowMissingColumns=True)
    both = both.filter("path IS NOT NULL").withColumn(source, source_or_path(source, "path"))
    both = both.withColumn("priority", F.nanvl("priority", F.lit(None).cast("double")))
    best = Window.partitionBy("path").orderBy(*[F.desc_nulls_last(c) for c in ("priority", "sample_weight", "score", "mined_at") if c in both.columns], *[F.asc(c) for c in both.columns if c in ("replay_id",)])
    both = both.withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n")
    return cap_buffer(both, most, source)


def merge_with_train(replay: DataFrame, base: DataFrame, source: str = "source") -> DataFrame:
    """Replay rows and, for other paths, the first base row of each path (by its columns' text)."""
    keep = ["path", "label", source, "sample_weight", "is_hard_negative"] + [c for c in ("hard_type", "score", "priority", "margin_to_threshold", "decision_thr", "mined_at", "mined_model") if c in replay.columns]
    both = replay.select(*keep).withColumn("__o", F.lit(0)).unionByName(base.withColumn(source, source_or_path(source, "path")).withColumn("__o", F.lit(1)), allowMissingColumns=True)
    rest = [F.asc_nulls_last(F.col(c).cast("string")) for c in both.columns if c not in ("path", "__o")]
    first = Window.partitionBy("path").orderBy("__o", *rest)
    return both.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "__o")
