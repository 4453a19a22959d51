"""Exact threshold-curve metrics of a binary classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup_join, materialize
from .ranking import running_sums, value_buckets


def threshold_curve(df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()) -> DataFrame:
    """keys, score, tp, fp, pos, neg: counts of rows at or above every distinct score.

    Rows with a null or NaN score or a label other than 0 and 1 are left out. Scores are ordered in
    ranges, so even as many scores as rows never meet in one task.
    """
    keys = list(keys)
    s = F.col(score).cast("double")
    rows = df.filter(F.col(label).isin(0, 1) & s.isNotNull() & ~F.isnan(s))
    each = materialize(rows.groupBy(*keys, (s + 0.0).alias("score")).agg(F.sum(F.col(label).cast("bigint")).alias("p"), F.sum((1 - F.col(label)).cast("bigint")).alias("n")))
    ranged, b = value_buckets(each, "score")
    curve = running_sums(ranged, keys, -F.col(b), [F.col("score").desc()], {"tp": F.col("p"), "fp": F.col("n")}).drop(b, "p", "n")
    if not keys:
        whole = each.agg(F.coalesce(F.sum("p"), F.lit(0)).alias("pos"), F.coalesce(F.sum("n"), F.lit(0)).alias("neg")).first()
        return curve.withColumns({"pos": F.lit(whole[0]).cast("bigint"), "neg": F.lit(whole[1]).cast("bigint")})
    whole = materialize(each.groupBy(*keys).agg(F.sum("p").alias("pos"), F.sum("n").alias("neg")))
    return lookup_join(curve, whole, keys)


def binary_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """rows, accuracy, real_accuracy, fake_accuracy, average_precision, auroc.

    A class accuracy is NaN without rows of the class, AUROC without either class; average precision
    is the sum of precision times the step in recall over distinct scores.
    """
    curve = materialize(threshold_curve(df, label, score))
    # steps from the previous score follow from the counts of the score itself
    own = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    step = own.groupBy((F.col(score).cast("double") + 0.0).alias("score")).agg(F.sum(F.col(label).cast("bigint")).alias("dp"), F.sum((1 - F.col(label)).cast("bigint")).alias("dn"))
    c = curve.join(step, "score")
    nan = F.lit(float("nan"))
    area = c.agg(
        F.sum(F.col("dp") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ap"),
        F.sum(F.col("dn") * (F.col("tp") * 2 - F.col("dp")) / 2.0).alias("auc"),
        F.max("pos").alias("pos"),
        F.max("neg").alias("neg"),
    )
    hit = ((F.col(score) >= threshold).cast("int") == F.col(label)).cast("double")
    plain = own.agg(F.count("*").alias("rows"), F.avg(hit).alias("accuracy"), F.avg(F.when(F.col(label) == 0, hit)).alias("real_accuracy"), F.avg(F.when(F.col(label) == 1, hit)).alias("fake_accuracy"))
    out = plain.withColumn("__k", F.lit(1)).join(area.withColumn("__k", F.lit(1)), "__k")
    return out.select(
        "rows",
        F.coalesce("accuracy", nan).alias("accuracy"),
        F.coalesce("real_accuracy", nan).alias("real_accuracy"),
        F.coalesce("fake_accuracy", nan).alias("fake_accuracy"),
        F.when(F.col("pos") > 0, F.col("ap") / F.col("pos")).otherwise(0.0).alias("average_precision"),
        F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("auc") / (F.col("pos") * F.col("neg"))).otherwise(nan).alias("auroc"),
    )


def precision_targets(df: DataFrame, targets: Sequence[float], label: str = "label", score: str = "score") -> DataFrame:
    """target, threshold, recall: the lowest score whose precision reaches each target, and its recall.

    Without such a score the threshold is null and the recall 0 (precision 1 at recall 0 always exists).
    """
    curve = threshold_curve(df, label, score).withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp")))
    reached = [F.when((F.col("precision") >= t) & (F.col("tp") > 0), F.struct("score", (F.col("tp") / F.col("pos")).alias("recall"))) for t in targets]
    best = curve.agg(*[F.min(r).alias(f"t{i}") for i, r in enumerate(reached)])
    rows = F.array(*[F.struct(F.lit(float(t)).alias("target"), F.col(f"t{i}.score").alias("threshold"), F.coalesce(F.col(f"t{i}.recall"), F.lit(0.0)).alias("recall")) for i, t in enumerate(targets)])
    return best.select(F.explode(rows).alias("x")).select("x.*")


def calibrate(df: DataFrame, precision: float, label: str = "label", score: str = "score") -> float:
    """The lowest threshold that reaches the precision; fails if there is none."""
    t = precision_targets(df, [precision], label, score).first()["threshold"]
    if t is None:
        raise ValueError(f"no threshold reaches precision {precision}")
    return float(t)
