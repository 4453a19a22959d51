"""Per-key results where a few keys hold most records.

Exact per-key quantiles by iterative refinement of value histograms: every pass adds
mergeable counts (partial aggregation before the shuffle), narrows each key's range to the
bucket that holds the wanted rank, and ends when ranks resolve. No key's values are ever
gathered, so a hot key costs the same few histogram rows as a rare one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, materialize


def _bucket(v, lo, hi, buckets: int, whole: bool):
    """Bucket of v in [lo, hi]; never falls as v rises."""
    dv, dl, dh = v.cast("double"), lo.cast("double"), hi.cast("double")
    share = F.floor((dv - dl) / (dh - dl) * F.lit(float(buckets)))
    inside = F.greatest(F.lit(0), F.least(F.lit(buckets - 1), share.cast("int")))
    near = F.least(v - lo, F.lit(buckets - 1)).cast("int") if whole else F.lit(0)
    endless = ~(F.abs(dh - dl) < F.lit(float("inf")))
    return (
        F.when(v == lo, 0)
        .when(endless, F.when(v == hi, buckets - 1).when(v < 0, 1).otherwise(2))
        .when(dh > dl, inside)
        .otherwise(near)
    )


def exact_key_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float | Fraction],
    buckets: int = 1024,
    limit: int = 200_000,
) -> DataFrame:
    """keys, n_rows, n_values and one column per entry of ``probs`` with the exact quantile.

    The quantile p of n values is the value of rank max(1, ceil(p * n)), in whole numbers for a Fraction. Null and NaN values
    are counted in n_rows only; a key without values gets null quantiles; null keys form
    their own key; ties and repeated rows count one by one; an empty table gives no rows.
    Other columns are not read, so clashing names do not matter.
    """
    whole = dict(df.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
    v = F.col(value).cast("bigint" if whole else "double")
    rows = df.select(*keys, v.alias("__v"))
    if not whole:
        rows = rows.withColumn("__v", F.when(~F.isnan("__v"), F.col("__v") + F.lit(0.0)))
    base = materialize(
        rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count("__v").alias("n_values"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    )
    names = list(probs)
    n = F.col("n_values")
    rank = lambda p: F.expr(f"(n_values * {p.numerator} + {p.denominator - 1}) DIV {p.denominator}") if isinstance(p, Fraction) else F.ceil(F.lit(float(p)) * n).cast("bigint")
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("q"), F.greatest(F.lit(1).cast("bigint"), rank(p)).alias("r")) for k, p in probs.items()])).alias("__q")
    state = base.filter("n_values > 0").select(*keys, "__lo", "__hi", wanted).select(*keys, F.col("__q.q").alias("__q"), F.col("__q.r").alias("__r"), "__lo", "__hi")
    state = materialize(state)
    done = []
    while True:
        done.append(state.filter("__lo = __hi").select(*keys, "__q", F.col("__lo").alias("__value")))
        open_ = state.filter("__lo < __hi")
        ranges = open_.select(*keys, "__lo", "__hi").distinct()
        if open_.isEmpty():
            break
        inside = lookup_join(rows.filter("__v IS NOT NULL"), ranges, keys, limit=limit).filter("__v >= __lo AND __v <= __hi")
        hist = inside.groupBy(*keys, "__lo", "__hi", _bucket(F.col("__v"), F.col("__lo"), F.col("__hi"), buckets, whole).alias("__i")).agg(
            F.count("*").alias("__n"), F.min("__v").alias("__mn"), F.max("__v").alias("__mx")
        )
        w = Window.partitionBy(*keys, "__lo", "__hi").orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumn("__c", F.sum("__n").over(w))
        same = [open_[k].eqNullSafe(hist[k]) for k in (*keys, "__lo", "__hi")]
        cond = (open_["__r"] > hist["__c"] - hist["__n"]) & (open_["__r"] <= hist["__c"])
        for s in same:
            cond = cond & s
        state = materialize(
            open_.join(hist, cond).select(*[open_[k] for k in keys], "__q", (F.col("__r") - F.col("__c") + F.col("__n")).alias("__r"), F.col("__mn").alias("__lo"), F.col("__mx").alias("__hi"))
        )
    found = done[0]
    for d in done[1:]:
        found = found.unionByName(d)
    found = found.groupBy(*keys).agg(*[F.max(F.when(F.col("__q") == k, F.col("__value"))).alias(k) for k in names])
    cond = [base[k].eqNullSafe(found[k]) for k in keys]
    joined = base.join(found, cond, "left")
    return joined.select(*[base[k] for k in keys], "n_rows", "n_values", *names)


def skewed_key_stats(
    df: DataFrame,
    keys: Sequence[str],
    distinct: str,
    flags: Mapping[str, Column] | None = None,
) -> DataFrame:
    """keys, rows, one count per flag, and the distinct non-blank values of ``distinct``.

    Two steps: first per (key, value), which spreads a hot key over all tasks, then per key
    over what is left after partial aggregation. Null keys form their own key; null and blank
    values are not counted as a value; a null flag is not counted; no rows give no rows.
    """
    flags = dict(flags or {})
    d = F.col(distinct)
    first = df.select(*keys, F.when(F.trim(d) != "", d).alias("__d"), *[F.when(c, 1).otherwise(0).alias(k) for k, c in flags.items()])
    first = first.groupBy(*keys, "__d").agg(F.count("*").alias("rows"), *[F.sum(k).alias(k) for k in flags])
    return first.groupBy(*keys).agg(F.sum("rows").alias("rows"), *[F.sum(k).alias(k) for k in flags], F.count("__d").alias("distinct_values"))


def heavy_keys(df: DataFrame, keys: Sequence[str], share_of: int) -> DataFrame:
    """keys, rows of the keys that hold at least 1/share_of of all rows.

    In the order of the keys' hash such a key fills a stretch of ranks that no multiple of n / share_of
    steps over, so exact_key_quantiles selects, by histograms of a fixed number of buckets however many keys there
    are, at most share_of hashes among which all heavy keys are. Rows with those hashes are then counted by
    their real keys. Keys with a null part count in the total but are never returned; no rows give no rows.
    """
    whole = [F.col(k).isNotNull() for k in keys]
    rows = df.select(F.lit(1).alias("__all"), *keys, F.shiftright(F.xxhash64(*keys), 1).alias("__h"))
    at = exact_key_quantiles(rows, ["__all"], "__h", {f"q{i}": Fraction(i, share_of) for i in range(1, share_of + 1)}).first()
    if at is None:
        return df.select(*keys, F.lit(0).cast("bigint").alias("rows")).filter("false")
    found = sorted({at[f"q{i}"] for i in range(1, share_of + 1)})
    near = rows.filter(F.col("__h").isin(found))
    for w in whole:
        near = near.filter(w)
    return near.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") * share_of >= at["n_rows"])
