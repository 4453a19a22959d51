"""Batch scoring by any model that maps rows to numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Builds, once a worker, a function from a pandas batch to one score (or list of view scores) a row.
ScorerFactory = Callable[[], Callable]


def score_rows(df: DataFrame, factory: ScorerFactory, key: str = "path", views: int = 1, name: str = "score") -> DataFrame:
    """key and the mean over ``views`` scores of every row, keyed rather than by place.

    A scorer may return one number or ``views`` numbers a row; null keys are left out.
    """
    if views not in (1, 2, 3, 4, 5):
        raise ValueError("views must be 1 to 5")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        score = factory()
        for pdf in batches:
            out = np.asarray(score(pdf), dtype="float64").reshape(len(pdf), -1)
            if out.shape[1] not in (1, views):
                raise ValueError(f"{out.shape[1]} views, expected {views}")
            yield pd.DataFrame({key: pdf[key], name: out.mean(axis=1)})

    return df.filter(F.col(key).isNotNull()).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, {name} double")


def embed_rows(df: DataFrame, factory: ScorerFactory, key: str = "path") -> DataFrame:
    """key and the unit-length vector of every row; a model's output over further axes is averaged first.

    The factory builds, once a worker, a function from a pandas batch to an array with one entry a row.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        embed = factory()
        for pdf in batches:
            out = np.asarray(embed(pdf), dtype="float64")
            out = out.reshape(*out.shape[:2], -1).mean(axis=2)
            out = out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
            yield pd.DataFrame({key: pdf[key], "vector": list(out.astype("float32"))})

    return df.filter(F.col(key).isNotNull()).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, vector array<float>")


def verdict(path: Column | str, score: Column | str, threshold: float) -> Column:
    """One record of a scored picture as JSON."""
    s = F.col(score) if isinstance(score, str) else score
    p = F.col(path) if isinstance(path, str) else path
    return F.to_json(F.struct(p.alias("path"), F.round(s, 6).alias("score"), F.lit(threshold).alias("threshold"), (s >= threshold).cast("int").alias("pred_label")))
