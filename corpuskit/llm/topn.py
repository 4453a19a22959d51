"""Problem 1: the N first items of every group, by partition lower bounds.

Each Arrow batch run of a partition finds the N-th best item of every group it holds at
least N of. N items at or before that one exist, so it is a valid bound. The best bound of
each group is joined to the rows, rows behind it are dropped before any shuffle, and only the
survivors are ranked. Bounds are whole order tuples, so millions of tied scores don't survive.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.common import before, lookup_join, materialize, ordering


def _local_bounds(groups: list[str], order: list[tuple[str, bool]], n: int, most: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute

        kept = None

        def cut(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
            keys, plain = [(g, "ascending") for g in groups], table.column_names
            for c, d in order:
                if d and pa.types.is_floating(table.schema.field(c).type):  # Arrow puts NaN last in either direction, Spark above all numbers
                    table = table.append_column(f"{c}_nan", pa.compute.is_nan(table.column(c)))
                    keys.append((f"{c}_nan", "descending"))
                keys.append((c, "descending" if d else "ascending"))
            table = table.sort_by(keys).select(plain).combine_chunks()
            ids = np.zeros(table.num_rows, dtype=bool)
            for g in groups:
                col = table.column(g)
                a, b = col.slice(1), col.slice(0, len(col) - 1)
                same = pa.compute.fill_null(pa.compute.equal(a, b), False)
                both = pa.compute.and_(pa.compute.is_null(a), pa.compute.is_null(b))
                ids[1:] |= ~np.asarray(pa.compute.or_(same, both).combine_chunks() if isinstance(same, pa.ChunkedArray) else pa.compute.or_(same, both))
            starts = np.flatnonzero(ids | (np.arange(table.num_rows) == 0))
            first = np.repeat(starts, np.diff(np.append(starts, table.num_rows)))
            rank = np.arange(table.num_rows) - first
            return table, rank, first

        for batch in batches:
            t = pa.Table.from_batches([batch])
            kept = t if kept is None else pa.concat_tables([kept, t])
            if kept.num_rows < most:
                continue
            table, rank, _ = cut(kept)
            kept = table.filter(pa.array(rank < n))
            if kept.num_rows > most // 2:
                yield from kept.filter(pa.array(cut(kept)[1] == n - 1)).to_batches()
                kept = None
        if kept is not None and kept.num_rows:
            table, rank, _ = cut(kept)
            yield from table.filter(pa.array(rank == n - 1)).to_batches()

    return run


def top_n_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[tuple[str, bool]],
    n: int,
    rank: str = "rank",
    most: int = 200_000,
) -> DataFrame:
    """The first n rows of each group in ``order`` ((column, descending) ...), with their rank.

    Nulls come last in either direction, NaN is above all numbers; null groups form a group; repeated rows count one
    by one; a group with fewer rows comes out whole; n <= 0 or an empty table gives no rows.
    Ties are broken by the later order columns: end the order with a unique one. All other
    columns pass through; an existing column named like ``rank`` is replaced.
    """
    groups, order = list(groups), list(order)
    df = df.drop(rank) if rank in df.columns else df
    if n <= 0:
        return df.withColumn(rank, F.lit(1)).filter("false")
    used = [f"__g{i}" for i in range(len(groups))]
    cols = [f"__o{i}" for i in range(len(order))]
    spec = [(c, d) for c, (_, d) in zip(cols, order)]
    narrow = df.select(*[F.col(g).alias(u) for g, u in zip(groups, used)], *[F.col(c).alias(u) for (c, _), u in zip(order, cols)])
    bounds = narrow.mapInArrow(_local_bounds(used, spec, n, most), narrow.schema)
    best = Window.partitionBy(*used).orderBy(*ordering(spec))
    bounds = materialize(
        bounds.withColumn("__rn", F.row_number().over(best)).filter("__rn = 1").select(*used, F.lit(True).alias("__has"), *[F.col(c).alias(f"__b{c}") for c in cols])
    )
    rows = df.select("*", *[F.col(g).alias(u) for g, u in zip(groups, used)], *[F.col(c).alias(u) for (c, _), u in zip(order, cols)])
    rows = lookup_join(rows, bounds, used, "left")
    rows = rows.filter(F.col("__has").isNull() | before(spec, "__b"))
    rows = rows.withColumn(rank, F.row_number().over(best)).filter(F.col(rank) <= n)
    return rows.select(*df.columns, rank)
