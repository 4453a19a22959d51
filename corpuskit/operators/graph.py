"""Connected components over edge tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release, split_join

#: Counted edges that one task may hold (some 100 MB).
LOCAL_EDGES = 500_000


def clean_edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct undirected edges (a < b); nulls and self-loops are left out."""
    s, d = F.col(src).cast("bigint"), F.col(dst).cast("bigint")
    return edges.select(F.least(s, d).alias("a"), F.greatest(s, d).alias("b"), (s.isNotNull() & d.isNotNull() & (s != d)).alias("ok")).filter("ok").select("a", "b").distinct()


def _forest(batches: Iterator) -> Iterator:
    """(v, root) of the (a, b) edges of one bounded partition by union-find; roots are smallest."""
    import pandas as pd

    parent: dict[int, int] = {}

    def find(x: int) -> int:
        r = x
        while parent.setdefault(r, r) != r:
            r = parent[r]
        while parent[x] != r:
            parent[x], x = r, parent[x]
        return r

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    if parent:
        yield pd.DataFrame({"v": list(parent), "root": [find(x) for x in parent]}).astype("int64")


def local_components(edges: DataFrame) -> DataFrame:
    """(v, root) of few, counted (a, b) edges in one task."""
    return edges.select("a", "b").coalesce(1).mapInPandas(_forest, "v bigint, root bigint")


def _signature(edges: DataFrame) -> tuple:
    """Two equal edge sets have equal signatures, others all but surely don't."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def star_components(edges: DataFrame, max_rounds: int = 60, hot: int = 200_000, local_rows: int = LOCAL_EDGES) -> DataFrame:
    """(v, root): every vertex of the (a, b) edges with the smallest vertex of its component.

    Alternating large-star and small-star rounds, each a group-by and a join; the number of
    rounds grows with the logarithm of the largest component. Hot vertices are not gathered: the
    minimum neighbour is a partial aggregate, and vertices of more than ``hot`` edges are broadcast.
    At most ``local_rows`` counted edges are solved in one task, to the same result.
    """
    e = materialize(edges.select("a", "b"))
    seen = _signature(e)
    if seen[0] <= local_rows:
        return local_components(e)
    for _ in range(max_rounds):
        # large-star: link every larger neighbour of v to the smallest of v and its neighbours
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("d")))
        large = split_join(both.filter("b > a"), least, "a", "d", hot).select(F.col("b").alias("u"), F.col("m").alias("v"))
        # small-star: link v and its smaller neighbours to the smallest of them
        down = large.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).filter("a <> b").distinct()
        down = materialize(down)
        low = materialize(down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("d")))
        small = split_join(down, low, "a", "d", hot)
        nxt = small.select(F.col("b").alias("u"), "m").unionByName(small.select(F.col("a").alias("u"), "m")).filter("u <> m").distinct()
        nxt = materialize(nxt.select(F.col("m").alias("a"), F.col("u").alias("b")))
        release(e, down, least, low)
        e, before, seen = nxt, seen, _signature(nxt)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("v"), "root")
    return roots.unionByName(e.select(F.col("a").alias("v"), F.col("a").alias("root")).distinct())


def components(vertices: DataFrame, vertex: str, edges: DataFrame, src: str, dst: str, label: str = "component") -> DataFrame:
    """vertices with their component's smallest member; a vertex without edges is its own.

    Null vertices keep a null label; edges to unknown vertices still link the known ones.
    """
    found = star_components(clean_edges(edges, src, dst)).select(F.col("v").alias("__v"), F.col("root").alias("__root"))
    out = vertices.join(found, F.col(vertex) == F.col("__v"), "left")
    return out.select(*vertices.columns, F.coalesce("__root", F.col(vertex)).alias(label))
