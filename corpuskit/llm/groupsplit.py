"""Problem 5: splits that keep linked rows together.

Rows are reduced to the distinct tuples of entities they carry, with the least and the greatest split
hint of their rows. Every partition of tuples builds a local union-find forest whose vertices, the
entities, hold the hints seen so far; forests are merged level by level, hints with them, and only entities that
more than one forest holds go up. Clusters are then given out largest first, each to
the split furthest below its target. That greedy order is the same for all clusters of one
size, so the driver sees only the histogram of sizes (at most about the square root of twice the rows).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.common import lookup_join, materialize, norm, ranked, release
from ..operators.graph import star_components

_FOREST = "part int, v bigint, root bigint, lo string, hi string"


def _local_forest(batches: Iterator) -> Iterator:
    """(part, v, root, lo, hi) of the edges of each part in this partition; the payload of an edge is its end b's."""
    import pandas as pd

    parents: dict[int, dict[int, int]] = {}
    bounds: dict[int, dict[int, tuple]] = {}

    def find(parent: dict[int, int], x: int) -> int:
        r = x
        while parent.setdefault(r, r) != r:
            r = parent[r]
        while parent[x] != r:
            parent[x], x = r, parent[x]
        return r

    for pdf in batches:
        for part, a, b, lo, hi in zip(*(pdf[c].tolist() for c in ("part", "a", "b", "lo", "hi"))):
            parent = parents.setdefault(part, {})
            x, y = find(parent, a), find(parent, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
            if lo is not None:
                own = bounds.setdefault(part, {})
                known = own.get(b)
                if known is None:
                    own[b] = (lo, hi)
                elif lo < known[0] or hi > known[1]:
                    own[b] = (min(lo, known[0]), max(hi, known[1]))
    for part, parent in parents.items():
        v = list(parent)
        own = bounds.get(part, {})
        lo, hi = ([own.get(x, (None, None))[k] for x in v] for k in (0, 1))
        out = pd.DataFrame({"part": part, "v": v, "root": [find(parent, x) for x in v]}).astype({"part": "int32", "v": "int64", "root": "int64"})
        yield out.assign(lo=pd.Series(lo, dtype="object"), hi=pd.Series(hi, dtype="object"))


def merged_forests(edges: DataFrame, part_edges: int = 200_000, fan_in: int = 8, top_edges: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """((v, root), (v, lo, hi)) of (a, b, lo, hi) edges, a being the finer end, by which edges are first
    gathered. lo and hi are those of b: every vertex that has any comes with an edge to itself.

    A part holds about ``part_edges`` edges; an end with more of them is spread over parts. Entities
    found in one part only are settled there, with their bounds; roots and shared entities go up, ``fan_in``
    parts to one. Should more than ``top_edges`` edges remain for the last part, star rounds over
    all executors solve them.
    """
    e = materialize(edges.groupBy("a", "b").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    parts = max(1, -(-e.count() // part_edges))
    hot = materialize(e.groupBy("a").agg(F.count("*").alias("d")).filter(F.col("d") > part_edges).select("a", F.lit(True).alias("hot")))
    level = lookup_join(e, hot, ["a"], "left")
    spot = F.when(F.col("hot"), F.xxhash64("a", "b")).otherwise(F.xxhash64("a"))
    level = level.select(F.pmod(spot, F.lit(parts)).cast("int").alias("part"), "a", "b", "lo", "hi")
    settled, facts = [], []
    while True:
        forest = materialize(level.repartition(parts, "part").mapInPandas(_local_forest, _FOREST))
        if parts == 1:
            top = forest.select("v", "root")
            facts.append(forest.select("v", "lo", "hi"))
            break
        shared = forest.groupBy("v").agg(F.count("*").alias("n")).filter("n > 1").select("v", F.lit(True).alias("shared"))
        marked = materialize(forest.join(shared, "v", "left"))
        release(forest)
        facts.append(marked.filter("shared IS NULL AND lo IS NOT NULL").select("v", "lo", "hi"))
        settled.append(marked.filter("shared IS NULL AND v <> root").select("v", "root"))
        up = marked.filter("shared").select("part", F.col("root").alias("a"), F.col("v").alias("b"), "lo", "hi")
        parts = -(-parts // fan_in)
        if parts == 1 and up.count() > top_edges:
            facts.append(up.groupBy(F.col("b").alias("v")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
            top = materialize(star_components(up.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), local_rows=0))
            break
        level = up.withColumn("part", F.expr(f"CAST(part DIV {fan_in} AS INT)"))
    labels = top
    for own in reversed(settled):
        alone = own.select(F.col("root").alias("v")).distinct().join(labels, "v", "left_anti").select("v", F.col("v").alias("root"))
        known = materialize(labels.unionByName(alone))
        found = lookup_join(own, known.select(F.col("v").alias("root"), F.col("root").alias("top")), ["root"])
        labels = materialize(known.unionByName(found.select("v", F.col("top").alias("root"))))
    bounds = facts[0]
    for f in facts[1:]:
        bounds = bounds.unionByName(f)
    return labels, bounds


def hierarchical_components(edges: DataFrame, part_edges: int = 200_000, fan_in: int = 8, top_edges: int = 2_000_000) -> DataFrame:
    """(v, root) of (a, b) edges; null ends and self-loops don't count."""
    none = F.lit(None).cast("string")
    return merged_forests(edges.filter("a <> b").select("a", "b", none.alias("lo"), none.alias("hi")), part_edges, fan_in, top_edges)[0]


def greedy_counts(sizes: Sequence[tuple[int, int]], targets: Mapping[str, float]) -> dict[int, dict[str, int]]:
    """For each (size, clusters): how many clusters each split gets, largest size first,
    always the split furthest below its target (ties: the order of ``targets``)."""
    names = list(targets)
    total = sum(s * n for s, n in sizes)
    whole = sum(targets.values())
    missing = {k: total * targets[k] / whole for k in names}
    out: dict[int, dict[str, int]] = {}
    for size, n in sorted(sizes, reverse=True):
        got = dict.fromkeys(names, 0)
        left = n
        if left > 10_000:  # all but the last steps at once: fill the furthest split down to a common gap
            level = sorted(missing.values(), reverse=True)
            for i in range(1, len(names) + 1):
                water = (sum(level[:i]) - left * size) / i
                if i == len(names) or water >= level[i]:
                    break
            for k in names:
                take = max(0, int((missing[k] - water) // size) - 1)
                take = min(take, left)
                got[k] += take
                missing[k] -= take * size
                left -= take
        for _ in range(left):
            k = max(names, key=lambda x: missing[x])
            got[k] += 1
            missing[k] -= size
        out[size] = got
    return out


class GroupSplit:
    """Clusters of linked rows and the split each is given to."""

    def __init__(self, rows: DataFrame, row_id: str, entities: Mapping[str, str], split_hint: str, targets: Mapping[str, float], part_edges: int = 200_000):
        """entities: kind -> column (null: the row has none of that kind), the finest kind first.

        Rows with a null id are left out; a row without any entity is its own cluster;
        repeated ids count as rows of the same cluster only through their entities. No rows
        give empty results. Hints: trimmed, lower-cased, null or blank as ``seen``.
        """
        self.targets = dict(targets)
        self.kinds = list(entities)
        h = norm(split_hint)
        self.names = [f"e{i}" for i in range(len(self.kinds))]
        base = rows.select(
            F.col(row_id).alias("id"),
            F.when(h.isNull() | (h == ""), "seen").otherwise(h).alias("hint"),
            *[F.col(c).cast("string").alias(e) for e, c in zip(self.names, entities.values())],
        ).filter("id IS NOT NULL")
        node = F.coalesce(*[self._vertex(k, e) for k, e in zip(self.kinds, self.names)], F.xxhash64(F.lit("row"), F.col("id").cast("string")))
        base = base.withColumn("node", node)
        self.row_node = base.select("id", "node")
        # the first kind is taken for the finest: its tuples are gathered by it
        tuples = base.groupBy("node", *self.names).agg(F.count("*").alias("rows"), F.min("id").alias("first"), F.min("hint").alias("lo"), F.max("hint").alias("hi"))
        self.tuples = materialize(tuples)
        ends = F.explode(F.array(*[self._vertex(k, e) for k, e in zip(self.kinds, self.names)])).alias("b")
        pairs = self.tuples.select(F.col("node").alias("a"), ends, "lo", "hi").filter("b IS NOT NULL")
        self.labels, self.hints = merged_forests(pairs, part_edges)
        # tuples before rows: a cluster with a third of all rows joins as few tuples
        counted = self.tuples.groupBy("node").agg(F.sum("rows").alias("rows"), F.min("first").alias("first"))
        of = lookup_join(counted, self.labels.select(F.col("v").alias("node"), "root"), ["node"], "left")
        self.node_root = materialize(of.select("node", "rows", "first", F.coalesce("root", "node").alias("root")))
        self.clusters = materialize(self.node_root.groupBy("root").agg(F.sum("rows").alias("size"), F.min("first").alias("cluster")))

    @staticmethod
    def _vertex(kind: str, column: str) -> Column:
        """The forest's vertex of an entity; null where there is none."""
        return F.when(F.col(column).isNotNull(), F.xxhash64(F.lit(kind), F.col(column)))

    def assigned(self) -> DataFrame:
        """root, cluster (its smallest row id), size, split."""
        sizes = [(r[0], r[1]) for r in self.clusters.groupBy("size").count().collect()]
        plan = greedy_counts(sizes, self.targets)
        names = list(self.targets)
        table = self.clusters.sparkSession.createDataFrame(
            [(s, *[sum(got[k] for k in names[: i + 1]) for i in range(len(names))]) for s, got in plan.items()], "size bigint, " + ", ".join(f"c{i} bigint" for i in range(len(names)))
        )
        number = dict(self.clusters.dtypes)["cluster"] not in ("string", "binary")
        order = self.clusters.withColumn("o", F.col("cluster") if number else F.xxhash64("cluster"))
        place = lookup_join(ranked(order, ["size"], "o", ties=["cluster"]), table, ["size"])
        pick = F.lit(names[-1])
        for i in range(len(names) - 2, -1, -1):
            pick = F.when(F.col("rank") <= F.col(f"c{i}"), names[i]).otherwise(pick)
        return place.select("root", "cluster", "size", pick.alias("split"))

    def rows(self) -> DataFrame:
        """id, cluster, split of every row."""
        given = self.node_root.select("node", "root").join(self.assigned(), "root").select("node", "cluster", "split")
        return lookup_join(self.row_node, materialize(given), ["node"]).select("id", "cluster", "split")

    def torn_entities(self) -> DataFrame:
        """kind, entity, rows, cluster, split: entities whose rows carry more than one hint, and the
        one split that their cluster is given to.

        They are read from the merged forests, whose vertices hold the least and greatest hint of
        an entity's rows. The tuples of these vertices alone then tell the entities' names, and once more
        their hints, so that entities of equal hash are told apart.
        """
        torn = materialize(lookup_join(self.hints.filter("lo < hi").select("v"), self.labels, ["v"], "left").select("v", F.coalesce("root", "v").alias("root")))
        each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(e).alias("entity"), self._vertex(k, e).alias("v")) for k, e in zip(self.kinds, self.names)])).alias("x")
        of = self.tuples.select("rows", "lo", "hi", each).select("x.*", "rows", "lo", "hi").filter("v IS NOT NULL")
        of = lookup_join(of, torn, ["v"])
        of = of.groupBy("kind", "entity", "root").agg(F.sum("rows").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo < hi")
        return lookup_join(of, materialize(self.assigned()), ["root"]).select("kind", "entity", "rows", "cluster", "split")
