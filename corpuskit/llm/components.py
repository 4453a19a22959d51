"""Problem 2: pairwise matches to groups.

Vertices of degree one are stripped and chains of vertices of degree two compressed by list
ranking (pointer doubling over arcs), in turn, until the core that is left fits one task or neither removes
anything: forests vanish in a number of rounds that grows with the logarithm of their size, and the vertices of
what remains have three neighbours or more. The reduced core is solved, and labels are restored to the removed vertices by doubling the pointers to
what each of them hung on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import lookup_join, materialize, release
from ..operators.graph import LOCAL_EDGES, clean_edges, star_components


def _both(e: DataFrame) -> DataFrame:
    return e.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("n")), F.struct(F.col("b").alias("v"), F.col("a").alias("n")))).alias("x")).select("x.*")


def _strip(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges without those of degree-one vertices, and (v, parent) of the vertices removed."""
    leaf = _both(e).groupBy("v").agg(F.count("*").alias("d"), F.min("n").alias("p")).filter("d = 1")
    # of two leaves on one edge only the larger goes
    gone = leaf.groupBy(F.least("v", "p").alias("a"), F.greatest("v", "p").alias("b")).agg(F.max("v").alias("v"))
    gone = materialize(gone.select("a", "b", "v", (F.col("a") + F.col("b") - F.col("v")).alias("parent")))
    rest = materialize(e.join(gone.select("a", "b"), ["a", "b"], "left_anti"))
    return rest, gone.select("v", "parent")


def _compress(e: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Edges with every chain of degree-two vertices replaced by one edge, and (v, parent), if there are chains."""
    two = _both(e).groupBy("v").agg(F.count("*").alias("d"), F.min("n").alias("n1"), F.max("n").alias("n2")).filter("d = 2").select("v", "n1", "n2")
    two = materialize(two)
    if two.isEmpty():
        return e, None
    arcs = two.select("v", F.explode(F.array("n1", "n2")).alias("h"))
    nxt = two.select(F.col("v").alias("h"), "n1", "n2")
    # an arc v -> h goes on over h if h is on the chain too, else it ends there; a hub that ends many is not in nxt
    arcs = lookup_join(arcs, nxt, ["h"], "left")
    other = F.col("n1") + F.col("n2") - F.col("v")
    state = materialize(arcs.select("v", "h", F.when(F.col("n1").isNotNull(), F.col("h")).alias("pv"), F.when(F.col("n1").isNotNull(), other).alias("ph"), F.col("v").alias("low"), F.when(F.col("n1").isNull(), F.col("h")).alias("end"), F.lit(False).alias("ring")))
    while not state.filter("pv IS NOT NULL").isEmpty():
        ahead = state.select(F.col("v").alias("pv"), F.col("h").alias("ph"), F.col("pv").alias("qv"), F.col("ph").alias("qh"), F.col("low").alias("low2"), F.col("end").alias("end2"), F.col("ring").alias("ring2"))
        j = state.filter("pv IS NOT NULL").join(ahead, ["pv", "ph"])
        # two stretches with the same minimum overlap: the chain is a ring, seen whole
        ring = F.col("ring2") | (F.col("low") == F.col("low2"))
        j = j.select("v", "h", F.when(~ring, F.col("qv")).alias("pv"), F.when(~ring, F.col("qh")).alias("ph"), F.least("low", "low2").alias("low"), F.when(~ring, F.col("end2")).alias("end"), ring.alias("ring"))
        old, state = state, materialize(j.unionByName(state.filter("pv IS NULL")))
        release(old)
    ends = state.groupBy("v").agg(F.min("end").alias("e1"), F.max("end").alias("e2"), F.max("ring").alias("ring"), F.min("low").alias("low"))
    ends = materialize(ends)
    gone = ends.select("v", F.when(F.col("ring"), F.col("low")).otherwise(F.col("e1")).alias("parent")).filter("v <> parent")
    new = ends.filter("NOT ring AND e1 <> e2").select(F.col("e1").alias("a"), F.col("e2").alias("b"))
    # every edge with an end on a chain is an arc: by whole edges no hub is gathered
    on_chain = two.select("v", F.explode(F.array("n1", "n2")).alias("h")).select(F.least("v", "h").alias("a"), F.greatest("v", "h").alias("b"))
    out = materialize(e.join(on_chain, ["a", "b"], "left_anti").unionByName(new).distinct())
    release(state)
    return out, gone


def linked_groups(edges: DataFrame, src: str, dst: str, core_rows: int = LOCAL_EDGES) -> DataFrame:
    """(v, group): every vertex on an edge with the smallest vertex linked to it.

    Edges may be repeated, reversed or in any order; null ends and self-loops do not count,
    and a vertex that only has such edges does not come out. No edges give no rows. A core of
    at most ``core_rows`` counted edges is solved in one task, a larger one by star rounds, to the same groups.
    """
    e = materialize(clean_edges(edges, src, dst))
    left, links = e.count(), []
    while left:
        rest, gone = _strip(e)
        links.append(gone)
        release(e)
        e, n = rest, rest.count()
        if n:
            rest, gone = _compress(e)
            if gone is not None:
                links.append(gone)
                release(e)
                e, n = rest, rest.count()
        done, left = n == left or n <= core_rows, n
        if done:
            break
    if left:
        core = star_components(e, local_rows=core_rows)
        links.append(core.select("v", F.col("root").alias("parent")).filter("v <> parent"))
    if not links:
        return e.select(F.col("a").alias("v"), F.col("b").alias("group"))
    # what a vertex hangs on was removed later than itself, or is a root
    hung = links[0]
    for x in links[1:]:
        hung = hung.unionByName(x)
    hung = materialize(hung)
    for _ in range(len(links).bit_length()):
        over = hung.select(F.col("v").alias("parent"), F.col("parent").alias("next"))
        old, hung = hung, materialize(lookup_join(hung, over, ["parent"], "left").select("v", F.coalesce("next", "parent").alias("parent")))
        release(old)
    least = materialize(hung.groupBy(F.col("parent").alias("root")).agg(F.least(F.min("v"), F.col("root")).alias("group")))
    members = hung.select("v", F.col("parent").alias("root"))
    return lookup_join(members, least, ["root"]).select("v", "group").unionByName(least.select(F.col("root").alias("v"), "group"))
