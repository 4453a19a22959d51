"""Near neighbours of embeddings within a source, and what they prune."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, materialize
from .graph import clean_edges, star_components
from .ranking import running_sums, value_buckets


def sign_tables(threshold: float, recall: float, rows: int, most: int = 16) -> tuple[int, int]:
    """(tables, bits): hash tables of signs of random projections in which a pair at the threshold shares
    a bucket with probability ``recall``, at the most bits a bucket that ``most`` tables allow.

    (1, 0), one bucket, where the tables would not at least halve the pairs compared, or rows are few.
    """
    same = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    best = (1, 0)
    for bits in range(1, max(1, rows // 100).bit_length() + 1):
        hit = same**bits
        tables = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if tables <= most and tables / 2**bits < 0.5:
            best = (tables, bits)
    return best


def vector_classes(df: DataFrame, row_id: str, source: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(representatives, edges): the row of smallest id for every distinct vector of a source, and star
    edges (source, row_a, row_b, cosine, rank) from it to its exact copies."""
    rows = df.filter(F.col(row_id).isNotNull() & F.col(source).isNotNull() & F.col(vector).isNotNull())
    rows = rows.withColumn("__v", F.sha2(F.to_json(F.struct(F.col(vector))), 256))
    reps = materialize(rows.groupBy(source, "__v").agg(F.min(row_id).alias("__rep"), F.count("*").alias("__n")))
    copies = lookup_join(rows.select(row_id, source, "__v"), reps.filter("__n > 1").select(source, "__v", "__rep"), [source, "__v"])
    edges = copies.filter(F.col(row_id) > F.col("__rep")).select(source, F.col("__rep").alias("row_a"), F.col(row_id).alias("row_b"), F.lit(1.0).alias("cosine"), F.lit(1).alias("rank"))
    own = rows.join(reps.select(source, F.col("__rep").alias(row_id)), [source, row_id], "left_semi").drop("__v")
    return own, edges


def cosine_neighbours(df: DataFrame, row_id: str, source: str, vector: str, threshold: float, topk: int | None = None, recall: float | None = None, block: int = 4_000, seed: int = 7) -> DataFrame:
    """source, row_a, row_b, cosine, rank: pairs of a source at or above threshold, from either side.

    Every pair is found, or with ``recall`` a pair at the threshold with that probability and closer ones more
    surely: rows then meet only where the signs of some random projections agree (sign_tables). A bucket of more than
    ``block`` rows is cut into a grid of blocks that meet pairwise, each pair of blocks one matrix
    product. Rank counts from 1, self excluded, ties by the other id; with topk
    only ranks up to topk - 1 stay. Null ids, sources and vectors match nothing, nor do vectors of
    different length. Where vectors repeat, bring
    the representatives of vector_classes, so that copies aren't paired with each other.
    """
    rows = df.select(F.col(row_id).alias("id"), F.col(source).alias("src"), F.col(vector).alias("v")).filter("id IS NOT NULL AND src IS NOT NULL AND v IS NOT NULL")
    kinds = dict(rows.dtypes)
    tables, bits = 1, 0
    if recall is not None:
        largest = rows.groupBy("src").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
        tables, bits = sign_tables(threshold, recall, largest)

    def coded(batches):
        import numpy as np

        planes: dict = {}
        for pdf in batches:
            out = np.zeros((len(pdf), tables), dtype=np.int64)
            for dim in set(map(len, pdf["v"])):
                at = np.flatnonzero([len(v) == dim for v in pdf["v"]])
                if dim not in planes:
                    planes[dim] = np.random.default_rng(seed).normal(size=(dim, tables * bits))
                signs = np.stack(pdf["v"].iloc[at]).astype(float) @ planes[dim] > 0
                out[at] = signs.reshape(len(at), tables, bits) @ (1 << np.arange(bits))
            yield pdf.assign(codes=list(out))

    schema = f"id {kinds['id']}, src {kinds['src']}, v {kinds['v']}, codes array<bigint>"
    rows = materialize(rows.mapInPandas(coded, schema) if bits else rows.withColumn("codes", F.array(F.lit(0).cast("bigint"))))
    keys = ["src", "dim", "t", "code"]
    where = rows.select("src", "id", F.size("v").alias("dim"), F.posexplode("codes").alias("t", "code"))
    hot = where.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("n")).filter("n > 1")
    each = rows.select("id", "src", "v", "codes", F.size("v").alias("dim"), F.posexplode("codes").alias("t", "code"))
    each = lookup_join(each, hot, keys, "left").withColumn("n", F.coalesce("n", F.lit(1)))
    each = each.withColumn("i", F.pmod(F.xxhash64("id"), F.col("n")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    each = each.select(*keys, F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "id", "v", "codes")

    def meet(key, pdf):
        import numpy as np
        import pandas as pd

        src, table, lo, hi = key[0], int(key[2]), key[-2], key[-1]
        v = np.stack(pdf["v"]).astype(float)
        v /= np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-12)
        codes, ids, i = np.stack(pdf["codes"]), pdf["id"].to_numpy(), pdf["i"].to_numpy()
        left, right = (np.arange(len(v)),) * 2 if lo == hi else (np.flatnonzero(i == lo), np.flatnonzero(i == hi))
        parts = []
        for k in range(0, len(left), 1_000):
            x = left[k : k + 1_000]
            cosine = v[x] @ v[right].T
            a, b = np.nonzero(cosine >= threshold)
            if lo == hi:
                a, b = a[b > a + k], b[b > a + k]
            c, a, b = cosine[a, b], x[a], right[b]
            new = ~(codes[a, :table] == codes[b, :table]).any(axis=1)  # else an earlier table has it
            parts.append(pd.DataFrame({"row_a": ids[a[new]], "row_b": ids[b[new]], "cosine": c[new]}))
        out = pd.concat(parts)
        return pd.concat([out, out.rename(columns={"row_a": "row_b", "row_b": "row_a"})])[["row_a", "row_b", "cosine"]].assign(src=src)

    pairs = each.groupBy(*keys, "lo", "hi").applyInPandas(meet, f"row_a {kinds['id']}, row_b {kinds['id']}, cosine double, src {kinds['src']}")
    w = Window.partitionBy("src", "row_a").orderBy(F.desc("cosine"), "row_b")
    out = pairs.withColumn("rank", F.row_number().over(w)).select(F.col("src").alias(source), "row_a", "row_b", "cosine", "rank")
    return out if topk is None else out.filter(F.col("rank") <= max(2, topk) - 1)


def member_neighbours(reps: DataFrame, neighbours: DataFrame, copies: DataFrame, row_id: str, source: str, topk: int) -> DataFrame:
    """cosine_neighbours of all rows from those of the representatives with the same topk.

    reps, copies: of vector_classes. Exact copies have cosine 1. Of a class only its first rows can be
    among the nearest of another row, and all rows of a class choose from one list of topk rows.
    """
    keep = max(2, topk) - 1
    members = reps.select(source, F.col(row_id).alias("rep"), F.col(row_id).alias("id")).unionByName(copies.select(source, F.col("row_a").alias("rep"), F.col("row_b").alias("id")))
    members = materialize(members)
    place = F.row_number().over(Window.partitionBy(source, "rep").orderBy("id"))
    firsts = materialize(members.withColumn("__p", place).filter(F.col("__p") <= keep + 1).drop("__p"))
    pairs = neighbours.select(source, F.col("row_a").alias("rep_a"), F.col("row_b").alias("rep"), "cosine")
    pairs = pairs.unionByName(reps.select(source, F.col(row_id).alias("rep_a"), F.col(row_id).alias("rep"), F.lit(1.0).alias("cosine")))
    pairs = lookup_join(pairs, firsts, [source, "rep"]).select(source, F.col("rep_a").alias("rep"), F.col("id").alias("row_b"), "cosine")
    nearest = lambda a: Window.partitionBy(source, a).orderBy(F.desc("cosine"), "row_b")
    lists = materialize(pairs.withColumn("__p", F.row_number().over(nearest("rep"))).filter(F.col("__p") <= keep + 1).drop("__p"))
    out = lookup_join(members.withColumnRenamed("id", "row_a"), lists, [source, "rep"]).filter("row_a <> row_b")
    out = out.withColumn("rank", F.row_number().over(nearest("row_a"))).filter(F.col("rank") <= keep)
    return out.select(source, "row_a", "row_b", "cosine", "rank")


def semantic_edges(neighbours: DataFrame) -> DataFrame:
    """Each pair once: kept where the smaller id lists the larger."""
    return neighbours.filter("row_a < row_b")


def tier(rows: Column, tiers: Sequence[Mapping[str, float]]) -> Column:
    """Struct of cosine_threshold and topk of the largest tier that rows reach, else of the smallest."""
    ordered = sorted(tiers, key=lambda t: t["min_rows"])
    rule = lambda t: F.struct(F.lit(float(t["cosine_threshold"])).alias("cosine_threshold"), F.lit(int(t["topk"])).alias("topk"))
    out = rule(ordered[0])
    for t in ordered[1:]:
        out = F.when(rows >= int(t["min_rows"]), rule(t)).otherwise(out)
    return out


def keep_budget(size: Column) -> Column:
    """Records kept of a semantic component: 1 up to four, 2 up to sixteen, else 3."""
    return F.when(size <= 4, 1).when(size <= 16, 2).otherwise(3)


def semantic_components(rows: DataFrame, edges: DataFrame, row_id: str, source: str) -> DataFrame:
    """rows with semantic_component_id, its size and rank in the component's keep order.

    Components are numbered within their source by smallest member: ``sem:source:0000000``. Kept
    are the first keep_budget(size) by area, sample weight and path.
    """
    found = materialize(star_components(clean_edges(edges, "row_a", "row_b")).select(F.col("v").alias(row_id), F.col("root").alias("__r")))
    out = rows.join(found, row_id, "left").withColumn("__r", F.coalesce("__r", row_id))
    sizes = out.groupBy(source, "__r").agg(F.count("*").alias("semantic_component_size"))
    ranged, b = value_buckets(materialize(sizes).withColumn("__d", F.col("__r").cast("double")), "__d")
    ids = running_sums(ranged, [source], F.col(b), [F.col("__r")], {"__n": F.lit(1).cast("bigint")})
    ids = materialize(ids.select(source, "__r", "semantic_component_size", F.format_string("sem:%s:%07d", source, F.col("__n") - 1).alias("semantic_component_id")))
    out = lookup_join(out, ids, [source, "__r"])
    area = F.coalesce("width", F.lit(0)).cast("bigint") * F.coalesce("height", F.lit(0))
    out = materialize(out.drop("__r"))
    # at most three rows of a component are kept, so every partition cuts it to three before it is gathered
    w = Window.partitionBy("semantic_component_id").orderBy(area.desc(), F.desc_nulls_last("sample_weight"), "path", row_id)
    first = out.withColumn("__rank", F.row_number().over(w)).filter("__rank <= 3").filter(F.col("__rank") <= keep_budget(F.col("semantic_component_size")))
    out = lookup_join(out, first.select(row_id, F.lit(1).alias("__kept")), [row_id], "left")
    kept = F.coalesce("__kept", F.lit(0))
    return out.withColumn("keep_stage2_semantic", kept).withColumn("drop_stage2_semantic", 1 - kept).drop("__kept")


def tight_units(rows: DataFrame, edges: DataFrame, row_id: str, base: str) -> DataFrame:
    """(base, tight_root): base components that semantic edges connect, by their smallest text id.

    Rows of no edge keep their own base component.
    """
    of = rows.select(F.col(row_id).alias("row_a"), F.col(base).alias("ca"))
    e = edges.select("row_a", "row_b").join(of, "row_a").join(of.select(F.col("row_a").alias("row_b"), F.col("ca").alias("cb")), "row_b")
    names = materialize(rows.select(base).filter(F.col(base).isNotNull()).distinct().withColumn("n", F.xxhash64(base)))
    linked = star_components(clean_edges(e.select(F.xxhash64("ca").alias("a"), F.xxhash64("cb").alias("b")), "a", "b")).select(F.col("v").alias("n"), "root")
    out = names.join(linked, "n", "left").withColumn("root", F.coalesce("root", "n"))
    least = materialize(out.groupBy("root").agg(F.min(base).alias("tight_root")))
    return lookup_join(out, least, ["root"]).select(base, "tight_root")


def focus_sources(ratios: DataFrame, source: str, explicit: Sequence[str], min_clean: int = 100_000, max_removed: float = 0.05, auto: bool = True) -> DataFrame:
    """Sources to look at: the explicit ones, and those with enough clean rows of which few were removed."""
    chosen = F.col(source).isin(list(explicit)) if explicit else F.lit(False)
    if auto:
        chosen = chosen | ((F.col("clean_rows") >= min_clean) & (F.col("removed_ratio") <= max_removed))
    return ratios.filter(chosen).select(source)


def semantic_pool(rows: DataFrame, seen_only: bool = True, skip_hints: Sequence[str] = ("unseen", "test_unseen"), skip_datasets: Sequence[str] = (), skip_sources: Sequence[str] = ()) -> DataFrame:
    """Rows that may be pruned: hints in skip_hints only count with seen_only; null names are ``unknown``."""
    from ..functions.text import split_hint, text_or

    out = rows
    if seen_only and skip_hints:
        out = out.filter(~split_hint("split_hint").isin(*skip_hints))
    if skip_datasets:
        out = out.filter(~text_or("dataset").isin(*skip_datasets))
    return out.filter(~text_or("source").isin(*skip_sources)) if skip_sources else out


def semantic_index(rows: DataFrame, pool: DataFrame, edges: DataFrame, row_id: str, base: str, source: str = "source") -> DataFrame:
    """rows with semantic_component_id, its size, tight_split_component_id, keep_ and drop_stage2_semantic.

    pool: the rows that were compared; all others are singletons and kept. Tight ids number the
    base components that edges connect, in an order of their hashes: ``tight:000000000``.
    """
    from .ranking import dense_ids

    inside = semantic_components(pool, edges, row_id, source).select(row_id, "semantic_component_id", "semantic_component_size", "keep_stage2_semantic")
    tight = tight_units(rows, edges, row_id, base)
    roots = tight.select("tight_root").distinct().withColumn("n", F.xxhash64("tight_root"))
    ids = materialize(dense_ids(materialize(roots), "n", "tight:%09d", "tight_split_component_id").join(roots, "n").select("tight_root", "tight_split_component_id"))
    names = materialize(lookup_join(tight, ids, ["tight_root"]).select(base, "tight_split_component_id"))
    out = rows.join(materialize(inside), row_id, "left")
    out = lookup_join(out, names, [base], "left")
    return out.withColumns({
        "semantic_component_id": F.coalesce("semantic_component_id", F.format_string("sem:singleton:%09d", row_id)),
        "semantic_component_size": F.coalesce("semantic_component_size", F.lit(1)),
        "keep_stage2_semantic": F.coalesce("keep_stage2_semantic", F.lit(1)),
    }).withColumn("drop_stage2_semantic", 1 - F.col("keep_stage2_semantic"))
