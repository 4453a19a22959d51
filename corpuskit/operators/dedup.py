"""Edges between duplicates, components, and the record each component keeps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import band, hamming, hash_to_long, log_aspect, mean_difference, thumb_bytes
from ..functions.text import split_hint
from .common import lookup_join, materialize
from .graph import clean_edges, star_components
from .ranking import dense_ids

EDGE = ("src_idx", "dst_idx", "reason", "score", "stage")


def _edge(src: str, dst: str, reason: Column | str, score: Column | str = "", stage: Column | str = "dedup") -> list[Column]:
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return [F.col(src).alias("src_idx"), F.col(dst).alias("dst_idx"), text(reason).alias("reason"), text(score).alias("score"), text(stage).alias("stage")]


def star_edges(df: DataFrame, row_id: str, keys: list[str], groups: DataFrame, reason: str, stage: str) -> DataFrame:
    """Edges from each group's smallest id (``anchor`` in groups) to its other rows."""
    rows = lookup_join(df.select(row_id, *keys), groups.select(*keys, "anchor"), keys)
    return rows.filter(F.col(row_id) > F.col("anchor")).select(*_edge("anchor", row_id, reason, "", stage))


def exact_edges(df: DataFrame, row_id: str, hashes: Mapping[str, str]) -> DataFrame:
    """Star edges between rows with the same non-blank hash; hashes: column -> reason. Labels are not looked at."""
    out = None
    for column, reason in hashes.items():
        known = df.filter(F.trim(column) != "")
        groups = materialize(known.groupBy(column).agg(F.min(row_id).alias("anchor"), F.count("*").alias("n")).filter("n > 1"))
        part = star_edges(known, row_id, [column], groups, reason, "dedup")
        out = part if out is None else out.unionByName(part)
    return out


def pair_lock_edges(df: DataFrame, row_id: str, reason: str = "pair_lock") -> DataFrame:
    """Star edges within a pair_group and content_id that holds both labels and no other."""
    known = df.filter("pair_group <> '' AND content_id <> ''")
    g = known.groupBy("pair_group", "content_id").agg(F.min(row_id).alias("anchor"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.when(~F.col("label").isin(0, 1), 1)).alias("odd"))
    groups = materialize(g.filter("lo = 0 AND hi = 1 AND odd = 0"))
    return star_edges(known, row_id, ["pair_group", "content_id"], groups, reason, "split_lock")


def prompt_lock_edges(df: DataFrame, row_id: str, dataset: str, max_size: int = 64, reason: str = "stem_lock") -> DataFrame:
    """Star edges within a prompt_group of 2 to ``max_size`` rows from more than one generator."""
    known = df.filter((F.col("prompt_group") != "") & (F.lower("dataset") == dataset))
    gen = F.coalesce("generator", F.lit("nan"))
    g = known.groupBy("prompt_group").agg(F.min(row_id).alias("anchor"), F.count("*").alias("n"), F.min(gen).alias("lo"), F.max(gen).alias("hi"))
    groups = materialize(g.filter((F.col("n") > 1) & (F.col("n") <= max_size) & (F.col("lo") != F.col("hi"))))
    return star_edges(known, row_id, ["prompt_group"], groups, reason, "split_lock")


def lsh_candidates(df: DataFrame, row_id: str, bits: str, band_bits: int = 16, max_bucket: int | None = 256) -> DataFrame:
    """(a, b), a < b: distinct pairs that share a band of the 64-bit column.

    Bands held by more than ``max_bucket`` ids are left out (None: none are); the caller brings
    distinct values, so exact copies never pair with each other here.
    """
    bands = max(1, 64 // max(1, band_bits))
    each = df.filter(F.col(bits).isNotNull()).select(F.col(row_id).alias("id"), F.explode(F.array(*[F.struct(F.lit(k).alias("k"), band(F.col(bits), k, band_bits).alias("v")) for k in range(bands)])).alias("x")).select("id", "x.k", "x.v")
    sizes = each.groupBy("k", "v").agg(F.count("*").alias("n")).filter("n > 1")
    if max_bucket is not None:
        sizes = sizes.filter(F.col("n") <= max_bucket)
    kept = each.join(sizes.select("k", "v"), ["k", "v"])
    left, right = kept.withColumnRenamed("id", "a"), kept.withColumnRenamed("id", "b")
    return left.join(right, ["k", "v"]).filter("a < b").select("a", "b").distinct()


def _shared_band(a: Column, b: Column, band_bits: int) -> Column:
    """Whether two hashes agree in one of their bands."""
    x, n = a.bitwiseXOR(b), max(1, 64 // max(1, band_bits))
    out = F.lit(False)
    for k in range(n):
        out = out | (F.shiftrightunsigned(x, k * band_bits).bitwiseAND(F.lit((1 << band_bits) - 1 if band_bits < 64 else -1)) == 0)
    return out


def hamming_pairs(classes: DataFrame, limits: Mapping[str, int], cell: int = 50_000) -> DataFrame:
    """(a, b), a < b, once each: all pairs of ``rep`` whose 64-bit columns differ in at most ``limits[column]``
    bits, in one column or another. Null values are near nothing.

    Of limit + 1 stretches of a column one agrees; rows are sent to the values of their stretches, several
    values to a task, and compared there in NumPy. A value held by more than ``cell`` rows is cut into a
    grid of blocks that meet pairwise. A pair comes out where its first common stretch is.
    """
    cuts = {c: [round(i * 64 / (bits + 1)) for i in range(bits + 2)] for c, bits in limits.items()}
    names = list(limits)
    parts, kinds = [], []
    for c in names:
        for i, (low, high) in enumerate(zip(cuts[c], cuts[c][1:])):
            p = F.shiftrightunsigned(F.col(c), low).bitwiseAND(F.lit((1 << (high - low)) - 1 if high - low < 64 else -1))
            parts.append(F.struct(F.lit(len(kinds)).alias("t"), p.alias("p")))
            kinds.append((c, i))
    values = [F.coalesce(c, F.lit(0)).alias(c) for c in names] + [F.col(c).isNotNull().alias(f"known_{c}") for c in names]
    held = [*names, *(f"known_{c}" for c in names)]
    each = classes.select("rep", *values, F.array(*parts).alias("__s")).select("rep", *held, F.explode("__s").alias("__s")).select("rep", *held, "__s.t", "__s.p").filter("p IS NOT NULL")
    hot = materialize(each.groupBy("t", "p").agg(F.ceil(F.count("*") / cell).cast("int").alias("n")).filter("n > 1"))
    shards = max(1, classes.count() // 2_000)
    each = lookup_join(each, hot, ["t", "p"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    own = F.pmod(F.xxhash64("rep"), F.col("n")).cast("int")
    each = each.withColumn("i", own).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    shard = F.when(F.col("n") > 1, F.col("p") + shards).otherwise(F.pmod("p", F.lit(shards)))
    each = each.select("t", shard.alias("shard"), F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "p", "rep", *held)

    def scan(key, pdf):
        import numpy as np
        import pandas as pd

        t, _, lo, hi = (int(k) for k in key)
        column, place = kinds[t]
        h = {c: pdf[c].to_numpy(np.int64).view(np.uint64) for c in names}
        rep, block, p = pdf["rep"].to_numpy(), pdf["i"].to_numpy(), pdf["p"].to_numpy()
        order = np.argsort(p, kind="stable")
        starts = np.append(np.flatnonzero(np.r_[True, p[order][1:] != p[order][:-1]]), len(p))
        found = []
        for s, e in zip(starts, starts[1:]):
            rows = order[s:e]
            left, right = (rows, rows) if lo == hi else (rows[block[rows] == lo], rows[block[rows] == hi])
            step = max(1, 4_000_000 // max(1, len(right)))
            for k in range(0, len(left), step):
                x = left[k : k + step]
                near = np.bitwise_count(h[column][x][:, None] ^ h[column][right][None, :]) <= limits[column]
                u, v = np.nonzero(near)
                if lo == hi:
                    u, v = u[v > u + k], v[v > u + k]
                u, v = x[u], right[v]
                # found before: by an earlier column, or an earlier stretch of this one
                new = np.ones(len(u), dtype=bool)
                for c in names[: names.index(column)]:
                    known = pdf["known_" + c].to_numpy()
                    new &= (np.bitwise_count(h[c][u] ^ h[c][v]) > limits[c]) | ~(known[u] & known[v])
                apart = h[column][u] ^ h[column][v]
                for low, high in list(zip(cuts[column], cuts[column][1:]))[:place]:
                    new &= (apart >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1) != 0
                found.append(np.stack([rep[u[new]], rep[v[new]]]))
        out = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
        return pd.DataFrame({"a": out.min(axis=0), "b": out.max(axis=0)}).astype("int64")

    return each.groupBy("t", "shard", "lo", "hi").applyInPandas(scan, "a bigint, b bigint")


def near_edges(
    df: DataFrame,
    row_id: str = "row_idx",
    phash_bits: int = 8,
    dhash_bits: int = 6,
    max_difference: float = 6.0,
    aspect: float = 0.12,
    cross_label: bool = False,
    report_bits: int = 4,
    band_bits: int | None = None,
    max_bucket: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(edges, members) of near-duplicate pictures.

    Readable rows with the same hashes, thumbnail, size and label form a class, represented by
    the smallest id; members is (row_idx, rep). Edges link all representatives within the limits: same
    label near_hash, another label near_hash_cross_label if ``cross_label``, else
    suspicious_cross_label_near within ``report_bits``. With ``band_bits`` pairs must also share a band of so many
    bits of phash64, which loses some; with ``max_bucket`` too, not one held by more classes.
    """
    ok = df.filter((F.col("read_ok") == 1) & hash_to_long("phash64").isNotNull())
    facts = ["phash64", "dhash64", "thumb8_hex", "width", "height", "label"]
    ok = ok.select(F.col(row_id).alias("id"), F.lower(F.trim("phash64")).alias("phash64"), F.lower(F.trim("dhash64")).alias("dhash64"), F.lower(F.trim("thumb8_hex")).alias("thumb8_hex"), "width", "height", "label")
    classes = materialize(ok.groupBy(*facts).agg(F.min("id").alias("rep")))
    members = lookup_join(ok, classes, facts).select(F.col("id").alias(row_id), "rep")
    c = materialize(classes.select("rep", "label", hash_to_long("phash64").alias("ph"), hash_to_long("dhash64").alias("dh"), thumb_bytes("thumb8_hex").alias("thumb"), log_aspect("width", "height").alias("la")))
    if band_bits and max_bucket:
        pairs = lsh_candidates(c, "rep", "ph", band_bits, max_bucket)
    else:
        pairs = hamming_pairs(c, {"ph": max(phash_bits, report_bits), "dh": max(dhash_bits, report_bits - 2, 1)})
    a, b = (c.select(*[F.col(x).alias(f"{s}_{x}") for x in c.columns]) for s in "ab")
    j = pairs.join(a, F.col("a") == F.col("a_rep")).join(b, F.col("b") == F.col("b_rep")).filter(F.abs(F.col("a_la") - F.col("b_la")) <= aspect)
    if band_bits and not max_bucket:
        j = j.filter(_shared_band(F.col("a_ph"), F.col("b_ph"), band_bits))
    ph, dh = hamming(F.col("a_ph"), F.col("b_ph")), hamming(F.col("a_dh"), F.col("b_dh"))
    j = j.withColumns({"ph": ph, "dh": dh, "mae": mean_difference(F.col("a_thumb"), F.col("b_thumb"))}).filter(F.col("mae") <= max_difference)
    close = (F.col("ph") <= phash_bits) | (F.col("dh") <= dhash_bits)
    report = (F.col("ph") <= report_bits) | (F.col("dh") <= max(1, report_bits - 2))
    same = F.col("a_label") == F.col("b_label")
    reason = F.when(same & close, "near_hash").when(~same & close & F.lit(cross_label), "near_hash_cross_label").when(~same & report, "suspicious_cross_label_near")
    stage = F.when(F.col("reason").startswith("suspicious"), "suspicious").otherwise("dedup")
    j = j.withColumn("reason", reason).filter("reason IS NOT NULL")
    score = F.format_string("ph=%d,dh=%d,mae=%.2f", "ph", "dh", F.bround("mae", 2))
    return j.select(*_edge("a", "b", F.col("reason"), score, stage)), members


def member_edges(members: DataFrame, row_id: str = "row_idx") -> DataFrame:
    """Star edges from each class representative to its other members."""
    return members.filter(F.col(row_id) > F.col("rep")).select(*_edge("rep", row_id, "near_hash", "ph=0,dh=0,mae=0.00", "dedup"))


def canonical_order(row_id: str) -> Column:
    """Rank of a record among its duplicates, smallest first: unseen, wide, high, large, path."""
    neg = lambda c: -F.coalesce(F.col(c), F.lit(-1)).cast("bigint")
    return F.struct(F.when(split_hint("split_hint") == "unseen", 0).otherwise(1).alias("p"), neg("width").alias("w"), neg("height").alias("h"), neg("file_size_bytes").alias("s"), F.col("path").alias("path"), F.col(row_id).alias("id"))


def apply_edges(df: DataFrame, edges: DataFrame, row_id: str = "row_idx") -> DataFrame:
    """df with both component labelings, their statistics, the canonical record and drop reason.

    Edges of stage dedup make duplicate components, with split_lock edges added split components;
    suspicious edges link nothing. A component of both labels is dropped as label_conflict, which
    overrides read_error; other copies are duplicate_noncanonical.
    """
    out = df
    for kind, stages in (("dedup", ["dedup"]), ("split", ["dedup", "split_lock"])):
        own = edges.filter(F.col("stage").isin(stages))
        found = materialize(star_components(clean_edges(own, "src_idx", "dst_idx")).select(F.col("v").alias(row_id), F.col("root").alias("__r")))
        out = out.join(found, row_id, "left").withColumn(f"{kind}_root", F.coalesce("__r", row_id)).drop("__r")
    out = materialize(out.withColumn("__hint", split_hint("split_hint")).withColumn("__order", canonical_order(row_id)))
    stats = out.groupBy("dedup_root").agg(
        F.count("*").cast("int").alias("dedup_component_size"),
        (F.min("label") < F.max("label")).cast("int").alias("has_label_conflict"),
        (F.min("__hint") < F.max("__hint")).cast("int").alias("cross_split_duplicate"),
        F.min("__order").alias("__first"),
    )
    stats = stats.withColumns({"canonical_path": F.col("__first.path"), "__canonical": F.col("__first.id")}).drop("__first")
    stats = materialize(stats.join(dense_ids(out, "dedup_root", "dedup_%08d", "dedup_component_id"), "dedup_root"))
    sizes = materialize(out.groupBy("split_root").agg(F.count("*").cast("int").alias("split_component_size")).join(dense_ids(out, "split_root", "split_%08d", "split_component_id"), "split_root"))
    out = lookup_join(lookup_join(out, stats, ["dedup_root"]), sizes, ["split_root"])
    conflict, readable = F.col("has_label_conflict") == 1, F.coalesce(F.col("read_ok") == 1, F.lit(False))
    out = out.withColumn("is_canonical", (F.col(row_id) == F.col("__canonical")).cast("int"))
    reason = F.when(conflict, "label_conflict").when(~readable, "read_error").when((F.col("dedup_component_size") > 1) & (F.col("is_canonical") == 0), "duplicate_noncanonical").otherwise("")
    out = out.withColumn("dedup_drop_reason", reason)
    return out.withColumn("keep_after_dedup", (F.col("dedup_drop_reason") == "").cast("int")).drop("__hint", "__order", "__canonical")


def edge_table(edges: DataFrame, rows: DataFrame, row_id: str = "row_idx") -> DataFrame:
    """Edges with path, source, label and component ids of both ends."""
    facts = ["path", "source", "label", "dedup_component_id", "split_component_id"]
    out = edges
    for side in ("src", "dst"):
        own = rows.select(F.col(row_id).alias(f"{side}_idx"), *[F.col(c).alias(f"{side}_{c}") for c in facts if c in rows.columns])
        out = out.join(own, f"{side}_idx")
    return out


def edge_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("stage", "reason").agg(F.count("*").alias("edges"))


def rebucket_flat(df: DataFrame, path: str = "path", threshold: int = 3, buckets: int = 128) -> DataFrame:
    """group_token and group_id of sources with at most ``threshold`` distinct tokens spread over
    hash buckets of the path; other sources and null sources keep theirs."""
    from ..functions.hashing import hash_bucket

    flat = materialize(df.groupBy("source").agg(F.countDistinct("group_token").alias("n")).filter((F.col("n") <= threshold) & F.col("source").isNotNull()).select("source", F.lit(True).alias("__flat")))
    out = lookup_join(df, flat, ["source"], "left")
    token = F.when(F.col("__flat"), hash_bucket(path, buckets)).otherwise(F.col("group_token"))
    return out.withColumn("group_token", token).withColumn("group_id", F.when(F.col("__flat"), F.concat_ws(":", "source", "group_token")).otherwise(F.col("group_id"))).drop("__flat")
