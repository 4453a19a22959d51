"""Problem 6: records of evaluation splits that are also listed for training.

Normalised evaluation passages (a record's path, and the three segments of its 64-bit
picture hash with every variant that differs in one bit) are put into sharded Aho-Corasick
automata; the training records' passages are scanned by the shard they belong to. Two
hashes within five bits agree in at least one of three segments up to one bit, so no pair is
missed. Matched intervals are merged into the coverage of the evaluation record, and
hashes are then compared bit by bit. All matching is between distinct values, so a picture or
path listed a million times is matched once; rows are joined only at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.common import lookup_join, materialize, norm

#: Start bit and length of the segments, from the lowest bit.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 5
#: Distinct values of a shard, and of one side in one task; larger shards are cut into a grid.
SHARD_VALUES = 20_000
TASK_VALUES = 100_000
#: Rows of one hash or path that meet those of another in one task.
BLOCK_ROWS = 2_000


def hash_bits(c: Column) -> Column:
    """16 hexadecimal digits as BIGINT; null where blank or not hexadecimal."""
    c = F.trim(c)
    return F.when(c.rlike("^[0-9a-fA-F]{1,16}$"), F.conv(c, 16, -10).cast("bigint"))


def plain_path(c: Column) -> Column:
    """Runs of slashes and /./ as one slash."""
    return F.regexp_replace(c, r"/(?:\.?/)+", "/")


def hint(c: Column) -> Column:
    h = norm(c)
    return F.when(h.isNull() | (h == ""), "seen").otherwise(h)


def _segment(h: Column, k: int) -> Column:
    start, length = SEGMENTS[k]
    return F.shiftrightunsigned(h, start).bitwiseAND(F.lit((1 << length) - 1))


def _scan(key, evals, trains):
    """Pairs of one shard. key: (kind, shard bits, shard, ...); kind 0 to 2 a hash segment, 3 paths."""
    import ahocorasick
    import numpy as np
    import pandas as pd

    empty = pd.DataFrame({"e": pd.Series(dtype="int64"), "t": pd.Series(dtype="int64"), "distance": pd.Series(dtype="int32"), "coverage": pd.Series(dtype="float64"), "path": pd.Series(dtype="object")})
    if not len(evals) or not len(trains):
        return empty
    kind = int(key[0])
    automaton = ahocorasick.Automaton()
    if kind == 3:
        for p in evals["path"].tolist():
            automaton.add_word(f"\n{p}\n", p)
        automaton.make_automaton()
        found = [p for p in trains["path"].tolist() for _, p in automaton.iter(f"\n{p}\n")]
        return pd.DataFrame({"e": 0, "t": 0, "distance": 0, "coverage": 1.0, "path": found}).astype(empty.dtypes.to_dict()) if found else empty
    start, length = ((0, 22), (22, 21), (43, 21))[kind]
    low, shard = length - int(key[1]), int(key[2])
    eh, th = evals["h"].to_numpy(np.int64).view(np.uint64), trains["h"].to_numpy(np.int64).view(np.uint64)
    seg = lambda x, s, n: (x >> np.uint64(s)) & np.uint64((1 << n) - 1)
    own = (seg(eh, start, length) >> np.uint64(low)).astype(np.int64) == shard
    # in its own shard a hash comes with every flip of the lower bits, elsewhere with the flip that leads there
    base = seg(eh, start, length)
    moved = (base & np.uint64((1 << low) - 1)) | (np.uint64(shard) << np.uint64(low))
    ids, words = [np.arange(len(eh))], [moved]
    at = np.flatnonzero(own)
    for b in range(low):
        ids.append(at)
        words.append(base[at] ^ np.uint64(1 << b))
    ids, words = np.concatenate(ids), np.concatenate(words)
    o = np.argsort(words, kind="stable")
    ids, words = ids[o], words[o]
    first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    last = np.r_[first[1:], len(words)]
    for k, w in enumerate(words[first].tolist()):
        automaton.add_word("|%06x" % w, k)
    automaton.make_automaton()
    ts = seg(th, start, length)
    pairs = []
    step = 20_000
    for i in range(0, len(ts), step):
        text = "".join(["|%06x" % w for w in ts[i : i + step].tolist()])
        hits = np.array([(end // 7, k) for end, k in automaton.iter(text)], dtype=np.int64).reshape(-1, 2)
        many = last[hits[:, 1]] - first[hits[:, 1]]
        # candidates are looked at a few million at a time
        cuts = np.flatnonzero(np.diff(np.cumsum(many) // 4_000_000, prepend=0))
        for part in np.split(np.arange(len(hits)), cuts):
            n, found = many[part], hits[part]
            t = np.repeat(found[:, 0] + i, n)
            skip = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            e = ids[np.repeat(first[found[:, 1]], n) + skip]
            x = eh[e] ^ th[t]
            d = np.bitwise_count(x)
            ok = d <= 5
            e, t, x, d = e[ok], t[ok], x[ok], d[ok]
            # each pair comes out of the first segment that finds it; found segments make its coverage
            near = [np.bitwise_count(seg(x, s, m)) <= 1 for s, m in ((0, 22), (22, 21), (43, 21))]
            ok = near[kind].copy()
            for j in range(kind):
                ok &= ~near[j]
            covered = sum(f * m for f, m in zip(near, (22, 21, 21))) / 64.0
            pairs.append(pd.DataFrame({"e": eh[e[ok]].view(np.int64), "t": th[t[ok]].view(np.int64), "distance": d[ok].astype("int32"), "coverage": covered[ok], "path": None}))
    out = pd.concat(pairs) if pairs else empty
    return out.drop_duplicates(["e", "t"]).astype({"path": "object"})


def _pieces(values: DataFrame, evaluation: bool, bits: int) -> DataFrame:
    """Passages of distinct hashes with the shards they are sent to: a segment's highest
    ``bits`` choose its shard, and an evaluation hash also goes where one of them flipped leads."""
    parts = []
    for k, (_, length) in enumerate(SEGMENTS):
        top = F.shiftrightunsigned(_segment(F.col("h"), k), length - bits)
        tops = [top] + ([top.bitwiseXOR(F.lit(1 << b)) for b in range(bits)] if evaluation else [])
        parts += [F.struct(F.lit(k).alias("kind"), t.cast("bigint").alias("shard")) for t in tops]
    return values.filter("h IS NOT NULL").select("h", F.explode(F.array(*parts)).alias("x")).select(F.col("x.kind").alias("kind"), F.col("x.shard").alias("shard"), "h", F.lit(None).cast("string").alias("path"))


def _grid(sides: list[DataFrame], task_values: int) -> list[DataFrame]:
    """Both sides with grid columns i and j: a shard above ``task_values`` on a side is cut there, and
    the other side sent to every cut, so that no task holds more."""
    sizes = [materialize(s.groupBy("kind", "shard").agg(F.ceil(F.count("*") / task_values).cast("int").alias(c)).filter(F.col(c) > 1)) for s, c in zip(sides, "ij")]
    if all(s.isEmpty() for s in sizes):
        return [s.withColumns({"i": F.lit(0), "j": F.lit(0)}) for s in sides]
    out = []
    for own, s in zip("ij", sides):
        for c, size in zip("ij", sizes):
            s = lookup_join(s, size.withColumnRenamed(c, f"n_{c}"), ["kind", "shard"], "left")
            n = F.coalesce(f"n_{c}", F.lit(1))
            spot = F.pmod(F.xxhash64("h", "path"), n).cast("int")
            s = s.withColumn(c, spot) if c == own else s.withColumn(c, F.explode(F.sequence(F.lit(0), n - 1)))
        out.append(materialize(s.drop("n_i", "n_j")))
    return out


def cross_split_matches(rows: DataFrame, row_id: str, path: str, phash: str, split: str, shard_values: int = SHARD_VALUES, task_values: int = TASK_VALUES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, hash pairs, paths): the prepared rows, (e, t, distance, coverage) between
    distinct evaluation and training hashes, and the distinct paths on both sides.

    A row is for training where its split hint is ``seen``, null or blank. Rows without an id
    are left out; null or blank paths and hashes, and hashes that are not hexadecimal, match
    nothing; repeated rows count as rows. An empty table gives empty results. The number of shards
    follows the counted rows.
    """
    r = rows.select(F.col(row_id).alias("id"), plain_path(F.col(path)).alias("p"), hash_bits(F.col(phash)).alias("h"), hint(F.col(split)).alias("split")).filter("id IS NOT NULL")
    r = materialize(r.select("id", F.when(F.trim("p") != "", F.col("p")).alias("p"), "h", "split", (F.col("split") == "seen").alias("train")))
    wanted = max(1, r.count() // shard_values)
    bits = max(3, min(18, wanted.bit_length()))
    sides = []
    for evaluation in (True, False):
        own = r.filter(~F.col("train") if evaluation else F.col("train"))
        texts = own.filter("p IS NOT NULL").select("p").distinct()
        texts = texts.select(F.lit(3).alias("kind"), F.pmod(F.xxhash64("p"), F.lit(wanted + 8)).cast("bigint").alias("shard"), F.lit(None).cast("bigint").alias("h"), F.col("p").alias("path"))
        sides.append(_pieces(own.select("h").distinct(), evaluation, bits).unionByName(texts).withColumn("bits", F.lit(bits)))
    at = ["kind", "bits", "shard", "i", "j"]
    ev, tr = _grid(sides, task_values)
    found = ev.groupBy(*at).cogroup(tr.groupBy(*at)).applyInPandas(_scan, "e bigint, t bigint, distance int, coverage double, path string")
    found = materialize(found)
    return r, found.filter("path IS NULL").drop("path"), found.filter("path IS NOT NULL").select(F.col("path").alias("p"))


def row_pairs(pairs: DataFrame, ev: DataFrame, tr: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """(ei, ti) of every (e, t) pair of values, the rows (e, ei) of the one and (t, ti) of the other.

    Only rows of paired values are moved. A value held by more than ``block`` rows is cut
    into blocks, and each block of one side meets each of the other in a task of its own.
    """
    pairs = materialize(pairs.select("e", "t"))
    sides, cuts = [], []
    for rows, value, row, n in ((ev, "e", "ei", "ni"), (tr, "t", "ti", "nj")):
        own = materialize(lookup_join(rows.select(value, row), pairs.select(value).distinct(), [value], "left_semi"))
        cuts.append(materialize(own.groupBy(value).agg(F.ceil(F.count("*") / block).cast("int").alias(n)).filter(F.col(n) > 1)))
        sides.append(own)
    if all(c.isEmpty() for c in cuts):
        return pairs.join(sides[0], "e").join(sides[1], "t").select("ei", "ti")
    blocks = lambda df, k: lookup_join(df, cuts[k], ["et"[k]], "left").fillna(1, ["ni", "nj"][k])
    grid = materialize(blocks(blocks(pairs, 0), 1))
    plain = grid.filter("ni = 1 AND nj = 1").join(sides[0], "e").join(sides[1], "t").select("ei", "ti")
    cells = grid.filter("ni > 1 OR nj > 1").select("e", "t", "nj", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)).alias("i"))
    cells = materialize(cells.select("e", "t", "i", F.explode(F.sequence(F.lit(0), F.col("nj") - 1)).alias("j")))
    left = blocks(sides[0], 0).withColumn("i", F.pmod(F.xxhash64("ei"), F.col("ni")).cast("int")).drop("ni")
    right = blocks(sides[1], 1).withColumn("j", F.pmod(F.xxhash64("ti"), F.col("nj")).cast("int")).drop("nj")
    hot = cells.join(left, ["e", "i"]).join(cells.join(right, ["t", "j"]), ["e", "t", "i", "j"]).select("ei", "ti")
    return plain.unionByName(hot)


def cross_split_pairs(rows: DataFrame, row_id: str, path: str, phash: str, split: str, block: int = BLOCK_ROWS) -> DataFrame:
    """(row_idx_a, row_idx_b), the smaller first: every pair of an evaluation and a training
    row with the same path or hashes within five bits."""
    r, hashes, paths = cross_split_matches(rows, row_id, path, phash, split)
    ev, tr = r.filter("NOT train"), r.filter("train")
    by_hash = row_pairs(hashes, ev.select(F.col("h").alias("e"), F.col("id").alias("ei")), tr.select(F.col("h").alias("t"), F.col("id").alias("ti")), block)
    by_path = row_pairs(paths.select(F.col("p").alias("e"), F.col("p").alias("t")), ev.select(F.col("p").alias("e"), F.col("id").alias("ei")), tr.select(F.col("p").alias("t"), F.col("id").alias("ti")), block)
    both = by_hash.unionByName(by_path).select(F.least("ei", "ti").alias("row_idx_a"), F.greatest("ei", "ti").alias("row_idx_b"))
    return both.distinct()


def overlap_report(rows: DataFrame, row_id: str, path: str, phash: str, split: str, source: str) -> DataFrame:
    """split, source, rows, overlapping, mean_coverage of the evaluation rows.

    A row overlaps if its path or a near hash is listed for training; coverage is the largest
    merged share of its passages that a training record matches.
    """
    kept = rows.select(row_id, path, phash, split, norm(source).alias("__source"))
    r, hashes, paths = cross_split_matches(kept, row_id, path, phash, split)
    best = hashes.groupBy(F.col("e").alias("h")).agg(F.max("coverage").alias("hc"))
    named = kept.select(F.col(row_id).alias("id"), F.col("__source").alias("source"))
    ev = r.filter("NOT train").join(best, "h", "left").join(paths.withColumn("pc", F.lit(1.0)), "p", "left")
    ev = ev.select("id", "split", F.greatest(F.coalesce("hc", F.lit(0.0)), F.coalesce("pc", F.lit(0.0))).alias("c")).join(named, "id", "left")
    return ev.groupBy("split", "source").agg(F.count("*").alias("rows"), F.count(F.when(F.col("c") > 0, 1)).alias("overlapping"), F.round(F.avg("c"), 6).alias("mean_coverage"))
