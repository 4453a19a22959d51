"""Core operators against brute force, with nulls, ties, repeats and empty tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from corpuskit.operators import allocate as A
from corpuskit.operators import dedup as D
from corpuskit.operators import graph as G
from corpuskit.operators import metrics as M
from corpuskit.operators import mining as N
from corpuskit.operators import ranking as R
from corpuskit.operators import semantic as X
from corpuskit.operators import skew as K
from corpuskit.operators import splits as P
from corpuskit.operators import summary as S
from corpuskit.operators import weights as W
from corpuskit.operators.common import lookup_join, ranked


@pytest.mark.parametrize("limit,hot", [(0, 1), (0, 500_000), (200_000, 1)])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join(spark, rows, limit, hot, how):
    left = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4), ("c", 5)], "k string, salt int")
    right = spark.createDataFrame([("a", "x"), (None, "n"), ("d", "y")], "k string, v string")
    got = rows(lookup_join(left, right if how in ("inner", "left") else right.select("k"), ["k"], how, limit=limit, hot=hot))
    match = [("a", 1, "x"), ("a", 2, "x"), (None, 3, "n")]
    rest = [("b", 4), ("c", 5)]
    want = {"inner": match, "left": match + [(*r, None) for r in rest], "left_semi": [r[:2] for r in match], "left_anti": rest}[how]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_materialize_untyped_columns(spark, rows):
    from corpuskit.operators.common import materialize, release

    t = materialize(spark.createDataFrame([(1,)], "a int").withColumn("n", F.lit(None)))
    assert rows(t) == [(1, None)]
    release(t)
    assert lookup_join(spark.createDataFrame([("a", 1)] * 5, "k string, x int"), spark.createDataFrame([("a", i) for i in range(3)], "k string, y int"), ["k"], limit=0, hot=2).count() == 15


def test_ranked_in_ranges(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.xxhash64("id").alias("o"), "id")
    got = ranked(df, ["k"], "o", per_bucket=20).collect()
    for k in range(3):
        own = sorted((r["o"], r["rank"]) for r in got if r["k"] == k)
        assert [r for _, r in own] == list(range(1, len(own) + 1))


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_exact_quantiles(spark, kind):
    rng = random.Random(1)
    cast = int if kind == "bigint" else float
    data = [("hot", cast(rng.choice([rng.randrange(-(10**6), 10**6), 5, 2**62, -(2**62)]))) for _ in range(2000)] + [("b", cast(3))] * 7 + [("n", None), (None, cast(1)), (None, cast(2))]
    if kind == "double":
        data += [("inf", float("inf")), ("inf", float("-inf")), ("inf", 1.5), ("inf", 2.5), ("inf", float("nan")), ("tiny", 1e-300), ("tiny", 2e-300), ("tiny", 1e300)]
    df = spark.createDataFrame(data, f"k string, v {kind}").withColumn("n_rows", F.lit("clash"))
    probs = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q99": 0.99, "high": 1.0}
    for buckets in (4, 1024):
        got = {r["k"]: r for r in K.exact_key_quantiles(df, ["k"], "v", probs, buckets=buckets).collect()}
        for k in {r[0] for r in data}:
            v = sorted(x for key, x in data if key == k and x is not None and not (isinstance(x, float) and math.isnan(x)))
            for name, p in probs.items():
                want = v[max(1, math.ceil(p * len(v))) - 1] if v else None
                assert got[k][name] == want, (k, name, buckets)
    assert K.exact_key_quantiles(df.limit(0), ["k"], "v", probs).count() == 0


def test_heavy_keys(spark, rows):
    df = spark.createDataFrame([("a", 1)] * 10 + [("b", 2)] + [(None, 3)] * 9, "k string, v int")
    assert rows(K.heavy_keys(df, ["k"], 2), "k", "rows") == [("a", 10)]
    assert K.heavy_keys(df.limit(0), ["k"], 2).count() == 0
    rng = random.Random(6)
    for n in (1, 39, 3000):
        keys = [rng.choice(["x", "y"] + [f"k{i}" for i in range(rng.choice([3, 60]))]) for _ in range(n)]
        many = spark.createDataFrame([(k, "g") for k in keys], "k string, rows string")
        for share in (2, 7, 20):
            want = sorted((k, keys.count(k)) for k in set(keys) if keys.count(k) * share >= n)
            assert rows(K.heavy_keys(many, ["k"], share), "k", "rows") == want
    assert rows(K.skewed_key_stats(df, ["k"], "k", {"big": F.col("v") > 2}), "rows", "big", "distinct_values") == [(1, 0, 1), (9, 9, 0), (10, 0, 1)]


def test_star_components(spark):
    rng = random.Random(2)
    e = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(70)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in e:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    edges = spark.createDataFrame(e + [(None, 1), (2, None), (5, 5)], "s bigint, d bigint")
    v = spark.createDataFrame([(i,) for i in parent] + [(99_999,)], "v bigint")
    want = {x: find(x) for x in parent} | {99_999: 99_999}
    assert {r["v"]: r["component"] for r in G.components(v, "v", edges, "s", "d").collect()} == want
    rounds = G.star_components(G.clean_edges(edges, "s", "d"), local_rows=0).collect()
    assert {r["v"]: r["root"] for r in rounds} == {x: r for x, r in want.items() if any(x in p and p[0] != p[1] for p in e)}
    star = spark.createDataFrame([(0, i) for i in range(1, 50)] + [(60, 61)], "a bigint, b bigint")
    assert {tuple(r) for r in G.star_components(star, hot=5, local_rows=0).collect()} == {(i, 0) for i in range(50)} | {(60, 60), (61, 60)}


def fill(counts, total, overshoot):
    """Even filling, restated: raise a common level until the total is reached."""
    level = 0
    while sum(min(c, level + 1) for c in counts.values()) <= total and level <= max(counts.values(), default=0):
        level += 1
    out = {g: min(c, level) for g, c in counts.items()}
    left = min(total, sum(counts.values())) - sum(out.values())
    for g in sorted(g for g, c in counts.items() if c > level):
        if left > 0 or (overshoot and out[g] == level and left != 0):
            out[g] += 1
            left -= 0 if overshoot else 1
    return out


@pytest.mark.parametrize("overshoot", [False, True])
def test_water_fill(spark, overshoot):
    rng = random.Random(3)
    for case in range(6):
        counts = {f"g{i}": rng.randrange(1, 20) for i in range(rng.randrange(1, 9))}
        total = rng.choice([0, 1, 7, 30, 500])
        df = spark.createDataFrame([("k", g, c) for g, c in counts.items()], "k string, g string, n bigint")
        for keys in ([], ["k"]):
            got = {r["g"]: r["quota"] for r in A.water_fill(df, keys, "g", "n", total, overshoot).collect()}
            assert got == fill(counts, total, overshoot), (counts, total, keys)


def test_running_sums_in_ranges(spark):
    df = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id"), F.md5(F.col("id").cast("string")).alias("key"))
    got = R.running_sums(df, ["k"], R.md5_bucket(F.col("key"), 300, 10), [F.col("key")], {"s": F.col("id")}, inclusive=False).collect()
    for k in (0, 1):
        own, total = sorted((r["key"], r["id"], r["s"]) for r in got if r["k"] == k), 0
        for _, i, s in own:
            assert s == total
            total += i
    ranged, b = R.value_buckets(df.withColumn("v", F.col("id").cast("double")), "v", per_bucket=20)
    got = R.running_sums(ranged, [], F.col(b), [F.col("v")], {"n": F.lit(1)}).collect()
    assert all(r["n"] == r["id"] + 1 for r in got)


def test_units_and_cover(spark, rows):
    u = spark.createDataFrame([("b", f"u{i}", i % 4 + 1) for i in range(30)] + [(None, "x", 5)], "bucket string, unit string, rows bigint")
    got = rows(A.take_until(u, "bucket", "unit", "rows", F.lit(20), "s"), "rows")
    assert 20 <= sum(r[0] for r in got) < 24
    got = rows(A.take_rows_from_units(u, "bucket", "unit", "rows", 11, "s"), "rows")
    assert 11 <= sum(r[0] for r in got) < 15
    g = spark.createDataFrame([("a", 5), ("b", 1), ("c", 1), ("d", 0), ("e", 9)], "g string, n bigint")
    assert rows(A.greedy_cover(g, "g", "n", 3), "g") == [("a",), ("b",), ("c",)]
    assert A.greedy_cover(g, "g", "n", 0).count() == 0
    t = g.withColumn("t", A.rule_target(F.col("n"), [{"min_rows": 5, "ratio": 0.5, "min_rows_out": 1, "cap_rows_out": 4}, {"min_rows": 1, "ratio": 2.5, "min_rows_out": 0, "cap_rows_out": 9}]))
    assert rows(t, "g", "t") == [("a", 2), ("b", 2), ("c", 2), ("d", 0), ("e", 4)]


def near_input(spark):
    rng = random.Random(4)
    base = [(rng.getrandbits(64), rng.getrandbits(64), bytes(rng.randrange(256) for _ in range(64))) for _ in range(25)]
    data = []
    for i in range(260):
        p, d, t = rng.choice(base)
        for b in rng.sample(range(64), rng.choice([0, 0, 1, 3, 7, 9])):
            p ^= 1 << b
        for b in rng.sample(range(64), rng.choice([0, 1, 5, 20])):
            d ^= 1 << b
        t = bytes(min(255, x + rng.choice([0, 4, 9])) for x in t)
        data.append((i, i % 9 and 1 or 0, f"{p:016x}" if i % 17 else "", f"{d:016x}", t.hex(), rng.choice([640, 650, 900]), 640, rng.choice([0, 0, 1])))
    return data, spark.createDataFrame(data, "row_idx bigint, read_ok int, phash64 string, dhash64 string, thumb8_hex string, width int, height int, label int")


@pytest.mark.parametrize("bits,bucket", [(16, 256), (16, None), (4, None)])
def test_near_edges(spark, bits, bucket):
    data, df = near_input(spark)
    edges, members = D.near_edges(df, band_bits=bits, max_bucket=bucket)
    rep = {r["row_idx"]: r["rep"] for r in members.collect()}
    ok = {r[0]: r for r in data if r[1] == 1 and r[2]}
    assert set(rep) == set(ok) and all(ok[i][2:] == ok[r][2:] for i, r in rep.items())
    want = set()
    reps = sorted(set(rep.values()))
    for x in reps:
        for y in reps:
            if x >= y:
                continue
            a, b = ok[x], ok[y]
            pa, pb = int(a[2], 16), int(b[2], 16)
            if not any((pa >> (k * bits)) & ((1 << bits) - 1) == (pb >> (k * bits)) & ((1 << bits) - 1) for k in range(64 // bits)):
                continue
            ph, dh = (pa ^ pb).bit_count(), (int(a[3], 16) ^ int(b[3], 16)).bit_count()
            mae = sum(abs(p - q) for p, q in zip(bytes.fromhex(a[4]), bytes.fromhex(b[4]))) / 64
            if abs(math.log(a[5] / a[6]) - math.log(b[5] / b[6])) > 0.12 or mae > 6.0:
                continue
            if a[7] == b[7] and (ph <= 8 or dh <= 6):
                want.add((x, y, "near_hash"))
            elif a[7] != b[7] and (ph <= 4 or dh <= 2):
                want.add((x, y, "suspicious_cross_label_near"))
    assert {(r["src_idx"], r["dst_idx"], r["reason"]) for r in edges.collect()} == want and want


def test_every_near_pair(spark):
    data, df = near_input(spark)
    edges, members = D.near_edges(df)
    ok = {r[0]: r for r in data if r[1] == 1 and r[2]}
    reps = sorted({r["rep"] for r in members.collect()})
    want = set()
    for x in reps:
        for y in reps:
            a, b = ok[x], ok[y]
            if x >= y or abs(math.log(a[5] / a[6]) - math.log(b[5] / b[6])) > 0.12:
                continue
            ph, dh = (int(a[2], 16) ^ int(b[2], 16)).bit_count(), (int(a[3], 16) ^ int(b[3], 16)).bit_count()
            if sum(abs(p - q) for p, q in zip(bytes.fromhex(a[4]), bytes.fromhex(b[4]))) / 64 <= 6.0 and ((ph <= 8 or dh <= 6) if a[7] == b[7] else (ph <= 4 or dh <= 2)):
                want.add((x, y))
    got = [(r["src_idx"], r["dst_idx"]) for r in edges.collect()]
    assert set(got) == want and len(got) == len(want)
    assert D.near_edges(df, band_bits=16)[0].count() < len(want)


@pytest.mark.parametrize("cell", [7, 50_000])
def test_hamming_pairs(spark, cell):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)] + [0]
    data = []
    for i in range(150):
        h = [rng.choice(base) for _ in range(2)]
        h = [x ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 2, 4, 5]))) for x in h]
        data.append((i, *[None if rng.random() < 0.1 else x - (1 << 64 if x >> 63 else 0) for x in h]))
    df = spark.createDataFrame(data, "rep bigint, x bigint, y bigint")
    near = lambda a, b, n: a is not None and b is not None and ((a ^ b) & (1 << 64) - 1).bit_count() <= n
    want = {(a[0], b[0]) for a in data for b in data if a[0] < b[0] and (near(a[1], b[1], 4) or near(a[2], b[2], 3))}
    got = [tuple(r) for r in D.hamming_pairs(df, {"x": 4, "y": 3}, cell).collect()]
    assert set(got) == want and len(got) == len(want)
    assert D.hamming_pairs(df.limit(0), {"x": 4}).count() == 0


def test_apply_edges(spark):
    data = [(0, "/a", 0, "unseen", 1, 1, 1, 1), (1, "/b", 0, "seen", 9, 9, 9, 1), (2, "/c", 0, None, 5, 5, 5, 0), (3, "/d", 1, "", 5, 5, 5, 1), (4, "/e", 0, "seen", 5, 5, 5, 1), (5, "/f", 1, "seen", None, None, None, None)]
    df = spark.createDataFrame(data, "row_idx bigint, path string, label int, split_hint string, width int, height int, file_size_bytes bigint, read_ok int")
    edges = spark.createDataFrame([(0, 1, "x", "", "dedup"), (1, 2, "x", "", "dedup"), (3, 4, "x", "", "dedup"), (4, 5, "y", "", "split_lock"), (0, 5, "z", "", "suspicious")], "src_idx bigint, dst_idx bigint, reason string, score string, stage string")
    got = {r["row_idx"]: r for r in D.apply_edges(df, edges).collect()}
    assert [got[i]["dedup_drop_reason"] for i in range(6)] == ["", "duplicate_noncanonical", "read_error", "label_conflict", "label_conflict", "read_error"]
    assert [got[i]["dedup_component_id"] for i in (0, 2, 3, 5)] == ["dedup_00000000", "dedup_00000000", "dedup_00000001", "dedup_00000002"]
    assert got[5]["split_component_size"] == 3 and got[0]["cross_split_duplicate"] == 1 and got[0]["is_canonical"] == 1 and got[1]["canonical_path"] == "/a"
    assert D.apply_edges(df.limit(0), edges.limit(0)).count() == 0


def test_locks(spark, rows):
    data = [(0, "p", "c", 0, "g1", "dragon", "s"), (1, "p", "c", 1, "g1", "Dragon", "s"), (2, "p", "d", 0, "", "dragon", "t"), (3, "p", "d", 0, "g1", "dragon", "u"), (4, "", "c", 1, "g9", "dragon", "v"), (5, "p", "c", 0, None, "other", "w")]
    df = spark.createDataFrame(data, "id bigint, pair_group string, content_id string, label int, prompt_group string, dataset string, generator string")
    assert rows(D.pair_lock_edges(df, "id"), "src_idx", "dst_idx") == [(0, 1), (0, 5)]
    assert rows(D.prompt_lock_edges(df, "id", "dragon"), "src_idx", "dst_idx") == [(0, 1), (0, 3)]
    assert D.prompt_lock_edges(df, "id", "dragon", max_size=2).count() == 0


def test_cosine_neighbours(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    v = rng.normal(size=(120, 6))
    v[60:] = v[:60] + rng.normal(size=(60, 6)) * 0.03
    data = [(i, f"s{i % 2}", x.tolist()) for i, x in enumerate(v)] + [(500, None, [1.0] * 6), (501, "s0", None), (502, "s1", [0.0] * 6)]
    df = spark.createDataFrame(data, "id bigint, s string, v array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for t in (0.2, 0.99):
        got = {(r["row_a"], r["row_b"]) for r in X.cosine_neighbours(df, "id", "s", "v", t).collect()}
        want = {(a, b) for a in range(120) for b in range(120) if a != b and a % 2 == b % 2 and u[a] @ u[b] >= t}
        assert got == want and want
    top = X.cosine_neighbours(df, "id", "s", "v", 0.2, topk=3).collect()
    assert max(r["rank"] for r in top) == 2
    assert X.cosine_neighbours(df.limit(0), "id", "s", "v", 0.5).count() == 0


def test_vector_classes(spark, rows):
    df = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "a", [1.0, 2.0]), (3, "b", [1.0, 2.0]), (4, "a", [1.0, 2.5]), (5, "a", [1.0, 2.0]), (None, "a", [1.0, 2.0])], "id bigint, s string, v array<double>")
    reps, edges = X.vector_classes(df, "id", "s", "v")
    assert rows(reps, "id") == [(1,), (3,), (4,)] and rows(edges, "row_a", "row_b") == [(1, 2), (1, 5)]


def test_global_top_prunes_exactly(spark):
    rng = random.Random(8)
    data = [(i, rng.choice([rng.random(), 0.5, None])) for i in range(60_000)]
    df = spark.createDataFrame(data, "id bigint, v double")
    got = [r["id"] for r in R.global_top(df, [F.desc_nulls_last("v"), F.asc("id")], 300, "v").collect()]
    assert sorted(got) == sorted(i for i, _ in sorted(((i, v) for i, v in data if v is not None), key=lambda x: (-x[1], x[0]))[:300])
    low = [r["id"] for r in R.global_top(df.filter("v IS NOT NULL"), [F.asc("v"), F.asc("id")], 300, "v", descending=False).collect()]
    assert sorted(low) == sorted(i for i, _ in sorted(((i, v) for i, v in data if v is not None), key=lambda x: (x[1], x[0]))[:300])


def test_metrics_match_definition(spark):
    rng = random.Random(6)
    data = [(rng.randrange(2), rng.choice([0.1, 0.2, 0.5, 0.5, rng.random()])) for _ in range(400)] + [(None, 0.3), (1, None), (0, float("nan")), (7, 0.2)]
    df = spark.createDataFrame(data, "label int, score double")
    ok = [(y, s) for y, s in data if y in (0, 1) and s is not None and not math.isnan(s)]
    pos, neg = [s for y, s in ok if y], [s for y, s in ok if not y]
    m = M.binary_metrics(df).first()
    assert abs(m["auroc"] - sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)) < 1e-9
    ap, last = 0.0, 0.0
    for t in sorted({s for _, s in ok}, reverse=True):
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        ap, last = ap + (tp / len(pos) - last) * tp / (tp + fp), tp / len(pos)
    assert abs(m["average_precision"] - ap) < 1e-9
    r = {x["target"]: x for x in M.precision_targets(df, [0.5, 1.01]).collect()}
    want = min((t for t in {s for _, s in ok} if sum(s >= t for s in pos) >= 0.5 * sum(s >= t for _, s in ok)), default=None)
    assert r[0.5]["threshold"] == want and r[1.01]["threshold"] is None and r[1.01]["recall"] == 0.0
    one = M.binary_metrics(df.filter("label = 1")).first()
    assert math.isnan(one["auroc"]) and math.isnan(one["real_accuracy"]) and one["average_precision"] == 1.0
    assert math.isnan(M.binary_metrics(df.limit(0)).first()["auroc"])
    with pytest.raises(ValueError):
        M.calibrate(df, 1.01)


def test_weights_and_draws(spark):
    df = spark.createDataFrame([(i, "a" if i < 8 else "b", str(i % 3), 1) for i in range(10)] + [(10, None, "x", 0)], "id bigint, g string, w string, hard int")
    out = {r["id"]: r["weight"] for r in W.balanced_weights(df, ["g"], 1.0, "w", "hard", 2.0).collect()}
    assert abs(out[1] - 2 / 8) < 1e-12 and abs(out[8] - 2.0) < 1e-12 and abs(out[10] - 1.0) < 1e-12 and abs(out[0] - 2e-6 / 8) < 1e-15
    weighted = W.balanced_weights(df, [], 0.0)
    drawn = W.draw_without_replacement(weighted, "id", "weight", 6, 1, world=3).collect()
    assert sorted(r["draw"] for r in drawn) == list(range(6)) and len({r["id"] for r in drawn}) == 6 and {r["process"] for r in drawn} == {0, 1, 2}
    heavy = spark.createDataFrame([(1, 99.0), (2, 1.0), (3, 0.0), (4, None)], "id bigint, weight double")
    many = W.draw_with_replacement(heavy, "id", "weight", 2000, 1).collect()
    share = sum(r["id"] == 1 for r in many) / len(many)
    assert len(many) == 2000 and 0.97 < share < 1.0 and {r["id"] for r in many} <= {1, 2}
    assert W.draw_with_replacement(heavy.limit(0), "id", "weight", 5, 1).count() == 0


def test_summaries(spark, rows):
    df = spark.createDataFrame([("a", 1, "/1"), ("a", None, "/2"), (None, 1, "/0")], "s string, n int, path string")
    assert rows(S.value_counts(df, ["s", "n"])) == [("n", "1", 2), ("s", "a", 2)]
    assert ("s", None, 1) in rows(S.index_summary(df, ["s", "n"])) and len(rows(S.index_summary(df, ["s", "n"]))) == 4
    assert rows(S.unit_table(df, "s", ["n"])) == [(None, 1, 1), ("a", 2, 1)]
    assert rows(S.overlap(df, df.filter("path = '/1'"), ["path", "gone"])) == [("gone", 0, 0, 0, ""), ("path", 3, 1, 1, "/1")]


def test_mining_and_buffer(spark, rows):
    data = [("/s/p1", 0, None, 0.9), ("/s/p2", 0, "x", 0.2), ("/s/p3", 1, "x", 0.1), ("/s/p4", 1, "y", 0.95), ("/s/p5", 0, "y", 0.55), (None, 1, "y", 0.5), ("/s/p6", None, "y", 0.5)]
    df = spark.createDataFrame(data, "path string, label int, source string, score double")
    out = {r["path"]: r for r in N.select_hard(df, 0.6, 1, 1, 2).collect()}
    assert out["/s/p1"]["hard_type"] == "real_false_positive" and out["/s/p1"]["source"] == "s" and out["/s/p3"]["hard_type"] == "fake_false_negative"
    assert out["/s/p5"]["hard_type"] == "uncertain_band" and len(out) == 4
    assert set(rows(N.select_hard(df, 0.6, 9, 9, 9, errors_only=True), "path")) == {("/s/p1",), ("/s/p3",)}
    buf = spark.createDataFrame([(f"/p{i}", "hot" if i < 8 else f"s{i}", float(i), 1.0) for i in range(10)] + [("/p0", "hot", 99.0, 1.0), ("/n", "hot", float("nan"), 1.0)], "path string, source string, priority double, sample_weight double")
    merged = N.merge_buffer(None, buf, 6)
    assert rows(merged, "path") == [("/p0",), ("/p5",), ("/p6",), ("/p7",), ("/p8",), ("/p9",)]
    assert N.merge_buffer(buf, buf, 100).count() == 11
    base = spark.createDataFrame([("/p0", 1, "b", 1.0, 0), ("/zz/q", 1, None, 1.0, 0)], "path string, label int, source string, sample_weight double, is_hard_negative int")
    both = N.merge_with_train(buf.withColumns({"label": F.lit(0), "is_hard_negative": F.lit(1)}), base)
    assert both.count() == 12 and rows(both.filter("path = '/zz/q'"), "source") == [("zz",)]


def sample_rows(spark, n=600):
    rng = random.Random(7)
    data = [(f"/x/{i}", i % 2 if i % 50 else None, f"s{rng.randrange(6)}", f"g{rng.randrange(4)}", rng.choice(["seen"] * 8 + ["unseen", "robust", None]), f"u{rng.randrange(150)}") for i in range(n)]
    return spark.createDataFrame(data, "path string, label int, source string, generator string, split_hint string, split_component_id string")


def test_compact_splits(spark):
    out = P.compact_splits(sample_rows(spark), (60, 20, 20, 30, 10), "source", 1)
    paths = {k: [r["path"] for r in v.select("path").collect()] for k, v in out.items()}
    assert all(len(p) == len(set(p)) for p in paths.values())
    main = ["train_stage1", "val", "test_seen", "test_unseen", "reviewed_pool"]
    assert sum(len(paths[k]) for k in main) == len(set().union(*(paths[k] for k in main)))
    assert len(paths["train_stage1"]) == 120 and len(paths["val"]) == 40 and len(paths["train_stage2"]) == 140
    for k in ("train_stage1", "val", "test_unseen"):
        P.require_binary(out[k], k)


def test_supplement_fills_missing_label(spark, rows):
    df = sample_rows(spark).filter("NOT (split_hint = 'unseen' AND label = 0)")
    out = P.compact_splits(df, (40, 10, 10, 15, 0), "source", 1)
    hints = rows(out["test_unseen"].groupBy("label", "split_hint").count())
    assert (0, "supplement_unseen", 15) in hints


def test_tight_splits_keep_units(spark):
    out = P.tight_splits(sample_rows(spark), ["s1"], ["g1"], (), 20, 20, [{"min_rows": 0, "ratio": 0.1, "min_rows_out": 3, "cap_rows_out": 9}], seed=1)
    unit = {k: {r[0] for r in v.select("split_component_id").collect()} for k, v in out.items()}
    assert not unit["train"] & unit["val_seen"] and not unit["train"] & unit["val_unseen"] and unit["val_unseen"]
    with pytest.raises(ValueError):
        P.require_binary(out["train"].filter("label = 1"), "train")


def test_heldout_and_single(spark):
    out = P.heldout_splits(sample_rows(spark), 50, 50, seed=1)
    src = {k: {r[0] for r in v.filter("label = 0").select("source").collect()} for k, v in out.items()}
    assert not src["train"] & src["val"] and out["val"].filter("label = 0").count() == 50
    with pytest.raises(ValueError):
        P.heldout_splits(sample_rows(spark), 5, 5, real_sources=["nobody"], fake_sources=["nobody"])
    one = P.single_stage_splits(sample_rows(spark), {"val": (11, 12), "train": (50, 40)}, seed=1)
    assert one["val"].count() == 23 and one["train"].count() == 90
    assert one["val"].join(one["train"], "path").count() == 0


def test_cosine_neighbours_with_recall(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.normal(size=(1500, 96))
    base[750:] = base[:750] + rng.normal(size=(750, 96)) * 0.09  # cosine about 0.996
    df = spark.createDataFrame([(i, i % 2 and "s" or "s", [float(x) for x in v]) for i, v in enumerate(base)], "id bigint, s string, v array<float>")
    want = {(r["row_a"], r["row_b"]) for r in X.cosine_neighbours(df, "id", "s", "v", 0.992, block=400).collect()}
    u = base / np.linalg.norm(base, axis=1, keepdims=True)
    a, b = np.nonzero(u @ u.T >= 0.992)
    assert want == {(int(x), int(y)) for x, y in zip(a, b) if x != y} and len(want) > 1000
    got = [(r["row_a"], r["row_b"]) for r in X.cosine_neighbours(df, "id", "s", "v", 0.992, recall=0.99).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.97 * len(want)
    tables, bits = X.sign_tables(0.992, 0.99, 300_000)
    assert tables / 2**bits < 0.01 and X.sign_tables(0.3, 0.99, 500) == (1, 0)
