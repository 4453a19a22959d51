"""Each operator against brute force or hand-made cases, with nulls, ties, repeats and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from corpuskit.llm import survivor as S
from corpuskit.llm.components import linked_groups
from corpuskit.llm.groupsplit import GroupSplit, greedy_counts, hierarchical_components
from corpuskit.llm.overlap import cross_split_matches, cross_split_pairs, overlap_report
from corpuskit.llm.quotas import rake, sample_by_targets, whole_quotas
from corpuskit.llm.survivor import consensus, field_consensus, surviving_records
from corpuskit.llm.topn import top_n_per_group

TOP = "g string, h string, score double, path string, id bigint, rank string"


def brute_top(data, n):
    groups = {}
    for r in data:
        groups.setdefault((r[0], r[1]), []).append(r)
    out = set()
    for rows in groups.values():
        rows.sort(key=lambda r: (r[2] is None, -(r[2] or 0.0), r[3] is None, r[3] or "", r[4]))
        out |= {r[4] for r in rows[:n]}
    return out


@pytest.mark.parametrize("most", [7, 200_000])
def test_top_n_ties_and_nulls(spark, most):
    rng = random.Random(1)
    data = []
    for i in range(3000):
        g = rng.choice(["hot"] * 6 + ["a", "b", None, f"s{i % 50}"])
        data.append((g, rng.choice(["x", None]), rng.choice([1.0, 2.0, 2.0, -0.5, None]), rng.choice(["p", "q", None, f"r{i % 9}"]), i, "old"))
    df = spark.createDataFrame(data, TOP).repartition(6)
    out = top_n_per_group(df, ["g", "h"], [("score", True), ("path", False), ("id", False)], 5, most=most)
    assert {r["id"] for r in out.collect()} == brute_top(data, 5)
    assert out.columns == ["g", "h", "score", "path", "id", "rank"] and dict(out.dtypes)["rank"] == "int"


@pytest.mark.parametrize("descending,want", [(True, [3, 4, 5, 2, 1]), (False, [0, 1, 2, 3, 4])])
def test_top_n_of_nan(spark, descending, want):
    scores = [0.0, 1.0, 2.0, float("nan"), float("nan"), float("nan"), None]
    df = spark.createDataFrame([("a", "h", x, "p", i, "") for i, x in enumerate(scores)], TOP).coalesce(1)
    out = top_n_per_group(df, ["g"], [("score", descending), ("id", False)], 5)
    assert [r["id"] for r in out.orderBy("rank").collect()] == want


def test_top_n_empty_and_repeats(spark):
    empty = spark.createDataFrame([], TOP)
    assert top_n_per_group(empty, ["g"], [("score", True)], 3).count() == 0
    same = spark.createDataFrame([("a", "h", 1.0, "p", 1, "")] * 7, TOP)
    assert top_n_per_group(same, ["g"], [("score", True), ("id", False)], 3).count() == 3
    assert top_n_per_group(same, ["g"], [("id", False)], 0).count() == 0


def union_find(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in parent}


def shapes():
    rng = random.Random(2)
    e = [(0, 100), (100, 101)]
    e += [(1000 + i, 1001 + i) for i in range(40)]  # a long chain
    e += [(2000, 2001 + i) for i in range(60)]  # a star
    e += [(3000 + i, 3000 + (i + 1) % 13) for i in range(13)] + [(4000, 4001), (4001, 4002), (4002, 4000)]  # rings
    e += [(5000 + i, 5000 + j) for i in range(6) for j in range(i)]  # a clique
    e += [(6000, 6001 + 10 * k + i) if i == 0 else (6000 + 10 * k + i, 6001 + 10 * k + i) for k in range(3) for i in range(9)] + [(6009, 7000), (6019, 7000), (6029, 7000)]  # parallel chains between two hubs
    e += [(rng.randrange(8000, 8200), rng.randrange(8000, 8200)) for _ in range(170)]
    e += [(rng.randrange(9000, 9040), rng.randrange(9000, 9040)) for _ in range(120)]
    rng.shuffle(e)
    return [(b, a) if rng.random() < 0.5 else (a, b) for a, b in e]


@pytest.mark.parametrize("core_rows", [500_000, 0])
def test_linked_groups(spark, core_rows):
    e = shapes()
    dirty = e + e[:30] + [(b, a) for a, b in e[:30]] + [(5, 5), (None, 3), (4, None), (None, None)]
    df = spark.createDataFrame(dirty, "src bigint, dst bigint").withColumnRenamed("src", "a").withColumnRenamed("dst", "group")
    got = {r["v"]: r["group"] for r in linked_groups(df, "a", "group", core_rows=core_rows).collect()}
    assert got == union_find([(a, b) for a, b in e if a != b])


def test_linked_groups_empty(spark):
    df = spark.createDataFrame([(None, 1), (2, 2)], "src bigint, dst bigint")
    assert linked_groups(df, "src", "dst").count() == 0


def test_hierarchical_components(spark):
    e = [(a, b) for a, b in shapes() if a != b]
    df = spark.createDataFrame(e, "a bigint, b bigint")
    for part_edges, top in ((30, 2_000_000), (30, 0), (10_000, 2_000_000), (5, 2_000_000)):
        got = {r["v"]: r["root"] for r in hierarchical_components(df, part_edges, 3, top).collect()}
        want = union_find(e)
        groups = lambda m: sorted(sorted(v for v in m if m[v] == r) for r in set(m.values()))
        assert groups(got) == groups(want)


def plain_greedy(sizes, targets):
    total = sum(s * n for s, n in sizes)
    miss = {k: total * t for k, t in targets.items()}
    out = {}
    for s, n in sorted(sizes, reverse=True):
        got = dict.fromkeys(targets, 0)
        for _ in range(n):
            k = max(targets, key=lambda x: miss[x])
            got[k] += 1
            miss[k] -= s
        out[s] = got
    return out


def test_greedy_counts_in_bulk():
    targets = {"train": 0.8, "validation": 0.1, "test": 0.1}
    for sizes in ([(5, 3), (2, 7), (1, 10)], [(900, 2), (1, 45_000)], [(3, 20_001), (1, 30_003)], []):
        bulk, plain = greedy_counts(sizes, targets), plain_greedy(sizes, targets)
        for s, n in sizes:
            assert sum(bulk[s].values()) == n and bulk[s] == plain[s]


def test_group_split(spark):
    rng = random.Random(3)
    data = [(i, f"c{rng.randrange(300)}" if rng.random() < 0.7 else None, f"g{rng.randrange(90)}" if rng.random() < 0.4 else None, "hot" if i % 3 == 0 and i < 90 else None, rng.choice(["seen", " SEEN", "", None, "val"])) for i in range(1500)]
    data += [(None, "c1", None, None, "seen"), (7, "c1", None, None, "val")]
    df = spark.createDataFrame(data, "id bigint, hint string, node string, split string, e0 string")
    split = GroupSplit(df, "id", {"id": "hint", "hint": "node", "node": "split"}, "e0", {"train": 0.8, "validation": 0.1, "test": 0.1}, part_edges=50)
    got = [tuple(r) for r in split.rows().collect()]
    assert len(got) == 1501
    of = {}
    for i, _, s in got:
        of.setdefault(i, set()).add(s)
    for col in (1, 2, 3):
        seen = {}
        for r in data:
            if r[0] is not None and r[col] is not None:
                seen.setdefault(r[col], set()).update(of[r[0]])
        assert all(len(s) == 1 for s in seen.values())
    share = sum(s == "train" for _, _, s in got) / len(got)
    assert 0.7 < share < 0.9
    norm = lambda h: (h or "").strip().lower() or "seen"
    torn = {(k, v) for k, col in (("id", 1), ("hint", 2), ("node", 3)) for v in {r[col] for r in data if r[col]} if len({norm(r[4]) for r in data if r[col] == v and r[0] is not None}) > 1}
    found = split.torn_entities().collect()
    assert {(r["kind"], r["entity"]) for r in found} == torn and len(found) == len(torn)
    clusters = {r["cluster"]: (r["split"], r["id"]) for r in split.rows().orderBy(F.desc("id")).collect()}
    assert all(clusters[r["cluster"]][0] == r["split"] and clusters[r["cluster"]][1] == r["cluster"] for r in found)
    counts = {(k, v): sum(r[col] == v for r in data if r[0] is not None) for k, col in (("id", 1), ("hint", 2), ("node", 3)) for v in {r[col] for r in data if r[col]}}
    assert all(r["rows"] == counts[r["kind"], r["entity"]] for r in found)


def test_group_split_empty(spark):
    df = spark.createDataFrame([], "id bigint, a string, h string")
    split = GroupSplit(df, "id", {"a": "a"}, "h", {"train": 1.0})
    assert split.rows().count() == 0 and split.torn_entities().count() == 0


def test_rake_and_quotas():
    target = {("a", "x"): 0.5, ("a", "y"): 0.2, ("b", "x"): 0.2, ("b", "y"): 0.1}
    have = {("a", "x"): 1000, ("a", "y"): 5, ("b", "x"): 1000, ("b", "y"): 1000}
    x = rake(target, have, 100)
    assert x[("a", "y")] <= 5 and abs(sum(x.values()) - 100) < 1e-3
    even = rake(target, {c: 1000 for c in target}, 100)
    assert all(abs(even[c] - 100 * target[c]) < 1e-6 for c in target)
    q = whole_quotas(x, have, {c: 12 for c in target}, 100)
    assert sum(q.values()) == 100 and q[("b", "y")] >= 12 and q[("a", "y")] == 5
    assert rake(target, {}, 10) == dict.fromkeys(target, 0.0)


def test_sample_by_targets(spark):
    data = [(f"p{i}", " A " if i % 2 else "a", "x", i % 3 and 1.0 or None, "w") for i in range(300)] + [(f"q{i}", "b", "x", float("nan"), "w") for i in range(9)]
    data += data[:100] + [(None, "a", "x", 1.0, "w"), ("z", None, "x", 1.0, "w"), ("p1", "b", "x", -1.0, "w")]
    df = spark.createDataFrame(data, "path string, source string, kind string, w double, item string")
    mix = spark.createDataFrame([("a", "x", 0.8, 3), ("b", "x", 0.2, 3), ("c", "x", 0.0, 2)], "source string, kind string, share double, low int")
    sample, report = sample_by_targets(df, "path", ["source", "kind"], "w", mix, "share", "low", one_in=5)
    got = sample.collect()
    assert len(got) == len({r["path"] for r in got}) == 310 // 5
    r = {x["source"]: x for x in report.collect()}
    assert r["b"]["available"] == 10 and r["b"]["short"] and r["c"]["short"] and not r["a"]["short"]
    assert r["c"]["gap"] == 2.0 and r["a"]["drawn"] + r["b"]["drawn"] == 62
    again, _ = sample_by_targets(df.repartition(5), "path", ["source", "kind"], "w", mix, "share", "low", one_in=5)
    assert {x["path"] for x in again.collect()} == {x["path"] for x in got}


def test_sample_by_targets_empty(spark):
    df = spark.createDataFrame([], "path string, source string")
    mix = spark.createDataFrame([("a", 1.0, 1)], "source string, share double, low int")
    sample, report = sample_by_targets(df, "path", ["source"], None, mix, "share", "low")
    assert sample.count() == 0 and report.first()["short"]


def test_cross_split_pairs(spark):
    rng = random.Random(4)
    data, base = [], [rng.getrandbits(64) for _ in range(40)] + [0]
    for i in range(900):
        h = rng.choice(base)
        for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 5, 6])):
            h ^= 1 << b
        text = rng.choice([f"{h:016x}", f"{h:016X}", f"{h:016x}", "", None, "zz"])
        p = rng.choice([f"/a/{i % 70}", f"/a//{i % 70}", f"/./a/{i % 70}", f"/a/./{i % 70}", None, f"/b/{i}"])
        data.append((i if i % 50 else None, p, text, rng.choice(["seen", None, " ", "Seen ", "val", " TEST", "unseen"]), rng.choice(["s", "T ", None]), 1))
    df = spark.createDataFrame(data, "row_idx bigint, path string, h string, hint string, e string, t int")
    got = {tuple(r) for r in cross_split_pairs(df, "row_idx", "path", "h", "hint").collect()}
    import re

    ok = [(i, re.sub(r"/(?:\.?/)+", "/", p) if p else None, int(h, 16) if h and h != "zz" else None, (s or "").strip().lower() in ("", "seen")) for i, p, h, s, _, _ in data if i is not None]
    want = {(min(a[0], b[0]), max(a[0], b[0])) for a in ok for b in ok if not a[3] and b[3] and ((a[1] and a[1] == b[1]) or (a[2] is not None and b[2] is not None and (a[2] ^ b[2]).bit_count() <= 5))}
    assert got == want and len(want) > 100
    cut = [tuple(r) for r in cross_split_pairs(df, "row_idx", "path", "h", "hint", block=4).collect()]
    assert len(cut) == len(set(cut)) and set(cut) == want
    pairs = {(r["e"], r["t"]) for r in cross_split_matches(df, "row_idx", "path", "h", "hint")[1].collect()}
    _, grid, paths = cross_split_matches(df, "row_idx", "path", "h", "hint", shard_values=5, task_values=7)
    grid = [(r["e"], r["t"]) for r in grid.collect()]
    assert len(grid) == len(set(grid)) and set(grid) == pairs and paths.count() == paths.distinct().count()
    report = overlap_report(df, "row_idx", "path", "h", "hint", "e").collect()
    assert sum(r["rows"] for r in report) == sum(not r[3] for r in ok)
    hit = {a[0] for a in ok if not a[3] and any((min(a[0], b[0]), max(a[0], b[0])) in want for b in ok if b[3])}
    assert sum(r["overlapping"] for r in report) == len(hit)


def test_cross_split_pairs_empty(spark):
    df = spark.createDataFrame([], "row_idx bigint, path string, h string, hint string, e string")
    assert cross_split_pairs(df, "row_idx", "path", "h", "hint").count() == 0
    assert overlap_report(df, "row_idx", "path", "h", "hint", "e").count() == 0


def test_consensus():
    assert consensus(["new york city", "new york cty", "new york city hall"], [1.0, 1.0, 1.0])[1] == "new york city"
    assert consensus(["a b", "a c"], [1.0, 3.0])[1] == "a c"
    assert consensus(["x"], [1.0]) == ("x", "x", 0)
    long = "word " * 20_000
    assert consensus([long, long + "end"], [2.0, 1.0])[1] == long


def test_surviving_records(spark):
    data = [
        ("g1", 1, 1, None, "A ", 2.0, "x"),
        ("g1", 2, 0, "red fox", "b", 1.0, "y"),
        ("g1", 3, 1, "red foxes", " ", None, "z"),
        ("g1", 4, 1, "red fox", "c", 0.0, "z"),
        ("g2", 5, None, None, None, None, None),
        ("g2", 5, None, None, None, None, None),
        (None, 6, 1, "no", "no", 1.0, "n"),
    ]
    df = spark.createDataFrame(data, "grp string, id bigint, ok int, name string, tag string, w double, filled string")
    out = {r["grp"]: r for r in surviving_records(df, "grp", [("ok", True), ("w", True), ("id", False)], ["name", "tag"], "w").collect()}
    assert set(out) == {"g1", "g2"}
    assert out["g1"]["id"] == 1 and out["g1"]["name"] == "red fox" and out["g1"]["tag"] == "A " and out["g1"]["filled"] == 1
    assert out["g2"]["name"] is None and out["g2"]["filled"] == 0
    assert surviving_records(df.limit(0), "grp", [("id", False)], ["name"], "w").count() == 0


def test_consensus_of_many_values(spark):
    data = [("k", f"the quick brown fox number {i}", 1.0) for i in range(90)] + [("k", "the quick brown fox", 5.0), ("s", "one", 1.0), ("p", "a", 1.0), ("p", "b", 2.0)]
    df = spark.createDataFrame(data, "key string, value string, weight double")
    out = {r["key"]: r["value"] for r in field_consensus(df, ["key"], chunk=16).collect()}
    assert out["k"].startswith("the quick brown fox") and out["s"] == "one" and out["p"] == "b"


def test_consensus_ignores_a_common_beginning():
    rng = random.Random(8)
    words = "red blue green tin kite fox".split()
    for _ in range(120):
        values = list({" ".join(rng.choice(words) for _ in range(rng.randrange(1, 7))) for _ in range(4)})
        weights = [rng.choice([1.0, 2.0, 0.5]) for _ in values]
        prefix = "lumen " * 400
        assert consensus([prefix + v for v in values], weights)[1] == prefix + consensus(values, weights)[1]


def test_alignment_is_the_same_in_blocks_and_long_rows():
    rng = random.Random(9)

    def cost(columns, seq):
        best = [[float(j) for j in range(len(seq) + 1)]]
        for c in columns:
            skip, up = 0.5 if "" in c else 1.0, best[-1]
            row = [up[0] + skip]
            for j, t in enumerate(seq):
                row.append(min(up[j] + (0.0 if t in c else 1.5), up[j + 1] + skip, row[j] + 1.0))
            best.append(row)
        return best[-1][-1]

    for n, m in ((5, 7), (60, 70), (90, 20), (0, 3), (3, 0)):
        columns = [{rng.choice("abcdef"): 1.0} | ({"": 0.5} if rng.random() < 0.3 else {}) for _ in range(n)]
        seq = [rng.choice("abcdef") for _ in range(m)]
        if n and m:  # nothing to trim
            columns[0], columns[-1], seq[0], seq[-1] = {"x": 1.0}, {"y": 1.0}, "p", "q"
        pairs = S._align(columns, seq)
        assert [i for i, _ in pairs if i >= 0] == list(range(n)) and [j for _, j in pairs if j >= 0] == list(range(m))
        paid = sum((0.0 if seq[j] in columns[i] else 1.5) if i >= 0 and j >= 0 else (1.0 if i < 0 else 0.5 if "" in columns[i] else 1.0) for i, j in pairs)
        assert paid == cost(columns, seq)
        text = [rng.choice("abcdef") for _ in range(n)]
        short = S._distance(text, seq)
        assert short == S._distance(seq, text) and abs(n - m) <= short <= max(n, m)
    many = [[f"w{rng.randrange(50)}" for _ in range(2500)] for _ in range(2)]
    assert len(S._align([{t: 1.0} for t in many[0]], many[1])) >= 2500  # in blocks


@pytest.mark.parametrize("chunk", [3, 128])
def test_elected_members_follow_the_order(spark, chunk):
    rng = random.Random(10)
    data = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([0, 1, None]), rng.choice([0.5, 1.0, float("nan"), None]), i) for i in range(80)]
    df = spark.createDataFrame(data, "g string, ok int, w double, id bigint")
    got = {r["g"]: r["id"] for r in S.elected_members(df.filter("g IS NOT NULL"), "g", [("ok", True), ("w", True), ("id", False)], chunk).collect()}
    key = lambda r: (r[1] is None, -(r[1] or 0), r[2] is None, -1e9 if r[2] is not None and r[2] != r[2] else -(r[2] or 0), r[3])
    assert got == {g: min((r for r in data if r[0] == g), key=key)[3] for g in ("hot", "a", "b")}
