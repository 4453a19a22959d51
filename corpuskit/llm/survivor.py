"""Problem 7: one surviving record for each group of duplicates, gaps filled by consensus.

Both choices are token-level consensus: sequences are aligned one after the other to a growing
profile, weighted tokens are voted per column, and the existing sequence closest to the vote is emitted.
For the record, the sequence is what trust is judged by, a token a column, and of two
members the more trusted one outweighs all after it. For a gap of that record, sequences are the tokens
of the group's distinct values of the field, with added-up weights. Members and values beyond a
bounded number are taken in parts whose winners, or whose profiles, are merged in turn, so no task holds a
group's rows; a merged profile holds an entry for every distinct token of a column.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.common import lookup_join, materialize

#: Members or distinct values that are aligned in one step, and profiles that are merged in one.
CHUNK = 128
FAN_IN = 16


def _tokens(text: str) -> list[str]:
    import re

    return re.findall(r"\w+|\s+|[^\w\s]", text)


def _best_rows(columns: list[dict], seq: list[str], ids: dict[str, int], codes, row: list) -> list:
    """Rows of the alignment's cost table after each of the columns, from the row before them."""
    out = [row]
    m = len(seq)
    if m < 48:
        for c in columns:
            skip, up = 0.5 if "" in c else 1.0, out[-1]
            own = [up[0] + skip]
            for j, t in enumerate(seq):
                own.append(min(up[j] + (0.0 if t in c else 1.5), up[j + 1] + skip, own[j] + 1.0))
            out.append(own)
        return out
    import numpy as np

    steps = np.arange(m + 1, dtype=float)
    for c in columns:
        skip, up = 0.5 if "" in c else 1.0, np.asarray(out[-1])
        same = np.isin(codes, [ids[t] for t in c if t in ids])
        best = np.minimum(up[:-1] + np.where(same, 0.0, 1.5), up[1:] + skip)
        # a run of inserted tokens costs 1 each: the least of all starts is a running minimum
        out.append(np.minimum.accumulate(np.append(up[0] + skip, best) - steps) + steps)
    return out


def _align(columns: list[dict], seq: list[str]) -> list[tuple[int, int]]:
    """Pairs of positions of an alignment of a profile and tokens; -1 is a gap.

    What both begin and end with is paired first, the rest at the least cost: a token that the column has costs
    nothing, another 1.5; a gap 1, or a half where the column already has one. Of the table, only
    every so many rows are kept, and the others computed again on the way back.
    """
    n, m = len(columns), len(seq)
    a = z = 0
    while a < min(n, m) and seq[a] in columns[a]:
        a += 1
    while z < min(n, m) - a and seq[m - 1 - z] in columns[n - 1 - z]:
        z += 1
    head, tail = [(i, i) for i in range(a)], [(n - z + i, m - z + i) for i in range(z)]
    columns, seq = columns[a : n - z], seq[a : m - z]
    n, m = len(columns), len(seq)
    if not n or not m:
        return head + [(a + i, -1) for i in range(n)] + [(-1, a + j) for j in range(m)] + tail
    ids: dict[str, int] = {}
    codes = [ids.setdefault(t, len(ids)) for t in seq]
    step = n if n * m <= 4_000_000 else int(n**0.5) + 1
    kept = [[float(j) for j in range(m + 1)]]
    for at in range(0, n - step, step):
        kept.append(_best_rows(columns[at : at + step], seq, ids, codes, kept[-1])[-1])
    i, j, pairs = n, m, []
    for k in range(len(kept) - 1, -1, -1):
        low = k * step
        best = _best_rows(columns[low : low + step], seq, ids, codes, kept[k])
        while i > low:
            c, up, here = columns[i - 1], best[i - 1 - low], best[i - low]
            if j and here[j] == up[j - 1] + (0.0 if seq[j - 1] in c else 1.5):
                i, j = i - 1, j - 1
                pairs.append((a + i, a + j))
            elif here[j] == up[j] + (0.5 if "" in c else 1.0):
                i -= 1
                pairs.append((a + i, -1))
            else:
                j -= 1
                pairs.append((-1, a + j))
    pairs += [(-1, a + x) for x in range(j - 1, -1, -1)]
    return head + pairs[::-1] + tail


def _distance(a: list[str], b: list[str]) -> int:
    """Tokens to insert, remove or replace."""
    x = z = 0
    while x < min(len(a), len(b)) and a[x] == b[x]:
        x += 1
    while z < min(len(a), len(b)) - x and a[-1 - z] == b[-1 - z]:
        z += 1
    a, b = a[x : len(a) - z], b[x : len(b) - z]
    if not a or not b:
        return len(a) + len(b)
    if len(b) < 48:
        row = list(range(len(b) + 1))
        for i, t in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(last + (t != y), row[j] + 1, row[j - 1] + 1)
        return row[-1]
    import numpy as np

    ids: dict[str, int] = {}
    codes, steps = np.array([ids.setdefault(t, len(ids)) for t in b]), np.arange(len(b) + 1)
    row = steps.copy()
    for i, t in enumerate(a, 1):
        best = np.minimum(row[:-1] + (codes != ids.get(t, -1)), row[1:] + 1)
        row = np.minimum.accumulate(np.append(i, best) - steps) + steps
    return int(row[-1])


def _merged(columns: list[dict], total: float, others: list[dict], weight: float) -> list[dict]:
    """Two profiles as one, aligned by the heaviest token of each of the second's columns."""
    seq = [_heaviest({t: w for t, w in c.items() if t} or c) for c in others]
    out = []
    for i, j in _align(columns, seq):
        column = columns[i] if i >= 0 else {"": total}
        for t, w in (others[j] if j >= 0 else {"": weight}).items():
            column[t] = column.get(t, 0.0) + w
        out.append(column)
    return out


def _heaviest(column: dict) -> str:
    return max(column.items(), key=lambda x: (x[1], x[0] != "", [-ord(ch) for ch in x[0]]))[0]


def _profile(seqs: list[list[str]], weights: list[float]) -> tuple[list[dict], float]:
    """Columns of token weights, with their sum, of sequences aligned in the given order."""
    columns, total = [{t: weights[0]} for t in seqs[0]], weights[0]
    for seq, w in zip(seqs[1:], weights[1:]):
        columns, total = _merged(columns, total, [{t: w} for t in seq], w), total + w
    return columns, total


def _voted(columns: list[dict]) -> list[str]:
    return [t for t in map(_heaviest, columns) if t]


def _ordered(values: list[str], weights: list[float]) -> list[int]:
    return sorted(range(len(values)), key=lambda k: (-weights[k], values[k]))


def consensus(values: list[str], weights: list[float]) -> tuple[str, str, int]:
    """(consensus text, existing value closest to it, its distance in tokens).

    Values are aligned by falling weight, ties by text; a column's heaviest token wins, ties
    by text, a gap only if it is heavier than any token. Of equally close values the heavier,
    then the smaller text is taken.
    """
    order = _ordered(values, weights)
    seqs = [_tokens(values[k]) for k in order]
    voted = _voted(_profile(seqs, [weights[k] for k in order])[0])
    d, _, value = min((_distance(seq, voted), -weights[k], values[k]) for k, seq in zip(order, seqs))
    return "".join(voted), value, d


def elected(members: list[dict], order: Sequence[tuple[str, bool]]) -> int:
    """Place of the member closest to the consensus of members, each a token a column of ``order``.

    order: (column, descending), nulls last, NaN above all numbers. Each member has four times the weight of the next.
    """
    import functools

    def compare(x: int, y: int) -> int:
        for name, descending in order:
            a, b = members[x][name], members[y][name]
            if a is None or b is None:
                if (a is None) != (b is None):
                    return 1 if a is None else -1
                continue
            a, b = ((v != v, 0 if v != v else v) for v in (a, b))
            if a != b:
                return -1 if (a > b) == descending else 1
        return 0

    if len(members) == 1:
        return 0
    places = sorted(range(len(members)), key=functools.cmp_to_key(compare))
    seqs = [[f"{name}={members[k][name]!r}" for name, _ in order] for k in places]
    voted = _voted(_profile(seqs, [4.0**-k for k in range(len(seqs))])[0])
    return min((_distance(seq, voted), k, place) for k, (seq, place) in enumerate(zip(seqs, places)))[2]


def elected_members(rows: DataFrame, group: str, order: Sequence[tuple[str, bool]], chunk: int = CHUNK) -> DataFrame:
    """group and the order columns of the elected member of every group.

    Of groups of more than ``chunk`` members, parts elect one each, and these are parted again.
    """
    names = [c for c, _ in order]
    spec = list(order)

    def vote(lists: pd.Series) -> pd.Series:
        return pd.Series([elected(list(x), spec) for x in lists], dtype="int32")

    choose = F.pandas_udf(vote, "int")
    level = rows.select(F.col(group).alias("__g"), *names)
    while True:
        sizes = level.groupBy("__g").agg(F.count("*").alias("__n"))
        big = materialize(sizes.filter(F.col("__n") > chunk))
        last = big.isEmpty()
        if last:
            parts = level.withColumn("__c", F.lit(0).cast("bigint"))
        else:
            n = F.ceil(F.coalesce("__n", F.lit(1)) / chunk).cast("bigint")
            parts = lookup_join(level, big, ["__g"], "left").withColumn("__c", F.pmod(F.xxhash64(*names), n)).drop("__n")
        lists = parts.groupBy("__g", "__c").agg(F.collect_list(F.struct(*names)).alias("x"))
        level = lists.select("__g", F.element_at("x", choose("x") + 1).alias("e")).select("__g", "e.*")
        if last:
            return level.withColumnRenamed("__g", group)
        level = materialize(level)


def _json_profile(values: pd.Series, weights: pd.Series) -> pd.Series:
    import json

    out = []
    for v, w in zip(values, weights):
        v, w = list(v), [float(x) for x in w]
        order = _ordered(v, w)
        out.append(json.dumps(_profile([_tokens(v[k]) for k in order], [w[k] for k in order])))
    return pd.Series(out, dtype="object")


def _json_merged(lists: pd.Series) -> pd.Series:
    import json

    out = []
    for x in lists:
        (columns, total), *rest = (json.loads(y) for y in x)
        for others, weight in rest:
            columns, total = _merged(columns, total, others, weight), total + weight
        out.append(json.dumps((columns, total)))
    return pd.Series(out, dtype="object")


def _json_distance(values: pd.Series, voted: pd.Series) -> pd.Series:
    import json

    return pd.Series([_distance(_tokens(v), json.loads(t)) for v, t in zip(values, voted)], dtype="int32")


def _consensus_value(values: pd.Series, weights: pd.Series) -> pd.Series:
    return pd.Series([consensus(list(v), [float(x) for x in w])[1] for v, w in zip(values, weights)], dtype="object")


def _json_voted(profiles: pd.Series) -> pd.Series:
    import json

    return pd.Series([json.dumps(_voted(json.loads(p)[0])) for p in profiles], dtype="object")


def field_consensus(values: DataFrame, keys: Sequence[str], chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """keys, value: for each key the existing value closest to the weighted consensus.

    values: keys, value, weight with distinct, non-null values a key. Up to ``chunk`` values make a
    profile; ``fan_in`` profiles are merged in a step; every value is then measured against the vote.
    """
    keys = list(keys)
    text = lambda f: F.pandas_udf(f, "string")
    values = materialize(values.select(*keys, "value", F.col("weight").cast("double").alias("weight")))
    sizes = materialize(values.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("value").alias("__one")))
    single = sizes.filter("__n = 1").select(*keys, F.col("__one").alias("value"))
    lists = lambda df, *k: df.groupBy(*k).agg(F.sort_array(F.collect_list(F.struct("value", "weight"))).alias("x"))
    few = sizes.filter(f"__n > 1 AND __n <= {chunk}").select(*keys)
    small = lists(lookup_join(values, few, keys, "left_semi"), *keys).select(*keys, text(_consensus_value)(F.col("x.value"), F.col("x.weight")).alias("value"))
    many = materialize(sizes.filter(f"__n > {chunk}").select(*keys, "__n"))
    if many.isEmpty():
        return single.unionByName(small)
    part = F.pmod(F.xxhash64("value"), F.ceil(F.col("__n") / (chunk // 2)).cast("bigint"))
    level = lists(lookup_join(values, many, keys).withColumn("__c", part), *keys, "__c")
    level = materialize(level.select(*keys, "__c", text(_json_profile)(F.col("x.value"), F.col("x.weight")).alias("p")))
    while not level.filter("__c > 0").isEmpty():
        up = level.withColumn("__up", F.expr(f"__c DIV {fan_in}")).groupBy(*keys, "__up").agg(F.sort_array(F.collect_list(F.struct("__c", "p"))).alias("x"))
        level = materialize(up.select(*keys, F.col("__up").alias("__c"), text(_json_merged)(F.col("x.p")).alias("p")))
    top = materialize(level.select(*keys, text(_json_voted)("p").alias("__voted")))
    near = lookup_join(values, top, keys).withColumn("__d", F.pandas_udf(_json_distance, "int")("value", "__voted"))
    best = near.groupBy(*keys).agg(F.min(F.struct("__d", (-F.col("weight")).alias("w"), "value"))["value"].alias("value"))
    return single.unionByName(small).unionByName(best)


def surviving_records(
    rows: DataFrame,
    group: str,
    order: Sequence[tuple[str, bool]],
    fields: Sequence[str],
    weight: str,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row a group: the one elected by ``order``, with null or blank ``fields`` filled.

    order: (column, descending), nulls last, ending in a unique column. A gap is filled with
    the group's value closest to the token consensus, weighted by ``weight`` (null or not
    positive counts as a small weight); a field that no record has stays null. Filled fields
    come back as strings in ``fields`` order, ``filled`` counts them. Rows with a null group
    are left out, repeated rows only add weight, other columns of the survivor pass
    through (one named ``filled`` is replaced). No rows give no rows.
    """
    fields, names = list(fields), [c for c, _ in order]
    rows = materialize(rows.drop("filled").filter(F.col(group).isNotNull()))
    text = {f: F.col(f).cast("string") for f in fields}
    has: dict[str, Column] = {f: F.when(F.trim(t) != "", t) for f, t in text.items()}
    chosen = materialize(elected_members(rows, group, order, chunk))
    best = materialize(lookup_join(rows, chosen, [group, *names], "left_semi").dropDuplicates([group]))
    lacking = F.array_compact(F.array(*[F.when(has[f].isNull(), F.lit(f)) for f in fields]))
    gaps = materialize(best.select(group, lacking.alias("__need")).filter(F.size("__need") > 0))
    # only the fields that a survivor lacks are voted on, in its own group
    w = F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.01))
    near = lookup_join(rows, gaps, [group])
    known = F.filter(F.array(*[F.struct(F.lit(f).alias("f"), has[f].alias("v")) for f in fields]), lambda x: x["v"].isNotNull() & F.array_contains("__need", x["f"]))
    cells = near.select(F.col(group).alias("__g"), w.alias("weight"), F.explode(known).alias("x"))
    cells = cells.groupBy("__g", F.col("x.f").alias("__f"), F.col("x.v").alias("value")).agg(F.sum("weight").alias("weight"))
    fill = field_consensus(cells, ["__g", "__f"], chunk).groupBy("__g").agg(F.map_from_entries(F.collect_list(F.struct("__f", "value"))).alias("__m"))
    out = lookup_join(best, fill.withColumnRenamed("__g", group), [group], "left")
    done = {f: F.coalesce(has[f], F.element_at("__m", F.lit(f))).alias(f) for f in fields}
    rest = [F.col(c) for c in rows.columns if c not in fields]
    return out.select(*rest, *done.values(), F.coalesce(F.size("__m"), F.lit(0)).alias("filled"))
