"""Problem 4: a sample whose category shares follow targets.

Weights are raked over the margins of every category column and of the joint category by
iterative proportional fitting, no category asking for more than it has. Items stand in each category in
the order of weighted exponential keys; a category's quota is drawn from the front of that order, at an
exact rank and without gathering a category. Minimums are then repaired. What targets miss is read from
the drawn order: a category is short where raking leaves it below its target and even its whole order,
items that others draw included, ends before it. Only the table of target categories, whose size is checked,
comes to the driver.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.common import lookup_join, materialize, norm, ranked

#: Most target categories that are raked on the driver.
MAX_TARGETS = 1_000_000


def rake(target: dict[tuple, float], have: dict[tuple, int], size: int, rounds: int = 200) -> dict[tuple, float]:
    """Expected rows of each category: the joint targets fitted to every single-column margin
    of the targets, no category above what it has; what a category lacks goes to those that
    share its column values."""
    import numpy as np

    out = dict.fromkeys(target, 0.0)
    cells = [c for c in target if have.get(c, 0) > 0]
    if not cells or size <= 0:
        return out
    share = np.array([target[c] for c in cells])
    most = np.array([have[c] for c in cells], dtype=float)
    margins = []
    for d in range(len(cells[0])):
        code: dict = {}
        for c in target:
            code.setdefault(c[d], len(code))
        every = np.bincount([code[c[d]] for c in target], weights=[target[c] * size for c in target], minlength=len(code))
        margins.append((np.array([code[c[d]] for c in cells]), every))
    x = np.minimum(most, share * size)
    x[x == 0] = 1e-9
    for _ in range(rounds):
        before = x
        for of, want in margins:
            now = np.bincount(of, weights=x, minlength=len(want))
            x = np.where(now[of] > 0, np.minimum(most, x * want[of] / np.where(now[of] > 0, now[of], 1.0)), x)
        if np.abs(x - before).max() < 1e-9:
            break
    # the rest of the sample goes where rows are left, in proportion to the targets
    for _ in range(rounds):
        gap = size - x.sum()
        room = (x < most - 1e-9) & (share > 0)
        if gap < 1e-6 or not room.any():
            break
        x = np.where(room, np.minimum(most, x + gap * share / share[room].sum()), x)
    return out | dict(zip(cells, x.tolist()))


def whole_quotas(x: dict[tuple, float], have: dict[tuple, int], least: dict[tuple, int], size: int) -> dict[tuple, int]:
    """Whole rows by largest remainder (ties by category), then minimums repaired: rows come
    from the categories furthest above their raked share that stay above their minimum."""
    order = {c: k for k, c in enumerate(sorted(x, key=str))}
    q = {c: min(int(v), have.get(c, 0)) for c, v in x.items()}
    rest = min(size, int(round(sum(x.values())))) - sum(q.values())
    for c in sorted(x, key=lambda c: (-(x[c] - int(x[c])), order[c])):
        if rest > 0 and q[c] < have.get(c, 0):
            q[c], rest = q[c] + 1, rest - 1
    for c in q:
        q[c] = max(q[c], min(least[c], have.get(c, 0)))
    over = sum(q.values()) - size
    givers = [(x[c] - q[c], order[c], c) for c in q if q[c] > least[c]]
    heapq.heapify(givers)
    while over > 0 and givers:
        _, k, c = heapq.heappop(givers)
        q[c], over = q[c] - 1, over - 1
        if q[c] > least[c]:
            heapq.heappush(givers, (x[c] - q[c], k, c))
    return q


def sample_by_targets(
    rows: DataFrame,
    item: str,
    columns: Sequence[str],
    weight: str | None,
    targets: DataFrame,
    share: str,
    minimum: str,
    one_in: int = 5,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(sample, report).

    The sample has floor(distinct items / one_in) rows at most, or more where the minimums ask for more, one an item, and the columns
    item, *columns, quota. String columns are trimmed and lower-cased. Null items are left out; rows
    outside the targets count as items but are not drawn; an item listed under several
    categories counts as available in each and is drawn once, under the first of them; its
    weight is the largest listed (null, NaN or not positive counts as 1). Repeated target rows
    are added up (minimum: the largest). The report has one row a target category: columns,
    target_share, min_rows, available, wanted, raked, drawn, gap (wanted minus drawn, at least 0),
    short (below its target or minimum after raking, and with every item of the category).
    """
    columns = list(columns)
    kinds = dict(rows.dtypes)
    key = lambda c: norm(c) if kinds[c] == "string" else F.col(c)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    w = F.when((w > 0) & ~F.isnan(w), w).otherwise(1.0)
    tkinds = dict(targets.dtypes)
    tkey = lambda c: norm(c) if tkinds[c] == "string" else F.col(c)
    wanted = targets.select(*[tkey(c).alias(c) for c in columns], F.col(share).cast("double").alias("target_share"), F.col(minimum).alias("min_rows"))
    wanted = wanted.groupBy(*columns).agg(F.sum("target_share").alias("target_share"), F.max("min_rows").alias("min_rows"))
    listed = wanted.limit(MAX_TARGETS + 1).collect()
    if len(listed) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} target categories")
    spark = rows.sparkSession
    cats = {tuple(r[c] for c in columns): k for k, r in enumerate(sorted(listed, key=lambda r: [str(r[c]) for c in columns]))}
    ordered = sorted(listed, key=lambda r: cats[tuple(r[c] for c in columns)])
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    table = spark.createDataFrame([(*c, k) for c, k in cats.items() if None not in c], f"{schema}, __cat int")
    # rows to categories while they are still rows, then distinct items, each with its first category
    items = rows.select(F.col(item).alias("__item"), *[key(c).alias(c) for c in columns], w.alias("__w")).filter("__item IS NOT NULL")
    items = lookup_join(items, table, columns, "left").groupBy("__item", "__cat").agg(F.max("__w").alias("__w"))
    place = F.row_number().over(Window.partitionBy("__item").orderBy(F.col("__cat").asc_nulls_last()))
    items = materialize(items.withColumn("__own", place == 1))
    size = items.filter("__own").count() // one_in
    matched = items.filter("__cat IS NOT NULL")
    free = {r[0]: r[1] for r in matched.filter("__own").groupBy("__cat").count().collect()}
    have = {c: free.get(k, 0) for c, k in cats.items()}
    target = {c: float(ordered[k]["target_share"] or 0.0) for c, k in cats.items()}
    least = {c: int(ordered[k]["min_rows"] or 0) for c, k in cats.items()}
    x = rake(target, have, size)
    quota = whole_quotas(x, have, least, size)
    need = {c: max(target[c] * size, float(least[c])) for c in cats}
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__item").cast("string"))), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)
    # an exponential key falls in (0, inf), 1 - exp(-key) in (0, 1); items that an earlier category draws stand behind
    place = (1.0 - F.pow(u, 1.0 / F.col("__w"))) + F.when(F.col("__own"), 0.0).otherwise(2.0)
    quotas = spark.createDataFrame([(k, quota[c], math.ceil(need[c]), *c) for c, k in cats.items()], f"__cat int, quota bigint, __need bigint, {schema}")
    order = ranked(matched.withColumn("__o", place), ["__cat"], "__o", "__rank", ["__item"])
    order = materialize(lookup_join(order, quotas, ["__cat"]).filter((F.col("__rank") <= F.col("quota")) | (F.col("__rank") <= F.col("__need"))))
    within = F.col("__own") & (F.col("__rank") <= F.col("quota"))
    sample = order.filter(within).select(F.col("__item").alias(item), *columns, "quota")
    counted = {r[0]: (r[1], r[2]) for r in order.groupBy("__cat").agg(F.count(F.when(within, 1)), F.count(F.when(F.col("__rank") <= F.col("__need"), 1))).collect()}
    available = {r[0]: r[1] for r in matched.groupBy("__cat").count().collect()}
    lines = []
    for c, k in cats.items():
        drawn, reached = counted.get(k, (0, 0))
        short = x[c] < math.ceil(need[c]) and reached < math.ceil(need[c])
        lines.append((*c, target[c], least[c], available.get(k, 0), target[c] * size, x[c], drawn, max(0.0, need[c] - drawn), short))
    report = spark.createDataFrame(lines, f"{schema}, target_share double, min_rows int, available bigint, wanted double, raked double, drawn bigint, gap double, short boolean")
    return sample, report
