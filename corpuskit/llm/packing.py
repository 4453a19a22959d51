"""Problem 8: documents into containers of fixed capacity.

Every partition packs its items best-fit decreasing; a dual-feasible-function lower bound
certifies its bin count. Partitions with a gap give the items of their unfilled bins back;
these are exchanged, packed anew together, and certified again, until gaps close or a round
gains nothing.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import materialize, release

#: Vocabulary of public byte-level BPE ranks; its path is a parameter.
VOCABULARY = "file:///opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split pattern that belongs to that vocabulary. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def token_counts(docs: DataFrame, doc_id: str, text: str, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc, tokens) of every document with a text, whole texts counted.

    The vocabulary file, on any file system that Spark reads (limited to 64 MB), is read once on the driver and broadcast.
    """
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(vocabulary)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getFileStatus(path).getLen() > 64 << 20:
        raise ValueError("the vocabulary is larger than 64 MB")
    stream = files.open(path)
    try:
        shared = spark.sparkContext.broadcast(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()

    def run(batches: Iterator) -> Iterator:
        import base64

        import pandas as pd
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in shared.value.splitlines() if line)}
        coder = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for pdf in batches:
            pdf = pdf.dropna()
            yield pd.DataFrame({"doc": pdf["doc"].astype("int64"), "tokens": [len(coder.encode_ordinary(t)) for t in pdf["text"]]}, columns=["doc", "tokens"]).astype("int64")

    return docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).filter("doc IS NOT NULL AND text IS NOT NULL").mapInPandas(run, "doc bigint, tokens bigint")


def best_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin of each item, free space of each bin); sizes in falling order."""
    import bisect

    bins, free, open_at, levels = [], [], {}, []
    for s in sizes:
        k = bisect.bisect_left(levels, s)
        if k == len(levels):
            b, rest = len(free), capacity - s
            free.append(rest)
        else:
            level = levels[k]
            own = open_at[level]
            b, rest = own.pop(), level - s
            if not own:
                del open_at[level], levels[k]
            free[b] = rest
        bins.append(b)
        if rest:
            if rest not in open_at:
                open_at[rest] = []
                bisect.insort(levels, rest)
            open_at[rest].append(b)
    return bins, free


def lower_bound(sizes, counts, capacity: int, steps: int = 20) -> int:
    """Bins that any packing of ``counts`` items of ``sizes`` needs: the best of the
    threshold functions (items above capacity - t fill a bin, items below t count nothing)
    and the rounding functions of 1 to ``steps``, each dual feasible."""
    import numpy as np

    if not len(sizes):
        return 0
    hist = np.zeros(capacity + 1, dtype=np.int64)
    np.add.at(hist, np.asarray(sizes, dtype=np.int64), np.asarray(counts, dtype=np.int64))
    x = np.arange(capacity + 1, dtype=np.int64)
    many, mass = np.append(np.cumsum(hist[::-1])[::-1], 0), np.append(np.cumsum((hist * x)[::-1])[::-1], 0)
    t = np.arange(0, capacity // 2 + 1)
    big = many[capacity - t + 1]
    middle = mass[t] - mass[capacity - t + 1]
    best = int(np.max(big + -(-middle // capacity)))
    for k in range(1, steps + 1):
        # in units of capacity * k: exact multiples of capacity / (k + 1) keep their size
        scaled = (k + 1) * x
        value = np.where(scaled % capacity == 0, x * k, (scaled // capacity) * capacity)
        best = max(best, int(-(-int((hist * value).sum()) // (capacity * k))))
    return best


def _pack(pdf):
    import numpy as np

    capacity = int(pdf["capacity"].iloc[0])
    pdf = pdf.sort_values(["size", "doc", "piece"], ascending=[False, True, True])
    bins, free = best_fit_decreasing(pdf["size"].tolist(), capacity)
    sizes, counts = np.unique(pdf["size"].to_numpy(), return_counts=True)
    pdf["bin"] = bins
    pdf["free"] = np.asarray(free, dtype=np.int64)[bins]
    pdf["gap"] = len(free) - lower_bound(sizes, counts, capacity)
    emptiest = int(np.argmax(free))
    pdf["loosest"] = (pdf["bin"] == emptiest) & (pdf["free"] > 0)
    return pdf.astype({"bin": "int64", "free": "int64", "gap": "int64"})


def certified_bounds(items: DataFrame) -> DataFrame:
    """(container, lower_bound) of (container, capacity, size) items.

    The bound needs only the number of items of each size, at most ``capacity`` rows a container.
    """

    def bound(pdf):
        import pandas as pd

        name, capacity = pdf["container"].iloc[0], int(pdf["capacity"].iloc[0])
        return pd.DataFrame([(name, lower_bound(pdf["size"].to_numpy(), pdf["n"].to_numpy(), capacity))], columns=["container", "lower_bound"])

    sizes = items.groupBy("container", "capacity", "size").agg(F.count("*").alias("n"))
    return sizes.groupBy("container").applyInPandas(bound, "container string, lower_bound bigint")


_ITEM = "container string, capacity bigint, doc bigint, piece bigint, start bigint, size bigint, part int"


def pack_documents(counts: DataFrame, specs: DataFrame, part_items: int = 20_000) -> DataFrame:
    """container, bin, doc_id, piece, start_token, tokens: each document in every container.

    counts: (doc, tokens), one row a document; specs: (container, capacity_tokens), a few rows. A text larger than
    the capacity is cut into full pieces and a rest; all others stay whole. Texts without tokens
    are left out, as are null or non-positive capacities; equal sizes are taken in order of the
    id. A part packs about ``part_items`` items in one task, twice as many after each of the first four exchanges;
    exchanges end when a container is at its bound or one didn't help it. More than 1,000 containers are refused.
    """
    specs = specs.filter("container IS NOT NULL AND capacity_tokens > 0").select("container", F.col("capacity_tokens").cast("bigint").alias("capacity"))
    specs = specs.groupBy("container").agg(F.max("capacity").alias("capacity"))
    listed = [(r[0], r[1]) for r in specs.limit(1001).collect()]
    if len(listed) > 1000:
        raise ValueError("more than 1000 containers")
    counts = counts.filter("tokens > 0")
    if not listed:
        return counts.select(F.lit("").alias("container"), F.lit("").alias("bin"), F.col("doc").alias("doc_id"), F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("start_token"), "tokens").filter("false")
    kinds = F.array(*[F.struct(F.lit(n).alias("container"), F.lit(c).cast("bigint").alias("capacity")) for n, c in listed])
    each = counts.select("doc", "tokens", F.explode(kinds).alias("k")).select("doc", "tokens", "k.container", "k.capacity")
    whole = F.expr("tokens DIV capacity")
    full = each.filter("tokens >= capacity").select("container", "doc", "capacity", F.explode(F.sequence(F.lit(0).cast("bigint"), whole - 1)).alias("piece"))
    full = full.select("container", F.concat_ws("-", "container", F.lit("full"), "doc", "piece").alias("bin"), "doc", "piece", (F.col("piece") * F.col("capacity")).alias("start"), F.col("capacity").alias("size"))
    docs = counts.count()
    parts = max(1, -(-docs // part_items))
    rest = each.filter("tokens % capacity > 0").select("container", "capacity", "doc", whole.alias("piece"), (whole * F.col("capacity")).alias("start"), (F.col("tokens") % F.col("capacity")).alias("size"))
    loose = materialize(rest.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(parts)).cast("int")))
    goal = {x[0]: x[1] for x in certified_bounds(loose).collect()}
    done, settled = [], dict.fromkeys(goal, 0)
    count = lambda df: {x[0]: x[1] for x in df.select("container", "bin").distinct().groupBy("container").count().collect()}
    before: dict[str, int] = {}
    for r in itertools.count():
        packed = materialize(loose.groupBy("container", "part").applyInPandas(_pack, _ITEM + ", bin bigint, free bigint, gap bigint, loosest boolean"))
        release(loose)
        named = packed.select("container", F.concat_ws("-", "container", F.lit(r), "part", "bin").alias("bin"), "doc", "piece", "start", "size", "capacity", "free", "gap", "loosest")
        now = count(named)
        # a container at its bound is certified as a whole, and one that a round didn't help is left
        swap = [c for c, n in now.items() if settled[c] + n > goal[c] and n < before.get(c, n + 1)]
        if not swap:
            done.append(named)
            break
        # full bins and certified parts stay, but for the part's loosest bin
        back = F.col("container").isin(swap) & (F.col("free") > 0) & ((F.col("gap") > 0) | F.col("loosest"))
        done.append(named.filter(~back))
        kept, before = count(named.filter(~back)), count(named.filter(back))
        settled = {c: settled[c] + kept.get(c, 0) for c in settled}
        again = named.filter(back).select("container", "capacity", "doc", "piece", "start", "size")
        sizes = [(x[0], x[1]) for x in again.groupBy("container").count().collect()]
        of = F.coalesce(*[F.when(F.col("container") == c, F.lit(max(1, -(-n // (part_items << min(r + 1, 4)))))) for c, n in sizes], F.lit(1))
        loose = materialize(again.withColumn("part", F.pmod(F.xxhash64("doc", F.lit(r)), of).cast("int")))
    out = full
    for d in done:
        out = out.unionByName(d.select("container", "bin", "doc", "piece", "start", "size"))
    return out.select("container", "bin", F.col("doc").alias("doc_id"), "piece", F.col("start").alias("start_token"), F.col("size").alias("tokens"))


def packing_report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """container, capacity, items, tokens, bins, lower_bound, filled, each over all its bins."""
    caps = specs.select("container", F.col("capacity_tokens").cast("bigint").alias("capacity"))
    bounds = certified_bounds(packed.withColumnRenamed("tokens", "size").join(caps, "container"))
    bins = packed.groupBy("container", "bin").agg(F.count("*").alias("items"), F.sum("tokens").alias("tokens"))
    bins = bins.groupBy("container").agg(F.sum("items").alias("items"), F.sum("tokens").alias("tokens"), F.count("*").alias("bins"))
    out = bins.join(bounds, "container").join(caps, "container")
    return out.select("container", "capacity", "items", "tokens", "bins", "lower_bound", F.round(F.col("tokens") / (F.col("bins") * F.col("capacity")), 6).alias("filled"))
