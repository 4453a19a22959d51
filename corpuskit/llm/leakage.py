"""Problem 9: evaluation passages inside documents, by greedy string tiling.

Every text is reduced to its letters, so neither case, punctuation, accents, layout, markup,
hyphenation nor lookalike characters matter; words of an item are stretches of its letters.
Running Karp-Rabin fingerprints of the document (one vectorised pass) are joined with
the fingerprints of the items' stretches of a few words. Where an item has as many of these seeds as a leak must
have, the longest match is marked again and again, matches never overlapping in the item; the longest tile tells
an exact run of words, the share of words marked tells passages that were cut and reordered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.common import materialize
from .plaintext import letters, numbered_letters

#: Most characters of a fingerprint (a power of two), and characters of the items matched in one pass.
SEED_CHARS = 16
BLOCK_CHARS = 64 << 20


def _item(text: str) -> tuple[str, list[int]]:
    """The item's letters and the start of each word, with the end of the last."""
    starts, parts, at = [], [], 0
    for w in text.split():
        x = letters(w)
        if x:
            starts.append(at)
            parts.append(x)
            at += len(x)
    return "".join(parts), [*starts, at]


def tiles(doc: str, at: list[int], item: str, starts: list[int], pos: list[int]) -> list[tuple[int, int, int]]:
    """Greedy tiles (item word, words, document position) from seeds (document position at,
    item position pos): the longest match of whole item words first, ties by item, then by
    document position."""
    import bisect

    found, covered = [], {}
    for d, p in sorted(zip(at, pos)):
        if covered.get(d - p, -1) >= d:
            continue
        i, j = d, p
        while i > 0 and j > 0 and doc[i - 1] == item[j - 1]:
            i, j = i - 1, j - 1
        e, k = d, p
        while e < len(doc) and k < len(item) and doc[e] == item[k]:
            e, k = e + 1, k + 1
        covered[d - p] = e
        first, last = bisect.bisect_left(starts, j), bisect.bisect_right(starts, k) - 1
        if last > first:
            found.append((last - first, first, i + starts[first] - j))
    marked = [False] * (len(starts) - 1)
    out = []
    while found:
        n, first, d = max(found, key=lambda x: (x[0], -x[1], -x[2]))
        out.append((first, n, d))
        marked[first : first + n] = [True] * n
        rest = []
        for n, first, d in found:  # what is left of the other matches
            run = None
            for w in range(first, first + n + 1):
                free = w < first + n and not marked[w]
                if free and run is None:
                    run = w
                if not free and run is not None:
                    rest.append((w - run, run, d + starts[run] - starts[first]))
                    run = None
        found = rest
    return out


def joins_entries(tile: tuple[int, int, int], starts: list[int], entries: list[tuple[int, int]]) -> bool:
    """Whether a tile crosses the start of a list entry but holds no whole entry: the end of one
    and the beginning of the next may be neighbours by chance."""
    first, n, d = tile
    end = d + starts[first + n] - starts[first]
    return any(d < a < end for a, _ in entries) and not any(d <= a < b <= end for a, b in entries)


def seeds_needed(words: int, min_words: int, min_coverage: float, gram: int) -> int:
    """Seeds without which an item of ``words`` words can't be reported. A tile of n words holds the
    n - gram + 1 grams that start in it, so ``min_words`` words hold min_words - gram + 1, and tiles of
    gram words or more that cover a share of the item hold at least one for every gram words covered."""
    return max(1, min(min(min_words, words) - gram + 1, math.ceil(min_coverage * words / gram - 1e-9)))


def _matcher(items: list[tuple[int, str, list[int]]], min_words: int, min_coverage: float, tile_words: int):
    import numpy as np

    base = 1_000_003

    def prints(codes: np.ndarray) -> dict[int, np.ndarray]:
        """Fingerprints of every stretch of 1, 2, 4 ... SEED_CHARS characters."""
        h, size = codes.astype(np.uint64) + np.uint64(1), 1
        out = {1: h}
        with np.errstate(over="ignore"):
            while size < SEED_CHARS and len(h) > size:
                h = h[:-size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
                size *= 2
                out[size] = h
        return out

    code = lambda t: np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
    found: dict[int, list] = {}
    # what an item needs: seeds in all, seeds on one diagonal or words under seeds, words of a seed
    least, in_line, under, wide = (np.zeros(len(items), dtype=np.int64) for _ in range(4))
    for k, (_, text, starts) in enumerate(items):
        words = len(starts) - 1
        gram = min(tile_words, words)
        least[k] = seeds_needed(words, min_words, min_coverage, gram)
        in_line[k], under[k], wide[k] = min(min_words, words) - gram + 1, math.ceil(min_coverage * words - 1e-9), gram
        own, at = prints(code(text)), np.asarray(starts, dtype=np.int64)
        # the seed of a gram is its longest beginning of 1, 2, 4 ... SEED_CHARS characters
        size = np.minimum(2 ** np.floor(np.log2(at[gram:] - at[: words - gram + 1])).astype(np.int64), SEED_CHARS)
        for n in np.unique(size).tolist():
            i = np.flatnonzero(size == n)
            found.setdefault(n, []).append((own[n][at[i]], np.full(len(i), k), i, at[i]))
    tables = []
    for n, parts in found.items():
        keys, *rest = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(keys, kind="stable")
        keys, rest = keys[order], [x[order] for x in rest]
        shift = np.uint64(64 - min(26, max(12, (64 * len(keys)).bit_length())))
        filled = np.zeros(1 << (64 - int(shift)), dtype=bool)
        mixed = lambda h, shift=shift: (h * np.uint64(0x9E3779B97F4A7C15)) >> shift
        filled[mixed(keys).astype(np.int64)] = True
        tables.append((n, keys, rest, filled, mixed))

    def match(texts: list[str]) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
        """Tiles of every (text, item) where the text's letters hold enough seeds of the item."""
        buffer = code("\n".join(texts))
        ends = np.cumsum([len(t) + 1 for t in texts])
        own, hits = prints(buffer), []
        for n, keys, rest, filled, mixed in tables:
            if n not in own:
                continue
            h = own[n]
            at = np.flatnonzero(filled[mixed(h).astype(np.int64)])
            lo = np.searchsorted(keys, h[at], "left")
            known = keys[np.minimum(lo, len(keys) - 1)] == h[at]
            at, lo = at[known], lo[known]
            many = np.searchsorted(keys, h[at], "right") - lo
            slot = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            hits.append((np.repeat(at, many), *(x[slot] for x in rest)))
        if not hits or not sum(len(x[0]) for x in hits):
            return {}
        d, k, i, p = (np.concatenate(x) for x in zip(*hits))
        of = np.searchsorted(ends, d, "right")
        pair = of * len(items) + k
        _, inverse, count = np.unique(pair, return_inverse=True, return_counts=True)
        enough = count[inverse] >= least[k]
        d, k, i, p, of, pair = (x[enough] for x in (d, k, i, p, of, pair))
        if not len(d):
            return {}

        def reached(value: np.ndarray, owner: np.ndarray, need: np.ndarray, apart: bool) -> set[int]:
            """Pairs with ``need`` equal values (apart: different ones)."""
            order = np.lexsort((value, owner))
            value, owner = value[order], owner[order]
            new = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]
            if apart:
                found, n = np.unique(owner[new], return_counts=True)
            else:
                found, n = owner[new], np.diff(np.append(np.flatnonzero(new), len(value)))
            return set(found[n >= need[found % len(items)]].tolist())

        some = reached(d - p, pair, in_line, False)
        spans = [(o < wide[k]) for o in range(int(wide[k].max()))]
        some |= reached(np.concatenate([i[ok] + o for o, ok in enumerate(spans)]), np.concatenate([pair[ok] for ok in spans]), under, True)
        out = {}
        if some:
            order = np.argsort(pair, kind="stable")
            pair, d, p = pair[order], d[order], p[order]
            for x in sorted(some):
                t, item = divmod(x, len(items))
                mine = slice(*np.searchsorted(pair, [x, x + 1]))
                start = int(ends[t]) - len(texts[t]) - 1
                out[t, item] = tiles(texts[t], (d[mine] - start).tolist(), items[item][1], items[item][2], p[mine].tolist())
        return out

    return match


def _buffers(pdf, chars: int = 1 << 20) -> Iterator[list[tuple]]:
    """(row, letters, list entries) of every reading, in groups of about ``chars`` letters."""
    group, size = [], 0
    for row, (plain, listing, entries) in enumerate(zip(pdf["plain"], pdf["listing"], pdf["entries"])):
        for text, cuts in ((plain, None), (listing, entries)):
            if text:
                group.append((row, text, cuts))
                size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def _readings(batches: Iterator) -> Iterator:
    """doc, the letters of each text, and those without the numbers of a list, with its entries."""
    import pandas as pd

    for pdf in batches:
        rows = []
        for doc, t in zip(pdf["doc"].tolist(), pdf["text"].tolist()):
            rows.append((doc, letters(t), *(numbered_letters(t) or (None, None))))
        yield pd.DataFrame(rows, columns=["doc", "plain", "listing", "entries"])


def leaked_passages(
    docs: DataFrame,
    doc_id: str,
    text: str,
    items: DataFrame,
    item_id: str,
    item_text: str,
    min_words: int = 12,
    min_coverage: float = 0.5,
    tile_words: int = 4,
) -> DataFrame:
    """item_id, doc_id, longest, covered, words, coverage, tiles of every document that holds
    ``min_words`` consecutive words of an item, or covers ``min_coverage`` of its words with
    tiles of at least ``tile_words`` words in any order.

    Null and empty texts match nothing; whole texts are searched, however long; items
    shorter than ``min_words`` words must be held whole; repeated documents each come out,
    repeated item ids are matched as separate texts and merged by the best. Numbered lists are also
    read without numbers that rise one by one, where a run holds a whole entry. No seed is left out,
    so nothing that fits is lost. Items are broadcast; beyond BLOCK_CHARS characters they are taken in
    blocks of that size, and documents are reduced to letters once for all blocks. Documents are never moved.
    """
    spark = docs.sparkSession
    schema = "item bigint, doc bigint, longest int, covered int, words int, tiles int"
    own = items.filter(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text).alias("text"))
    total = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text")).filter("doc IS NOT NULL AND text IS NOT NULL AND text <> ''")
    narrow = narrow.mapInPandas(_readings, "doc bigint, plain string, listing string, entries array<array<bigint>>") if blocks > 1 else narrow
    narrow = materialize(narrow) if blocks > 1 else narrow
    out = None
    for b in range(blocks):
        block = own.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else own
        # the matcher is built once a worker and kept beside the items it was built from
        shared = spark.sparkContext.broadcast({"items": sorted((r[0], *_item(r[1])) for r in block.collect())})

        def run(batches: Iterator, shared=shared) -> Iterator:
            import pandas as pd

            kept = shared.value
            if "match" not in kept:
                kept["listed"] = [x for x in kept["items"] if len(x[2]) > 1]
                kept["match"] = _matcher(kept["listed"], min_words, min_coverage, tile_words)
            listed, match = kept["listed"], kept["match"]
            for pdf in batches if blocks > 1 else _readings(batches):
                best: dict[tuple[int, int], tuple] = {}
                for group in _buffers(pdf):
                    for (t, k), tl in match([x[1] for x in group]).items():
                        row, _, cuts = group[t]
                        item, words = listed[k][0], len(listed[k][2]) - 1
                        if cuts is not None:
                            tl = [x for x in tl if not joins_entries(x, listed[k][2], cuts)]
                        sizes = [n for _, n, _ in tl if n >= tile_words or n == words]
                        if not sizes:
                            continue
                        longest, covered = max(sizes), sum(sizes)
                        if longest >= min(min_words, words) or covered >= min_coverage * words:
                            found = (longest, covered, words, len(sizes))
                            best[row, item] = max(best.get((row, item), found), found)
                ids = pdf["doc"].tolist()
                rows = [(item, ids[row], *found) for (row, item), found in best.items()]
                yield pd.DataFrame(rows, columns=["item", "doc", "longest", "covered", "words", "tiles"]).astype({"item": "int64", "doc": "int64", "longest": "int32", "covered": "int32", "words": "int32", "tiles": "int32"})

        part = narrow.mapInPandas(run, schema)
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("item").alias(item_id), F.col("doc").alias(doc_id), "longest", "covered", "words", F.round(F.col("covered") / F.col("words"), 6).alias("coverage"), "tiles")
