"""Packing, leaks and spam pages."""

import os
import random

import numpy as np
import pytest

from corpuskit.llm import leakage as L
from corpuskit.llm.leakage import _item, _matcher, leaked_passages, tiles
from corpuskit.llm.packing import VOCABULARY, best_fit_decreasing, lower_bound, pack_documents, packing_report, token_counts
from corpuskit.llm.plaintext import letters
from corpuskit.llm.spam import EVIDENCE, FEATURES, STOPWORDS, page_reader, spam_pages, weak_label, with_views

SPECS = [("s", 10), ("m", 64), ("zero", 0), (None, 5)]


def fewest(sizes, capacity):
    """Bins of an optimal packing by exhaustive search."""
    best = [len(sizes)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity:
                bins[i] += sizes[k]
                go(k + 1, bins)
                bins[i] -= sizes[k]
        go(k + 1, bins + [sizes[k]])

    go(0, [])
    return best[0]


def test_bound_never_exceeds_optimum():
    rng = random.Random(1)
    for _ in range(150):
        c = rng.randrange(4, 30)
        sizes = sorted((rng.randrange(1, c + 1) for _ in range(rng.randrange(1, 9))), reverse=True)
        u, n = np.unique(sizes, return_counts=True)
        best = fewest(sizes, c)
        bins, free = best_fit_decreasing(sizes, c)
        assert lower_bound(u, n, c) <= best <= len(free)
        load = [0] * len(free)
        for b, s in zip(bins, sizes):
            load[b] += s
        assert [c - x for x in load] == free and min(free) >= 0
    assert lower_bound([6], [4], 10) == 4 and lower_bound([], [], 10) == 0


@pytest.mark.parametrize("part_items", [20, 20_000])
def test_packing_keeps_everything(spark, part_items):
    rng = random.Random(2)
    data = [(i, rng.choice([0, 1, 3, 4, 5, 6, 7, 9, 10, 11, 64, 65, 200])) for i in range(700)]
    counts = spark.createDataFrame(data, "doc bigint, tokens bigint")
    specs = spark.createDataFrame(SPECS, "container string, capacity_tokens int")
    packed = pack_documents(counts, specs, part_items=part_items)
    got = packed.collect()
    for name, c in SPECS[:2]:
        own = [r for r in got if r["container"] == name]
        pieces = {}
        for r in own:
            pieces.setdefault(r["doc_id"], []).append((r["start_token"], r["tokens"]))
        assert set(pieces) == {d for d, n in data if n}
        for d, n in data:
            at = 0
            for start, size in sorted(pieces.get(d, [])):
                assert start == at and (n > c or size == n)
                at += size
            assert at == n
        load = {}
        for r in own:
            load[r["bin"]] = load.get(r["bin"], 0) + r["tokens"]
        assert max(load.values()) <= c
        report = next(r for r in packing_report(packed, specs).collect() if r["container"] == name)
        assert report["bins"] == len(load) >= report["lower_bound"] and report["bins"] <= report["lower_bound"] * (1.03 if part_items < 100 else 1.005) + 1


def test_packing_empty(spark):
    counts = spark.createDataFrame([], "doc bigint, tokens bigint")
    specs = spark.createDataFrame(SPECS, "container string, capacity_tokens int")
    assert pack_documents(counts, specs).count() == 0
    assert pack_documents(spark.createDataFrame([(1, 5)], "doc bigint, tokens bigint"), specs.filter("false")).count() == 0


@pytest.mark.skipif(not os.path.exists(VOCABULARY.removeprefix("file://")), reason="no vocabulary")
def test_token_counts(spark):
    long = "lumen " * 50_000
    docs = spark.createDataFrame([(1, "hello world", 1), (2, "", 2), (3, None, 3), (None, "x", 4), (5, long, 5), (6, "<|endoftext|>", 6)], "doc_id bigint, text string, tokens int")
    got = {r["doc"]: r["tokens"] for r in token_counts(docs, "doc_id", "text").collect()}
    assert got[1] == 2 and got[2] == 0 and set(got) == {1, 2, 5, 6} and got[5] >= 50_000 and got[6] > 1


ITEM = "A careful reader notices thirteen ochre brass kettles whose outlines repeat exactly, first around the ears and again behind a school's half-drawn orchestra of old façades."


def test_letters():
    assert letters("<p>Ünlike&nbsp;an оrсhаrd,</p> [x](http://a.b/c) thim-\nbles") == "unlikeanorchardxthimbles"
    assert letters("1. first\n> 2) second") == "1first2second"


def test_leaks_in_numbered_lists(spark):
    w = ITEM.split()
    lines = [" ".join(w[i : i + 3]) for i in range(0, len(w), 3)]
    data = [
        (1, "\n".join(f"{i}. {x}" for i, x in enumerate(lines, 4))),
        (2, "intro\n" + "\n".join(f"> {i}) {x}" for i, x in enumerate(lines[:4], 1)) + "\nmore"),
        (3, "\n".join(f"{i % 2}. {x}" for i, x in enumerate(lines[::-1]))),
        (4, "1. noise and " + " ".join(w[:6]) + "\n2. " + " ".join(w[6:12]) + " goes on"),
    ]
    docs = spark.createDataFrame(data, "d bigint, t string")
    items = spark.createDataFrame([(7, ITEM)], "i bigint, x string")
    got = {r["d"]: (r["longest"], r["words"]) for r in leaked_passages(docs, "d", "t", items, "i", "x").collect()}
    assert got == {1: (len(w), len(w)), 2: (12, len(w))}


def test_leaks_in_disguise(spark):
    w = ITEM.split()
    spoof = ITEM.replace("o", "о").replace("e", "е").replace(" ", " ")
    hidden = "".join(ch + ("​" if i % 7 == 3 else "­" if i % 11 == 5 else "") for i, ch in enumerate(ITEM))
    marked = " ".join(f"<b>{x}</b>" if i % 3 == 0 else x for i, x in enumerate(w)).replace(" ", "&nbsp;", 4)
    data = [
        (1, "Before. " + ITEM + " After."),
        (2, ITEM.upper().replace(",", "")),
        (3, spoof),
        (4, hidden),
        (5, marked),
        (6, "> " + ITEM.replace("thirteen", "thir-\n> teen").replace("ears ", "ears\n> ")),
        (7, " ".join(w[3:15])),
        (8, " ".join(w[3:14])),
        (9, "noise " * 30_000 + " ".join(w[5:20])),
        (10, None),
        (11, ""),
        (12, " ".join(w[14:]) + " then something else " + " ".join(w[:9])),
        (1, "Before. " + ITEM + " After."),
        (None, ITEM),
        (13, "wholly unrelated text about kettles and ears"),
        (14, "a short one of six words"),
    ]
    docs = spark.createDataFrame(data, "doc bigint, text string")
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "A short one, of six WORDS"), (None, "x")], "item bigint, text string")
    out = leaked_passages(docs, "doc", "text", items, "item", "text").collect()
    hit = sorted(r["doc"] for r in out if r["item"] == 1 and r["longest"] >= 12)
    assert hit == [1, 1, 2, 3, 4, 5, 6, 7, 9, 12] or hit == [1, 1, 2, 3, 4, 5, 6, 7, 9]
    moved = next(r for r in out if r["doc"] == 12)
    assert moved["coverage"] > 0.8 and moved["tiles"] == 2
    assert not any(r["doc"] in (8, 13) for r in out)
    assert [r["doc"] for r in out if r["item"] == 4] == [14]
    assert leaked_passages(docs.limit(0), "doc", "text", items, "item", "text").count() == 0
    assert leaked_passages(docs, "doc", "text", items.limit(0), "item", "text").count() == 0


def test_tiles_do_not_overlap():
    item, starts = _item("one two three four five six")
    doc = letters("three four five six then one two three four")
    at = [(doc.find(item[s : s + 3], k), s) for s in starts[:-1] for k in (0, 15)]
    got = tiles(doc, [a for a, _ in at if a >= 0], item, starts, [p for a, p in at if a >= 0])
    words = [w for first, n, _ in got for w in range(first, first + n)]
    assert len(words) == len(set(words)) == 6 and got[0][1] == 4


SPAM = [
    "buy lamp cheap lamp best lamp cheap lamp buy lamp best cheap lamp lamp buy lamp cheap",
    "\n".join(f"https://shop.test/a/{i}" for i in range(20)),
    " ".join(f"#best_lamp{i}" for i in range(20)),
    ", ".join(["lamp free", "photo cheap", "best chair", "table sale"] * 6),
    "\n".join(["lamp free", "photo cheap", "best chair", "table sale"] * 5),
    "<ul>" + "".join(f'<li><a href="http://x.test/{i}">lamp {w}</a></li>' for i, w in enumerate("free buy cheap best new sale top stock".split())) + "</ul>",
]
HONEST = [
    "The museum and the second reviewer did not agree about the picture. It shows a kite above a quarry. " * 3,
    "a fox near a vending machine, muted palette, ink outlines, flat lay, long exposure",
    "[INFO] hashing real_food took 388 batches, rate 3.2\n[OK] merged basalt with 8286 edges, ratio 33.7\n[WARN] oldgan: 6038 files skipped, 29.32 GB left",
    "model:\n  name: pastel\n  threshold: 0.685\ndata:\n  source: dump\n  root: /mnt/pool/fake\n  batch: 61",
    "The archive was kept after the merge because the labels were good enough for the test. See also the notes of the team.\n[1] http://a.test/1\n[2] http://a.test/2",
    "source,label,files,kept\nreal_aerial,0,3234,0.206\nreal_museum,0,3903,0.074\ngen_web,1,1497,0.678",
]


def test_labels_and_spam(spark):
    data = [(i * 100 + k, t, f"site_{i % 3}" if k % 2 else None, "x") for k in range(12) for i, t in enumerate(SPAM + HONEST)]
    data += [(5000, None, "site_1", "x"), (None, SPAM[0], "site_1", "x"), (5001, "", "", "x"), (5002, "?", " ", "x")]
    docs = spark.createDataFrame(data, "doc bigint, body string, host string, spam string")
    labels = {r["page"]: r["label"] for r in with_views(docs, "doc", "body", "host").withColumn("label", weak_label()).collect()}
    assert all(labels[i * 100] in (1.0 if i < len(SPAM) else 0.0, None) for i in range(len(SPAM + HONEST)))
    assert sum(labels[i * 100] is not None for i in range(len(SPAM + HONEST))) >= 11 and labels[5001] == 0.0
    out = spam_pages(docs, "doc", "body", "host").collect()
    assert {r["page"] for r in out if r["spam"]} == {i * 100 + k for k in range(12) for i in range(len(SPAM))}
    assert len(out) == 12 * 12 + 2


def test_page_reader():
    read = page_reader(STOPWORDS)
    view = lambda t: dict(zip(EVIDENCE + FEATURES, read(t)))
    assert not set(EVIDENCE) & set(FEATURES)
    assert view("")["size"] == 0 and view("?!")["words"] == 0
    long = view("lamp " * 200_000)
    assert long["size"] == long["words"] == 200_000 and long["top"] == 1.0
    links = view('<a href="http://x.test/1">lamp</a> [b](http://y.test) www.z.test #tag')
    assert links["links"] == 3 and links["tags"] == 1 and links["hidden"] > 0.4
    assert view("tripod head 64gb 12.99 new, tripod head 3,95")["prices"] == 2 and view("rate 12.9934 in 3.2 s")["prices"] == 0


def test_host_rate_shifts_doubtful_pages(spark):
    mixed = "lamp shade cheap. The lamp was kept. best lamp shade free download now"
    data = [(i, SPAM[i % len(SPAM)] + f" w{i}", "bad") for i in range(60)] + [(100 + i, HONEST[i % len(HONEST)] + f" W{i}.", "good") for i in range(60)] + [(200, mixed, "bad"), (201, mixed, "good")]
    docs = spark.createDataFrame(data, "doc bigint, body string, host string")
    out = {r["page"]: r for r in spam_pages(docs, "doc", "body", "host").collect()}
    assert out[200]["probability"] == out[201]["probability"] and out[200]["host_rate"] > out[201]["host_rate"] and out[200]["score"] > out[201]["score"]


def test_spam_one_class_and_empty(spark):
    docs = spark.createDataFrame([(1, HONEST[0], "h"), (2, HONEST[2], None)], "doc bigint, body string, host string")
    assert not any(r["spam"] for r in spam_pages(docs, "doc", "body", "host").collect())
    assert spam_pages(docs.limit(0), "doc", "body", "host").count() == 0


@pytest.mark.parametrize("words", [3, 5, 30, 60])
def test_seeds_lose_no_leak(words):
    rng = random.Random(words)
    vocabulary = "a to it ox be of kettle brass the amber orchestra i on".split()
    for _ in range(60):
        item = " ".join(rng.choice(vocabulary) for _ in range(words))
        w = item.split()
        pieces = [" ".join(w[i : i + n]) for i in range(0, words, 4) for n in [rng.choice([2, 4, 5, 13])]]
        rng.shuffle(pieces)
        doc = letters(" zz ".join(pieces) + " " + " ".join(rng.choice(vocabulary) for _ in range(40)))
        text, starts = _item(item)
        got = _matcher([(1, text, starts)], 12, 0.5, 4)(["noise", doc, item]).get((1, 0), [])
        seeds = [(d, p) for p in starts[:-1] for d in range(len(doc)) if doc[d] == text[p]]
        every = tiles(doc, [d for d, _ in seeds], text, starts, [p for _, p in seeds])
        report = lambda found: sorted(n for _, n, _ in found if n >= 4 or n == words)
        a, b = report(got), report(every)
        if max(b, default=0) >= min(12, words) or sum(b) >= 0.5 * words:
            assert (max(a), sum(a)) == (max(b), sum(b))


def test_reordered_passages_and_blocks(spark, monkeypatch):
    rng = random.Random(5)
    w = ITEM.split()
    parts = [w[i : i + 6] for i in range(0, len(w), 6)]
    data = []
    for d in range(40):
        rng.shuffle(parts)
        take = parts[: 1 + d % len(parts)]
        data.append((d, " - ".join(" ".join(x) + f" noise{d} filler" for x in take), sum(len(x) for x in take if len(x) >= 4) / len(w)))
    docs = spark.createDataFrame(data, "d bigint, t string, s double")
    items = spark.createDataFrame([(7, ITEM), (8, "quite another text of a dozen words and a few more to be long"), (7, "a short one")], "i bigint, x string")
    want = {d for d, _, s in data if s >= 0.5}
    for block in (1 << 26, 60):
        monkeypatch.setattr(L, "BLOCK_CHARS", block)
        out = {r["d"]: r for r in leaked_passages(docs, "d", "t", items, "i", "x").collect()}
        assert set(out) == want and all(abs(out[d]["coverage"] - s) < 1e-6 for d, _, s in data if d in want)
