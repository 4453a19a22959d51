"""Properties of the driver-side and per-task parts on arbitrary input."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuskit.llm.groupsplit import greedy_counts
from corpuskit.llm.leakage import _item, tiles
from corpuskit.llm.packing import best_fit_decreasing, lower_bound
from corpuskit.llm.plaintext import letters
from corpuskit.llm.quotas import rake, whole_quotas
from corpuskit.llm.spam import EVIDENCE, STOPWORDS, page_reader
from corpuskit.llm.survivor import consensus


@given(st.integers(1, 60), st.lists(st.integers(1, 60), max_size=60))
def test_packing(capacity, sizes):
    sizes = sorted((min(s, capacity) for s in sizes), reverse=True)
    bins, free = best_fit_decreasing(sizes, capacity)
    load = np.zeros(len(free), int)
    np.add.at(load, bins, sizes)
    assert (load <= capacity).all() and (capacity - load == free).all()
    u, n = np.unique(sizes, return_counts=True) if sizes else ([], [])
    low = lower_bound(u, n, capacity)
    assert -(-sum(sizes) // capacity) <= low <= len(free)


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=8))
def test_greedy(sizes):
    targets = {"a": 0.7, "b": 0.2, "c": 0.1}
    plan = greedy_counts(list(sizes.items()), targets)
    assert {s: sum(got.values()) for s, got in plan.items()} == sizes
    total = sum(s * n for s, n in sizes.items())
    if sizes:
        for k, t in targets.items():
            assert sum(s * got[k] for s, got in plan.items()) <= total * t + max(sizes)


cells = st.dictionaries(st.tuples(st.sampled_from("abc"), st.sampled_from("xyz")), st.tuples(st.floats(0.01, 1), st.integers(0, 200), st.integers(0, 5)), min_size=1, max_size=9)


@settings(deadline=None)
@given(cells, st.integers(0, 300))
def test_quotas(table, size):
    whole = sum(v[0] for v in table.values())
    target = {c: v[0] / whole for c, v in table.items()}
    have, least = {c: v[1] for c, v in table.items()}, {c: v[2] for c, v in table.items()}
    x = rake(target, have, size)
    assert all(-1e-9 <= x[c] <= have[c] + 1e-9 for c in x) and sum(x.values()) <= size + 1e-3
    q = whole_quotas(x, have, least, size)
    assert all(0 <= q[c] <= have[c] for c in q)
    needed = sum(min(least[c], have[c]) for c in q)
    assert sum(q.values()) <= max(size, needed)
    if needed <= size:
        assert all(q[c] >= min(least[c], have[c]) for c in q)


word = st.sampled_from("ab bc cd de abc bcd".split())


@given(st.lists(word, min_size=1, max_size=25), st.lists(word, max_size=60))
def test_tiles(item_words, doc_words):
    item, starts = _item(" ".join(item_words))
    doc = letters(" ".join(doc_words))
    seeds = [(d, p) for p in starts[:-1] for d in range(len(doc)) if doc[d : d + 4] == item[p : p + 4] and len(item) >= p + 4]
    got = tiles(doc, [d for d, _ in seeds], item, starts, [p for _, p in seeds])
    marked = [w for first, n, _ in got for w in range(first, first + n)]
    assert len(marked) == len(set(marked))
    for first, n, at in got:
        text = item[starts[first] : starts[first + n]]
        assert doc[at : at + len(text)] == text


@given(st.lists(st.tuples(st.text(max_size=12), st.floats(0.01, 9)), min_size=1, max_size=6, unique_by=lambda x: x[0]))
def test_consensus_is_an_existing_value(values):
    text, value, distance = consensus([v for v, _ in values], [w for _, w in values])
    assert value in [v for v, _ in values] and distance >= 0


@given(st.text(max_size=300))
def test_page_views_are_shares(text):
    f = dict(zip(EVIDENCE, page_reader(STOPWORDS)(text)))
    assert all(x >= 0 for x in f.values()) and all(f[k] <= f["size"] for k in ("linked", "listed", "prose", "echo", "again"))


@given(st.text(max_size=80))
def test_letters_are_stable(text):
    once = letters(text)
    assert letters(once) == once
