"""Ranked search over term-document grids."""

import math
import random
import re
from collections import Counter

import numpy as np

from vesselmart.llm import treap

from .helpers import documents, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def _ranked(docs, items, k=20):
    """Every document scored for every item."""
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    number, length = len(counted), sum(sum(c.values()) for _, c in counted)
    frequency = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 75 + 25 * sum(c.values()) * number // length
            score = 0
            for t, repeats in Counter(_terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * frequency[t] + 1)))
                    score += repeats * w * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i))
        scores.sort(key=lambda s: (s[0], s[1] is not None, s[1] or 0))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def _items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def _search(spark, docs, items, k=20, parts=3):
    index = treap.build(documents(spark, docs, rank="clash", score="clash").repartition(parts))
    got = treap.search(index, _items(spark, items), k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def test_search_agrees_with_scoring_all(spark, monkeypatch):
    draw = random.Random(6)
    docs = [(k, prose(k, draw.choice([3, 20, 90, 700]), draw.choice([30, 400, 5000]))) for k in range(260)]
    docs += [(1000 + k, docs[7][1]) for k in range(60)]  # equal scores
    docs += [(2000, "Ünï W7-w7 w7.W9"), (2001, "w1 " * 3000)]
    items = [(k, prose(900 + k, draw.choice([1, 8, 40]), 300)) for k in range(25)] + [(99, docs[7][1]), (98, "w7 w7 W7 ünï")]
    want = _ranked(docs, items)
    assert _search(spark, docs, items) == want
    assert _search(spark, docs, items, k=3, parts=1) == _ranked(docs, items, 3)
    monkeypatch.setattr(treap, "BLOCK", 600)  # several passes
    assert _search(spark, docs, items) == want


def test_small_steps_and_segments_change_nothing(monkeypatch):
    """Width, memory and segment bounds only change the order of work."""
    draw = random.Random(7)
    docs = [(k, prose(k, draw.randint(1, 60), 50)) for k in range(300)]
    items = [(k, prose(70 + k, 12, 60)) for k in range(9)]
    want = [r for r in _ranked(docs, items, 5)]
    counted = [Counter(treap.terms(t)) for _, t in docs]
    length = sum(sum(c.values()) for c in counted)
    frequency = Counter(t for c in counted for t in c)
    queries = [Counter(treap.terms(t)) for _, t in items]
    for width, paths, size in ((1, 1, 300), (2, 50, 40), (64, 1 << 18, 7), (64, 1 << 18, 300)):
        monkeypatch.setattr(treap, "WIDTH", width)
        monkeypatch.setattr(treap, "PATHS", paths)
        best = treap.Best(len(items), 5)
        for at in range(0, 300, size):
            some = counted[at:at + size]
            words = sorted(set().union(*some))
            cells = [(words.index(t), d, f, sum(c.values())) for d, c in enumerate(some) for t, f in c.items()]
            row, column, count, n = (np.array(x, np.int64) for x in zip(*cells))
            impact = 10**9 * count // (1000 * count + 12 * (75 + 25 * n * 300 // length))
            tree = treap.Treap(*treap.build_treap(row, column, impact))
            found = [
                (q, words.index(t), r * treap.weight_of(300, frequency[t]))
                for q, c in enumerate(queries) for t, r in c.items() if t in words
            ]
            if found:
                treap._descend(tree, np.arange(at, at + len(some)), *(np.array(x, np.int64) for x in zip(*found)), best)
        got = {(i, d, s) for i, d, s in zip(best.item.tolist(), best.doc.tolist(), best.score.tolist())}
        assert got == {(i, d, s) for i, _, d, s in want}


def test_a_treap_gives_back_its_cells():
    draw = np.random.default_rng(1)
    for rows, columns, cells in ((1, 1, 1), (3, 100, 90), (5000, 7, 3000), (64, 64, 4096)):
        code = draw.choice(rows * columns, cells, replace=False)
        row, column, impact = code // columns, code % columns, draw.integers(0, 10**6, cells)
        tree = treap.Treap(*treap.build_treap(row, column, impact))
        node = np.zeros(cells, np.int64)
        for level in range(tree.levels - 1, -1, -1):
            at = 4 * node + 2 * (row >> level & 1) + (column >> level & 1)
            assert tree.present[at].all()
            assert (tree.most[tree.node[at]] <= tree.most[node]).all()
            node = tree.node[at].astype(np.int64)
        assert (tree.most[node] == impact).all() and len(np.unique(node)) == cells


def test_edges_of_search(spark):
    docs = [(None, "red fish"), (4, "red fish"), (4, "red fish"), (4, None), (5, ""), (6, "--"), (7, "blue\x00sky")]
    items = [(1, "RED fish"), (1, "RED fish"), (2, None), (3, ""), (None, "sky blue"), (8, "none of it")]
    got = _search(spark, docs, items)
    assert [(i, r, d) for i, r, d, _ in got if i == 1] == [
        (1, 1, None), (1, 1, None), (1, 2, 4), (1, 2, 4), (1, 3, 4), (1, 3, 4)
    ]
    assert [(i, r, d) for i, r, d, _ in got if i != 1] == [(None, 1, 7)]
    assert _search(spark, [], items) == [] and _search(spark, docs, []) == []
    assert _search(spark, [(1, None)], items) == []
