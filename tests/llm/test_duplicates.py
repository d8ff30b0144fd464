"""Jaccard join, substring removal and benchmark passages."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vesselmart.llm import decontaminate, parityjoin, substrings
from vesselmart.llm.components import components
from vesselmart.llm.shingles import shingle_sets

from .helpers import component_ids, documents, prose, shingles, without_repeats

EDGES = [None, "", " \n ", "one", "One", "a b c d", "A B C D", "a b c d e", "a b c d e", "x " * 3000]


def _changed(text, draw, share):
    return " ".join(w if draw.random() > share else f"n{draw.randrange(10**6)}" for w in text.split())


def _near_copies():
    draw = random.Random(12)
    texts = list(EDGES)
    for k, n in enumerate((6, 30, 60, 90, 127, 128, 160, 300, 700, 1500)):
        base = prose(100 + k, n, 10_000)
        texts += [base, base] + [_changed(base, draw, s) for s in (0.01, 0.02, 0.03, 0.04, 0.05)]
        cut = base.split()
        texts += [" ".join(cut[:int(n * s)]) for s in (0.95, 0.85, 0.82, 0.8, 0.79)]
    passage = prose(99, 60, 10_000)
    texts += [passage + " " + prose(1000 + k, 60, 10_000) for k in range(40)]
    return texts


def test_components_follow_all_pairs(spark):
    texts = _near_copies()
    order = list(range(len(texts)))
    random.Random(13).shuffle(order)
    pairs = list(zip(order, texts))
    df = documents(spark, pairs, key="clash", node="clash").repartition(5)
    rows = {r["doc_id"]: r for r in parityjoin.link(df).collect()}
    for (number, text), want in zip(pairs, component_ids(pairs)):
        assert rows[number]["n_shingles"] == len(shingles(text))
        assert rows[number]["component_id"] == want


def test_repeated_and_missing_ids(spark):
    text = prose(5, 80)
    other = prose(6, 90)
    df = documents(spark, [(1, text), (1, text), (1, other), (2, other), (None, prose(7, 50)), (3, None)])
    rows = parityjoin.link(df).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (1, 1), (1, 1), (1, 1), (2, 1), (3, 3)]
    kept = parityjoin.representatives(df)
    assert kept.columns == df.columns and kept.count() == 4


def test_chunks_in_common():
    """Sets within the bound share one of the chosen chunks."""
    draw = random.Random(14)
    for n in (3, 9, 40, 63, 64, 79, 130, 255, 256, 319, 600, 1200):
        a = [draw.getrandbits(60) for _ in range(n)]
        for m in {n, int(n * 1.1), int(n * 1.25)}:
            differ = (n + m) // 9
            gone = (differ + n - m) // 2
            b = a[gone:] + [draw.getrandbits(60) for _ in range(m - (n - gone))]
            both, union = len(set(a) & set(b)), len(set(a) | set(b))
            if 100 * both < 80 * union:
                continue
            sizes = np.array([n, m])
            level = np.floor(np.log2(sizes)).astype(np.int64)
            value = np.array(a + b, np.uint64)
            text = np.repeat([0, 1], sizes)
            low = level.min()
            if level[1] > low:
                bound = np.array([(n + n * 5 // 4) // 9, (m + (1 << level[1]) - 1) // 9])
            else:
                bound = (sizes + sizes * 5 // 4) // 9
            key, owner = parityjoin._keys(value, text, np.array([low, low]), bound)
            assert set(key[owner == 0]) & set(key[owner == 1]), (n, m)


def test_sketch_distance_is_a_lower_bound(spark):
    texts = _near_copies()[40:80]
    rows = {r["doc_id"]: r for r in parityjoin.signatures(documents(spark, texts)).collect()}
    for i in range(len(texts)):
        for j in range(i):
            apart = sum(bin((rows[i][f"s{k}"] ^ rows[j][f"s{k}"]) & (2**64 - 1)).count("1") for k in range(parityjoin.LONGS))
            assert apart <= len(shingles(texts[i]) ^ shingles(texts[j]))


def test_shingle_sets():
    texts = ["a b c d e f", "A B C D E F", "a b c d e a b c d e", "q", "", "x y z", "a b c d"]
    _, sizes = shingle_sets(texts)
    assert sizes.tolist() == [len(shingles(t)) for t in texts]


def test_stars_find_components(spark):
    draw = random.Random(15)
    links = [(k, k + 1) for k in range(60)] + [(100 + draw.randrange(40), 100 + draw.randrange(40)) for _ in range(30)]
    links += [(200, k) for k in range(201, 240)] + [(5, 5)]
    root = {n: n for pair in links for n in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root if any(n in p and p[0] != p[1] for p in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _repeats():
    draw = random.Random(16)
    passage = prose(50, 55, 10_000)
    texts = [*EDGES, "a " * 19, "a " * 20, "a " * 21, "a " * 50, passage, passage]
    for k in range(40):
        words = prose(200 + k, draw.randint(10, 120), 10_000).split()
        at = draw.randrange(len(words))
        start = draw.randrange(40)
        words[at:at] = passage.split()[start:start + draw.randint(15, 55)]
        texts.append(" ".join(words))
    return texts + texts[-3:] + ["p q " * 40 + passage, "q p " * 40]


def test_substrings_follow_all_windows(spark):
    texts = _repeats()
    order = list(range(len(texts)))
    random.Random(17).shuffle(order)
    pairs = list(zip(order, texts))
    df = documents(spark, pairs, keys="clash", ranges="clash").repartition(6)
    rows = {r["doc_id"]: r for r in substrings.deduplicate(df).collect()}
    assert len(rows) == len(pairs)
    for number, (n, kept) in without_repeats(pairs).items():
        r = rows[number]
        assert (r["n_words"], r["n_removed"]) == (n, n - len(kept)), number
        assert r["kept_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()
    assert substrings.deduplicate(df.limit(0)).count() == 0


def test_cover_meets_every_difference():
    for d in range(substrings.PERIOD):
        assert any((a - b) % substrings.PERIOD == d for a in substrings.COVER for b in substrings.COVER)
    assert substrings.ANCHOR + substrings.PERIOD - 1 == substrings.WINDOW


def _least_edits(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        before, row = row, [0]
        for k, p in enumerate(pattern):
            row.append(min(before[k] + (p != c), before[k + 1] + 1, row[k] + 1))
        best = min(best, row[-1])
    return best


def _edited(text, draw, edits):
    chars = list(text)
    for _ in range(edits):
        k = draw.randrange(len(chars))
        chars[k:k + 1] = draw.choice([[], ["@"], [chars[k], "@"]])
    return "".join(chars)


@pytest.fixture(scope="module")
def items():
    return [(k, prose(300 + k, n, 10_000)) for k, n in enumerate((4, 6, 9, 14, 30, 60))] + [(90, None), (91, ""), (92, "short one"), (93, "b" * 100)]


def test_passages_follow_full_alignment(spark, items):
    draw = random.Random(18)
    texts = [*EDGES, "b" * 300]
    for _, item in items[:6]:
        for edits in (0, 1, 2, 4, 5, 7, 12):
            part = _edited(item, draw, edits)
            texts.append(prose(draw.randrange(10**6), 30) + " " + part.upper().replace(" ", " \n") + " " + prose(draw.randrange(10**6), 20))
    texts += [prose(draw.randrange(10**6), 60, 10_000) for _ in range(10)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, texts, item_id="clash")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find(df, bench).collect()}
    index = decontaminate.Index([i for i in items if i[1]])
    segments = [
        (n, "".join(map(chr, index.codes[k, :index.length[k]])), int(index.edits[k])) for k, n in enumerate(index.item)
    ]
    for k, text in enumerate(texts):
        text = decontaminate.plain(text or "")
        for number, _ in items:
            want = any(_least_edits(s, text) <= e for n, s, e in segments if n == number)
            assert ((k, number) in got) == want, (k, number)
    assert {r["doc_id"] for r in decontaminate.clean(df, bench).collect()} == set(range(len(texts))) - {k for k, _ in got}
    assert decontaminate.clean(df, bench).columns == df.columns


def test_blocks_and_empty_tables(spark, items, monkeypatch):
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, [items[5][1], "x " + items[3][1], "nothing", items[4][1]])
    once = {tuple(r) for r in decontaminate.find(df, bench).collect()}
    assert {r[0] for r in once} == {0, 1, 3}
    monkeypatch.setattr(decontaminate, "BLOCK", 100)
    assert {tuple(r) for r in decontaminate.find(df, bench).collect()} == once
    assert decontaminate.find(df, bench.limit(0)).count() == 0
    assert decontaminate.find(df.limit(0), bench).count() == 0


def test_long_texts_in_stretches(items, monkeypatch):
    index = decontaminate.Index([i for i in items if i[1]])
    text = prose(7, 300) + " " + items[5][1] + " " + prose(8, 300)
    whole = list(index.hits([text]))
    monkeypatch.setattr(decontaminate, "STRETCH", 500)
    parts = list(index.hits([text]))
    assert [(h[1], h[2], h[4]) for h in whole] == [(h[1], h[2], h[4]) for h in parts] and whole


def _found(index, texts):
    return {h[0] for h in index.hits(texts)}


def test_passages_from_every_offset():
    item = decontaminate.plain(" ".join("".join(random.Random(k).choices("abcdefgh", k=2 + k % 9)) for k in range(40)))
    index = decontaminate.Index([(1, item)])
    n = decontaminate.PASSAGE
    around = prose(30, 20) + " ", " " + prose(31, 20)
    parts = [item[k:k + n] for k in range(len(item) - n + 1)]
    words = item.split()
    parts += [" ".join(words[k:k + 13]) for k in range(28)]
    assert _found(index, [p.join(around) for p in parts]) == set(range(len(parts)))
    # much shorter parts are nobody's
    assert not _found(index, [item[k:k + 30].join(around) for k in range(len(item) - 30)])


@pytest.mark.parametrize("n", [8, 14, 22])
def test_one_replaced_word(n):
    words = ["".join(random.Random(50 + k).choices("abcdefgh", k=2 + k % 9)) for k in range(n)]
    index = decontaminate.Index([(1, " ".join(words))])
    around = prose(32, 20) + " ", " " + prose(33, 20)
    texts = []
    for k in range(n):
        for new in ([], ["xy"], ["considerations"], [words[k], "zzzzzz"]):
            texts.append(" ".join(words[:k] + new + words[k + 1:]).join(around))
    assert _found(index, texts) == set(range(len(texts)))
    # two words in each dozen characters leave no passage
    assert not _found(index, [" ".join("zzzz" if k % 2 else w for k, w in enumerate(words)).join(around)])


@pytest.mark.parametrize("parts", [1, 6])
def test_substrings_of_repeated_and_missing_ids(spark, parts):
    text, passage = prose(5, 80), prose(6, 60)
    long = [prose(700 + k, 30) + " " + passage for k in range(3)]
    pairs = [(1, text), (1, text), (None, long[0]), (4, long[1]), (4, long[2]), (5, None), (None, None)]
    rows = substrings.deduplicate(documents(spark, pairs).repartition(parts)).collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"]) for r in rows)
    # the passage stays in the row without id, the text in one of the equal rows
    assert got == [(-1, 0, 0), (-1, 90, 0), (1, 80, 0), (1, 80, 80), (4, 90, 60), (4, 90, 60), (5, 0, 0)]
