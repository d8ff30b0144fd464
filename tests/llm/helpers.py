"""Small tables and brute-force versions for the tests."""

from __future__ import annotations

import random
from collections import Counter

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **extra):
    """A documents table of ``texts``; ids count from 0, or are given in pairs."""
    pairs = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
    rows = [(i, t, "en", "s", None if t is None else len(t), *extra.values()) for i, t in pairs]
    fields = "".join(f", {name} string" for name in extra)
    return spark.createDataFrame(rows, DOCUMENT + fields)


def prose(seed: int, n: int, words: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def component_ids(pairs):
    """{(id, text)} to the least id reachable, by comparing all with all."""
    sets = [shingles(t) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (number, _) in enumerate(pairs):
        least[find(k)] = min(number, least.get(find(k), number))
    return [least[find(k)] for k in range(len(pairs))]


def without_repeats(pairs):
    """Kept words by id, windows taken in order of id and place."""
    seen, out = set(), {}
    for number, text in sorted(pairs, key=lambda p: p[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if window in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(window)
        out[number] = (len(words), [w for w, g in zip(words, gone) if not g])
    return out


def repeat_words(words):
    found = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for k in range(len(words) - 2):
        if found[tuple(words[k:k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    return len(covered)
