"""Best-fit packing over a histogram of lengths."""

import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from vesselmart.llm import packing  # noqa: E402

from .helpers import documents, prose  # noqa: E402

WORDS = public_tokenizers.path("word_bpe_49k.json")


def _one_by_one(lengths, capacity):
    """Sequences that best-fit decreasing opens, piece by piece."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=room.__getitem__)] -= n
        else:
            room.append(capacity - n)
    return len(room)


def _filled(made, counts, capacity):
    """Pieces of every sequence by the plan, gapless."""
    placed = {}
    for k, n in enumerate(made.length):
        later = [made.rank[j] for j in range(k + 1, len(made.length)) if made.length[j] == n]
        for t in range(made.rank[k], min(later, default=counts[n])):
            nth, slot = divmod(t - made.rank[k], made.each[k])
            placed.setdefault(made.sequence[k] + nth, []).append((made.offset[k] + slot * n, n))
    for parts in placed.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= capacity
    return placed


def test_plan_is_best_fit_decreasing():
    draw = random.Random(8)
    for capacity in (7, 50, 64):
        for _ in range(60):
            kinds = draw.randint(1, capacity)
            counts = {draw.randint(1, capacity): draw.choice([1, 2, 9, 80]) for _ in range(kinds)}
            made = packing.plan(counts, capacity)
            placed = _filled(made, counts, capacity)
            assert sum(map(len, placed.values())) == sum(counts.values())
            assert len(placed) == made.sequences == _one_by_one(
                [n for n, c in counts.items() for _ in range(c)], capacity
            )
            assert len(made.length) <= packing.most_runs(capacity)


def test_a_plan_does_not_grow_with_the_counts():
    few = {n: 3 for n in range(1, 4097)}
    many = {n: 3_000_000_007 for n in range(1, 4097)}
    for counts in (few, many):
        made = packing.plan(counts)
        assert len(made.length) <= packing.most_runs(4096)
        total = sum(n * c for n, c in counts.items())
        assert made.sequences <= 1.01 * total / 4096 + 1


ODD = [
    None, "", " ", "a", "Don't STOP, we'll 12 a.b", "x<|endoftext|>y <|startoftext|>", "été İΣ Σ",
    "a\x85b\x1cc d\xa0e", "家族 \U0001f469‍\U0001f469 ½²", " ́b", "'s 'S it's''re", "a\x00b\x1f1",
    "same", "same", "<b>it's</b>", "слово Über-groß", "word " * 9000, "z" * 5000,
]


def test_pieces_hold_the_library_s_ids(spark):
    draw = random.Random(2)
    texts = ODD + ["".join(draw.choices("ab' <|>\n\t.é́Z1sS東\x85", k=80)) for _ in range(300)]
    texts += [prose(k, draw.randint(1, 60)) for k in range(200)] + [prose(1, 50)] * 400
    library = Tokenizer.from_file(WORDS)
    want = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    df = documents(spark, texts, piece="clash", ids="clash", rank="clash").repartition(5)
    packed = packing.pack(df, WORDS, capacity=64).cache()
    got = {}
    for row in packed.collect():
        got.setdefault(row["doc_id"], []).append(row)
    assert len(got) == len(texts)
    for number, rows in got.items():
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert [i for r in rows for i in r["ids"]] == want[number]
        for row in rows:
            mine = want[number][row["start"]:row["start"] + row["length"]]
            assert row["ids"] == mine and (row["length"] == 64 or row["piece"] == len(rows) - 1)
            assert row["ids_crc32"] == zlib.crc32(np.array(mine, "<u4").tobytes())
    lengths = [r["length"] for rows in got.values() for r in rows]
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert len(whole) == _one_by_one(lengths, 64)
    for rows in got.values():
        for row in rows:
            assert whole[row["sequence_id"]][row["offset"]:row["offset"] + row["length"]] == row["ids"]
    assert sum(map(len, whole.values())) == sum(lengths)


def test_edges_of_packing(spark):
    rows = [(None, "one two"), (4, "one two"), (4, "one two"), (4, None)]
    got = packing.pack(documents(spark, rows), WORDS, with_ids=False).collect()
    assert sorted((r["length"], r["doc_id"] or 0) for r in got) == [(1, 4), (3, 0), (3, 4), (3, 4)]
    assert {r["sequence_id"] for r in got} == {0} and sorted(r["offset"] for r in got) == [0, 3, 6, 9]
    assert packing.pack(documents(spark, []), WORDS).count() == 0


def test_a_full_memory_starts_anew():
    library = Tokenizer.from_file(WORDS)
    with open(WORDS, encoding="utf-8") as file:
        encoder = packing.Encoder(file.read())
    for k in range(4):
        encoder.used = packing.MEMORY + 1
        texts = [prose(k, 40), "it's " + "y" * 200, "é" * 70, prose(k, 40)]
        assert encoder.encode(texts) == [
            np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts
        ]
        assert encoder.used < packing.MEMORY
