"""Benchmark passages in documents by q-gram counting and banded alignment.

Texts are compared in lower case with white space runs as one space. The unit
is a passage of ``PASSAGE`` = 50 characters from any place of a benchmark item on
(no 13 words of the items given are shorter). A document is contaminated by an
item in either of two cases.

1. Some part of it is within ``edits_of(length)`` edits (one in twenty characters)
   of a segment of the item. Segments have ``SEGMENT`` = 47 characters and begin
   every ``STRIDE`` = 4, so each passage holds a whole one; the last is flush with
   the end, and a shorter item is one segment.
2. It has a passage, or the whole of a shorter item, but for one word: up to
   ``GAP`` = 24 characters of it are left out, or replaced by as many. The rest is
   verbatim and has ``PASSAGE`` characters, or all others of the item if these are
   ``SHORTEST`` or more.

Filter. A part within k edits of a segment of m characters has at least
``m + 1 - q - k * q`` q-grams in common with it, and they lie on diagonals
(place in the document less place in the segment) no more than k apart. Shared
q-grams are counted in overlapping bands of 2 (k + 1) diagonals, one every
k + 1, so that some band holds all of them. Bands that reach the bound are
verified by an alignment confined to them. Of two parts beside a gap the longer
one alone reaches the bound, so that where no segment of an item is found, the
bands of that item are searched for verbatim runs and their continuation.

Documents are read once and not shuffled. The benchmark is broadcast in blocks
of about ``BLOCK`` characters, counted first; a larger one takes one pass over
the documents for each block.

Defined results: null documents and items match nothing, nor do items of fewer
than ``SHORTEST`` characters, which any text might contain. Repeated items and
documents are reported each. Rows come in no order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, without_ids
from .shingles import mix

Q = 12
PASSAGE = 50
STRIDE = 4
SEGMENT = PASSAGE - STRIDE + 1
#: Most characters of an item, and of a document, in place of each other.
GAP = 24
SHORTEST = 24
#: Characters of benchmark text searched for in one pass.
BLOCK = 400_000
#: Characters of documents filtered at a time.
STRETCH = 1 << 19
HITS = "doc_id long, item_id long, n_segments long, first long, least_edits long"
_STEP = 0x9E3779B97F4A7C15
#: Powers of the step that shift a hash by 1, 2 and 4 characters.
_B, _B2, _B4 = (np.uint64(_STEP**k % (1 << 64)) for k in (1, 2, 4))


def edits_of(length: int) -> int:
    return length // 20


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the Q = 8 + 4 characters from each place on."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    one = codes.astype(np.uint64) + np.uint64(1)
    two = one[:-1] * _B + one[1:]
    four = two[:-2] * _B2 + two[2:]
    eight = four[:-4] * _B4 + four[4:]
    return mix(eight[:-4] * _B4 + four[8:])


def _continued(item: np.ndarray, codes: np.ndarray, a: int, b: int, shift: int) -> int | None:
    """Edits of the least gap after the verbatim run from a to b of an item at a + shift
    of a text, if what follows the gap completes a passage or the item."""
    best = None
    # a gap ends with the word it begins in, or with the next if it begins at a space
    spaces = np.flatnonzero(item[b + 1:b + 1 + GAP] == 32)
    most = min(int(spaces[0]) + 2, GAP) if len(spaces) else GAP
    for left in range(min(most, len(item) - b) + 1):
        j = b + left
        for put in range(min(GAP, len(codes) - b - shift) + 1):
            if best is not None and max(left, put) >= best:
                break
            rest = codes[b + shift + put:b + shift + put + len(item) - j]
            want = item[j:j + len(rest)]
            if len(rest) and rest[0] != want[0]:
                continue
            other = np.flatnonzero(rest != want)
            length = int(other[0]) if len(other) else len(rest)
            total = b - a + length
            if total >= PASSAGE or total >= SHORTEST and not a and j + length == len(item):
                best = max(left, put)
    return best


class Index:
    """Segments of a block of items and the places of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item: list[int] = []
        self.whole: list[np.ndarray] = []
        offsets: list[int] = []
        segments: list[np.ndarray] = []
        for number, text in items:
            text = plain(text or "")
            if len(text) < SHORTEST:
                continue
            last = max(0, len(text) - SEGMENT)
            whole = _codes(text)
            for start in sorted({*range(0, last, STRIDE), last}):
                self.item.append(number)
                self.whole.append(whole)
                offsets.append(start)
                segments.append(whole[start:start + SEGMENT])
        self.offset = np.array(offsets, np.int64)
        self.length = np.array([len(s) for s in segments], np.int64)
        self.edits = np.array([edits_of(len(s)) for s in segments], np.int64)
        # the longer part of an item but for a gap, if it is too short for a passage besides
        whole = np.array([len(w) for w in self.whole], np.int64)
        beside = (np.minimum(np.maximum(whole - GAP, SHORTEST), PASSAGE) + 1) // 2 + 1 - Q
        self.bound = np.maximum(np.minimum(self.length + 1 - Q - self.edits * Q, beside), 1)
        self.codes = np.zeros((len(segments), SEGMENT), np.uint32)
        hashes, segment, place = [], [], []
        for k, codes in enumerate(segments):
            self.codes[k, :len(codes)] = codes
            grams = _grams(codes)
            hashes.append(grams)
            segment.append(np.full(len(grams), k, np.int32))
            place.append(np.arange(len(grams), dtype=np.int32))
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.segment = np.concatenate(segment)[order] if hashes else np.zeros(0, np.int32)
        self.place = np.concatenate(place)[order] if hashes else np.zeros(0, np.int32)
        self.grams, self.begin, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.grams >> np.uint64(42)).astype(np.int64)] = True

    def bands(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, first diagonal) of the bands of a text that reach the bound."""
        grams = _grams(codes)
        at = np.flatnonzero(self.seen[(grams >> np.uint64(42)).astype(np.int64)])
        found = np.searchsorted(self.grams, grams[at])
        found[found == len(self.grams)] = 0
        hit = self.grams[found] == grams[at]
        at, found = at[hit], found[hit]
        times = self.count[found]
        post = np.repeat(self.begin[found] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        segment = self.segment[post].astype(np.int64)
        diagonal = np.repeat(at, times) - self.place[post]
        step = self.edits[segment] + 1
        band = diagonal // step
        # each diagonal is in two bands; negative ones are possible at the start
        segment = np.concatenate([segment, segment])
        band = np.concatenate([band, band - 1])
        key = segment * (np.int64(1) << 40) + (band + (1 << 30))
        key, count = np.unique(key, return_counts=True)
        segment, band = key >> 40, (key & ((1 << 40) - 1)) - (1 << 30)
        enough = count >= self.bound[segment]
        segment, band = segment[enough], band[enough]
        return segment, band * (self.edits[segment] + 1)

    def align(self, codes: np.ndarray, segment: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Least edits of each segment against the text within its band.

        Rows are characters of the segments, columns the diagonals from
        ``start - k`` to ``start + 2 (k + 1) + k``; beginning and end in the text
        are free.
        """
        most = int(self.edits[segment].max(initial=0))
        width = 4 * most + 3
        low = start - self.edits[segment]
        far = np.int64(1) << 20
        cost = np.zeros((len(segment), width), np.int64)
        best = np.full(len(segment), far)
        columns = np.arange(width)
        for i in range(SEGMENT):
            where = low[:, None] + i + columns
            inside = (where >= 0) & (where < len(codes))
            letter = np.where(inside, codes[np.clip(where, 0, len(codes) - 1)], 0xFFFFFFFF)
            new = cost + (letter != self.codes[segment, i][:, None])
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
            # characters of the text left out: a running minimum along the row
            new = np.minimum.accumulate(new - columns, axis=1) + columns
            cost = new
            done = self.length[segment] == i + 1
            best[done] = cost[done].min(axis=1)
        return best

    def beside_gap(self, codes: np.ndarray, k: int, start: int) -> tuple[int, int] | None:
        """(place, edits) of a passage but for a gap, with a run in the band of segment k."""
        item = self.whole[k]
        for diagonal in range(start, start + 2 * (int(self.edits[k]) + 1)):
            shift = diagonal - int(self.offset[k])
            low, high = max(0, -shift), min(len(item), len(codes) - shift)
            if low >= high:
                continue
            same = item[low:high] == codes[low + shift:high + shift]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]))) + low
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if b - a < Q:
                    continue
                after = _continued(item, codes, a, b, shift)
                # the part before a gap is the part after it, read backwards
                n, m = len(item), len(codes)
                before = _continued(item[::-1], codes[::-1], n - b, n - a, m - n - shift)
                edits = [e for e in (after, before) if e is not None]
                if edits:
                    return max(a + shift, 0), min(edits)
        return None

    def hits(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, segments found, first place, least edits)."""
        for number, text in enumerate(texts):
            found: dict[int, dict[int, tuple[int, int]]] = {}
            # long texts in stretches that overlap by more than any match
            for begin in range(0, max(len(text), 1), STRETCH):
                codes = _codes(text[begin:begin + STRETCH + 4 * SEGMENT])
                segment, start = self.bands(codes)
                if not len(segment):
                    continue
                edits = self.align(codes, segment, start)
                good = edits <= self.edits[segment]
                sure = {self.item[s] for s in segment[good].tolist()}
                for s, d in zip(segment[~good].tolist(), start[~good].tolist()):
                    if self.item[s] not in sure and (hit := self.beside_gap(codes, s, d)):
                        sure.add(self.item[s])
                        mine = found.setdefault(self.item[s], {})
                        place, least = mine.get(s, (begin + hit[0], hit[1]))
                        mine[s] = (min(place, begin + hit[0]), min(least, hit[1]))
                for s, d, e in zip(segment[good].tolist(), start[good].tolist(), edits[good].tolist()):
                    mine = found.setdefault(self.item[s], {})
                    place, least = mine.get(s, (begin + max(d, 0), e))
                    mine[s] = (min(place, begin + max(d, 0)), min(least, e))
            for item, mine in found.items():
                yield (
                    number, item, len(mine), min(p for p, _ in mine.values()),
                    min(e for _, e in mine.values()),
                )


def _blocks(benchmark: DataFrame) -> list[DataFrame]:
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK))
    return [
        benchmark.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) for k in range(blocks)
    ]


def find(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_segments, first, least_edits) of every contaminated
    document and item; a passage but for a gap counts as one segment and its gap as
    edits; ``first`` is about where, in the text as compared."""

    def search(block: DataFrame) -> DataFrame:
        items = [(r["item_id"], r["text"]) for r in block.collect()]
        shared = documents.sparkSession.sparkContext.broadcast(Index(items))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in by_bytes(batch, "text"):
                    texts = [plain(t or "") for t in part.column("text").to_pylist()]
                    rows = list(shared.value.hits(texts))
                    if rows:
                        number, *rest = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column("doc_id").cast(pa.int64()).take(pa.array(number)),
                                *(pa.array(c, pa.int64()) for c in rest),
                            ],
                            ["doc_id", "item_id", "n_segments", "first", "least_edits"],
                        )

        return documents.select("doc_id", "text").mapInArrow(work, HITS)

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return reduce(DataFrame.unionAll, map(search, _blocks(items)))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without contaminated ones; rows that share an id go together."""
    return without_ids(documents, find(documents, benchmark))
