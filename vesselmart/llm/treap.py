"""Ranked lexical search by K2-treaps over term-document grids.

Index. Each task cuts its documents into segments. A segment is a grid of terms
(rows, the frequent first) by documents (columns, the short first) whose cells
hold impacts: ``(10**9 * tf) // (1000 * tf + 12 * m)`` with ``m = 75 + 25 * n * N //
L``, a document's gain from a term before the term's weight. The grid is a
quadtree in level order: four bits a node tell which quadrants are not empty, and
each node has the greatest impact below it, kept as the drop from its parent in
as few bytes as the level needs; an only child has its parent's. The number of bits set before a quadrant's is
the number of its node, so that there are no pointers.

Search. An item's terms are rows, and its rows are followed together: a state is
a range of documents with a node for each row that has one there. The weights
times the maxima add up to a bound of the scores in the range, and to the score
where the range is one document. Ranges are split best first, many at a time; a
range whose bound is below an item's k-th score so far is left. Each task carries
these scores from segment to segment and hands on its k best documents an item.

Segments are bounded, documents are neither shuffled nor sent anywhere, and one
ranking puts together at most k rows of an item from each task. Weights need the
document counts of the items' terms alone, added up from the segments. Items are
searched in blocks of about ``BLOCK`` characters, counted first, one pass over the
index for each block; those are what is broadcast.

Defined results: null and empty texts have no terms, and neither match nor count;
rows that share an id are documents (items) of their own, of which equal scores
rank in any order; a null id ranks before others of its score; documents of score
0 are not returned. Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, materialised, texts

#: Most documents and about as many term occurrences a segment holds.
DOCUMENTS, POSTINGS = 1 << 13, 1 << 18
#: Characters of items searched for in one pass.
BLOCK = 400_000
#: Ranges of an item split at a time before it has k documents.
WIDTH = 64
#: Rows followed at a time, in all items.
PATHS = 1 << 18
_NULL = -(1 << 63)
#: ASCII letters in lower case, digits and bytes of longer characters; else a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z lowered."""
    return text.encode().translate(_FOLD).split()


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // count}") if count else np.zeros(0, np.uint8)


SEGMENT = "docs array<long>, sizes array<long>, terms binary, frequencies binary, columns binary, counts binary"


class _Builder:
    """Collects documents of one segment."""

    def __init__(self):
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.rows: defaultdict[bytes, int] = defaultdict()
        self.rows.default_factory = self.rows.__len__
        self.row, self.count, self.many = array("I"), array("I"), array("I")

    def add(self, doc_id: int | None, words: list[bytes]) -> None:
        found = Counter(words)
        self.docs.append(doc_id)
        self.sizes.append(len(words))
        self.row.extend(map(self.rows.__getitem__, found))
        self.count.extend(found.values())
        self.many.append(len(found))

    def full(self) -> bool:
        return len(self.docs) >= DOCUMENTS or len(self.row) >= POSTINGS

    def batch(self) -> pa.RecordBatch:
        row, count = np.frombuffer(self.row, np.uint32), np.frombuffer(self.count, np.uint32)
        sizes = np.array(self.sizes, np.int64)
        short = np.argsort(sizes, kind="stable")
        place = np.empty(len(sizes), np.int64)
        place[short] = np.arange(len(sizes))
        column = np.repeat(place, np.frombuffer(self.many, np.uint32))
        frequency = np.bincount(row, minlength=len(self.rows))
        words = list(self.rows)
        order = sorted(range(len(words)), key=lambda t: (-frequency[t], words[t]))
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        by_row = np.lexsort((column, place[row]))
        values = [
            pa.array([[self.docs[k] for k in short.tolist()]], pa.list_(pa.int64())),
            pa.array([sizes[short]], pa.list_(pa.int64())),
            *(
                pa.array([v], pa.binary()) for v in (
                    b" ".join(words[t] for t in order), _packed(frequency[order]),
                    _packed(column[by_row]), _packed(count[by_row]),
                )
            ),
        ]
        return pa.RecordBatch.from_arrays(values, ["docs", "sizes", "terms", "frequencies", "columns", "counts"])


def _segments(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Term counts of the documents, a row for each segment."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = _Builder()
        for batch in batches:
            for part in by_bytes(batch, text):
                ids = part.column(id_column).to_pylist()
                for doc_id, value in zip(ids, texts(part, text)):
                    if words := terms(value):
                        builder.add(doc_id, words)
                        if builder.full():
                            yield builder.batch()
                            builder = _Builder()
        if builder.docs:
            yield builder.batch()

    rows = documents.select(F.col(id_column).cast("long").alias(id_column), text)
    return rows.mapInArrow(work, SEGMENT)


def _spread(values: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2**32, each moved to twice its place."""
    values = values.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        values = (values | values << np.uint64(shift)) & np.uint64(mask)
    return values


def build_treap(row: np.ndarray, column: np.ndarray, impact: np.ndarray) -> tuple[int, int, list[bytes], list[bytes]]:
    """(levels, greatest impact, child bits by level, drops by level) of cells that differ."""
    levels = max(1, int(max(row.max(), column.max())).bit_length())
    codes = _spread(row) << np.uint64(1) | _spread(column)
    order = np.argsort(codes)
    codes, most = codes[order], impact[order].astype(np.int64)
    bits, drops = [], []
    for _ in range(levels):
        above = codes >> np.uint64(2)
        first = np.flatnonzero(np.concatenate(([True], above[1:] != above[:-1])))
        size = np.diff(np.append(first, len(above)))
        parent = np.repeat(np.arange(len(first)), size)
        present = np.zeros(4 * len(first), np.uint8)
        present[4 * parent + (codes & np.uint64(3)).astype(np.int64)] = 1
        greatest = np.maximum.reduceat(most, first)
        bits.append(np.packbits(present).tobytes())
        several = (size > 1)[parent]
        drops.append(_packed((greatest[parent] - most)[several]))
        codes, most = above[first], greatest
    return levels, int(most[0]), bits[::-1], drops[::-1]


class Treap:
    """A grid read back: quadrant bits, the nodes they lead to, and maxima."""

    def __init__(self, levels: int, top: int, bits: list[bytes], drops: list[bytes]):
        self.levels = levels
        present, most, nodes = [], [np.array([top], np.int32)], 1  # impacts are below 10**6
        for packed, drop in zip(bits, drops):
            here = np.unpackbits(np.frombuffer(packed, np.uint8), count=4 * nodes)
            present.append(here)
            size = here.reshape(-1, 4).sum(axis=1, dtype=np.int64)
            own, several = np.repeat(most[-1], size), np.repeat(size > 1, size)
            nodes = len(own)
            own[several] -= _unpacked(drop, int(several.sum())).astype(np.int32)
            most.append(own)
        self.present = np.concatenate(present).view(bool)
        #: bits set up to and with a quadrant's: the number of its node
        self.node = np.cumsum(self.present, dtype=np.int32)
        self.most = np.concatenate(most)


INDEX = "docs array<long>, terms binary, frequencies binary, levels int, top long, bits array<binary>, drops array<binary>"


@dataclass(frozen=True)
class Index:
    """Segments in the shared folder, documents with a term, and their terms with repeats."""

    segments: DataFrame
    documents: int
    length: int


def build(documents: DataFrame, id_column: str = "doc_id", text: str = "text") -> Index:
    """Index every document; impacts need the total counts, so terms are counted first."""
    counted = materialised(_segments(documents, id_column, text), "postings")
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    total = counted.agg(F.sum(F.size("docs")).alias("n"), F.sum(sizes).alias("l")).first()
    number, length = int(total["n"] or 0), int(total["l"] or 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part = batch.slice(k, 1)
                raw = {n: part.column(i)[0] for i, n in enumerate(part.schema.names)}
                size = raw["sizes"].values.to_numpy()
                words = raw["terms"].as_py().count(b" ") + 1
                frequency = _unpacked(raw["frequencies"].as_py(), words).astype(np.int64)
                cells = int(frequency.sum())
                column = _unpacked(raw["columns"].as_py(), cells).astype(np.int64)
                count = _unpacked(raw["counts"].as_py(), cells).astype(np.int64)
                m = np.array([75 + 25 * n * number // length for n in size.tolist()], np.int64)
                impact = 1_000_000_000 * count // (1000 * count + 12 * m[column])
                row = np.repeat(np.arange(words), frequency)
                levels, top, bits, drops = build_treap(row, column, impact)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(part.schema.get_field_index("docs")),
                        part.column(part.schema.get_field_index("terms")),
                        part.column(part.schema.get_field_index("frequencies")),
                        pa.array([levels], pa.int32()), pa.array([top], pa.int64()),
                        pa.array([bits], pa.list_(pa.binary())), pa.array([drops], pa.list_(pa.binary())),
                    ],
                    ["docs", "terms", "frequencies", "levels", "top", "bits", "drops"],
                )

    return Index(materialised(counted.mapInArrow(work, INDEX), "treaps"), number, length)


@dataclass
class Ranges:
    """Document ranges of items, and the rows followed in them, by range."""

    item: np.ndarray
    level: int
    first: np.ndarray  # number of the range among those of its level
    bound: np.ndarray
    size: np.ndarray  # rows followed
    row: np.ndarray  # places in the list of all items' rows
    node: np.ndarray

    def take(self, chosen: np.ndarray) -> Ranges:
        """The chosen ranges (a mask), in their order."""
        rows = np.repeat(chosen, self.size)
        return Ranges(
            self.item[chosen], self.level, self.first[chosen], self.bound[chosen],
            self.size[chosen], self.row[rows], self.node[rows],
        )


class Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))
        #: a range below has nothing to add; every score is above 0
        self.least = np.ones(items, np.int64)
        self.filled = np.zeros(items, bool)

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        item, doc, score = (
            np.concatenate(pair) for pair in ((self.item, item), (self.doc, doc), (self.score, score))
        )
        order = np.lexsort((doc, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[rank < self.k]
        last = rank == self.k - 1
        self.item, self.doc, self.score = item[rank < self.k], doc[kept], score[kept]
        self.filled[item[last]] = True
        self.least[item[last]] = score[order][last]


def _split(ranges: Ranges, treap: Treap, place: np.ndarray, weight: np.ndarray) -> Ranges:
    """Both halves of each range, where some row has a cell."""
    owner = np.repeat(np.arange(len(ranges.size)), ranges.size)
    down = place[ranges.row] >> (treap.levels - 1 - ranges.level) & 1
    at = 4 * ranges.node.astype(np.int64) + 2 * down
    halves = []
    for half in (0, 1):
        there = np.flatnonzero(treap.present[at + half])
        halves.append((2 * owner[there] + half, ranges.row[there], treap.node[at[there] + half]))
    key, row, node = (np.concatenate(pair) for pair in zip(*halves))
    order = np.argsort(key, kind="stable")
    key, row, node = key[order], row[order], node[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else key
    gain = weight[row] * treap.most[node]
    old = key[start] >> 1
    return Ranges(
        ranges.item[old], ranges.level + 1, 2 * ranges.first[old] + (key[start] & 1),
        np.add.reduceat(gain, start) if len(key) else gain, np.diff(np.append(start, len(key))), row, node,
    )


def _descend(treap: Treap, docs: np.ndarray, item: np.ndarray, place: np.ndarray, weight: np.ndarray, best: Best) -> None:
    """Improve ``best`` by a segment in which row ``place[j]`` counts ``weight[j]`` for ``item[j]``."""
    order = np.argsort(item, kind="stable")
    item, place, weight = item[order], place[order], weight[order]
    items, start = np.unique(item, return_index=True)
    size = np.diff(np.append(start, len(item)))
    bound = np.add.reduceat(weight, start) * treap.most[0]
    todo = [Ranges(items, 0, np.zeros(len(items), np.int64), bound, size, np.arange(len(item)), np.zeros(len(item), np.int32))]
    while todo:
        ranges = todo.pop()
        ranges = ranges.take(ranges.bound >= best.least[ranges.item])
        if not len(ranges.item):
            continue
        if ranges.level == treap.levels:
            best.add(ranges.item, docs[ranges.first], ranges.bound)
            continue
        # best ranges first: all of items with k documents, some of others, as many as fit
        order = np.lexsort((-ranges.bound, ranges.item))
        sorted_items = ranges.item[order]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        chosen = best.filled[ranges.item] | (rank < WIDTH)
        if ranges.size[chosen].sum() > PATHS:
            by_rank = np.argsort(np.where(chosen, rank, len(rank)), kind="stable")
            fits = np.cumsum(ranges.size[by_rank]) <= PATHS
            fits[0] = True
            some = np.zeros(len(chosen), bool)
            some[by_rank[fits]] = True
            chosen &= some
        if not chosen.all():
            todo.append(ranges.take(~chosen))
            ranges = ranges.take(chosen)
        todo.append(_split(ranges, treap, place, weight))


def _frequencies(index: Index, words: Broadcast) -> dict[bytes, int]:
    """Documents that hold each of the given terms."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total = words.value, Counter()
        for batch in batches:
            for packed, frequency in zip(*(c.to_pylist() for c in batch.columns)):
                mine = packed.split(b" ")
                found = [k for k, t in enumerate(mine) if t in wanted]
                many = _unpacked(frequency, len(mine))[found].tolist()
                total.update(dict(zip((mine[k] for k in found), many)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
            ["term", "documents"],
        )

    counts = index.segments.select("terms", "frequencies").mapInArrow(work, "term binary, documents long")
    # a row for each term of a block of items at most
    rows = counts.groupBy("term").agg(F.sum("documents").alias("documents")).collect()
    return {bytes(r["term"]): r["documents"] for r in rows}


def weight_of(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def _search_block(index: Index, queries: list[str], k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each task for each query."""
    context = index.segments.sparkSession.sparkContext
    counted = [Counter(terms(q)) for q in queries]
    words = context.broadcast(set().union(*counted) if counted else set())
    frequency = _frequencies(index, words)
    weights = {t: weight_of(index.documents, f) for t, f in frequency.items()}
    rows: dict[bytes, list[tuple[int, int]]] = {}
    for number, found in enumerate(counted):
        for term, repeats in found.items():
            if weights.get(term, 0) > 0:
                rows.setdefault(term, []).append((number, repeats * weights[term]))
    shared, items = context.broadcast(rows), len(queries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, best = shared.value, Best(items, k)
        for batch in batches:
            for at in range(batch.num_rows):
                docs, packed, levels, top, bits, drops = (c[at] for c in batch.columns)
                found = [
                    (item, row, weight)
                    for row, term in enumerate(packed.as_py().split(b" ")) if term in rows
                    for item, weight in rows[term]
                ]
                if found:
                    treap = Treap(levels.as_py(), top.as_py(), bits.as_py(), drops.as_py())
                    ids = docs.values.fill_null(_NULL).to_numpy()
                    _descend(treap, ids, *(np.array(c, np.int64) for c in zip(*found)), best)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(best.item.astype(np.int32)),
                pa.array(best.doc, mask=best.doc == _NULL), pa.array(best.score),
            ],
            ["item", "doc_id", "score"],
        )

    segments = index.segments.select("docs", "terms", "levels", "top", "bits", "drops")
    return segments.mapInArrow(work, "item int, doc_id long, score long")


def search(index: Index, items: DataFrame, k: int, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """(id, rank, doc_id, score) of each item's k best documents; equal texts are searched once."""
    spark = items.sparkSession
    named = items.select(id_column, F.sha2(text, 256).alias("key"), F.col(text).alias("query"))
    queries = materialised(named.filter("query IS NOT NULL").select("key", "query").distinct(), "queries")
    total = queries.agg(F.sum(F.length("query"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK))
    best = None
    for number in range(blocks):
        block = queries.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == number).collect()
        found = _search_block(index, [r["query"] for r in block], k)
        keys = spark.createDataFrame([(n, r["key"]) for n, r in enumerate(block)], "item int, key string")
        part = found.join(F.broadcast(keys), "item").drop("item")
        best = part if best is None else best.unionAll(part)
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(named.select(id_column, "key"), "key").select(id_column, "rank", "doc_id", "score")
