"""Greedy word-piece counts by a linear longest-match automaton.

The pieces form a byte trie. Every node has a failure link: the node that holds
what remains of its string after the longest pieces at its front are taken off,
and the number of pieces taken off on the way. A word is read once, byte by
byte; where a byte has no edge the link is followed and its count added. So the
length of the greedy longest-match split is known without building a piece.

A worker runs the automaton over the distinct words of a slice of texts in
step, one byte of every word at a time. The vocabulary is read on the driver
and broadcast: its size does not depend on the data.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]`` and are matched with
``prefix`` (one space) in front, as word starts are spelled in the vocabulary;
null and empty texts have no words and no pieces. A byte that starts no piece
counts as one unknown piece.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import by_bytes, texts

PREFIX = b" "


class Automaton:
    """Trie over ``pieces`` with failure links and popped-piece counts.

    ``edge`` maps ``node * 256 + byte`` to a node through a flat hash table;
    node 0 is the root.
    """

    def __init__(self, pieces: list[bytes]):
        # single bytes outside the vocabulary are unknown pieces of one byte
        vocabulary = {p for p in pieces if p} | {bytes([b]) for b in range(256)}
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in sorted(vocabulary):
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    final.append(False)
                node = children[node][byte]
            final[node] = True
        fail, popped = [0] * len(children), [0] * len(children)
        level = [0]
        while level:
            following = []
            for parent in level:
                for byte, node in children[parent].items():
                    following.append(node)
                    if final[node]:
                        fail[node], popped[node] = 0, 1
                        continue
                    # what the parent leaves behind, then read the byte from there
                    at, count = fail[parent], popped[parent]
                    while byte not in children[at]:
                        count += popped[at]
                        at = fail[at]
                    fail[node], popped[node] = children[at][byte], count
            level = following
        self.fail = np.array(fail, np.int32)
        self.popped = np.array(popped, np.int32)
        keys = np.array(
            [n * 256 + b for n, c in enumerate(children) for b in c], np.int64
        )
        targets = np.array([t for c in children for t in c.values()], np.int32)
        self.bits = int(2 * len(keys)).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.targets = np.full(1 << self.bits, -1, np.int32)
        waiting = np.arange(len(keys))
        slot = self._slot(keys)
        while len(waiting):  # linear probing, all keys at once
            free = waiting[self.keys[slot[waiting]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.targets[slot[placed]] = keys[placed], targets[placed]
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            slot[waiting] = (slot[waiting] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, nodes: np.ndarray, octets: np.ndarray) -> np.ndarray:
        """Child of each node along a byte, or -1."""
        keys = nodes.astype(np.int64) * 256 + octets
        slot = self._slot(keys)
        out = np.full(len(keys), -1, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.targets[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of greedy longest-match pieces of each word."""
        total = np.zeros(len(words), np.int64)
        if not words:
            return total
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        octets = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")  # words still running stay in front
        lengths, starts = lengths[order], starts[order]
        nodes, count = np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        running = len(words)
        for k in range(int(lengths[0])):
            running = int(np.searchsorted(-lengths[:running], -k, side="left"))
            at = octets[starts[:running] + k]
            to = self.step(nodes[:running], at)
            stuck = np.flatnonzero(to < 0)
            while len(stuck):
                here = nodes[stuck]
                count[stuck] += self.popped[here]
                nodes[stuck] = self.fail[here]
                to[stuck] = self.step(nodes[stuck], at[stuck])
                stuck = stuck[to[stuck] < 0]
            nodes[:running] = to
        rest = np.flatnonzero(nodes)
        while len(rest):
            count[rest] += self.popped[nodes[rest]]
            nodes[rest] = self.fail[nodes[rest]]
            rest = rest[nodes[rest] > 0]
        total[order] = count
        return total


def read_pieces(source: str) -> list[bytes]:
    """Pieces of a vocabulary file of lines "base64 rank"."""
    return [base64.b64decode(line.split()[0]) for line in source.splitlines() if line.strip()]


_AUTOMATA: dict[str, Automaton] = {}


def _automaton(source: str) -> Automaton:
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = Automaton(read_pieces(source))
    return _AUTOMATA[key]


def count_pieces(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text", prefix: bytes = PREFIX
) -> DataFrame:
    """(key, n_words, n_pieces) of every row of ``df``."""
    with open(path, encoding="ascii") as file:
        source = df.sparkSession.sparkContext.broadcast(file.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(source.value)
        for batch in batches:
            for part in by_bytes(batch, text):
                words = [t.encode().split() for t in texts(part, text)]
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                flat = np.empty(int(sizes.sum()), object)
                flat[:] = [w for some in words for w in some]
                codes, distinct = pd.factorize(flat)
                each = automaton.counts([prefix + w for w in distinct])
                running = np.concatenate([[0], np.cumsum(each[codes])])
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key), pa.array(sizes),
                        pa.array(running[ends] - running[ends - sizes]),
                    ],
                    [key, "n_words", "n_pieces"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(work, f"`{key}` {kind}, n_words long, n_pieces long")
