"""Best-fit packing planned on a histogram of lengths.

Documents become token ids, each with a separator at its end; longer ones are
cut into pieces of ``capacity`` tokens. The plan needs only the number of pieces
of each length: lengths are gone through from the longest down, and all pieces
of a length go to the sequences with the least room that still holds one, as
best-fit decreasing would put them one by one. Sequences of equal room are kept
as ranges of numbers, so a step handles a range at once, however many pieces.

Pieces then take the planned slots by their rank within their length. A task
counts each length as it writes; with the counts of the tasks before it this
gives ranks without a sort, so that a length that a third of all pieces have is
no hot key. A run of the plan is (length, first rank, pieces a sequence, first
sequence, offset).

Size of the plan. Filling a range leaves less than half its room, so a range is
filled 12 times at most for a capacity of 4096, and a length starts at most four
new ranges: fewer than 4 * 12 * 4096 runs (:func:`most_runs`), whatever the number
of documents. That is what is broadcast.

Defined results: null and empty texts are pieces of the separator alone;
repeated rows, repeated ids and null ids are pieces of their own; an empty table
gives no pieces; other columns are not looked at.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import ENTRY, Vocabulary, byte_letters, merge_pieces
from .common import by_bytes, materialised, texts

CAPACITY = 4096
SEPARATOR = 1
#: Bytes of pieces a worker remembers; when full it starts anew, which costs time only.
MEMORY = 160 << 20
#: The tokenizer's own pattern (fixed) for Latin-1: contractions, letters, single
#: digits, other signs. Keys keep their case, which is lowered when merged.
_LETTERS, _DIGITS, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_PATTERN = (
    rf"'(?:[sS]|[tT]|[rR][eE]|[vV][eE]|[mM]|[lL][lL]|[dD])|[{_LETTERS}]+|[{_DIGITS}]"
    rf"|[^{_SPACE}{_LETTERS}{_DIGITS}]+"
)
_LATIN_PIECES = re.compile(_PATTERN).findall
#: The same, but whole what stands between white space and is not all Latin-1.
_MIXED_PIECES = re.compile(
    rf"[^{_SPACE}Ā-\U0010ffff]*[Ā-\U0010ffff][^{_SPACE}]*|{_PATTERN}"
).findall


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Token ids of texts, equal to those of the tokenizers library.

    The tokenizer drops white space, and neither its normaliser nor its merges
    reach across it, so a text's ids are those of its chunks, one after the
    other. Latin-1 chunks, which normalising only lowers, are cut by the
    tokenizer's pattern, others are normalised and cut by the library; the pieces
    of a slice that are not yet known are merged together. A chunk that may hold a
    special token is left to the library whole.
    """

    def __init__(self, source: str):
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocab = Vocabulary(source)
        self.marks = {t[:2] for t in self.vocab.special}
        self.table = str.maketrans({c: chr(b) for c, b in byte_letters().items()})
        self.memory: dict[str, bytes] = {}
        self.used = 0

    def _pieces(self, text: str) -> list[str]:
        if any(m in text for m in self.marks):
            parts = [[c] if any(m in c for m in self.marks) else _MIXED_PIECES(c) for c in re.split(r"[\t-\r ]+", text)]
            return [p for some in parts for p in some]
        return _LATIN_PIECES(text) if _is_latin(text) else _MIXED_PIECES(text)

    def _cut(self, chunk: str) -> list[bytes]:
        """Bytes of the pieces the library makes of a chunk."""
        made = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(chunk))
        return [p.translate(self.table).encode("latin-1") for p, _ in made]

    def _learn(self, pieces: set[str]) -> None:
        if self.used > MEMORY:
            self.memory, self.used = {}, 0
        known = self.memory
        fresh = pieces.difference(known)
        marked = {p for m in self.marks for p in fresh if m in p}
        for piece in marked:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            known[piece] = np.array(ids, "<u4").tobytes()
        rest = [p for p in fresh if p not in marked] if marked else list(fresh)
        latin = [p for p in rest if p.isascii() or _is_latin(p)]
        plain = list(map(str.encode, map(str.lower, latin)))
        cut = {p: self._cut(p) for p in set(rest).difference(latin)} if len(latin) < len(rest) else {}
        merged = dict(merge_pieces({*plain, *(p for some in cut.values() for p in some)}, self.vocab))
        known.update(zip(latin, map(merged.__getitem__, plain)))
        known.update((piece, b"".join([merged[p] for p in some])) for piece, some in cut.items())
        self.used += 2 * sum(map(len, fresh)) + ENTRY * len(fresh)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers."""
        pieces = [self._pieces(t) for t in texts]
        self._learn(set().union(*pieces))
        take = self.memory.__getitem__
        return [b"".join(map(take, some)) for some in pieces]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(source: str) -> Encoder:
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(source)
    return _ENCODERS[key]


@dataclass
class Plan:
    """Runs of slots; run k serves ranks from ``rank[k]`` on, up to the next run of its length."""

    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)  # pieces put into one sequence
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    sequences: int = 0

    def add(self, length: int, rank: int, each: int, sequence: int, offset: int) -> None:
        self.length.append(length)
        self.rank.append(rank)
        self.each.append(each)
        self.sequence.append(sequence)
        self.offset.append(offset)


def most_runs(capacity: int) -> int:
    """Bound on the runs of any plan."""
    return 4 * capacity * max(1, math.ceil(math.log2(capacity)))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-fit decreasing over the number of pieces of each length."""
    made = Plan()
    rooms: list[int] = []  # with open sequences, ascending
    ranges: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, number)

    def open_up(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in ranges:
                ranges[room] = []
                bisect.insort(rooms, room)
            ranges[room].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                first, number = made.sequences, -(-left // (capacity // length))
                made.sequences += number
                open_up(capacity, first, number)
                at = bisect.bisect_left(rooms, length)
            room = rooms[at]
            first, number = ranges[room].pop()
            if not ranges[room]:
                del ranges[room], rooms[at]
            each = room // length
            full = min(number, left // each)
            if full:
                made.add(length, rank, each, first, capacity - room)
                open_up(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < number and left:
                made.add(length, rank, left, first + full, capacity - room)
                open_up(room - left * length, first + full, 1)
                full, left = full + 1, 0
            open_up(room, first + full, number - full)
    return made


PIECES = "piece int, start long, length long, ids_crc32 long, chunk int, place long"


def _pieces(df: DataFrame, source: str, capacity: int, separator: int, id_column: str, text: str, with_ids: bool) -> DataFrame:
    """Pieces as they are met, each with its place among its task's pieces of its length."""
    shared = df.sparkSession.sparkContext.broadcast(source)
    end = separator.to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        chunk = TaskContext.get().partitionId()
        met = [0] * (capacity + 1)
        for batch in batches:
            for part in by_bytes(batch, text):
                which, piece, start, size, crc, place, ids = [], [], [], [], [], [], []
                for row, packed in enumerate(encoder.encode(texts(part, text))):
                    packed += end
                    for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                        mine = packed[at:at + 4 * capacity]
                        length = len(mine) // 4
                        which.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        size.append(length)
                        crc.append(zlib.crc32(mine))
                        place.append(met[length])
                        met[length] += 1
                        if with_ids:
                            ids.append(mine)
                columns = [
                    part.column(id_column).take(pa.array(which, pa.int64())),
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array([chunk] * len(which), pa.int32()), pa.array(place, pa.int64()),
                ]
                names = [id_column, "piece", "start", "length", "ids_crc32", "chunk", "place"]
                if with_ids:
                    ends = np.cumsum([0, *size])
                    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {PIECES}" + (", ids array<int>" if with_ids else "")
    return df.select(id_column, text).mapInArrow(work, schema)


def _ranked(pieces: DataFrame) -> DataFrame:
    """Pieces with their rank within their length over all tasks."""
    counts = pieces.groupBy("length", "chunk").agg((F.max("place") + 1).alias("n"))
    # one row a task and length: the window's partitions have as many rows as there are tasks
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    return pieces.join(bases, ["length", "chunk"]).withColumn("rank", F.col("base") + F.col("place"))


def pack(
    df: DataFrame, path: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
    id_column: str = "doc_id", text: str = "text", with_ids: bool = True,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece.

    ``path`` is a tokenizer file whose ids do not depend on text beyond white space.
    """
    with open(path, encoding="utf-8") as file:
        source = file.read()
    pieces = materialised(
        _pieces(df, source, capacity, separator, id_column, text, with_ids), "pieces"
    )
    # at most one row for each length up to the capacity
    counts = pieces.groupBy("length").count().collect()
    made = plan({r["length"]: r["count"] for r in counts}, capacity)
    assert len(made.length) <= most_runs(capacity)
    runs = np.array([made.length, made.rank, made.each, made.sequence, made.offset], np.int64)
    # one ordered key a run: lengths as planned, then ranks
    order = np.lexsort((runs[1], runs[0]))
    shared = df.sparkSession.sparkContext.broadcast(runs[:, order])
    kept = [id_column, "piece", "start", "length", "ids_crc32", "rank", *(["ids"] if with_ids else [])]
    out = [f for f in pieces.schema.fields if f.name in kept]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, each, sequence, offset = shared.value
        first = np.searchsorted(length, np.arange(capacity + 2))
        for batch in batches:
            mine = batch.column(batch.schema.get_field_index("length")).to_numpy()
            turn = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            run = np.empty(len(mine), np.int64)
            for size in np.unique(mine).tolist():
                here = mine == size
                a, b = first[size], first[size + 1]
                run[here] = a + np.searchsorted(rank[a:b], turn[here], side="right") - 1
            nth, slot = np.divmod(turn - rank[run], each[run])
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names if n != "rank"}
            columns["sequence_id"] = pa.array(sequence[run] + nth)
            columns["offset"] = pa.array(offset[run] + slot * mine)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out)
    ranked = _ranked(pieces).select(*[f.name for f in out], "rank")
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) from packed pieces with ids; a group has ``capacity`` tokens at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
