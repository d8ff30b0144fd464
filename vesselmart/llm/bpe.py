"""Byte-level BPE encoding and decoding by a segment tree over pair ranks.

A piece of text is a row of symbols. A segment tree holds, for each pair of
adjacent symbols, ``rank * leaves + position`` (no merge: a large number) and
keeps minima, so its root is the leftmost pair of lowest rank. A merge changes
three leaves, each repaired in logarithmic time, until the root holds no pair.

Short pieces of one batch are worked on together, one tree a row of a matrix;
longer ones get a tree of their own, of some 45 bytes of memory for each byte of
the piece. The vocabulary file is read on the driver and broadcast: its size does
not depend on the data. A worker's memory of pieces is bounded by bytes.

Defined results: null and empty texts give no ids and decode to an empty text;
bytes that are no UTF-8 decode to U+FFFD; other columns pass through ``encode``
and ``decode`` unchanged, but for one of the name that the result has.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import by_bytes, texts

#: White space, spelled out since regular-expression libraries differ on it.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _pattern(letter: str, digit: str, space: str) -> str:
    """Pre-tokens of byte-level BPE (fixed pattern of the public tokenizer)."""
    return (
        rf" ?[{letter}]++|'(?:s|t|re|ve|m|ll|d)| ?[{digit}]++"
        rf"| ?[^{space}{letter}{digit}]++|[{space}]+(?![^{space}])|[{space}]+"
    )


#: The pattern in full, and for texts of Latin-1 characters only, where the
#: quicker standard library can list the letters and digits.
FIND = regex.compile(_pattern(r"\p{L}", r"\p{N}", _WS)).findall
FIND_LATIN = re.compile(
    _pattern(r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0")
).findall
_NONE = 1 << 60
_FAR = np.int32(2**31 - 1)
#: Pieces merged at a time in step.
BLOCK = 4096
#: Pieces of up to this many bytes are merged together in a matrix.
SHORT = 32
#: Bytes of pieces a worker remembers; when full it starts anew, which costs time only.
MEMORY = 48 << 20
#: What a remembered piece takes besides its bytes.
ENTRY = 200


def byte_letters() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in vocabulary files of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks and bytes of the tokens of one tokenizer file (JSON text)."""

    def __init__(self, source: str):
        model = json.loads(source)
        letters = byte_letters()
        vocab: dict[str, int] = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        # set in vocabularies of words, on the last symbol of each piece
        suffix = model["model"].get("end_of_word_suffix") or ""
        self.token_bytes = [b""] * self.size
        for token, number in vocab.items():
            if number not in self.special.values():
                plain = token[:-len(suffix)] if suffix and token.endswith(suffix) else token
                self.token_bytes[number] = bytes(letters[c] for c in plain)
        for token, number in self.special.items():
            self.token_bytes[number] = token.encode()
        self.byte_ids, self.last_ids = np.empty(256, np.int32), np.empty(256, np.int32)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
            self.last_ids[byte] = vocab[letter + suffix]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = left * self.size + right
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        # ranks of two bytes inside a piece, and of the two at its end
        self.byte_pairs, self.last_pairs = (
            self.ranks(np.repeat(self.byte_ids, 256), np.tile(second, 256)).reshape(256, 256)
            for second in (self.byte_ids, self.last_ids)
        )
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special else None
        )

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1; a symbol below 0 pairs with nothing."""
        keys = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        good = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(good, self.order[at], np.int32(-1))

    def symbols(self, piece: bytes) -> np.ndarray:
        """A piece's bytes as the symbols that merging begins with."""
        octets = np.frombuffer(piece, np.uint8)
        out = self.byte_ids[octets]
        out[-1:] = self.last_ids[octets[-1:]]
        return out


def merge_one(row: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Merge one row of symbols with a segment tree of its own."""
    n = len(row)
    if n < 2:
        return row
    leaves = 1 << (n - 1).bit_length()
    none, size, keys = _NONE, vocab.size, vocab.keys
    symbols = array("i", row.astype(np.int32).tobytes())

    def leaf(i: int, j: int) -> int:
        key = symbols[i] * size + symbols[j]
        at = bisect_left(keys, key)
        return int(vocab.order[at]) * leaves + i if at < len(keys) and keys[at] == key else none

    ranks = vocab.ranks(row[:-1], row[1:]).astype(np.int64)
    packed = np.full(2 * leaves, none, np.int64)
    packed[leaves:leaves + n - 1] = np.where(ranks >= 0, ranks * leaves + np.arange(n - 1), none)
    width = leaves // 2
    while width:
        packed[width:2 * width] = np.minimum(packed[2 * width:4 * width:2], packed[2 * width + 1:4 * width:2])
        width //= 2
    tree = array("q", packed.tobytes())
    del packed, ranks
    after, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))

    def put(i: int, value: int) -> None:
        k = leaves + i
        tree[k] = value
        k >>= 1
        while k:
            low = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == low:
                break
            tree[k] = low
            k >>= 1

    while tree[1] < none:
        rank, i = divmod(tree[1], leaves)
        gone, right = after[i], after[after[i]]
        symbols[i], symbols[gone], after[i] = int(vocab.merged[rank]), -1, right
        put(gone, none)
        if right < n:
            before[right] = i
            put(i, leaf(i, right))
        else:
            put(i, none)
        if before[i] >= 0:
            put(before[i], leaf(before[i], i))
    merged = np.frombuffer(symbols, np.int32)
    return merged[merged >= 0]


def merge_many(pieces: list[bytes], leaves: int, vocab: Vocabulary) -> list[bytes]:
    """Merge pieces of 1 to ``leaves`` bytes in step; ids as packed 32-bit integers.

    Every piece is a row of three flat matrices: symbols with their neighbours,
    and the tree. Rows are taken in blocks that stay in the processor's cache.
    """
    out: list[bytes] = []
    for k in range(0, len(pieces), BLOCK):
        out += _merge_block(pieces[k:k + BLOCK], leaves, vocab)
    return out


def _merge_block(pieces: list[bytes], leaves: int, vocab: Vocabulary) -> list[bytes]:
    rows, wide = len(pieces), leaves + 1  # the last column ends every row
    lengths = np.fromiter(map(len, pieces), np.int64, rows)
    row = np.repeat(np.arange(rows), lengths)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    octets = np.frombuffer(b"".join(pieces), np.uint8)
    symbols = np.full(rows * wide, -1, np.int32)
    symbols[row * wide + column] = vocab.byte_ids[octets]
    symbols[np.arange(rows) * wide + lengths - 1] = vocab.last_ids[octets[np.cumsum(lengths) - 1]]
    after = np.tile(np.arange(1, wide + 1, dtype=np.int32), rows)
    after[np.arange(rows) * wide + lengths - 1] = leaves
    before = np.tile(np.arange(-1, leaves, dtype=np.int32), rows)
    tree = np.full((rows, 2 * leaves), _FAR, np.int32)
    inner = column[1:] > 0  # bytes that follow another one of their piece
    place = column[1:][inner] - 1
    pair = np.where(
        place + 2 == lengths[row[1:][inner]],
        vocab.last_pairs[octets[:-1][inner], octets[1:][inner]],
        vocab.byte_pairs[octets[:-1][inner], octets[1:][inner]],
    )
    tree[row[1:][inner], leaves + place] = np.where(pair >= 0, pair * leaves + place, _FAR)
    width = leaves // 2
    while width:
        np.minimum(
            tree[:, 2 * width:4 * width:2], tree[:, 2 * width + 1:4 * width:2],
            out=tree[:, width:2 * width],
        )
        width //= 2
    tree = tree.ravel()

    def leaf(first: np.ndarray, second: np.ndarray, i: np.ndarray) -> np.ndarray:
        rank = vocab.ranks(first, second)
        return np.where(rank >= 0, rank * leaves + i, _FAR)

    live = np.flatnonzero(tree[1::2 * leaves] < _FAR)
    while len(live):
        rank, i = np.divmod(tree[live * (2 * leaves) + 1], leaves)
        base = live * wide
        here = base + i
        gone = after[here]
        right = after[base + gone]
        new = vocab.merged[rank]
        symbols[here], symbols[base + gone] = new, -1
        after[here] = right
        before[base + right] = i
        left = before[here]
        has = np.flatnonzero(left >= 0)
        root = live * (2 * leaves)
        # the pair removed, the pair to the right and the pair to the left
        k = np.concatenate([leaves + gone, leaves + i, leaves + left[has]])
        root = np.concatenate([root, root, root[has]])
        tree[root + k] = np.concatenate([
            np.full(len(live), _FAR, np.int32),
            leaf(new, symbols[base + right], i),
            leaf(symbols[base[has] + left[has]], new[has], left[has]),
        ])
        k >>= 1
        while k[0]:  # all leaves are equally deep
            child = root + 2 * k
            tree[root + k] = np.minimum(tree[child], tree[child + 1])
            k >>= 1
        live = live[tree[live * (2 * leaves) + 1] < _FAR]
    grid = symbols.reshape(rows, wide)
    kept = grid >= 0
    packed = grid[kept].astype("<u4").tobytes()
    ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
    return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def pre_tokens(text: str) -> list[str]:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return FIND(text)
    return FIND_LATIN(text)


def merge_pieces(pieces: Iterable[bytes], vocab: Vocabulary) -> Iterator[tuple[bytes, bytes]]:
    """Each piece (of one byte at least) with its ids as packed 32-bit integers."""
    ordered = sorted(pieces, key=len)
    start, leaves = 0, 2
    while leaves <= SHORT:
        end = bisect_right(ordered, leaves, start, key=len)
        some = ordered[start:end]
        yield from zip(some, merge_many(some, leaves, vocab))
        start, leaves = end, 2 * leaves
    for piece in ordered[start:]:
        yield piece, merge_one(vocab.symbols(piece), vocab).astype("<u4").tobytes()


class Codec:
    """Encoder and decoder of one worker, with a memory of pieces seen."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.memory: dict[str, bytes] = {}
        self.used = 0

    def _learn(self, pieces: set[str]) -> None:
        if self.used > MEMORY:
            self.memory, self.used = {}, 0
        new = {p.encode(): p for p in pieces.difference(self.memory)}
        for piece, packed in merge_pieces(new, self.vocab):
            self.memory[new[piece]] = packed
            self.used += len(piece) + len(packed) + ENTRY

    def encode(self, many: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        vocab = self.vocab
        parts = [
            vocab.split_special.split(t) if any(s in t for s in vocab.special) else [t] for t in many
        ]
        # odd places hold special tokens
        pieces = [[pre_tokens(p) if not k % 2 else p for k, p in enumerate(some)] for some in parts]
        self._learn({x for some in pieces for p in some[::2] for x in p})
        take = self.memory.__getitem__
        out = []
        for some in pieces:
            packed = [
                vocab.special[p].to_bytes(4, "little") if k % 2 else b"".join(map(take, p))
                for k, p in enumerate(some)
            ]
            out.append(b"".join(packed))
        return out

    def decode(self, ids: np.ndarray) -> str:
        joined = b"".join(map(self.vocab.token_bytes.__getitem__, ids.tolist()))
        return joined.decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def _codec(source: str) -> Codec:
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(Vocabulary(source))
    return _CODECS[key]


def _source(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _schema(df: DataFrame, out: str, kind: T.DataType) -> T.StructType:
    kept = [f for f in df.schema.fields if f.name != out]
    return T.StructType([*kept, T.StructField(out, kind)])


def _with_column(batch: pa.RecordBatch, out: str, values: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != out]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), values], [*kept, out])


def _id_lists(packed: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(p) // 4 for p in packed)])
    ids = np.frombuffer(b"".join(packed), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the token ids of column ``text`` as an array of integers."""
    source = _source(df, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(source.value)
        for batch in batches:
            for part in by_bytes(batch, text):
                yield _with_column(part, out, _id_lists(codec.encode(texts(part, text))))

    return df.mapInArrow(work, _schema(df, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that column ``ids`` stands for; null ids give an empty text."""
    source = _source(df, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(source.value)
        for batch in batches:
            lists = batch.column(ids)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(sizes)
            decoded = [codec.decode(flat[e - n:e]) for e, n in zip(ends.tolist(), sizes.tolist())]
            yield _with_column(batch, out, pa.array(decoded, pa.string()))

    return df.mapInArrow(work, _schema(df, out, T.StringType()))


def with_ids(df: DataFrame, path: str, text: str = "text", ids: str = "ids", same: str = "decodes") -> DataFrame:
    """``df`` with token ids in place of ``text``, and whether they decode to it.

    Both directions in one Python function, so that a task has one worker with
    one vocabulary.
    """
    source = _source(df, path)
    kept = [f for f in df.schema.fields if f.name not in (text, ids, same)]
    schema = T.StructType([
        *kept, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(same, T.BooleanType())
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(source.value)
        for batch in batches:
            for part in by_bytes(batch, text):
                many = texts(part, text)
                packed = codec.encode(many)
                decodes = [codec.decode(np.frombuffer(p, "<u4")) == t for p, t in zip(packed, many)]
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, _id_lists(packed), pa.array(decodes)], [*(f.name for f in kept), ids, same]
                )

    return df.mapInArrow(work, schema)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """Per document of (doc_id, text): digests of its ids and of their decoding."""
    source = _source(df, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(source.value)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                packed = codec.encode(texts(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array([len(p) // 4 for p in packed], pa.int64()),
                        pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                        pa.array([
                            hashlib.sha256(codec.decode(np.frombuffer(p, "<u4")).encode()).hexdigest()
                            for p in packed
                        ]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return df.select("doc_id", "text").mapInArrow(work, DIGESTS)
