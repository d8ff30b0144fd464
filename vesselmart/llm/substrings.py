"""Removal of repeated word sequences, found by difference-cover anchors.

A window is ``WINDOW`` = 20 consecutive words of one document. A word goes if a
window over it has the same words as a window that starts earlier: in a
document of smaller id, or before it in the same document.

Anchors. Positions whose remainder modulo ``PERIOD`` = 13 is in ``COVER`` =
{0, 1, 3, 9} carry an anchor, the hash of the eight words from there on. Every
difference modulo 13 is a difference of two members of the cover, so for any two
positions i and j some shift below 13 takes both to an anchored position, and
13 - 1 + 8 = 20: two equal windows share an anchor at the same place inside.
Less than a third of the positions is hashed and shuffled.

Extension. Around the anchors that occur twice, all windows of 20 words are
hashed, and of each the first occurrence is found. The others' words go.

Copies of whole documents are settled first: all but the first lose everything
(if they have a window at all) and take no part in the rest.

Skew. A passage held by a third of all documents gives each task one row for the
key's partition; the others of that task have company or an earlier occurrence
at hand and are spread out. Minima over a key are over those rows. Rows collected
to one record are those of one document. Tables of document ids are broadcast
only when counted below ``BROADCAST_ROWS``, else the join is a shuffle.

Hashes are 64 bits for anchors, where a clash only costs time, and 96 bits for
windows. Defined results: null texts have no words. Null ids come first. Rows that
share an id are rows of their own, in an order that is settled once: where ids are
repeated or null, rows are sorted by id, numbered and written at the start, and the
numbers stand for the ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, materialised, texts
from .shingles import mix, word_hashes

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
#: Rows a task combines at a time.
COMBINED = 1 << 19
BROADCAST_ROWS = 500_000
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _words(many: list[str]) -> list[list[bytes]]:
    return [t.encode().split() for t in many]


def _sequence_hash(hashes: np.ndarray, at: np.ndarray, length: int, step: np.uint64) -> np.ndarray:
    """Hash of the ``length`` words from each position on."""
    value = np.zeros(len(at), np.uint64)
    for k in range(length):
        value = value * step + hashes[at + k]
    return mix(value)


def _positions(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of every sequence of ``length`` words in texts of a window or more."""
    count = np.where(sizes >= WINDOW, sizes - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), count)
    return text, np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)


def anchors(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, hash) of every anchor."""
    hashes, sizes = word_hashes(words)
    text, start = _positions(sizes, ANCHOR)
    covered = np.isin(start % PERIOD, COVER)
    text, start = text[covered], start[covered]
    base = np.cumsum(sizes) - sizes
    return text, start, _sequence_hash(hashes, base[text] + start, ANCHOR, _STEPS[0])


def _whole(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, digest, kept_sha256) as if nothing were repeated."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                words = _words(texts(part, "text"))
                digests = [hashlib.sha256(b" ".join(w)) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([d.digest()[:16] for d in digests], pa.binary()),
                        pa.array([d.hexdigest() for d in digests]),
                    ],
                    ["doc_id", "n_words", "digest", "kept_sha256"],
                )

    return documents.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_words long, digest binary, kept_sha256 string"
    )


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _shared_anchors(documents: DataFrame) -> DataFrame:
    """(doc_id, keys): the anchors of each document that occur elsewhere too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, doc = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            company = ~first
            company[:-1] |= ~first[1:]
            again = np.zeros(len(key), bool)
            again[1:] = ~first[1:] & (doc[1:] == doc[:-1])
            key, doc, first, company = (x[~again] for x in (key, doc, first, company))
            salt = np.where(first, np.uint64(0), mix(doc.view(np.uint64)) | np.uint64(1))
            return pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(salt.view(np.int64)), pa.array(doc), pa.array(company)],
                ["key", "salt", "doc_id", "company"],
            )

        size = 0
        for batch in batches:
            for part in by_bytes(batch, "text"):
                text, _, key = anchors(_words(texts(part, "text")))
                held.append((key, part.column("doc_id").cast(pa.int64()).to_numpy()[text]))
                size += len(key)
                if size >= COMBINED:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    rows = documents.select("doc_id", "text").mapInArrow(
        work, "key long, salt long, doc_id long, company boolean"
    )
    alike = Window.partitionBy("key", "salt")
    rows = rows.withColumn("low", F.min("doc_id").over(alike)).withColumn("high", F.max("doc_id").over(alike))
    rows = rows.filter(F.col("company") | (F.col("low") != F.col("high")))
    return rows.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def _windows(rows: DataFrame) -> DataFrame:
    """Windows around the shared anchors of (doc_id, text, keys).

    Of each window one task sends its first occurrence to the others'; words
    under later ones are ranges (``first`` to ``last`` exclusive) already.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            high, low, doc, start = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((start, doc, low, high))
            high, low, doc, start = high[order], low[order], doc[order], start[order]
            first = np.ones(len(high), bool)
            first[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            # later occurrences, joined to ranges of words
            order = np.lexsort((start[~first], doc[~first]))
            gone_doc, gone = doc[~first][order], start[~first][order]
            begins = np.ones(len(gone), bool)
            begins[1:] = (gone_doc[1:] != gone_doc[:-1]) | (gone[1:] > gone[:-1] + WINDOW)
            at = np.flatnonzero(begins)
            last = np.append(at[1:], len(gone)) - 1
            spread = mix(gone_doc[at].view(np.uint64) * np.uint64(3) + gone[at].astype(np.uint64))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([high[first], spread]).view(np.int64)),
                    pa.array(np.concatenate([low[first], np.full(len(at), -1)]), pa.int32()),
                    pa.array(np.concatenate([doc[first], gone_doc[at]])),
                    pa.array(np.concatenate([start[first], gone[at]]), pa.int32()),
                    pa.array(np.concatenate([start[first] + WINDOW, gone[last] + WINDOW]), pa.int32()),
                ],
                ["high", "low", "doc_id", "first", "last"],
            )

        size = 0
        for batch in batches:
            for part in by_bytes(batch, "text"):
                words = _words(texts(part, "text"))
                hashes, sizes = word_hashes(words)
                text, at, key = anchors(words)
                lists = part.column("keys")
                wanted = lists.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(len(sizes)), np.diff(lists.offsets.to_numpy()))
                # anchors of a text among its own shared keys
                pair = mix(key + mix(text.astype(np.uint64)))
                hit = np.isin(pair, mix(wanted + mix(owner.astype(np.uint64))))
                text, at = text[hit], at[hit]
                base = np.cumsum(sizes) - sizes
                mark = np.zeros(int(sizes.sum()) + 1, np.int64)
                np.add.at(mark, base[text] + np.maximum(at - PERIOD + 1, 0), 1)
                np.add.at(mark, base[text] + np.minimum(at, sizes[text] - WINDOW) + 1, -1)
                where = np.flatnonzero(np.cumsum(mark)[:-1] > 0)
                text = np.searchsorted(np.cumsum(sizes), where, side="right")
                high = _sequence_hash(hashes, where, WINDOW, _STEPS[0])
                low = (_sequence_hash(hashes, where, WINDOW, _STEPS[1]) >> np.uint64(33)).astype(np.int64)
                doc = part.column("doc_id").cast(pa.int64()).to_numpy()[text]
                held.append((high, low, doc, where - base[text]))
                size += len(where)
                if size >= COMBINED:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return rows.select("doc_id", "text", "keys").mapInArrow(
        work, "high long, low int, doc_id long, first int, last int"
    )


def repeated_ranges(documents: DataFrame) -> DataFrame:
    """(doc_id, ranges) of the words to remove, for documents without copies before them."""
    shared = materialised(_shared_anchors(documents), "anchors")
    rows = documents.select("doc_id", "text").join(shared, "doc_id")
    windows = _windows(rows)
    # ranges already known have -1 here and a key of their own
    earliest = F.min(F.struct("doc_id", "first")).over(Window.partitionBy("high", "low"))
    gone = windows.withColumn("earliest", earliest).filter(
        (F.col("low") == -1) | (F.struct("doc_id", "first") != F.col("earliest"))
    )
    listed = gone.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("r"))
    merged = F.aggregate(
        F.col("r"), F.array().cast("array<struct<first:int,last:int>>"),
        lambda done, r: F.when(
            (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["last"] >= r["first"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.get(done, F.size(done) - 1)["first"].alias("first"),
                        F.greatest(F.get(done, F.size(done) - 1)["last"], r["last"]).alias("last"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(r))),
    )
    return listed.select("doc_id", merged.alias("ranges"))


def _kept(words: list[bytes], ranges: list[dict]) -> list[bytes]:
    out, last = [], 0
    for r in ranges:
        out += words[last:r["first"]]
        last = r["last"]
    return out + words[last:]


def _without(rows: DataFrame) -> DataFrame:
    """Digests of (doc_id, text, ranges) once the ranges are gone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                words = _words(texts(part, "text"))
                kept = [_kept(w, r) for w, r in zip(words, part.column("ranges").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(w) - len(k) for w, k in zip(words, kept)], pa.int64()),
                        pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for k in kept]),
                    ],
                    ["doc_id", "n_removed", "rest_sha256"],
                )

    return rows.select("doc_id", "text", "ranges").mapInArrow(
        work, "doc_id long, n_removed long, rest_sha256 string"
    )


def _firsts(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Whole digests with a mark on copies; the documents without copies before them."""
    whole = materialised(_whole(documents), "whole")
    first = whole.groupBy("digest", "n_words").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    several = materialised(first.filter("n > 1").drop("n"), "copied")
    listed = F.broadcast(several) if _few(several) else several
    copies = whole.select("doc_id", "digest", "n_words").join(listed, ["digest", "n_words"])
    copies = materialised(copies.filter("doc_id <> first_id").select("doc_id"), "copies")
    text = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small = _few(copies)
    firsts = text.join(F.broadcast(copies) if small else copies, "doc_id", "left_anti")
    return whole, copies, firsts


def _numbered(documents: DataFrame) -> DataFrame:
    """(row, doc_id, text), written; ``row`` follows the ids, nulls first."""
    # sorted by place besides, so that rows of one id spread over several tasks
    placed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("place")
    )
    rows = placed.orderBy(F.col("doc_id").asc_nulls_first(), "place")
    return materialised(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")


def deduplicate(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``documents(doc_id, text)``."""
    held = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if held.filter("n > 1 OR doc_id IS NULL").isEmpty():
        return _deduplicate(documents)
    rows = _numbered(documents)
    found = _deduplicate(rows.select(F.col("row").alias("doc_id"), "text")).withColumnRenamed("doc_id", "row")
    return rows.select("row", "doc_id").join(found, "row").drop("row")


def _deduplicate(documents: DataFrame) -> DataFrame:
    """``deduplicate`` of rows with distinct ids."""
    whole, copies, firsts = _firsts(documents)
    ranges = materialised(repeated_ranges(firsts), "ranges")
    small = _few(ranges)
    rest = _without(firsts.join(F.broadcast(ranges) if small else ranges, "doc_id"))
    rows = whole.drop("digest").join(rest, "doc_id", "left").join(
        copies.withColumn("copy", F.lit(True)), "doc_id", "left"
    )
    empty = hashlib.sha256(b"").hexdigest()
    all_gone = F.col("copy") & (F.col("n_words") >= WINDOW)
    return rows.select(
        "doc_id", "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(all_gone, F.lit(empty)).otherwise(F.coalesce("rest_sha256", "kept_sha256")).alias("kept_sha256"),
    )
