"""Jaccard join of shingle sets by parity sketches.

Texts link when their sets of five-word shingles have a Jaccard similarity of
at least 80 / 100. With sizes s and t, such sets differ in at most (s + t) / 9
shingles.

Sketches. Shingles are dealt by a hash into ``r`` chunks, and each chunk is the
exclusive or of the hashes of its shingles. A differing shingle changes one
chunk, so similar sets agree in all but (s + t) / 9 chunks. A second, narrow
sketch keeps one parity bit for each of 1024 hash values: its Hamming distance
is a lower bound of the symmetric difference.

Size bands. The number of chunks follows the power of two below the size, so
that a chunk holds one to three shingles; a set little above a power of two is
sketched for the band below as well, as partners of at most 5/4 its size meet
there. Below 64 shingles each shingle is a chunk of its own.

Pigeonhole join. With at most D differing chunks, and chunks ordered alike for
all sets (most shingles first), the first D + 1 chunks of either set have one in
common. Only those become join keys. Chunks of several shingles come first since
a passage shared by many documents rarely fills one.

Verification. Keys shared by different sets are kept. In each, the set with
most shared keys is compared with the others; links found are contracted to
components. Then the pairs across components that share a key and pass the
Hamming bound are compared, so that no link between components is lost. Links
inside a component need not be known. Comparison is exact, on the texts.

Skew. Equal sets are one node. Within a task only one row of a key goes to the
key's partition, the rest are known to be shared and spread out, so that a key
held by a third of all documents has a row for each task at most. A group to
compare is at most ``MEMBERS`` sets and one centre. Joins back are one row a key
or node and may be split.

That D + 1 chunks are not empty is a matter of chance, failing with a probability
below 1e-12 a document of 64 and more shingles; then all its chunks are keys.

Defined results: null texts and texts without words have no shingles and are
alone; equal texts are linked; repeated ids are one document each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, materialised, texts, without_ids
from .components import components
from .shingles import mix, shingle_sets

BITS = 1024
LONGS = BITS // 64
#: Rows of keys a task combines at a time.
COMBINED = 1 << 19
#: Most sets compared with a centre in one group.
MEMBERS = 64
#: Most rows of a table counted to be small that are broadcast.
BROADCAST_ROWS = 500_000
SIGNATURE = (
    "doc_id long, n_shingles long, node long, keys array<long>, "
    + ", ".join(f"s{k} long" for k in range(LONGS))
)


def chunks_of_level(level: np.ndarray) -> np.ndarray:
    """Number of chunks of the band of sizes from 2 ** level on."""
    per = np.where(level < 6, 2.0**40, np.where(level < 8, 1.6, 0.8))
    return np.minimum(per * 2.0**level, 2.0**43).astype(np.uint64)


def _keys(
    value: np.ndarray, text: np.ndarray, level: np.ndarray, differing: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the first ``differing + 1`` chunks of each text, and their texts.

    ``value`` and ``text`` are shingles and the texts that hold them; ``level``
    and ``differing`` are per text.
    """
    part = mix(value ^ np.uint64(0x5851F42D4C957F2D)) % chunks_of_level(level)[text]
    slot = (text.astype(np.uint64) << np.uint64(44)) | part
    order = np.argsort(slot)
    slot, value = slot[order], mix(value[order])
    first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, int)
    parity = np.bitwise_xor.reduceat(value, first) if len(first) else value
    held = np.diff(np.append(first, len(slot)))
    owner = (slot[first] >> np.uint64(44)).astype(np.int64)
    where = slot[first] & np.uint64((1 << 44) - 1)
    key = mix(parity ^ mix(where + (level[owner].astype(np.uint64) << np.uint64(48))))
    solid = parity != 0
    key, held, owner = key[solid], held[solid], owner[solid]
    order = np.lexsort((key, -held, owner))
    key, owner = key[order], owner[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left")
    taken = rank <= differing[owner]
    return key[taken], owner[taken]


def _nodes(value: np.ndarray, sizes: np.ndarray) -> list[int | None]:
    """A number for each set, the same for equal sets; none for an empty one."""
    ends = np.cumsum(sizes)
    return [
        xxhash.xxh3_64_intdigest(value[e - n:e].tobytes(), n) - (1 << 63) if n else None
        for e, n in zip(ends.tolist(), sizes.tolist())
    ]


def _signatures(part: pa.RecordBatch) -> pa.RecordBatch:
    value, sizes = shingle_sets(texts(part, "text"))
    rows = len(sizes)
    text = np.repeat(np.arange(rows), sizes)
    level = np.where(sizes > 0, np.floor(np.log2(np.maximum(sizes, 1))), 0).astype(np.int64)
    floor = np.int64(1) << level
    own = _keys(value, text, level, (sizes + sizes * 5 // 4) // 9)
    near = (sizes > 0) & (level > 0) & (sizes * 4 <= 5 * (floor - 1))
    chosen = near[text]
    below = _keys(value[chosen], text[chosen], np.maximum(level - 1, 0), (sizes + floor - 1) // 9)
    key, owner = np.concatenate([own[0], below[0]]), np.concatenate([own[1], below[1]])
    order = np.argsort(owner, kind="stable")
    key, per = key[order], np.bincount(owner, minlength=rows)
    bit = (mix(value ^ np.uint64(0xD1342543DE82EF95)) >> np.uint64(54)).astype(np.int64)
    parity = np.bincount(text * BITS + bit, minlength=rows * BITS) & 1
    sketch = np.packbits(parity.astype(np.uint8)).view(np.int64).reshape(rows, LONGS)
    node = _nodes(value, sizes)
    offsets = np.concatenate([[0], np.cumsum(per)])
    keys = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key.view(np.int64)))
    return pa.RecordBatch.from_arrays(
        [
            part.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()),
            pa.array(node, pa.int64()), keys, *(pa.array(sketch[:, k]) for k in range(LONGS)),
        ],
        ["doc_id", "n_shingles", "node", "keys", *(f"s{k}" for k in range(LONGS))],
    )


def signatures(documents: DataFrame) -> DataFrame:
    """Size, node (hash of the set), keys and narrow sketch of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "text"):
                yield _signatures(part)

    return documents.select("doc_id", "text").mapInArrow(work, SIGNATURE)


def shared_keys(signed: DataFrame) -> DataFrame:
    """(key, node, n) of the keys that more than one node holds."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            key, node, n = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((node, key))
            key, node, n = key[order], node[order], n[order]
            again = np.zeros(len(key), bool)
            again[1:] = (key[1:] == key[:-1]) & (node[1:] == node[:-1])
            key, node, n = key[~again], node[~again], n[~again]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            # the first node of a key meets those of other tasks; if it has
            # company here, it is marked too
            company = np.zeros(len(key), bool)
            company[:-1] = ~first[1:]
            company |= ~first
            salt = np.where(first, np.uint64(0), mix(node.view(np.uint64)) | np.uint64(1)).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(salt), pa.array(node), pa.array(n), pa.array(company)],
                ["key", "salt", "node", "n", "company"],
            )

        size = 0
        for batch in batches:
            lists = batch.column("keys")
            per = np.diff(lists.offsets.to_numpy())
            key = lists.flatten().to_numpy()
            held.append((
                key, np.repeat(batch.column("node").to_numpy(), per),
                np.repeat(batch.column("n_shingles").to_numpy(), per),
            ))
            size += len(key)
            if size >= COMBINED:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    rows = signed.filter("node IS NOT NULL").select("node", "n_shingles", "keys").mapInArrow(
        combine, "key long, salt long, node long, n long, company boolean"
    )
    alike = Window.partitionBy("key", "salt")
    rows = rows.withColumn("low", F.min("node").over(alike)).withColumn("high", F.max("node").over(alike))
    some = F.col("company") | (F.col("low") != F.col("high"))
    return rows.filter(some).select("key", "node", "n")


def _may_link(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= 80 * F.greatest(n, m)


def star_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): of each key, the node with most shared keys and each other one."""
    score = shared.groupBy("node").agg(F.count(F.lit(1)).alias("score"))
    rows = shared.join(score, "node")
    centre = rows.groupBy("key").agg(F.max(F.struct("score", "node", "n")).alias("c"))
    pairs = rows.join(centre, "key").filter(
        (F.col("node") != F.col("c.node")) & _may_link(F.col("n"), F.col("c.n"))
    )
    return pairs.select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct()


def rest_pairs(shared: DataFrame, roots: DataFrame, sketches: DataFrame, done: DataFrame) -> DataFrame:
    """(a, b) of different components that share a key, may link by size, are as
    near as the Hamming bound asks for and have not been compared."""
    rows = shared.join(roots, "node", "left").select(
        "key", "node", "n", F.coalesce("root", "node").alias("root")
    )
    apart = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    rows = rows.join(apart.filter("low <> high").select("key"), "key").distinct()
    rows = rows.join(sketches, "node")
    a = rows.select("key", *[F.col(c).alias(f"a_{c}") for c in rows.columns if c != "key"])
    b = rows.select("key", *[F.col(c).alias(f"b_{c}") for c in rows.columns if c != "key"])
    distance = sum(
        (F.bit_count(F.col(f"a_s{k}").bitwiseXOR(F.col(f"b_s{k}"))) for k in range(LONGS)), F.lit(0)
    )
    near = (
        (F.col("a_node") < F.col("b_node")) & (F.col("a_root") != F.col("b_root"))
        & _may_link(F.col("a_n"), F.col("b_n")) & (9 * distance <= F.col("a_n") + F.col("b_n"))
    )
    pairs = a.join(b, "key").filter(near)
    pairs = pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()
    tested = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.join(tested, ["a", "b"], "left_anti")


def _linked(table: pa.Table) -> pa.Table:
    """Members of one group that link with its centre."""
    centre = np.array(table.column("centre").to_pylist())
    order = np.argsort(~centre, kind="stable")
    sets, sizes = shingle_sets([t or "" for t in table.column("text").take(pa.array(order)).to_pylist()])
    ends = np.cumsum(sizes)
    node = table.column("node").to_numpy()[order]
    # where rows share an id, those with another text are not meant
    meant = [k for k, n in enumerate(_nodes(sets, sizes)) if n == node[k]]
    a, b = [], []
    first = sets[ends[meant[0]] - sizes[meant[0]]:ends[meant[0]]] if meant else sets
    for k in meant[1:]:
        both = len(np.intersect1d(first, sets[ends[k] - sizes[k]:ends[k]], assume_unique=True))
        if 100 * both >= 80 * (len(first) + sizes[k] - both):
            a.append(node[meant[0]])
            b.append(node[k])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def verified(pairs: DataFrame, members: DataFrame, documents: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose texts link. ``members`` is (node, doc_id) with
    one document a node."""
    # only centres of more than one group need be told apart
    degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("degree")).filter(F.col("degree") > MEMBERS)
    hubs = materialised(degree, "hubs")
    few = hubs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    groups = F.coalesce(F.ceil(F.col("degree") / MEMBERS), F.lit(1))
    dealt = pairs.join(F.broadcast(hubs) if few else hubs, "a", "left").withColumn(
        "salt", F.pmod(F.xxhash64("b"), groups)
    )
    wanted = dealt.select("a", "salt", F.col("b").alias("node"), F.lit(False).alias("centre")).unionByName(
        dealt.select("a", "salt", F.col("a").alias("node"), F.lit(True).alias("centre")).distinct()
    )
    wanted = materialised(wanted.join(members, "node"), "compared")
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    text = documents.select("doc_id", "text")
    rows = text.join(F.broadcast(wanted) if small else wanted, "doc_id")
    return rows.select("a", "salt", "node", "centre", "text").groupBy("a", "salt").applyInArrow(
        _linked, "a long, b long"
    )


def link(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``documents(doc_id, text)``.

    A component's id is the least of its rows, null only if all are null.
    """
    signed = materialised(signatures(documents), "signatures")
    shared = materialised(shared_keys(signed), "shared")
    sketches = signed.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(f"s{k}").alias(f"s{k}") for k in range(LONGS)]
    )
    candidates = shared.select("node").distinct()
    nodes = materialised(sketches.join(candidates, "node", "left_semi"), "nodes")
    members = nodes.select("node", "doc_id")
    stars = materialised(star_pairs(shared), "pairs")
    links = materialised(verified(stars, members, documents), "links")
    roots = materialised(components(links), "roots")
    rest = materialised(rest_pairs(shared, roots, nodes.drop("doc_id"), stars), "pairs")
    more = materialised(verified(rest, members, documents), "links")
    if not more.isEmpty():
        roots = materialised(components(links.unionByName(more)), "roots")
    rows = signed.select("doc_id", "n_shingles", "node").join(roots, "node", "left")
    # a document without shingles is a component of its own
    rows = rows.select("doc_id", "n_shingles", F.coalesce("root", "node").alias("root"))
    first = rows.filter("root IS NOT NULL").groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("size")
    )
    first = materialised(first.filter("size > 1").drop("size"), "components")
    small = first.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(first) if small else first, "root", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def representatives(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each component, one of the least id.

    Of repeated ids only one row stays where their texts are equal.
    """
    linked = link(documents)
    ids = documents.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = materialised(ids.select("doc_id"), "ids")
    kept = without_ids(documents, linked.filter("doc_id <> component_id"))
    if again.isEmpty():
        return kept
    single = without_ids(kept, again)
    same = kept["doc_id"].eqNullSafe(again["doc_id"])
    return single.unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
