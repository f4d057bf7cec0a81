"""SimHash near-duplicates: byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most ``d`` bits differ in at most ``d``
of their eight bytes, so they share at least ``8 - d`` positional bytes. The index
is keyed by the positions and values of ``8 - d`` bytes: a pair that meets under a
key has reached that count, every pair that can qualify meets under one, and a
posting list cannot grow beyond the ``256 ** d`` values of the open bytes however
hot its documents are (65,536 for two bits). Inside a list the distances are
verified, and only a spanning forest of the links leaves the task.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._graph import connected_components
from panelspark.llm._shared import checkpointed, drop_kept


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the shingles of a text; 0 for a text without words."""
    words = (text or b"").lower().split()  # of bytes: A-Z, and the six blanks of ASCII
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(shingle)), strict=False)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = np.array(hashes[at : at + (1 << 14)], dtype="<u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches, shingle, seed):
    drop_kept()
    for batch in batches:
        prints = np.fromiter((fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, print)`` per row of ``docs``; the print as a signed long."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle, seed=seed), "doc_id long, print long")


def _roots(values: np.ndarray, bits: int) -> np.ndarray:
    """Per distinct value, the index of the least value it reaches by links of at most ``bits`` bits."""
    n = len(values)
    root = np.arange(n)
    if n <= 256:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= bits
        while True:
            new = np.where(near, root[None, :], n).min(axis=1)
            if (new == root).all():
                return root
            root = new
    order = np.argsort(values)
    ranked = values[order]
    used = [b for b in range(64) if int(np.bitwise_or.reduce(values ^ values[0])) >> b & 1]
    flips = [sum(1 << b for b in c) for k in range(1, bits + 1) for c in combinations(used, k)]
    neighbours = []
    for flip in flips:
        want = values ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(ranked, want), n - 1)
        found = ranked[at] == want
        neighbours.append((np.flatnonzero(found), order[at[found]]))
    while True:
        new = root.copy()
        for i, j in neighbours:
            new[i] = np.minimum(new[i], new[j])
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _links(batches, bits):
    """Pairs of prints under each key; rows come sorted by key, groups may cross batches."""

    def closed(keys, prints):
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(prints)])
        two = starts[sizes == 2]
        a, b = prints[two], prints[two + 1]
        near = np.bitwise_count(a ^ b) <= bits
        left, right = [a[near]], [b[near]]
        for s, m in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            values = prints[s : s + m]
            root = _roots(values, bits)
            linked = root != np.arange(m)
            left.append(values[linked])
            right.append(values[root[linked]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["a", "b"])

    held_keys, held = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        k, key, value = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        keys = np.concatenate([held_keys, np.stack([k.astype(np.int64), key], axis=1)])
        prints = np.concatenate([held, value.view(np.uint64)])
        cut = len(prints) - int((keys[::-1] == keys[-1]).all(axis=1).argmin()) if (keys != keys[-1]).any() else 0
        if cut:
            yield closed(keys[:cut], prints[:cut])
        held_keys, held = keys[cut:], prints[cut:]
    if len(held):
        yield closed(held_keys, held)


def links(prints: DataFrame, bits: int = 2) -> DataFrame:
    """Pairs ``(a, b)`` of distinct prints within ``bits`` differing bits that
    connect all that such pairs connect (a spanning forest per index key).

    ``prints`` has one column ``print`` of distinct values.
    """
    masks = [sum(255 << 8 * p for p in shared) for shared in combinations(range(8), 8 - bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    index = F.array(*[F.struct(F.lit(i).alias("k"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    postings = prints.select("print", F.inline(index)).select("k", "key", "print")
    postings = postings.repartition("k", "key").sortWithinPartitions("k", "key")
    return postings.mapInArrow(partial(_links, bits=bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, seed: int = 42, bits: int = 2) -> DataFrame:
    """``(doc_id, print, component_id)`` per row of ``docs``.

    Rows whose prints differ in at most ``bits`` bits are linked; ``component_id``
    is the least key that links reach. Equal prints are one node, so copies cost
    one row in the index. A null or empty text, or one of blanks, has print 0 and
    is linked like any other. A row with a null key takes part; its component's id
    is the least key that is not null, null if there is none. Repeated rows come
    back as often as they are there. No rows: no rows. Other columns of ``docs``
    are not read.
    """
    if not 1 <= bits <= 3:
        raise ValueError("bits must be 1, 2 or 3: a posting list holds up to 256 ** bits prints")
    rows = checkpointed(fingerprints(docs, text, key, shingle, seed))
    nodes = checkpointed(rows.groupBy("print").agg(F.min("doc_id").alias("least")))
    component = connected_components(links(nodes.select("print"), bits)).withColumnRenamed("node", "print")
    merged = nodes.join(component, "print")
    least = merged.groupBy("component").agg(F.min("least").alias("linked"))
    linked = merged.join(least, "component").select("print", "linked")
    nodes = nodes.join(linked, "print", "left").select("print", F.coalesce("linked", "least").alias("component_id"))
    return rows.join(nodes, "print").select("doc_id", "print", "component_id")


def keep_one(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` names as the least of their group.

    Of rows that repeat such a key one is kept. Rows without a key are kept.
    """
    kept = found.where("doc_id = component_id").groupBy("doc_id").count()
    once = docs.join(kept.where("count = 1").select(F.col("doc_id").alias(key)), key, "left_semi")
    again = docs.join(kept.where("count > 1").select(F.col("doc_id").alias(key)), key, "left_semi").dropDuplicates([key])
    return once.unionAll(again).unionAll(docs.where(F.col(key).isNull())).select(docs.columns)
