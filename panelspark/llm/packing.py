"""Vector best-fit packing of token sequences.

Every piece of a document demands tokens, one document place and attention cost
(the square of its length). A task packs its own pieces, largest first, block by
block: of the open bins that hold the piece under every capacity, the one with the
least weighted residual norm takes it (or the greatest weighted dot product of
demand and residual). Bins that are nearly full leave; the others stay open for the
next block, and what a task has not filled in the end is packed again with the rest
of the other tasks. No token is shuffled but those of these last bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._shared import written
from panelspark.llm._tokens import batches_of, encoder


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most, and the weights of the three in a choice."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def __post_init__(self):
        if self.rule not in ("norm", "dot"):
            raise ValueError("rule is norm or dot")
        if min(self.tokens, self.documents, self.attention) < 1:
            raise ValueError("a sequence must hold something")

    @property
    def longest(self) -> int:
        """The longest piece that fits an empty sequence."""
        return min(self.tokens, int(np.sqrt(self.attention)))


class Bins:
    """Open bins with their residual capacities as shares of the whole."""

    def __init__(self, capacity: Capacity):
        self.capacity = capacity
        self.whole = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=np.int64)
        self.scale = np.array(capacity.weights) / self.whole
        self.left = np.empty((3, 64), dtype=np.int64)
        self.numbers = np.empty(64, dtype=np.int64)
        self.open = 0
        self.made = 0

    def put(self, length: int) -> int:
        """The number of the bin that takes a piece of this length."""
        need = np.array([length, 1, length * length])[:, None]
        left = self.left[:, : self.open]
        fits = np.flatnonzero((left >= need).all(axis=0))
        if len(fits):
            room = left[:, fits]
            if self.capacity.rule == "norm":
                at = fits[(((room - need) * self.scale[:, None]) ** 2).sum(axis=0).argmin()]
            else:
                at = fits[(room * need * (self.scale / self.whole)[:, None]).sum(axis=0).argmax()]
        else:
            if self.open == self.left.shape[1]:
                self.left = np.concatenate([self.left, np.empty_like(self.left)], axis=1)
                self.numbers = np.concatenate([self.numbers, np.empty_like(self.numbers)])
            at, self.open = self.open, self.open + 1
            self.left[:, at] = self.whole
            self.numbers[at] = self.made
            self.made += 1
        self.left[:, at] -= need[:, 0]
        return int(self.numbers[at])

    def close(self, room: int) -> set[int]:
        """Drop the bins in which no piece of more than ``room`` tokens fits; their numbers."""
        left = self.left[:, : self.open]
        full = (left[0] <= room) | (left[1] < 1) | (left[2] <= room * room)
        gone = set(self.numbers[: self.open][full].tolist())
        keep = np.flatnonzero(~full)
        self.left[:, : len(keep)] = left[:, keep]
        self.numbers[: len(keep)] = self.numbers[keep]
        self.open = len(keep)
        return gone


def pack(pieces: Iterator[tuple], capacity: Capacity, room: int, block: int = 4 << 20) -> Iterator[tuple[int, bool, list[tuple]]]:
    """Bins of ``(…, length)`` tuples as ``(number, full, members)``.

    Pieces come in blocks of about ``block`` tokens; a block and the open bins are
    all that is held. Bins with at most ``room`` tokens left are given out as they
    fill (``full``), the open ones at the end.
    """
    bins, held, full_ones = Bins(capacity), {}, 0

    def place(part):
        for n, piece in enumerate(sorted(part, key=lambda p: -p[-1])):
            held.setdefault(bins.put(piece[-1]), []).append(piece)
            if n % 256 == 255:
                for number in bins.close(room):
                    yield number, True, held.pop(number)
        for number in bins.close(room):
            yield number, True, held.pop(number)

    part, tokens = [], 0
    for piece in pieces:
        if piece[-1] >= capacity.tokens - room:
            full_ones -= 1
            yield full_ones, True, [piece]
            continue
        part.append(piece)
        tokens += piece[-1]
        if tokens >= block:
            yield from place(part)
            part, tokens = [], 0
    yield from place(part)
    for number, members in held.items():
        yield number, False, members


_PIECES = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)


def _rows(bins, base: int, tails: bool):
    """Arrow batches of packed pieces; bins that are not full have no sequence yet if ``tails``."""
    out, held = [], 0
    for number, full, members in bins:
        offset = 0
        for key, piece, start, ids, length in members:
            settled = full or not tails
            out.append((key, piece, start, length, ids, base + (number & 0xFFFFFFFF) if settled else None, offset if settled else None))
            offset += length
            held += length
        if held >= 2 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _base(stage: int) -> int:
    return (stage << 60) + (TaskContext.get().partitionId() << 32)


def _tokenise_and_pack(batches, path, end, capacity, room):
    code, size = encoder(path), capacity.longest
    last = end.to_bytes(4, "little")

    def pieces():
        for batch in batches:
            for rows in batches_of(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))):
                for (key, _), ids in zip(rows, code.encode([t for _, t in rows]), strict=True):
                    ids += last
                    for n, at in enumerate(range(0, len(ids), 4 * size)):
                        part = ids[at : at + 4 * size]
                        yield key, n, n * size, part, len(part) // 4

    yield from _rows(pack(pieces(), capacity, room), _base(0), True)


def _pack_rest(batches, capacity):
    pieces = (
        (key, piece, start, ids, length)
        for batch in batches
        for key, piece, start, length, ids in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)
    )
    yield from _rows(pack(pieces, capacity, 0), _base(1), False)


def pack_documents(
    docs: DataFrame, tokenizer: str, end: int, text: str = "text", key: str = "doc_id", capacity: Capacity | None = None, room: int = 8, rest: int = 20_000
) -> DataFrame:
    """Pieces of all documents with their ids and their place in a sequence.

    Columns ``doc_id, piece, start, length, ids, sequence_id, offset``; ``ids`` are
    little-endian unsigned 32-bit integers. A document is its ids and then ``end``;
    one longer than the longest piece that ``capacity`` allows is cut into such
    pieces. A bin with at most ``room`` free tokens is full. ``rest`` is the number
    of pieces of unfinished bins that one task packs in the second pass.

    Null and empty texts are one token, ``end``. Null keys and repeated rows are
    packed like others. Other columns of ``docs`` are not read. No rows: no rows.
    """
    capacity = capacity or Capacity()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    first = written(rows.mapInArrow(partial(_tokenise_and_pack, path=tokenizer, end=end, capacity=capacity, room=room), _PIECES), "pieces")
    left = first.where("sequence_id is null")
    tasks = -(-left.count() // rest)
    if not tasks:
        return first
    left = left.repartition(tasks, "doc_id", "piece").mapInArrow(partial(_pack_rest, capacity=capacity), _PIECES)
    return first.where("sequence_id is not null").unionAll(left)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, doc_ids, lengths)``: the training rows, one per sequence."""
    members = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    grouped = packed.groupBy("sequence_id").agg(members.alias("m"))
    ids = F.aggregate("m", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return grouped.select("sequence_id", ids.alias("ids"), F.col("m.doc_id").alias("doc_ids"), F.col("m.length").alias("lengths"))
