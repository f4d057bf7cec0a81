"""Token ids in files of bit-plane shuffled blocks.

A file holds the documents of one range of keys. Ids are cut into blocks of a fixed
number; a block of 32-bit ids is transposed into its four byte planes or thirty-two
bit planes, and each plane is compressed with zstandard. Behind the blocks stand a
chunk index (per plane its place and size, per block its number of ids), the
documents' keys and lengths, and a fixed-size end.

Layout, little-endian: ``magic, plane bytes ..., index, keys, lengths, end``, where
``index`` is rows of ``(place u64, size u32)`` block by block and plane by plane,
``keys`` are i64 with a byte each for null, ``lengths`` u32, the three compressed,
and ``end`` is ``END``.

Tasks write through the file system that the folder's address names, under a name
of their own attempt, and rename at the end: a repeated or speculative task cannot
leave half a file under a final name, and only files that the manifest lists are read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelspark.llm._shared import new_folder, written
from panelspark.llm._tokens import batches_of, encoder

MAGIC = b"PLANES01"
# ids, ids to a block, planes, documents, place and three sizes of the index, magic
END = "<QIIQQIII8s"
BLOCK = 1 << 16


def planes_of(ids: np.ndarray, planes: int) -> list[bytes]:
    """The planes of a block of ids: bytes of equal weight, or bits of equal weight, together."""
    bytes_ = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [np.ascontiguousarray(bytes_[:, i]).tobytes() for i in range(4)]
    bits = np.unpackbits(bytes_, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def ids_of(parts: list[bytes], n: int) -> np.ndarray:
    """The block of ``n`` ids that ``planes_of`` took apart."""
    if len(parts) == 4:
        return np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1).reshape(-1).view("<u4")
    bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in parts], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    """Documents in, blocks out; holds one block, the index and the documents' lengths."""

    def __init__(self, out, block: int = BLOCK, planes: int = 4, level: int = 3):
        if planes not in (4, 32):
            raise ValueError("planes is 4 (bytes) or 32 (bits)")
        self.out, self.block, self.planes = out, block, planes
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.held, self.waiting, self.total, self.at = [], 0, 0, 0
        self.index, self.keys, self.lengths = [], [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self.held.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= self.block:
            whole = np.frombuffer(b"".join(self.held), "<u4")
            cut = len(whole) - len(whole) % self.block
            for at in range(0, cut, self.block):
                self._block(whole[at : at + self.block])
            self.held, self.waiting = [whole[cut:].tobytes()], len(whole) - cut

    def _block(self, ids: np.ndarray) -> None:
        for plane in planes_of(ids, self.planes):
            data = self.compress(plane)
            self.index.append((self.at, len(data)))
            self._put(data)
        self.total += len(ids)

    def close(self) -> None:
        if self.waiting:
            self._block(np.frombuffer(b"".join(self.held), "<u4"))
        index = self.compress(np.array(self.index, dtype=[("place", "<u8"), ("size", "<u4")]).tobytes())
        null = np.array([k is None for k in self.keys], np.uint8)
        keys = self.compress(np.array([k or 0 for k in self.keys], "<i8").tobytes() + null.tobytes())
        lengths = self.compress(np.array(self.lengths, "<u4").tobytes())
        place = self.at
        for part in (index, keys, lengths):
            self._put(part)
        self._put(struct.pack(END, self.total, self.block, self.planes, len(self.keys), place, len(index), len(keys), len(lengths), MAGIC))


class Reader:
    """Blocks or documents of one file; holds the index and one block at a time."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - struct.calcsize(END))
        self.total, self.block, self.planes, self.documents, place, *sizes, magic = struct.unpack(END, source.read(struct.calcsize(END)))
        if magic != MAGIC:
            raise ValueError("not a file of planes")
        self.expand = zstandard.ZstdDecompressor().decompress
        source.seek(place)
        index, keys, lengths = (self.expand(source.read(n)) for n in sizes)
        self.index = np.frombuffer(index, dtype=[("place", "<u8"), ("size", "<u4")])
        self.lengths = np.frombuffer(lengths, "<u4")
        values, null = np.frombuffer(keys, "<i8", self.documents), np.frombuffer(keys, np.uint8, self.documents, 8 * self.documents)
        self.keys = [None if n else v for v, n in zip(values.tolist(), null.tolist(), strict=True)]

    def read_block(self, number: int) -> np.ndarray:
        """Block ``number``, found through the chunk index."""
        rows = self.index[number * self.planes : (number + 1) * self.planes]
        parts = []
        for place, size in rows.tolist():
            self.source.seek(place)
            parts.append(self.expand(self.source.read(size)))
        return ids_of(parts, min(self.block, self.total - number * self.block))

    def rows(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(key, start in the file, ids)`` of every document in order."""
        left, number, start = np.empty(0, "<u4"), 0, 0
        for key, length in zip(self.keys, self.lengths.tolist(), strict=True):
            parts, have = [left], len(left)
            while have < length:
                parts.append(self.read_block(number))
                number, have = number + 1, have + len(parts[-1])
            ids = np.concatenate(parts) if len(parts) > 1 else left
            yield key, start, ids[:length]
            left, start = ids[length:], start + length


def _write(batches, folder, path, end, block, planes):
    """One file for the rows of a task, which come in order; a row for the manifest."""
    files, base = fs.FileSystem.from_uri(folder)
    own = uuid.uuid4().hex
    name = f"{base}/{own}"
    code, last = encoder(path), end.to_bytes(4, "little")
    out = writer = None
    for batch in batches:
        for rows in batches_of(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))):
            if writer is None:
                out = files.open_output_stream(f"{name}.part")
                writer = Writer(out, block, planes)
            for (key, _), ids in zip(rows, code.encode([t for _, t in rows]), strict=True):
                writer.add(key, ids + last)
    if writer is None:
        return
    writer.close()
    out.close()
    files.move(f"{name}.part", f"{name}.planes")
    first = next((k for k in writer.keys if k is not None), None)
    yield pa.RecordBatch.from_pydict(
        {"file": [f"{folder}/{own}.planes"], "first": pa.array([first], pa.int64()), "documents": pa.array([len(writer.keys)], pa.int64()), "ids": pa.array([writer.total], pa.int64())}
    )


def write_tokens(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None, text: str = "text", key: str = "doc_id", block: int = BLOCK, planes: int = 4) -> DataFrame:
    """Write the ids of all documents, in ascending order of ``key`` over all files.

    Returns the manifest, itself a table in the shared folder: ``file, first,
    documents, ids, start``, with the ids of all files before it in ``start``. Each
    file is one range of keys (null keys come first) and is written by one task in
    bounded memory. Null and empty texts are the one id ``end``; repeated rows are
    written as often as they are there, rows of one key in the order of their texts.
    ``folder`` is the address of an empty folder that all executors can write to;
    one in the shared folder if it is left out. No rows: no files.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    task = partial(_write, folder=folder, path=tokenizer, end=end, block=block, planes=planes)
    files = written(dealt.mapInArrow(task, "file string, first long, documents long, ids long"), "manifest")
    before = Window.orderBy(F.col("first").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each file
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("long")))


def _read(batches):
    for batch in batches:
        for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            files, path = fs.FileSystem.from_uri(name)
            with files.open_input_file(path) as source:
                keys, starts, ids, held = [], [], [], 0
                for key, at, found in Reader(source).rows():
                    keys.append(key)
                    starts.append(start + at)
                    ids.append(found.tobytes())
                    held += len(found)
                    if held >= 1 << 20:
                        yield _arrow(keys, starts, ids)
                        keys, starts, ids, held = [], [], [], 0
                if keys:
                    yield _arrow(keys, starts, ids)


def _arrow(keys, starts, ids):
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(keys, pa.int64()), "start": pa.array(starts, pa.int64()), "ids": pa.array(ids, pa.binary())})


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in the files of a manifest; ``ids``
    are little-endian unsigned 32-bit integers, ``start`` counts those before it."""
    tasks = max(1, manifest.count())
    return manifest.select("file", "start").repartition(tasks, "file").mapInArrow(_read, "doc_id long, start long, ids binary")
