"""Files of planes: round trips, order, edge rows."""

import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelspark.llm import tokenfile

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=50), max_size=12), st.integers(1, 40), st.sampled_from([4, 32]))
def test_round_trip(documents, block, planes):
    sink = io.BytesIO()
    writer = tokenfile.Writer(sink, block, planes)
    for i, ids in enumerate(documents):
        writer.add(None if i == 1 else i - 3, np.array(ids, "<u4").tobytes())
    writer.close()
    reader = tokenfile.Reader(pa.BufferReader(sink.getvalue()))
    start = 0
    for i, ((key, at, ids), want) in enumerate(zip(reader.rows(), documents, strict=True)):
        assert key == (None if i == 1 else i - 3) and at == start and ids.tolist() == want
        start += len(want)
    assert reader.total == start
    whole = [x for d in documents for x in d]
    for number in range(-(-start // block)):
        assert reader.read_block(number).tolist() == whole[number * block : (number + 1) * block]


def test_not_a_file_of_planes():
    with pytest.raises(ValueError):
        tokenfile.Reader(pa.BufferReader(b"x" * 100))


@pytest.mark.parametrize("planes", [4, 32])
def test_documents(spark, planes):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(5)
    manifest = tokenfile.write_tokens(docs, BYTE, 2, planes=planes, block=5000)
    got = sorted((r.doc_id, r.start, bytes(r.ids)) for r in tokenfile.read_tokens(manifest).collect())
    library = Tokenizer.from_file(BYTE)
    start = 0
    for row, (key, at, ids) in zip(sorted(docs.collect(), key=lambda r: r.doc_id), got, strict=True):
        want = np.array([*library.encode(row.text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert (key, at) == (row.doc_id, start) and ids == want and zlib.crc32(ids) == zlib.crc32(want)
        start += len(want) // 4
    assert manifest.agg({"ids": "sum"}).first()[0] == start


def test_edges(spark):
    rows = [(5, None), (None, "b"), (3, ""), (3, "x y"), (3, "x y"), (-1, "word " * 90000), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text as ids", "doc_id as start")
    got = sorted(tokenfile.read_tokens(tokenfile.write_tokens(docs, BYTE, 2)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, -1, 3, 3, 3, 5]
    assert [len(bytes(r.ids)) // 4 for r in got] == [1, 2, 90002, 1, 3, 3, 1]
    assert [r.start for r in got] == [0, 1, 3, 90005, 90006, 90009, 90012]
    assert tokenfile.read_tokens(tokenfile.write_tokens(docs.limit(0), BYTE, 2)).count() == 0
