"""Packing: ids equal the library's, capacities hold, few sequences."""

import weakref
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelspark.llm import _tokens, packing, passages, simhash, toxicity

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def library(path):
    found = Tokenizer.from_file(path)
    return lambda t: np.array(found.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()


WHOLE = {p: library(p) for p in (WORD, BYTE)}
OWN = {p: _tokens.Encoder(p) for p in (WORD, BYTE)}


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_on_documents(spark, path):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    assert OWN[path].encode(texts) == [WHOLE[path](t) for t in texts]


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("'sIİΣßÉé́A0.|<>end"), st.characters(exclude_categories=["Cs"])), max_size=12), max_size=30))
def test_words_learned_together(path, words):
    """Words that meet in one call of the library have the ids that they have alone."""
    own = _tokens.Encoder(path)
    assert own.encode([" ".join(words), " ".join(words[::-1])]) == [WHOLE[path](" ".join(w)) for w in (words, words[::-1])]
    assert own.encode(words) == [WHOLE[path](w) for w in words]


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=600, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x1c\x85\xa0 'sİΣßÉé́A0.|<>endoftext"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_encoder_on_any_text(path, text):
    assert OWN[path].encode([text]) == [WHOLE[path](text)]


def test_encoder_special_and_long():
    for path in (WORD, BYTE):
        for text in ("<|endoftext|> a <|startoftext|>", "hello <|endoftext|> there", "a<|EndOfText|>b  c", "<|endoftext|>\u0338 x", "x" * 5000 + " b", "", "a  b   c", " a ", "one\ntwo \n three"):
            assert OWN[path].encode([text, text]) == [WHOLE[path](text)] * 2


def check_packing(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(members) <= capacity.documents
        assert sum(n * n for _, n in members) <= capacity.attention
    return len(bins)


def test_documents_are_packed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7)
    rows = packing.pack_documents(docs, WORD, 1).collect()
    made = check_packing(rows, packing.Capacity())
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = WHOLE[WORD](d.text) + b"\x01\0\0\0"
        parts = sorted(by[d.doc_id], key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in parts) == ids
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start for r in parts] == [4096 * i for i in range(len(parts))]
        assert all(r.length == 4096 for r in parts[:-1])
    total = sum(r.length for r in rows)
    assert made <= -(-total // 4096) * 1.01 + 1


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "hello there", "c"), (3, "x", "d"), (3, "x", "d"), (4, "word " * 9000, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = packing.pack_documents(docs, WORD, 1).collect()
    assert [(r.doc_id, r.length, bytes(r.ids)) for r in got if r.doc_id in (1, 2)] == [(i, 1, b"\x01\0\0\0") for i in sorted({1, 2}, key=[r.doc_id for r in got].index)]
    assert sum(r.doc_id == 3 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1
    assert sorted(r.length for r in got if r.doc_id == 4) == [809, 4096, 4096]
    assert check_packing(got, packing.Capacity()) == 3
    assert packing.pack_documents(docs.limit(0), WORD, 1).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_all_three_capacities(spark, rule):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    capacity = packing.Capacity(2048, 3, 1500 * 1500, (1.0, 1.0, 1.0), rule)
    rows = packing.pack_documents(docs, WORD, 1, capacity=capacity, rest=50).collect()
    check_packing(rows, capacity)
    assert max(r.length for r in rows) <= 1500
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)


@given(st.lists(st.integers(1, 100), max_size=80), st.sampled_from(["norm", "dot"]))
@settings(deadline=None, max_examples=50)
def test_close_to_the_least_number(lengths, rule):
    bins = list(packing.pack(((i, n) for i, n in enumerate(lengths)), packing.Capacity(100, 1000, 10**9, (1, 0, 0), rule), 0, 10**9))
    assert sorted(p for _, _, m in bins for p in m) == sorted(enumerate(lengths))
    assert all(sum(n for _, n in m) <= 100 for _, _, m in bins)
    if rule == "norm":
        assert len(bins) <= 11 / 9 * -(-sum(lengths) // 100) * 1.25 + 1


def test_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    packed = packing.pack_documents(docs, WORD, 1)
    rows = {(r.doc_id, r.piece): bytes(r.ids) for r in packed.collect()}
    made = packing.sequences(packed).collect()
    assert sum(len(bytes(r.ids)) for r in made) == sum(map(len, rows.values()))
    assert all(len(bytes(r.ids)) == 4 * sum(r.lengths) <= 4 * 4096 for r in made)
    assert zlib.crc32(b"")  == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_document_and_attention_limits_bind(rule):
    made = lambda lengths, *most: sorted(len(m) for _, _, m in packing.pack(enumerate(lengths), packing.Capacity(*most, rule=rule), 0, 10**9))
    assert made([10] * 9, 100, 100, 10**9) == [9]
    assert made([10] * 9, 100, 3, 10**9) == [3, 3, 3]
    assert made([50] * 4, 100, 100, 10**9) == [2, 2]
    assert made([50] * 4, 100, 100, 4000) == [1, 1, 1, 1]


@pytest.mark.parametrize(
    "task",
    [
        lambda rows: list(simhash._fingerprints(rows.to_batches(), 3, 42)),
        lambda rows: list(passages._block_windows(rows.to_batches(), passages.Rule(), 1 << 20)),
        lambda rows: list(toxicity._count([pa.RecordBatch.from_pydict({"text": ["a b"], "toxic": [1]})], None)),
        lambda rows: toxicity.scorer(toxicity.Lexicon()).func(pd.Series(["a b"])),
    ],
)
def test_a_task_of_another_operator_drops_the_words(spark, task):
    code = _tokens.encoder(WORD)
    code.encode(["some words to remember"])
    assert _tokens.encoder(WORD) is code
    words = weakref.ref(code.plain)
    del code
    task(pa.table({"doc": [1], "text": [b"a b"]}))
    assert not _tokens.encoder.cache_info().currsize and words() is None
    assert _tokens.encoder(WORD).encode(["some words"]) == [WHOLE[WORD]("some words")]
