"""SentencePiece: ids equal the library's, streaming equals whole search, round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
OWN, LIBRARY = pieces.Model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_documents_as_the_library(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for text, want in zip(texts, LIBRARY.encode(texts, num_threads=1), strict=True):
        got = OWN.encode(text).tolist()
        assert got == want and OWN.decode(got) == text


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tabeinrst'é▁😀<0x"), st.characters(exclude_categories=["Cs"], exclude_characters="\0")), max_size=60))
def test_any_text_as_the_library(text):
    got = OWN.encode(text).tolist()
    assert got == LIBRARY.encode(text)
    assert OWN.decode(got) == text.replace("▁", " ")


@pytest.mark.parametrize("text", ["", " ", "   ", "a" * 3000, "ab" * 2000, " " * 500 + "x", "thethethe" * 300, "é" * 100 + "漢字" * 50])
def test_streams_without_words(text):
    normal = OWN.normal(text)
    runs = list(OWN.stream(normal))
    assert [i for r in runs for i in r] == LIBRARY.encode(text)
    if len(text) > 2000:
        assert len(runs) > 2  # ids leave while the text is still coming


def whole_search(model, normal):
    """Unigram: the best path through the whole text."""
    best = [(0.0, None, ())] + [(float("-inf"), None, ())] * len(normal)
    for i in range(len(normal)):
        for j in range(i + 1, min(len(normal), i + model.longest) + 1):
            found = model.ids.get(normal[i:j])
            if found is not None and best[i][0] + model.scores[found] > best[j][0]:
                best[j] = (best[i][0] + model.scores[found], i, (found,))
        if normal[i] not in model.ids and best[i][0] + model.unknown_score > best[i + 1][0]:
            best[i + 1] = (best[i][0] + model.unknown_score, i, model._fallback(normal[i]))
    out, at = [], len(normal)
    while at:
        out.append(best[at][2])
        at = best[at][1]
    return best[-1][0], [i for p in reversed(out) for i in p]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abeinrst \né😀", max_size=400))
def test_unigram_search_equals_the_whole_one(text):
    own = pieces.Model(PATH)
    own.merges = False
    own.scores = {i: -1.0 - (i * 7919 % 1000) / 300 for i in own.scores}
    own.unknown_score = -20.0
    normal = own.normal(text)
    score, _ = whole_search(own, normal)
    got = [i for r in own.stream(normal) for i in r]
    bytes_ = [i for i in got if i in own.byte_of]
    unknown = sum(c not in own.ids for c in normal)
    assert sum(own.scores[i] for i in got if i not in own.byte_of) - 20.0 * unknown == pytest.approx(score)
    assert bool(bytes_) == bool(unknown) and own.decode(got) == text


def test_queries_and_edges(spark):
    rows = [(1, None), (2, ""), (None, "héllo\nwörld  x"), (3, "a"), (3, "a"), (4, "word " * 60000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2))
    got = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert [r.decoded for r in got] == [t or "" for _, t in rows]
    assert [len(bytes(r.ids)) // 4 for r in got] == [len(LIBRARY.encode(t or "")) for _, t in rows]
    assert pieces.encode(docs.limit(0), PATH).count() == 0
    none = pieces.decode(docs.select(F.lit(None).cast("binary").alias("ids")), PATH)
    assert none.where("decoded is null").count() == len(rows)


def test_new_words_share_the_boundaries_of_their_beginnings(monkeypatch):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abeinrst'é😀<漢") for _ in range(rng.randint(1, 12))) for _ in range(40)]
    words = [rng.choice(stems) + rng.choice(stems)[: rng.randint(0, 9)] for _ in range(2000)] + ["x" * 64, "x" * 65, "ab" * 400, "abc"]
    texts = [" ".join(rng.sample(words, rng.randint(1, 60))) for _ in range(200)]
    texts += ["", " ", "  two  blanks ", "a▁b", "▁", " x", "x ", *words[-4:]]
    want = LIBRARY.encode(texts)
    plain = [" ".join(w) for w in zip(words[::2], words[1::2], strict=True)]
    for remembered, together in ((1_000_000, 4_000_000), (50, 300)):  # also where little is remembered
        monkeypatch.setattr(pieces, "REMEMBERED", remembered)
        monkeypatch.setattr(pieces, "TOGETHER", together)
        own = pieces.Model(PATH)
        assert [np.frombuffer(i, "<u4").tolist() for i in own.encode_all(texts)] == want
        assert [np.frombuffer(i, "<u4").tolist() for i in own.encode_all(plain)] == LIBRARY.encode(plain)
        assert len(own.memory) <= remembered and own.encode_all([]) == []


def test_shared_boundaries_are_computed_once():
    own, known = pieces.Model(PATH), [0]
    grown = own._grow
    own._grow = lambda *a: (known.__setitem__(0, known[0] + 1), grown(*a))[1]
    words = [pieces.BLANK + "question" + c * n for c in "abc" for n in range(20)]
    found = own.search(words)
    assert all(np.frombuffer(found[w], "<u4").tolist() == [i for r in own.stream(w) for i in r] for w in words)
    assert known[0] <= len("question") + 1 + 3 * 19


def test_unigram_words_are_streamed():
    own = pieces.Model(PATH)
    own.merges = False
    own.scores = {i: -1.0 - (i * 7919 % 1000) / 300 for i in own.scores}
    text = "the best path of the words"
    assert own.encode(text).tolist() == [i for w in pieces._words(own.normal(text)) for r in own.stream(w) for i in r]
