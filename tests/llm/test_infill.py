"""Fill-in-middle against plain Python, round trips, edge rows."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.llm import infill

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain(key, text, percent=50, spm=80, seed=42, marks=infill.MARKS):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in marks) or h[2] % 100 >= percent:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"{marks[1]}{s}{marks[0]}{p}{marks[2]}{m}"
    return len(units), "psm", len(p), len(m), f"{marks[0]}{p}{marks[1]}{s}{marks[2]}{m}"


def numbers(count, seed=42):
    digests = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i in range(count)]
    return [np.array([int(d[8 * j : 8 * j + 8], 16) for d in digests], np.int64) for j in range(4)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "bc", " ", "\n", "\t ", "é", "😀", "<", "P>", "S>", "<P", "M", " ", "\x85"]), max_size=20).map("".join), max_size=12), st.sampled_from([3, 16, 1 << 20]))
def test_block(texts, window):
    infill.WINDOW, kept = window, infill.WINDOW
    try:
        marks = infill._check_marks(infill.MARKS)
        data, bounds = infill._bytes_of(pa.array(texts, pa.string()))
        out, ends, n, form, before, within = infill.cut_block(data, bounds, numbers(len(texts)), marks, 50, 80)
        outputs = infill._texts_of(out, ends).to_pylist()
        for i, text in enumerate(texts):
            moved = form[i] != 0
            assert plain(i, text) == (n[i], infill.FORMS[form[i]], before[i] if moved else None, within[i] if moved else None, outputs[i])
        assert infill._texts_of(*infill.restore_block(out, ends, form, marks)).to_pylist() == texts
    finally:
        infill.WINDOW = kept


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = infill.restore(infill.transform(docs)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r.infill) == plain(r.doc_id, texts[r.doc_id]) and r.restored == (texts[r.doc_id] or "")
    assert {r.infill.form for r in got} == set(infill.FORMS)


def test_edges(spark):
    long = "é w" * 1_000_000 + " "
    rows = [(1, None), (2, ""), (None, "no key but five units "), (3, "a <M> b"), (4, " \n "), (5, "one"), (5, "one"), (6, long), (7, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("infill", F.lit(0)).withColumn("n", F.lit("x")).repartition(3)
    for percent, spm in ((50, 80), (100, 0), (100, 100), (0, 0)):
        got = infill.restore(infill.transform(docs, percent=percent, spm_percent=spm)).collect()
        assert sorted(map(str, [(r.doc_id, r.text, r.n) for r in got])) == sorted(map(str, [(*r, "x") for r in rows]))
        for r in got:
            assert tuple(r.infill) == plain(r.doc_id, r.text, percent, spm) and r.restored == (r.text or "")
    assert infill.restore(infill.transform(docs.limit(0))).count() == 0


def test_other_marks(spark):
    docs = spark.createDataFrame([(i, f"word{i} and <P> more words {i}") for i in range(50)], "doc_id long, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    for r in infill.restore(infill.transform(docs, percent=100, marks=marks, seed=7), marks=marks).collect():
        assert tuple(r.infill) == plain(r.doc_id, r.text, 100, 80, 7, marks) and r.restored == r.text
    for bad in (("aba", "x", "y"), ("ab", "bc", "z"), ("", "x", "y"), ("ab", "xaby", "z")):
        with pytest.raises(ValueError):
            infill.transform(docs, marks=bad)
    with pytest.raises(ValueError, match="each mark once"):
        infill.restore_block(*infill._bytes_of(pa.array(["<P>a<S>b"])), np.array([1]), infill._check_marks(infill.MARKS))
