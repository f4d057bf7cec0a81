"""Nearest neighbours: pigeonhole probing, recall against brute force, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import neighbours


@pytest.mark.parametrize("radius", [0, 1, 7, 8, 13, 20, 64])
def test_probing_finds_every_code_in_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 256, (300, 8), dtype=np.uint8)
    for i in range(0, 300, 3):  # near ones too
        codes[i] = codes[0] ^ np.packbits(rng.random(64) < 0.12)
    asked = codes[:40]
    apart = np.bitwise_count(asked.view("<u8")[:, 0][:, None] ^ codes.view("<u8")[:, 0][None, :])
    index = neighbours.Index(codes, radius)
    assert (index.probe(asked) | (apart > radius)).all()
    assert (index.within(asked, 0) == (apart <= radius)).all()
    assert (index.within(asked, 9).sum(axis=1) >= 9).all()


def brute(ids, x, asked, k):
    out = {}
    for q in asked:
        score = (x * x[ids.tolist().index(q)]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), score[j]) for j in order]
    return out


def recall(spark, ids, x, k=20, **more):
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    asked = frame.where("vec_id % 20 = 0")
    got = {}
    for r in neighbours.nearest(frame, asked, k, **more).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(ids, x, [int(i) for i in ids if i % 20 == 0], k)
    assert set(got) == set(want)
    for q, rows in got.items():
        assert len(rows) == min(k, len(ids) - 1) and q not in [i for i, _ in rows]
        assert [s for _, s in rows] == pytest.approx([float(x[ids.tolist().index(i)] @ x[ids.tolist().index(q)]) for i, _ in rows])
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    assert recall(spark, ids, x, row_block=300, query_block=40) >= 0.9


def test_recall_with_unequal_lengths(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24)) * rng.lognormal(sigma=0.7, size=(1500, 1))
    assert recall(spark, np.arange(1500), x, row_block=400) >= 0.9


def test_few_rows_and_ties(spark):
    x = np.repeat(np.eye(3), 3, axis=0)
    assert recall(spark, np.arange(9), x) == 1.0
    assert recall(spark, np.array([0, 20]), np.ones((2, 5))) == 1.0


def test_rows_without_a_place(spark):
    bad = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [None, 1.0]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (120, [1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [])]
    frame = spark.createDataFrame(bad, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))
    got = neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), 20).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 7, 3.0), (0, 2, 7, 3.0)]
    assert neighbours.nearest(frame.limit(0), frame, 5).count() == 0
    assert neighbours.nearest(frame, frame.limit(0), 5).count() == 0
