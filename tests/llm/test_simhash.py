"""SimHash operator against plain Python."""

from itertools import combinations

import numpy as np
import pytest
from panelspark.llm import _graph, simhash
from tests_llm_plain import simhash_of


def components(rows):
    root = list(range(len(rows)))
    while True:
        new = list(root)
        for i, j in combinations(range(len(rows)), 2):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 2:
                new[i] = new[j] = min(new[i], new[j])
        if new == root:
            break
        root = new
    least = {}
    for r, (key, _) in zip(root, rows, strict=True):
        least[r] = min(x for x in (least.get(r), key) if x is not None) if (least.get(r), key) != (None, None) else None
    return [least[r] for r in root]


TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away " * 3),
    (2, "the QUICK brown fox jumps over the lazy dog and runs away " * 3),
    (3, "the quick brown fox jumps over the lazy dog and runs away " * 3 + "now"),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r"),
    (7, "one"),
    (8, "one two"),
    (9, "Ärger mit É und\x1cÜ"),
    (None, "one two"),
    (10, "one two"),
    (10, "one two"),
    (11, " ".join(f"w{i}" for i in range(40000))),
]


def test_matches_plain(spark):
    docs = spark.createDataFrame([(k, t, "x", 1.0) for k, t in TEXTS], "doc_id long, text string, print string, component_id double")
    got = simhash.near_duplicates(docs).collect()
    rows = [(k, simhash_of(t)) for k, t in TEXTS]
    want = sorted((str(k), p, c) for (k, p), c in zip(rows, components(rows), strict=True))
    assert sorted((str(r.doc_id), r.print % (1 << 64), r.component_id) for r in got) == want


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_connect_like_all_pairs(spark, bits):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    values = {int(s) for s in seeds}
    for s in seeds:  # chains and clouds around each seed
        at = int(s)
        for _ in range(60):
            at ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 4), replace=False))
            values.add(at)
        for _ in range(40):
            values.add(int(s) ^ sum(1 << int(b) for b in rng.choice(16, 2, replace=False)))
    values = sorted(values)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "print long")
    got = simhash.connected_components(simhash.links(frame, bits)).collect()
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(values, 2):
        if bin(a ^ b).count("1") <= bits:
            root[max(top(a), top(b))] = min(top(a), top(b))
    want = {}
    for v in values:
        want.setdefault(top(v), set()).add(v)
    have = {}
    for r in got:
        have.setdefault(r.component, set()).add(r.node % (1 << 64))
    assert sorted(map(sorted, have.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


@pytest.mark.parametrize("pairs", [4096, 2])
def test_rounds_of_few_pairs_are_kept_in_few_files(spark, monkeypatch, pairs):
    made, real = [], _graph.checkpointed

    def counted(df):
        out = real(df)
        made.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(_graph, "checkpointed", counted)
    monkeypatch.setattr(_graph, "PAIRS", pairs)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "29")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        frame = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20], "a long, b long")
        got = {r.node: r.component for r in _graph.connected_components(frame).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}
    assert len(made) > 2 and max(made[1:]) == (_graph.FILES if pairs == 4096 else 20)


def test_large_posting_list():
    rng = np.random.default_rng(5)
    values = np.unique(rng.integers(0, 1 << 16, 900, dtype=np.uint64)) | np.uint64(7 << 40)
    root = simhash._roots(values, 2)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    label = np.arange(len(values))
    while True:
        new = np.where(near, label[None, :], len(values)).min(axis=1)
        if (new == label).all():
            break
        label = new
    assert len(set(zip(root, label, strict=True))) == len(set(root)) == len(set(label))


def test_keep_one(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (1, "a b c d"), (None, "q r s t"), (5, "other words here now")], "doc_id long, text string")
    kept = simhash.keep_one(docs, simhash.near_duplicates(docs))
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "5", "None"]
