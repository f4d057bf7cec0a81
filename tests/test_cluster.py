"""k-means: the same under any partitioning, and equal to plain Python from the same start."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import cluster


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 6, (5, 3))
    x = np.concatenate([c + rng.normal(0, 1, (60, 3)) for c in centres])
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["c"] *= 1e6
    pdf["id"] = np.arange(len(pdf))
    return pdf


def clusters(df):
    found = {}
    for r in df.select("id", "cluster").collect():
        found.setdefault(r["cluster"], set()).add(r["id"])
    return sorted(map(sorted, found.values()))


@pytest.mark.parametrize("scale", [False, True])
def test_any_partitioning(spark, frame, scale):
    df = spark.createDataFrame(frame)
    one = cluster.kmeans_groups(df.repartition(1), ["a", "b", "c"], 5, scale=scale)
    many = cluster.kmeans_groups(df.repartition(50), ["a", "b", "c"], 5, scale=scale)
    got = {r["id"]: r["cluster"] for r in one.select("id", "cluster").collect()}
    assert got == {r["id"]: r["cluster"] for r in many.select("id", "cluster").collect()} and len(got) == len(frame)


def test_plain_python_agrees(spark, frame):
    df = spark.createDataFrame(frame)
    x = frame[["a", "b", "c"]].to_numpy() / frame[["a", "b", "c"]].std(ddof=1).to_numpy()
    points = df.select(F.array("a", "b", "c").alias("__x"))
    unit = np.array([2.0 ** (np.frexp(abs(frame[c]).max())[1] - 24) for c in ("a", "b", "c")])
    weight = 1 / frame[["a", "b", "c"]].var(ddof=1).to_numpy()
    np.testing.assert_allclose(cluster._weights(points, unit), weight, rtol=1e-6)
    best = None
    for seed in (0, 1, 2):
        start = cluster._start(points, 5, seed, unit, weight) * np.sqrt(weight)
        assert len(np.unique(start, axis=0)) == 5
        while True:
            near = ((x[:, None, :] - start[None]) ** 2).sum(axis=2).argmin(axis=1)
            moved = np.array([x[near == i].mean(axis=0) for i in range(5)])
            if np.allclose(moved, start, atol=1e-9):
                break
            start = moved
        cost = ((x - start[near]) ** 2).sum()
        best = min([b for b in (best, (cost, near.tolist())) if b is not None])
    want = {}
    for i, c in zip(frame["id"], best[1], strict=True):
        want.setdefault(c, []).append(i)
    assert clusters(cluster.kmeans_groups(df, ["a", "b", "c"], 5, scale=True)) == sorted(want.values())


def test_vectors_and_edges(spark):
    rows = [(i, [float(i % 3), float(i % 3 * 2), 1.0]) for i in range(30)] + [(30, None)]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    grouped = cluster.kmeans_vectors(df, "v", 8)
    assert clusters(grouped) == [list(range(j, 30, 3)) for j in range(3)]  # fewer different rows than clusters
    assert cluster.kmeans_vectors(df.limit(0), "v", 3).count() == 0
    table = cluster.cluster_profile(grouped.withColumn("share", F.col("id") * 1.0), "share").collect()
    assert [r["position"] for r in table] == [1, 2, 3] and table[0]["mean"] >= table[1]["mean"]


def test_rows_of_the_queries_are_computed_once(spark, tmp_path):
    from panelspark.plans import catalog

    lines = pd.DataFrame({"l_partkey": np.arange(120) % 40, "l_suppkey": np.arange(120) % 4})
    lines["l_shipdate"] = pd.to_datetime("1995-01-01").date()
    for i, c in enumerate(("l_quantity", "l_extendedprice", "l_discount", "l_tax")):
        lines[c] = 1.0 + np.arange(120) * (i + 3) % 17
    lines["l_returnflag"], lines["l_linestatus"] = np.where(np.arange(120) % 3 == 0, "A", "R"), "F"
    spark.createDataFrame(lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(4)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    for name in ("cluster_rank", "cluster_profile"):
        plan = catalog.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().withCachedData().toString()
        assert "lineitem" not in plan and ("InMemoryRelation" in plan or "ExistingRDD" in plan or "LogicalRDD" in plan)
