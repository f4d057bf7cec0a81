"""k-means groups of members and their profiles, the same under any partitioning.

Values are rounded to 2⁻²⁴ of their column's range, so that all sums are of whole numbers
and do not depend on their order; starting points follow from digests of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.operators.explore import mean_band
from panelspark.operators.panel import bind_by_rank
from panelspark.session import reused

#: Rows of least digest, for each cluster, among which a start is drawn.
CANDIDATES = 64


def kmeans_groups(
    df: DataFrame, features: Sequence[str], k: int = 8, seeds: Sequence[int] = (0, 1, 2), scale: bool = False,
    out: str = "cluster", max_iter: int = 100,
) -> DataFrame:
    """Every row with its cluster; the best of several starts by total distance.

    Rows with a null feature are dropped. Cluster numbers carry no meaning:
    report clusters by a ranked mean. ``scale`` divides the features by their deviations.
    """
    rows = df.na.drop("any", subset=list(features))
    packed = rows.withColumn("__x", F.array(*[F.col(f"`{c}`").cast("double") for c in features]))
    return _best_of(packed, k, seeds, out, max_iter, scale).drop("__x")


def kmeans_vectors(
    df: DataFrame, vector: str, k: int = 8, seeds: Sequence[int] = (0, 1, 2), out: str = "cluster", max_iter: int = 100
) -> DataFrame:
    """``kmeans_groups`` over a whole array column, whatever its length; null vectors are dropped."""
    packed = df.filter(F.col(vector).isNotNull()).withColumn("__x", F.transform(vector, lambda v: v.cast("double")))
    return _best_of(packed, k, seeds, out, max_iter, False).drop("__x")


def _best_of(packed: DataFrame, k: int, seeds: Sequence[int], out: str, max_iter: int, scale: bool) -> DataFrame:
    with reused(packed.select("__x")) as kept:
        tops = kept.select(F.posexplode("__x").alias("at", "v")).groupBy("at").agg(F.max(F.abs("v")).alias("top")).orderBy("at").collect()
        if not tops:
            return packed.withColumn(out, F.lit(None).cast("int"))
        unit = np.array([2.0 ** (math.frexp(r["top"])[1] - 24) if r["top"] > 0 else 1.0 for r in tops])
        weight = _weights(kept, unit) if scale else np.ones(len(unit))
        fits = [_lloyd(kept, _start(kept, k, seed, unit, weight), unit, weight, max_iter) for seed in seeds]
    centres = min(fits, key=lambda fit: fit[0])[1]
    factor = F.array(*[F.lit(float(w)) for w in np.sqrt(weight)])
    scaled = packed.withColumn("__w", F.zip_with("__x", factor, lambda v, w: v * w))
    return nearest_centre(scaled, "__w", centres * np.sqrt(weight), out).drop("__w")


def _weights(points: DataFrame, unit: np.ndarray) -> np.ndarray:
    """One over the variance of each column, from exact sums."""
    q = F.round(F.col("v") / F.array(*[F.lit(float(u)) for u in unit])[F.col("at")]).cast("decimal(20,0)")
    long = points.select(F.posexplode("__x").alias("at", "v")).select("at", q.alias("q"))
    sums = long.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("s"), F.sum((F.col("q") * F.col("q")).cast("decimal(38,0)")).alias("ss")).orderBy("at")
    var = np.array([float(r["n"] * int(r["ss"]) - int(r["s"]) ** 2) / r["n"] / max(r["n"] - 1, 1) for r in sums.collect()]) * unit**2
    return np.where(var > 0, 1 / np.where(var > 0, var, 1.0), 1.0)


def _rounded(x: np.ndarray, unit: np.ndarray) -> np.ndarray:
    return np.rint(x / unit).astype(np.int64)


def _distances(q: np.ndarray, centres: np.ndarray, unit: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared distances, added up column by column: a row's do not depend on its batch."""
    far = np.zeros((len(q), len(centres)))
    for j in range(q.shape[1]):
        off = (q[:, j] * unit[j])[:, None] - centres[None, :, j]
        far += weight[j] * off * off
    return far


def _start(points: DataFrame, k: int, seed: int, unit: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Starting centres, drawn with odds by distance among the rows of least digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.array_join(F.transform("__x", lambda v: v.cast("string")), ",")))
    rows = points.select("__x", digest.alias("__d")).distinct().orderBy("__d").limit(CANDIDATES * k).collect()
    q = _rounded(np.array([r["__x"] for r in rows]), unit)
    rng = np.random.default_rng(seed)
    centres = q[:1] * unit
    while len(centres) < k:
        least = _distances(q, centres, unit, weight).min(axis=1)
        if not least.sum() > 0:
            break  # fewer different rows than clusters
        at = int(np.searchsorted(np.cumsum(least), rng.random() * least.sum(), side="right"))
        centres = np.concatenate([centres, q[min(at, len(q) - 1)][None, :] * unit])
    return centres


def _lloyd(points: DataFrame, centres: np.ndarray, unit: np.ndarray, weight: np.ndarray, max_iter: int) -> tuple[float, np.ndarray]:
    """Total distance and centres once no centre moves, or after ``max_iter`` rounds."""
    width = centres.shape[1]
    for _ in range(max_iter):

        def run(batches, centres=centres):
            sums, count, cost = np.zeros(centres.shape, np.int64), np.zeros(len(centres), np.int64), 0
            for batch in batches:
                if batch.num_rows:
                    q = _rounded(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width), unit)
                    far = _distances(q, centres, unit, weight)
                    near = far.argmin(axis=1)
                    np.add.at(sums, near, q)
                    count += np.bincount(near, minlength=len(centres))
                    cost += math.fsum(far[np.arange(len(q)), near])
            wide = np.column_stack([sums, count])
            yield pa.RecordBatch.from_pydict(
                {"cluster": pa.array(range(len(centres)), pa.int32()), "m": pa.array(list(wide), pa.list_(pa.int64())), "cost": pa.array([float(cost)] + [0.0] * (len(centres) - 1))}
            )

        parts = points.select("__x").mapInArrow(run, "cluster int, m array<bigint>, cost double")
        summed = parts.select("cluster", F.posexplode("m").alias("at", "v")).groupBy("cluster", "at").agg(F.sum("v").alias("v"))
        wide = np.zeros((len(centres), width + 1), np.int64)
        for cluster, at, v in summed.collect():
            wide[cluster, at] = v
        count = wide[:, -1:]
        moved = np.where(count > 0, wide[:, :-1] * unit / np.maximum(count, 1), centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return float(parts.agg(F.sum("cost")).first()[0] or 0.0), centres


def cluster_profile(df: DataFrame, value: str, cluster: str = "cluster") -> DataFrame:
    """Mean ± 1 deviation of a value per cluster, clusters numbered by falling mean.

    The rank runs over one row per cluster.
    """
    bands = mean_band(df, [cluster], value)
    order = W.partitionBy(F.lit(1)).orderBy(F.col("mean").desc_nulls_last(), cluster)
    return bands.withColumn("position", F.row_number().over(order)).drop(cluster)


def compare_ranks(rank_means: DataFrame, profiles: Mapping[str, DataFrame], k: int = 8) -> DataFrame:
    """Average share by rank next to the ordered cluster means of each feature set."""
    frames = {"rank_mean": (rank_means, "mean"), **{name: (p, "mean") for name, p in profiles.items()}}
    return bind_by_rank(frames, k)


def nearest_centre(df: DataFrame, vector: str, centres: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Assign array rows to the closest of a few given centres, in the JVM."""
    x = F.transform(vector, lambda v: v.cast("double"))
    far = [
        F.struct(
            F.aggregate(
                F.zip_with(x, F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b)),
                F.lit(0.0),
                lambda acc, v: acc + v,
            ).alias("d"),
            F.lit(i).alias("i"),
        )
        for i, centre in enumerate(centres)
    ]
    return df.withColumn(out, F.array_min(F.array(*far))["i"])
