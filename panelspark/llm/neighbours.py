"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

A rotation of the principal axes, learned on a bounded sample so that the signs lose
least (iterative quantisation), gives each vector a code of up to 64 bits. Codes are
indexed by their eight bytes. By the pigeonhole principle two codes within a Hamming
radius ``8 s + a`` agree up to ``s`` bits on one of the first ``a + 1`` bytes or up
to ``s - 1`` on one of the others, so probing those neighbouring byte values finds
every code in the radius. What is found is checked for the whole distance and ranked
by the inner product of the original vectors in double precision.

Vectors get one more coordinate that makes all as long as the longest, which turns
the largest inner product into the smallest angle. Queries meet rows in a grid of
blocks of bounded size; a block of rows is indexed where it is read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelspark.llm._shared import checkpointed

_DISTANCE = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])


@dataclass(frozen=True)
class Codes:
    """Centre and rotation (from the lengthened vectors), the longest norm, the radius."""

    centre: np.ndarray
    rotation: np.ndarray
    longest: float
    radius: int

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        x = x / self.longest
        return np.c_[x, np.sqrt(np.maximum(0, 1 - (x**2).sum(axis=1)))]

    def of(self, x: np.ndarray) -> np.ndarray:
        """Codes of rows, as their eight bytes."""
        return self._signs(self.lengthened(x))

    def of_queries(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return self._signs(np.c_[unit, np.zeros(len(x))])

    def _signs(self, x: np.ndarray) -> np.ndarray:
        bits = np.zeros((len(x), 64), np.uint8)
        bits[:, : self.rotation.shape[1]] = (x - self.centre) @ self.rotation > 0
        return np.packbits(bits, axis=1, bitorder="little")


def _usable(vector: Column, size: int | None = None) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vector.isNotNull() & whole & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good if size is None else good & (F.size(vector) == size), F.lit(False))


def _rotation(x: np.ndarray, rounds: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Iterative quantisation: principal axes, then the rotation whose signs fit best."""
    centre = x.mean(axis=0)
    centred = x - centre
    values, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, np.argsort(-values)[:64]]
    projected = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.sign(projected @ turn).T @ projected)
        turn = (u @ vt).T
    return centre, axes @ turn


def learn(vectors: DataFrame, longest: float, k: int = 20, sample: int = 20_000, trials: int = 200, share: float = 0.99, rounds: int = 30, seed: int = 1) -> Codes:
    """Rotation and radius from the ``sample`` rows of least key digest.

    ``vectors`` has the columns ``id, v``. The radius is the least that holds
    ``share`` of the ``k`` nearest sampled rows of ``trials`` sampled vectors; in the
    whole table the nearest are nearer still.
    """
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    x = np.array(rows["v"].tolist(), dtype=np.float64)
    codes = Codes(np.zeros(1), np.zeros((1, 1)), longest, 64)
    centre, rotation = _rotation(codes.lengthened(x), rounds, seed)
    codes = Codes(centre, rotation, longest, 64)
    own, asked = codes.of(x).view("<u8")[:, 0], x[:trials]
    theirs = codes.of_queries(asked).view("<u8")[:, 0]
    scores = asked @ x.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    near = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    apart = np.bitwise_count(theirs[:, None] ^ own[near])
    radius = int(np.quantile(apart, share, method="higher")) if apart.size else 64
    return Codes(centre, rotation, longest, radius)


class Index:
    """Codes of a block of rows by the values of their bytes, with the rows that a
    probe of each value finds as bitmaps."""

    def __init__(self, codes: np.ndarray, radius: int):
        self.codes, self.radius = codes.view("<u8")[:, 0], radius
        small, extra = divmod(radius, 8)
        self.bitmaps = []
        for j in range(8):
            reach = small if j <= extra else small - 1
            if reach >= 0:
                self.bitmaps.append((j, np.packbits((reach >= _DISTANCE)[:, codes[:, j]], axis=1, bitorder="little")))

    def probe(self, codes: np.ndarray) -> np.ndarray:
        """For each query, which rows share a byte within its reach."""
        found = np.zeros((len(codes), -(-len(self.codes) // 8)), np.uint8)
        for j, bitmap in self.bitmaps:
            found |= bitmap[codes[:, j]]
        return np.unpackbits(found, axis=1, count=len(self.codes), bitorder="little").astype(bool)

    def within(self, codes: np.ndarray, least: int) -> np.ndarray:
        """All rows in the radius; for a query with fewer than ``least``, the rows of
        the ``least`` smallest distances (with ties)."""
        apart = np.bitwise_count(codes.view("<u8")[:, 0][:, None] ^ self.codes[None, :])
        found = self.probe(codes) & (apart <= self.radius)
        few = np.flatnonzero(found.sum(axis=1) < min(least, len(self.codes)))
        if len(few):
            worst = np.partition(apart[few], min(least, len(self.codes)) - 1, axis=1)[:, min(least, len(self.codes)) - 1]
            found[few] |= apart[few] <= worst[:, None]
        return found


def _search(queries: pd.DataFrame, rows: pd.DataFrame, codes: Codes, k: int) -> pd.DataFrame:
    """The ``k`` best of a block of rows for a block of queries."""
    names = ["query_id", "vec_id", "score"]
    if not len(queries) or not len(rows):
        return pd.DataFrame({n: pd.Series(dtype=t) for n, t in zip(names, ("int64", "int64", "float64"), strict=True)})
    rows = rows.sort_values("id", kind="stable")
    ids, x = rows["id"].to_numpy(), np.array(rows["v"].tolist(), dtype=np.float64)
    index = Index(codes.of(x), codes.radius)
    out = []
    for at in range(0, len(queries), 256):
        part = queries.iloc[at : at + 256]
        own, q = part["id"].to_numpy(), np.array(part["v"].tolist(), dtype=np.float64)
        found = index.within(codes.of_queries(q), k + 1)
        i, j = np.nonzero(found)
        keep = own[i] != ids[j]
        i, j = i[keep], j[keep]
        score = np.empty(len(i))
        for s in range(0, len(i), 1 << 16):
            t = slice(s, s + (1 << 16))
            score[t] = np.einsum("nd,nd->n", q[i[t]], x[j[t]])
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, i)
        best = np.arange(len(i)) - first < k
        out.append(pd.DataFrame({"query_id": own[i[best]], "vec_id": ids[j[best]], "score": score[best]}))
    return pd.concat(out)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, vector: str = "embedding", key: str = "vec_id", row_block: int = 8192, query_block: int = 4096, codes: Codes | None = None) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product with each row of
    ``queries``: ``query_id, rank, vec_id, score``, ties to the smaller key.

    A row is no neighbour of the query with its key. Vectors that are null, all
    zero, hold nulls or values that are not finite, or have another length than most
    of ``vectors``, and rows with a null key, take no part on either side. A query
    gets all other rows if there are fewer than ``k``. Repeated rows of ``vectors``
    count each; a repeated query is answered once. No rows or no queries: no rows.
    Every task works on one block of rows and one of queries, of about the given
    sizes; each pair of blocks gives at most ``k`` rows a query.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & _usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("many"), F.sqrt(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("longest"))
    most = sizes.orderBy(F.desc("many"), F.desc("n")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if most is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.where(F.size("v") == most.n)
    asked = queries.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = asked.where(F.col("id").isNotNull() & _usable(F.col("v"), most.n)).dropDuplicates(["id"])
    codes = codes or learn(rows, most.longest, k)
    row_blocks, query_blocks = -(-most.many // row_block), max(1, -(-asked.count() // query_block))
    place = lambda n: F.pmod(F.xxhash64("id", F.lit(11)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("id", "v", place(query_blocks).alias("qb"), every(row_blocks).alias("rb"))
    right = rows.select("id", "v", every(query_blocks).alias("qb"), place(row_blocks).alias("rb"))
    found = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInPandas(lambda q, r: _search(q, r, codes, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = checkpointed(found)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

