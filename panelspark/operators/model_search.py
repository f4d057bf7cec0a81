"""The models that hold a stated share of the posterior mass, where there are too many to list.

Models are the nodes of a tree: a model's children add one later term each. For all
models below a node the mass is bounded from the moments: what terms can add to R² is at
most a sum of one number per term, and the log score is convex in R², so a chord above
it turns that sum into a product, whose totals over all sets of a size are elementary
symmetric polynomials. Nodes of large bound are expanded, subtrees in tasks, until the
listed models hold the share against everything that the bounds still allow.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import dist
from panelspark.session import pinned

#: Nodes within this factor of the largest bound are expanded in a round.
SPREAD = math.log(50)


@dataclass(frozen=True)
class Tree:
    """Correlations of one training set's terms, in the order in which models grow."""

    order: np.ndarray
    a: np.ndarray
    r: np.ndarray
    n: float
    c: float
    terms: int

    @classmethod
    def of(cls, evidence) -> Tree:
        """Terms go in by their gain, so that models without a strong term are cut off early."""
        scale = np.sqrt(np.maximum(np.diag(evidence.s), 0.0))
        usable = np.flatnonzero(scale > 0)
        d = scale[usable]
        a = evidence.s[np.ix_(usable, usable)] / np.outer(d, d)
        r = evidence.sy[usable] / d / math.sqrt(evidence.t)
        left, order, block, pull = list(range(len(usable))), [], a.copy(), r.copy()
        while left:
            free = np.array([block[j, j] for j in left])
            gain = np.where(free > 1e-10, pull[left] ** 2 / np.maximum(free, 1e-10), -1.0)
            j = left.pop(int(np.argmax(gain)))
            order.append(j)
            if block[j, j] > 1e-10:
                way = block[:, j] / block[j, j]
                pull = pull - way * pull[j]
                block = block - np.outer(way, block[j])
        return cls(usable[order], a[np.ix_(order, order)], r[order], evidence.n, evidence.c, len(evidence.sy))

    def size_score(self, k):
        """What the number of terms alone adds to the log posterior; none from n − 1 on."""
        fit = (self.n - 1 - k) / 2 * math.log1p(self.c) if k else (self.n - 1) / 2 * math.log1p(self.c)
        return fit - math.log(self.terms + 1) - dist.log_choose(self.terms, k) if k < self.n - 1 or k == 0 else -math.inf

    def fit_score(self, r2):
        return -(self.n - 1) / 2 * np.log1p(self.c * (1 - np.minimum(r2, 1.0)))

    def root(self) -> tuple[float, float]:
        """Log posterior of the empty model, and the bound of all others."""
        children = self.expand(())
        below = np.logaddexp.reduce([v for _, lp, b in children for v in (lp, b)]) if children else -math.inf
        return -math.log(self.terms + 1), float(below)

    def expand(self, chosen: tuple[int, ...]) -> list[tuple[tuple[int, ...], float, float]]:
        """The children ``(chosen, log posterior, log bound of all models below)`` of a node;
        terms that the chosen ones already determine give models without mass."""
        at = list(chosen)
        start = at[-1] + 1 if at else 0
        rest = np.arange(start, len(self.r))
        if not len(rest):
            return []
        b, pull, base = self.a[np.ix_(rest, rest)], self.r[rest], 0.0
        if at:
            way = np.linalg.solve(self.a[np.ix_(at, at)], np.column_stack([self.a[np.ix_(at, rest)], self.r[at]]))
            base = float(self.r[at] @ way[:, -1])
            b = b - self.a[np.ix_(rest, at)] @ way[:, :-1]
            pull = pull - self.a[np.ix_(rest, at)] @ way[:, -1]
        floor = _diagonal_below(b)
        most = _suffix_gains(b, pull, 1 - base)
        out = []
        for i in range(len(rest)):
            if b[i, i] <= 1e-10:
                continue
            r2 = min(base + pull[i] ** 2 / b[i, i], 1.0)
            score = self.size_score(len(at) + 1)
            left = pull[i + 1 :] - b[i + 1 :, i] * (pull[i] / b[i, i])
            room = min(max(base + most[i] - r2, 0.0) * (1 + 1e-9) + 1e-12, 1 - r2)
            below = self._below(len(at) + 1, r2, room, left**2, floor[i + 1 :])
            out.append(((*at, int(rest[i])), float(score + self.fit_score(r2)), below))
        return out

    def _below(self, k: int, r2: float, room: float, squares: np.ndarray, floor: np.ndarray) -> float:
        """Log bound of the mass of all models that add some of the later terms."""
        count = len(squares)
        if not count:
            return -math.inf
        low, high = float(self.fit_score(r2)), float(self.fit_score(r2 + max(room, 0.0)))
        slope = (high - low) / room if room > 1e-12 else 0.0
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(floor > 0, np.minimum(squares / floor, room), room)
        logs = slope * gain + (0.0 if room > 1e-12 else high - low)
        top = logs.max()
        sums = np.zeros(count + 1)
        sums[0] = 1.0
        for j, weight in enumerate(np.exp(logs - top)):
            sums[1 : j + 2] = sums[1 : j + 2] + weight * sums[: j + 1]
        sizes = np.arange(1, count + 1)
        with np.errstate(divide="ignore"):
            by_terms = np.log(sums[1:]) + sizes * top + low
        by_count = np.array([dist.log_choose(count, m) for m in range(1, count + 1)]) + high
        scores = np.array([self.size_score(k + m) for m in range(1, count + 1)])
        return float(np.logaddexp.reduce(np.minimum(by_terms, by_count) + scores))


def _diagonal_below(b: np.ndarray) -> np.ndarray:
    """A diagonal matrix below ``b`` in the order of quadratic forms: what a set of terms adds
    to R² is at most the sum of the squared pulls over it, for any set, and whatever other
    terms come in first."""
    least = np.linalg.eigvalsh(b)[0]
    plain = np.full(len(b), max(least * (1 - 1e-9) - 1e-12, 0.0))
    if plain[0] <= 1e-9:
        return plain
    own = 1 / np.diag(np.linalg.inv(b))
    scale = np.sqrt(own)
    scaled = max(np.linalg.eigvalsh(b / np.outer(scale, scale))[0] * (1 - 1e-9) - 1e-12, 0.0) * own
    return scaled if np.log(np.maximum(scaled, 1e-300)).sum() > np.log(plain).sum() else plain


def _suffix_gains(b: np.ndarray, pull: np.ndarray, most: float) -> np.ndarray:
    """What the terms from each one on add to R² together."""
    try:
        half = np.linalg.solve(np.linalg.cholesky(b[::-1, ::-1]), pull[::-1])
    except np.linalg.LinAlgError:
        return np.full(len(b), most)
    return np.minimum(np.cumsum(half**2)[::-1], most)


def _expanded(tree: Tree, node: tuple, least: float, expansions: int):
    """Rows of a subtree: its nodes by decreasing bound, as long as that exceeds ``least``."""
    heap, count = [(-node[2], node)], 0
    while heap:
        below, (chosen, score, _) = heapq.heappop(heap)
        if -below <= least or count >= expansions:
            yield chosen, score, -below, True
            continue
        count += 1
        yield chosen, score, -below, False
        for child in tree.expand(chosen):
            heapq.heappush(heap, (-child[2], child))


SCHEMA = "fold int, chosen array<int>, log_post double, below double, open boolean"


def search_models(
    spark: SparkSession, evidence: Mapping[int, object], share: float = 0.99, most_models: int = 5_000_000, expansions: int = 300
) -> tuple[DataFrame, dict[int, float]]:
    """``(fold, included, log_post)`` of models that hold at least ``share`` of every training
    set's posterior mass, and the share proven for each.

    Rounds expand the open nodes of large bound, each task its own subtrees, ``expansions``
    nodes of a subtree at most before what is open is dealt out anew. Raises when the proof
    takes more than ``most_models`` models: with a weak prior the mass may lie spread over
    nearly all of them.
    """
    trees = {int(k): Tree.of(e) for k, e in evidence.items()}
    terms = len(next(iter(evidence.values())).sy)
    roots = {k: t.root() for k, t in trees.items()}
    zero = {k: max(lp, b) for k, (lp, b) in roots.items()}  # keeps the sums in range
    state = spark.createDataFrame([(k, [], float(lp), float(b), b > -math.inf) for k, (lp, b) in roots.items()], SCHEMA)
    tasks = max(8, spark.sparkContext.defaultParallelism)
    base = F.create_map(*[F.lit(v) for k, z in zero.items() for v in (k, float(z))])[F.col("fold")]
    while True:
        found = state.groupBy("fold").agg(
            F.sum(F.exp(F.col("log_post") - base)).alias("mass"),
            F.sum(F.when(F.col("open"), F.exp(F.col("below") - base)).otherwise(0.0)).alias("rest"),
            F.max(F.when(F.col("open"), F.col("below"))).alias("top"),
            F.count(F.lit(1)).alias("n"),
        ).collect()
        proven = {r["fold"]: r["mass"] / (r["mass"] + r["rest"]) for r in found}
        least = {r["fold"]: r["top"] - SPREAD if proven[r["fold"]] < share else math.inf for r in found}
        if all(v >= share for v in proven.values()):
            break
        if sum(r["n"] for r in found) > most_models:
            raise RuntimeError(f"{most_models} models hold {min(proven.values()):.3f} of the posterior mass")

        def grow(batches, least=least):
            for batch in batches:
                rows = []
                for fold, chosen, score, below in zip(batch["fold"], batch["chosen"], batch["log_post"], batch["below"], strict=True):
                    node = (tuple(int(j) for j in chosen), score, below)
                    rows += [(fold, list(c), s, b, o) for c, s, b, o in _expanded(trees[fold], node, least[fold], expansions)]
                    if len(rows) >= 20_000:
                        yield pd.DataFrame(rows, columns=["fold", "chosen", "log_post", "below", "open"])
                        rows = []
                yield pd.DataFrame(rows, columns=["fold", "chosen", "log_post", "below", "open"])

        opened = state.filter("open").repartition(tasks, "fold", "chosen").mapInPandas(grow, SCHEMA)
        state = pinned(state.filter("not open").unionByName(opened))
    flags = F.create_map(*[v for k, t in trees.items() for v in (F.lit(k), F.array(*[F.lit(int(j)) for j in t.order]))])[F.col("fold")]
    named = F.transform("chosen", lambda j: F.element_at(flags, j + 1))
    included = F.transform(F.array(*[F.lit(j) for j in range(terms)]), lambda j: F.array_contains(named, j).cast("int"))
    return state.select("fold", included.alias("included"), "log_post"), proven
