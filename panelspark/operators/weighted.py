"""Iteratively reweighted fits: one pass over the rows serves all models.

Quantile regression (by smoothed Newton steps) and generalised linear models
(by scoring steps) both need, per step and model, the weighted products
``XᵀWX`` and ``Xᵀv``. A model is a quantile level, a held-out fold, a bootstrap
replicate, a penalty, or a combination of them; rows are never copied per model.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.gram import MAX_COLLECTED, add_partials, packed_pairs, quoted

MODELS_AT_ONCE = 256
#: Rows times models of one block: what a step holds of them does not grow with either.
CELLS_AT_ONCE = 1 << 18
#: Tables of more rows get the shorter search for quantile planes. Its planes are proven as the
#: others are, but of several equally good ones it may end at another.
MANY_ROWS = 1 << 20
STREAM = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Models:
    """Everything that tells the models of one pass apart, one entry per model."""

    beta: np.ndarray
    skip_fold: np.ndarray
    skip_inner: np.ndarray
    tau: np.ndarray
    replicate: np.ndarray
    width: np.ndarray
    before: np.ndarray

    @classmethod
    def grid(cls, size: int, **given) -> Models:
        """Models from broadcastable lists; unset fields mean "does not apply"."""
        given = {k: np.asarray(v) for k, v in given.items()}
        count = max([len(v) for v in given.values()], default=1)
        full = {
            "skip_fold": np.full(count, -1),
            "skip_inner": np.full(count, -1),
            "tau": np.full(count, 0.5),
            "replicate": np.full(count, -1),
            "width": np.ones(count),
        }
        full.update(given)
        return cls(beta=np.zeros((count, size)), before=np.zeros((count, size)), **full)

    def __len__(self) -> int:
        return len(self.tau)

    def part(self, lo: int, hi: int) -> Models:
        return self.pick(slice(lo, hi))

    def pick(self, at) -> Models:
        return Models(**{f: getattr(self, f)[at] for f in self.__dataclass_fields__})


def row_bits(row_key: Sequence[str], seed: int | str) -> Column:
    """64 bits of a digest of the row key and the seed, as a long."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in row_key], F.lit(str(seed))))
    high, low = (F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in (0, 1))
    return F.shiftleft(high, 32).bitwiseOR(low)


def poisson_one(row_hash: np.ndarray, replicate: np.ndarray) -> np.ndarray:
    """Poisson(1) counts per (row, replicate) from the row's 64-bit hash.

    They depend on nothing but the row and the replicate, so any partitioning
    of the rows draws the same bootstrap sample.
    """
    with np.errstate(over="ignore"):
        z = row_hash.astype(np.uint64)[:, None] + STREAM * (replicate.astype(np.uint64) + np.uint64(1))[None, :]
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    z >>= np.uint64(11)
    term, cdf = np.exp(-1.0), [np.exp(-1.0)]
    for k in range(1, 18):
        term /= k
        cdf.append(cdf[-1] + term)
    # as whole numbers of 2⁻⁵³, which the draws are; few draws are beyond the first
    cuts = np.ceil(np.array(cdf) * float(1 << 53)).astype(np.uint64)
    counts = (z >= cuts[0]).astype(float)
    counts += z >= cuts[1]
    far = z >= cuts[2]
    counts[far] = np.searchsorted(cuts, z[far], side="right")
    return counts


@dataclass(frozen=True)
class Design:
    """Prepared rows: centred and scaled terms plus what the models look at."""

    rows: DataFrame
    terms: list[str]
    label: str
    shift: np.ndarray
    scale: np.ndarray
    y_shift: float
    y_scale: float
    fold: str | None = None
    inner_fold: str | None = None
    hash: str | None = None
    parts: int = 1 << 30
    count: int = 0

    @property
    def size(self) -> int:
        return len(self.terms) + 1

    def read(self) -> DataFrame:
        """The columns the tasks need, and no others."""
        columns = [F.col(quoted(t)).cast("double").alias(f"x{j}") for j, t in enumerate(self.terms)]
        columns.append(F.col(quoted(self.label)).cast("double").alias("y"))
        for name in ("fold", "inner_fold"):
            if getattr(self, name):
                columns.append(F.col(getattr(self, name)).cast("int").alias(name))
        if self.hash:
            columns.append(F.col(self.hash).alias("hash"))
        return self.rows.select(*columns)

    @property
    def scaling(self) -> tuple:
        return self.shift, self.scale, self.y_shift, self.y_scale

    def to_original(self, beta: np.ndarray) -> np.ndarray:
        """Coefficients on the original scale, intercept first."""
        slopes = beta[..., 1:] / self.scale * self.y_scale
        start = beta[..., 0] * self.y_scale + self.y_shift - slopes @ self.shift
        return np.concatenate([start[..., None], slopes], axis=-1)


def prepare(
    rows: DataFrame, terms: Sequence[str], label: str, scale_label: bool, fold: str | None = None,
    inner_fold: str | None = None, hash_column: str | None = None,
) -> Design:
    """Column means and deviations in one aggregate, used to condition the steps."""
    aggs = [f(quoted(c)) for c in [*terms, label] for f in (F.avg, F.stddev_pop)]
    count, *stats = rows.agg(F.count(F.lit(1)), *aggs).first()
    stats = [0.0 if v is None else float(v) for v in stats]
    mean, sd = np.array(stats[0::2]), np.array(stats[1::2])
    sd = np.where(sd > 0, sd, 1.0)
    return Design(
        rows, list(terms), label, mean[:-1], sd[:-1],
        mean[-1] if scale_label else 0.0, sd[-1] if scale_label else 1.0, fold, inner_fold, hash_column,
        rows.rdd.getNumPartitions(), count,
    )


Step = Callable[[np.ndarray, np.ndarray, np.ndarray, Models], tuple[list, list[np.ndarray]]]


def weighted_pass(design: Design, models: Models, step: Step, grams: int, sides: int, scalars: int):
    """One pass: lists of ``XᵀWX`` [model, i, j] and ``Xᵀv`` [model, i], and scalars [model, s].

    ``step(base, u, y, models)`` gives, for a block of rows ``u``, pairs of
    weights and right-hand values (or None) and the scalars; ``base`` is each row's own
    weight in a model (0 when its fold is held out, a count in a bootstrap
    replicate).
    """
    size, count = design.size, len(models)
    pairs = packed_pairs(size)
    width = grams * len(pairs) + sides * size + scalars
    if count * width > MAX_COLLECTED:
        raise ValueError("too many models for one pass")
    task = _sums_task(design.scaling, models, step, width)
    partial = design.read().mapInArrow(task, "model int, m array<double>")
    flat = add_partials(partial, "model", count, width, design.parts)
    i, j = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    blocks = []
    for g in range(grams):
        gram = np.zeros((count, size, size))
        gram[:, i, j] = gram[:, j, i] = flat[:, g * len(pairs) : (g + 1) * len(pairs)]
        blocks.append(gram)
    rest = flat[:, grams * len(pairs) :]
    return blocks, [rest[:, k * size : (k + 1) * size] for k in range(sides)], rest[:, sides * size :]


def _blocks(batches, scaling, models):
    """Blocks of rows with the row weights of up to ``MODELS_AT_ONCE`` models at a time."""
    shift, scale, y_shift, y_scale = scaling
    p = len(shift)
    rows = CELLS_AT_ONCE // max(1, min(len(models), MODELS_AT_ONCE))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            block = batch.slice(start, rows)
            n = block.num_rows
            column = {c: block.column(c).to_numpy(zero_copy_only=False) for c in block.schema.names}
            u = np.ones((n, p + 1))
            for t in range(p):
                u[:, t + 1] = (column[f"x{t}"] - shift[t]) / scale[t]
            y = (column["y"] - y_shift) / y_scale
            for lo in range(0, len(models), MODELS_AT_ONCE):
                part = models.part(lo, lo + MODELS_AT_ONCE)
                base = np.ones((n, len(part)))
                if "fold" in column:
                    base *= column["fold"][:, None] != part.skip_fold[None, :]
                if "inner_fold" in column:
                    base *= column["inner_fold"][:, None] != part.skip_inner[None, :]
                if "hash" in column and (part.replicate >= 0).any():
                    drawn = poisson_one(column["hash"].view(np.uint64), np.maximum(part.replicate, 0))
                    base *= np.where(part.replicate[None, :] >= 0, drawn, 1.0)
                yield u, y, base, part, lo


def _sums_task(scaling, models, step, width):
    i, j = np.triu_indices(len(scaling[0]) + 1)

    def run(batches):
        sums, seen, products = np.zeros((len(models), width)), None, None
        for u, y, base, part, lo in _blocks(batches, scaling, models):
            if u is not seen:
                seen, products = u, u[:, i] * u[:, j]
            weights, extra = step(base, u, y[:, None], part)
            sums[lo : lo + len(part)] += np.concatenate(
                [
                    *[w.T @ products for w, _ in weights if w is not None],
                    *[v.T @ u for _, v in weights if v is not None],
                    *[e.sum(axis=0)[:, None] for e in extra],
                ],
                axis=1,
            )
        if seen is not None:
            yield pa.RecordBatch.from_pydict(
                {"model": pa.array(range(len(models)), pa.int32()), "m": pa.array(list(sums), pa.list_(pa.float64()))}
            )

    return run


# --- quantile steps --------------------------------------------------------------


def start_step(base, u, y, models):
    """Least squares: the starting point, and the spread of its residuals."""
    eta = u @ models.beta.T
    return [(base + 0 * eta, base * y)], [base * np.abs(y - eta), base]


def quantile_step(base, u, y, models):
    """Curvatures and pull of the check loss with its kink smoothed over ``± width``.

    The first weights are the smooth loss's own curvature (Newton), the second
    bound it from above everywhere (majorise-minimise), with the same pull.
    """
    r = y - u @ models.beta.T
    h = models.width[None, :]
    size = np.abs(r)
    near = size < h
    pull = base * (models.tau[None, :] - 1 + np.clip((r + h) / (2 * h), 0.0, 1.0))
    tail = (models.tau[None, :] - 0.5) * r
    smooth = np.where(near, r * r / (4 * h) + h / 4, size / 2)
    return (
        [(base * near / (2 * h), pull), (base / (2 * np.maximum(h, size)), None)],
        [base * (smooth + tail), base, base * near, base * (size / 2 + tail)],
    )


def solve_all(gram: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Solve every model's system, guarding against collinear terms."""
    size = gram.shape[1]
    scale = np.maximum(np.trace(gram, axis1=1, axis2=2) / size, 1e-300)
    system = gram + 1e-12 * scale[:, None, None] * np.eye(size)
    return np.linalg.solve(system, rhs[..., None])[..., 0]


def fit_quantiles(
    design: Design, models: Models, lam: float = 0.0, passes: int = 80, tol: float = 1e-6, near: int = 20,
    warm: bool = False,
) -> tuple[Models, np.ndarray, np.ndarray]:
    """Coefficients (conditioned scale), loss and rows in the last band of every quantile model.

    The loss is smoothed over a band of residuals. Passes settle the smooth
    loss for one band, then the band narrows, from the spread of the
    least-squares residuals until about ``near`` rows per coefficient (of many rows the
    power 2/3, if that is more) are left in it. Steps blend Newton and majorise-minimise
    curvature: a step that raises the loss is taken back, and the blend leans to the
    majorising side, which cannot raise it. Settled models leave the passes. What the
    last band leaves is of the order of its square; ``finish_quantiles`` removes it.
    ``lam`` is an L1 penalty on the slopes of the original columns. ``warm`` models
    start with a plane and a band near their own.
    """
    size, count = design.size, len(models)
    if warm:
        beta, width, n = models.beta.copy(), models.width.copy(), None
    else:
        (gram,), (rhs,), _ = weighted_pass(design, models, start_step, 1, 1, 2)
        beta = solve_all(gram, rhs)
        _, _, spread = weighted_pass(design, replace(models, beta=beta), start_step, 1, 1, 2)
        n = np.maximum(spread[:, 1], 1)
        width = 2 * spread[:, 0] / n + 1e-12
    unit = np.concatenate([[0.0], lam / design.scale])
    best, least, loss = beta.copy(), np.full(count, np.inf), np.zeros(count)
    blend, fresh, missed = np.full(count, 0.01 if warm else 1.0), np.ones(count, bool), np.zeros(count, bool)
    newton, major, pull = np.zeros((count, size, size)), np.zeros((count, size, size)), np.zeros((count, size))
    held, done = np.zeros(count), np.zeros(count, bool)
    for _ in range(passes):
        at = np.flatnonzero(~done)
        now = replace(models, beta=beta, width=width).pick(at)
        (g_newton, g_major), (g_pull,), scalars = weighted_pass(design, now, quantile_step, 2, 1, 4)
        n = np.maximum(scalars[:, 1], 1) if n is None else n
        merit = np.full(count, np.inf)
        merit[at] = scalars[:, 0] + (np.abs(beta[at]) * unit).sum(axis=1)
        ok = merit <= least
        ok[done] = False
        held[at] = scalars[:, 2]
        thin = held <= (np.maximum(near * size, n ** (2 / 3)) if design.count > MANY_ROWS else near * size)
        small = np.zeros(count, bool)
        known = ok & ~fresh
        small[known] = (least - merit)[known] <= (np.where(thin, np.minimum(tol, size / n), 1e-4) * np.abs(merit))[known]
        flat = known & small & (blend <= 0.1)
        new = ok[at]
        best[ok], least[ok], loss[ok] = beta[ok], merit[ok], scalars[new, 3]
        newton[ok], major[ok], pull[ok] = g_newton[new], g_major[new], g_pull[new]
        done |= flat & thin
        if done.all():
            break
        blend = np.where(known, blend * np.where(missed, 0.3, 0.1), blend)
        blend = np.where(ok, blend, np.minimum(1.0, np.maximum(10 * blend, 0.1)))
        missed, fresh = ~ok, np.zeros(count, bool)
        system = newton + blend[:, None, None] * (major - newton)
        system = system + (1e-9 * n / width)[:, None, None] * np.eye(size)
        target = np.einsum("mij,mj->mi", system, best) + pull
        move = ~done
        if lam > 0:
            beta[move] = soft_solve(
                system[move] / n[move, None, None], target[move] / n[move, None], unit[None, :] / n[move, None], best[move]
            )
        else:
            beta[move] = np.linalg.solve(system[move], target[move][..., None])[..., 0]
        narrow = flat & ~thin
        width = np.where(narrow, width * 0.25, width)
        beta[narrow | done] = best[narrow | done]
        least[narrow], fresh[narrow] = np.inf, True
        blend[narrow] = np.maximum(blend[narrow], 0.1)
    return replace(models, beta=best, width=width), loss * design.y_scale, held


# --- exact quantile solutions ------------------------------------------------------


def _nearest_basis(u, off) -> list[int] | None:
    """Rows of least ``off``, each independent of those before it, as many as columns."""
    rest, basis = u.copy(), []
    order = np.argsort(off, kind="stable")
    least = 1e-10 * np.sqrt((u * u).sum(axis=1))
    for _ in range(u.shape[1]):
        free = np.sqrt((rest * rest).sum(axis=1)) > least
        free[basis] = False
        if not free.any():
            return None
        basis.append(int(order[np.argmax(free[order])]))
        way = rest[basis[-1]] / np.linalg.norm(rest[basis[-1]])
        for _ in range(2):
            rest = rest - np.outer(rest @ way, way)
    return basis


def best_plane(u, y, w, tau, far, b):
    """Minimise ``Σ w·ρ_τ(y − ub) − far·b`` exactly over a few rows, starting near ``b``.

    Walks along edges between planes through as many rows as coefficients, each
    time as far as the loss falls. Where more rows lie on a plane, the walk may come
    back to a basis; it then goes on over values apart by next to nothing, which no
    longer tie, and the basis it ends at is as good for the values themselves. None if
    the walk would leave the given rows.
    """
    basis = _nearest_basis(u, np.abs(y - u @ b))
    if basis is None:
        return None
    basis, ended, turns = _walk(u, y, w, tau, far, basis)
    if turns:
        lift = np.random.default_rng(0).uniform(0.5, 1.0, len(y)) * max(1.0, np.abs(y).max())
        for eps in (1e-10, 1e-12):
            apart = y + eps * lift
            found, ended, turns = _walk(u, apart, w, tau, far, list(basis))
            if not ended:
                continue
            r, moved = (v - u @ (np.linalg.inv(u[found]) @ v[found]) for v in (y, apart))
            other = (r > 0) != (moved > 0)
            other[found] = False
            if np.abs(r[other]).max(initial=0.0) <= 1e3 * eps * lift.max():
                basis = found
                break
        else:
            return None
    return np.linalg.inv(u[basis]) @ y[basis] if ended else None


def _walk(u, y, w, tau, far, basis):
    """Last basis, whether it is the optimum, and whether the walk came back to a basis."""
    seen = set()
    for _ in range(1000 + 20 * len(y)):
        inverse = np.linalg.inv(u[basis])
        b = inverse @ y[basis]
        r = y - u @ b
        r[basis] = 0.0
        pull = np.where(r > 0, tau, tau - 1) * w
        pull[basis] = 0.0
        side = -(far + pull @ u) @ inverse
        over, under = side - (w * tau)[basis], (w * (tau - 1))[basis] - side
        j = int(np.argmax(np.maximum(over, under)))
        slope = -max(over[j], under[j])
        if slope >= -1e-10 * (1 + np.abs(side).max()):
            return basis, True, False
        if (key := tuple(sorted(basis))) in seen:
            return basis, False, True
        seen.add(key)
        way = inverse[:, j] * (1.0 if under[j] > over[j] else -1.0)
        along = u @ way
        with np.errstate(divide="ignore", invalid="ignore"):
            at = r / along
        at[basis] = np.inf
        at[~(at > 0) | (w <= 0)] = np.inf
        order = np.argsort(at, kind="stable")
        passed = slope + np.cumsum((w * np.abs(along))[order])
        first = int(np.argmax(passed >= 0))
        if passed[first] < 0 or not np.isfinite(at[order[first]]):
            return basis, False, False
        basis[j] = int(order[first])
    return basis, False, False


# Edges of the distances that a band may end at: quarter powers of two.
BAND_STEPS, BAND_LOW = 256, -200


def _counts_task(scaling, models):
    """Task function: rows of each model by the logarithm of their distance from its plane."""

    def run(batches):
        counts = np.zeros((len(models), BAND_STEPS))
        for u, y, base, part, lo in _blocks(batches, scaling, models):
            off = np.abs(y[:, None] - u @ part.beta.T)
            with np.errstate(divide="ignore"):
                step = np.clip(np.ceil(4 * np.log2(off)) - BAND_LOW, 0, BAND_STEPS - 1).astype(np.int64)
            at = (step + np.arange(len(part)) * BAND_STEPS)[base > 0]
            counts[lo : lo + len(part)] += np.bincount(at, minlength=len(part) * BAND_STEPS).reshape(len(part), -1)
        yield pa.RecordBatch.from_pydict({"model": pa.array(range(len(models)), pa.int32()), "m": pa.array(list(counts), pa.list_(pa.float64()))})

    return run


def band_widths(design: Design, models: Models, rows_kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Per model the widest band about its plane that holds at most ``rows_kept`` rows (the
    narrowest one, if that holds more; all rows, if there are no more), and the rows in it."""
    partial = design.read().mapInArrow(_counts_task(design.scaling, models), "model int, m array<double>")
    counts = add_partials(partial, "model", len(models), BAND_STEPS, design.parts).cumsum(axis=1)
    last = np.maximum((counts <= rows_kept).sum(axis=1) - 1, 0)
    width = np.exp2((last + BAND_LOW) / 4)
    whole = counts[:, -1] <= rows_kept
    return np.where(whole, np.inf, width), np.where(whole, counts[:, -1], counts[np.arange(len(models)), last])


def _band_task(scaling, models):
    """Task function: rows within each model's band, as ``[weight, y, u…]``, and the pull of
    those outside it, as ``[u…]``."""

    def run(batches):
        far = np.zeros((len(models), len(scaling[0]) + 1))
        for u, y, base, part, lo in _blocks(batches, scaling, models):
            r = y[:, None] - u @ part.beta.T
            inside = np.abs(r) < part.width[None, :]
            far[lo : lo + len(part)] += (base * ~inside * (part.tau[None, :] - (r < 0))).T @ u
            row, model = np.nonzero(inside & (base > 0))
            if len(row):
                block = np.column_stack([base[row, model], y[row], u[row]])
                yield _banded(lo + model, True, block)
        yield _banded(np.arange(len(models)), False, far)

    return run


def _banded(model, inside: bool, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"model": pa.array(model, pa.int32()), "inside": pa.array([inside] * len(rows), pa.bool_()), "row": pa.array(list(rows), pa.list_(pa.float64()))}
    )


def band_planes(design: Design, models: Models, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The exact plane over each model's band, and whether there is one: a task solves one
    model at a time from that model's rows, and only planes reach the driver."""
    tau, beta, size, many = models.tau, models.beta, design.size, design.count > MANY_ROWS

    def solve(key, table):
        m = key[0].as_py()
        block, pulls = (
            table.filter(mask).column("row").combine_chunks().flatten().to_numpy().reshape(-1, width)
            for mask, width in ((table.column("inside"), size + 2), (pc.invert(table.column("inside")), size))
        )
        far = np.array([math.fsum(column) for column in pulls.T])  # the same sum in any order
        block = block[np.lexsort(block.T[::-1])]  # the same walk under any partitioning
        plane = None if many else _plane_of(block, tau[m], far, beta[m], unit)
        if plane is None:
            plane = _plane_of(_equal_once(block), tau[m], far, beta[m], unit)
        return pa.table({"model": pa.array([m], pa.int32()), "plane": pa.array([plane], pa.list_(pa.float64()))})

    rows = design.read().mapInArrow(_band_task(design.scaling, models), "model int, inside boolean, row array<double>")
    # one model a task: the partitions must not be put together
    dealt = rows.repartition(min(len(models), 2000), "model")
    found = dealt.groupBy("model").applyInArrow(solve, "model int, plane array<double>").collect()
    planes, solved = beta.copy(), np.zeros(len(models), bool)
    for m, plane in found:
        if plane is not None:
            planes[m], solved[m] = plane, True
    return planes, solved


def _equal_once(block):
    """Equal rows of a band as one row of their weights' sum."""
    if not len(block):
        return block
    block = block[np.lexsort(block.T)]
    first = np.flatnonzero(np.r_[True, (block[1:, 1:] != block[:-1, 1:]).any(axis=1)])
    weight = np.add.reduceat(block[:, 0], first)
    return np.column_stack([weight, block[first, 1:]])


#: Models that share a band in one task, and the most rows of such a band.
SHARED, SHARED_ROWS = 12, 2_000_000


def _chunks(models: Models) -> list[tuple[int, int]]:
    """Neighbouring models of one plane, ``(first, end)``, at most ``SHARED`` and never of two parts of a block."""
    new = np.r_[True, (models.beta[1:] != models.beta[:-1]).any(axis=1) | (np.diff(models.tau) != 0)]
    out = []
    for m in range(len(models)):
        if new[m] or m % MODELS_AT_ONCE == 0 or m - out[-1][0] >= SHARED:
            out.append((m, m))
        out[-1] = out[-1][0], m + 1
    return out


def _shared_band_task(scaling, models, chunks):
    """Task function: rows within the band that a chunk of models shares, as ``[y, u…, weights…]``,
    and every model's pull of the rows outside it, as ``[u…]``."""
    names = "chunk", "model", "row"

    def batch(chunk, model, rows):
        flat, width = np.ascontiguousarray(rows, float), rows.shape[1]
        offsets = pa.array(np.arange(0, len(rows) * width + 1, width), pa.int32())
        row = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(c, len(rows)), pa.int32()) for c in (chunk, model)] + [row], names=names)

    def run(batches):
        far = np.zeros((len(models), len(scaling[0]) + 1))
        for u, y, base, part, lo in _blocks(batches, scaling, models):
            own = [(c, a - lo, b - lo) for c, (a, b) in enumerate(chunks) if lo <= a < lo + len(part)]
            first = [a for _, a, _ in own]
            r = y[:, None] - u @ part.beta[first].T
            inside = np.abs(r) < part.width[None, first]
            pull = np.where(inside, 0.0, part.tau[None, first] - (r < 0))
            for i, (c, a, b) in enumerate(own):
                far[lo + a : lo + b] += base[:, a:b].T @ (pull[:, i, None] * u)
                rows = np.flatnonzero(inside[:, i])
                if len(rows):
                    yield batch(c, -1, np.column_stack([y[rows], u[rows], base[rows, a:b]]))
        for c, (a, b) in enumerate(chunks):
            yield batch(c, np.arange(a, b), far[a:b])

    return run


def shared_planes(design: Design, models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Exact planes of many models near few given ones, and which of them are proven.

    Held-out folds and replicates of a level differ from its plane by little: the rows that
    may change side for any of them lie in one band about it, of the root of all rows. Such
    a band is read once for all its models; the rows outside act as one linear term for each
    model. A task solves the models of a chunk from their band, and a pass over all rows
    counts the rows outside that changed side. Models whose count is not 0 are not proven.
    """
    leads, lead = np.unique(np.column_stack([models.tau, models.beta]), axis=0, return_inverse=True)
    order = np.argsort(lead.ravel(), kind="stable")
    models, lead = models.pick(order), lead.ravel()[order]
    keep = int(min(1000 + 20 * np.sqrt(design.size * design.count), SHARED_ROWS))
    width, inside = band_widths(design, replace(Models.grid(design.size, tau=leads[:, 0]), beta=leads[:, 1:]), keep)
    models = replace(models, width=np.where(inside > SHARED_ROWS, 0.0, width)[lead])
    chunks, size, tau, beta = _chunks(models), design.size, models.tau, models.beta

    def solve(key, table):
        first, end = chunks[key[0].as_py()]
        number = table.column("model").to_numpy()
        values = lambda mask: table.filter(pa.array(mask)).column("row").combine_chunks().flatten().to_numpy()
        block = values(number < 0).reshape(-1, 1 + size + end - first)
        block = block[np.lexsort(block.T[::-1])]  # the same search under any partitioning
        planes = []
        for m in range(first, end):
            far = np.array([math.fsum(column) for column in values(number == m).reshape(-1, size).T])
            plane = near_plane(block[:, 1 : size + 1], block[:, 0], block[:, 1 + size + m - first], tau[m], far, beta[m])
            planes.append(None if plane is None else plane.tolist())
        return pa.table({"model": pa.array(range(first, end), pa.int32()), "plane": pa.array(planes, pa.list_(pa.float64()))})

    task = _shared_band_task(design.scaling, models, chunks)
    rows = design.read().mapInArrow(task, "chunk int, model int, row array<double>")
    # one chunk a task: the partitions must not be put together
    found = rows.repartition(min(len(chunks), 2000), "chunk").groupBy("chunk").applyInArrow(solve, "model int, plane array<double>").collect()
    planes, exact = models.beta.copy(), np.zeros(len(models), bool)
    for m, plane in found:
        if plane is not None:
            planes[m], exact[m] = plane, True
    at = np.flatnonzero(exact)
    if len(at):
        now = replace(models, beta=planes, before=models.beta).pick(at)
        _, _, checked = weighted_pass(design, now, turned_step, 0, 0, 2)
        exact[at] = checked[:, 0] == 0
    back = np.argsort(order)
    return planes[back], exact[back]


def near_plane(u, y, w, tau, far, start):
    """Minimise ``Σ w·ρ_τ(y − ub) − far·b`` exactly over the rows of a band: Newton steps on the
    loss with its kink smoothed over fewer and fewer rows, then the exact walk over those next to
    the plane, until no other row changes side. None if the band does not hold the optimum."""
    u, y, w = u[w > 0], y[w > 0], w[w > 0]
    size, b = u.shape[1], start
    if len(y) < size:
        return None
    few = max(20 * size, len(y) ** (2 / 3))
    h = np.abs(y - u @ b).max() + 1e-300

    def smooth(at):
        r = y - u @ at
        near = np.abs(r) < h
        rho = np.where(near, r * r / (4 * h) + h / 4, np.abs(r) / 2) + (tau - 0.5) * r
        return r, near, w @ rho - far @ at

    while True:
        r, near, loss = smooth(b)
        for _ in range(30):
            pull = (w * (tau - 1 + np.clip((r + h) / (2 * h), 0.0, 1.0))) @ u + far
            gram = (u[near] * (w[near] / (2 * h))[:, None]).T @ u[near]
            step = np.linalg.lstsq(gram + 1e-12 * np.trace(gram) / size * np.eye(size), pull, rcond=None)[0]
            for part in 0.5 ** np.arange(12):
                r2, near2, less = smooth(b + part * step)
                if less < loss:
                    break
            else:
                break
            gained, b, r, near, loss = loss - less, b + part * step, r2, near2, less
            if gained <= 1e-10 * abs(loss):
                break
        if near.sum() <= few or h < 1e-12:
            break
        h /= 4
    keep = 100 + 40 * size + int(20 * np.sqrt(size * near.sum()))
    for _ in range(20):
        r = y - u @ b
        off = np.abs(r)
        edge = np.partition(off, keep)[keep] if keep < len(off) else np.inf
        inside = off <= edge
        out = ~inside
        pull = far + (w[out] * (tau - (r[out] < 0))) @ u[out]
        block = _equal_once(np.column_stack([w[inside], y[inside], u[inside]]))
        plane = best_plane(block[:, 2:], block[:, 1], block[:, 0], np.full(len(block), tau), pull, b)
        if plane is not None:
            b = plane
            if not ((y[out] - u[out] @ b > 0) != (r[out] > 0)).any():
                return b
        elif not out.any():
            return None
        keep *= 2
    return None


def turned_step(base, u, y, models):
    """Rows outside the old band that changed side, and the loss."""
    old, new = y - u @ models.before.T, y - u @ models.beta.T
    turned = (np.abs(old) >= models.width[None, :]) & ((old > 0) != (new > 0))
    return [], [base * turned, base * (np.abs(new) / 2 + (models.tau[None, :] - 0.5) * new)]


def finish_quantiles(
    design: Design, models: Models, loss: np.ndarray, held: np.ndarray, lam: float = 0.0, most_rows: int = 200_000
) -> tuple[Models, np.ndarray]:
    """Exact optima near given planes, proven over all rows.

    Rows far from a plane keep their side, so they act as one linear term; the
    rest is a small exact problem over the rows in a band, which a task solves for
    each model. A pass then counts the far rows that changed side: none means the
    optimum over all rows is found, else the new plane starts another round. Planes
    settled with ``held`` rows in their smooth band are off by some multiple of the root
    of that. A round that proves no model and improves none looks at four times as many
    rows. Raises when the ``most_rows`` rows around a plane do not hold the proof.
    """
    size = design.size
    keep = 100 + 40 * size
    if design.count > MANY_ROWS:
        keep = int(min(keep + 20 * np.sqrt(size * held.max(initial=0.0)), most_rows))
    unit = np.concatenate([[0.0], lam / design.scale])
    beta, loss = models.beta.copy(), loss / design.y_scale
    exact = np.zeros(len(models), bool)
    while not exact.all():
        at = np.flatnonzero(~exact)
        part = replace(models, beta=beta).pick(at)
        width, inside = band_widths(design, part, keep)
        if inside.max() > most_rows:
            raise RuntimeError(f"{int(inside.max())} rows lie next to a quantile's plane")
        part = replace(part, width=width)
        planes, solved = band_planes(design, part, unit)
        _, _, checked = weighted_pass(design, replace(part, beta=planes, before=part.beta), turned_step, 0, 0, 2)
        now = checked[:, 1] + (np.abs(planes) * unit).sum(axis=1)
        proven = solved & (checked[:, 0] == 0)
        better = proven | (solved & (now < loss[at] * (1 - 1e-12)))
        beta[at[better]], loss[at[better]] = planes[better], now[better]
        exact[at[proven]] = True
        if not better.any():
            if keep >= most_rows or all(np.isinf(width)):
                raise RuntimeError("a quantile fit could not be proven exact")
            keep = min(4 * keep, most_rows)
    return replace(models, beta=beta), loss * design.y_scale


def _plane_of(block, tau, far, start, unit):
    """The exact plane for one model's band, with the L1 penalty as extra rows."""
    u, y, w = block[:, 2:], block[:, 1], block[:, 0]
    level = np.full(len(block), tau)
    if unit.any():
        extra = len(unit) - 1
        u, y = np.concatenate([u, np.diag(unit)[1:]]), np.concatenate([y, np.zeros(extra)])
        w, level = np.concatenate([w, np.full(extra, 2.0)]), np.concatenate([level, np.full(extra, 0.5)])
    return best_plane(u, y, w, level, far, start)


# --- generalised linear steps --------------------------------------------------------


def _binomial(eta, y):
    mu = 1 / (1 + np.exp(-np.clip(eta, -35, 35)))
    fit = np.where(y > 0, -np.log(mu) * y, 0.0) + np.where(y < 1, -np.log1p(-mu) * (1 - y), 0.0)
    return mu, np.maximum(mu * (1 - mu), 1e-10), 2 * fit


def _poisson(eta, y):
    mu = np.exp(np.clip(eta, -30, 30))
    ratio = np.where(y > 0, y * np.log(np.where(y > 0, y, 1.0) / mu), 0.0)
    return mu, mu, 2 * (ratio - (y - mu))


def _gaussian(eta, y):
    return eta, np.ones_like(eta), (y - eta) ** 2


FAMILIES = {"binomial": _binomial, "poisson": _poisson, "gaussian": _gaussian}


def glm_step(family: str) -> Step:
    curve = FAMILIES[family]

    def step(base, u, y, models):
        eta = u @ models.beta.T
        mu, w, deviance = curve(eta, y + 0 * eta)
        return [(base * w, base * (w * eta + (y - mu)))], [base * deviance, base, base * y]

    return step


def mean_response(eta, family: str):
    """Inverse link as a column expression."""
    if family == "binomial":
        return 1 / (1 + F.exp(-eta))
    return F.exp(eta) if family == "poisson" else eta


def start_glm(models: Models, mean: np.ndarray, family: str) -> Models:
    """Intercept-only start: the link of each training mean."""
    if family == "binomial":
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        first = np.log(mean / (1 - mean))
    elif family == "poisson":
        first = np.log(np.maximum(mean, 1e-6))
    else:
        first = mean
    beta = np.zeros_like(models.beta)
    beta[:, 0] = first
    return replace(models, beta=beta)


def soft_solve(
    gram: np.ndarray, rhs: np.ndarray, penalty: np.ndarray, start: np.ndarray, tol: float = 1e-11, sweeps: int = 200_000
) -> np.ndarray:
    """Minimise ``½bᵀGb − vᵀb + Σ penalty·|b|`` for all models at once, by coordinates.

    A pull within rounding of the penalty leaves the coefficient at 0. Raises if
    the coordinates have not settled after ``sweeps`` rounds.
    """
    b = start.copy()
    diag = np.einsum("mii->mi", gram)
    usable = diag > 1e-14
    g = rhs - np.einsum("mij,mj->mi", gram, b)
    edge = penalty * (1 + 1e-9)
    for _ in range(sweeps):
        moved = 0.0
        for j in range(b.shape[1]):
            z = g[:, j] + diag[:, j] * b[:, j]
            new = np.where(np.abs(z) > edge[:, j], z - np.sign(z) * penalty[:, j], 0.0)
            new = np.where(usable[:, j], new / np.where(usable[:, j], diag[:, j], 1.0), 0.0)
            change = new - b[:, j]
            b[:, j] = new
            g -= gram[:, :, j] * change[:, None]
            moved = max(moved, np.abs(change).max(initial=0.0))
        if moved < tol * max(1.0, np.abs(b).max(initial=0.0)):
            return b
    raise RuntimeError("penalised coefficients do not settle")


def fit_glm(
    design: Design, models: Models, family: str, penalty: np.ndarray | None = None, passes: int = 100, tol: float = 1e-9
) -> tuple[Models, np.ndarray, np.ndarray]:
    """Coefficients, deviance and row count per model.

    ``penalty`` [model, term] is an L1 weight on the scaled slopes, relative to
    the mean log-likelihood; without it the steps are ordinary scoring. A step
    that raises a model's objective is halved. Raises if a model has not
    converged after ``passes`` steps, as with labels that the terms separate.
    """
    _, _, scalars = weighted_pass(design, models, glm_step(family), 1, 1, 3)
    n = np.maximum(scalars[:, 1], 1)
    models = start_glm(models, scalars[:, 2] / n, family)
    weight = np.zeros((len(n), design.size))
    if penalty is not None:
        weight[:, 1:] = penalty
    best, least = models.beta, np.full(len(n), np.inf)
    deviance, done = np.zeros(len(n)), np.zeros(len(n), bool)
    for _ in range(passes):
        (gram,), (rhs,), scalars = weighted_pass(design, models, glm_step(family), 1, 1, 3)
        now = scalars[:, 0] / 2 + n * (weight * np.abs(models.beta)).sum(axis=1)
        worse = ~(now <= least + tol * (np.abs(least) + 0.1)) & np.isfinite(least)
        settled = np.isfinite(least) & ~worse & (np.abs(least - now) <= tol * (np.abs(now) + 0.1))
        done |= settled
        better = ~worse
        best = np.where(better[:, None], models.beta, best)
        least, deviance = np.where(better, now, least), np.where(better, scalars[:, 0], deviance)
        if done.all():
            if penalty is None and family == "binomial" and (least <= 1e-6 * n).any():
                raise RuntimeError(f"the {family} model does not converge: do the terms separate the labels?")
        if penalty is None:
            beta = solve_all(gram, rhs)
        else:
            beta = soft_solve(gram / n[:, None, None], rhs / n[:, None], weight, models.beta)
        if done.all():
            return replace(models, beta=beta), deviance, scalars[:, 1]
        beta = np.where(worse[:, None], (models.beta + best) / 2, beta)
        models = replace(models, beta=np.where(done[:, None], best, beta))
    raise RuntimeError(f"the {family} model does not converge: do the terms separate the labels?")
