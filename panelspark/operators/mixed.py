"""Mixed-effects models from per-group sums.

A model has one grouping with a random intercept (and slopes) whose number of
levels may grow with the data, and optionally a crossed or enclosing factor
with a random intercept and a bounded number of levels. The rows are reduced
once to sums per (group, crossed level, fold). For given relative covariances
every group adds a small matrix, so one pass over the group table scores many
candidate covariances of many models (folds, reduced models) together; only
matrices of the size (terms + crossed levels)² reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from panelspark.functions import dist
from panelspark.operators.clean import left_join_on
from panelspark.operators.design import ModelSpec, design_rows
from panelspark.operators.gram import add_partials, collect_moments, packed_pairs, quoted
from panelspark.operators.linear import INTERCEPT, independent_columns, linear_predictor
from panelspark.session import pinned, reused

MAX_CROSSED = 2000
# Sums that one pass keeps in a task: as many points are scored at once as fit.
AT_ONCE = 8_000_000
QUIET = 6


@dataclass(frozen=True)
class MixedSpec:
    """Fixed part plus ``(1 + slope | group)`` and ``(1 | crossed)``.

    A nested intercept ``(1 | a / b)`` is ``group=["a", "b"], crossed="a"``.
    """

    fixed: ModelSpec
    group: Sequence[str]
    crossed: str | None = None
    slope: str | None = None

    @property
    def random_terms(self) -> list[str]:
        return [INTERCEPT] + ([self.slope] if self.slope else [])


@dataclass(frozen=True)
class Variant:
    """One model of a joint search: a held-out fold and the random parts it has."""

    fold: int = -1
    intercept: bool = True
    slope: bool = True
    crossed: bool = True


@dataclass
class Solution:
    """A fitted variant, on the conditioned scale of the design."""

    variant: Variant
    n: float
    lam: np.ndarray
    theta: float
    beta: np.ndarray
    cov: np.ndarray
    sigma2: float
    deviance: float
    modes: np.ndarray
    mode_cov: np.ndarray


@dataclass
class Prepared:
    """Group table and bounded totals of one mixed model."""

    spec: MixedSpec
    groups: DataFrame
    rows: DataFrame
    terms: list[str]
    shift: np.ndarray
    y_shift: float
    z_shift: float
    z_scale: float
    levels: list
    fixed_by_fold: dict
    crossed_by_fold: dict
    zz: np.ndarray
    fold: str | None = None
    parts: int = 1 << 30
    passes: int = field(default=0)

    @property
    def r(self) -> int:
        return 2 if self.spec.slope else 1

    @property
    def p1(self) -> int:
        return len(self.terms) + 1

    def fixed(self, fold: int) -> np.ndarray:
        return sum(m for k, m in self.fixed_by_fold.items() if k != fold)

    def between(self, fold: int) -> np.ndarray:
        """Sums of [1, x, y] per crossed level."""
        start = np.zeros((len(self.levels), self.p1 + 1))
        return sum((m for k, m in self.crossed_by_fold.items() if k != fold), start)


def _design(df: DataFrame, spec: MixedSpec, fold: str | None) -> DataFrame:
    keep = [*spec.group, *([spec.crossed] if spec.crossed else []), *([spec.slope] if spec.slope else [])]
    keep = list(dict.fromkeys(c for c in keep if c not in spec.fixed.terms))
    rows = design_rows(df, spec.fixed, [*keep, fold] if fold else keep)
    return rows.na.drop("any", subset=keep)


def prepare_mixed(rows: DataFrame, spec: MixedSpec, fold: str | None = None) -> Prepared:
    """Reduce design rows to sums per (group, crossed level, fold)."""
    label = spec.fixed.label
    keyed = rows.withColumn("__fold", F.col(fold).cast("int") if fold else F.lit(-2))
    moments = collect_moments(keyed, [*spec.fixed.terms, label], ["__fold"])
    s = moments.total[1:-1, 1:-1] - np.outer(moments.total[0, 1:-1], moments.total[0, 1:-1]) / moments.total[0, 0]
    kept = independent_columns(s)
    terms = [spec.fixed.terms[j] for j in kept]
    at = np.array([0, *[j + 1 for j in kept], len(spec.fixed.terms) + 1])
    shift, y_shift = moments.shift[:-1][kept], float(moments.shift[-1])

    z_shift, z_scale = 0.0, 1.0
    if spec.slope:
        row = rows.agg(F.avg(quoted(spec.slope)), F.stddev_pop(quoted(spec.slope))).first()
        z_shift, z_scale = float(row[0]), float(row[1]) or 1.0

    levels = _levels(rows, spec.crossed)
    if spec.crossed:
        table = rows.sparkSession.createDataFrame(list(zip(levels, range(len(levels)), strict=True)),
            keyed.select(F.col(spec.crossed).alias("__level")).schema.add("__s", T.IntegerType()))
        # at most MAX_CROSSED rows
        keyed = keyed.join(F.broadcast(table), F.col(spec.crossed) == F.col("__level"))
    else:
        keyed = keyed.withColumn("__s", F.lit(0))

    z = [F.lit(1.0)] + ([(F.col(quoted(spec.slope)) - z_shift) / z_scale] if spec.slope else [])
    u = [F.lit(1.0)] + [F.col(quoted(t)) - F.lit(float(m)) for t, m in zip(terms, shift, strict=True)]
    u.append(F.col(quoted(label)) - F.lit(y_shift))
    sums = [F.sum(a * b) for i, a in enumerate(z) for b in z[i:]] + [F.sum(a * b) for a in z for b in u]
    cells = keyed.groupBy(*spec.group, "__s", "__fold").agg(F.array(*sums).alias("__sums"))
    # a group has at most (crossed levels × folds) cells
    groups = cells.groupBy(*spec.group).agg(
        F.collect_list("__s").alias("__s"), F.collect_list("__fold").alias("__fold"),
        F.flatten(F.collect_list("__sums")).alias("__sums"),
    )
    return Prepared(
        spec, groups, rows, terms, shift, y_shift, z_shift, z_scale, levels,
        {k[0]: m[np.ix_(at, at)] for k, m in moments.by_key.items()}, {}, np.zeros((1, 1)), fold,
    )


def _levels(rows: DataFrame, crossed: str | None) -> list:
    if not crossed:
        return []
    found = rows.select(crossed).distinct().orderBy(crossed).limit(MAX_CROSSED + 1).collect()
    if len(found) > MAX_CROSSED:
        raise ValueError(f"{crossed} has more than {MAX_CROSSED} levels: make it the grouping factor instead")
    return [r[0] for r in found]


def _unpack(batch: pa.RecordBatch, r: int, width: int):
    """Cells of a batch of groups: group index, level, fold, ZᵀZ and Zᵀ[1, x, y]."""
    s, fold, sums = (batch.column(c) for c in ("__s", "__fold", "__sums"))
    counts = np.diff(s.offsets.to_numpy())
    owner = np.repeat(np.arange(batch.num_rows), counts)
    flat = sums.flatten().to_numpy(zero_copy_only=False).reshape(len(owner), -1)
    pairs = packed_pairs(r)
    zz = np.zeros((len(owner), r, r))
    for c, (i, j) in enumerate(pairs):
        zz[:, i, j] = zz[:, j, i] = flat[:, c]
    zu = flat[:, len(pairs) :].reshape(len(owner), r, width)
    return owner, s.flatten().to_numpy(), fold.flatten().to_numpy(), zz, zu


def _group_blocks(cells, groups: int, fold: int, levels: int):
    """Per group, over the cells outside a fold: A = ZᵀZ and B = Zᵀ[1, x, y, crossed]."""
    owner, s, cell_fold, zz, zu = cells
    use = cell_fold != fold
    r, width = zz.shape[1], zu.shape[2]
    a = np.zeros((groups, r, r))
    b = np.zeros((groups, r, width + levels))
    np.add.at(a, owner[use], zz[use])
    np.add.at(b[:, :, :width], owner[use], zu[use])
    if levels:
        at = (owner[use], slice(None), width + s[use])
        np.add.at(b, at, zz[use][:, :, 0])
    return a, b


def relative_factor(params: np.ndarray, r: int) -> np.ndarray:
    """Lower-triangular relative covariance factor."""
    if r == 1:
        return np.array([[params[0]]])
    return np.array([[params[0], 0.0], [params[1], params[2]]])


def _absorbed(a: np.ndarray, lam: np.ndarray):
    """``Λ(I + ΛᵀAΛ)⁻¹Λᵀ`` and its log-determinant, per group."""
    inner = np.eye(len(lam)) + lam.T @ a @ lam
    return lam @ np.linalg.solve(inner, np.broadcast_to(lam.T, inner.shape)), np.linalg.slogdet(inner)[1]


def evaluate(p: Prepared, points: Sequence[tuple[Variant, np.ndarray]]) -> list[tuple[np.ndarray, float]]:
    """``ΣBᵀCB`` and the summed log-determinant for every (variant, Λ): one pass over the groups
    for as many points as ``AT_ONCE`` values hold, which bounds a task's sums and the driver's."""
    most = max(1, AT_ONCE // ((p.p1 + 1 + len(p.levels)) * (p.p1 + 2 + len(p.levels)) // 2 + 1))
    if len(points) > most:
        parts = [evaluate(p, points[lo : lo + most]) for lo in range(0, len(points), most)]
        return [piece for part in parts for piece in part]
    p.passes += 1
    r, width, levels = p.r, p.p1 + 1, len(p.levels)
    size = width + levels
    upper = np.triu_indices(size)
    work: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, (variant, params) in enumerate(points):
        work.setdefault(variant.fold, []).append((i, relative_factor(params, r)))
    count = len(points)

    def run(batches):
        out = np.zeros((count, len(upper[0]) + 1))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cells = _unpack(batch, r, width)
            for fold, items in work.items():
                a, b = _group_blocks(cells, batch.num_rows, fold, levels)
                flat = b.reshape(-1, size)
                for i, lam in items:
                    c, logdet = _absorbed(a, lam)
                    out[i, :-1] += (flat.T @ (c @ b).reshape(-1, size))[upper]
                    out[i, -1] += logdet.sum()
        yield pa.RecordBatch.from_pydict(
            {"point": pa.array(range(count), pa.int32()), "m": pa.array(list(out), pa.list_(pa.float64()))}
        )

    partial = p.groups.select("__s", "__fold", "__sums").mapInArrow(run, "point int, m array<double>")
    flat = add_partials(partial, "point", count, len(upper[0]) + 1, p.parts)
    out = []
    for i in range(count):
        q = np.zeros((size, size))
        q[upper] = flat[i, :-1]
        out.append((q + np.triu(q, 1).T, float(flat[i, -1])))
    return out


def _totals(p: Prepared) -> None:
    """Sums per crossed level and fold, and ZᵀZ: bounded by levels × folds."""
    r, width, levels = p.r, p.p1 + 1, len(p.levels)

    def run(batches):
        level, by_fold, a = {}, {}, np.zeros((r, r))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            _, s, fold, zz, zu = _unpack(batch, r, width)
            a += zz.sum(axis=0)
            for k in np.unique(fold):
                block = level.setdefault(int(k), np.zeros((max(levels, 1), width)))
                np.add.at(block, s[fold == k], zu[fold == k][:, 0, :])
        by_fold = {-9: a.ravel(), **{k: m.ravel() for k, m in level.items()}}
        yield pa.RecordBatch.from_pydict(
            {"fold": pa.array(list(by_fold), pa.int32()), "m": pa.array(list(by_fold.values()), pa.list_(pa.float64()))}
        )

    table = (
        p.groups.select("__s", "__fold", "__sums")
        .mapInArrow(run, "fold int, m array<double>")
        .select("fold", F.posexplode("m").alias("pos", "value"))
        .groupBy("fold", "pos")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    found: dict[int, np.ndarray] = {}
    for fold, pos, value in table:
        size = r * r if fold == -9 else max(levels, 1) * width
        found.setdefault(fold, np.zeros(size))[pos] = value
    p.zz = found.pop(-9).reshape(r, r)
    if levels:
        p.crossed_by_fold = {k: m.reshape(levels, width) for k, m in found.items()}


def _reduced(p: Prepared, variant: Variant, q: np.ndarray):
    """``WᵀV⁻¹W`` for W = [1, x, y, crossed] after absorbing the groups."""
    width = p.p1 + 1
    size = width + len(p.levels)
    m = np.zeros((size, size))
    m[:width, :width] = p.fixed(variant.fold)
    if p.levels:
        between = p.between(variant.fold)
        m[width:, :width], m[:width, width:] = between, between.T
        m[width:, width:] = np.diag(between[:, 0])
    return m - q


def _spectrum(p: Prepared, m: np.ndarray):
    """What every crossed ratio needs of ``m``, worked out once: sums of [1, x, y], and the
    eigenvalues and rotated sums of the crossed levels."""
    width = p.p1 + 1
    if not p.levels:
        return m[:width, :width], np.zeros(0), np.zeros((0, width))
    values, vectors = np.linalg.eigh(m[width:, width:])
    return m[:width, :width], np.maximum(values, 0.0), vectors.T @ m[width:, :width]


def _at_thetas(spectrum, logdet: float, thetas: np.ndarray):
    """Log-determinant, ``XᵀV⁻¹X``, coefficients and RSS for several crossed ratios at once."""
    f, values, g = spectrum
    square = thetas[:, None] ** 2
    f = f - np.einsum("tk,ki,kj->tij", square / (1 + square * values), g, g)
    logdets = logdet + np.log1p(square * values).sum(axis=1)
    xx, xy, yy = f[:, :-1, :-1], f[:, :-1, -1], f[:, -1, -1]
    beta = np.linalg.solve(xx, xy[..., None])[..., 0]
    rss = np.maximum(yy - np.einsum("ti,ti->t", xy, beta), 1e-300)
    return logdets, xx, beta, rss


def _deviances(logdets: np.ndarray, xx: np.ndarray, rss: np.ndarray, n: float, reml: bool) -> np.ndarray:
    if reml:
        df = n - xx.shape[-1]
        return logdets + np.linalg.slogdet(xx)[1] + df * (1 + np.log(2 * math.pi * rss / df))
    return logdets + n * (1 + np.log(2 * math.pi * rss / n))


THETAS = np.concatenate([[0.0], np.exp(np.linspace(math.log(1e-3), math.log(1e3), 41))])


def _best_theta(spectrum, logdet: float, score, thetas: np.ndarray = THETAS, fine: bool = True) -> tuple[float, float]:
    """Least score over the crossed ratios for a given Λ, and its ratio: no pass over data.

    ``score`` takes what ``_at_thetas`` gives."""
    grid = thetas if len(spectrum[1]) else np.zeros(1)
    values = score(*_at_thetas(spectrum, logdet, grid))
    at = int(values.argmin())
    best = (float(values[at]), float(grid[at]))
    for _ in range(9 if fine and len(grid) > 1 else 0):
        lo, hi = grid[max(at - 1, 0)], grid[min(at + 1, len(grid) - 1)]
        grid = np.linspace(lo, hi, 17)
        values = score(*_at_thetas(spectrum, logdet, grid))
        at = int(values.argmin())
        best = min(best, (float(values[at]), float(grid[at])))
    return best


def _by_deviance(p: Prepared, variant: Variant, reml: bool):
    n = p.fixed(variant.fold)[0, 0]
    return lambda logdets, xx, beta, rss: _deviances(logdets, xx, rss, n, reml)


def _thetas(variant: Variant) -> np.ndarray:
    return THETAS if variant.crossed else np.zeros(1)


def _free(variant: Variant, r: int) -> list[int]:
    if not variant.intercept:
        return []
    return [0, 1, 2] if r == 2 and variant.slope else [0]


def _coarse(free: list[int], r: int) -> list[np.ndarray]:
    size = 1 if r == 1 else 3
    if not free:
        return [np.zeros(size)]
    if len(free) == 1:
        values = [0.0, *np.exp(np.linspace(math.log(0.01), math.log(30), 25))]
        return [np.array([v] + [0.0] * (size - 1)) for v in values]
    steps = (0.03, 0.1, 0.3, 1.0, 3.0)
    return [np.array([a, tilt * c, c]) for a in steps for c in steps for tilt in (-0.6, 0.0, 0.6)]


def _stencil(centre: np.ndarray, h: float, free: list[int]) -> list[np.ndarray]:
    if not free:
        return [centre]
    if len(free) == 1:
        offsets = [np.array([v]) for v in np.linspace(-1, 1, 9)]
    else:
        offsets = [np.array(o, float) for o in np.ndindex(3, 3, 3)]
        offsets = [o - 1 for o in offsets]
    out = []
    for o in offsets:
        point = centre.copy()
        point[free] += h * o
        out.append(point)
    return out


def _step(gradient: np.ndarray, hess: np.ndarray, radius: float) -> np.ndarray:
    """The least point of a quadratic within ``radius``, also of one that has no minimum."""
    values, vectors = np.linalg.eigh(hess)
    slope = vectors.T @ gradient

    def at(shift: float) -> np.ndarray:
        return -slope / np.maximum(values + shift, 1e-12 * (1 + np.abs(values).max()))

    if values[0] > 0 and np.linalg.norm(at(0.0)) <= radius:
        return vectors @ at(0.0)
    low = max(0.0, -values[0])
    high = low + np.linalg.norm(slope) / radius + 1e-300
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if np.linalg.norm(at(middle)) > radius else (low, middle)
    return vectors @ at(high)


def _next_centre(points: list[np.ndarray], values: list[float], centre: np.ndarray, h: float, free: list[int]):
    """Next centre, stencil size and predicted gain: the least point, within two stencils,
    of the quadratic through the stencil."""
    x = np.array([(q - centre)[free] / h for q in points])
    d = x.shape[1]
    pairs = packed_pairs(d)
    basis = np.column_stack([np.ones(len(x)), x, *[x[:, i] * x[:, j] for i, j in pairs]])
    coef = np.linalg.lstsq(basis, np.array(values) - min(values), rcond=None)[0]
    hess = np.zeros((d, d))
    for c, (i, j) in enumerate(pairs):
        hess[i, j] = hess[j, i] = coef[1 + d + c] * (2 if i == j else 1)
    step = _step(coef[1 : d + 1], hess, 2.0)
    moved = centre.copy()
    moved[free] += h * step
    gain = -(coef[1 : d + 1] @ step + step @ hess @ step / 2)
    reach = np.linalg.norm(step)
    return moved, h * (0.15 if reach <= 0.7 else 0.6 if reach < 1.99 else 1.4), float(gain)


def _settle(state: dict, free: dict, score, rounds: int, tol: float) -> None:
    """Move every ``[centre, stencil size]`` of ``state`` to the least score nearby; all share each pass.

    Every round scores a small stencil around each centre and moves to the minimum of the
    quadratic through it, until the predicted gain or the stencil is tiny, or ``QUIET``
    rounds in a row have gained next to nothing (with a variance of zero, whole curves of
    points have the same score). A stencil without a point as good as the best so far is
    given up for a smaller one around that. Raises if the search has not ended after
    ``rounds`` rounds. ``score`` takes ``(key, point)`` pairs.
    """
    open_ = [i for i in state if free[i]]
    best, least, quiet = {}, dict.fromkeys(open_, math.inf), dict.fromkeys(open_, 0)
    for _ in range(rounds):
        if not open_:
            return
        points = [(i, x) for i in open_ for x in _stencil(state[i][0], state[i][1], free[i])]
        scored = score(points)
        still = []
        for i in open_:
            rows = [k for k in range(len(points)) if points[k][0] == i]
            values = [scored[k] for k in rows]
            if min(values) > least[i] + 1e-9:
                state[i] = [best[i], state[i][1] * 0.3]
                gain = math.inf
            else:
                quiet[i] = quiet[i] + 1 if min(values) > least[i] - 1e-9 else 0
                if min(values) <= least[i]:
                    best[i], least[i] = points[rows[int(np.argmin(values))]][1], min(values)
                *state[i], gain = _next_centre([points[k][1] for k in rows], values, state[i][0], state[i][1], free[i])
            if gain <= 1e-9:
                continue
            if state[i][1] <= tol * (1 + np.abs(state[i][0]).max()) or quiet[i] >= QUIET:
                state[i][0] = best[i]
            else:
                still.append(i)
        open_ = still
    if open_:
        raise RuntimeError("the variance parameters do not settle")


def _first_state(x: np.ndarray) -> list:
    return [x, max(0.35 * np.abs(x).max(), 0.02)]


def search(
    p: Prepared, variants: Sequence[Variant], reml: bool = True, rounds: int = 200, tol: float = 1e-6,
) -> list[Solution]:
    """Λ with the least deviance for every variant; all variants share each pass.

    A coarse grid gives the first centres, then ``_settle`` moves them.
    """
    r = p.r
    free = {i: _free(v, r) for i, v in enumerate(variants)}

    def score(points, fine=True):
        pieces = evaluate(p, [(variants[i], x) for i, x in points])
        return [
            _best_theta(_spectrum(p, _reduced(p, variants[i], q)), ld, _by_deviance(p, variants[i], reml), _thetas(variants[i]), fine)[0]
            for (i, _), (q, ld) in zip(points, pieces, strict=True)
        ]

    points = [(i, x) for i in free for x in _coarse(free[i], r)]
    scored = score(points, fine=False)
    state = {}
    for i in free:
        mine = [(scored[k], points[k][1]) for k in range(len(points)) if points[k][0] == i]
        state[i] = _first_state(min(mine, key=lambda item: item[0])[1])
    _settle(state, free, score, rounds, tol)
    final = [state[i][0] for i in range(len(variants))]
    pieces = evaluate(p, list(zip(variants, final, strict=True)))
    return [
        _solve(p, v, lam, q, logdet, reml) for v, lam, (q, logdet) in zip(variants, final, pieces, strict=True)
    ]


def _solve(p: Prepared, variant: Variant, lam: np.ndarray, q: np.ndarray, logdet: float, reml: bool) -> Solution:
    m, n = _reduced(p, variant, q), p.fixed(variant.fold)[0, 0]
    spectrum = _spectrum(p, m)
    deviance, theta = _best_theta(spectrum, logdet, _by_deviance(p, variant, reml), _thetas(variant))
    width = p.p1 + 1
    _, xx, beta, rss = (part[0] for part in _at_thetas(spectrum, logdet, np.array([theta])))
    sigma2 = float(rss) / (n - len(xx) if reml else n)
    levels = len(p.levels)
    mode_cov = np.zeros((levels, levels))
    modes = np.zeros(levels)
    if levels and theta > 0:
        mode_cov = theta**2 * np.linalg.inv(np.eye(levels) + theta**2 * m[width:, width:])
        modes = mode_cov @ (m[width:, width - 1] - m[width:, : p.p1] @ beta)
    return Solution(
        variant, n, relative_factor(lam, p.r), theta, beta, sigma2 * np.linalg.inv(xx), sigma2, deviance, modes, mode_cov,
    )


# --- results ---------------------------------------------------------------------


def _original(p: Prepared, s: Solution) -> np.ndarray:
    """Fixed effects with the intercept moved back to the original scale."""
    b = s.beta.copy()
    b[0] = s.beta[0] + p.y_shift - s.beta[1:] @ p.shift
    return b


def _group_map(p: Prepared) -> np.ndarray:
    """Random effects on the conditioned slope → effects on the original one."""
    if p.r == 1:
        return np.eye(1)
    return np.array([[1.0, -p.z_shift / p.z_scale], [0.0, 1.0 / p.z_scale]])


@dataclass
class MixedFit:
    prepared: Prepared
    solution: Solution

    def coefficients(self, level: float = 0.95, profile: bool = True) -> DataFrame:
        """Fixed effects with standard errors and (profile) intervals; aliased terms are null."""
        p, s = self.prepared, self.solution
        move = np.eye(p.p1)
        move[0, 1:] = -p.shift
        se = np.sqrt(np.diag(move @ s.cov @ move.T))
        beta = _original(p, s)
        z = dist.normal_ppf(0.5 + level / 2)
        ends = profile_intervals(p, s, level) if profile else np.stack([beta - z * se, beta + z * se], axis=1)
        found = dict(zip([INTERCEPT, *p.terms], zip(beta, se, ends, strict=True), strict=True))
        rows = []
        for term in [INTERCEPT, *p.spec.fixed.terms]:
            if term in found:
                b, e, (lo, hi) = found[term]
                rows.append((term, float(b), float(e), float(b / e), float(lo), float(hi)))
            else:
                rows.append((term, None, None, None, None, None))
        return p.rows.sparkSession.createDataFrame(
            rows, "term string, estimate double, std_error double, t_value double, ci_low double, ci_high double"
        )

    def covariance(self) -> np.ndarray:
        """Covariance of the group effects on the original scale."""
        p, s = self.prepared, self.solution
        t = _group_map(p)
        return s.sigma2 * t @ s.lam @ s.lam.T @ t.T

    def variances(self) -> DataFrame:
        p, s = self.prepared, self.solution
        g = self.covariance()
        name = ":".join(p.spec.group)
        rows = [(name, t, float(g[i, i])) for i, t in enumerate(p.spec.random_terms)]
        if p.r == 2:
            rows.append((name, f"cov({INTERCEPT},{p.spec.slope})", float(g[0, 1])))
        if p.spec.crossed:
            rows.append((p.spec.crossed, INTERCEPT, float(s.sigma2 * s.theta**2)))
        rows.append(("Residual", "", float(s.sigma2)))
        return p.rows.sparkSession.createDataFrame(rows, "factor string, term string, variance double")

    def r_squared(self) -> DataFrame:
        """Marginal and conditional R²; with a slope, the mean variance over the rows."""
        p, s = self.prepared, self.solution
        m = p.fixed(s.variant.fold)
        n, mean = m[0, 0], m[0, 1:-1] / m[0, 0]
        spread = (m[1:-1, 1:-1] - n * np.outer(mean, mean)) / (n - 1)
        fixed = float(s.beta[1:] @ spread @ s.beta[1:])
        random = float(np.trace(s.lam @ s.lam.T @ p.zz) / n * s.sigma2 + s.sigma2 * s.theta**2)
        whole = fixed + random + s.sigma2
        return p.rows.sparkSession.createDataFrame(
            [(float(fixed / whole), float((fixed + random) / whole))], "r2_marginal double, r2_conditional double"
        )

    def modes(self) -> DataFrame:
        """``(factor, grp, term, condval, condsd)`` for every level of both factors."""
        p, s = self.prepared, self.solution
        spark = p.rows.sparkSession
        name = ":".join(p.spec.group)
        grp = F.concat_ws(":", *[F.col(c).cast("string") for c in p.spec.group])
        terms = F.array(*[F.lit(t) for t in p.spec.random_terms])
        long = (
            group_modes(p, [s])
            .select(F.lit(name).alias("factor"), grp.alias("grp"), F.posexplode("effects").alias("at", "e"))
            .select("factor", "grp", terms[F.col("at")].alias("term"), F.col("e")[0].alias("condval"), F.col("e")[1].alias("condsd"))
        )
        if not p.spec.crossed:
            return long
        sd = np.sqrt(s.sigma2 * np.diag(s.mode_cov))
        rows = [
            (p.spec.crossed, str(v), INTERCEPT, float(u), float(e))
            for v, u, e in zip(p.levels, s.modes, sd, strict=True)
        ]
        return long.unionByName(spark.createDataFrame(rows, long.schema))

    def predict(self) -> DataFrame:
        """Design rows with the fitted value, random effects included."""
        return predict_mixed(self.prepared, [self.solution])


def group_modes(p: Prepared, solutions: Sequence[Solution]) -> DataFrame:
    """``(group…, fold, effects [[mode, sd] per random term])``, one pass over the group table."""
    r, width, levels, p1 = p.r, p.p1 + 1, len(p.levels), p.p1
    t = _group_map(p)
    keys = list(p.spec.group)
    schema = p.groups.select(*keys).schema.add("fold", T.IntegerType()).add(
        "effects", T.ArrayType(T.ArrayType(T.DoubleType()))
    )
    arrow_schema = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cells = _unpack(batch, r, width)
            for s in solutions:
                a, b = _group_blocks(cells, batch.num_rows, s.variant.fold, levels)
                c, _ = _absorbed(a, s.lam)
                left = b[:, :, width - 1] - b[:, :, :p1] @ s.beta
                spread = c.copy()
                if levels:
                    left = left - b[:, :, width:] @ s.modes
                    cross = c @ b[:, :, width:]
                    spread = spread + cross @ s.mode_cov @ cross.transpose(0, 2, 1)
                mode = np.einsum("grs,gs->gr", c, left) @ t.T
                sd = np.sqrt(s.sigma2 * np.einsum("ir,grs,is->gi", t, spread, t))
                data = {k: batch.column(k) for k in keys}
                data["fold"] = [s.variant.fold] * batch.num_rows
                data["effects"] = np.stack([mode, sd], axis=2).tolist()
                yield pa.RecordBatch.from_pydict(data, schema=arrow_schema)

    return p.groups.mapInArrow(run, schema)


def predict_mixed(p: Prepared, solutions: Sequence[Solution], out: str = "pred") -> DataFrame:
    """Fitted values; levels not seen in training get effect 0."""
    spark = p.rows.sparkSession
    held = p.fold is not None and solutions[0].variant.fold >= 0
    rows = p.rows.withColumn("__fold", F.col(p.fold).cast("int") if held else F.lit(-1))
    table = spark.createDataFrame(
        [(s.variant.fold, [float(v) for v in _original(p, s)]) for s in solutions], "__fold int, __b array<double>"
    )
    # one row per model
    rows = left_join_on(rows, F.broadcast(table), ["__fold"])
    pred = linear_predictor(F.col("__b"), p.terms)
    if p.spec.crossed:
        seen = [
            (s.variant.fold, v, float(u)) for s in solutions for v, u in zip(p.levels, s.modes, strict=True)
        ]
        schema = rows.select("__fold", F.col(p.spec.crossed)).schema.add("__u", T.DoubleType())
        # folds × crossed levels rows
        rows = left_join_on(rows, F.broadcast(spark.createDataFrame(seen, schema)), ["__fold", p.spec.crossed])
        pred = pred + F.coalesce(F.col("__u"), F.lit(0.0))
    effects = group_modes(p, solutions).withColumnRenamed("fold", "__fold")
    rows = left_join_on(rows, effects, ["__fold", *p.spec.group])
    pred = pred + F.coalesce(F.col("effects")[0][0], F.lit(0.0))
    if p.spec.slope:
        pred = pred + F.coalesce(F.col("effects")[1][0], F.lit(0.0)) * F.col(quoted(p.spec.slope))
    return rows.withColumn(out, pred).drop("__fold", "__b", "__u", "effects")


def profile_intervals(p: Prepared, s: Solution, level: float, rounds: int = 200, tol: float = 1e-6) -> np.ndarray:
    """Likelihood-profile intervals of the fixed effects, ``[low, high]`` per term.

    At given variance parameters, the values of a coefficient whose deviance lies within
    the chi-square point of the least one are an interval in closed form. The profile
    interval reaches as far as any of these, so each end is the farthest end over all
    variance parameters, a variance of zero included. It is found by a search of its own,
    begun from the best of a coarse grid and of the estimate; all ends share each pass.
    """
    variant = s.variant
    ml = search(p, [variant], reml=False)[0]
    n = p.fixed(variant.fold)[0, 0]
    height = ml.deviance + dist.normal_ppf(0.5 + level / 2) ** 2
    move = np.eye(p.p1)
    move[0, 1:] = -p.shift
    middle = _original(p, ml)
    unit = np.sqrt(np.diag(move @ ml.cov @ move.T))

    def outward(logdets, xx, beta, rss):
        """How far the low and high ends lie from the estimate, in standard errors. Where no
        value is within the height, the root of what is missing counts against it."""
        centre = beta @ move.T
        centre[:, 0] += p.y_shift
        var = np.einsum("ij,tjk,ik->ti", move, np.linalg.inv(xx), move)
        room = var * (n / (2 * math.pi) * np.exp((height - logdets) / n - 1) - rss)[:, None]
        reach = np.sign(room) * np.sqrt(np.abs(room))
        return np.stack([middle - centre + reach, centre - middle + reach], axis=2) / unit[:, None]

    ends = [(j, side) for j in range(p.p1) for side in (0, 1)]
    free = dict.fromkeys(ends, _free(variant, p.r))

    def score(points):
        pieces = evaluate(p, [(variant, x) for _, x in points])
        return [
            _best_theta(_spectrum(p, _reduced(p, variant, q)), ld, lambda *at, e=e: -outward(*at)[:, e[0], e[1]], _thetas(variant))[0]
            for (e, _), (q, ld) in zip(points, pieces, strict=True)
        ]

    starts = [ml.lam[np.tril_indices(p.r)], *_coarse(free[ends[0]], p.r)]
    grid = _thetas(variant) if p.levels else np.zeros(1)
    first = [
        outward(*_at_thetas(_spectrum(p, _reduced(p, variant, q)), ld, grid)).max(axis=0)
        for q, ld in evaluate(p, [(variant, x) for x in starts])
    ]
    state = {e: _first_state(starts[int(np.argmax([f[e] for f in first]))]) for e in ends}
    _settle(state, free, score, rounds, tol)
    found = score([(e, state[e][0]) for e in ends])
    out = np.zeros((p.p1, 2))
    for (j, side), value in zip(ends, found, strict=True):
        out[j, side] = middle[j] + (1 if side else -1) * -value * unit[j]
    return out


def _ready(df: DataFrame, spec: MixedSpec, fold: str | None = None) -> Prepared:
    """Prepared model with its group table pinned, as every later pass reads it."""
    rows = _design(df, spec, fold)
    with reused(rows) as kept:
        p = prepare_mixed(kept, spec, fold)
        p.groups = pinned(p.groups)
        p.parts = p.groups.rdd.getNumPartitions()
        _totals(p)
    p.rows = rows
    return p


def fit_mixed(df: DataFrame, spec: MixedSpec, reml: bool = True) -> MixedFit:
    """Fit by restricted (or full) maximum likelihood."""
    p = _ready(df, spec)
    return MixedFit(p, search(p, [Variant()], reml)[0])


def random_term_tests(df: DataFrame, spec: MixedSpec) -> DataFrame:
    """Likelihood-ratio test for leaving out each random term (restricted likelihood)."""
    p = _ready(df, spec)
    name = ":".join(spec.group)
    reduced = []
    if spec.slope:
        reduced.append((f"{spec.slope} in ({' + '.join(['1', spec.slope])} | {name})", Variant(slope=False), 2))
    else:
        reduced.append((f"(1 | {name})", Variant(intercept=False), 1))
    if spec.crossed:
        reduced.append((f"(1 | {spec.crossed})", Variant(crossed=False), 1))
    full, *others = search(p, [Variant(), *[v for _, v, _ in reduced]])
    out = [("<none>", float(-full.deviance / 2), None, None, None)]
    for (text, _, df_lost), s in zip(reduced, others, strict=True):
        gain = float(max(s.deviance - full.deviance, 0.0))
        out.append((text, float(-s.deviance / 2), gain, df_lost, dist.chi2_sf(gain, df_lost)))
    return df.sparkSession.createDataFrame(
        out, "term string, log_lik double, lrt double, df int, p_value double"
    )


def cv_mixed(df: DataFrame, spec: MixedSpec, fold: str = "fold", reml: bool = True) -> DataFrame:
    """Out-of-fold predictions; every fold's model is searched in the same passes."""
    p = _ready(df, spec, fold)
    variants = [Variant(fold=int(k)) for k in sorted(p.fixed_by_fold)]
    return predict_mixed(p, search(p, variants, reml))

