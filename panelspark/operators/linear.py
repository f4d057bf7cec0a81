"""Least squares, lasso and ridge solved from keyed moments."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import dist
from panelspark.operators.design import ModelSpec, design_rows
from panelspark.operators.gram import Moments, collect_moments, quoted

INTERCEPT = "(Intercept)"
TIDY = "term string, estimate double, std_error double, t_value double, p_value double, ci_low double, ci_high double"


def centred(m: np.ndarray):
    """``n``, means, and centred cross-products of x, of x with y, and of y."""
    n = m[0, 0]
    mean = m[0, 1:] / n
    s = m[1:, 1:] - n * np.outer(mean, mean)
    return n, mean, s[:-1, :-1], s[:-1, -1], s[-1, -1]


def independent_columns(s: np.ndarray, tol: float = 1e-7) -> list[int]:
    """Columns not (nearly) a combination of earlier ones; later duplicates lose."""
    work = s.copy()
    start = np.diag(s).copy()
    kept = []
    for j in range(len(s)):
        if start[j] <= 0 or work[j, j] <= (tol**2) * start[j] or work[j, j] <= 1e-13 * start[j]:
            continue
        kept.append(j)
        work = work - np.outer(work[:, j], work[j]) / work[j, j]
    return kept


def solve_ols(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], float]:
    """Slopes (NaN where aliased), inverse of the kept block, kept columns, RSS."""
    _, _, s, sy, t = centred(m)
    kept = independent_columns(s)
    b = np.full(len(s), np.nan)
    if kept:
        # solved on the correlation scale, which evens out the columns' units
        scale = np.sqrt(np.diag(s)[kept])
        inverse = np.linalg.inv(s[np.ix_(kept, kept)] / np.outer(scale, scale)) / np.outer(scale, scale)
        b[kept] = inverse @ sy[kept]
        rss = t - sy[kept] @ b[kept]
    else:
        inverse, rss = np.zeros((0, 0)), t
    return b, inverse, kept, max(rss, 0.0)


def with_intercept(m: np.ndarray, shift: np.ndarray, slopes: np.ndarray) -> np.ndarray:
    """Prepend the intercept on the original (unshifted) scale."""
    n, mean, *_ = centred(m)
    b = np.nan_to_num(slopes)
    at = mean + shift
    return np.concatenate([[at[-1] - at[:-1] @ b], slopes])


@dataclass
class OlsFit:
    terms: list[str]
    coefficients: np.ndarray
    std_errors: np.ndarray
    df_residual: float
    sigma: float
    r_squared: float
    adj_r_squared: float
    f_value: float
    f_df: int
    f_p_value: float
    n: float

    def intervals(self, level: float = 0.95) -> np.ndarray:
        half = dist.t_ppf(0.5 + level / 2, self.df_residual) * self.std_errors
        return np.stack([self.coefficients - half, self.coefficients + half], axis=1)

    def tidy(self, spark: SparkSession, level: float = 0.95) -> DataFrame:
        ci = self.intervals(level)
        rows = []
        for i, term in enumerate(self.terms):
            b, se = self.coefficients[i], self.std_errors[i]
            t = b / se if se > 0 else math.nan
            p = 2 * dist.t_sf(abs(t), self.df_residual) if t == t else math.nan
            rows.append((term, *[_null(v) for v in (b, se, t, p, ci[i, 0], ci[i, 1])]))
        return spark.createDataFrame(rows, TIDY)

    def summary(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(float(self.n), float(self.df_residual), *[_null(v) for v in (
                self.sigma, self.r_squared, self.adj_r_squared, self.f_value, self.f_p_value)])],
            "n double, df_residual double, sigma double, r_squared double, adj_r_squared double, "
            "f_value double, f_p_value double",
        )


def _null(value):
    value = float(value)
    return None if math.isnan(value) else value


def ols_from_moments(m: np.ndarray, shift: np.ndarray, terms: Sequence[str]) -> OlsFit:
    n, mean, s, sy, t = centred(m)
    b, inverse, kept, rss = solve_ols(m)
    rank = len(kept)
    df = n - rank - 1
    sigma2 = rss / df if df > 0 else math.nan
    se = np.full(len(b), np.nan)
    se[kept] = np.sqrt(sigma2 * np.diag(inverse))
    at = (mean + shift)[:-1][kept]
    se0 = math.sqrt(sigma2 * (1 / n + at @ inverse @ at)) if df > 0 else math.nan
    r2 = 1 - rss / t if t > 0 else math.nan
    f = (t - rss) / rank / sigma2 if rank and df > 0 and sigma2 > 0 else math.nan
    return OlsFit(
        [INTERCEPT, *terms], with_intercept(m, shift, b), np.concatenate([[se0], se]), df,
        math.sqrt(sigma2) if df > 0 else math.nan, r2, 1 - (1 - r2) * (n - 1) / df if df > 0 else math.nan,
        f, rank, dist.f_sf(f, rank, df) if f == f else math.nan, n,
    )


def fit_ols(df: DataFrame, spec: ModelSpec, moments: Moments | None = None) -> OlsFit:
    """Least squares in one pass for the means and one for the moments; none for given moments of the same rows."""
    moments = moments or collect_moments(design_rows(df, spec), [*spec.terms, spec.label])
    return ols_from_moments(moments.total, moments.shift, spec.terms)


# --- predictions -----------------------------------------------------------


def linear_predictor(coefficients: Column, terms: Sequence[str]) -> Column:
    """``b[0] + Σ b[j]·x_j`` for an array column of coefficients."""
    total = coefficients[0]
    for j, term in enumerate(terms):
        total = total + coefficients[j + 1] * F.col(quoted(term))
    return total


def predict(rows: DataFrame, terms: Sequence[str], coefficients: np.ndarray, out: str = "pred") -> DataFrame:
    """Fitted values as one expression over the columns; aliased terms count 0."""
    b = F.array(*[F.lit(float(v)) for v in np.nan_to_num(coefficients)])
    return rows.withColumn(out, linear_predictor(b, terms))


def predict_by_fold(
    rows: DataFrame, terms: Sequence[str], by_fold: Mapping[int, np.ndarray], fold: str = "fold", out: str = "pred"
) -> DataFrame:
    """Score each row with the coefficients fitted without its fold."""
    table = rows.sparkSession.createDataFrame(
        [(int(k), [float(v) for v in np.nan_to_num(b)]) for k, b in by_fold.items()], "__fold int, __b array<double>"
    )
    # one row per fold
    scored = rows.join(F.broadcast(table), F.col(fold) == F.col("__fold"), "left")
    return scored.withColumn(out, linear_predictor(F.col("__b"), terms)).drop("__fold", "__b")


def fold_coefficients_ols(moments: Moments) -> dict:
    """Coefficients per held-out fold, all from one pass."""
    return {
        k: with_intercept(m, moments.shift, solve_ols(m)[0]) for k, m in moments.training().items()
    }


def cv_ols(
    df: DataFrame, spec: ModelSpec, fold: str = "fold", keep: Sequence[str] = (), moments: Moments | None = None
) -> DataFrame:
    """Out-of-fold predictions for every complete row; without terms, the training mean.
    Given moments are those of the same rows, by fold first."""
    rows = design_rows(df, spec, [fold, *keep])
    moments = moments or collect_moments(rows, [*spec.terms, spec.label], [fold])
    return predict_by_fold(rows, spec.terms, fold_coefficients_ols(moments), fold)


# --- lasso and ridge -------------------------------------------------------


@dataclass
class Standardised:
    """Correlation-scale statistics of several training sets, stacked."""

    n: np.ndarray
    sd: np.ndarray
    corr: np.ndarray
    corr_y: np.ndarray
    var_y: np.ndarray


def standardise(matrices: Sequence[np.ndarray], scale: bool = True) -> Standardised:
    """Population-sd scaling, as the penalty is defined; constant columns get 0."""
    parts = [centred(m) for m in matrices]
    n = np.array([p[0] for p in parts])
    s, sy = np.array([p[2] for p in parts]), np.array([p[3] for p in parts])
    var = np.einsum("fii->fi", s) / n[:, None]
    sd = np.sqrt(np.maximum(var, 0.0)) if scale else np.ones_like(var)
    inv = np.divide(1.0, sd, out=np.zeros_like(sd), where=var > 1e-14 * (1 + sd**2))
    corr = s * inv[:, :, None] * inv[:, None, :] / n[:, None, None]
    return Standardised(n, sd, corr, sy * inv / n[:, None], np.array([p[4] for p in parts]) / n)


def lambda_grid(st: Standardised, points: int = 100, ratio: float | None = None, ridge: bool = False) -> np.ndarray:
    """Log-spaced penalties per training set, from the smallest that selects nothing."""
    top = np.abs(st.corr_y).max(axis=1, initial=0.0) * (1000.0 if ridge else 1.0)
    top = np.where(top > 0, top, 1.0)
    if ratio is None:
        ratio = 1e-4 if st.n.min() > st.corr_y.shape[1] else 1e-2
    return top[:, None] * np.power(ratio, np.linspace(0, 1, points))[None, :]


def lasso_paths(st: Standardised, lambdas: np.ndarray, tol: float = 1e-10, sweeps: int = 100_000) -> np.ndarray:
    """Standardised slopes ``[set, λ, term]`` by coordinate descent on all sets at once."""
    sets, p = st.corr_y.shape
    diag = np.einsum("fii->fi", st.corr)
    usable = diag > 0
    safe = np.where(usable, diag, 1.0)
    b, g = np.zeros((sets, p)), st.corr_y.copy()
    out = np.zeros((sets, lambdas.shape[1], p))
    limit = tol * max(np.abs(st.corr_y).max(initial=0.0), 1e-300)
    for at in range(lambdas.shape[1]):
        lam = lambdas[:, at]
        active = np.arange(p)
        for _ in range(sweeps):
            moved = 0.0
            for j in active:
                z = g[:, j] + diag[:, j] * b[:, j]
                new = np.where(usable[:, j], np.sign(z) * np.maximum(np.abs(z) - lam, 0.0) / safe[:, j], 0.0)
                step = new - b[:, j]
                size = np.abs(step).max()
                if size > 0:
                    g -= st.corr[:, :, j] * step[:, None]
                    b[:, j] = new
                    moved = max(moved, size)
            full = len(active) == p
            if moved <= limit and full:
                break
            # sweep the non-zero terms until they settle, then check all again
            active = np.arange(p) if moved <= limit else np.flatnonzero((b != 0).any(axis=0))
            if len(active) == 0:
                active = np.arange(p)
        else:
            raise RuntimeError("lasso coefficients do not settle")
        out[:, at] = b
    return out


def ridge_paths(st: Standardised, lambdas: np.ndarray) -> np.ndarray:
    """Standardised slopes ``[set, λ, term]`` from the closed form ``(R + λ/sd(y)·I)⁻¹r``.

    As for the lasso, λ is in units of the label.
    """
    p = st.corr_y.shape[1]
    relative = lambdas / np.sqrt(np.maximum(st.var_y, 1e-300))[:, None]
    system = st.corr[:, None] + relative[:, :, None, None] * np.eye(p)
    return np.linalg.solve(system, np.broadcast_to(st.corr_y[:, None, :, None], (*system.shape[:3], 1)))[..., 0]


def unscale(st: Standardised, paths: np.ndarray) -> np.ndarray:
    inv = np.divide(1.0, st.sd, out=np.zeros_like(st.sd), where=st.sd > 0)
    return paths * inv[:, None, :]


def path_rss(st: Standardised, paths: np.ndarray) -> np.ndarray:
    """Residual sum of squares per set and λ, as a quadratic form."""
    fit = np.einsum("flp,fp->fl", paths, st.corr_y)
    size = np.einsum("flp,fpq,flq->fl", paths, st.corr, paths)
    return np.maximum(st.n[:, None] * (st.var_y[:, None] - 2 * fit + size), 0.0)


def information_criterion(
    n: float, rss: np.ndarray, nonzero: np.ndarray, columns: int, extended: bool = False, count_intercept: bool = True
) -> np.ndarray:
    """Gaussian BIC, or EBIC; the EBIC term counts the intercept unless told otherwise."""
    size = nonzero + 1
    with np.errstate(divide="ignore"):
        value = n * np.log(rss / n) + n * (math.log(2 * math.pi) + 1) + math.log(n) * size
    if extended:
        chosen = size if count_intercept else nonzero
        value = value + 2 * np.array([dist.log_choose(columns, int(c)) for c in chosen])
    return value


@dataclass
class PenalisedFit:
    terms: list[str]
    coefficients: np.ndarray
    lambda_opt: float
    path: list[tuple]
    path_schema: str

    def tidy(self, spark: SparkSession) -> DataFrame:
        rows = [(t, float(b)) for t, b in zip([INTERCEPT, *self.terms], self.coefficients, strict=True)]
        return spark.createDataFrame(rows, "term string, estimate double")

    def path_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.path, self.path_schema)


def best_by_criterion(
    matrices: Sequence[np.ndarray], extended: bool = False, lambdas: np.ndarray | None = None, count_intercept: bool = True
):
    """Per training set: path, criterion values and the index of the best λ."""
    st = standardise(matrices)
    grid = lambda_grid(st) if lambdas is None else np.broadcast_to(lambdas, (len(matrices), len(lambdas)))
    paths = lasso_paths(st, grid)
    rss = path_rss(st, paths)
    nonzero = (paths != 0).sum(axis=2)
    columns = paths.shape[2]
    values = np.array([
        information_criterion(st.n[f], rss[f], nonzero[f], columns, extended, count_intercept)
        for f in range(len(matrices))
    ])
    # the path runs from large to small λ, so the first minimum is the larger λ
    return st, grid, unscale(st, paths), values, nonzero, values.argmin(axis=1)


def lasso_bic(
    df: DataFrame, spec: ModelSpec, extended: bool = False, lambdas: Sequence[float] | None = None,
    count_intercept: bool = True, moments: Moments | None = None,
) -> PenalisedFit:
    """Lasso with the penalty chosen by BIC or EBIC.

    By default EBIC's number of models counts the intercept as a chosen column,
    which makes the model with every column win; ``count_intercept=False`` is
    the published form. Given moments are those of the same rows.
    """
    moments = moments or collect_moments(design_rows(df, spec), [*spec.terms, spec.label])
    grid_in = None if lambdas is None else np.asarray(lambdas, float)
    st, grid, slopes, values, nonzero, best = best_by_criterion([moments.total], extended, grid_in, count_intercept)
    rows = [
        (float(a), float(v), int(c) + 1) for a, v, c in zip(grid[0], values[0], nonzero[0], strict=True)
    ]
    b = with_intercept(moments.total, moments.shift, slopes[0, best[0]])
    return PenalisedFit(list(spec.terms), b, float(grid[0, best[0]]), rows, "lambda double, bic double, nvars int")


def penalised_path(
    df: DataFrame, spec: ModelSpec, lambdas: Sequence[float], ridge: bool = False
) -> DataFrame:
    """``(lambda, term, estimate)`` at given penalties, which must fall."""
    moments = collect_moments(design_rows(df, spec), [*spec.terms, spec.label])
    st = standardise([moments.total])
    grid = np.asarray(lambdas, float)[None, :]
    slopes = unscale(st, (ridge_paths if ridge else lasso_paths)(st, grid))[0]
    rows = []
    for lam, b in zip(lambdas, slopes, strict=True):
        full = with_intercept(moments.total, moments.shift, b)
        rows += [(float(lam), t, float(v)) for t, v in zip([INTERCEPT, *spec.terms], full, strict=True)]
    return df.sparkSession.createDataFrame(rows, "lambda double, term string, estimate double")


def held_out_mse(test: np.ndarray, train: np.ndarray, slopes: np.ndarray) -> np.ndarray:
    """Mean squared error on the held-out moments, per row of ``slopes``."""
    _, mean, *_ = centred(train)
    a = mean[-1] - slopes @ mean[:-1]
    v = np.concatenate([-a[:, None], -slopes, np.ones((len(slopes), 1))], axis=1)
    return np.maximum(np.einsum("li,ij,lj->l", v, test, v), 0.0) / test[0, 0]


def cv_curve(errors: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Size-weighted mean error per λ and its standard error over folds."""
    weight = sizes / sizes.sum()
    mean = weight @ errors
    spread = np.sqrt(weight @ (errors - mean) ** 2 / max(len(sizes) - 1, 1))
    return mean, spread


def pick_lambda(mean: np.ndarray, se: np.ndarray, rule: str) -> int:
    best = int(mean.argmin())
    if rule == "min":
        return best
    if rule == "1se":
        return int(np.flatnonzero(mean <= mean[best] + se[best])[0])
    raise ValueError(f"unknown rule {rule!r}: use 'min' or '1se'")


def penalised_cv_many(
    fits: Sequence[np.ndarray], folds: Sequence[Sequence[tuple[np.ndarray, np.ndarray]]], rule: str, ridge: bool, points: int = 100
):
    """For each full matrix: slopes at the λ chosen over its (train, test) pairs."""
    st = standardise(fits)
    grid = lambda_grid(st, points, ridge=ridge)
    solve = ridge_paths if ridge else lasso_paths
    slopes = unscale(st, solve(st, grid))
    flat = [(i, train, test) for i, pairs in enumerate(folds) for train, test in pairs if test[0, 0] > 0]
    inner_st = standardise([train for _, train, _ in flat])
    inner_grid = np.array([grid[i] for i, _, _ in flat])
    inner = unscale(inner_st, solve(inner_st, inner_grid))
    out = []
    for i in range(len(fits)):
        mine = [r for r, (owner, _, _) in enumerate(flat) if owner == i]
        errors = np.array([held_out_mse(flat[r][2], flat[r][1], inner[r]) for r in mine])
        mean, se = cv_curve(errors, np.array([flat[r][2][0, 0] for r in mine]))
        at = pick_lambda(mean, se, rule)
        out.append((slopes[i, at], grid[i], mean, se, at, slopes[i]))
    return out


def penalised_cv(
    df: DataFrame, spec: ModelSpec, fold: str = "fold", rule: str = "min", ridge: bool = False,
    moments: Moments | None = None,
) -> PenalisedFit:
    """Lasso (or ridge) with the penalty chosen by K-fold error, in one pass; none for
    given moments of the same rows, by fold first."""
    rows = design_rows(df, spec, [fold])
    moments = moments or collect_moments(rows, [*spec.terms, spec.label], [fold])
    total, train, test = moments.total, moments.training(), moments.margin(0)
    picked = penalised_cv_many([total], [[(train[k], test[k]) for k in test]], rule, ridge)
    slopes, grid, mean, se, at, path = picked[0]
    rows_out = [
        (float(a), float(m), float(s), int((b != 0).sum()))
        for a, m, s, b in zip(grid, mean, se, path, strict=True)
    ]
    return PenalisedFit(
        list(spec.terms), with_intercept(total, moments.shift, slopes), float(grid[at]), rows_out,
        "lambda double, cv_error double, cv_se double, nvars int",
    )


def nested_training(moments: Moments):
    """Outer training matrices and, for each, its inner (train, test) pairs.

    With independent outer and inner folds the rows outside both are the total
    minus both margins plus their common cell: one pass serves all K × J fits.
    """
    total, outer, inner = moments.total, moments.margin(0), moments.margin(1)
    empty = np.zeros_like(total)
    fits = {k: total - m for k, m in outer.items()}
    pairs = {}
    for k in outer:
        cells = [(j, moments.by_key.get((k, j), empty)) for j in inner]
        pairs[k] = [(total - outer[k] - inner[j] + cell, inner[j] - cell) for j, cell in cells]
    return fits, pairs


def cv_penalised(
    df: DataFrame,
    spec: ModelSpec,
    criterion: str = "cv",
    rule: str = "min",
    ridge: bool = False,
    fold: str = "fold",
    inner_fold: str = "inner_fold",
    keep: Sequence[str] = (),
    count_intercept: bool = True,
    moments: Moments | None = None,
) -> DataFrame:
    """Out-of-fold predictions of lasso or ridge, the penalty chosen inside each training set.

    Given moments are those of the same rows, by fold and, for ``criterion="cv"``, inner fold."""
    if criterion not in ("cv", "bic", "ebic") or (ridge and criterion != "cv"):
        raise ValueError(f"criterion {criterion!r} not implemented")
    rows = design_rows(df, spec, [fold, inner_fold, *keep] if criterion == "cv" else [fold, *keep])
    columns = [*spec.terms, spec.label]
    if not spec.terms:
        moments = moments or collect_moments(rows, columns, [fold])
        return predict_by_fold(rows, [], fold_coefficients_ols(moments), fold)
    if criterion == "cv":
        moments = moments or collect_moments(rows, columns, [fold, inner_fold])
        fits, pairs = nested_training(moments)
        picked = penalised_cv_many(list(fits.values()), [pairs[k] for k in fits], rule, ridge)
        slopes = {k: p[0] for k, p in zip(fits, picked, strict=True)}
    else:
        moments = moments or collect_moments(rows, columns, [fold])
        fits = moments.training()
        _, _, b, _, _, best = best_by_criterion(
            list(fits.values()), criterion == "ebic", count_intercept=count_intercept
        )
        slopes = {k: b[i, best[i]] for i, k in enumerate(fits)}
    by_fold = {k: with_intercept(fits[k], moments.shift, slopes[k]) for k in fits}
    return predict_by_fold(rows, spec.terms, by_fold, fold)
