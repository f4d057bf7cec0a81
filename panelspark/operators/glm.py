"""Generalised linear models and their lasso, with information criteria and K-fold scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import dist
from panelspark.operators.design import ModelSpec, design_rows
from panelspark.operators.gram import collect_moments, fold_values
from panelspark.operators.linear import (
    PenalisedFit, cv_curve, lasso_bic, pick_lambda, predict_by_fold, standardise,
)
from panelspark.operators.weighted import Design, Models, fit_glm, glm_step, mean_response, prepare, weighted_pass
from panelspark.session import reused


def _respond(df: DataFrame, family: str, scale: str) -> DataFrame:
    if scale == "link":
        return df
    if scale != "response":
        raise ValueError(f"unknown prediction scale {scale!r}")
    return df.withColumn("pred", mean_response(F.col("pred"), family))


def cv_glm(
    df: DataFrame, spec: ModelSpec, family: str = "gaussian", scale: str = "link", fold: str = "fold",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Out-of-fold predictions on the link or response scale; all folds share each pass."""
    rows = design_rows(df, spec, [fold, *keep])
    with reused(rows) as kept:
        folds = fold_values(kept, fold)
        design = prepare(kept, spec.terms, spec.label, scale_label=False, fold=fold)
        models, _, _ = fit_glm(design, Models.grid(design.size, skip_fold=folds), family)
    by_fold = dict(zip(folds, design.to_original(models.beta), strict=True))
    return _respond(predict_by_fold(rows, spec.terms, by_fold, fold), family, scale)


def _grids(matrices: Sequence[np.ndarray], points: int, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Penalty grid and training deviations of the terms, per training set."""
    st = standardise(matrices)
    top = np.abs(st.corr_y).max(axis=1, initial=0.0)
    top = np.where(top > 0, top, 1.0)
    return top[:, None] * np.power(ratio, np.linspace(0, 1, points))[None, :], st.sd


def _fit_paths(design: Design, family: str, sets: list[dict], lambdas: np.ndarray, sds: np.ndarray):
    """All training sets × penalties as models of one set of passes."""
    points = lambdas.shape[1]
    spread = {k: np.repeat([s.get(k, -1) for s in sets], points) for k in ("skip_fold", "skip_inner")}
    models = Models.grid(design.size, **spread)
    relative = sds / design.scale
    penalty = lambdas.reshape(-1)[:, None] * np.repeat(relative, points, axis=0)
    models, deviance, n = fit_glm(design, models, family, penalty)
    shape = (len(sets), points)
    return models, deviance.reshape(shape), n.reshape(shape)


def _criterion(deviance: np.ndarray, n: np.ndarray, nonzero: np.ndarray, columns: int, extended: bool) -> np.ndarray:
    size = nonzero + 1
    value = deviance + np.log(n) * size
    if extended:
        value = value + 2 * np.vectorize(lambda c: dist.log_choose(columns, int(c)))(size)
    return value


def lasso_glm_bic(
    df: DataFrame, spec: ModelSpec, family: str = "binomial", extended: bool = False, points: int = 60,
    ratio: float = 1e-3,
) -> PenalisedFit:
    """Lasso of an exponential-family model, the penalty chosen by deviance BIC or EBIC.

    For the gaussian family the deviance is no log-likelihood, so that case
    uses the least-squares criterion.
    """
    if family == "gaussian":
        return lasso_bic(df, spec, extended)
    rows = design_rows(df, spec)
    with reused(rows) as kept:
        moments = collect_moments(kept, [*spec.terms, spec.label])
        lambdas, sds = _grids([moments.total], points, ratio)
        design = prepare(kept, spec.terms, spec.label, scale_label=False)
        models, deviance, n = _fit_paths(design, family, [{}], lambdas, sds)
    nonzero = (models.beta[:, 1:] != 0).sum(axis=1)
    values = _criterion(deviance[0], n[0], nonzero, len(spec.terms), extended)
    best = int(values.argmin())
    beta = design.to_original(models.beta)
    table = [
        (float(a), float(v), int(c) + 1, float(d))
        for a, v, c, d in zip(lambdas[0], values, nonzero, deviance[0], strict=True)
    ]
    return PenalisedFit(
        list(spec.terms), beta[best], float(lambdas[0, best]), table,
        "lambda double, bic double, nvars int, deviance double",
    )


def cv_lasso_glm(
    df: DataFrame, spec: ModelSpec, family: str = "binomial", criterion: str = "cv", rule: str = "1se",
    scale: str = "link", fold: str = "fold", inner_fold: str = "inner_fold", points: int = 40, ratio: float = 1e-3,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Out-of-fold lasso predictions, the penalty chosen inside each training set."""
    if criterion not in ("cv", "bic", "ebic"):
        raise ValueError(f"criterion {criterion!r} not implemented")
    inner = criterion == "cv"
    rows = design_rows(df, spec, [fold, *([inner_fold] if inner else []), *keep])
    columns = [*spec.terms, spec.label]
    with reused(rows) as kept:
        moments = collect_moments(kept, columns, [fold])
        fits = moments.training()
        lambdas, sds = _grids(list(fits.values()), points, ratio)
        design = prepare(kept, spec.terms, spec.label, False, fold, inner_fold if inner else None)
        models, deviance, n = _fit_paths(design, family, [{"skip_fold": k} for k in fits], lambdas, sds)
        beta = design.to_original(models.beta).reshape(len(fits), points, -1)
        if inner:
            best = _inner_choice(design, family, list(fits), moments, lambdas, rule, kept, columns, fold, inner_fold)
        else:
            nonzero = (models.beta[:, 1:] != 0).sum(axis=1).reshape(len(fits), points)
            best = _criterion(deviance, n, nonzero, len(spec.terms), criterion == "ebic").argmin(axis=1)
    by_fold = {k: beta[i, best[i]] for i, k in enumerate(fits)}
    return _respond(predict_by_fold(rows, spec.terms, by_fold, fold), family, scale)


def _inner_choice(design, family, outer, moments, lambdas, rule, kept, columns, fold, inner_fold):
    """Index of the penalty with the best inner-fold deviance, per outer fold."""
    points = lambdas.shape[1]
    cells = collect_moments(kept, columns, [fold, inner_fold], moments.shift)
    inner = sorted({j for _, j in cells.by_key})
    empty = np.zeros_like(cells.total)
    train, sets = [], []
    for k in outer:
        for j in inner:
            both = cells.by_key.get((k, j), empty)
            train.append(cells.total - cells.margin(0)[k] - cells.margin(1)[j] + both)
            sets.append({"skip_fold": k, "skip_inner": j})
    sds = standardise(train).sd
    grid = np.repeat(lambdas, len(inner), axis=0)
    models, train_deviance, train_n = _fit_paths(design, family, sets, grid, sds)
    # deviance on the outer training set minus that on the inner one is the held-out part
    wide = replace(models, skip_inner=np.full(len(models), -1))
    _, _, scalars = weighted_pass(design, wide, glm_step(family), 1, 1, 3)
    shape = (len(outer), len(inner), points)
    held_n = (scalars[:, 1].reshape(shape) - train_n.reshape(shape))[:, :, 0]
    held = (scalars[:, 0].reshape(shape) - train_deviance.reshape(shape)) / np.maximum(held_n, 1)[:, :, None]
    best = []
    for i in range(len(outer)):
        use = held_n[i] > 0
        mean, se = cv_curve(held[i][use], held_n[i][use])
        best.append(pick_lambda(mean, se, rule))
    return np.array(best)


