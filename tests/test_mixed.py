import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import mixed, report
from panelspark.operators.design import ModelSpec

FIXED = ModelSpec("y", ["x"])
NESTED = mixed.MixedSpec(FIXED, ["p", "g"], crossed="p")
SLOPE = mixed.MixedSpec(ModelSpec("y", ["x", "h"]), ["g"], crossed="p", slope="h")
ALONE = mixed.MixedSpec(FIXED, ["g"])


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(12)
    rows = []
    pe, ge, gs = rng.normal(0, 1.0, 5), rng.normal(0, 1.2, 9), rng.normal(0, 0.5, 9)
    cell = rng.normal(0, 0.8, (5, 9))
    for p in range(5):
        for g in range(9):
            for _ in range(rng.integers(1, 7)):
                x, h = rng.normal(), rng.normal(3, 2)
                rows.append((f"p{p}", f"g{g}", x, h, 10 + 0.7 * x + pe[p] + ge[g] + gs[g] * h + cell[p, g] + rng.normal()))
    pdf = pd.DataFrame(rows, columns=["p", "g", "x", "h", "y"])
    pdf["fold"] = np.arange(len(pdf)) % 4
    # one group is seen in a single fold only
    pdf.loc[pdf.index[-3:], "g"] = "rare"
    pdf.loc[pdf.index[-3:], "fold"] = 1
    return pdf


@pytest.fixture(scope="module")
def rows(spark, frame):
    return spark.createDataFrame(frame).repartition(5).cache()


def dense(pdf, spec, lam, theta):
    """Everything from the full covariance matrix."""
    x = np.column_stack([np.ones(len(pdf)), pdf[list(spec.fixed.features)]])
    y = pdf["y"].to_numpy()
    z = np.column_stack([np.ones(len(pdf))] + ([pdf[spec.slope]] if spec.slope else []))
    key = pdf[list(spec.group)].agg("|".join, axis=1).to_numpy()
    v = np.eye(len(y)) + np.where(key[:, None] == key[None, :], z @ lam @ lam.T @ z.T, 0.0)
    if spec.crossed:
        s = pdf[spec.crossed].to_numpy()
        v += theta**2 * (s[:, None] == s[None, :])
    vi = np.linalg.inv(v)
    beta = np.linalg.solve(x.T @ vi @ x, x.T @ vi @ y)
    r = y - x @ beta
    n, p = x.shape
    df, rss = n - p, r @ vi @ r
    deviance = (
        np.linalg.slogdet(v)[1] + np.linalg.slogdet(x.T @ vi @ x)[1] + df * (1 + math.log(2 * math.pi * rss / df))
    )
    return deviance, beta, rss / df, vi, r, z, key, np.linalg.inv(x.T @ vi @ x)


def on_original(fit):
    t = mixed._group_map(fit.prepared)
    return t @ fit.solution.lam


@pytest.mark.parametrize("spec", [NESTED, SLOPE, ALONE])
def test_fit_against_the_full_matrix(rows, frame, spec):
    fit = mixed.fit_mixed(rows, spec)
    s, lam = fit.solution, on_original(fit)
    deviance, beta, sigma2, vi, r, z, key, cov = dense(frame, spec, lam, s.theta)
    assert s.deviance == pytest.approx(deviance, abs=1e-6)
    assert s.sigma2 == pytest.approx(sigma2, rel=1e-7)
    table = {t["term"]: t for t in fit.coefficients(profile=False).collect()}
    names = ["(Intercept)", *spec.fixed.features]
    np.testing.assert_allclose([table[t]["estimate"] for t in names], beta, rtol=1e-6)
    np.testing.assert_allclose([table[t]["std_error"] for t in names], np.sqrt(sigma2 * np.diag(cov)), rtol=1e-6)
    # no nearby covariance does better
    rng = np.random.default_rng(0)
    for _ in range(40):
        near = np.tril(lam + rng.normal(0, 0.05, lam.shape))
        assert dense(frame, spec, near, abs(s.theta + rng.normal(0, 0.05)))[0] >= deviance - 1e-6
    # conditional modes: G Zᵀ V⁻¹ r
    modes = {(m["grp"], m["term"]): m for m in fit.modes().collect() if m["factor"] == ":".join(spec.group)}
    for k in np.unique(key):
        at = key == k
        expected = lam @ lam.T @ z[at].T @ (vi @ r)[at]
        got = [modes[k.replace("|", ":"), t]["condval"] for t in spec.random_terms]
        np.testing.assert_allclose(got, expected, atol=1e-6)
    if spec.crossed:
        levels = {m["grp"]: m["condval"] for m in fit.modes().collect() if m["factor"] == spec.crossed and ":" not in m["factor"]}
        for p, value in levels.items():
            assert value == pytest.approx(s.theta**2 * (vi @ r)[frame["p"] == p].sum(), abs=1e-6)
    fitted = fit.predict().toPandas()
    random = sum(lam @ lam.T @ z[key == k].T @ (vi @ r)[key == k] @ z[key == k].T for k in ()) if False else None
    assert random is None and len(fitted) == len(frame)
    assert np.corrcoef(fitted["pred"], fitted["y"])[0, 1] ** 2 > 0.3


def test_fitted_values_and_condsd(rows, frame):
    fit = mixed.fit_mixed(rows, NESTED)
    s, lam = fit.solution, on_original(fit)
    _, beta, sigma2, vi, r, z, key, _ = dense(frame, NESTED, lam, s.theta)
    # y − fitted = V⁻¹ r (the residual part of the decomposition)
    got = fit.predict().toPandas().sort_values(["x", "y"])
    expected = (frame["y"] - vi @ r)[frame.sort_values(["x", "y"]).index]
    np.testing.assert_allclose(got["pred"], expected, atol=1e-6)
    # joint posterior covariance of both sets of effects
    groups, levels = np.unique(key), np.unique(frame["p"])
    big = np.column_stack([(key[:, None] == groups) * lam[0, 0], (frame["p"].to_numpy()[:, None] == levels) * s.theta])
    post = np.linalg.inv(np.eye(big.shape[1]) + big.T @ big) * sigma2
    scale = np.concatenate([np.full(len(groups), lam[0, 0]), np.full(len(levels), s.theta)])
    sd = np.sqrt(np.diag(post)) * scale
    modes = {m["grp"]: m["condsd"] for m in fit.modes().collect()}
    names = [g.replace("|", ":") for g in groups] + list(levels)
    np.testing.assert_allclose([modes[n] for n in names], sd, rtol=1e-5)
    bars = report.caterpillar(fit.modes()).collect()
    assert all(b["upper"] - b["lower"] == pytest.approx(4 * b["condsd"]) for b in bars)


def test_profile_interval(rows, frame):
    """At both ends the profile deviance is up by the chi-square point."""
    fit = mixed.fit_mixed(rows, ALONE)
    table = {t["term"]: t for t in fit.coefficients().collect()}
    x, y = frame["x"].to_numpy(), frame["y"].to_numpy()
    g = frame["g"].to_numpy()
    same = g[:, None] == g[None, :]

    def ml(offset, cols):
        best = math.inf
        for ratio in np.exp(np.linspace(-3, 3, 241)):
            v = np.eye(len(y)) + ratio * same
            vi, target = np.linalg.inv(v), y - offset
            r = target - cols @ np.linalg.solve(cols.T @ vi @ cols, cols.T @ vi @ target)
            best = min(best, np.linalg.slogdet(v)[1] + len(y) * (1 + math.log(2 * math.pi * (r @ vi @ r) / len(y))))
        return best

    one = np.ones((len(y), 1))
    low = ml(0.0, np.column_stack([one, x]))
    for end in ("ci_low", "ci_high"):
        assert ml(table["x"][end] * x, one) - low == pytest.approx(3.841, abs=0.03)


def nelder_mead(f, start, size=0.3, rounds=500):
    """Plain downhill simplex."""
    points = [np.array(start, float)] + [np.array(start, float) + size * e for e in np.eye(len(start))]
    values = [f(x) for x in points]
    for _ in range(rounds):
        order = np.argsort(values)
        points, values = [points[i] for i in order], [values[i] for i in order]
        if values[-1] - values[0] < 1e-8:
            break
        middle = np.mean(points[:-1], axis=0)
        trials = [middle + t * (points[-1] - middle) for t in (-1.0, -2.0, 0.5)]
        found = [f(x) for x in trials[:2]]
        if found[0] >= values[-1]:
            found[0] = f(trials[2])
            trials[0] = trials[2]
        best = int(np.argmin(found))
        if found[best] < values[-1]:
            points[-1], values[-1] = trials[best], found[best]
        else:
            points = [points[0] + 0.5 * (x - points[0]) for x in points]
            values = [f(x) for x in points]
    return min(values)


def dense_profile(pdf, spec, term=None, value=None):
    """Least deviance from the full covariance matrix, one coefficient held fixed."""
    names = ["(Intercept)", *spec.fixed.features]
    x = np.column_stack([np.ones(len(pdf)), pdf[list(spec.fixed.features)]])
    y = pdf["y"].to_numpy()
    if term:
        y = y - value * x[:, names.index(term)]
        x = np.delete(x, names.index(term), axis=1)
    z = np.column_stack([np.ones(len(pdf))] + ([pdf[spec.slope]] if spec.slope else []))
    key = pdf[list(spec.group)].agg("|".join, axis=1).to_numpy()
    s = pdf[spec.crossed].to_numpy() if spec.crossed else np.zeros(len(pdf))
    same, level = key[:, None] == key[None, :], s[:, None] == s[None, :]

    def deviance(params):
        lam = mixed.relative_factor(params[:-1], z.shape[1])
        v = np.eye(len(y)) + same * (z @ lam @ lam.T @ z.T) + bool(spec.crossed) * params[-1] ** 2 * level
        vi = np.linalg.inv(v)
        r = y - x @ np.linalg.solve(x.T @ vi @ x, x.T @ vi @ y)
        return np.linalg.slogdet(v)[1] + len(y) * (1 + math.log(2 * math.pi * (r @ vi @ r) / len(y)))

    size = 2 if z.shape[1] == 1 else 4
    return min(nelder_mead(deviance, start) for start in (np.full(size, 0.5), np.full(size, 0.02)))


def singular(pdf):
    """The same rows with a response that no group has a part in."""
    out = pdf.copy()
    rng = np.random.default_rng(5)
    out["y"] = 3 + 0.4 * out["x"] - 0.2 * out["h"] + rng.permutation(np.linspace(-1, 1, len(out)))
    for column in (["g"], ["p"]):
        out["y"] -= out.groupby(column)["y"].transform("mean") - (3 + 0.4 * out["x"] - 0.2 * out["h"]).groupby(out[column[0]]).transform("mean")
    return out


@pytest.mark.parametrize("flat", [False, True])
def test_profile_with_a_slope_against_the_full_matrix(spark, frame, flat):
    pdf = singular(frame) if flat else frame
    fit = mixed.fit_mixed(spark.createDataFrame(pdf), SLOPE)
    if flat:
        assert np.abs(fit.solution.lam).max() < 1e-3 and fit.solution.theta < 1e-3
    table = {t["term"]: t for t in fit.coefficients().collect()}
    low = dense_profile(pdf, SLOPE)
    for term in ("(Intercept)", "x", "h"):
        assert table[term]["ci_low"] < table[term]["estimate"] < table[term]["ci_high"]
        for end in ("ci_low", "ci_high"):
            assert dense_profile(pdf, SLOPE, term, table[term][end]) - low == pytest.approx(3.8415, abs=2e-3)


def test_search_returns_to_its_best_point():
    """A quadratic's minimum that turns out worse does not end or mislead the search."""
    def score(points):
        return [float(np.sum(np.abs(x - [2.0, -1.0, 0.5]) ** 1.5) + (20 if x[0] > 2.6 else 0)) for _, x in points]

    state = {0: [np.array([0.1, 0.1, 0.1]), 0.9]}
    mixed._settle(state, {0: [0, 1, 2]}, score, 200, 1e-6)
    np.testing.assert_allclose(state[0][0], [2.0, -1.0, 0.5], atol=1e-3)


def test_r_squared(rows, frame):
    fit = mixed.fit_mixed(rows, SLOPE)
    g = fit.covariance()
    table = {t["term"]: t["estimate"] for t in fit.coefficients(profile=False).collect()}
    fixed = np.var(frame["x"] * table["x"] + frame["h"] * table["h"], ddof=1)
    z = np.column_stack([np.ones(len(frame)), frame["h"]])
    random = np.einsum("ni,ij,nj->n", z, g, z).mean() + fit.solution.sigma2 * fit.solution.theta**2
    row = fit.r_squared().first()
    whole = fixed + random + fit.solution.sigma2
    assert row["r2_marginal"] == pytest.approx(fixed / whole)
    assert row["r2_conditional"] == pytest.approx((fixed + random) / whole)


def test_term_tests(rows, frame):
    table = {t["term"]: t for t in mixed.random_term_tests(rows, SLOPE).collect()}
    full = mixed.fit_mixed(rows, SLOPE).solution.deviance
    assert table["<none>"]["log_lik"] == pytest.approx(-full / 2, abs=1e-5)
    slope = table["h in (1 + h | g)"]
    assert slope["df"] == 2 and slope["p_value"] < 1e-3
    no_slope = mixed.fit_mixed(rows, mixed.MixedSpec(SLOPE.fixed, ["g"], crossed="p")).solution.deviance
    assert slope["lrt"] == pytest.approx(no_slope - full, abs=1e-4)
    alone = {t["term"]: t for t in mixed.random_term_tests(rows, ALONE).collect()}
    gls = dense(frame, ALONE, np.zeros((1, 1)), 0.0)[0]
    assert alone["(1 | g)"]["lrt"] == pytest.approx(gls - mixed.fit_mixed(rows, ALONE).solution.deviance, abs=1e-5)


@pytest.mark.parametrize("spec", [NESTED, SLOPE])
def test_cv_is_a_refit(rows, frame, spec):
    scored = mixed.cv_mixed(rows, spec).toPandas()
    assert len(scored) == len(frame)
    k = 1
    fit = mixed.fit_mixed(rows.filter(F.col("fold") != k), spec)
    table = {t["term"]: t["estimate"] for t in fit.coefficients(profile=False).collect()}
    modes = {(m["factor"], m["grp"], m["term"]): m["condval"] for m in fit.modes().collect()}
    name = ":".join(spec.group)
    held = scored[scored.fold == k]
    for _, row in held.iterrows():
        grp = ":".join(row[c] for c in spec.group)
        expected = table["(Intercept)"] + sum(table[t] * row[t] for t in spec.fixed.features)
        expected += modes.get((spec.crossed, row["p"], "(Intercept)"), 0.0) + modes.get((name, grp, "(Intercept)"), 0.0)
        if spec.slope:
            expected += modes.get((name, grp, spec.slope), 0.0) * row[spec.slope]
        assert row["pred"] == pytest.approx(expected, abs=2e-3)
    assert (held["g"] == "rare").any()


def test_aliased_fixed_terms(rows):
    spec = mixed.MixedSpec(ModelSpec("y", ["x", "twice"]), ["g"])
    fit = mixed.fit_mixed(rows.withColumn("twice", F.col("x") * 2), spec)
    table = {t["term"]: t["estimate"] for t in fit.coefficients(profile=False).collect()}
    assert table["twice"] is None and table["x"] is not None
