"""Quantile and generalised linear fits against exhaustive or independent solutions."""

from dataclasses import replace
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from panelspark.operators import glm, quantile, weighted
from panelspark.operators.design import ModelSpec

SPEC = ModelSpec("y", ["a", "b"])


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(4)
    n = 90
    pdf = pd.DataFrame({"id": range(n), "a": rng.standard_normal(n) + 5, "b": rng.random(n) * 100})
    pdf["y"] = 1 + 2 * pdf["a"] - 0.1 * pdf["b"] + rng.standard_exponential(n) * 3
    pdf["fold"] = pdf["id"] % 3
    pdf["inner_fold"] = (pdf["id"] // 3) % 3
    odds = 1 / (1 + np.exp(-(pdf["a"] - 5 + 0.02 * (pdf["b"] - 50))))
    pdf["flag"] = (rng.random(n) < odds).astype(float)
    pdf["count"] = rng.poisson(np.exp(0.3 * (pdf["a"] - 4))).astype(float)
    return pdf


@pytest.fixture(scope="module")
def rows(spark, frame):
    return spark.createDataFrame(frame).repartition(4).cache()


def check_loss(pdf, b, tau):
    r = pdf["y"] - b[0] - pdf[["a", "b"]].to_numpy() @ b[1:]
    return float((np.abs(r) / 2 + (tau - 0.5) * r).sum())


def best_vertex(pdf, tau):
    """The least check loss over all fits through three rows: the exact optimum."""
    u = np.column_stack([np.ones(len(pdf)), pdf[["a", "b"]]])
    y = pdf["y"].to_numpy()
    at = np.array(list(combinations(range(len(pdf)), 3)))
    b = np.linalg.solve(u[at], y[at][..., None])[..., 0]
    r = y[None, :] - b @ u.T
    return float((np.abs(r) / 2 + (tau - 0.5) * r).sum(axis=1).min())


@pytest.mark.parametrize("shuffled", [False, True])
def test_quantile_reaches_the_exact_optimum(rows, frame, monkeypatch, shuffled):
    from panelspark.operators import gram

    if shuffled:
        monkeypatch.setattr(gram, "SMALL_RESULT", 0)
    taus = [0.1, 0.5, 0.9]
    found = quantile.fit_quantile(rows, SPEC, taus).toPandas()
    for tau in taus:
        mine = found[found.tau == tau].set_index("term")["estimate"]
        b = mine[["(Intercept)", "a", "b"]].to_numpy()
        assert check_loss(frame, b, tau) == pytest.approx(best_vertex(frame, tau), rel=1e-9)


def test_quantile_with_more_rows(spark):
    rng = np.random.default_rng(8)
    n = 6000
    pdf = pd.DataFrame({"a": rng.standard_normal(n), "b": rng.standard_normal(n)})
    pdf["y"] = 2 * pdf["a"] + (1 + 0.5 * np.abs(pdf["b"])) * rng.standard_normal(n)
    found = quantile.fit_quantile(spark.createDataFrame(pdf), SPEC, [0.2]).toPandas().set_index("term")["estimate"]
    b = found[["(Intercept)", "a", "b"]].to_numpy()
    u = np.column_stack([np.ones(n), pdf[["a", "b"]]])
    # exact optimality: three rows lie on the plane and their multipliers stay between the slopes
    r = (pdf["y"] - u @ b).to_numpy()
    on = np.argsort(np.abs(r))[:3]
    assert np.abs(r[on]).max() < 1e-8
    psi = np.where(r > 0, 0.2, -0.8)
    psi[on] = 0.0
    side = np.linalg.solve(u[on].T, -(u.T @ psi))
    assert np.all((side <= 0.2 + 1e-6) & (side >= -0.8 - 1e-6))


def test_quantile_without_terms_is_exact(rows, frame):
    got = {r["tau"]: r["estimate"] for r in quantile.fit_quantile(rows, ModelSpec("y", []), [0.2, 0.5]).collect()}
    assert got == {t: pytest.approx(np.quantile(frame["y"], t)) for t in (0.2, 0.5)}


def test_penalised_optimum(rows, frame):
    """No small move lowers the penalised loss."""
    lam = 8.0
    found = quantile.fit_quantile(rows, SPEC, [0.5], lam=lam).toPandas().set_index("term")["estimate"]
    b = found[["(Intercept)", "a", "b"]].to_numpy()
    total = lambda v: check_loss(frame, v, 0.5) + lam * np.abs(v[1:]).sum()
    rng = np.random.default_rng(0)
    for size in (1e-3, 1e-2, 1e-1):
        for _ in range(200):
            move = rng.standard_normal(3) * size / np.array([1, 1, 50])
            move[0] -= move[1] * 5 + move[2] * 50
            assert total(b + move) >= total(b) - 1e-9


def test_penalty_shrinks_to_zero(rows):
    found = quantile.fit_quantile(rows, SPEC, [0.5], lam=1e5).collect()
    assert all(abs(r["estimate"]) < 1e-8 for r in found if r["term"] != "(Intercept)")


def test_cv_and_sweep(rows, frame):
    scored = quantile.cv_quantile(rows, SPEC, 0.5, keep=["id"]).toPandas()
    assert len(scored) == len(frame)
    for k in range(3):
        found = quantile.fit_quantile(rows.filter(F.col("fold") != k), SPEC, [0.5]).toPandas().set_index("term")["estimate"]
        held = scored[scored.fold == k]
        expected = found["(Intercept)"] + held["a"] * found["a"] + held["b"] * found["b"]
        np.testing.assert_allclose(held["pred"], expected, rtol=1e-7)
    sweep = quantile.quantile_sweep(rows, SPEC, [0.25, 0.5]).toPandas().set_index("tau")
    rmse = np.sqrt(((scored["y"] - scored["pred"]) ** 2).mean()) / frame["y"].mean()
    assert sweep.loc[0.5, "outsample"] == pytest.approx(rmse, rel=1e-9)


def test_bootstrap_does_not_depend_on_partitions(rows):
    a = quantile.bootstrap_quantile(rows, SPEC, ["id"], replicates=30, seed=1).toPandas()
    b = quantile.bootstrap_quantile(rows.repartition(2), SPEC, ["id"], replicates=30, seed=1).toPandas()
    np.testing.assert_allclose(a["std_error"], b["std_error"], rtol=1e-7)
    assert (a["std_error"] > 0).all() and (a["ci_low"] < a["estimate"]).all()


def test_poisson_weights():
    w = weighted.poisson_one(np.arange(200_000).astype(np.uint64) * np.uint64(7919), np.array([0, 1]))
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02)
    assert abs(np.corrcoef(w.T)[0, 1]) < 0.02


@pytest.mark.parametrize("family, label", [("binomial", "flag"), ("poisson", "count"), ("gaussian", "y")])
def test_glm_matches_ml(rows, frame, family, label):
    spec = ModelSpec(label, ["a", "b"])
    got = glm.cv_glm(rows, spec, family, "response", keep=["id"]).toPandas().set_index("id")["pred"]
    assembler = VectorAssembler(inputCols=["a", "b"], outputCol="f")
    for k in (0, 2):
        train, held = rows.filter(F.col("fold") != k), rows.filter(F.col("fold") == k)
        model = GeneralizedLinearRegression(family=family, featuresCol="f", labelCol=label, maxIter=60, tol=1e-10).fit(
            assembler.transform(train)
        )
        expected = model.transform(assembler.transform(held)).toPandas().set_index("id")["prediction"]
        np.testing.assert_allclose(got[expected.index], expected, rtol=1e-5)


def test_lasso_glm_matches_ml(rows):
    spec = ModelSpec("flag", ["a", "b"])
    fit = glm.lasso_glm_bic(rows, spec, points=12, ratio=0.05)
    lam = fit.path[6][0]
    # refit the path model at one penalty with the other implementation
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="f").transform(rows)
    ml = LogisticRegression(featuresCol="f", labelCol="flag", elasticNetParam=1.0, regParam=lam, maxIter=500, tol=1e-12).fit(vec)
    p = ml.transform(vec).toPandas()
    prob = np.array([v[1] for v in p["probability"]])
    deviance = -2 * np.where(p["flag"] == 1, np.log(prob), np.log1p(-prob)).sum()
    # the deviations it scales by differ by n/(n−1)
    assert fit.path[6][3] == pytest.approx(deviance, rel=2e-3)
    assert [r[2] for r in fit.path][0] == 1


@pytest.mark.parametrize("criterion", ["bic", "ebic", "cv"])
def test_cv_lasso_glm(rows, frame, criterion):
    scored = glm.cv_lasso_glm(rows, ModelSpec("flag", ["a", "b"]), criterion=criterion, scale="response", points=8, ratio=0.05, keep=["id"])
    pred = scored.toPandas()
    assert len(pred) == len(frame) and pred["pred"].between(0, 1).all()
    with pytest.raises(ValueError):
        glm.cv_lasso_glm(rows, SPEC, criterion="aic")


def test_fits_that_cannot_converge_raise(spark):
    apart = spark.createDataFrame([(float(i), float(i > 9)) for i in range(20)], "a double, flag double").withColumn("fold", (F.col("a") % 2).cast("int"))
    with pytest.raises(RuntimeError, match="converge"):
        glm.cv_glm(apart, ModelSpec("flag", ["a"]), "binomial")
    gram, rhs = np.array([[[1.0, 0.999], [0.999, 1.0]]]), np.array([[1.0, 1.0]])
    with pytest.raises(RuntimeError, match="settle"):
        weighted.soft_solve(gram, rhs, np.zeros((1, 2)), np.zeros((1, 2)), sweeps=2)


def test_quantile_without_proof_raises(rows, monkeypatch):
    monkeypatch.setattr(weighted, "_plane_of", lambda *args: None)
    with pytest.raises(RuntimeError, match="exact"):
        quantile.fit_quantile(rows, SPEC, [0.5])


def test_packed_partials_are_never_taken_apart(spark):
    from panelspark.operators import gram

    partial = spark.createDataFrame([(i % 3, [float(i), 1.0]) for i in range(60)], "model int, m array<double>").repartition(9)
    summed = gram.sum_arrays(partial, ["model"], 9)
    assert "Generate" not in summed._jdf.queryExecution().toString()
    assert {r.model: list(r.m) for r in summed.collect()} == {k: [float(sum(range(k, 60, 3))), 20.0] for k in range(3)}
    assert gram.sum_arrays(partial.select("m"), [], 9).first().m == [float(sum(range(60))), 60.0]


def test_best_plane_with_ties():
    """Many rows on one plane, as where every row comes several times: the walk must not go in circles."""
    rng = np.random.default_rng(5)
    flag = np.repeat(rng.integers(0, 2, 60), 6).astype(float)
    y = np.repeat(np.round(rng.random(60) * 50 + 1), 6) + 3 * flag
    u = np.column_stack([np.ones(len(y)), flag])
    found = weighted.best_plane(u, y, np.ones(len(y)), np.full(len(y), 0.3737), np.zeros(2), np.array([25.0, 3.0]))
    a, b = (np.quantile(y[flag == f], 0.3737, method="inverted_cdf") for f in (0, 1))
    np.testing.assert_allclose(found, [a, b - a], atol=1e-9)


def test_quantile_of_copied_rows(spark, monkeypatch):
    """Every row forty times: the folds' fits stay those of the rows, by the search for many rows."""
    monkeypatch.setattr(weighted, "MANY_ROWS", 1000, raising=False)
    monkeypatch.setattr(quantile, "MANY_ROWS", 1000, raising=False)
    rng = np.random.default_rng(6)
    n = 400
    pdf = pd.DataFrame({"a": (rng.random(n) < 0.4).astype(float), "y": np.round(rng.random(n) * 1000, 2), "fold": np.arange(n) % 3})
    rows = spark.createDataFrame(pdf).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).repartition(4)
    scored = quantile.cv_quantile(rows, ModelSpec("y", ["a"]), 0.3737).distinct().toPandas()
    for k in range(3):
        for a in (0.0, 1.0):
            expected = np.quantile(pdf[(pdf.fold != k) & (pdf.a == a)]["y"], 0.3737, method="inverted_cdf")
            np.testing.assert_allclose(scored[(scored.fold == k) & (scored.a == a)]["pred"], expected, rtol=1e-9)


def test_many_models_of_many_rows_share_their_levels_passes(spark, monkeypatch):
    """Folds and replicates end where the search for few rows ends, without passes of their own."""
    rng = np.random.default_rng(12)
    n = 6000
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.standard_normal(n), "b": rng.exponential(size=n), "fold": rng.integers(0, 5, n)})
    pdf["y"] = 2 * pdf["a"] + pdf["b"] + (1 + 0.5 * pdf["b"]) * rng.standard_normal(n)
    rows = spark.createDataFrame(pdf).repartition(4)

    def both():
        sweep = quantile.quantile_sweep(rows, SPEC, [0.25, 0.5]).toPandas()
        boot = quantile.bootstrap_quantile(rows, SPEC, ["id"], replicates=30, seed=1).toPandas()
        return sweep.to_numpy(float), boot.drop(columns="term").to_numpy(float)

    expected = both()
    for module in (weighted, quantile):
        monkeypatch.setattr(module, "MANY_ROWS", 1000)
    monkeypatch.setattr(quantile, "FIRST_ROWS", 2000, raising=False)
    searched, fit = [], weighted.fit_quantiles
    monkeypatch.setattr(quantile, "fit_quantiles", lambda design, models, *args, **kw: searched.append(len(models)) or fit(design, models, *args, **kw))
    for got, want in zip(both(), expected, strict=True):
        np.testing.assert_allclose(got, want, rtol=1e-9)
    assert max(searched) <= 2  # levels, and not 12 or 31 models


def test_models_outside_the_shared_band_are_not_proven(spark, monkeypatch):
    rng = np.random.default_rng(13)
    pdf = pd.DataFrame({"a": rng.standard_normal(3000), "fold": np.arange(3000) % 3})
    pdf["y"] = pdf["a"] + rng.standard_normal(3000)
    design = weighted.prepare(spark.createDataFrame(pdf), ["a"], "y", scale_label=True, fold="fold")
    models = weighted.Models.grid(2, tau=[0.5] * 4, skip_fold=[-1, 0, 1, 2])
    near, _, _ = weighted.fit_quantiles(design, models)
    planes, exact = weighted.shared_planes(design, replace(models, beta=np.repeat(near.beta[:1], 4, axis=0)))
    assert exact.all()
    full, _ = weighted.finish_quantiles(design, near, *weighted.fit_quantiles(design, models)[1:])
    np.testing.assert_allclose(planes, full.beta, rtol=1e-9)
    monkeypatch.setattr(weighted, "SHARED_ROWS", 100)
    away = np.repeat(near.beta[:1], 4, axis=0) + np.array([3.0, 0.0])
    assert not weighted.shared_planes(design, replace(models, beta=away))[1].any()


def test_blocks_of_rows_and_models_are_bounded(monkeypatch):
    """Neither a large batch nor many models make the arrays of a step large; the sums stay the same."""
    import pyarrow as pa

    rng = np.random.default_rng(7)
    batch = pa.RecordBatch.from_pydict({"x0": rng.random(5000), "y": rng.random(5000)})
    models = weighted.Models.grid(2, tau=np.linspace(0.1, 0.9, 300))
    scaling = (np.zeros(1), np.ones(1), 0.0, 1.0)
    sizes = []

    def step(base, u, y, part):
        sizes.append(base.size)
        return weighted.start_step(base, u, y, part)

    width = 3 + 2 + 2
    (out,) = weighted._sums_task(scaling, models, step, width)(iter([batch]))
    assert max(sizes) <= 1 << 18
    total = np.array(out.column("m").to_pylist())
    assert np.allclose(total[:, 0], 5000) and np.allclose(total[:, 3], batch.column("y").to_numpy().sum())
