import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from panelspark.operators import gram, linear
from panelspark.operators.design import ModelSpec, all_interactions, design_rows, interactions_with, value_grid


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(1)
    n = 400
    x = rng.standard_normal((n, 4)) @ np.triu(rng.random((4, 4)) + 0.5)
    x[:, 1] += 1e6  # large mean
    y = 3 + x @ [1.0, 0.5, 0.0, -2.0] - 0.5e6 + rng.standard_normal(n)
    pdf = pd.DataFrame(x, columns=["a", "b", "c", "d"]).assign(y=y, id=range(n))
    pdf["fold"] = pdf["id"] % 5
    pdf["inner_fold"] = (pdf["id"] // 5) % 4
    pdf["flat"] = 7.0
    pdf["twice"] = pdf["a"] * 2
    return pdf


@pytest.fixture(scope="module")
def rows(spark, frame):
    return spark.createDataFrame(frame).repartition(7).cache()


SPEC = ModelSpec("y", ["a", "b", "c", "d"])


def reference(pdf, cols=("a", "b", "c", "d")):
    u = np.column_stack([np.ones(len(pdf)), pdf[list(cols)]])
    scale = np.abs(u).max(axis=0)
    return np.linalg.lstsq(u / scale, pdf["y"], rcond=None)[0] / scale


def test_three_ways_of_the_same_moments(rows, frame, monkeypatch):
    columns = ["a", "b", "y"]
    one = gram.collect_moments(rows, columns, ["fold"])
    two = gram.collect_moments(rows, columns, ["fold"], shift=one.shift)
    monkeypatch.setattr(gram, "JVM_COLUMNS", 0)
    three = gram.collect_moments(rows.repartition(3), columns, ["fold"], shift=one.shift)
    assert one.by_key.keys() == two.by_key.keys() == three.by_key.keys() == {(k,) for k in range(5)}
    for k in one.by_key:
        np.testing.assert_allclose(one.by_key[k], two.by_key[k], rtol=1e-7, atol=1e-6)
        np.testing.assert_allclose(two.by_key[k], three.by_key[k], rtol=1e-9, atol=1e-8)
    u = np.column_stack([np.ones(len(frame)), frame[columns] - one.shift])
    np.testing.assert_allclose(two.total, u.T @ u, rtol=1e-8, atol=1e-6)


def test_many_keys_are_flushed(spark, monkeypatch):
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(3000) % 1500, "x": 1.0, "y": 2.0})).coalesce(1)
    monkeypatch.setattr(gram, "JVM_COLUMNS", 0)
    got = gram.keyed_moments(df, ["x", "y"], ["k"]).groupBy("k").agg(F.sum("value").alias("s"))
    assert got.count() == 1500
    assert {r["s"] for r in got.collect()} == {2 * (1 + 1 + 2 + 1 + 2 + 4.0)}


def test_ols_against_reference_and_ml(spark, rows, frame):
    fit = linear.fit_ols(rows, SPEC)
    np.testing.assert_allclose(fit.coefficients[1:], reference(frame)[1:], rtol=1e-5, atol=1e-6)
    centred = rows.withColumn("b", F.col("b") - 1e6)
    vec = VectorAssembler(inputCols=list(SPEC.features), outputCol="f").transform(centred)
    ml = LinearRegression(featuresCol="f", labelCol="y", solver="normal").fit(vec)
    np.testing.assert_allclose(fit.coefficients[1:], ml.coefficients.toArray(), rtol=1e-7)
    np.testing.assert_allclose(fit.std_errors[1:], ml.summary.coefficientStandardErrors[:-1], rtol=1e-6)
    np.testing.assert_allclose(fit.r_squared, ml.summary.r2, rtol=1e-9)
    tidy = {r["term"]: r for r in fit.tidy(spark).collect()}
    np.testing.assert_allclose([tidy[t]["p_value"] for t in SPEC.features], ml.summary.pValues[:-1], atol=1e-9)


def test_aliased_terms_are_null(spark, rows, frame):
    fit = linear.fit_ols(rows, ModelSpec("y", ["a", "flat", "twice", "c"]))
    tidy = {r["term"]: r["estimate"] for r in fit.tidy(spark).collect()}
    assert tidy["flat"] is None and tidy["twice"] is None
    np.testing.assert_allclose([tidy["a"], tidy["c"]], reference(frame, ("a", "c"))[1:], rtol=1e-7)


def test_cv_is_a_refit_without_the_fold(rows, frame):
    got = linear.cv_ols(rows, SPEC, keep=["id"]).toPandas().set_index("id")["pred"].sort_index()
    assert len(got) == len(frame)
    for k in range(5):
        b = reference(frame[frame.fold != k])
        held = frame[frame.fold == k]
        expected = b[0] + held[list(SPEC.features)].to_numpy() @ b[1:]
        np.testing.assert_allclose(got[held["id"]], expected, rtol=1e-5, atol=1e-3)


def test_one_row_fold_and_mean_only(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 3.0), (1, 5.0)], "fold int, y double")
    got = sorted(r["pred"] for r in linear.cv_ols(df, ModelSpec("y", [])).collect())
    assert got == pytest.approx([1.0, 1.0, 4.0])


def test_lasso_matches_ml(rows):
    lam = 0.3
    centred = rows.withColumn("b", F.col("b") - 1e6)
    vec = VectorAssembler(inputCols=list(SPEC.features), outputCol="f").transform(centred)
    ml = LinearRegression(featuresCol="f", labelCol="y", elasticNetParam=1.0, regParam=lam, maxIter=1000, tol=1e-12).fit(vec)
    got = {r["term"]: r["estimate"] for r in linear.penalised_path(centred, SPEC, [lam]).collect()}
    n = 400
    # the other implementation scales by the sample deviation, ours by the population one
    np.testing.assert_allclose([got[t] for t in SPEC.features], ml.coefficients.toArray(), atol=lam * 5 / n)


def test_lasso_optimality_and_orthonormal_case():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((60, 3)) - rng.standard_normal((1, 3)))
    x = q - q.mean(axis=0)
    x, _ = np.linalg.qr(x)
    x = x * np.sqrt(60)
    y = x @ [2.0, -0.4, 0.05] + rng.standard_normal(60) * 0.1
    u = np.column_stack([np.ones(60), x, y])
    st = linear.standardise([u.T @ u])
    for lam in (0.1, 0.5, 3.0):
        b = linear.unscale(st, linear.lasso_paths(st, np.array([[lam]])))[0, 0]
        c = x.T @ (y - y.mean()) / 60
        np.testing.assert_allclose(b, np.sign(c) * np.maximum(np.abs(c) - lam, 0), atol=1e-8)
    z = rng.standard_normal((80, 6))
    z[:, 3] = z[:, 0] + 0.1 * z[:, 3]
    w = z @ rng.standard_normal(6) + rng.standard_normal(80)
    v = np.column_stack([np.ones(80), z, w])
    st = linear.standardise([v.T @ v, v[:50].T @ v[:50]])
    grid = linear.lambda_grid(st)
    paths = linear.lasso_paths(st, grid)
    grad = st.corr_y[:, None] - np.einsum("fpq,flq->flp", st.corr, paths)
    assert np.all(np.abs(grad) <= grid[:, :, None] * (1 + 1e-6) + 1e-9)
    on = paths != 0
    np.testing.assert_allclose(grad[on], (np.sign(paths) * grid[:, :, None])[on], atol=1e-7)
    assert np.all(paths[:, 0] == 0)


def test_ridge_closed_form():
    rng = np.random.default_rng(3)
    x, y = rng.standard_normal((50, 3)), rng.standard_normal(50)
    u = np.column_stack([np.ones(50), x, y])
    st = linear.standardise([u.T @ u])
    z = (x - x.mean(0)) / x.std(0)
    lam = 0.7
    expected = np.linalg.solve(z.T @ z / 50 + lam / y.std() * np.eye(3), z.T @ (y - y.mean()) / 50)
    np.testing.assert_allclose(linear.ridge_paths(st, np.array([[lam]]))[0, 0], expected, rtol=1e-9)


@pytest.mark.parametrize("criterion, ridge", [("cv", False), ("cv", True), ("bic", False), ("ebic", False)])
def test_outer_cv_is_the_inner_fit_on_the_rest(rows, frame, criterion, ridge):
    got = linear.cv_penalised(rows, SPEC, criterion=criterion, ridge=ridge, keep=["id"]).toPandas().set_index("id")["pred"]
    for k in (0, 3):
        rest = rows.filter(F.col("fold") != k)
        if criterion == "cv":
            fit = linear.penalised_cv(rest, SPEC, "inner_fold", "min", ridge)
        else:
            fit = linear.lasso_bic(rest, SPEC, extended=criterion == "ebic")
        held = frame[frame.fold == k]
        expected = fit.coefficients[0] + held[list(SPEC.features)].to_numpy() @ fit.coefficients[1:]
        np.testing.assert_allclose(got[held["id"]], expected, rtol=1e-4, atol=1e-2)


def test_rules_and_errors(rows):
    mean, se = np.array([5.0, 3.0, 2.0, 2.5]), np.array([1.0, 1.0, 1.5, 1.0])
    assert linear.pick_lambda(mean, se, "min") == 2 and linear.pick_lambda(mean, se, "1se") == 1
    with pytest.raises(ValueError):
        linear.pick_lambda(mean, se, "other")
    with pytest.raises(ValueError):
        linear.cv_penalised(rows, SPEC, criterion="aic")
    big, small = (linear.lasso_bic(rows, SPEC, extended=e, count_intercept=False) for e in (False, True))
    assert np.count_nonzero(small.coefficients) <= np.count_nonzero(big.coefficients)


def test_folds(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    a = {r["k"]: r["fold"] for r in gram.assign_folds(df, ["k"], 10, 5).collect()}
    b = {r["k"]: r["fold"] for r in gram.assign_folds(df.repartition(5), ["k"], 10, 5).collect()}
    assert a == b and set(a.values()) == set(range(10))
    exact = gram.assign_balanced_folds(df.repartition(6), ["k"], 10, 5, bucket_rows=20)  # 256 buckets
    sizes = [r["count"] for r in exact.groupBy("fold").count().collect()]
    assert sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1


def test_design(spark):
    columns = ["a", "b", "c", "share"]
    assert len(all_interactions(columns)) == 6
    assert interactions_with(columns, "share", without=["c"]) == [("a", "share"), ("b", "share")]
    df = spark.createDataFrame([(1.0, 2, 3.0), (None, 2, 3.0)], "y double, a int, b double")
    rows = design_rows(df, ModelSpec("y", ["a", "b"], [("a", "b")])).collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.0, 3.0, 6.0)]
    assert [r[0] for r in value_grid(spark, 0.0, 1.0, 5).orderBy("value").collect()] == [0.0, 0.25, 0.5, 0.75, 1.0]


def test_given_moments_need_no_pass(spark, monkeypatch):
    from panelspark.operators import gram, linear, select
    from panelspark.operators.design import ModelSpec, design_rows

    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    pdf = pd.DataFrame(x, columns=list("abcde")).assign(y=x @ [1.0, 0, 2, 0, 0.5] + rng.normal(size=300), id=range(300))
    df = gram.assign_folds(gram.assign_folds(spark.createDataFrame(pdf), ["id"], 4, 1), ["id"], 4, 2, "inner_fold")
    spec = ModelSpec("y", list("abcde"))
    moments = gram.collect_moments(design_rows(df, spec, ["fold", "inner_fold"]), [*spec.terms, "y"], ["fold", "inner_fold"])
    fits = [
        lambda **k: linear.fit_ols(df, spec, **k).coefficients,
        lambda **k: linear.lasso_bic(df, spec, **k).coefficients,
        lambda **k: linear.penalised_cv(df, spec, **k).coefficients,
        lambda **k: select.fit_bayes(df, spec, **k)[0][-1].sy,
        *[
            lambda f=f, **k: [r["pred"] for r in f(df, spec, keep=["id"], **k).orderBy("id").collect()]
            for f in (linear.cv_ols, linear.cv_penalised, lambda *a, **k: linear.cv_penalised(*a, criterion="bic", **k), select.cv_bayes)
        ],
    ]
    want = [fit() for fit in fits]

    def no_pass(*a, **k):
        raise AssertionError("a pass over the rows")

    monkeypatch.setattr(linear, "collect_moments", no_pass)
    monkeypatch.setattr(select, "collect_moments", no_pass)
    for fit, values in zip(fits, want, strict=True):
        np.testing.assert_allclose(fit(moments=moments), values, rtol=1e-9, atol=1e-9)
