"""Registered queries: design, folds, regression, selection, clustering, reports."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from panelspark.operators import cluster, explore, glm, gram, linear, mixed, panel, quantile, report, select
from panelspark.operators.design import ModelSpec, design_array, design_rows, interactions_with
from panelspark.plans import mapping as M
from panelspark.plans.queries_panel import KEYS, rounded
from panelspark.plans.registry import query
from panelspark.session import pinned
from panelspark.sources import table_reader

K = 10
SEED, INNER_SEED = 1993, 666
PANEL_KEY = ["period", "grp", "member"]
ONE = ModelSpec("price", ["mins"])
WIDE = ModelSpec("price", ["mins", "disc", "tax", "made", "tried"])
LONG = ModelSpec("price", WIDE.features, interactions_with(WIDE.features, "mins", without=["disc"]))


def folded(spark, sf):
    """Member rows with an outer and an inner fold."""
    rows = gram.assign_folds(M.members(spark, sf), PANEL_KEY, K, SEED)
    return gram.assign_folds(rows, PANEL_KEY, K, INNER_SEED, "inner_fold")


def _sql_fold(seed: int, key: str = "period, grp, member") -> str:
    return f"CAST(CAST(concat('0x', substr(md5(concat_ws('|', {key}, '{seed}')), 1, 8)) AS BIGINT) % {K} AS INTEGER)"


SQL_FOLDED = f"""{M.SQL_MEMBERS},
folded AS (SELECT *, {_sql_fold(SEED)} AS fold, {_sql_fold(INNER_SEED)} AS inner_fold FROM members)"""

# Centred columns and the sums of one slope per held-out fold.
SQL_ONE = (
    SQL_FOLDED
    + """,
ends AS (SELECT avg(mins) AS mx, avg(price) AS my FROM folded),
base AS (SELECT period, grp, member, mins, price, fold, inner_fold, mins - mx AS x, price - my AS y, mx, my
         FROM folded, ends),
cell AS (SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy
         FROM base GROUP BY fold),
whole AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy, sum(syy) AS syy FROM cell),
train AS (SELECT c.fold, w.n - c.n AS n, w.sx - c.sx AS sx, w.sy - c.sy AS sy, w.sxx - c.sxx AS sxx,
                 w.sxy - c.sxy AS sxy, w.syy - c.syy AS syy FROM cell c, whole w),
stat AS (SELECT fold, n, sx / n AS ax, sy / n AS ay, sxx / n - (sx / n) * (sx / n) AS vx,
                sxy / n - (sx / n) * (sy / n) AS vxy, syy / n - (sy / n) * (sy / n) AS vy FROM train),
total AS (SELECT n, sx / n AS ax, sy / n AS ay, sxx / n - (sx / n) * (sx / n) AS vx,
                 sxy / n - (sx / n) * (sy / n) AS vxy, syy / n - (sy / n) * (sy / n) AS vy FROM whole)"""
)
SQL_GRID = "generate_series(0, 99) g(i)"


# --- folds, design, moments -----------------------------------------------------------


@query("fold_assign", f"WITH {SQL_FOLDED} SELECT period, grp, member, fold, inner_fold FROM folded")
def fold_assign(spark, sf):
    return folded(spark, sf).select(*PANEL_KEY, "fold", "inner_fold")


@query(
    "fold_balanced",
    f"""SELECT event_id, CAST((row_number() OVER (ORDER BY md5(concat_ws('|', event_id, '{SEED}')), event_id) - 1) % {K}
               AS INTEGER) AS fold FROM events""",
)
def fold_balanced(spark, sf):
    """Folds of equal size: rows dealt out in digest order."""
    events = table_reader(spark, sf)("events").select("event_id")
    return gram.assign_balanced_folds(events, ["event_id"], K, SEED)


@query(
    "design_rows",
    f"""WITH {M.SQL_MEMBERS}
        SELECT period, grp, member, round(price, 4) AS price, mins, made, tried, mins * made AS mins_made,
               mins * tried AS mins_tried FROM members""",
)
def design_rows_query(spark, sf):
    spec = ModelSpec("price", ["mins", "made", "tried"], interactions_with(["mins", "made", "tried"], "mins"))
    rows = design_rows(M.members(spark, sf), spec, PANEL_KEY)
    return rounded(rows.withColumnsRenamed({"mins:made": "mins_made", "mins:tried": "mins_tried"}), 4, "price")


@query(
    "keyed_gram",
    f"""WITH {SQL_FOLDED}, v AS (SELECT fold, 1.0 AS "(Intercept)", mins, made, tried, price / 1000 AS price FROM folded)
        {" UNION ALL ".join(
            f'''SELECT fold, '{a}' AS "left", '{b}' AS "right", round(sum("{a}" * "{b}"), 3) AS value FROM v GROUP BY fold'''
            for i, a in enumerate(["(Intercept)", "mins", "made", "tried", "price"])
            for b in ["(Intercept)", "mins", "made", "tried", "price"][i:])}""",
)
def keyed_gram(spark, sf):
    rows = folded(spark, sf).withColumn("price", F.col("price") / 1000)
    columns = ["mins", "made", "tried", "price"]
    named = gram.named_moments(gram.keyed_moments(rows, columns, ["fold"]), columns, ["fold"])
    return rounded(named, 3, "value")


@query(
    "design_array_sums",
    f"""WITH {M.SQL_MEMBERS} SELECT period, count(*) AS n, sum(made + tried + made * tried) AS total
        FROM members GROUP BY period""",
)
def design_array_sums(spark, sf):
    spec = ModelSpec("price", ["made", "tried"], [("made", "tried")])
    rows = design_array(M.members(spark, sf), spec, ["period"])
    summed = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return rows.groupBy("period").agg(F.count(F.lit(1)).alias("n"), F.sum(summed).alias("total"))


# --- least squares -----------------------------------------------------------------------


@query(
    "cv_mean_only",
    f"""WITH {SQL_ONE} SELECT period, grp, member, round(stat.ay + my, 4) AS pred FROM base JOIN stat USING (fold)""",
)
def cv_mean_only(spark, sf):
    scored = linear.cv_ols(folded(spark, sf), ModelSpec("price", []), keep=PANEL_KEY)
    return rounded(scored.select(*PANEL_KEY, "pred"), 4, "pred")


@query(
    "ols_simple",
    f"""WITH {SQL_ONE}, f AS (
          SELECT n, vxy / vx AS b, my + ay - vxy / vx * (mx + ax) AS a, n * (vy - vxy * vxy / vx) / (n - 2) AS s2,
                 n * vx AS sxx, mx + ax AS xbar, vxy * vxy / vx / vy AS r2 FROM total, ends)
        SELECT '(Intercept)' AS term, round(a, 5) AS estimate, round(sqrt(s2 * (1 / n + xbar * xbar / sxx)), 6) AS std_error,
               round(a / sqrt(s2 * (1 / n + xbar * xbar / sxx)), 6) AS t_value FROM f
        UNION ALL
        SELECT 'mins', round(b, 5), round(sqrt(s2 / sxx), 6), round(b / sqrt(s2 / sxx), 6) FROM f""",
)
def ols_simple(spark, sf):
    tidy = linear.fit_ols(M.members(spark, sf), ONE).tidy(spark).select("term", "estimate", "std_error", "t_value")
    return rounded(rounded(tidy, 5, "estimate"), 6, "std_error", "t_value")


# Two slopes by the normal equations, with an expanded Student quantile for the interval.
SQL_TWO = f"""{M.SQL_MEMBERS},
c AS (SELECT mins - avg(mins) OVER () AS x, made - avg(made) OVER () AS z, price - avg(price) OVER () AS y FROM members),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(x * x) AS xx, sum(x * z) AS xz, sum(z * z) AS zz, sum(x * y) AS xy,
             sum(z * y) AS zy, sum(y * y) AS yy FROM c),
b AS (SELECT *, xx * zz - xz * xz AS det, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS bx,
             (xx * zy - xz * xy) / (xx * zz - xz * xz) AS bz FROM s),
r AS (SELECT *, (yy - bx * xy - bz * zy) AS rss, n - 3 AS df, CAST(1.959963984540054 AS DOUBLE) AS q FROM b),
t AS (SELECT *, rss / df AS s2, q + (q * q * q + q) / (4 * df) + (5 * pow(q, 5) + 16 * q * q * q + 3 * q) / (96 * df * df)
             AS tq FROM r)"""


@query(
    "ols_ci",
    f"""WITH {SQL_TWO}
        SELECT 'mins' AS term, round(bx, 5) AS estimate, round(bx - tq * sqrt(s2 * zz / det), 5) AS ci_low,
               round(bx + tq * sqrt(s2 * zz / det), 5) AS ci_high FROM t
        UNION ALL
        SELECT 'made', round(bz, 5), round(bz - tq * sqrt(s2 * xx / det), 5), round(bz + tq * sqrt(s2 * xx / det), 5) FROM t""",
)
def ols_ci(spark, sf):
    tidy = linear.fit_ols(M.members(spark, sf), ModelSpec("price", ["mins", "made"])).tidy(spark)
    return rounded(tidy.filter("term <> '(Intercept)'").select("term", "estimate", "ci_low", "ci_high"), 5, "estimate", "ci_low", "ci_high")


@query(
    "ols_summary",
    f"""WITH {SQL_TWO}
        SELECT n, df AS df_residual, round(sqrt(s2), 6) AS sigma, round(1 - rss / yy, 8) AS r_squared,
               round(1 - (1 - (1 - rss / yy)) * (n - 1) / df, 8) AS adj_r_squared, round((yy - rss) / 2 / s2, 3) AS f_value
        FROM t""",
)
def ols_summary(spark, sf):
    summary = linear.fit_ols(M.members(spark, sf), ModelSpec("price", ["mins", "made"])).summary(spark)
    out = rounded(rounded(summary.drop("f_p_value"), 6, "sigma"), 8, "r_squared", "adj_r_squared")
    return rounded(out, 3, "f_value")


# Two terms with next to no effect, so that tail areas are of ordinary size. A Student tail is
# a finite sum for whole degrees of freedom, another one for even than for odd; an F tail with
# two terms is a power.
SQL_SLIGHT = f"""{M.SQL_MEMBERS},
c AS (SELECT grp - avg(grp) OVER () AS x, period - avg(period) OVER () AS z, price - avg(price) OVER () AS y FROM members),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(x * x) AS xx, sum(x * z) AS xz, sum(z * z) AS zz, sum(x * y) AS xy, sum(z * y) AS zy, sum(y * y) AS yy FROM c),
b AS (SELECT *, xx * zz - xz * xz AS det, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS bx, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS bz FROM s),
r AS (SELECT *, (yy - bx * xy - bz * zy) AS rss, n - 3 AS df FROM b),
t AS (SELECT 'grp' AS term, bx * bx / (rss / df * zz / det) AS t2, df FROM r UNION ALL SELECT 'period', bz * bz / (rss / df * xx / det), df FROM r),
k AS (SELECT unnest(range(0, CAST(df AS BIGINT) // 2 + 1)) AS k FROM r),
sums AS (
  SELECT term, t2, df,
         sum(CASE WHEN k < df / 2 THEN exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1) + k * ln(df / (df + t2))) ELSE 0 END) AS even,
         sum(CASE WHEN k >= 1 AND k <= (df - 1) / 2 THEN exp(lgamma(greatest(k, 1)) + lgamma(0.5) - ln(2) - lgamma(k + 0.5) + (k - 0.5) * ln(df / (df + t2))) ELSE 0 END) AS odd
  FROM t, k GROUP BY term, t2, df)"""


@query(
    "ols_p_values",
    f"""WITH {SQL_SLIGHT}
        SELECT term, round(1 - CASE WHEN CAST(df AS BIGINT) % 2 = 0 THEN sqrt(t2 / (df + t2)) * even
                               ELSE 2 / pi() * (atan(sqrt(t2 / df)) + sqrt(t2 / (df + t2)) * odd) END, 7) AS p_value FROM sums
        UNION ALL SELECT 'F', round(pow(rss / yy, df / 2), 7) FROM r""",
)
def ols_p_values(spark, sf):
    """Two-sided tail areas of two weak terms, and that of both together."""
    fit = linear.fit_ols(M.members(spark, sf), ModelSpec("price", ["grp", "period"]))
    both = fit.summary(spark).select(F.lit("F").alias("term"), F.col("f_p_value").alias("p_value"))
    return rounded(fit.tidy(spark).filter("term <> '(Intercept)'").select("term", "p_value").unionByName(both), 7, "p_value")


@query(
    "ols_cv",
    f"""WITH {SQL_ONE}
        SELECT period, grp, member, round(my + stat.ay + vxy / vx * (x - stat.ax), 4) AS pred
        FROM base JOIN stat USING (fold)""",
)
def ols_cv(spark, sf):
    scored = linear.cv_ols(folded(spark, sf), ONE, keep=PANEL_KEY)
    return rounded(scored.select(*PANEL_KEY, "pred"), 4, "pred")


@query("ols_cv_wide")
def ols_cv_wide(spark, sf):
    """In- and out-of-fold errors with interactions (blocks of rows multiplied in tasks)."""
    rows = pinned(folded(spark, sf))
    inside = linear.predict(design_rows(rows, LONG), LONG.terms, linear.fit_ols(rows, LONG).coefficients)
    return report.error_table({"OLS": (inside, linear.cv_ols(rows, LONG))}, LONG.label)


# --- lasso and ridge -------------------------------------------------------------------------

FEW_LAMBDAS = [5000.0, 1000.0, 100.0, 10.0]


def _sql_one_penalty(slope: str) -> str:
    arms = " UNION ALL ".join(f"SELECT CAST({v} AS DOUBLE) AS lam" for v in FEW_LAMBDAS)
    return f"""WITH {SQL_ONE}, l AS ({arms}),
      f AS (SELECT lam, {slope} / sqrt(vx) AS b, mx + ax AS xbar, my + ay AS ybar FROM total, ends, l)
      SELECT lam AS "lambda", '(Intercept)' AS term, round(ybar - b * xbar, 5) AS estimate FROM f
      UNION ALL SELECT lam, 'mins', round(b, 5) FROM f"""


@query("lasso_one", _sql_one_penalty("sign(vxy) * greatest(abs(vxy / sqrt(vx)) - lam, 0)"))
def lasso_one(spark, sf):
    return rounded(linear.penalised_path(M.members(spark, sf), ONE, FEW_LAMBDAS), 5, "estimate")


@query("ridge_one", _sql_one_penalty("vxy / sqrt(vx) / (1 + lam / sqrt(vy))"))
def ridge_one(spark, sf):
    return rounded(linear.penalised_path(M.members(spark, sf), ONE, FEW_LAMBDAS, ridge=True), 5, "estimate")


SQL_BIC = "n * ln(n * (vy - 2 * vxy / sqrt(vx) * b + b * b) / n) + n * (ln(2 * pi()) + 1) + ln(n) * nvars"


@query(
    "lasso_bic_one",
    f"""WITH {SQL_ONE},
        l AS (SELECT *, abs(vxy / sqrt(vx)) * pow(1e-4, i / 99.0) AS lam FROM total, {SQL_GRID}),
        f AS (SELECT *, sign(vxy) * greatest(abs(vxy / sqrt(vx)) - lam, 0) AS b,
                     CASE WHEN i > 0 THEN 2 ELSE 1 END AS nvars FROM l)
        SELECT round(lam, 5) AS "lambda", round({SQL_BIC}, 4) AS bic, nvars FROM f""",
)
def lasso_bic_one(spark, sf):
    fit = linear.lasso_bic(M.members(spark, sf), ONE)
    return rounded(rounded(fit.path_table(spark), 5, "lambda"), 4, "bic")


@query("lasso_path_bic")
def lasso_path_bic(spark, sf):
    """Path with information criterion, all terms and interactions."""
    return linear.lasso_bic(M.members(spark, sf), LONG).path_table(spark)


@query("lasso_ebic")
def lasso_ebic(spark, sf):
    return linear.lasso_bic(M.members(spark, sf), LONG, extended=True).tidy(spark)


SQL_CV_ONE = f"""{SQL_ONE},
l AS (SELECT i, abs(vxy / sqrt(vx)) * pow({{ratio}}, i / 99.0) * {{scale}} AS lam FROM total, {SQL_GRID}),
f AS (SELECT i, lam, fold, ax, ay, {{slope}} / sqrt(vx) AS b FROM stat, l),
e AS (SELECT f.i, f.lam, c.n AS n,
             (c.syy - 2 * (ay - b * ax) * c.sy - 2 * b * c.sxy + c.n * (ay - b * ax) * (ay - b * ax)
              + 2 * (ay - b * ax) * b * c.sx + b * b * c.sxx) / c.n AS mse
      FROM f JOIN cell c USING (fold)),
m AS (SELECT i, any_value(lam) AS lam, sum(n * mse) / sum(n) AS cv_error FROM e GROUP BY i),
v AS (SELECT e.i, sqrt(sum(n * (mse - cv_error) * (mse - cv_error)) / sum(n) / (count(*) - 1)) AS cv_se
      FROM e JOIN m USING (i) GROUP BY e.i)"""


@query(
    "lasso_cv_one",
    "WITH "
    + SQL_CV_ONE.format(ratio="1e-4", scale="1", slope="sign(vxy) * greatest(abs(vxy / sqrt(vx)) - lam, 0)")
    + """ SELECT round(lam, 5) AS "lambda", round(cv_error / 1e6, 4) AS cv_error, round(cv_se / 1e6, 4) AS cv_se,
                 CASE WHEN i > 0 THEN 1 ELSE 0 END AS nvars FROM m JOIN v USING (i)""",
)
def lasso_cv_one(spark, sf):
    table = linear.penalised_cv(folded(spark, sf), ONE).path_table(spark)
    table = table.withColumns({"cv_error": F.col("cv_error") / 1e6, "cv_se": F.col("cv_se") / 1e6})
    return rounded(rounded(table, 5, "lambda"), 4, "cv_error", "cv_se")


@query(
    "ridge_cv_one",
    "WITH "
    + SQL_CV_ONE.format(ratio="1e-4", scale="1000", slope="vxy / sqrt(vx) / (1 + lam / sqrt(vy))")
    + ' SELECT round(lam, 3) AS "lambda", round(cv_error / 1e6, 4) AS cv_error FROM m',
)
def ridge_cv_one(spark, sf):
    table = linear.penalised_cv(folded(spark, sf), ONE, ridge=True).path_table(spark)
    table = table.select(F.round("lambda", 3).alias("lambda"), F.round(F.col("cv_error") / 1e6, 4).alias("cv_error"))
    return table


@query("lasso_cv")
def lasso_cv(spark, sf):
    """Coefficients at the penalty with the least K-fold error."""
    return linear.penalised_cv(folded(spark, sf), LONG, rule="min").tidy(spark)


@query("lasso_cv_1se")
def lasso_cv_1se(spark, sf):
    return linear.penalised_cv(folded(spark, sf), LONG, rule="1se").tidy(spark)


@query(
    "lasso_outer_one",
    f"""WITH {SQL_ONE},
        l AS (SELECT *, abs(vxy / sqrt(vx)) * pow(1e-4, i / 99.0) AS lam FROM stat, {SQL_GRID}),
        f AS (SELECT *, sign(vxy) * greatest(abs(vxy / sqrt(vx)) - lam, 0) AS b,
                     CASE WHEN i > 0 THEN 2 ELSE 1 END AS nvars FROM l),
        picked AS (SELECT fold, ax, ay, arg_min(b, {SQL_BIC}) / any_value(sqrt(vx)) AS slope FROM f GROUP BY fold, ax, ay)
        SELECT period, grp, member, round(my + ay + slope * (x - ax), 4) AS pred FROM base JOIN picked USING (fold)""",
)
def lasso_outer_one(spark, sf):
    scored = linear.cv_penalised(folded(spark, sf), ONE, criterion="bic", keep=PANEL_KEY)
    return rounded(scored.select(*PANEL_KEY, "pred"), 4, "pred")


def _sql_sums(prefix: str = "") -> str:
    names = ["n", "sx", "sy", "sxx", "sxy", "syy"]
    return ", ".join(f"CAST(sum({prefix}{c}) AS DOUBLE) AS {c}" for c in names)


SQL_SOFT = "sign({vxy}) * greatest(abs({vxy} / sqrt({vx})) - lam, 0) / sqrt({vx})"


@query(
    "lasso_nested_one",
    f"""WITH {SQL_ONE},
        cell2 AS (SELECT fold, inner_fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy,
                         sum(y * y) AS syy FROM base GROUP BY fold, inner_fold),
        pairs AS (SELECT DISTINCT a.fold AS k, b.inner_fold AS j FROM cell2 a, cell2 b),
        tr AS (SELECT k, j, {_sql_sums()} FROM pairs JOIN cell2 ON fold <> k AND inner_fold <> j GROUP BY k, j),
        te AS (SELECT k, j, {_sql_sums()} FROM pairs JOIN cell2 ON fold <> k AND inner_fold = j GROUP BY k, j),
        ts AS (SELECT k, j, sx / n AS ax, sy / n AS ay, sxx / n - (sx / n) * (sx / n) AS vx,
                      sxy / n - (sx / n) * (sy / n) AS vxy FROM tr),
        l AS (SELECT fold AS k, i, abs(vxy / sqrt(vx)) * pow(1e-4, i / 99.0) AS lam FROM stat, {SQL_GRID}),
        f AS (SELECT k, j, i, ax, ay, {SQL_SOFT.format(vx="vx", vxy="vxy")} AS b FROM ts JOIN l USING (k)),
        e AS (SELECT k, i, n, (syy - 2 * (ay - b * ax) * sy - 2 * b * sxy + n * (ay - b * ax) * (ay - b * ax)
                               + 2 * (ay - b * ax) * b * sx + b * b * sxx) / n AS mse FROM f JOIN te USING (k, j)),
        m AS (SELECT k, i, sum(n * mse) / sum(n) AS err FROM e GROUP BY k, i),
        best AS (SELECT k, arg_min(i, err) AS i FROM m GROUP BY k),
        picked AS (SELECT k AS fold, ax, ay, {SQL_SOFT.format(vx="vx", vxy="vxy")} AS slope
                   FROM best JOIN l USING (k, i) JOIN stat ON stat.fold = k)
        SELECT period, grp, member, round(my + ay + slope * (x - ax), 4) AS pred FROM base JOIN picked USING (fold)""",
)
def lasso_nested_one(spark, sf):
    """Out-of-fold lasso with the penalty chosen by inner folds: 10 × 10 fits from one pass."""
    scored = linear.cv_penalised(folded(spark, sf), ONE, criterion="cv", keep=PANEL_KEY)
    return rounded(scored.select(*PANEL_KEY, "pred"), 4, "pred")


def _errors(spark, scored, label, name):
    return explore.fit_metrics(scored, label, "pred").withColumn("model", F.lit(name))


@query("lasso_outer_cv")
def lasso_outer_cv(spark, sf):
    """Out-of-fold errors with the penalty chosen by inner folds, by BIC and by EBIC."""
    rows = pinned(folded(spark, sf))
    parts = [
        _errors(spark, linear.cv_penalised(rows, LONG, criterion=c), LONG.label, f"lasso_{c}")
        for c in ("cv", "bic", "ebic")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ridge_outer_cv")
def ridge_outer_cv(spark, sf):
    scored = linear.cv_penalised(folded(spark, sf), LONG, criterion="cv", ridge=True)
    return _errors(spark, scored, LONG.label, "ridge_cv")


# --- generalised linear models -------------------------------------------------------------------

SQL_DOCS = f"""docs AS (
  SELECT d.doc_id, quality, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS long, ln(n_chars + 1) AS log_chars,
         length(text) - length(replace(text, ' ', '')) AS words,
         {_sql_fold(SEED, "d.doc_id")} AS fold
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

TEXT = ModelSpec("quality", ["log_chars", "words", "lines", "digits"])


def labelled_documents(spark, sf):
    """Labelled documents with whole-text counts as features."""
    t = table_reader(spark, sf)
    count = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("double")
    rows = t("documents").join(t("labels"), "doc_id").select(
        "doc_id",
        F.col("quality").cast("double").alias("quality"),
        (F.col("n_chars") >= 1000).cast("double").alias("long"),
        F.log(F.col("n_chars") + 1).alias("log_chars"),
        F.log(count(" ") + 1).alias("words"),
        F.log(count("\n") + 1).alias("lines"),
        F.log(count("[0-9]") + 1).alias("digits"),
    )
    rows = gram.assign_folds(rows, ["doc_id"], K, SEED)
    return gram.assign_folds(rows, ["doc_id"], 5, INNER_SEED, "inner_fold")


@query(
    "glm_cv",
    f"""WITH {SQL_DOCS}, folds AS (SELECT DISTINCT fold FROM docs), kinds AS (SELECT DISTINCT long FROM docs),
        p AS (SELECT f.fold, k.long, avg(d.quality) AS pred FROM folds f, kinds k, docs d
              WHERE d.fold <> f.fold AND d.long = k.long GROUP BY f.fold, k.long)
        SELECT doc_id, round(pred, 6) AS pred FROM docs JOIN p USING (fold, long)""",
)
def glm_cv(spark, sf):
    """Logistic regression on one flag: the held-out fit is the training share per flag value."""
    spec = ModelSpec("quality", ["long"])
    scored = glm.cv_glm(labelled_documents(spark, sf), spec, "binomial", "response", keep=["doc_id"])
    return rounded(scored.select("doc_id", "pred"), 6, "pred")


@query(
    "glm_poisson_cv",
    f"""WITH {SQL_FOLDED}, r AS (SELECT *, CASE WHEN tried > 0 THEN 1 ELSE 0 END AS any_try FROM folded),
        folds AS (SELECT DISTINCT fold FROM r),
        p AS (SELECT f.fold, any_try, avg(made) AS pred FROM folds f, r WHERE r.fold <> f.fold GROUP BY f.fold, any_try)
        SELECT period, grp, member, round(pred, 6) AS pred FROM r JOIN p USING (fold, any_try)""",
)
def glm_poisson_cv(spark, sf):
    scored = glm.cv_glm(flagged(spark, sf), ModelSpec("made", ["any_try"]), "poisson", "response", keep=PANEL_KEY)
    return rounded(scored.select(*PANEL_KEY, "pred"), 6, "pred")


@query("glm_cv_text")
def glm_cv_text(spark, sf):
    """Out-of-fold probabilities from whole-text counts."""
    scored = glm.cv_glm(labelled_documents(spark, sf), TEXT, "binomial", "response", keep=["doc_id"])
    return scored.select("doc_id", "quality", "pred")


@query("lasso_glm_bic")
def lasso_glm_bic(spark, sf):
    return glm.lasso_glm_bic(labelled_documents(spark, sf), TEXT).path_table(spark)


@query("lasso_glm_cv")
def lasso_glm_cv(spark, sf):
    """Out-of-fold lasso probabilities, the penalty by one standard error of inner folds."""
    rows = labelled_documents(spark, sf)
    scored = glm.cv_lasso_glm(rows, TEXT, criterion="cv", scale="response", points=20, keep=["doc_id"])
    return scored.select("doc_id", "quality", "pred")


# --- post-selection inference and model averaging ---------------------------------------------------


@query("post_selection")
def post_selection(spark, sf):
    return select.post_selection(folded(spark, sf), LONG)


SQL_SCORES = f"""{SQL_TWO},
g AS (SELECT *, 0.01 * n AS c FROM t),
sc AS (
  SELECT '0,0' AS included, -ln(3) - ln(1) AS log_post FROM g UNION ALL
  SELECT '1,0', (n - 2) / 2 * ln(1 + c) - (n - 1) / 2 * ln(1 + c * (1 - xy * xy / xx / yy)) - ln(3) - ln(2) FROM g UNION ALL
  SELECT '0,1', (n - 2) / 2 * ln(1 + c) - (n - 1) / 2 * ln(1 + c * (1 - zy * zy / zz / yy)) - ln(3) - ln(2) FROM g UNION ALL
  SELECT '1,1', (n - 3) / 2 * ln(1 + c) - (n - 1) / 2 * ln(1 + c * (rss / yy)) - ln(3) FROM g)"""
TWO = ModelSpec("price", ["mins", "made"])


@query(
    "model_scores",
    f"""WITH {SQL_SCORES} SELECT included, round(log_post, 4) AS log_post,
        round(exp(log_post - max(log_post) OVER ()) / sum(exp(log_post - m)) OVER (), 6) AS prob
        FROM sc, (SELECT max(log_post) AS m FROM sc)""",
)
def model_scores(spark, sf):
    """Log posterior and probability of every model."""
    _, probabilities = select.fit_bayes(M.members(spark, sf), TWO)
    named = probabilities.select(
        F.array_join(F.transform("included", lambda v: v.cast("string")), ",").alias("included"), "log_post", "prob"
    )
    return rounded(rounded(named, 4, "log_post"), 6, "prob")


SQL_PROBABLE = f"""{SQL_SCORES},
pr AS (SELECT included, log_post, exp(log_post - m) / sum(exp(log_post - m)) OVER () AS prob FROM sc, (SELECT max(log_post) AS m FROM sc)),
co AS (SELECT included, log_post, prob, n * 0.01 / (1 + n * 0.01) * CASE included WHEN '1,0' THEN xy / xx WHEN '1,1' THEN bx ELSE 0 END AS b1,
              n * 0.01 / (1 + n * 0.01) * CASE included WHEN '0,1' THEN zy / zz WHEN '1,1' THEN bz ELSE 0 END AS b2 FROM pr, t),
mean AS (SELECT avg(price) AS my, avg(mins) AS m1, avg(made) AS m2 FROM members)"""


@query(
    "model_averages_two",
    f"""WITH {SQL_PROBABLE}
        SELECT '(Intercept)' AS term, round(sum(prob * (my - b1 * m1 - b2 * m2)), 4) AS estimate, round(sum(prob), 6) AS margpp FROM co, mean
        UNION ALL SELECT 'mins', round(sum(prob * b1), 4), round(sum(CASE WHEN included IN ('1,0', '1,1') THEN prob END), 6) FROM co
        UNION ALL SELECT 'made', round(sum(prob * b2), 4), round(sum(CASE WHEN included IN ('0,1', '1,1') THEN prob END), 6) FROM co""",
)
def model_averages_two(spark, sf):
    """Averaged coefficients and inclusion probabilities of two terms."""
    evidence, probabilities = select.fit_bayes(M.members(spark, sf), TWO)
    averaged = select.averaged_coefficients(probabilities, evidence, TWO.terms).select("term", "estimate", "margpp")
    return rounded(rounded(averaged, 4, "estimate"), 6, "margpp")


@query(
    "top_models_two",
    f"""WITH {SQL_PROBABLE}
        SELECT CASE included WHEN '0,0' THEN '' WHEN '1,0' THEN 'mins' WHEN '0,1' THEN 'made' ELSE 'mins,made' END AS model,
               round(log_post, 4) AS log_post, round(prob, 6) AS prob FROM pr ORDER BY log_post DESC LIMIT 2""",
)
def top_models_two(spark, sf):
    """The two most probable models by the names of their terms."""
    _, probabilities = select.fit_bayes(M.members(spark, sf), TWO)
    return rounded(rounded(select.top_models(probabilities, TWO.terms, 2), 4, "log_post"), 6, "prob")


@query("model_averages")
def model_averages(spark, sf):
    """Averaged coefficients, intervals and inclusion probabilities over all models."""
    evidence, probabilities = select.fit_bayes(M.members(spark, sf), LONG)
    return select.averaged_coefficients(probabilities, evidence, LONG.terms).drop("fold")


@query("top_models")
def top_models(spark, sf):
    _, probabilities = select.fit_bayes(M.members(spark, sf), LONG)
    return select.top_models(probabilities, LONG.terms, 10)


# The measures and a flag for every group but the first: more terms than can be listed in
# all combinations.
MANY_GROUPS = list(range(1, 25))
MANY = ModelSpec("price", [*WIDE.features, *[f"grp_{g}" for g in MANY_GROUPS]])


def many_rows(spark, sf):
    return folded(spark, sf).withColumns({f"grp_{g}": (F.col("grp") == g).cast("double") for g in MANY_GROUPS})


@query("bayes_many")
def bayes_many(spark, sf):
    """Averaged coefficients over the models that hold 99 % of the posterior mass, of 29 terms."""
    evidence, weighed = select.fit_bayes(many_rows(spark, sf), MANY)
    weighed = pinned(weighed)
    averaged = select.averaged_coefficients(weighed, evidence, MANY.terms).drop("fold")
    return averaged.crossJoin(F.broadcast(weighed.select("proven").limit(1)))


# One weak term: two models, their evidence and shrunken slope per held-out fold.
WEAK = ModelSpec("price", ["weak"])
SQL_WEAK = f"""{SQL_FOLDED},
base AS (SELECT *, grp - avg(grp) OVER () AS x, price - avg(price) OVER () AS y, avg(price) OVER () AS my FROM folded),
cell AS (SELECT fold, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy, sum(y * y) AS syy
         FROM base GROUP BY fold),
train AS (SELECT c.fold, sum(o.n) AS n, sum(o.sx) AS sx, sum(o.sy) AS sy, sum(o.sxx) AS sxx, sum(o.sxy) AS sxy,
                 sum(o.syy) AS syy FROM cell c JOIN cell o ON c.fold <> o.fold GROUP BY c.fold),
stat AS (SELECT fold, CAST(n AS DOUBLE) AS n, sx / n AS ax, sy / n AS ay, sxx - sx * sx / n AS xx, sxy - sx * sy / n AS xy,
                syy - sy * sy / n AS yy, 0.01 * n AS c FROM train),
odds AS (SELECT *, (n - 2) / 2 * ln(1 + c) - (n - 1) / 2 * ln(1 + c * (1 - xy * xy / xx / yy)) AS gain FROM stat),
fit AS (SELECT *, 1 / (1 + exp(-gain)) * c / (1 + c) * xy / xx AS b FROM odds)"""


@query(
    "bayes_cv_one",
    f"""WITH {SQL_WEAK} SELECT period, grp, member, round(my + ay + b * (x - ax), 4) AS pred FROM base JOIN fit USING (fold)""",
)
def bayes_cv_one(spark, sf):
    """Out-of-fold predictions averaged over the models with and without one weak term."""
    rows = folded(spark, sf).withColumn("weak", F.col("grp").cast("double"))
    return rounded(select.cv_bayes(rows, WEAK, keep=PANEL_KEY).select(*PANEL_KEY, "pred"), 4, "pred")


@query("bayes_cv")
def bayes_cv(spark, sf):
    scored = select.cv_bayes(folded(spark, sf), LONG)
    return _errors(spark, scored, LONG.label, "bayes")


@query(
    "running_share",
    """SELECT event_id, user_id, round(avg(CASE WHEN event_type = 'click' THEN 1.0 ELSE 0.0 END) OVER (
              PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 8) AS share
       FROM events""",
)
def running_share(spark, sf):
    """Running mean of an indicator along each key's sequence, in daily pieces."""
    events = table_reader(spark, sf)("events").select("event_id", "user_id", "ts", "event_type")
    flag = (F.col("event_type") == "click").cast("int")
    out = select.running_mean(events, ["user_id"], ["ts", "event_id"], flag, "share", chunk=F.to_date("ts"))
    return rounded(out.select("event_id", "user_id", "share"), 8, "share")


# --- quantile regression ----------------------------------------------------------------------------

TAUS = [round(0.05 * i, 2) for i in range(1, 20)]


@query(
    "quantile_levels",
    f"""WITH {M.SQL_MEMBERS} """
    + " UNION ALL ".join(
        f"SELECT CAST({t} AS DOUBLE) AS tau, '(Intercept)' AS term, round(quantile_cont(price, {t}), 4) AS estimate FROM members"
        for t in TAUS
    ),
)
def quantile_levels(spark, sf):
    """Quantile regression without terms: the sample quantiles, exactly."""
    return rounded(quantile.fit_quantile(M.members(spark, sf), ModelSpec("price", []), TAUS), 4, "estimate")


FLAG_TAUS = [0.1313, 0.3737, 0.8181]


def flagged(spark, sf):
    return folded(spark, sf).withColumn("any_try", (F.col("tried") > 0).cast("double"))


SQL_FLAGGED = SQL_FOLDED + """,
r AS (SELECT *, CASE WHEN tried > 0 THEN 1 ELSE 0 END AS any_try FROM folded)"""


@query(
    "quantile_flag",
    f"WITH {SQL_FLAGGED}, q AS ("
    + " UNION ALL ".join(
        f"""SELECT CAST({t} AS DOUBLE) AS tau, quantile_disc(price, {t}) FILTER (any_try = 0) AS a,
                   quantile_disc(price, {t}) FILTER (any_try = 1) AS b FROM r"""
        for t in FLAG_TAUS
    )
    + """) SELECT tau, '(Intercept)' AS term, round(a, 4) AS estimate FROM q
         UNION ALL SELECT tau, 'any_try', round(b - a, 4) FROM q""",
)
def quantile_flag(spark, sf):
    """Quantile regression on one flag: the exact fit is the quantile of either side."""
    found = quantile.fit_quantile(flagged(spark, sf), ModelSpec("price", ["any_try"]), FLAG_TAUS)
    return rounded(found, 4, "estimate")


@query(
    "quantile_flag_cv",
    f"""WITH {SQL_FLAGGED}, folds AS (SELECT DISTINCT fold FROM r),
        q AS (SELECT f.fold, any_try, quantile_disc(price, 0.3737) AS pred FROM folds f, r
              WHERE r.fold <> f.fold GROUP BY f.fold, any_try)
        SELECT period, grp, member, round(pred, 4) AS pred FROM r JOIN q USING (fold, any_try)""",
)
def quantile_flag_cv(spark, sf):
    scored = quantile.cv_quantile(flagged(spark, sf), ModelSpec("price", ["any_try"]), 0.3737, keep=PANEL_KEY)
    return rounded(scored.select(*PANEL_KEY, "pred"), 4, "pred")


# Rows below a plane count against those above; of a side's n sorted values the fit takes
# number ceil(level * n).
_SQL_AT = "list_sort(list(price))[CAST(ceil({level} * count(*)) AS BIGINT)]"


@query(
    "quantile_flag_lasso",
    f"""WITH {SQL_FLAGGED}, n AS (SELECT any_try, count(*) AS n, quantile_disc(price, 0.3737) AS q FROM r GROUP BY any_try),
        s AS (SELECT sign(max(q) FILTER (any_try = 1) - max(q) FILTER (any_try = 0)) * 5.3 AS pull FROM n),
        q AS (SELECT any_try, list_sort(list(price))[CAST(ceil(0.3737 * count(*) + CASE any_try WHEN 0 THEN max(pull) ELSE -max(pull) END) AS BIGINT)] AS q
              FROM r, s GROUP BY any_try),
        e AS (SELECT max(q) FILTER (any_try = 0) AS a, max(q) FILTER (any_try = 1) AS b FROM q)
        SELECT CAST(0.3737 AS DOUBLE) AS tau, '(Intercept)' AS term, round(a, 4) AS estimate FROM e
        UNION ALL SELECT 0.3737, 'any_try', round(b - a, 4) FROM e""",
)
def quantile_flag_lasso(spark, sf):
    """L1-penalised quantile regression on one flag: either side's quantile, moved by the penalty."""
    return rounded(quantile.fit_quantile(flagged(spark, sf), ModelSpec("price", ["any_try"]), [0.3737], lam=5.3), 4, "estimate")


@query(
    "quantile_flag_sweep",
    f"""WITH {SQL_FLAGGED}, folds AS (SELECT DISTINCT fold FROM r UNION ALL SELECT -1), taus AS (SELECT unnest({FLAG_TAUS}) AS tau),
        q AS (SELECT f.fold, any_try, tau, {_SQL_AT.format(level="max(tau)")} AS pred FROM folds f, taus, r WHERE r.fold <> f.fold GROUP BY f.fold, any_try, tau),
        e AS (SELECT tau, q.fold = -1 AS inside, sqrt(avg((price - pred) ** 2)) / avg(price) AS nrmse
              FROM r JOIN q ON r.any_try = q.any_try AND (q.fold = -1 OR q.fold = r.fold) GROUP BY ALL)
        SELECT CAST(tau AS DOUBLE) AS tau, round(max(nrmse) FILTER (inside), 8) AS insample, round(max(nrmse) FILTER (NOT inside), 8) AS outsample
        FROM e GROUP BY tau""",
)
def quantile_flag_sweep(spark, sf):
    """Errors within and out of folds at several levels, on one flag."""
    found = quantile.quantile_sweep(flagged(spark, sf), ModelSpec("price", ["any_try"]), FLAG_TAUS)
    return rounded(found, 8, "insample", "outsample")


REPLICATES = 20
_MIX = "CAST(CAST(xor({z}, {z} >> {by}) AS UHUGEINT) * CAST({factor} AS UHUGEINT) % CAST(18446744073709551616 AS UHUGEINT) AS UBIGINT)"


@query(
    "quantile_flag_boot",
    f"""WITH {SQL_FLAGGED},
        h AS (SELECT any_try, price, CAST(concat('0x', substr(md5(concat_ws('|', period, grp, member, '{SEED}')), 1, 16)) AS UBIGINT) AS h FROM r),
        z0 AS (SELECT any_try, price, k, CAST((CAST(h AS UHUGEINT) + CAST(11400714819323198485 AS UHUGEINT) * CAST(k + 1 AS UHUGEINT)) % CAST(18446744073709551616 AS UHUGEINT) AS UBIGINT) AS z
               FROM h, range({REPLICATES}) t(k)),
        z1 AS (SELECT any_try, price, k, {_MIX.format(z="z", by=30, factor="13787848793156543929")} AS z FROM z0),
        z2 AS (SELECT any_try, price, k, {_MIX.format(z="z", by=27, factor="10723151780598845931")} AS z FROM z1),
        u AS (SELECT any_try, price, k, (xor(z, z >> 31) >> 11) / 9007199254740992.0::DOUBLE AS u FROM z2),
        w AS (SELECT any_try, price, k, len([c FOR c IN {{cdf}} IF c <= u]) AS w FROM u),
        c AS (SELECT *, sum(w) OVER (PARTITION BY k, any_try ORDER BY price ROWS UNBOUNDED PRECEDING) AS upto, sum(w) OVER (PARTITION BY k, any_try) AS whole FROM w),
        q AS (SELECT k, any_try, min(price) FILTER (upto >= 0.373737 * whole) AS q FROM c GROUP BY k, any_try),
        b AS (SELECT k, max(q) FILTER (any_try = 0) AS a, max(q) FILTER (any_try = 1) - max(q) FILTER (any_try = 0) AS b FROM q GROUP BY k),
        f AS (SELECT quantile_disc(price, 0.373737) FILTER (any_try = 0) AS a, quantile_disc(price, 0.373737) FILTER (any_try = 1) AS b FROM r),
        e AS (SELECT '(Intercept)' AS term, f.a AS est, s FROM f, (SELECT stddev_samp(a) AS s FROM b)
              UNION ALL SELECT 'any_try', f.b - f.a, s FROM f, (SELECT stddev_samp(b) AS s FROM b))
        SELECT term, round(est, 4) AS estimate, round(s, 4) AS std_error, round(est - 1.959963984540054 * s, 4) AS ci_low,
               round(est + 1.959963984540054 * s, 4) AS ci_high FROM e""".replace("{cdf}", str([float(sum(np.exp(-1.0) / np.prod(np.arange(1.0, i + 1)) for i in range(k + 1))) for k in range(18)])),
)
def quantile_flag_boot(spark, sf):
    """Bootstrap errors of a quantile regression on one flag; weights follow from digests of the keys."""
    found = quantile.bootstrap_quantile(flagged(spark, sf), ModelSpec("price", ["any_try"]), PANEL_KEY, 0.373737, replicates=REPLICATES, seed=SEED)
    return rounded(found, 4, "estimate", "std_error", "ci_low", "ci_high")


@query("quantile_fit")
def quantile_fit(spark, sf):
    return quantile.fit_quantile(M.members(spark, sf), WIDE, [0.5, 0.8])


@query("quantile_lasso")
def quantile_lasso(spark, sf):
    return quantile.fit_quantile(M.members(spark, sf), WIDE, [0.5], lam=50.0)


@query("quantile_boot")
def quantile_boot(spark, sf):
    return quantile.bootstrap_quantile(M.members(spark, sf), WIDE, PANEL_KEY, 0.5, replicates=100, seed=SEED)


@query("quantile_sweep")
def quantile_sweep(spark, sf):
    return quantile.quantile_sweep(folded(spark, sf), WIDE, TAUS)


@query("quantile_cv")
def quantile_cv(spark, sf):
    scored = quantile.cv_quantile(folded(spark, sf), WIDE, 0.5)
    return _errors(spark, scored, WIDE.label, "median")


# --- mixed models --------------------------------------------------------------------------------------

NESTED = mixed.MixedSpec(ModelSpec("mins", []), ["period", "grp"], crossed="period")
NESTED_X = mixed.MixedSpec(ModelSpec("price", ["mins", "made", "hhi"]), ["period", "grp"], crossed="period")
SLOPE = mixed.MixedSpec(ModelSpec("price", ["mins", "made", "hhi"]), ["grp"], crossed="period", slope="hhi")


def panel_rows(spark, sf):
    """Top members with shares and concentration, in scaled units; folds attached."""
    rows = M.shares(spark, sf).select(*PANEL_KEY, "mins", "price", "made", "share", "hhi")
    rows = panel.zscore(rows, ["price", "made", "share", "hhi"])
    return gram.assign_folds(rows, PANEL_KEY, K, SEED)


# Balanced nested layout: restricted likelihood equals the analysis of variance; a negative
# period component is 0 and its mean square joins the groups'.
SQL_ANOVA = f"""{M.SQL_TOP},
cells AS (SELECT period, grp, avg(mins) AS m, sum(mins * mins) - sum(mins) * sum(mins) / count(*) AS ss, count(*) AS k
          FROM top GROUP BY period, grp),
periods AS (SELECT period, avg(m) AS m, sum(m * m) - sum(m) * sum(m) / count(*) AS ss, count(*) AS g FROM cells GROUP BY period),
a AS (SELECT (SELECT sum(ss) / (count(*) * (max(k) - 1)) FROM cells) AS ms_e, (SELECT max(k) FROM cells) AS k,
             (SELECT sum(ss) / sum(g - 1) FROM periods) * (SELECT max(k) FROM cells) AS ms_g, (SELECT max(g) FROM periods) AS g,
             (SELECT count(*) FROM periods) AS t,
             (SELECT (sum(m * m) - sum(m) * sum(m) / count(*)) / (count(*) - 1) FROM periods)
               * (SELECT max(k) FROM cells) * (SELECT max(g) FROM periods) AS ms_p)"""


@query(
    "mixed_nested",
    f"""WITH {SQL_ANOVA}
        SELECT 'period:grp' AS factor, '(Intercept)' AS term, round(CASE WHEN ms_p >= ms_g THEN (ms_g - ms_e) / k
                 ELSE ((ms_p * (t - 1) + ms_g * t * (g - 1)) / (t * g - 1) - ms_e) / k END, 3) AS variance FROM a UNION ALL
        SELECT 'period', '(Intercept)', round(greatest((ms_p - ms_g) / (k * g), 0), 3) FROM a UNION ALL
        SELECT 'Residual', '', round(ms_e, 3) FROM a""",
)
def mixed_nested(spark, sf):
    """Variance components of a balanced nested layout."""
    return rounded(mixed.fit_mixed(M.top_members(spark, sf), NESTED).variances(), 3, "variance")


@query(
    "mixed_modes",
    f"""WITH {SQL_ANOVA},
        v AS (SELECT *, CASE WHEN ms_p >= ms_g THEN ms_g ELSE (ms_p * (t - 1) + ms_g * t * (g - 1)) / (t * g - 1) END AS lg,
                     greatest(ms_p - ms_g, 0) AS dp, (SELECT avg(m) FROM cells) AS mu FROM a),
        u AS (SELECT period, dp / (lg + dp) * (m - mu) AS mode FROM periods, v)
        SELECT 'period' AS factor, CAST(period AS VARCHAR) AS grp, round(mode, 3) + 0.0 AS mode FROM u
        UNION ALL
        SELECT 'period:grp', concat(period, ':', grp), round((lg - ms_e) / lg * (m - mu - u.mode), 3) + 0.0
        FROM cells JOIN u USING (period), v""",
)
def mixed_modes(spark, sf):
    """Conditional modes of a balanced nested layout."""
    modes = mixed.fit_mixed(M.top_members(spark, sf), NESTED).modes()
    return modes.select("factor", "grp", (F.round("condval", 3) + F.lit(0.0)).alias("mode"))


@query("mixed_nested_terms")
def mixed_nested_terms(spark, sf):
    return mixed.fit_mixed(panel_rows(spark, sf), NESTED_X).coefficients()


@query("mixed_slope")
def mixed_slope(spark, sf):
    return mixed.fit_mixed(panel_rows(spark, sf), SLOPE).coefficients()


@query("mixed_slope_variances")
def mixed_slope_variances(spark, sf):
    return mixed.fit_mixed(panel_rows(spark, sf), SLOPE).variances()


@query("mixed_r_squared")
def mixed_r_squared(spark, sf):
    return mixed.fit_mixed(panel_rows(spark, sf), NESTED_X).r_squared()


@query("mixed_ranef")
def mixed_ranef(spark, sf):
    """Conditional modes ± 2 deviations of the slope by group, ordered."""
    return report.caterpillar(mixed.fit_mixed(panel_rows(spark, sf), SLOPE).modes(), "hhi")


@query("mixed_lrt")
def mixed_lrt(spark, sf):
    return mixed.random_term_tests(panel_rows(spark, sf), SLOPE)


@query("mixed_cv")
def mixed_cv(spark, sf):
    return _errors(spark, mixed.cv_mixed(panel_rows(spark, sf), NESTED_X), "price", "mixed")


# The eight top members of every group, by place: all groups have the same design, so that
# the restricted fit is the mean and the covariance of the groups' own least-squares lines,
# and the profile of a coefficient that of a normal mean.
PLACED = mixed.MixedSpec(ModelSpec("mins", ["place"]), ["period", "grp"], slope="place")
SQL_PLACED = f"""{M.SQL_TOP},
placed AS (SELECT period, grp, mins, CAST(row_number() OVER (PARTITION BY period, grp ORDER BY mins DESC, member) AS DOUBLE) AS place FROM top),
lines AS (SELECT period, grp, regr_intercept(mins, place) AS b0, regr_slope(mins, place) AS b1, avg(mins) AS m, regr_syy(mins, place) AS syy,
                 regr_sxy(mins, place) AS sxy, regr_syy(mins, place) - regr_sxy(mins, place) * regr_sxy(mins, place) / regr_sxx(mins, place) AS rss
          FROM placed GROUP BY period, grp),
fit AS (SELECT count(*) AS g, avg(b0) AS b0, avg(b1) AS b1, var_samp(b0) AS s00, covar_samp(b0, b1) AS s01, var_samp(b1) AS s11,
               sum(rss) / (count(*) * 6) AS s2, var_samp(m) AS vm, sum(syy) - sum(sxy) * sum(sxy) / (count(*) * 42.0) AS pooled FROM lines),
comp AS (SELECT *, s00 - s2 * (1 / 8.0 + 20.25 / 42) AS g00, s01 + s2 * 4.5 / 42 AS g01, s11 - s2 / 42 AS g11, s00 * s11 - s01 * s01 AS det FROM fit)"""


def placed_rows(spark, sf):
    """Top members with their place in the group."""
    return panel.top_k(M.members(spark, sf), ["period", "grp"], "mins", M.TOP, ["member"], rank="place").withColumn("place", F.col("place").cast("double"))


@query(
    "mixed_place_terms",
    f"""WITH {SQL_PLACED},
        t AS (SELECT '(Intercept)' AS term, b0 AS b, s00 AS s, g FROM comp UNION ALL SELECT 'place', b1, s11, g FROM comp)
        SELECT term, round(b, 6) AS estimate, round(sqrt(s / g), 6) AS std_error, round(b / sqrt(s / g), 4) AS t_value,
               round(b - sqrt(s * (g - 1) / g * (exp(3.841458820694124 / g) - 1)), 5) AS ci_low,
               round(b + sqrt(s * (g - 1) / g * (exp(3.841458820694124 / g) - 1)), 5) AS ci_high FROM t""",
)
def mixed_place_terms(spark, sf):
    """Fixed effects of a random intercept and slope, with profile intervals."""
    terms = mixed.fit_mixed(placed_rows(spark, sf), PLACED).coefficients()
    return rounded(rounded(rounded(terms, 6, "estimate", "std_error"), 4, "t_value"), 5, "ci_low", "ci_high")


@query(
    "mixed_place_variances",
    f"""WITH {SQL_PLACED}
        SELECT 'period:grp' AS factor, '(Intercept)' AS term, round(g00, 2) AS variance FROM comp UNION ALL
        SELECT 'period:grp', 'place', round(g11, 3) FROM comp UNION ALL
        SELECT 'period:grp', 'cov((Intercept),place)', round(g01, 2) FROM comp UNION ALL
        SELECT 'Residual', '', round(s2, 3) FROM comp""",
)
def mixed_place_variances(spark, sf):
    """Covariance of random intercepts and slopes, and the residual variance."""
    found = mixed.fit_mixed(placed_rows(spark, sf), PLACED).variances()
    fine = F.col("term").isin("place", "")
    return found.withColumn("variance", F.when(fine, F.round("variance", 3)).otherwise(F.round("variance", 2)))


@query(
    "mixed_place_r_squared",
    f"""WITH {SQL_PLACED}, v AS (SELECT b1 * b1 * 42.0 * g / (8 * g - 1) AS f, g00 + 9 * g01 + 25.5 * g11 AS r, s2 FROM comp)
        SELECT round(f / (f + r + s2), 6) AS r2_marginal, round((f + r) / (f + r + s2), 6) AS r2_conditional FROM v""",
)
def mixed_place_r_squared(spark, sf):
    return rounded(mixed.fit_mixed(placed_rows(spark, sf), PLACED).r_squared(), 6, "r2_marginal", "r2_conditional")


@query(
    "mixed_place_ranef",
    f"""WITH {SQL_PLACED},
        u AS (SELECT concat(period, ':', grp) AS grp,
                     (g01 * (s11 * (l.b0 - c.b0) - s01 * (l.b1 - c.b1)) + g11 * (s00 * (l.b1 - c.b1) - s01 * (l.b0 - c.b0))) / det AS mode,
                     sqrt(g11 - (g01 * g01 * s11 - 2 * g01 * g11 * s01 + g11 * g11 * s00) / det) AS sd FROM lines l, comp c)
        SELECT 'period:grp' AS factor, grp, 'place' AS term, round(mode, 4) + 0.0 AS condval, round(sd, 4) AS condsd,
               round(mode - 2 * sd, 4) + 0.0 AS lower, round(mode + 2 * sd, 4) + 0.0 AS upper,
               CAST(row_number() OVER (ORDER BY mode DESC, grp) AS INTEGER) AS display_order FROM u""",
)
def mixed_place_ranef(spark, sf):
    """Conditional modes of the slope with their deviations, the ends of the bars and their order."""
    bars = report.caterpillar(mixed.fit_mixed(placed_rows(spark, sf), PLACED).modes(), "place")
    return bars.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in ("condval", "condsd", "lower", "upper")})


@query(
    "mixed_place_lrt",
    f"""WITH {SQL_PLACED},
        d AS (SELECT g * (ln(det) + ln(8 * 42.0) - 2 * ln(s2)) + 2 * ln(g) - ln(det) + 2 * ln(s2)
                       + (8 * g - 2) * (1 + ln(2 * pi() * s2)) AS whole, g, 8 * vm AS w, pooled / (7 * g - 1) AS e FROM comp),
        l AS (SELECT whole, g * ln(w / e) + ln(8 * g * e / w) + ln(42.0 * g) + (8 * g - 2) * (1 + ln(2 * pi() * e)) AS less FROM d)
        SELECT '<none>' AS term, round(-whole / 2, 4) AS log_lik, CAST(NULL AS DOUBLE) AS lrt, CAST(NULL AS INTEGER) AS df,
               CAST(NULL AS DOUBLE) AS p_value FROM l UNION ALL
        SELECT 'place in (1 + place | period:grp)', round(-less / 2, 4), round(less - whole, 4), 2, round(exp(-(less - whole) / 2), 8) FROM l""",
)
def mixed_place_lrt(spark, sf):
    """Likelihood-ratio test of the random slope."""
    tests = mixed.random_term_tests(placed_rows(spark, sf), PLACED)
    return rounded(rounded(tests, 4, "log_lik", "lrt"), 8, "p_value")


@query(
    "mixed_place_cv",
    f"""WITH {SQL_PLACED}, cells AS (SELECT *, {_sql_fold(SEED, "period, grp")} AS fold FROM lines),
        p AS (SELECT f.fold, avg(b0) AS b0, avg(b1) AS b1 FROM (SELECT DISTINCT fold FROM cells) f JOIN cells c ON c.fold <> f.fold GROUP BY f.fold),
        s AS (SELECT mins AS y, p.b0 + p.b1 * place AS pred FROM placed JOIN cells USING (period, grp) JOIN p USING (fold))
        SELECT count(*) AS n, round(corr(y, pred) ** 2, 6) AS sq_corr, round(sqrt(avg((y - pred) ** 2)), 5) AS rmse,
               round(sqrt(avg((y - pred) ** 2)) / avg(y), 7) AS nrmse, 'place' AS model FROM s""",
)
def mixed_place_cv(spark, sf):
    """Errors of predictions for groups that the model has not seen: folds of whole groups."""
    rows = gram.assign_folds(placed_rows(spark, sf), ["period", "grp"], K, SEED)
    found = _errors(spark, mixed.cv_mixed(rows, PLACED), "mins", "place").drop("ssr")
    return rounded(rounded(rounded(found, 6, "sq_corr"), 5, "rmse"), 7, "nrmse")


# --- clusters ---------------------------------------------------------------------------------------------


def cluster_rows(spark, sf):
    rows = M.shares(spark, sf)
    from panelspark.functions.columns import per_unit, safe_pct

    return rows.select(
        *PANEL_KEY,
        "share",
        *[per_unit(c, "mins").alias(f"{c}_rate") for c in ("price", "disc", "tax")],
        safe_pct("made", "tried").alias("made_pct"),
    )


FEATURE_SETS = {
    "off_mean": ["price_rate", "made_pct"],
    "def_mean": ["disc_rate", "tax_rate"],
    "tot_mean": ["price_rate", "disc_rate", "tax_rate", "made_pct"],
}


@query("cluster_profile")
def cluster_profile(spark, sf):
    """Salary share by cluster of the members' rates, clusters in order of their mean."""
    rows = pinned(cluster_rows(spark, sf))
    grouped = cluster.kmeans_groups(rows, FEATURE_SETS["tot_mean"], 8, seeds=(SEED, INNER_SEED))
    return cluster.cluster_profile(grouped, "share")


@query("cluster_rank")
def cluster_rank(spark, sf):
    """Average share by salary rank beside the ordered means of three clusterings."""
    rows = pinned(cluster_rows(spark, sf))
    ranked = panel.rank_labels(rows, KEYS, "share", 8, ["member"])
    means = explore.mean_band(ranked, ["rank"], "share")
    profiles = {
        name: cluster.cluster_profile(cluster.kmeans_groups(rows, features, 8, seeds=(SEED, INNER_SEED)), "share")
        for name, features in FEATURE_SETS.items()
    }
    return cluster.compare_ranks(means, profiles)


@query("cluster_embeddings")
def cluster_embeddings(spark, sf):
    """k-means of the whole embedding vectors: size and label mix per cluster, by size."""
    vectors = table_reader(spark, sf)("embeddings")
    grouped = cluster.kmeans_vectors(vectors.select("vec_id", "label", "embedding"), "embedding", 8, seeds=(SEED, INNER_SEED))
    return grouped.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels"))


@query(
    "cluster_assign",
    """WITH long AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
       centre AS (SELECT label AS cluster, i, avg(CAST(v AS DOUBLE)) AS c FROM long GROUP BY label, i),
       far AS (SELECT vec_id, any_value(label) AS label, cluster, sum((v - c) * (v - c)) AS d
               FROM long JOIN centre USING (i) GROUP BY vec_id, cluster),
       near AS (SELECT vec_id, any_value(label) AS label, arg_min(cluster, d) AS cluster FROM far GROUP BY vec_id)
       SELECT vec_id, label, cluster FROM near""",
)
def cluster_assign(spark, sf):
    """Every vector's nearest label centre, over all rows and dimensions."""
    vectors = table_reader(spark, sf)("embeddings").select("vec_id", "label", "embedding")
    means = (
        vectors.select("label", F.posexplode("embedding").alias("i", "v"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("v").cast("double")).alias("c"))
        .groupBy("label")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda s: s["c"]).alias("centre"))
        .orderBy("label")
        .collect()
    )
    labels = F.array(*[F.lit(int(r["label"])) for r in means])
    near = cluster.nearest_centre(vectors, "embedding", [r["centre"] for r in means])
    return near.select("vec_id", "label", labels[F.col("cluster")].alias("cluster"))


# --- reports ------------------------------------------------------------------------------------------------


@query(
    "report_errors",
    f"""WITH {SQL_ONE}, p AS (
          SELECT price, my + total.ay + total.vxy / total.vx * (x - total.ax) AS ols_in,
                 my + stat.ay + stat.vxy / stat.vx * (x - stat.ax) AS ols_out, my + total.ay AS mean_in, my + stat.ay AS mean_out
          FROM base JOIN stat USING (fold), total),
        e AS (SELECT avg(price) AS m, sqrt(avg(pow(price - ols_in, 2))) AS a, sqrt(avg(pow(price - ols_out, 2))) AS b,
                     sqrt(avg(pow(price - mean_in, 2))) AS c, sqrt(avg(pow(price - mean_out, 2))) AS d FROM p)
        SELECT 'OLS' AS model, round(a / m, 8) AS insample, round(b / m, 8) AS outsample, 1 AS display_order FROM e
        UNION ALL SELECT 'Mean', round(c / m, 8), round(d / m, 8), 2 FROM e""",
)
def report_errors(spark, sf):
    rows = pinned(folded(spark, sf))
    mean = ModelSpec("price", [])
    scored = {}
    for name, spec in (("OLS", ONE), ("Mean", mean)):
        inside = linear.predict(design_rows(rows, spec), spec.terms, linear.fit_ols(rows, spec).coefficients)
        scored[name] = (inside, linear.cv_ols(rows, spec))
    return rounded(report.error_table(scored, "price"), 8, "insample", "outsample")


@query("report_errors_group")
def report_errors_group(spark, sf):
    """In- and out-of-fold errors of least squares, both lassos and model averaging."""
    rows = pinned(folded(spark, sf))
    base = design_rows(rows, LONG)
    # one pass under all models: totals and training sets are sums of the cells of both folds
    moments = gram.collect_moments(design_rows(rows, LONG, ["fold", "inner_fold"]), [*LONG.terms, LONG.label], ["fold", "inner_fold"])
    inside = lambda b: linear.predict(base, LONG.terms, b)
    evidence, probabilities = select.fit_bayes(rows, LONG, moments=moments)
    averaged = select.averaged_coefficients(probabilities, evidence, LONG.terms)
    by_term = {r["term"]: r["estimate"] for r in averaged.collect()}
    bayes = np.array([by_term[t] for t in [linear.INTERCEPT, *LONG.terms]])
    return report.error_table(
        {
            "OLS": (inside(linear.fit_ols(rows, LONG, moments=moments).coefficients), linear.cv_ols(rows, LONG, moments=moments)),
            "L1 penalisation (BIC)": (
                inside(linear.lasso_bic(rows, LONG, moments=moments).coefficients),
                linear.cv_penalised(rows, LONG, criterion="bic", moments=moments),
            ),
            "L1 penalisation (CV)": (
                inside(linear.penalised_cv(rows, LONG, moments=moments).coefficients),
                linear.cv_penalised(rows, LONG, criterion="cv", moments=moments),
            ),
            "Bayesian model selection": (inside(bayes), select.cv_bayes(rows, LONG, moments=moments)),
        },
        LONG.label,
    )


@query("report_errors_member")
def report_errors_member(spark, sf):
    """In- and out-of-fold errors of least squares, the median fit and both mixed models."""
    rows = pinned(panel_rows(spark, sf).withColumn("price", F.col("price") + 10))
    spec = NESTED_X.fixed
    base = design_rows(rows, spec)
    median = {r["term"]: r["estimate"] for r in quantile.fit_quantile(rows, spec, [0.5]).collect()}
    middle = np.array([median[t] for t in [linear.INTERCEPT, *spec.terms]])
    return report.error_table(
        {
            "OLS": (
                linear.predict(base, spec.terms, linear.fit_ols(rows, spec).coefficients),
                linear.cv_ols(rows, spec),
            ),
            "Median regression": (linear.predict(base, spec.terms, middle), quantile.cv_quantile(rows, spec, 0.5)),
            "Mixed effects (nested intercepts)": (
                mixed.fit_mixed(rows, NESTED_X).predict(),
                mixed.cv_mixed(rows, NESTED_X),
            ),
            "Mixed effects (varying slope)": (mixed.fit_mixed(rows, SLOPE).predict(), mixed.cv_mixed(rows, SLOPE)),
        },
        spec.label,
    )


@query(
    "report_terms",
    f"""WITH {M.SQL_MEMBERS}, f AS (
          SELECT concat('grp_', grp) AS term, regr_slope(price, mins) AS estimate FROM members GROUP BY grp),
        b AS (SELECT *, CASE WHEN term IN ('grp_7', 'grp_3', 'grp_11') THEN 1 ELSE 0 END AS block,
                     CASE term WHEN 'grp_7' THEN 1 WHEN 'grp_3' THEN 2 WHEN 'grp_11' THEN 3 END AS place FROM f)
        SELECT term, round(estimate, 5) AS estimate, CASE block WHEN 1 THEN 'blue' ELSE 'lightblue' END AS color,
               CAST(row_number() OVER (ORDER BY block, place, term) AS INTEGER) AS display_order FROM b""",
)
def report_terms(spark, sf):
    """Terms sorted by name, three chosen ones last, numbered and coloured for display."""
    fit = explore.facet_fit(M.members(spark, sf), "grp", "mins", "price")
    terms = fit.select(F.concat(F.lit("grp_"), F.col("grp").cast("string")).alias("term"), F.col("slope").alias("estimate"))
    return rounded(report.coefficient_blocks(terms, ["grp_7", "grp_3", "grp_11"]), 5, "estimate")


@query("report_lasso_terms")
def report_lasso_terms(spark, sf):
    """Selected terms, largest first, with the significance flag of each."""
    inference = report.flagged_terms(select.post_selection(folded(spark, sf), LONG)).drop("display_order")
    return report.selected_terms(inference)


@query("report_bayes_terms")
def report_bayes_terms(spark, sf):
    evidence, probabilities = select.fit_bayes(M.members(spark, sf), LONG)
    averaged = select.averaged_coefficients(probabilities, evidence, LONG.terms).drop("fold")
    return report.probability_flags(averaged).join(
        report.probable_terms(averaged).select("term", "display_order"), "term", "left"
    )
