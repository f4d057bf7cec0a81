"""Distributions, straight-line fits and error measures behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import dist
from panelspark.operators.panel import group_quantiles
from panelspark.session import reused


def mean_band(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Mean, sample deviation and mean ± 1 deviation per group."""
    return (
        df.groupBy(*keys)
        .agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"))
        .withColumns({"upper": F.col("mean") + F.col("sd"), "lower": F.col("mean") - F.col("sd")})
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts and density over ``bins`` equal bins of the column's range.

    Bins without rows are not listed. One pass for the range and one for the
    counts; what is shuffled is at most ``bins`` rows per task.
    """
    known = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    ends = (
        known.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"))
        .select(F.struct("lo", "hi", "n").alias("ends"))
        .scalar()
    )
    width = (ends["hi"] - ends["lo"]) / bins
    place = F.floor(F.try_divide(F.col("x") - ends["lo"], width))
    index = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        known.groupBy(index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            (ends["lo"] + F.col("bin") * width).alias("left"),
            (ends["lo"] + (F.col("bin") + 1) * width).alias("right"),
            "count",
            F.try_divide(F.col("count").cast("double"), ends["n"] * width).alias("density"),
        )
    )


def density_grid(df: DataFrame, column: str, points: int = 512, fineness: int = 32) -> DataFrame:
    """Gaussian kernel density on an even grid over the column's range.

    Rows are first reduced to cells of the ``fineness``-th part of the bandwidth,
    with the first six moments about the cell's middle; the kernel's series about
    the middle then gives the sum over a cell's rows to about 1e-11 of its height.
    A cell reaches the grid points within nine bandwidths (beyond, the kernel is
    below 3e-18 of its height). The bandwidth is ``0.9 · min(sd, IQR / 1.34) · n^(-1/5)``.
    """
    rows = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL")
    with reused(rows) as known:
        lo, hi, n, sd = known.agg(F.min("x"), F.max("x"), F.count("x"), F.stddev_samp("x")).first()
        if not n or hi <= lo:
            raise ValueError(f"{column} has no spread to estimate a density from")
        q1, q3 = group_quantiles(known, [], "x", {"q1": 0.25, "q3": 0.75}).first()
    bw = 0.9 * min(sd, (q3 - q1) / 1.34 or sd) * n**-0.2
    step = (hi - lo) / (points - 1)
    cell = F.floor((F.col("x") - lo) / (bw / fineness))
    middle = lo + (F.col("cell") + 0.5) * (bw / fineness)
    off = (F.col("x") - middle) / bw
    powers = [F.sum(F.pow(off, F.lit(float(k)))).alias(f"s{k}") for k in range(6)]
    cells = rows.withColumn("cell", cell).groupBy("cell").agg(*powers).withColumn("at", middle)
    near = F.sequence(
        F.greatest(F.ceil((F.col("at") - 9 * bw - lo) / step), F.lit(0)).cast("int"),
        F.least(F.floor((F.col("at") + 9 * bw - lo) / step), F.lit(points - 1)).cast("int"),
    )
    reached = (F.col("at") + 9 * bw >= lo + F.ceil((F.col("at") - 9 * bw - lo) / step) * step)
    spots = cells.filter(reached).withColumn("point", F.explode(near))
    z = (lo + F.col("point") * step - F.col("at")) / bw
    hermite = [F.lit(1.0), z]
    for k in range(1, 5):
        hermite.append(z * hermite[k] - k * hermite[k - 1])
    series, factorial = F.lit(0.0), 1.0
    for k in range(6):
        factorial *= max(k, 1)
        series = series + hermite[k] * F.col(f"s{k}") / factorial
    height = F.exp(-0.5 * z * z) * series / (F.lit(n * bw) * F.sqrt(2 * F.pi()))
    summed = spots.groupBy("point").agg(F.sum(height).alias("density"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    # points far from all rows have a density of 0
    found = grid.join(summed, "point", "left")
    return found.select("point", (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"), F.coalesce("density", F.lit(0.0)).alias("density"))


def facet_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per (row, metric) with the metric's value."""
    return df.unpivot(list(ids), list(metrics), "metric", "value")


def facet_fit(df: DataFrame, facet: str, x: str, y: str) -> DataFrame:
    """Least-squares line per facet, with what its confidence band needs."""
    r = lambda name: getattr(F, f"regr_{name}")(y, x).alias(name)
    fit = df.groupBy(facet).agg(
        r("count"), r("slope"), r("intercept"), r("r2"), r("sxx"), r("syy"), r("sxy"), r("avgx"),
        F.min(F.when(F.col(y).isNotNull(), F.col(x))).alias("x_min"),
        F.max(F.when(F.col(y).isNotNull(), F.col(x))).alias("x_max"),
    )
    rss = F.greatest(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.lit(0.0))
    return fit.withColumn("sigma", F.sqrt(F.try_divide(rss, F.col("count") - 2)))


def facet_band(fits: DataFrame, facet: str, level: float = 0.95, points: int = 80) -> DataFrame:
    """The fitted line and its pointwise confidence band on a grid per facet."""

    @F.pandas_udf("double")
    def t_factor(count: pd.Series) -> pd.Series:
        return count.map(lambda n: dist.t_ppf(0.5 + level / 2, n - 2) if n and n > 2 else None)

    grid = fits.withColumn("t", t_factor(F.col("count").cast("double"))).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    )
    grid = grid.withColumn(
        "x", F.col("x_min") + F.col("point") * (F.col("x_max") - F.col("x_min")) / (points - 1)
    ).withColumn("fit", F.col("intercept") + F.col("slope") * F.col("x"))
    off = F.col("x") - F.col("avgx")
    half = F.col("t") * F.col("sigma") * F.sqrt(1 / F.col("count") + F.try_divide(off * off, F.col("sxx")))
    return grid.select(facet, "point", "x", "fit", (F.col("fit") - half).alias("lower"), (F.col("fit") + half).alias("upper"))


def fit_metrics(df: DataFrame, y: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Squared correlation, RMSE, RMSE over the mean, and residual sum of squares."""
    known = df.filter(F.col(y).isNotNull() & F.col(pred).isNotNull())
    err = F.pow(F.col(y) - F.col(pred), 2)
    rmse = F.sqrt(F.avg(err))
    return known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.pow(F.corr(y, pred), 2).alias("sq_corr"),
        rmse.alias("rmse"),
        F.try_divide(rmse, F.avg(y)).alias("nrmse"),
        F.sum(err).alias("ssr"),
    )


def table_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def column_spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample deviation of every column, and whether the column varies at all."""
    one = df.agg(*[F.stddev_samp(c).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column", "sd").withColumn("varies", F.col("sd") > 0)


def varying_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns with a positive sample deviation, in the given order."""
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is not None and row[c] > 0]
