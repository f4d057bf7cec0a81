"""Tables behind the result charts. They hold one row per model or term."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.operators.clean import left_join_on, union_by_name
from panelspark.operators.explore import fit_metrics
from panelspark.operators.linear import INTERCEPT


def error_table(models: Mapping[str, tuple[DataFrame, DataFrame]], label: str, pred: str = "pred") -> DataFrame:
    """``(model, insample, outsample)``: RMSE over the mean response of each model's predictions."""
    sides = []
    for name, (inside, outside) in models.items():
        for side, scored in (("insample", inside), ("outsample", outside)):
            error = fit_metrics(scored, label, pred).select(
                F.lit(name).alias("model"), F.lit(side).alias("side"), "nrmse"
            )
            sides.append(error)
    order = F.create_map(*[F.lit(v) for i, name in enumerate(models) for v in (name, i)])
    return (
        union_by_name(*sides)
        .groupBy("model")
        .pivot("side", ["insample", "outsample"])
        .agg(F.first("nrmse"))
        .withColumn("display_order", order[F.col("model")] + 1)
    )


def _numbered(df: DataFrame, *order) -> DataFrame:
    """Number the rows of a term table (one row per term) for display."""
    return df.withColumn("display_order", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order)))


def selected_terms(inference: DataFrame) -> DataFrame:
    """Terms the lasso kept, largest estimate first."""
    return _numbered(inference.filter("estimate <> 0"), F.col("estimate").desc(), F.col("term"))


def flagged_terms(inference: DataFrame, alpha: float = 0.1) -> DataFrame:
    """All terms, marked where the p-value is below ``alpha`` (null where there is none)."""
    small = F.col("p_value") < alpha
    return _numbered(
        inference.withColumn("color", F.when(small, "red").when(~small, "grey")),
        F.col("estimate").desc(),
        F.col("term"),
    )


def probable_terms(averaged: DataFrame, least: float = 0.9) -> DataFrame:
    """Terms whose inclusion probability reaches ``least``, largest estimate first."""
    kept = averaged.filter((F.col("margpp") >= least) & (F.col("term") != INTERCEPT))
    return _numbered(kept, F.col("estimate").desc(), F.col("term"))


def probability_flags(averaged: DataFrame, above: float = 0.9) -> DataFrame:
    """All terms, marked where the inclusion probability exceeds ``above``."""
    return averaged.filter(F.col("term") != INTERCEPT).withColumn(
        "color", F.when(F.col("margpp") > above, "red").otherwise("grey")
    )


def coefficient_blocks(
    coefficients: DataFrame, last: Sequence[str], colors: tuple[str, str] = ("lightblue", "blue")
) -> DataFrame:
    """Terms sorted by name, then the ``last`` ones as they come, numbered and coloured by block."""
    rest = coefficients.filter(~F.col("term").isin(INTERCEPT, *last)).withColumns(
        {"block": F.lit(0), "color": F.lit(colors[0])}
    )
    tail = coefficients.filter(F.col("term").isin(*last)).withColumns(
        {"block": F.lit(1), "color": F.lit(colors[1])}
    )
    place = F.array_position(F.array(*[F.lit(t) for t in last]), F.col("term"))
    stacked = union_by_name(rest, tail)
    return _numbered(stacked, F.col("block"), F.when(F.col("block") == 1, place), F.col("term")).drop("block")


def caterpillar(modes: DataFrame, term: str | None = None, width: float = 2.0, pieces: int = 500) -> DataFrame:
    """Conditional modes ± ``width`` deviations, ordered by the mode within a grouping factor.

    A factor's levels are cut into ``pieces`` at approximate quantiles and
    numbered piece by piece, so a factor of any number of levels is not sorted
    in one task.
    """
    kept = modes if term is None else modes.filter(F.col("term") == term)
    half = F.col("condsd") * width
    keys = ["factor", "term"]
    cuts = kept.groupBy(*keys).agg(F.percentile_approx("condval", [i / pieces for i in range(1, pieces)], 100 * pieces).alias("__cuts"))
    placed = left_join_on(kept, cuts, keys, null_safe=True)
    placed = placed.withColumn("__piece", F.size(F.filter("__cuts", lambda c: c > F.col("condval")))).drop("__cuts")
    sizes = placed.groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(*keys).orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*keys, "__piece", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    inside = F.row_number().over(W.partitionBy(*keys, "__piece").orderBy(F.col("condval").desc(), "grp"))
    ranked = left_join_on(placed.withColumn("__inside", inside), starts, [*keys, "__piece"], null_safe=True)
    return ranked.withColumns(
        {
            "lower": F.col("condval") - half,
            "upper": F.col("condval") + half,
            "display_order": (F.col("__start") + F.col("__inside")).cast("int"),
        }
    ).drop("__piece", "__inside", "__start")
