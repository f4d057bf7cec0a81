"""Model specifications, design rows and parameter grids."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ModelSpec:
    """A linear predictor: main effects plus products of two columns."""

    label: str
    features: Sequence[str]
    interactions: Sequence[tuple[str, str]] = field(default_factory=tuple)

    @property
    def terms(self) -> list[str]:
        return [*self.features, *[f"{a}:{b}" for a, b in self.interactions]]


def all_interactions(columns: Sequence[str]) -> list[tuple[str, str]]:
    """Every unordered pair of columns."""
    return list(combinations(columns, 2))


def interactions_with(
    columns: Sequence[str], partner: str, without: Sequence[str] = ()
) -> list[tuple[str, str]]:
    """The pairs that contain ``partner``, except those with a column in ``without``."""
    test = re.compile(rf"^{re.escape(partner)}$")
    return [
        (a, b)
        for a, b in all_interactions(columns)
        if (test.search(a) or test.search(b)) and not {a, b} & set(without)
    ]


def design_rows(df: DataFrame, spec: ModelSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns, response and one double column per term; complete cases only."""
    terms = [F.col(c).cast("double").alias(c) for c in spec.features]
    terms += [
        (F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{a}:{b}") for a, b in spec.interactions
    ]
    chosen = [F.col(c) for c in keep if c != spec.label and c not in spec.features]
    rows = df.select(*chosen, F.col(spec.label).cast("double").alias(spec.label), *terms)
    return rows.na.drop("any", subset=[spec.label, *spec.terms])


def design_array(df: DataFrame, spec: ModelSpec, keep: Sequence[str] = ()) -> DataFrame:
    """The same rows with the terms packed into one array column ``x``."""
    rows = design_rows(df, spec, keep)
    kept = [c for c in rows.columns if c not in spec.terms]
    return rows.select(*kept, F.array(*[F.col(f"`{t}`") for t in spec.terms]).alias("x"))


def value_grid(spark: SparkSession, start: float, stop: float, points: int, name: str = "value") -> DataFrame:
    """``points`` evenly spaced values from ``start`` to ``stop``."""
    step = (stop - start) / (points - 1) if points > 1 else 0.0
    return spark.range(points).select((F.lit(float(start)) + F.col("id") * F.lit(step)).alias(name))
