"""Key repair, code conforming and joins with explicit null rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.columns import recode


def recode_columns(df: DataFrame, pairs: Mapping[str, str], *columns: str) -> DataFrame:
    """Recode several columns with one literal map."""
    return df.withColumns({c: recode(c, pairs) for c in columns})


def recode_from_table(df: DataFrame, column: str, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """Recode from a dictionary table; values it does not list pass through.

    The table's keys must be unique. No broadcast is forced: the dictionary may
    have any size and Spark broadcasts it by itself when it is small.
    """
    table = mapping.select(F.col(old).alias("__old"), F.col(new).alias("__new"))
    return (
        df.join(table, F.col(column) == F.col("__old"), "left")
        .withColumn(column, F.coalesce("__new", column))
        .drop("__old", "__new")
    )


def conform_codes(df: DataFrame, column: str, pairs: Mapping[str, str]) -> DataFrame:
    """Bring renamed group codes to one code. Where it stands among the joins matters."""
    return df.withColumn(column, recode(column, pairs))


def code_lookup(df: DataFrame, column: str, codes: Mapping[str, str], out: str) -> DataFrame:
    """Attach the code of a name; names without a code get null."""
    literal = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return df.withColumn(out, F.try_element_at(literal, F.col(column)))


def left_join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] | Mapping[str, str],
    null_safe: bool = False,
) -> DataFrame:
    """Left equi-join on same-named keys, or on ``{left: right}`` names.

    The right-hand key columns do not survive. ``null_safe`` lets null match null.
    """
    pairs = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    renamed = right.withColumnsRenamed({r: f"__r_{r}" for r in pairs.values()})

    def equal(a: str, b: str) -> Column:
        lhs, rhs = left[a], renamed[f"__r_{b}"]
        return lhs.eqNullSafe(rhs) if null_safe else lhs == rhs

    on = reduce(lambda x, y: x & y, [equal(a, b) for a, b in pairs.items()])
    return left.join(renamed, on, "left").drop(*[f"__r_{r}" for r in pairs.values()])


def unmatched_keys(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Distinct values of ``key`` that the dimension does not hold."""
    keys = dim.select(F.col(dim_key or key).alias("__k"))
    return df.select(key).join(keys, F.col(key) == F.col("__k"), "left_anti").distinct()


def pair_by_position(unmatched: DataFrame, key: str, values: Sequence[str]) -> dict[str, str]:
    """Pair the sorted distinct keys with a literal list of the same length.

    Reads at most ``len(values) + 1`` keys, so the list bounds what is fetched;
    another number of keys is an error, as the pairs would be wrong.
    """
    rows = (
        unmatched.select(key)
        .filter(F.col(key).isNotNull())
        .distinct()
        .orderBy(key)
        .limit(len(values) + 1)
        .collect()
    )
    if len(rows) != len(values):
        more = "or more " if len(rows) > len(values) else ""
        raise ValueError(f"{len(values)} replacement values for {len(rows)} {more}keys")
    return {row[0]: value for row, value in zip(rows, values, strict=True)}


def repair_and_match(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    repairs: Mapping[str, str],
    dim_key: str | None = None,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Match to a dimension, repairing the keys that do not match as they stand.

    A key the dimension holds is used unchanged, also when it is listed in
    ``repairs``; others are replaced and then matched, and rows still without a
    match are dropped unless ``keep_unmatched``. The result's key is the
    repaired one. One pass over the facts: only the rows with a listed
    replacement need to know whether their key exists, so that test runs
    against the few listed keys and not against the whole dimension.
    """
    dim_key = dim_key or key
    how = "left" if keep_unmatched else "inner"
    if repairs:
        listed = (
            dim.select(F.col(dim_key).alias("__k")).filter(F.col("__k").isin(*repairs)).distinct()
        )
        # at most len(repairs) rows
        known = F.broadcast(listed.withColumn("__known", F.lit(True)))
        df = (
            df.join(known, F.col(key) == F.col("__k"), "left")
            .withColumn(key, F.when(F.col("__known"), F.col(key)).otherwise(recode(key, repairs)))
            .drop("__k", "__known")
        )
    right = dim.withColumnRenamed(dim_key, "__dim_key")
    return df.join(right, F.col(key) == F.col("__dim_key"), how).drop("__dim_key")


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null (or NaN) in the given columns, or in any column."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
