"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def conditional(test: Column, when_true, when_false) -> Column:
    """Two-branch choice; a null test gives null, not the second branch."""
    return F.when(test, when_true).when(~test, when_false)


def recode(column: ColumnLike, pairs: Mapping[str, str]) -> Column:
    """Replace listed values and pass all others through.

    The map is a literal of the caller's, so its size does not grow with data.
    """
    col = as_column(column)
    if not pairs:
        return col
    literal = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return F.coalesce(F.try_element_at(literal, col), col)


def duration_minutes(column: ColumnLike) -> Column:
    """``M:S`` text to minutes; blank, unreadable or other forms give null."""
    parts = F.split(as_column(column), ":")
    minutes = F.try_element_at(parts, F.lit(1)).try_cast("double")
    seconds = F.try_element_at(parts, F.lit(2)).try_cast("double")
    return F.when(F.size(parts) == 2, minutes + seconds / 60)


def per_unit(amount: ColumnLike, exposure: ColumnLike, unit: float = 10.0) -> Column:
    """Amount per ``unit`` of exposure; null when there was no exposure."""
    return F.try_divide(as_column(amount).cast("double"), as_column(exposure).cast("double")) * unit


def safe_pct(made: ColumnLike, tried: ColumnLike) -> Column:
    """Percentage that is 0 when nothing was tried."""
    ratio = F.try_divide(as_column(made).cast("double"), as_column(tried).cast("double"))
    return F.coalesce(ratio * 100, F.lit(0.0))


def strip_slashes(column: ColumnLike) -> Column:
    """Remove every run of ``/``."""
    return F.regexp_replace(as_column(column), "/+", "")


def strip_suffix(column: ColumnLike, mark: str = "*") -> Column:
    """Remove trailing ``mark`` characters, such as an honours asterisk."""
    escaped = "".join("\\" + c if not c.isalnum() else c for c in mark)
    return F.regexp_replace(as_column(column), f"(?:{escaped})+$", "")


def _plain(aggregate: Column) -> Column:
    return aggregate


def strict_sum(column: ColumnLike, over: Callable[[Column], Column] = _plain) -> Column:
    """Sum that is null as soon as one value is null; ``over`` turns each part into a window."""
    col = as_column(column)
    return F.when(over(F.count(col)) == over(F.count(F.lit(1))), over(F.sum(col)))


def strict_mean(column: ColumnLike, over: Callable[[Column], Column] = _plain) -> Column:
    col = as_column(column)
    return F.when(over(F.count(col)) == over(F.count(F.lit(1))), over(F.avg(col)))


def sum_or_zero(column: ColumnLike) -> Column:
    """Sum over the non-null values; 0 when there are none."""
    col = as_column(column)
    return F.coalesce(F.sum(col), F.lit(0).cast("double"))


def row_sum(columns: Sequence[ColumnLike] | None = None, array: ColumnLike | None = None) -> Column:
    """Sum across columns of a row, or over the elements of an array column."""
    if array is not None:
        return F.aggregate(as_column(array), F.lit(0).cast("long"), lambda acc, x: acc + x)
    return reduce(lambda a, b: a + b, [as_column(c) for c in columns])


def cols_between(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in column order, both included."""
    lo, hi = df.columns.index(first), df.columns.index(last)
    if lo > hi:
        raise ValueError(f"{first} comes after {last}")
    return df.columns[lo : hi + 1]


def scalar_of(stats: DataFrame, column: str) -> Column:
    """One value of a one-row frame as a scalar subquery (no join)."""
    return stats.select(column).scalar()

