"""Group aggregates, top-k, shares, imputation, ranks and reshapes of a panel.

Groups may be very uneven. Whatever needs all rows of a group together is
either pre-aggregated before the shuffle, split into chunks, or limited to
groups whose size the caller has bounded (``top_k`` does that).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.functions.columns import strict_mean, strict_sum, sum_or_zero
from panelspark.operators.clean import left_join_on


def _struct_of(order_by: Sequence[str]) -> Column:
    return F.struct(*order_by)


def first_per_group(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Value of each column in the first row of a group, under a total order."""
    first = F.min_by(F.struct(*columns), _struct_of(order_by)).alias("__first")
    return df.groupBy(*keys).agg(first).select(*keys, "__first.*")


def keep_first_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The whole first row of each key.

    An aggregate and not a window: each map task sends one row per key, so
    copies of a hot key never meet in one task.
    """
    row = F.min_by(F.struct(*df.columns), _struct_of(order_by)).alias("__row")
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(row).select("__row.*")


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def group_sums(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    strict: bool = False,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Sum columns per group; nulls are skipped, or spoil the sum when ``strict``."""
    total = strict_sum if strict else sum_or_zero
    aggs = [total(c).alias(c) for c in columns]
    aggs += [expr.alias(name) for name, expr in (extra or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def wins_by_group(
    games: DataFrame, home: str, visitor: str, home_wins: str, period: str, out: str = "wins"
) -> DataFrame:
    """Games won per (period, group), from both sides of every game.

    A game without a result makes the sum null for both its groups.
    """
    won = F.col(home_wins) == 1
    winner = F.when(won, F.col(home)).when(~won, F.col(visitor))
    sides = games.select(period, winner.alias("__winner"), home, visitor).unpivot(
        [period, "__winner"], [home, visitor], "__side", "group_id"
    )
    flag = F.when(F.col("__winner") == F.col("group_id"), 1).when(
        F.col("__winner") != F.col("group_id"), 0
    )
    return sides.select(period, "group_id", flag.alias("__flag")).groupBy(period, "group_id").agg(
        strict_sum("__flag").alias(out)
    )


def top_k(
    df: DataFrame, keys: Sequence[str], by: str, k: int, tiebreak: Sequence[str], rank: str | None = None
) -> DataFrame:
    """The ``k`` rows of each group with the largest ``by``, ties cut by ``tiebreak``.

    The rank filter becomes a group limit below the shuffle, so a map task
    sends at most ``k`` rows of a group however large the group is.
    """
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc() for c in tiebreak]]
    name = rank or "__rank"
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def with_group_aggregates(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, Callable[[Callable[[Column], Column]], Column]],
    bounded_groups: bool = False,
) -> DataFrame:
    """Attach group aggregates to every row.

    Each entry of ``aggs`` builds its expression from a wrapper put around every
    aggregate in it. With ``bounded_groups`` (say, after ``top_k``) the wrapper
    is a window, which shares the exchange that is already there. Otherwise the
    aggregates are computed with map-side combining and joined back: no task
    ever holds a whole group, and a hot key is split by the adaptive skew join
    or never shuffled when the aggregate table is small.
    """
    if bounded_groups:
        w = W.partitionBy(*keys)
        return df.withColumns({name: build(lambda agg: agg.over(w)) for name, build in aggs.items()})
    table = df.groupBy(*keys).agg(*[build(lambda agg: agg).alias(name) for name, build in aggs.items()])
    return left_join_on(df, table, keys, null_safe=True)


def share_of_group(
    df: DataFrame, keys: Sequence[str], column: str, out: str, bounded_groups: bool = False
) -> DataFrame:
    """Percentage share of a value in its group's total; null if the total is."""
    total = {"__total": lambda over: strict_sum(column, over)}
    with_total = with_group_aggregates(df, keys, total, bounded_groups)
    return with_total.withColumn(out, F.try_divide(F.col(column), F.col("__total")) * 100).drop("__total")


def concentration(
    df: DataFrame, keys: Sequence[str], share: str, out: str = "hhi", bounded_groups: bool = False
) -> DataFrame:
    """Herfindahl-Hirschman index of a group's shares, on every row."""
    squared = F.col(share) * F.col(share)
    return with_group_aggregates(df, keys, {out: lambda over: strict_sum(squared, over)}, bounded_groups)


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probs: Mapping[str, float],
    pieces: int = 256,
) -> DataFrame:
    """Exact interpolated quantiles per group that never hold a large group in one task.

    Equal values are counted first. A bounded quantile sketch then proposes cut
    points for each group's values, exact counts tell which of the pieces hold
    the wanted ranks, and only those are sorted, each by itself. ``probs`` maps
    output names to probabilities. Without keys the whole table is one group.
    """
    keys = list(keys)
    if not keys:
        whole = df.select(column).withColumn("__all", F.lit(1))
        return group_quantiles(whole, ["__all"], column, probs, pieces).drop("__all")
    counts = df.groupBy(*keys, F.col(column).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    # one row for each group; nulls take no part in the sketch
    shares = [i / pieces for i in range(1, pieces)]
    groups = counts.groupBy(*keys).agg(
        F.array_distinct(F.percentile_approx("__v", shares, 100 * pieces)).alias("__cuts"),
        F.sum(F.when(F.col("__v").isNotNull(), F.col("__n"))).alias("__total"),
    )
    placed = left_join_on(counts, groups, keys, null_safe=True).withColumn(
        "__piece", F.when(F.col("__v").isNotNull(), F.size(F.filter("__cuts", lambda c: c < F.col("__v"))))
    )
    sizes = placed.groupBy(*keys, "__piece").agg(F.sum("__n").alias("__pn"), F.first("__total").alias("__total"))
    w = W.partitionBy(*keys).orderBy(F.col("__piece").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    ends = sizes.filter("__piece IS NOT NULL").withColumn("__end", F.sum("__pn").over(w))
    # the ranks of all probabilities are one array column, which keeps the plan small
    ends = ends.select("*", (F.col("__end") - F.col("__pn")).alias("__before"), _ranks(probs.values()).alias("__ranks"))
    holds = F.exists("__ranks", lambda r: (F.col("__end") >= r["low"]) & (F.col("__before") < r["high"]))
    wanted = ends.filter(holds).select(*keys, "__piece", "__before", "__ranks")
    ranked = left_join_on(placed.select(*keys, "__piece", "__v", "__n"), wanted, [*keys, "__piece"], null_safe=True)
    inside = W.partitionBy(*keys, "__piece").orderBy("__v").rowsBetween(W.unboundedPreceding, 0)
    ranked = ranked.filter("__before IS NOT NULL").withColumn("__upto", F.col("__before") + F.sum("__n").over(inside))
    rank = lambda i, end: F.col("__ranks")[i][end]
    at = lambda r: F.max(F.when((F.col("__upto") - F.col("__n") < r) & (r <= F.col("__upto")), F.col("__v")))
    found = ranked.groupBy(*keys).agg(
        *[F.array(*[at(rank(i, end)) for i in range(len(probs))]).alias(f"__{end}") for end in ("low", "high")],
        F.max("__ranks").alias("__ranks"),
    )
    low, high = F.col("__low"), F.col("__high")
    values = found.select(*keys, *[(low[i] + rank(i, "part") * (high[i] - low[i])).alias(name) for i, name in enumerate(probs)])
    return left_join_on(groups.select(*keys), values, keys, null_safe=True)


def _ranks(probs) -> Column:
    """Per probability, the two ranks to interpolate between and the part of the way."""
    out = []
    for p in probs:
        place = (F.col("__total") - 1) * F.lit(float(p))
        low = F.floor(place) + 1
        out.append(F.struct(low.alias("low"), F.least(low + 1, F.col("__total")).alias("high"), (place - F.floor(place)).alias("part")))
    return F.array(*out)


def group_quantile(
    df: DataFrame, keys: Sequence[str], column: str, prob: float, out: str = "quantile", pieces: int = 256
) -> DataFrame:
    return group_quantiles(df, keys, column, {out: prob}, pieces)


def group_median(
    df: DataFrame, keys: Sequence[str], column: str, out: str = "median", pieces: int = 256
) -> DataFrame:
    return group_quantiles(df, keys, column, {out: 0.5}, pieces)


def impute_median(
    df: DataFrame, keys: Sequence[str], column: str, bounded_groups: bool = False
) -> DataFrame:
    """Replace nulls by the median of the group's other values.

    ``bounded_groups`` uses the window median over the group's few rows; else
    the medians come from ``group_median`` and are joined back.
    """
    if bounded_groups:
        middle = F.median(column).over(W.partitionBy(*keys))
        return df.withColumn(column, F.coalesce(F.col(column), middle))
    table = group_median(df, keys, column, "__median")
    return (
        left_join_on(df, table, keys, null_safe=True)
        .withColumn(column, F.coalesce(F.col(column), F.col("__median")))
        .drop("__median")
    )


def carry_back(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    column: str,
    out: str | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Fill nulls with the next known value of the same key; trailing nulls stay.

    ``chunk`` cuts a key's sequence into pieces, and must not decrease along
    ``order_by`` (a day of a timestamp, say). Pieces are then filled in
    parallel and only their first known values are compared across pieces, so
    one long sequence does not have to pass through one task.
    """
    out = out or column
    rows_after = lambda w: w.rowsBetween(0, W.unboundedFollowing)
    if chunk is None:
        w = rows_after(W.partitionBy(*keys).orderBy(*order_by))
        return df.withColumn(out, F.first(column, ignorenulls=True).over(w))
    cut = W.partitionBy(*keys, "__chunk").orderBy(*order_by)
    filled = df.withColumn("__chunk", chunk).withColumns(
        {"__filled": F.first(column, ignorenulls=True).over(rows_after(cut)), "__at": F.row_number().over(cut)}
    )
    # the first row of a chunk holds its first known value: one row per chunk goes on
    after = W.partitionBy(*keys).orderBy("__chunk").rowsBetween(1, W.unboundedFollowing)
    nexts = filled.filter("__at = 1").select(
        *keys, "__chunk", F.first("__filled", ignorenulls=True).over(after).alias("__next")
    )
    return (
        left_join_on(filled.drop("__at"), nexts, [*keys, "__chunk"], null_safe=True)
        .withColumn(out, F.coalesce("__filled", "__next"))
        .drop("__chunk", "__filled", "__next")
    )


def topk_coverage(
    members: DataFrame, period: str, group: str, amount: str, k: int, tiebreak: Sequence[str], out: str = "share"
) -> DataFrame:
    """Mean over groups, per period, of the percentage the top ``k`` members cover."""
    top = top_k(members, [period, group], amount, k, tiebreak)
    covered = top.groupBy(period, group).agg(strict_sum(amount).alias("__covered"))
    total = members.groupBy(period, group).agg(strict_sum(amount).alias("__total"))
    return (
        # null-safe keys keep both sides' plans alike, so the member sums are shuffled once
        left_join_on(covered, total, [period, group], null_safe=True)
        .withColumn("__pct", F.try_divide(F.col("__covered"), F.col("__total")) * 100)
        .groupBy(period)
        .agg(strict_mean("__pct").alias(out))
    )


def column_stats(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """One row with the mean and sample deviation of each column."""
    aggs = []
    for i, c in enumerate(columns):
        complete = F.count(c) == F.count(F.lit(1))
        for name, agg in (("m", F.avg(c)), ("s", F.stddev_samp(c))):
            aggs.append((F.when(complete, agg) if strict else agg).alias(f"{name}{i}"))
    return df.agg(*aggs)


def zscore(
    df: DataFrame, columns: Sequence[str], suffix: str = "", strict: bool = False
) -> DataFrame:
    """Centre and scale columns over the whole table.

    The statistics are one aggregate row, read as a scalar subquery: no join
    and no un-partitioned window. With ``strict`` a null spoils the column.
    """
    stats = column_stats(df, columns, strict).select(F.struct("*").alias("stats")).scalar()
    return df.withColumns(
        {
            f"{c}{suffix}": F.try_divide(F.col(c) - stats[f"m{i}"], stats[f"s{i}"])
            for i, c in enumerate(columns)
        }
    )


def rank_labels(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    k: int,
    tiebreak: Sequence[str],
    prefix: str = "player_",
    out: str = "rank",
) -> DataFrame:
    """Label the ``k`` rows of each group with ``prefix`` and their descending rank."""
    ranked = top_k(df, keys, by, k, tiebreak, rank="__position")
    return ranked.withColumn(out, F.concat(F.lit(prefix), F.col("__position").cast("string"))).drop(
        "__position"
    )


def rank_wide(
    df: DataFrame,
    keys: Sequence[str],
    rank: str,
    labels: Sequence[str],
    values: Sequence[str],
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per key, with a ``{value}_{label}`` column for every rank label.

    The labels are given, so there is no pass to discover them. Ranks a group
    lacks are null. ``carry`` columns are constant within a key.
    """
    one = [F.max(c).alias(c) for c in carry]
    cells = [F.first(c, ignorenulls=True).alias(c) for c in values]
    wide = df.groupBy(*keys).pivot(rank, list(labels)).agg(*cells)
    names = {
        (f"{label}_{v}" if len(values) > 1 else label): f"{v}_{label}" for label in labels for v in values
    }
    wide = wide.withColumnsRenamed(names).select(*keys, *[f"{v}_{x}" for v in values for x in labels])
    if not one:
        return wide
    return left_join_on(wide, df.groupBy(*keys).agg(*one), keys, null_safe=True)


def shifted_period_join(
    left: DataFrame, right: DataFrame, period: str, keys: Sequence[str], shift: int = -1
) -> DataFrame:
    """Left join after moving the right side's period by ``shift``."""
    moved = right.withColumn(period, F.col(period) + shift)
    return left_join_on(left, moved, [period, *keys])


def bind_by_rank(
    frames: Mapping[str, tuple[DataFrame, str]], k: int, out: str = "position"
) -> DataFrame:
    """Put ordered value lists side by side: the i-th largest of each in row i.

    ``frames`` maps an output name to (frame, value column). Each list is a
    top-``k`` report, so ``k`` bounds the rows that are ranked in one task.
    """
    result = None
    for name, (frame, value) in frames.items():
        first = frame.select(F.col(value).cast("double").alias(name)).orderBy(F.col(name).desc_nulls_last()).limit(k)
        ranked = first.withColumn(
            out, F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.col(name).desc_nulls_last()))
        )
        result = ranked if result is None else result.join(ranked, out, "full")
    return result.select(out, *frames)


def right_join_members(
    values: DataFrame, members: DataFrame, keys: Mapping[str, str]
) -> DataFrame:
    """Keep every member row and attach its values (``{members key: values key}``)."""
    renamed = values.withColumnsRenamed({v: f"__v_{v}" for v in keys.values()})
    on = None
    for m, v in keys.items():
        test = renamed[f"__v_{v}"] == members[m]
        on = test if on is None else on & test
    return renamed.join(members, on, "right").drop(*[f"__v_{v}" for v in keys.values()])
