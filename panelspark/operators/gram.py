"""Keyed moments: the one pass over the rows under every linear model.

For each key the pass adds up the products of ``[1, x1 … xp, y]``. Sums are
all that is kept, so the moments of a training set are the total minus those
of the held-out fold, and no model needs a pass of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Up to this many columns the products are JVM sums; beyond it the generated
# aggregate grows too wide and blocks of rows are multiplied in numpy instead.
JVM_COLUMNS = 9
# Up to this many, running covariances give the same sums without a shift,
# in one pass.
COVARIANCE_COLUMNS = 4
MAX_COLLECTED = 50_000_000
# Values of task results the driver may add up itself; beyond it they are shuffled.
SMALL_RESULT = 2_000_000


def quoted(name: str) -> str:
    return f"`{name}`"


def packed_pairs(size: int) -> list[tuple[int, int]]:
    """Index pairs of the packed upper triangle, row by row."""
    return [(i, j) for i in range(size) for j in range(i, size)]


def common_shift(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Each column's mean over the whole table, so that products keep their digits."""
    if not columns:
        return np.zeros(0)
    row = df.agg(*[F.avg(F.col(quoted(c)).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return np.array([0.0 if v is None or v != v else v for v in row])


def keyed_moments(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    shift: np.ndarray | None = None,
) -> DataFrame:
    """``(keys…, pos, value)``: packed products of ``[1, columns − shift]`` per key.

    Sums are taken inside each task first; the shuffle carries one row of packed
    products per task and key, whatever the number of rows or the skew of the keys.
    """
    shift = np.zeros(len(columns)) if shift is None else np.asarray(shift, float)
    rows = df.select(*keys, *[F.col(quoted(c)).cast("double").alias(c) for c in columns])
    rows = rows.na.drop("any", subset=list(columns)) if columns else rows
    if len(columns) <= JVM_COLUMNS:
        u = [F.lit(1.0)] + [
            F.col(quoted(c)) - F.lit(float(s)) for c, s in zip(columns, shift, strict=True)
        ]
        sums = [F.sum(u[i] * u[j]) for i, j in packed_pairs(len(u))]
        return rows.groupBy(*keys).agg(F.array(*sums).alias("m")).select(*keys, F.posexplode("m").alias("pos", "value"))
    schema = T.StructType(
        [rows.schema[k] for k in keys] + [T.StructField("m", T.ArrayType(T.DoubleType()))]
    )
    blocks = rows.mapInArrow(_block_sums(list(columns), list(keys), shift, schema), schema)
    summed = sum_arrays(blocks, keys, rows.rdd.getNumPartitions())
    return summed.select(*keys, F.posexplode("m").alias("pos", "value"))


def _block_sums(columns, keys, shift, schema, held=512):
    """Task function: products per key over the task's rows, at most ``held`` keys at a time."""
    arrow_schema = to_arrow_schema(schema)
    upper = np.triu_indices(len(columns) + 1)

    def flush(sums):
        data = {k: [key[i] for key in sums] for i, k in enumerate(keys)}
        data["m"] = [s[upper] for s in sums.values()]
        return pa.RecordBatch.from_pydict(data, schema=arrow_schema)

    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            u = np.empty((batch.num_rows, len(columns) + 1))
            u[:, 0] = 1.0
            for j, c in enumerate(columns):
                u[:, j + 1] = batch.column(c).to_numpy(zero_copy_only=False) - shift[j]
            if keys:
                frame = batch.select(keys).to_pandas()
                groups = frame.groupby(keys, dropna=False, sort=False).indices
            else:
                groups = {(): slice(None)}
            for key, at in groups.items():
                key = key if isinstance(key, tuple) else (key,)
                part = u[at]
                product = part.T @ part
                if key in sums:
                    sums[key] += product
                else:
                    sums[key] = product
            if len(sums) > held:
                yield flush(sums)
                sums = {}
        if sums:
            yield flush(sums)

    return run


def named_moments(moments: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Moments with readable ``left``/``right`` names instead of a packed position."""
    names = ["(Intercept)", *columns]
    pairs = packed_pairs(len(names))
    left = F.array(*[F.lit(names[i]) for i, _ in pairs])
    right = F.array(*[F.lit(names[j]) for _, j in pairs])
    return moments.select(*keys, left[F.col("pos")].alias("left"), right[F.col("pos")].alias("right"), "value")


@dataclass
class Moments:
    """Collected moments: one small matrix per key, over ``[1, columns − shift]``."""

    columns: list[str]
    shift: np.ndarray
    by_key: dict[tuple, np.ndarray]

    @property
    def total(self) -> np.ndarray:
        size = len(self.columns) + 1
        return sum(self.by_key.values(), np.zeros((size, size)))

    def training(self, position: int = 0) -> dict:
        """Total minus each value of one key column."""
        total = self.total
        return {k: total - m for k, m in self.margin(position).items()}

    def margin(self, position: int) -> dict:
        """Sums over all other key columns."""
        out: dict = {}
        for key, m in self.by_key.items():
            out[key[position]] = out[key[position]] + m if key[position] in out else m.copy()
        return dict(sorted(out.items()))


def collect_moments(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), shift: np.ndarray | None = None
) -> Moments:
    """Run the pass and fetch the matrices: keys × p², checked, and never rows."""
    columns = list(columns)
    if shift is None and 0 < len(columns) <= COVARIANCE_COLUMNS:
        return _from_covariances(df, columns, list(keys))
    if shift is None:
        shift = common_shift(df, columns)
    size = len(columns) + 1
    table = keyed_moments(df, columns, keys, shift).limit(MAX_COLLECTED + 1).toArrow()
    if table.num_rows > MAX_COLLECTED:
        raise ValueError("too many keys for the driver: moments are meant for folds, not for levels")
    pos = table.column("pos").to_numpy()
    value = table.column("value").to_numpy()
    upper = packed_pairs(size)
    rows, cols = np.array([p[0] for p in upper]), np.array([p[1] for p in upper])
    labels = list(zip(*[table.column(k).to_pylist() for k in keys], strict=True)) if keys else [()] * len(pos)
    by_key: dict[tuple, np.ndarray] = {}
    for key, at, v in zip(labels, pos, value, strict=True):
        m = by_key.setdefault(key, np.zeros((size, size)))
        m[rows[at], cols[at]] = m[cols[at], rows[at]] = 0.0 if v is None or np.isnan(v) else v
    return Moments(columns, np.asarray(shift, float), dict(sorted(by_key.items())))


def _from_covariances(df: DataFrame, columns: list[str], keys: list[str], most: int = 100_000) -> Moments:
    """The same moments about the overall means, from per-key means and covariances."""
    rows = df.select(*keys, *[F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    rows = rows.na.drop("any", subset=[f"c{i}" for i in range(len(columns))])
    pairs = packed_pairs(len(columns))
    found = (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.avg(f"c{i}") for i in range(len(columns))]).alias("mean"),
            F.array(*[F.covar_pop(f"c{i}", f"c{j}") for i, j in pairs]).alias("cov"),
        )
        .limit(most + 1)
        .collect()
    )
    if len(found) > most:
        raise ValueError("too many keys for the driver: moments are meant for folds, not for levels")
    found = [r for r in found if r["n"]]
    n = np.array([float(r["n"]) for r in found])
    means = np.array([r["mean"] for r in found], float).reshape(len(found), len(columns))
    shift = n @ means / n.sum() if len(found) else np.zeros(len(columns))
    by_key = {}
    for r, count, mean in zip(found, n, means - shift, strict=True):
        m = np.zeros((len(columns) + 1, len(columns) + 1))
        for (i, j), c in zip(pairs, r["cov"], strict=True):
            m[i + 1, j + 1] = m[j + 1, i + 1] = count * (c + mean[i] * mean[j])
        m[0, 0], m[0, 1:], m[1:, 0] = count, count * mean, count * mean
        by_key[tuple(r[k] for k in keys)] = m
    return Moments(columns, shift, dict(sorted(by_key.items())))


def _sum_sorted(keys: list[str], arrow_schema: pa.Schema):
    """Task function: rows ``(keys…, m)`` sorted by key, summed while they stream by."""

    def run(batches):
        held, total = None, None
        out: list[tuple] = []

        def packed():
            data = {k: [row[0][i] for row in out] for i, k in enumerate(keys)}
            data["m"] = [row[1] for row in out]
            return pa.RecordBatch.from_pydict(data, schema=arrow_schema)

        for batch in batches:
            labels = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True)) if keys else [()] * batch.num_rows
            m = batch.column("m")
            for i, key in enumerate(labels):
                row = m[i].values.to_numpy(zero_copy_only=False)
                if key == held:
                    total = total + row
                    continue
                if held is not None:
                    out.append((held, total))
                held, total = key, row
                if len(out) == 256:
                    yield packed()
                    out.clear()
        if held is not None:
            out.append((held, total))
        if out:
            yield packed()

    return run


def sum_arrays(partial: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """``(keys…, m)``: packed arrays of many tasks summed per key, never taken apart.

    Two rounds: a key's arrays are first summed in about ``sqrt(parts)`` groups
    of tasks, then across the groups, so no task reads one of every other task's.
    """
    keys = list(keys)
    schema = T.StructType([*[partial.schema[k] for k in keys], partial.schema["m"]])
    salted = partial.select(*keys, "m", (F.spark_partition_id() % max(1, int(parts**0.5))).alias("__salt"))
    first_schema = T.StructType([*schema.fields[:-1], T.StructField("__salt", T.IntegerType()), schema["m"]])
    task = _sum_sorted([*keys, "__salt"], to_arrow_schema(first_schema))
    salted = salted.repartition(*keys, "__salt").sortWithinPartitions(*keys, "__salt").mapInArrow(task, first_schema)
    gathered = salted.drop("__salt")
    gathered = gathered.repartition(*keys).sortWithinPartitions(*keys) if keys else gathered.repartition(1)
    return gathered.mapInArrow(_sum_sorted(keys, to_arrow_schema(schema)), schema)


def add_partials(partial: DataFrame, index: str, count: int, width: int, parts: int) -> np.ndarray:
    """Sum per-task rows ``(index, m array)`` to a [count, width] array.

    Few tasks with short results are added here; otherwise the arrays are
    summed by ``sum_arrays`` first, so what arrives never depends on the task count.
    """
    flat = np.zeros((count, width))
    if parts * count * width > SMALL_RESULT:
        partial = sum_arrays(partial, [index], parts)
    table = partial.toArrow()
    if table.num_rows:
        values = table.column("m").combine_chunks().flatten().to_numpy().reshape(-1, width)
        np.add.at(flat, table.column(index).to_numpy(), values)
    return flat


def row_hash(row_key: Sequence[str], seed: int | str) -> Column:
    """Eight hex digits of a digest of the row key and the seed."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in row_key], F.lit(str(seed)))
    return F.substring(F.md5(text), 1, 8)


def assign_folds(
    df: DataFrame, row_key: Sequence[str], k: int = 10, seed: int | str = 0, out: str = "fold"
) -> DataFrame:
    """Fold 0…k−1 from a digest of the row key: no shuffle, sizes nearly equal."""
    number = F.conv(row_hash(row_key, seed), 16, 10).cast("long")
    return df.withColumn(out, (number % k).cast("int"))


def fold_values(rows: DataFrame, fold: str, most: int = 1000) -> list[int]:
    """The fold numbers that occur; a column with more than ``most`` is no fold column."""
    found = rows.select(fold).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{fold} has more than {most} values")
    return sorted(r[0] for r in found)


def assign_balanced_folds(
    df: DataFrame, row_key: Sequence[str], k: int = 10, seed: int | str = 0, out: str = "fold",
    bucket_rows: int = 100_000,
) -> DataFrame:
    """Folds whose sizes differ by at most one: rows dealt out in digest order.

    The global rank is a rank inside a digest bucket plus the number of rows in
    earlier buckets, so no task sorts all rows; there are as many buckets as keep
    one near ``bucket_rows``. The row key must be unique for the digests to spread.
    """
    total, digits = df.count(), 1
    while 16**digits * bucket_rows < total:
        digits += 1
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in row_key], F.lit(str(seed)))
    hashed = df.withColumn("__h", F.md5(text)).withColumn("__bucket", F.substring("__h", 1, digits))
    sizes = hashed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    # one row for each bucket
    upto = W.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(upto), F.lit(0))).drop("__n")
    inside = F.row_number().over(W.partitionBy("__bucket").orderBy("__h", *row_key))
    return (
        hashed.withColumn("__inside", inside)
        .join(starts, "__bucket")
        .withColumn(out, ((F.col("__start") + F.col("__inside") - 1) % k).cast("int"))
        .drop("__h", "__bucket", "__inside", "__start")
    )
