"""Typed readers. Filters and projections on the result reach the scan."""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    where: Column | str | None = None,
    sep: str = ",",
) -> DataFrame:
    """Read the columns of ``schema`` from a delimited file with a header line; blanks become null.

    Columns are found by their names in the header, in any order and among any
    others. The header is the first line of one of the files (all must have the
    same); no other line is read to plan the query. A missing column raises.
    """
    header = _header(spark, path, sep)
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    known = {f.name: f.dataType for f in schema.fields}
    names, seen = [], set()
    for i, name in enumerate(header):
        # a blank or repeated name is no column that anyone asks for
        free = name if name and name not in seen else f"__{i}"
        seen.add(free)
        names.append(free)
    whole = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
    df = (
        spark.read.schema(whole)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
        .select(*[f"`{f.name}`" for f in schema.fields])
    )
    return df if where is None else df.filter(where)


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    """The names in the first line of a file."""
    line = spark.read.text(path).limit(1).first()
    text = "" if line is None else line[0].lstrip("\ufeff")
    return next(csv.reader([text], delimiter=sep), [])


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def table_reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """``name -> DataFrame`` over a folder of ``name.parquet`` tables."""
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


def literal_table(
    spark: SparkSession, columns: Mapping[str, Sequence], schema: str | T.StructType
) -> DataFrame:
    """A small in-line table given column by column."""
    lengths = {len(v) for v in columns.values()}
    if len(lengths) != 1:
        raise ValueError("all columns of a literal table need the same length")
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), schema)
