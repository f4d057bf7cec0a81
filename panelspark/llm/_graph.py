"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm._shared import checkpointed


#: A round's pairs go to a file for every so many, and to no more than this many files if they are few.
PAIRS, FILES = 4096, 8


def _stars(pairs: DataFrame) -> DataFrame:
    """``(u, v)`` both ways, with the least of each node's closed neighbourhood."""
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    return both.join(least.select("u", F.least("u", "least").alias("least")), "u")


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(pairs: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the undirected pairs ``(a, b)``;
    ``component`` is the least node that can be reached.

    Large-star then small-star until the pairs stay the same: then each node
    points at the least of its component. Every round is a join and two
    aggregates over the pairs (which never grow in number) and is checkpointed.
    Since their number is known, few pairs go to few files. Null ends, loops and
    repeats are dropped. No pairs: no rows.
    """
    pairs = pairs.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = checkpointed(pairs)
    state = _state(pairs)
    while state[0]:
        large = _stars(pairs).where("v > u").select(F.col("v").alias("a"), F.col("least").alias("b")).where("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(down, "a")
        small = (
            small.where("b != least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionAll(down.select("a", F.col("least").alias("b")))
            .distinct()
        )
        pairs = checkpointed(small.coalesce(max(FILES, -(-state[0] // PAIRS))))
        last, state = state, _state(pairs)
        if last == state:
            break
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
