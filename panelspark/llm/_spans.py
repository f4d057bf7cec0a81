"""Columns over arrays of spans ``(start, kind, end)``, kinds being numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
