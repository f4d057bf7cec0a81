"""Physical plans of the panel queries: what must and must not be in them."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from panelspark.operators import gram, panel
from panelspark.plans import catalog
from panelspark.plans import mapping as M

FOLDER = "/root/testdata/sf0.001"
PANEL = [name for name, fn in catalog.QUERIES.items() if fn.__module__.endswith("queries_panel")]


def explained(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", [n for n in PANEL if n not in ("density_grid", "facet_band")])
def test_no_slow_operators(spark, name):
    plan = explained(catalog.QUERIES[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = explained(catalog.QUERIES["scan_project"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_quantity,10.0\)", plan)
    plan = explained(M.box(spark, FOLDER).groupBy("period").agg(F.sum("mins")))
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("l_quantity" in s and "l_tax" not in s and "l_partkey" not in s for s in schema)


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    plan = explained(panel.top_k(df, ["l_suppkey"], "l_quantity", 3, ["l_orderkey", "l_partkey"]))
    assert plan.count("WindowGroupLimit") >= 2  # once per task, once per group


def test_sums_are_combined_before_the_shuffle(spark):
    plan = explained(panel.group_sums(spark.read.parquet(f"{FOLDER}/lineitem.parquet"), ["l_suppkey"], ["l_quantity"]))
    assert plan.count("HashAggregate") >= 2


def test_whole_group_share_has_no_window(spark):
    df = spark.read.parquet(f"{FOLDER}/customer.parquet")
    shared = panel.concentration(panel.share_of_group(df, ["c_nationkey"], "c_acctbal", "s"), ["c_nationkey"], "s")
    assert "Window" not in explained(shared)


def test_folds_need_no_shuffle(spark):
    df = spark.read.parquet(f"{FOLDER}/events.parquet").select("event_id")
    assert "Exchange" not in explained(gram.assign_folds(df, ["event_id"]))


def test_moments_shuffle_sums_only(spark):
    df = spark.read.parquet(f"{FOLDER}/lineitem.parquet").withColumn("fold", F.lit(1))
    plan = explained(gram.keyed_moments(df, ["l_quantity", "l_tax"], ["fold"]))
    assert plan.count("Exchange") <= 4 and "MapInArrow" not in plan
    wide = df.select("fold", *[(F.col("l_tax") * i).alias(f"t{i}") for i in range(12)])
    plan = explained(gram.keyed_moments(wide, [f"t{i}" for i in range(12)], ["fold"]))
    assert "MapInArrow" in plan and "PartialAggregate" not in plan


def test_wide_moments_multiply_blocks_and_keep_them_packed(spark):
    from panelspark.plans.queries_panel import WIDE_TERMS, wide_rows

    moments = gram.keyed_moments(wide_rows(spark, FOLDER), [*WIDE_TERMS, "hhi"], ["fold"])
    text = moments._jdf.queryExecution().optimizedPlan().toString()
    # one block product, two rounds of packed sums, and the only explosion comes after them
    assert text.count("MapInArrow") == 3 and text.index("Generate") < text.index("MapInArrow")
