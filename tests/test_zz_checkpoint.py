"""With a checkpoint folder the repeatedly read tables are written there. Runs last:
a session keeps its folder once it is set."""

import pandas as pd
import pytest

from panelspark.operators import mixed, panel, quantile
from panelspark.operators.design import ModelSpec
from panelspark.session import has_checkpoint_dir, pinned, reused


@pytest.fixture(scope="module")
def checkpointing(spark, tmp_path_factory):
    if not has_checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return spark


def test_tables_are_checkpointed(checkpointing):
    df = checkpointing.range(10).selectExpr("id", "id * 2 AS twice")
    assert has_checkpoint_dir(checkpointing)
    with reused(df) as kept:
        assert kept.count() == 10 and "twice" in kept.columns
        assert "Range" not in kept._jdf.queryExecution().toString()  # the lineage is cut
    assert pinned(df).count() == 10


def test_fits_with_checkpoints(checkpointing):
    pdf = pd.DataFrame({"g": [f"g{i % 6}" for i in range(60)], "x": [float(i % 7) for i in range(60)]})
    pdf["y"] = 1 + 2 * pdf["x"] + pdf["g"].str[1].astype(int) + pdf.index % 3
    df = checkpointing.createDataFrame(pdf)
    found = quantile.fit_quantile(df, ModelSpec("y", ["x"]), [0.5]).collect()
    assert {r["term"] for r in found} == {"(Intercept)", "x"}
    fit = mixed.fit_mixed(df, mixed.MixedSpec(ModelSpec("y", ["x"]), ["g"]))
    assert fit.modes().count() == 6 and fit.predict().count() == 60
    assert panel.group_quantiles(df, ["g"], "y", {"q": 0.5}, pieces=2).count() == 6
