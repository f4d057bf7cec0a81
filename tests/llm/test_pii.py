"""PII: base spans against Python's matcher, added spans, redaction, edge rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.llm import pii
from tests_llm_plain import pii_spans


def base(text):
    return [(s, pii.KINDS.index(kind), e) for s, kind, e in pii_spans(text)]


TEXTS = [
    None, "", "a@b.c_d@e.f", "x@y", "mail me: é😀 joe.doe@mail.example.com, or 1.2.3.4.5.6.7.8", "256.1.1.1 0255.0.00.1 1.2.3",
    "4111 1111-1111 1111", "4111  1111 1111 1111", "4111111111111112", "+1 (377) 555-0271 +49-30-1234567.", "+1+2 345 678 9012", "1 " * 30000, "a" * 200000 + "@",
    "9" * 100000, "+" + "1" * 12 + ") (", "1.1.1.1@x.y 4111111111111111.1.1.1", "a.@b..c @d.e %@-.-",
]


def spans_of(spark, texts, model=pii.Model()):
    rows = [(i, t, 3) for i, t in enumerate(texts)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string, pii int"), model).collect()
    return {r.doc_id: [tuple(s) for s in r.pii.base] for r in found}


def test_base_spans(spark):
    got = spans_of(spark, TEXTS)
    assert [got[i] for i in range(len(TEXTS))] == [base(t) for t in TEXTS]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789@.+-() aé_%😀\n", max_size=60), min_size=60, max_size=60))
def test_base_spans_of_any_text(spark, texts):
    got = spans_of(spark, texts)
    assert [got[i] for i in range(len(texts))] == [base(t) for t in texts]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = pii.find(docs, pii.learn(docs)).select("doc_id", "text", "pii", pii.redacted(F.col("text"), F.col("pii.spans")).alias("clean")).collect()
    assert len(found) == 1000
    for r in found:
        have = [tuple(s) for s in r.pii.base]
        assert have == base(r.text)
        assert set(have) <= {tuple(s) for s in r.pii.spans}
        assert not base(r.clean)
    assert sum(len(r.pii.spans) for r in found) < 1.2 * sum(len(r.pii.base) for r in found)


def test_trees_add_what_looks_alike(spark):
    rows = [(i, f"call phone +1 (3{i % 90 + 10}) 555-0{100 + i} now, order no {1000000 + i * 7}") for i in range(300)]
    rows += [(1000 + i, f"parts 55{i:02d}-00{i:02d}-{i:03d} in stock") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.learn(docs)
    assert model.trees and "phone" in model.thresholds
    clean = pii.find(docs.where("doc_id >= 1000"), model)
    assert clean.where(F.size("pii.spans") > 0).count() == 0
    text = "call phone +1 (377) 555-0271 and +1 [377] 555-0271"
    got = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first().pii
    assert tuple(got.base[0])[::2] == (11, 28)


def test_compiled_trees_equal_the_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = [([float(i % 7), float(i % 5), float(i)], float((i % 7 > 3) ^ (i % 5 > 2))) for i in range(200)]
    frame = spark.createDataFrame(rows, "x array<double>, label double").withColumn("features", array_to_vector("x"))
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(frame)
    own = pii.Model(tuple((float(w), pii._tree(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees, strict=True)))
    for r in model.transform(frame).select(vector_to_array("probability")[1].alias("p"), own.score(F.col("x")).alias("q")).collect():
        assert r.p == pytest.approx(r.q, abs=1e-9)


def test_redaction_and_edges(spark):
    rows = [(1, "é a@b.cd, 1.2.3.4!"), (None, "4111111111111111"), (None, "4111111111111111"), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("base", F.lit(1))
    got = pii.find(docs, pii.learn(docs)).withColumn("text", pii.redacted(F.col("text"), F.col("pii.spans"))).collect()
    assert [r.text for r in got] == ["é [EMAIL], [IP]!", "[CARD]", "[CARD]", None, ""]
    assert got[0].base == 1
    assert pii.find(docs.limit(0), pii.learn(docs.limit(0))).count() == 0


def test_plan_has_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = pii.find(docs, pii.learn(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_common_forms_beside_the_rules_are_added(spark):
    rows = [(i, f"call phone +1 (3{i % 90 + 10}) 555-0{100 + i} now") for i in range(300)]
    rows += [(1000 + i, f"call phone 1 (3{i % 90 + 10}) 555-0{100 + i} now") for i in range(300)]
    rows += [(2000 + i, f"write to joe{i}@mail.example.com soon") for i in range(300)]
    rows += [(3000 + i, f"write to joe{i} (at) mail (dot) example (dot) com soon") for i in range(300)]
    rows += [(4000 + i, f"parts 55{i:02d}-00{i:02d}-{i:03d} in stock, handle@name{i}") for i in range(99)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.find(docs, pii.learn(docs)).select("doc_id", F.size("pii.spans").alias("n"), F.size("pii.base").alias("b")).collect()
    for r in found:
        assert r.n == (r.doc_id < 4000) and r.b == (r.doc_id // 1000 in (0, 2))
