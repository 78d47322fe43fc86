"""What a bound on the labelled documents may not change."""

import pytest
from pyspark.sql import functions as F

from tidelake.llm import quality, toxicity


@pytest.mark.parametrize("most", [20, 10_000])
def test_scores_are_alike_whether_or_not_the_bound_binds(spark, most):
    docs = spark.createDataFrame([(i, "the same plain words") for i in range(330)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 30), int(i >= 30)) for i in range(330)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, labels, F.lit(True), most=most)
    assert docs.limit(1).select(toxicity.scorer(docs, model)("text")).first()[0] < 0.25
    rules, intercept = quality.fit(docs, labels, F.lit(True), most=most)
    stats = quality.statistics_column(F.col("text"))
    assert docs.limit(1).select(quality.score_column(stats, rules, intercept)).first()[0] == pytest.approx(300 / 330, abs=0.02)
