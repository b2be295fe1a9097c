"""Toxicity: scores mean the same however few documents of a label are sampled."""

import random

import pytest

from casaflow.llm.toxicity import fit_toxicity, score_toxicity


@pytest.mark.parametrize("per_class", [100, 450])
def test_scores_follow_the_class_ratio_of_all_labels(spark, per_class):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randint(0, 50)}" for _ in range(12)), int(i % 9 == 0)) for i in range(900)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"), per_class=per_class)
    scored = score_toxicity(spark.createDataFrame([(1, None)], "doc_id long, text string"), model)
    assert 0.04 < scored.collect()[0]["score"] < 0.25      # 1 of 9 is toxic
