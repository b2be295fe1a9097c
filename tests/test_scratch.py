"""Scratch tables of a step are deleted, its result stays."""

import os

from casaflow.session import checkpoint_root, materialize, scratch


def test_only_the_kept_table_stays(spark):
    root = checkpoint_root(spark)
    before = set(os.listdir(root))
    with scratch(spark, {"result"}):
        inner = materialize(spark.range(5), "scratch-inner")
        result = materialize(inner.where("id > 1"), "result")
    after = materialize(spark.range(2), "scratch-outside")
    assert result.count() == 3 and after.count() == 2
    assert sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(root)) - before) == ["result", "scratch-outside"]
