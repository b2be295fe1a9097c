"""The corpus pipeline: every stage against a plain version of itself."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from casaflow.llm.queries import TOXIC_FROM, mixture, toxicity_model
from casaflow.llm.toxicity import score_toxicity
from casaflow.session import materialize
from tests.llm import brute
from tests.llm.conftest import SF
from tests.llm.test_other_operators import check_packing
from tests.llm.test_line_recall import RECALL, removed, removed_by_edits


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_stages_follow_the_dealt_order():
    assert [n for n, _ in CP.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]


def test_stages_match_plain_versions(spark, docs):
    scores = dict(rows(score_toxicity(docs.select("doc_id", "text"), toxicity_model(spark, docs, SF)), "doc_id", "score"))
    kept = materialize(CP.drop_toxic(spark, docs, SF), "t")
    assert kept.columns == docs.columns
    assert {r[0] for r in rows(kept, "doc_id")} == {d for d, s in scores.items() if s < TOXIC_FROM}

    lined = materialize(CP.drop_lines(spark, kept, SF), "t")
    texts = rows(kept, "doc_id", "text")
    gone, similar = removed(spark, texts), removed_by_edits(texts)      # what goes, and what should by edit similarity alone
    assert gone <= similar and len(gone) >= RECALL * len(similar) > 0
    got = {r["doc_id"]: r for r in lined.collect()}
    assert lined.columns == docs.columns
    assert {d: r["text"] for d, r in got.items()} == {
        d: "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone) for d, t in texts}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())

    single = materialize(CP.drop_near_copies(spark, docs, SF), "t")      # on the raw table, where copies abound
    groups = brute.jaccard_groups(rows(docs, "doc_id", "text"), 5, 80, 100)
    assert [r[0] for r in rows(single, "doc_id")] == sorted((d for d, n, c in groups if not n or d == c), key=str)

    mixed = materialize(CP.mix(spark, single, SF), "t")
    assert mixed.columns == docs.columns
    assert rows(mixed, *docs.columns) == rows(mixture(single), *docs.columns)

    packed = CP.pack_sequences(spark, mixed, SF)
    lengths = {}
    for d, t in rows(mixed, "doc_id", "text"):
        lengths[d] = lengths.get(d, 0) + len(brute.WORD.findall(t))
    check_packing([tuple(r) for r in packed.collect()], lengths)


def test_run_applies_the_stages(spark):
    out = CP.run(spark, SF)
    assert out.columns[:2] == ["doc_id", "piece"] and out.count() > 100


def test_near_copies_of_repeated_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    data = [(1, long), (1, long), (2, long + " x"), (None, long), (None, None), (3, "other words here"), (3, "and now something else"), (4, "")]
    out = CP.drop_near_copies(spark, spark.createDataFrame(data, "doc_id long, text string"), SF)
    assert rows(out, "doc_id", "text") == sorted([(1, long), (None, None), (3, "other words here"), (3, "and now something else"), (4, "")], key=str)


@pytest.mark.parametrize("which", ["odd", "none"])
def test_odd_rows_pass_through_every_stage(spark, odd, no_docs, which):
    frame = (odd if which == "odd" else no_docs).withColumn("n_chars", F.length("text").cast("long"))
    for _, stage in CP.STAGES[:-1]:
        out = materialize(stage(spark, frame, SF), "t")
        assert out.columns == frame.columns
        frame = out
    assert (CP.STAGES[-1][1](spark, frame, SF).count() > 0) == (which == "odd")
