"""Toxicity features found in pairs and plain scores; sizes of all levels of a
cascade; rule hosts and labels of any form."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casaflow.llm import toxicity
from casaflow.llm.embed_dedup import embed_dedup
from casaflow.llm.toxicity import fit_toxicity, likelihood_ratio, score_toxicity, telling_pairs, term_buckets
from casaflow.llm.url_filter import BloomCascade, cascade_bits, level_rate, url_filter


def crossed(n, seed):
    """Documents whose label only a pair tells: each of four words is in half of
    the documents of either label."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        toxic = int(rng.random() < 0.4)
        pair = rng.choice([("idiots", "northerners"), ("angels", "southerners")] if toxic
                          else [("idiots", "southerners"), ("angels", "northerners")])
        words = [f"w{rng.randint(0, 60)}" for _ in range(12)] + list(pair)
        rng.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_pairs_pass_the_screen_and_decide(spark):
    table = spark.createDataFrame(crossed(1200, 1), "doc_id long, text string, toxic int")
    model = fit_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    assert model.where("bucket >= 0").count() >= 4
    fresh = spark.createDataFrame(crossed(400, 2), "doc_id long, text string, toxic int")
    got = score_toxicity(fresh, model).collect()
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in got) / len(got) > 0.97


@pytest.mark.parametrize("block", [512, 3])
def test_telling_pairs_match_a_count_of_every_pair(monkeypatch, block):
    monkeypatch.setattr(toxicity, "PAIR_BLOCK", block)
    rng = np.random.default_rng(5)
    held = rng.random((300, 10)) < 0.4
    label = (held[:, 2] ^ held[:, 7]).astype(float)
    label[rng.random(300) < 0.1] = 1
    row, feature = np.nonzero(held)
    positive = int(label.sum())
    alone = likelihood_ratio(held[label > 0].sum(axis=0), held.sum(axis=0), positive, 300)
    expected = np.zeros(10, dtype=bool)
    pairs = list(itertools.combinations(range(10), 2))
    for i, j in pairs:
        both = held[:, i] & held[:, j]
        ratio = likelihood_ratio(np.array([both[label > 0].sum()]), np.array([both.sum()]), positive, 300)[0]
        if ratio >= 14 + 2 * math.log(len(pairs)) + max(alone[i], alone[j]):
            expected[[i, j]] = True
    assert expected[[2, 7]].all()
    assert telling_pairs(feature, row, label, alone, 14.0).tolist() == expected.tolist()
    assert not telling_pairs(feature[:0], row[:0], label, alone, 14.0).any()


def test_scores_are_the_plain_sum_over_pairs(spark):
    table = spark.createDataFrame(crossed(600, 3), "doc_id long, text string, toxic int")
    model = fit_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    fitted = {r.bucket: (r.weight, r.factors) for r in model.collect()}

    def bucket(word):
        return int(next(iter(term_buckets(pa.array([word]), 22)))[2][0])

    def plain(text):
        own = {bucket(w) for w in re.findall("[a-z0-9]+", text.lower())} & set(fitted)
        total = fitted[-1][0] + sum(fitted[b][0] for b in own)
        total += sum(sum(x * y for x, y in zip(fitted[a][1], fitted[b][1])) for a, b in itertools.combinations(sorted(own), 2))
        return 1 / (1 + math.exp(-total))

    texts = ["", "unknown words", "idiots", "Idiots, northerners!", "idiots idiots southerners"] + [r[1] for r in crossed(40, 4)]
    got = score_toxicity(spark.createDataFrame(list(enumerate(texts)), "i long, text string"), model).collect()
    assert [r.score for r in got] == pytest.approx([plain(r.text) for r in got], abs=1e-9)


def test_a_repeated_id_is_learned_once(spark):
    rows = crossed(300, 6)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    hot = docs.union(docs.where("doc_id = 7").crossJoin(spark.range(50)).select("doc_id", "text"))
    a, b = (sorted(map(tuple, fit_toxicity(d, labels).select("bucket", "weight").collect())) for d in (docs, hot))
    assert a == b


# --- URLs -----------------------------------------------------------------------

@pytest.mark.parametrize("listed,universe,shard_bytes", [(3, 50_000, 64), (600, 20_000, 512)])
def test_every_level_of_a_shard_is_within_its_bytes(spark, listed, universe, shard_bytes):
    keys = spark.range(universe).select(F.concat(F.lit("k"), "id").alias("key"))
    own = spark.range(listed).select(F.concat(F.lit("k"), F.col("id") * 7).alias("key"))
    cascade = BloomCascade(own, keys, shard_bytes=shard_bytes)
    for shard in cascade.filters:
        # a level has whole words of 64 bits
        assert sum(bits // 8 - 8 for _, bits, _ in shard.value.levels) <= shard_bytes
    out = cascade.add(keys.withColumn("keys", F.array("key")), "keys", "hit")
    found = {r.key for r in out.where(F.size("hit") == 1).collect()}
    assert found == {f"k{7 * i}" for i in range(listed) if 7 * i < universe}


def test_levels_grow_with_the_list_not_with_the_corpus():
    small, large = (cascade_bits(1000, u, level_rate(1000, u)) for u in (10 ** 6, 10 ** 9))
    assert large - small == pytest.approx(1000 * math.log2(1000) / math.log(2), rel=1e-6)
    for u in (10, 1000, 10 ** 7):
        best = cascade_bits(1000, u, level_rate(1000, u))
        assert all(best <= cascade_bits(1000, u, r) + 1e-6 for r in np.geomspace(1e-9, 0.5, 60))
    assert cascade_bits(0, 10, level_rate(0, 10)) == 0 and level_rate(5, 0) == 0.5


def test_rule_hosts_of_any_case_and_rules_listed_both_ways(spark):
    pages = spark.createDataFrame([(1, "http://a.bad.com/x"), (2, "http://both.org/"), (3, "http://listed.net/"), (4, "http://É.com/")], "page_id long, url string")
    rules = [("BAD.com", "/", "block"), ("both.org", "/", "allow"), ("Both.ORG", "/", "block"), ("É.com", "/", "block")]
    listed = spark.createDataFrame([("Listed.NET",)], "key string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter(pages, rules, listed).collect()}
    assert got == {1: ("bad.com/", "block"), 2: ("both.org/", "block"), 3: (None, "block"), 4: ("É.com/", "block")}


# --- labels of vectors ----------------------------------------------------------

@pytest.mark.parametrize("kind,labels", [("double", [1.2, 1.7, 1.2, None, None]), ("string", ["cat", "dog", "cat", None, None])])
def test_labels_of_any_type_are_compared_whole(spark, kind, labels):
    rows = [(i, [1.0, 2.0, 3.0], x) for i, x in enumerate(labels)]
    got = embed_dedup(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {0: (1, 0), 1: (0, 1), 2: (1, 0), 3: (0, 3), 4: (0, 4)}
