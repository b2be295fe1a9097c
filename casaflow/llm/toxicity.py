"""Toxicity scores by a factorization machine over hashed terms.

A document is the set of its terms' buckets. The machine scores it with a bias,
a weight per bucket, and the product of the factors of every pair of its
buckets, so it learns that an insult beside a group mention means more than the
two apart, which additive weights can't say. Pair terms cost linear time:
``(|sum v|^2 - sum |v|^2) / 2``.

Its features are the buckets that tell the labels apart alone, and those that do
so beside another bucket (``telling_pairs``), however little each says by itself.

It is fitted by mini-batch AdaGrad in one task on a bounded sample of the
labelled documents (``per_class`` of each label, picked by their id's hash), and
its bias is then set back by the labels' shares in the sample, so that scores
mean the same however many documents there are;
scoring covers every document and only broadcasts the fitted buckets (at most
2^bits).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casaflow.llm.arrays import NO_TERM, U64, byte_chunks, column_bytes, word_hashes
from casaflow.session import materialize, ship_package

TEXT_BLOCK = 4 << 20
FACTORS = 8
NO_LABELS = -3.0    # bias of a machine that saw no labels of both kinds
#: A term is looked at in pairs when this share of the documents of label 1, and
#: so many of them, hold it; a square of PAIR_BLOCK terms is counted at a time.
PAIR_SHARE, PAIR_DOCS, PAIR_BLOCK = 0.01, 20, 512


class FactorizationMachine:
    """Binary features; ``weights`` and ``factors`` have a row per feature."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def raw(self, feature: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores before the sigmoid, factor sums) of n rows, given the present
        features and the row of each."""
        total = self.bias + np.bincount(row, self.weights[feature], n)
        sums = np.empty((n, self.factors.shape[1]))
        for f in range(self.factors.shape[1]):
            v = self.factors[feature, f]
            sums[:, f] = np.bincount(row, v, n)
            total += 0.5 * (sums[:, f] ** 2 - np.bincount(row, v * v, n))
        return total, sums

    @classmethod
    def fit(cls, feature: np.ndarray, row: np.ndarray, label: np.ndarray, n_features: int, factors: int = FACTORS,
            steps: int = 3000, batch: int = 256, rate: float = 0.1, decay: float = 1e-5, seed: int = 1) -> FactorizationMachine:
        """Logistic loss, AdaGrad, ``steps`` mini-batches; ``row`` is sorted."""
        rng = np.random.default_rng(seed)
        model = cls(0.0, np.zeros(n_features), rng.normal(0, 0.02, (n_features, factors)))
        seen_w, seen_v, seen_b = np.full(n_features, 1e-6), np.full((n_features, factors), 1e-6), 1e-6
        starts = np.searchsorted(row, np.arange(len(label) + 1))
        for _ in range(-(-steps * batch // max(1, len(label)))):
            order = rng.permutation(len(label))
            for lo in range(0, len(order), batch):
                rows = order[lo:lo + batch]
                sizes = starts[rows + 1] - starts[rows]
                own = np.repeat(starts[rows] - np.concatenate([[0], np.cumsum(sizes[:-1])]), sizes) + np.arange(sizes.sum())
                at, x = np.repeat(np.arange(len(rows)), sizes), feature[own]
                score, sums = model.raw(x, at, len(rows))
                error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - label[rows]
                used, which = np.unique(x, return_inverse=True)
                scale = 1 / len(rows)
                step = np.bincount(which, error[at], len(used)) * scale + decay * model.weights[used]
                seen_w[used] += step ** 2
                model.weights[used] -= rate * step / np.sqrt(seen_w[used])
                for f in range(factors):
                    v = model.factors[x, f]
                    step = np.bincount(which, error[at] * (sums[at, f] - v), len(used)) * scale + decay * model.factors[used, f]
                    seen_v[used, f] += step ** 2
                    model.factors[used, f] -= 0.3 * rate * step / np.sqrt(seen_v[used, f])
                seen_b += float(error.mean()) ** 2
                model.bias -= rate * float(error.mean()) / seen_b ** 0.5
        return model

    def score(self, feature: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(feature, row, n)[0], -30, 30)))


def likelihood_ratio(hits: np.ndarray, count: np.ndarray, positive: int, n: int) -> np.ndarray:
    """G statistic of each term's presence (in ``hits`` of the ``positive`` and
    in ``count`` of all n documents) against independence of the label."""
    cells = np.stack([hits, count - hits, positive - hits, n - positive - (count - hits)]).astype(float)
    expected = np.stack([count * positive, count * (n - positive), (n - count) * positive, (n - count) * (n - positive)]) / n
    with np.errstate(divide="ignore", invalid="ignore"):
        return 2 * np.where(cells > 0, cells * np.log(cells / expected), 0.0).sum(axis=0)


def telling_pairs(feature: np.ndarray, row: np.ndarray, label: np.ndarray, alone: np.ndarray, least_ratio: float) -> np.ndarray:
    """Which features tell the labels apart only beside another feature.

    ``alone`` holds every feature's own likelihood ratio. The documents that hold
    both of a pair are counted by matrix products over blocks of the features
    frequent under label 1. A pair counts when its ratio exceeds the better one of
    its two features by ``least_ratio`` and the surprise due to the number of
    pairs looked at (2 ln of it, as a ratio's tail falls with exp(-x / 2))."""
    positive, n = int(label.sum()), len(label)
    told = np.zeros(len(alone), dtype=bool)
    often = np.flatnonzero(np.bincount(feature, label[row] > 0, len(alone)) >= max(PAIR_DOCS, PAIR_SHARE * positive))
    if len(often) < 2:
        return told
    least = least_ratio + 2 * np.log(len(often) * (len(often) - 1) / 2)
    place = np.full(len(alone), -1)
    place[often] = np.arange(len(often))
    held = place[feature] >= 0
    of, doc = place[feature[held]], row[held]
    by_term = np.argsort(of, kind="stable")
    of, doc = of[by_term], doc[by_term]

    def dense(lo: int) -> np.ndarray:
        a, b = np.searchsorted(of, [lo, lo + PAIR_BLOCK])
        out = np.zeros((n, min(PAIR_BLOCK, len(often) - lo)), np.float32)
        out[doc[a:b], of[a:b] - lo] = 1
        return out

    toxic = label > 0
    for lo in range(0, len(often), PAIR_BLOCK):
        left = dense(lo)
        for at in range(lo, len(often), PAIR_BLOCK):
            right = left if at == lo else dense(at)
            hits = left[toxic].T @ right[toxic]
            ratio = likelihood_ratio(hits, hits + left[~toxic].T @ right[~toxic], positive, n)
            i, j = often[lo:lo + left.shape[1]], often[at:at + right.shape[1]]
            passed = ratio >= least + np.maximum(alone[i][:, None], alone[j])
            passed &= i[:, None] < j
            told[i[passed.any(axis=1)]] = True
            told[j[passed.any(axis=0)]] = True
    return told


def term_buckets(texts: pa.Array, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of texts: (first row, rows, bucket, row within the block), each
    bucket once a text, sorted by row."""
    flat, offsets = column_bytes(texts)
    for lo, hi in byte_chunks(offsets, TEXT_BLOCK):
        cut = offsets[lo:hi + 1]
        terms, at = word_hashes(flat[cut[0]:cut[-1]], cut - cut[0], NO_TERM)
        row = np.repeat(np.arange(hi - lo, dtype=np.int64), np.diff(at))
        both = np.unique((row << bits) | (terms >> U64(64 - bits)).astype(np.int64))
        yield lo, hi - lo, both & ((1 << bits) - 1), both >> bits


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 per_class: int = 8000, bits: int = 22, least_ratio: float = 14.0) -> DataFrame:
    """The fitted machine as a table: bucket (-1: the bias), weight, factors.

    ``labels`` has the id and a 0/1 label; rows with a null in either are
    ignored, a repeated id counts once (with its highest label; of its texts the
    one whose buckets sort first). At most about
    ``per_class`` documents of each label are used; the bias is corrected by the
    logarithm of the ratio of their shares, so scores follow the class ratio of
    all labels. Features are the buckets
    whose frequencies under the two labels differ by a log-likelihood ratio of
    ``least_ratio`` or more, alone or in pairs (``telling_pairs``), so that a
    million rare terms can't be learned by
    heart. Without labels of both kinds the table has
    at most a bias, NO_LABELS.
    """
    ship_package(docs.sparkSession)
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label")))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}     # two rows
    shares = {label: min(1.0, per_class / n) for label, n in sizes.items()}
    share = F.lit(0.0)
    for label, part in shares.items():
        share = F.when(F.col("label") == label, part).otherwise(share)
    # a label sampled by s has its odds multiplied by s in the sample
    prior = float(np.log(shares[0] / shares[1])) if set(shares) == {0, 1} else 0.0
    part = F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(1 << 30)) / float(1 << 30)
    sample = materialize(known.where(part < share), "toxicity-sample")     # its size is bounded by per_class
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).join(F.broadcast(sample), F.col("doc") == F.col("id"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n, bucket, row in term_buckets(batch.column(1), bits):
                cuts = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, n), batch.column(2).slice(lo, n),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(bucket.astype(np.int32)))], names=["id", "label", "buckets"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).value_lengths().to_numpy(zero_copy_only=False),
                  b.column(1).flatten().to_numpy(zero_copy_only=False)) for b in batches]
        label = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int32)
        table = {"bucket": [-1], "weight": [NO_LABELS], "factors": [[0.0] * FACTORS]}
        if len(np.unique(label)) == 2:
            row = np.repeat(np.arange(len(label)), np.concatenate([p[1] for p in parts]))
            bucket = np.concatenate([p[2] for p in parts])
            used, which, count = np.unique(bucket, return_inverse=True, return_counts=True)
            alone = likelihood_ratio(np.bincount(which, label[row] > 0), count, int((label > 0).sum()), len(label))
            often = (alone >= least_ratio) | telling_pairs(which, row, label, alone, least_ratio)
            dense = np.cumsum(often) - 1
            keep = often[which]
            model = FactorizationMachine.fit(dense[which[keep]], row[keep], (label > 0).astype(float), int(often.sum()))
            table = {"bucket": [-1, *used[often].tolist()], "weight": [model.bias + prior, *model.weights.tolist()],
                     "factors": [[0.0] * FACTORS, *model.factors.tolist()]}
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(table["bucket"], pa.int32()), "weight": pa.array(table["weight"], pa.float64()),
                                          "factors": pa.array(table["factors"], pa.list_(pa.float64()))})

    terms = texts.select("id", "text", "label").mapInArrow(describe, f"id {dict(known.dtypes)['id']}, label int, buckets array<int>")
    described = materialize(terms.groupBy("id", "label").agg(F.min("buckets").alias("buckets")), "toxicity-terms")
    ordered = described.repartition(1).sortWithinPartitions("id").select("label", "buckets")   # the bounded sample
    return materialize(ordered.mapInArrow(fit, "bucket int, weight double, factors array<double>"), "toxicity-model")


def score_toxicity(docs: DataFrame, model: DataFrame, text_col: str = "text", bits: int = 22, out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the score from 0 to 1 of every whole text.

    Empty, null and unknown texts get the bias's score. All rows and columns
    stay, whatever their names (a column named ``out`` is replaced); an empty
    table stays empty.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = list(model.toLocalIterator())              # at most 2^bits fitted buckets
    bias = next((r["weight"] for r in rows if r["bucket"] < 0), NO_LABELS)
    rows = [r for r in rows if r["bucket"] >= 0]
    place = np.full(1 << bits, -1, np.int32)
    place[[r["bucket"] for r in rows]] = np.arange(len(rows))
    machine = FactorizationMachine(bias, np.array([r["weight"] for r in rows]),
                                   np.array([r["factors"] for r in rows]).reshape(len(rows), FACTORS))
    shared = spark.sparkContext.broadcast((place, machine))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, machine = shared.value
        for batch in batches:
            scores = np.empty(batch.num_rows)
            for lo, n, bucket, row in term_buckets(batch.column(1), bits):
                feature = place[bucket]
                scores[lo:lo + n] = machine.score(feature[feature >= 0], row[feature >= 0], n)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], names=["row", "text", "score"])

    others = [c for c in docs.columns if c not in (text_col, out)]
    packed = docs.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("row"),
                         F.col(text_col).alias("text"))
    scored = packed.mapInArrow(score, T.StructType([*packed.schema.fields, T.StructField("score", T.DoubleType())]))
    at = {c: F.col(f"row.c{i}") for i, c in enumerate(others)}
    return scored.select(*[F.col("text").alias(c) if c == text_col else at[c].alias(c) for c in docs.columns if c != out],
                         F.col("score").alias(out))
