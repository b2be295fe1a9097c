"""Target-distribution importance resampling.

Every text is a bag of hashed n-grams. A byte table lower-cases A-Z and blanks
all that separates terms, ``bytes.split`` yields the terms, chained CRC-32 seeds
extend them to n-grams, and Counters (one a task, added up by Spark) hold how
often each bucket occurs in the corpus and in the target. A document's weight is
the sum over its n-grams of the logarithm of the target's share over the
corpus's share; with Gumbel noise drawn from the id's hash on top, the highest
scores are a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casaflow.llm.links import fresh
from casaflow.llm.ranks import number_rows
from casaflow.llm.words import buckets_of, gram_hashes, text_bytes
from casaflow.session import materialize, ship_package

#: N-grams that a task counts at once before it adds them to its Counter.
COUNT_AT_ONCE = 1 << 20


def _count(buckets: int, grams: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        held: list[np.ndarray] = []

        def add() -> None:
            n = np.bincount(np.concatenate(held), minlength=buckets) if held else np.zeros(buckets, np.int64)
            total.update({int(b): int(n[b]) for b in np.flatnonzero(n)})
            held.clear()

        size = 0
        for batch in batches:
            for data in text_bytes(batch.column(0)):
                for _, hashes in gram_hashes(data, grams):
                    held.append(buckets_of(hashes, buckets))
                    size += len(hashes)
                    if size >= COUNT_AT_ONCE:
                        add()
                        size = 0
        add()
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(list(total), pa.int32()), "n": pa.array(list(total.values()), pa.int64())})
    return run


def bucket_counts(texts: DataFrame, text_col: str, buckets: int, grams: int) -> DataFrame:
    """(bucket, n) over all n-grams of all texts; buckets that don't occur are
    absent. A task sends one row for each bucket, whatever it read."""
    ship_package(texts.sparkSession)
    counted = texts.select(F.col(f"`{text_col}`")).mapInArrow(_count(buckets, grams), "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the
    target over that in the corpus, rounded down."""
    total, aim = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1.0) * total / ((corpus.get(b, 0) + 1.0) * aim)))
                     for b in range(buckets)], dtype=np.int64)


def _weigh(gains: np.ndarray, grams: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in text_bytes(batch.column("text")):
                words = features = weight = 0
                for n, hashes in gram_hashes(data, grams):
                    words += n
                    features += len(hashes)
                    weight += int(gains[buckets_of(hashes, len(gains))].sum())
                out.append((words, features, weight))
            cols = [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))]
            yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("row"), batch.column("id"), *cols],
                                             names=["at", "row", "id", "n_words", "n_features", "weight"])
    return run


def gumbel(id_text: Column, seed: int) -> Column:
    """Thousandths of standard Gumbel noise, rounded down, from the first 32
    bits of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(uniform)))


def importance_resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
                        keep: list[str] | None = None, buckets: int = 10_000, grams: int = 3, min_words: int = 20,
                        share: tuple[int, int] = (5, 100), seed: int = 42) -> DataFrame:
    """Every row of ``docs`` (its columns, or those in ``keep``) with n_words,
    n_features, weight, score and rank; a name that is taken gets an underscore.

    Of the N documents with at least ``min_words`` words, the
    ``share[0] * N // share[1]`` of the highest scores are drawn: their rank is 1,
    2, 3, ... by falling score, ties to the smaller id, then (equal ids) fewer
    n-grams, then the row as stored, so that ties only decide between rows that
    are alike here. All others have a null rank.

    A null or empty text has no words, no n-grams and weight 0. Null ids count as
    an empty id in the noise and come last in ties; rows that repeat an id are
    drawn each for itself. Texts are used whole; one without separators is a
    single word. An empty target leaves smoothing alone, an empty ``docs`` an
    empty result.

    The driver holds ``buckets`` counts of both sides. Texts are read twice, for
    the counts and for the weights; only rows of scores not below the last drawn
    one are shuffled whole.
    """
    spark = docs.sparkSession
    ship_package(spark)
    corpus, aim = ({r["bucket"]: r["n"] for r in bucket_counts(t, c, buckets, grams).collect()}      # at most ``buckets`` rows
                   for t, c in ((docs, text_col), (target, target_col)))
    names = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).alias("row")
    pick = docs.select(F.monotonically_increasing_id().alias("at"), row, F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = ", ".join(f"{c} {pick.schema[c].dataType.simpleString()}" for c in ("at", "row", "id"))
    weighed = pick.mapInArrow(_weigh(bucket_gains(corpus, aim, buckets), grams), f"{schema}, n_words long, n_features long, weight long")
    noise = gumbel(F.coalesce(F.col("id").cast("string"), F.lit("")), seed)
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise), "scored")

    long = scored.where(F.col("n_words") >= min_words)
    draw = share[0] * long.count() // share[1]
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features").asc(), F.col("at").asc()]
    ranked = number_rows(long.select("at", "score", "id", "n_features"), order).where(F.col("rank") < draw)
    drawn = materialize(ranked.select("at", "score", (F.col("rank") + 1).alias("rank")), "drawn")
    least = drawn.agg(F.min("score")).first()[0]
    near = (F.col("n_words") >= min_words) & (F.col("score") >= F.lit(least)) if least is not None else F.lit(False)
    out = (scored.where(near).join(drawn.select("at", "rank"), "at", "left")
           .unionByName(scored.where(~near).withColumn("rank", F.lit(None).cast("long"))))
    cols = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)]
    for c in ("n_words", "n_features", "weight", "score", "rank"):
        new = c
        while new.lower() in {n.lower() for n in names}:
            new = f"_{new}"
        cols.append(F.col(c).alias(new))
    return out.select(*cols)
