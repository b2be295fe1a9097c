"""Variable-capacity best-fit packing of token sequences.

Pieces (documents, cut at the largest capacity) are packed longest first. A
piece goes into the open bin, of whatever capacity, that it leaves the least
room in; if none fits it opens the capacity of least cost per token among those
it fits in. At the end each bin is downsized to the smallest capacity that holds
its contents. Pieces are dealt to shards of bounded size by hash; a shard is
packed by one task, so only the last bins of a shard lose anything to the cut.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaflow.session import ship_package

#: Permitted sequence lengths.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Copies of a row that are numbered at a time.
COPIES = 1 << 16


def sequence_cost(capacity: int) -> float:
    """Cost of one training sequence: a fixed part, one linear in its length
    and one quadratic (attention)."""
    return 128.0 + capacity + capacity * capacity / 16384.0


def best_fit(lengths: list[int], capacities: tuple[int, ...], cost: Callable[[int], float] = sequence_cost) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, offset of each piece, final capacity of each bin);
    ``lengths`` are given longest first and none exceeds the largest capacity."""
    sizes = sorted(capacities)
    by_cost = sorted(sizes, key=lambda c: (cost(c) / c, c))
    opens = {}                                   # least-cost capacity by the smallest that fits
    for i, c in enumerate(sizes):
        opens[i] = next(x for x in by_cost if x >= c)
    room: list[tuple[int, int]] = []             # (free tokens, bin), sorted
    used: list[int] = []
    bins, offsets = [], []
    for n in lengths:
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = opens[bisect_left(sizes, n)], len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if free > n:
            insort(room, (free - n, b))
    return bins, offsets, [sizes[bisect_left(sizes, u)] for u in used]


def pack(docs: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", capacities: tuple[int, ...] = CAPACITIES,
         shard_pieces: int = 50_000) -> DataFrame:
    """One row per piece: the id, piece (from 0), piece_start (its first token
    in the document), piece_tokens, bin_id, bin_offset, bin_capacity, bin_tokens.

    Documents longer than the largest capacity are cut into pieces of it and a
    rest. Null, zero and negative lengths have no pieces. Null and repeated ids
    are packed like any others, each row for itself; rows of equal id and length
    are numbered (copies), and ties are packed in the order of id, piece and
    copy, so the packing doesn't depend on how the table is partitioned. An
    empty table gives an empty result; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    largest = max(capacities)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(length_col).cast("long").alias("n")).where("n > 0")
    # rows of equal id and length are counted, then numbered, a bounded number at a time
    copies = (rows.groupBy("id", "n").agg(F.count(F.lit(1)).alias("times"))
              .withColumn("from", F.explode(F.expr(f"sequence(0L, times - 1, {COPIES}L)")))
              .withColumn("copy", F.explode(F.expr(f"sequence(from, least(from + {COPIES - 1}L, times - 1))"))))
    pieces = (copies.select("id", "n", "copy").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {largest}"))))
              .withColumn("start", F.col("piece") * largest)
              .withColumn("length", F.least(F.lit(largest), F.col("n") - F.col("start"))))
    count = rows.agg(F.sum(F.expr(f"(n - 1) div {largest} + 1"))).first()[0] or 0
    shards = max(1, -(-int(count) // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.lit(23), "id", "n", "piece", "copy"), F.lit(shards)).cast("int"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "id", "n", "piece", "copy"], ascending=[False, True, True, True, True], kind="stable", na_position="first")
        bins, offsets, sizes = best_fit(part["length"].tolist(), capacities)
        bins = np.array(bins)
        used = np.bincount(bins, part["length"]).astype(np.int64)
        return pd.DataFrame({"id": part["id"].astype("Int64"), "piece": part["piece"], "start": part["start"], "length": part["length"],
                             "bin": bins + (int(part["shard"].iloc[0]) << 32), "offset": offsets,
                             "capacity": np.array(sizes)[bins], "used": used[bins]})

    packed = dealt.groupBy("shard").applyInPandas(run, "id long, piece long, start long, length long, bin long, offset long, capacity long, used long")
    names = {"id": id_col, "piece": "piece", "start": "piece_start", "length": "piece_tokens", "bin": "bin_id", "offset": "bin_offset",
             "capacity": "bin_capacity", "used": "bin_tokens"}
    return packed.select(*[F.col(a).alias(b) for a, b in names.items()])
