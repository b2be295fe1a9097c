"""Exact top-k search over binary codes: incremental multi-index hashing.

A code is cut into segments, and each segment is an index of its own. A query
looks up, in every segment, all values within radius 0, then 1, 2, ... of its
own. When radius r is done in all m segments, every code within distance
``m (r + 1) - 1`` has been met (one farther in every segment by r + 1 is at
least ``m (r + 1)`` away), so a query stops as soon as its kth verified
distance is within that bound. Rows and queries meet in blocks; each block
answers exactly for its rows and the best k over all blocks remain.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casaflow.session import ship_package

RESULT = "query_id long, query_code array<long>, id long, distance int"


def _signs(vector: Column, first: int, bits: int) -> Column:
    """A long of the signs of ``bits`` components from ``first`` on."""
    def bit(j: int) -> Column:
        x = F.get(vector, F.lit(first + j)).cast("double")
        return F.when((x > 0) & ~F.isnan(x), F.lit(1 << j if j < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
    code = bit(0)
    for j in range(1, bits):
        code = code.bitwiseOR(bit(j))
    return code


def sign_code(vector: Column, bits: int = 64) -> Column:
    """A long whose bit j says whether component j is above zero (missing, null
    and NaN components are 0). A vector of more than ``bits`` components is an
    error: ``sign_words`` holds longer ones whole."""
    too_long = F.raise_error(F.lit(f"a vector has more than {bits} components")).cast("long")
    return F.when(F.size(vector) > bits, too_long).when(vector.isNotNull(), _signs(vector, 0, bits))


def sign_words(vector: Column, components: int) -> Column:
    """The signs of ``components`` components as an array of longs, 64 each; a
    longer vector is an error."""
    words = -(-max(components, 1) // 64)
    cut = [_signs(vector, 64 * w, 64) for w in range(words)]
    too_long = F.raise_error(F.lit(f"a vector has more than {64 * words} components")).cast("array<long>")
    return F.when(F.size(vector) > 64 * words, too_long).when(vector.isNotNull(), F.array(*cut))


def _masks(width: int, radius: int) -> np.ndarray:
    """All segment values with ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for c in itertools.combinations(range(width), radius)], dtype=np.int64)


class MultiIndex:
    """Segment tables over the codes (rows x words) of one block; each word of
    ``bits`` bits is cut into ``segments``."""

    def __init__(self, codes: np.ndarray, bits: int, segments: int):
        self.codes = codes.reshape(len(codes), -1)
        edges = np.linspace(0, bits, segments + 1).astype(int)
        self.parts = [(w, int(a), int(b - a)) for w in range(self.codes.shape[1]) for a, b in zip(edges[:-1], edges[1:])]
        self.tables = []
        for word, at, width in self.parts:
            value = self._segment(self.codes[:, word], at, width)
            order = np.argsort(value, kind="stable")
            starts = np.searchsorted(value[order], np.arange((1 << width) + 1))
            self.tables.append((order, starts))

    @staticmethod
    def _segment(codes: np.ndarray, at: int, width: int) -> np.ndarray:
        return ((codes >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def search(self, query: np.ndarray, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k codes nearest to ``query`` (its words), ties by id."""
        values = [int(self._segment(query[word:word + 1], at, width)[0]) for word, at, width in self.parts]
        met = np.zeros(len(self.codes), dtype=bool)
        rows, dist = np.empty(0, np.int64), np.empty(0, np.int64)
        for radius in range(max(width for _, _, width in self.parts) + 1):
            found = []
            for (_, _, width), value, (order, starts) in zip(self.parts, values, self.tables):
                if radius > width:
                    continue
                probe = value ^ _MASKS(width, radius)
                lo, size = starts[probe], starts[probe + 1] - starts[probe]
                some = size > 0
                lo, size = lo[some], size[some]
                total = int(size.sum())
                if total:
                    at = np.repeat(lo - np.concatenate([[0], np.cumsum(size[:-1])]), size) + np.arange(total)
                    found.append(order[at])
            if found:
                new = np.unique(np.concatenate(found))
                new = new[~met[new]]
                met[new] = True
                rows = np.concatenate([rows, new])
                dist = np.concatenate([dist, np.bitwise_count(self.codes[new] ^ query).sum(axis=1, dtype=np.int64)])
                if len(rows) > k:    # keep the best k and everything tied with the kth
                    kth = np.partition(dist, k - 1)[k - 1]
                    rows, dist = rows[dist <= kth], dist[dist <= kth]
            if len(rows) >= min(k, len(self.codes)) and (len(rows) >= len(self.codes) or
                                                         np.partition(dist, k - 1)[k - 1] <= len(self.parts) * (radius + 1) - 1):
                break
        best = np.lexsort((ids[rows], dist))[:k]
        return rows[best], dist[best]


_CACHE: dict[tuple[int, int], np.ndarray] = {}


def _MASKS(width: int, radius: int) -> np.ndarray:
    if (width, radius) not in _CACHE:
        _CACHE[width, radius] = _masks(width, radius)
    return _CACHE[width, radius]


def topk_codes(rows: DataFrame, queries: DataFrame, k: int = 10, bits: int = 64, segments: int = 4,
               block_rows: int = 1 << 17, block_queries: int = 1 << 12) -> DataFrame:
    """The k rows nearest to each query by Hamming distance, ties by the smaller
    id: query_id, rank (from 1), id, distance, query_code (array of longs).

    Both frames have ``id`` (long) and ``code``, a long of ``bits`` bits or an
    array of such longs, as many in every row of both frames. Rows with a null id
    or code are not found and ask nothing; repeated rows are found as often as
    they occur. A query is an id with a code: repeated ones are asked once, and
    different codes under one id have rankings of their own (told apart by
    ``query_code``). With fewer than k rows all are returned; an empty side gives
    an empty result. Other columns are ignored. Rows and queries are dealt
    by hash to blocks of about ``block_rows`` and ``block_queries``, whose
    numbers follow the counts; a block pair holds only its own rows and queries
    and returns at most k rows a query.
    """
    ship_package(rows.sparkSession)

    def coded(frame: DataFrame) -> DataFrame:
        code = F.col("code") if frame.schema["code"].dataType.typeName() == "array" else F.when(F.col("code").isNotNull(), F.array("code"))
        return frame.select("id", code.alias("code")).where("id is not null and code is not null")

    rows, queries = coded(rows), coded(queries).distinct()
    n, q = rows.count(), queries.count()
    row_blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-q // block_queries))

    def dealt(frame: DataFrame, salt: Column, own: str, blocks: int, other: str, others: int) -> DataFrame:
        return (frame.withColumn(own, F.pmod(salt, F.lit(blocks)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))))

    left = dealt(rows, F.xxhash64(F.lit(5), "id", F.monotonically_increasing_id()), "rb", row_blocks, "qb", query_blocks)
    right = dealt(queries, F.xxhash64(F.lit(5), "id", "code"), "qb", query_blocks, "rb", row_blocks)

    def answer(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(block) and len(asked):
            ids = block["id"].to_numpy(np.int64)
            codes, wanted = (np.stack(f["code"].to_list()).astype(np.int64).view(np.uint64) for f in (block, asked))
            index = MultiIndex(codes, bits, segments)
            for query, own in zip(asked["id"].tolist(), wanted):
                hit, dist = index.search(own, k, ids)
                out.append(pd.DataFrame({"query_id": query, "query_code": [own.view(np.int64)] * len(hit), "id": ids[hit], "distance": dist.astype(np.int32)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "query_code", "id", "distance"], dtype=object)

    best = (left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInPandas(answer, RESULT))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query_code").orderBy("distance", "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "distance", "query_code")
