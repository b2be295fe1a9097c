"""Links between rows and what follows from them: splitting hot groups,
bounded prefilters and distributed connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casaflow.llm.arrays import Forest
from casaflow.session import materialize, ship_package

#: Members of a group that one task may compare with each other.
GROUP_LIMIT = 2000
#: Edges that one task contracts to stars.
EDGES_PER_TASK = 1 << 18


def split_groups(rows: DataFrame, key: str, member: str, limit: int = GROUP_LIMIT, weight: str | None = None, *,
                 sizes: DataFrame | None = None) -> DataFrame:
    """Deal each group's members so that no cell exceeds about ``2 * limit``
    members, or twice that sum of ``weight``.

    Adds ``cell`` (long) and ``side``. A group within the limit is one cell with
    side 0. A larger one is cut into chunks by the member's hash and every pair
    of chunks becomes a cell whose two chunks have sides 0 and 1, so any two
    members still meet in one cell: nothing is capped. ``sizes`` gives each
    key's members (column ``_n``) where they are known.
    """
    if sizes is None:
        sizes = rows.groupBy(key).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_n"))
    sizes = materialize(sizes.where(F.col("_n") > limit).select(F.col(key).alias("_k"), F.ceil(F.col("_n") / limit).cast("int").alias("_chunks")), "hot-groups")
    whole = {"cell": F.col(key), "side": F.lit(0)}
    if sizes.isEmpty():
        return rows.withColumns(whole)
    # only rows that may belong to a large group are moved to meet their group's size
    flagged = Bitmap(sizes, F.col("_k")).flag(rows, F.col(key), "_large")
    joined = flagged.where("_large").drop("_large").join(sizes, F.col(key) == F.col("_k"), "left").drop("_k")
    chunk = F.pmod(F.xxhash64(F.lit(11), F.col(member)), F.col("_chunks")).cast("int")
    other = F.explode(F.when(F.col("_chunks").isNull(), F.array(F.lit(0)))
                      .otherwise(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    dealt = joined.withColumn("_c", F.coalesce(chunk, F.lit(0))).withColumn("_o", other)
    cell = F.when(F.col("_chunks").isNull(), F.col(key)).otherwise(
        F.xxhash64(F.col(key), F.least("_c", "_o"), F.greatest("_c", "_o")))
    cut = (dealt.withColumns({"cell": cell, "side": F.when(F.col("_c") > F.col("_o"), 1).otherwise(0)})
           .drop("_chunks", "_c", "_o"))
    return cut.unionByName(flagged.where("not _large").drop("_large").withColumns(whole))


class Bitmap:
    """A fixed-size set of hashed keys: may pass more than was put in, never
    less. Its 2^bits bits are a table of at most 2^bits / 64 words (2 MiB at the
    default), so testing rows against it is a broadcast join of bounded size."""

    def __init__(self, keys: DataFrame, key: Column | str, bits: int = 23):
        self.bits = bits
        self.words = materialize(
            keys.select(self._hash(key).alias("h")).groupBy(F.shiftright("h", 6).alias("_at"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63L as int))")).alias("_word")), "bitmap")

    def _hash(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(F.lit(3), key), F.lit(1 << self.bits))

    def flag(self, frame: DataFrame, key: Column | str, name: str) -> DataFrame:
        """``frame`` with ``name``: whether the key may be in the set."""
        hit = F.expr("shiftrightunsigned(_word, cast(_h & 63L as int)) & 1L = 1L")
        return (frame.withColumn("_h", self._hash(key)).join(F.broadcast(self.words), F.shiftright("_h", 6) == F.col("_at"), "left")
                .withColumn(name, F.coalesce(hit, F.lit(False))).drop("_h", "_at", "_word"))

    def keep(self, frame: DataFrame, key: Column | str) -> DataFrame:
        """The rows whose key may be in the set."""
        return self.flag(frame, key, "_maybe").where("_maybe").drop("_maybe")


def without(frame: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``frame`` whose ``key`` is not in ``gone`` (null keys stay);
    only rows that a bitmap of the gone keys passes are shuffled."""
    flagged = Bitmap(gone, F.col(key)).flag(frame.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(frame.columns)])
                                                         .alias("row"), F.col(key).alias("key")), F.col("key"), "maybe")
    left = flagged.where("maybe").join(gone.select(F.col(key).alias("key")), "key", "left_anti").select("row")
    both = left.unionByName(flagged.where("not maybe").select("row"))
    return both.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(frame.columns)])


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``frame`` has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def task_count(rows: DataFrame, per_task: int) -> int:
    """Tasks for work that grows with rows, not with bytes."""
    return max(1, -(-rows.count() // per_task))


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sorted by key) whose key has another row; holds one row back."""
    last: pa.RecordBatch | None = None
    last_met = False
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        same = key[1:] == key[:-1]
        before = last is not None and last.column(0)[0].as_py() == key[0]
        if last is not None and (last_met or before):
            yield last
        met = np.concatenate([[before], same]) | np.append(same, False)
        if met[:-1].any():
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array(met[:-1]))
        last, last_met = batch.slice(batch.num_rows - 1), bool(met[-1])
    if last is not None and last_met:
        yield last


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace a partition's edges (u, v) by stars of its own components."""
    pairs = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not pairs:
        return
    nodes, flat = np.unique(np.concatenate([x for p in pairs for x in p]), return_inverse=True)
    forest, at = Forest(len(nodes)), 0
    for u, _ in pairs:
        k = len(u)
        for a, b in zip(flat[at:at + k].tolist(), flat[at + k:at + 2 * k].tolist()):
            forest.join(a, b)
        at += 2 * k
    roots = np.array([forest.root(i) for i in range(len(nodes))])
    rest = np.flatnonzero(roots != np.arange(len(nodes)))
    yield pa.RecordBatch.from_pydict({"u": nodes[rest], "v": nodes[roots[rest]]})


def _stars(edges: DataFrame) -> tuple[DataFrame, int]:
    """The edges (u, v) with every partition of EDGES_PER_TASK rows contracted,
    and the number of partitions."""
    stored = materialize(edges, "edges")
    parts = max(1, -(-stored.count() // EDGES_PER_TASK))
    return materialize(stored.coalesce(parts).mapInArrow(_contract, "u long, v long"), "stars"), parts


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the edges; a component's id is its
    smallest node. Edges may repeat and lead both ways; loops are ignored.

    Each round replaces the edges of every partition (a bounded number of
    edges) by stars, then links every node to the smallest node around it (the
    large-star and small-star steps), and is written out. Rounds grow with the
    logarithm of the longest path; edges of a single partition need none.
    """
    ship_package(edges.sparkSession)
    u, v = F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")
    stars, parts = _stars(edges.where(F.col(a) != F.col(b)).select(u, v).distinct())
    while parts > 1:
        parents = stars.select(F.col("v").alias("u")).distinct()
        open_ends = (stars.groupBy("u").count().where("count > 1").select("u")
                     .unionByName(stars.join(parents, "u", "left_semi").select("u")))
        if open_ends.isEmpty():
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("low", "u").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(low, "u")
                 .select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("low").alias("v")).distinct())
        stars, parts = _stars(small)
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
