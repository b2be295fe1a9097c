"""Near-duplicate vectors: random-hyperplane sign hashing in several tables,
exact cosine verification and distributed connected components.

* Equal vectors with one label are one class with a weight.
* Every class gets one bucket per table: its signs against ``bits`` random
  hyperplanes. Vectors of cosine c agree on one plane with probability
  1 - acos(c)/pi, so a pair at 0.98 meets in one of 24 tables of 16 planes with
  probability 0.99996.
* Inside a bucket all pairs are verified with one matrix product in double
  precision. A pair counts only in the first table where it meets, so links are
  counted without writing pairs out; a spanning forest goes on as edges.
* Buckets beyond the group limit are cut into chunks that meet pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaflow.llm.arrays import U64, Forest, column_bytes, key_runs, mix, run_bounds
from casaflow.llm.links import components, repeated, split_groups
from casaflow.session import materialize, ship_package

TILE = 512          # rows of a verified tile


def hyperplanes(dim: int, planes: int, seed: int) -> np.ndarray:
    """The same random directions in every task."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, planes))


def sign_buckets(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """One ``bits``-bit sign pattern per vector and table (uint32)."""
    signs = vectors @ hyperplanes(vectors.shape[1], tables * bits, seed) > 0
    weights = (1 << np.arange(bits)).astype(np.uint32)
    return signs.reshape(len(vectors), tables, bits) @ weights


def _describe(tables: int, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            lens = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            usable = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            values = lists.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) + 0.0
            at = np.concatenate([[0], np.cumsum(lens)])
            vec, sig, keys = ([None] * batch.num_rows for _ in range(3))
            for dim in np.unique(lens[lens > 0]).tolist():
                rows = np.flatnonzero((lens == dim) & usable)
                mat = values[at[rows][:, None] + np.arange(dim)]
                scale = np.abs(mat).max(axis=1, initial=0.0)
                good = np.isfinite(mat).all(axis=1) & (scale > 0)
                rows, mat = rows[good], mat[good]
                if not len(rows):
                    continue
                # scaled by the largest component, so no square over- or underflows
                buckets = sign_buckets(mat / scale[good][:, None], tables, bits, seed)
                table = np.arange(tables, dtype=U64) << U64(32)
                hashed = mix(mix(table + buckets.astype(U64)) + U64(dim)).view(np.int64)
                for i, row in enumerate(rows.tolist()):
                    vec[row], sig[row], keys[row] = mat[i].tobytes(), buckets[i].astype("<u4").tobytes(), hashed[i]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(vec, pa.binary()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "vec_id", "label", "vec", "sig", "keys"])
    return run


def _tile_links(a: np.ndarray, b: np.ndarray, sa: np.ndarray, sb: np.ndarray, table: int, limit: float) -> np.ndarray:
    """Pairs (bool matrix) of unit vectors that link and first meet in ``table``."""
    linked = a @ b.T >= limit
    for t in range(table):
        if not linked.any():
            break
        linked &= sa[:, t][:, None] != sb[:, t][None, :]
    return linked


def _verify(tables: int, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, "cell"):
            cell, rep, table, weight, side = (rows.column(c).to_numpy() for c in ("cell", "rep", "table", "weight", "side"))
            flat, offsets = column_bytes(rows.column("vec"))
            sigs = np.frombuffer(column_bytes(rows.column("sig"))[0], "<u4").reshape(-1, tables)
            links = np.zeros(len(cell), np.int64)
            edges: list[tuple[int, int]] = []
            cuts = run_bounds(cell)
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo < 2 or len({int(x) for x in np.diff(offsets[lo:hi + 1])}) > 1:
                    continue
                mat = flat[offsets[lo]:offsets[hi]].view(np.float64).reshape(hi - lo, -1)
                mat = mat / np.abs(mat).max(axis=1)[:, None]
                unit = mat / np.sqrt((mat * mat).sum(axis=1))[:, None]
                own, sides, forest = sigs[lo:hi], side[lo:hi], Forest(hi - lo)
                two = bool(sides.any())
                for i in range(0, hi - lo, TILE):
                    for j in range(i, hi - lo, TILE):
                        x, y = slice(i, min(i + TILE, hi - lo)), slice(j, min(j + TILE, hi - lo))
                        linked = _tile_links(unit[x], unit[y], own[x], own[y], int(table[lo]), limit)
                        if i == j:
                            linked = np.triu(linked, 1)
                        if two:
                            linked &= sides[x][:, None] != sides[y][None, :]
                        p, q = np.nonzero(linked)
                        np.add.at(links, lo + i + p, weight[lo + j + q])
                        np.add.at(links, lo + j + q, weight[lo + i + p])
                        for s, t in zip((i + p).tolist(), (j + q).tolist()):
                            if forest.join(s, t):
                                edges.append((int(rep[lo + s]), int(rep[lo + t])))
            some = np.flatnonzero(links)
            a, b = zip(*edges) if edges else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([*rep[some].tolist(), *a], pa.int64()), pa.array([None] * len(some) + list(b), pa.int64()),
                 pa.array([*links[some].tolist(), *[0] * len(a)], pa.int64())], names=["a", "b", "links"])
    return run


def embed_dedup(vectors: DataFrame, threshold: float = 0.98, tables: int = 24, bits: int = 16, seed: int = 7,
                id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: id, n_links (other vectors linked directly),
    component_id (smallest id reachable by links, itself included) and kept
    (id = component_id).

    Two vectors link when their labels (of any type, equal by a 64-bit hash) are
    equal and not null, their lengths are equal and their cosine in double precision is at least ``threshold``.
    Vectors that are null, empty, zero, or hold null or non-finite components,
    and vectors with a null label, link with nothing. Repeated rows link with
    each other; repeated ids are kept as rows of their own; a null id is never
    kept, and a component without any id has a null component_id. An empty
    table gives an empty result; other columns are ignored.
    """
    ship_package(vectors.sparkSession)
    pick = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                          F.when(F.col(label_col).isNotNull(), F.xxhash64(label_col)).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    described = materialize(pick.mapInArrow(_describe(tables, bits, seed), "row long, vec_id long, label long, vec binary, "
                                            "sig binary, keys array<long>"), "vectors")
    digest = [F.xxhash64(F.lit(s), "vec") for s in (1, 2)]
    full = described.where("vec is not null").withColumns({"d1": digest[0], "d2": digest[1]})
    classes = materialize(full.groupBy("label", "d1", "d2").agg(
        F.min("row").alias("rep"), F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("weight")), "vector-classes")

    points = full.join(classes.select(F.col("rep").alias("row"), "weight"), "row")
    buckets = points.select(F.col("row").alias("rep"), "label", F.posexplode("keys").alias("table", "bucket"))
    routes = buckets.select(F.xxhash64("label", "bucket").alias("key"), "rep", "table").repartition("key").sortWithinPartitions("key")
    met = materialize(routes.mapInArrow(repeated, "key long, rep long, table int"), "vector-routes")
    filled = split_groups(met, "key", "rep").join(points.select(F.col("row").alias("rep"), "weight", "sig", "vec"), "rep")
    found = materialize(filled.select("cell", "rep", "table", "weight", "side", "sig", "vec")
                        .repartition("cell").sortWithinPartitions("cell", "rep")
                        .mapInArrow(_verify(tables, threshold), "a long, b long, links long"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    comps = materialize(components(found.where("b is not null").select("a", "b"))
                        .join(classes.select(F.col("rep").alias("node"), "least_id"), "node"), "vector-components")
    least = comps.groupBy("component").agg(F.min("least_id").alias("least"))
    linked = comps.join(least, "component").select(F.col("node").alias("rep"), "least", F.lit(True).alias("linked"))
    named = classes.join(counts, "rep", "left").join(linked, "rep", "left").select(
        "label", "d1", "d2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.when(F.col("linked"), F.col("least")).otherwise(F.col("least_id")).alias("component_id"))
    out = (full.select("vec_id", "label", "d1", "d2").join(named, ["label", "d1", "d2"]).select("vec_id", "n_links", "component_id")
           .unionByName(described.where("vec is null").select(
               "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))))
    return out.select(F.col("vec_id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
