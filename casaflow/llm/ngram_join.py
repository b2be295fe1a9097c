"""N-gram Jaccard join: count vectors of token groups in R-trees.

Every text becomes the set of its distinct k-word shingles. The shingles are
hashed into groups; a set is the point of its group counts, and the overlap of
two sets is at most the sum over the groups of the smaller count.

* Equal sets are one class, represented by one row.
* Routing: two sets of Jaccard >= t share a shingle among the first
  ``n - ceil(t n) + 1`` of each in one global order, so each class goes to the
  nodes named by its first shingles. The order puts frequent shingles last (a
  heuristic that only keeps nodes small; any order gives the same links). Under
  one shingle, classes are in the order of size; where the next size is too
  large for a link a new node begins. Nodes of the same classes are one node.
* Each node packs the points that reach it into an R-tree and keeps the pairs
  whose bound allows the link; what hangs together over all nodes is a family.
* Families get the whole sets, each set once, and verify pairs exactly; pairs
  already linked through others are skipped, so a group of copies costs no
  square of links.
* Links run through distributed connected components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaflow.llm.arrays import (U64, Forest, byte_chunks, column_bytes, key_runs, mix, run_bounds,
                                 shingles, word_hashes)
from casaflow.llm.links import GROUP_LIMIT, Bitmap, components, split_groups, task_count
from casaflow.session import materialize, scratch, ship_package

GROUPS = 64, 4096    # fewest and most coordinates of a count vector
FAMILY_SHINGLES = 1 << 22   # shingles of a family's chunk (32 MiB)
#: Rows of one task that searches nodes, and of one that verifies families.
MEET_ROWS, VERIFY_ROWS = 1 << 15, 1 << 11
#: A route's low bits hold the set's size in steps of a two-hundredth.
SIZE_BITS, SIZE_STEP = 12, 1.005
LEAF = 32            # points of an R-tree leaf, children of a node
TEXT_BLOCK = 4 << 20  # bytes of text hashed at once


def _sets(batch: pa.RecordBatch, text: int, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row of the batch, shingle set) of each text."""
    flat, offsets = column_bytes(batch.column(text))
    for lo, hi in byte_chunks(offsets, TEXT_BLOCK):
        cut = offsets[lo:hi + 1]
        words, at = word_hashes(flat[cut[0]:cut[-1]], cut - cut[0])
        for i in range(hi - lo):
            yield lo + i, shingles(words[at[i]:at[i + 1]], k)


def frequent_shingles(texts: DataFrame, k: int, share: float = 2e-4, at_most: int = 1 << 19) -> np.ndarray:
    """Shingles in many documents, counted over all of them: tasks count within
    blocks of 4M shingles and report those that repeat there, Spark sums. The
    result (at most ``at_most`` hashes) only shapes the routing order."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, docs = [], 0, 0

        def report():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= 3
            return pa.RecordBatch.from_pydict({"token": tokens[often].view(np.int64), "n": n[often].astype(np.int64)})

        for batch in batches:
            for _, own in _sets(batch, 0, k):
                held.append(own)
                size, docs = size + len(own), docs + 1
                if size >= 4 << 20:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()
        yield pa.RecordBatch.from_pydict({"token": pa.array([None], pa.int64()), "n": pa.array([docs], pa.int64())})

    counts = texts.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where("n >= 16 or token is null"), "shingle-counts")
    docs = (counts.where("token is null").first() or {"n": 0})["n"]
    hot = (counts.where(F.col("token").isNotNull() & (F.col("n") >= max(16, int(docs * share))))
           .orderBy(F.desc("n"), "token").limit(at_most).select("token"))
    return np.sort(np.array([r[0] for r in hot.toLocalIterator()], dtype=np.int64).view(U64))


def group_counts(own: np.ndarray) -> np.ndarray:
    """The point of a set: counts of its shingles in 64 to 4096 hash groups, a
    power of two above a sixteenth of the set: with fewer groups unrelated large
    sets have bounds near their size, with more the points grow heavy."""
    groups = max(GROUPS[0], min(GROUPS[1], 1 << (len(own) // 16).bit_length()))
    return np.bincount((own & U64(groups - 1)).astype(np.int64), minlength=groups).astype(np.uint16)


class Folded:
    """The points of some rows at every width that two of them share: wider
    points are added up to the narrower one of a pair, never to that of a third
    row, under which large sets would look alike."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, sizes: np.ndarray):
        self.flat, self.offsets, self.sizes = flat, offsets, sizes
        self.widths = np.diff(offsets) // 2
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def level(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(row of the matrix by point, matrix) of the points at least so wide."""
        if width not in self.levels:
            rows = np.flatnonzero(self.widths >= width)
            place = np.full(len(self.widths), -1)
            place[rows] = np.arange(len(rows))
            matrix = np.empty((len(rows), width), np.uint16 if self.sizes[rows].max() < 1 << 16 else np.uint32)
            counts, begin = self.flat.view(np.uint16), self.offsets // 2
            for wide in np.unique(self.widths[rows]).tolist():
                own = np.flatnonzero(self.widths == wide)
                step = max(1, (1 << 20) // wide)
                for part in (own[lo:lo + step] for lo in range(0, len(own), step)):
                    points = counts[begin[part][:, None] + np.arange(wide)]
                    matrix[place[part]] = points.reshape(len(part), wide // width, width).sum(axis=1, dtype=np.uint32)
            self.levels[width] = place, matrix
        return self.levels[width]

    def allow(self, i: int, others: np.ndarray, num: int, den: int) -> np.ndarray:
        """Those of ``others`` whose bound with the row ``i`` allows a link."""
        shared, fits = np.minimum(self.widths[others], self.widths[i]), np.zeros(len(others), dtype=bool)
        for width in np.unique(shared).tolist():
            at = np.flatnonzero(shared == width)
            place, matrix = self.level(width)
            bound = np.minimum(matrix[place[others[at]]], matrix[place[i]]).sum(axis=1, dtype=np.int64)
            fits[at] = bound >= _need(self.sizes[i], self.sizes[others[at]], num, den)
        return others[fits]


def _pair_bounds(flat: np.ndarray, offsets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of the rows ``first`` and those after them."""
    bound = np.empty(len(first), np.int64)
    width = np.diff(offsets)
    same = width[first] == width[first + 1]
    counts = flat.view(np.uint16)
    for w in np.unique(width[first[same]]).tolist():
        at = np.flatnonzero(same & (width[first] == w))
        for lo in range(0, len(at), 2048):
            part = at[lo:lo + 2048]
            column = np.arange(w // 2)
            bound[part] = np.minimum(counts[(offsets[first[part]] // 2)[:, None] + column],
                                     counts[(offsets[first[part] + 1] // 2)[:, None] + column]).sum(axis=1, dtype=np.int64)
    for k in np.flatnonzero(~same).tolist():
        a, b = (counts[offsets[i] // 2:offsets[i + 1] // 2] for i in (first[k], first[k] + 1))
        groups = min(len(a), len(b))
        bound[k] = np.minimum(*(x.reshape(-1, groups).sum(axis=0, dtype=np.int64) for x in (a, b))).sum()
    return bound


def size_code(n: int) -> int:
    return min(int(np.log(max(n, 1)) / np.log(SIZE_STEP)), (1 << SIZE_BITS) - 1)


def _nodes(num: int, den: int, limit: int):
    """Routes (sorted by key and size) as nodes of two rows or more: (cell, rep,
    large). A run ends where the key does or the next size allows no link with
    the last. A run of at most ``limit`` rows is named by its rows, so that equal
    ones fall together; a larger one by its first route, and passed on in parts."""
    gap = int(np.ceil(np.log(den / num) / np.log(SIZE_STEP))) + 1

    def rows(cell, rep, large):
        return pa.RecordBatch.from_pydict({"cell": cell.view(np.int64), "rep": rep, "large": np.full(len(rep), large)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rep, name = np.empty(0, np.int64), np.empty(0, np.int64), None     # the open run; its name once it is large
        for batch in chain(batches, [None]):
            if batch is not None:
                key, rep = np.concatenate([key, batch.column(0).to_numpy()]), np.concatenate([rep, batch.column(1).to_numpy()])
            if not len(key):
                continue
            low = key & ((1 << SIZE_BITS) - 1)
            cuts = np.flatnonzero((key[1:] >> SIZE_BITS != key[:-1] >> SIZE_BITS) | (np.diff(low) > gap)) + 1
            cuts = np.concatenate([[0], cuts, [len(key)] if batch is None else []]).astype(np.int64)
            sizes = np.diff(cuts)
            large = sizes > limit
            large[:1] |= name is not None
            for i in np.flatnonzero(large).tolist():
                part, own = rep[cuts[i]:cuts[i + 1]], mix(key[cuts[i]:cuts[i] + 1].view(U64))[0] if i or name is None else name
                yield rows(np.full(len(part), own, U64), part, True)
            name = None if len(sizes) else name
            small = (sizes > 1) & ~large
            if small.any():
                sums = np.add.reduceat(mix(rep[:cuts[-1]].view(U64)), cuts[:-1])
                sums = mix(sums + sizes.astype(U64))
                once = np.zeros(len(sizes), dtype=bool)
                at = np.flatnonzero(small)
                once[at[np.unique(sums[at], return_index=True)[1]]] = True
                chosen = np.zeros(len(key), dtype=bool)
                chosen[:cuts[-1]] = np.repeat(once, sizes)
                yield rows(np.repeat(sums[once], sizes[once]), rep[chosen], False)
            key, rep = key[cuts[-1]:], rep[cuts[-1]:]
            if len(key) > limit + 1:        # the open run is large; its last row stays to compare sizes with
                name = name if name is not None else mix(key[:1].view(U64))[0]
                yield rows(np.full(len(rep) - 1, name, U64), rep[:-1], True)
                key, rep = key[-1:], rep[-1:]

    return run


def _need(n_a, n_b, num: int, den: int):
    """Least overlap of a link: den * I >= num * (a + b - I)."""
    return -(-num * (n_a + n_b) // (num + den))


class CountTree:
    """A packed R-tree over count vectors: leaves of LEAF points in tile order,
    each node with its largest counts and its smallest and largest set size."""

    def __init__(self, sizes: np.ndarray, counts: np.ndarray):
        n = len(sizes)
        tiles = max(1, int(np.sqrt(n / LEAF)))
        axis = int(np.argmax(counts.std(axis=0)))
        slab = np.empty(n, np.int64)
        slab[np.argsort(sizes, kind="stable")] = np.arange(n) * tiles // n
        self.order = np.lexsort((counts[:, axis], slab))
        self.sizes, self.counts = sizes[self.order], counts[self.order]
        self.levels = []
        top, small, large = self.counts, self.sizes, self.sizes
        while len(top) > 1:
            at = np.arange(0, len(top), LEAF)
            top = np.maximum.reduceat(top, at)
            small, large = np.minimum.reduceat(small, at), np.maximum.reduceat(large, at)
            self.levels.append((top, small, large))

    def search(self, size: int, count: np.ndarray, num: int, den: int) -> np.ndarray:
        """Tree positions of the points whose bound allows a link."""
        def passes(top, small, large, at):
            fit = at[(small[at] * num <= size * den) & (large[at] * den >= size * num)]
            bound = np.minimum(top[fit], count).sum(axis=1, dtype=np.int64)
            return fit[bound >= _need(size, np.maximum(small[fit], -(-size * num // den)), num, den)]

        at = np.arange(len(self.levels[-1][0])) if self.levels else np.arange(len(self.sizes))
        for level, below in zip(self.levels[::-1], [*self.levels[-2::-1], (self.counts, self.sizes, self.sizes)]):
            at = passes(*level, at)
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < len(below[1])]
        return passes(self.counts, self.sizes, self.sizes, at)


def _candidates(num: int, den: int):
    """Per node: R-tree search; a forest over the candidate pairs as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, "cell"):
            cell, rep, n, side = (rows.column(c).to_numpy() for c in ("cell", "rep", "n", "side"))
            flat, offsets = column_bytes(rows.column("counts"))
            cuts = run_bounds(cell)
            labels = np.arange(len(cell))
            pair = cuts[:-1][np.diff(cuts) == 2]
            good = pair[_pair_bounds(flat, offsets, pair) >= _need(n[pair], n[pair + 1], num, den)]
            labels[good + 1] = good
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo > 2:
                    points = Folded(flat[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], n[lo:hi])
                    labels[lo:hi] = lo + _candidate_groups(points, side[lo:hi], num, den)
            tied = np.flatnonzero(labels != np.arange(len(cell)))
            yield pa.RecordBatch.from_pydict({"a": rep[tied], "b": rep[labels[tied]]})

    return run


def _candidate_groups(points: Folded, side: np.ndarray, num: int, den: int) -> np.ndarray:
    """The smallest index of each point's connected set of candidate pairs. The
    tree knows all points at the narrowest width only; what it finds is held
    against the pair's own width."""
    n = len(points.sizes)
    tree = CountTree(points.sizes, points.level(int(points.widths.min()))[1])
    label, two = np.arange(n), bool(side.any())
    for pos in range(n):
        i = int(tree.order[pos])
        hits = tree.order[tree.search(int(tree.sizes[pos]), tree.counts[pos], num, den)]
        hits = hits[label[hits] != label[i]]
        if two:
            hits = hits[side[hits] != side[i]]
        if len(hits):
            tied = np.unique(np.append(label[points.allow(i, hits, num, den)], label[i]))
            if len(tied) > 1:
                label[np.isin(label, tied)] = tied[0]
    return label


def _verify(num: int, den: int):
    """Per family: exact Jaccard of the pairs that are not linked yet and whose
    bound allows a link; links as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in key_runs(batches, "cell"):
            cell, rep, side = (rows.column(c).to_numpy() for c in ("cell", "rep", "side"))
            flat, offsets = column_bytes(rows.column("tokens"))
            tokens, offsets = flat.view(U64), offsets // 8
            packed, ends = column_bytes(rows.column("counts"))
            links = []
            cuts = run_bounds(cell)
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                own = [tokens[offsets[i]:offsets[i + 1]] for i in range(lo, hi)]
                sizes = np.array([len(x) for x in own])
                label, sides = np.arange(hi - lo), side[lo:hi]
                two = bool(sides.any())
                points = Folded(packed[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo], sizes)
                for i in range(hi - lo - 1):
                    j = i + 1 + np.flatnonzero((label[i + 1:] != label[i])
                                               & (sizes[i + 1:] * den >= sizes[i] * num) & (sizes[i] * den >= sizes[i + 1:] * num))
                    if two:
                        j = j[sides[j] != sides[i]]
                    for other in points.allow(i, j, num, den).tolist():
                        if label[other] != label[i]:
                            both = len(np.intersect1d(own[i], own[other], assume_unique=True))
                            if den * both >= num * (sizes[i] + sizes[other] - both):
                                links.append((int(rep[lo + i]), int(rep[lo + other])))
                                label[label == label[other]] = label[i]
            if links:
                a, b = zip(*links)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
               num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: the id, n_shingles and component_id, the smallest
    id reachable by links ``den * intersection >= num * union`` (itself
    included).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set holds the
    distinct k-word shingles (64-bit hashes). With fewer words the whole
    sequence counts as one shingle. Null or wordless texts have no set, link
    with nothing and are their own component. Repeated rows and repeated ids
    are kept as rows of their own; null ids join in links, and a component
    without any id has a null component_id. Very long texts are used whole; an
    empty table gives an empty result. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    with scratch(docs.sparkSession, {"ngram-groups"}):
        groups = materialize(_groups(docs, id_col, text_col, k, num, den), "ngram-groups")
    return groups.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _groups(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """The join's rows: doc_id, n, component_id."""
    pick = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    often = docs.sparkSession.sparkContext.broadcast(frequent_shingles(pick.select("text"), k))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = often.value, set()
        for batch in batches:
            n, d1, d2, counts, keys = [], [], [], [], []
            for _, own in _sets(batch, 2, k):
                n.append(len(own))
                h = mix(own + U64(len(own)))
                d1.append(int(h.sum(dtype=U64).view(np.int64)))
                d2.append(int(mix(h).sum(dtype=U64).view(np.int64)))
                # copies within a task share one set of routes
                if not len(own) or (d1[-1], d2[-1]) in seen:
                    counts.append(None)
                    keys.append(None)
                    continue
                seen.add((d1[-1], d2[-1]))
                counts.append(group_counts(own).tobytes())
                first = len(own) + 1 - (-(-num * len(own) // den))
                if len(last):
                    at = np.minimum(np.searchsorted(last, own), len(last) - 1)
                    own = np.concatenate([own[last[at] != own], own[last[at] == own]])
                keys.append((own[:first].view(np.int64) >> SIZE_BITS << SIZE_BITS) | size_code(n[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(counts, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["row", "doc_id", "n", "d1", "d2", "counts", "keys"])

    described = materialize(
        pick.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .mapInArrow(describe, "row long, doc_id long, n long, d1 long, d2 long, counts binary, keys array<long>"), "ngram-sets")
    # the row that stands for a class of equal sets: one that carries its routes
    full = described.where("n > 0")
    classes = materialize(
        full.groupBy("n", "d1", "d2").agg(
            F.min(F.when(F.col("counts").isNotNull(), F.struct("row", "doc_id"))).alias("first"),
            F.min("doc_id").alias("least_id"))
        .select("n", "d1", "d2", "least_id", F.col("first.row").alias("rep"), F.col("first.doc_id").alias("rep_id")), "ngram-classes")
    points = (described.join(classes.select(F.col("rep").alias("row")), "row", "left_semi")
              .withColumnRenamed("row", "rep"))

    with scratch(docs.sparkSession, {"ngram-families"}):
        near = _near(points, num, den)
        families = materialize(components(near), "ngram-families")
    families = families.select(F.col("node").alias("rep"), F.col("component").alias("family"))

    wanted = families.select("rep").join(classes, "rep").select("rep", "rep_id", "d1", "d2")
    sets = materialize(_wanted_sets(pick, wanted, k).join(points.select("rep", "n", "counts"), "rep"), "ngram-wanted")
    # a chunk is bounded in members, which are compared with each other, and in shingles
    weighed = families.join(sets.select("rep", F.greatest(F.col("n"), F.lit(FAMILY_SHINGLES // GROUP_LIMIT)).alias("weight")), "rep")
    dealt = (split_groups(weighed, "family", "rep", FAMILY_SHINGLES, "weight").select("cell", "rep", "side")
             .join(sets, "rep").select("cell", "rep", "side", "counts", "tokens"))
    links = materialize(dealt.repartition(task_count(families, VERIFY_ROWS), "cell").sortWithinPartitions("cell", "rep")
                        .mapInArrow(_verify(num, den), "a long, b long"), "ngram-links")
    found = materialize(components(links).join(classes.select(F.col("rep").alias("node"), "least_id"), "node"), "ngram-found")
    least = found.groupBy("component").agg(F.min("least_id").alias("least"))
    linked = found.join(least, "component").select(F.col("node").alias("rep"), F.col("least"), F.lit(True).alias("linked"))
    named = classes.join(linked, "rep", "left").select(
        "n", "d1", "d2", F.when(F.col("linked"), F.col("least")).otherwise(F.col("least_id")).alias("component_id"))
    out = (full.select("doc_id", "n", "d1", "d2").join(named, ["n", "d1", "d2"])
           .select("doc_id", "n", "component_id")
           .unionByName(described.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))))
    return out


def _near(points: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): what the nodes' trees join, from rows rep, n, counts and keys."""
    routes = points.select(F.explode("keys").alias("key"), "rep").repartition(F.shiftright("key", SIZE_BITS)).sortWithinPartitions("key")
    met = materialize(routes.mapInArrow(_nodes(num, den, GROUP_LIMIT), "cell long, rep long, large boolean"), "ngram-routes")
    # many nodes are met by the same rows: one of them is enough
    small = met.where("not large").select("cell", "rep").distinct().withColumn("side", F.lit(0))
    large = met.where("large").select("cell", "rep").withColumnRenamed("cell", "key")
    cells = materialize(small.unionByName(split_groups(large, "key", "rep").select("cell", "rep", "side")), "ngram-cells")
    filled = cells.join(points.select("rep", "n", "counts"), "rep").select("cell", "rep", "n", "side", "counts")
    return materialize(filled.repartition(task_count(cells, MEET_ROWS), "cell").sortWithinPartitions("cell", "rep")
                       .mapInArrow(_candidates(num, den), "a long, b long"), "ngram-candidates")


def _wanted_sets(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, tokens) of the wanted rows, computed again from their texts: a
    scan passes a fixed-size bitmap of the wanted ids, an exact join follows."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2, tokens = [], [], []
            for _, own in _sets(batch, 1, k):
                h = mix(own + U64(len(own)))
                d1.append(int(h.sum(dtype=U64).view(np.int64)))
                d2.append(int(mix(h).sum(dtype=U64).view(np.int64)))
                tokens.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(tokens, pa.binary())],
                names=["id", "e1", "e2", "tokens"])

    near = Bitmap(wanted, F.coalesce("rep_id", F.lit(-1))).keep(texts, F.coalesce("doc_id", F.lit(-1)))
    found = near.select("doc_id", "text").mapInArrow(compute, "id long, e1 long, e2 long, tokens binary")
    on = F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("e1") == F.col("d1")) & (F.col("e2") == F.col("d2"))
    return wanted.join(found, on).select("rep", "tokens").dropDuplicates(["rep"])
