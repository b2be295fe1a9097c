"""Filter interaction audit by sorted posting lists.

For every part of a corpus and every filter there is a sorted list of the rows
that fail it. What a filter removes after others is the difference of its list
and the union of theirs, so all orders of the filters follow from the 16
unions before each filter: galloping k-way merges copy whole runs of a list up to
the next list's head and leap over what another list already has. Rows are dealt
by ranges of ids; a range's lists are merged by one task, and the sizes of the
ranges add up.
"""

from __future__ import annotations

import itertools
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casaflow.llm.words import text_bytes, word_blocks
from casaflow.session import materialize, ship_package

FILTERS = "ABCDE"
#: The filter that fails copies; the others look at the text alone.
COPY = FILTERS.index("E")
#: Rows of one range of ids.
RANGE_ROWS = 1 << 16
UPPER = bytes(range(65, 91))
CONTINUATION = bytes(range(0x80, 0xC0))
SPECIAL = re.compile(rb"[#$%&*|]")
SIZES = "docs long, failing long, before long, removed long, good long, toxic long"


def gallop(ids: list[int], x: int, at: int) -> int:
    """The first place from ``at`` on whose id is not below ``x``: steps that
    double, then a binary search in the last one."""
    step, end = 1, at
    while end < len(ids) and ids[end] < x:
        at, end, step = end + 1, end + step, 2 * step
    return bisect_left(ids, x, at, min(end, len(ids)))


def union(lists: list[list[int]]) -> list[int]:
    """The ids in any of the sorted lists, sorted."""
    at = [0] * len(lists)
    heads = [(ids[0], k) for k, ids in enumerate(lists) if ids]
    heapify(heads)
    out: list[int] = []
    while len(heads) > 1:
        _, k = heappop(heads)
        ids, head = lists[k], heads[0][0]
        end = gallop(ids, head, at[k])
        out += ids[at[k]:end]
        at[k] = end + (end < len(ids) and ids[end] == head)     # the other list brings it
        if at[k] < len(ids):
            heappush(heads, (ids[at[k]], k))
    if heads:
        k = heads[0][1]
        out += lists[k][at[k]:]
    return out


def difference(ids: list[int], other: list[int]) -> list[int]:
    """The ids of a sorted list that another one does not have."""
    out: list[int] = []
    i = j = 0
    while i < len(ids):
        j = gallop(other, ids[i], j)
        if j == len(other):
            return out + ids[i:]
        end = gallop(ids, other[j], i)
        out += ids[i:end]
        i = end + (end < len(ids) and ids[end] == other[j])
    return out


def common(ids: list[int], other: list[int]) -> list[int]:
    """The ids that both sorted lists have."""
    out: list[int] = []
    i = j = 0
    while i < len(ids):
        j = gallop(other, ids[i], j)
        if j == len(other):
            break
        if other[j] == ids[i]:
            out.append(ids[i])
            i += 1
        else:
            i = gallop(ids, other[j], i)
    return out


def failures(data: bytes) -> int:
    """Bits of the text filters that a text fails: A under 100 words, B
    distinct words below four fifths of the words, C capitals above a tenth of
    the characters, D any of ``#$%&*|``."""
    words, distinct = 0, set()
    for block in word_blocks(data):
        words += len(block)
        distinct.update(block)
    capitals, points = len(data) - len(data.translate(None, UPPER)), len(data.translate(None, CONTINUATION))
    return ((words < 100) | (100 * len(distinct) < 80 * words) << 1 | (100 * capitals > 10 * points) << 2
            | (SPECIAL.search(data) is not None) << 3)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts' failures and a 128-bit hash of each, as two longs."""
    for batch in batches:
        bits, digests = [], []
        for data in text_bytes(batch.column("text")):
            bits.append(failures(data))
            digests.append(blake2b(data, digest_size=16).digest())
        halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                                          pa.array(bits, pa.int32())], names=["id", "part", "hash", "hash2", "bits"])


def merge_range(fails: list[list[int]], rows: list[int], good: list[int], toxic: list[int], size) -> Iterator[tuple[int, ...]]:
    """(prefix, filter, docs, failing, before, removed, good, toxic) for every
    filter and every set of filters before it (as bits)."""
    sets = {0: []} | {p: union([f for k, f in enumerate(fails) if p >> k & 1]) for p in range(1, 1 << len(fails))}
    for k, failing in enumerate(fails):
        for prefix, before in sets.items():
            if not prefix >> k & 1:
                removed = difference(failing, before)
                yield (prefix, k, size(rows), size(failing), size(before), size(removed), size(common(good, removed)), size(common(toxic, removed)))


def _audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sizes of one range, sorted by id, hash and ``is_doc``."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    range_ = pa.Table.from_batches(held)
    col = {c: range_.column(c).to_numpy() for c in ("hash", "hash2", "is_doc", "bits", "n", "good", "toxic")}
    ids = range_.column("id").combine_chunks()
    known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (known[1:] != known[:-1]) | (col["hash"][1:] != col["hash"][:-1]) | (col["hash2"][1:] != col["hash2"][:-1])
    doc = col["is_doc"] == 1
    key = np.cumsum(new) - 1
    first = np.flatnonzero((~doc[new])[key] & doc | ~known & doc)       # rows under a first row's key, and rows without an id
    where = np.flatnonzero(doc)
    coded = range_.column("part").combine_chunks().take(pa.array(where)).dictionary_encode()
    part = coded.indices.to_numpy()
    weights = col["n"].tolist()
    single = bool((col["n"][doc] == 1).all())
    size = len if single else (lambda found: sum(map(weights.__getitem__, found)))
    first = first.tolist()
    out = []
    for i, name in enumerate(coded.dictionary.to_pylist()):
        rows = where[part == i]
        bits = col["bits"][rows]
        fails = [rows[bits >> k & 1 == 1].tolist() for k in range(len(FILTERS))]
        here = rows.tolist()
        fails[COPY] = difference(here, common(first, here))
        good, toxic = (rows[col[c][rows] == 1].tolist() for c in ("good", "toxic"))
        out += [(name, *sizes) for sizes in merge_range(fails, here, good, toxic, size)]
    names = ["part", "prefix", "filter", "docs", "failing", "before", "removed", "good", "toxic"]
    types = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 6]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 9, types)], names=names)


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row for each part, order of the five filters and step: part,
    filter_order, step, kept (documents left after the step), removed, redundant
    (fail the step's filter, removed before), unique_fails (fail it alone),
    good_lost and toxic_lost (removed here, labelled so), shapley (removed by the
    filter summed over all orders).

    Filters A to D look at the whole text (``failures``), E fails a row whose
    text a smaller id has anywhere in the table. ``labels`` holds the id,
    ``quality`` and ``toxic``; where it repeats an id, one row with 1 is enough. A
    null text is empty, a null part the empty string. A row without an id has no
    label, is no copy and makes none; rows of equal id and text are no copies of
    each other and all count. Other columns are ignored; without documents there
    are no rows.

    The posting lists of a range hold at most about RANGE_ROWS rows (rows alike
    in id, text and part are one with a count).
    """
    spark = docs.sparkSession
    ship_package(spark)
    pick = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                       F.col(f"`{text_col}`").alias("text"))
    marked = pick.mapInArrow(_mark, "id long, part string, hash long, hash2 long, bits int")
    rows = materialize(marked.groupBy("id", "hash", "hash2", "part").agg(F.first("bits").alias("bits"), F.count(F.lit(1)).alias("n")), "audit-rows")
    known = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int").alias("good"),
                           F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int").alias("toxic"))
             .where("id is not null").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic")))
    firsts = rows.where("id is not null").groupBy("hash", "hash2").agg(F.min("id").alias("id")).select(
        "id", F.lit("").alias("part"), "hash", "hash2", F.lit(0).alias("bits"), F.lit(1).cast("long").alias("n"),
        F.lit(0).alias("good"), F.lit(0).alias("toxic"), F.lit(0).alias("is_doc"))
    labelled = rows.join(known, "id", "left").select("id", "part", "hash", "hash2", "bits", "n", F.coalesce("good", F.lit(0)).alias("good"),
                                                    F.coalesce("toxic", F.lit(0)).alias("toxic"), F.lit(1).alias("is_doc"))
    posted = materialize(labelled.unionByName(firsts), "audit-postings")
    ranges = max(1, -(-posted.count() // RANGE_ROWS))
    dealt = posted.repartitionByRange(ranges, "id", "hash", "hash2").sortWithinPartitions("id", "hash", "hash2", "is_doc")
    sizes = dealt.mapInArrow(_audit, f"part string, prefix int, filter int, {SIZES}")
    sums = sizes.groupBy("part", "prefix", "filter").agg(*[F.sum(c).alias(c) for c in ("docs", "failing", "before", "removed", "good", "toxic")])

    n = len(FILTERS)
    steps = [("".join(FILTERS[k] for k in order), step + 1, sum(1 << k for k in order[:step]), order[step])
             for order in itertools.permutations(range(n)) for step in range(n)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, prefix int, filter int")
    times = F.lit(0)
    for before in range(n):
        times = F.when(F.bit_count("prefix") == before, math.factorial(before) * math.factorial(n - 1 - before)).otherwise(times)
    same = Window.partitionBy("part", "filter")         # the 16 sets before a filter
    others = F.lit((1 << n) - 1) - F.expr("shiftleft(1, filter)")
    told = sums.withColumns({
        "unique_fails": F.sum(F.when(F.col("prefix") == others, F.col("removed")).otherwise(0)).over(same),
        "shapley": F.sum(F.col("removed") * times).over(same)})
    return told.join(F.broadcast(orders), ["prefix", "filter"]).select(
        "part", "filter_order", "step", (F.col("docs") - F.col("before") - F.col("removed")).alias("kept"), "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"), "shapley")
