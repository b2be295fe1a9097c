"""Remove repeated byte strings: suffix arrays by linear suffix grouping.

A byte goes when it lies in a string of ``length`` bytes that also starts
anywhere else in the corpus.

* Routing: in each ``length``-byte window the k-gram of least hash is its
  anchor; equal windows have equal anchors at equal offsets. Windows of one
  anchor are a run, named by the hash of over half a window around the anchor.
  Only runs whose name occurs again go on (one narrow shuffle).
* Runs with equal bytes all repeat; those of one text (periodic text) are
  settled in the task that finds them. Runs with a common name and different bytes
  (where repeated passages begin and end) are cut into blocks aligned at the
  anchor; the suffix array of all block sequences of a task, built by grouping
  Lyndon prefixes, brings together the suffixes that share enough whole blocks,
  and the bytes left over at both ends of a window are compared exactly.
* Names shared by more different runs than a task should hold are settled by
  counting their windows one by one, which combines before it shuffles.
* Covered windows merge to spans per text; texts are cut by their spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaflow.llm.arrays import U64, column_bytes, key_runs, mix, run_bounds
from casaflow.llm.grouping import common_prefixes, suffix_array
from casaflow.llm.links import Bitmap, repeated
from casaflow.session import materialize, ship_package

KGRAM = 32            # bytes of an anchor
POSITION_BITS = 20    # positions of a hashed piece of text
PIECE = 1 << 19       # window starts hashed at once
BLOCK = 20            # bytes of a suffix-array symbol; divides the window length
RUN_LIMIT = 4000      # different runs of one name compared in one task
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if not _POWERS:
        base, n = 0x9E3779B97F4A7C15, 1 << POSITION_BITS
        for value in (base, pow(base, -1, 1 << 64)):
            row = np.full(n, value, dtype=U64)
            row[0] = 1
            _POWERS.append(np.multiply.accumulate(row))
    return _POWERS[0], _POWERS[1]


class RangeHash:
    """Hashes of any ranges of a piece of at most 2^20 - 1 bytes."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers()
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * power[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U64))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:-k]) * self.inverse[:n])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (block-wise running minima)."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=U64)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def runs(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(name, bytes hash, first start, last start, anchor) of the runs of all
    windows of a piece."""
    ranges = RangeHash(data)
    grams = ranges.grams(KGRAM)
    mask = U64((1 << POSITION_BITS) - 1)
    packed = (grams & ~mask) | np.arange(len(grams), dtype=U64)
    anchor = (sliding_minimum(packed, length - KGRAM + 1) & mask).astype(np.int64)
    start = np.arange(len(anchor))
    reach = (length - KGRAM) // 2
    left = anchor - start >= reach
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (left[1:] != left[:-1])) + 1
    first, last = np.concatenate([[0], cut]), np.append(cut, len(anchor)) - 1
    a, left = anchor[first], left[first]
    low = np.where(left, a - reach, a)
    name = mix(ranges.of(low, low + length - reach) + left.astype(U64))
    whole = mix(ranges.of(first, last + length) + mix(((a - first).astype(U64) << U64(32)) + (last - first).astype(U64)))
    return name, whole, first, last, a


RUN_COLUMNS = "name long, whole long, text long, first long, last long, anchor long, n long"


def _own_repeats(parts: list[tuple[np.ndarray, ...]], digest: int, length: int) -> list[tuple[np.ndarray, ...]]:
    """One text's runs, each different one once with its number ``n``, and what
    its own repeats (as in periodic text) cover, as merged spans with n = 0."""
    name, whole, first, last, anchor = (np.concatenate(c) for c in zip(*parts))
    both = mix(name + mix(whole))
    _, at, which, count = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
    if len(at) == len(both):
        return [(name, whole, np.full(len(name), digest), first, last, anchor, np.ones(len(name), np.int64))]
    again = np.flatnonzero(count[which] > 1)
    start, end = first[again], last[again] + length        # in text order, so ends ascend
    cut = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    lo, hi = start[cut], end[np.append(cut[1:], len(end)) - 1]
    spans = (mix(lo.astype(U64) + U64(digest & (1 << 64) - 1)), np.zeros(len(lo), U64), np.full(len(lo), digest), lo, hi, lo, np.zeros(len(lo), np.int64))
    return [(name[at], whole[at], np.full(len(at), digest), first[at], last[at], anchor[at], count), spans]


def _met_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs whose name has another row or that repeat in their own text, and
    all spans; rows are sorted by name."""
    aside: list[pa.RecordBatch] = []

    def others() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alone = pc.equal(batch.column(6), 1)
            aside.append(batch.filter(pc.invert(alone)))
            yield batch

    for batch in repeated(others()):
        yield batch.filter(pc.equal(batch.column(6), 1))
        while aside:
            yield aside.pop()
    yield from aside


def _find_runs(length: int):
    columns = [c.split()[0] for c in RUN_COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            digests = batch.column(0).to_numpy()
            flat, offsets = column_bytes(batch.column(1))
            held: list[tuple[np.ndarray, ...]] = []
            rows = 0
            for i, digest in enumerate(digests.tolist()):
                n = int(offsets[i + 1] - offsets[i])
                if n < length or digest in seen:      # a copy in the same task adds nothing
                    continue
                seen.add(digest)
                parts = []
                for base in range(0, n - length + 1, PIECE):
                    end = min(n, base + PIECE + length - 1)
                    name, whole, first, last, anchor = runs(flat[offsets[i] + base:offsets[i] + end], length)
                    parts.append((name, whole, first + base, last + base, anchor + base))
                held += _own_repeats(parts, digest, length)
                rows += sum(len(p[0]) for p in parts)
                if rows > 1 << 17:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in zip(*held)], names=columns)
                    held, rows = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in zip(*held)], names=columns)
    return run


def _matching_windows(rows: list[tuple[int, np.ndarray, int, int, int]], length: int) -> list[np.ndarray]:
    """For runs (group, bytes, first, last, anchor), with bytes from ``first``
    to ``last + length``: which of the run's windows also occur at the same
    offset from the anchor in another run of the group."""
    whole = length // BLOCK - 1           # whole blocks inside any window
    symbols, row_of, block_of, marks = [], [], [], []
    blobs, lows = [], []
    for r, (group, data, first, last, anchor) in enumerate(rows):
        low = first - anchor              # column of the first byte; columns count from the anchor
        b0, b1 = -(-low // BLOCK), (low + len(data)) // BLOCK
        part = data[b0 * BLOCK - low:b1 * BLOCK - low].reshape(-1, BLOCK).astype(U64) + U64(1)
        value = (part * _powers()[0][:BLOCK]).sum(axis=1, dtype=U64)
        column = np.arange(b0, b1)
        value = mix(mix(value) + mix(U64(group) * U64(1 << 20) + (column + (1 << 18)).astype(U64)))
        symbols.append(value >> U64(2))
        row_of.append(np.full(b1 - b0 + 1, r))
        block_of.append(np.append(column, b1))
        marks.append(U64((1 << 63) + r))  # an end mark of its own
        blobs.append(data)
        lows.append(low)
    text = np.concatenate([np.append(s, m) for s, m in zip(symbols, marks)])
    row_of, block_of = np.concatenate(row_of), np.concatenate(block_of)
    _, text = np.unique(text, return_inverse=True)
    array = suffix_array(text)
    prefix = common_prefixes(text, array)
    # suffixes that share ``whole`` blocks stand together
    label = np.cumsum(prefix < whole)
    size = np.bincount(label)[label]
    at = array[size > 1]
    label, row, block = label[size > 1], row_of[at], block_of[at]
    result = [np.zeros(last - first + 1, dtype=bool) for _, _, first, last, _ in rows]
    if not len(at):
        return result
    padded = np.concatenate([np.concatenate([np.zeros(BLOCK, np.uint8), d, np.zeros(BLOCK, np.uint8)]) for d in blobs])
    sizes = np.array([len(d) + 2 * BLOCK for d in blobs])
    begin = np.concatenate([[0], np.cumsum(sizes[:-1])]) + BLOCK
    low = np.array(lows)
    span = np.array([last - first for _, _, first, last, _ in rows])
    here = begin[row] + block * BLOCK - low[row]
    for d in range(BLOCK):                # bytes of the window before its first whole block
        column = block * BLOCK - d
        start = column - low[row]         # the window's number within its run
        fits = np.flatnonzero((start >= 0) & (start <= span[row]))
        if not len(fits):
            continue
        ends = np.concatenate([padded[here[fits][:, None] + np.arange(-d, 0)],
                               padded[(here[fits] + whole * BLOCK)[:, None] + np.arange(BLOCK - d)]], axis=1)
        key = np.ascontiguousarray(np.concatenate([label[fits].astype("<i8").view(np.uint8).reshape(-1, 8), ends], axis=1))
        key = key.view(np.dtype((np.void, key.shape[1]))).ravel()
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        for k in fits[count[which] > 1].tolist():
            result[row[k]][start[k]] = True
    return result


def _compare_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in key_runs(batches, "name"):
            name, text, first, last, anchor, alone = (table.column(c).to_numpy() for c in ("name", "text", "first", "last", "anchor", "alone"))
            flat, offsets = column_bytes(table.column("data"))
            group = np.repeat(np.arange(len(run_bounds(name)) - 1), np.diff(run_bounds(name)))
            rows = [(int(group[i]), flat[offsets[i]:offsets[i + 1]], int(first[i]), int(last[i]), int(anchor[i]))
                    for i in range(len(name))]
            out: list[tuple[int, int, int]] = []
            for i, hit in enumerate(_matching_windows(rows, length)):
                if alone[i] and hit.any():
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                    out += [(int(text[i]), int(first[i] + a), int(first[i] + b - 1 + length)) for a, b in edge.reshape(-1, 2)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["text", "start", "end"])
    return run


def _cut_runs(length: int):
    """(digest, text, runs) to one row per run with the run's bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = memoryview(text.as_buffer())
                for lo in range(0, len(asked), 4096):
                    part = asked[lo:lo + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[c] for r in part], t) for c, t in (("name", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("anchor", pa.int64()), ("alone", pa.bool_()))]
                        + [pa.array([digest] * len(part), pa.int64()), pa.array([bytes(data[r["first"]:r["last"] + length]) for r in part], pa.binary())],
                        names=["name", "first", "last", "anchor", "alone", "text", "data"])
    return run


def _window_hashes(length: int):
    """Each window of a run by itself: (window hash, text, start, alone)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = column_bytes(batch.column(6))
            for i in range(batch.num_rows):
                hashes = RangeHash(flat[offsets[i]:offsets[i + 1]]).grams(length).view(np.int64)
                n, name, first = len(hashes), batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                yield pa.RecordBatch.from_pydict({
                    "window": mix(hashes.view(U64) + U64(name & (1 << 64) - 1)).view(np.int64), "text": np.full(n, batch.column(5)[i].as_py()),
                    "start": first + np.arange(n), "alone": pa.array([batch.column(4)[i].as_py()] * n, pa.bool_())})
    return run


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted intervals of each text to its maximal spans."""
    for table in key_runs(batches, "text"):
        text, start, end = (table.column(c).to_numpy() for c in ("text", "start", "end"))
        cuts = run_bounds(text)
        spans = []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            reach = np.maximum.accumulate(end[lo:hi])
            begins = np.flatnonzero(np.concatenate([[True], start[lo + 1:hi] > reach[:-1]]))
            ends = reach[np.append(begins[1:], hi - lo) - 1]
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(start[lo:hi][begins], ends)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(text[cuts[:-1]]), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["text", "spans"])


def repeated_spans(texts: DataFrame, length: int = 400) -> DataFrame:
    """(text, spans): the covered byte ranges of each different text that has
    some. ``texts`` has ``digest`` (64-bit hash of the bytes) and ``data``
    (binary, not null); a text that occurs twice is covered whole if it has
    ``length`` bytes."""
    copies = (texts.select("digest", F.octet_length("data").cast("long").alias("n")).where(F.col("n") >= length)
              .groupBy("digest").agg(F.count(F.lit(1)).alias("c"), F.max("n").alias("n")).where("c > 1"))
    copies = materialize(copies.select(F.col("digest").alias("text"), F.lit(0).cast("long").alias("start"), F.col("n").alias("end")), "copies")
    found = texts.mapInArrow(_find_runs(length), RUN_COLUMNS)
    kept = materialize(found.repartition("name").sortWithinPartitions("name").mapInArrow(_met_runs, RUN_COLUMNS), "runs")
    own = kept.where("n = 0").select("text", F.col("first").alias("start"), F.col("last").alias("end"))
    met = kept.where("n > 0")
    kinds = met.groupBy("name", "whole").agg(F.sum("n").alias("n"), F.min(F.struct("text", "first", "last", "anchor")).alias("r"))
    kinds = materialize(kinds, "run-kinds")
    # runs with equal bytes: every window of them repeats
    equal = (met.join(kinds.where("n > 1").select("name", "whole"), ["name", "whole"], "left_semi")
             .select("text", F.col("first").alias("start"), (F.col("last") + length).alias("end")))
    # names with different runs: one of each kind meets the others
    mixed = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    asked = (kinds.join(mixed, "name").groupBy(F.col("r.text").alias("text"))
             .agg(F.collect_list(F.struct("name", F.col("r.first").alias("first"), F.col("r.last").alias("last"),
                                          F.col("r.anchor").alias("anchor"), (F.col("n") == 1).alias("alone"))).alias("asked")))
    asked = materialize(asked, "runs-asked")
    wanted = Bitmap(asked, F.col("text")).keep(texts, F.col("digest")).dropDuplicates(["digest"])
    parts = materialize(wanted.join(asked, F.col("digest") == F.col("text")).select("digest", "data", "asked").mapInArrow(
        _cut_runs(length), "name long, first long, last long, anchor long, alone boolean, text long, data binary"), "run-bytes")
    large = mixed.where(F.col("kinds") > RUN_LIMIT).select("name")
    compared = (parts.join(large, "name", "left_anti").repartition("name").sortWithinPartitions("name")
                .mapInArrow(_compare_runs(length), "text long, start long, end long"))
    windows = parts.join(large, "name", "left_semi").select("name", "first", "last", "anchor", "alone", "text", "data").mapInArrow(
        _window_hashes(length), "window long, text long, start long, alone boolean")
    counted = (windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
               .join(windows.where("alone"), "window").select("text", "start", (F.col("start") + length).alias("end")))
    covered = own.unionByName(equal).unionByName(compared).unionByName(counted).join(copies.select("text"), "text", "left_anti").unionByName(copies)
    return covered.distinct().repartition("text").sortWithinPartitions("text", "start").mapInArrow(
        _merge_spans, "text long, spans array<struct<start:long,end:long>>")


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("data")
        kept = []
        for text, spans in zip(batch.column(at), batch.column(batch.num_columns - 1).to_pylist()):
            data, pos, out = memoryview(text.as_buffer()), 0, []
            for s in spans or ():
                out.append(data[pos:s["start"]])
                pos = s["end"]
            kept.append(b"".join([*out, data[pos:]]))
        yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(kept, pa.binary()), *batch.columns[at + 1:]], names=batch.schema.names)


def dedup_strings(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without their repeated strings: id, n_bytes, ``spans`` (the
    maximal removed byte ranges, null when none) and ``kept`` (binary: the
    remaining bytes, which may cut characters in two).

    A string of ``length`` (a multiple of 20 of at least 100) bytes counts as
    repeated when it starts at any other place, in the same or another
    document; strings are judged on the input. A null text is empty. Texts
    shorter than ``length`` keep all bytes; every copy of a repeated row is
    treated alike; null and repeated ids are kept as they are; very long texts
    are hashed in pieces. An empty table gives an empty result; other columns
    are ignored. Equality of runs is that of 64-bit hashes.
    """
    ship_package(docs.sparkSession)
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col(id_col).alias("id"), data.alias("data")).withColumn("digest", F.xxhash64("data"))
    spans = materialize(repeated_spans(rows.select("digest", "data"), length), "spans")
    sized = rows.withColumn("n_bytes", F.octet_length("data").cast("long"))
    flagged = Bitmap(spans, F.col("text")).flag(sized, F.col("digest"), "maybe")
    none = F.lit(None).cast("array<struct<start:long,end:long>>")
    untouched = flagged.where("not maybe").select("id", "n_bytes", none.alias("spans"), F.col("data").alias("kept"))
    touched = (flagged.where("maybe").join(spans, F.col("digest") == F.col("text"), "left").select("id", "n_bytes", "data", "spans")
               .mapInArrow(_cut_texts, f"id {dict(docs.dtypes)[id_col]}, n_bytes long, data binary, spans array<struct<start:long,end:long>>")
               .select("id", "n_bytes", "spans", F.col("data").alias("kept")))
    return untouched.unionByName(touched).withColumnRenamed("id", id_col)
