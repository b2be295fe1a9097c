"""Packing token sequences into windows of one length by non-negative least squares.

Documents are cut into whole windows and a rest; the rests' lengths make a
histogram of fixed size. Every combination of up to three lengths that fills a
window exactly is a column of a matrix, and the number of times each is used is
the non-negative least squares fit of the histogram. Rounded counts are taken as
far as pieces last; what is left is packed greedily, longest piece first, the
longest that fits next, and a piece is cut only to close a window that no piece
fits. The last tokens go to sequences of powers of two, which need no padding.

The plan says for runs of pieces (all pieces of one length, numbered) in which
run of sequences and at which offset they lie, so its size depends on the window
and not on the number of documents; tasks look their pieces up in it.
"""

from __future__ import annotations

import zlib
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaflow.llm.ranks import number_rows
from casaflow.llm.words import text_bytes
from casaflow.session import materialize, ship_package

#: Rounds of the least squares solver, and the combinations each looks at.
ROUNDS, LOOKED_AT = 60, 20_000
TEXTS_AT_ONCE = 256


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """All rows of one to three of the lengths (falling, then zeros) that add up
    to the window."""
    there = np.zeros(window + 1, dtype=bool)
    there[lengths] = True
    found = [np.array([[window, 0, 0]])] if there[window] else []
    a = lengths[(lengths < window) & (2 * lengths >= window)]
    pairs = a[there[window - a]]
    found.append(np.stack([pairs, window - pairs, np.zeros_like(pairs)], axis=1))
    for a in lengths[(lengths < window - 1) & (3 * lengths >= window)].tolist():
        b = lengths[(lengths <= a) & (2 * lengths >= window - a) & (lengths < window - a)]
        b = b[there[window - a - b]]
        found.append(np.stack([np.full_like(b, a), b, window - a - b], axis=1))
    return np.concatenate(found)


def fit_counts(combos: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative x with the sum of x[j] times the lengths of combination j
    near the histogram in least squares. Each round moves the combinations that
    gain most, no two of which share a length, each to its best value."""
    left = histogram.astype(float)
    left[0] = 0.0
    x = np.zeros(len(combos))
    same = (combos[:, 0] == combos[:, 1]).astype(int) + (combos[:, 1] == combos[:, 2]) * (combos[:, 2] > 0) + (combos[:, 0] == combos[:, 2])
    norm = (combos > 0).sum(axis=1) + 2.0 * same       # squared length of the column: repeated lengths count squared
    for _ in range(rounds if len(combos) else 0):
        slope = left[combos].sum(axis=1)
        step = np.maximum(slope / norm, -x)
        gain = step * (2 * slope - norm * step)
        best = np.argpartition(-gain, min(LOOKED_AT, len(gain) - 1))[:LOOKED_AT]
        best = best[gain[best] > 0.25]
        if not len(best):
            break
        free = [True] * len(histogram)
        moved = []
        for j, (a, b, c) in zip(best[np.argsort(-gain[best])].tolist(), combos[best[np.argsort(-gain[best])]].tolist()):
            if free[a] and (not b or free[b]) and (not c or free[c]):
                free[a] = free[b] = free[c] = False
                free[0] = True
                moved.append(j)
        x[moved] += step[moved]
        np.subtract.at(left, combos[moved], step[moved][:, None])
        left[0] = 0.0
    return x


class Plan:
    """Which pieces lie where: entries (source length, start in the piece, first
    number, count, length, first sequence, offset)."""

    def __init__(self, histogram: np.ndarray, window: int):
        self.window, self.sequences = window, 0
        self.left = histogram.astype(np.int64).copy()
        self.pool = {n: deque([(n, 0, 0, int(c))]) for n, c in enumerate(histogram.tolist()) if n and c}
        self.entries: list[tuple[int, ...]] = []

    def take(self, length: int, count: int, sequence: int, offset: int, part: int | None = None) -> None:
        """Put ``count`` pieces of ``length`` (or their first ``part`` tokens; the
        rest goes back) into consecutive sequences."""
        self.left[length] -= count
        while count:
            source, start, first, n = self.pool[length].popleft()
            use = min(n, count)
            if use < n:
                self.pool[length].appendleft((source, start, first + use, n - use))
            size = length if part is None else part
            self.entries.append((source, start, first, use, size, sequence, offset))
            if size < length:
                self.pool.setdefault(length - size, deque()).append((source, start + size, first, use))
                self.left[length - size] += use
            sequence, count = sequence + use, count - use

    def windows(self, lengths: list[int], count: int, cut: int | None = None) -> None:
        """``count`` windows of these lengths, and of the first tokens of a
        piece of the length ``cut`` to the end."""
        offset = 0
        for n in lengths:
            self.take(n, count, self.sequences, offset)
            offset += n
        if cut is not None:
            self.take(cut, count, self.sequences, offset, self.window - offset)
        self.sequences += count

    def fitted(self, combos: np.ndarray, x: np.ndarray) -> None:
        """The rounded counts, the largest first, as far as pieces last."""
        whole = np.floor(x + 0.5).astype(np.int64)
        for j in np.argsort(-x, kind="stable")[:int((whole > 0).sum())].tolist():
            lengths = [n for n in combos[j].tolist() if n]
            count = min(int(whole[j]), *(int(self.left[n]) // k for n, k in Counter(lengths).items()))
            if count > 0:
                self.windows(lengths, count)

    def greedy(self) -> None:
        """Full windows from what is left, as long as there are tokens for one."""
        sizes = np.arange(self.window + 1)
        while int(self.left @ sizes) >= self.window:
            lengths, used, gap = [], Counter(), self.window
            while gap:
                fit = [n for n in np.flatnonzero(self.left[:gap + 1])[::-1].tolist() if self.left[n] > used[n]] if used else \
                    np.flatnonzero(self.left)[-1:].tolist()
                if not fit:
                    break
                n = fit[0]
                k = min(gap // n, int(self.left[n]) - used[n])
                lengths += [n] * k
                used[n] += k
                gap -= n * k
            cut = None
            if gap:
                cut = next(n for n in np.flatnonzero(self.left)[::-1].tolist() if self.left[n] > used[n])
                used[cut] += 1
            self.windows(lengths, min(int(self.left[n]) // k for n, k in used.items()), cut)

    def tail(self) -> None:
        """What is too little for a window, in sequences of powers of two."""
        sizes = np.arange(self.window + 1)
        while (tokens := int(self.left @ sizes)):
            room, offset = 1 << (tokens.bit_length() - 1), 0
            while offset < room:
                n = int(np.flatnonzero(self.left)[-1])
                part = min(n, room - offset)
                self.take(n, 1, self.sequences, offset, part)
                offset += part
            self.sequences += 1

    def table(self) -> np.ndarray:
        return np.array(self.entries, dtype=np.int64).reshape(-1, 7)


def plan_windows(histogram: np.ndarray, window: int) -> Plan:
    """The plan for ``histogram[n]`` pieces of each length n up to the window."""
    plan = Plan(histogram, window)
    combos = combinations(np.flatnonzero(histogram), window)
    plan.fitted(combos, fit_counts(combos, histogram))
    plan.greedy()
    plan.tail()
    return plan


class Places:
    """Looks pieces up in a plan's entries."""

    def __init__(self, entries: np.ndarray, window: int):
        self.base = window + 1
        state = entries[:, 0] * self.base + entries[:, 1]
        order = np.lexsort((entries[:, 2], state))
        self.entries = entries[order]
        self.states, at = np.unique(state[order], return_inverse=True)
        self.keys = (at << 40) + self.entries[:, 2]         # numbers stay below 2^40

    def find(self, length: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(index of the piece, start in it, length, sequence, offset) of all
        parts of the pieces, the first parts first."""
        index, at = np.arange(len(length)), np.zeros(len(length), np.int64)
        while len(index):
            state = np.searchsorted(self.states, length[index] * self.base + at)
            e = self.entries[np.searchsorted(self.keys, (state << 40) + number[index], side="right") - 1]
            yield index, at, e[:, 4], e[:, 5] + number[index] - e[:, 2], e[:, 6]
            at = at + e[:, 4]
            more = at < length[index]
            index, at = index[more], at[more]


def _encode(tokenizer_path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from casaflow.llm.tokens import encoder
        enc = encoder(tokenizer_path)
        narrow = enc.tokenizer.get_vocab_size() <= 1 << 16 and (end_id or 0) < 1 << 16
        for batch in batches:
            for part in (batch.slice(i, TEXTS_AT_ONCE) for i in range(0, batch.num_rows, TEXTS_AT_ONCE)):
                ids, offsets = enc.encode([t.decode() for t in text_bytes(part.column("text"))])
                sizes, crcs, blobs = [], [], []
                for a, b in zip(offsets[:-1], offsets[1:]):
                    own = ids[a:b] if end_id is None else np.append(ids[a:b], np.uint32(end_id))
                    sizes.append(len(own))
                    crcs.append(zlib.crc32(own.astype("<u4").tobytes()))
                    blobs.append(own.astype("<u2" if narrow else "<u4").tobytes())
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()),
                                                  pa.array(blobs, pa.binary())], names=["row", "id", "n", "crc", "ids"])
    return run


def _place(entries: np.ndarray, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(entries, window)
        for batch in batches:
            row, start = batch.column("row").to_numpy(), batch.column("start").to_numpy()
            for index, at, length, sequence, offset in places.find(batch.column("length").to_numpy(), batch.column("number").to_numpy()):
                yield pa.RecordBatch.from_pydict({"row": row[index], "start": start[index] + at, "length": length, "sequence_id": sequence, "offset": offset})
    return run


def _cut(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, TEXTS_AT_ONCE) for i in range(0, batch.num_rows, TEXTS_AT_ONCE)):
                out = [[] for _ in range(8)]
                for doc, n, blob, pieces in zip(part.column("id").to_pylist(), part.column("n").to_pylist(), part.column("ids"), part.column("pieces").to_pylist()):
                    ids = np.frombuffer(blob.as_buffer(), "<u2" if len(blob.as_buffer()) == 2 * n else "<u4")
                    for p in pieces:
                        wide = ids[p["start"]:p["start"] + p["length"]].astype("<u4").tobytes()
                        for col, value in zip(out, (doc, p["start"], p["length"], zlib.crc32(wide), n, p["sequence_id"], p["offset"], wide if with_ids else None)):
                            col.append(value)
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:7]), pa.array(out[7], pa.binary())],
                                                 names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])
    return run


def pack_windows(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048,
                 end_id: int | None = 1, with_ids: bool = True) -> DataFrame:
    """One row per piece: the id, start (its document's token ids before it),
    length, ids_crc32 (of its ids as little-endian u32), doc_tokens, sequence_id,
    offset in the sequence, and, with ``with_ids``, the ids as u32 bytes.

    Every id of every whole text, and ``end_id`` after each, lies in exactly one
    piece. All sequences hold exactly ``window`` ids but for the last few, whose
    sizes are falling powers of two, so none needs padding. A null or empty text
    is its end id alone (no piece without one). Null and repeated ids are packed
    as rows of their own; pieces of one length are numbered by id (null ids
    first), start and the CRC-32 of the document's ids, so the result does not
    depend on the partitioning; only rows alike in all these may change places.
    Very long texts are one row of ids, cut like any other. Other columns are
    ignored; an empty table gives no rows.

    The driver holds the histogram and the plan, whose sizes depend on the window.
    """
    if window & (window - 1) or not 0 < window < 1 << 16:
        raise ValueError("the window must be a power of two below 65536")
    ship_package(docs.sparkSession)
    pick = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    tokens = materialize(pick.mapInArrow(_encode(tokenizer_path, end_id), "row long, id long, n long, crc long, ids binary").where("n > 0"), "window-tokens")
    pieces = tokens.select("row", "id", "n", "crc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(window).cast("long"))).alias("start"))
    pieces = pieces.select("row", "id", "crc", "start", F.least(F.lit(window), F.col("n") - F.col("start")).alias("length"))
    histogram = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():      # at most ``window`` rows
        histogram[r["length"]] = r["n"]
    entries = plan_windows(histogram, window).table()
    order = [F.col("id").asc_nulls_first(), F.col("start").asc(), F.col("crc").asc(), F.col("row").asc()]
    numbered = number_rows(pieces, order, ["length"], "number").select("row", "start", "length", "number")
    placed = numbered.mapInArrow(_place(entries, window), "row long, start long, length long, sequence_id long, offset long")
    by_row = placed.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))     # a row's own pieces
    cut = tokens.join(by_row, "row").select("id", "n", "ids", "pieces").mapInArrow(
        _cut(with_ids), "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
    return cut.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []))
