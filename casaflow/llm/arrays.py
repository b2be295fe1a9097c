"""Array helpers that run inside tasks: word spans, 64-bit hashes, runs of
sorted rows. Everything here works on whole Arrow columns with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the 64-bit finaliser.
MIX_A, MIX_B = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = x ^ (x >> U64(33))
    x = x * MIX_A
    x = x ^ (x >> U64(33))
    x = x * MIX_B
    return x ^ (x >> U64(33))


def _powers(n: int) -> np.ndarray:
    base = np.full(n, 0x9E3779B97F4A7C15, dtype=U64)
    if n:
        base[0] = 1
    return np.multiply.accumulate(base)


_POWERS = _powers(1 << 12)


def powers(n: int) -> np.ndarray:
    """The first n powers of the polynomial base, modulo 2^64."""
    global _POWERS
    if n > len(_POWERS):
        _POWERS = _powers(1 << int(n - 1).bit_length())
    return _POWERS[:n]


def segment_hashes(values: np.ndarray, starts: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    """Hash of each segment ``values[starts[i]:starts[i+1]]`` (the last one ends
    with the array); positions where ``keep`` is false count as absent, so they
    must trail their segment."""
    if not len(starts):
        return np.empty(0, U64)
    lens = np.diff(np.append(starts, len(values)))
    pos = np.arange(starts[0], len(values)) - np.repeat(starts, lens)
    part = (values[starts[0]:].astype(U64) + U64(1)) * powers(int(lens.max()))[pos]
    if keep is not None:
        part *= keep[starts[0]:]
    return mix(np.add.reduceat(part, starts - starts[0]))


#: Byte tables of the word rule ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes between terms: all ASCII but letters and digits.
NO_TERM = np.zeros(256, dtype=bool)
NO_TERM[[c for c in range(128) if not chr(c).isalnum()]] = True


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(col) else np.empty(0, np.uint8)
    return flat, offsets - offsets[0]


def word_starts(flat: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Where the runs of ``inside`` bytes begin; runs never cross texts."""
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(flat)]
    begin[edge] = inside[edge]
    return np.flatnonzero(begin)


def word_hashes(flat: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (runs of bytes not in the table
    ``apart``) of consecutive texts, and each text's offsets into them."""
    if not len(flat):
        return np.empty(0, U64), np.zeros(len(offsets), np.int64)
    inside = ~apart[flat]
    starts = word_starts(flat, offsets, inside)
    return segment_hashes(LOWER[flat], starts, inside), np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of one text's k-word shingles; with fewer words,
    the whole sequence as one; empty without words."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    h = np.full(n - width + 1, width, dtype=U64)
    for j in range(width):
        h = mix(h + words[j:n - width + 1 + j])
    return np.unique(h)


def byte_chunks(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end
        row = end


def key_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup batches sorted by ``key`` into tables that never cut a key in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        first = int(np.searchsorted(col, col[-1], side="left"))
        if held and first == 0 and held[-1].column(batch.schema.get_field_index(key))[-1].as_py() == col[0]:
            held.append(batch)
            continue
        held.append(batch.slice(0, first))
        out = pa.Table.from_batches([b for b in held if b.num_rows] or [batch.slice(0, 0)])
        if out.num_rows:
            yield out
        held = [batch.slice(first)]
    if held:
        yield pa.Table.from_batches(held)


def run_bounds(sorted_keys: np.ndarray) -> np.ndarray:
    """Offsets of the runs of equal keys, with the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]])


class Forest:
    """Union-find over 0..n-1; the root is the smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True
