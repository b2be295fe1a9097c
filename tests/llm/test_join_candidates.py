"""N-gram join: which pairs of a node are candidates."""

import numpy as np
import pyarrow as pa
import pytest

from casaflow.llm import ngram_join as J
from casaflow.llm.arrays import U64


@pytest.mark.parametrize("sides", [False, True])
def test_a_small_set_in_a_node_does_not_tie_large_ones(sides):
    """Sets of 150 to 6000 shingles in one node: counted in the smallest set's
    64 groups all large ones look alike. Each set has one near copy."""
    rng = np.random.default_rng(5)
    sets = []
    for n in (150, 3000, 3100, 3300, 4000, 4100, 6000):
        own = np.unique(rng.integers(0, 1 << 63, n).astype(U64))
        sets += [own, np.unique(np.append(own[n // 20:], rng.integers(0, 1 << 63, n // 20).astype(U64)))]
    node = pa.RecordBatch.from_pydict({
        "cell": np.full(len(sets), 7), "rep": np.arange(len(sets)), "n": np.array([len(s) for s in sets]),
        "side": np.arange(len(sets)) % 2 if sides else np.zeros(len(sets), np.int64),
        "counts": pa.array([J.group_counts(s).tobytes() for s in sets], pa.binary())})
    pairs = {tuple(sorted(p)) for b in J._candidates(80, 100)(iter([node])) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert pairs == {(i, i + 1) for i in range(0, len(sets), 2)}


def test_bounds_at_the_pairs_width_are_never_below_the_overlap():
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 1 << 63, 9000).astype(U64)
    sets = [np.unique(rng.choice(pool, n)) for n in (40, 900, 1100, 2500, 5000, 70000)]
    counts = [J.group_counts(s) for s in sets]
    flat = np.concatenate(counts).view(np.uint8)
    offsets = np.concatenate([[0], np.cumsum([2 * len(c) for c in counts])])
    sizes = np.array([len(s) for s in sets])
    points = J.Folded(flat, offsets, sizes)
    for i in range(len(sets)):
        for j in range(len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            for num in (10, 50, 80):
                if 100 * both >= num * (sizes[i] + sizes[j] - both):
                    assert points.allow(i, np.array([j]), num, 100).tolist() == [j]
