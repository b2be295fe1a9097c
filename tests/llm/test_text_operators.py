"""Line dedup, n-gram join, repeated strings: against brute force."""

import hashlib
import random

import numpy as np
import pytest

from casaflow.llm import line_dedup as L
from casaflow.llm.arrays import column_bytes, shingles, word_hashes
from casaflow.llm.grouping import common_prefixes, suffix_array
from casaflow.llm.line_dedup import line_dedup
from casaflow.llm.ngram_join import CountTree, _need, ngram_join
from casaflow.llm.suffix_dedup import dedup_strings
from tests.llm import brute


def pairs(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# --- suffix grouping ---------------------------------------------------------

def test_suffix_array_sorts_suffixes():
    rng = random.Random(3)
    for trial in range(400):
        s = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(0, 24))] * rng.choice([1, 1, 2])
        expected = sorted(range(len(s)), key=lambda i: s[i:])
        got = suffix_array(np.array(s, dtype=np.int64))
        assert got.tolist() == expected
        shared = common_prefixes(np.array(s, dtype=np.int64), got).tolist()
        for k in range(1, len(s)):
            a, b = s[expected[k - 1]:], s[expected[k]:]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == n


# --- repeated strings --------------------------------------------------------

def passage_texts(seed, n=24, length=100):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))
    shared = [" ".join(word() for _ in range(60)) for _ in range(4)]
    texts = []
    for i in range(n):
        own = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(3)]
        cut = rng.choice(shared)
        lo = rng.randint(0, 80)
        texts.append(own[0] + cut[lo:lo + rng.randint(length - 10, 2 * length)] + own[1] + rng.choice(["", own[0] * 2, "é" * 150]) + own[2])
    return texts + [texts[0], "", None, "x" * 350, "short"]


@pytest.mark.parametrize("run_limit", [4000, 1])
def test_repeated_strings_match_brute_force(spark, monkeypatch, run_limit):
    from casaflow.llm import suffix_dedup
    monkeypatch.setattr(suffix_dedup, "RUN_LIMIT", run_limit)       # 1: names counted window by window
    texts = passage_texts(5)
    df = dedup_strings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 100)
    got = {r["doc_id"]: (r["n_bytes"], [(s["start"], s["end"]) for s in r["spans"] or ()], bytes(r["kept"])) for r in df.collect()}
    expected = brute.repeated_strings(texts, 100)
    assert [got[i] for i in range(len(texts))] == expected
    assert any(s for _, s, _ in expected)


def test_repeated_strings_odd_rows(odd, no_docs):
    rows = pairs(dedup_strings(odd, 400), "doc_id", "n_bytes", "spans")
    assert len(rows) == odd.count() and dict((r[0], r[1]) for r in rows)[1] == 0
    assert all(not r[2] for r in rows)
    assert dedup_strings(no_docs).count() == 0


# --- n-gram join ----------------------------------------------------------------

def near_texts(seed, n=60):
    rng = random.Random(seed)
    bases = [[f"w{rng.randint(0, 400)}" for _ in range(rng.choice([2, 12, 40, 200]))] for _ in range(8)]
    out = []
    for _ in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
            words[rng.randrange(len(words))] = f"W{rng.randint(0, 9999)}"
        out.append(" ".join(words) + rng.choice(["", " ", "\n"]))
    return out + ["", None, "  ", "one", "ONE", "one two"]


@pytest.mark.parametrize("k,num,limit", [(3, 90, 2000), (5, 80, 2000), (3, 70, 3)])
def test_ngram_join_matches_brute_force(spark, monkeypatch, k, num, limit):
    from casaflow.llm import links
    from casaflow.llm import ngram_join as ngram
    monkeypatch.setattr(links.split_groups, "__defaults__", (limit, None))      # 3: groups are cut into chunks
    monkeypatch.setattr(ngram, "GROUP_LIMIT", limit)
    monkeypatch.setattr(ngram, "FAMILY_SHINGLES", 100 * limit)
    rows = list(enumerate(near_texts(k)))
    df = ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), k=k, num=num)
    expected = brute.jaccard_groups(rows, k, num, 100)
    assert sorted(pairs(df, "doc_id", "n_shingles", "component_id")) == sorted(expected)
    assert any(a != c for a, _, c in expected)


@pytest.mark.parametrize("limit", [2, 5, 1000])
@pytest.mark.parametrize("batch", [1, 3, 64, 10_000])
def test_nodes_end_where_sizes_or_shingles_do(limit, batch):
    import pyarrow as pa

    from casaflow.llm.ngram_join import SIZE_BITS, _nodes, size_code
    rng = random.Random(limit)
    rows = sorted((rng.randrange(-6, 6) << SIZE_BITS | size_code(rng.choice([3, 40, 44, 48, 900, 905, 70_000])), i) for i in range(300))
    parts = [rows[i:i + batch] for i in range(0, len(rows), batch)]
    batches = (pa.RecordBatch.from_pydict({"key": [k for k, _ in p], "rep": pa.array([r for _, r in p], pa.int64())}) for p in parts)
    cells = {}
    for out in _nodes(80, 100, limit)(batches):
        for cell, rep, large in zip(*(out.column(c).to_pylist() for c in ("cell", "rep", "large"))):
            cells.setdefault((cell, large), set()).add(rep)
    gap, runs = size_code(125) - size_code(100) + 2, [[rows[0]]]
    for row in rows[1:]:
        last = runs[-1][-1][0]
        new = row[0] >> SIZE_BITS != last >> SIZE_BITS or row[0] - last > gap
        runs.append([row]) if new else runs[-1].append(row)
    assert sorted((len(r) > limit, sorted(i for _, i in r)) for r in runs if len(r) > 1) == sorted(
        (large, sorted(reps)) for (_, large), reps in cells.items())


def test_ngram_join_odd_rows(odd, no_docs):
    got = pairs(ngram_join(odd, k=3), "doc_id", "n_shingles", "component_id")
    assert len(got) == odd.count()
    by_id = {r[0]: r[1:] for r in got}
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[6][1] == 5 and by_id[9] == (1, 9) and by_id[None][1] is None
    assert ngram_join(no_docs).count() == 0


def test_count_tree_finds_every_pair_within_the_bound():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 5, (300, 64)).astype(np.uint16)
    counts[100:200] = counts[:100]
    counts[150:200, 3] += 1
    sizes = counts.sum(axis=1).astype(np.int64)
    tree = CountTree(sizes, counts)
    for i in range(0, 300, 7):
        bound = np.minimum(counts, counts[i]).sum(axis=1)
        fits = (sizes * 100 >= sizes[i] * 90) & (sizes[i] * 100 >= sizes * 90) & (bound >= _need(sizes[i], sizes, 90, 100))
        assert sorted(tree.order[tree.search(int(sizes[i]), counts[i], 90, 100)].tolist()) == np.flatnonzero(fits).tolist()


def test_words_and_shingles():
    import pyarrow as pa
    flat, offsets = column_bytes(pa.array(["A b\tc", None, "  ", "a B c d a b c"]))
    words, at = word_hashes(flat, offsets)
    assert np.diff(at).tolist() == [3, 0, 0, 7]
    assert words[:3].tolist() == words[3:6].tolist()
    assert len(shingles(words[3:], 3)) == 4 and len(shingles(words[:2], 3)) == 1 and not len(shingles(words[:0], 3))


# --- fuzzy lines ---------------------------------------------------------------

def test_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abç") for _ in range(rng.randint(0, 14))) for _ in range(2))
        assert L.edit_distance(a, b) == brute.levenshtein(a, b)


def line_docs(seed):
    rng = random.Random(seed)
    bases = [" ".join(f"term{rng.randint(0, 300)}" for _ in range(n)) for n in (3, 8, 30, 60, 120) for _ in range(4)]
    docs = []
    for i in range(30):
        lines = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(bases).split()
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] += rng.choice(["s", "!", "", "x"])
            lines.append(rng.choice(["", " "]) + " ".join(words).upper() if rng.random() < 0.3 else " ".join(words))
        docs.append("\n".join(lines + rng.choice([[], [""], ["--- !"]])))
    return docs + [docs[0], "", None]


def expected_lines(rows, distance, similarity):
    classes, places = {}, []
    for doc, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            norm = L.normalise(line.encode())
            if norm:
                data = np.frombuffer(line.encode(), np.uint8)
                classes.setdefault(norm, int(L.line_hashes(data, np.array([0, len(data)]))[3][0]))
                places.append((doc, number, norm))
    names = list(classes)
    union = brute.Union(len(names))
    for i, a in enumerate(names):
        for j in range(i):
            b = names[j]
            if (classes[a] ^ classes[b]).bit_count() <= distance:
                x, y = a.decode(), b.decode()
                if brute.levenshtein(x, y) <= (1 - similarity) * max(len(x), len(y)) + 1e-9:
                    union.join(i, j)
    seen, gone = set(), set()
    for doc, number, norm in sorted(places):
        group = union.root(names.index(norm))
        if group in seen:
            gone.add((doc, number))
        seen.add(group)
    return {doc: None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, i) not in gone) for doc, text in rows}, gone


@pytest.mark.parametrize("distance,agree", [(3, 1), (6, 2)])
def test_line_dedup_matches_brute_force(spark, distance, agree):
    rows = list(enumerate(line_docs(2)))
    df = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), distance=distance, agree=agree)
    expected, gone = expected_lines(rows, distance, 0.9)
    assert dict(pairs(df, "doc_id", "text")) == expected
    assert gone


def test_line_dedup_odd_rows(odd, no_docs):
    out = line_dedup(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    by_id = {r["doc_id"]: r for r in out.collect()}
    assert by_id[1]["text"] is None and by_id[2]["text"] == "" and by_id[3]["text"] == " \n\t "
    assert by_id[5]["text"] and by_id[6]["text"] == "" and by_id[9]["text"] == "repeated row"
    assert by_id[5]["name"] == "x-name"
    assert line_dedup(no_docs).count() == 0


def test_block_keys_are_a_pigeonhole():
    rng = random.Random(2)
    masks = L.block_keys(3, 2)
    assert len(masks) == 10
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


def test_queries_on_the_small_tables(spark, docs):
    from casaflow.llm.queries import op7_suffix_dedup, op9_ngram_join
    from tests.llm.conftest import SF
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(pairs(op9_ngram_join(spark, SF), "doc_id", "n_shingles", "component_id")) == sorted(brute.jaccard_groups(rows, 3, 90, 100))
    expected = {d: (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
                for (d, _), (n, spans, kept) in zip(rows, brute.repeated_strings([t for _, t in rows], 400))}
    assert {r[0]: r[1:] for r in pairs(op7_suffix_dedup(spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")} == expected
