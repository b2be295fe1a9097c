"""Filter audit, window packing and importance resampling against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casaflow.llm import filter_audit as A
from casaflow.llm import ranks
from casaflow.llm import window_packing as W
from casaflow.llm.filter_audit import audit_filters
from casaflow.llm.importance import bucket_counts, importance_resample
from casaflow.llm.window_packing import Plan, Places, pack_windows, plan_windows
from casaflow.llm.words import gram_hashes, word_blocks
from tests.llm import brute
from tests.llm.conftest import SF


def tokenizer_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# --- words, ranks -----------------------------------------------------------------

@pytest.mark.parametrize("block", [1, 7, 1 << 20])
def test_blocks_do_not_change_words_or_grams(block):
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(" \t\nAbé9-_|x\x1c ") for _ in range(rng.randrange(60)))
        words = [w for part in word_blocks(text.encode(), block) for w in part]
        assert words == [w.encode() for w in brute.WORD.findall(text)]
        terms = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(brute.LOW))
        expected = Counter(zlib.crc32(" ".join(terms[i:i + k]).encode()) for k in (1, 2, 3) for i in range(len(terms) - k + 1))
        got, n = Counter(), 0
        for m, hashes in gram_hashes(text.encode(), 3, block):
            got.update(hashes)
            n += m
        assert got == expected and n == len(terms)


@pytest.mark.parametrize("per_task", [3, 1 << 20])
def test_rows_are_numbered_in_order_within_groups(spark, monkeypatch, per_task):
    monkeypatch.setattr(ranks, "ROWS_PER_TASK", per_task)
    rng = random.Random(2)
    data = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(5), i) for i in range(60)]
    df = spark.createDataFrame(data, "g int, v int, i int").repartition(5)
    got = ranks.number_rows(df, [F.col("v").desc(), F.col("i")], ["g"])
    assert got.columns == ["g", "v", "i", "rank"]
    expected = {}
    for g in (1, 2, 3):
        for n, r in enumerate(sorted((r for r in data if r[0] == g), key=lambda r: (-r[1], r[2]))):
            expected[r] = n
    assert {tuple(r[:3]): r[3] for r in got.collect()} == expected
    whole = ranks.number_rows(df, [F.col("i").desc()]).collect()
    assert all(r["rank"] == 59 - r["i"] for r in whole)
    assert ranks.number_rows(df.where("g > 9"), [F.col("i")], ["g"]).count() == 0


# --- filter audit -----------------------------------------------------------------

def test_gallop_and_merges():
    rng = random.Random(3)
    for _ in range(400):
        lists = [sorted(rng.sample(range(60), rng.randrange(30))) for _ in range(rng.randrange(1, 5))]
        a, b = lists[0], lists[-1]
        x, at = rng.randrange(62), rng.randrange(len(a) + 1)
        assert A.gallop(a, x, at) == next((i for i in range(at, len(a)) if a[i] >= x), len(a))
        assert A.union(lists) == sorted(set().union(*lists))
        assert A.difference(a, b) == sorted(set(a) - set(b))
        assert A.common(a, b) == sorted(set(a) & set(b))


def expected_audit(rows, labels):
    """{(part, order, step): counts} by applying every order document by document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in rows:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    docs = []
    for d, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": re.search("[#$%&*|]", text) is not None,
                 "E": d is not None and d > least[text]}
        docs.append((part or "", d, {f for f, bad in fails.items() if bad}))
    out, shapley = {}, Counter()
    for part in {p for p, _, _ in docs}:
        own = [x for x in docs if x[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [x for x in own if f in x[2] and not x[2] & before]
                shapley[part, f] += len(gone)
                out[part, order, step] = [sum(not x[2] & (before | {f}) for x in own), len(gone), sum(f in x[2] and bool(x[2] & before) for x in own),
                                          sum(x[2] == {f} for x in own), sum(x[1] in good for x in gone), sum(x[1] in toxic for x in gone)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


@pytest.mark.parametrize("per_range", [40, 1 << 16])
def test_audit_matches_every_order_applied(spark, monkeypatch, per_range):
    monkeypatch.setattr(A, "RANGE_ROWS", per_range)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["Aa", "b", "CC", "d#", "e", f"w{i}", f"v{rng.randrange(90)}"]) for _ in range(rng.choice([0, 3, 60, 140])))
             for i in range(60)]
    rows = [(rng.choice([i, i, i, None, 7]), rng.choice(texts + [None, ""]), rng.choice(["en", "de", "", None])) for i in range(240)]
    rows += [(500, texts[0], "en")] * 3 + [(501 + i, texts[1], "xx\x00") for i in range(4)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 240, 2)] + [(2, 1, 1), (None, 1, 1), (500, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("x") for c in ("id", "part", "bits", "n", "good", "hash")})
    got = audit_filters(docs.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    expected = expected_audit(rows, labels)
    assert audit_rows(got) == expected and len(expected) == 4 * 600


def test_audit_odd_rows_and_empty_tables(spark, odd, no_docs):
    from tests.llm.conftest import ODD
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_rows(audit_filters(odd, none)) == expected_audit([r[:3] for r in ODD], [])
    out = audit_filters(no_docs, none)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert out.count() == 0


# --- window packing ---------------------------------------------------------------

def check_plan(histogram, window, entries):
    """Every token of every piece once; sequences without gaps; full but for
    powers of two. Returns the number of cuts."""
    seen = Counter()
    sequences = {}
    for source, start, first, count, length, sequence, offset in entries.tolist():
        assert length > 0
        for i in range(count):
            seen[source, first + i] += length
            sequences.setdefault(sequence + i, []).append((offset, length))
    assert seen == {(n, i): n for n, c in enumerate(histogram.tolist()) if n for i in range(c)}
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes.append(at)
    assert sorted(sequences) == list(range(len(sequences)))
    short = sorted(s for s in sizes if s < window)
    assert max(sizes, default=0) <= window and all(s & (s - 1) == 0 for s in short) and len(short) == len(set(short))
    return sum(e[3] for e in entries.tolist() if e[1])


@pytest.mark.parametrize("window", [1, 8, 64, 256])
def test_plans_place_every_piece(window):
    rng = np.random.default_rng(window)
    for n in (0, 1, 5, 60, 900):
        for shape in ("even", "short", "one length"):
            lengths = {"even": rng.integers(1, window + 1, n), "short": np.minimum(window, 1 + rng.geometric(0.2, n)),
                       "one length": np.full(n, max(1, window * 3 // 5))}[shape]
            histogram = np.bincount(lengths, minlength=window + 1)
            entries = plan_windows(histogram, window).table()
            check_plan(histogram, window, entries)
            length, number = (np.array(x, np.int64) for x in (list(zip(*((m, i) for m, c in enumerate(histogram.tolist()) for i in range(c)))) or ([], [])))
            found = Counter()
            for index, at, size, _, _ in Places(entries, window).find(length, number) if n else ():
                found.update(dict(zip(index.tolist(), size.tolist())))
            assert dict(found) == dict(enumerate(length.tolist()))


def test_combinations_fill_the_window():
    lengths = np.array([1, 2, 3, 5, 8, 9, 16])
    got = {tuple(x for x in c if x) for c in W.combinations(lengths, 16).tolist()}
    assert got == {c for k in (1, 2, 3) for c in itertools.combinations_with_replacement(lengths[::-1].tolist(), k) if sum(c) == 16}


def test_fit_reaches_the_least_squares_conditions():
    """Non-negative; where a combination is used the residual is orthogonal to
    it, and no unused one would help."""
    rng = np.random.default_rng(5)
    histogram = np.bincount(rng.integers(1, 33, 4000), minlength=33)
    combos = W.combinations(np.flatnonzero(histogram), 32)
    x = W.fit_counts(combos, histogram, rounds=3000)
    left = histogram - sum(np.bincount(combos[:, k], x, minlength=33) for k in range(3))
    left[0] = 0
    slope = left[combos].sum(axis=1)
    assert (x >= 0).all() and slope.max() < 3 and np.abs(slope[x > 0.5]).max() < 3
    assert np.square(left).sum() < np.square(histogram).sum() / 20


def test_exact_combinations_are_used_before_cuts():
    histogram = np.zeros(2049, np.int64)
    histogram[[1500, 548, 1024, 700, 648]] = [40, 40, 20, 60, 30]       # 1500+548, 2 x 1024, 2 x 700 + 648
    plan = plan_windows(histogram, 2048)
    assert check_plan(histogram, 2048, plan.table()) == 0 and plan.sequences == 80


def check_windows(rows, texts, tokenizer, window=2048, end=1):
    """Pieces hold the library's ids; sequences are gapless and need no padding."""
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        wide = np.frombuffer(r["ids"], "<u4")
        assert len(wide) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
    sizes = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        sizes.append(at)
    assert max(sizes) <= window and all(s == window or s & (s - 1) == 0 for s in sizes)
    assert sum(sizes) == sum(map(len, ids))
    return ids, pieces


def test_windows_hold_the_documents_ids(spark, docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = dict(docs.select("doc_id", "text").collect())
    rows = pack_windows(docs, tokenizer_path()).collect()
    ids, pieces = check_windows(rows, list(texts.values()), tokenizer)
    by_doc = dict(zip(texts, ids))
    assert {d for d, _ in pieces} == set(texts)
    for (d, n), parts in pieces.items():
        parts.sort(key=lambda r: r["start"])
        assert n == len(by_doc[d]) and [r["start"] for r in parts] == list(itertools.accumulate([0] + [r["length"] for r in parts[:-1]]))
        assert b"".join(r["ids"] for r in parts) == np.array(by_doc[d], "<u4").tobytes()
    again = pack_windows(docs.repartition(7, "n_chars"), tokenizer_path(), with_ids=False).collect()
    assert sorted(tuple(r) for r in again) == sorted(tuple(r)[:-1] for r in rows)


def test_windows_of_odd_rows(spark, odd, no_docs):
    from tests.llm.conftest import ODD
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = pack_windows(odd, tokenizer_path()).collect()
    ids, pieces = check_windows(rows, [r[1] for r in ODD], tokenizer)
    assert Counter({k: sum(r["length"] for r in v) for k, v in pieces.items()}) == sum((Counter({(r[0], len(i)): len(i)}) for r, i in zip(ODD, ids)), Counter())
    assert pack_windows(no_docs, tokenizer_path()).count() == 0
    assert pack_windows(odd.where("text is null"), tokenizer_path(), end_id=None).count() == 0
    with pytest.raises(ValueError):
        pack_windows(odd, tokenizer_path(), window=1000)


# --- importance resampling --------------------------------------------------------

def plain_sample(rows, target, buckets=10_000, least=20, num=5, den=100, seed=42):
    """[(id, n_words, n_features, weight, score, rank)] of (id, text) rows."""
    def bag(text):
        terms = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(brute.LOW))
        return len(terms), Counter(zlib.crc32(" ".join(terms[i:i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(terms) - k + 1))
    bags = [bag(t) for _, t in rows]
    s, t = sum((b for _, b in bags), Counter()), sum((bag(x)[1] for x in target), Counter())
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in s}
    out = []
    for (d, _), (n, b) in zip(rows, bags):
        weight = sum(gain[k] * c for k, c in b.items())
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, sum(b.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = {id(r): i for i, r in enumerate(order[:num * len(order) // den], 1)}
    return [tuple(r) + (drawn.get(id(r)),) for r in out]


@pytest.mark.parametrize("num,per_task", [(5, 1 << 20), (40, 16)])
def test_sample_matches_a_plain_one(spark, docs, monkeypatch, num, per_task):
    monkeypatch.setattr(ranks, "ROWS_PER_TASK", per_task)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = importance_resample(docs, bench, keep=["doc_id"], share=(num, 100))
    expected = plain_sample(docs.select("doc_id", "text").collect(), [r[0] for r in bench.select("text").collect()], num=num)
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    assert max(r[5] or 0 for r in expected) == num * sum(r[1] >= 20 for r in expected) // 100 > 0


def test_sample_odd_rows(spark, odd, no_docs):
    from tests.llm.conftest import CLASHING, ODD, SCHEMA
    rows = ODD + [(20 + i, " ".join(f"w{j}" for j in range(i, i + 25)), "en", "s") for i in range(4)] + [(30, "same text " * 12, "en", "s")] * 3
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING + ("rank", "weight", "at")})
    target = [" ".join(f"w{j}" for j in range(30)), None, ""]
    got = importance_resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), share=(1, 2))
    assert got.columns == [*frame.columns, "n_words", "n_features", "_weight", "_score", "_rank"]
    key = lambda r: tuple((x is None, str(x)) for x in r)       # noqa: E731
    assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_features", "_weight", "_score", "_rank").collect()), key=key) == \
        sorted(plain_sample([r[:2] for r in rows], target, num=1, den=2), key=key)
    texts = sorted(r[0] or "" for r in got.select("text").collect())
    assert texts == sorted(r[1] or "" for r in rows)
    nothing = spark.createDataFrame([], "text string")
    assert importance_resample(no_docs, nothing).count() == 0 and bucket_counts(nothing, "text", 10, 3).count() == 0
    assert importance_resample(odd, nothing, keep=["doc_id"], share=(0, 1)).where("rank is not null").count() == 0


def test_copies_and_repeats_share_the_noise_of_their_id(spark):
    rows = [(1, "a b c " * 10), (1, "a b c " * 10), (None, "d " * 30), (None, "d " * 30)]
    got = importance_resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("a b",)], "text string"), share=(1, 1))
    found = sorted((r["doc_id"] or 0, r["score"], r["rank"]) for r in got.collect())
    assert found[0][1] == found[1][1] and found[2][1] == found[3][1] and sorted(r[2] for r in found) == [1, 2, 3, 4]
