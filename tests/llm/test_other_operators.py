"""Vectors, search, URLs, toxicity, mixing, packing, token files."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from casaflow.llm import records
from casaflow.llm.embed_dedup import embed_dedup
from casaflow.llm.links import components
from casaflow.llm.mixing import mix_sources, word_count
from casaflow.llm.packing import CAPACITIES, best_fit, pack, sequence_cost
from casaflow.llm.tokens import PieceEncoder
from casaflow.llm.topk import MultiIndex, sign_code, sign_words, topk_codes
from casaflow.llm.toxicity import FactorizationMachine, fit_toxicity, score_toxicity
from casaflow.llm.url_filter import BloomCascade, url_filter
from tests.llm import brute

CLASH = {"row": "x", "key": "x", "rep": "x"}


def clashing(df):
    return df.withColumns({c: F.lit(v) for c, v in CLASH.items()})


# --- links ----------------------------------------------------------------------

@pytest.mark.parametrize("per_task", [1 << 18, 20])
def test_components_of_long_paths_stars_and_loops(spark, monkeypatch, per_task):
    from casaflow.llm import links
    monkeypatch.setattr(links, "EDGES_PER_TASK", per_task)
    edges = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(8, 60)] + [(90, 90), (95, 96), (96, 95)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect())
    assert got == {**{i: 100 for i in range(100, 181)}, **{i: 7 for i in range(7, 60)}, 95: 95, 96: 95}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- embeddings ------------------------------------------------------------------

def vectors(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(12):
        base = rng.standard_normal(16)
        for _ in range(rng.integers(1, 8)):
            rows.append((base + rng.standard_normal(16) * rng.choice([0, 0.05, 0.12])).tolist())
    rows = [(i, v, int(rng.integers(0, 2))) for i, v in enumerate(rows)]
    n = len(rows)
    return rows + [(n, rows[0][1], rows[0][2]), (n + 1, None, 0), (n + 2, [0.0] * 16, 0), (n + 3, [float("nan")] * 16, 0),
                   (n + 4, [None, *[1.0] * 15], 0), (n + 5, rows[0][1], None), (n + 6, [], 0), (n + 7, rows[0][1][:8], rows[0][2]),
                   (n + 8, [1e200 * x for x in rows[0][1]], rows[0][2]), (n + 9, [math.inf] * 16, 0)]


def expected_links(rows, threshold):
    ok = [i for i, (_, v, lab) in enumerate(rows) if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1]) / max(map(abs, rows[i][1])) for i in ok}
    union, links = brute.Union(len(rows)), [0] * len(rows)
    for i in ok:
        for j in ok:
            if j < i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] / math.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j])) >= threshold:
                    union.join(i, j)
                    links[i] += 1
                    links[j] += 1
    return {rows[i][0]: (links[i], rows[union.root(i)][0], union.root(i) == i) for i in range(len(rows))}


@pytest.mark.parametrize("limit", [2000, 2])
def test_embed_dedup_matches_brute_force(spark, monkeypatch, limit):
    from casaflow.llm import links
    monkeypatch.setattr(links.split_groups, "__defaults__", (limit, None))      # 2: buckets are cut into chunks
    rows = vectors()
    df = embed_dedup(clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")), 0.98)
    got = {r[0]: tuple(r[1:]) for r in df.collect()}
    expected = expected_links(rows, 0.98)
    assert got == expected and sum(e[0] for e in expected.values()) > 20


def test_embed_dedup_repeated_and_null_ids_and_empty(spark):
    schema = "vec_id long, embedding array<float>, label int"
    got = embed_dedup(spark.createDataFrame([(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (3, [2.0, -1.0], 1)], schema)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, 2, 5, True), (5, 2, 5, True), (None, 2, 5, False), (3, 0, 3, True)], key=str)
    assert embed_dedup(spark.createDataFrame([], schema)).count() == 0


# --- top-k -------------------------------------------------------------------------

def test_topk_matches_brute_force_over_blocks(spark):
    rng = random.Random(8)
    centres = [rng.getrandbits(64) for _ in range(6)]
    codes = []
    for i in range(400):
        code = rng.choice(centres)
        for b in rng.sample(range(64), rng.choice([0, 1, 3, 9, 30])):
            code ^= 1 << b
        codes.append((i, code - (1 << 64) if code >> 63 else code))
    rows = clashing(spark.createDataFrame(codes + [(None, 5), (999, None)], "id long, code long"))
    got = topk_codes(rows, rows.where("id % 50 = 0"), 7, block_rows=90, block_queries=3)
    expected = set()
    for q, a in codes[::50]:
        best = sorted((((a ^ b) & (1 << 64) - 1).bit_count(), i) for i, b in codes)[:7]
        expected |= {(q, rank + 1, i, d) for rank, (d, i) in enumerate(best)}
    assert {tuple(r)[:4] for r in got.collect()} == expected


def test_topk_of_long_codes_and_repeated_query_ids(spark):
    rng = random.Random(9)
    base = [rng.gauss(0, 1) for _ in range(100)]
    vectors = [(i, [-x if j >= 64 * (i % 2) and rng.random() < 0.1 else x for j, x in enumerate(base[:rng.choice([100, 100, 70])])]) for i in range(200)]
    frame = spark.createDataFrame(vectors, "id long, v array<double>")
    rows = frame.select("id", sign_words(F.col("v"), 100).alias("code"))
    queries = rows.where("id in (0, 50)").withColumn("id", F.lit(7).cast("long"))
    got = topk_codes(rows, queries.unionByName(queries), 5, block_rows=60, block_queries=1)
    signs = {i: [x > 0 for x in v] + [False] * (100 - len(v)) for i, v in vectors}
    expected = []
    for q in (0, 50):
        best = sorted((sum(a != b for a, b in zip(signs[q], signs[i])), i) for i in signs)[:5]
        expected += [(7, rank + 1, i, d) for rank, (d, i) in enumerate(best)]
    assert sorted(tuple(r)[:4] for r in got.collect()) == sorted(expected)
    assert any(signs[1][:64] == signs[i][:64] and signs[1] != signs[i] for i in signs)
    with pytest.raises(Exception, match="more than 64 components"):
        frame.select(sign_code(F.col("v"))).collect()


def test_topk_ties_repeats_few_rows_and_empty(spark):
    rows = spark.createDataFrame([(1, 0), (2, 0), (2, 0), (3, -1)], "id long, code long")
    assert [tuple(r)[1:4] for r in topk_codes(rows, rows.where("id = 3"), 10).orderBy("rank").collect()] == [(1, 3, 0), (2, 1, 64), (3, 2, 64), (4, 2, 64)]
    assert topk_codes(rows.where("false"), rows, 3).count() == 0 and topk_codes(rows, rows.where("false"), 3).count() == 0


def test_multi_index_stops_early():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 63, 5000, dtype=np.int64).view(np.uint64)
    codes[:20] = codes[0]
    rows, dist = MultiIndex(codes, 64, 4).search(codes[:1], 10, np.arange(5000))
    assert rows.tolist() == list(range(10)) and not dist.any()


def test_sign_code(spark):
    df = spark.createDataFrame([([1.0, -1.0, 2.0, None, float("nan")] + [0.0] * 58 + [3.0],), (None,), ([],)], "v array<double>")
    assert [r[0] for r in df.select(sign_code(F.col("v"))).collect()] == [5 - (1 << 63), None, 0]


# --- URLs --------------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
URLS = ["http://A.Example.NET/en/x?q", "http://example.net/de/", "https://x.example.com/de/1#f", "https://x.example.com/d/de/", "http://a.org/fr/", "http://a.org/fr",
        "http://net", "http://net/", "HTTP://x.notnet/", "no scheme", None, "", "http://", "x://y://z.net/a", "http://bad.example.com?u=/de/", "http://www.bad.example.com/x",
        "http://notbad.example.com/", "http://bad.example.net/", "http://bad.example.net/en/", "http://u..net/x", "http://a.net/" + "p" * 50_000]


def expected_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = rest[:cut].translate(str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)}))
        path = rest[cut:]
        path = path[:min((path.index(c) for c in "?#" if c in path), default=len(path))]
    fits = [(h + p, a) for h, p, a in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda f: len(f[0]))
        return host, path, rule, verdict
    listed = any(host == k or host.endswith("." + k) for k in ("bad.example.com", "bad.example.net"))
    return host, path, None, "block" if listed else "allow"


@pytest.mark.parametrize("shard_bytes", [32 << 20, 1])
def test_url_filter_matches_plain_rules(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(BloomCascade.__init__, "__defaults__", (0.3, shard_bytes))     # 1: many shards
    pages = clashing(spark.createDataFrame(list(enumerate(URLS + URLS[:3])), "page_id long, url string"))
    listed = spark.createDataFrame([("bad.example.com",), ("bad.example.net",), (None,)], "key string")
    got = {r[0]: tuple(r)[1:5] for r in url_filter(pages, RULES, listed).collect()}
    assert got == {i: expected_url(u) for i, u in enumerate(URLS + URLS[:3])}
    assert url_filter(pages.where("false"), RULES).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key like '%7'")
    cascade = BloomCascade(listed, universe, rate=0.2)
    assert len(cascade.filters[0].value.levels) > 2
    out = cascade.add(universe.withColumn("keys", F.array("key")), "keys", "hit")
    assert out.where((F.size("hit") == 1) != F.col("key").like("%7")).count() == 0


# --- toxicity ------------------------------------------------------------------------

def test_machine_learns_pairs_that_weights_miss():
    rng = np.random.default_rng(2)
    n, insult, group = 3000, 0, 1
    rows, labels = [], []
    for _ in range(n):
        present = set(rng.integers(2, 40, 6).tolist())
        a, b = rng.random() < 0.5, rng.random() < 0.5
        present |= ({insult} if a else set()) | ({group} if b else set())
        rows.append(sorted(present))
        labels.append(a and b)
    feature, row = np.concatenate([np.array(r) for r in rows]), np.repeat(np.arange(n), [len(r) for r in rows])
    train = row < 2000
    machine = FactorizationMachine.fit(feature[train], row[train], np.array(labels[:2000], float), 40)
    score = machine.score(feature[~train], row[~train] - 2000, 1000)
    assert ((score >= 0.5) == np.array(labels[2000:])).mean() > 0.98
    machine.factors[:] = 0
    machine.weights = machine.weights.copy()
    assert machine.raw(np.array([insult]), np.array([0]), 1)[0][0] < 0        # an insult alone isn't enough


def test_toxicity_separates_held_out_documents(spark):
    from casaflow.llm.queries import op4_toxicity
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    got = op4_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in got) / len(got)
    assert right > 0.93 and all(0 <= r.score <= 1 for r in got)
    assert not [r for r in got if r.predicted and not r.toxic]


def test_toxicity_odd_rows(spark, odd, no_docs):
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 0), (7, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = fit_toxicity(odd, labels)
    out = score_toxicity(odd, model, out="score")
    assert sorted(out.columns) == sorted(odd.columns) and out.count() == odd.count()
    by_id = {r["doc_id"]: r["score"] for r in out.collect()}
    assert by_id[1] == by_id[2] == by_id[3] and all(0 <= s <= 1 for s in by_id.values())
    bare = fit_toxicity(no_docs, labels.where("false"))
    assert bare.count() <= 1 and score_toxicity(no_docs, bare).count() == 0


# --- mixing ----------------------------------------------------------------------------

def water_fill(budget, children):
    """{name: share} of (name, weight, capacity) children, by repeated dealing."""
    got, open_ = {}, {n: (w, c) for n, w, c in children if w > 0}
    while open_:
        level = budget / sum(w for w, _ in open_.values())
        full = {n: c for n, (w, c) in open_.items() if c <= level * w}
        if not full:
            return {**{n: 0.0 for n, w, _ in children if w <= 0}, **got, **{n: level * w for n, (w, _) in open_.items()}}
        for n, c in full.items():
            got[n] = c
            budget -= c
            del open_[n]
    return {**{n: 0.0 for n, w, _ in children if w <= 0}, **got}


def test_quotas_match_repeated_dealing(spark):
    from casaflow.llm.mixing import leaf_quotas
    rng = random.Random(6)
    leaves = [(d, la, s, rng.choice([0, 10, 500, 5000])) for d in "xyz" for la in ("en", "de") for s in ("s1", "s2", "s3") if rng.random() < 0.9]
    weights = [("x", 5.0), ("y", 0.0), ("x/en", 3.0), ("x/en/s1", 0.0), ("z/de/s2", 9.0)]
    given = dict(weights)
    budget, epochs = 9000.0, 3
    df = leaf_quotas(spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long"), weights, F.lit(budget) + F.sum("tokens") * 0, epochs)
    got = {tuple(r)[:3]: r["quota"] for r in df.collect()}
    cap = lambda *p: sum(t * epochs for *path, t in leaves if tuple(path[:len(p)]) == p)
    kids = lambda *p: sorted({tuple(path[:len(p) + 1]) for *path, _ in leaves if tuple(path[:len(p)]) == p})
    shares = {(): budget}
    for depth in range(3):
        for node in [n for n in shares if len(n) == depth]:
            shares |= water_fill(shares[node], [(k, given.get("/".join(k), 1.0), cap(*k)) for k in kids(*node)])
    assert got == {tuple(path): math.floor(shares[tuple(path)] + 1e-6) for *path, _ in leaves}


def test_mixing_meets_quotas_and_is_seeded(spark, docs):
    domain = F.when(F.col("source") == "src0", "a").otherwise("b")
    runs = [mix_sources(docs, [("a", 3.0)], 0.5, domain, seed, 2) for seed in (1, 1, 2)]
    rows = [sorted(map(tuple, r.select("doc_id", "mix_epoch").collect())) for r in runs]
    assert rows[0] == rows[1] != rows[2]
    total = docs.agg(F.sum(word_count(F.col("text")))).first()[0]
    used = runs[0].agg(F.sum(word_count(F.col("text")))).first()[0]
    assert used <= 0.5 * total and used > 0.3 * total
    assert runs[0].columns == [*docs.columns, "mix_epoch"]


def test_mixing_odd_rows(odd, no_docs):
    out = mix_sources(odd, [], 1.0, F.lit("d"), max_epochs=1)
    rows = out.collect()
    assert out.columns == [*odd.columns, "mix_epoch"] and {r["doc_id"] for r in rows} >= {4, 5, 6, 7, 9, 10, None}
    assert sum(r["doc_id"] == 9 for r in rows) == 2 and all(r["key"] == "x-key" for r in rows)
    assert mix_sources(no_docs, [("d", 1.0)], 1.0, F.lit("d")).count() == 0


# --- packing -------------------------------------------------------------------------------

def test_best_fit_matches_looking_at_every_bin():
    rng = random.Random(9)
    for _ in range(60):
        lengths = sorted((rng.randint(1, 64) for _ in range(rng.randint(1, 80))), reverse=True)
        bins, offsets, sizes = best_fit(lengths, (16, 32, 64), lambda c: 8 + c)
        items = [[] for _ in sizes]
        for n, b, o in zip(lengths, bins, offsets):
            assert o == sum(items[b])
            items[b].append(n)
        expected = brute.best_fit(lengths, (16, 32, 64), lambda c: 8 + c)
        assert sorted(zip(items, sizes)) == sorted(expected)


def check_packing(rows, lengths, capacities=CAPACITIES):
    seen, bins = {}, {}
    for doc, piece, start, n, b, offset, capacity, used in rows:
        seen.setdefault(doc, []).append((start, n))
        bins.setdefault((b, capacity, used), []).append((offset, n))
    for (_, capacity, used), parts in bins.items():
        ends = 0
        for offset, n in sorted(parts):
            assert offset == ends
            ends += n
        assert ends == used <= capacity == min(c for c in capacities if c >= used)
    assert len({b for b, _, _ in bins}) == len(bins)
    for doc, parts in seen.items():
        assert sum(n for _, n in parts) == lengths[doc]
    return bins


def test_packing_covers_every_document(spark, docs):
    sized = docs.select("doc_id", word_count(F.col("text")).alias("n_tokens"))
    lengths = dict(map(tuple, sized.collect()))
    for shard in (50_000, 40):
        rows = [tuple(r) for r in pack(sized, shard_pieces=shard).collect()]
        bins = check_packing(rows, lengths)
        assert {r[0] for r in rows} == {d for d, n in lengths.items() if n}
    assert sum(used for _, _, used in bins) / sum(c for _, c, _ in bins) > 0.8
    assert sequence_cost(1024) / 1024 < sequence_cost(8192) / 8192


def test_packing_does_not_depend_on_partitions(spark, docs, monkeypatch):
    from casaflow.llm import packing
    monkeypatch.setattr(packing, "COPIES", 2)
    sized = docs.select("doc_id", word_count(F.col("text")).alias("n_tokens"))
    sized = sized.unionByName(sized.where("doc_id % 5 = 0").withColumn("doc_id", F.lit(None).cast("long"))).unionByName(sized.where("doc_id < 9"))
    one, other = (sorted((tuple(r) for r in pack(x, shard_pieces=40).collect()), key=str) for x in (sized, sized.repartition(7, "n_tokens")))
    assert one == other and len(one) > 200


def test_packing_odd_lengths(spark):
    df = clashing(spark.createDataFrame([(1, 20_000), (2, 0), (3, None), (4, -5), (None, 7), (5, 8192), (5, 8192)], "doc_id long, n_tokens long"))
    rows = [tuple(r) for r in pack(df).collect()]
    check_packing(rows, {1: 20_000, None: 7, 5: 16_384})
    assert pack(df.where("false")).count() == 0


# --- token files ------------------------------------------------------------------------------

def test_piecewise_ids_equal_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    rng = random.Random(4)
    parts = ["a", "Hello", " ", "  ", "\n", "\t", "'s", "'", "é", "Ñandú", "12", "3½", "!!", "—", "漢字", "\x85", "\u00a0", "\u00ad", "<|endoftext|>", "x" * 30, "_", "\r\n", "²", "ª"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)] + ["", " ", "\n\n a", "a \n"]
    enc = PieceEncoder(path, limit=900, block_chars=500)
    ids, offsets = enc.encode(texts)
    for i, t in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


def test_records_round_trip(spark, odd, no_docs, tmp_dir):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    records.write_records(odd, f"{tmp_dir}/a", path, shard_bytes=60_000)
    rows = records.read_records(spark, f"{tmp_dir}/a").orderBy("shard", "row").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids == [None, 1, 2, 3, 4, 5, 6, 7, 9, 9, 10]
    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    at = 0
    for r in rows:
        expected = np.array([*whole.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 2], "<u4")
        assert bytes(r["ids"]) == expected.tobytes() and r["start"] == at and r["n_tokens"] == len(expected)
        assert r["ids_crc32"] == zlib.crc32(expected.tobytes())
        at += len(expected)
    dealt = records.shuffled_records(spark, f"{tmp_dir}/a", seed=3, partitions=2).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["ids"])) for r in dealt) == sorted((r["doc_id"] or 0, bytes(r["ids"])) for r in rows)
    records.write_records(no_docs, f"{tmp_dir}/b", path)
    assert records.read_records(spark, f"{tmp_dir}/b").count() == 0


def test_shards_are_read_by_several_tasks(spark, docs, tmp_dir):
    import public_tokenizers
    manifest = records.write_records(docs, f"{tmp_dir}/several", public_tokenizers.path("byte_bpe_50k.json"), shard_bytes=40_000)
    shards = manifest.count()
    tasks = records.read_records(spark, f"{tmp_dir}/several").select(F.spark_partition_id().alias("p")).distinct().count()
    assert shards > 4 and tasks > shards // 3


def test_damaged_frames_are_found():
    data = records.frame(b"payload") + records.frame(b"")
    assert records.unframe(memoryview(data), 0) == (b"payload", 23)
    for at in (0, 9, 14, 20):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe(memoryview(bytes(broken)), 0)
    with pytest.raises(ValueError):
        records.unframe(memoryview(data[:15]), 0)
