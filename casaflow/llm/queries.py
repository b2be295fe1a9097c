"""The registered queries of the training-data operators and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole
table and derives the compared columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casaflow.llm import records
from casaflow.llm.embed_dedup import embed_dedup
from casaflow.llm.filter_audit import audit_filters
from casaflow.llm.importance import importance_resample
from casaflow.llm.line_dedup import line_dedup
from casaflow.llm.mixing import mix_sources
from casaflow.llm.ngram_join import ngram_join
from casaflow.llm.packing import pack
from casaflow.llm.suffix_dedup import dedup_strings
from casaflow.llm.tokens import token_count
from casaflow.llm.topk import sign_words, topk_codes
from casaflow.llm.toxicity import fit_toxicity, score_toxicity
from casaflow.llm.url_filter import url_filter
from casaflow.llm.window_packing import pack_windows
from casaflow.session import materialize, scratch_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op10_token_records(spark, sf_dir):
    """Token ids of every document, written as framed records and read back."""
    import public_tokenizers
    folder = scratch_path(spark, "token-records")
    records.write_records(table(spark, sf_dir, "documents"), folder,
                          public_tokenizers.path("byte_bpe_50k.json"))
    return records.read_records(spark, folder, with_ids=False)


@register
def op9_ngram_join(spark, sf_dir):
    """Documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or
    more, as connected components."""
    return ngram_join(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


#: Rules of the URL query: (host, path prefix, action).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: The block list of the URL query: each name under each of the three domains.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_DOMAINS = ("example.com", "example.net", "example.org")


@register
def op3_url_filter(spark, sf_dir):
    """Every page's url judged by rules, then by the block list."""
    listed = spark.createDataFrame([(f"{n}.{d}",) for n in LISTED_NAMES for d in LISTED_DOMAINS], "key string")
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES, listed)


_FIT = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
_BY_LENGTH = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
_LISTED = ", ".join(f"('{n}.{d}')" for n in LISTED_NAMES for d in LISTED_DOMAINS)

ORACLE["op3_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
hosts AS (SELECT DISTINCT host FROM parts),
on_list AS (
  SELECT host, arg_max(k, length(k)) AS listed_key
  FROM hosts JOIN (VALUES {_LISTED}) AS l(k) ON host = k OR ends_with(host, '.' || k)
  GROUP BY host),
judged AS (
  SELECT *, CASE {" ".join(f"WHEN {_FIT.format(h=h, p=p)} THEN '{h}{p}'" for h, p, _ in _BY_LENGTH)} END AS rule,
         CASE {" ".join(f"WHEN {_FIT.format(h=h, p=p)} THEN '{a}'" for h, p, a in _BY_LENGTH)} END AS action
  FROM parts LEFT JOIN on_list USING (host))
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN listed_key IS NULL THEN 'allow' ELSE 'block' END) AS verdict, listed_key
FROM judged
"""


#: Neighbours of each query of the search.
TOP_K = 10


@register
def op8_topk_codes(spark, sf_dir):
    """The ten rows whose sign codes are nearest to each vector whose id is
    divisible by 50, itself included."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    rows = vectors.select("id", sign_words(F.col("embedding"), longest).alias("code"))
    return topk_codes(rows, rows.where("id % 50 = 0"), TOP_K).drop("query_code")


ORACLE["op8_topk_codes"] = f"""
WITH codes AS (
  SELECT vec_id AS id, [coalesce(x, 0) > 0 AND NOT isnan(coalesce(x, 0)) for x in embedding] AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (
  SELECT q.id AS query_id, r.id,
         CAST(len([1 for p in list_zip(q.code, r.code) if p[1] <> p[2]]) AS INTEGER) AS distance
  FROM codes q CROSS JOIN codes r WHERE q.id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS INTEGER) AS rank, id, distance
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, id) <= {TOP_K}
"""


@register
def op1_embed_dedup(spark, sf_dir):
    """Vectors of one label with a cosine of 0.98 or more, as components."""
    return embed_dedup(table(spark, sf_dir, "embeddings"), 0.98)


ORACLE["op1_embed_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) for x in embedding] AS e FROM embeddings),
ok AS (
  SELECT vec_id, label, e, sqrt(list_sum([x * x for x in e])) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len([1 for x in e if x IS NULL OR NOT isfinite(x)]) = 0
    AND list_sum([x * x for x in e]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
   AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(node, root) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
component AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN component ON node = vec_id LEFT JOIN counts ON a = vec_id
"""


#: Bytes of a repeated string.
REPEAT_BYTES = 400


@register
def op7_suffix_dedup(spark, sf_dir):
    """Documents without the bytes of strings of 400 bytes that occur twice."""
    out = dedup_strings(table(spark, sf_dir, "documents"), REPEAT_BYTES)
    removed = F.aggregate(F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")), F.lit(0).cast("long"),
                          lambda s, x: s + x["end"] - x["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"))


@register
def op2_line_dedup(spark, sf_dir):
    """Documents without near-repeated lines: what is left of each text."""
    docs = table(spark, sf_dir, "documents")
    return line_dedup(docs).select(
        "doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), F.length("text").cast("long").alias("n_kept_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: Scores from which a document counts as toxic.
TOXIC_FROM = 0.7


def held_out(doc_id):
    """The third of the documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity_model(spark, docs, sf_dir):
    return fit_toxicity(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id")))


@register
def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@register
def op5_packing(spark, sf_dir):
    """Every document's pieces in bins of the permitted sequence lengths. Lengths
    are token ids, an end id after every document included."""
    import public_tokenizers
    ship_package(spark)
    ids = token_count(F.col("text"), public_tokenizers.path("byte_bpe_50k.json"))
    return pack(materialize(table(spark, sf_dir, "documents").select("doc_id", (ids + 1).alias("n_tokens")), "packing-lengths"))


#: The mixture: weights by domain, language and source; share of the tokens.
MIX_WEIGHTS = [("crawl", 0.4), ("web", 0.35), ("books", 0.25),
               *[(f"{d}/{lang}", w) for d in ("crawl", "web", "books")
                 for lang, w in (("en", 0.55), ("de", 0.2), ("fr", 0.15), ("es", 0.1))],
               ("web/en/src1", 3.0), ("books/en/src10", 2.0)]
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.8, 2, 1


def mix_domain(source="source"):
    """src0 is a crawl, src1 to src9 the web, all others books."""
    c = F.col(source)
    return F.when(c == "src0", "crawl").when(c.rlike("^src[1-9]$"), "web").otherwise("books")


def mixture(docs, epoch_col="mix_epoch"):
    return mix_sources(docs, MIX_WEIGHTS, MIX_SHARE, mix_domain(), MIX_SEED, MIX_EPOCHS, epoch_col=epoch_col)


@register
def op6_mixing(spark, sf_dir):
    """The documents of the mixture, a row for every epoch that takes them."""
    return mixture(table(spark, sf_dir, "documents")).select("doc_id", "mix_epoch", "lang", "source")


def _share_out(source: str, family: str, name: str) -> str:
    """SQL of one level of the budget tree."""
    by = f"PARTITION BY {family}" if family else ""
    keys = f"{family}, {name}" if family else name
    over = f"OVER ({by} ORDER BY cap / w, {name} ROWS BETWEEN"
    return f"""
  SELECT {keys}, least(cap, greatest(water * w, 0)) AS got FROM (
    SELECT *, max(level) OVER ({by}) AS water FROM (
      SELECT *, (budget - coalesce(sum(cap) {over} UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) {over} CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ({source})))"""


_WEIGHTS = ", ".join(f"('{p}', {w}::DOUBLE)" for p, w in MIX_WEIGHTS)
_W = "coalesce((SELECT weight FROM weights WHERE path = {p}), 1.0::DOUBLE) AS w"
_G0 = f"""SELECT m_domain, sum(tokens) * {MIX_EPOCHS}::DOUBLE AS cap, {_W.format(p="m_domain")},
           (SELECT floor(sum(tokens) * {MIX_SHARE}::DOUBLE) FROM leaves) AS budget FROM leaves GROUP BY m_domain"""
_G1 = f"""SELECT l.m_domain, l.m_lang, sum(tokens) * {MIX_EPOCHS}::DOUBLE AS cap, any_value(got) AS budget,
           {_W.format(p="l.m_domain || '/' || l.m_lang")} FROM leaves l JOIN g0 USING (m_domain) GROUP BY l.m_domain, l.m_lang"""
_G2 = f"""SELECT l.m_domain, l.m_lang, l.m_source, tokens * {MIX_EPOCHS}::DOUBLE AS cap, got AS budget,
           {_W.format(p="l.m_domain || '/' || l.m_lang || '/' || l.m_source")} FROM leaves l JOIN g1 USING (m_domain, m_lang)"""
MIX_SQL = f"""
weights(path, weight) AS (VALUES {_WEIGHTS}),
d AS (
  SELECT *, CASE WHEN source = 'src0' THEN 'crawl' WHEN regexp_matches(source, '^src[1-9]$') THEN 'web' ELSE 'books' END AS m_domain,
         coalesce(lang, '') AS m_lang, coalesce(source, '') AS m_source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n,
         coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS place
  FROM docs),
leaves AS (SELECT m_domain, m_lang, m_source, CAST(sum(n) AS BIGINT) AS tokens FROM d GROUP BY ALL),
g0 AS ({_share_out(_G0, "", "m_domain")}),
g1 AS ({_share_out(_G1, "m_domain", "m_lang")}),
g2 AS ({_share_out(_G2, "m_domain, m_lang", "m_source")}),
quota AS (
  SELECT m_domain, m_lang, m_source, CASE WHEN tokens > 0 THEN CAST(floor(got + 1e-6) AS BIGINT) // tokens ELSE 0 END AS whole,
         CASE WHEN tokens > 0 THEN CAST(floor(got + 1e-6) AS BIGINT) % tokens ELSE 0 END AS rest
  FROM g2 JOIN leaves USING (m_domain, m_lang, m_source)),
keyed AS (
  SELECT d.*, whole, rest, md5('{MIX_SEED}:' || whole || ':' || place) AS key
  FROM d JOIN quota USING (m_domain, m_lang, m_source)),
placed AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY m_domain, m_lang, m_source ORDER BY key) AS BIGINT) AS ends FROM keyed),
mixed AS (
  SELECT * EXCLUDE (epochs), CAST(unnest(range(epochs)) AS INTEGER) AS mix_epoch
  FROM (SELECT *, whole + CASE WHEN rest > 0 AND key <= (
          SELECT max(p.key) FROM placed p WHERE p.ends <= p.rest AND p.m_domain = placed.m_domain AND p.m_lang = placed.m_lang
             AND p.m_source = placed.m_source) THEN 1 ELSE 0 END AS epochs FROM placed) WHERE epochs > 0)"""
ORACLE["op6_mixing"] = f"WITH docs AS (SELECT * FROM documents), {MIX_SQL}\nSELECT doc_id, mix_epoch, lang, source FROM mixed"


@register
def op11_filter_audit(spark, sf_dir):
    """What each of five filters removes after others, in all orders."""
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_BIT = "CASE letter " + " ".join(f"WHEN '{c}' THEN {1 << i}" for i, c in enumerate("ABCDE")) + " END"
ORACLE["op11_filter_audit"] = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS bits
  FROM texts LEFT JOIN known USING (doc_id)),
cells AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, bits),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders(filter_order) AS (
  SELECT letter FROM letters
  UNION ALL
  SELECT filter_order || letter FROM orders, letters WHERE NOT contains(filter_order, letter)),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter,
         list_sum([{_BIT.replace("letter", "c")} for c in string_split(filter_order[:step - 1], '')]) AS before
  FROM orders, range(1, 6) AS s(step) WHERE length(filter_order) = 5),
bits AS (SELECT filter_order, step, letter, CAST(coalesce(before, 0) AS INTEGER) AS before, {_BIT} AS own FROM steps),
told AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN c.bits & (before | own) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN c.bits & own > 0 AND c.bits & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN c.bits & own > 0 AND c.bits & before > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN c.bits = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN c.bits & own > 0 AND c.bits & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN c.bits & own > 0 AND c.bits & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells c CROSS JOIN bits GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM told
"""


@register
def op12_window_packing(spark, sf_dir):
    """Every document's token ids in windows of 2048."""
    import public_tokenizers
    return pack_windows(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


@register
def op13_importance_resampling(spark, sf_dir):
    """Documents drawn to look like the benchmark texts."""
    out = importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE["op13_importance_resampling"] = """
WITH RECURSIVE crc_bits(byte, bit, r) AS (
  SELECT i, 0, i FROM range(256) AS t(i)
  UNION ALL
  SELECT byte, bit + 1, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM crc_bits WHERE bit < 8),
crc_table AS (SELECT list(r ORDER BY byte) AS t FROM crc_bits WHERE bit = 8),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS row, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT side, row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS (
  SELECT side, row, unnest(w || [w[i] || ' ' || w[i + 1] for i in range(1, len(w))]
                             || [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) AS gram FROM words),
counted AS (SELECT side, row, gram, count(*) AS n FROM grams GROUP BY ALL),
kinds AS (SELECT gram, hex(encode(gram)) AS h FROM (SELECT DISTINCT gram FROM counted)),
bytes AS (SELECT gram, [16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1
                        for i in range(0, len(h) // 2)] AS b FROM kinds),
placed AS (
  SELECT gram, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295), 4294967295) % 10000 AS bucket
  FROM bytes, crc_table),
features AS (SELECT side, row, bucket, sum(n) AS n FROM counted JOIN placed USING (gram) GROUP BY ALL),
buckets AS (SELECT bucket, sum(CASE WHEN side = 'd' THEN n ELSE 0 END) AS s, sum(CASE WHEN side = 'b' THEN n ELSE 0 END) AS t
            FROM features GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (total_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (total_t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM buckets, (SELECT sum(s) AS total_s, sum(t) AS total_t FROM buckets)),
weights AS (SELECT row, sum(n * gain) AS weight FROM features JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
docs AS (
  SELECT id AS doc_id, row, len(w) AS n_words, len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0) AS n_features,
         CAST(coalesce(weight, 0) AS BIGINT) AS weight, sha256('42:' || coalesce(CAST(id AS VARCHAR), ''))[:8] AS h
  FROM texts JOIN words USING (side, row) LEFT JOIN weights USING (row) WHERE side = 'd'),
scored AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((list_reduce([instr('0123456789abcdef', c) - 1 for c in string_split(h, '')],
           lambda a, x: a * 16 + x) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM docs),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, row) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT s.doc_id, CAST(s.n_features AS BIGINT) AS n_features, s.weight, s.score,
       CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN ranked USING (row)
"""
