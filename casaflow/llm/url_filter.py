"""URL filters by a Bloom filter cascade.

A cascade answers "is this key listed?" exactly for every key of a known
universe. Level 1 is a Bloom filter of the listed keys; level 2 one of the
unlisted universe keys that level 1 wrongly passes; level 3 one of the listed
keys that level 2 passes; and so on until a level passes nothing wrongly. A
key's answer is the parity of the first level that rejects it. The universe is
every key of the whole corpus, so applying the cascade needs no join, and no
shuffle of the corpus while the filters fit one broadcast.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casaflow.llm.arrays import U64, mix
from casaflow.session import materialize, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_LEVELS = 64


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host follows the first ``://`` up to ``/``, ``?``,
    ``#`` or the end, with A-Z lower-cased; the path follows up to ``?``, ``#``
    or the end. Both are empty for a null url or one without ``://``."""
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_keys(host: Column, path: Column, lengths: Iterable[int]) -> Column:
    """Every key a rule could have that fits the url: each host suffix (whole
    labels) with each path prefix of the given lengths, longest first."""
    lengths = sorted(set(lengths))
    labels = F.split(host, "\\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
                        lambda p: p.isNotNull())
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    keys = F.filter(F.array_distinct(keys), lambda k: k != "")
    return F.array_sort(keys, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
                        .when(a < b, -1).when(a > b, 1).otherwise(0))


@dataclasses.dataclass
class Cascade:
    """Levels of one shard: (bits as words, number of bits, probes)."""
    levels: list[tuple[np.ndarray, int, int]]

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Membership of keys by their two 64-bit hashes."""
        answer = np.zeros(len(h1), dtype=bool)
        open_ = np.arange(len(h1))
        for level, spec in enumerate(self.levels):
            open_ = open_[_passes(spec, level, h1[open_], h2[open_])]
            if not len(open_):
                break
            answer[open_] = level % 2 == 0
        return answer


def _positions(level: int, bits: int, probes: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Bit positions (keys x probes) of double hashing, different at each level."""
    a, b = mix(h1 + U64(2 * level + 1)), mix(h2 + U64(2 * level + 1)) | U64(1)
    return (a[:, None] + np.arange(probes, dtype=U64) * b[:, None]) % U64(bits)


def _passes(spec: tuple[np.ndarray, int, int], level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    words, bits, probes = spec
    if not len(h1):
        return np.zeros(0, dtype=bool)
    at = _positions(level, bits, probes, h1, h2)
    return ((words[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1) != 0).all(axis=1)


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)


def level_rate(listed: int, others: int) -> float:
    """The false-positive rate of level 1 for which all levels take least bits."""
    return min(0.5, listed / (2 * math.log(2) * others)) if listed and others else 0.5


def cascade_bits(listed: int, others: int, rate: float) -> float:
    """Expected bits of all levels: level 1 has the listed keys, level 2 the
    others it passes, level 3 half the listed ones, and so on by halves."""
    return (listed * -math.log2(rate) + 2 * others * rate + listed) / math.log(2) if listed else 0.0


class BloomCascade:
    """An exact membership filter for ``listed`` over ``universe``.

    Both are frames with a string column ``key`` (nulls are ignored, repeats
    count once). ``rate`` is the false-positive rate of level 1; later levels use
    one half. Without one it follows from both sizes (``level_rate``), so that all
    levels together take about ``log2(universe / listed) + 3`` bits * 1.44 a listed
    key: they grow with the list, not with the corpus. Keys are dealt to as many
    shards by their hash as keep all levels of a shard within ``shard_bytes``, the
    bound of every broadcast and of what the driver builds at a time.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame, rate: float | None = None, shard_bytes: int = 32 << 20):
        spark = listed.sparkSession
        ship_package(spark)
        h1, h2 = _hashes(F.col("key"))
        flagged = (listed.select("key", F.lit(1).alias("on")).unionByName(universe.select("key", F.lit(0).alias("on")))
                   .where("key is not null").groupBy("key").agg(F.max("on").alias("on")))
        keys = materialize(flagged.select(h1.alias("h1"), h2.alias("h2"), (F.col("on") == 1).alias("on")), "cascade-keys")
        n, others = keys.agg(F.count_if("on"), F.count_if(~F.col("on"))).first()
        rate = level_rate(n, others) if rate is None else rate
        # level sizes vary by chance: room for twice the expectation
        self.shards = max(1, math.ceil(2 * cascade_bits(n, others, rate) / 8 / shard_bytes))
        shard = F.pmod(F.col("h1"), F.lit(self.shards)).cast("int")
        self.filters = []
        for s in range(self.shards):
            own = keys.where(shard == s) if self.shards > 1 else keys
            self.filters.append(spark.sparkContext.broadcast(self._levels(own, rate)))

    @staticmethod
    def _levels(keys: DataFrame, rate: float) -> Cascade:
        """Encode by turns what must pass and what wrongly passed."""
        cascade = Cascade([])
        classes = [keys.where("on").select("h1", "h2"), keys.where("not on").select("h1", "h2")]
        for level in range(MAX_LEVELS):
            inside = classes[level % 2]
            n = inside.count()
            if n == 0:
                return cascade
            per_key = -math.log(rate if level == 0 else 0.5) / math.log(2) ** 2
            bits = max(64, -(-math.ceil(n * per_key) // 64) * 64)
            probes = max(1, round(per_key * math.log(2)))
            words = _encode(inside, level, bits, probes)
            cascade.levels.append((words, bits, probes))
            spec = (words, bits, probes)
            classes[1 - level % 2] = materialize(_filtered(classes[1 - level % 2], level, spec), "cascade-level")
        raise ValueError("the cascade doesn't end: two different keys share both hashes")

    def add(self, frame: DataFrame, keys: str, out: str) -> DataFrame:
        """``frame`` with ``out``: the listed keys among the array column
        ``keys``, in its order (null array: empty)."""
        schema = T.StructType([*[f for f in frame.schema.fields if f.name != out], T.StructField(out, T.ArrayType(T.StringType()))])
        names, filters, shards = [f.name for f in schema.fields[:-1]], self.filters, self.shards
        array = F.coalesce(F.col(keys), F.array().cast("array<string>"))
        h = [F.transform(array, lambda k: _hashes(k)[0]), F.transform(array, lambda k: _hashes(k)[1])]

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h1, h2 = (batch.column(batch.num_columns - 2 + i) for i in (0, 1))
                a, b = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (h1, h2))
                if shards == 1:
                    hit = filters[0].value.listed(a.view(U64), b.view(U64))
                else:
                    hit, shard = np.zeros(len(a), dtype=bool), np.mod(a, shards)
                    for s in np.unique(shard).tolist():
                        at = np.flatnonzero(shard == s)
                        hit[at] = filters[s].value.listed(a[at].view(U64), b[at].view(U64))
                of = np.repeat(np.arange(batch.num_rows), h1.value_lengths().to_numpy(zero_copy_only=False))
                texts = batch.column(names.index(keys)).flatten().filter(pa.array(hit))
                cuts = np.searchsorted(of[hit], np.arange(batch.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.ListArray.from_arrays(pa.array(cuts), texts.cast(pa.string()))],
                                                 names=[*names, out])

        hashed = frame.select(*[F.col(f"`{c}`") for c in names], h[0].alias("_h1"), h[1].alias("_h2"))
        if shards > 1:   # a task then fetches few of the shards' filters at a time
            hashed = hashed.sortWithinPartitions(F.pmod(F.get("_h1", F.lit(0)), F.lit(shards)))
        return hashed.mapInArrow(mark, schema)


def _encode(keys: DataFrame, level: int, bits: int, probes: int) -> np.ndarray:
    """The filter's words; tasks send their distinct words, Spark ORs them. They
    come to the driver in one job, 16 bytes a word of a filter of bounded size."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (c.to_numpy().view(U64) for c in batch.columns)
            if len(h1):
                at = np.unique(_positions(level, bits, probes, h1, h2))
                where, first = np.unique(at >> U64(6), return_index=True)
                words = np.bitwise_or.reduceat(U64(1) << (at & U64(63)), first)
                yield pa.RecordBatch.from_pydict({"at": where.astype(np.int64), "word": words.view(np.int64)})

    words = np.zeros(bits // 64, np.int64)
    placed = keys.mapInArrow(place, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words[placed.column("at").to_numpy()] = placed.column("word").to_numpy()
    return words.view(U64)


def _filtered(keys: DataFrame, level: int, spec: tuple[np.ndarray, int, int]) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(spec)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (c.to_numpy().view(U64) for c in batch.columns)
            yield batch.filter(pa.array(_passes(shared.value, level, h1, h2)))

    return keys.mapInArrow(keep, "h1 long, h2 long")


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Judge every url: id, host, path, rule, verdict and ``listed_key``.

    ``rules`` are (host, path prefix, "allow" or "block"); a rule fits its host
    (A-Z lower-cased, as in the keys of ``listed``)
    and all subdomains when the url's path starts with the rule's path, and the
    longest fitting rule (host and path together) decides; one that is listed
    both ways blocks. Without one, the
    verdict is "block" when a host suffix of the url is among the keys of
    ``listed`` (``listed_key`` is the longest such), else "allow". Membership
    in the blocking rules, the allowing rules and the list comes from three
    cascades over all keys of the corpus.

    A null url, or one without ``://``, has an empty host and path and is
    allowed. Repeated rows are all judged; an empty table gives an empty
    result; other columns of ``pages`` are ignored.
    """
    spark = pages.sparkSession
    ascii_lower = str.maketrans(UPPER, LOWER)
    rules = [(h.translate(ascii_lower), p, a) for h, p, a in rules]
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule_keys = url_keys(F.col("host"), F.col("path"), [len(p) for _, p, _ in rules]) if rules else F.array().cast("array<string>")
    keyed = parts.select("*", rule_keys.alias("rule_keys"), url_keys(F.col("host"), F.lit(""), [0]).alias("host_keys"))
    universe = {c: keyed.select(F.explode(c).alias("key")).distinct() for c in ("rule_keys", "host_keys")}
    universe["rule_keys"] = materialize(universe["rule_keys"], "url-rule-keys")     # of two cascades
    out = keyed
    for action in ("block", "allow"):
        own = spark.createDataFrame([(h + p,) for h, p, a in rules if a == action], "key string")
        out = BloomCascade(own, universe["rule_keys"]).add(out, "rule_keys", action)
    listed = spark.createDataFrame([], "key string") if listed is None else listed.select(F.translate("key", UPPER, LOWER).alias("key"))
    out = BloomCascade(listed, universe["host_keys"]).add(out, "host_keys", "on_list")
    # keys are longest first, so the first listed one decides
    block, allow = F.get("block", F.lit(0)), F.get("allow", F.lit(0))
    longer = F.coalesce(F.length(block), F.lit(-1)) >= F.coalesce(F.length(allow), F.lit(-1))
    rule, key = F.when(longer, block).otherwise(allow), F.get("on_list", F.lit(0))
    verdict = (F.when(rule.isNotNull(), F.when(longer, "block").otherwise("allow"))
               .otherwise(F.when(key.isNotNull(), "block").otherwise("allow")))
    return out.select(F.col("page_id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"),
                      key.alias("listed_key"))
