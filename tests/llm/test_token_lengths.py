"""Token counts of whole texts, and the packing query that is laid out by them."""

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from casaflow.llm.queries import op5_packing
from casaflow.llm.tokens import PieceEncoder, count_ids, encoder, token_count
from casaflow.session import ship_package
from tests.llm.conftest import SF
from tests.llm.test_other_operators import check_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_counts(rows):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in rows]


def test_counts_are_the_librarys(spark, odd, no_docs):
    ship_package(spark)
    got = odd.select("text", token_count(F.col("text"), PATH).alias("n")).collect()
    assert [r.n for r in got] == library_counts(r.text for r in got)
    assert no_docs.select(token_count(F.col("text"), PATH).alias("n")).count() == 0


def test_blocks_do_not_change_counts():
    texts = ["one two", "", "", "né — ünïcode", "word " * 300, "don't", "tail"]
    for block in (1, 8, 1 << 20):
        assert count_ids(texts, PieceEncoder(PATH, block_chars=block)).tolist() == library_counts(texts)
    assert count_ids([], encoder(PATH)).tolist() == []


def test_packing_query_lays_out_token_ids(spark, docs):
    texts = docs.select("doc_id", "text").collect()
    lengths = {r.doc_id: n + 1 for r, n in zip(texts, library_counts(r.text for r in texts))}
    rows = [tuple(r) for r in op5_packing(spark, SF).collect()]
    check_packing(rows, lengths)
    assert {r[0] for r in rows} == set(lengths)      # an empty text has its end id
