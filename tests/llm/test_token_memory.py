"""What a worker that encodes texts holds at a time."""

from __future__ import annotations

import os

import public_tokenizers

from casaflow.llm import tokens


def test_new_pieces_reach_the_library_in_bounded_calls(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc = tokens.PieceEncoder(path)
    texts = [" ".join(f"w{i}x{i * 7919 % 10007}" for i in range(lo, lo + 4000)) for lo in (0, 2000, 6000)]
    expected = [enc.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    calls, library = [], enc._library
    monkeypatch.setattr(enc, "_library", lambda part: calls.append(len(part)) or library(part))
    ids, offsets = enc.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == expected
    assert len(calls) > 1 and max(calls) <= tokens.PIECES_AT_ONCE


def test_a_workers_encoder_starts_no_threads_of_its_own(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
