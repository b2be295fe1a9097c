"""Words and word n-grams of whole texts as bytes, a bounded block at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa

#: Bytes of a text that are split into words at once.
BLOCK = 1 << 20
BREAK = re.compile(rb"[\x20\x09-\x0D]")


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The texts of a string column as UTF-8; null texts are empty."""
    for text in column:
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def word_blocks(data: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words (runs of anything but ASCII white space) of a text, those of
    about ``block`` bytes at a time; no word is cut in two."""
    at = 0
    while at < len(data):
        found = BREAK.search(data, at + block) if at + block < len(data) else None
        end = found.start() if found else len(data)
        if words := data[at:end].split():
            yield words
        at = end


def _term_table() -> bytes:
    """Lower case for A-Z, itself for digits, letters and non-ASCII bytes, a
    space for every other byte."""
    table = bytearray(b" " * 256)
    table[128:] = range(128, 256)
    for c in range(128):
        if chr(c).isalnum():
            table[c] = ord(chr(c).lower())
    return bytes(table)


TERMS = _term_table()


def gram_hashes(data: bytes, n: int, block: int = BLOCK) -> Iterator[tuple[int, list[int]]]:
    """(words, hashes) of each block of a text's terms: the CRC-32 of every run
    of 1 to ``n`` consecutive terms joined by one space. A run's CRC seeds that of
    the run one term longer, so no run is ever put together; the CRCs of the
    block's last runs seed the next block's."""
    ends: list[int] = []                # CRCs of the runs of 1, 2, ... terms that end with the last term
    for words in word_blocks(data.translate(TERMS), block):
        runs = list(map(crc32, words))
        last, out = [runs[-1]], list(runs)
        tails = [b" " + w for w in words] if n > 1 else []
        for k in range(1, n):
            seeds = ends[k - 1:k] + runs[:-1]
            runs = list(map(crc32, tails[len(tails) - len(seeds):], seeds))
            if not runs:
                break
            last.append(runs[-1])
            out += runs
        ends = last
        yield len(words), out


def buckets_of(hashes: list[int], buckets: int) -> np.ndarray:
    return np.fromiter(hashes, np.int64, len(hashes)) % buckets
