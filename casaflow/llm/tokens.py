"""Byte-level BPE encoding of whole texts with a memo of pre-token pieces.

The tokenizers library splits a text into pieces with one pattern and runs BPE
inside each piece, so the ids of a text are the ids of its pieces in order. A
task finds the pieces of a block of texts with numpy, has the library encode
each new piece once, and gathers the ids. Texts with characters outside the
range where the pattern's classes are plain (or with a special token or a
contraction) go to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from casaflow.llm.arrays import segment_hashes

#: Fixed values of the pre-token pattern over U+0000..U+024F: white space,
#: letters, digits; every other printable character is "other".
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
CONTRACTION = re.compile(r"'(?:[stmd]|re|ve|ll)")
SPACE, BREAK, LETTER, DIGIT, OTHER = range(5)
#: New pieces that the library encodes in one call (it holds about a KB for each).
PIECES_AT_ONCE = 1 << 12


def _classes() -> np.ndarray:
    table = np.full(0x250, OTHER, dtype=np.uint8)
    for code in range(0x250):
        c = chr(code)
        if c.isalpha():
            table[code] = LETTER
        elif c.isnumeric():
            table[code] = DIGIT
    table[[9, 10, 13]] = BREAK
    table[32] = SPACE
    return table


CLASS = _classes()


def pieces(codes: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Start positions of the pre-token pieces of concatenated plain texts:
    runs of letters, digits or others take one space before them; a white-space
    run gives up its last character to what follows."""
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    kind = CLASS[codes]
    run = np.where(kind == BREAK, SPACE, kind)
    first = np.zeros(n, dtype=bool)
    first[text_starts] = True
    begin = first.copy()
    begin[1:] |= run[1:] != run[:-1]
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n)
    space = run[starts] == SPACE
    goes_on = np.append(~first[starts[1:]], False)
    mark = np.zeros(n, dtype=bool)
    mark[starts] = True
    # a word run right after a space of the same text belongs to that space
    after = np.flatnonzero(~space & ~first[starts])
    after = after[kind[starts[after] - 1] == SPACE]
    mark[starts[after]] = False
    # the last character of a longer white-space run starts the next piece
    longer = space & goes_on & (ends - starts > 1)
    mark[ends[longer] - 1] = True
    return np.flatnonzero(mark)


class PieceEncoder:
    """Encodes lists of texts to (ids, offsets); remembers up to ``limit`` pieces."""

    def __init__(self, tokenizer_path: str, limit: int = 2_000_000, block_chars: int = 1 << 20):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit, self.block = limit, block_chars
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.size = np.empty(0, np.int32)
        self.flat = np.empty(0, np.uint32)

    def _plain(self, text: str) -> bool:
        return (PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)
                and ("'" not in text or CONTRACTION.search(text) is None))

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the offsets of each text in them."""
        out: list[np.ndarray] = []
        row = 0
        while row < len(texts):
            block, chars = [], 0
            while row < len(texts) and (not block or chars + len(texts[row]) <= self.block) and self._plain(texts[row]):
                block.append(texts[row])
                chars += len(texts[row])
                row += 1
            if block:
                out += self._encode_plain(block)
            else:
                out.append(np.asarray(self._library([texts[row]])[0], dtype=np.uint32))
                row += 1
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in out], dtype=np.int64)]).astype(np.int64)
        return (np.concatenate(out) if out else np.empty(0, np.uint32)), offsets

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        joined = "".join(texts)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        if not joined:
            return [np.empty(0, np.uint32)] * len(texts)
        codes = np.frombuffer(joined.encode("utf-16-le"), np.uint16)
        starts = pieces(codes, bounds[:-1][lengths > 0])
        keys, first, which = np.unique(segment_hashes(codes, starts), return_index=True, return_inverse=True)
        slot = self._slots(keys, first, joined, starts)
        sizes = self.size[slot][which].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(self.at[slot][which] - total[:-1], sizes) + np.arange(total[-1])
        ids = self.flat[source]
        cuts = total[np.searchsorted(starts, bounds)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _slots(self, keys: np.ndarray, first: np.ndarray, joined: str, starts: np.ndarray) -> np.ndarray:
        """Memo rows of the pieces; new pieces are encoded and added."""
        if len(self.keys) + len(keys) > self.limit:
            self._forget()
        slot = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = slot < len(self.keys)
        known[inside] = self.keys[slot[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            ends = np.append(starts[1:], len(joined))
            sizes, flat = [], [self.flat]
            for lo in range(0, len(new), PIECES_AT_ONCE):
                ids = self._library([joined[starts[i]:ends[i]] for i in first[new[lo:lo + PIECES_AT_ONCE]]])
                sizes.append(np.array([len(x) for x in ids], dtype=np.int32))
                flat.append(np.fromiter((i for x in ids for i in x), np.uint32, int(sizes[-1].sum())))
            size = np.concatenate(sizes)
            at = len(self.flat) + np.concatenate([[0], np.cumsum(size[:-1], dtype=np.int64)])
            self.flat = np.concatenate(flat)
            where = slot[new]
            self.keys = np.insert(self.keys, where, keys[new])
            self.at = np.insert(self.at, where, at)
            self.size = np.insert(self.size, where, size)
            slot = np.searchsorted(self.keys, keys)
        return slot


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(tokenizer_path: str) -> PieceEncoder:
    """One encoder per worker process and vocabulary file. Spark gives a worker
    one core: the library's own threads would only hold memory each."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = PieceEncoder(tokenizer_path)
    return _ENCODERS[tokenizer_path]


def count_ids(texts: list[str], enc: PieceEncoder) -> np.ndarray:
    """The number of ids of each text, encoded in blocks of the encoder's size."""
    sizes, lo = [np.empty(0, np.int64)], 0
    while lo < len(texts):
        hi, chars = lo, 0
        while hi < len(texts) and (hi == lo or chars + len(texts[hi]) <= enc.block):
            chars += len(texts[hi])
            hi += 1
        sizes.append(np.diff(enc.encode(texts[lo:hi])[1]))
        lo = hi
    return np.concatenate(sizes)


def token_count(text: Column, tokenizer_path: str) -> Column:
    """The number of ids of each whole text (null: none). The caller ships the
    package and stores what it reads twice."""
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series(count_ids(texts.fillna("").tolist(), encoder(tokenizer_path)))

    return F.pandas_udf(count, "long")(text)
