"""Word spans and word hashes of whole texts, vectorised over Arrow blocks.

Helpers for code that runs inside Spark tasks (``mapInArrow``). A block is a
run of whole texts of about ``BLOCK_BYTES`` bytes (a longer text is a block
of its own), so a task's memory is bounded by its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U64 = np.uint64

#: Bytes that are no white space of ``[\x20\x09-\x0D]``.
NON_SPACE = np.ones(256, bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: ASCII letters, digits and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_TABLE = np.random.default_rng(20240611).integers(0, 1 << 64, size=64 * 256, dtype=U64)
_ODD = U64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers (multiply and xor-shift rounds)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


@dataclass
class Block:
    """Whole texts as one byte array; ``offs[i]:offs[i+1]`` is text i (a null
    is empty). ``batch`` holds the other columns of the same rows."""

    data: np.ndarray
    offs: np.ndarray
    batch: pa.RecordBatch

    def __len__(self) -> int:
        return len(self.offs) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offs[i] : self.offs[i + 1]].tobytes()


def blocks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column)).fill_null("").cast(pa.large_string())
        offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        raw = col.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(col):
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
            hi = min(hi, len(col))
            yield Block(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], batch.slice(lo, hi - lo))
            lo = hi


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
    """(start, end, text index) of every maximal run of word bytes."""
    w = is_word[data]
    full = offs[1:] > offs[:-1]
    s = w.copy()
    s[1:] &= ~w[:-1]
    first = offs[:-1][full]
    s[first] = w[first]
    e = w
    last = offs[1:][full] - 1
    keep = e[last].copy()
    e[:-1] &= ~is_word[data[1:]]
    e[last] = keep
    starts, ends = np.flatnonzero(s), np.flatnonzero(e) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices of all runs ``starts[i] : starts[i] + lens[i]``, joined."""
    total = int(lens.sum())
    before = np.cumsum(lens) - lens
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lens)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each (non-empty) byte span: a random table per place
    and byte, summed and mixed with the length."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    before = np.cumsum(lens) - lens
    total = int(lens.sum())
    place = np.arange(total, dtype=np.int32) - np.repeat(before.astype(np.int32), lens)
    byte = data[place + np.repeat(starts.astype(np.int32), lens)]
    value = _TABLE[((place & 63) << 8) + byte]
    far = np.flatnonzero(place >= 64)
    if len(far):
        value[far] = mix64(value[far] + (place[far] >> 6).astype(U64) * _ODD)
    return mix64(np.add.reduceat(value, before) + lens.astype(U64) * _ODD)


@dataclass
class Words:
    """The words of a block: byte spans, text index, hash and place in text."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    count: np.ndarray  # words per text
    first: np.ndarray  # index of each text's first word


def words(block: Block, is_word: np.ndarray = NON_SPACE, lower: bool = True) -> Words:
    data = LOWER[block.data] if lower else block.data
    start, end, doc = word_spans(data, block.offs, is_word)
    count = np.bincount(doc, minlength=len(block)).astype(np.int64)
    return Words(start, end, doc, hash_spans(data, start, end), count, np.cumsum(count) - count)


def windows(w: Words, n: int):
    """(hash, text index, first word) of every n-word window inside a text."""
    if len(w.hash) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = len(w.hash) - n + 1
    h = np.zeros(m, U64)
    for i in range(n):
        h = mix64(h * U64(3) + w.hash[i : i + m])
    at = np.flatnonzero(w.doc[:m] == w.doc[n - 1 :])
    return h[at], w.doc[at], at
