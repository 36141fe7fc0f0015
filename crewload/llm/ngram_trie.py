"""Language-model scoring with Elias-Fano n-gram tries.

A trigram model with absolute discounting, interpolated down to add-one
unigrams. The trie is sharded by the last context word, so that one shard
holds all that a word needs above the unigram level: contexts ``v``, their
successors ``w``, contexts ``u v`` below ``v``, and their successors. A level
keeps the successors of each context from where those of the one before end,
as one Elias-Fano sequence, and monotone pointers to each context's first; a
lookup reads its context's pointers and searches the successor between them.
Probabilities and back-off weights are quantised to one byte. All levels of a
shard lie in one memory map.

Spark moves packed columns instead of rows. A first pass counts the training
words: the size of the vocabulary, and the words that are frequent. Then a
task sends each shard the trigrams of its texts once, sorted and compressed; a
shard counts, builds its trie, answers every occurrence with ``(a, b)`` of
``p(w | u v) = a + b p(w)`` and passes those to the unigram shard of ``w``,
which knows ``p(w)`` and adds up logarithms by text. Shards grow in number
with the corpus, and the model is the same for any number of them: discounts
are constants, vocabulary and counts exact. A context word of more than
``SPLIT_TOKENS`` occurrences is divided by a hash of ``u``, so that the longer
contexts ``u v`` stay whole. Its own successors are counted over the whole
corpus by a pass of their own, and the unigram shard of ``w`` takes the bigram
level from there, to the same byte as an undivided word's; a word's division
moves work and changes no score. The occurrences of such a word go to many
unigram shards, its counts with them.
"""

from __future__ import annotations

import math
import mmap
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .words import NON_SPACE, U64, blocks, mix64, ragged, words

BATCH_TOKENS, BATCH_DOCS = 2_000_000, 60_000
SHARD_BYTES = 11 << 20  # corpus bytes per trie shard
UNIGRAM_SHARDS = 4  # trie shards per unigram shard
SPLIT_TOKENS = 1 << 20  # occurrences of a word from which it is divided
SPLIT_SHARE = 1e-6  # and least share of all tokens: at most 1 / SPLIT_SHARE such words
DISCOUNT = 0.75  # absolute discount of bigrams and trigrams
SURVEY_WORDS = 1 << 21  # words counted before they are merged
SUM_ROWS = 1 << 18  # sums of texts held before they are added up
A_STEP, B_STEP = 10 / 254, 6 / 254  # log10 per quantisation step, one byte
END, START = U64(1), U64(2)
HASH_SHIFT = U64(64 - 52)  # words are known by 52 bits of their hash: sorted, they pack well
_SALT = U64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


# --- Elias-Fano ------------------------------------------------------------------


class EliasFano:
    """A strictly monotone sequence of integers below ``universe``: the low
    bits of each side by side, high bits in unary, zeros counted per word of
    64 bits."""

    WORD = 64

    def __init__(self, n, low_bits, low, high, zeros):
        self.n, self.low_bits, self.low, self.high, self.zeros = n, low_bits, low.view(U64), high.view(U64), zeros

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, int(math.log2(max(1, universe // max(1, n)))))
        packed = []
        for lo in range(0, n if low_bits else 0, 1 << 16):  # a multiple of 64 values: whole words
            part = (values[lo : lo + (1 << 16), None] >> np.arange(low_bits)).astype(np.uint8) & 1
            packed.append(np.packbits(part.reshape(-1), bitorder="little"))
        low = np.concatenate([*packed, np.zeros(16, np.uint8)])
        low = low[: len(low) - len(low) % 8].view(np.int64)
        size = n + (universe >> low_bits) + 2
        size += -size % cls.WORD
        unary = np.zeros(size, np.uint8)
        unary[(values >> low_bits) + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little").view(np.int64)
        per = cls.WORD - np.bitwise_count(high.view(U64)).astype(np.int64)
        return cls(n, low_bits, low, high, np.concatenate([[0], np.cumsum(per)]).astype(np.int64))

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Bit position of the zero (or one) number k (from 0)."""
        before = np.arange(len(self.zeros)) * self.WORD - self.zeros if ones else self.zeros
        word = np.searchsorted(before, k, "right") - 1
        left = (k - before[word]).astype(np.uint8)
        bits = self.high[word] if ones else ~self.high[word]
        at = word * self.WORD
        for half in (32, 16, 8, 4, 2, 1):  # the half of the bits that holds it
            count = np.bitwise_count(bits & U64((1 << half) - 1))
            above = left >= count
            left -= count * above
            step = above * np.uint8(half)
            bits >>= step.astype(U64)
            at += step
        return at

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        at = i * self.low_bits
        word, bit = at >> 6, (at & 63).astype(U64)
        value = self.low[word] >> bit
        over = np.flatnonzero(bit > U64(64 - self.low_bits))
        value[over] |= self.low[word[over] + 1] << (U64(64) - bit[over])
        return (value & U64((1 << self.low_bits) - 1)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The elements number i."""
        return ((self._select(i, True) - i) << self.low_bits) | self._low(i)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, or -1: the successor is sought among the
        elements that share its high bits."""
        if not self.n or not len(values):
            return np.full(len(values), -1)
        high = values >> self.low_bits
        most = (len(self.high) * self.WORD - self.n) - 1  # zeros there are
        new = np.concatenate([[True], high[1:] != high[:-1]])  # equal neighbours share one range
        h, run = np.minimum(high[new], most), np.cumsum(new) - 1
        lo = np.where(h > 0, self._select(np.maximum(h - 1, 0), False) - (h - 1), 0)[run]
        end = (self._select(h, False) - h)[run]
        want, hi = values & ((1 << self.low_bits) - 1), end.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            below = self._low(mid) < want[open_]
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
        hit = (lo < end) & (high <= most)
        found = np.full(len(values), -1)
        at = lo[hit]
        found[hit] = np.where(self._low(at) == want[hit], at, -1)
        return found

    def parts(self):
        return [np.array([self.n, self.low_bits], np.int64), self.low.view(np.int64), self.high.view(np.int64), self.zeros]

    @classmethod
    def of(cls, parts) -> EliasFano:
        return cls(int(parts[0][0]), int(parts[0][1]), *parts[1:])


def successors(values: EliasFano, first: EliasFano, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Index of the successor ``word`` of each context (-1: none, as for a
    context of -1): the pointers of the context bound the search, and its
    words count from where those of the context before end."""
    out = np.full(len(context), -1)
    at = np.flatnonzero(context >= 0)
    if not len(at):
        return out
    c = context[at]
    new = _changes(c)
    own, run = c[new], np.cumsum(new) - 1
    lo, hi = first.get(own) - own, first.get(own + 1) - (own + 1)
    base = np.where(lo > 0, values.get(np.maximum(lo - 1, 0)) + 1, 0)
    end = values.get(hi - 1)
    want = base[run] + word[at]
    inside = want <= end[run]
    out[at[inside]] = values.find(want[inside])
    return np.where((out >= 0) & (context >= 0), out, -1)


def _codes(p: np.ndarray, step: float) -> np.ndarray:
    """One byte per probability: 0 is zero, else 255 + log10(p) / step."""
    with np.errstate(divide="ignore"):
        code = np.rint(np.log10(p) / step) + 255
    return np.where(p > 0, np.clip(code, 1, 255), 0).astype(np.uint8)


def _values(step: float) -> np.ndarray:
    return np.concatenate([[0.0], 10.0 ** ((np.arange(1, 256) - 255) * step)])


_A, _B = _values(A_STEP), _values(B_STEP)


def _changes(x: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it (the first does)."""
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


class Trie:
    """The levels of one shard in one memory map.

    ``root``: context words (with their split number); ``next``: their
    successors ``w``; ``inner``: the words ``u`` before them, that is the
    longer contexts; ``last``: the successors of those. ``first_next``,
    ``first_inner`` and ``first_last`` are the monotone pointers to a
    context's first successor.
    """

    SEQUENCES = ("root", "next", "inner", "last", "first_next", "first_inner", "first_last")
    CHUNK = 1 << 18
    CODES = ("a_next", "b_root", "a_last", "b_inner")

    def __init__(self, held: mmap.mmap, words: int):
        self.words, self.held = words, held
        at, parts = 0, []
        for _ in range(4 * len(self.SEQUENCES) + len(self.CODES)):
            kind, size = struct.unpack_from("<qq", held, at)
            parts.append(np.frombuffer(held, np.int64 if kind else np.uint8, size, at + 16))
            at += 16 + -(-size * (8 if kind else 1) // 8) * 8
        for i, name in enumerate(self.SEQUENCES):
            setattr(self, name, EliasFano.of(parts[4 * i : 4 * i + 4]))
        for name, part in zip(self.CODES, parts[4 * len(self.SEQUENCES) :], strict=True):
            setattr(self, name, part)

    @classmethod
    def build(cls, names: np.ndarray, root: np.ndarray, u: np.ndarray, w: np.ndarray, count: np.ndarray, words: int, universe: int) -> Trie:
        """From the distinct training trigrams in order: context (a rank in
        ``names``), the word before it, the word, and how often."""
        new = _changes(root)
        held, root = names[root[new]], np.cumsum(new) - 1
        nxt = root * words + w
        order = np.argsort(nxt)
        nxt = nxt[order]
        first = np.flatnonzero(_changes(nxt))
        nxt, c2 = nxt[first], np.add.reduceat(count[order], first)
        del order, first
        pair = root * words + u
        new = _changes(pair)
        inner, last, c3 = pair[new], (np.cumsum(new) - 1) * words + w, count
        del pair, root

        def level(key, count, contexts):
            context = key // words
            total = np.maximum(np.bincount(context, count, contexts), 1)
            types = np.bincount(context, minlength=contexts)
            return _codes((count - DISCOUNT) / total[context], A_STEP), _codes(DISCOUNT * types / total, B_STEP)

        def stacked(key, contexts):
            """Each context's words from where those before it end, and the
            pointers to its first (one more for the end)."""
            context, word = key // words, key % words
            types = np.bincount(context, minlength=contexts)
            ends = np.cumsum(types)
            size = np.where(types > 0, word[np.maximum(ends - 1, 0)] + 1, 0) if len(key) else np.zeros(contexts, np.int64)
            values = (np.cumsum(size) - size)[context] + word
            first = np.concatenate([[0], ends]) + np.arange(contexts + 1)
            return EliasFano.build(values, int(size.sum()) + 1), EliasFano.build(first, len(key) + contexts + 2)

        a2, b2 = level(nxt, c2, len(held))
        a3, b3 = level(last, c3, len(inner))
        (e2, p2), (ei, pi), (e3, p3) = stacked(nxt, len(held)), stacked(inner, len(held)), stacked(last, len(inner))
        sequences = [EliasFano.build(held, universe), e2, ei, e3, p2, pi, p3]
        parts = [p for s in sequences for p in s.parts()] + [a2, b2, a3, b3]
        size = sum(16 + -(-p.nbytes // 8) * 8 for p in parts)
        out, at = mmap.mmap(-1, max(1, size)), 0
        for p in parts:
            struct.pack_into("<qq", out, at, p.dtype == np.int64, len(p))
            out[at + 16 : at + 16 + p.nbytes] = p.tobytes()
            at += 16 + -(-p.nbytes // 8) * 8
        return cls(out, words)

    def query(self, root: np.ndarray, u: np.ndarray, w: np.ndarray, divided: np.ndarray):
        """The codes of (a, b) with p(w | u, context) = a + b * p(w), or
        a + b * p(w | context) for a divided context."""
        if len(w) > self.CHUNK:  # bounded memory, whatever the number of lookups
            cuts = [slice(i, i + self.CHUNK) for i in range(0, len(w), self.CHUNK)]
            parts = [self.query(root[i], u[i], w[i], divided[i]) for i in cuts]
            return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        at = self.root.find(root)
        top = np.where(divided, -1, at)
        nxt = successors(self.next, self.first_next, top, w)
        inner = successors(self.inner, self.first_inner, at, u)
        last = successors(self.last, self.first_last, inner, w)

        def code(codes, i, values, missing):
            return np.where(i >= 0, values[codes[np.maximum(i, 0)]] if len(codes) else missing, missing)

        a2, b2 = code(self.a_next, nxt, _A, 0.0), code(self.b_root, top, _B, 1.0)
        a3, b3 = code(self.a_last, last, _A, 0.0), code(self.b_inner, inner, _B, 1.0)
        return _codes(a3 + b3 * a2, A_STEP), _codes(b3 * b2, B_STEP)


# --- packed columns ----------------------------------------------------------------


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as byte planes, compressed; small unsigned types where they fit."""
    head, body = [], []
    for a in arrays:
        if a.dtype != U64:
            a = a.astype(next(t for t in (np.uint8, np.uint16, np.uint32) if not len(a) or a.max() <= np.iinfo(t).max))
        head.append((a.dtype.itemsize, len(a)))
        body.append(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"")
    raw = struct.pack("<q", len(arrays)) + b"".join(struct.pack("<qq", *h) for h in head) + b"".join(body)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of an ascending array; ``cumsum`` undoes it."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<q", raw, 0)
    at, out = 8 + 16 * n, []
    for k in range(n):
        width, size = struct.unpack_from("<qq", raw, 8 + 16 * k)
        planes = np.frombuffer(raw, np.uint8, width * size, at).reshape(width, size) if size else np.zeros((width, 0), np.uint8)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1))
        at += width * size
    return out


ROWS = "part int, base long, kind string, payload binary"


def _rows(rows) -> pa.RecordBatch:
    part, base, kind, payload = ([r[i] for r in rows] for i in range(4))
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(base, pa.int64()), pa.array(kind, pa.string()), pa.array(payload, pa.binary())],
        ["part", "base", "kind", "payload"],
    )


def _tokens(block):
    """(hashes, count per text): the words of each text and its end."""
    w = words(block, NON_SPACE)
    h = w.hash >> HASH_SHIFT
    return np.insert(np.where(h <= START, START + U64(1), h), np.cumsum(w.count), END), w.count + 1


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    k, at = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(at, np.concatenate(counts), len(k)).astype(np.int64)


def _unigram_shard(words: np.ndarray, shards: int, salt: np.ndarray | int = 0) -> np.ndarray:
    return (mix64(words + U64(7) + np.asarray(salt, U64) * _SALT) % U64(shards)).astype(np.int64)


def _survey(shards: int):
    """The training words of a task with their counts, by unigram shard."""

    def run(batches):
        keys, counts, held = [], [], 0

        def rows():
            k, c = _merged(keys, counts)
            target = _unigram_shard(k, shards)
            order = np.argsort(target, kind="stable")  # ascending words inside a shard
            cut = np.searchsorted(target[order], np.arange(shards + 1))
            mine = (order[cut[i] : cut[i + 1]] for i in range(shards))
            return _rows([(i, 0, "count", _pack([_steps(k[m]), c[m]])) for i, m in enumerate(mine) if len(m)])

        for block in blocks(batches, "text"):
            h, n = _tokens(block)
            train = ~np.array(block.batch.column(1).to_pylist(), bool)
            k, c = np.unique(h[np.repeat(train, n)], return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > SURVEY_WORDS:
                k, c = _merged(keys, counts)
                keys, counts, held = [k], [c], len(k)
                if held > SURVEY_WORDS // 2:
                    yield rows()
                    keys, counts, held = [], [], 0
        if keys:
            yield rows()

    return run


def _count(table: pa.Table) -> pa.Table:
    """A unigram shard's part of the vocabulary: its tokens and words, and
    the words of more than SPLIT_TOKENS occurrences."""
    got = [_unpack(x) for x in table.column("payload").to_pylist()]
    k, c = _merged([np.cumsum(g[0]) for g in got], [g[1] for g in got])
    often = c > SPLIT_TOKENS
    return pa.table(
        {
            "kind": pa.array(["n", "v", *["word"] * int(often.sum())]),
            "key": pa.array(np.concatenate([[0, 0], k[often].view(np.int64)]).astype(np.int64)),
            "n": pa.array(np.concatenate([[c.sum(), len(k)], c[often]]).astype(np.int64)),
        }
    )


class Frequent:
    """The words that are divided, with their counts, number of parts and
    number of different successors."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, floor: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.ways = -(-self.counts // max(1, floor))
        self.types = np.zeros(len(words), np.int64)

    def of(self, words: np.ndarray) -> np.ndarray:
        """The place of each word, or -1."""
        if not len(self.words):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, -1)

    def parts(self, words: np.ndarray) -> np.ndarray:
        at = self.of(words)
        return np.where(at >= 0, self.ways[at] if len(self.ways) else 1, 1)

    def whole(self, a: np.ndarray, b: np.ndarray, context: np.ndarray, count: np.ndarray):
        """The codes of a trie's answers for divided contexts, with the bigram
        level put in: ``count`` is of (context, w) over the whole corpus."""
        total = self.counts[context].astype(float)
        a2 = _A[_codes(np.maximum(count - DISCOUNT, 0) / total, A_STEP)]
        b2 = _B[_codes(DISCOUNT * self.types[context] / total, B_STEP)]
        return _codes(_A[a] + _B[b] * a2, A_STEP), _codes(_B[b] * b2, B_STEP)


def _pair_sums(words: list[np.ndarray], contexts: list[np.ndarray], counts: list[np.ndarray], n: int):
    """(words, pairs per word, context, count) of the distinct pairs, by word
    and context; contexts are numbers below ``n``."""
    k, at = np.unique(np.concatenate(words), return_inverse=True)
    key, at = np.unique(at.astype(np.int64) * n + np.concatenate(contexts), return_inverse=True)
    return k, np.bincount(key // n, minlength=len(k)), key % n, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def _pair_rows(shards: int, k, per, context, count, salt: int = 0) -> list[tuple]:
    target, at = _unigram_shard(k, shards, salt), np.cumsum(per) - per
    order = np.argsort(target, kind="stable")  # ascending words inside a shard
    cut = np.searchsorted(target[order], np.arange(shards + 1))
    rows = []
    for i in np.flatnonzero(np.diff(cut)).tolist():
        mine = order[cut[i] : cut[i + 1]]
        pairs = ragged(at[mine], per[mine])
        rows.append((i, 0, "pairs", _pack([_steps(k[mine]), per[mine], context[pairs], count[pairs]])))
    return rows


def _pairs(shards: int, frequent: Frequent):
    """The training successors of the frequent words of a task, counted, by
    the successor's unigram shard."""

    def run(batches):
        got, held, n = ([], [], []), 0, len(frequent.words)
        for block in blocks(batches, "text"):
            h, size = _tokens(block)
            train = np.repeat(~np.array(block.batch.column(1).to_pylist(), bool), size)
            context = frequent.of(h)
            at = np.flatnonzero((context >= 0) & train & (h != END))
            for x, part in zip(got, (h[at + 1], context[at], np.ones(len(at), np.int64)), strict=True):
                x.append(part)
            held += len(at)
            if held > SURVEY_WORDS:
                k, per, context, count = _pair_sums(*got, n)
                got, held = ([np.repeat(k, per)], [context], [count]), len(count)
                if held > SURVEY_WORDS // 2:
                    yield _rows(_pair_rows(shards, k, per, context, count))
                    got, held = ([], [], []), 0
        if held:
            yield _rows(_pair_rows(shards, *_pair_sums(*got, n)))

    return run


def _unpairs(blobs: list[bytes]):
    """Lists of word, context and count of packed pairs."""
    got = [_unpack(x) for x in blobs]
    return [np.repeat(np.cumsum(g[0]), g[1].astype(np.int64)) for g in got], [g[2].astype(np.int64) for g in got], [g[3] for g in got]


def _count_pairs(shards: int, frequent: Frequent):
    """A unigram shard's part of the pairs, for all shards that hold the
    word; and how many pairs each context has there."""

    def run(table: pa.Table) -> pa.Table:
        n = len(frequent.words)
        k, per, context, count = _pair_sums(*_unpairs(table.column("payload").to_pylist()), n)
        types = np.bincount(context, minlength=n)
        rows = [(c, int(types[c]), "types", None) for c in np.flatnonzero(types).tolist()]
        ways, at = frequent.parts(k), np.cumsum(per) - per
        for salt in range(int(ways.max())):
            some = ways > salt
            pairs = ragged(at[some], per[some])
            rows += _pair_rows(shards, k[some], per[some], context[pairs], count[pairs], salt)
        return pa.Table.from_batches([_rows(rows)])

    return run


def _send(n_shards: int, frequent: Frequent):
    """Each batch of texts sends every shard its trigrams, sorted."""

    def emit(batch):
        base, tokens, count, ids, held = batch
        count, held = np.concatenate(count), np.concatenate(held)
        n = len(count)
        first = np.cumsum(count) - count
        h = np.insert(np.concatenate(tokens), np.repeat(first, 2), START)
        vocabulary, s = np.unique(h, return_inverse=True)
        s = s.astype(np.int32)
        del h
        at = ragged(first + 2 * np.arange(1, n + 1), count)
        doc = np.repeat(np.arange(n, dtype=np.uint16), count)
        bits = max(1, len(vocabulary).bit_length())
        if 3 * bits <= 63:
            key = s[at - 1].astype(np.int64)
            for back in (2, 0):
                key <<= bits
                key |= s[at - back]
            del at, s
            order = np.argsort(key)
            key = key[order]
            w, u = ((key >> (k * bits)).astype(np.int32) & ((1 << bits) - 1) for k in (0, 1))
            key >>= 2 * bits
            v = key.astype(np.int32)
            del key
        else:  # a text of millions of distinct words
            order = np.lexsort((s[at], s[at - 2], s[at - 1]))
            v, u, w = (s[at - k][order] for k in (1, 2, 0))
            del at, s
        doc = doc[order]
        del order
        split, shard = np.zeros(len(v), np.int32), (mix64(vocabulary) % U64(n_shards)).astype(np.int32)[v]
        ways = frequent.parts(vocabulary)
        often = np.flatnonzero((ways > 1)[v])
        if len(often):
            part = mix64(vocabulary[u[often]]) % ways[v[often]].astype(U64)
            split[often] = part.astype(np.int32)
            shard[often] = (mix64(vocabulary[v[often]] + part * _SALT) % U64(n_shards)).astype(np.int32)
        if n_shards <= 1 << 16:
            shard = shard.astype(np.uint16)  # sorted by radix
        by = np.argsort(shard, kind="stable").astype(np.int32)
        cut = np.searchsorted(shard[by], np.arange(n_shards + 1))
        del shard
        rows, small = [], np.zeros(len(vocabulary), np.int64)
        for k in np.flatnonzero(np.diff(cut)).tolist():
            mine = by[cut[k] : cut[k + 1]]
            cols = [v[mine], u[mine], w[mine]]
            used = np.sort(np.concatenate(cols))
            used = used[_changes(used)]
            small[used] = np.arange(len(used))
            context, before, word = (small[x] for x in cols)
            before = _steps(before) % len(used)  # ascends within a context: most steps are short
            payload = _pack([_steps(vocabulary[used]), _steps(context), before, word, split[mine], doc[mine], np.packbits(held)])
            rows.append((k, base, "grams", payload))
        null = np.array([x is None for x in ids])
        known = np.array([0 if x is None else x for x in ids], np.int64).view(U64)
        # the texts themselves pass by the shards, in as many groups of their own
        rows.append((n_shards + _spread(base, n_shards), base, "docs", _pack([known, null.astype(np.int64), held.astype(np.int64), count])))
        return _rows(rows)

    def run(batches):
        batch, size = None, 0
        for block in blocks(batches, "text"):
            h, n = _tokens(block)
            ids, rows = block.batch.column(0).to_pylist(), block.batch.column(2)
            held = np.array(block.batch.column(1).to_pylist(), bool)
            if batch and (size + len(h) > BATCH_TOKENS or len(batch[3]) + len(n) > BATCH_DOCS):
                yield emit(batch)
                batch = None
            lo = 0
            while lo < len(n):  # a block of very many short texts is cut, too
                hi = min(len(n), lo + BATCH_DOCS)
                a, b = int(n[:lo].sum()), int(n[:hi].sum())
                if batch is None:
                    batch, size = (rows[lo].as_py(), [], [], [], []), 0
                batch[1].append(h[a:b])
                batch[2].append(n[lo:hi])
                batch[3].extend(ids[lo:hi])
                batch[4].append(held[lo:hi])
                size, lo = size + b - a, hi
                if lo < len(n):
                    yield emit(batch)
                    batch = None
        if batch:
            yield emit(batch)

    return run


def _spread(base: int, groups: int) -> int:
    """The group of a batch, of ``groups``."""
    return int(mix64(np.array([base], np.int64).view(U64))[0] % U64(groups))


def _answer(unigram_shards: int, frequent: Frequent):
    """A trie shard: count, build the trie, answer every occurrence."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if not rows or rows[0]["kind"] == "docs":
            parts = [_spread(r["base"], unigram_shards) for r in rows]
            return table.set_column(0, "part", pa.array(parts, pa.int32()))
        rows.sort(key=lambda r: r["base"])
        got = [_unpack(r.pop("payload")) for r in rows]
        for g in got:
            g[0], g[1] = np.cumsum(g[0]), np.cumsum(g[1].astype(np.int32), dtype=np.int32)
            g[2] = (np.cumsum(g[2], dtype=np.int64) % len(g[0])).astype(np.int32)
        vocabulary, local = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        start, local = np.cumsum([0, *(len(g[0]) for g in got)]), local.astype(np.int32)
        held = np.concatenate([np.unpackbits(g[6])[g[5].astype(np.int64)] for g in got]).astype(bool)
        batch = np.repeat(np.arange(len(got), dtype=np.uint32), [len(g[1]) for g in got])
        doc = np.concatenate([g[5] for g in got]).astype(np.uint16)
        split = np.concatenate([g[4] for g in got]).astype(np.int32)
        v, u, w = (np.concatenate([local[start[i] : start[i + 1]][g[k]] for i, g in enumerate(got)]) for k in (1, 2, 3))
        del got, local
        ways, n = int(split.max()) + 1, len(vocabulary)
        # contexts v with their split number, as ranks; all in the order (context, u, w)
        root = v.astype(np.int64) * ways + split
        roots = np.unique(root)
        root = np.searchsorted(roots, root)
        del v, split
        order = np.argsort((root * n + u) * n + w) if len(roots) * n * n < 2**63 else np.lexsort((w, u, root))
        root, u, w = root[order], u[order], w[order]
        doc, batch, held = doc[order], batch[order], held[order]
        del order
        # each distinct trigram is counted and looked up once
        new = _changes(root) | _changes(u) | _changes(w)
        which = np.cumsum(new, dtype=np.int32) - np.int32(1)
        learnt = np.bincount(which[~held], minlength=int(which[-1]) + 1)
        gr, gu, gw = root[new].astype(np.int32), u[new], w[new]
        del root, u, new
        some = learnt > 0
        trie = Trie.build(roots, gr[some], gu[some], gw[some], learnt[some], n, n * ways)
        context = frequent.of(vocabulary).astype(np.int32)[roots // ways][gr]
        a, b = trie.query(roots[gr], gu, gw, context >= 0)
        del gr, gu, gw, trie, some
        a, b = a[which], b[which]
        context = context[which]
        del which
        bases = np.array([x["base"] for x in rows], np.int64).view(U64)
        target = _unigram_shard(vocabulary, unigram_shards)[w]
        ways = frequent.parts(vocabulary)
        often = np.flatnonzero((ways > 1)[w])
        if len(often):  # a frequent word's occurrences are dealt by batch
            salt = mix64(bases[batch[often]] + U64(3)) % ways[w[often]].astype(U64)
            target[often] = _unigram_shard(vocabulary[w[often]], unigram_shards, salt)
        place = target * n
        place += w
        place *= len(rows)
        place += batch
        place <<= 16
        place |= doc
        order = np.argsort(place).astype(np.int32)  # by unigram shard, word, batch and text
        del place
        cut = np.searchsorted(target[order], np.arange(unigram_shards + 1))
        del target
        out = []
        for k in np.flatnonzero(np.diff(cut)).tolist():
            every = order[cut[k] : cut[k + 1]]
            divided = context[every] >= 0
            for mine in (every[~divided], every[divided]):
                if len(mine):
                    used, run_length = np.unique(w[mine], return_counts=True)
                    learnt = np.add.reduceat((~held[mine]).astype(np.int64), np.cumsum(run_length) - run_length)
                    cols = [bases, _steps(vocabulary[used]), run_length, learnt, batch[mine], doc[mine], a[mine], b[mine]]
                    out.append((k, 0, "words", _pack(cols + [context[mine]] * bool(context[mine[0]] >= 0))))
        return pa.Table.from_batches([_rows(out)])

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, known double, score double"


def _sum(n_train: int, vocabulary: int, frequent: Frequent):
    """A unigram shard: counts of its words, then logarithms by text, packed
    by the batch the texts came from."""

    def followers(keys: np.ndarray, blobs: list[bytes]):
        """(place of w * number of frequent words + frequent word) of the
        pairs of these words, ascending, and their counts."""
        w, context, count = ([np.zeros(1, t), *x] for t, x in zip((U64, np.int64, np.int64), _unpairs(blobs), strict=True))
        w, context, count = (np.concatenate(x)[1:] for x in (w, context, count))
        at = np.minimum(np.searchsorted(keys, w), len(keys) - 1)
        here = keys[at] == w
        key = np.concatenate([[-1], at[here] * len(frequent.words) + context[here]])  # never empty
        order = np.argsort(key)
        return key[order], np.concatenate([[0], count[here]])[order]

    def added(sums: list[tuple]):
        """Sums of each text, once."""
        row, first, at = np.unique(np.concatenate([s[0] for s in sums]), return_index=True, return_inverse=True)
        base = np.concatenate([s[1] for s in sums])[first]
        return row, base, np.array([np.bincount(at, np.concatenate([s[2][k] for s in sums])) for k in range(3)])

    def run(got: pa.Table) -> pa.Table:
        rows = got.to_pylist()
        out = [(0, r["base"], "docs", r["payload"]) for r in rows if r["kind"] == "docs"]
        blobs = [r["payload"] for r in rows if r["kind"] == "words"]
        if blobs:
            heads = [_unpack(blob)[1:4:2] for blob in blobs]
            keys, at = np.unique(np.concatenate([np.cumsum(g[0]) for g in heads]), return_inverse=True)
            learnt = np.bincount(at, np.concatenate([g[1] for g in heads]))
            place = frequent.of(keys)
            if (place >= 0).any():  # counted by the survey: here is only a part of them
                learnt = np.where(place >= 0, frequent.counts[place], learnt)
            del heads, at
            sums, n = [], len(frequent.words)
            pairs, times = followers(keys, [r["payload"] for r in rows if r["kind"] == "pairs"])
            for blob in blobs:
                bases, h, run_length, _, batch, doc, a, b, *divided = _unpack(blob)
                word = np.repeat(np.searchsorted(keys, np.cumsum(h)), run_length.astype(np.int64))
                c = learnt[word]
                if divided:
                    context = divided[0].astype(np.int64)
                    want = word * n + context
                    at = np.minimum(np.searchsorted(pairs, want), len(pairs) - 1)
                    a, b = frequent.whole(a, b, context, np.where(pairs[at] == want, times[at], 0))
                row, at = np.unique((batch.astype(np.int64) << 16) | doc, return_inverse=True)
                p = _A[a] + _B[b] * ((c + 1) / (n_train + vocabulary + 1))
                cols = [np.bincount(at, c > 0), np.bincount(at, np.log10(c + 1)), np.bincount(at, np.log10(np.minimum(p, 1)))]
                sums.append((bases.view(np.int64)[row >> 16] + (row & 0xFFFF), bases.view(np.int64)[row >> 16], np.array(cols)))
                del bases, h, run_length, batch, doc, a, b, divided, word, c, p, row, at, cols
                if sum(len(s[0]) for s in sums[1:]) > max(SUM_ROWS, len(sums[0][0])):  # a text is in many payloads
                    sums = [added(sums)]
            row, base, total = added(sums)
            for one in np.unique(base).tolist():
                m = base == one
                out.append((0, one, "sums", _pack([row[m] - one, *(t[m].view(U64) for t in total)])))
        return pa.Table.from_batches([_rows(out)])

    return run


def _totals(got: pa.Table) -> pa.Table:
    """The texts of one batch with their sums over all unigram shards."""
    rows = got.to_pylist()
    ids, null, held, count = _unpack(next(r["payload"] for r in rows if r["kind"] == "docs"))
    total = np.zeros((3, len(count)))
    for r in rows:
        if r["kind"] == "sums":
            at, *cols = _unpack(r["payload"])
            for k, c in enumerate(cols):
                total[k, at] += c.view(np.float64)
    return pa.table(
        {
            "doc_id": pa.array(ids.view(np.int64), mask=null.astype(bool)), "held_out": pa.array(held.astype(bool)),
            "n_tokens": pa.array(count.astype(np.int64)), "n_known": pa.array(np.rint(total[0]).astype(np.int64)),
            "known": pa.array(total[1]), "score": pa.array(total[2]),
        }
    )


def survey(flat: DataFrame, shards: int) -> tuple[int, int, Frequent]:
    """Training tokens, distinct training words and the frequent words of
    (doc_id, held, text)."""
    counted = flat.mapInArrow(_survey(shards), ROWS).repartitionById(shards, "part").groupBy("part").applyInArrow(_count, "kind string, key long, n long")
    counted = stage(counted, "survey")
    n_train, vocabulary = (int(counted.where(F.col("kind") == k).agg(F.sum("n")).first()[0] or 0) for k in ("n", "v"))
    floor = max(SPLIT_TOKENS, int(SPLIT_SHARE * n_train))
    often = counted.where((F.col("kind") == "word") & (F.col("n") > floor)).collect()  # at most 1 / SPLIT_SHARE words
    return n_train, vocabulary, Frequent(np.array([r["key"] for r in often], np.int64).view(U64), np.array([r["n"] for r in often], np.int64), floor)


def pair_survey(flat: DataFrame, shards: int, frequent: Frequent) -> DataFrame:
    """The training successors of the frequent words with their counts, packed
    for the unigram shards; sets ``frequent.types``."""
    counted = flat.mapInArrow(_pairs(shards, frequent), ROWS).repartitionById(shards, "part").groupBy("part").applyInArrow(_count_pairs(shards, frequent), ROWS)
    counted = stage(counted, "pairs")
    for r in counted.where("kind = 'types'").groupBy("part").agg(F.sum("base").alias("n")).collect():  # a row per frequent word
        frequent.types[r["part"]] = r["n"]
    return counted.where("kind = 'pairs'")


def score_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for every row of ``docs``.

    Learns from rows that are not held out. A null or empty text is the end
    token alone; repeated rows give repeated result rows; a null doc_id stays
    null and is learnt from; other columns are ignored; an empty table gives
    no rows. If nothing may be learnt, every count is 0 and the model is the
    add-one unigram of an empty corpus.
    """
    flat = docs.select(
        F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string")
    )
    size = int(docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0)
    n_shards = max(1, -(-size // SHARD_BYTES))
    unigram_shards = max(1, n_shards // UNIGRAM_SHARDS)
    n_train, vocabulary, frequent = survey(flat.drop("row"), unigram_shards)

    sent = flat.mapInArrow(_send(n_shards, frequent), ROWS)
    # a group's number is its partition: hashed, several would meet in one task
    answered = sent.repartitionById(2 * n_shards, "part").groupBy("part").applyInArrow(_answer(unigram_shards, frequent), ROWS)
    if len(frequent.words):
        answered = answered.unionByName(pair_survey(flat.drop("row"), unigram_shards, frequent))
    sums = answered.repartitionById(unigram_shards, "part").groupBy("part").applyInArrow(_sum(n_train, vocabulary, frequent), ROWS)
    texts = stage(sums, "sums").groupBy("base").applyInArrow(_totals, SCORES)
    return texts.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("known") - F.col("n_tokens") * math.log10(n_train + vocabulary + 1)).alias("base_score"), "score",
    )
