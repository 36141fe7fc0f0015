"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Only a piece's length matters to the packing, and there are at most
``max_tokens`` lengths, so the plan is made on the histogram of lengths: a
bin is filled greedily with the longest pieces that fit, then its smallest
piece is replaced by two unpacked ones that fill the widened gap more
tightly. The same bin is repeated as long as its pieces last, so the plan has
a size bound set by ``max_tokens`` alone, not by the corpus. Spark then ranks
the pieces of each length (in hashed groups, with a running count over the
groups, so a length that holds a third of all rows is still spread) and each
piece reads its sequence and offset from the plan.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .words import blocks, hash_spans, ragged

MAX_TOKENS = 2048
GROUP_ROWS = 8192  # rows of one ranking group, about
CACHE = 1 << 20  # distinct chunks whose ids a Python worker remembers
CACHE_IDS = 6 << 20  # and their ids
JOIN = 64  # chunks tokenised as one text
CHUNK_BYTES = 1 << 19  # text bytes taken at a time
ENCODE_TEXTS = 256  # texts tokenised at a time: their encodings take some 100 bytes an id

#: First bytes of characters that are no white space (one- and two-byte ones).
_SOLID = np.zeros(256, bool)
_SOLID[[*range(0x21, 0x7F), *range(0xC3, 0xE0)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True


def chunk_starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Places where texts may be cut without a change of their ids.

    The byte-level pre-tokeniser looks at no character before a unit, and a
    unit always starts at a space before a non-space, at a stop after an
    ASCII letter, and on both sides of a single line end between non-spaces.
    """
    cut = np.zeros(len(data), bool)
    now, after = data[:-1], data[1:]
    cut[:-1] = (now == 0x20) & _SOLID[after]
    cut[1:] |= _LETTER[now] & _STOP[after]
    if len(data) > 2:
        solid = _SOLID & (np.arange(256) < 0x7F)
        single = (data[1:-1] == 0x0A) & solid[data[:-2]] & _SOLID[data[2:]]
        cut[1:-1] |= single
        cut[2:] |= single
    # none of these looks across a text's end: every text starts a chunk, and
    # one cut before its last byte would miss what follows
    full = offs[1:] > offs[:-1]
    cut[offs[1:][full] - 1] &= data[offs[1:][full] - 1] != 0x20
    first, last = offs[:-1][full], offs[1:][full]
    long = last - first > 1
    lone = last[long] - 1
    cut[lone] &= data[lone] != 0x0A
    cut[first] = True
    return np.flatnonzero(cut)


class _Chunks:
    """Token ids of chunks of text; grows as chunks are met, so that each
    distinct chunk is tokenised once (as long as it is remembered).

    An open-addressing table of chunk hashes; bytes, ids and sizes lie in
    buffers that only grow. A hash alone is never trusted: the bytes are
    compared, and a chunk that differs is tokenised by itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(max(vocabulary.values(), default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)  # byte-level: a character for each byte
        self.slots = np.empty(4 * CACHE, np.int32)
        self.key = np.empty(CACHE, np.uint64)
        self.start, self.size = np.empty(CACHE, np.int32), np.empty(CACHE, np.int32)
        self.text_start, self.text_size = np.empty(CACHE, np.int64), np.empty(CACHE, np.int32)
        self.ids, self.text = np.empty(1 << 20, np.uint32), np.empty(1 << 22, np.uint8)
        self.clear()

    def clear(self) -> None:
        self.slots.fill(-1)
        self.n = self.n_ids = self.n_text = 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The row of each hash, or -1."""
        mask = np.uint64(len(self.slots) - 1)
        slot = (h & mask).astype(np.int64)
        row = self.slots[slot]
        todo = np.flatnonzero((row >= 0) & (self.key[row] != h))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & int(mask)
            r = self.slots[slot[todo]]
            row[todo] = r
            todo = todo[(r >= 0) & (self.key[r] != h[todo])]
        return row

    def _add(self, h: np.ndarray, rows: np.ndarray) -> None:
        """Enter rows of distinct new hashes."""
        mask = len(self.slots) - 1
        slot, todo = (h & np.uint64(mask)).astype(np.int64), np.arange(len(h))
        while len(todo):
            free = self.slots[slot[todo]] < 0
            mine = todo[free]
            self.slots[slot[mine]] = rows[mine]  # of several the last one stays
            todo = todo[self.slots[slot[todo]] != rows[todo]]
            slot[todo] = (slot[todo] + 1) & mask

    @staticmethod
    def _room(buffer: np.ndarray, n: int) -> np.ndarray:
        return buffer if n <= len(buffer) else np.concatenate([buffer, np.empty(max(n - len(buffer), len(buffer)), buffer.dtype)])

    def _ids(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids joined, ids per text) of texts that lie one after another."""
        offs = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        texts = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offs), pa.py_buffer(raw))
        ids, count = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(size), ENCODE_TEXTS):
            some = texts.slice(lo, ENCODE_TEXTS).to_pylist()
            got = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            count.append(np.fromiter(map(len, got), np.int64, len(got)))
            ids.append(np.fromiter(chain.from_iterable(got), np.uint32, int(count[-1].sum())))
        return np.concatenate(ids), np.concatenate(count)

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids joined, ids per chunk, bytes joined) of byte spans. Chunks
        that start with a space before a non-space start a unit after any
        text, so ``JOIN`` of them are tokenised as one; the bytes of each id
        tell where its chunk ends."""
        size = ends - starts
        raw = data[ragged(starts, size)]
        at = np.cumsum(size) - size
        free = (raw[at] == 0x20) & (size > 1)
        free[free] = _SOLID[raw[at[free] + 1]]
        alone, many = np.flatnonzero(~free), np.flatnonzero(free)
        own, count_alone = self._ids(raw[ragged(at[alone], size[alone])], size[alone])
        if not len(many):
            return own, count_alone, raw
        joined = np.add.reduceat(size[many], np.arange(0, len(many), JOIN))
        ids, _ = self._ids(raw[ragged(at[many], size[many])], joined)
        reached = np.cumsum(self.n_bytes[ids])
        last = np.searchsorted(reached, stops := np.cumsum(size[many]))
        if not np.array_equal(reached[last], stops):
            raise ValueError("the tokeniser joins bytes across a space")
        count = np.zeros(len(size), np.int64)
        count[alone], count[many] = count_alone, np.diff(last, prepend=-1)
        out, to = np.empty(int(count.sum()), np.uint32), np.cumsum(count) - count
        out[ragged(to[alone], count_alone)], out[ragged(to[many], count[many])] = own, ids
        return out, count, raw

    def _learn(self, data, starts, ends, h) -> None:
        ids, count, raw = self._encode(data, starts, ends)
        n, size = len(h), ends - starts
        if self.n + n > CACHE or self.n_ids + len(ids) > CACHE_IDS:
            self.clear()
            if n > CACHE or len(ids) > CACHE_IDS:
                return  # a block of more than the cache: tokenised chunk by chunk below
        self.ids, self.text = self._room(self.ids, self.n_ids + len(ids)), self._room(self.text, self.n_text + len(raw))
        self.ids[self.n_ids : self.n_ids + len(ids)], self.text[self.n_text : self.n_text + len(raw)] = ids, raw
        at = slice(self.n, self.n + n)
        self.key[at], self.size[at], self.text_size[at] = h, count, size
        self.start[at], self.text_start[at] = self.n_ids + np.cumsum(count) - count, self.n_text + np.cumsum(size) - size
        self._add(h, np.arange(self.n, self.n + n, dtype=np.int32))
        self.n, self.n_ids, self.n_text = self.n + n, self.n_ids + len(ids), self.n_text + len(raw)

    def _same(self, row: np.ndarray, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the remembered chunks have these bytes."""
        same = self.text_size[row] == size
        at = np.flatnonzero(same)
        mine, theirs = ragged(starts[at], size[at]), ragged(self.text_start[row[at]], size[at])
        differ = data[mine] != self.text[theirs]
        if differ.any():
            same[at[np.searchsorted(np.cumsum(size[at]), np.flatnonzero(differ), "right")]] = False
        return same

    def ids_of(self, data: np.ndarray, offs: np.ndarray):
        """(ids of all texts joined, ids per text)."""
        starts = chunk_starts(data, offs)
        ends = np.append(starts[1:], len(data))
        doc = np.searchsorted(offs, starts, "right") - 1
        h = hash_spans(data, starts, ends)
        row = self._find(h)
        new = np.flatnonzero(row < 0)
        if len(new):
            distinct, first = np.unique(h[new], return_index=True)
            self._learn(data, starts[new[first]], ends[new[first]], distinct)
            row = self._find(h)  # all again: the cache may have been emptied
        span = (ends - starts).astype(np.int64)
        odd = row < 0
        odd[~odd] = ~self._same(row[~odd], data, starts[~odd], span[~odd])
        if not odd.any():
            size = self.size[row].astype(np.int64)
            return self.ids[ragged(self.start[row].astype(np.int64), size)], np.bincount(doc, size, len(offs) - 1).astype(np.int64)
        ids, size = self._mixed(data, starts, ends, row, odd)
        return ids, np.bincount(doc, size, len(offs) - 1).astype(np.int64)

    def _mixed(self, data, starts, ends, row, odd):
        """Ids where some chunks are not (rightly) remembered."""
        own, count, _ = self._encode(data, starts[odd], ends[odd])
        size = np.zeros(len(row), np.int64)
        size[~odd], size[odd] = self.size[row[~odd]], count
        at = np.cumsum(size) - size
        ids = np.empty(int(size.sum()), np.uint32)
        ids[ragged(at[odd], count)] = own
        ids[ragged(at[~odd], size[~odd])] = self.ids[ragged(self.start[row[~odd]].astype(np.int64), size[~odd])]
        return ids, size


def _chunk_cache(path: str) -> _Chunks:
    """One cache per Python worker: kept in a module that outlives the task."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_chunks_by_file", {})
    if path not in held:
        held[path] = _Chunks(path)
    return held[path]


def _pieces(path: str, max_tokens: int):
    def run(batches):
        chunks = _chunk_cache(path)
        for block in blocks(batches, "text", CHUNK_BYTES):
            ids, count = chunks.ids_of(block.data, block.offs)
            ids = np.insert(ids, np.cumsum(count), 0)  # id 0 ends every document
            total = count + 1
            n = -(-total // max_tokens)
            doc = np.repeat(np.arange(len(block)), n)
            piece = ragged(np.zeros(len(n), np.int64), n)
            head = total - (n - 1) * max_tokens  # the first piece may be shorter
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * max_tokens)
            length = np.where(piece == 0, head[doc], max_tokens)
            base = (np.cumsum(total) - total)[doc] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + b)]) for a, b in zip(base.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [block.batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32). A document
    is its ids and then id 0; only longer ones are cut, so that all pieces but
    the first have ``max_tokens`` ids."""
    flat = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return flat.mapInArrow(_pieces(tokenizer_path, max_tokens), schema)


def plan_bins(count: np.ndarray, size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins for ``count[length]`` pieces of each length up to ``size``:
    [([(length, pieces), ...], how many such bins), ...]."""
    count = np.asarray(count, np.int64).copy()
    bins = []
    while True:
        have = np.flatnonzero(count)
        if not len(have):
            return bins
        left, gap, inside = count.copy(), size, {}
        for length in have[::-1].tolist():  # greedily, the longest that fits
            n = min(int(left[length]), gap // length)
            if n:
                inside[length], gap = n, gap - n * length
                left[length] -= n
            if not gap:
                break
        smallest = min(inside)
        if gap and left.any():
            pair = _best_two(left, gap + smallest)
            if pair and sum(pair) > smallest:
                inside[smallest] -= 1
                for length in pair:
                    inside[length] = inside.get(length, 0) + 1
        inside = {k: n for k, n in inside.items() if n}
        repeat = min(int(count[k]) // n for k, n in inside.items())
        for k, n in inside.items():
            count[k] -= n * repeat
        bins.append((sorted(inside.items(), reverse=True), repeat))


def _best_two(left: np.ndarray, room: int) -> tuple[int, int] | None:
    """The two remaining lengths with the largest sum that fits ``room``."""
    have = np.flatnonzero(left[: room + 1])
    if not len(have):
        return None
    other = np.searchsorted(have, np.minimum(room - have, have - 1), "right") - 1
    total = np.where(other >= 0, have + have[np.maximum(other, 0)], -1)
    twice = (left[have] >= 2) & (2 * have <= room)
    total = np.where(twice & (2 * have > total), 2 * have, total)
    i = int(total.argmax())
    return (int(have[i]), int(total[i] - have[i])) if total[i] >= 0 else None


def _place(plan: dict[int, np.ndarray]):
    """plan: by length, rows (first rank, pieces per bin, first bin, offset)."""

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            seq, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length).tolist():
                at, rows = np.flatnonzero(length == size), plan[size]
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                inner = rank[at] - row[:, 0]
                seq[at] = row[:, 2] + inner // row[:, 1]
                offset[at] = row[:, 3] + inner % row[:, 1] * size
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(seq), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return run


def pack(docs: DataFrame, tokenizer_path: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32,
    sequence_id, offset); sequences hold at most ``max_tokens`` ids, their
    pieces stand gapless from offset 0.

    A null or empty text is a document of the single id 0. Repeated rows are
    packed each; a null doc_id stays null; other columns are ignored; an empty
    table gives no rows.
    """
    pieces = stage(token_pieces(docs, tokenizer_path, max_tokens), "pieces")
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most max_tokens rows
    count = np.zeros(max_tokens + 1, np.int64)
    for row in histogram:
        count[row["length"]] = row["n"]
    used, first_bin, plan = np.zeros(max_tokens + 1, np.int64), 0, {}
    for inside, repeat in plan_bins(count, max_tokens):
        offset = 0
        for length, n in inside:
            plan.setdefault(length, []).append((used[length], n, first_bin, offset))
            used[length] += n * repeat
            offset += n * length
        first_bin += repeat
    plan = {length: np.array(rows, np.int64) for length, rows in plan.items()}

    groups = max(1, -(-int(count.sum()) // GROUP_ROWS))
    grouped = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = grouped.groupBy("length", "grp").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(
        "length",
        "grp",
        (F.sum("n").over(Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"),
    )
    order = Window.partitionBy("length", "grp").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = grouped.withColumn("nth", F.row_number().over(order) - 1).join(before, ["length", "grp"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(
        _place(plan), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
