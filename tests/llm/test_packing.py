"""Packing against a plain tokeniser: ids, cuts, places."""

import random
import zlib

import numpy as np
import pytest
from crewload.llm import packing

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, piece string, length string, rank int, nth int, grp int"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def odd_texts(n):
    rng = random.Random(1)
    parts = [*"aBz.,;:!?'()\n\n\t  09-é 　中\u0085ñ", "'s", "n't", "<|endoftext|>", "\r\n", " word", "Word.", " two, "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def check(rows, texts, plain, size):
    """Every row of the contract, for documents (id, text)."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in texts:
        ids, at = plain(text), 0
        mine = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(-(-len(ids) // size)))
        for r in mine:
            assert (r.start, r.ids_crc32) == (at, crc(ids[at : at + r.length]))
            assert r.length == size or r.piece == 0
            at += r.length
        assert at == len(ids)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in bins.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= size


def test_pieces_match_a_plain_tokeniser(spark, plain):
    texts = list(enumerate([None, "", *odd_texts(1500), "one two " * 900, "x" * 3000, "\n" * 500]))
    df = spark.createDataFrame([(i, t, "p", "l", 1, 2, 3) for i, t in texts], DOC).repartition(3)
    for size in (8, 2048):
        check(packing.pack(df, PATH, size).collect(), texts, plain, size)


def test_repeated_and_null_ids_and_an_empty_table(spark, plain):
    rows = [(1, "a b c", "p", "l", 1, 2, 3)] * 3 + [(None, "d e", "p", "l", 1, 2, 3)] * 2
    got = packing.pack(spark.createDataFrame(rows, DOC), PATH, 16).collect()
    assert sorted((r.doc_id or 0, r.ids_crc32) for r in got) == sorted([(1, crc(plain("a b c")))] * 3 + [(0, crc(plain("d e")))] * 2)
    assert len({(r.sequence_id, r.offset) for r in got}) == 5
    assert packing.pack(spark.createDataFrame([], DOC), PATH, 16).collect() == []


def block(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])


@pytest.mark.parametrize("cache", [8, 512])
def test_a_small_cache_changes_nothing(monkeypatch, plain, cache):
    monkeypatch.setattr(packing, "CACHE", cache)  # emptied again and again, or too small for a block
    chunks = packing._Chunks(PATH)
    for seed in range(4):
        texts = odd_texts(60 + seed)
        ids, count = chunks.ids_of(*block(texts))
        assert ids.tolist() == [i for t in texts for i in plain(t)[:-1]] and count.tolist() == [len(plain(t)) - 1 for t in texts]


def test_chunks_of_one_hash_are_told_apart(monkeypatch, plain):
    monkeypatch.setattr(packing, "hash_spans", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    chunks = packing._Chunks(PATH)
    texts = odd_texts(200)
    ids, _ = chunks.ids_of(*block(texts))
    assert ids.tolist() == [i for t in texts for i in plain(t)[:-1]]


def test_bins_near_the_lower_bound(spark):
    rng = np.random.default_rng(0)
    for count in (np.bincount(rng.integers(1, 65, 3000), minlength=65), np.bincount([64] * 5 + [33] * 9 + [1] * 3, minlength=65)):
        bins = packing.plan_bins(count, 64)
        need = -(-int((count * np.arange(65)).sum()) // 64)
        halves = int(count[33:].sum())  # pieces over half a bin never share one
        assert sum(r for _, r in bins) <= max(need * 1.02 + 1, halves + 1)
