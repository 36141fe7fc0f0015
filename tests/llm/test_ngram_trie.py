"""The n-gram trie against a model of dictionaries, for any number of shards."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from crewload.llm import ngram_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, base string, held string, kind string, row string, part int"


def tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*WORD.findall(low), None]  # None ends a text


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def texts_of(seed, n=160):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    p = 1 / np.arange(1, 61)
    p[0] = p.sum()  # one word holds a third of all tokens and more
    p /= p.sum()
    out = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 40), p=p))) for i in range(n)]
    out += [(n + 1, None), (n + 2, ""), (n + 3, " \t A a É é"), (None, "w1 w2 new"), (n + 4, " ".join(f"x{i}" for i in range(3000)))]
    return out + [out[3]] * 4  # repeated rows


def model_scores(docs):
    """Per row: tokens, known, base and score, without quantisation."""
    d = ngram_trie.DISCOUNT
    c1, c2, c3 = Counter(), defaultdict(Counter), defaultdict(Counter)
    for i, text in docs:
        if not is_held(i):
            t = ["<s>", "<s>", *tokens(text)]
            for u, v, w in zip(t, t[1:], t[2:]):
                c1[w] += 1
                c2[v][w] += 1
                c3[u, v][w] += 1
    n, size = sum(c1.values()), len(c1)
    out = []
    for i, text in docs:
        t, score, base = ["<s>", "<s>", *tokens(text)], 0.0, 0.0
        for u, v, w in zip(t, t[1:], t[2:]):
            p = (c1[w] + 1) / (n + size + 1)
            base += math.log10(p)
            for counts in (c2.get(v), c3.get((u, v))):
                if counts:
                    total = sum(counts.values())
                    p = max(0, counts[w] - d) / total + d * len(counts) / total * p
            score += math.log10(min(p, 1))
        out.append((i, is_held(i), len(t) - 2, sum(c1[w] > 0 for w in t[2:]), n, base, score))
    return out


def scored(spark, docs):
    df = spark.createDataFrame([(i, t, "b", "h", "k", "r", 1) for i, t in docs], DOC).repartition(4)
    return sorted((tuple(r) for r in ngram_trie.score_texts(df).collect()), key=lambda r: (r[0] is None, r[0] or 0))


@pytest.fixture(scope="module")
def docs():
    return texts_of(1)


def test_scores_match_a_model_of_dictionaries(spark, docs):
    want = sorted(model_scores(docs), key=lambda r: (r[0] is None, r[0] or 0))
    for got, w in zip(scored(spark, docs), want, strict=True):
        assert got[:5] == w[:5]
        assert got[5] == pytest.approx(w[5], abs=1e-6)
        assert got[6] == pytest.approx(w[6], abs=0.06 * w[2])  # a byte per weight: up to a few hundredths a token


@pytest.mark.parametrize("split", [1 << 20, 200])
def test_the_model_is_the_same_for_any_number_of_shards(spark, docs, monkeypatch, split):
    monkeypatch.setattr(ngram_trie, "SPLIT_TOKENS", split)
    found = []
    for shard_bytes in (14 << 20, 4_000, 700):
        monkeypatch.setattr(ngram_trie, "SHARD_BYTES", shard_bytes)
        found.append(scored(spark, docs))
    for other in found[1:]:
        for a, b in zip(found[0], other, strict=True):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)
    want = sorted(model_scores(docs), key=lambda r: (r[0] is None, r[0] or 0))
    assert [r[:5] for r in found[-1]] == [w[:5] for w in want]  # a divided word keeps its exact count
    assert [r[5] for r in found[-1]] == pytest.approx([w[5] for w in want])


@pytest.mark.parametrize("shard_bytes", [14 << 20, 4_000])
def test_dividing_frequent_words_changes_no_score(spark, docs, monkeypatch, shard_bytes):
    monkeypatch.setattr(ngram_trie, "SHARD_BYTES", shard_bytes)
    whole = scored(spark, docs)
    for split in (1_000, 200, 20):  # one, a few and most words are divided
        monkeypatch.setattr(ngram_trie, "SPLIT_TOKENS", split)
        for a, b in zip(whole, scored(spark, docs), strict=True):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)


def test_small_batches_and_wide_ranks_change_nothing(spark, docs, monkeypatch):
    whole = scored(spark, docs)
    monkeypatch.setattr(ngram_trie, "BATCH_TOKENS", 50)
    monkeypatch.setattr(ngram_trie, "BATCH_DOCS", 3)
    monkeypatch.setattr(ngram_trie, "SURVEY_WORDS", 20)
    for a, b in zip(whole, scored(spark, docs), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-9)


def test_empty_and_held_out_only(spark):
    assert scored(spark, []) == []
    held = next(i for i in range(100) if is_held(i))
    (row,) = scored(spark, [(held, "a b")])
    assert row[:5] == (held, True, 3, 0, 0) and row[5] == row[6] == 0.0


@pytest.mark.parametrize("universe", [1, 100, 5_000, 1 << 40])
def test_elias_fano_round_trip(universe):
    rng = np.random.default_rng(universe % 97)
    values = np.unique(rng.integers(0, universe, 1000))
    seq = ngram_trie.EliasFano.build(values, universe)
    seq = ngram_trie.EliasFano.of(seq.parts())
    assert (seq.get(np.arange(len(values))) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe, 1000)])
    place = {int(v): i for i, v in enumerate(values)}
    assert seq.find(asked).tolist() == [place.get(int(v), -1) for v in asked]


def test_successors_search_between_pointers():
    rng = np.random.default_rng(8)
    key = np.unique(rng.integers(0, 40 * 50, 600))  # context * 50 + word; some contexts are empty
    key = key[(key // 50) % 7 != 3]
    n, w = 50, key % 50
    grams = ngram_trie.Trie.build(np.arange(40), key // n, w, w, np.ones(len(key), np.int64), n, 40)
    held = np.unique(key // n)
    context = np.repeat(np.arange(-1, len(held)), n)
    word = np.tile(np.arange(n), len(held) + 1)
    got = ngram_trie.successors(grams.next, grams.first_next, context, word)
    place = {int(k): i for i, k in enumerate(key)}
    assert got.tolist() == [place.get(int(held[c]) * n + x, -1) if c >= 0 else -1 for c, x in zip(context.tolist(), word.tolist())]
