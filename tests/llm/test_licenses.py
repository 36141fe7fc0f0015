"""Licence scan against plain Python: base places of whole tables, changed and
torn notices, odd rows."""

import re

import numpy as np
import pytest
from conftest import SF_SMALL
from crewload.llm import licenses, queries
from crewload.llm.words import Block

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
DOC = "doc_id long, text string, word string, n long, labels string, score double"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "w", 1, "l", 0.5) for i, t in texts], DOC)


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    at = sorted((i, label) for p, label in BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_base_columns_match_brute_force(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op8_license_index(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == {i: base(t) for i, t in text.items()}
    assert len(got) == len(text) and all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def share(index, words, k):
    """The share of notice k's weight in place, by the definition: any
    alignment that puts a looked up word where it belongs."""
    notice = licenses.NOTICES[k].phrase.split()
    idf = dict(zip(licenses.WORDS, index.idf, strict=True))
    total = sum(idf[w] for w in notice)
    mine = sorted({w for w in words if w in notice}, key=lambda w: (-idf[w], licenses.WORDS.index(w)))
    left = sum(idf[w] * notice.count(w) for w in mine)
    if left < licenses.COVER * total:
        return 0.0
    rare = []
    for w in mine:
        rare.append(w)
        left -= idf[w] * notice.count(w)
        if left < licenses.COVER * total:
            break
    best = 0.0
    for start in {i - o for i, w in enumerate(words) if w in rare for o, x in enumerate(notice) if x == w}:
        near = lambda o: words[max(0, start + o - licenses.SLACK) : max(0, start + o + licenses.SLACK + 1)]  # noqa: B023, E731
        best = max(best, sum(idf[x] for o, x in enumerate(notice) if x in near(o)) / total)
    return best


def test_notices_match_brute_force():
    rng = np.random.default_rng(2)
    index = licenses.Index({w: int(rng.integers(0, 50)) for w in licenses.WORDS}, 100)
    hit = 0
    for trial in range(60):
        k = trial % len(licenses.NOTICES)
        words = licenses.NOTICES[k].phrase.split()
        for _ in range(rng.integers(0, len(words) // 2)):
            i = int(rng.integers(0, len(words)))
            [lambda: words.pop(i), lambda: words.insert(i, "xyzzy"), lambda: words.__setitem__(i, "plugh")][rng.integers(0, 3)]()  # noqa: B023
        words = ["one", "the", *words, "license", "two"]
        data = np.frombuffer(" ".join(words).encode(), np.uint8)
        w, number, _ = index.places(Block(data, np.array([0, len(data)]), None))
        want = [share(index, words, j) for j in range(len(licenses.NOTICES))]
        got = {j: s for _, j, s in index.found(w, number)}
        assert got == pytest.approx({j: s for j, s in enumerate(want) if s >= licenses.COVER})
        hit += k in got
    assert 20 < hit < 60  # some are changed too much


def test_changed_notices_get_their_label(spark):
    mit, apache, zlib = (next(t.phrase for t in licenses.NOTICES if t.label == x) for x in ("mit", "apache-2", "zlib"))
    words = mit.split()
    torn = " ".join(w for i, w in enumerate(words) if i not in (3, 70))  # the phrase of its first line is not whole
    lines = "# " + apache.replace("0 ", "0,\n# ").replace("LICENSE", "License")
    named = zlib.replace("alter it and", "alter it (c) Someone and").upper()
    texts = [(1, "x " * 500 + torn), (2, lines), (3, named), (4, " ".join(words[::-1])), (5, " ".join(words[:20])), (6, "software " * 3000)]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(docs_of(spark, texts)).collect()}
    assert [got[i][0] for i in range(1, 7)] == ["mit", "apache-2", "zlib", "", "mit" if "mit" in got[5][0] else "", ""]
    assert got[1][1] > 0.9 and got[6][1] == 0


def test_odd_rows(spark):
    long = "under the mit license " * 20_000
    got = licenses.scan_licenses(docs_of(spark, [(1, None), (2, ""), (3, long), (3, long), (None, "CC-BY-NC")])).collect()
    rows = sorted((r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got)
    assert rows[0] == (0, 3, 1, 0, 0, "cc-by-nc") and rows[3] == rows[4] == (3, 80_000, 20_000, 0, 79_996, "mit")
    assert rows[1] == (1, 0, 0, None, None, "") and rows[2] == (2, 0, 0, None, None, "")
    assert licenses.scan_licenses(docs_of(spark, [])).collect() == []
