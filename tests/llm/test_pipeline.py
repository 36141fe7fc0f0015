"""The stages of the pipeline against brute force on small fixtures."""

import re
from itertools import combinations

import corpus_pipeline as pipeline
import numpy as np
import pytest
from crewload.llm import queries, secrets

DOC = "doc_id long, text string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in texts], DOC)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_near_dedup_stage_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = []
    for group in range(30):  # copies with one to seven words changed
        base = [f"g{group}w{x}" for x in rng.integers(0, 10**6, 140)]
        texts.append((len(texts), " ".join(base)))
        for changed in range(1, 8):
            w = list(base)
            for k in rng.choice(140, changed, replace=False):
                w[k] = f"x{len(texts)}y{k}"
            if rng.random() < 0.4:
                texts.append((len(texts), " ".join(w)))
    sets, label, between = {i: shingles(t) for i, t in texts}, {i: i for i, _ in texts}, 0
    for a, b in combinations(sets, 2):
        n = len(sets[a] & sets[b])
        share = 100 * n / (len(sets[a]) + len(sets[b]) - n)
        between += 80 <= share < 85
        if share >= 80:
            x, y = sorted((label[a], label[b]))
            label = {k: x if v == y else v for k, v in label.items()}
    assert between > 5
    got = pipeline.near_dedup_stage(spark, docs_of(spark, [*texts, (0, texts[0][1]), (None, "no id"), (900, None)]), "")
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == sorted({*label.values(), 900})
    assert got.where("doc_id is null").count() == 1 and got.columns == ["doc_id", "text", "n_chars"]


def test_decontamination_stage_matches_brute_force(spark, tmp_path):
    ask = "If the {} walks {} km every morning and then rides a bus for {} minutes how far has it gone after the whole long week ends"
    items = [ask.format("dog", 5, 20), "Count every apple that lies under the old tree by the river and tell us how many of them are left"]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rng = np.random.default_rng(7)
    texts = []
    for i in range(30):
        parts = [" ".join(rng.choice(WORDS, 30)) + "." for _ in range(3)]
        if i % 3 == 0:
            parts.insert(1, items[i % 2] + ".")
        if i % 4 == 0:
            parts.append(ask.format("dog", 5 + i, 20 + i) + ".")
        texts.append((i, " ".join(parts)))
    slots = [re.compile(re.sub(r"[0-9]+", "[0-9]+", x)) for x in items]
    want = [i for i, t in texts if not any(s.search(t) for s in slots)]
    got = pipeline.decontamination_stage(spark, docs_of(spark, [*texts, (90, None)]), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == [*want, 90]


def test_secrets_stage_matches_brute_force(spark):
    token = "A" * 30 + secrets._base62_crc("A" * 30)
    texts = [(1, f"\u00e9 password: abcdef and ghp_{token} end"), (2, "nothing here"), (3, None), (None, "token = abcdefgh")]
    want = {1: "\u00e9 [SECRET] and [SECRET] end", 2: "nothing here", 3: None, None: "[SECRET]"}
    got = pipeline.secrets_stage(spark, docs_of(spark, texts), "").collect()
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_quality_stage_keeps_the_good(spark, tmp_path):
    good = [(i, " ".join(WORDS[(i + k) % 19] for k in range(60)) + ".") for i in range(120)]
    junk = [(200 + i, " ".join(WORDS[(i + k) % 19].upper() + "!!" for k in range(60))) for i in range(40)]
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in good + junk], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = pipeline.quality_stage(spark, docs_of(spark, good + junk), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == list(range(120))


def test_packing_stage_matches_brute_force(spark):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    texts = [(i, " ".join(WORDS[(i * k) % 19] for k in range(40 * i))) for i in range(1, 60)]
    got = pipeline.packing_stage(spark, docs_of(spark, texts), "").collect()
    for i, text in texts:
        assert sum(r.length for r in got if r.doc_id == i) == len(t.encode(text, add_special_tokens=False).ids) + 1
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)  # gapless
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048
