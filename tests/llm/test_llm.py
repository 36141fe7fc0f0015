"""The llm operators on small fixtures: brute force, round trips, odd rows."""

import re
from itertools import combinations

import numpy as np
import pytest
from crewload.llm import chat, decontaminate, extract, licenses, minhash, ngram_trie, packing, perplexity, quality, secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, source string, key string, rank int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "s", "k", 1) for i, t in texts], DOC)


def odd_rows(spark):
    long = " ".join(WORDS[i % 19] + str(i) for i in range(30_000))
    return docs_of(spark, [(1, None), (2, ""), (3, long), (3, long), (None, "one two three four five six"), (4, "a b")])


def shingles(text, n=5):
    w = WORD.findall(text.lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = [str(x) for x in rng.integers(0, 10**6, 140)]
    texts = [(0, " ".join(base))]
    for i in range(1, 90):  # near copies around the threshold
        w = list(base)
        for k in rng.integers(0, len(w), rng.integers(0, 9)):
            w[k] = f"x{i}y{k}"
        texts.append((i, " ".join(w)))
    sets = {i: shingles(t) for i, t in texts}
    label = {i: i for i in sets}
    for a, b in combinations(sets, 2):
        n = len(sets[a] & sets[b])
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((label[a], label[b]))
            label = {k: x if v == y else v for k, v in label.items()}
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == label


def test_near_duplicates_odd_rows(spark):
    got = minhash.near_duplicates(odd_rows(spark)).collect()
    assert len(got) == 6 and all(r.kept for r in got)
    assert {r.doc_id: r.n_shingles for r in got}[2] == 0
    assert minhash.near_duplicates(docs_of(spark, [])).collect() == []


def test_bins_are_full_and_within_size():
    count = np.bincount(np.random.default_rng(0).integers(1, 2049, 5000), minlength=2049)
    bins = packing.plan_bins(count, 2048)
    used = np.zeros(2049, int)
    for inside, repeat in bins:
        assert sum(k * n for k, n in inside) <= 2048
        for k, n in inside:
            used[k] += n * repeat
    assert (used == count).all()
    assert sum(r for _, r in bins) <= -(-int((count * np.arange(2049)).sum()) // 2048) * 1.01 + 1


def test_chunked_ids_equal_whole_texts(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = ["a  b\n c", " lead", "trail  ", "don't é ñ x <|endoftext|> 　 z", "", "one two  three\t four"]
    got = packing.pack(docs_of(spark, list(enumerate(texts))), public.path("byte_bpe_50k.json"), 8).collect()
    for i, text in enumerate(texts):
        assert sum(r.length for r in got if r.doc_id == i) == len(t.encode(text, add_special_tokens=False).ids) + 1


def test_secrets_checksums_and_redaction(spark):
    body = "A" * 30
    good = "ghp_" + body + secrets._base62_crc(body)
    texts = [(1, f"é password: abcdef {good}"), (2, "ghp_" + "B" * 36), (3, "token=abc"), (4, None)]
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.find_secrets(docs_of(spark, texts)).collect()}
    assert found[1] == [("assign", 2, 18), ("github", 19, 19 + len(good))]
    assert found[2] == found[3] == found[4] == []
    out = {r.doc_id: r.text for r in secrets.redact_secrets(docs_of(spark, texts)).collect()}
    assert out[1] == "é [SECRET] [SECRET]" and out[4] is None


def test_openssh_and_encrypted_keys_are_redacted(spark):
    import base64

    def field(x):
        return len(x).to_bytes(4, "big") + x

    def pem(name, raw, head="", end="\n"):
        body = base64.b64encode(raw).decode()
        lines = end.join(body[i : i + 64] for i in range(0, len(body), 64))
        return f"-----BEGIN {name}PRIVATE KEY-----{end}{head}{lines}{end}-----END {name}PRIVATE KEY-----"

    def ssh(keys, private=b"p" * 70):
        return b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + keys.to_bytes(4, "big") + field(b"k" * 51) * keys + field(private)

    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,{}\n\n"
    iv, cipher = "0123456789ABCDEF" * 2, bytes(range(16, 128))
    keys = [
        pem("OPENSSH ", ssh(1)), pem("OPENSSH ", ssh(2)), pem("OPENSSH ", ssh(1), end="\r\n"), pem("RSA ", cipher, head.format(iv)),
        pem("RSA ", cipher, head.format(iv).replace("\n", "\r\n"), "\r\n"), pem("RSA ", cipher, " ".join(head.format(iv).split()) + " ", " "),
        pem("DSA ", cipher, head.replace("AES-128-CBC", "DES-EDE3-CBC").format(iv[:16])), pem("EC ", b"\x30\x03abc", "Comment: mine\n"),
        pem("", b"\x30\x03abc"),
    ]
    odd = [pem("OPENSSH ", ssh(1) + b"x"), pem("OPENSSH ", ssh(1)[:40]), pem("OPENSSH ", ssh(0)[:50]), pem("RSA ", cipher[:-1], head.format(iv)),
           pem("RSA ", cipher, head.format("0123")), pem("RSA ", cipher), pem("RSA ", cipher, "Comment: mine\n")]
    texts = [(i, f"\u00e9 before {k} after") for i, k in enumerate(keys + odd)]
    out = {r.doc_id: r.text for r in secrets.redact_secrets(docs_of(spark, texts)).collect()}
    assert [out[i] for i in range(len(keys))] == ["\u00e9 before [SECRET] after"] * len(keys)
    assert [out[i] for i in range(len(keys), len(texts))] == [x for _, x in texts[len(keys) :]]


def test_reparameterised_question_is_found(spark):
    ask = "If {} walks {} km every morning and then rides a bus for {} minutes how far has {} gone after the whole long week ends"
    bench = spark.createDataFrame([(7, "Say. " + ask.format("we and Anna", 5, 20, "Anna"))], "item_id long, text string")
    texts = [(1, "Noise here. " + ask.format("we and Bert", 9, 35, "Bert") + " more"), (2, "Nothing at all like that question."), (3, None)]
    got = decontaminate.contaminated_pairs(docs_of(spark, texts), bench).collect()
    assert [(r.doc_id, r.item_id, r.contaminated) for r in got] == [(1, 7, True)] and got[0].n_changed > 0


def test_each_occurrence_of_an_item_is_judged(spark):
    ask = "If {} walks {} km every morning and then rides a bus for {} minutes how far has she gone after the whole long week ends"
    train = "A train travels at 60 km per hour for 2 hours. Then a train travels at 80 km per hour for 3 hours. How far did it get in all?"
    bench = spark.createDataFrame([(7, ask.format("she", 5, 20)), (8, train)], "item_id long, text string")
    twice = ask.format("she", 5, 20) + ". Other words stand here. " + ask.format("she", 9, 35)
    torn = ask.format("she", 5, 20).replace("rides a bus", "rides quite a bus") + ". " + ask.format("she", 9, 35)
    texts = [(1, twice), (2, train), (3, torn), (4, "A train travels at 60 km per hour for 2 hours, and that is that.")]
    got = {(r.doc_id, r.item_id): r.contaminated for r in decontaminate.contaminated_pairs(docs_of(spark, texts), bench).collect()}
    assert got == {(1, 7): True, (2, 8): True, (3, 7): True, (4, 8): False}


def test_elias_fano_finds_every_value():
    rng = np.random.default_rng(1)
    for universe in (10, 10**5, 10**12):
        v = np.unique(rng.integers(0, universe, 300))
        found = ngram_trie.EliasFano.build(v, universe).find(v)
        assert (found == np.arange(len(v))).all()


def test_language_model_odd_rows(spark):
    got = ngram_trie.score_texts(odd_rows(spark)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 3, 7, 30_001, 30_001] and all(r.score < 0 for r in got)


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "### x: </turn> \\"), (1, 1, "assistant", None), (None, 0, "user", "lost"), (1, 1, "assistant", "b#<")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_paths(chat.reply_chains(df)).collect()
    assert len(got) == 1
    assert chat.parse(got[0].formatted) == [("user", "### x: </turn> \\"), ("assistant", ""), ("assistant", "b#<")]


def test_best_branch_of_a_tree(spark):
    rows = [("t", "r", None, 0.0), ("t", "a", "r", 1.0), ("t", "b", "r", 5.0), ("t", "c", "a", 1.0), ("t", "x", "y", 9.0), ("t", "y", "x", 9.0)]
    nodes = spark.createDataFrame(rows, "tree string, node string, parent string, score double")
    got = sorted((r.depth, r.node) for r in chat.reply_paths(nodes).collect())
    assert got == [(0, "r"), (1, "b")]


def test_main_text_of_other_layouts():
    body = "".join(f"<p>Sentence number {i} of the story is long enough, it says.</p>" for i in range(6))
    chrome = "<nav><a href=/>Home</a></nav><div class=ad>Buy now</div>"
    pages = [f"<html><body>{chrome}<article><h1>Title {i}</h1>{body}</article><footer>&copy; x</footer></body></html>" for i in range(40)]
    model = extract.train(pages)
    want = "Title 1\n" + "\n".join(f"Sentence number {i} of the story is long enough, it says." for i in range(6))
    other = f"<body><aside>See also</aside><main><h1>Title 1</h1>{body}</main><form>Sign up</form><div id=comments><p>Nice</p></div></body>"
    assert extract.main_text([pages[1], other, ""], model) == [want, want, ""]


def test_rules_and_licences(spark):
    text = " ".join(f"w{i}" for i in range(60)) + "\nsame line\nsame line"
    r = {x.doc_id: x for x in perplexity.quality_rules(docs_of(spark, [(1, text), (2, None)]).withColumnRenamed("source", "lang")).collect()}
    assert (r[1].n_words, r[1].n_dup_lines, r[1].base_failed, r[2].n_words, r[2].kept) == (64, 1, False, 0, False)
    got = {x.doc_id: x for x in licenses.scan_licenses(docs_of(spark, [(1, "Under the MIT License, under the mit license"), (2, None)])).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].labels, got[2].n_base, got[2].first_word) == (2, 0, 4, "mit", 0, None)


def test_quality_separates_junk(spark):
    good = [(i, " ".join(WORDS[(i + k) % 19] for k in range(60)) + ".") for i in range(120)]
    junk = [(200 + i, " ".join(WORDS[(i + k) % 19].upper() + "!!" for k in range(60))) for i in range(40)]
    labels = spark.createDataFrame([(i, int(i < 200)) for i, _ in good + junk], "doc_id long, quality int")
    docs = docs_of(spark, good + junk + [(999, None)])
    got = quality.score_quality(docs, quality.train(docs, labels)).collect()
    assert all(r.predicted == int(r.doc_id < 200) for r in got if r.doc_id != 999)
    assert quality.train(docs_of(spark, []), labels) is None


@pytest.mark.parametrize("name", ["op3_template_decontamination", "op5_reply_trees", "op10_circulant_minhash"])
def test_queries_match_their_sql(spark, name):
    import os
    import sys

    from conftest import ROOT, SF_SMALL

    sys.path.insert(0, os.path.join(ROOT, "tools"))
    from compare import compare

    assert compare(spark, SF_SMALL, [name], verbose=False)[name][0] == "ok"
