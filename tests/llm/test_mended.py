"""Cases that earlier versions missed, and odd rows of the operators."""

import re
import time
from collections import Counter

import numpy as np
import pytest
from crewload.llm import decontaminate, extract, minhash, perplexity, secrets

DOC = "doc_id long, text string, pos int, at int, h long, first string, lang string, key string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, 3, "f", "en", "k") for i, t in texts], DOC)


# --- 3 decontamination: copies that template windows can't carry --------------

TITLE = "The Quick Brown Fox Jumps Over The Lazy Dog While Seven Silent Wizards Brew Purple Potions Under Moonlight"
CHINESE = "从前有一座山，山里有一座庙，庙里有一个老和尚在给小和尚讲故事，讲的是什么呢"
SHORT = "What is the capital of France?"
PLAIN = "a farmer sells 12 apples to every customer who walks into the shop before 9 in the morning and then closes"
ITEM = "item_id long, text string, pos int, at int, h long, first string"


def flagged(spark, docs, items):
    bench = spark.createDataFrame([(i, t, 1, 2, 3, "f") for i, t in items], ITEM)
    return {(r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(docs_of(spark, docs), bench).collect() if r.contaminated}


def test_verbatim_copies_are_found(spark):
    around = "Some words stand before it here.\n{}\nAnd others come after it, quite a few of them in fact."
    texts = [TITLE, CHINESE, "Question: " + SHORT, PLAIN, "2) " + SHORT]
    docs = [(i, around.format(t)) for i, t in enumerate(texts)]
    docs += [
        (10, around.format("What is the capital of Spain and the history of France?")), (11, around.format("从前有一座山，很高")),
        (12, around.format("The Quick Brown Fox went home")), (13, None), (14, ""), (15, "what is"),
    ]
    items = [(1, TITLE), (2, CHINESE), (3, SHORT), (4, PLAIN), (5, "Yes"), (6, None), (7, "")]
    assert flagged(spark, docs, items) == {(0, 1), (1, 2), (2, 3), (3, 4), (4, 3)}


def test_all_texts_of_an_id_are_looked_for(spark):
    other = PLAIN.replace("apples", "pears").replace("farmer", "grocer who lives nearby")
    items = [(1, PLAIN), (1, "a quite different text that shares nothing at all with the first one of this very item"), (1, SHORT)]
    docs = [(1, items[1][1]), (2, PLAIN), (3, "xx. " + SHORT), (4, other + " zz"), (5, "clean words only"), (5, PLAIN), (5, "clean again")]
    assert flagged(spark, docs, items) >= {(1, 1), (2, 1), (3, 1), (5, 1)}
    assert not {p for p in flagged(spark, [(9, "clean words only, and more of them to fill a line")], items)}


def test_empty_sides_and_dropping(spark):
    assert flagged(spark, [], [(1, PLAIN)]) == set() and flagged(spark, [(1, PLAIN)], []) == set()
    bench = spark.createDataFrame([(1, SHORT, 1, 2, 3, "f")], ITEM)
    left = decontaminate.drop_contaminated(docs_of(spark, [(1, SHORT), (2, "clean"), (None, SHORT), (3, None)]), bench).collect()
    assert sorted((r.doc_id or 0) for r in left) == [0, 2, 3] and left[0].key == "k"


# --- 10 near duplicates: rows of one id ----------------------------------------


def test_rows_of_one_id_are_one_node(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    got = minhash.near_duplicates(docs_of(spark, [(1, a), (5, a), (5, b), (2, b), (9, "other words entirely")])).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == Counter(
        {(1, 1, True): 1, (5, 1, False): 2, (2, 1, False): 1, (9, 9, True): 1}
    )


# --- 1 extraction: the labeller decides -----------------------------------------


@pytest.fixture(scope="module")
def pages():
    import pyarrow.parquet as pq

    return pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()


@pytest.fixture(scope="module")
def model(pages):
    return extract.train([p["html"] for p in pages[:240]])


BODY = "".join(f"<p>This is paragraph {i} of the story, long enough to be read as text by anyone.</p>" for i in range(6))
NAV = "<nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav>"


@pytest.mark.parametrize(
    "wrap", ['<div class="layout has-sidebar">', '<div class="post with-comments">', "<form action=x>", '<div id="page-wrap">', "<main>"]
)
@pytest.mark.parametrize("inner", ["<article>{}</article>", "{}"])
def test_wrappers_keep_the_main_text(model, wrap, inner):
    tag = wrap[1:].split()[0].rstrip(">")
    page = f"<html><body>{NAV}{wrap}{inner.format(BODY)}</{tag}><footer><p>Copyright 2020</p></footer></body></html>"
    text = extract.main_text([page], model)[0]
    assert text.count("paragraph") == 6 and "Home" not in text and "Copyright" not in text


def test_hidden_parts_are_no_text(model):
    page = f"<html><body>{NAV}<article>{BODY}<p hidden>secret one</p><div style='display: none'>secret two</div><script>x</script></article></body></html>"
    assert "secret" not in extract.main_text([page], model)[0]


def test_all_given_pages_match_their_markup(pages, model):
    """Brute force: the blocks inside an article and outside named chrome."""
    found = extract.main_text([p["html"] or "" for p in pages], model)
    want = ["\n".join(x.text for x in extract.leaves(p["html"] or "") if x.main and not x.chrome) for p in pages]
    assert sum(a == b for a, b in zip(found, want)) >= len(pages) - 1


def test_long_and_deep_pages(model):
    long = "<html><body><article>" + "".join(f"<p>Paragraph {i} has several words in it and a stop.</p>" for i in range(18_000)) + "</article></body></html>"
    assert extract.main_text([long], model)[0].count("Paragraph") > 17_900
    took = []
    for n in (4_000, 16_000):
        t = time.process_time()
        extract.leaves("<div>" * n + "text</div>" * n + "</b></i>" * n)
        took.append(time.process_time() - t)
    assert took[1] < 10 * max(took[0], 0.02)


def test_extract_odd_rows(spark, model):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "t", "n"), (2, None, "", "t", "n"), (None, "u", NAV, "t", "n"), (3, "u", f"<article>{BODY}</article>", "t", "n")] * 2
    got = extract.extract(spark.createDataFrame(rows, schema), model).collect()
    assert Counter((r.page_id, r.n_chars) for r in got) == Counter({(1, 0): 2, (2, 0): 2, (None, 0): 2, (3, len(got[3].text)): 2})
    assert extract.extract(spark.createDataFrame([], schema)).collect() == []  # fits on nothing, too


# --- 6 perplexity bands -----------------------------------------------------------


def test_symbol_junk_is_rejected_and_text_kept(spark):
    """On the given documents: all but a few texts of over 5 % symbols past
    the base rules go, the others stay."""
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    docs = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in table], "doc_id long, text string, lang string")
    rows = [r for r in perplexity.quality_rules(docs).collect() if not r.base_failed]
    junk = [r for r in rows if 20 * r.n_symbols > r.word_chars]
    text = [r for r in rows if r.n_symbols * 200 <= r.word_chars]
    assert len(junk) > 40 and sum(r.kept for r in junk) <= 0.02 * len(junk)
    assert len(text) > 700 and sum(not r.kept for r in text) <= 0.01 * len(text)


def test_bands_reject_outliers_of_a_varied_corpus(spark):
    """Texts that differ much among themselves: 40 deviations of theirs would
    pass any text."""
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("etaoinshr"), rng.integers(2, 7))) for _ in range(50)]
    strange = [chr(c) for c in range(0x62, 0x7B)]

    def text(share):
        words = ["".join(rng.choice(strange, 5)) if rng.random() < share else str(rng.choice(vocabulary)) for _ in range(120)]
        return " ".join(words)

    texts = [text(rng.random() * 0.4) for _ in range(200)]
    junk = [" ".join("".join(rng.choice(list("#*$%&|<>QZ79{~;"), 6)) for _ in range(120)) for _ in range(10)]
    rows = perplexity.quality_rules(docs_of(spark, list(enumerate(texts + junk)))).collect()
    assert not any(r.base_failed for r in rows)
    middle = float(np.median([r.log_perplexity for r in rows]))
    spread = float(np.median([abs(r.log_perplexity - middle) for r in rows]))
    assert spread > 0.1 and min(r.log_perplexity for r in rows if r.doc_id >= 200) < middle + 40 * spread
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.doc_id) if not r.kept] == list(range(200, 210))


def test_base_counts_match_brute_force(spark):
    texts = ["", None, "a b c a b c", "x\ny\nx\n \nx", "# $ a|b <c>", "é é é é é", "one two three " * 30, "w " * 20_000, "　a　b"]
    got = {r.doc_id: r for r in perplexity.quality_rules(docs_of(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        many = Counter(grams)
        repeat = {k + j for k, g in enumerate(grams) if many[g] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(repeat) > 50 * len(w))


def test_all_junk_and_empty(spark):
    junk = [(i, "## $$ %% && ** " * 30) for i in range(5)]
    assert len(perplexity.quality_rules(docs_of(spark, junk)).collect()) == 5
    assert perplexity.quality_rules(docs_of(spark, [])).collect() == []


# --- 9 secrets -----------------------------------------------------------------------


def test_token_runs_are_read_once():
    automaton = secrets._automaton()
    for make in (lambda n: b"eyJ" * n, lambda n: b"eyJa." + b"eyJ" * n, lambda n: b"eyJ." * n, lambda n: b"eyJ" * n + b"." + b"eyJ" * n):
        took = []
        for n in (20_000, 80_000):
            t = time.process_time()
            secrets._near_hits(automaton, make(n))
            took.append(time.process_time() - t)
        assert took[1] < 12 * max(took[0], 0.05), took


def test_base_kinds_match_brute_force(spark):
    pieces = ["password=", "Token: ", "api_key='", "SECRET =", "AKIA", "ABCDEFGH12345678", "abcdef0123456789", "0123456789abcdef01234567", " ", "x", "é", "=", "\n", "passwd:", "zZ9+/_.-"]
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(pieces, rng.integers(0, 25))) for _ in range(400)] + [None, "", "token=" + "a" * 50_000, "f" * 100_000]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(docs_of(spark, list(enumerate(texts)))).collect()}
    rules = {
        "assign": (r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    }
    for i, text in enumerate(texts):
        for kind, (pattern, ok) in rules.items():
            want = [(m.start(), m.end()) for m in re.finditer(pattern, text or "") if ok(m)]
            assert [(s.start, s.end) for s in got[i] if s.kind == kind] == want, (kind, text)
