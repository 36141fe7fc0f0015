"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks. Each block has a tag-path vector
(the tags, class and id words from the root, hashed into an embedding), a
hashed-word vector and a few figures; a bidirectional LSTM in numpy reads the
whole sequence and classifies every block with the document's context. It is
trained on a bounded sample of the pages themselves (``FIT_PAGES``,
``FIT_HTML``): blocks whose containers say what they are give the labels, and
the containers are renamed at random (and hidden now and then), so the network
learns layout and context, not one vocabulary of tags. Its label decides: the
names are input and teach. Only what a browser doesn't show as text (scripts,
styles, form fields, hidden parts) never becomes a block of the result, nor do
parts named as something else where they hold less than half of the text.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: element and class vocabularies ------------------------------
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "canvas", "select", "button")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
CLOSES = {  # an opening tag ends an open one of these, up to the nearest scope
    "p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
}
SCOPE = frozenset("ul ol dl table tbody thead tfoot div article section main body html nav aside header footer form blockquote figure".split())
CHROME_TAGS = frozenset("nav header footer aside form head menu dialog".split())
CHROME_WORDS = frozenset(
    """ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer
    gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion
    related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split()
)
#: Beside a chrome word these make a name of the page around that part.
AROUND = frozenset("has with without no layout page wrap wrapper container site outer".split())
MAIN_TAGS, MAIN_WORDS = ("article", "main"), ("content", "article", "post", "entry", "story", "main", "body", "text")
# --------------------------------------------------------------------------------

FIT_PAGES, FIT_HTML, FIT_BLOCKS = 480, 16 << 20, 400  # pages to fit on, characters of them all, blocks in a row of one page
PATH_NAMES = 64  # innermost names that a block's path vector holds
PATH_BUCKETS, WORD_BUCKETS, PATH_DIM, WORD_DIM, HIDDEN = 256, 512, 12, 6, 12
EPOCHS, BATCH, RATE, SEED = 12, 24, 0.015, 11

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'">])*)(?:>|\Z)""",
    re.S | re.I,
)
_ATTR = re.compile(r"""(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z0-9]+")


@dataclass
class Leaf:
    text: str
    path: tuple[str, ...]  # tags and class words, the innermost last
    linked: int  # characters inside links
    chrome: bool  # in a part that names itself something else than main text
    main: bool  # in a container that says it is the main text
    hidden: bool = False  # never shown
    depth: int = 0


@dataclass(slots=True)
class Open:
    """An open element; its path is its own names and those above it."""

    tag: str
    names: tuple[str, ...]
    above: "Open | None"
    chrome: bool
    main: bool
    hidden: bool
    depth: int

    def path(self) -> tuple[str, ...]:
        out: list[str] = []
        at: Open | None = self
        while at is not None and len(out) < PATH_NAMES:
            out.extend(reversed(at.names))
            at = at.above
        return tuple(reversed(out[:PATH_NAMES]))


def _element(tag: str, attrs: str):
    """(names of the path, chrome, main, hidden) of an opened element."""
    names, chrome, main, hidden = [tag], tag in CHROME_TAGS, tag in MAIN_TAGS, False
    if attrs and attrs.strip():
        for m in _ATTR.finditer(attrs):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key in ("class", "id", "role"):
                for word in value.split():
                    found = _NAME.findall(word)
                    names += [f".{x}" for x in found]
                    if tag not in ("body", "html", *MAIN_TAGS) and AROUND.isdisjoint(found):
                        chrome = chrome or not CHROME_WORDS.isdisjoint(found)
                    main = main or any(x in MAIN_WORDS for x in found)
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and "display:none" in value.replace(" ", "")):
                hidden = True
    return names, chrome or hidden, main, hidden


def leaves(page: str) -> list[Leaf]:
    """The text blocks of a page in order; white space is one space."""
    out: list[Leaf] = []
    root = Open("", (), None, False, False, False, 0)
    stack, opened = [root], Counter()  # what is open, and how often
    blocks = [root]  # those of it that are no inline elements
    parts: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            at = blocks[-1]
            out.append(Leaf(text, at.path(), min(linked, len(text)), at.chrome, at.main, at.hidden, at.depth))
        parts.clear()
        linked = 0

    def close(i: int):
        """Close the open elements from the i-th on."""
        for x in stack[i:]:
            opened[x.tag] -= 1
            if x.tag not in INLINE:
                blocks.pop()
        del stack[i:]

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            linked += (m.start() - at) * (links > 0)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
        elif m["end"]:
            if tag == "a":
                links = max(0, links - 1)
            if tag not in INLINE:
                flush()
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
        elif tag in VOID:
            if tag == "hr":
                flush()
        else:
            if tag not in INLINE:
                flush()
                links = 0 if tag in SCOPE else links
                ends = CLOSES.get(tag, ("p",) if tag in SCOPE or tag[0] == "h" and tag[1:].isdigit() else ())
                for i in range(len(stack) - 1, 0, -1) if any(opened[x] for x in ends) else ():
                    if stack[i].tag in ends:
                        close(i)
                    elif stack[i].tag in SCOPE:
                        break
            if tag == "a":
                links += 1
            names, chrome, main, hidden = _element(tag, m["attrs"])
            above = stack[-1]
            chrome = above.chrome or chrome
            if main and above.tag == "form" and not above.above.chrome:
                chrome = hidden  # a form around the whole page
            new = Open(tag, tuple(names), above, chrome, above.main or main, above.hidden or hidden, above.depth + len(names))
            stack.append(new)
            opened[tag] += 1
            if tag not in INLINE:
                blocks.append(new)
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def _bucket(name: str, n: int, memo: dict) -> int:
    if name not in memo:
        memo[name] = zlib.crc32(name.encode()) % n
    return memo[name]


def encode(page: list[Leaf], memo: dict | None = None):
    """(path bags, word bags, figures) of a page's blocks."""
    paths, word_bags = (memo if memo is not None else {}).setdefault("p", {}), (memo if memo is not None else {}).setdefault("w", {})
    p = [np.array([_bucket(x, PATH_BUCKETS, paths) for x in leaf.path] or [0]) for leaf in page]
    w = []
    for leaf in page:
        w.append(np.array([zlib.crc32(x.encode()) % WORD_BUCKETS for x in leaf.text.split(" ")]))
    figures = np.array(
        [
            [np.log1p(len(x.text)) / 5, x.linked / max(1, len(x.text)), x.text[-1] in ".!?:;", min(x.depth, PATH_NAMES) / 10, i / max(1, len(page) - 1)]
            for i, x in enumerate(page)
        ],
        float,
    ).reshape(len(page), 5)
    return p, w, figures


N_IN = PATH_DIM + WORD_DIM + 5


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Embeddings, one LSTM per direction, a logistic output per block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.par = {"P": rng.normal(0, 0.5, (PATH_BUCKETS, PATH_DIM)), "W": rng.normal(0, 0.2, (WORD_BUCKETS, WORD_DIM))}
        for d in "fb":
            self.par["K" + d] = rng.normal(0, (N_IN + HIDDEN) ** -0.5, (N_IN + HIDDEN, 4 * HIDDEN))
            self.par["c" + d] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])
        self.par["o"] = rng.normal(0, (2 * HIDDEN + N_IN) ** -0.5, 2 * HIDDEN + N_IN)
        self.par["z"] = np.zeros(1)

    def inputs(self, pages):
        """Padded (T, B, N_IN) inputs and the mask of real blocks."""
        longest = max(len(x[2]) for x in pages)
        x, mask = np.zeros((longest, len(pages), N_IN)), np.zeros((longest, len(pages)))
        for b, (p, w, figures) in enumerate(pages):
            n = len(figures)
            for at, dim, bags, table in ((0, PATH_DIM, p, "P"), (PATH_DIM, WORD_DIM, w, "W")):
                size = np.array([len(i) for i in bags])
                total = np.add.reduceat(self.par[table][np.concatenate(bags)], np.cumsum(size) - size, axis=0)
                x[:n, b, at : at + dim] = total / np.sqrt(size)[:, None]
            x[:n, b, PATH_DIM + WORD_DIM :] = figures
            mask[:n, b] = 1
        return x, mask

    def _run(self, x, mask, d):
        kernel, bias = self.par["K" + d], self.par["c" + d]
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        h, c = np.zeros((x.shape[1], HIDDEN)), np.zeros((x.shape[1], HIDDEN))
        out, tape = np.zeros((len(x), x.shape[1], HIDDEN)), []
        for t in steps:
            joined = np.concatenate([x[t], h], 1)
            g = joined @ kernel + bias
            f, i, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            n = np.tanh(g[:, 3 * HIDDEN :])
            before = c
            m = mask[t][:, None]
            c = m * (f * c + i * n) + (1 - m) * c
            s = np.tanh(c)
            h = m * (o * s) + (1 - m) * h
            out[t] = h
            tape.append((t, joined, f, i, o, n, before, s, m))
        return out, tape

    def forward(self, pages):
        x, mask = self.inputs(pages)
        hf, tf = self._run(x, mask, "f")
        hb, tb = self._run(x, mask, "b")
        every = np.concatenate([hf, hb, x], 2)
        return every @ self.par["o"] + self.par["z"][0], mask, x, every, tf, tb

    def probabilities(self, pages) -> list[np.ndarray]:
        logit = self.forward(pages)[0]
        return [_sigmoid(logit[: len(p[2]), b]) for b, p in enumerate(pages)]

    def _back(self, dh_out, tape, d, grads, dx):
        kernel = self.par["K" + d]
        dh, dc = np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
        for t, joined, f, i, o, n, before, s, m in reversed(tape):
            dh = dh + dh_out[t]
            live = dh * m
            dcell = m * dc + live * o * (1 - s * s)
            dg = np.concatenate([dcell * before * f * (1 - f), dcell * n * i * (1 - i), live * s * o * (1 - o), dcell * i * (1 - n * n)], 1)
            grads["K" + d] += joined.T @ dg
            grads["c" + d] += dg.sum(0)
            back = dg @ kernel.T
            dx[t] += back[:, :N_IN]
            dh = back[:, N_IN:] + dh * (1 - m)
            dc = dcell * f + dc * (1 - m)

    def gradients(self, pages, labels):
        logit, mask, x, every, tf, tb = self.forward(pages)
        y = np.zeros_like(logit)
        known = np.zeros_like(logit)
        for b, lab in enumerate(labels):
            y[: len(lab), b] = lab == 1
            known[: len(lab), b] = lab >= 0
        n = max(1.0, known.sum())
        dl = (_sigmoid(logit) - y) * known / n
        grads = {k: np.zeros_like(v) for k, v in self.par.items()}
        grads["o"] = np.tensordot(dl, every, ([0, 1], [0, 1]))
        grads["z"] = np.array([dl.sum()])
        de = dl[:, :, None] * self.par["o"]
        dx = de[:, :, 2 * HIDDEN :].copy()
        self._back(de[:, :, :HIDDEN], tf, "f", grads, dx)
        self._back(de[:, :, HIDDEN : 2 * HIDDEN], tb, "b", grads, dx)
        for b, (p, w, figures) in enumerate(pages):
            for at, dim, bags, table in ((0, PATH_DIM, p, "P"), (PATH_DIM, WORD_DIM, w, "W")):
                size = np.array([len(i) for i in bags])
                g = dx[: len(figures), b, at : at + dim] / np.sqrt(size)[:, None]
                np.add.at(grads[table], np.concatenate(bags), np.repeat(g, size, axis=0))
        return grads

    def fit(self, pages, labels, epochs: int = EPOCHS):
        rng, t = np.random.default_rng(SEED), 0
        first = {k: np.zeros_like(v) for k, v in self.par.items()}
        second = {k: np.zeros_like(v) for k, v in self.par.items()}
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            order = sorted(order, key=lambda i: len(pages[i][2]))  # like lengths together
            lots = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
            for k in rng.permutation(len(lots)):
                grads, t = self.gradients([pages[i] for i in lots[k]], [labels[i] for i in lots[k]]), t + 1
                for key, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[key] = 0.9 * first[key] + 0.1 * g
                    second[key] = 0.999 * second[key] + 0.001 * g * g
                    self.par[key] -= RATE * (first[key] / (1 - 0.9**t)) / (np.sqrt(second[key] / (1 - 0.999**t)) + 1e-8)


# Names that a layout may give its parts; training pages are renamed with them.
_LAYOUT = {
    True: (("article",), ("main",), ("div", ".content"), ("div", ".post"), ("div", ".entry"), ("section", ".story"), ("div", ".article", ".body"), ("main", ".text")),
    False: (("nav",), ("header",), ("footer",), ("aside",), ("div", ".ad"), ("div", ".sidebar"), ("ul", ".menu"), ("div", ".cookie"), ("div", ".comments"),
            ("section", ".related"), ("form",), ("div", ".newsletter"), ("div", ".promo"), ("div", ".notice"), ("div", ".share"), ("div", ".banner")),
}


def _renamed(page: list[Leaf], rng) -> list[Leaf]:
    """The page in another layout: its parts get other containers, boilerplate
    runs may move behind the main text or be repeated."""
    runs: list[list[Leaf]] = []
    for leaf in page:
        if runs and runs[-1][0].main == leaf.main and runs[-1][0].chrome == leaf.chrome:
            runs[-1].append(leaf)
        else:
            runs.append([leaf])
    out = []
    if rng.random() < 0.5:
        extra = [r for r in runs if not r[0].main]
        if extra:
            runs.insert(int(rng.integers(0, len(runs) + 1)), extra[int(rng.integers(0, len(extra)))])
    for run in runs:
        good = run[0].main and not run[0].chrome
        names = _LAYOUT[good][int(rng.integers(0, len(_LAYOUT[good])))]
        hide = rng.random() < 0.15
        for leaf in run:
            last = tuple(x for x in leaf.path[-1:] if x in ("p", "li", "td", "h1", "h2", "h3", "blockquote", "pre"))
            path = ("html", "body", *(() if hide else names), *last)
            out.append(Leaf(leaf.text, path, leaf.linked, leaf.chrome, leaf.main, leaf.hidden, len(path)))
    return out


def train(pages: list[str]) -> Labeller:
    """Fit on pages whose containers name their parts; others teach nothing."""
    rng, model = np.random.default_rng(SEED), Labeller()
    inputs, labels = [], []
    for page in sorted(pages):
        found = [x for x in leaves(page) if not x.hidden]
        lo = int(rng.integers(0, max(1, len(found) - FIT_BLOCKS + 1)))
        found = found[lo : lo + FIT_BLOCKS]
        if any(x.main and not x.chrome for x in found):
            for version in (found, _renamed(found, rng), _renamed(found, rng)):
                inputs.append(encode(version))
                labels.append(np.array([1 if x.main and not x.chrome else 0 if x.chrome else -1 for x in version]))
    # one plain page is always there, so an odd sample still gives a model
    plain = [Leaf("Home", ("html", "body", "nav"), 4, True, False), Leaf("A long line of text. " * 5, ("html", "body", "article", "p"), 0, False, True)]
    inputs.append(encode(plain))
    labels.append(np.array([0, 1]))
    model.fit(inputs, labels)
    return model


def main_text(pages: list[str], model: Labeller, threshold: float = 0.5) -> list[str]:
    """The main text of each page: its blocks labelled main, one per line."""
    found = [[x for x in leaves(p) if not x.hidden] for p in pages]
    out, memo = [""] * len(pages), {}
    order = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
    lo = 0
    while lo < len(order):  # pages of like length, a bounded number of blocks
        hi = lo + 1
        while hi < len(order) and hi - lo < 128 and (hi - lo + 1) * len(found[order[hi]]) <= 40_000:
            hi += 1
        group = order[lo:hi]
        for i, p in zip(group, model.probabilities([encode(found[i], memo) for i in group]), strict=True):
            named = sum(len(x.text) for x in found[i] if x.chrome and not x.main)
            small = 2 * named < sum(len(x.text) for x in found[i])  # parts beside the text, not around it
            out[i] = "\n".join(x.text for x, q in zip(found[i], p, strict=True) if q >= threshold and not (small and x.chrome and not x.main))
        lo = hi
        memo = memo if len(memo.get("p", ())) < 100_000 else {}
    return out


def fit(pages: DataFrame, n_pages: int = FIT_PAGES, max_html: int = FIT_HTML) -> Labeller:
    """Train on the ``n_pages`` pages of the smallest id hash, as far as their
    html has ``max_html`` characters together (a bounded sample; labelling
    covers every page). The ids and lengths are chosen first, so no task sends
    pages that are not used; of repeated rows of an id one html is used, rows
    without an id are not."""
    some = pages.select(F.col("page_id").cast("long"), F.col("html").cast("string").alias("html"))
    some = some.where(F.col("page_id").isNotNull() & F.col("html").isNotNull())
    size = some.groupBy("page_id").agg(F.max(F.length("html")).alias("n"))
    chosen, room = [], max_html
    for r in size.orderBy(F.xxhash64("page_id"), "page_id").limit(n_pages).collect():
        if r["n"] <= room:
            chosen.append(r["page_id"])
            room -= r["n"]
    rows = some.where(F.col("page_id").isin(chosen)).groupBy("page_id").agg(F.min("html").alias("html")).collect()  # n_pages rows
    return train([r["html"] for r in rows])


def _label(model: Labeller):
    def run(batches):
        for batch in batches:
            pages = batch.column(2).to_pylist()
            text: list[str] = []
            for lo in range(0, len(pages), 512):
                text += main_text([x or "" for x in pages[lo : lo + 512]], model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return run


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    A null or empty html gives an empty text; repeated rows give repeated
    result rows; null ids and urls stay null; other columns are ignored; an
    empty table gives no rows. Whole pages are read, however long.
    """
    model = model or fit(pages)
    flat = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return flat.mapInArrow(_label(model), "page_id long, url string, text string, n_chars long")
