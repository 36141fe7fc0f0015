"""Licence scan by a positional rare-token index.

Templates are word sequences with positions, of two kinds. Document
frequencies of their words over the whole corpus give each word an IDF.

A phrase must stand in a text word for word: its word of the highest IDF is
looked up, and the postings of its other words are intersected by relative
position, so a place counts only if all words stand where the rare one says.

A notice is the body of a licence and may be changed, torn or cut: words that
carry ``COVER`` of its IDF weight must stand within ``SLACK`` places of where
they belong. Each file looks up its own words of the highest IDF: as many as
it takes for the rest of the file's words to carry less than ``COVER``, so
that no place can do without one of them. Each occurrence of such a word says
where the notice would begin, and the other words are intersected with that.

Templates with mandatory key phrases also need one of them as a place in the
same text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import ALNUM, Block, blocks, hash_spans, words


@dataclass(frozen=True)
class Template:
    label: str
    phrase: str
    mandatory: tuple[str, ...] = ()
    base: bool = False


# --- fixed values: licence phrases, their labels and mandatory key phrases -----
TEMPLATES = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy",
             ("the software is provided as is",)),
    Template("apache-2", "licensed under the apache license", ("version 2", "license 2")),
    Template("gpl-3", "gnu general public license version 3"),
    Template("gpl-3", "gnu general public license", ("version 3", "gplv3", "gpl 3")),
    Template("gpl-2", "gnu general public license version 2"),
    Template("lgpl-3", "gnu lesser general public license version 3"),
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("bsd-3", "redistribution and use in source and binary forms",
             ("neither the name of",)),
    Template("bsd-2", "redistribution and use in source and binary forms",
             ("this list of conditions and the following disclaimer",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc-by", "cc by 4"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc0", "cc0 1"),
    Template("proprietary", "all rights reserved", ("proprietary and confidential", "may not be reproduced")),
)

# Bodies of public licences, as words.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction including without limitation the rights "
             "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom "
             "the software is furnished to do so subject to the following conditions the above copyright notice and this permission "
             "notice shall be included in all copies or substantial portions of the software",
             ("this permission notice shall be included", "to deal in the software without restriction")),
    Template("bsd-2", "redistribution and use in source and binary forms with or without modification are permitted provided that "
             "the following conditions are met redistributions of source code must retain the above copyright notice this list of "
             "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this "
             "list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
             ("this list of conditions and the following disclaimer",)),
    Template("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
             "products derived from this software without specific prior written permission", ("to endorse or promote products",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
             "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
             "provided as is and the author disclaims all warranties with regard to this software",
             ("for any purpose with or without fee",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
             "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
             "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without "
             "warranties or conditions of any kind either express or implied see the license for the specific language governing "
             "permissions and limitations under the license", ("apache license version 2", "apache org licenses license 2")),
    Template("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
             "public license as published by the free software foundation either version 3 of the license or at your option any later "
             "version", ("either version 3", "version 3 of the license")),
    Template("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
             "public license as published by the free software foundation either version 2 of the license or at your option any later "
             "version", ("either version 2", "version 2 of the license")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
             "distributed with this file you can obtain one at", ("mozilla public license v 2",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify "
             "publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose "
             "commercial or non commercial and by any means", ("released into the public domain",)),
    Template("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to "
             "alter it and redistribute it freely subject to the following restrictions the origin of this software must not be "
             "misrepresented you must not claim that you wrote the original software", ("the origin of this software",)),
)
# --------------------------------------------------------------------------------

COVER = 0.6  # least share of a notice's IDF weight that must stand in place
SLACK = 2  # places that a word may be off

PHRASES = tuple(dict.fromkeys(p for t in (*TEMPLATES, *NOTICES) for p in (*([] if t in NOTICES else [t.phrase]), *t.mandatory)))
WORDS = tuple(sorted({w for p in (*PHRASES, *(t.phrase for t in NOTICES)) for w in p.split()}))


def _word_hashes(texts) -> np.ndarray:
    joined = np.frombuffer("".join(texts).encode(), np.uint8)
    size = np.array([len(t) for t in texts])
    end = np.cumsum(size)
    return hash_spans(joined, end - size, end)


class Index:
    """Template postings: for each phrase its word numbers and the place of
    the word with the highest IDF, for each notice its word numbers and the
    weight that each word has in it."""

    CHUNK = 4096  # places of a notice that are compared at once

    def __init__(self, frequency: dict[str, int], n_docs: int):
        self.idf = np.log((n_docs + 1) / (np.array([frequency.get(w, 0) for w in WORDS]) + 1)) + 1
        number = {w: i for i, w in enumerate(WORDS)}
        self.phrases = [np.array([number[w] for w in p.split()]) for p in PHRASES]
        self.anchor = [int(np.argmax(self.idf[p])) for p in self.phrases]
        self.notices = [np.array([number[w] for w in t.phrase.split()]) for t in NOTICES]
        self.weight = np.array([np.bincount(m, self.idf[m], len(WORDS)) for m in self.notices])
        self.total = self.weight.sum(1)
        hashes = _word_hashes(WORDS)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Licence word number of each word of a text, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def places(self, block: Block):
        """(words, their licence word numbers, per phrase the indices of all
        words that start a place)."""
        w = words(block, ALNUM)
        number = self.numbers(w.hash)
        known = np.flatnonzero(number >= 0)
        by_word = known[np.argsort(number[known], kind="stable")]
        cut = np.searchsorted(number[by_word], np.arange(len(WORDS) + 1))
        out = []
        for phrase, anchor in zip(self.phrases, self.anchor, strict=True):
            rare = phrase[anchor]
            start = by_word[cut[rare] : cut[rare + 1]] - anchor
            start = start[(start >= 0) & (start + len(phrase) <= len(number))]
            for offset, word in enumerate(phrase):
                start = start[number[start + offset] == word]
            out.append(start[w.doc[start] == w.doc[start + len(phrase) - 1]])
        return w, number, out

    def looked_up(self, present: np.ndarray, k: int) -> np.ndarray:
        """The words by which a file looks notice ``k`` up, given the numbers
        of its licence words: none if they can't carry ``COVER``."""
        mine = present[self.weight[k, present] > 0]
        mine = mine[np.lexsort((mine, -self.idf[mine]))]
        left = self.weight[k, mine].sum() - np.cumsum(self.weight[k, mine])
        need = COVER * self.total[k]
        if not len(mine) or left[0] + self.weight[k, mine[0]] < need:
            return mine[:0]
        return mine[: 1 + int(np.argmax(left < need))]

    def covered(self, number: np.ndarray, k: int) -> float:
        """The largest share of notice ``k``'s weight that stands in place in
        a file, given as the licence word number of each of its words."""
        notice = self.notices[k]
        rare = self.looked_up(np.unique(number[number >= 0]), k)
        starts = [np.flatnonzero(number == notice[o]) - o for o in np.flatnonzero(np.isin(notice, rare))]
        starts = np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
        edge = np.full(len(notice) + SLACK, -1)
        padded, best = np.concatenate([edge, number, edge]), 0.0
        for lo in range(0, len(starts), self.CHUNK):
            at = starts[lo : lo + self.CHUNK, None] + np.arange(len(notice)) + len(edge)
            stands = padded[at] == notice
            for off in range(1, SLACK + 1):
                stands |= (padded[at - off] == notice) | (padded[at + off] == notice)
            best = max(best, float((stands @ self.idf[notice]).max()))
        return best / self.total[k]

    def found(self, w, number: np.ndarray):
        """(text, notice, share) of every notice that stands in a text."""
        known = np.flatnonzero(number >= 0)
        texts, row = np.unique(w.doc[known], return_inverse=True)
        has = np.zeros((len(texts), len(WORDS)), np.float32)
        has[row, number[known]] = 1
        # only texts whose words can carry a notice at all go on
        for d, k in zip(*np.nonzero(has @ self.weight.T >= COVER * self.total * (1 - 1e-5)), strict=True):
            lo = w.first[texts[d]]
            share = self.covered(number[lo : lo + w.count[texts[d]]], k)
            if share >= COVER:
                yield int(texts[d]), int(k), share


def _frequencies(batches):
    total = np.zeros(len(WORDS), np.int64)
    index, n = Index({}, 1), 0
    for block in blocks(batches, "text"):
        w = words(block, ALNUM)
        number = index.numbers(w.hash)
        known = number >= 0
        pairs = np.unique(w.doc[known] * len(WORDS) + number[known])
        total += np.bincount(pairs % len(WORDS), minlength=len(WORDS))
        n += len(block)
    yield pa.RecordBatch.from_arrays([pa.array([*WORDS, ""]), pa.array([*total.tolist(), n])], ["word", "n"])


def build_index(docs: DataFrame) -> Index:
    """Document frequencies of the template words (a fixed list) over all texts."""
    text = docs.select(F.col("text").cast("string"))
    rows = text.mapInArrow(_frequencies, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    count = {r["word"]: r["n"] for r in rows}  # one row per template word
    return Index(count, count.get("", 0))


def _scan(index: Index):
    number = {p: i for i, p in enumerate(PHRASES)}
    base = [number[t.phrase] for t in TEMPLATES if t.base]
    weight = [float(index.idf[p].sum()) for p in index.phrases]

    def run(batches):
        for block in blocks(batches, "text"):
            w, known, places = index.places(block)
            n = len(block)
            n_base, first, last = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
            has = np.zeros((len(PHRASES), n), bool)
            for i, start in enumerate(places):
                has[i, w.doc[start]] = True
            starts = np.sort(np.concatenate([places[i] for i in base]))
            if len(starts):
                doc = w.doc[starts]
                n_base = np.bincount(doc, minlength=n)
                word = starts - w.first[doc]
                first[doc[::-1]] = word[::-1]
                last[doc] = word
            base_labels, labels, score = [[] for _ in range(n)], [[] for _ in range(n)], np.zeros(n)
            for t in TEMPLATES:
                hit = has[number[t.phrase]].copy()
                if t.mandatory:
                    hit &= np.any([has[number[m]] for m in t.mandatory], axis=0)
                for d in np.flatnonzero(hit).tolist():
                    labels[d].append(t.label)
                    if t.base:
                        base_labels[d].append(t.label)
                # IDF weight of the evidence: 1 - exp(-weight / 10)
                score[hit] = np.maximum(score[hit], 1 - np.exp(-weight[number[t.phrase]] / 10))
            for d, k, share in index.found(w, known):
                t = NOTICES[k]
                if not t.mandatory or any(has[number[m], d] for m in t.mandatory):
                    labels[d].append(t.label)
                    score[d] = max(score[d], 1 - np.exp(-share * index.total[k] / 10))
            join = lambda x: ",".join(sorted(set(x)))
            none = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [
                    block.batch.column(0), pa.array(w.count), pa.array(n_base.astype(np.int64)),
                    pa.array(first.astype(np.int64), mask=none), pa.array(last.astype(np.int64), mask=none),
                    pa.array([join(x) for x in base_labels]), pa.array([join(x) for x in labels]), pa.array(score),
                ],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    return run


def scan_licenses(docs: DataFrame, index: Index | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) for every row.

    ``n_base`` counts all places of the base phrases (overlapping ones too),
    ``score`` grows with the IDF weight of the strongest template found (the
    part of a notice that stands in place) and is 0 without one. A null or empty text has no words and empty labels; repeated rows
    give repeated result rows; a null doc_id stays null; other columns are
    ignored; an empty table gives no rows.
    """
    index = index or build_index(docs)
    flat = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return flat.mapInArrow(
        _scan(index),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
