"""License scans: matching statistics against a generalised suffix automaton of licence texts.

The automaton holds the words of all templates.  A text is streamed through it: each word extends the longest
match that ends there, or falls back along suffix links until it does.  Maximal matches are chained, per
template, into spans in text and template order; a template's coverage is the share of its words in its best
chain.  The named phrases are templates themselves, and every place where one ends is read off the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Rolling, lower_bytes, text_blocks

#: Phrases whose places are counted, with their labels (fixed by the query's contract).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices that are looked for besides; public texts, shortened to their invariable parts.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the rights"
    " to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to"
    " whom the software is furnished to do so subject to the following conditions the above copyright notice and this"
    " permission notice shall be included in all copies or substantial portions of the software",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met redistributions of source code must retain the above copyright notice this list of"
    " conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this"
    " list of conditions and the following disclaimer in the documentation and or other materials provided with the"
    " distribution",
    "apache": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with"
    " the license you may obtain a copy of the license at http www apache org licenses license 2 0",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license as published by the free software foundation either version",
    "lgpl": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general"
    " public license as published by the free software foundation",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not"
    " distributed with this file you can obtain one at",
    "cc": "this work is licensed under a creative commons attribution",
    "rights-reserved": "all rights reserved",
}

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  #: what lies between words
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[0x00:0x30] = _WORD_BYTE[0x3A:0x61] = _WORD_BYTE[0x7B:0x80] = False


class Automaton:
    """A generalised suffix automaton of token sequences.

    ``places`` of a state: the (template, end) of every occurrence of its strings; bounded by all templates' words.
    """

    def __init__(self, templates: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[list[tuple[int, int]]] = [[]]
        for number, tokens in enumerate(templates):
            last = 0
            for end, token in enumerate(tokens):
                last = self._extend(last, token)
                self.places[last].append((number, end))
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.places[self.link[state]].extend(self.places[state])
        self.whole: list[list[int]] = [[] for _ in self.length]  # templates that end as suffixes of the state's strings
        for number, tokens in enumerate(templates):
            state = 0
            for token in tokens:
                state = self.next[state][token]
            self.whole[state].append(number)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.whole[state] = self.whole[state] + self.whole[self.link[state]]

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(dict(following))
        self.places.append([])
        return len(self.length) - 1

    def _split(self, parent: int, child: int, token: int) -> int:
        copy = self._new(self.length[parent] + 1, self.link[child], self.next[child])
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(token) == child:
            self.next[parent][token] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, token: int) -> int:
        known = self.next[last].get(token)
        if known is not None:  # a later template walks along an earlier one
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, token)
        state = self._new(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = state
            at = self.link[at]
        if at >= 0:
            other = self.next[at][token]
            self.link[state] = other if self.length[other] == self.length[at] + 1 else self._split(at, other, token)
        return state

    def scan(self, tokens: list[int]) -> Iterator[tuple[int, int, int]]:
        """Matching statistics: (position, state, length of the longest match that ends there)."""
        state = matched = 0
        follow, link, length = self.next, self.link, self.length
        for position, token in enumerate(tokens):
            while state and token not in follow[state]:
                state = link[state]
                matched = length[state]
            if token in follow[state]:
                state = follow[state][token]
                matched += 1
            yield position, state, matched


class Scanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, notices: dict[str, str] | list[tuple[str, str]] = NOTICES, least: int = 6, gap: int = 12, coverage: float = 0.6):
        texts = [(p.split(), label, True) for p, label in phrases.items()] + [(t.split(), label, False) for label, t in (notices.items() if isinstance(notices, dict) else notices)]
        vocabulary = {w: i for i, w in enumerate(sorted({w for t, _, _ in texts for w in t}))}
        self.size = [len(t) for t, _, _ in texts]
        self.label = [label for _, label, _ in texts]
        self.phrase = [is_phrase for _, _, is_phrase in texts]
        self.automaton = Automaton([[vocabulary[w] for w in t] for t, _, _ in texts])
        self.least, self.gap, self.coverage = least, gap, coverage
        self.need = [min([least, *(self.size[n] for n, _ in p)]) for p in self.automaton.places]
        data = np.frombuffer(" ".join(vocabulary).encode(), np.uint8)
        ends = np.flatnonzero(np.concatenate([data == 32, [True]]))
        hashes = Rolling(data).spans(np.concatenate([[0], ends[:-1] + 1]), ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def ids(self, word: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of hashed words, -1 for others."""
        at = np.minimum(np.searchsorted(self.hashes, word), len(self.hashes) - 1)
        return np.where(self.hashes[at] == word, self.order[at], -1)

    def run(self, ids: list[int], offset: int, hits: list, spans: list) -> None:
        """One run of vocabulary words: phrase places to ``hits``, maximal matches to ``spans``."""
        automaton, before = self.automaton, (0, 0, 0)
        for position, state, matched in automaton.scan(ids):
            if before[2] and matched <= before[2]:
                self._keep(before, offset, spans)
            for number in automaton.whole[state]:
                if self.size[number] <= matched and self.phrase[number]:
                    hits.append((offset + position - self.size[number] + 1, number))
            before = (position, state, matched)
        if before[2]:
            self._keep(before, offset, spans)

    def _keep(self, match: tuple[int, int, int], offset: int, spans: list) -> None:
        position, state, matched = match
        if matched < self.need[state]:
            return
        for number, end in self.automaton.places[state]:
            if matched >= min(self.least, self.size[number]):
                spans.append((number, offset + position - matched + 1, end - matched + 1, matched))

    def chains(self, spans: list[tuple[int, int, int, int]]) -> dict[int, tuple[int, int, int]]:
        """For each template its best chain: (words covered, first word, last word of the text)."""
        best: dict[int, tuple[int, int, int]] = {}
        ends: dict[int, list[tuple[int, int, int, int]]] = {}
        for number, at, inside, length in sorted(spans):
            score, first = length, at
            alive = [e for e in ends.get(number, []) if at - e[0] <= self.gap]
            for text_end, inner_end, covered, begun in alive:
                over = max(0, text_end - at, inner_end - inside)
                if text_end <= at + length and over < length and inside + length > inner_end and inside - inner_end <= self.gap and covered + length - over > score:
                    score, first = covered + length - over, begun
            alive.append((at + length, inside + length, score, first))
            ends[number] = alive
            if score > best.get(number, (0, 0, 0))[0]:
                best[number] = (score, first, at + length - 1)
        return best

    def scan(self, ids: np.ndarray) -> dict:
        """One text's words as vocabulary numbers (-1: no word of any template)."""
        known = ids >= 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        hits: list[tuple[int, int]] = []
        spans: list[tuple[int, int, int, int]] = []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a > 1:  # no template has a single word
                self.run(ids[a:b].tolist(), a, hits, spans)
        best = self.chains(spans)
        found = {n: x for n, x in best.items() if x[0] >= self.coverage * self.size[n]}
        base = sorted({self.label[n] for _, n in hits})
        return {
            "n_words": len(ids),
            "n_base": len(hits),
            "first_word": min((p for p, _ in hits), default=None),
            "last_word": max((p for p, _ in hits), default=None),
            "base_labels": ",".join(base),
            "labels": ",".join(sorted({*base, *(self.label[n] for n in found)})),
            "score": 1.0 if hits else max((x[0] / self.size[n] for n, x in best.items()), default=0.0),
            "spans": [{"label": self.label[n], "first": x[1], "last": x[2], "covered": x[0] / self.size[n]} for n, x in sorted(found.items())],
        }


#: Words of all texts of a licence table, at most: the automaton is held by every task.
MOST_WORDS = 1_000_000


def notices_of(licenses: DataFrame, most_words: int = MOST_WORDS) -> list[tuple[str, str]]:
    """Templates from a table of whole licence texts (label, text), for ``notices`` of scan_licenses.

    Texts of fewer than two words and null labels are left out; a table of over ``most_words`` words is an error.
    """
    words = F.filter(F.split(F.lower("text"), WORD_GAP), lambda w: w != "")
    known = licenses.select("label", words.alias("words")).filter((F.size("words") > 1) & F.col("label").isNotNull())
    if (known.agg(F.sum(F.size("words"))).first()[0] or 0) > most_words:
        raise ValueError(f"the licence texts have over {most_words} words")
    return [(r["label"], " ".join(r["words"])) for r in known.dropDuplicates().orderBy("label", "words").collect()]


SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("covered", T.DoubleType())])


def scan_licenses(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) for every row.

    Null and empty texts have no words and score 0; labels are then empty strings.  Texts are read whole and
    repeated rows scanned each; further columns are ignored.  ``options``: see Scanner; notices_of makes its
    templates from a table of whole licence texts.
    """
    schema = T.StructType([docs.schema["doc_id"]])
    for name, kind in (("n_words", "long"), ("n_base", "long"), ("first_word", "long"), ("last_word", "long"), ("base_labels", "string"), ("labels", "string"), ("score", "double")):
        schema = schema.add(name, kind)
    schema = schema.add("spans", T.ArrayType(SPAN))
    names = schema.names[1:]
    span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())]))
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**options)
        for batch in batches:
            for at, n, data, ends in text_blocks(batch.column(1)):
                data = lower_bytes(data)
                mask = np.concatenate([[False], _WORD_BYTE[data], [False]])
                edge = np.flatnonzero(mask[1:] != mask[:-1])
                start, stop = edge[::2], edge[1::2]
                ids = scanner.ids(Rolling(data).spans(start, stop))
                cut = np.searchsorted(start, np.concatenate([[0], ends]))
                rows = [scanner.scan(ids[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in zip(names, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), *columns], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op7_licenses(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", F.round("score", 6).alias("score"))
