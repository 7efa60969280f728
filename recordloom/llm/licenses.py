"""Licence notices in documents, by a generalised suffix automaton of their words.

The automaton of all templates is small and fixed; documents stream through it once.
Every position gets its matching statistic (the longest run of words ending there that
stands in some template). Long matches in template order chain into covered spans.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import letter_words, slices, utf8

# Base phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Openings of public licence notices and common one-line notices.
TEMPLATES = [
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
MIN_MATCH = 3  # words of a match that may join a chain
MAX_GAP = 12  # document words between two matches of a chain
MIN_SHARE = 0.75  # of a template's words that a chain must cover for its label


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]  # (sequence, end) of occurrences
        for n, words in enumerate(sequences):
            last = 0
            for end, w in enumerate(words, 1):
                last = self._extend(last, w)
                self.ends[last].append((n, end))
        for v in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[v]] += self.ends[v]
        self.ends = [sorted(set(e)) for e in self.ends]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, p: int, w: int) -> int:
        """The state of p's longest word sequence followed by w, split off if it is not the longest there."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w)
        return new

    def walk(self, words):
        """(state, matched length) after each word: the matching statistics."""
        v = n = 0
        for w in words:
            while v and w not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            if w in self.next[v]:
                v, n = self.next[v][w], n + 1
            yield v, n


class Scanner:
    """Automaton, vocabulary and phrase states of a set of templates and phrases."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.templates = [(label, len(words.split())) for label, words in templates]
        self.phrases = [label for _, label in phrases]
        self.vocabulary: dict[bytes, int] = {}
        sequences = [
            [self.vocabulary.setdefault(w.encode(), len(self.vocabulary)) for w in words.split()]
            for words in [*(t for _, t in templates), *(p for p, _ in phrases)]
        ]
        self.automaton = Automaton(sequences)
        # phrases that end at a state: (phrase, words that must be matched)
        here: list[list[tuple[int, int]]] = [[] for _ in self.automaton.link]
        for n, words in enumerate(sequences[len(templates):]):
            *_, (v, _) = self.automaton.walk(words)
            here[v].append((n, len(words)))
        self.phrases_at = [list(x) for x in here]
        for v in sorted(range(1, len(here)), key=self.automaton.length.__getitem__):
            self.phrases_at[v] += self.phrases_at[self.automaton.link[v]]

    def scan(self, words: list[bytes]) -> tuple[list, list]:
        """([(phrase, first word)], [(template, first word, last word, words covered)])."""
        get = self.vocabulary.get
        ids = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        known = np.flatnonzero(ids >= 0)
        if len(known) < 2:
            return [], []
        cuts = np.flatnonzero(np.diff(known) > 1) + 1
        phrases, matches = [], []
        for run in np.split(known, cuts):
            if len(run) < 2:
                continue
            first, run_ids = int(run[0]), ids[run].tolist()
            statistics = [*self.automaton.walk(run_ids), (0, 0)]
            for i, (v, n) in enumerate(statistics[:-1]):
                for phrase, need in self.phrases_at[v]:
                    if n >= need:
                        phrases.append((phrase, first + i - need + 1))
                if n >= MIN_MATCH and statistics[i + 1][1] <= n:  # cannot be longer
                    matches.append((first + i - n + 1, n, v))
        return phrases, self.chain(matches)

    def chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Matches that follow each other in the document and in a template, as one span each.

        Each match extends the chain that covers most with it, or starts its own. Of chains of a
        template that overlap in the document the one that covers most is kept, then the shortest.
        """
        ended: dict[int, list] = {}  # template -> chains by last match: (covered, first, last, end in the template)
        recent: dict[int, int] = {}  # template -> first chain that a match can still extend
        for start, n, v in matches:
            last = start + n - 1
            for template, end in self.automaton.ends[v]:
                if template >= len(self.templates):
                    continue
                chains, at = ended.setdefault(template, []), recent.get(template, 0)
                # matches that start later also end later, so a chain out of reach stays so
                while at < len(chains) and start - chains[at][2] > MAX_GAP:
                    at += 1
                recent[template] = at
                best = (n, start)
                for covered, first, before, upto in chains[at:]:
                    if before < last and upto < end:
                        best = max(best, (covered + min(n, end - upto, last - before), first))
                chains.append((*best, last, end))
        spans = []
        for template, chains in ended.items():
            kept: list[tuple[int, int]] = []
            for covered, first, last, _ in sorted(chains, key=lambda c: (-c[0], c[2] - c[1], c[1])):
                place = bisect_left(kept, (first, last))
                if (place == 0 or kept[place - 1][1] < first) and (place == len(kept) or last < kept[place][0]):
                    kept.insert(place, (first, last))
                    spans.append((template, first, last, covered))
        return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label:string,first:long,last:long,covered:long,share:double>>"
)
_ARROW = pa.schema(
    [("doc_id", pa.int64())]
    + [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    + [
        (
            "spans",
            pa.list_(
                pa.struct(
                    [("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]
                )
            ),
        )
    ]
)


def scan_licenses(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", templates=TEMPLATES, phrases=PHRASES, min_share=MIN_SHARE
) -> DataFrame:
    """One row of `SCHEMA` per input row.

    Base columns count the places of the phrases. `spans` are the template spans of at least
    half a template; a span of `min_share` gives its label, and `score` is the largest share.
    Null text has no words; without a phrase `first_word` and `last_word` are null and labels
    empty strings. Rows that repeat are scanned one by one, a null id is carried along, other
    columns are ignored, an empty table gives no rows. The templates are a fixed list, so the
    automaton that travels with the task is of fixed size.
    """
    scanner = Scanner(templates, phrases)

    def scan(batches):
        for batch in slices(batches):
            rows = {n: [] for n in _ARROW.names}
            rows["doc_id"] = batch.column(0)
            for text_ in utf8(batch.column(1)):
                words = letter_words(text_)
                places, chains = scanner.scan(words)
                spans = []
                for template, first, last, covered in chains:
                    label, length = scanner.templates[template]
                    share = min(1.0, covered / length)
                    if share >= 0.5:
                        spans.append({"label": label, "first": first, "last": last, "covered": covered, "share": share})
                starts = [start for _, start in places]
                base = {scanner.phrases[p] for p, _ in places}
                labels = base | {s["label"] for s in spans if s["share"] >= min_share}
                rows["n_words"].append(len(words))
                rows["n_base"].append(len(places))
                rows["first_word"].append(min(starts, default=None))
                rows["last_word"].append(max(starts, default=None))
                rows["base_labels"].append(",".join(sorted(base)))
                rows["labels"].append(",".join(sorted(labels)))
                rows["score"].append(max((s["share"] for s in spans), default=0.0))
                rows["spans"].append(spans)
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], *[pa.array(rows[f.name], f.type) for f in _ARROW if f.name != "doc_id"]], schema=_ARROW
            )

    own = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(scan, SCHEMA)
