"""License scans: matching statistics against a generalised suffix automaton of template words."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.common import ids_and_texts, short_batches

# The phrases and labels of the base scan.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Well-known opening or granting sentences of public licences.
TEMPLATES = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "bsd-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-text": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mit-release": "Released under the MIT License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
}
#: Words of a match that may be chained, words that a gap in a chain may hold, share of a template covered.
LONG, GAP, COVERED = 3, 3, 0.8
PIECE = 1 << 20
#: Bytes of a word become themselves (A-Z lower-cased), all other ASCII characters become spaces.
_BLANK = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BLANK).split()


def word_runs(text: str):
    """The words of a text in runs of about ``PIECE`` bytes."""
    data = text.encode("utf-8", "surrogatepass").translate(_BLANK)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences.

    A state stands for word runs that end at the same template positions; ``longest`` is the length of its
    longest run, ``link`` the state of the longest run that ends at more positions, and ``ends`` names one
    (template, position) at which its runs end.
    """

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.ends: list[tuple[int, int]] = [(-1, 0)]
        for number, words in enumerate(sequences):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word, (number, at))
        self.order = sorted(range(1, len(self.next)), key=self.longest.__getitem__)

    def _state(self, longest: int, ends: tuple[int, int]) -> int:
        self.next.append({})
        self.link.append(0)
        self.longest.append(longest)
        self.ends.append(ends)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes, old: int) -> int:
        """The state of runs ending in ``word`` after ``state``, cut off ``old`` if that also holds longer ones."""
        if self.longest[old] == self.longest[state] + 1:
            return old
        new = self._state(self.longest[state] + 1, self.ends[old])
        self.next[new], self.link[new] = dict(self.next[old]), self.link[old]
        self.link[old] = new
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = new
            state = self.link[state]
        return new

    def _extend(self, last: int, word: bytes, ends: tuple[int, int]) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new, state = self._state(self.longest[last] + 1, ends), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        self.link[new] = 0 if state < 0 else self._split(state, word, self.next[state][word])
        return new

    def step(self, state: int, length: int, word: bytes) -> tuple[int, int]:
        """The state and length of the longest run that ends at this word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.longest[state]
        if word in self.next[state]:
            return self.next[state][word], length + 1
        return 0, 0

    def run_state(self, words: list[bytes]) -> int:
        state = 0
        for word in words:
            state = self.next[state][word]
        return state


class LicenseIndex:
    """The automaton of phrases and templates, with what its states report."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES):
        self.phrase_words = [words_of(p) for p in phrases]
        self.phrase_labels = list(phrases.values())
        self.template_words = [words_of(t) for t in templates.values()]
        self.template_labels = list(templates)
        sequences = self.phrase_words + self.template_words
        self.auto = SuffixAutomaton(sequences)
        self.vocabulary = {w for s in sequences for w in s}
        # phrases that are a suffix of every run of the state long enough: those of the state and of its links
        own: dict[int, list[int]] = {}
        for number, words in enumerate(self.phrase_words):
            own.setdefault(self.auto.run_state(words), []).append(number)
        self.phrases: list[list[int]] = [[] for _ in self.auto.next]
        for state in self.auto.order:
            self.phrases[state] = own.get(state, []) + self.phrases[self.auto.link[state]]
        # template positions at which a run of the state ends
        self.places: list[set[tuple[int, int]]] = [set() for _ in self.auto.next]
        for number, words in enumerate(self.template_words):
            state = 0
            for at, word in enumerate(words):
                state = self.auto.next[state][word]
                self.places[state].add((number, at))
        for state in reversed(self.auto.order):
            self.places[self.auto.link[state]] |= self.places[state]

    def scan(self, text: str) -> dict:
        """Base places, and template spans (label, first word, last word, share covered) of one text."""
        auto, known = self.auto, self.vocabulary
        state = length = at = 0
        places: list[tuple[int, int]] = []
        chains: list[dict[int, list]] = [{} for _ in self.template_words]  # template: shift -> [last word, first, covered, template position]
        spans: dict[int, list[tuple[float, int, int]]] = {}
        for words in word_runs(text):
            if known.isdisjoint(words):
                state, length, at = 0, 0, at + len(words)
                continue
            for k in [k for k, w in enumerate(words) if w in known]:
                here = at + k
                if k == 0 or words[k - 1] not in known:
                    if k:
                        state = length = 0
                state, length = auto.step(state, length, words[k])
                for number in self.phrases[state]:
                    size = len(self.phrase_words[number])
                    if length >= size:
                        places.append((here - size + 1, number))
                if length >= LONG:
                    for number, end in self.places[state]:
                        self._chain(chains[number], spans, number, here, end, length)
            if words and words[-1] not in known:
                state = length = 0
            at += len(words)
        return {"n_words": at, "places": places, "spans": [(self.template_labels[n], *s) for n, found in sorted(spans.items()) for s in found]}

    def _chain(self, open_chains: dict, spans: dict, number: int, here: int, end: int, length: int) -> None:
        """Join the match that ends at word ``here`` and template position ``end`` to a chain close before it."""
        size = len(self.template_words[number])
        start, first = end - length + 1, here - length + 1
        best = None
        for shift in list(open_chains):
            last, begun, covered, upto = open_chains[shift]
            if here - last > GAP + size:
                del open_chains[shift]
            elif upto < end and here - last <= GAP + length and end - upto <= GAP + length:
                gained = min(length, end - upto, here - last)
                if best is None or covered + gained > best[2]:
                    best = [here, begun, covered + gained, end]
        if best is None or length > best[2]:
            best = [here, first, length, end]
        open_chains[here - end] = best
        share = best[2] / size
        if share >= COVERED:
            # the best of chains that overlap; a chain that begins past the last span is one more
            found = spans.setdefault(number, [])
            if not found or best[1] > found[-1][2]:
                found.append((share, best[1], here))
            elif share > found[-1][0]:
                found[-1] = (share, best[1], here)


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Licence findings of every document.

    n_base counts the places of base phrases, first_word and last_word are their smallest and largest start
    (null without any), base_labels and labels list distinct labels in order, spans holds the covered template
    spans (label, share of the template covered, first and last word), score is the largest share, and 1 where
    a base phrase stands.  Texts are streamed word by word with the automaton's state, so memory does not grow
    with a text's length.  Null and empty texts have no words and score 0; every row reports for itself; an
    empty table gives no rows.
    """
    short_batches(docs.sparkSession)
    index = LicenseIndex(phrases, templates)
    span = pa.struct([("label", pa.string()), ("covered", pa.float64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches):
        for batch in batches:
            found = [index.scan(t) for t in batch.column(1).to_pylist()]
            base = [sorted({index.phrase_labels[n] for _, n in f["places"]}) for f in found]
            every = [sorted({*b, *(s[0] for s in f["spans"])}) for b, f in zip(base, found)]
            starts = [[s for s, _ in f["places"]] for f in found]
            columns = {
                "doc_id": batch.column(0),
                "n_words": pa.array([f["n_words"] for f in found], pa.int64()),
                "n_base": pa.array([len(s) for s in starts], pa.int64()),
                "first_word": pa.array([min(s, default=None) for s in starts], pa.int64()),
                "last_word": pa.array([max(s, default=None) for s in starts], pa.int64()),
                "base_labels": pa.array([",".join(b) for b in base], pa.string()),
                "labels": pa.array([",".join(e) for e in every], pa.string()),
                "score": pa.array([1.0 if s else max((x[1] for x in f["spans"]), default=0.0) for s, f in zip(starts, found)], pa.float64()),
                "spans": pa.array([[dict(zip(("label", "covered", "first", "last"), s)) for s in f["spans"]] for f in found], pa.list_(span)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label: string, covered: double, first: long, last: long>>"
    )
    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, schema)
