"""License scans: which license templates and phrases a text holds.

Templates are found by an exact set-similarity join between the texts' blocks and a table of templates.  For a template,
the blocks of a text are all runs of words in a paragraph (lines up to a blank one) of the template's length and a quarter
more, two words at least, so that a few words may stand between its own; line breaks, comment marks and comment words at
line starts make no difference.  (Much longer runs would take the words of a neighbouring notice for this one's.)  Words are ordered by how many documents of the whole table hold them, rarest first.  A block that holds at
least a share t of a template's n distinct words must hold one of the n - ceil(t n) + 1 rarest (prefix filter), must have
at least ceil(t n) distinct words itself (length filter), and what can still follow a shared word in both orders must
suffice (positional filter); what passes is verified on the sets.  The filters see whole paragraphs, which hold all that
their blocks hold, so they lose no block.

Defined cases: a null text is empty, with no words, no labels and score 0; every row gives a row, whatever its doc_id;
further columns are ignored; a block of any length is taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorframe.llm.common import small_batches

# Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Template texts and their labels.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-3-clause": "Released under the BSD 3-Clause License",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "lgpl": "under the terms of the GNU Lesser General Public License",
    "agpl": "under the terms of the GNU Affero General Public License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by-4.0": "Licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
THRESHOLD = 0.9
# Words that mark a line as a comment.
COMMENTS = frozenset((b"dnl", b"rem"))

_WORDS = bytes(ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))


def words_of(text: str | bytes | None) -> list[bytes]:
    """Words in lower case: runs of ASCII letters and digits and of all other non-ASCII characters."""
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(_WORDS).split()


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """All starts at which the phrase's words stand one after another."""
    out, at = [], -1
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return out
        if words[at : at + len(phrase)] == phrase:
            out.append(at)


def template_frequencies(docs: DataFrame, templates: dict[str, str]) -> dict[bytes, int]:
    """In how many documents of the whole table each word of the templates occurs.

    Tasks count their own documents; the words are those of the templates, so what is summed and returned is bounded.
    """
    known = frozenset(w for t in templates.values() for w in words_of(t))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = dict.fromkeys(sorted(known), 0)
        for batch in batches:
            for text in batch.column(0):
                for w in known.intersection(words_of(text.as_py())):
                    counts[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    counted = small_batches(docs).select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class TemplateIndex:
    """Templates in the global word order, with the postings of their prefixes."""

    def __init__(self, templates: dict[str, str], frequency: dict[bytes, int], threshold: float):
        self.rank = {w: i for i, w in enumerate(sorted(frequency, key=lambda w: (frequency[w], w)))}
        self.sets: dict[str, frozenset[bytes]] = {}
        self.needed: dict[str, int] = {}
        self.widths: dict[str, int] = {}
        self.postings: dict[bytes, list[tuple[str, int]]] = {}
        for label, text in sorted(templates.items()):
            order = sorted(set(words_of(text)), key=self.rank.__getitem__)
            self.sets[label], self.needed[label] = frozenset(order), ceil(threshold * len(order) - 1e-9)
            length = len(words_of(text))
            self.widths[label] = length + max(2, length // 4)
            for place, w in enumerate(order[: len(order) - self.needed[label] + 1]):
                self.postings.setdefault(w, []).append((label, place))
        self.prefixes = frozenset(self.postings)

    def matches(self, block: bytes) -> Iterator[tuple[str, float]]:
        """(label, containment) of the templates that the block holds."""
        held = frozenset(words_of(block))
        order = sorted((w for w in held if w in self.rank), key=self.rank.__getitem__)
        tried = set()
        for place, w in enumerate(order):
            for label, at in self.postings.get(w, ()):
                need = self.needed[label]
                if label in tried or len(held) < need:
                    continue
                if 1 + min(len(self.sets[label]) - at - 1, len(order) - place - 1) + min(at, place) < need:
                    continue
                tried.add(label)
                shared = len(self.sets[label] & held)
                if shared >= need:
                    yield label, shared / len(self.sets[label])

    def _in_a_run(self, words: list[bytes], label: str) -> int:
        """The most of the template's words in one of its blocks."""
        wanted, width = self.sets[label], self.widths[label]
        hits = [(i, w) for i, w in enumerate(words) if w in wanted]
        inside: dict[bytes, int] = {}
        most = first = 0
        for i, w in hits:
            inside[w] = inside.get(w, 0) + 1
            while hits[first][0] <= i - width:
                gone = hits[first][1]
                first += 1
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
            most = max(most, len(inside))
        return most

    def found(self, text: bytes) -> dict[str, float]:
        """The largest containment by label of the templates that a block of the text holds."""
        best: dict[str, float] = {}
        for lines in _paragraphs(text):
            words = None
            for label, share in self.matches(b"\n".join(lines)):
                if best.get(label, 0.0) < share:  # the paragraph holds as much as any of its blocks
                    words = words or [w for line in lines for w in _uncommented(line)]
                    if (n := self._in_a_run(words, label)) >= self.needed[label]:
                        best[label] = max(n / len(self.sets[label]), best.get(label, 0.0))
        return best


def _uncommented(line: bytes) -> list[bytes]:
    words = words_of(line)
    return words[1:] if words and words[0] in COMMENTS else words


def _paragraphs(text: bytes) -> Iterator[list[bytes]]:
    """Runs of lines that are not blank."""
    for blank, lines in groupby(text.split(b"\n"), lambda line: not line.strip()):
        if not blank:
            yield list(lines)


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row for every row of docs.

    doc_id, n_words; n_base, first_word, last_word, base_labels: places and labels of the phrases; labels: those and the
    templates' (arrays, distinct and sorted); score: the largest containment of a found template, 1 where a phrase stands.
    """
    frequency = template_frequencies(docs, templates)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                        ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(templates, frequency, threshold)
        split = {label: words_of(p) for p, label in phrases.items()}
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = (text.as_py() or "").encode()
                words = words_of(data)
                places = {label: found for label, phrase in split.items() if (found := phrase_places(words, phrase))}
                starts = [p for found in places.values() for p in found]
                found = {} if index.prefixes.isdisjoint(words) else index.found(data)
                out.append({"doc_id": doc_id, "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                            "base_labels": sorted(places), "labels": sorted({*places, *found}), "score": 1.0 if places else max(found.values(), default=0.0)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    fields = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double"
    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, fields)
