"""Licence scans through a positional index of rare tokens.

Each licence is a template: its words, the key phrases that must stand in place, and a label. For every
template the index holds its rarest words (highest inverse document frequency over all documents) as
postings (template, position). A file's occurrences of those words give postings; template positions are
subtracted from file positions, and words that agree on the start propose a place. A place is accepted
only where all mandatory key phrases stand at their relative positions and enough of the words agree.

The base phrases are templates of their own whose only key phrase is the whole phrase, so that every
accepted place of theirs is an occurrence, and each occurrence is proposed through its rarest word.

Score: the largest share of a template's words that stand in place, over the accepted places; 0 without.

Defined cases: null and empty texts have no words, labels "" and score 0; documents are handled one by
one, so repeated rows give repeated rows; a null doc_id is kept; an empty table gives no row.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, whole_text

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def words_of(text: str) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters, as UTF-8."""
    return _WORDS(text.encode("utf-8", "surrogatepass").lower())


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[int, int], ...]  # (start, end) of mandatory phrases
    base: bool = False
    least: float = 0.6


def template(label: str, text: str, *keys: str) -> Template:
    words = tuple(words_of(text))
    spans = []
    for key in keys:
        k = tuple(words_of(key))
        at = next(i for i in range(len(words)) if words[i : i + len(k)] == k)
        spans.append((at, at + len(k)))
    return Template(label, words, tuple(spans))


def phrase(label: str, text: str) -> Template:
    words = tuple(words_of(text))
    return Template(label, words, ((0, len(words)),), base=True)


#: The phrases and labels that the query's contract names.
BASE = (phrase("mit", "mit license"), phrase("apache", "apache license"), phrase("gpl", "general public license"))

#: Openings and notices of widely used licences.
TEMPLATES = (
    template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "free of charge", "to any person obtaining a copy"),
    template("mit", "Released under the MIT License", "MIT License"),
    template("apache", "Licensed under the Apache License, Version 2.0", "Apache License"),
    template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at", "except in compliance with the License"),
    template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "GNU General Public License"),
    template("gpl", "This work is licensed under the GNU General Public License, version 3", "GNU General Public License"),
    template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "GNU Lesser General Public License"),
    template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "GNU Affero General Public License"),
    template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "in source and binary forms", "with or without modification"),
    template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License"),
    template("epl", "made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License"),
    template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0"),
    template("cc-by-nc", "Licensed under CC BY-NC 4.0", "CC BY NC"),
    template("unlicense", "This is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def document_frequencies(docs: DataFrame, vocabulary: frozenset[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many documents each word of the vocabulary stands, and how many documents there are.

    Only counts come to the driver, one for each word of the fixed vocabulary.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        n = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                n += 1
                seen.update(vocabulary.intersection(words_of(text)))
        rows = [(w.decode(), c) for w, c in seen.items()] + [("", n)]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows]), pa.array([c for _, c in rows], pa.int64())], names=["word", "n"])

    rows = docs.select(whole_text().alias("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r.word.encode(): r.n for r in rows}
    return found, found.pop(b"", 0)


class Index:
    """Postings of each template's rarest words."""

    def __init__(self, templates: Iterable[Template], frequency: dict[bytes, int], n_docs: int, rare: int = 5):
        self.templates = tuple(templates)
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed = []
        for t, one in enumerate(self.templates):
            idf = {w: math.log((1 + n_docs) / (1 + frequency.get(w, 0))) for w in one.words}
            chosen = sorted(idf, key=lambda w: (-idf[w], w))[: 1 if one.base else rare]
            # A phrase needs its one word. Elsewhere two agree, though a key phrase alone may hold fewer.
            self.needed.append(1 if one.base else min(2, len(chosen)))
            for p, w in enumerate(one.words):
                if w in chosen:
                    self.postings[w].append((t, p))
        self.postings = dict(self.postings)

    def places(self, words: list[bytes]) -> Iterator[tuple[int, int, float]]:
        """Template, start and coverage of each accepted place."""
        rare = self.postings
        votes: Counter[tuple[int, int]] = Counter()
        for at in [i for i, w in enumerate(words) if w in rare]:
            for t, p in rare[words[at]]:
                votes[t, at - p] += 1
        for (t, start), n in votes.items():
            one = self.templates[t]
            if n < self.needed[t] or any(start + a < 0 or tuple(words[start + a : start + b]) != one.words[a:b] for a, b in one.keys):
                continue
            first = max(0, -start)
            same = sum(x == y for x, y in zip(one.words[first:], words[start + first : start + len(one.words)], strict=False))
            if same >= one.least * len(one.words):
                yield t, start, same / len(one.words)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("templates", pa.list_(pa.int32()))])


def scan_licenses(docs: DataFrame, base: Iterable[Template] = BASE, more: Iterable[Template] = TEMPLATES) -> DataFrame:
    """One row per document: word and place counts, labels, score, and the accepted templates' numbers."""
    every = (*base, *more)
    frequency, n_docs = document_frequencies(docs, frozenset(w for t in every for w in t.words))
    index = Index(every, frequency, n_docs)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                found = list(index.places(words))
                starts = [s for t, s, _ in found if every[t].base]
                labels = [{every[t].label for t, _, _ in found if every[t].base or not only} for only in (True, False)]
                rows.append((doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None), *(",".join(sorted(x)) for x in labels), max((c for _, _, c in found), default=0.0), sorted({t for t, _, _ in found})))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)], schema=_RESULT)

    texts = docs.select("doc_id", whole_text().alias("text"))
    return texts.mapInArrow(scan, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, templates array<int>")
