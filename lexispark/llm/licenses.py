"""License scans: phrases, and an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import lean, short_batches

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices of public licenses and their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("reserved", "all rights reserved"),
]
#: Share of a template's distinct words that a block must hold; words of a block and its step within longer lines.
CONTAINED, BLOCK, STEP = 0.8, 200, 100
#: Words over which a notice may be spread across lines, times its own.
SPREAD = 2

FOUND = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def _words(raw: bytes) -> list[bytes]:
    return WORD.findall(raw.lower())


class TemplateIndex:
    """Templates under a global order of words, rarest first, with the postings of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], contained: float):
        order = lambda w: (frequency.get(w, 0), w)
        self.labels = [label for label, _ in templates]
        self.sets = [sorted(set(_words(text.encode())), key=order) for _, text in templates]
        self.least = [math.ceil(contained * len(s) - 1e-9) for s in self.sets]
        self.place = {w: k for k, w in enumerate(sorted({w for s in self.sets for w in s}, key=order))}
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, s in enumerate(self.sets):
            for p, w in enumerate(s[: len(s) - self.least[t] + 1]):
                self.postings.setdefault(w, []).append((t, p))
        self.probe = frozenset(self.postings)
        self.reach = [SPREAD * len(_words(text.encode())) for _, text in templates]

    def matches(self, block: set[bytes]) -> dict[int, float]:
        """Containment of each template that the block holds. Words outside the templates come last in the order, so
        the position of a word within a block counts template words alone, and the rest only adds to its length."""
        if self.probe.isdisjoint(block):
            return {}
        own = sorted(block & self.place.keys(), key=self.place.__getitem__)
        out, tried = {}, set()
        for q, w in enumerate(own):
            for t, p in self.postings.get(w, ()):
                if t in tried:
                    continue
                tried.add(t)
                need = self.least[t]
                if len(block) < need or 1 + min(len(self.sets[t]) - p - 1, len(own) - q - 1) < need:
                    continue  # length filter; positional filter: too little is left on either side
                n = sum(x in block for x in self.sets[t])
                if n >= need:
                    out[t] = n / len(self.sets[t])
        return out


    def wrapped(self, words: list[bytes]) -> dict[int, float]:
        """Containment of each template in the best run of words SPREAD times as long as it, wherever lines end."""
        held, out = set(words) & self.place.keys(), {}
        for t, s in enumerate(self.sets):
            if sum(x in held for x in s) < self.least[t]:
                continue
            own, inside, best, first = frozenset(s), Counter(), 0, 0
            at = [k for k, w in enumerate(words) if w in own]
            for k in at:
                inside[words[k]] += 1
                while k - at[first] >= self.reach[t]:
                    w = words[at[first]]
                    inside[w] -= 1
                    if not inside[w]:
                        del inside[w]
                    first += 1
                best = max(best, len(inside))
            if best >= self.least[t]:
                out[t] = best / len(s)
        return out


def blocks_of(raw: bytes) -> Iterator[list[bytes]]:
    """Lines; a line of more than BLOCK words as windows of BLOCK words, STEP apart."""
    for line in raw.split(b"\n"):
        words = _words(line)
        for a in range(0, max(1, len(words) - BLOCK + STEP), STEP) if len(words) > BLOCK else (0,):
            yield words[a : a + BLOCK]


@lean
def _frequency(batches: Iterable[pa.RecordBatch], words: frozenset) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for raw in batch.column(0):
            total.update(words.intersection(_words(raw.as_py() or b"")))
    yield pa.record_batch([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])


@lean
def _scan(batches: Iterable[pa.RecordBatch], index: TemplateIndex, phrases: dict[str, str]) -> Iterator[pa.RecordBatch]:
    split = [(p.encode().split(), label) for p, label in phrases.items()]
    rare = [p.split()[-1].encode() for p in phrases]
    for batch in batches:
        rows = []
        for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = (raw.as_py() or b"").lower()
            words = _words(raw)
            at, base = [], set()
            if any(r in raw for r in rare):
                for phrase, label in split:
                    k = -1
                    with_last = phrase[-1]
                    try:
                        while True:
                            k = words.index(with_last, k + 1)
                            begin = k - len(phrase) + 1
                            if begin >= 0 and words[begin : k + 1] == phrase:
                                at.append(begin)
                                base.add(label)
                    except ValueError:
                        pass
            best, labels = float(bool(base)), set(base)
            if not index.probe.isdisjoint(words):
                for found in (index.wrapped(words), *(index.matches(set(block)) for block in blocks_of(raw))):
                    for t, share in found.items():
                        labels.add(index.labels[t])
                        best = max(best, share)
            rows.append((doc, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)] if rows else [pa.array([], t) for t in _TYPES], names=_NAMES)


_NAMES = [x.split()[0] for x in FOUND.split(", ")]
_TYPES = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, contained: float = CONTAINED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """FOUND for each row: places of the phrases, and labels of all templates contained in a block of the text or in a short run of its words.

    The words of the templates are ordered by how many documents of the whole corpus hold them; the templates are a
    fixed list, so their index goes to every task. score is 1 for a phrase, else the best containment, else 0. Null
    and empty texts have no words; repeated rows and null doc_ids give a row each; an empty table gives no rows;
    columns other than the two named are not read.
    """
    short_batches(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    vocabulary = frozenset(w for _, text in templates for w in _words(text.encode()))
    counts = two.select("text").mapInArrow(functools.partial(_frequency, words=vocabulary), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    index = TemplateIndex(templates, {bytes(r["word"]): r["n"] for r in counts.collect()}, contained)
    return two.mapInArrow(functools.partial(_scan, index=index, phrases=phrases), FOUND)
