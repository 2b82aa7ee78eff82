"""License scan with a positional index of rare words.

A template is a short license notice: its label, its words, and mandatory key phrases. The weight of a license word is
its inverse document frequency, counted over all documents. A template matches a text at a place if words of at least
``cover`` of its weight stand at their positions relative to that place, and its key phrases are among the words there,
unbroken.

The index has postings ``(template, position)`` of each template's rarest words only: of its positions in order of
falling weight, those before which the weight that is left reaches the required cover. A match has to agree in one of
these, so looking up the rare words of a text finds every match. Each look-up names a template and the place where
it would begin; equal names are put together, every such place is intersected with the template's words by relative
position, and the key phrases are verified where the weight suffices. Phrases of which every word is mandatory are
templates of cover 1.

Weights are whole numbers, so sums do not depend on their order. Templates are a list the caller writes; a task holds
them, their index and one batch of texts.

Defined results: NULL and empty texts have no words and no matches; a notice cut off by the text's end matches if what
is there has the weight; repeated notices are all reported, ordered by first word, label and template; repeated rows
are scanned alike; a very long text is a batch of its own, whole; empty tables give empty results. Words no document
has get the highest weight. Other columns are kept, and must not bear one of the names added.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.llm.common import flat, slices
from telemetry_lake.llm.grams import FOLD

BATCH_BYTES = 4 << 20
# Share of a template's weight that has to stand in place, in percent.
COVER = 80
# Candidate places whose words are compared with a template at a time.
COMPARED = 1 << 14

MATCH = T.StructType([
    T.StructField("label", T.StringType(), False),
    T.StructField("template", T.IntegerType(), False),
    T.StructField("first_word", T.LongType(), False),
    T.StructField("covered", T.LongType(), False),
    T.StructField("weight", T.LongType(), False),
    T.StructField("exact", T.BooleanType(), False),
])
ADDED = T.StructType([
    T.StructField("n_words", T.LongType(), False),
    T.StructField("matches", T.ArrayType(MATCH, False), False),
])


@dataclass(frozen=True)
class Template:
    """A license notice; with ``exact`` all its words are mandatory."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    exact: bool = False

    @property
    def words(self) -> list[str]:
        return words_in(self.text)


def words_in(text: str) -> list[str]:
    """Words of a text: runs of letters and digits of ASCII, A-Z in lower case, and of all characters beyond it."""
    folded = re.sub("[A-Z]", lambda found: found[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


# Phrases that name a license, and their labels.
PHRASES = [
    Template("mit", "under the mit license", exact=True),
    Template("apache-2", "apache license version 2", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
]
# The public wording of common license notices.
NOTICES = [
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the Software), to deal in the Software without restriction", ("permission is hereby granted",)),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
             "with the License", ("apache license",)),
    Template("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license", "2 0")),
    Template("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 "
             "of the License, or (at your option) any later version", ("gnu general public license", "version 2")),
    Template("gpl-2", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    Template("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
             "of the License, or (at your option) any later version", ("gnu general public license", "version 3")),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
             ("gnu lesser general public license",)),
    Template("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
             "version 3 of the License", ("gnu affero general public license",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met", ("source and binary forms",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted", ("with or without fee",)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software",)),
    Template("cc0", "The person who associated a work with this deed has dedicated the work to the public domain", ("public domain",)),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License",
             ("attribution sharealike",)),
    Template("cc-by-nc", "Licensed under CC BY NC 4.0", ("cc by nc",)),
]
TEMPLATES = [*PHRASES, *NOTICES]


def coded(column: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each word of the texts, one text behind the other, as its place in ``vocabulary`` or -1, and the texts' bounds."""
    data, offsets = flat(column)
    folded = FOLD[data]
    inside = folded != 32
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    head[begins] = inside[begins]
    tail = inside.copy()
    tail[:-1] &= head[1:] | ~inside[1:]
    first, stop = np.flatnonzero(head), np.flatnonzero(tail) + 1
    letters = np.concatenate([[0], np.cumsum(stop - first)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(letters.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(folded[inside]))]
    )
    codes = pc.index_in(words, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, np.searchsorted(first, offsets)


def vocabulary_of(templates: Sequence[Template]) -> pa.Array:
    return pa.array(sorted({word.encode() for template in templates for word in template.words}), pa.large_binary())


class RareIndex:
    """Templates as word numbers, their weights, and the postings of their rarest words."""

    def __init__(self, templates: Sequence[Template], weights: dict[bytes, int], cover: int):
        self.templates = templates
        self.vocabulary = vocabulary_of(templates)
        place = {word: i for i, word in enumerate(self.vocabulary.to_pylist())}
        weight = [weights[word] for word in place]
        self.weights = np.array(weight, np.int64)
        self.words = [np.array([place[word.encode()] for word in t.words], np.int64) for t in templates]
        self.keys = [[np.array([place[word.encode()] for word in words_in(key)], np.int64) for key in t.keys] for t in templates]
        self.totals = [int(self.weights[words].sum()) for words in self.words]
        self.covers = [100 if t.exact else cover for t in templates]
        postings: list[list[tuple[int, int]]] = [[] for _ in place]
        for number, (words, total, required) in enumerate(zip(self.words, self.totals, self.covers, strict=True)):
            left = total
            for position in sorted(range(len(words)), key=lambda p: (-weight[words[p]], p)):
                if 100 * left < required * total:
                    break
                postings[words[position]].append((number, position))
                left -= weight[words[position]]
        self.first = np.cumsum([0, *map(len, postings)])
        pairs = [pair for own in postings for pair in own]
        self.template = np.array([number for number, _ in pairs], np.int64)
        self.position = np.array([position for _, position in pairs], np.int64)

    def candidates(self, codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct ``(template, place, text)`` that a rare word speaks for; a place is the number of a word, and may
        lie before its text."""
        at = np.flatnonzero(codes >= 0)
        many = self.first[codes[at] + 1] - self.first[codes[at]]
        at, many = at[many > 0], many[many > 0]
        posting = np.repeat(self.first[codes[at]] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        at = np.repeat(at, many)
        place, template = at - self.position[posting], self.template[posting]
        order = np.lexsort((place, text[at], template))
        template, place, text = template[order], place[order], text[at][order]
        new = np.ones(len(order), bool)
        new[1:] = (template[1:] != template[:-1]) | (place[1:] != place[:-1]) | (text[1:] != text[:-1])
        return template[new], place[new], text[new]

    def matches(self, codes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(text, place, template, covered weight)`` of all matches, places counted from each text's first word."""
        text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        template, place, text = self.candidates(codes, text_of)
        out = []
        edges = np.searchsorted(template, np.arange(len(self.templates) + 1))
        for number, (low, high) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            words = self.words[number]
            for begin in range(low, high, COMPARED):
                part = slice(begin, min(begin + COMPARED, high))
                spots = place[part, None] + np.arange(len(words))
                inside = (spots >= bounds[text[part], None]) & (spots < bounds[text[part] + 1, None])
                same = inside & (codes[np.clip(spots, 0, len(codes) - 1)] == words)
                covered = same @ self.weights[words]
                good = 100 * covered >= self.covers[number] * self.totals[number]
                for key in self.keys[number]:
                    # Where the template has the phrase does not matter, as long as the text has it in that stretch.
                    window = np.where(inside, codes[np.clip(spots, 0, len(codes) - 1)], -1)
                    found = np.zeros(len(window), bool)
                    for shift in range(len(words) - len(key) + 1):
                        found |= (window[:, shift : shift + len(key)] == key).all(1)
                    good &= found
                for k in np.flatnonzero(good).tolist():
                    own = int(text[begin + k])
                    # A notice whose beginning is not in the text begins with the text's first word.
                    out.append((own, max(int(place[begin + k] - bounds[own]), 0), number, int(covered[k])))
        return out


def document_counts(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text") -> tuple[int, dict[bytes, int]]:
    """The number of documents, and of those that hold each license word; as many sums as the templates have words."""
    vocabulary = vocabulary_of(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                codes, bounds = coded(part.column(text), vocabulary)
                text_of = np.repeat(np.arange(part.num_rows), np.diff(bounds))[codes >= 0]
                seen = np.unique(text_of * len(vocabulary) + codes[codes >= 0]) % max(len(vocabulary), 1)
                counts += np.bincount(seen, minlength=len(vocabulary))
                rows += part.num_rows
        words = pa.array([*range(len(vocabulary)), -1], pa.int32())
        yield pa.RecordBatch.from_arrays([words, pa.array([*counts.tolist(), rows], pa.int64())], names=["word", "n"])

    totals = {row.word: row.n for row in docs.select(text).mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return totals.get(-1, 0), {word: totals.get(i, 0) for i, word in enumerate(vocabulary.to_pylist())}


def idf_weights(rows: int, counts: dict[bytes, int]) -> dict[bytes, int]:
    """Inverse document frequencies in thousandths, at least 1."""
    return {word: 1 + math.floor(1000 * math.log((rows + 1) / (n + 1))) for word, n in counts.items()}


def scan_licenses(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, cover: int = COVER, text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_words`` and ``matches`` of the templates: label, template number, first word, the weight
    that stands in place and the template's whole weight, and whether every word of the template was mandatory.

    The texts are read twice, first for the document frequencies of the license words.
    """
    if clash := set(ADDED.fieldNames()) & set(docs.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    if not 0 < cover <= 100 or any(not template.words for template in templates):
        raise ValueError("cover is a percentage, and every template has words")
    index = RareIndex(templates, idf_weights(*document_counts(docs, templates, text)), cover)
    kind = pa.list_(pa.field("element", pa.struct([
        pa.field("label", pa.string(), False), pa.field("template", pa.int32(), False), pa.field("first_word", pa.int64(), False),
        pa.field("covered", pa.int64(), False), pa.field("weight", pa.int64(), False), pa.field("exact", pa.bool_(), False),
    ]), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                codes, bounds = coded(part.column(text), index.vocabulary)
                found: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for own, place, number, covered in index.matches(codes, bounds):
                    template = index.templates[number]
                    found[own].append({"label": template.label, "template": number, "first_word": place, "covered": covered,
                                       "weight": index.totals[number], "exact": template.exact})
                for own in found:
                    own.sort(key=lambda match: (match["first_word"], match["label"], match["template"]))
                new = [pa.array(np.diff(bounds), pa.int64()), pa.array(found, kind)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *ADDED.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *ADDED.fields]))
