"""Operator 11: license scans as an exact set-similarity join of text blocks with license templates.

Words are runs of digits, letters and non-ASCII bytes after A-Z is lower-cased.
A template's tokens are its distinct words. Templates of up to S words (S a
power of two) are held against *blocks*: the words kS to (k+2)S - 1 of a text,
for every k, so any S + 1 consecutive words stand together in a block. A block
meets a template T when it holds at least ``percent`` per cent of T's tokens,
``need(T)`` of them.

All tokens are ordered by their count in the whole corpus, rarest first (a
first pass; ties by hash). Then, without loss:

* prefix filter: a block that lacks the first |T| - need + 1 tokens of T can't
  hold ``need`` of them, so only blocks with one of these are candidates;
* length filter: the block must have ``need`` tokens that occur in templates;
* positional filter: with the first common token at position i of T and at
  position j of the block, at most min(|T| - i, |block| - j) tokens are common;
* the survivors' intersections are counted in full.

Phrases are templates of 100 per cent whose block is as long as the phrase: the
prefix is the rarest word, its position fixes where the phrase would stand, and
the words there are compared in order.

Templates come as a list. One pass carries at most ``PASS_TOKENS`` distinct
tokens to the tasks; longer lists take further passes over the texts. Every
task handles whole texts in slices, so nothing is grouped or shuffled but the
token counts.

Defined results: a null or empty text has no words and no matches; null and
repeated ids keep their rows; equal rows get equal results; other columns are
ignored; an empty table gives no rows; templates without words never match.
"""

from __future__ import annotations

import itertools
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .frames import ship, unpack

PASS_TOKENS = 200_000
SMALLEST = 8


class Template(NamedTuple):
    """``percent`` of its distinct words must stand in one block; with ``phrase`` all words, consecutively."""

    label: str
    family: str
    text: str
    percent: int = 80
    phrase: bool = False


# Phrases of the base labels.
PHRASES = [
    Template("gpl", "phrase", "gnu general public license", 100, True),
    Template("apache", "phrase", "apache license", 100, True),
    Template("cc-by", "phrase", "cc by", 100, True),
    Template("mit", "phrase", "mit license", 100, True),
]
# Opening clauses of public licenses and their usual notices.
NOTICES = [
    Template("mit", "mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to "
             "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("isc", "isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("bsd", "bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met: Redistributions of source code must retain the above copyright notice"),
    Template("apache", "apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
             "with the License. You may obtain a copy of the License at"),
    Template("gpl", "gnu", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
             "License as published by the Free Software Foundation"),
    Template("lgpl", "gnu", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation"),
    Template("agpl", "gnu", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
             "Public License as published by the Free Software Foundation"),
    Template("mpl", "mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
             "distributed with this file, You can obtain one at"),
    Template("epl", "epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License", 90),
    Template("boost", "boost", "Distributed under the Boost Software License, Version 1.0", 100),
    Template("unlicense", "unlicense", "This is free and unencumbered software released into the public domain", 90),
    Template("cc0", "cc", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", 90),
    Template("cc-by", "cc", "licensed under a Creative Commons Attribution International License", 100),
    Template("cc-by-sa", "cc", "licensed under a Creative Commons Attribution ShareAlike International License", 100),
    Template("cc-by-nc", "cc", "licensed under a Creative Commons Attribution NonCommercial International License", 100),
    Template("cc-by-nd", "cc", "licensed under a Creative Commons Attribution NoDerivatives International License", 100),
    Template("cc-by-sa", "cc-short", "licensed under CC BY-SA", 100),
    Template("cc-by-nc", "cc-short", "licensed under CC BY-NC", 100),
    Template("cc-by-nd", "cc-short", "licensed under CC BY-ND", 100),
    Template("mit", "mit", "released under the MIT License", 100),
    Template("gpl", "gnu-short", "this work is licensed under the GNU General Public License, version", 90),
]

# Bytes between words, once A-Z counts as a-z.
_OUTSIDE = np.array([not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80) for b in range(256)])
_MATCH = "array<struct<label:string,family:string,phrase:boolean,best:boolean,start:long,past:long,overlap:int,containment:double>>"


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the words of a slice."""
    start, end, doc = K.word_spans(data, off, _OUTSIDE)
    return K.span_hashes(data, start, end), doc


def _text_words(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return _words(data, np.array([0, len(data)]))[0]


def passes(templates: list[Template], limit: int = PASS_TOKENS) -> list[list[Template]]:
    """The templates in runs of at most ``limit`` tokens; a family stays together, also if it is larger."""
    families: dict[str, list[Template]] = {}
    for t in templates:
        families.setdefault(t.family, []).append(t)
    out, held = [], 0
    for family in families.values():
        n = sum(len(np.unique(_text_words(t.text))) for t in family)
        if not out or held + n > limit:
            out.append([])
            held = 0
        out[-1] += family
        held += n
    return out


class TemplateIndex:
    """Templates over frequency-ordered tokens, with the prefixes as an inverted index per block size."""

    def __init__(self, templates: list[Template], counts: dict[int, int]):
        words = [_text_words(t.text) for t in templates]
        self.templates = templates
        self.vocabulary = np.unique(np.concatenate([*words, np.zeros(0, K.U)]))
        seen = np.array([counts.get(int(h), 0) for h in K.as_i64(self.vocabulary)], np.int64)
        self.rank = np.empty(len(seen), np.int64)
        self.rank[np.lexsort((self.vocabulary, seen))] = np.arange(len(seen))
        ranks = [self.rank[np.searchsorted(self.vocabulary, w)] for w in words]
        self.phrases = [(k, ranks[k], int(ranks[k].argmin())) for k, t in enumerate(templates) if t.phrase and len(words[k])]
        self.sets = [np.unique(r) for r in ranks]
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.need = np.array([-(-t.percent * len(s) // 100) for t, s in zip(templates, self.sets, strict=True)], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.concatenate([*self.sets, np.zeros(0, np.int64)])
        names = sorted({t.family for t in templates if not t.phrase})
        self.family = np.array([-1 if t.phrase else names.index(t.family) for t in templates], np.int64)
        v = max(1, len(self.vocabulary))
        self.members = np.sort(np.concatenate([k * v + s for k, s in enumerate(self.sets)])) if templates else np.zeros(0, np.int64)
        self.classes = {}  # block step: (first entry of each rank, template, position)
        by_step: dict[int, list[int]] = {}
        for k, t in enumerate(templates):
            if not t.phrase and len(words[k]):
                by_step.setdefault(max(SMALLEST, 1 << (len(words[k]) - 1).bit_length()), []).append(k)
        for step, ks in by_step.items():
            entries = sorted((int(r), k, i) for k in ks for i, r in enumerate(self.sets[k][:self.size[k] - self.need[k] + 1]))
            r, k, i = (np.array(x, np.int64) for x in zip(*entries, strict=True))
            self.classes[step] = (np.searchsorted(r, np.arange(v + 1)), k, i)


def _expand(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions first[i] .. first[i] + n[i] - 1 for every i, and the i of each."""
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner], owner


def find(data: np.ndarray, off: np.ndarray, index: TemplateIndex) -> tuple[np.ndarray, np.ndarray]:
    """Of a slice: word counts of the documents, and the matches as rows (document, template, start, past, overlap)."""
    n_docs = len(off) - 1
    h, doc = _words(data, off)
    bounds = K.doc_bounds(doc, n_docs)
    n_words = np.diff(bounds)
    found = [np.zeros((0, 5), np.int64)]
    if len(h) and len(index.vocabulary):
        v = np.minimum(np.searchsorted(index.vocabulary, h), len(index.vocabulary) - 1)
        at = np.flatnonzero(index.vocabulary[v] == h)
        rank = index.rank[v[at]]
        if len(at):
            found.append(_phrases(at, rank, doc, bounds, index))
            found += [_blocks(at - bounds[doc[at]], rank, doc[at], n_words, step, index) for step in index.classes]
    rows = np.concatenate(found)
    return n_words, rows[np.lexsort((rows[:, 1], rows[:, 2], rows[:, 0]))]


def best(rows: np.ndarray, index: TemplateIndex) -> np.ndarray:
    """Flags of the phrases, and of the matches with the largest share (then the most) of tokens found among
    those of one family in one block."""
    d, t, start, past, overlap = rows.T
    family, share = index.family[t], overlap / np.maximum(1, index.size[t])
    o = np.lexsort((overlap, share, past, start, family, d))
    last = np.ones(len(o), bool)
    for x in (d, family, start, past):
        last[:-1] &= x[o][1:] == x[o][:-1]
    last[:-1] = ~last[:-1]
    top = o[last][np.cumsum(last) - last]  # of each match in order, the last one of its group
    flags = np.empty(len(o), bool)
    flags[o] = (share[o] == share[top]) & (overlap[o] == overlap[top])
    return flags | (family < 0)


def _phrases(at, rank, doc, bounds, index) -> np.ndarray:
    of = np.full(bounds[-1], -1, np.int64)
    of[at] = rank
    out = [np.zeros((0, 5), np.int64)]
    for k, words, pivot in index.phrases:
        start = at[rank == words[pivot]] - pivot
        d = doc[start + pivot]
        ok = (start >= bounds[d]) & (start + len(words) <= bounds[d + 1])
        start, d = start[ok], d[ok]
        for j, w in enumerate(words):
            same = of[start + j] == w
            start, d = start[same], d[same]
        s = start - bounds[d]
        out.append(np.stack([d, np.full(len(s), k), s, s + len(words), np.full(len(s), index.size[k])], axis=1))
    return np.concatenate(out)


def _blocks(pos, rank, doc, n_words, step, index) -> np.ndarray:
    """Matches of the templates of one block step among the tokens (position, rank, document) of a slice."""
    first, template, place = index.classes[step]
    count = np.maximum(1, -(-n_words // step) - 1)
    base = np.concatenate([[0], np.cumsum(count)])

    def held(p, d):  # the one or two blocks around each position
        b = np.concatenate([p // step - 1, p // step])
        who = np.concatenate([np.arange(len(p)), np.arange(len(p))])
        ok = (b >= 0) & (b < count[d[who]])
        return (base[d[who]] + b)[ok], who[ok]
    hits, owner = _expand(first[rank], first[rank + 1] - first[rank])
    block, who = held(pos[owner], doc[owner])
    if not len(block):
        return np.zeros((0, 5), np.int64)
    t, i = template[hits[who]], place[hits[who]]
    o = np.lexsort((i, t, block))
    block, t, i = block[o], t[o], i[o]
    fresh = np.ones(len(block), bool)
    fresh[1:] = (block[1:] != block[:-1]) | (t[1:] != t[:-1])
    block, t, i = block[fresh], t[fresh], i[fresh]
    near, inverse = np.unique(block, return_inverse=True)
    every, who = held(pos, doc)
    k = np.minimum(np.searchsorted(near, every), len(near) - 1)
    mine = near[k] == every
    v = len(index.vocabulary)
    tokens = np.unique(k[mine] * v + rank[who[mine]])  # the candidate blocks' token sets, rarest first
    edge = np.searchsorted(tokens, np.arange(len(near) + 1) * v)
    size = np.diff(edge)[inverse]
    need, total = index.need[t], index.size[t]
    j = np.searchsorted(tokens, inverse * v + index.flat[index.first[t] + i]) - edge[inverse]
    ok = (size >= need) & (np.minimum(total - i, size - j) >= need)
    block, t, inverse, size = block[ok], t[ok], inverse[ok], size[ok]
    row, owner = _expand(edge[inverse], size)
    key = t[owner] * v + tokens[row] % v
    spot = np.minimum(np.searchsorted(index.members, key), len(index.members) - 1)
    overlap = np.bincount(owner[index.members[spot] == key], minlength=len(t))
    ok = overlap >= index.need[t]
    block, t, overlap = block[ok], t[ok], overlap[ok]
    d = np.searchsorted(base, block, side="right") - 1
    start = (block - base[d]) * step
    return np.stack([d, t, start, np.minimum(start + 2 * step, n_words[d]), overlap], axis=1)


def token_counts(docs: DataFrame, templates: list[Template], text: str = "text") -> dict[int, int]:
    """Occurrences of the templates' tokens in all texts, by hash."""
    vocabulary = np.unique(np.concatenate([_text_words(t.text) for t in templates]))
    held = ship(docs.sparkSession, vocabulary)

    def run(batches):
        vocab = unpack(held)
        n = np.zeros(len(vocab), np.int64)
        for batch in batches:
            for _, _, data, off in K.slices(batch):
                h, _ = _words(data, off)
                v = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
                n += np.bincount(v[vocab[v] == h], minlength=len(vocab))
        yield pa.RecordBatch.from_arrays([pa.array(K.as_i64(vocab[n > 0])), pa.array(n[n > 0])], names=["h", "n"])
    if not len(vocabulary):
        return {}
    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).collect()
    return {r["h"]: r["n"] for r in rows}


def _scan_pass(rows: DataFrame, index: TemplateIndex, kind: str, keep_text: bool) -> DataFrame:
    held = ship(rows.sparkSession, index)
    struct = pa.struct([("label", pa.string()), ("family", pa.string()), ("phrase", pa.bool_()), ("best", pa.bool_()), ("start", pa.int64()), ("past", pa.int64()),
                        ("overlap", pa.int32()), ("containment", pa.float64())])
    names = ["doc_id", "n_words", "found", *["text"] * keep_text]

    def fn(batch):
        index = unpack(held)
        for i, j, data, off in K.slices(batch):
            n, m = find(data, off, index)
            label, family, phrase = ([getattr(index.templates[k], f) for k in m[:, 1]] for f in ("label", "family", "phrase"))
            values = pa.StructArray.from_arrays(
                [pa.array(label, pa.string()), pa.array(family, pa.string()), pa.array(phrase, pa.bool_()), pa.array(best(m, index)), pa.array(m[:, 2]), pa.array(m[:, 3]),
                 pa.array(m[:, 4].astype(np.int32)), pa.array(m[:, 4] / np.maximum(1, index.size[m[:, 1]]))], fields=list(struct))
            at = np.searchsorted(m[:, 0], np.arange(j - i + 1)).astype(np.int32)
            cols = [batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(pa.array(at), values)]
            yield pa.RecordBatch.from_arrays(cols + [batch.column(1).slice(i, j - i)] * keep_text, names=names)
    return rows.mapInArrow(K.arrow_map(fn), f"doc_id {kind}, n_words long, found {_MATCH}" + ", text string" * keep_text)


def scan(docs: DataFrame, templates: list[Template] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, matches), one row per row of ``docs``: every phrase place and every block that meets a
    template, as (label, family, phrase, best, start, past, overlap, containment), by start; ``best`` as of ``best``."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    runs = passes(PHRASES + NOTICES if templates is None else templates) or [[]]
    counts = token_counts(own, list(itertools.chain(*runs))) if runs[0] else {}
    out = None
    for i, run in enumerate(runs):
        index, last = TemplateIndex(run, counts), i == len(runs) - 1
        if out is None:
            out = _scan_pass(own, index, kind, not last).withColumnRenamed("found", "matches")
        else:  # the matches so far travel inside the id column
            held = out.select(F.struct("doc_id", "matches").alias("doc_id"), "text")
            step = _scan_pass(held, index, held.schema["doc_id"].dataType.simpleString(), not last)
            out = step.select("doc_id.doc_id", "n_words", F.concat("doc_id.matches", "found").alias("matches"), *["text"] * (not last))
    by_start = lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)
    return out.withColumn("matches", F.array_sort("matches", by_start)) if len(runs) > 1 else out


def summary(scanned: DataFrame) -> DataFrame:
    """Per row of ``scan``: counts and extent of the phrase places, labels of the phrases and of the best template
    of each family in a block, and the largest containment found."""
    label_list = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda m: m["label"])))
    places = F.filter("matches", lambda m: m["phrase"])
    return scanned.withColumn("_places", places).select(
        "doc_id", "n_words", F.size("_places").cast("long").alias("n_base"),
        F.array_min(F.transform("_places", lambda m: m["start"])).alias("first_word"),
        F.array_max(F.transform("_places", lambda m: m["start"])).alias("last_word"),
        F.array_join(label_list("_places"), ",").alias("base_labels"),
        F.array_join(label_list(F.filter("matches", lambda m: m["best"])), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"))
