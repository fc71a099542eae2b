"""License scans as an exact set-similarity join (operator 8).

License templates are sets of words, and text blocks are windows of words that begin with a word of the template and have
``STRETCH`` words for each of its words; they run over line ends, as notices are wrapped. A block carries a template if
it holds at least ``containment`` of the template's words, and the words that tell the template from its like. All such
pairs are found exactly: words are ordered by how many documents hold them, over all documents, rarest first; a block
that meets the threshold must hold one of a template's first ``size - needed + 1`` words (prefix filter), must have as
many of its words around as are needed (length filter), and while the words are matched in this order what is left must
still suffice (positional filter). Of blocks of one template that overlap, the first of those that hold most is reported.

Defined cases: a null or empty text has no words and no labels; repeated rows give repeated results; an empty table
gives none; words tie in frequency by their spelling; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_text, read, released
from .scan import ALNUM_WORD, LOWER_TABLE, Chunk, U, per_chunk

CONTAINMENT = 0.8
#: A block is so many words for each word of a template (rounded up): a notice with some words put in.
STRETCH = 1.5
#: The contract's phrases and labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Sentences that public licenses tell their users to write, with labels of our own, and the words that tell a short one from its like.
TEMPLATES = (
    ("mit", "released under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ""),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache 2"),
    ("apache-2.0", "you may not use this file except in compliance with the license", "compliance except"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general 2"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser"),
    ("agpl", "licensed under the gnu affero general public license", "affero"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "fee"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc nc 4"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc sa 4"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc nd 4"),
    ("cc-by", "licensed under a creative commons attribution international license", "creative attribution"),
    ("cc0", "dedicated to the public domain under cc0", "cc0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
)


def _hashes(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    offs = np.cumsum([0, *map(len, data)])
    return Chunk(np.frombuffer(b"".join(data), np.uint8), offs, slice(0, len(data))).hashes(offs[:-1], offs[1:], LOWER_TABLE)


class Vocabulary:
    """The words of templates and phrases, found among word hashes."""

    def __init__(self, words: list[str]):
        h = _hashes(words)
        self.order = np.argsort(h)
        self.sorted = h[self.order]
        self.near = np.zeros(1 << 16, bool)
        self.near[(h >> U(48)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of known words, and which they are."""
        maybe = np.flatnonzero(self.near[(h >> U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.sorted, h[maybe]), len(self.sorted) - 1)
        ok = self.sorted[at] == h[maybe]
        return maybe[ok], self.order[at[ok]]


def document_frequency(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many documents each of the given words stands; partial counts are summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, total = Vocabulary(words), np.zeros(len(words), np.int64)
        for _, chunk in per_chunk(batches):
            starts, ends, first = chunk.spans(ALNUM_WORD)
            at, which = vocab.find(chunk.hashes(starts, ends, LOWER_TABLE))
            doc = np.searchsorted(first, at, "right") - 1
            total += np.bincount(np.unique(doc * len(words) + which) % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(words)), pa.int32()), pa.array(total)], ["word", "n"])

    # As many rows as the templates have words.
    return {words[r.word]: r.n for r in docs.mapInArrow(released(run), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}


def block_words(template: str) -> int:
    """How many words a block has at most."""
    return math.ceil(STRETCH * len(template.split()))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, places of phrases, and ``blocks``: (label, template, line, first word, containment) of each match."""
    docs = ids_and_text(docs)
    phrases = PHRASES if phrases is None else phrases
    words = sorted({w for _, t, _ in templates for w in t.split()} | {w for p in phrases for w in p.split()})
    frequency = document_frequency(docs, words)
    index = {w: i for i, w in enumerate(words)}
    by_rarity = sorted(words, key=lambda w: (frequency.get(w, 0), w))
    rank = np.zeros(len(words), np.int64)
    rank[[index[w] for w in by_rarity]] = np.arange(len(words))
    sets = [sorted({int(rank[index[w]]) for w in t.split()}) for _, t, _ in templates]
    asked = [{int(rank[index[w]]) for w in own.split()} for *_, own in templates]
    needed = [math.ceil(containment * len(s) - 1e-9) for s in sets]
    spans = [block_words(t) for _, t, _ in templates]
    opens: dict[int, list[int]] = {}
    for k, (s, o) in enumerate(zip(sets, needed, strict=True)):
        for r in s[: len(s) - o + 1]:
            opens.setdefault(r, []).append(k)
    is_open = np.zeros(len(words), bool)
    is_open[list(opens)] = True
    spelled = [([index[w] for w in p.split()], label) for p, label in phrases.items()]
    names = [label for label, *_ in templates]

    def matches(ranks: list[int], at: list[int], i: int) -> Iterator[tuple[int, int, float]]:
        """(template, first word, containment) of blocks that hold the known word ``i``, one of a prefix; ``ranks`` and their places: a document's known words."""
        for k in opens[ranks[i]]:
            s, o, size = set(sets[k]), needed[k], spans[k]
            lo, hi = bisect_right(at, at[i] - size), bisect_left(at, at[i] + size)
            # Length filter: words around that are the template's.
            if sum(r in s for r in ranks[lo:hi]) < o:
                continue
            for first in range(lo, i + 1):
                if ranks[first] not in s:
                    continue
                end = bisect_left(at, at[first] + size)
                have, got = {r for r in ranks[first:end] if r in s}, 0
                for n, r in enumerate(sets[k]):  # positional filter: rarest first, until too few can follow
                    if got + len(s) - n < o:
                        break
                    got += r in have
                if got >= o and asked[k] <= have:
                    yield k, at[first], got / len(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabulary(words)
        for rows, chunk in per_chunk(batches):
            starts, ends, first = chunk.spans(ALNUM_WORD)
            at, which = vocab.find(chunk.hashes(starts, ends, LOWER_TABLE))
            word = np.full(len(starts) + 8, -1, np.int64)
            word[at] = which
            doc = np.repeat(np.arange(chunk.n), np.diff(first))
            places: list[list] = [[] for _ in range(chunk.n)]
            for ids, label in spelled:
                ok = at[which == ids[0]]
                for j, w in enumerate(ids[1:], 1):
                    ok = ok[word[ok + j] == w]
                ok = ok[ok + len(ids) <= first[doc[ok] + 1]]
                for p in ok.tolist():
                    places[doc[p]].append({"label": label, "word": p - int(first[doc[p]])})
            blocks: list[list] = [[] for _ in range(chunk.n)]
            lines, _, line_first = chunk.lines()
            bound = np.searchsorted(at, first)
            owner = doc[at]
            ranked = rank[which]
            for d in np.unique(owner[is_open[ranked]]).tolist():
                lo, hi = int(bound[d]), int(bound[d + 1])
                ranks, spots = ranked[lo:hi].tolist(), at[lo:hi].tolist()
                found = {(k, p): c for i in np.flatnonzero(is_open[ranked[lo:hi]]).tolist() for k, p, c in matches(ranks, spots, i)}
                last: dict[int, tuple[int, float]] = {}
                for k, p in sorted(found):  # of blocks that overlap, the first of those that hold most
                    if k in last and p < last[k][0] + spans[k] and found[k, p] <= last[k][1]:
                        continue
                    if k in last and p < last[k][0] + spans[k]:
                        blocks[d].pop()
                    last[k] = p, found[k, p]
                    line = int(np.searchsorted(lines, starts[p], "right")) - 1
                    blocks[d].append({"label": names[k], "template": k, "line": line - int(line_first[d]), "word": p - int(first[d]), "containment": found[k, p]})
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(first)), pa.array(places, place), pa.array(blocks, block)], ["doc_id", "n_words", "places", "blocks"])

    place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    block = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int32()), ("line", pa.int64()), ("word", pa.int64()), ("containment", pa.float64())]))
    return docs.mapInArrow(released(run), "doc_id long, n_words long, places array<struct<label:string,word:long>>, blocks array<struct<label:string,template:int,line:long,word:long,containment:double>>")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read(spark, sf_dir, "documents"))
    base, own = F.col("places.label"), F.col("blocks.label")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max("blocks.containment"), F.lit(0.0))).alias("score"),
    )
