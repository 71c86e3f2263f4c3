"""License scan: exact set-similarity join of word windows with license templates.

A place in a text matches a template if a window of words, across line ends, holds at
least ``containment`` of the template's distinct words and is at most 1 / ``containment``
times as long as the template, so wrapped lines count and words scattered over a long
text do not. The templates' words are ordered by how many documents hold them; a
matching window must hold one of the ``n - ceil(containment * n) + 1`` rarest (prefix),
so only windows around these are looked at (position) whose part up to the end of the
text holds enough words of the template (length). The distinct words are then counted
exactly.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import map_arrow, prepare
from shelfline.llm.license_texts import WHOLE_TEXTS
from shelfline.llm.text import ALNUM, HashIndex, Words, chunks, texts_of, words_of

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences by which licenses are usually named or granted, by label.
SENTENCES = [
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc-by", "licensed under cc by 4.0"),
    ("cc-by", "licensed under a creative commons attribution 4.0 international license"),
    ("cc0", "dedicated to the public domain under the cc0 1.0 universal dedication"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
TEMPLATES = [*SENTENCES, *WHOLE_TEXTS]


def _hashes(text: str) -> np.ndarray:
    return words_of([text.encode()], ALNUM, lower=True).hash


def word_counts(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """In how many documents each word of the templates occurs."""
    index = HashIndex(vocabulary)

    def count(batches):
        total = np.zeros(len(index.values), np.int64)
        for batch in batches:
            for _, texts in chunks(texts_of(batch.column(0))):
                words = words_of(texts, ALNUM, lower=True)
                at, place = index.find(words.hash)
                pairs = np.unique(words.doc[at] * np.int64(len(index.values)) + place)
                total += np.bincount(pairs % len(index.values), minlength=len(index.values))
        yield pa.RecordBatch.from_arrays([pa.array(index.values.view(np.int64)), pa.array(total)], ["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {r["word"] % (1 << 64): r["n"] for r in rows}


class Matcher:
    """Templates prepared for the join: words by rarity, prefixes and bounds."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[int, int], containment: float) -> None:
        self.labels = [label for label, _ in templates]
        self.words = []
        for _, text in templates:
            distinct = {int(h) for h in _hashes(text)}
            self.words.append(sorted(distinct, key=lambda h: (counts.get(h, 0), h)))
        self.need = [math.ceil(containment * len(w)) for w in self.words]
        self.index = HashIndex(np.array(sorted({h for w in self.words for h in w}), np.uint64))
        #: By template, the rank of each indexed word, -1 for words of other templates.
        self.rank = np.full((len(templates), len(self.index.values)), -1, np.int64)
        for number, words in enumerate(self.words):
            self.rank[number, np.searchsorted(self.index.values, np.array(words, np.uint64))] = np.arange(len(words))
        self.reach = [math.ceil(len(_hashes(text)) / containment) for _, text in templates]

    def windows(self, words: Words) -> list[tuple[int, int, int, float]]:
        """(first word, last word, template, containment) of each matched place; those of one template do not overlap."""
        at, place = self.index.find(words.hash)
        return [m for number in range(len(self.words)) for m in self._matches(words, at, self.rank[number, place], number)]

    def _matches(self, words: Words, at: np.ndarray, rank: np.ndarray, number: int) -> list[tuple[int, int, int, float]]:
        need, reach = self.need[number], self.reach[number]
        in_prefix = at[(rank >= 0) & (rank <= len(self.words[number]) - need)]
        if not len(in_prefix):
            return []
        hit, rank = at[rank >= 0], rank[rank >= 0]
        # Position: a window that starts at a hit must reach a prefix word.
        following = np.searchsorted(in_prefix, hit)
        near = in_prefix[np.minimum(following, len(in_prefix) - 1)]
        # Length: its words of the template, with repeats, up to the end of its text.
        stop = np.searchsorted(hit, np.minimum(hit + reach, words.first[words.doc[hit] + 1]))
        start = np.flatnonzero((near >= hit) & (near < hit + reach) & (stop - np.arange(len(hit)) >= need))
        if not len(start):
            return []
        # A hit counts in the windows that start after the last hit of the same word.
        order = np.lexsort((hit, rank))
        before = np.full(len(hit), -1, np.int64)
        same = rank[order[1:]] == rank[order[:-1]]
        before[order[1:][same]] = order[:-1][same]
        common, last = np.zeros(len(start), np.int64), start.copy()
        for step in range(int((stop[start] - start).max())):
            now = start + step
            inside = now < stop[start]
            now = np.minimum(now, len(hit) - 1)
            new = inside & (before[now] < start)
            common += new
            last[new] = now[new]
        enough = common >= need
        start, common, last = start[enough], common[enough], last[enough]
        first_word, last_word = hit[start], hit[last]
        # The best windows first: most words held, then the shortest, then the first.
        taken: list[int] = []
        found = []
        for i in np.lexsort((first_word, last_word - first_word, -common)).tolist():
            one, two = int(first_word[i]), int(last_word[i])
            k = bisect_left(taken, one)
            # Ends of taken windows stand at odd places, so an even k lies between two of them.
            if k % 2 == 0 and (k == len(taken) or taken[k] > two):
                taken[k:k] = [one, two]
                found.append((one, two, number, int(common[i]) / len(self.words[number])))
        return sorted(found)


def best_labels(matches: list[tuple[int, int, str, float]]) -> set[str]:
    """Labels of the matches (first word, last word, label, containment) that overlap none with a higher containment."""
    matches = sorted(matches)
    beaten = [False] * len(matches)
    for i, (_, last, _, share) in enumerate(matches):
        for j in range(i + 1, len(matches)):
            if matches[j][0] > last:
                break
            beaten[i] |= matches[j][3] > share
            beaten[j] |= matches[j][3] < share
    return {label for (_, _, label, _), lost in zip(matches, beaten, strict=True) if not lost}


def phrase_places(words: Words, phrases: dict[str, str]) -> list[tuple[int, int, str]]:
    """(first word, words, label) wherever a phrase's words stand consecutively in one text."""
    places = []
    for phrase, label in phrases.items():
        parts = phrase.encode().split(b" ")
        hashes, whole = words.shingles(len(parts))
        blank = np.zeros(len(parts), np.int64)
        wanted = Words(blank, blank, blank, blank, blank, _hashes(phrase)).shingles(len(parts))[0][0]
        for at in np.flatnonzero((hashes == wanted) & whole).tolist():
            if words.phrase(at, len(parts)) == phrase.encode():
                places.append((at, len(parts), label))
    return places


def scan_licenses(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None, containment: float = 0.8
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    The base is every place of a phrase. ``blocks`` lists the matched windows as
    (first_word, last_word, label, containment), words counted from 0; ``labels`` adds to the base ones the labels
    of the windows that overlap no better one; ``score`` is 1 with a base place, else the best containment, else 0.
    A null text counts as empty; repeated rows are judged one by one.
    """
    prepare(docs.sparkSession)
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    docs = docs.select("doc_id", "text")
    vocabulary = np.unique(np.concatenate([_hashes(t) for _, t in templates] or [np.zeros(0, np.uint64)]))
    matcher = Matcher(templates, word_counts(docs, vocabulary), containment)

    def scan(batch: pa.RecordBatch) -> dict:
        size = batch.num_rows
        out = {k: [None] * size for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks")}
        for base, texts in chunks(texts_of(batch.column(1))):
            words = words_of(texts, ALNUM, lower=True)
            base_of, blocks_of = defaultdict(list), defaultdict(list)
            for at, _, label in phrase_places(words, phrases):
                doc = int(words.doc[at])
                base_of[doc].append((at - int(words.first[doc]), label))
            for one, two, number, share in matcher.windows(words):
                doc = int(words.doc[one])
                skipped = int(words.first[doc])
                blocks_of[doc].append((one - skipped, two - skipped, matcher.labels[number], share))
            counts = np.diff(words.first).tolist()
            for doc in range(len(texts)):
                i, places, blocks = base + doc, base_of.get(doc, ()), blocks_of.get(doc, [])
                named = {label for _, label in places}
                out["n_words"][i], out["n_base"][i] = counts[doc], len(places)
                if places:
                    out["first_word"][i], out["last_word"][i] = min(places)[0], max(places)[0]
                out["base_labels"][i] = ",".join(sorted(named))
                out["labels"][i] = ",".join(sorted(named | best_labels(blocks)))
                out["score"][i] = 1.0 if places else max((share for *_, share in blocks), default=0.0)
                out["blocks"][i] = [{"first_word": a, "last_word": b, "label": c, "containment": d} for a, b, c, d in sorted(blocks)]
        kinds = {k: pa.int64() for k in ("n_words", "n_base", "first_word", "last_word")}
        kinds |= {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
        kinds["blocks"] = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))
        return {"doc_id": batch.column(0)} | {k: pa.array(v, kinds[k]) for k, v in out.items()}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs,
        scan,
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, blocks array<struct<first_word:long,last_word:long,label:string,containment:double>>",
    )
