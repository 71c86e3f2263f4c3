"""Benchmark decontamination as a prefix-filtered containment join.

Every benchmark item is cut into windows of ``window`` words. A window's shingles
are ordered by how often they occur in the corpus; a text that contains the share
``containment`` of them must contain one of the ``n - ceil(containment * n) + 1``
rarest, so only those are looked up. The place of the shingle inside the window
gives the only place in the document where the window could stand (positional
bound), which must lie inside the document (length bound). What is left is verified
word by word.

The benchmark is worked through in blocks of at most ``block_words`` words, so what
is sent to the executors has a fixed bound; between blocks the documents and what is known of them are written.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import Scratch, map_arrow, prepare
from shelfline.llm.text import ALNUM, HashIndex, Words, chunks, texts_of, words_of


@dataclass
class Window:
    """Distinct words sequence of items: its text, word hashes and the items holding it."""

    text: bytes
    hashes: np.ndarray
    items: list[str]


@dataclass
class Prefixes:
    """Lookup of one shingle length: for each indexed hash the (window, offset) pairs that chose it."""

    index: HashIndex
    uses: list[list[tuple[int, int]]]


def item_windows(items: list[tuple[object, str | None]], window: int) -> list[Window]:
    """Windows of a block of items; an item shorter than ``window`` is one window."""
    found: dict[bytes, tuple[np.ndarray, set[str]]] = {}
    for item_id, text in items:
        words = words_of([(text or "").encode()], ALNUM, lower=True)
        count = len(words.hash)
        size = min(window, count)
        for i in range(count - size + 1 if count else 0):
            _, ids = found.setdefault(words.phrase(i, size), (words.hash[i : i + size], set()))
            if item_id is not None:
                ids.add(str(item_id))
    return [Window(text, hashes, sorted(ids)) for text, (hashes, ids) in sorted(found.items())]


def _shingles_of(window: Window, shingle: int) -> np.ndarray:
    size = min(shingle, len(window.hashes))
    n = len(window.hashes)
    blank = np.zeros(n, np.int64)
    return Words(blank, blank, blank, blank, blank, window.hashes).shingles(size)[0]


def shingle_counts(docs: DataFrame, windows: list[Window], shingle: int) -> dict[int, int]:
    """How often each shingle of the windows occurs in all documents."""
    by_size: dict[int, list[np.ndarray]] = defaultdict(list)
    for w in windows:
        by_size[min(shingle, len(w.hashes))].append(_shingles_of(w, shingle))
    indexes = {size: HashIndex(np.concatenate(parts)) for size, parts in by_size.items()}

    def count(batches):
        totals = {size: np.zeros(len(index.values), np.int64) for size, index in indexes.items()}
        for batch in batches:
            for _, texts in chunks(texts_of(batch.column(0))):
                words = words_of(texts, ALNUM, lower=True)
                for size, index in indexes.items():
                    hashes, whole = words.shingles(size)
                    _, place = index.find(hashes[whole])
                    totals[size] += np.bincount(place, minlength=len(index.values))
        for size, index in indexes.items():
            hit = np.flatnonzero(totals[size])
            yield pa.RecordBatch.from_arrays([pa.array(index.values[hit].view(np.int64)), pa.array(totals[size][hit])], ["hash", "n"])

    counts = docs.select("text").mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return {row["hash"] % (1 << 64): row["n"] for row in counts.collect()}


def choose_prefixes(windows: list[Window], counts: dict[int, int], shingle: int, containment: float) -> dict[int, Prefixes]:
    """The rarest shingles of each window that the containment threshold makes necessary."""
    uses: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for number, window in enumerate(windows):
        hashes = [int(h) for h in _shingles_of(window, shingle)]
        rare_first = sorted(range(len(hashes)), key=lambda o: (counts.get(hashes[o], 0), hashes[o], o))
        length = len(hashes) - math.ceil(containment * len(hashes)) + 1
        for offset in rare_first[:length]:
            if counts.get(hashes[offset], 0):
                uses[min(shingle, len(window.hashes))][hashes[offset]].append((number, offset))
    out = {}
    for size, by_hash in uses.items():
        index = HashIndex(np.array(list(by_hash), np.uint64))
        out[size] = Prefixes(index, [by_hash[int(h)] for h in index.values])
    return out


def _contained(words: Words, start: int, window: Window, shingle: int, containment: float) -> bool:
    n = len(window.hashes)
    if containment >= 1:
        return bool((words.hash[start : start + n] == window.hashes).all()) and words.phrase(start, n) == window.text
    size = min(shingle, n)
    same = words.hash[start : start + n] == window.hashes
    equal = np.convolve(same, np.ones(size, int), "valid") == size
    return int(equal.sum()) >= math.ceil(containment * len(equal))


def find_windows(words: Words, windows: list[Window], prefixes: dict[int, Prefixes], shingle: int, containment: float) -> set[tuple[int, int]]:
    """(first word, window) of every occurrence in some texts."""
    found: set[tuple[int, int]] = set()
    for size, prefix in prefixes.items():
        hashes, whole = words.shingles(size)
        hashes = np.where(whole, hashes, np.uint64(0))
        for at, place in zip(*(x.tolist() for x in prefix.index.find(hashes)), strict=True):
            doc = words.doc[at]
            for number, offset in prefix.uses[place]:
                start = at - offset
                if start < words.first[doc] or start + len(windows[number].hashes) > words.first[doc + 1]:
                    continue
                if (start, number) not in found and _contained(words, start, windows[number], shingle, containment):
                    found.add((start, number))
    return found


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5, containment: float = 1.0, block_words: int = 2_000_000
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items.

    A text or item that is null or has no word matches nothing (zero counts, the
    SHA-256 of an empty string). Repeated rows are judged one by one; repeated items
    count once; an item without an id marks words but is not listed. Only the columns
    doc_id, text and item_id, text are read, whatever else the tables hold.
    """
    marked = _marked(docs.select("doc_id", "text"), benchmark, window, shingle, containment, block_words)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        marked,
        _summary,
        f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents without any benchmark window, all columns kept; the parameters are those of ``decontaminate``.

    Rows pass the search whole, so nothing is joined or shuffled.
    """
    settings = {"window": 10, "shingle": 5, "containment": 1.0, "block_words": 2_000_000} | parameters
    return _marked(docs, benchmark, **settings).where(F.col("hits").isNull()).select("row.*")


def _marked(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int, containment: float, block_words: int) -> DataFrame:
    """Columns row (the document), hits ((start, length) pairs of windows) and found (items)."""
    if not 0 < containment <= 1 or window < 1 or shingle < 1:
        raise ValueError("window and shingle must be positive, containment in (0, 1]")
    prepare(docs.sparkSession)
    items = benchmark.select("item_id", "text")
    # A word takes two bytes with its blank, so this bounds the words of a block.
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n_blocks = max(1, math.ceil(size / 2 / block_words))
    state = docs.select(
        F.struct("*").alias("row"), F.lit(None).cast("binary").alias("hits"), F.array().cast("array<string>").alias("found")
    )
    scratch, written = Scratch(docs.sparkSession, "decontaminate"), None
    for block in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        windows = item_windows([(r["item_id"], r["text"]) for r in rows], window)
        if windows:
            prefixes = choose_prefixes(windows, shingle_counts(docs, windows, shingle), shingle, containment)
            state = _mark(state, windows, prefixes, shingle, containment)
            if block < n_blocks - 1:
                # Written, so that no task ever holds more than one block's windows.
                state = scratch.write(state, "marked")
                scratch.drop(written)
                written = state
    return state


def _mark(state: DataFrame, windows: list[Window], prefixes: dict[int, Prefixes], shingle: int, containment: float) -> DataFrame:
    """Add the occurrences of one block's windows to each document's hits and items."""

    def mark(batch: pa.RecordBatch) -> dict:
        row, hits, found = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for base, texts in chunks(texts_of(row.field("text"))):
            words = words_of(texts, ALNUM, lower=True)
            pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for start, number in find_windows(words, windows, prefixes, shingle, containment):
                pairs[int(words.doc[start])].append((start - int(words.first[words.doc[start]]), number))
            for doc, places in pairs.items():
                spans = sorted({(start, len(windows[number].hashes)) for start, number in places})
                hits[base + doc] = (hits[base + doc] or b"") + np.array(spans, "<u4").tobytes()
                found[base + doc] = sorted({*found[base + doc], *(i for _, number in places for i in windows[number].items)})
        return {"row": row, "hits": pa.array(hits, pa.binary()), "found": pa.array(found, pa.list_(pa.string()))}

    return map_arrow(state, mark, f"row {state.schema['row'].dataType.simpleString()}, hits binary, found array<string>")


def _summary(batch: pa.RecordBatch) -> dict:
    row, hits, found = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
    n_words, n_hit = np.zeros(len(hits), np.int64), np.zeros(len(hits), np.int64)
    for base, texts in chunks(texts_of(row.field("text"))):
        counts = np.diff(words_of(texts, ALNUM, lower=True).first)
        n_words[base : base + len(texts)] = counts
        for i in range(base, base + len(texts)):
            if hits[i]:
                spans = np.frombuffer(hits[i], "<u4").reshape(-1, 2).astype(np.int64)
                edge = np.zeros(n_words[i] + 1, np.int64)
                np.add.at(edge, spans[:, 0], 1)
                np.add.at(edge, spans.sum(axis=1), -1)
                n_hit[i] = int((np.cumsum(edge) > 0).sum())
    return {
        "doc_id": row.field("doc_id"), "n_words": n_words, "n_hit": n_hit,
        "n_items": np.array([len(x) for x in found], np.int64),
        "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in found],
        "contaminated": n_hit > 0, "items": pa.array(found, pa.list_(pa.string())),
    }
