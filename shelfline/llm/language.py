"""Language identification with language-bitmask n-gram filters.

The text's letters, lower-cased, are read as byte n-grams with a blank for every run
of other characters. Learning counts the n-grams of each language and keeps those
that make up at least ``min_share`` of its n-grams. They are put into one bit-sliced
Bloom filter: slot by slot, one bit per language, so that the bitwise AND of the
slots an n-gram hashes to gives all languages that contain it.

A text is judged by the number of its n-grams that each language contains. A slot is
set by chance with a language's fill rate f, an n-gram passes by chance with
p = f ** hashes, so of n n-grams with c hits (c - n * p) / (1 - p) are expected to be
true ones; the language with most of them wins, ties go to the first name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import Scratch, held_out_column, map_arrow, prepare
from shelfline.llm.text import mix

UNKNOWN = "und"
GRAM = 4
_SLICES = 64
_letter = regex.compile(r"\p{L}")
#: Lower-cased bytes: letters of ASCII and all of longer characters stay, others become a blank.
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams (GRAM bytes as one integer) without a double blank, and the text of each."""
    parts = [(t or "").lower().encode() for t in texts]
    data = _LETTERS[np.frombuffer(b" " + b"  ".join(parts) + b" ", np.uint8)]
    size = len(data) - GRAM + 1
    if size <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    blank = data == 0x20
    double = np.concatenate(([0], np.cumsum(blank[1:] & blank[:-1])))
    gram = np.zeros(size, np.uint64)
    for j in range(GRAM):
        gram = (gram << np.uint64(8)) | data[j : j + size].astype(np.uint64)
    whole = np.flatnonzero(double[GRAM - 1 :][:size] == double[:size])
    starts = np.cumsum([0, *(len(p) + 2 for p in parts)])
    return gram[whole], np.searchsorted(starts, whole, "right") - 1


def _runs(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t or "") > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t or "")
    if first < len(texts):
        yield first, texts[first:]


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, slice, grams, counts: n-gram counts of each language, packed by slices of the n-gram space.

    Each task sums what it reads before anything is shuffled, so a language with most
    of the rows sends no more than its n-grams once per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                for _, run in _runs([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                    total[lang] = _add(total.get(lang), *np.unique(grams_of(run)[0], return_counts=True))
        for lang, (grams, counts) in total.items():
            part = (mix(grams) % np.uint64(_SLICES)).astype(np.int64)
            rows = [(lang, s, grams[part == s].tobytes(), counts[part == s].astype("<i8").tobytes()) for s in range(_SLICES) if (part == s).any()]
            # Texts without a letter leave nothing to send.
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["lang", "slice", "grams", "counts"])

    return docs.select("lang", "text").mapInArrow(count, "lang string, slice long, grams binary, counts binary")


def _add(one: tuple[np.ndarray, np.ndarray] | None, grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if one is None:
        return grams, counts
    both, place = np.unique(np.concatenate((one[0], grams)), return_inverse=True)
    return both, np.bincount(place, np.concatenate((one[1], counts)), len(both)).astype(np.int64)


@dataclass
class Filters:
    """Languages by bit, the slots and each language's chance of a false hit."""

    langs: list[str]
    slots: np.ndarray
    hashes: int
    chance: np.ndarray

    def places(self, grams: np.ndarray, j: int) -> np.ndarray:
        return (mix(grams + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - int(np.log2(self.slots.shape[1])))).astype(np.int64)

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        grams, doc = grams_of(texts)
        n = np.bincount(doc, minlength=len(texts)).astype(np.float64)
        true = np.zeros((len(self.langs), len(texts)))
        places = [self.places(grams, j) for j in range(self.hashes)]
        for plane in range(self.slots.shape[0]):
            mask = self.slots[plane][places[0]]
            for p in places[1:]:
                mask = mask & self.slots[plane][p]
            for bit in range(min(8, len(self.langs) - 8 * plane)):
                hits = np.bincount(doc, (mask >> np.uint8(bit)) & np.uint8(1), len(texts))
                p = self.chance[8 * plane + bit]
                true[8 * plane + bit] = np.maximum(0.0, (hits - n * p) / (1 - p) if p < 1 else 0.0)
        best = true.argmax(axis=0) if self.langs else np.zeros(len(texts), int)
        out, score = [], []
        for i, t in enumerate(texts):
            if not self.langs or not t or not _letter.search(t):
                out.append(UNKNOWN)
                score.append(0.0)
            else:
                out.append(self.langs[best[i]])
                score.append(float(min(1.0, true[best[i], i] / n[i])) if n[i] else 0.0)
        return out, score


def learn(docs: DataFrame, min_share: float = 2e-5, slot_bits: int = 20, hashes: int = 2) -> Filters:
    """Learn from the rows with a language whose id is not held out; all of them are read.

    What reaches the driver is the filter itself: 2 ** slot_bits slots of one byte per
    eight languages, whatever the size of the corpus.
    """
    prepare(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & ~held_out_column(F.col("doc_id")))
    spark = docs.sparkSession
    packed = count_grams(rows)

    def merge(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            for g, c in zip(part.column("grams").to_pylist(), part.column("counts").to_pylist(), strict=True):
                total = _add(total, np.frombuffer(g, np.uint64), np.frombuffer(c, "<i8"))
        grams, counts = total
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()]), pa.array([int(counts.sum())]), pa.array([grams.tobytes()]), pa.array([counts.astype("<i8").tobytes()])],
            ["lang", "n", "grams", "counts"],
        )

    scratch = Scratch(spark, "language")
    merged = scratch.write(packed.groupBy("lang", "slice").applyInArrow(merge, "lang string, n long, grams binary, counts binary"), "counts")
    sizes = {r["lang"]: r["n"] for r in merged.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sizes)
    planes = max(1, -(-len(langs) // 8))
    empty = Filters(langs, np.zeros((planes, 1 << slot_bits), np.uint8), hashes, np.zeros(len(langs)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: list[np.ndarray] = []
        for batch in batches:
            for lang, g, c in zip(*(batch.column(k).to_pylist() for k in ("lang", "grams", "counts")), strict=True):
                grams = np.frombuffer(g, np.uint64)[np.frombuffer(c, "<i8") >= min_share * sizes[lang]]
                for j in range(hashes):
                    bits.append(empty.places(grams, j) * np.int64(len(langs)) + langs.index(lang))
        found = np.unique(np.concatenate(bits)) if bits else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found)], ["bit"])

    slots = empty.slots
    if langs:
        rows = merged.mapInArrow(place, "bit long")
        # Distinct bits packed into one row per 2 ** 14 slots: bounded by the size of the filter.
        span = (1 << 14) * len(langs)
        blocks = rows.distinct().groupBy(F.floor(F.col("bit") / span).alias("block")).agg(F.collect_list((F.col("bit") % span).cast("int")).alias("bits"))
        for row in blocks.toLocalIterator():
            bit = np.array(row["bits"], np.int64) + row["block"] * span
            slot, lang = bit // len(langs), bit % len(langs)
            np.bitwise_or.at(slots, (lang // 8, slot), np.left_shift(1, lang % 8).astype(np.uint8))
    scratch.drop(merged)
    fill = np.array([((slots[i // 8] >> np.uint8(i % 8)) & np.uint8(1)).mean() for i in range(len(langs))])
    return Filters(langs, slots, hashes, fill**hashes)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (share of its n-grams that are the language's).

    A text that is null or has no letter is ``und`` with score 0, as is every text if
    nothing could be learned. Repeated rows are judged one by one; only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def judge(batch: pa.RecordBatch) -> dict:
        langs, scores = [], []
        for _, run in _runs(batch.column(1).to_pylist()):
            found = shared.value.judge(run)
            langs += found[0]
            scores += found[1]
        return {"doc_id": batch.column(0), "lang_pred": langs, "score": scores}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), judge, f"doc_id {kind}, lang_pred string, score double")


def in_known_language(docs: DataFrame, filters: Filters, min_score: float = 0.2) -> DataFrame:
    """The documents whose language is told with at least ``min_score``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def judge(batch: pa.RecordBatch) -> dict:
        row, keep = batch.column(0), []
        for _, run in _runs(row.field("text").to_pylist()):
            keep += [lang != UNKNOWN and score >= min_score for lang, score in zip(*shared.value.judge(run), strict=True)]
        return {"row": row, "keep": keep}

    whole = docs.select(F.struct("*").alias("row"))
    kept = map_arrow(whole, judge, f"row {whole.schema['row'].dataType.simpleString()}, keep boolean")
    return kept.where("keep").select("row.*")
