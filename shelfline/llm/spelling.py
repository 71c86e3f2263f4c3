"""Spelling variants: words one edit apart, found by dense comparison of prefix-suffix tiles.

Two words are one inserted, deleted or replaced code point apart exactly if their lengths differ by at most one and
their common prefix and common suffix together reach the longer length minus one. With M the longer
length and the positions of M cut into segments, the segment in which the common prefix ends names a tile: both words
share all characters before the segment and all after it. So every word is laid into one tile for each segment, for M its
own length and for M one more, and only words of one tile are compared: as rows of padded code-point matrices,
block against block, column by column, from the front and from the back. A pair counts only in the tile of the segment in which its
prefix ends, hence once. Segments are two characters long for words up to 2 * ``SEGMENTS`` characters, which bounds a tile by
the square of the alphabet whatever the corpus; longer words have ``SEGMENTS`` segments. Tiles above ``TILE`` words are dealt out as pairs of blocks.

Per word of a tile only its number of near words and the best of them leave the task.

Results for special rows: a missing or empty text has no words; rows without ``doc_id`` are counted with an empty id before
the colon; repeated rows count as often as they occur; texts and words of any length are read whole; an empty table has no words. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import Scratch, prepare

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10
#: One run in so many loses a character, chosen by the CRC of the document's id and the run.
DAMAGED = 31
SEGMENTS = 16
TILE = 4096
#: Most rows and cells of a matrix.
BLOCK = 128
CELLS = 1 << 22
#: Distinct words counted before they are handed on.
COUNTED = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {ord(c): ord(c) + 32 for c in map(chr, range(65, 91))}


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``: words of the documents that are long and frequent enough."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text").filter(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                _count(total, id_, text.as_py())
                if len(total) >= COUNTED:
                    yield _counts(total)
                    total.clear()
        if total:
            yield _counts(total)

    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= MIN_COUNT)


def _count(total: Counter[str], id_: str, text: str) -> None:
    start = zlib.crc32(f"{id_}:".encode())
    for found, n in Counter(m.group() for m in _RUN.finditer(text)).items():
        lowered = found.lower() if found.isascii() else found.translate(_LOWER)
        if len(lowered) < MIN_LENGTH:
            continue
        crc = zlib.crc32(lowered.encode(), start)
        if crc % DAMAGED == 0:
            at = crc % len(lowered)
            lowered = lowered[:at] + lowered[at + 1 :]
            if len(lowered) < MIN_LENGTH:
                continue
        total[lowered] += n


def _counts(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


# ---------------------------------------------------------------- tiles


def tiles(words: DataFrame) -> DataFrame:
    """Every word with the tiles it lies in: ``tile`` (a hash of all that the tile's words share), ``longer`` (M) and ``segment``."""
    word, size = F.col("word"), F.char_length("word")
    by_length = words.withColumn("longer", F.explode(F.array(size, size + 1)))
    width = F.greatest(F.lit(2), F.ceil(F.col("longer") / SEGMENTS)).cast("int")
    spread = by_length.withColumn("width", width).withColumn("segment", F.explode(F.sequence(F.lit(0), F.ceil(F.col("longer") / width).cast("int") - 1)))
    before = F.col("segment") * F.col("width")
    after = F.greatest(F.col("longer") - before - F.col("width"), F.lit(0))
    head = F.substring(word, F.lit(1), before)
    tail = F.substring(word, size - after + 1, after)
    return spread.select("word", "n", "longer", "segment", F.xxhash64("longer", "segment", head, tail).alias("tile"))


def near_words(words: DataFrame) -> DataFrame:
    """For each word that has any: ``n_near``, and ``best``, the near word of largest ``n`` (then the smallest), with its ``best_n``."""
    laid = tiles(words)
    sizes = laid.groupBy("tile").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    blocks = F.ceil(F.col("size") / TILE).cast("int")
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    pair = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high")))
    dealt = (
        laid.join(sizes, "tile")
        .select("word", "n", "longer", "segment", "tile", own.alias("own"), F.explode(pair).alias("pair"))
        .repartition("tile", "pair")
        .sortWithinPartitions("tile", "pair")
    )
    schema = "word string, n_near long, best_n long, best string"
    partial = dealt.select("word", "n", "longer", "segment", "tile", "pair.low", "pair.high", "own").mapInArrow(_compare_tiles, schema)
    # Smallest of (-n, word): the largest n, then the first word.
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    found = partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first"))
    return found.select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile and pair of blocks; a batch's last group waits for its rows in the next batch."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        begin = _groups(rows)[1][-1]
        if begin:
            yield from _near_in(rows.slice(0, begin))
        held = rows.slice(begin)
    if held is not None:
        yield from _near_in(held)


def _groups(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's group (tile and pair of blocks), and the first row of each group."""
    keys = np.stack([rows.column(c).to_numpy() for c in ("tile", "low", "high")])
    begins = np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
    return np.cumsum(begins) - 1, np.flatnonzero(begins)


class _Block:
    """Words as rows of two code-point matrices, padded with 0: read forwards and read backwards."""

    def __init__(self, words: list[str], start: int) -> None:
        self.start = start
        self.lengths = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        columns = np.arange(self.lengths.max())
        used = columns < self.lengths[:, None]
        self.front = np.zeros(used.shape, "<u4")
        self.front[used] = codes
        turned = np.maximum(self.lengths[:, None] - 1 - columns, 0)
        self.back = np.where(used, np.take_along_axis(self.front, turned, axis=1), 0)


def _common(a: np.ndarray, b: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of ``a`` with each row of ``b``, for the pairs asked for.

    Distinct words never agree in the padding: the shorter one's first padding meets a letter.
    """
    same, length = asked.copy(), np.zeros(asked.shape, np.int64)
    for column in range(min(a.shape[1], b.shape[1])):
        same &= a[:, column, None] == b[None, :, column]
        if not same.any():
            break
        length += same
    return length


def _near_in(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Near words inside each group of the rows: per row that has any, their number and the best."""
    words = rows.column("word").to_pylist()
    n, longer, segment, low, high, own = (rows.column(c).to_numpy() for c in ("n", "longer", "segment", "low", "high", "own"))
    group = _groups(rows)[0]
    width = np.maximum(2, -(-longer // SEGMENTS))
    blocks = [_Block(words[a:b], a) for a, b in _cut(words)]
    left, right = [], []
    for i, a in enumerate(blocks):
        rows_a = slice(a.start, a.start + len(a.lengths))
        for b in blocks[i:]:
            if group[b.start] > group[rows_a.stop - 1]:
                break
            rows_b = slice(b.start, b.start + len(b.lengths))
            of_a = lambda x: x[rows_a, None]
            of_b = lambda x: x[None, rows_b]
            size = np.maximum(a.lengths[:, None], b.lengths[None, :])
            asked = (of_a(group) == of_b(group)) & (np.abs(a.lengths[:, None] - b.lengths[None, :]) <= 1) & (size == of_a(longer)) & (size == of_b(longer))
            asked &= (of_a(segment) == of_b(segment)) & ((of_a(low) == of_a(high)) | (of_a(own) != of_b(own)))
            if a is b:
                asked = np.triu(asked, 1)
            if not asked.any():
                continue
            prefix = _common(a.front, b.front, asked)
            asked &= prefix // of_a(width) == of_a(segment)
            near = asked & (prefix + _common(a.back, b.back, asked) >= size - 1)
            x, y = np.nonzero(near)
            left.append(x + a.start)
            right.append(y + b.start)
    if not left or not sum(map(len, left)):
        return
    one, other = (np.concatenate(p) for p in ([*left, *right], [*right, *left]))
    count = np.bincount(one, minlength=len(words))
    best: dict[int, tuple[int, str]] = {}
    for r, o in zip(one.tolist(), other.tolist(), strict=True):
        candidate = (-int(n[o]), words[o])
        if r not in best or candidate < best[r]:
            best[r] = candidate
    found = sorted(best)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([words[r] for r in found], pa.string()),
            pa.array(count[found], pa.int64()),
            pa.array([-best[r][0] for r in found], pa.int64()),
            pa.array([best[r][1] for r in found], pa.string()),
        ],
        ["word", "n_near", "best_n", "best"],
    )


def _cut(words: list[str]) -> Iterator[tuple[int, int]]:
    """Blocks of rows in order, of at most ``BLOCK`` rows and ``CELLS`` matrix cells (or one row)."""
    start, most = 0, 0
    for at, word in enumerate(words):
        most = max(most, len(word))
        if at > start and (at - start >= BLOCK or (at - start + 1) * most > CELLS):
            yield start, at
            start, most = at, len(word)
    yield start, len(words)


# ---------------------------------------------------------------- groups


def last_forms(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and ``root`` of every word with a form: the last word on its way from form to form.

    Each round doubles the way followed. A form is ``FORM_RATIO`` times as frequent as its word, so ways are short and have no circles.
    """
    ways = scratch.write(forms.select("word", F.col("form").alias("root")), "ways-0")
    for round_ in range(1, 64):
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        followed = scratch.write(ways.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"ways-{round_}")
        moved = not followed.filter("moved").isEmpty()
        scratch.drop(ways)
        ways = followed.select("word", "root")
        if not moved:
            break
    return ways


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row per word: ``word``, ``form`` (the near word of largest count, if ``FORM_RATIO`` times as frequent), ``root``
    (where following forms ends), ``n``, ``n_near``, ``form_n``."""
    prepare(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.write(count_words(docs), "words")
    near = near_words(words)
    is_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")
    )
    found = scratch.write(joined, "forms")
    roots = last_forms(found.filter(F.col("form").isNotNull()), scratch)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
