"""Token-ID files in a word-aligned Simple-8b code.

A 64-bit word holds a selector in its top four bits and 60 bits of data, lowest id
first. Selector s says how many ids of how many bits follow (``COUNTS``, ``WIDTHS``).
An id of more than 60 bits is escaped: a word of selector 15 (``ESCAPE``), then the
id as a word of its own. Ids are packed in blocks of ``BLOCK`` ids; the payload starts
with a header and the offset of every block, so blocks decode independently and all
words of one selector decode in one vector operation.

Payload, little endian: "S8B1", u32 block size, u64 ids, u64 blocks, then for each
block a u64 offset in words, one more for the end, and the words.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfline.llm.common import prepare

MAGIC, HEADER = b"S8B1", struct.Struct("<4sIQQ")
BLOCK = 1024
# Ids in a word and bits of each, by selector; narrowest first.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
SEGMENT_IDS = 1 << 20
#: Most pieces of text whose ids a Python worker remembers, pieces coded as one text, and such texts coded in one call.
MEMORY, JOINED, CALLED = 1_000_000, 200, 100
#: Bytes of texts that are cut and put together at once, or one longer text; the arrays for that take several times as many.
CUT = 1 << 20
#: Pieces of more bytes are not remembered.
LONG_PIECE = 100
#: Characters that any Unicode version calls white space, or may.
_WHITE = frozenset(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
_WHITE_BYTE = np.array([b < 0x80 and chr(b) in _WHITE for b in range(256)])
#: The longer ones, their bytes read as a number.
_WHITE_LONG = np.array(sorted(int.from_bytes(c.encode()) for c in _WHITE if not c.isascii()))
#: What may start a match: 1 white space (as every version has it), 2 signs but the apostrophe, which also starts endings.
_STARTS = np.array([1 if b in b"\t\n\r " else 2 if 0x20 < b < 0x7F and b != 0x27 and not chr(b).isalnum() else 0 for b in range(256)], np.int8)
_WORD_BYTE = np.array([b < 0x80 and chr(b).isalnum() for b in range(256)])


def _after_white(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before a place may be white space."""
    first = raw[at - 1]
    white = _WHITE_BYTE[first]
    wide = np.flatnonzero(first >= 0x80)
    third, second, first = (raw[at[wide] - k].astype(np.int64) for k in (3, 2, 1))
    pair = second << 8 | first
    white[wide] = np.isin(pair, _WHITE_LONG) | np.isin(third << 16 | pair, _WHITE_LONG)
    return white


def _borders(raw: np.ndarray) -> np.ndarray:
    """Marks places in UTF-8 texts where a new match starts, whatever follows.

    They are white space after another character, and signs after a letter or digit of ASCII or a letter of Latin-1.
    """
    border = np.zeros(len(raw), bool)
    kind = _STARTS[raw]
    white = np.flatnonzero(kind == 1)
    border[white[~_after_white(raw, white)]] = True
    sign = np.flatnonzero(kind == 2)
    last = raw[sign - 1]
    border[sign[_WORD_BYTE[last] | ((raw[sign - 2] == 0xC3) & (last != 0x97) & (last != 0xB7))]] = True
    return border


def _parts(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, and where each starts in them, with the end."""
    _, places, data = texts.buffers()
    bounds = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return bounds - bounds[0], np.frombuffer(data or b"", np.uint8)[bounds[0] : bounds[-1]]


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def _holds(texts: pa.Array, parts: list[str]) -> np.ndarray:
    """Whether a text holds any of the parts."""
    found = [np.asarray(pc.match_substring(texts, part)) for part in parts]
    return np.logical_or.reduce(found) if found else np.zeros(len(texts), bool)


def encode(ids: np.ndarray) -> bytes:
    """Code one run of unsigned ids."""
    ids = np.asarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    left = np.tile(np.arange(BLOCK, 0, -1, dtype=np.int16), blocks)[: len(ids)]
    left[(blocks - 1) * BLOCK :] -= blocks * BLOCK - len(ids)
    # The narrowest selector each id fits, len(WIDTHS) if none does; then the widest of that over the ids a word would hold.
    width = np.searchsorted(np.uint64(1) << WIDTHS.astype(np.uint64), ids, "right").astype(np.int8)
    choice = np.full(len(ids), -1, np.int8)
    widest, length = width.copy(), 1
    for selector in range(len(WIDTHS) - 1, -1, -1):
        count = int(COUNTS[selector])
        while length < count:
            # Two windows of this length side by side, or overlapping, make a longer one.
            grow = min(length, count - length)
            if grow < len(ids):
                widest = np.append(np.maximum(widest[:-grow], widest[grow:]), widest[-grow:])
            length += grow
        np.copyto(choice, selector, where=(widest <= selector) & (left >= count))
    # Without a selector, -1, it is the last of these.
    step = np.append(COUNTS, 1).astype(np.int16)[choice]
    # All blocks are walked side by side, one word of each at a time.
    at, number = np.arange(blocks) * BLOCK, np.arange(blocks)
    ends = np.minimum(at + BLOCK, len(ids))
    taken_at, taken_block = [], []
    while len(at):
        taken_at.append(at)
        taken_block.append(number)
        at = at + step[at]
        go = at < ends[number]
        at, number = at[go], number[go]
    starts = np.sort(np.concatenate(taken_at)) if taken_at else np.zeros(0, np.int64)
    picked = choice[starts]
    escaped = picked < 0
    places = np.concatenate(([0], np.cumsum(1 + escaped)))
    words = np.zeros(places[-1], np.uint64)
    for selector in range(len(WIDTHS)):
        mine = np.flatnonzero(picked == selector)
        value = np.full(len(mine), selector << 60, np.uint64)
        for j in range(COUNTS[selector]):
            value |= ids[starts[mine] + j] << np.uint64(j * WIDTHS[selector])
        words[places[:-1][mine]] = value
    words[places[:-1][escaped]] = np.uint64(ESCAPE << 60)
    words[places[:-1][escaped] + 1] = ids[starts[escaped]]
    offsets = places[np.searchsorted(starts, np.append(np.arange(blocks) * BLOCK, len(ids)))]
    return HEADER.pack(MAGIC, BLOCK, len(ids), blocks) + offsets.astype("<u8").tobytes() + words.astype("<u8").tobytes()


def decode(payload: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (end exclusive); only the blocks that hold them are read."""
    magic, block, total, blocks = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token-id payload")
    last = total if last is None else min(last, total)
    if first >= last:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(payload, "<u8", blocks + 1, HEADER.size).astype(np.int64)
    b0, b1 = first // block, -(-last // block)
    words = np.frombuffer(payload, "<u8", offsets[b1] - offsets[b0], HEADER.size + 8 * (blocks + 1) + 8 * int(offsets[b0]))
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    # An escape's second word can look like an escape itself, so they are settled in order.
    at = 0
    for e in np.flatnonzero(selector == ESCAPE).tolist():
        if e >= at:
            raw[e + 1] = True
            at = e + 2
    head = (selector == ESCAPE) & ~raw
    counts = np.where(raw, 1, np.where(head, 0, np.append(COUNTS, [0, 0])[selector]))
    places = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in range(len(WIDTHS)):
        mine = np.flatnonzero((selector == s) & ~raw)
        for j in range(COUNTS[s]):
            out[places[mine] + j] = (words[mine] >> np.uint64(j * WIDTHS[s])) & np.uint64((1 << int(WIDTHS[s])) - 1)
    out[places[raw]] = words[raw]
    return out[first - b0 * block : last - b0 * block]


class Tokens:
    """Ids of texts by a tokenizers file, remembering the ids of pieces of text.

    Texts are cut where the byte-level pre-tokenizer starts a new match whatever follows (``_borders``), so that the pieces can be
    coded one by one. The pieces of a batch are numbered and put together again as Arrow columns; Python sees each distinct
    piece once, and the library those that are not remembered. When the memory is full, the half of it that was met
    first stays: frequent pieces are met early. Texts that hold a special token are coded whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()]
        # A byte-level token has one character for each of its bytes.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)
        #: The place of each remembered piece, whose ids are flat[ends[place] : ends[place + 1]].
        self.known: dict[str, int] = {}
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _code(self, texts: list[str]) -> list[list[int]]:
        # The fast call differs in leaving out the places of the tokens in the text.
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, int]:
        """Code the pieces and add them to the known ones; returns their places, and how many places are to be remembered.

        Pieces that begin with white space and do not end in it are joined to texts, in which they start new matches; the lengths of the
        tokens in bytes tell where a piece ends.
        """
        bounds, raw = _parts(pieces)
        length = np.diff(bounds)
        alone = (_STARTS[raw[bounds[:-1]]] != 1) | _after_white(raw, bounds[1:]) | (length > LONG_PIECE) | _holds(pieces, self.special)
        # Joined ones first, long ones last.
        order = np.argsort(alone.astype(np.int8) + (length > LONG_PIECE), kind="stable")
        pieces, length = pieces.take(pa.array(order)), length[order]
        bounds, raw = _parts(pieces)
        joined = len(pieces) - int(alone.sum())
        ids, sizes = [self.flat[: self.ends[-1]]], [np.zeros(0, np.int64)]
        for i in range(0, joined, JOINED * CALLED):
            upto = min(i + JOINED * CALLED, joined)
            cuts = [*bounds[i:upto:JOINED].tolist(), int(bounds[upto])]
            coded = self._code([raw[a:b].tobytes().decode() for a, b in pairwise(cuts)])
            ids.append(np.concatenate([np.array(c, np.uint32) for c in coded]))
            tokens_end = np.cumsum(self.bytes_of[ids[-1]])
            sizes.append(np.diff(np.searchsorted(tokens_end, np.cumsum(length[i:upto])) + 1, prepend=0))
        names = _strings(pieces)
        for i in range(joined, len(pieces), CALLED):
            coded = self._code(names[i : i + CALLED])
            ids.append(np.fromiter(chain.from_iterable(coded), np.uint32))
            sizes.append(np.fromiter(map(len, coded), np.int64))
        places = np.empty(len(pieces), np.int64)
        places[order] = np.arange(len(self.known), len(self.known) + len(pieces))
        self.flat = np.concatenate(ids)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])
        remembered = len(pieces) - int((length > LONG_PIECE).sum())
        self.known.update(zip(names[:remembered], range(len(self.known), len(self.known) + remembered), strict=True))
        return places, len(self.known)

    def _keep(self, count: int) -> None:
        """Only the first places stay."""
        if count < len(self.known):
            self.known = dict(islice(self.known.items(), count))
        if count + 1 < len(self.ends):
            self.ends = self.ends[: count + 1].copy()
            self.flat = self.flat[: self.ends[-1]].copy()

    def ids(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        texts = (pa.array(texts, pa.string()) if isinstance(texts, list) else texts).cast(pa.large_string())
        bounds, _ = _parts(texts)
        cuts = np.flatnonzero(np.diff(bounds[:-1] // CUT, prepend=-1)).tolist()
        return [run for a, b in pairwise([*cuts, len(texts)]) for run in self._ids(texts.slice(a, b - a))]

    def _ids(self, texts: pa.LargeStringArray) -> list[np.ndarray]:
        bounds, raw = _parts(texts)
        if not len(raw):
            return [np.zeros(0, np.uint32)] * len(texts)
        border = _borders(raw)
        for number in np.flatnonzero(_holds(texts, self.special)).tolist():
            border[bounds[number] : bounds[number + 1]] = False
        border[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(border)
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw)).dictionary_encode()
        places = np.fromiter(map(self.known.get, _strings(pieces.dictionary), repeat(-1)), np.int64, len(pieces.dictionary))
        new, keep = np.flatnonzero(places < 0), len(self.known)
        if len(new):
            places[new], keep = self._learn(pieces.dictionary.take(pa.array(new)))
        coded = pa.LargeListArray.from_arrays(pa.array(self.ends), pa.array(self.flat)).take(pa.array(places).take(pieces.indices))
        upto, ids = np.asarray(coded.offsets), np.asarray(coded.values)
        ends = upto[np.searchsorted(starts, bounds)]
        self._keep(keep if keep <= MEMORY else MEMORY // 2)
        return [ids[a:b] for a, b in pairwise(ends.tolist())]


@lru_cache(maxsize=1)
def _tokens(path: str) -> Tokens:
    return Tokens(tokenizer_path(path))


def tokenizer_path(name: str) -> str:
    """The file itself, or where this machine has the public tokenizer of that name."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


SEGMENT_SCHEMA = "part int, segment int, n_ids long, no_id binary, doc_ids binary, doc_ends binary, payload binary"


def _segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Code the sorted documents of a partition into segments of about SEGMENT_IDS ids."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    docs: list[int | None] = []
    runs: list[np.ndarray] = []
    size, end = 0, np.array([end_id], np.uint32)

    def flush() -> pa.RecordBatch:
        missing = np.array([d is None for d in docs], np.uint8)
        values = np.array([0 if d is None else d for d in docs], "<i8")
        ends = np.cumsum([len(r) + 1 for r in runs]).astype("<u8")
        ids = np.concatenate([x for r in runs for x in (r, end)])
        row = [part, number, int(ends[-1]), missing.tobytes(), values.tobytes(), ends.tobytes(), encode(ids)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        names = [c.split()[0] for c in SEGMENT_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    for batch in batches:
        coded = _tokens(path).ids(pc.fill_null(batch.column(1), ""))
        for doc, run in zip(batch.column(0).to_pylist(), coded, strict=True):
            docs.append(doc)
            runs.append(run)
            size += len(run) + 1
            if size >= SEGMENT_IDS:
                yield flush()
                docs, runs, size, number = [], [], 0, number + 1
    if docs:
        yield flush()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Write the ids of all documents in ascending doc_id order under ``path``.

    Documents are range-partitioned by id and sorted inside each part; every part is
    written as rows of (part, segment, documents, payload). Null texts are empty (the
    end id alone), null ids come first, rows with the same id follow the order of
    their texts. Only doc_id and text are read.
    """
    prepare(docs.sparkSession)
    ordered = docs.select("doc_id", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    segments = ordered.mapInArrow(lambda batches: _segments(batches, tokenizer, end_id), SEGMENT_SCHEMA)
    segments.write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids.

    ``start`` counts the ids of all documents before it, found from the sums of the
    segments; ``ids_crc32`` is that of the ids as little-endian 32-bit integers.
    """
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    sizes = segments.select("part", "segment", "n_ids")
    # One row per part of the files, so this window orders a short list.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("part").orderBy("segment")
    starts = sizes.join(before, "part").select(
        "part", "segment", (F.col("before") + F.sum("n_ids").over(inside) - F.col("n_ids")).alias("segment_start")
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                missing = np.frombuffer(row["no_id"], np.uint8).astype(bool)
                ends = np.frombuffer(row["doc_ends"], "<u8").astype(np.int64)
                starts_in = np.concatenate(([0], ends[:-1]))
                ids = decode(row["payload"])
                small = ids.astype("<u4")
                columns = {
                    "doc_id": pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=missing),
                    "start": pa.array(row["segment_start"] + starts_in),
                    "n_tokens": pa.array(ends - starts_in),
                    "ids_crc32": pa.array([zlib.crc32(small[a:b]) for a, b in zip(starts_in, ends, strict=True)], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in zip(starts_in, ends, strict=True)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    # One row per segment, a million ids: sent to the tasks, so that the payloads need not be shuffled.
    return segments.drop("n_ids").join(F.broadcast(starts), ["part", "segment"]).mapInArrow(documents, schema)
