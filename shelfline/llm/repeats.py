"""Removal of repeated byte strings with a column-wise Burrows-Wheeler construction.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier.
Equal strings hold the same smallest k-byte hash (k = ``MER``), so the strings are
dealt out by that hash: successive positions that share it form one piece of text,
whose strings are exactly its windows. Within a batch of documents only the first of
equal pieces is sent on; the others are repeats already.

First only keys travel: the shared hash, a second 64-bit hash of the piece's bytes, and
where it stands. They settle all equal pieces, and show which hashes are shared by pieces that
differ; only those pieces are read from their texts. For them the Burrows-Wheeler transform of
the whole collection is built column by column: in each round one symbol per piece is
inserted, from the right end, at the place its predecessor's rank gives, and the common
prefix lengths of the new suffixes and their successors follow from range minima of the
previous round. Rounds run over blocks of ``BLOCK`` bytes of pieces (whole hash groups, so at
most one group more), in arrays read and written front to back. Suffixes that share
LENGTH bytes stand together; all but the first occurrence are repeats.

A hash shared by very many different pieces (the edges of a passage that a large share
of all documents holds) would fill one task. Such hashes are recognised in a sample of
documents; their windows are dealt one by one by a hash of the whole window instead, and
are then equal pieces or different ones. The choice moves work only, the result is the same.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, functions as F

from shelfline.llm.common import Scratch, map_arrow, prepare
from shelfline.llm.text import chunks, mix, powers, texts_of

LENGTH = 100
MER = 40
#: Most windows of one piece, which bounds the rounds of the construction.
PIECE = 64
BLOCK = 1 << 17
#: Bytes of text for which there is a bucket at least.
BUCKET_BYTES = 128 << 20
#: Documents sampled for hashes with very many pieces, and from how many pieces there a hash is dealt by window.
SAMPLE, HOT = 20_000, 20
_LAST = np.int64((1 << 63) - 1)
_HEAD = struct.Struct("<QQ")
#: Added to the size of a piece that can hold equal windows.
_INNER = 1 << 15
#: Stands for the missing symbol before a whole string; UTF-8 has no such byte.
_DONE = np.uint8(0xFF)


class Pieces:
    """Pieces of text: bytes in ``data`` from start to end, owner (doc, sub) and place of the first window."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, sub: np.ndarray, place: np.ndarray) -> None:
        self.data, self.start, self.end, self.doc, self.sub, self.place = data, start, end, doc, sub, place

    def __len__(self) -> int:
        return len(self.start)

    def take(self, which: np.ndarray) -> Pieces:
        return Pieces(self.data, self.start[which], self.end[which], self.doc[which], self.sub[which], self.place[which])

    def bytes(self) -> np.ndarray:
        size = self.end - self.start
        shift = self.start - (np.cumsum(size) - size)
        return self.data[np.repeat(shift, size) + np.arange(int(size.sum()))]

    def pack(self) -> bytes:
        size = (self.end - self.start).astype("<u2")
        parts = [size, self.doc.astype("<i8"), self.sub.astype("<i8"), self.place.astype("<u8"), self.bytes()]
        body = _HEAD.pack(len(self), int(size.astype(np.int64).sum())) + b"".join(p.tobytes() for p in parts)
        return zstandard.ZstdCompressor(level=1).compress(body)


def unpack(payloads: list[bytes]) -> Pieces:
    size, doc, sub, place, data = [], [], [], [], []
    for payload in payloads:
        body = zstandard.ZstdDecompressor().decompress(payload)
        n, total = _HEAD.unpack_from(body)
        at = _HEAD.size
        for out, kind, width in ((size, "<u2", 2), (doc, "<i8", 8), (sub, "<i8", 8), (place, "<u8", 8)):
            out.append(np.frombuffer(body, kind, n, at))
            at += n * width
        data.append(np.frombuffer(body, np.uint8, total, at))
    size = np.concatenate(size).astype(np.int64)
    end = np.cumsum(size)
    return Pieces(np.concatenate(data), end - size, end, np.concatenate(doc), np.concatenate(sub), np.concatenate(place).astype(np.int64))


def _range_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums for the hash of any range of ``data``, and the powers that shift it to its start."""
    up, down = powers(len(data) + 1)
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)]))), down


def window_minima(mers: np.ndarray) -> np.ndarray:
    """The smallest of the MER hashes inside the window from each position on."""
    if len(mers) < LENGTH - MER + 1:
        return np.zeros(0, np.uint64)
    low = mers
    span, width = LENGTH - MER + 1, 1
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def cut_pieces(texts: list[bytes], doc: np.ndarray, sub: np.ndarray) -> tuple[Pieces, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of some texts, the hash each shares, a hash of its bytes, and whether windows of one piece can be equal.

    Equal windows of a piece hold the shared hash at different places, so the piece goes on
    behind a window that starts with it.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    sums, down = _range_hashes(data)
    size = max(0, len(data) - MER + 1)
    mers = mix((sums[len(sums) - size :] - sums[:size]) * down[:size])
    low = window_minima(mers)
    windows = np.maximum(0, ends - starts - LENGTH + 1)
    owner = np.repeat(np.arange(len(texts)), windows)
    place = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    at = starts[owner] + place
    value = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    run = np.diff(np.append(first, len(at)))
    # Long runs (repetitive text) are cut, which keeps all windows of a hash together.
    parts = -(-run // PIECE)
    begin = np.repeat(first, parts) + PIECE * (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts))
    count = np.minimum(PIECE, np.repeat(first + run, parts) - begin)
    start = at[begin]
    end = start + count + LENGTH - 1
    pieces = Pieces(data, start, end, doc[owner[begin]], sub[owner[begin]], place[begin])
    passed = np.concatenate(([0], np.cumsum(mers[: len(low)] == low)))
    inner = passed[end - LENGTH] > passed[start]
    return pieces, value[begin], mix((sums[end] - sums[start]) * down[start]), inner


def earlier_exists(group: np.ndarray, doc: np.ndarray, sub: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which entries have an equal string (same group) in a smaller document or earlier in their own."""
    order = np.lexsort((place, sub, doc, group))
    g, d, s, p = group[order], doc[order], sub[order], place[order]
    new_group = np.ones(len(order), bool)
    new_group[1:] = g[1:] != g[:-1]
    head = np.maximum.accumulate(np.where(new_group, np.arange(len(order)), 0))
    new_owner = new_group.copy()
    new_owner[1:] |= (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    own_head = np.maximum.accumulate(np.where(new_owner, np.arange(len(order)), 0))
    out = np.zeros(len(order), bool)
    out[order] = (d > d[head]) | (p > p[own_head])
    return out


def _same(*keys: np.ndarray) -> np.ndarray:
    """Number of the group of equal keys that each entry belongs to."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), np.int64)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def transform(strings: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes of a collection in order: string, start of the suffix, common prefix with the one before.

    The ends of strings are distinct and sort first, by string. Each round prepends
    one symbol to every unfinished string's last suffix.
    """
    data = np.append(strings.bytes(), np.uint8(0))
    size = (strings.end - strings.start).astype(np.int32)
    last = np.cumsum(size, dtype=np.int32)
    first = last - size
    n = len(size)
    # One record per suffix, so that a round moves them once: where it starts, the common prefix, the symbol before it.
    record = np.dtype([("at", np.int32), ("prefix", np.uint16), ("before", np.uint8), ("", np.uint8)])
    suffixes = np.zeros(n, record)
    suffixes["at"] = last
    suffixes["before"] = np.where(size > 0, data[last - 1], _DONE)
    newest = np.arange(n, dtype=np.int32)  # place of each string's latest suffix
    active = np.flatnonzero(size > 0).astype(np.int32)
    whole = n - len(active)
    numbers = np.arange(n + len(data) - 1, dtype=np.int32)
    rank = np.empty_like(numbers)
    while len(active):
        before = np.ascontiguousarray(suffixes["before"])
        # Suffixes that start with a symbol, in order of symbol and of the suffix behind it; whole strings, without one, come last.
        order = np.argsort(before, kind="stable")
        kept = len(order) - whole
        rank[order] = numbers[: len(order)]
        new = rank[newest[active]]
        by_rank = np.argsort(new)
        active, new = active[by_rank], new[by_rank]
        places = newest[active]
        # A new suffix and the one after it have a new neighbour before them.
        after = new[np.append(new[1:] != new[:-1] + 1, new[-1] + 1 < kept)] + 1
        touched = np.sort(np.concatenate((new, after)))
        behind = order[np.maximum(touched - 1, 0)]
        here = order[touched]
        inner = np.flatnonzero((touched > 0) & (before[here] == before[behind]))
        value = np.zeros(len(touched), np.uint16)
        if len(inner):
            # From the last range to the first: what lies between two of them is then no range of its own.
            inner = inner[np.argsort(-behind[inner])]
            bounds = np.stack((behind[inner] + 1, here[inner] + 1), axis=1).ravel()
            value[inner] = 1 + np.minimum.reduceat(np.append(suffixes["prefix"], np.uint16(0)), bounds)[::2]
        place = n + new
        old = np.ones(len(suffixes) + len(new), bool)
        old[place] = False
        added = np.zeros(len(new), record)
        added["at"] = suffixes["at"][places] - 1
        goes_on = added["at"] > first[active]
        added["before"] = np.where(goes_on, data[added["at"] - 1], _DONE)
        # Moved as plain numbers, which NumPy copies fastest.
        grown = np.empty(len(old), np.uint64)
        grown[old] = suffixes.view(np.uint64)
        grown[place] = added.view(np.uint64)
        suffixes = grown.view(record)
        suffixes["prefix"][n + touched] = value
        newest[active] = place
        whole += len(active) - np.count_nonzero(goes_on)
        active = active[goes_on]
    # Ends of strings come first, by string; every other suffix starts inside its string.
    owner = np.repeat(np.arange(n, dtype=np.int32), size)[np.minimum(suffixes["at"], len(data) - 2)] if len(data) > 1 else np.zeros(n, np.int32)
    owner[:n] = np.arange(n)
    return owner, suffixes["at"] - first[owner], suffixes["prefix"].astype(np.int32)


def repeated_windows(pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of every window of a collection that also starts earlier."""
    owner, left, prefix = transform(pieces)
    whole = (pieces.end - pieces.start)[owner] - left >= LENGTH
    group = np.cumsum(prefix < LENGTH)
    # A suffix too short for a window breaks no group: its prefix with both neighbours is short.
    owner, left, group = owner[whole], left[whole], group[whole]
    late = earlier_exists(group, pieces.doc[owner], pieces.sub[owner], pieces.place[owner] + left)
    return owner[late], left[late]


def _cuts(doc: np.ndarray, sub: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Merged byte ranges by document."""
    if not len(doc):
        return
    order = np.lexsort((first, sub, doc))
    doc, sub, first, last = doc[order], sub[order], first[order], last[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1])
    bounds = np.append(np.flatnonzero(new), len(doc))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield int(doc[a]), int(sub[a]), np.stack(merge(first[a:b], last[a:b]), axis=1).astype("<u8").tobytes()


def merge(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges sorted by their first element; ranges that touch become one."""
    reach = np.maximum.accumulate(last)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return first[heads], reach[np.append(heads[1:], len(first)) - 1]


_SCHEMA = "bucket int, payload binary, doc long, sub long, cuts binary, wanted binary"
_KINDS = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
_KEY = [("value", "<u8"), ("content", "<u8"), ("size", "<u2"), ("place", "<u8"), ("doc", "<i8"), ("sub", "<i8")]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names)


def _pack_keys(columns: dict[str, np.ndarray]) -> bytes:
    body = struct.pack("<Q", len(columns["value"])) + b"".join(columns[k].astype(t).tobytes() for k, t in _KEY)
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack_keys(payloads: list[bytes]) -> dict[str, np.ndarray]:
    parts: dict[str, list[np.ndarray]] = {k: [] for k, _ in _KEY}
    for payload in payloads:
        body = zstandard.ZstdDecompressor().decompress(payload)
        (n,), at = struct.unpack_from("<Q", body), 8
        for k, t in _KEY:
            parts[k].append(np.frombuffer(body, t, n, at))
            at += n * np.dtype(t).itemsize
    out = {k: np.concatenate(v) for k, v in parts.items()}
    return out | {k: out[k].astype(np.int64) for k in ("size", "place")}


def _batch_pieces(batch: pa.RecordBatch) -> Iterator[tuple[Pieces, np.ndarray, np.ndarray, np.ndarray]]:
    doc = np.array([_LAST if d is None else d for d in batch.column(0).to_pylist()], np.int64)
    sub = np.array(batch.column(1).to_pylist(), np.int64)
    for base, texts in chunks(texts_of(batch.column(2)), 4 << 20):
        found = cut_pieces(texts, doc[base : base + len(texts)], sub[base : base + len(texts)])
        if len(found[0]):
            yield found


def hot_hashes(rows: DataFrame) -> np.ndarray:
    """Hashes that HOT or more different pieces of SAMPLE documents (taken by a hash of their ids) share.

    At most the sample's pieces divided by HOT reach the driver.
    """
    total = rows.count()
    share = min(1.0, SAMPLE / max(1, total))
    sample = rows.where(F.pmod(F.xxhash64("doc", "sub"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, value, content, _ in _batch_pieces(batch):
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(content.view(np.int64))], ["value", "content"])

    found = sample.mapInArrow(values, "value long, content long").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return np.sort(np.array([r["value"] for r in found.where(F.col("n") >= HOT).collect()], np.int64).view(np.uint64))


def _split_hot(
    pieces: Pieces, value: np.ndarray, content: np.ndarray, inner: np.ndarray, hot: np.ndarray
) -> tuple[Pieces, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of hot hashes become single windows, dealt by their own hash and told apart by it and the shared one."""
    if not len(hot):
        return pieces, value, content, inner
    is_hot = hot[np.minimum(np.searchsorted(hot, value), len(hot) - 1)] == value
    if not is_hot.any():
        return pieces, value, content, inner
    long, cold = pieces.take(is_hot), ~is_hot
    count = long.end - long.start - LENGTH + 1
    offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    source = np.repeat(np.arange(len(long)), count)
    start = long.start[source] + offset
    sums, down = _range_hashes(pieces.data)
    own = mix((sums[start + LENGTH] - sums[start]) * down[start])
    joined = [
        np.concatenate((a[cold], b))
        for a, b in (
            (pieces.start, start), (pieces.end, start + LENGTH), (pieces.doc, long.doc[source]),
            (pieces.sub, long.sub[source]), (pieces.place, long.place[source] + offset), (value, own), (content, value[is_hot][source]),
        )
    ]
    return Pieces(pieces.data, *joined[:5]), joined[5], joined[6], np.append(inner[cold], np.zeros(len(source), bool))


def _deal(rows: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """Distinct pieces of each batch by bucket, and what the batch itself shows to be repeated."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in _batch_pieces(batch):
                pieces, value, content, inner = _split_hot(*found, hot)
                size = pieces.end - pieces.start
                late = earlier_exists(_same(value, content, size), pieces.doc, pieces.sub, pieces.place)
                gone = pieces.take(late)
                out = [(d % buckets, None, d, s, c, None) for d, s, c in _cuts(gone.doc, gone.sub, gone.place, gone.place + size[late])]
                keys = {"value": value, "content": content, "size": size + _INNER * inner, "place": pieces.place, "doc": pieces.doc, "sub": pieces.sub}
                bucket = (value % np.uint64(buckets)).astype(np.int64)
                bucket[late] = buckets
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    chosen = order[edges[b] : edges[b + 1]]
                    out.append((b, _pack_keys({k: v[chosen] for k, v in keys.items()}), None, None, None, None))
                yield _rows(out)

    return rows.mapInArrow(deal, _SCHEMA)


def _compare_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By document: ranges of pieces that equal an earlier one, and the (place, size) of pieces to be read.

    Ranges that the batches found on their own pass through.
    """
    payloads: list[bytes] = []
    for batch in batches:
        column = batch.column(1)
        payloads += [p for p in column.to_pylist() if p is not None]
        known = batch.filter(pa.compute.is_null(column))
        if known.num_rows:
            yield known
    if not payloads:
        return
    keys = _unpack_keys(payloads)
    doc, sub, place, value = (keys[k] for k in ("doc", "sub", "place", "value"))
    size, inner = keys["size"] % _INNER, keys["size"] >= _INNER
    late = earlier_exists(_same(value, keys["content"], size), doc, sub, place)
    rows = [(0, None, d, s, c, None) for d, s, c in _cuts(doc[late], sub[late], place[late], (place + size)[late])]
    left = np.flatnonzero(~late)
    order = left[np.argsort(value[left], kind="stable")]
    # Rows of one piece that merely share an id do not make a hash worth reading, different pieces do.
    again = np.zeros(len(order), bool)
    again[1:] = value[order][1:] == value[order][:-1]
    again[:-1] |= again[1:]
    order = order[again | inner[order]]
    order = order[np.lexsort((place[order], sub[order], doc[order]))]
    new = np.ones(len(order), bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (sub[order][1:] != sub[order][:-1])
    bounds = np.append(np.flatnonzero(new), len(order)).tolist()
    wanted = np.stack((place[order], size[order]), axis=1).astype("<u8")
    rows += [(0, None, int(doc[order[a]]), int(sub[order[a]]), None, wanted[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    yield _rows(rows)


def _shared_hashes(pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The smallest MER hash and the content hash of each piece."""
    value, content = np.zeros(len(pieces), np.uint64), np.zeros(len(pieces), np.uint64)
    step = 1 << 13
    for a in range(0, len(pieces), step):
        start, end = pieces.start[a : a + step], pieces.end[a : a + step]
        data = pieces.data[start[0] : end[-1]]
        sums, down = _range_hashes(data)
        mers = mix((sums[MER:] - sums[:-MER]) * down[: len(data) - MER + 1])
        start, end = start - start[0], end - pieces.start[a]
        bounds = np.stack((start, np.minimum(end - MER + 1, len(mers))), axis=1).ravel()
        value[a : a + step] = np.minimum.reduceat(np.append(mers, np.uint64((1 << 64) - 1)), bounds)[::2]
        content[a : a + step] = mix((sums[end] - sums[start]) * down[start])
    return value, content


def _read_pieces(batch: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    """The wanted pieces of some texts (doc, sub, text, wanted), packed by the bucket of their hash."""
    doc, sub = (np.array(batch.column(i).to_pylist(), np.int64) for i in (0, 1))
    wanted = batch.column(3).to_pylist()
    out = []
    for base, texts in chunks(texts_of(batch.column(2)), 4 << 20):
        starts = np.cumsum([0, *(len(t) for t in texts)])
        ranges = [np.frombuffer(b"".join(wanted[base + i]), "<u8").reshape(-1, 2).astype(np.int64) for i in range(len(texts))]
        ranges = [r[np.argsort(r[:, 0], kind="stable")] for r in ranges]
        owner = np.repeat(np.arange(len(texts)), [len(r) for r in ranges])
        place, size = np.concatenate(ranges).T
        start = starts[owner] + place
        pieces = Pieces(np.frombuffer(b"".join(texts), np.uint8), start, start + size, doc[base + owner], sub[base + owner], place)
        bucket = (_shared_hashes(pieces)[0] % np.uint64(buckets)).astype(np.int64)
        out += [(b, pieces.take(bucket == b).pack(), None, None, None, None) for b in np.unique(bucket).tolist()]
    return _rows(out)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges that the pieces of one task show to be repeated."""
    payloads = [p for batch in batches for p in batch.column(1).to_pylist()]
    if not payloads:
        return
    pieces = unpack(payloads)
    del payloads
    value, content = _shared_hashes(pieces)
    late = earlier_exists(_same(value, content, pieces.end - pieces.start), pieces.doc, pieces.sub, pieces.place)
    gone = pieces.take(late)
    found = [(gone.doc, gone.sub, gone.place, gone.place + gone.end - gone.start)]
    kept, value = pieces.take(~late), value[~late]
    order = np.argsort(value, kind="stable")
    ordered = value[order]
    # Blocks of whole hash groups.
    size = np.cumsum((kept.end - kept.start)[order])
    group_end = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)) + 1 if len(order) else []
    first = 0
    for end in group_end:
        if end == len(order) or size[end - 1] - (size[first - 1] if first else 0) >= BLOCK:
            some = kept.take(order[first:end])
            owner, offset = repeated_windows(some)
            start = some.place[owner] + offset
            found.append((some.doc[owner], some.sub[owner], start, start + LENGTH))
            first = end
    doc, sub, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
    yield _rows([(0, None, d, s, c, None) for d, s, c in _cuts(doc, sub, start, end)])


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
_RESULT_COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def _removed(texts: list[bytes | None], cuts: list[list[bytes] | None]) -> dict:
    """The columns of _RESULT for texts and the ranges to cut."""
    out: dict[str, list] = {c: [] for c in _RESULT_COLUMNS}
    for text, parts in zip(texts, cuts, strict=True):
        text = text or b""
        removed, spans, kept = 0, [], text
        if parts:
            ranges = np.frombuffer(b"".join(parts), "<u8").reshape(-1, 2).astype(np.int64)
            ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
            first, last = merge(ranges[:, 0], ranges[:, 1])
            spans = [{"start": a, "end": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            removed = int((last - first).sum())
            kept = b"".join(text[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(text)], strict=True))
        for key, item in zip(out, (len(text), removed, len(spans), hashlib.sha256(kept).hexdigest(), spans), strict=True):
            out[key].append(item)
    spans = pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    return out | {"kept_sha256": pa.array(out["kept_sha256"], pa.string()), "spans": spans}


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    ``spans`` are the removed byte ranges (start, end). A null text has no bytes. A row
    without an id comes after all others; rows that share an id (or lack one) are
    documents of their own of which none comes before the other. Only doc_id and text are read.
    """
    spark = prepare(docs.sparkSession)
    scratch = Scratch(spark, "repeats")
    docs = docs.select("doc_id", "text")
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_LAST)))
    # Texts are only told apart by hash where ids do not do it.
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    sub = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    keyed = docs.select("doc_id", "text", number.alias("doc"), sub.alias("sub"))
    hot = hot_hashes(keyed.select("doc", "sub", "text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # A task unpacks its bucket, so their number grows with the text.
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    dealt = _deal(keyed.select("doc", "sub", "text"), buckets, hot).repartitionById(buckets, "bucket")
    by_key = scratch.write(dealt.mapInArrow(_compare_keys, _SCHEMA).select("doc", "sub", "cuts", "wanted"), "keys")
    by_doc = by_key.groupBy("doc", "sub").agg(F.collect_list("cuts").alias("cuts"), F.collect_list("wanted").alias("wanted"))

    kind = docs.schema["doc_id"].dataType.simpleString()
    carried = "doc long, sub long, text string, cuts array<binary>, wanted array<binary>"

    def part(batch: pa.RecordBatch) -> dict:
        """Texts without pieces to be read are finished; the others are carried on."""
        cuts, wanted = batch.column(4).to_pylist(), batch.column(5).to_pylist()
        goes_on = pa.array([bool(w) for w in wanted])
        texts = texts_of(batch.column(1))
        out = _removed([None if w else t for t, w in zip(texts, wanted, strict=True)], [None if w else c for c, w in zip(cuts, wanted, strict=True)])
        rest = {n: pa.compute.if_else(goes_on, batch.column(i), None) for n, i in (("text", 1),)}
        lists = pa.list_(pa.binary())
        rest |= {"cuts": pa.array([c if w else None for c, w in zip(cuts, wanted, strict=True)], lists), "wanted": pa.array([w or None for w in wanted], lists)}
        return {"doc_id": batch.column(0), "doc": batch.column(2), "sub": batch.column(3)} | rest | out

    joined = keyed.join(by_doc, ["doc", "sub"], "left").select("doc_id", "text", "doc", "sub", "cuts", "wanted")
    half = scratch.write(map_arrow(joined, part, f"doc_id {kind}, {carried}, {_RESULT}"), "half")
    scratch.drop(by_key)
    results = ["doc_id", *_RESULT_COLUMNS]
    going_on = half.where("wanted is not null")
    pieces = going_on.select("doc", "sub", "text", "wanted").mapInArrow(
        lambda batches: (_read_pieces(b, buckets) for b in batches if b.num_rows), _SCHEMA
    )
    found = pieces.repartitionById(buckets, "bucket").mapInArrow(_repeats, _SCHEMA)
    more = found.groupBy("doc", "sub").agg(F.collect_list("cuts").alias("more"))
    rest = going_on.join(more, ["doc", "sub"], "left").select("doc_id", "text", F.concat("cuts", F.coalesce("more", F.array().cast("array<binary>"))).alias("cuts"))

    def finish(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0)} | _removed(texts_of(batch.column(1)), batch.column(2).to_pylist())

    return half.where("wanted is null").select(*results).unionByName(map_arrow(rest, finish, f"doc_id {kind}, {_RESULT}"))
