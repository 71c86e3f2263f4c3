"""Byte-level BPE by rank files: exact ids in linear time, and back to bytes.

A text is cut by a pattern, and each match is coded by itself. A match that is a token is that
token. Any other is coded without replaying the merges: the longest token at a place is taken
(a pyahocorasick automaton over the tokens' bytes, one Latin-1 character for each byte) if it
may stand after the token before it; otherwise shorter tokens are tried, and when none fits, the
token before is given up. Two tokens may stand side by side if merging their joined bytes gives just
these two; the answer is remembered. A row of tokens of which all neighbours may stand side by side is the
one that the merges give, since the first merge across a border would also happen in the
two tokens beside that border alone. A place from which no way leads on is marked and never entered again, so a
match takes time in proportion to its length.

Results for special rows: a missing or empty text has no ids; rows without ``doc_id`` and repeated
rows are coded like all others; other columns are ignored, whatever their names. Texts of any length are coded whole.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Most remembered pieces of text, and neighbours; both are dropped when full. Longer pieces are not remembered.
REMEMBERED = 1 << 19
REMEMBERED_NEIGHBOURS = 1 << 20
REMEMBERED_LENGTH = 64
#: Bytes of results after which a batch is handed on.
BATCH_BYTES = 8 << 20
#: Characters from which on the pieces of a text are not held at the same time.
LONG_TEXT = 1 << 20

_WIDTH = 4
_NEVER = 1 << 40
#: A code point that no Unicode version assigns.
_UNASSIGNED = "\uFFFF"


class Codec:
    """Encoder and decoder for the ranks in one file of lines ``base64 rank``."""

    def __init__(self, path: str, pattern: str) -> None:
        import ahocorasick
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        if absent := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"{path} has no token for {len(absent)} of the 256 bytes")
        self.names = {rank: token for token, rank in self.ranks.items()}
        self.sizes = {rank: len(token) for token, rank in self.ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self.newer = _newer_characters(pattern)
        self.unassigned = dict.fromkeys(map(ord, self.newer), _UNASSIGNED)
        self.pieces = _Pieces(self)
        self.neighbours: dict[int, bool] = {}
        self.histories: dict[int, list[tuple[int, bytes, bytes]] | None] = {}
        self.shorter: dict[int, int | None] = {}

    def encode(self, text: str) -> bytes:
        """Ids of the whole text, four bytes each, little-endian."""
        return b"".join(map(self.pieces.__getitem__, self.cut(text)))

    def cut(self, text: str) -> Iterable[str]:
        """All matches of the pattern, as tiktoken finds them."""
        if not text.isascii() and not self.newer.isdisjoint(text):
            # Cut a text of as many characters, with an unassigned one in the place of each that tiktoken does not know.
            return (text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.unassigned)))
        if len(text) < LONG_TEXT:
            return self.pattern.findall(text)
        return (m.group() for m in self.pattern.finditer(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self._backtrack(piece)

    def _backtrack(self, piece: bytes) -> list[int]:
        latin, end = piece.decode("latin-1"), len(piece)
        sizes, known, longest = self.sizes, self.neighbours, self._longest
        dead = bytearray(end + 1)
        ids: list[int] = []
        at, token, before = 0, longest(latin, 0), -1
        while at < end:
            after = at + sizes[token]
            fits = not dead[after]
            if fits and before < 0:
                fits = self.history(token) is not None
            elif fits:
                fits = known.get(before << 32 | token)
                if fits is None:
                    fits = self.may_follow(before, token)
            if fits:
                ids.append(token)
                at, before = after, token
                if at < end:
                    token = longest(latin, at)
            elif (less := self.next_shorter(token)) is not None:
                token = less
            else:
                dead[at] = 1
                token = ids.pop()
                at -= sizes[token]
                before = ids[-1] if ids else -1
        return ids

    def _longest(self, latin: str, at: int) -> int:
        """The longest token at a place; no more than its possible length is looked at."""
        if len(latin) > self.longest:
            latin, at = latin[at : at + self.longest], 0
        return next(self.automaton.iter_long(latin, at))[1]

    def next_shorter(self, token: int) -> int | None:
        """The longest token that begins ``token`` and is shorter."""
        if token not in self.shorter:
            name = self.names[token]
            self.shorter[token] = next((self.ranks[name[:n]] for n in range(len(name) - 1, 0, -1) if name[:n] in self.ranks), None)
        return self.shorter[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of the two tokens gives these two again.

        Both tokens go through the merges they go through alone, the next lowest rank first, until a merge
        across the border has a lower rank than theirs (of equal ranks the leftmost is merged).
        """
        pair = left << 32 | right
        known = self.neighbours.get(pair)
        if known is None:
            if len(self.neighbours) >= REMEMBERED_NEIGHBOURS:
                self.neighbours.clear()
            known = self.neighbours[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        a, b = self.history(left), self.history(right)
        if a is None or b is None:
            return False
        end, start = self.names[left][-1:], self.names[right][:1]
        i = j = 0
        while True:
            across = self.ranks.get(end + start, _NEVER)
            next_a = a[i][0] if i < len(a) else _NEVER
            next_b = b[j][0] if j < len(b) else _NEVER
            if across < next_a and across <= next_b:
                return False
            if next_a == next_b == _NEVER:
                return True
            if next_a <= next_b:
                end = a[i][2]
                i += 1
            else:
                start = b[j][1]
                j += 1

    def history(self, token: int) -> list[tuple[int, bytes, bytes]] | None:
        """The merges of a token's own bytes: rank, first and last part after it. None if they do not lead to the token."""
        if token not in self.histories:
            name, steps = self.names[token], []
            parts = [name[i : i + 1] for i in range(len(name))]
            while len(parts) > 1:
                rank, i = min((self.ranks.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
                if rank == _NEVER:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                steps.append((rank, parts[0], parts[-1]))
            self.histories[token] = steps if len(parts) == 1 else None
        return self.histories[token]


def _newer_characters(pattern: str) -> frozenset[str]:
    """Characters that the regex module's newer tables call letters or numbers, and tiktoken's tables do not know yet.

    tiktoken is asked with ranks that join a letter or digit with the first byte of what follows in the same match.
    """
    import regex
    import tiktoken

    characters = "".join(map(chr, chain(range(0x80, 0xD800), range(0xE000, 0x110000))))
    candidates = [c for c in regex.findall(r"[\p{L}\p{N}]", characters) if unicodedata.category(c) == "Cn"]
    ranks = {bytes([b]): b for b in range(256)}
    for known in b"a1":
        for lead in range(0xC2, 0xF5):
            ranks[bytes([known, lead])] = len(ranks)
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return frozenset(c for c in candidates if all(probe.encode_ordinary(known + c)[0] < 256 for known in "a1"))


class _Pieces(dict):
    """Coded pieces by their text; codes those it has not seen."""

    def __init__(self, codec: Codec) -> None:
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.codec.encode_piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=4)
def codec(vocabulary: str, pattern: str | None) -> Codec:
    """One codec for each worker process. ``vocabulary``: a file, or a name that public_tokenizers knows on the worker."""
    import public_tokenizers

    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    return Codec(path, public_tokenizers.PATTERN if pattern is None else pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (four bytes each, little-endian) of every row's whole text."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary, pattern)
        yield from _coded(batches, lambda text: coder.encode(text.as_py() or ""))

    coded = docs.select("doc_id", F.col("text").cast("string").alias("value")).mapInArrow(run, f"doc_id {doc_type}, value binary")
    return coded.select("doc_id", (F.octet_length("value") / _WIDTH).cast("long").alias("n_tokens"), F.col("value").alias("ids"))


def decode(coded: DataFrame, vocabulary: str, pattern: str | None = None) -> DataFrame:
    """``doc_id`` and ``data``, the bytes that the ``ids`` of each row stand for; no ids are no bytes."""
    doc_type = coded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary, pattern)
        yield from _coded(batches, lambda ids: coder.decode(ids.as_buffer() if ids.is_valid else b""))

    decoded = coded.select("doc_id", F.col("ids").alias("value")).mapInArrow(run, f"doc_id {doc_type}, value binary")
    return decoded.select("doc_id", F.col("value").alias("data"))


def round_trip(docs: DataFrame, vocabulary: str, pattern: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``data``: every text's ids, and the bytes decoded from them."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    coded = encode(docs, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary, pattern)
        for batch in batches:
            ids = batch.column("ids")
            at = 0
            for part in _parts(coder.decode(x.as_buffer()) for x in ids):
                rows = batch.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(part, pa.binary())], [*rows.schema.names, "data"])

    return coded.mapInArrow(run, f"doc_id {doc_type}, n_tokens long, ids binary, data binary")


def _coded(batches: Iterator[pa.RecordBatch], code) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for part in _parts(map(code, batch.column("value"))):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(part)), pa.array(part, pa.binary())], ["doc_id", "value"])
            at += len(part)


def _parts(values: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Values in lists of about ``BATCH_BYTES``, so that long texts do not add up in one batch."""
    part, size = [], 0
    for value in values:
        part.append(value)
        size += len(value)
        if size >= BATCH_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part
