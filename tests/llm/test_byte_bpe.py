"""Byte-level BPE against tiktoken, the merges themselves and an exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from shelfline.llm import byte_bpe, queries

RANKS = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.codec(RANKS, None)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def ids_of(coder, text):
    return np.frombuffer(coder.encode(text), "<u4").tolist()


def test_ids_equal_tiktoken_for_random_texts(coder, library):
    rng = random.Random(4)
    names = [name.decode("utf-8", "ignore") for name in coder.ranks]
    odd = [" ", "　", " ", "\t", "\n", "\r\n", "\x1c", "\x85", "'s", "'S", "é", "漢", "한", "١", "½", "😀", "‍", "�", "\x00"]
    for _ in range(8000):
        text = "".join(rng.choice((rng.choice(names), rng.choice(names).strip(), rng.choice(odd) * rng.randint(1, 6), rng.choice("abcxyz.0-"))) for _ in range(rng.randint(0, 12)))
        assert ids_of(coder, text) == library.encode_ordinary(text), repr(text)
        assert coder.decode(coder.encode(text)) == text.encode()


def test_every_character_is_cut_as_tiktoken_cuts_it(coder, library):
    step = 7  # coprime to the size of all blocks of characters
    for code in [*range(0x80, 0x3000), *range(0x3000, 0xD800, step), *range(0xE000, 0x110000, step * 5), 0x20C1, 0x323B0]:
        c = chr(code)
        text = f"a{c}a1{c}1.{c}. {c}  {c}'s{c}"
        assert ids_of(coder, text) == library.encode_ordinary(text), hex(code)


def test_pieces_of_bytes_equal_the_merges(coder):
    rng = random.Random(5)
    for _ in range(3000):
        piece = bytes(rng.choice(b"abe t\xc3\xa9\xe6\xbc\xa2\xff") for _ in range(rng.randint(1, 24)))
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, i = min((coder.ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
            if rank == 1 << 40:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert coder.encode_piece(piece) == ([coder.ranks[piece]] if piece in coder.ranks else [coder.ranks[x] for x in parts])


def test_small_ranks_that_need_every_way_back(tmp_path):
    """Ranks in which long tokens mislead, one is out of reach of the merges, and a shorter token's rank is higher than a longer one's."""
    import base64

    names = [bytes([b]) for b in range(256)] + [b"bc", b"ab", b"cd", b"abcd", b"abc", b"de", b"bcde", b"aa", b"aaaa", b"xyz"]
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(n) + b" %d\n" % i for i, n in enumerate(names)))
    coder = byte_bpe.codec(str(path), None)
    library = tiktoken.Encoding("small", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    rng = random.Random(6)
    for _ in range(4000):
        text = "".join(rng.choice("abcdexyz") for _ in range(rng.randint(1, 14)))
        assert ids_of(coder, text) == library.encode_ordinary(text), text
    (tmp_path / "none.tiktoken").write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.codec(str(tmp_path / "none.tiktoken"), None)


def test_full_memories_change_nothing(coder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    monkeypatch.setattr(byte_bpe, "REMEMBERED_NEIGHBOURS", 5)
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 10)
    text = "Unfathomable ententes, 1234 zwölf Boxkämpfer; ändern naïve œuvres\n\n  ok " * 3
    assert ids_of(coder, text) == library.encode_ordinary(text)


def test_documents(spark, docs, texts, no_docs, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BATCH_BYTES", 3000)
    long = "ab " * 150_000 + "x" * 150_000
    extra = spark.createDataFrame([(None, "one two"), (7, "one two"), (7, "one two"), (8, long)], "doc_id long, text string")
    both = docs.unionByName(extra, allowMissingColumns=True)
    both = both.selectExpr("*", "1 as n_tokens", "'x' as ids", "'y' as value", "2 as data")
    wanted = {}
    for doc_id, text in [*texts, (None, "one two"), (7, "one two"), (7, "one two"), (8, long)]:
        ids = library.encode_ordinary(text or "")
        row = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        wanted.setdefault(doc_id, []).append(row)
    got = {}
    for r in byte_bpe.round_trip(both, RANKS).selectExpr("doc_id", "n_tokens", "sha2(ids, 256)", "sha2(data, 256)").collect():
        got.setdefault(r[0], []).append(tuple(r)[1:])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in wanted.items()}
    again = byte_bpe.decode(byte_bpe.encode(both, RANKS).drop("n_tokens"), RANKS)
    assert sorted(bytes(r["data"]).decode() for r in again.collect()) == sorted([*(t or "" for _, t in texts), *["one two"] * 3, long])
    assert byte_bpe.round_trip(no_docs, RANKS).count() == 0
    assert byte_bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), RANKS).first()["data"] == b""


def test_query_columns(spark):
    df = queries.op13_byte_bpe(spark, "/root/testdata/sf0.001")
    assert df.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
