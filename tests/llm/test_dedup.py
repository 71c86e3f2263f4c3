"""Near duplicates and repeated strings against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from shelfline.llm import near_dups, repeats
from shelfline.llm.common import may_be_among


def groups(texts, shingle, percent):
    sets = {}
    for doc, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[doc] = {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()
    label = {d: d for d in sets}
    changed = True
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {d: (len(sets[d]), label[d], label[d] == d) for d in sets}


@pytest.mark.parametrize(("short", "family", "shingle", "percent"), [(12, 1024, 3, 85), (2, 1024, 3, 85), (2, 3, 3, 85), (3, 5, 5, 80)])
def test_near_duplicates_equal_brute_force(monkeypatch, docs, texts, short, family, shingle, percent):
    monkeypatch.setattr(near_dups, "SHORT", short)
    monkeypatch.setattr(near_dups, "FAMILY", family)
    got = {r["doc_id"]: tuple(r)[1:] for r in near_dups.near_duplicates(docs, shingle, percent).collect()}
    assert got == groups(texts, shingle, percent)


def test_near_duplicates_with_repeated_and_missing_ids(spark, texts, no_docs):
    a, b = texts[0][1] + " one two three", texts[1][1] + " four five six"
    docs = spark.createDataFrame([(5, a), (5, b), (3, b), (9, a), (None, a), (7, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dups.near_duplicates(docs, 3, 85).collect()), key=str)
    assert got == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (9, 3, False), (None, None, True), (7, 7, True)], key=str)
    assert near_dups.near_duplicates(no_docs).count() == 0
    assert near_dups.one_of_each_group(docs, 3, 85).count() == 3


def passage_texts(n, own, rng):
    """Texts that share 700 words and have ``own`` words each; every tenth group of three is copied with a few words changed."""
    passage = [f"p{k}" for k in range(700)]
    texts = []
    for i in range(n):
        words = [*passage, *(f"w{i}x{k}" for k in range(own))]
        if i % 10 < 2 and i:
            words = texts[i - 1].split(" ")
            for at in rng.sample(range(len(words)), 8):
                words[at] = f"e{i}x{at}"
        texts.append(" ".join(words))
    return texts


def test_more_texts_with_one_passage_than_a_family_holds(spark):
    """1,300 texts of ordinary length in one list, with the constants as they are."""
    texts = passage_texts(1300, 500, random.Random(12))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs, 3, 85).collect()}
    # Only a text and the copies made of it are near.
    for i in range(1300):
        assert got[i] == (i - i % 10 + (-1 if i >= 10 else 0) if i % 10 < 2 and i >= 10 else 0 if i < 2 else i), i


@pytest.mark.parametrize(("short", "family", "block", "blocks"), [(2, 4, 1 << 11, 1 << 20), (2, 4, 1 << 14, 0), (2, 4, 1, 0)])
@pytest.mark.parametrize("pair", [0, 4096])
def test_blocks_and_lists_equal_brute_force(monkeypatch, docs, texts, short, family, block, blocks, pair):
    """Families cut into blocks at once, after they were listed, and lists alone."""
    for name, value in {"SHORT": short, "FAMILY": family, "BLOCK": block, "BLOCKS": blocks, "_PAIR": pair}.items():
        monkeypatch.setattr(near_dups, name, value)
    got = {r["doc_id"]: tuple(r)[1:] for r in near_dups.near_duplicates(docs, 3, 85).collect()}
    assert got == groups(texts, 3, 85)


def near_copies(n, words, rng):
    """Copies of one text with some words replaced, left out or put in, so that about half of them are no near duplicates of it; every fifth is one of the copy before."""
    base = [f"b{k}" for k in range(words)]
    texts = [base]
    for i in range(1, n):
        rate, out = rng.uniform(0.0, 0.01 if i % 5 == 4 else 0.07), []
        for word in texts[-1] if i % 5 == 4 else base:
            kind = rng.random() / rate if rate else 9
            out += [word] if kind > 1 else [[], [f"r{rng.randrange(300)}"], [word, f"r{rng.randrange(300)}"]][int(kind * 3) % 3]
        texts.append(out)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("blocks", [0, 16])
def test_a_large_family_of_near_copies_is_settled_in_blocks(monkeypatch, spark, blocks):
    """The groups settled hold some rows a text, though the family is five times what one task settles."""
    monkeypatch.setattr(near_dups, "FAMILY", 80)
    monkeypatch.setattr(near_dups, "BLOCK", 120_000, raising=False)
    monkeypatch.setattr(near_dups, "BLOCKS", blocks, raising=False)
    made = []

    def settled(groups, keys, percent, settle=near_dups._settle):
        made.append(groups.count())
        return settle(groups, keys, percent)

    monkeypatch.setattr(near_dups, "_settle", settled)
    texts = near_copies(400, 300, random.Random(3))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in near_dups.near_duplicates(docs, 5, 80).collect()}
    assert got == groups(texts, 5, 80)
    assert 1 < len({c for _, c, _ in got.values()}) < 400
    assert 2 * len(texts) < sum(made) < 10 * len(texts)


def test_ids_that_may_be_wanted(spark):
    docs = spark.range(-500, 500).selectExpr("if(id = 7, null, id) as doc_id", "string(id) as text", "'x' as map_part", "'y' as map_bits")
    wanted = spark.createDataFrame([(i,) for i in (-500, -1, 0, 3, 499, 9999, None)], "doc_id long")
    found = may_be_among(docs, "doc_id", wanted)
    assert found.columns == docs.columns
    assert sorted(r["doc_id"] for r in found.collect()) == [-500, -1, 0, 3, 499]
    assert may_be_among(docs, "doc_id", wanted.limit(0)).count() == 0


def removed(texts, length=100):
    data = {d: (t or "").encode() for d, t in texts}
    first = {}
    for d in sorted(data):
        for i in range(len(data[d]) - length + 1):
            first.setdefault(data[d][i : i + length], (d, i))
    out = {}
    for d, b in data.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] != (d, i):
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum())
        out[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [20, 2])
def test_repeats_equal_brute_force(monkeypatch, docs, texts, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "BLOCK", 5000)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 3000 * hot)
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.remove_repeats(docs).drop("spans").collect()}
    assert got == removed(texts)


def test_repeats_with_repeated_and_missing_ids(spark, no_docs):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(150))
    docs = spark.createDataFrame([(1, text), (1, text + "!"), (2, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_removed"]) for r in repeats.remove_repeats(docs).collect()), key=str)
    # Rows that share an id are not before each other; all others repeat them.
    assert got == sorted([(1, 0), (1, 0), (2, 150), (None, 150), (None, 0)], key=str)
    assert repeats.remove_repeats(no_docs).count() == 0


def test_transform_sorts_all_suffixes():
    rng = random.Random(2)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 8))]
        end = np.cumsum([len(s) for s in strings])
        none = np.zeros(len(strings), np.int64)
        pieces = repeats.Pieces(np.frombuffer(b"".join(strings), np.uint8), end - [len(s) for s in strings], end, none, none, none)
        owner, left, prefix = repeats.transform(pieces)
        expected = sorted(((*s[k:], i - 1000), i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))
        assert list(zip(owner.tolist(), left.tolist(), strict=True)) == [(i, k) for _, i, k in expected]
        for x in range(1, len(owner)):
            a, b = (strings[owner[y]][left[y] :] for y in (x - 1, x))
            same = next((n for n, (c, d) in enumerate(zip(a, b, strict=False)) if c != d), min(len(a), len(b)))
            assert prefix[x] == same


def test_transform_reads_only_the_prefixes_between_neighbours(monkeypatch):
    """A round of the construction takes range minima between equal symbols, not between all of them."""
    letters = np.random.default_rng(5).integers(97, 123, 64 * 120).astype(np.uint8)
    end = np.arange(1, 65) * 120
    none = np.zeros(64, np.int64)
    read = []

    class Minimum:
        def __call__(self, *args):
            return np.minimum(*args)

        def reduceat(self, values, bounds):
            covered = np.maximum(np.diff(np.append(bounds, len(values))), 1)
            read.append(int(covered.sum()) / len(values))
            return np.minimum.reduceat(values, bounds)

    class Numpy:
        minimum = Minimum()

        def __getattr__(self, name):
            return getattr(np, name)

    monkeypatch.setattr(repeats, "np", Numpy())
    repeats.transform(repeats.Pieces(letters, end - 120, end, none, none, none))
    assert sum(read) / len(read) < 6
