"""Spelling variants against a plain comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from shelfline.llm import queries, spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= 7 and k >= 2}
    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def edit(rng, word):
    at, c = rng.randrange(len(word)), rng.choice("abcéßÿñ×")
    return rng.choice((word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]))


def random_texts(rng):
    base = ["".join(rng.choice("abcéàz") for _ in range(rng.randint(6, 16))) for _ in range(25)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaaa", "abababababab", "b" * 40, "ab" * 60, "q" * 3000, "q" * 2999]
    words = []
    for word in base:
        words += [word] * rng.choice((2, 30, 400))
        for _ in range(8):
            near = edit(rng, word)
            words += [near] * rng.choice((1, 2, 3, 30)) + [edit(rng, near)] * rng.choice((1, 2))
    rng.shuffle(words)
    words = [w.upper() if rng.random() < 0.1 and w.isascii() else w.capitalize() if w[0].isascii() else w for w in words]
    texts = [rng.choice((" ", ", ", "-1", "\n")).join(words[i : i + 60]) for i in range(0, len(words), 60)]
    rows = [(i - 5, t) for i, t in enumerate(texts)]
    return [*rows, rows[0], rows[0], (None, texts[1]), (7, None), (8, ""), (9, "12 ... 漢字漢字漢字漢字")]


@pytest.mark.parametrize(("tile", "block", "counted", "batch"), [(4096, 128, 200_000, 2000), (3, 4, 5, 7), (1, 2, 50, 2000)])
def test_variants_equal_all_pairs(spark, monkeypatch, tile, block, counted, batch):
    monkeypatch.setattr(spelling, "TILE", tile)
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "COUNTED", counted)
    rows = random_texts(random.Random(tile))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as word", "'y' as tile").repartition(3)
    if batch != 2000:
        monkeypatch.setattr(spelling, "prepare", lambda s: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch)))
    found = spelling.spelling_variants(df)
    assert found.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    got = found.collect()
    assert len(got) == len({r["word"] for r in got})
    wanted = expected(rows)
    assert {r["word"]: tuple(r)[1:] for r in got} == wanted
    assert any(w[1] not in (k, w[0]) for k, w in wanted.items()), "no way of two forms"


def test_every_pair_meets_in_one_tile(spark):
    """All words of two letters, and long ones: the tiles join near words once, whatever the lengths."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") for _ in range(k)) for k in (7, 8, 9, 33, 34, 100) for _ in range(60)})
    words += ["a" * 50, "a" * 51, "x" + "a" * 50]
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    got = {r["word"]: r["n_near"] for r in spelling.near_words(df).collect()}
    assert got == {w: k for w in words if (k := sum(v != w and one_edit(v, w) for v in words))}


def test_no_words(spark, no_docs):
    assert spelling.spelling_variants(no_docs).count() == 0
    few = spark.createDataFrame([(1, "short words only, unparalleled once")], "doc_id long, text string")
    assert spelling.spelling_variants(few).count() == 0


def test_query(spark):
    df = queries.op11_spelling_variants(spark, "/root/testdata/sf0.001")
    got = {r["word"]: tuple(r)[1:] for r in df.collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert got == expected([tuple(r) for r in docs])
