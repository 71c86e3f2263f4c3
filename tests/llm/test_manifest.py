"""The Merkle manifest against a plain recomputation."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfline.llm import manifest, queries


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return digest(map(field, row))


def tree(nodes, fan_out):
    """Root, and for every node the siblings left and right of it, level by level."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, groups = [], []
        for start in range(0, len(nodes), fan_out):
            run = nodes[start : start + fan_out]
            for k in range(len(run)):
                for i in members[start + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(digest(run))
            groups.append([i for m in members[start : start + fan_out] for i in m])
        nodes, members = above, groups
    return nodes[0], paths


def is_tampered(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0


def expected(rows, fan_out=16):
    """Result rows of documents (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in sources:
        mine = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((mine, *tree([leaf_of(r) for r in mine], fan_out)))
    root, above = tree([t[1] for t in trees], fan_out) if trees else (None, [])
    out = []
    for (mine, subroot, paths), upper in zip(trees, above, strict=True):
        for row, path in zip(mine, paths, strict=True):
            path = path + upper
            node = leaf_of((*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4])) if row[4] is not None and is_tampered(row) else row)
            for before, after in path:
                node = digest([before, node, after])
            out.append((row[0], leaf_of(row), subroot, root, digest(b + a for b, a in path), node, node == root))
    return sorted(out, key=str)


def result(spark, rows, monkeypatch, fan_out=16, extra=""):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    if extra:
        df = df.selectExpr("*", extra)
    monkeypatch.setattr(queries, "table", lambda *_: df.repartition(3))
    monkeypatch.setattr(manifest, "FAN_OUT", fan_out)
    original = manifest.manifest
    monkeypatch.setattr(queries.manifest, "manifest", lambda docs, tampered: original(docs, tampered, fan_out))
    found = queries.op12_manifest(spark, "")
    monkeypatch.setattr(queries.manifest, "manifest", original)
    assert found.dtypes == [
        ("doc_id", "bigint"), ("leaf", "string"), ("subroot", "string"), ("root", "string"), ("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean"),
    ]
    return sorted((tuple(r) for r in found.collect()), key=str)


def random_rows(rng, n):
    sources = [None, "", "é", "zz", "=x", "A", "src1"]
    text = lambda: rng.choice([None, "", "Plain Text", "lower only", "Ünï ÇODÉ", "A" * rng.randint(1, 5000)])
    ids = rng.sample(range(-300, 3 * n), n - n // 4) + rng.sample([-(1 << 63), (1 << 63) - 1, 1 << 40, -(1 << 40), 64, 63, 0], 3)
    rows = [(i, rng.choice(sources) if rng.random() < 0.6 else "hot", rng.choice([None, "en"]), rng.choice([None, 3]), text()) for i in ids]
    rows += rng.choices(rows, k=n // 8) + [(None, r[1], *r[2:]) for r in rng.choices(rows, k=n // 8)]
    rows += [(rows[0][0], rows[0][1], "xx", k, "other") for k in range(5)]
    return rows


@pytest.mark.parametrize(("n", "fan_out"), [(40, 2), (900, 16)])
def test_manifest_equals_plain_recomputation(spark, monkeypatch, n, fan_out):
    rows = random_rows(random.Random(n), n)
    found = result(spark, rows, monkeypatch, fan_out, extra="'x' as family")
    assert found == expected(rows, fan_out)
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


def test_exact_powers_and_single_leaves(spark, monkeypatch):
    rows = [(i, f"s{n}", "en", 1, f"T{i}") for n in (1, 16, 17, 256, 257) for i in range(n)]
    rows += [(i, f"lone{i}", "en", 1, "t") for i in range(18)]
    assert result(spark, rows, monkeypatch) == expected(rows)


def test_many_copies_of_one_row(spark, monkeypatch):
    rows = [(5, "s", "en", 1, "Same")] * 400 + [(None, None, None, None, None)] * 300 + [(6, "s", "en", 1, "Same")]
    assert result(spark, rows, monkeypatch) == expected(rows)


def test_no_rows(spark, monkeypatch):
    assert result(spark, [], monkeypatch) == []


def test_places_are_ranks(spark, monkeypatch):
    rows = random_rows(random.Random(9), 300)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    found = manifest.manifest(df).collect()
    assert all(r["folded_root"] == r["root"] for r in found)
    for source in {r[1] for r in rows}:
        mine = sorted((r for r in found if r["source"] == source), key=lambda r: r["place"])
        assert [r["place"] for r in mine] == list(range(len(mine)))
        order = [(r["doc_id"] is not None, r["doc_id"] or 0, r["leaf"]) for r in mine]
        assert order == sorted(order)
